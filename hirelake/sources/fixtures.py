"""Stand-ins built from the given tables (see FIXTURES.md).

The reference ships no data, so every query reads the given parquet tables
and derives posting-shaped rows from them with plain DataFrame expressions.
Nothing here collects or samples: the derived rows grow with the inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_parts
from ..operators._util import literal_table
from ..functions.text import PLATFORMS, posting_url
from ..schemas import DAY_PARTS, POSTING_COLUMNS
from ..taxonomy import taxonomy_rows

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# --- FIXED VALUES: the five address shapes of the posting stand-in ----------
LOCATIONS = ["서울 강남구", "주소 경기 성남시", "부산", None, "서울  마포구"]
# -----------------------------------------------------------------------------

BASE_DATE = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A3: one given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list) -> Column:
    """values[index] for a small literal list, as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting rows derived from ``documents``: one per document and snapshot
    k (0 <= k <= doc_id % 3). Every character of the text lands in one of the
    four free-text fields (quarters of the text), so term work covers whole
    texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    doc_id = F.col("doc_id")
    text = F.col("text")
    n = F.char_length(text)
    q = F.ceil(n / 4).cast("int")
    subs = [sub for _, _, sub in taxonomy_rows()]
    cat_n = ((doc_id * 7 + F.col("k")) % 96).cast("int")
    category = F.when(cat_n < len(subs), F.try_element_at(F.array(*[F.lit(s) for s in subs]), cat_n + 1)) \
        .when(cat_n == 95, F.lit("블록체인 엔지니어")) \
        .otherwise(F.concat(F.lit("unmapped-"), cat_n.cast("string")))
    platform = _pick((doc_id % 4).cast("int"), PLATFORMS)
    snap = F.date_add(F.to_date(F.lit(BASE_DATE)), ((doc_id % 45) + F.col("k")).cast("int"))
    coordinate = F.when(doc_id % 3 == 0, F.lit(None).cast("array<double>")).otherwise(
        F.array(F.lit(33.0) + (doc_id % 50).cast("double") / F.lit(10.0),
                F.lit(126.0) + (doc_id % 30).cast("double") / F.lit(10.0)))
    end_at = (F.when(doc_id % 11 == 0, F.lit(None).cast("string"))
              .when(doc_id % 13 == 0, F.lit("open-ended"))
              .otherwise(F.date_add(F.to_date(F.lit(BASE_DATE)), (doc_id % 45).cast("int")).cast("string")))
    skills = F.when(doc_id % 7 == 0, F.lit(None).cast("array<string>")).otherwise(
        F.regexp_extract_all(text, F.lit("[A-Z][A-Za-z]+"), 0))

    rows = docs.withColumn("k", F.explode(F.sequence(F.lit(0), (doc_id % 3).cast("int"))))
    out = rows.select(
        doc_id.cast("string").alias("job_id"),
        platform.alias("platform"),
        category.alias("category"),
        posting_url(platform, doc_id).alias("url"),
        F.when(doc_id % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("company-"), (doc_id % 200).cast("string"))).alias("company"),
        F.split_part(text, F.lit("\n"), F.lit(1)).alias("title"),
        text.substr(F.lit(2) * q + 1, q).alias("primary_responsibility"),
        text.substr(q + 1, q).alias("required"),
        text.substr(F.lit(1), q).alias("preferred"),
        end_at.alias("end_at"),
        skills.alias("skills"),
        # addresses with ideographic and no-break spaces among the plain ones
        F.when(doc_id % 10 == 3, F.lit("\u3000경기\u3000성남시")).when(doc_id % 20 == 8, F.lit("부산\u00a0해운대구"))
        .otherwise(_pick((doc_id % 5).cast("int"), LOCATIONS)).alias("location"),
        text.substr(F.lit(3) * q + 1, n + 1).alias("welfare"),
        F.when(platform == "wanted", F.lit("")).when(platform == "rallit", F.col("lang"))
         .otherwise(F.lit(None).cast("string")).alias("body"),
        F.concat_ws("\n", F.col("source"), F.col("lang")).alias("company_description"),
        coordinate.alias("coordinate"),
        F.year(snap).cast("string").alias("year"),
        F.month(snap).cast("string").alias("month"),
        F.lpad(F.dayofmonth(snap).cast("string"), 2, "0").alias("day"),
    )
    return out


# Per-site landing shapes: column order and id type differ by site, as the
# four scrapers emit them. Used to exercise B3 (align) and G1 (union).
_SITE_ORDER = {
    "wanted": POSTING_COLUMNS,
    "jumpit": ["job_id", "platform", "category", "company", "title", "preferred", "required",
               "primary_responsibility", "url", "end_at", "skills", "location", "welfare", "body",
               "company_description", "coordinate"],
    "jobplanet": ["job_id", "platform", "category", "company", "title", "preferred", "required",
                  "primary_responsibility", "url", "end_at", "skills", "location", "welfare", "body",
                  "company_description", "coordinate"],
    "rallit": ["job_id", "category", "platform", "company", "title", "preferred", "required",
               "primary_responsibility", "url", "end_at", "skills", "location", "body",
               "company_description", "welfare", "coordinate"],
}
_INTEGER_IDS = {"jumpit", "rallit"}


def site_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The posting stand-in split into the four sites' landing tables, with
    their own column order and integer ids where the site uses them."""
    base = postings(spark, sf_dir)
    frames = {}
    for site, order in _SITE_ORDER.items():
        f = base.where(F.col("platform") == site)
        if site in _INTEGER_IDS:
            f = f.withColumn("job_id", F.col("job_id").cast("bigint"))
        frames[site] = f.select(*order, *DAY_PARTS)
    return frames


# --- Direct bindings of the TPC-H-ish tables ---------------------------------

def lineitem_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as postings: platform = l_returnflag, job_id = order-line,
    company = supplier, title = part, category = p_type (join to part), day
    parts of l_shipdate (unpadded strings, as partition paths may carry)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    rows = li.join(part, li.l_partkey == part.p_partkey, "left")
    parts = day_parts("l_shipdate")
    return rows.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("job_id"),
        F.col("l_returnflag").alias("platform"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("company"),
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("title"),
        parts["year"].alias("year"), parts["month"].alias("month"), parts["day"].alias("day"),
    )


ORDER_PLATFORM = {"F": "wanted", "O": "rallit", "P": "jumpit"}


def order_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as postings: major = o_orderstatus, middle = o_orderpriority,
    deadline = o_orderdate as text, platform by status."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    platform = None
    for code, name in ORDER_PLATFORM.items():
        platform = F.when(status == code, F.lit(name)) if platform is None else platform.when(status == code, F.lit(name))
    return o.select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        platform.alias("platform"),
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("company"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.to_date("o_orderdate").cast("string").alias("end_at"),
        F.col("o_orderpriority").alias("primary_responsibility"),
        F.concat(F.lit("segment of customer "), F.col("o_custkey").cast("string")).alias("company_description"),
        status.alias("major_category"),
        F.col("o_orderpriority").alias("middle_category"),
        F.lit(None).cast("string").alias("sub_category"),
        F.col("o_totalprice"),
        F.col("o_orderdate"),
    )


def event_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as daily posting rows: platform = event_type, job_id = user,
    unpadded day parts of ts."""
    ev = table(spark, sf_dir, "events")
    parts = day_parts("ts")
    return ev.select(
        parts["year"].alias("year"), parts["month"].alias("month"), parts["day"].alias("day"),
        F.col("event_type").alias("platform"),
        F.col("user_id").cast("string").alias("job_id"),
        F.lit(None).cast("string").alias("company"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("major_category"),
        F.lit(None).cast("string").alias("middle_category"),
        F.lit(None).cast("string").alias("sub_category"),
    )


def customer_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers as postings for the geocode path: location = nation name,
    platform by c_custkey % 4, own coordinate unless c_custkey % 3 = 0."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    key = F.col("c_custkey")
    return rows.select(
        key.cast("string").alias("job_id"),
        _pick((key % 4).cast("int"), PLATFORMS).alias("platform"),
        F.col("n_name").alias("location"),
        F.when(key % 3 == 0, F.lit(None).cast("array<double>")).otherwise(
            F.array(F.col("c_nationkey").cast("double"), (key % 10).cast("double"))).alias("coordinate"),
    )


def nation_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address lookup table (location, lat, lon): every nation whose key is
    not divisible by 5."""
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_nationkey") % 5 != 0).select(
        F.col("n_name").alias("location"),
        (F.lit(30.0) + F.col("n_nationkey").cast("double")).alias("lat"),
        (F.lit(120.0) + F.col("n_regionkey").cast("double")).alias("lon"),
    )


# --- FIXED VALUES: address table of the posting stand-in ---------------------
# Two of the five address shapes are missing on purpose (lookup misses).
POSTING_ADDRESSES = [
    ("서울 강남구", 37.4979, 127.0276),
    ("부산", 35.1796, 129.0756),
    ("서울  마포구", 37.5663, 126.9019),
]
# -----------------------------------------------------------------------------


def posting_addresses(spark: SparkSession) -> DataFrame:
    """Fixed literal table: safe to broadcast without a size check."""
    return literal_table(spark, POSTING_ADDRESSES, [("location", "string"), ("lat", "double"), ("lon", "double")])


def embedding_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as company rows: coordinate = first two embedding values."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.concat(F.lit("company-"), F.col("label").cast("string")).alias("company"),
        F.when(F.col("vec_id") % 7 == 0, F.lit(None).cast("array<float>"))
         .otherwise(F.slice("embedding", 1, 2)).alias("coordinate"),
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("company_description"),
    )


def lexicon(spark: SparkSession, sf_dir: str, pattern: str = "[A-Za-zÀ-ɏ]+") -> DataFrame:
    """Noun lexicon: distinct script runs in benchmark.text."""
    b = table(spark, sf_dir, "benchmark").select("text")
    return b.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("term")).distinct()


# --- events as operational events (J1, J2, B19) -------------------------------
# Object events: purchase -> created, error -> deleted, other types stay
# as they are (unknown to the alert). Job-state events: event type -> state.
OBJECT_TYPE_OF = {"purchase": "Object Created", "error": "Object Deleted"}
JOB_STATE_OF = {"purchase": "SUCCEEDED", "error": "FAILED", "click": "TIMEOUT", "view": "STOPPED"}
JOB_NAMES = ["first_stage", "second_stage", "other_job"]


def _map_type(col: Column, mapping: dict[str, str], default: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(default)


def object_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        _map_type(F.col("event_type"), OBJECT_TYPE_OF, F.col("event_type")).alias("detail_type"),
        F.concat(F.lit("bucket-"), (F.col("user_id") % 3).cast("string")).alias("bucket_name"),
        F.concat(F.lit("events/"), F.col("event_id").cast("string"), F.lit(".json")).alias("object_key"),
        F.floor(F.col("value") * 100).cast("bigint").alias("object_size"),
    )


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        _pick((F.col("user_id") % 3).cast("int"), JOB_NAMES).alias("job_name"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("job_run_id"),
        _map_type(F.col("event_type"), JOB_STATE_OF, F.lit("RUNNING")).alias("state"),
        F.floor(F.col("value") * 30).cast("bigint").alias("execution_time"),
    )


# --- Raw site payloads (B14-B18): one JSON document per posting ----------------
# Built per row with to_json in each site's own shape; the normalisers must
# turn them back into posting rows. Text fields carry CRLF line ends for the
# site whose scraper converts them, and that site's deadline uses dots.

def raw_payloads(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    p = postings(spark, sf_dir).where(F.col("platform") == site)
    lat = F.try_element_at("coordinate", F.lit(1))
    lon = F.try_element_at("coordinate", F.lit(2))
    if site == "wanted":
        body = F.struct(F.struct(
            F.struct(F.col("company").alias("name")).alias("company"),
            F.col("title").alias("position"),
            F.struct(F.col("primary_responsibility").alias("main_tasks"), F.col("required").alias("requirements"),
                     F.col("preferred").alias("preferred_points"), F.col("welfare").alias("benefits"),
                     F.col("company_description").alias("intro")).alias("detail"),
            F.col("end_at").alias("due_time"),
            F.transform("skills", lambda s: F.struct(s.alias("title"))).alias("skill_tags"),
            F.struct(F.col("location").alias("full_location"),
                     F.struct(F.struct(lat.alias("lat"), lon.alias("lng")).alias("location")).alias("geo_location")
                     ).alias("address"),
        ).alias("job"))
    elif site == "jumpit":
        body = F.struct(F.struct(
            F.col("company").alias("companyName"), F.col("title").alias("title"),
            F.col("preferred").alias("preferredRequirements"), F.col("required").alias("qualifications"),
            F.col("primary_responsibility").alias("responsibility"), F.col("end_at").alias("closedAt"),
            F.transform("skills", lambda s: F.struct(s.alias("stack"))).alias("techStacks"),
            F.col("welfare").alias("welfares"), F.col("company_description").alias("serviceInfo"),
            F.struct(F.struct(F.struct(F.col("location").alias("streetAddress")).alias("address"))
                     .alias("jobLocation")).alias("jobPostingForSearchEngine"),
        ).alias("result"))
    elif site == "jobplanet":
        def crlf(c):
            return F.replace(F.col(c), F.lit("\n"), F.lit("\r\n"))
        dotted = F.coalesce(F.date_format(F.col("end_at").try_cast("date"), "yyyy.MM.dd"), F.col("end_at"))
        body = F.struct(F.struct(
            dotted.alias("end_at"), F.col("company").alias("name"), F.col("title").alias("title"),
            crlf("preferred").alias("preferred_skill"), crlf("required").alias("required_qualification"),
            crlf("primary_responsibility").alias("primary_responsibility"), F.col("skills").alias("skills"),
            F.coalesce(F.col("location"), F.lit("")).alias("location"), crlf("welfare").alias("benefit"),
            crlf("company_description").alias("introduction"),
        ).alias("data"))
    elif site == "rallit":
        body = F.struct(F.struct(
            F.col("job_id").cast("bigint").alias("id"), F.col("company").alias("companyName"),
            F.col("title").alias("title"), F.col("preferred").alias("preferredQualifications"),
            F.col("required").alias("basicQualifications"), F.col("primary_responsibility").alias("responsibilities"),
            F.col("end_at").alias("endedAt"), F.col("skills").alias("jobSkillKeywords"),
            F.col("location").alias("addressMain"), F.col("body").alias("description"),
            F.col("company_description").alias("companyDescription"), F.col("welfare").alias("benefits"),
            lat.alias("latitude"), lon.alias("longitude"),
        ).alias("data"))
    else:
        raise ValueError(site)
    # every 17th posting's payload is an empty object: the normaliser skips it
    payload = F.when(F.col("job_id").cast("bigint") % 17 == 0, F.lit("{}"))
    if site == "wanted":  # and every 19th holds an empty job object, which that site's scraper skips too
        payload = payload.when(F.col("job_id").cast("bigint") % 19 == 0, F.lit('{"job": {}}'))
    payload = payload.otherwise(F.to_json(body))
    return p.select("job_id", "category", payload.alias("payload"))


def landing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing documents as JSON text (A2/B1): the postings of one site and
    day in groups of at most 64 source documents (a bounded group however
    large the input). Every third group uses the older wrapper key
    ``result``, every seventh carries neither key; jumpit and rallit ids
    are JSON numbers, the others strings."""
    p = postings(spark, sf_dir).withColumn("_group", F.floor(F.col("job_id").cast("bigint") / 64))
    fields = [F.col(c) for c in POSTING_COLUMNS if c != "job_id"]
    as_number = F.to_json(F.struct(F.col("job_id").cast("bigint").alias("job_id"), *fields))
    as_string = F.to_json(F.struct(F.col("job_id"), *fields))
    item = F.when(F.col("platform").isin(*_INTEGER_IDS), as_number).otherwise(as_string)
    docs = p.groupBy("platform", "year", "month", "day", "_group").agg(
        F.concat_ws(",", F.collect_list(item)).alias("_items"))
    key = (F.when(F.col("_group") % 7 == 6, F.lit("other"))
           .when(F.col("_group") % 3 == 0, F.lit("result")).otherwise(F.lit("results")))
    text = F.concat(F.lit('{"'), key, F.lit('": ['), F.col("_items"), F.lit("]}"))
    return docs.select(text.alias("document"), "year", "month", "day")


# --- Detail pages and listings (I16, I17, D20), derived from the given pages ---

#: Inner HTML of a paragraph: up to the next <p> or </p>.
PARAGRAPH = r"<p(?:\s[^>]*+)?>([^<]*+(?:<(?!/?p[\s>])[^<]*+)*+)"


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages' own heading, paragraphs and link texts laid out as a
    detail page: an intro section and four blocks with two paragraphs each (the
    last takes all that are left), tags as the site marks them, and before them
    a site heading, a banner section and a foreign tag. Pages with fewer
    paragraphs lack blocks."""
    from ..functions import html as h

    pg = table(spark, sf_dir, "pages").select("page_id", "html", h.tokens("html").alias("t")).select(
        "page_id", F.coalesce(h.text_of(h.first_element(F.col("t"), h.named("h1"))), F.lit("")).alias("h"),
        F.regexp_extract_all("html", F.lit(PARAGRAPH), 1).alias("ps"),
        F.regexp_extract_all("html", F.lit(r'<li[^>]*>\s*<a href="[^"]*">([^<]*)</a>'), 1).alias("links"))

    def p(n: int, attributes: str = "") -> Column:
        text = F.try_element_at("ps", F.lit(n))
        return F.when(text.isNull(), "").otherwise(F.concat(F.lit(f"<p{attributes}>"), text, F.lit("</p>")))

    rest = F.array_join(F.transform(F.slice("ps", F.lit(11), F.size("ps")), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    blocks = [F.concat(F.lit(f'<div data-n="{i} > 0" class="css-15i1vgz b{i}"><h3>b</h3><div><ul><li>'), p(2 * i + 1, ' class="t"'),
                       F.lit("</li></ul></div>"), p(2 * i + 2), rest if i == 4 else F.lit(""), F.lit("</div>")) for i in range(1, 5)]
    tags = F.array_join(F.transform("links", lambda t: F.concat(
        F.lit('<span class="css-kgsirb">\n#<!-- -->'), t, F.lit("\t</span>"))), "")
    html = F.concat(F.lit('<header><h1>site</h1><span class="css-kgsirb">#all</span></header><section class="banner"><p>banner</p></section>'
                          '<main><h1 class="title css-17ueevk">'), "h",
                    F.lit('</h1><section><p>no job</p></section><div class="css-1vbiael"><section class="a"><pre>code</pre>'), p(1, " id=x"), p(2),
                    F.lit("</section><section>"), *blocks, F.lit('</section></div><div class="css-104fbyc">'), tags,
                    F.lit("</div></main><section><p>footer</p></section>"))
    return pg.select("page_id", html.alias("html"))


def listing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing payloads whose ids overlap from page to page; every tenth is
    empty."""
    key = F.col("page_id")
    ids = F.array(*[F.struct(i.alias("id")) for i in (key, key + 1, F.floor(key / 2).cast("bigint"))])
    body = F.when(key % 10 == 0, F.lit('{"data": []}')).otherwise(F.to_json(F.struct(ids.alias("data"))))
    return table(spark, sf_dir, "pages").select(body.alias("payload"))
