"""Registered queries: one per operator of the inventory, keyed by its id.

Each callable takes (spark, sf_dir) and returns a lazy DataFrame over the
given tables (or rows Spark derives from them), so its work grows with them.
Column names match the oracle SQL in ``oracle/sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as fd
from ..functions import geo as fg
from ..functions import text as ft
from ..operators import clean, geo, marts, pages, quality, terms
from ..operators.order import with_position
from ..sources import fixtures as fx
from ..streaming import alerts
from ..taxonomy import loose_taxonomy_df, part_taxonomy_df, taxonomy_df
from .pipeline import explore, first_stage, mart_layer, normalize_layer, second_stage

# Reproducible "today" of the deadline marts (the reference used the current date).
POSTINGS_AS_OF = "2024-01-20"
ORDERS_AS_OF = "1998-06-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- shared lineages ---------------------------------------------------------

def cleaned(spark: SparkSession, d: str) -> DataFrame:
    """First-stage output over the posting stand-in, the input of the marts.

    Built from one scan of the stand-in: the same rows as the four-site
    union of K1 (``k1_first_stage`` keeps that union), since the site tables
    are themselves splits of one derived table here.
    """
    return first_stage([fx.postings(spark, d)], taxonomy_df(spark), fx.posting_addresses(spark),
                       addresses_fixed=True)


def cleaned_from_sites(spark: SparkSession, d: str) -> DataFrame:
    """K1 proper: align and union the four site tables, then clean."""
    frames = list(fx.site_frames(spark, d).values())
    return first_stage(frames, taxonomy_df(spark), fx.posting_addresses(spark), addresses_fixed=True)


def daily(spark: SparkSession, d: str) -> DataFrame:
    return marts.daily_postings(cleaned(spark, d))


def unique_jds(spark: SparkSession, d: str) -> DataFrame:
    return marts.unique_postings(daily(spark, d))


def lineitem_classified(spark: SparkSession, d: str) -> DataFrame:
    return clean.map_categories(fx.lineitem_postings(spark, d), part_taxonomy_df(spark))


# --- minimum slice: taxonomy join -> daily -> unique -> counts ---------------

@query("c1_category_join")
def c1_category_join(spark, d):
    p = fx.postings(spark, d)
    return clean.map_categories(p, taxonomy_df(spark)).select(
        "job_id", "platform", "category", "major_category", "middle_category", "sub_category",
        "year", "month", "day")


@query("c1_category_join_part")
def c1_category_join_part(spark, d):
    return lineitem_classified(spark, d).select(
        "job_id", "platform", "category", "major_category", "middle_category", "sub_category")


@query("b10_daily_postings")
def b10_daily_postings(spark, d):
    return daily(spark, d)


@query("b10_daily_postings_lineitem")
def b10_daily_postings_lineitem(spark, d):
    return marts.daily_postings(lineitem_classified(spark, d))


@query("b11_unique_postings")
def b11_unique_postings(spark, d):
    return unique_jds(spark, d)


@query("b11_unique_postings_lineitem")
def b11_unique_postings_lineitem(spark, d):
    return marts.unique_postings(marts.daily_postings(lineitem_classified(spark, d)))


@query("d1_count_major")
def d1_count_major(spark, d):
    return marts.count_by(unique_jds(spark, d), ["major_category"])


@query("d2_count_major_middle")
def d2_count_major_middle(spark, d):
    return marts.count_by(unique_jds(spark, d), ["major_category", "middle_category"])


@query("k1_first_stage")
def k1_first_stage(spark, d):
    return cleaned_from_sites(spark, d)


@query("b8_company_detail")
def b8_company_detail(spark, d):
    return geo.company_detail(cleaned(spark, d))


def lexicon(spark, d):
    return fx.lexicon(spark, d, terms.FIXTURE_PATTERN)


# --- sources and projections -------------------------------------------------

@query("a3_read_table")
def a3_read_table(spark, d):
    from ..sources.tables import read_table, register_views
    register_views(spark, {"hl_orders": fx.table(spark, d, "orders")})
    return read_table(spark, "hl_orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("a4_read_day")
def a4_read_day(spark, d):
    from ..sources.tables import read_day
    ev = fx.table(spark, d, "events")
    parts = fd.day_parts("ts", padded=True)
    # The table is not partitioned by day: a range of ts prunes row groups.
    one = ev.where((F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
    days = one.select("event_id", "user_id", "event_type", *[v.alias(k) for k, v in parts.items()])
    return read_day(days, "2024", "01", "15")


@query("a10_sql_view")
def a10_sql_view(spark, d):
    cleaned(spark, d).createOrReplaceTempView("posting_analysis")
    return spark.sql("""
        SELECT major_category, middle_category, COUNT(DISTINCT job_id) AS count
        FROM posting_analysis GROUP BY major_category, middle_category""")


@query("b2_select_columns")
def b2_select_columns(spark, d):
    from ..operators.normalize import select_columns
    return select_columns(fx.postings(spark, d), ["job_id", "platform", "category", "company", "title",
                                                  "url", "end_at", "location"])


@query("b3_align")
def b3_align(spark, d):
    from ..operators.normalize import align
    from ..schemas import POSTING_SCHEMA
    out = None
    for f in fx.site_frames(spark, d).values():  # every site, every column, casts of the arrays too
        aligned = align(f, POSTING_SCHEMA)
        out = aligned if out is None else out.unionByName(aligned)
    return out


@query("b4_split_platform")
def b4_split_platform(spark, d):
    return clean.split_platform(fx.order_postings(spark, d), ["wanted", "rallit"]).select(
        "job_id", "platform", "company", "major_category")


@query("b5_by_major")
def b5_by_major(spark, d):
    return clean.by_major(cleaned(spark, d), "GAME").select(
        "job_id", "platform", "category", "major_category", "middle_category", "sub_category")


@query("b6_has_coordinates")
def b6_has_coordinates(spark, d):
    return geo.has_coordinates(geo.company_detail(cleaned(spark, d)))


@query("b7_upcoming_deadlines")
def b7_upcoming_deadlines(spark, d):
    return marts.upcoming_deadlines(cleaned(spark, d), POSTINGS_AS_OF, 7)


@query("b7_upcoming_deadlines_orders")
def b7_upcoming_deadlines_orders(spark, d):
    return marts.upcoming_deadlines(fx.order_postings(spark, d), ORDERS_AS_OF, 7)


@query("b8_company_detail_embeddings")
def b8_company_detail_embeddings(spark, d):
    return geo.company_detail(fx.embedding_postings(spark, d))


@query("b9_sub_category_list")
def b9_sub_category_list(spark, d):
    return marts.sub_category_list(unique_jds(spark, d))


@query("b19_events_in")
def b19_events_in(spark, d):
    return alerts.job_rule(fx.job_events(spark, d), fx.JOB_NAMES[:2]).select("event_id", "job_name", "state")


# --- joins ------------------------------------------------------------------

@query("c2_posting_skills")
def c2_posting_skills(spark, d):
    c = cleaned(spark, d)
    jds = marts.unique_postings(marts.daily_postings(c))
    return marts.posting_terms(jds, marts.unnest_distinct(c, "skills", "unnested_skill"),
                               "unnested_skill", "skill", with_sub=False)


def _english_mart(col, alias):
    def run(spark, d):
        c = cleaned(spark, d)
        jds = marts.unique_postings(marts.daily_postings(c))
        out = f"unnested_{col}_english_nouns"
        return marts.posting_terms(jds, terms.latin_term_table(c, col, out), out, alias)
    return run


def _korean_mart(col, alias):
    def run(spark, d):
        c = cleaned(spark, d)
        jds = marts.unique_postings(marts.daily_postings(c))
        out = f"unnested_{col}_korean_nouns"
        t = terms.lexicon_term_table(c, col, out, lexicon(spark, d), terms.FIXTURE_PATTERN)
        return marts.posting_terms(jds, t, out, alias)
    return run


QUERIES["c3_posting_preferred"] = _english_mart("preferred", "preferred")
QUERIES["c4_posting_required"] = _english_mart("required", "required")
QUERIES["c5_posting_responsibility"] = _english_mart("primary_responsibility", "primary_responsibility")
QUERIES["c6_posting_welfare_english"] = _english_mart("welfare", "unnested_welfare_english_nouns")
QUERIES["c7_posting_welfare_korean"] = _korean_mart("welfare", "unnested_welfare_korean_nouns")


@query("c8_company_coordinates")
def c8_company_coordinates(spark, d):
    c = cleaned(spark, d)
    return marts.company_coordinates(marts.unique_postings(marts.daily_postings(c)), geo.company_detail(c))


@query("c9_semi_on")
def c9_semi_on(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    urgent = fx.table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.semi_on(li, urgent, ["l_orderkey"])


@query("c10_geocode")
def c10_geocode(spark, d):
    return geo.geocode(fx.customer_postings(spark, d), fx.nation_addresses(spark, d))


@query("c11_classify_loose")
def c11_classify_loose(spark, d):
    return clean.classify_loose(fx.postings(spark, d), loose_taxonomy_df(spark)).select(
        "job_id", "platform", "category", "major_category", "middle_category", "year", "month", "day")


# --- aggregations -------------------------------------------------------------

@query("d1_count_major_orders")
def d1_count_major_orders(spark, d):
    o = fx.order_postings(spark, d)
    return marts.count_by(o.select(*marts.UNIQUE_JD_COLUMNS).distinct(), ["major_category"])


@query("d2_count_major_middle_orders")
def d2_count_major_middle_orders(spark, d):
    o = fx.order_postings(spark, d)
    return marts.count_by(o.select(*marts.UNIQUE_JD_COLUMNS).distinct(), ["major_category", "middle_category"])


@query("d3_count_sub")
def d3_count_sub(spark, d):
    return marts.count_by(unique_jds(spark, d), ["sub_category"])


@query("d4_daily_counts")
def d4_daily_counts(spark, d):
    return marts.daily_counts(daily(spark, d))


@query("d4_daily_counts_events")
def d4_daily_counts_events(spark, d):
    return marts.daily_counts(marts.daily_postings(fx.event_postings(spark, d)))


@query("d5_distinct_by_major")
def d5_distinct_by_major(spark, d):
    return marts.distinct_postings(lineitem_classified(spark, d), ["major_category"])


@query("d6_distinct_by_major_middle")
def d6_distinct_by_major_middle(spark, d):
    return marts.distinct_postings(lineitem_classified(spark, d), ["major_category", "middle_category"])


@query("d7_count_non_null")
def d7_count_non_null(spark, d):
    return quality.count_non_null(cleaned(spark, d), ["major_category", "middle_category", "sub_category"])


@query("d8_ranked_major")
def d8_ranked_major(spark, d):
    return with_position(quality.ranked_counts(cleaned(spark, d), "major_category"))


@query("d9_ranked_middle")
def d9_ranked_middle(spark, d):
    return with_position(quality.ranked_counts(cleaned(spark, d), "middle_category"))


@query("d10_groups_per_middle")
def d10_groups_per_middle(spark, d):
    return quality.groups_per_middle(cleaned(spark, d))


@query("d11_count_by_sido")
def d11_count_by_sido(spark, d):
    return quality.count_by_sido(cleaned(spark, d))


@query("d12_count_by_gugun")
def d12_count_by_gugun(spark, d):
    return quality.count_by_gugun(cleaned(spark, d))


def _li_keys(spark, d):
    return fx.lineitem_postings(spark, d).select("job_id", "platform", "company", "title")


@query("d14_repeated_keys")
def d14_repeated_keys(spark, d):
    return quality.repeated_keys(_li_keys(spark, d), ["job_id"])


@query("d15_duplicate_rows")
def d15_duplicate_rows(spark, d):
    return quality.duplicate_rows(_li_keys(spark, d), ["job_id"])


@query("d16_duplicate_rows_pair")
def d16_duplicate_rows_pair(spark, d):
    return quality.duplicate_rows(_li_keys(spark, d), ["job_id", "company"])


@query("d16_duplicate_rows_pair_postings")
def d16_duplicate_rows_pair_postings(spark, d):
    p = fx.postings(spark, d).select("job_id", "platform", "company", "category", "year", "month", "day")
    return quality.duplicate_rows(p, ["job_id", "company"])


@query("d17_duplicate_summary")
def d17_duplicate_summary(spark, d):
    return quality.duplicate_summary(_li_keys(spark, d))


@query("d17_duplicate_summary_postings")
def d17_duplicate_summary_postings(spark, d):
    return quality.duplicate_summary(fx.postings(spark, d))


@query("d18_distinct_dates")
def d18_distinct_dates(spark, d):
    return with_position(quality.distinct_dates(fx.event_postings(spark, d)))


@query("d19_dedupe_first")
def d19_dedupe_first(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return quality.dedupe_first(docs, ["text"], ["doc_id"], row_id="doc_id")


@query("d20_distinct_ids")
def d20_distinct_ids(spark, d):
    return pages.distinct_ids(fx.listing_payloads(spark, d))


@query("d21_profile")
def d21_profile(spark, d):
    o = fx.table(spark, d, "orders")
    p = quality.profile(o)
    return p.select("column", "count", "nulls", "min", "max", F.round("mean", 4).alias("mean"),
                    F.round("stddev", 2).alias("stddev"),
                    *[F.round(F.get("quartiles", F.lit(i)), 4).alias(n) for i, n in enumerate(("q1", "median", "q3"))])


# --- sorts ---------------------------------------------------------------

@query("f2_sort_by")
def f2_sort_by(spark, d):
    return with_position(quality.sort_by(_li_keys(spark, d), ["job_id"], as_string=True))


@query("f4_preview")
def f4_preview(spark, d):
    return quality.preview(_li_keys(spark, d), 20, ["job_id", "company"])


# --- set operations -----------------------------------------------------

@query("g1_union_sources")
def g1_union_sources(spark, d):
    return clean.union_sources(list(fx.site_frames(spark, d).values()))


@query("g2_enrich_subset")
def g2_enrich_subset(spark, d):
    return geo.geocode(fx.postings(spark, d), fx.posting_addresses(spark), fixed_size=True).select(
        "job_id", "platform", "location", "coordinate", "year", "month", "day")


@query("g3_union_loose")
def g3_union_loose(spark, d):
    f = fx.site_frames(spark, d)
    return clean.union_loose([
        f["wanted"].select(F.col("job_id").cast("string").alias("job_id"), "platform", "title", "location"),
        f["jobplanet"].select(F.col("job_id").cast("string").alias("job_id"), "platform", "company", "end_at"),
        f["jumpit"].select(F.col("job_id").cast("string").alias("job_id"), "platform", "title", "end_at"),
        f["rallit"].select(F.col("job_id").cast("string").alias("job_id"), "platform", "location"),
    ])


# --- scalar functions ---------------------------------------------------

@query("h1_clean_text")
def h1_clean_text(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    return ft.clean_text(docs, ["text"])


@query("h2_h13_text_functions")
def h2_h13_text_functions(spark, d):
    docs = fx.table(spark, d, "documents")
    t = F.col("text")
    return docs.select(
        "doc_id",
        ft.crlf_to_lf(t).alias("lf_text"),
        ft.empty_to_null(F.split_part(t, F.lit("\n"), F.lit(2))).alias("second_line"),
        ft.remove_spaces(F.col("source")).alias("source_nospace"),
        F.size(ft.split_ws(t)).cast("bigint").alias("n_tokens"),
        ft.prefix(F.col("lang"), 1).alias("lang_initial"),
        F.col("text").startswith("The").alias("starts_the"),
        ft.strip(F.split_part(t, F.lit("\n"), F.lit(1))).alias("first_line_stripped"),
    )


@query("h10_sido_gugun")
def h10_sido_gugun(spark, d):
    p = fx.postings(spark, d)
    return p.select("job_id", "location", fg.sido("location").alias("sido"), fg.gugun("location").alias("gugun"))


@query("h12_url_id")
def h12_url_id(spark, d):
    return pages.url_id(fx.table(spark, d, "pages"))


@query("h17_date_parts")
def h17_date_parts(spark, d):
    ev = fx.table(spark, d, "events")
    parts = fd.day_parts("ts")
    return ev.select("event_id", *[v.alias(k) for k, v in parts.items()],
                     fd.date_str(parts["year"], parts["month"], parts["day"]).alias("date_str"))


@query("h25_json_field")
def h25_json_field(spark, d):
    ev = fx.table(spark, d, "events")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"),
                     F.get_json_object("props", "$.k").alias("k_text"))


# --- term extraction -------------------------------------------------------

@query("i1_jd_skills")
def i1_jd_skills(spark, d):
    return marts.unnest_distinct(cleaned(spark, d), "skills", "unnested_skill")


def _latin_table(col):
    def run(spark, d):
        return terms.latin_term_table(cleaned(spark, d), col, f"unnested_{col}_english_nouns")
    return run


def _korean_table(col):
    def run(spark, d):
        return terms.lexicon_term_table(cleaned(spark, d), col, f"unnested_{col}_korean_nouns",
                                        lexicon(spark, d), terms.FIXTURE_PATTERN)
    return run


QUERIES["i2_preferred_english"] = _latin_table("preferred")
QUERIES["i3_preferred_korean"] = _korean_table("preferred")
QUERIES["i4_responsibility_english"] = _latin_table("primary_responsibility")
QUERIES["i5_responsibility_korean"] = _korean_table("primary_responsibility")
QUERIES["i6_required_english"] = _latin_table("required")
QUERIES["i7_required_korean"] = _korean_table("required")
QUERIES["i8_welfare_english"] = _latin_table("welfare")
QUERIES["i9_welfare_korean"] = _korean_table("welfare")


@query("i10_latin_terms")
def i10_latin_terms(spark, d):
    docs = fx.table(spark, d, "documents")
    return docs.select("doc_id", ft.latin_terms("text").alias("terms"))


@query("i11_lexicon_terms")
def i11_lexicon_terms(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    out = terms.lexicon_terms(docs, ["text"], lexicon(spark, d), terms.FIXTURE_PATTERN,
                              name=lambda c: "nouns", key=["doc_id"])
    return out.select("doc_id", "nouns")


@query("i14_page_links")
def i14_page_links(spark, d):
    # The given pages link words, not posting ids: the slug stands in for the id.
    return pages.page_links(fx.table(spark, d, "pages"), id_pattern=r"^/(.+)$")


@query("i15_first_paragraph")
def i15_first_paragraph(spark, d):
    return pages.first_paragraphs(fx.table(spark, d, "pages"))


@query("i16_page_sections")
def i16_page_sections(spark, d):
    return pages.page_sections(fx.detail_pages(spark, d))


# --- alerts ---------------------------------------------------------------

@query("j1_object_alerts")
def j1_object_alerts(spark, d):
    ev = alerts.object_rule(fx.object_events(spark, d), ["bucket-0", "bucket-1"])
    return alerts.object_alerts(ev).select("event_id", "text", "attachment")


@query("j1_object_alerts_all")
def j1_object_alerts_all(spark, d):
    return alerts.object_alerts(fx.object_events(spark, d)).select("event_id", "detail_type", "text", "attachment")


@query("j2_job_state_alerts")
def j2_job_state_alerts(spark, d):
    ev = alerts.job_rule(fx.job_events(spark, d), fx.JOB_NAMES[:2])
    return alerts.job_state_alerts(ev).select("event_id", "text", "attachment")


# --- composite ---------------------------------------------------------

@query("k2_second_stage")
def k2_second_stage(spark, d):
    return second_stage(cleaned(spark, d), lexicon(spark, d), terms.FIXTURE_PATTERN)


@query("h16_reformat_date")
def h16_reformat_date(spark, d):
    o = fx.table(spark, d, "orders")
    dotted = F.date_format("o_orderdate", "yyyy.MM.dd")
    return o.select("o_orderkey", dotted.alias("dotted"), fd.reformat_dotted(dotted).alias("end_at"),
                    fd.reformat_dotted(F.col("o_orderpriority")).alias("not_a_date"))


@query("i13_eda_terms")
def i13_eda_terms(spark, d):
    from ..schemas import EDA_TERM_COLUMNS, term_column
    c = cleaned(spark, d).select("job_id", "platform", "category", "year", "month", "day", *EDA_TERM_COLUMNS)
    out = terms.add_term_columns(c, lexicon(spark, d), EDA_TERM_COLUMNS, terms.FIXTURE_PATTERN)
    arrays = [term_column(col, k) for k in ("korean", "english") for col in EDA_TERM_COLUMNS]
    return out.select("job_id", "platform", "category", "year", "month", "day", *arrays)


def _normalized(site):
    def run(spark, d):
        from ..operators.normalize import NORMALIZERS
        return NORMALIZERS[site](fx.raw_payloads(spark, d, site))
    return run


# B14-B18 (with H2, H3, H16, H23, H24): site payloads back to posting rows
QUERIES["b14_normalize_wanted"] = _normalized("wanted")
QUERIES["b15_normalize_jumpit"] = _normalized("jumpit")
QUERIES["b16_normalize_jobplanet"] = _normalized("jobplanet")
QUERIES["b17_normalize_rallit"] = _normalized("rallit")


@query("b1_landing_rows")
def b1_landing_rows(spark, d):
    """A2 + B1 + B13: parse landing documents, accept both wrapper keys,
    skip documents with neither, unnest the postings."""
    from ..operators.normalize import landing_rows
    from ..schemas import LANDING_SCHEMA
    docs = fx.landing_documents(spark, d)
    parsed = docs.select(F.from_json("document", LANDING_SCHEMA).alias("doc"), "year", "month", "day")
    return landing_rows(parsed.select("doc.*", "year", "month", "day"))


ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")


@query("d22_row_counts")
def d22_row_counts(spark, d):
    """Row count of every table (one aggregate per table)."""
    out = None
    for name in ALL_TABLES:
        c = fx.table(spark, d, name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


@query("h26_first_nested")
def h26_first_nested(spark, d):
    """First element of a nested JSON array, NULL on any miss (empty
    array, missing key or text that is not JSON)."""
    ev = fx.table(spark, d, "events")
    doc = (F.when(F.col("event_id") % 5 == 0, F.lit('{"documents": []}'))
           .when(F.col("event_id") % 7 == 0, F.lit("not json"))
           .otherwise(F.concat(F.lit('{"documents": [{"address": {"x": "'), F.col("user_id").cast("string"),
                               F.lit('", "y": '), F.col("props"), F.lit("}}]}"))))
    schema = "documents array<struct<address: struct<x: string, y: struct<k: bigint>>>>"
    first = F.try_element_at(F.from_json(doc, schema)["documents"], F.lit(1))["address"]
    return ev.select("event_id", first["x"].alias("x"), first["y"]["k"].alias("k"))


@query("i17_clean_tags")
def i17_clean_tags(spark, d):
    """Skill tags read from detail pages."""
    return pages.skill_tags(fx.detail_pages(spark, d))


# --- composed layers (K3-K5), one line per table ----------------------------

def table_digest(name: str, df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """table_name, rows, checksum: the rows and the order-free sum of the row
    hashes of a table (text, number and date columns; DOUBLE as ten
    thousandths)."""
    kinds = dict(df.dtypes)
    cols = sorted(cols or [c for c, k in df.dtypes if k in ("string", "bigint", "double", "date")])
    text = [(F.round(F.col(c) * 10000).cast("bigint") if kinds[c] == "double" else F.col(c)).cast("string") for c in cols]
    row = F.concat_ws("|", *[F.coalesce(t, F.lit("~")) for t in text])
    part = F.conv(F.substring(F.md5(row), 1, 7), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(part), F.lit(0)).alias("checksum")).select(
        F.lit(name).alias("table_name"), "rows", "checksum")


def _digests(tables: dict[str, DataFrame], cols: dict[str, list[str]] | None = None) -> DataFrame:
    lines = [table_digest(n, t, (cols or {}).get(n)) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, lines)


@query("k3_normalized_layer")
def k3_normalized_layer(spark, d):
    return _digests(normalize_layer(cleaned(spark, d), lexicon(spark, d), terms.FIXTURE_PATTERN))


@query("k4_mart_layer")
def k4_mart_layer(spark, d):
    c = cleaned(spark, d)
    return _digests(mart_layer(normalize_layer(c, lexicon(spark, d), terms.FIXTURE_PATTERN), c, POSTINGS_AS_OF))


@query("k5_explore")
def k5_explore(spark, d):
    """K5: digests of all tables of the exploration, on every column but
    arrays (skills and coordinate of the repeated rows; quartiles, which the
    text columns of postings do not have)."""
    return _digests(explore(cleaned(spark, d)))


@query("d13_count_by")
def d13_count_by(spark, d):
    """Rows per value of one column."""
    return marts.count_by(fx.customer_postings(spark, d), ["location"])
