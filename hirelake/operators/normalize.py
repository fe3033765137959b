"""Unnest, projection and payload normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import reformat_dotted
from ..functions.geo import coordinate_pair
from ..functions.text import crlf_to_lf, empty_to_null, posting_url
from ..schemas import DAY_PARTS, POSTING_COLUMNS, POSTING_SCHEMA


def landing_rows(df: DataFrame) -> DataFrame:
    """A2 + B1 + B13: one row per posting of landing documents that carry the
    array under ``results`` or the older ``result``; documents with neither
    give no rows. Partition columns present on the input are kept."""
    keep = [c for c in DAY_PARTS if c in df.columns]
    arr = F.coalesce(F.col("results"), F.col("result")) if "result" in df.columns else F.col("results")
    exploded = df.select(F.explode(arr).alias("r"), *keep)
    return exploded.select(*[F.col(f"r.{c}").alias(c) for c in POSTING_COLUMNS], *keep)


unnest_postings = landing_rows


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """B2: reorder / restrict columns."""
    return df.select(*cols)


def align(df: DataFrame, schema: T.StructType | list[str], extra: list[str] | None = None) -> DataFrame:
    """Select the schema's columns by name and cast them to its types, so
    frames of different sites can be unioned by name. Mixed id types (string
    and integer) become strings."""
    if isinstance(schema, list):
        schema = T.StructType([f for f in POSTING_SCHEMA.fields if f.name in schema])
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *(extra or []))


# --- Raw site payloads (B14-B18) ---------------------------------------------
# Each normaliser takes a frame with a JSON text column ``payload`` plus the
# context the scraper knows (job_id, category) and returns posting rows.

WANTED_PAYLOAD = T.StructType([T.StructField("job", T.StructType([
    T.StructField("company", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("position", T.StringType()),
    T.StructField("detail", T.StructType([
        T.StructField("main_tasks", T.StringType()),
        T.StructField("requirements", T.StringType()),
        T.StructField("preferred_points", T.StringType()),
        T.StructField("benefits", T.StringType()),
        T.StructField("intro", T.StringType()),
    ])),
    T.StructField("due_time", T.StringType()),
    T.StructField("skill_tags", T.ArrayType(T.StructType([T.StructField("title", T.StringType())]))),
    T.StructField("address", T.StructType([
        T.StructField("full_location", T.StringType()),
        T.StructField("geo_location", T.StructType([
            T.StructField("location", T.StructType([
                T.StructField("lat", T.DoubleType()),
                T.StructField("lng", T.DoubleType()),
            ])),
        ])),
    ])),
]))])

JUMPIT_PAYLOAD = T.StructType([T.StructField("result", T.StructType([
    T.StructField("companyName", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("preferredRequirements", T.StringType()),
    T.StructField("qualifications", T.StringType()),
    T.StructField("responsibility", T.StringType()),
    T.StructField("closedAt", T.StringType()),
    T.StructField("techStacks", T.ArrayType(T.StructType([T.StructField("stack", T.StringType())]))),
    T.StructField("welfares", T.StringType()),
    T.StructField("serviceInfo", T.StringType()),
    T.StructField("jobPostingForSearchEngine", T.StructType([
        T.StructField("jobLocation", T.StructType([
            T.StructField("address", T.StructType([T.StructField("streetAddress", T.StringType())])),
        ])),
    ])),
]))])

JOBPLANET_PAYLOAD = T.StructType([T.StructField("data", T.StructType([
    T.StructField("end_at", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("preferred_skill", T.StringType()),
    T.StructField("required_qualification", T.StringType()),
    T.StructField("primary_responsibility", T.StringType()),
    T.StructField("skills", T.ArrayType(T.StringType())),
    T.StructField("location", T.StringType()),
    T.StructField("benefit", T.StringType()),
    T.StructField("introduction", T.StringType()),
]))])

RALLIT_PAYLOAD = T.StructType([T.StructField("data", T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("companyName", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("preferredQualifications", T.StringType()),
    T.StructField("basicQualifications", T.StringType()),
    T.StructField("responsibilities", T.StringType()),
    T.StructField("endedAt", T.StringType()),
    T.StructField("jobSkillKeywords", T.ArrayType(T.StringType())),
    T.StructField("addressMain", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("companyDescription", T.StringType()),
    T.StructField("benefits", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
]))])


def _parsed(raw: DataFrame, schema: T.StructType, root: str) -> DataFrame:
    """Parse ``payload`` and keep rows whose root object is present."""
    p = raw.withColumn("_p", F.from_json("payload", schema))
    return p.where(F.col(f"_p.{root}").isNotNull())


def _posting(**cols) -> list:
    return [cols[c].cast(POSTING_SCHEMA[c].dataType).alias(c) for c in POSTING_COLUMNS]


def normalize_wanted(raw: DataFrame) -> DataFrame:
    """Nested JSON -> posting; skill titles via transform; coordinate only
    when both parts are present."""
    # An empty job object is skipped like a missing one; the other sites keep
    # an empty root object as a posting of NULLs, and skip only a missing one.
    filled = F.coalesce(F.regexp_replace(F.get_json_object("payload", "$.job"), r"\s", ""), F.lit("")) != "{}"
    p = _parsed(raw.where(filled), WANTED_PAYLOAD, "job")
    j = "_p.job"
    skills = F.col(f"{j}.skill_tags")
    return p.select(*_posting(
        job_id=F.col("job_id").cast("string"), platform=F.lit("wanted"), category=F.col("category"),
        url=posting_url(F.lit("wanted"), F.col("job_id")), company=F.col(f"{j}.company.name"),
        title=F.coalesce(F.col(f"{j}.position"), F.lit("")),
        primary_responsibility=F.col(f"{j}.detail.main_tasks"), required=F.col(f"{j}.detail.requirements"),
        preferred=F.col(f"{j}.detail.preferred_points"), end_at=F.col(f"{j}.due_time"),
        skills=F.transform(skills, lambda s: s["title"]),
        location=F.col(f"{j}.address.full_location"), welfare=F.col(f"{j}.detail.benefits"),
        body=F.lit(""), company_description=F.col(f"{j}.detail.intro"),
        coordinate=coordinate_pair(F.col(f"{j}.address.geo_location.location.lat"),
                                   F.col(f"{j}.address.geo_location.location.lng")),
    ))


def normalize_jumpit(raw: DataFrame) -> DataFrame:
    """Deep struct paths, tech stacks via transform, no coordinate."""
    p = _parsed(raw, JUMPIT_PAYLOAD, "result")
    r = "_p.result"
    return p.select(*_posting(
        job_id=F.col("job_id").cast("string"), platform=F.lit("jumpit"), category=F.col("category"),
        url=posting_url(F.lit("jumpit"), F.col("job_id")), company=F.col(f"{r}.companyName"),
        title=F.col(f"{r}.title"), primary_responsibility=F.col(f"{r}.responsibility"),
        required=F.col(f"{r}.qualifications"), preferred=F.col(f"{r}.preferredRequirements"),
        end_at=F.col(f"{r}.closedAt"), skills=F.transform(F.col(f"{r}.techStacks"), lambda s: s["stack"]),
        location=F.col(f"{r}.jobPostingForSearchEngine.jobLocation.address.streetAddress"),
        welfare=F.col(f"{r}.welfares"), body=F.lit(None), company_description=F.col(f"{r}.serviceInfo"),
        coordinate=F.lit(None),
    ))


def normalize_jobplanet(raw: DataFrame) -> DataFrame:
    """Empty -> NULL, CRLF -> LF, deadline 'yyyy.MM.dd' -> 'yyyy-MM-dd'."""
    p = _parsed(raw, JOBPLANET_PAYLOAD, "data")
    d = "_p.data"

    def text(name, nullable_empty=True):
        c = crlf_to_lf(F.col(f"{d}.{name}"))
        return empty_to_null(c) if nullable_empty else c

    return p.select(*_posting(
        job_id=F.col("job_id").cast("string"), platform=F.lit("jobplanet"), category=F.col("category"),
        url=posting_url(F.lit("jobplanet"), F.col("job_id")), company=F.col(f"{d}.name"),
        title=F.col(f"{d}.title"), primary_responsibility=text("primary_responsibility", False),
        required=text("required_qualification", False), preferred=text("preferred_skill"),
        end_at=reformat_dotted(F.col(f"{d}.end_at")), skills=F.col(f"{d}.skills"),
        location=empty_to_null(F.col(f"{d}.location")), welfare=text("benefit"), body=F.lit(None),
        company_description=text("introduction"), coordinate=F.lit(None),
    ))


def normalize_rallit(raw: DataFrame) -> DataFrame:
    """Coordinate only when latitude and longitude are both truthy."""
    p = _parsed(raw, RALLIT_PAYLOAD, "data")
    d = "_p.data"
    return p.select(*_posting(
        job_id=F.col(f"{d}.id").cast("string"), platform=F.lit("rallit"), category=F.col("category"),
        url=posting_url(F.lit("rallit"), F.col(f"{d}.id")), company=F.col(f"{d}.companyName"),
        title=F.col(f"{d}.title"), primary_responsibility=F.col(f"{d}.responsibilities"),
        required=F.col(f"{d}.basicQualifications"), preferred=F.col(f"{d}.preferredQualifications"),
        end_at=F.col(f"{d}.endedAt"), skills=F.col(f"{d}.jobSkillKeywords"),
        location=F.col(f"{d}.addressMain"), welfare=F.col(f"{d}.benefits"), body=F.col(f"{d}.description"),
        company_description=F.col(f"{d}.companyDescription"),
        coordinate=coordinate_pair(F.col(f"{d}.latitude"), F.col(f"{d}.longitude"), truthy=True),
    ))


NORMALIZERS = {
    "wanted": normalize_wanted,
    "jumpit": normalize_jumpit,
    "jobplanet": normalize_jobplanet,
    "rallit": normalize_rallit,
}
