"""Composite pipelines (K1-K5) and table rebuilds.

Each stage is one lazy DataFrame lineage; nothing is collected. Writing is
left to the caller (sinks) or to :func:`rebuild`, which materialises tables
in dependency order so later marts read the written parents instead of
recomputing them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import clean_text
from ..operators import geo, marts, quality, terms
from ..operators.clean import map_categories, union_sources
from ..sources.catalog import replace_table
from ..schemas import CLEANED_COLUMNS, DAY_PARTS, TERM_SOURCE_COLUMNS, TEXT_COLUMNS, term_column


def first_stage(frames: list[DataFrame], taxonomy: DataFrame, addresses: DataFrame,
                addresses_fixed: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """K1: align + union the site tables, classify, order columns, clean the
    free-text columns and geocode the platforms without coordinates. Columns
    in ``extra`` are carried along."""
    columns = [*CLEANED_COLUMNS, *extra]
    union = union_sources(frames, extra=[*DAY_PARTS, *extra])
    classified = map_categories(union, taxonomy).select(*columns)
    cleaned = clean_text(classified, TEXT_COLUMNS)
    return geo.geocode(cleaned, addresses, fixed_size=addresses_fixed).select(*columns)


def second_stage(cleaned: DataFrame, lexicon: DataFrame,
                 pattern: str = terms.KOREAN_PATTERN) -> DataFrame:
    """K2: add the eight term arrays (Korean nouns by lexicon, Latin terms)."""
    return terms.add_term_columns(cleaned, lexicon, TERM_SOURCE_COLUMNS, pattern=pattern)


def term_table_specs() -> list[tuple[str, str, str]]:
    """(table, source column, unnested column) of the eight term tables."""
    specs = []
    for col in TERM_SOURCE_COLUMNS:
        for kind in ("english", "korean"):
            name = term_column(col, kind)
            specs.append((f"jd_{name}", name, f"unnested_{name}"))
    return specs


def normalize_layer(cleaned: DataFrame, lexicon: DataFrame,
                    pattern: str = terms.KOREAN_PATTERN) -> dict[str, DataFrame]:
    """K3: the eleven normalised tables.

    The term tables are computed straight from the text tokens
    (DISTINCT job_id, platform, term) rather than from materialised arrays:
    the same rows, without building and re-exploding per-row arrays.
    """
    out = {
        "daily_jd_table": marts.daily_postings(cleaned),
        "company_detail": geo.company_detail(cleaned),
        "jd_skills": marts.unnest_distinct(cleaned, "skills", "unnested_skill"),
    }
    for table, name, unnested in term_table_specs():
        source = name.rsplit("_", 2)[0]
        if "_english_" in name:
            out[table] = terms.latin_term_table(cleaned, source, unnested)
        else:
            out[table] = terms.lexicon_term_table(cleaned, source, unnested, lexicon, pattern)
    return out


def mart_layer(norm: dict[str, DataFrame], enriched: DataFrame, as_of, days: int = 7) -> dict[str, DataFrame]:
    """K4: base mart unique_jds, then the twelve marts on top of it."""
    jds = marts.unique_postings(norm["daily_jd_table"])
    return {name: jds if name == "unique_jds" else mart(name, jds, norm, enriched, as_of, days) for name in MART_TABLES}


def explore(df: DataFrame) -> dict[str, DataFrame]:
    """K5: the exploratory report's tables."""
    return {
        "count_non_null": quality.count_non_null(df, ["major_category", "middle_category", "sub_category"], "job_id"),
        "ranked_major": quality.ranked_counts(df, "major_category"),
        "ranked_middle": quality.ranked_counts(df, "middle_category"),
        "groups_per_middle": quality.groups_per_middle(df),
        "count_by_sido": quality.count_by_sido(df),
        "count_by_gugun": quality.count_by_gugun(df),
        "duplicate_rows": quality.duplicate_rows(df, ["job_id"]),
        "duplicate_rows_pair": quality.duplicate_rows(df, ["job_id", "company"]),
        "duplicate_summary": quality.duplicate_summary(df),
        "profile": quality.profile(df),
    }


def rebuild(spark: SparkSession, registry: dict[str, Callable[[dict[str, DataFrame]], DataFrame]],
            names: list[str], base_path: str | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Rebuild each table in order, as ``CREATE TABLE AS``.

    ``registry[name](done)`` builds a table from the tables already rebuilt
    (``done``), so a later table reads its written parent, not its lineage.
    With ``base_path`` tables are written as files there; otherwise each is
    built beside its old version in the catalog and then replaces it, so a
    reader never meets a missing table (:func:`..sources.catalog.replace_table`).
    """
    done: dict[str, DataFrame] = {}
    for name in names:
        df = registry[name](done)
        if base_path:
            path = f"{base_path.rstrip('/')}/{name}"
            df.write.mode("overwrite").format(fmt).save(path)
            done[name] = spark.read.format(fmt).load(path)
        else:
            done[name] = replace_table(df, name, fmt)
    return done


NORMALIZED_TABLES = ["daily_jd_table", "company_detail", "jd_skills"] + [t for t, _, _ in term_table_specs()]
MART_TABLES = ["unique_jds", "unique_category_count_major", "unique_category_count_major_middle",
               "unique_category_count_sub", "unique_daily_job_posting_count",
               "unique_upcoming_deadline_jobs_7days", "unique_company_coordinates", "unique_jd_skills",
               "unique_preferred_english", "unique_required_english", "unique_primary_responsibility_english",
               "unique_welfare_english", "unique_welfare_korean"]


def run_batch(spark: SparkSession, frames: list[DataFrame], out_base: str, taxonomy: DataFrame,
              addresses: DataFrame, lexicon: DataFrame, as_of, pattern: str = terms.KOREAN_PATTERN,
              addresses_fixed: bool = False) -> dict[str, DataFrame]:
    """The daily batch end to end, each layer written before the next reads it:

    K1 -> ``cleaned`` (partitioned by day) -> K2 -> ``enriched`` -> K3
    normalised tables -> K4 marts (base ``unique_jds`` first, then the rest).

    Written tables in ``out_base`` (a shared folder on a cluster) cut the
    lineage, so a lost executor recomputes at most one layer, and every mart
    reads its parent once instead of re-running the pipeline.
    """
    from ..sources.sinks import write_partitioned

    base = out_base.rstrip("/")
    write_partitioned(first_stage(frames, taxonomy, addresses, addresses_fixed), f"{base}/cleaned")
    cleaned = spark.read.parquet(f"{base}/cleaned")
    write_partitioned(second_stage(cleaned, lexicon, pattern), f"{base}/enriched")
    enriched = spark.read.parquet(f"{base}/enriched")

    norm_plans = normalize_layer(cleaned, lexicon, pattern)
    norm = rebuild(spark, {n: (lambda done, n=n: norm_plans[n]) for n in NORMALIZED_TABLES},
                   NORMALIZED_TABLES, base_path=f"{base}/normalized")

    def from_written(name: str):
        if name == "unique_jds":
            return lambda done: marts.unique_postings(norm["daily_jd_table"])
        return lambda done: mart(name, done["unique_jds"], norm, enriched, as_of)  # reads the written base mart

    marts_done = rebuild(spark, {n: from_written(n) for n in MART_TABLES}, MART_TABLES, base_path=f"{base}/marts")
    return {"cleaned": cleaned, "enriched": enriched, **norm, **marts_done}


def mart(name: str, jds: DataFrame, norm: dict[str, DataFrame], enriched: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The one definition of every mart beside the base mart ``jds``."""
    if name == "unique_daily_job_posting_count":
        return marts.daily_counts(norm["daily_jd_table"])
    if name == "unique_upcoming_deadline_jobs_7days":
        return marts.upcoming_deadlines(enriched, as_of, days)
    if name == "unique_category_count_major":
        return marts.count_by(jds, ["major_category"])
    if name == "unique_category_count_major_middle":
        return marts.count_by(jds, ["major_category", "middle_category"])
    if name == "unique_category_count_sub":
        return marts.sub_category_list(jds)
    if name == "unique_company_coordinates":
        return marts.company_coordinates(jds, norm["company_detail"])
    if name == "unique_jd_skills":
        return marts.posting_terms(jds, norm["jd_skills"], "unnested_skill", "skill", with_sub=False)
    aliases = {"unique_preferred_english": ("preferred", "preferred"),
               "unique_required_english": ("required", "required"),
               "unique_primary_responsibility_english": ("primary_responsibility", "primary_responsibility"),
               "unique_welfare_english": ("welfare", None), "unique_welfare_korean": ("welfare", None)}
    col, alias = aliases[name]
    kind = "korean" if name.endswith("_korean") else "english"
    unnested = f"unnested_{col}_{kind}_nouns"
    return marts.posting_terms(jds, norm[f"jd_{col}_{kind}_nouns"], unnested, alias or unnested)
