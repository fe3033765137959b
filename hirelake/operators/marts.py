"""Normalised tables and marts.

All are relational: DISTINCT becomes a partial + final hash aggregate (the
map side collapses repeats before the shuffle), joins are equi-joins that
Catalyst plans (sort-merge with AQE skew splitting, or broadcast when AQE
sees a small side at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_str, within_days
from ..schemas import UNIQUE_JD_COLUMNS
from ._util import lookup_join
from .packed import distinct_terms, packed, packed_lists, unpacked

JOIN_KEYS = ["platform", "job_id"]


def daily_postings(df: DataFrame) -> DataFrame:
    """daily_jd_table = DISTINCT day parts, date_str and identity."""
    return df.select(
        "year", "month", "day",
        date_str("year", "month", "day").alias("date_str"),
        "platform", "job_id", "company", "title",
        "major_category", "middle_category", "sub_category",
    ).distinct()


def unique_postings(daily: DataFrame) -> DataFrame:
    """unique_jds = DISTINCT posting identity (days removed; one row per
    distinct title/company/category of a posting)."""
    return daily.select(*UNIQUE_JD_COLUMNS).distinct()


def sub_category_list(jds: DataFrame) -> DataFrame:
    """sub_category of every unique posting, duplicates kept."""
    return jds.select("sub_category")


def count_by(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """COUNT(*) per key (NULL keys form their own group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def daily_counts(daily: DataFrame) -> DataFrame:
    """Rows of the daily table per date_str, key cast to DATE."""
    return (daily.groupBy("date_str").agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("date_str").try_cast("date").alias("date_str"), "count"))


def distinct_postings(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """COUNT(DISTINCT job_id) per key (platform ignored)."""
    return df.groupBy(*keys).agg(F.count_distinct("job_id").alias(name))


def upcoming_deadlines(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Postings whose deadline is within [as_of, as_of + days], DISTINCT.
    Deadlines that are not dates drop out like NULLs (try_cast)."""
    return df.where(within_days("end_at", as_of, days)).select(
        "company", "title", "url", "end_at", "primary_responsibility",
        "company_description", "major_category", "middle_category",
    ).distinct()


def unnest_distinct(df: DataFrame, col: str, out: str) -> DataFrame:
    """DISTINCT (job_id, platform, element); NULL or empty arrays give
    no rows, NULL elements are kept (UNNEST semantics)."""
    # array_distinct first: repeats inside one row vanish map-side, in codegen
    keys, lists = ["job_id", "platform"], F.array_distinct(col)
    if dict(df.dtypes)[col] != "array<string>":
        return df.select(*keys, F.explode(lists).alias(out)).distinct()
    return distinct_terms(packed_lists(df, keys, lists), keys, out)


def posting_terms(jds: DataFrame, terms: DataFrame, term_col: str, alias: str,
                  with_sub: bool = True) -> DataFrame:
    """C2-C7 (+B12): unique postings x term table on (platform, job_id), no
    DISTINCT: a posting listed under several categories repeats its terms.
    Terms (strings) go to the join several a row. NULL keys, which match nothing,
    are left out on the terms' side only: no filter reaches the DISTINCT of the
    postings, so all marts of a layer read one shuffle of it."""
    cats = ["major_category", "middle_category"] + (["sub_category"] if with_sub else [])
    u = jds.select(*cats, *JOIN_KEYS)
    t = packed(terms.dropna(subset=JOIN_KEYS), JOIN_KEYS, term_col)
    return unpacked(lookup_join(u, t, JOIN_KEYS, "inner", null_safe=True), [*cats, *JOIN_KEYS], alias)


def company_coordinates(jds: DataFrame, detail: DataFrame) -> DataFrame:
    """DISTINCT (major, middle, sub, company, lat, lon) of postings joined
    to company detail on company name, coordinates non-NULL.

    Both sides are reduced to their distinct join-relevant rows first
    (same result after the outer DISTINCT): the description column and the
    repeats of a company never reach the join, which bounds the fan-out of
    a company with many postings and many detail rows.
    """
    u = jds.select("major_category", "middle_category", "sub_category", "company") \
        .where(F.col("company").isNotNull()).distinct()
    c = detail.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
        .select("company", "lat", "lon").distinct()
    return u.join(c, "company", "inner").select(
        "major_category", "middle_category", "sub_category", "company", "lat", "lon").distinct()
