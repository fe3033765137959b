"""Classification, splits and unions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PLATFORMS, remove_spaces
from ..schemas import DAY_PARTS, POSTING_SCHEMA
from ._util import drop_if_present
from .normalize import align

CATEGORY_COLUMNS = ["major_category", "middle_category", "sub_category"]


def map_categories(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Left join postings to the taxonomy on category = sub_category.

    The taxonomy is a fixed literal table (88 rows), so it is broadcast: the
    posting side is never shuffled. Unmapped categories keep NULL
    major/middle/sub. Sub-categories are unique, so rows never fan out.
    """
    base = drop_if_present(df, CATEGORY_COLUMNS)
    tax = F.broadcast(taxonomy.select(*CATEGORY_COLUMNS))
    return base.join(tax, base["category"] == tax["sub_category"], "left")


def classify_loose(df: DataFrame, loose: DataFrame) -> DataFrame:
    """C11: the exploratory classifier: look the category up with all spaces
    removed; unknown names give NULL instead of raising."""
    base = drop_if_present(df, ["major_category", "middle_category"])
    dim = F.broadcast(loose.select("category_key", "major_category", "middle_category"))
    keyed = base.withColumn("_key", remove_spaces("category"))
    return keyed.join(dim, keyed["_key"] == dim["category_key"], "left").drop("_key", "category_key")


def split_platform(df: DataFrame, platforms: list[str]) -> DataFrame:
    """Rows of the listed platforms (the reference's OR-ed equalities)."""
    return df.where(F.col("platform").isin(platforms))


def by_major(df: DataFrame, major: str) -> DataFrame:
    """B5."""
    return df.where(F.col("major_category") == major)


def union_sources(frames: list[DataFrame], schema=POSTING_SCHEMA, extra: list[str] | None = None) -> DataFrame:
    """G1 after B3: align every site frame to one schema, then UNION ALL by
    name. Ids of integer sites become strings, so the union is type-safe."""
    extra = DAY_PARTS if extra is None else extra
    aligned = [align(f, schema, extra) for f in frames]
    out = aligned[0]
    for f in aligned[1:]:
        out = out.unionByName(f)
    return out


def union_loose(frames: list[DataFrame]) -> DataFrame:
    """Append frames by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def enrich_subset(df: DataFrame, pred: Column, enrich: Callable[[DataFrame], dict[str, Column]],
                  keep: Column | None = None) -> DataFrame:
    """The reference splits the input by a predicate, enriches one half
    and unions the halves back. Same rows in one pass: keep only the rows the
    two halves covered, then rewrite the enriched columns under ``pred``.

    ``enrich(df)`` returns {column: new value} evaluated on the same frame.
    """
    scoped = df.where(keep) if keep is not None else df
    new_cols = enrich(scoped)
    return scoped.withColumns({c: F.when(pred, v).otherwise(F.col(c)) for c, v in new_cols.items()})


def known_platforms() -> Column:
    return F.col("platform").isin(PLATFORMS)
