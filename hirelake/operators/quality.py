"""Duplicate reports, profiles, exploratory counts, sorts.

Skew rule: one key may hold a third of all rows. So nothing here uses a
window partitioned by a data key (that would put the hot key in one task).
Counts per key are partial aggregates (collapsed map-side), and rows are
matched back to repeated keys by a semi join that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import int_div
from ..functions.geo import gugun, sido
from ._util import lookup_join


def semi_on(df: DataFrame, keys: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (replaces collecting the
    key set to the driver and filtering with IN). NULL keys match nothing,
    unless ``null_safe``."""
    k = keys.select(*on).distinct()
    return lookup_join(df, k, on, "left_semi", null_safe)


def count_non_null(df: DataFrame, keys: list[str], col: str = "job_id") -> DataFrame:
    """COUNT(col) per key (NULL keys kept, NULL values not counted)."""
    return df.groupBy(*keys).agg(F.count(col).alias(f"{col}_count"))


def ranked_counts(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per key, largest first; NULL key dropped as pandas'
    group-by does."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(key)))


def groups_per_middle(df: DataFrame) -> DataFrame:
    """Number of (major, middle, sub) groups per middle category: the
    chart that groups an already grouped frame. NULL middle dropped."""
    groups = count_non_null(df, ["major_category", "middle_category", "sub_category"], "job_id")
    return ranked_counts(groups, "middle_category", "job_id_count")


def count_by_sido(df: DataFrame, col: str = "location") -> DataFrame:
    """Postings per province (NULL province dropped)."""
    return (df.select(sido(col).alias("sido_location")).where(F.col("sido_location").isNotNull())
            .groupBy("sido_location").agg(F.count(F.lit(1)).alias("count")))


def count_by_gugun(df: DataFrame, col: str = "location") -> DataFrame:
    """Postings per district (NULL district dropped)."""
    return (df.select(gugun(col).alias("gugun_location")).where(F.col("gugun_location").isNotNull())
            .groupBy("gugun_location").agg(F.count(F.lit(1)).alias("count")))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (HAVING)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key tuple occurs more than once (all copies
    kept, NULL keys equal to each other, like pandas ``duplicated(keep=False)``)."""
    rk = repeated_keys(df, keys).select(*keys)
    return lookup_join(df, rk, keys, "left_semi", null_safe=True)


def duplicate_summary(df: DataFrame, key: list[str] | None = None, pair: list[str] | None = None) -> DataFrame:
    """One row with total rows, rows with a repeated key and with a
    repeated pair, the reference's ``len // 2`` figures, whether the two keys
    agree, and the exact number of removable copies.

    ``key`` must be a subset of ``pair``: counts per pair are rolled up to
    the key, so both reports come from one aggregation lineage.
    """
    key = key or ["job_id"]
    pair = pair or ["job_id", "company"]
    if not set(key) <= set(pair):
        raise ValueError("key must be a subset of pair")
    per_pair = df.groupBy(*pair).agg(F.count(F.lit(1)).alias("c2"))
    per_key = per_pair.groupBy(*key).agg(
        F.sum("c2").alias("c1"),
        F.sum(F.when(F.col("c2") > 1, F.col("c2")).otherwise(0)).alias("d2"),
        F.sum(F.when(F.col("c2") > 1, 1).otherwise(0)).alias("k2"),
    )
    s = per_key.agg(
        F.coalesce(F.sum("c1"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("c1") > 1, F.col("c1")).otherwise(0)), F.lit(0)).cast("bigint").alias("dup_rows"),
        F.coalesce(F.sum(F.when(F.col("c1") > 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("dup_keys"),
        F.coalesce(F.sum("d2"), F.lit(0)).cast("bigint").alias("dup_pair_rows"),
        F.coalesce(F.sum("k2"), F.lit(0)).cast("bigint").alias("dup_pairs"),
    )
    half = int_div("dup_rows", F.lit(2))  # the reference's len // 2
    return s.select(
        "total_rows", "dup_rows", "dup_pair_rows",
        half.alias("dup_count_half"),
        (F.col("total_rows") - half).alias("net_postings_half"),
        (F.col("dup_rows") == F.col("dup_pair_rows")).alias("keys_agree"),
        (F.col("dup_rows") - F.col("dup_keys")).alias("removable_rows"),
        (F.col("total_rows") - F.col("dup_rows") + F.col("dup_keys")).alias("net_postings"),
    )


def distinct_dates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """D18 + F1: DISTINCT day parts, sorted ascending."""
    cols = cols or ["year", "month", "day"]
    return df.select(*cols).distinct().orderBy(*cols)


def dedupe_first(df: DataFrame, keys: list[str], order: list[str], row_id: str | None = None) -> DataFrame:
    """Keep the first row per key under an explicit order.

    Where the order is a column that no two rows share (``row_id``), the
    smallest id per key is chosen first, by a hash aggregation over a hash of
    the keys, and the rows are then fetched by id with a semi join: no text is
    sorted or aggregated. Otherwise whole rows are compared. An aggregate (``min_by``) instead of ``row_number() over (partition by
    key)``: it is combined map-side, so a key holding a third of all rows is
    reduced in every task before the shuffle instead of sorted in one task.
    Remaining columns break ties, so the pick is deterministic. The group key
    is the 256-bit hash of the keys, not the keys: long texts are neither
    sorted nor compared.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    orderable = [c for c in rest if not isinstance(df.schema[c].dataType, T.MapType)]
    rank = F.struct(*[F.col(c) for c in order + orderable])
    # A NULL key is a key of its own: JSON writes it as null.
    key = F.unhex(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256))
    if row_id is not None:
        if list(order) != [row_id]:
            raise ValueError("the order must be the row id")
        first = df.groupBy(key.alias("_key")).agg(F.min(row_id).alias(row_id)).select(row_id)
        return lookup_join(df, first, [row_id], "left_semi", null_safe=True)
    picked = df.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*df.columns), rank).alias("_row"))
    return picked.select("_row.*")


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
#: Buckets of a round of the selection, and rounds after the first: 4 x 14 bits are more than a double's 52.
BUCKETS, ROUNDS = 1 << 14, 4


def exact_quantiles(df: DataFrame, cols: list[str], probs: tuple[float, ...]) -> DataFrame:
    """column, quantiles: exact quantiles of numeric columns (as doubles),
    interpolated between the two nearest values as SQL's PERCENTILE_CONT does;
    NULLs are left out, a column without values has no row.

    Distributed selection by repeated bucket counting: the first round counts
    values by sign and exponent, the others split the one bucket that holds a
    wanted rank into ``BUCKETS`` equal ranges. Each round reads the columns
    once and aggregates map-side; what meets are a few ranks and their bucket
    counts, never values. Bucket functions are monotone, so ranks are exact."""
    one = lambda c: F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
    values = df.select(F.explode(F.array(*[one(c) for c in cols])).alias("x")).select("x.*").where("v IS NOT NULL")
    sizes = values.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    want = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    ranks = (sizes.select("column", "n", want.alias("w")).withColumn("at", (F.col("n") - 1) * F.col("w.p"))
             .select("column", F.col("w.i").alias("i"), (F.col("at") - F.floor("at")).alias("part"),
                     F.explode(F.array(F.floor("at"), F.least(F.floor("at") + 1, F.col("n") - 1))).alias("k")).distinct())
    state = ranks.select("column", "k", F.col("k").alias("left"), F.lit(None).cast("double").alias("lo"),
                         F.lit(None).cast("double").alias("hi")).distinct()
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    exponent = (F.when(F.isnan(v), 9999).when(v == float("inf"), 9998).when(v == float("-inf"), -9998).when(v == 0, 0)
                .when(v > 0, 1100 + F.floor(F.log2(v))).otherwise(-1100 - F.floor(F.log2(-v))).cast("int"))
    split = F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0).cast("int")
    for turn in range(ROUNDS + 1):
        # A few rows for each column: the ranks wanted of it.
        met = values.join(F.broadcast(state), "column")
        met = met if turn == 0 else met.where((v >= lo) & (v <= hi))
        counts = (met.groupBy("column", "k", "left", (split if turn else exponent).alias("bucket"))
                  .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")))
        lists = counts.groupBy("column", "k", "left").agg(F.array_sort(F.collect_list(F.struct("bucket", "c", "lo", "hi"))).alias("b"))
        none = F.lit(None).cast("double")
        zero = F.struct(F.col("left").alias("left"), F.lit(False).alias("done"), none.alias("lo"), none.alias("hi"))
        found = F.aggregate("b", zero, lambda s, x: F.when(s["done"], s).when(
            s["left"] < x["c"], F.struct(s["left"].alias("left"), F.lit(True).alias("done"), x["lo"].alias("lo"), x["hi"].alias("hi")))
            .otherwise(F.struct((s["left"] - x["c"]).alias("left"), F.lit(False).alias("done"), s["lo"].alias("lo"), s["hi"].alias("hi"))))
        state = lists.select("column", "k", found.alias("f")).select("column", "k", "f.left", "f.lo", "f.hi")
    ends = ranks.join(state.select("column", "k", "lo"), ["column", "k"]).groupBy("column", "i").agg(
        F.min("lo").alias("a"), F.max("lo").alias("b"), F.max("part").alias("part"))
    value = F.col("a") + F.when(F.col("a") == F.col("b"), 0.0).otherwise((F.col("b") - F.col("a")) * F.col("part"))
    return ends.groupBy("column").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("q")))), lambda x: x["q"]).alias("quantiles"))


def profile(df: DataFrame, cols: list[str] | None = None, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column with count, NULL count, min, max, mean, stddev
    and exact quartiles. Non-numeric columns get count, NULL count, min and
    max. All but the quartiles come from one aggregation pass."""
    cols = cols or df.columns
    aggs, names = [], []
    numbers = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]
    for c in cols:
        dt = df.schema[c].dataType
        is_num = c in numbers
        orderable = isinstance(dt, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)) or is_num
        col = F.col(c)
        parts = {
            "count": F.count(col).cast("bigint"),
            "nulls": F.count(F.when(col.isNull(), 1)).cast("bigint"),
            "min": F.min(col).cast("string") if orderable else F.lit(None).cast("string"),
            "max": F.max(col).cast("string") if orderable else F.lit(None).cast("string"),
            "mean": F.avg(col) if is_num else F.lit(None).cast("double"),
            "stddev": F.stddev_samp(col) if is_num else F.lit(None).cast("double"),
        }
        aggs.append(F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in parts.items()]).alias(c))
        names.append(c)
    wide = df.agg(*aggs).select(F.explode(F.array(*[F.col(n) for n in names])).alias("p")).select("p.*")
    if not numbers:
        return wide.withColumn("quartiles", F.lit(None).cast("array<double>"))
    found = exact_quantiles(df, numbers, quantiles).withColumnRenamed("quantiles", "quartiles")
    return wide.join(found, "column", "left")


def sort_by(df: DataFrame, cols: list[str], descending: bool = False, as_string: bool = False) -> DataFrame:
    """total order on ``cols`` (cast to string for F2's string
    order); the other columns break ties, which also lets range partitioning
    split a hot sort value across tasks."""
    key = [F.col(c).cast("string") if as_string else F.col(c) for c in cols]
    key = [k.desc() if descending else k.asc() for k in key]
    rest = [F.col(c).asc() for c in df.columns if c not in cols
            and not isinstance(df.schema[c].dataType, T.MapType)]
    return df.orderBy(*key, *rest)


def preview(df: DataFrame, n: int, cols: list[str], descending: bool = False) -> DataFrame:
    """the first n rows after a total order (TakeOrderedAndProject:
    top-n per task, then merged)."""
    return sort_by(df, cols, descending).limit(n)
