"""Sharding: Karmarkar-Karp differencing over indivisible groups.

Rows of one text are a group that no cut divides. Differencing starts with a
partial partition for every item (all of it in one part, the others empty) and
repeatedly combines the two of largest spread, the heaviest part of one with
the lightest of the other, until one is left; its parts are the shards.

Differencing is sequential, so it is done over a number of items that the
table's size does not raise. A group over 1/``FINE`` of a shard is an item of
its own (there cannot be more than ``FINE`` x shards of them). All other groups
are dealt by hash to chunks, and a chunk is an item: ``GRADES`` grades of
``CHUNKS`` chunks each, each grade holding a quarter of the one before. So a
small table is differenced nearly group by group, and a large one has chunks
from the coarse to the very fine, with which the gaps are closed at the end.

One aggregation of (text hash, bytes) finds the groups; the plan of items (at
most ``GRADES * CHUNKS + FINE * shards`` rows, whatever the input) is broadcast
to the rows, so texts are never shuffled and a hot group meets no single task.
Slots number the rows of a shard without gaps: rows are counted per block of
the written table, the counts are summed up, and each block numbers its own.

Defined cases: a null text has the bytes of an empty one, and both are one
group; null and repeated keys are rows like others; rows with equal columns
have a slot each; an empty table gives no rows; a group heavier than a fair
share makes its shard heavier than the others; further columns pass through,
``size``, ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

SHARDS = 24
#: Bytes of a row besides its text.
ROW_BYTES = 8
#: A group over this part of a fair shard is an item of its own.
FINE = 64
GRADES, CHUNKS = 8, 2048
#: Rows of a written file that are numbered together.
BLOCK = 1 << 16


def difference(sizes: list[int], parts: int) -> list[int]:
    """The part of every item, by repeated differencing of the two partial
    partitions with the largest spread (max - min); ties by age."""
    if not sizes:
        return []
    sums: list[list[int] | None] = [[s] + [0] * (parts - 1) for s in sizes]  # heaviest part first
    made: list[tuple[int, int, list[int]] | None] = [None] * len(sizes)
    heap = [(-(s if parts > 1 else 0), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, x), (_, y) = heapq.heappop(heap), heapq.heappop(heap)
        joined = [a + b for a, b in zip(sums[x], reversed(sums[y]))]
        order = sorted(range(parts), key=lambda j: -joined[j])
        heapq.heappush(heap, (joined[order[-1]] - joined[order[0]], len(sums)))
        sums[x] = sums[y] = None
        sums.append([joined[j] for j in order])
        made.append((x, y, order))
    out = [0] * len(sizes)
    todo = [(heap[0][1], list(range(parts)))]
    while todo:
        node, names = todo.pop()
        if made[node] is None:
            out[node] = names[0]
            continue
        x, y, order = made[node]
        left, right = [0] * parts, [0] * parts
        for place, j in enumerate(order):
            left[j] = right[parts - 1 - j] = names[place]
        todo += [(x, left), (y, right)]
    return out


def _hashes(text: str) -> tuple[Column, Column]:
    own = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(own), F.xxhash64(F.lit("group"), own)


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _chunk(h1: Column, h2: Column) -> Column:
    """Grade g (of 0, 1, ...) has 3/4 of what the grades before it left; the last has the rest."""
    at = F.pmod(h2, F.lit(4 ** (GRADES - 1)))
    grade = sum(((at < 4 ** i).cast("int") for i in range(GRADES - 1)), F.lit(0))
    return grade * CHUNKS + F.pmod(h1, F.lit(CHUNKS)).cast("int")


def items(df: DataFrame, text: str, shards: int) -> DataFrame:
    """h1, h2, chunk, size of the items: of a heavy group its hashes, of the
    others their chunk."""
    h1, h2 = _hashes(text)
    groups = materialize(df.select(h1.alias("h1"), h2.alias("h2"), _size(text).alias("size"))
                         .groupBy("h1", "h2").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("size") * FINE * shards > F.lit(total)
    return (groups.select(*[F.when(heavy, F.col(h)).alias(h) for h in ("h1", "h2")],
                          F.when(~heavy, _chunk(F.col("h1"), F.col("h2"))).alias("chunk"), "size")
            .groupBy("h1", "h2", "chunk").agg(F.sum("size").alias("size")))


def plan(df: DataFrame, text: str = "text", shards: int = SHARDS) -> DataFrame:
    """h1, h2, chunk, shard of the items; made in one task, from a number of
    items that the constants bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (-r[3], r[2] is None, r[2] or 0, r[0] or 0, r[1] or 0))
        own = difference([r[3] for r in rows], shards)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int32()), pa.array(own, pa.int32())], names=["h1", "h2", "chunk", "shard"])

    return materialize(items(df, text, shards).repartition(1)
                       .mapInArrow(run, "h1 bigint, h2 bigint, chunk int, shard int"), "shard-plan")


def place(df: DataFrame, text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``df`` with the columns size and shard; no row moves."""
    of = plan(df, text, shards)
    heavy = of.where("chunk IS NULL").select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("shard").alias("__heavy"))
    light = of.where("chunk IS NOT NULL").select(F.col("chunk").alias("__chunk"), F.col("shard").alias("__light"))
    columns = [c for c in df.columns if c not in ("size", "shard")]
    h1, h2 = _hashes(text)
    return (df.select(*columns, _size(text).alias("size"), h1.alias("__a"), h2.alias("__b"))
            .withColumn("__c", _chunk(F.col("__a"), F.col("__b")))
            .join(F.broadcast(heavy), (F.col("__a") == F.col("__h1")) & (F.col("__b") == F.col("__h2")), "left")
            .join(F.broadcast(light), F.col("__c") == F.col("__chunk"), "left")
            .select(*columns, "size", F.coalesce("__heavy", "__light").alias("shard")))


def number(placed: DataFrame) -> DataFrame:
    """Placed rows with slot: their number in their shard, from 0. The rows
    are written first, so that a place in a file names each for good."""
    columns = [c for c in placed.columns if c != "slot"]
    rows = materialize(placed.select(*columns), "shard-rows").select(
        *columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    rows = rows.withColumn("__block", F.expr(f"__row div {BLOCK}"))
    place_ = ["shard", "__file", "__block"]
    before = Window.partitionBy("shard").orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy(*place_).agg(F.count(F.lit(1)).alias("n"))
             .select(*place_, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first")))
    own = F.row_number().over(Window.partitionBy(*place_).orderBy("__row")).cast("long") - 1
    return rows.withColumn("__own", own).join(first, place_).select(*columns, (F.col("__first") + F.col("__own")).alias("slot"))


def write_shards(df: DataFrame, path: str, text: str = "text", shards: int = SHARDS) -> None:
    """Whole rows as Parquet, a folder for each shard; a folder is written by
    as many tasks as its bytes need."""
    place(df, text, shards).hint("rebalance", "shard").write.partitionBy("shard").mode("overwrite").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by the law ``bytes``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = place(docs).select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "shard")
    return number(placed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                 F.lit(None).cast("int").alias("grown_shard"))
