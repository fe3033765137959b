"""Approximate nearest neighbours by inner product: stable projections in a
kd-tree, searched until a chi-square test holds.

Vectors are dealt into blocks by a hash of their id, queries likewise; each
pair of a vector block and a query block is one group of bounded size, so the
whole query set meets all rows without a hot group and without a broadcast.

In a block, inner product becomes distance: with M the largest norm, a vector
x is (x, sqrt(M^2 - |x|^2)) and a query q is (M q / |q|, 0). These are
projected to ``PROJECTED`` dimensions by a Gaussian (2-stable) matrix and put
into a kd-tree. The squared ratio of projected to true distance is chi-square
distributed, so a vector for which P(chi2 <= (its projected distance / true
distance of the k-th best)^2) reaches ``CONFIDENCE`` is that unlikely to be
better. A query visits the leaves by the projected distance of their boxes, in
rounds that double, verifies those vectors of a round that the test of their
own projected distance leaves, on the original components, and stops where the
test holds for the next box. The bound only falls, so a vector put aside once
stays so. The best of all blocks are merged per query.

Vectors are compared in double precision and with those of their own length
only. Defined cases: null ids, null or zero vectors and those with null or
non-finite components take no part; equal scores go by the smaller id; rows
that repeat the query's id are its own; fewer than k candidates: all of them;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

K = 20
PROJECTED = 16
LEAF = 32
CONFIDENCE = 0.95
#: Leaves of a query's first round.
FIRST_LEAVES = 4
#: Rows of a block, on average (8,192 vectors of 64 doubles are 4 MB). Every query brings k rows back from each
#: block, and every vector is sent once for each block of queries, so small blocks of either cost rows.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 8192
QUERY_EVERY = 20
SCHEMA = "query_id bigint, vec_id bigint, score double"


def chi2_below(x: np.ndarray, m: int) -> np.ndarray:
    """P(chi-square with an even number m of degrees of freedom <= x)."""
    half = np.minimum(x / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi2_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(np.array(mid), m) < p else (low, mid)
    return high


class Tree:
    """Leaves of a kd-tree: rows in leaf order, where leaves begin, boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        parts = [np.arange(len(points))]
        while len(parts[0]) > leaf:  # equal halves by rank, so all parts of a level shrink alike, equal points too
            halves = []
            for rows in parts:
                own = points[rows]
                rows = rows[np.argsort(own[:, np.argmax(own.max(0) - own.min(0))], kind="stable")]
                halves += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
            parts = sorted(halves, key=len, reverse=True)
        parts = [p for p in parts if len(p)]
        self.order = np.concatenate(parts)
        self.begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        self.low = np.stack([points[p].min(0) for p in parts])
        self.high = np.stack([points[p].max(0) for p in parts])

    def leaf_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance of a point to every leaf's box."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (gap * gap).sum(1)


class Block:
    """The vectors of one block, indexed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 5):
        norms = (vectors * vectors).sum(1)
        self.size = float(np.sqrt(norms.max()))
        scaled = vectors / self.size
        extra = np.sqrt(np.maximum(1 - (scaled * scaled).sum(1), 0))
        self.matrix = np.random.default_rng(seed).normal(size=(vectors.shape[1] + 1, PROJECTED))
        points = np.column_stack([scaled, extra]) @ self.matrix
        self.tree = Tree(points)
        self.ids, self.vectors = ids[self.tree.order], np.ascontiguousarray(vectors[self.tree.order])
        self.points = np.ascontiguousarray(points[self.tree.order])
        self.stop = chi2_quantile(CONFIDENCE, PROJECTED)
        self.verified = 0

    def search(self, own: int, q: np.ndarray, k: int = K) -> list[tuple[int, float]]:
        """(id, score) of the k best found, best first; ``own`` is left out.
        ``verified`` counts the vectors compared on original components."""
        norm = float(np.sqrt((q * q).sum()))
        at_q = np.append(q / norm, 0.0) @ self.matrix
        near = self.tree.leaf_distances(at_q)
        leaves = np.argsort(near, kind="stable")
        slack = 1e-9 * norm * self.size  # equal vectors must not be told apart by rounding
        begin, take, at = self.tree.begin, FIRST_LEAVES, 0
        rows, scores, kth, bound = np.empty(0, int), np.empty(0), -np.inf, np.inf
        while at < len(leaves) and near[leaves[at]] < bound:
            r = np.concatenate([np.arange(begin[x], begin[x + 1]) for x in leaves[at:at + take]])
            at, take = at + take, 2 * take
            gap = self.points[r] - at_q
            r = r[((gap * gap).sum(1) < bound) & (self.ids[r] != own)]
            self.verified += len(r)
            s = self.vectors[r] @ q
            keep = s >= kth - slack
            rows, scores = np.concatenate([rows, r[keep]]), np.concatenate([scores, s[keep]])
            if len(rows) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= kth - slack
                rows, scores = rows[keep], scores[keep]
                # the squared true distance of the k-th best, of vectors of size 1; rounding must not make it zero
                bound = self.stop * max(2 - 2 * kth / (norm * self.size), 1e-12)
        r = rows
        exact = (self.vectors[r] * q).sum(1)
        best = np.lexsort((self.ids[r], -exact))[:k]
        return [(int(self.ids[r[i]]), float(exact[i])) for i in best]


def _matrix(t: pa.Table, column: str) -> np.ndarray:
    values = t.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(np.float64)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(fine & F.exists(v, lambda x: x != 0))
            .select(F.col(key).cast("long").alias("id"), v.alias("v")))


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row where
    ``queries`` (a condition on ``id``) holds, among all other rows."""
    rows = materialize(usable(df, key, vector), "ann-vectors")
    n, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(queries, 1))).first()
    blocks, sheets = max(1, ceil(n / VECTOR_BLOCK)), max(1, ceil(asked / QUERY_BLOCK))
    size = F.size("v").alias("size")
    vectors = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), size, "id", "v",
                          F.explode(F.sequence(F.lit(0), F.lit(sheets - 1))).alias("sheet"))
    asks = rows.where(queries).select(F.pmod(F.xxhash64(F.lit("q"), "id"), F.lit(sheets)).cast("int").alias("sheet"), size, "id", "v",
                                      F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    keys = ("block", "sheet", "size")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            block = Block(left.column("id").to_numpy(), _matrix(left, "v"))
            for own, q in zip(right.column("id").to_pylist(), _matrix(right, "v")):
                found += [(own, i, s) for i, s in block.search(own, q, k)]
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()),
                         "vec_id": pa.array([f[1] for f in found], pa.int64()),
                         "score": pa.array([f[2] for f in found], pa.float64())})

    found = vectors.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(run, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_EVERY == 0)
