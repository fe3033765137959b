"""Near duplicates: chosen-path set similarity join over word shingles.

A document's set holds its distinct shingles; equal sets are one class, known
by a hash of the set. Classes walk down ``TREES`` random trees: every node
selects one or (one time in four) two of the minwise tokens, and a class goes to
the child of its own token there. With a similarity of 0.8 that is 1 / 0.8
children on average, so a similar pair is expected to stay together in one of
them, while dissimilar ones part at once. A node with at most ``SMALL`` classes
is a leaf; a larger one branches on, ``DEPTH`` times at most.

Nodes are compared in three rounds, each on what the links found before have
not yet connected. First the classes of a node in ``FIRST`` of the trees are
held against one of them (its pivot: the one that meets the most classes over
all its nodes, as an original does whose copies were edited apart), then those
of a node in any tree against it and a second one. Only nodes that still hold several components are then compared
exhaustively, whatever their size: classes apart from their node's pivot against
all classes of the node outside their own component. So a large group of near
copies costs a few pairs per class and node, not all pairs.

Candidates pass a filter on 4-bit minhash sketches (a short one that travels
with the rows of a node, then the whole), wide enough (five and more than four
standard errors) not to lose links; the exhaustive comparison also holds odd
sketches of the sets against each other (the parity of the shingles in each of
``ODD`` slots: two sketches differ in no more slots than the sets do in
shingles, so below some thousand shingles this is nearly exact and loses
nothing). What passes is confirmed on full sets, made anew from whole texts: in the first rounds each class's closest candidate, in
the last all candidates. The texts of classes that share any node are written
once for all rounds. Joins are merge joins at every size, so that what is
shuffled follows the input. Links and components stay on the executors, and
become ids of documents only at the end.

Defined cases: null, empty or blank text: empty set, linked with nothing; fewer
words than a shingle: the whole sequence is one; null ids take no part (null
component, kept); rows that repeat an id are kept or dropped alike, and what is
linked with any of their texts is in one component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import give_back, materialize, table
from .graph import components

WORDS = 5
#: Similarity in hundredths.
SIMILARITY = 80
TREES, DEPTH, SMALL = 12, 3, 32
#: Trees of the first round.
FIRST = 3
#: Minwise tokens to choose from, and minhashes in the sketch (4 bits each).
TOKENS, SKETCH = 48, 128
#: Sketch estimate from which a pair is a candidate.
CANDIDATE = 0.63
#: Slots of the odd sketch.
ODD = 2048
_SEEDS = np.random.default_rng(17).integers(1, 1 << 32, (2, SKETCH), np.uint64).astype(np.uint32)
_SEEDS[0] |= np.uint32(1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text, A-Z lower-cased,
    cut at blanks, tabs, line feeds, vertical tabs, form feeds and returns."""
    from xxhash import xxh3_64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(found) < words:
        return np.array([xxh3_64_intdigest(b" ".join(found), 1)] if found else [], np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(h) - words + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words):
        mixed = (mixed ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minhashes(hashes: np.ndarray) -> np.ndarray:
    low = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    best = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 2048):
        part = low[start:start + 2048, None]
        best = np.minimum(best, ((part ^ _SEEDS[1]) * _SEEDS[0]).min(0))
    return best


def parities(hashes: np.ndarray) -> np.ndarray:
    """Odd sketch of a set of shingle hashes, as 64-bit numbers."""
    slots = (hashes >> np.uint64(65 - ODD.bit_length())).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=ODD) & 1).astype(np.uint8)).view("<i8")


def features(docs: DataFrame, words: int) -> DataFrame:
    """id, said (hash of the text), n, k0, k1 (128-bit hash of the set), tokens,
    sketch of documents (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()
    names = [f"s{i}" for i in range(SKETCH // 16)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            size, keys, tokens, sketches = [], [], [], []
            for text in batch.column(2):
                own = shingles(text.as_py(), words)
                best = minhashes(own)
                size.append(len(own))
                keys.append(np.frombuffer(xxh3_128_digest(own.tobytes()), "<i8"))
                tokens.append(best[:TOKENS].astype(np.int32))
                bits = (best ^ (best >> 16)) * np.uint32(0x85EBCA6B) >> np.uint32(28)
                packed = (bits[0::2] | bits[1::2] << np.uint32(4)).astype(np.uint8)
                sketches.append(packed.view("<i8"))
            keys_, sketches_ = np.array(keys).reshape(-1, 2), np.array(sketches).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), *[pa.array(keys_[:, i]) for i in (0, 1)],
                 pa.array(tokens, pa.list_(pa.int32())), *[pa.array(sketches_[:, i]) for i in range(len(names))]],
                names=["id", "said", "n", "k0", "k1", "tokens", *names])
        give_back()

    return docs.select("id", F.xxhash64("text").alias("said"), "text").mapInArrow(
        run, f"id {kind}, said bigint, n bigint, k0 bigint, k1 bigint, tokens array<int>, {', '.join(f'{s} bigint' for s in names)}")


def _agreement(left: str, right: str, longs: int) -> Column:
    """Estimated similarity from the first sketch columns with two prefixes."""
    def equal(i: int) -> Column:
        x = F.col(f"{left}s{i}").bitwiseXOR(F.col(f"{right}s{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        return F.lit(16) - F.bit_count(x)

    agree = reduce(Column.__add__, [equal(i) for i in range(longs)]) / F.lit(16 * longs)
    return (agree - 1 / 16) / (15 / 16)


def _estimate(left: str, right: str) -> Column:
    return _agreement(left, right, SKETCH // 16)


def _sized(reps: DataFrame, prefix: str, key: str) -> DataFrame:
    return reps.select(F.col("id").alias(key), F.col("n").alias(f"{prefix}n"),
                       *[F.col(f"s{i}").alias(f"{prefix}s{i}") for i in range(SKETCH // 16)])


def _may_link(similarity: int, left: str = "x", right: str = "y") -> Column:
    low, high = F.least(f"{left}n", f"{right}n"), F.greatest(f"{left}n", f"{right}n")
    return (low * 100 >= high * similarity) & (_estimate(left, right) >= CANDIDATE - (80 - similarity) / 100)


def odd_sketches(texts: DataFrame, words: int) -> DataFrame:
    """id, odd (odd sketch) of texts (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [parities(shingles(t.as_py(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], names=["id", "odd"])
        give_back()

    return texts.select("id", "text").mapInArrow(run, "id bigint, odd array<bigint>")


def _odd_may_link(similarity: int) -> Column:
    """Whether the odd sketches of x and y differ in no more slots than linked
    sets do: at most the shingles these may differ in, and at most what so many
    shingles are expected to leave odd and five standard errors (half the root
    of the slots, at most)."""
    differ = F.zip_with("xodd", "yodd", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    slots = F.aggregate(differ, F.lit(0), lambda total, n: total + n)
    apart = (F.col("xn") + F.col("yn")) * F.lit((100 - similarity) / (100 + similarity))
    odd = F.lit(ODD / 2) * (1 - F.exp(apart * F.lit(-2 / ODD))) + F.lit(2.5 * ODD ** 0.5)
    return slots <= F.least(apart, odd) + 1e-6


def _children(rows: DataFrame) -> DataFrame:
    """node, id, first of the children that members (node, id, tokens, first)
    go to."""
    pick = lambda n: F.pmod(F.xxhash64("node", F.lit(n)), F.lit(TOKENS)).cast("int")
    two = (F.pmod(F.xxhash64("node", F.lit(2)), F.lit(4)) == 0) & (pick(1) != pick(3))
    at = F.explode(F.when(two, F.array(pick(1), pick(3))).otherwise(F.array(pick(1)))).alias("at")
    return (rows.select("id", "first", "node", "tokens", at)
            .select(F.xxhash64("node", "at", F.element_at("tokens", F.col("at") + 1)).alias("node"), "id", "first"))


#: What of a class travels with it: its size and the first 32 minhashes of its sketch.
BRIEF = ["n", "s0", "s1"]


def _maybe(similarity: int, other: str) -> Column:
    """Whether a row's class may link with another whose brief columns have a
    prefix: five standard errors of 32 minhashes below the threshold."""
    low, high = F.least("n", f"{other}n"), F.greatest("n", f"{other}n")
    return (low * 100 >= high * similarity) & (_agreement("", other, 2) >= similarity / 100 - 0.38)


def tree_nodes(reps: DataFrame) -> DataFrame:
    """node, id, first (whether of the first trees), brief columns, met (how
    many classes it meets over all its nodes) of all classes that share a node
    to be compared: leaves, and those of the last depth."""
    trees = F.explode(F.array(*[F.lit(t).cast("long") for t in range(TREES)])).alias("node")
    rows = reps.select("id", "tokens", trees).withColumn("first", F.col("node") < FIRST)
    nodes = []
    for depth in range(DEPTH):
        rows = _children(rows)
        counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        live = materialize(rows.join(counts.hint("merge"), "node"), "path-nodes")
        large = F.col("members") > SMALL
        last = depth == DEPTH - 1
        nodes.append((live if last else live.where(~large)).select("node", "id", "first", "members"))
        if last or live.where(large).isEmpty():
            break
        rows = live.where(large).join(reps.select("id", "tokens").hint("merge"), "id").select("id", "first", "tokens", "node")
    rows = reduce(DataFrame.unionByName, nodes)
    met = rows.groupBy("id").agg(F.sum("members").alias("met"))
    brief = reps.select("id", *BRIEF).join(met.hint("merge"), "id").hint("merge")
    return materialize(rows.drop("members").join(brief, "id"), "path-members")


def _mixed(nodes: DataFrame, parts: DataFrame | None) -> DataFrame:
    """node, id, met, brief columns, c (component so far) of the nodes that
    hold several components; top_*, low_*: the same of two of the node's
    classes, the one that meets most (ties: largest id) and the smallest id."""
    rows = nodes.select("node", "id", "met", *BRIEF)
    if parts is None:
        rows = rows.withColumn("c", F.col("id"))
    else:
        known = parts.select("id", F.col("component").alias("c")).hint("merge")
        rows = rows.join(known, "id", "left").select("node", "id", "met", *BRIEF, F.coalesce("c", "id").alias("c"))
        rows = materialize(rows, "near-placed")
    own = ["id", "c", *BRIEF]
    ends = (rows.groupBy("node").agg(F.min("c").alias("__a"), F.max("c").alias("__b"),
                                     F.max(F.struct("met", *own)).alias("__top"), F.min(F.struct(*own)).alias("__low"))
            .where("__a <> __b").select("node", *[F.col(f"__{x}.{c}").alias(x + ("" if c == "id" else f"_{c}"))
                                                  for x in ("top", "low") for c in own]))
    return rows.join(ends.hint("merge"), "node")


def _found(pairs: DataFrame, reps: DataFrame, similarity: int) -> DataFrame:
    """a, b, likeness of the distinct pairs that pass the sketch filter."""
    return (pairs.distinct().join(_sized(reps, "x", "a").hint("merge"), "a").join(_sized(reps, "y", "b").hint("merge"), "b")
            .where(_may_link(similarity)).select("a", "b", _estimate("x", "y").alias("likeness")))


def confirm(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """a, b of the pairs that link on the full sets of their texts (id, text)."""
    side = lambda key, name: texts.select(F.col("id").alias(key), F.col("text").alias(name)).hint("merge")
    rows = pairs.select("a", "b").join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            last, x = None, None
            for p, q in zip(batch.column(2), batch.column(3)):
                if (t := p.as_py()) != last:
                    last, x = t, shingles(t, words)
                y = shingles(q.as_py(), words)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return materialize(rows.mapInArrow(run, "a bigint, b bigint"), "near-links")


def links(reps: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """a, b: links that connect all classes (id, n, tokens, sketch) which
    belong together."""
    pairs = lambda rows, *ends: reduce(DataFrame.unionByName, [
        rows.where((F.col(e) != F.col("id")) & (F.col(f"{e}_c") != F.col("c")) & _maybe(similarity, f"{e}_"))
        .select(F.col(e).alias("a"), F.col("id").alias("b")) for e in ends])
    best = lambda found: found.groupBy("b").agg(F.max_by("a", "likeness").alias("a")).select("a", "b")
    sure = confirm(best(_found(pairs(_mixed(nodes.where("first"), None), "top"), reps, similarity)), texts, words, similarity)
    rows = materialize(_mixed(nodes, components(sure)), "near-mixed")
    sure = sure.unionByName(confirm(best(_found(pairs(rows, "top", "low"), reps, similarity)), texts, words, similarity))
    # What is still apart from its node's pivot meets all others of the node: each pair in the first node it shares.
    rows = _mixed(rows, components(sure)).select("node", "id", "c", "top_c")
    every = nodes.groupBy("id").agg(F.collect_set("node").alias("nodes"))
    odd = odd_sketches(texts, words).hint("merge")
    rows = materialize(rows.join(every.hint("merge"), "id").join(_sized(reps, "", "id").hint("merge"), "id").join(odd, "id"), "near-mixed")
    named = lambda p: rows.select(F.col("node").alias(p + "node"), *[
        F.col(c).alias(p + c) for c in rows.columns if c != "node"])
    first = F.array_min(F.array_intersect("xnodes", "ynodes")) == F.col("xnode")
    met = named("x").where("xc <> xtop_c").join(
        named("y"), (F.col("xnode") == F.col("ynode")) & (F.col("xc") != F.col("yc")) & _may_link(similarity) & _odd_may_link(similarity) & first)
    more = materialize(met.select(F.least("xid", "yid").alias("a"), F.greatest("xid", "yid").alias("b")).distinct(), "near-open")
    return sure if more.isEmpty() else sure.unionByName(confirm(more, texts, words, similarity))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    similarity: int = SIMILARITY) -> DataFrame:
    """key, n_shingles, component_id, kept of every row."""
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    seen = materialize(features(docs, words), "near-features")
    sketch = [f"s{i}" for i in range(SKETCH // 16)]
    used = seen.where("n > 0 AND id IS NOT NULL")
    classes = used.groupBy("k0", "k1").agg(F.min("id").alias("rep"), F.min_by("said", "id").alias("said"))
    # A class is known by k0, or by k1 where two classes share a k0.
    alone = F.count(F.lit(1)).over(Window.partitionBy("k0")) == 1
    classes = materialize(classes.withColumn("class", F.when(alone, F.col("k0")).otherwise(F.col("k1"))), "near-classes")
    of = classes.select("k0", "k1", "class").hint("merge")
    reps = materialize(used.join(of, ["k0", "k1"]).groupBy(F.col("class").alias("id"), "n", *sketch)
                       .agg(F.first("tokens").alias("tokens")).select("id", "n", "tokens", *sketch), "near-reps")
    nodes = tree_nodes(reps)
    ends = nodes.select(F.col("id").alias("class")).distinct().join(classes.select("class", "rep", "said").hint("merge"), "class")
    ends = ends.select("class", F.col("rep").alias("id"), "said").hint("merge")
    texts = materialize(docs.where("id IS NOT NULL").withColumn("said", F.xxhash64("text")).join(ends, ["id", "said"])
                        .select(F.col("class").alias("id"), "text").dropDuplicates(["id"]), "near-texts")
    # An id with several classes (rows that repeat it with other texts) ties them.
    own = used.select("id", "k0", "k1").distinct().join(of, ["k0", "k1"]).select("id", "class")
    several = own.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("id", "a")
    ties = own.join(several.hint("merge"), "id").where("a <> class").select("a", F.col("class").alias("b")).distinct()
    parts = components(links(reps, nodes, texts, words, similarity).unionByName(ties))
    found = classes.join(parts.select(F.col("id").alias("class"), "component").hint("merge"), "class", "left").select(
        "k0", "k1", "rep", F.coalesce("component", "class").alias("part"))
    smallest = found.groupBy("part").agg(F.min("rep").alias("component"))
    found = found.join(smallest.hint("merge"), "part").select("k0", "k1", "component").hint("merge")
    out = seen.select("id", "n", "k0", "k1").join(found, ["k0", "k1"], "left")
    # An empty set, and a null id, stand alone.
    part = F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), part.alias("component_id"),
                      F.coalesce(F.col("id") == part, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate component stays."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
