"""Document fingerprints: SimHash over weighted terms, and a radius search.

A term is a word with its successor (the last word stands alone); its weight
is its length, so frequent short words say little, and every occurrence counts.
Each term's 128-bit hash votes with its weight on the sign of each bit. The
votes are counted as sums of two 32-bit lanes per 64-bit number, so one hash
aggregation over the exploded terms gives all bits, inside generated code.

``within_radius`` finds all pairs of distinct fingerprints within a Hamming
radius r by permuted block tables: the bits are cut into r + 1 blocks, one of
which must be equal; what is left is cut again into r + 1 blocks, one of which
must be equal too. Each choice of two blocks is a table, joined on their bits.
Copies are collapsed first: it returns pairs of fingerprints, and rows are
members of their fingerprint.

Defined cases: null text is the empty text; texts without words have one empty
term; equal texts have equal fingerprints; a null key has no next document
(its edited text is its text, near_next is null); of repeated keys the row with
the smallest text hash is the one others see as their next; the only document
is its own next; rows with equal key and text are one row (their votes add up to
the same signs); further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

BITS = 128
RADIUS = 3
LANES = 0x0000000100000001
#: Successors are looked up among keys that agree in all but so many bits.
KEY_BITS = 10


def terms(text: str) -> Column:
    """Array of (word, next word) of a text column."""
    words = F.split(F.trim(F.translate(F.coalesce(F.col(text), F.lit("")), "\n\r\t", "   ")), " +", -1)
    return F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b"))


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, high, low: the fingerprint of each group of equal keys (their
    texts' terms vote together)."""
    rows = df.select(*keys, F.explode(terms(text)).alias("t"))
    rows = rows.select(*keys, F.col("t.a").alias("a"), F.coalesce("t.b", F.lit("")).alias("b"))
    weight = F.greatest(F.length("a") + F.length("b"), F.lit(1)).cast("long")
    votes = rows.select(*keys, weight.alias("w"), F.xxhash64("a", "b").alias("h0"), F.xxhash64("b", "a", F.lit(1)).alias("h1"))
    lanes = [F.sum(F.shiftright(f"h{half}", bit).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{half}_{bit}")
             for half in (0, 1) for bit in range(32)]
    sums = votes.groupBy(*keys).agg(F.sum("w").alias("w"), *lanes)

    def signs(half: int) -> Column:
        bits = F.lit(0).cast("long")
        for bit in range(32):
            v = F.col(f"v{half}_{bit}")
            for lane, at in ((v.bitwiseAND(F.lit(0xFFFFFFFF)), bit), (F.shiftrightunsigned(v, 32), bit + 32)):
                bits = bits.bitwiseOR(F.shiftleft((lane * 2 > F.col("w")).cast("long"), at))
        return bits

    return sums.select(*keys, signs(0).alias("high"), signs(1).alias("low"))


def written(high: Column, low: Column) -> Column:
    return F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0"))


def distance(h1: Column, l1: Column, h2: Column, l2: Column) -> Column:
    return F.bit_count(h1.bitwiseXOR(h2)) + F.bit_count(l1.bitwiseXOR(l2))


def _bits(start: int, size: int) -> Column:
    """``size`` (64 at most) bits of high||low from ``start``, as a number."""
    def part(col: str, begin: int, n: int) -> Column:
        v = F.shiftrightunsigned(col, 64 - begin - n)
        return v if n == 64 else v.bitwiseAND(F.lit((1 << n) - 1))

    if start + size <= 64:
        return part("high", start, size)
    if start >= 64:
        return part("low", start - 64, size)
    tail = start + size - 64
    return F.shiftleft(part("high", start, 64 - start), tail).bitwiseOR(part("low", 0, tail))


def _cut(bits: list[tuple[int, int]], pieces: int) -> list[list[tuple[int, int]]]:
    """Cut runs of bits (start, size) into ``pieces`` of equal size."""
    singles = [s + i for s, n in bits for i in range(n)]
    out = []
    for p in range(pieces):
        own = singles[p * len(singles) // pieces:(p + 1) * len(singles) // pieces]
        runs: list[list[int]] = []
        for b in own:
            if runs and runs[-1][0] + runs[-1][1] == b and runs[-1][1] < 32:
                runs[-1][1] += 1
            else:
                runs.append([b, 1])
        out.append([tuple(r) for r in runs])
    return out


def within_radius(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """high, low, other_high, other_low, bits: all pairs of distinct
    fingerprints (columns high, low) at most ``radius`` bits apart, once."""
    distinct = fps.select("high", "low").distinct()
    tables = []
    first = _cut([(0, 64), (64, 64)], radius + 1)
    for i, block in enumerate(first):
        rest = _cut([r for j, other in enumerate(first) if j != i for r in other], radius + 1) if radius else [block]
        for j, second in enumerate(rest):
            tables.append(F.struct(F.lit(i * (radius + 1) + j).alias("t"),
                                   F.xxhash64(*[_bits(s, n) for s, n in [*block, *second]]).alias("k")))
    keyed = distinct.select("high", "low", F.explode(F.array(*tables)).alias("x")).select("high", "low", "x.t", "x.k")
    other = keyed.select(F.col("high").alias("other_high"), F.col("low").alias("other_low"), "t", "k")
    bits = distance(F.col("high"), F.col("low"), F.col("other_high"), F.col("other_low"))
    after = (F.col("high") < F.col("other_high")) | ((F.col("high") == F.col("other_high")) & (F.col("low") < F.col("other_low")))
    return (keyed.join(other, ["t", "k"]).where(after).withColumn("bits", bits).where(F.col("bits") <= radius)
            .select("high", "low", "other_high", "other_low", "bits").distinct())


def successors(ids: DataFrame) -> DataFrame:
    """id, next: the next larger id of every id (distinct integers), and the
    smallest one behind the largest. Ids are sorted within blocks of
    2 ** KEY_BITS neighbouring values; the first ids of the blocks are linked
    the same way, so no task sorts more than one such block."""
    ends = ids.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
    if ends["low"] is None:
        return ids.select("id", F.col("id").alias("next"))

    def linked(rows: DataFrame, low: int, high: int) -> DataFrame:
        if high - low < 1 << KEY_BITS:  # at most so many ids: one block
            return rows.select("id", F.lead("id").over(Window.partitionBy(F.lit(0)).orderBy("id")).alias("next"))
        block = F.shiftright("id", KEY_BITS)
        out = rows.withColumn("block", block).withColumn(
            "next", F.lead("id").over(Window.partitionBy("block").orderBy("id")))
        firsts = rows.groupBy(block.alias("block")).agg(F.min("id").alias("first"))
        chain = linked(firsts.select(F.col("block").alias("id")), low >> KEY_BITS, high >> KEY_BITS)
        after = (chain.join(firsts.select(F.col("block").alias("next"), "first"), "next")
                 .select(F.col("id").alias("block"), "first"))
        return (out.join(after, "block", "left")
                .select("id", F.coalesce("next", "first").alias("next")))

    return linked(ids, ends["low"], ends["high"]).select("id", F.coalesce("next", F.lit(ends["low"])).alias("next"))


def edited_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of documents (id, text without nulls): id, text, edited; and id, next.
    Only as much of a text travels to its predecessor as that one needs."""
    docs = docs.withColumn("hash", F.xxhash64("text"))
    known = docs.where("id IS NOT NULL")
    sizes = known.groupBy("id").agg(F.max(F.length("text")).alias("n"))
    sizes = materialize(sizes, "simhash-sizes")
    links = materialize(successors(sizes.select("id")).join(sizes, "id"), "simhash-next")
    wanted = links.select(F.col("next").alias("id"), F.col("id").alias("to"), F.floor(F.col("n") / 4).cast("int").alias("want"))
    sent = known.join(wanted, "id").select("to", "hash", F.expr("substring(text, 1, want)").alias("head"))
    heads = sent.groupBy(F.col("to").alias("id")).agg(F.min_by("head", "hash").alias("head"))
    met = known.join(heads, "id", "left").unionByName(docs.where("id IS NULL").withColumn("head", F.lit(None).cast("string")))
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.when(F.col("id").isNull(), F.col("text")).otherwise(F.concat(
        F.substring("text", F.lit(1), F.length("text") - quarter), F.substring("head", F.lit(1), quarter)))
    return met.select("id", "hash", "text", edited.alias("edited")), links.select("id", "next")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts, links = edited_texts(docs)
    keys = ["id", "hash", "n_chars", "edited_sha256", "is_edited"]
    both = texts.select(
        "id", "hash", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("said")),
                          F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("said")))).alias("x"))
    fps = fingerprints(both.select("id", "hash", "n_chars", "edited_sha256", "x.is_edited", "x.said"), keys, "said")
    pick = lambda c, e: F.max(F.when(F.col("is_edited") == e, F.col(c)))
    rows = fps.groupBy(*keys[:4]).agg(
        pick("high", False).alias("high"), pick("low", False).alias("low"),
        pick("high", True).alias("edited_high"), pick("low", True).alias("edited_low"))
    rows = materialize(rows, "simhash-fingerprints")
    shown = rows.groupBy("id").agg(F.min_by("high", "hash").alias("next_high"), F.min_by("low", "hash").alias("next_low"))
    nexts = links.join(shown.withColumnRenamed("id", "next"), "next").select("id", "next_high", "next_low")
    out = rows.join(nexts, "id", "left")
    like = lambda h, low: F.lit(1.0) - distance(F.col("high"), F.col("low"), F.col(h), F.col(low)) / F.lit(BITS)
    return out.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", written(F.col("high"), F.col("low")).alias("fingerprint"),
        written(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"),
        like("edited_high", "edited_low").alias("near_edited"), like("next_high", "next_low").alias("near_next"))
