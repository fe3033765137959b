"""Source divergence audit: how the terms of a source differ from those of the
other sources of its language, and from the language as a whole.

Terms are runs of letters A-Z and of characters beyond ASCII, A-Z lower-cased.
A language keeps the terms of at least ``MIN_DOCS`` of its documents. Shares
are whole numbers, p = 1 + floor(SCALE * (count + 1) / (N + V)), for every kept
term, occurring there or not; a divergence is floor((p - q)^2 / q).

Terms that a source uses more than its language are ranked by a dominance
skyband. The divergence rises with the count in the source and falls with the
count in the language, and ties go to the earlier term. So a term that ``k``
others dominate (no lower count in the source, no higher count in the language,
earlier in UTF-8) is not among the first ``k``. The terms of a source are dealt
to partitions, as many as its terms need; every partition keeps the terms that
fewer than k others dominate there; these skybands are merged, and only what is
left is ranked exactly. A partition holds ``BUFFER`` rows at most and passes on
what does not shrink, so memory is bounded whatever the data.

Two sources are compared over all kept terms of their language. Terms that
neither has count as many times one constant; terms that one of them has depend
on its count alone, so its histogram of counts suffices; of terms of both, the
pairs of counts that occur are counted, from a term's list of its sources (one
entry for each). The pairs of sources of a language are the result itself.

Counting is combined in the task before anything is shuffled, so a hot source
or a frequent term is one row for each (full buffer of a) task.

Defined cases: null text, lang and source are read as empty ones; a source
without terms takes part with zero counts; a language that keeps no term has
pairs of value 0 and no terms; a language of one source has no pairs; repeated
rows are documents like others; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: Distinct (lang, source, term) that a counting task holds; rows that a skyband task holds.
HELD, BUFFER = 300_000, 200_000
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
#: Terms of a source that are dealt to a partition together, on average.
CELL = 50_000
#: Letters stay (A-Z lower-cased), bytes of characters beyond ASCII stay, all else parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def add_terms(text: bytes, many: Counter) -> set[bytes]:
    """The distinct terms of a whole text (UTF-8); their occurrences are added
    to ``many``."""
    plain, distinct, start = text.translate(LETTERS), set(), 0
    while start < len(plain):
        end = plain.find(b" ", start + PIECE)
        end = len(plain) if end < 0 else end
        found = plain[start:end].split()
        many.update(found)
        distinct.update(found)
        start = end
    return distinct


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term (binary), n occurrences, docs documents with it, of
    documents (lang, source, text); parts of a task's rows, to be summed."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (many, docs) in held.items():
                if n := len(many):
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n),
                         pa.array(list(many), pa.binary()), pa.array(np.fromiter(many.values(), np.int64, n)),
                         pa.array(np.fromiter(map(docs.__getitem__, many), np.int64, n))], names=names)
            held.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                many, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(many)
                docs.update(add_terms(text, many))
                size += len(many) - before
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(
        run, "lang string, source string, term binary, n bigint, docs bigint")


def skyband_rows(n: np.ndarray, total: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Indices of the rows that fewer than ``k`` others dominate: n no lower,
    total no higher, rank lower. It is enough to count among the rows kept
    before: of k dominators, the first k themselves are kept."""
    order = np.lexsort((rank, total, -n))
    kept = np.empty(0, np.int64)
    for start in range(0, len(order), 256):
        block = order[start:start + 256]
        over = ((total[kept][None, :] <= total[block][:, None]) & (rank[kept][None, :] < rank[block][:, None])).sum(1)
        own = (total[block][None, :] <= total[block][:, None]) & (rank[block][None, :] < rank[block][:, None])
        over += np.tril(own, -1).sum(1)
        kept = np.concatenate([kept, block[over < k]])
    return kept


def _skyband(rows: pa.Table, k: int) -> pa.Table:
    """The skyband of each (lang, source) in the table."""
    rows = rows.combine_chunks()
    n, total = rows["n"].to_numpy(), rows["total"].to_numpy()
    rank = np.empty(len(n), np.int64)
    rank[pc.sort_indices(rows["term"]).to_numpy()] = np.arange(len(n))
    lang, source = (rows[c].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("lang", "source"))
    group = lang * (source.max(initial=0) + 1) + source
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    keep = [own[skyband_rows(n[own], total[own], rank[own], k)] for own in np.split(order, cuts)]
    return rows.take(pa.array(np.concatenate(keep)))


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """The rows (lang, source, term, n, total) of each partition that fewer
    than ``k`` rows of their source there dominate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= BUFFER:
                held = [_skyband(pa.concat_tables(held), k)]
                size = held[0].num_rows
                if 2 * size > BUFFER:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if size:
            yield from _skyband(pa.concat_tables(held), k).to_batches()

    return rows.mapInArrow(run, "lang string, source string, term binary, n bigint, total bigint")


def _share(count: Column, whole: Column) -> Column:
    """1 + floor(SCALE * count / whole) for count <= whole, digit by digit, so
    that no product leaves a long (up to 9e15 occurrences)."""
    digits, left = F.lit(0).cast("long"), count
    for _ in range(3):
        left = left * 1000
        digits = digits * 1000 + _floor(left, whole)
        left = left % F.nullif(whole, F.lit(0))
    return digits + 1


def _floor(a: Column, b: Column) -> Column:
    """Whole part of a / b; null where b is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def _diverge(p: Column, q: Column) -> Column:
    return _floor((p - q) * (p - q), q)


def audit(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the
    language (``pair``), and the ``top`` terms of the source (``term``)."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                       for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    # Dealt by (lang, term), which serves the sums of each source and of the language alike.
    counted = (count_terms(docs).repartition("lang", "term").groupBy("lang", "source", "term")
               .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    whole_term = Window.partitionBy("lang", "term")
    posts = materialize(counted.withColumn("total", F.sum("n").over(whole_term)).withColumn("docs", F.sum("docs").over(whole_term))
                        .where(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "total"), "terms-kept")
    whole = (posts.groupBy("lang", "term").agg(F.max("total").alias("total"))
             .groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count(F.lit(1)).alias("v")))
    own = posts.groupBy("lang", "source").agg(F.sum("n").alias("own_n"), F.count(F.lit(1)).alias("own_v"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    sources = materialize(
        docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
        .select("lang", "source", zero("own_n"), zero("own_v"), zero("lang_n"), zero("v"))
        .withColumn("all_n", F.col("own_n") + F.col("v")).withColumn("none", _share(F.lit(1), F.col("all_n"))), "term-sources")
    return _pairs(posts, sources).unionByName(_terms(posts, sources, top))


def _pairs(posts: DataFrame, sources: DataFrame) -> DataFrame:
    a = sources.select("lang", "source", "own_v", "v", "all_n", "none")
    b = sources.select("lang", F.col("source").alias("item"), F.col("own_v").alias("item_v"),
                       F.col("all_n").alias("item_all"), F.col("none").alias("item_none"))
    other = F.col("source") != F.col("item")
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "none", "item_none"))
    value = lambda v: F.coalesce(v, F.lit(0)).cast("long").alias("value")
    names = ("lang", "source", "item")
    neither = a.join(b, "lang").where(other).select(
        *names, value((F.col("v") - F.col("own_v") - F.col("item_v")) * _diverge(p0, q0)))
    # Terms of one source, by the counts that occur there.
    seen = materialize(posts.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("many"))
                       .join(sources.select("lang", "source", "all_n", "none"), ["lang", "source"])
                       .select("lang", "source", "many", "none", _share(F.col("n") + 1, F.col("all_n")).alias("p")), "term-counts")
    first = seen.join(b, "lang").where(other).select(*names, value(F.col("many") * _diverge(p, q0)))
    second = (seen.select("lang", F.col("source").alias("item"), "many", F.col("p").alias("q"))
              .join(a.select("lang", "source", "none"), "lang").where(other)
              .select(*names, value(F.col("many") * _diverge(p0, q))))
    # Terms of both, by the pairs of counts that occur there: in place of what the three sums above hold of them.
    at = (posts.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("own"))
          .select("lang", "own", F.posexplode("own").alias("i", "x"))
          .select("lang", "x", F.explode(F.slice("own", F.col("i") + 2, F.size("own"))).alias("y"))
          .groupBy("lang", F.col("x.source").alias("source"), F.col("y.source").alias("item"), F.col("x.n").alias("n"),
                   F.col("y.n").alias("item_n")).agg(F.count(F.lit(1)).alias("many")))
    met = (at.join(sources.select("lang", "source", "all_n", "none"), ["lang", "source"]).join(b, ["lang", "item"])
           .withColumn("p", _share(F.col("n") + 1, F.col("all_n"))).withColumn("q", _share(F.col("item_n") + 1, F.col("item_all"))))
    way = lambda s, i, p, q, p0, q0: met.select(
        "lang", F.col(s).alias("source"), F.col(i).alias("item"),
        value(F.col("many") * (_diverge(p, q) - _diverge(p, q0) - _diverge(p0, q) + _diverge(p0, q0))))
    both = way("source", "item", p, q, p0, q0).unionByName(way("item", "source", q, p, q0, p0))
    parts = reduce(DataFrame.unionByName, [x.groupBy(*names).agg(F.sum("value").alias("value")) for x in (neither, first, second, both)])
    found = parts.groupBy(*names).agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(posts: DataFrame, sources: DataFrame, top: int) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    shared = lambda rows: (rows.join(sources, ["lang", "source"])
                           .withColumn("p", _share(F.col("n") + 1, F.col("all_n")))
                           .withColumn("q", _share(F.col("total") + 1, F.col("lang_n") + F.col("v"))).where(p > q))
    # What dominates a term with p > q has it too, so the others need not be kept to rule terms out.
    cell = F.pmod(F.xxhash64("term"), F.ceil(F.col("own_v") / F.lit(CELL))).alias("cell")
    columns = ["lang", "source", "term", "n", "total"]
    dealt = shared(posts).select(*columns, cell).repartition("lang", "source", "cell").select(*columns)
    merged = skyband(skyband(dealt, top).repartition("lang", "source"), top)
    ranked = (shared(merged).withColumn("value", _diverge(p, q))
              .select("lang", "source", F.decode("term", "UTF-8").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (ranked.withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(table(spark, sf_dir, "documents"))


_F = "(({p} - {q}) * ({p} - {q})) // {q}"
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {MIN_DOCS}
), whole AS (
  SELECT lang, sum(total) AS lang_n, count(*) AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), s AS (SELECT DISTINCT lang, source FROM d
), own AS (
  SELECT s.lang, s.source, coalesce(sum(c.n), 0) AS own_n FROM s LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT o.lang, o.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({SCALE} * (coalesce(c.n, 0) + 1)) // (o.own_n + h.v) AS p,
         1 + ({SCALE} * (k.total + 1)) // (h.lang_n + h.v) AS q
  FROM own o JOIN kept k USING (lang) JOIN whole h USING (lang) LEFT JOIN c USING (lang, source, term)
), two AS (
  SELECT a.lang, a.source, b.source AS item, sum({_F.format(p='a.p', q='b.p')}) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(two.value, 0)::BIGINT AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN two ON two.lang = a.lang AND two.source = a.source AND two.item = b.source
), single AS (
  SELECT lang, source, 'term' AS part, term AS item, ({_F.format(p='p', q='q')})::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM single)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
