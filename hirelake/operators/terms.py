"""Term extraction (I10-I13) and term tables.

Latin terms are a pure expression (``regexp_extract_all``). Korean nouns are
re-aimed from a per-row statistical tagger to a lexicon: each script run
(token) is segmented into lexicon words and unknown letters at least cost, and
its words are its nouns (compounds have several, particles are unknown
letters). The work is done on the token vocabulary, not on the text:

    texts -> tokens (with position) -> substrings of the distinct tokens (of
    the lengths that occur in the lexicon) -> join lexicon -> cheapest path
    through a token's words -> occurrences -> arrays per row in text order.

Token rows carry a small row key, never the text, so the shuffles move
(key, position, token) only. A lexicon within the session's broadcast limit
(measured at run time) is sent to the tasks instead, as a tagger's dictionary
would be, and each segments the tokens of the rows it reads: no occurrence is
shuffled at all.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.compute import take
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import HANGUL_RUN, latin_terms
from ..schemas import term_column
from ._util import broadcast_limit, lookup_join
from .packed import ROWS, distinct_terms, pack_lists, packed_lists, packed_schema

KOREAN_PATTERN = HANGUL_RUN
# Stand-in script for the given tables, which hold no Hangul: Latin letters
# with the Latin-1 / Latin Extended blocks (FIXTURES.md).
FIXTURE_PATTERN = "[A-Za-zÀ-ɏ]+"


#: Cost of a lexicon word without a cost of its own, and of a letter that no word covers.
WORD_COST, LETTER_COST = 1, 2


def _lexicon_terms(lexicon: DataFrame) -> DataFrame:
    """term, cost of every word (the cheapest, where one is repeated)."""
    cost = F.col("cost").cast("int") if "cost" in lexicon.columns else F.lit(WORD_COST)
    return (lexicon.select(F.col("term").cast("string").alias("term"), cost.alias("cost"))
            .where(F.col("term") != "").groupBy("term").agg(F.min("cost").alias("cost"))
            .where(F.col("cost").isNotNull()))


def _substrings(vocab: DataFrame, lex: DataFrame) -> DataFrame:
    """tok, s, n, term: the substrings of every token, of the lengths
    that occur in the lexicon. The lengths are a scalar subquery (a few
    numbers, at run time): building the plan starts no job, and one overlong
    entry adds one length."""
    lengths = lex.agg(F.sort_array(F.collect_set(F.char_length("term")))).scalar()
    able = vocab.withColumn("_lengths", lengths)
    n = F.explode(F.filter("_lengths", lambda x: x <= F.char_length("tok"))).alias("n")
    sized = able.select("tok", n)
    at = sized.select("*", F.explode(F.sequence(F.lit(0), F.char_length("tok") - F.col("n"))).alias("s"))
    return at.withColumn("term", F.col("tok").substr(F.col("s") + 1, F.col("n")))


def _order(a: tuple | None, b: tuple | None) -> int:
    """Order of two word lists, each a chain (list before, word, length).
    They are followed back only to where they part."""
    n, m, x, y = a[2] if a else 0, b[2] if b else 0, a, b
    while x and x[2] > m:
        x = x[0]
    while y and y[2] > n:
        y = y[0]
    found = (n > m) - (n < m)
    while x is not y:
        if x[1] != y[1]:
            found = 1 if x[1] > y[1] else -1
        x, y = x[0], y[0]
    return found


def _cheapest(tok: str, words: list[tuple[int, int, int]]) -> list[str]:
    """Words of the cheapest segmentation of a token, from its lexicon words
    (end, start, gain; sorted). Least cost is most gain, where a word gains the
    cost of the letters it covers less its own; of equal ones the list of words
    that is greatest in code-point order is taken."""
    ends, values, lists = [0], [0], [None]  # the best segmentation up to each end
    for e, s, gain in words:
        at = bisect_right(ends, s) - 1
        before, value = lists[at], values[at] + gain
        found = (before, tok[s:e], before[2] + 1 if before else 1)
        if value < values[-1] or value == values[-1] and _order(found, lists[-1]) < 0:
            value, found = values[-1], lists[-1]
        if ends[-1] == e:
            values[-1], lists[-1] = value, found
        else:
            ends.append(e)
            values.append(value)
            lists.append(found)
    out, last = [], lists[-1]
    while last:
        out.append(last[1])
        last = last[0]
    return out[::-1]


#: Rows of one group are brought together by this number: a sort by one number is a radix sort.
_HASH = "_h"


def _gathered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by their keys and, within a partition, ordered by the keys' hash."""
    return df.repartition(*keys).withColumn(_HASH, F.xxhash64(*keys)).sortWithinPartitions(_HASH)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], order: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, sorted by ``keys`` and ``order``, with where
    each group starts, of gathered rows that come in batches. Rows of a hash
    that goes on in the next batch are held back."""
    def ready(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(parts)
        table = table.sort_by([(c, "ascending") for c in [_HASH, *keys, *order]]).combine_chunks()
        return table, _starts(table, keys)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes = batch.column(_HASH).to_numpy()
        cut = int(np.searchsorted(hashes, hashes[-1]))
        if held and (cut or held[-1].column(_HASH)[-1].as_py() != hashes[-1]):
            yield ready([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield ready([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield ready(held)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Rows whose keys (NULL equals NULL) are not those of the row before."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for k in keys:
        was, now = table[k].slice(0, table.num_rows - 1), table[k].slice(1)
        differs = pc.or_(pc.fill_null(pc.not_equal(was, now), False), pc.xor(pc.is_null(was), pc.is_null(now)))
        new[1:] |= differs.to_numpy()
    return np.flatnonzero(new)


def _cheapest_of_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tok, e, s, gain) -> (tok, nouns)."""
    for table, starts in _whole_groups(batches, ["tok"], ["e", "s"]):
        toks = take(table["tok"], pa.array(starts))
        words = list(zip(*(table[c].to_numpy().tolist() for c in ("e", "s", "gain"))))
        ends = [*starts.tolist(), len(words)]
        nouns = [_cheapest(t, words[i:j]) for t, i, j in zip(toks.to_pylist(), ends, ends[1:])]
        out = pa.table({"tok": toks, "nouns": pa.array(nouns, pa.list_(pa.string()))})
        yield from out.combine_chunks().to_batches()


def _noun_arrays(keys: list[str], n_cols: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(keys..., ci, pos, nouns) -> (keys..., one noun array per column)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, keys, ["ci", "pos"]):
            # rows that share a key and a place (copies) count once
            places = [*_starts(table, [*keys, "ci", "pos"]).tolist(), table.num_rows]
            if len(places) <= table.num_rows:
                nouns = table["nouns"].to_pylist()
                keep = [i for a, b in zip(places, places[1:])
                        for i in ([a] if b - a == 1 else sorted({tuple(nouns[i]): i for i in range(a, b)}.values(), key=nouns.__getitem__))]
                table = take(table, pa.array(keep)).combine_chunks()
                starts = _starts(table, keys)
            nouns, ci = table["nouns"].chunk(0), table["ci"].to_numpy()
            owner = np.repeat(np.arange(len(starts)), np.diff([*starts, table.num_rows]))
            sizes = pc.list_value_length(nouns).to_numpy()
            out = {k: take(table[k], pa.array(starts)) for k in keys}
            for i in range(n_cols):
                mine = ci == i
                ends = np.cumsum(np.bincount(owner[mine], sizes[mine], len(starts))).astype(np.int32)
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                out[f"_n{i}"] = pa.ListArray.from_arrays(offsets, nouns.filter(pa.array(mine)).flatten())
            yield from pa.table(out).combine_chunks().to_batches()
    return run


#: Bytes of a lexicon word beside its letters, and tokens whose nouns a task remembers.
WORD_BYTES, KNOWN = 24, 1 << 18


def _sent(df: DataFrame, lexicon: DataFrame) -> tuple[Column, Column] | None:
    """Whether the lexicon is within the broadcast limit, and its words if it
    is: scalar subqueries, so building the plan starts no job and a larger
    lexicon is never put together. None where the session broadcasts nothing."""
    limit = broadcast_limit(df.sparkSession)
    if limit <= 0:
        return None
    lex = _lexicon_terms(lexicon)
    fits = lex.agg(F.coalesce(F.sum(F.octet_length("term") + WORD_BYTES) <= limit, F.lit(True)).alias("fits")).scalar()
    return fits, lex.where(fits).agg(F.collect_list(F.struct("term", "cost")).alias("words")).scalar()


def _with_words(df: DataFrame, words: Column) -> DataFrame:
    """The words ride on the first row of each partition."""
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    return df.withColumn("_lex", F.when(first, words))


class _Dictionary:
    """A lexicon in a task, as a tree of letters with a word's gain under "",
    and the nouns of the tokens met so far."""

    def __init__(self) -> None:
        self.tree: dict = {}
        self.known: dict[str, list[str]] = {}

    def learn(self, words: pa.ListArray) -> None:
        for x in words.flatten().to_pylist():
            node = self.tree
            for letter in x["term"]:
                node = node.setdefault(letter, {})
            node[""] = len(x["term"]) * LETTER_COST - x["cost"]

    def nouns(self, tok: str) -> list[str]:
        if (found := self.known.get(tok)) is None:
            words, size = [], len(tok)
            for s in range(size):
                node, e = self.tree, s
                while e < size and (node := node.get(tok[e])) is not None:
                    e += 1
                    if "" in node:
                        words.append((e, s, node[""]))
            if len(self.known) >= KNOWN:
                self.known.clear()
            found = self.known[tok] = _cheapest(tok, sorted(words))
        return found

    def nouns_of_lists(self, toks: pa.ListArray) -> pa.ListArray:
        """Token lists -> the nouns of their tokens in order; NULL -> []."""
        flat = toks.flatten().dictionary_encode()
        codes = flat.indices.to_numpy()
        nouns = pa.array([self.nouns(t) for t in flat.dictionary.to_pylist()], pa.list_(pa.string()))
        sizes = pc.list_value_length(nouns).to_numpy(zero_copy_only=False)[codes]
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(_sizes(toks))])]
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), take(nouns, flat.indices).flatten())


def _sizes(lists: pa.ListArray) -> np.ndarray:
    """Elements of each list, none for NULL."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _read(batches: Iterator[pa.RecordBatch], lex: _Dictionary) -> Iterator[pa.RecordBatch]:
    """Batches in parts of a few rows; the words among them go to ``lex``."""
    for batch in batches:
        if "_lex" in batch.schema.names and batch.column("_lex").null_count < batch.num_rows:
            lex.learn(batch.column("_lex"))
        yield from (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS))


def _local_arrays(columns: list[str], n_cols: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(columns..., _t0, _t1, ..., _lex) -> (columns..., one noun array per token list)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = _Dictionary()
        for part in _read(batches, lex):
            nouns = [lex.nouns_of_lists(part.column(f"_t{i}")) for i in range(n_cols)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), *nouns], names=[*columns, *names])
    return run


def segment(rows: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., tok, nouns) for rows of (keys..., tok) whose token holds a
    lexicon word; ``nouns`` are the words of its cheapest segmentation, in
    order. A ``cost`` column in the lexicon prices its words.

    Matching runs on the vocabulary (DISTINCT tokens, collapsed map-side), not
    on occurrences, and the (tok, nouns) map is joined back to them. AQE splits
    a hot word or token in both joins. A token's words are bounded by its length; the
    walk through them is a small Python helper, as a fold of expressions over
    them is interpreted and took most of the run.
    """
    lex = _lexicon_terms(lexicon)
    vocab = _substrings(rows.select("tok").distinct(), lex)
    hits = lookup_join(vocab, lex, ["term"], "inner")
    words = hits.select("tok", (F.col("s") + F.col("n")).alias("e"), "s", (F.col("n") * LETTER_COST - F.col("cost")).alias("gain"))
    nouns = _gathered(words, ["tok"]).mapInArrow(_cheapest_of_tokens, "tok string, nouns array<string>").where(F.size("nouns") > 0)
    # nouns has one row a token: its partitions are even and need no sort, and neither do the occurrences
    return lookup_join(rows, nouns.hint("shuffle_hash"), ["tok"], "inner").select(*keys, "tok", "nouns")


def row_key(df: DataFrame, cols: list[str] | None = None) -> Column:
    """A content key: SHA-256 (32 bytes) of the given columns (default: the
    whole row) as JSON. Rows with the same texts share it; their term arrays
    are equal, so sharing is exact."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in (cols or df.columns)])), 256))


def lexicon_terms(df: DataFrame, cols: list[str], lexicon: DataFrame,
                  pattern: str = KOREAN_PATTERN, name=lambda c: term_column(c, "korean"),
                  key: list[str] | None = None, dedupe: bool = True) -> DataFrame:
    """Add one noun array per text column (text order, repeats kept);
    NULL, blank or unmatched text -> [].

    Where the lexicon is within the broadcast limit, rows are worked on where
    they are read. Otherwise, and where a ``key`` that should be unique has
    several texts (whose rows share their nouns), by joins; both are decided at
    run time.
    """
    sent = _sent(df, lexicon)
    if sent is None:
        return _joined_terms(df, cols, lexicon, pattern, name, key, dedupe)
    fits, words = sent
    here = fits if key is None else fits & _one_text_a_key(df, cols, key)
    toks = [F.regexp_extract_all(F.col(c), F.lit(pattern), 0).alias(f"_t{i}") for i, c in enumerate(cols)]
    names = [name(c) for c in cols]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.ArrayType(T.StringType())) for n in names]])
    local = _with_words(df.where(here).select(*df.columns, *toks), words)
    local = local.mapInArrow(_local_arrays(df.columns, len(cols), names), schema)
    return local.union(_joined_terms(df.where(~here), cols, lexicon, pattern, name, key, dedupe))


def _one_text_a_key(df: DataFrame, cols: list[str], key: list[str]) -> Column:
    """Whether all rows of a key have the same texts (NULL keys are one key)."""
    text = F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])
    per_key = df.groupBy(*key).agg(F.min(text).alias("a"), F.max(text).alias("b"))
    return per_key.agg(F.coalesce(F.min(F.col("a") == F.col("b")), F.lit(True)).alias("one")).scalar()


def _joined_terms(df: DataFrame, cols: list[str], lexicon: DataFrame, pattern: str, name,
                  key: list[str] | None, dedupe: bool) -> DataFrame:
    """Noun arrays by joins, for a lexicon of any size.

    Token rows carry only a small row key (``key`` when the caller has a
    unique one, else a content hash), the column index, the position and
    the token; all columns are tokenised in one pass and the arrays come
    back in one join.
    """
    if key is None:
        # keyed by the texts themselves: copies of a posting (re-scraped every
        # day) collapse map-side here and are tokenised once
        keyed = df.withColumn("_rk", row_key(df, cols))
        kcols = ["_rk"]
        source = keyed.select("_rk", *cols).dropDuplicates(["_rk"]) if dedupe else keyed
    else:
        # A unique key has no copies to collapse. Routing the rows through a
        # dropDuplicates exchange would let both branches share one read of
        # the input (faster locally, where a scan is one task), but at scale
        # it shuffles every text once to save a second parallel scan: not
        # worth it, so the input is read by each branch.
        keyed, kcols, source = df, key, df
    per_col = F.array(*[F.struct(F.lit(i).alias("ci"),
                                 F.regexp_extract_all(F.col(c), F.lit(pattern), 0).alias("toks"))
                        for i, c in enumerate(cols)])
    toks = (source.select(*kcols, F.explode(per_col).alias("_c"))
            .select(*kcols, F.col("_c.ci").alias("ci"), F.posexplode("_c.toks").alias("pos", "tok")))
    hits = segment(toks, lexicon, [*kcols, "ci", "pos"])
    # dealt by key and put together in one pass: no state per key
    dealt = _gathered(hits.select(*kcols, "ci", "pos", "nouns"), kcols)
    schema = T.StructType([T.StructField(k, dealt.schema[k].dataType) for k in kcols]
                          + [T.StructField(f"_n{i}", T.ArrayType(T.StringType())) for i in range(len(cols))])
    arrays = dealt.mapInArrow(_noun_arrays(kcols, len(cols)), schema)
    out = lookup_join(keyed, arrays, kcols, "left", null_safe=True)
    out = out.withColumns({name(c): F.coalesce(F.col(f"_n{i}"), F.array().cast("array<string>"))
                           for i, c in enumerate(cols)})
    return out.select(*df.columns, *[name(c) for c in cols])


def add_term_columns(df: DataFrame, lexicon: DataFrame, cols: list[str],
                     pattern: str = KOREAN_PATTERN) -> DataFrame:
    """Korean noun arrays and Latin term arrays for each column,
    built as one plan (no driver round trip)."""
    with_ko = lexicon_terms(df, cols, lexicon, pattern)
    return with_ko.withColumns({term_column(c, "english"): latin_terms(c) for c in cols})


def _packed_nouns(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(keys..., _t0, _lex) -> packed rows of the tokens' nouns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = _Dictionary()
        for part in _read(batches, lex):
            yield pack_lists(part, keys, lex.nouns_of_lists(part.column("_t0")))
    return run


def latin_term_table(df: DataFrame, col: str, out: str) -> DataFrame:
    """DISTINCT (job_id, platform, Latin term of col). A posting's
    terms are shuffled several a row."""
    keys = ["job_id", "platform"]
    return distinct_terms(packed_lists(df, keys, F.array_distinct(latin_terms(col))), keys, out)


def lexicon_term_table(df: DataFrame, col: str, out: str, lexicon: DataFrame,
                       pattern: str = KOREAN_PATTERN) -> DataFrame:
    """DISTINCT (job_id, platform, noun of col).

    Same rows as unnesting the noun arrays. Where the lexicon is within the
    broadcast limit, nouns are found where a text is read and shuffled several
    a row; otherwise by joins (decided at run time).
    """
    keys = ["job_id", "platform"]
    sent = _sent(df, lexicon)
    if sent is None:
        return _joined_term_table(df, col, out, lexicon, pattern)
    fits, words = sent
    runs = F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(pattern), 0))
    toks = _with_words(df.where(fits).select(*keys, runs.alias("_t0")), words)
    nouns = distinct_terms(toks.mapInArrow(_packed_nouns(keys), packed_schema(df, keys)), keys, out)
    return nouns.union(_joined_term_table(df.where(~fits), col, out, lexicon, pattern))


def _joined_term_table(df: DataFrame, col: str, out: str, lexicon: DataFrame, pattern: str) -> DataFrame:
    """Nouns by joins, for a lexicon of any size. Copies of a posting (re-scraped
    every day) collapse as whole texts: a task's table of distinct rows is then
    no larger than the text it read, where one of distinct tokens is many
    times that. A token met in two texts of a posting is met by the last DISTINCT.
    """
    runs = F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(pattern), 0))
    keys = ["job_id", "platform"]
    texts = df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
    toks = texts.select(*keys, F.explode(runs).alias("tok"))
    nouns = segment(toks, lexicon, keys)
    return nouns.select(*keys, F.explode("nouns").alias(out)).distinct()
