"""Terms of a posting in one row, for shuffles: a row of a short term is mostly
the posting's keys and the row's own bookkeeping. Packed rows are made in the
task that has the terms and taken apart after the shuffle, in built-in
expressions; a row holds terms of one batch only, so its size is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.compute import take
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands between the terms of a row; a term that holds it has a row of its own, as NULL has.
SEPARATOR = "\x1f"
#: Parts that a posting's terms are dealt to by their hash where all copies of a term must meet.
PARTS = 2
#: Rows of a batch that are packed at once.
ROWS = 2000
PACKED = "_part int, _terms string, _alone boolean"


def packed_schema(df: DataFrame, keys: list[str]) -> T.StructType:
    return T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(PACKED).fields])


def pack(part: pa.RecordBatch, keys: list[str], owner: np.ndarray, terms: pa.Array, distinct: bool) -> pa.RecordBatch:
    """Packed rows of a batch: ``terms[i]`` is of the batch's row ``owner[i]``.
    With ``distinct`` repeats go and a posting's terms are dealt to parts."""
    code, parts = np.zeros(part.num_rows, np.int64), PARTS if distinct else 1
    for k in keys:
        col = part.column(k).dictionary_encode("encode")
        code = np.unique(code * (len(col.dictionary) + 1) + col.indices.to_numpy(), return_inverse=True)[1]
    first = np.unique(code, return_index=True)[1]  # a row of each posting
    coded = terms.dictionary_encode("encode")
    words, at = coded.dictionary, coded.indices.to_numpy()
    n, dealt = len(words) + 1, np.zeros(len(words), np.int64)
    if parts > 1:
        dealt[:] = [crc32((t or "").encode()) % parts for t in words.to_pylist()]
    alone = pc.fill_null(pc.match_substring(words, SEPARATOR), True).to_numpy(zero_copy_only=False).astype(bool)
    pairs = (code[owner] * parts + dealt[at]) * n + at
    pairs = np.unique(pairs) if distinct else np.sort(pairs)
    group, word = pairs // n, pairs % n
    new = np.ones(len(pairs), bool)
    new[1:] = (group[1:] != group[:-1]) | alone[word[1:]] | alone[word[:-1]]
    starts = np.flatnonzero(new)
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(pairs)), pa.int32()), take(words, pa.array(word)))
    rows = pa.array(first[group[starts] // parts])
    return pa.RecordBatch.from_arrays(
        [*(take(part.column(k), rows) for k in keys), pa.array(group[starts] % parts, pa.int32()),
         pc.binary_join(lists, SEPARATOR), pa.array(alone[word[starts]])], names=[*keys, "_part", "_terms", "_alone"])


def pack_lists(part: pa.RecordBatch, keys: list[str], lists: pa.ListArray) -> pa.RecordBatch:
    """Packed rows of the distinct terms of a batch's lists; NULL has none."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pack(part, keys, np.repeat(np.arange(part.num_rows), sizes), lists.flatten(), distinct=True)


def packed_lists(df: DataFrame, keys: list[str], lists: Column) -> DataFrame:
    """keys, _part, _terms, _alone of the distinct terms of an array column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                yield pack_lists(part, keys, part.column("_list"))
    return df.select(*keys, lists.alias("_list")).mapInArrow(run, packed_schema(df, keys))


def packed(df: DataFrame, keys: list[str], term: str) -> DataFrame:
    """keys, _part, _terms, _alone of rows of (keys, term), repeats kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pack(batch, keys, np.arange(batch.num_rows), batch.column(term), distinct=False)
    return df.select(*keys, term).mapInArrow(run, packed_schema(df, keys))


def unpacked(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """cols and one term a row, of packed rows."""
    terms = F.when(F.col("_alone"), F.array("_terms")).otherwise(F.split("_terms", SEPARATOR, -1))
    return df.select(*cols, F.explode(terms).alias(out))


def distinct_terms(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """DISTINCT (keys, term) of packed rows, dealt by keys and part: all copies
    of a term meet, and the DISTINCT needs no other shuffle."""
    dealt = df.repartition(*keys, "_part")
    return unpacked(dealt, [*keys, "_part"], out).distinct().select(*keys, out)
