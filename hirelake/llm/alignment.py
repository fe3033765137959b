"""Cross-tokenizer alignment by inverted pair bitmaps.

Every text is encoded by a byte-level vocabulary (A) and a piece vocabulary
(B). Where tokens of both end at the same byte the text falls into groups; a
token of A and one of B whose bytes overlap are linked. A pair of ids counts
for the documents that hold it linked.

The index is inverted: for each pair, a compressed bitmap of the documents that
hold it. Documents are numbered within blocks of at most ``DOCS`` documents and
about ``LINKS`` links, so a block's bitmaps are built in bounded memory: plane 0
holds the documents of a pair; plane j >= 1 those whose number of links less
one has bit j - 1. A bitmap is a sorted list of 16-bit numbers, or one bit for
each document of the block where that is shorter. Blocks share no document, so
ORing a pair's bitmaps sets them side by side and the popcounts add up; the
counts decide which pair is best for its A id. The postings then carry a pair's
count and mark back to the documents of their block, weighted by their plane.

Rows are shuffled as bitmaps, by pair (a pair has at most one row for each
block and plane, so a frequent one is as many rows as there are blocks, and the
join is one that AQE splits) and by block (bounded by its links).

Encoding is done per piece of text between places where both vocabularies
always end a token (see ``_CUT``); what a piece gives is kept in bounded caches.
That no piece of B runs over such a place is verified when the vocabulary is
loaded, else whole texts are encoded.

Defined cases: null and empty texts, and texts that one of the vocabularies does
not give back byte for byte, have no tokens: zeros and an empty digest; rows of
one key are documents each; null keys are keys like others; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A block ends at so many documents or links.
DOCS, LINKS = 1 << 16, 1 << 20
#: Bytes (about) of words, and of parts of words, that a worker keeps, and the longest of them in characters.
KEPT, LONGEST = 200 << 20, 40

# How the byte-level vocabulary cuts text before its merges, and letters of one script class.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER = "A-Za-z0-9À-ÖØ-öø-ɏ"
_MARK = ".,;:!?"
#: Both vocabularies end a token: before a space or line feed that follows no white space; between a letter or digit and a
#: mark; and between a single line feed and a letter or digit.
_CUT = re.compile(rf"(?<=[!-~{_LETTER}])(?=[ \n])|(?<=[{_LETTER}])(?=[{_MARK}])|(?<=[!-~{_LETTER}]\n)(?=[{_LETTER}])")
#: A space that may not be such a place.
_LOOSE = re.compile(rf"[^!-~{_LETTER}] ")
_INSIDE = re.compile(rf"[^▁]▁|[{_LETTER}][{_MARK}]|\n")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {**{chr(b): b for b in kept}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """Both vocabularies, and what they make of text."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = _byte_letters(), model["vocab"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        if any(vocab[m.replace(" ", "")] != 256 + i for i, m in enumerate(merges)):
            raise ValueError("ids of the byte-level vocabulary are not in the order of its merges")
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length_a = [0] * len(ranks)
        for raw, i in ranks.items():
            self.length_a[i] = len(raw)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b, inside = [], False
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
                inside = inside or bool(_INSIDE.search(piece)) and not (self.b.is_control(i) or self.b.is_unknown(i))
        self.length_b = [len(x) for x in self.bytes_b]
        self.named = [str(i) for i in range(max(len(ranks), len(self.bytes_b)))]
        start = self.b.encode("\n")  # a dummy space, then a token that never merges
        self.whole = inside or len(start) != 2 or not self.b.is_byte(start[1])
        self.words: dict[str, tuple] = {}
        self.parts: dict[str, tuple] = {}
        self.held = 0

    def align(self, a: list[int], b: list[int]) -> tuple[bytes, bytes, int, int]:
        """Groups as text, links as pairs of 16-bit ids, n_a, n_b, of tokens
        over the same bytes."""
        length_a, length_b, named = self.length_a, self.length_b, self.named
        x, y = a[0], b[0]
        links, groups, own, other, i, j, ahead = [x, y], [], named[x], named[y], 0, 0, length_a[x] - length_b[y]
        while True:
            if ahead == 0:
                groups.append(own + "|" + other)
                i += 1
                j += 1
                if i == len(a):
                    return ";".join(groups).encode(), array("H", links).tobytes(), i, j
                x, y = a[i], b[j]
                own, other, ahead = named[x], named[y], length_a[x] - length_b[y]
            elif ahead < 0:
                i += 1
                x = a[i]
                own += "," + named[x]
                ahead += length_a[x]
            else:
                j += 1
                y = b[j]
                other += "," + named[y]
                ahead -= length_b[y]
            links += (x, y)

    def _encode(self, texts: list[str]) -> list[tuple | None]:
        """Of pieces of text (with ``whole`` a space and all of it each); None
        where the bytes of B are not those of the text (A keeps every byte)."""
        out = []
        # The vocabulary itself sets a space before a text; a line feed stops that space from joining what follows.
        spaced = [self.whole or len(t) > 1 and t[0] == " " for t in texts]
        pieces = self.b.encode([t[1:] if x else "\n" + t for t, x in zip(texts, spaced)], num_threads=1)
        for text, x, b in zip(texts, spaced, pieces):
            b = b if x else b[2:]
            same = b"".join([self.bytes_b[y] for y in b]) == text.encode()
            out.append(self.align(self.a.encode_ordinary(text), b) if same else None)
        return out

    def _learn(self, words: list[list[str]]) -> list[tuple | None]:
        """Of words given as their parts; unknown parts are encoded together."""
        known = self.parts
        new = list({p for parts in words for p in parts if p not in known})
        made = self._encode(new)
        known.update(zip(new, made))
        self.held += sum([len(x[0]) + len(x[1]) + 300 for x in made if x])
        out = []
        for parts in words:
            found = [known[p] for p in parts]
            out.append(None if None in found else found[0] if len(found) == 1 else _joined(found))
        for p in new:
            if len(p) > LONGEST:
                del known[p]
        return out

    def __call__(self, text: str | None) -> tuple[bytes, bytes, int, int] | None:
        """Of a space and the whole text; None without tokens."""
        if not text:
            return None
        try:
            text.encode()
        except UnicodeEncodeError:
            return None
        if self.held > KEPT:
            self.words.clear()
            self.parts.clear()
            self.held = 0
        if self.whole:
            return self._encode([" " + text])[0]
        if _LOOSE.search(text) or text[0] == " ":
            return self._learn([_CUT.split(" " + text)])[0]
        words = text.split(" ")
        found = list(map(self.words.get, words))
        new = list({w for w, x in zip(words, found) if x is None})
        if new:
            made = dict(zip(new, self._learn([_CUT.split(" " + w) for w in new])))
            if None in made.values():
                return None
            found = [made[w] if x is None else x for w, x in zip(words, found)]
            short = [(w, x) for w, x in made.items() if len(w) <= LONGEST]
            self.words.update(short)
            self.held += sum([len(x[0]) + len(x[1]) + 300 for _, x in short])
        return _joined(found)


def _joined(found: list[tuple]) -> tuple[bytes, bytes, int, int]:
    return (b";".join([x[0] for x in found]), b"".join([x[1] for x in found]),
            sum([x[2] for x in found]), sum([x[3] for x in found]))


_PAIRS: dict[tuple[str, str], Pair] = {}


def vocabulary(name: str) -> str:
    """The place of a public vocabulary where this is called (in the worker)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pair_of(name_a: str, name_b: str) -> Pair:
    """One pair of vocabularies for each worker process."""
    if (name_a, name_b) not in _PAIRS:
        _PAIRS[name_a, name_b] = Pair(vocabulary(name_a), vocabulary(name_b))
    return _PAIRS[name_a, name_b]


def bitmaps(keys: np.ndarray, docs: np.ndarray, size: int) -> dict[str, object]:
    """pair (ascending), plane, n and bitmap of sorted, distinct (key, doc):
    parallel lists; ``keys`` hold the pair and its plane."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    n = np.diff(np.concatenate([start, [len(keys)]]))
    bits = (size + 7) // 8
    dense = 2 * n > bits
    out_size = np.where(dense, bits, 2 * n)
    offsets = np.concatenate([[0], np.cumsum(out_size)]).astype(np.int64)
    data = np.zeros(offsets[-1], np.uint8)
    of = np.repeat(dense, n)
    at = np.repeat(offsets[:-1], n)
    light = ~of
    rank = np.arange(len(keys)) - np.repeat(start, n)
    place = at[light] + 2 * rank[light]
    data[place], data[place + 1] = docs[light] & 255, docs[light] >> 8
    np.bitwise_or.at(data, at[of] + (docs[of] >> 3), (1 << (docs[of] & 7)).astype(np.uint8))
    return {"keys": keys[start], "n": n, "dense": dense, "offsets": offsets, "data": data}


def postings(links: np.ndarray, docs: np.ndarray, size: int) -> dict[str, object]:
    """Planes of a block's links: pair ids (a << 16 | b) and their documents."""
    both, many = np.unique(links.astype(np.uint64) << np.uint64(16) | docs.astype(np.uint64), return_counts=True)
    pair, doc, more = both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.int64), many - 1
    keys, own = [pair << np.uint64(8)], [doc]
    for j in range(int(more.max(initial=0)).bit_length()):
        has = (more >> j) & 1 == 1
        keys.append(pair[has] << np.uint64(8) | np.uint64(j + 1))
        own.append(doc[has])
    keys, own = np.concatenate(keys), np.concatenate(own)
    order = np.argsort(keys, kind="stable")
    return bitmaps(keys[order], own[order], size)


FIELDS = ("block bigint, doc int, {key}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
          "a int, b int, plane int, n bigint, dense boolean, bitmap binary")


def index(df: DataFrame, key: str = "doc_id", text: str = "text",
          name_a: str = VOCABULARY_A, name_b: str = VOCABULARY_B) -> DataFrame:
    """The inverted index, written: rows of documents (block, doc, key and its
    figures; a null) and of bitmaps (block, a, b, plane, n, dense, bitmap)."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = FIELDS.format(key=f"key {rows.schema['key'].dataType.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(name_a, name_b)
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        held: list[tuple] = []
        links: list[bytes] = []
        size, kind = 0, pa.null()

        def fields(rows_: int, /, **own: pa.Array) -> pa.RecordBatch:
            types = {"block": pa.int64(), "doc": pa.int32(), "key": kind, "n_a": pa.int64(), "n_b": pa.int64(),
                     "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "a": pa.int32(),
                     "b": pa.int32(), "plane": pa.int32(), "n": pa.int64(), "dense": pa.bool_(), "bitmap": pa.binary()}
            return pa.RecordBatch.from_arrays([own[c].cast(t) if c in own else pa.nulls(rows_, t) for c, t in types.items()],
                                              names=list(types))

        def out() -> Iterator[pa.RecordBatch]:
            where = pa.array(np.full(len(held), block))
            yield fields(len(held), block=where, doc=pa.array(np.arange(len(held))),
                         **{c: pa.array([h[i] for h in held], *([kind] if c == "key" else []))
                            for i, c in enumerate(("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"))})
            ids = np.frombuffer(b"".join(links), np.uint16).astype(np.uint64)
            own = np.repeat(np.arange(len(held)), [h[4] for h in held])
            made = postings(ids[0::2] << np.uint64(16) | ids[1::2], own, len(held))
            keys, offsets = made["keys"], made["offsets"]
            for s in range(0, len(keys), 1 << 16):
                e = min(s + (1 << 16), len(keys))
                part = keys[s:e]
                raw = pa.Array.from_buffers(pa.binary(), e - s, [
                    None, pa.py_buffer((offsets[s:e + 1] - offsets[s]).astype(np.int32).tobytes()),
                    pa.py_buffer(made["data"][offsets[s]:offsets[e]].tobytes())])
                yield fields(e - s, block=pa.array(np.full(e - s, block)), a=pa.array((part >> np.uint64(24)).astype(np.int32)),
                             b=pa.array(((part >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int32)),
                             plane=pa.array((part & np.uint64(255)).astype(np.int32)), n=pa.array(made["n"][s:e]),
                             dense=pa.array(made["dense"][s:e]), bitmap=raw)

        gc.disable()  # nothing here refers to itself, and the kept words would be walked again and again
        for batch in batches:
            kind = batch.schema.field(0).type
            for key_, text_ in zip(batch.column(0), batch.column(1)):
                found = pair(text_.as_py())
                if found is None:
                    held.append((key_.as_py(), 0, 0, 0, 0, ""))
                else:
                    groups, own, n_a, n_b = found
                    held.append((key_.as_py(), n_a, n_b, groups.count(b";") + 1, len(own) // 4,
                                 hashlib.sha256(groups).hexdigest()))
                    links.append(own)
                    size += len(own) // 4
                if len(held) == DOCS or size >= LINKS:
                    yield from out()
                    block, size = block + 1, 0
                    held.clear()
                    links.clear()
        if held:
            yield from out()
        gc.enable()

    return materialize(rows.mapInArrow(run, schema), "pair-index")


def pair_scores(indexed: DataFrame) -> DataFrame:
    """a, b, count (documents) of every pair, and best: whether no other pair
    of its A id has a higher one (an A id has at most as many pairs as B ids)."""
    counts = indexed.where("plane = 0").groupBy("a", "b").agg(F.sum("n").alias("count"))
    best = F.max("count").over(Window.partitionBy("a"))
    return counts.withColumn("best", (F.col("count") == best).cast("long"))


def _members(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Documents of all bitmaps, and the row of each."""
    raw = rows["bitmap"].combine_chunks()
    raw = raw if isinstance(raw, pa.Array) else pa.concat_arrays(raw.chunks)
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    dense = rows["dense"].to_numpy()
    length = np.diff(offsets)
    docs, of = [], []
    light = np.flatnonzero(~dense)
    n = length[light] // 2
    at = np.repeat(offsets[light] - 2 * (np.cumsum(n) - n), n) + 2 * np.arange(n.sum())
    docs.append(data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8)
    of.append(np.repeat(light, n))
    for i in np.flatnonzero(dense).tolist():
        own = np.flatnonzero(np.unpackbits(data[offsets[i]:offsets[i + 1]], bitorder="little"))
        docs.append(own)
        of.append(np.full(len(own), i))
    return np.concatenate(docs), np.concatenate(of)


def align(df: DataFrame, key: str = "doc_id", text: str = "text",
          name_a: str = VOCABULARY_A, name_b: str = VOCABULARY_B) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of
    every row."""
    indexed = index(df, key, text, name_a, name_b)
    scores = materialize(pair_scores(indexed), "pair-scores")
    kind = indexed.schema["key"].dataType.simpleString()
    weight = F.expr("CASE WHEN plane = 0 THEN 1L ELSE shiftleft(1L, plane - 1) END")
    sent = (indexed.where("a IS NOT NULL").join(scores, ["a", "b"])
            .select("block", "dense", "bitmap", (weight * F.col("count")).alias("n_a"), (weight * F.col("best")).alias("n_b")))
    own = indexed.where("a IS NULL").select("block", "doc", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def run(rows: pa.Table) -> pa.Table:
        lacks = rows["dense"].is_null()
        docs = rows.filter(lacks).sort_by("doc")
        marks = rows.filter(rows["dense"].is_valid())
        count, best = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        if marks.num_rows:
            member, of = _members(marks)
            np.add.at(count, member, marks["n_a"].to_numpy()[of])
            np.add.at(best, member, marks["n_b"].to_numpy()[of])
        return pa.table({**{c: docs[c] for c in ("key", "n_a", "n_b", "n_groups", "n_links")}, "n_best": pa.array(best),
                         "count_sum": pa.array(count), "groups_sha256": docs["groups_sha256"]})

    return (own.unionByName(sent, allowMissingColumns=True).groupBy("block").applyInArrow(
        run, f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
             "groups_sha256 string").withColumnRenamed("key", key))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of every document under the public vocabularies."""
    return align(table(spark, sf_dir, "documents"))
