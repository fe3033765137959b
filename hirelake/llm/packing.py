"""Packing: token streams cut into fixed windows by dynamic programming.

The documents of an input partition, in their order, form one stream of token
ids (every document ends with an end id). The stream is cut into windows of at
most ``WINDOW`` tokens. Cuts are considered at document ends (free), sentence
ends and, inside long sentences, every ``STRIDE`` tokens; a cut inside a
document costs a truncation penalty, a window costs its padding. With c the
cut positions and W the window,

    f(j) = penalty(j) + W - c[j] + min { f(i) + c[i] : c[j] - W <= c[i] < c[j] }

whose sliding minimum a monotone queue gives in constant time per cut. The
stream is solved a region of ``REGION`` tokens at a time (what lies behind the
region's best cut moves to the next one), so memory does not grow with the
partition or with a document. A window of a power-of-two length is not padded;
the last window of a stream is split into such lengths where that costs less.

Nothing is shuffled: each task packs the rows it reads, so no key, however
frequent, gathers rows in one task, and a lost task is simply run again. The
order of documents is the input's; sort the table first for another order.

Defined cases: null text is an empty text (its end id is still packed), null
and repeated ids are packed as separate rows, an empty table gives no rows,
further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, table

WINDOW = 2048
END_ID = 1
REGION = 48 * WINDOW
#: Furthest distance of two cut positions.
STRIDE = 32
SENTENCE_PENALTY, TRUNCATION_PENALTY, SEQUENCE_PENALTY = 2, 12, 16
VOCABULARY = "word_bpe_49k.json"
#: Words and word parts whose ids a task keeps, none longer than LONGEST characters; both start anew when full, and are
#: given back when the task ends (about 30 MB each).
WORD_CACHE, LONGEST = 200_000, 40

# The vocabulary's own white space, word parts and specials.
SPACE = re.compile("[" + "".join(map(chr, (
    9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_²³¹¼½¾]+|[\\d²³¹¼½¾]|(?:[^\\w²³¹¼½¾]|_)+")
PLAIN = re.compile("[!-~\xa1-įı-ſ]*")
UNIT_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split, not to the vocabulary
SPECIAL = re.compile(r"<\|(?:start|end)oftext\|>")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write every byte as one printable letter."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(kept))
    return {**{b: chr(b) for b in kept}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, word by word: the
    vocabulary drops white space, so a text's ids are its words' ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def sentence_ends(self) -> np.ndarray:
        """By id: whether the token closes a sentence."""
        vocab = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            ends[i] = bool(re.fullmatch(r"[^\w]*[.!?][^\w]*</w>", token))
        return ends

    def _part(self, part: str) -> bytes:
        raw = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(raw)], "<u4").tobytes()
        if len(part) <= LONGEST:
            self.parts[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and not SPECIAL.search(word):
            get, make = self.parts.get, self._part
            ids = b"".join([make(p) if (v := get(p)) is None else v for p in PARTS.findall(word.lower())])
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= LONGEST:
            self.words[word] = ids
        return ids

    def forget(self) -> None:
        self.words.clear()
        self.parts.clear()

    def __call__(self, text: str) -> bytes:
        for cache in (self.words, self.parts):
            if len(cache) > WORD_CACHE:
                cache.clear()
        get, make = self.words.get, self._word
        words = SPACE.split(text) if UNIT_SEPARATORS.search(text) else text.split()
        return b"".join([make(w) if (v := get(w)) is None else v for w in words])


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process and vocabulary: the name of a public one
    (found where the task runs), or a path."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers

        _ENCODERS[vocabulary] = Encoder(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    return _ENCODERS[vocabulary]


def cut_positions(ends: np.ndarray, doc_ends: np.ndarray, total: int) -> tuple[list[int], list[int]]:
    """Where a stream of ``total`` tokens may be cut and what each cut costs.
    ``ends``: positions behind sentence ends; ``doc_ends``: behind documents."""
    cost = {0: 0, total: TRUNCATION_PENALTY}
    cost.update(dict.fromkeys(ends.tolist(), SENTENCE_PENALTY))
    cost.update(dict.fromkeys(doc_ends.tolist(), 0))
    known = np.array(sorted(cost), np.int64)
    for i in np.flatnonzero(np.diff(known) > STRIDE).tolist():
        for p in range(int(known[i]) + STRIDE, int(known[i + 1]), STRIDE):
            cost[p] = TRUNCATION_PENALTY
    at = sorted(cost)
    return at, [cost[p] for p in at]


def best_cuts(at: list[int], cost: list[int], window: int, whole: bool) -> list[int]:
    """Cut positions of the cheapest windows from the start to the end
    (``whole``), or to the best cut within the last window."""
    n = len(at)
    f, came = [0] * n, [0] * n
    queue: deque[int] = deque([0])
    key = [0] * n  # f + position, what the queue is ordered by
    for j in range(1, n):
        p = at[j]
        while at[queue[0]] < p - window:
            queue.popleft()
        i = queue[0]
        came[j] = i
        v = key[i] + cost[j] + window - p + SEQUENCE_PENALTY
        f[j] = v
        v += p
        key[j] = v
        while queue and key[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    j = n - 1
    if not whole:
        last = [i for i in range(1, n) if at[i] > at[-1] - window]
        # A cut that leaves more for the next region must not look dearer: count a token as placed.
        j = min(last, key=lambda i: (f[i] - at[i] * f[n - 1] / max(at[-1], 1), -at[i]))
    cuts = []
    while j:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


def split_tail(length: int, window: int) -> list[int]:
    """Lengths of the windows for a stream's last ``length`` tokens: one
    padded window, or unpadded ones of power-of-two lengths if cheaper."""
    powers = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    extra = (len(powers) - 1) * (SEQUENCE_PENALTY + TRUNCATION_PENALTY)
    return powers if window - length > extra else [length]


class Packer:
    """Packs a stream of documents; yields the pieces of finished windows."""

    def __init__(self, sentence_ends: np.ndarray, first_sequence: int, window: int = WINDOW, region: int = REGION):
        self.ends, self.sequence, self.window, self.region = sentence_ends, first_sequence, window, region
        self.docs: list[list] = []  # key, ids, first token in the region, tokens of the document
        self.size = 0

    def add(self, key: object, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            take = min(len(ids) - start, max(1, self.region - self.size))
            self.docs.append([key, ids[start:start + take], start, len(ids)])
            self.size += take
            start += take
            if self.size >= self.region:
                yield from self.flush(False)

    def flush(self, whole: bool) -> Iterator[tuple]:
        if not self.size:
            return
        tokens = np.concatenate([d[1] for d in self.docs])
        behind = np.cumsum([len(d[1]) for d in self.docs])
        closed = np.array([d[2] + len(d[1]) == d[3] for d in self.docs])
        at, cost = cut_positions(np.flatnonzero(self.ends[tokens]) + 1, behind[closed], self.size)
        cuts = best_cuts(at, cost, self.window, whole)
        if whole:
            last = cuts[-2] if len(cuts) > 1 else 0
            cuts = cuts[:-1] + (last + np.cumsum(split_tail(self.size - last, self.window))).tolist()
        d, begin = 0, 0
        left: list[list] = []
        low = 0  # where document d begins in the region
        for cut in cuts:
            offset = 0
            while begin < cut:
                key, ids, start, total = self.docs[d]
                a, b = begin - low, min(cut - low, len(ids))
                piece = ids[a:b]
                yield key, start + a, b - a, zlib.crc32(piece.tobytes()), total, self.sequence, offset, piece
                offset += b - a
                begin += b - a
                if b == len(ids):
                    low += len(ids)
                    d += 1
            self.sequence += 1
        for key, ids, start, total in self.docs[d:]:
            skip = begin - low if not left else 0
            if skip < len(ids):
                left.append([key, ids[skip:], start + skip, total])
            low += len(ids) if left else 0
            begin = max(begin, low)
        self.docs, self.size = left, sum(len(x[1]) for x in left)


def pack(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of all windows: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and the ids themselves with ``with_ids``."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"key {key_type}, {', '.join(f'{n} bigint' for n in names)}" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        context = TaskContext.get()
        packer = Packer(encode.sentence_ends(), (context.partitionId() if context else 0) << 40)
        types = None

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([p[0] for p in pieces], types)]
            columns += [pa.array([p[i] for p in pieces], pa.int64()) for i in range(1, 7)]
            if with_ids:
                columns.append(pa.array([p[7].astype(np.int32) for p in pieces], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names=["key", *names] + ["ids"] * with_ids)

        for batch in batches:
            types = batch.schema.field(0).type
            for key, said in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(encode(said.as_py() or "") + end, "<u4")
                if pieces := list(packer.add(key.as_py(), ids)):
                    yield out(pieces)
        if pieces := list(packer.flush(True)):
            yield out(pieces)
        encode.forget()
        give_back()

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def public_vocabulary() -> str:
    """Name of the public vocabulary; each task finds its file."""
    return VOCABULARY


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_vocabulary())
