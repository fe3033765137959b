"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its words' byte n-grams (hashed to a
fixed number of buckets); a linear layer and a softmax give the language.
Embeddings and layer are trained together by stochastic gradient descent in
numpy on a bounded sample of labelled texts, drawn for each language by itself
(``LANG_TEXTS`` distinct ones at most), so that a rare language is learned too
and copies count once; a held-back part of each language's texts calibrates the
temperature of the score and the rejection threshold.

At prediction the linear layer is folded into the buckets (logit of a text =
mean of its buckets' logits), so a gram costs one table lookup, and the model
that travels to the tasks is ``buckets x languages`` floats. Texts are
read whole, one Arrow batch at a time, without a shuffle.

Defined cases: null text or no letter: ``und`` with score 0; no labelled rows:
``und`` everywhere; repeated rows and null ids are predicted like any other;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold, materialize, table

BUCKETS = 1 << 15
DIM = 16
NGRAMS = (2, 3, 4)
#: Bytes of a text hashed at a time, so that memory does not grow with a text.
CHUNK = 1 << 18
#: Distinct texts read at most for each language (3,000 of four languages); the
#: fit runs on the driver over their hashed counts (at most BUCKETS numbers a
#: text), never over the corpus.
LANG_TEXTS = 750
EPOCHS = 4
LEARNING_RATE = 2.0
#: Share of calibration rows whose score may fall below the rejection threshold.
REJECT_SHARE = 0.01


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte n-grams inside the words of a text, borders marked
    by a space; a gram with a space between its ends is no subword."""
    raw = f" {' '.join(text.lower().split())} ".encode("utf-8", "replace")
    last = max(NGRAMS) - 1
    for start in range(0, len(raw), CHUNK):
        b = np.frombuffer(raw[start:start + CHUNK + last], np.uint8).astype(np.uint32)
        space = b == 32
        for n in NGRAMS:
            m = min(CHUNK, len(b) - n + 1)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint32)
            inside = np.zeros(m, bool)
            for i in range(n):
                h = (h ^ b[i:i + m]) * np.uint32(16777619)
                if 0 < i < n - 1:
                    inside |= space[i:i + m]
            h ^= h >> 15
            yield (h % BUCKETS)[~inside].astype(np.int64)


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and how often each occurs."""
    counts = np.zeros(BUCKETS)
    for ids in subwords(text):
        counts += np.bincount(ids, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # buckets x languages
    temperature: float
    reject_below: float


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """Model from (language, buckets, counts) rows."""
    languages = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), 1.0, 0.0)
    label = {lang: i for i, lang in enumerate(languages)}
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    out = rng.normal(0, 0.1, (DIM, len(languages)))
    rows = [rows[i] for i in rng.permutation(len(rows))]
    held, train, met = [], [], dict.fromkeys(languages, 0)
    for r in rows:  # every fifth text of a language is held back
        met[r[0]] += 1
        (train if met[r[0]] % 5 else held).append(r)
    # A pass meets every language equally often: rows of one with few texts come again.
    of = [np.array([i for i, r in enumerate(train) if r[0] == lang]) for lang in languages]
    size = max(map(len, of))
    steps, done = EPOCHS * size * len(languages), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(np.concatenate([np.resize(rng.permutation(x), size) for x in of])):
            lang, ids, counts = train[i]
            rate = LEARNING_RATE * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            weight = counts / counts.sum()
            mean = weight @ emb[ids]
            z = mean @ out
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[lang]] -= 1
            step = rate * (out @ p)
            out -= rate * np.outer(mean, p)
            emb[ids] -= weight[:, None] * step
    logits = emb @ out
    scores = [(label[lang], (c / c.sum()) @ logits[ids]) for lang, ids, c in (held or train) if len(ids)]
    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0),
                      key=lambda t: -sum(_log_softmax(z / t)[y] for y, z in scores))
    best = [float(np.exp(_log_softmax(z / temperature).max())) for y, z in scores if int(np.argmax(z)) == y]
    reject = float(np.quantile(best, REJECT_SHARE)) if best else 0.0
    return Model(languages, logits, temperature, reject)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max()
    return z - np.log(np.exp(z).sum())


def predict_text(model: Model, text: str | None) -> tuple[str, float, bool]:
    """Language of a whole text, its score, and whether the score clears the
    rejection threshold."""
    if text is None or not model.languages or not any(map(str.isalpha, text)):
        return "und", 0.0, False
    total, n = np.zeros(len(model.languages)), 0
    for ids in subwords(text):
        total += np.take(model.logits, ids, axis=0).sum(0)
        n += len(ids)
    p = np.exp(_log_softmax(total / max(n, 1) / model.temperature))
    best = int(np.argmax(p))
    score = float(min(1.0, p[best]))
    return model.languages[best], score, score >= model.reject_below


def draw(labelled: DataFrame, text: str = "text", lang: str = "lang", texts: int = LANG_TEXTS) -> DataFrame:
    """text, lang: the ``texts`` distinct texts of each language with the
    smallest hashes, whatever the partitioning; all of a language with fewer.
    Only hashes are compared: a share of them in which a language has about
    twice the texts wanted is ranked, and the drawn ones meet the texts by a
    broadcast. Copies combine before they are shuffled."""
    rows = (labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where(F.col("text").isNotNull() & F.col("lang").isNotNull())
            .withColumn("h", F.xxhash64("lang", "text")))
    keys = materialize(rows.select("lang", "h").distinct(), "language-keys")
    n = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = (F.col("h").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    near = keys.join(F.broadcast(n), "lang").where(place <= F.lit(2.0 * texts + 100) / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = near.withColumn("rank", rank).where(F.col("rank") <= texts).select("lang", "h")
    return (rows.join(F.broadcast(drawn), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
            .select("text", "lang"))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", texts: int = LANG_TEXTS) -> Model:
    """Fit on at most ``texts`` distinct texts of each language; tasks hash the
    whole texts, the driver sees bucket counts."""
    sample = draw(labelled, text, lang, texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for t, g in zip(texts, langs):
                ids, n = bucket_counts(t)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [g], "ids": [ids.astype("<i4").tobytes()], "n": [n.astype("<f4").tobytes()]},
                    schema=pa.schema([("lang", pa.string()), ("ids", pa.binary()), ("n", pa.binary())]))

    got = sample.mapInArrow(count, "lang string, ids binary, n binary").collect()
    got.sort(key=lambda r: (r["lang"], len(r["ids"]), r["ids"]))
    return fit([(r["lang"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["n"], "<f4")) for r in got])


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, lang_pred, score, accepted for every row of ``df``."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages floats
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [predict_text(model, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                names=["key", "lang_pred", "score", "accepted"])

    out = rows.mapInArrow(run, f"key {key_type}, lang_pred string, score double, accepted boolean")
    return out.withColumnRenamed("key", key)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(fold(key, 4) == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
