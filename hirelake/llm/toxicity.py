"""Toxicity: a linear-chain conditional random field over the tokens of a text.

Labelled documents say which texts are toxic. From a bounded, hashed sample of
them (``TRAIN_ROWS`` rows at most for each label) token labels are derived: the
fewest words and word beginnings that cover the toxic documents and are nearly
absent from the clean ones mark their tokens as toxic. A two-state CRF (clean,
toxic) with one weight for each such feature, a bias and transition weights is
fitted to these token labels on the whole texts of all drawn rows; its forward-backward marginals at the tokens of
a document are aggregated (largest log-odds, expected number of toxic tokens)
and a logistic layer turns them into the document's score.

Scoring reads whole texts, one Arrow batch at a time, without a shuffle. Runs
of tokens without a feature all have the same potentials, so forward and
backward messages cross a run by a power of one 2x2 matrix: exact marginals at
a cost that follows the number of tokens with features.

Defined cases: null, empty or wordless text: no tokens, scored by the logistic
layer's bias, no spans; no labelled rows (or one label only): score 0
everywhere; repeated rows, null ids and further columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, fold, give_back, table

#: Labelled rows read at most, for each label.
TRAIN_ROWS = 1500
#: Word beginnings used as features, by length.
PREFIXES = (4, 5, 6)
#: A feature needs this many times the rate in toxic documents, ...
MIN_RATIO = 25.0
#: ... this many toxic documents that no feature has covered yet, and there are at most MAX_FEATURES.
MIN_COVER, MAX_FEATURES = 4, 2000
#: Share of the toxic documents that makes a feature the cover did without worth tagging, and the number of neutral words
#: that may be taken for such features by chance, over all words tried.
MIN_SHARE, BY_CHANCE = 0.01, 0.001
WORD_CACHE = 200_000
WORD = re.compile(r"[^\W_]+")


@lru_cache(20_000)
def features(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings."""
    w = word.lower()
    return (f"={w}", *(w[:n] for n in PREFIXES if len(w) >= n))


@dataclass
class Model:
    #: Log-odds weight of each feature for the toxic state.
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    #: Log-potentials of a step from state i to state j.
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: Logistic layer: bias, largest log-odds, log of 1 + expected toxic tokens; None: nothing learned.
    layer: tuple[float, float, float] | None = None


class Tagger:
    """Marginals of the toxic state at the tokens that have a feature."""

    def __init__(self, model: Model):
        self.model = model
        self.cache: dict[str, float] = {}
        step = np.exp(model.steps + np.array([0.0, model.bias]))
        values, vectors = np.linalg.eig(step)
        order = np.argsort(-np.abs(values))
        self.ratio = float((values[order[1]] / values[order[0]]).real)
        v = vectors[:, order].real
        w = np.linalg.inv(v)
        # step ** g is, up to a factor, first + ratio ** g * second
        self.first, self.second = np.outer(v[:, 0], w[0]).tolist(), np.outer(v[:, 1], w[1]).tolist()
        self.steps = np.exp(model.steps).tolist()
        self.open = exp(model.bias)

    def _weight(self, word: str) -> float:
        get = self.model.weights.get
        total = sum(get(f, 0.0) for f in features(word))
        if len(word) <= 40:
            self.cache[word] = total
        return total

    def _cross(self, gap: int) -> list[list[float]]:
        r = self.ratio ** gap
        a, b = self.first, self.second
        return [[a[0][0] + r * b[0][0], a[0][1] + r * b[0][1]], [a[1][0] + r * b[1][0], a[1][1] + r * b[1][1]]]

    def __call__(self, text: str | None) -> list[tuple[int, float]]:
        """(token number, marginal) of every token with a feature."""
        words = WORD.findall(text) if text else []
        if len(self.cache) > WORD_CACHE:
            self.cache.clear()
        get, make = self.cache.get, self._weight
        score = [make(w) if (v := get(w)) is None else v for w in words]
        hits = [i for i, v in enumerate(score) if v]
        if not hits:
            return []
        # Forward messages just before each hit's own potential, then backward ones just after it.
        forward, at = [], -1
        a = [1.0, 0.0]  # as if a clean token stood before the text
        for i in hits:
            m = self._cross(i - at - 1)
            a = [a[0] * m[0][0] + a[1] * m[1][0], a[0] * m[0][1] + a[1] * m[1][1]]
            s = self.steps
            a = [a[0] * s[0][0] + a[1] * s[1][0], (a[0] * s[0][1] + a[1] * s[1][1]) * self.open * exp(min(score[i], 30.0))]
            total = a[0] + a[1]
            a = [a[0] / total, a[1] / total]
            forward.append(a)
            at = i
        out, b, at = [], [1.0, 1.0], len(words)
        for k in range(len(hits) - 1, -1, -1):
            i = hits[k]
            if at < len(words):  # through the next hit
                s, e = self.steps, self.open * exp(min(score[at], 30.0))
                b = [s[0][0] * b[0] + s[0][1] * e * b[1], s[1][0] * b[0] + s[1][1] * e * b[1]]
            m = self._cross(at - i - 1)
            b = [m[0][0] * b[0] + m[0][1] * b[1], m[1][0] * b[0] + m[1][1] * b[1]]
            total = b[0] + b[1]
            b = [b[0] / total, b[1] / total]
            f = forward[k]
            out.append((i, f[1] * b[1] / (f[0] * b[0] + f[1] * b[1])))
            at = i
        return out[::-1]


def summary(marginals: list[tuple[int, float]]) -> tuple[float, float]:
    """What the logistic layer sees: the largest log-odds of a token, and the
    logarithm of 1 + the expected number of toxic tokens."""
    top = max((p for _, p in marginals), default=0.0)
    top = min(max(top, 1e-6), 1 - 1e-6)
    return log(top / (1 - top)) / 14, log1p(sum(p for _, p in marginals))


def choose_features(rows: list[tuple[int, str]]) -> dict[str, float]:
    """Greedy cover of the toxic texts by features that are rare in the clean
    ones, with their log-odds."""

    def of(text: str) -> set[str]:
        return {f for w in set(WORD.findall(text)) for f in features(w)}

    toxic = [t for y, t in rows if y]
    clean = len(rows) - len(toxic)
    often = Counter(x for t in toxic for x in of(t))
    where: dict[str, set[int]] = {x: set() for x, n in often.items() if n >= MIN_COVER}
    for i, t in enumerate(toxic):
        for x in of(t) & where.keys():
            where[x].add(i)
    in_clean = Counter(x for y, t in rows if not y for x in of(t) & where.keys())

    def ratio(x: str) -> float:
        return (len(where[x]) + 0.5) / (len(toxic) + 1) * (clean + 1) / (in_clean[x] + 0.5)

    where = {x: w for x, w in where.items() if ratio(x) >= MIN_RATIO}
    open_docs, chosen, least = set(range(len(toxic))), {}, 0
    while where and len(chosen) < MAX_FEATURES:
        # Ties: the longer feature says more about the token, then by name.
        x = max(where, key=lambda f: (len(where[f] & open_docs), len(f.lstrip("=")), f))
        if len(where[x] & open_docs) < MIN_COVER:
            break
        chosen[x] = log(ratio(x))
        least = min(least or len(where[x]), len(where[x]))
        open_docs -= where.pop(x)
    # Then the features that the cover did without: as rare in clean documents, in more toxic ones than any word that
    # stands in documents regardless of their label would be by chance and than the rarest feature of the cover (what
    # explains no document of its own needs as much support as what does), and beside ever other words (copies of one
    # toxic document share all their words, and so their neighbours).
    share = len(toxic) / len(rows)
    rest = {x for x, w in where.items() if len(w) >= max(MIN_COVER, MIN_SHARE * len(toxic), least) and not in_clean[x]
            and len(often) * share ** len(w) <= BY_CHANCE}
    beside: dict[str, set[tuple]] = {x: set() for x in rest}
    for t in toxic:
        words = WORD.findall(t)
        for i, w in enumerate(words):
            for x in rest.intersection(features(w)):
                beside[x].add((*words[max(0, i - 1):i], *words[i + 1:i + 2]))
    for x in sorted(rest, key=lambda f: (-len(where[f]), f))[:max(0, MAX_FEATURES - len(chosen))]:
        if len(beside[x]) >= 0.7 * len(where[x]):
            chosen[x] = log(ratio(x))
    return chosen


def segments(text: str, number: dict[str, int]) -> tuple[list[int], list[list[int]]]:
    """A whole text as the CRF's fit sees it: the plain tokens before each
    token with a feature and after the last one, and the feature numbers of
    the tokens with features."""
    gaps, hits, gap = [], [], 0
    for w in WORD.findall(text):
        found = [number[f] for f in features(w) if f in number]
        if found:
            gaps.append(gap)
            hits.append(found)
            gap = 0
        else:
            gap += 1
    return [*gaps, gap], hits


def fit_crf(sequences: list[tuple[list[int], list[list[int]], int]], start: np.ndarray, rounds: int = 40) -> tuple:
    """Weights, bias and transitions that maximise the likelihood of token
    labels; a sequence is what ``segments`` returns and the label of its tokens
    with features (plain tokens are clean). All sequences move through the
    forward-backward recursion together, and a run of plain tokens is one step:
    its matrix power and the expected transitions inside it have closed forms
    in the eigenvectors of a plain step, so whole texts cost what their tokens
    with features cost. Without sequences the start values stay."""
    n = len(start)
    theta = np.concatenate([start, [-4.0, 0.0, 0.0, 0.0, 0.0]])  # weights, bias, steps 00 01 10 11
    if not sequences:
        return theta[:n], float(theta[n]), theta[n + 1:].reshape(2, 2)
    sequences = sorted(sequences, key=lambda s: -len(s[1]))
    count = np.array([len(hits) for _, hits, _ in sequences])
    # Tokens with features lie by their number in the text: those of turn t are of the first ``live[t]`` sequences.
    live = (np.arange(count[0])[:, None] < count).sum(1) if count[0] else np.zeros(0, int)
    begin = np.concatenate([[0], np.cumsum(live)]).astype(int)
    gap, y = np.zeros(begin[-1], int), np.zeros(begin[-1])
    tail, token, feature = np.zeros(len(sequences), int), [], []
    seen = np.zeros((2, 2))
    for i, (gaps, hits, label) in enumerate(sequences):
        before = 0
        for t, (g, found) in enumerate(zip(gaps, hits)):
            at = begin[t] + i
            gap[at], y[at] = g, label
            token += [at] * len(found)
            feature += found
            if g:
                seen[before, 0] += 1
                seen[0, 0] += g - 1
                before = 0
            seen[before, label] += 1
            before = label
        tail[i] = gaps[-1]
        if gaps[-1]:
            seen[before, 0] += 1
            seen[0, 0] += gaps[-1] - 1
    token, feature = np.array(token, int), np.array(feature, int)

    def inside(f: np.ndarray, c: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Expected transitions inside runs of ``g`` plain tokens between the messages f and c."""
        left, right, far = f @ vectors, c @ inverse.T, ratio ** g
        total = left[:, 0] * right[:, 0] + far * left[:, 1] * right[:, 1]
        cross = (1 - far) / (1 - ratio)
        mass = np.array([[g, cross], [cross, g * ratio ** np.maximum(g - 1, 0)]])
        mass = np.einsum("sp,sq,pqs,s->pq", left, right, mass, 1 / total)
        return plain * (inverse.T @ mass @ vectors.T)

    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        move = np.exp(theta[n + 1:].reshape(2, 2))
        plain = move * np.array([1.0, exp(min(max(theta[n], -30.0), 30.0))])
        values, vectors = np.linalg.eig(plain)
        order = np.argsort(-np.abs(values))
        values, vectors = values[order].real, vectors[:, order].real
        inverse, ratio, plain = np.linalg.inv(vectors), float(values[1] / values[0]), plain / values[0]
        power = lambda g: np.einsum("ip,gp,pj->gij", vectors, np.stack([np.ones(len(g)), ratio ** g], 1), inverse)
        score = np.full(len(gap), theta[n])
        np.add.at(score, token, theta[feature])
        emit = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], 1)
        hit = move * emit[:, None, :]
        turn = power(gap) @ hit
        alpha, beta = np.empty_like(emit), np.empty_like(emit)  # before a token's run, after the token
        a = np.tile([1.0, 0.0], (len(sequences), 1))
        for t, k in enumerate(live):
            alpha[begin[t]:begin[t + 1]] = a[:k]
            x = np.einsum("si,sij->sj", a[:k], turn[begin[t]:begin[t + 1]])
            a[:k] = x / x.sum(1, keepdims=True)
        b = power(tail).sum(2)
        for t in range(len(live) - 1, -1, -1):
            k = live[t]
            beta[begin[t]:begin[t + 1]] = b[:k]
            x = np.einsum("sij,sj->si", turn[begin[t]:begin[t + 1]], b[:k])
            b[:k] = x / x.sum(1, keepdims=True)
        pair = np.einsum("si,sij->sj", alpha, power(gap))[:, :, None] * hit * beta[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        expected = (pair.sum(0) + inside(alpha, np.einsum("sij,sj->si", hit, beta), gap)
                    + inside(a, np.ones_like(a), tail))
        grad = -0.01 * theta
        grad[n] += y.sum() - expected[:, 1].sum()
        np.add.at(grad, feature, (y - pair[:, :, 1].sum(1))[token])
        grad[n + 1:] += (seen - expected).ravel()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta += 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:n], float(theta[n]), theta[n + 1:].reshape(2, 2)


def fit_layer(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small ridge."""
    z = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (weight * (y - p)) - 0.05 * w
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(3)
        w = w + np.linalg.solve(h, g)
    return tuple(float(v) for v in w)


def fit(rows: list[tuple[int, str]], toxic_share: float) -> Model:
    """Model from (label, whole text) rows, with the share of toxic rows among
    all labelled ones."""
    if len({y for y, _ in rows}) < 2:
        return Model()
    chosen = choose_features(rows)
    number = {f: i for i, f in enumerate(chosen)}
    picked = [(*segments(t, number), label) for label, t in rows]
    start = np.array(list(chosen.values()), float)
    weights, bias, steps = fit_crf(picked, start)
    model = Model({f: float(weights[i]) for f, i in number.items()}, bias, steps)
    tagger = Tagger(model)
    x = np.array([summary(tagger(t)) for _, t in rows])
    y = np.array([label for label, _ in rows], float)
    share = y.mean()
    weight = np.where(y == 1, toxic_share / share, (1 - toxic_share) / (1 - share))
    model.layer = fit_layer(x, y, weight)
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled keys of each label (null labels and
    texts are left out). The keys are drawn from ``labels`` alone and meet the
    texts in one scan, by a broadcast of at most 2 * ``rows`` keys; of a key
    that documents repeat, the text with the smallest hash counts."""
    usable = labels.select(key, label).where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    counts = {r[label]: r["n"] for r in usable.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model()
    drawn = bounded_sample(usable.where(F.col(label) == 0), rows, key).unionByName(
        bounded_sample(usable.where(F.col(label) == 1), rows, key))
    got = [(r[label], r["key"], r[text]) for r in
           docs.select(F.col(key).alias("key"), text).where(F.col(text).isNotNull())
           .join(F.broadcast(drawn.withColumnRenamed(key, "key")), "key")
           .groupBy("key", label).agg(F.min_by(text, F.struct(F.xxhash64(text), F.col(text))).alias(text)).toLocalIterator()]
    got.sort(key=lambda r: (r[0], str(r[1]), r[2]))
    order = np.random.default_rng(11).permutation(len(got))
    return fit([(got[i][0], got[i][2]) for i in order], counts[1] / (counts[0] + counts[1]))


SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))


def score_text(tagger: Tagger, text: str | None) -> tuple[float, list[dict]]:
    """Score of a whole text, and the offsets (in code points) of the tokens
    that are more likely toxic than not."""
    layer = tagger.model.layer
    if layer is None:
        return 0.0, []
    marginals = tagger(text)
    top, total = summary(marginals)
    score = 1 / (1 + exp(-max(-30.0, min(30.0, layer[0] + layer[1] * top + layer[2] * total))))
    bad = {i: p for i, p in marginals if p >= 0.5}
    spans = [{"begin": m.start(), "end": m.end(), "marginal": bad[i]}
             for i, m in enumerate(WORD.finditer(text)) if i in bad] if bad else []
    return score, spans


def score(df: DataFrame, model: Model, text: str = "text", only_clean: bool = False) -> DataFrame:
    """``df`` with the columns score, predicted and spans (columns of these
    names are replaced); with ``only_clean`` the rows predicted clean, as they
    came."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # MAX_FEATURES weights at most
    added = [] if only_clean else ["score", "predicted", "spans"]
    kept = [c for c in df.columns if c not in added]
    rows = df.select(*kept)
    at = kept.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    extra = "" if only_clean else ", score double, predicted int, spans array<struct<begin:int,end:int,marginal:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            found = [score_text(tagger, t.as_py()) for t in batch.column(at)]
            if only_clean:
                yield batch.filter(pa.array([s < 0.5 for s, _ in found], pa.bool_()))
                continue
            columns = [*batch.columns, pa.array([s for s, _ in found], pa.float64()),
                       pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([x for _, x in found], SPANS)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])
        features.cache_clear()
        give_back()

    return rows.mapInArrow(run, schema + extra)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(fold(key, 5) == 0, F.lit(False))


def learn(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """Model from the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")
    return train(docs, labels)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, learn(spark, docs, sf_dir)).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", "spans")


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents not predicted toxic."""
    return score(docs, learn(spark, docs, sf_dir), only_clean=True)
