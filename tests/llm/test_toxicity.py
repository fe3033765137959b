import zlib
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import toxicity as tox

from .conftest import docs_frame, write_tables


def brute_marginals(model, words):
    """Marginals by enumerating all state sequences."""
    total, toxic = 0.0, np.zeros(len(words))
    for states in product((0, 1), repeat=len(words)):
        s, before = 0.0, 0
        for w, y in zip(words, states):
            s += model.steps[before][y] + y * (model.bias + sum(model.weights.get(f, 0.0) for f in tox.features(w)))
            before = y
        total += np.exp(s)
        toxic += np.exp(s) * np.array(states)
    return toxic / total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["plain", "rude", "Rudest", "ok", "other"]), max_size=9))
def test_marginals_match_enumeration(words):
    model = tox.Model({"=rude": 3.0, "rude": 1.5, "=ok": -1.0}, -2.0, np.array([[0.4, -0.7], [-0.3, 0.2]]), (0.0, 1.0, 1.0))
    got = dict(tox.Tagger(model)(" ".join(words)))
    want = brute_marginals(model, words)
    assert set(got) == {i for i, w in enumerate(words) if w in ("rude", "Rudest", "ok")}
    assert all(abs(p - want[i]) < 1e-9 for i, p in got.items())


def test_held_out_accuracy_and_spans(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in tox.query(spark, sf_small).collect()}
    assert got.keys() == texts.keys()
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        for s in r["spans"]:
            assert tox.WORD.fullmatch(texts[k][s["begin"]:s["end"]])
    held = [k for k in labels if k in got and got[k]["held_out"]]
    assert sum(got[k]["predicted"] == labels[k] for k in held) >= 0.9 * len(held)


def labelled(n=400):
    rows, marks = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [f"w{(i * j) % 997}" for j in range(1, 30)]
        if bad:
            words.insert(i % 20, ["nasty", "vilest", "vileness"][i % 3])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_draw_does_not_depend_on_partitions(spark):
    rows, marks = labelled(300)
    rows += [(i, f"other text of {i} {j}") for i in range(100) for j in range(3)]
    docs, marked = docs_frame(spark, rows), spark.createDataFrame(marks * 3, "doc_id long, quality int, toxic int")
    one = tox.train(docs.repartition(1), marked.repartition(1), rows=40)
    other = tox.train(docs.repartition(7), marked.repartition(5), rows=40)
    assert one.weights == other.weights and one.layer == other.layer and one.weights


def test_neutral_words_are_no_features():
    rows, marks = labelled(1000)
    model_rows = [(m[2], t) for (_, t), m in zip(rows, marks)]
    assert set(tox.choose_features(model_rows)) <= {f for w in ("nasty", "vilest", "vileness") for f in tox.features(w)}


def test_odd_rows(spark, odd, no_docs, tmp_dir):
    rows, marks = labelled()
    marked = spark.createDataFrame(marks + [(1000, 1, None), (None, 1, 1), (0, 1, 1)], "doc_id long, quality int, toxic int")
    model = tox.train(docs_frame(spark, rows + [(None, "nasty"), (1000, None)]), marked)
    got = tox.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in got)
    said = "İ some w1 w2 words Vilest here nasty!"
    row = tox.score(docs_frame(spark, [(1, said)]), model).first()
    assert row["predicted"] == 1 and [said[s["begin"]:s["end"]] for s in row["spans"]] == ["Vilest", "nasty"]
    assert tox.score(no_docs, model).count() == 0
    unlearned = tox.score(odd, tox.train(no_docs, marked.limit(0)))
    assert {r["score"] for r in unlearned.collect()} == {0.0}
    write_tables(tmp_dir, documents=docs_frame(spark, rows), labels=marked)
    kept = tox.clean_stage(spark, spark.read.parquet(f"{tmp_dir}/documents.parquet"), tmp_dir)
    assert "score" in kept.columns  # the input's own column
    bad = {k for k, _, y in marks if y}
    left = {r["doc_id"] for r in kept.collect()}
    assert not left & bad and left == {k for k, _ in rows} - bad


def test_long_texts_are_fitted():
    """Texts of any length, toxic ones longer than all clean ones included."""
    plain = " ".join(f"p{i % 41}" for i in range(1200))
    rows = [(i % 2, f"{plain} nasty {plain} w{i}" if i % 2 else f"{plain} w{i}") for i in range(60)]
    model = tox.fit(rows, 0.5)
    tagger = tox.Tagger(model)
    for text, bad in ((f"{plain} nasty", 1), (plain, 0), ("so nasty", 1), ("so plain", 0)):
        score, spans = tox.score_text(tagger, text)
        assert (score >= 0.5) == bool(bad) == bool(spans)
    mixed = [(y, t if y else "a short clean text") for y, t in rows]
    assert tox.score_text(tox.Tagger(tox.fit(mixed, 0.5)), f"{plain} nasty")[0] >= 0.5


def test_fit_without_tokens():
    weights, bias, steps = tox.fit_crf([], np.array([2.0]))
    assert weights.tolist() == [2.0] and np.isfinite(bias) and np.isfinite(steps).all()
    assert 0 <= tox.score_text(tox.Tagger(tox.fit([(0, ""), (1, "!")], 0.5)), "word")[0] <= 1
