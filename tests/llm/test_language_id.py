import zlib

from hirelake.llm import language_id as li

from .conftest import docs_frame, write_tables


def test_held_out_accuracy(spark, sf_small):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = li.query(spark, sf_small).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es", "und"}
    held = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.9 * len(held)


def test_chunks_do_not_change_the_counts(monkeypatch):
    text = "äöü quick brown foxes, 中文 and more " * 50
    whole = [a.tolist() for a in li.bucket_counts(text)]
    monkeypatch.setattr(li, "CHUNK", 37)
    assert [a.tolist() for a in li.bucket_counts(text)] == whole


def test_odd_rows(spark, odd, no_docs, tmp_dir):
    model = li.train(docs_frame(spark, [(i, "the and of to " * 5, "en") for i in range(30)]
                                + [(i, "der die und das " * 5, "de") for i in range(30)]
                                + [(1, None, "en"), (2, "no language", None)]))
    assert model.languages == ["de", "en"]
    got = li.predict(odd, model).collect()
    assert len(got) == odd.count()
    letters = {1: "und", 2: "und", 3: "und"}
    for r in got:
        assert r["lang_pred"] == letters.get(r["doc_id"], r["lang_pred"])
        assert (r["lang_pred"] == "und") == (r["score"] == 0.0)
    assert li.predict(docs_frame(spark, [(1, "12 _ 9!")]), model).first()["lang_pred"] == "und"
    assert li.predict(docs_frame(spark, [(1, "and of the to")]), model).first()["lang_pred"] == "en"
    assert li.predict(no_docs, model).count() == 0
    assert li.query(spark, write_tables(tmp_dir, documents=no_docs)).count() == 0
    unknown = li.predict(odd, li.train(no_docs))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}


def test_number_like_letters_are_none(spark):
    model = li.train(docs_frame(spark, [(i, f"the and of number{i}", "en") for i in range(50)] + [(99, "der und", "de")] * 3))
    got = {r["doc_id"]: r["lang_pred"] for r in li.predict(docs_frame(spark, [(1, "\u00b2 \u00bd \u2167 12 _"), (2, "\u00aa")]), model).collect()}
    assert got[1] == "und" and got[2] != "und"


def test_rare_language_and_copies(spark):
    rows = [(i, f"the and of to number{i}", "en") for i in range(3000)] + [(i, "the copy of all", "en") for i in range(400)]
    rows += [(i, f"ja kun hän oli numero{i}", "fi") for i in range(3)]
    df = docs_frame(spark, rows)
    drawn = [tuple(r) for r in li.draw(df, texts=40).collect()]
    assert len(drawn) == len(set(drawn)) == 43
    assert sorted(r for r in drawn if r[1] == "fi") == sorted((t, g) for _, t, g in rows if g == "fi")
    assert sorted(tuple(r) for r in li.draw(df.repartition(7), texts=40).collect()) == sorted(drawn)
    model = li.train(df)
    assert model.languages == ["en", "fi"]
    assert li.train(docs_frame(spark, [(1, "same", "en")] * 50 + [(2, "other", "en")])).languages == ["en"]
