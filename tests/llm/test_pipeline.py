from collections import defaultdict

import corpus_pipeline
from hirelake.llm import packing

from .conftest import DOCS, write_tables
from .test_toxicity import labelled


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dup", "mixing", "packing"]


def planted(spark, tmp_dir):
    """Clean, toxic, copied and boilerplate-carrying documents."""
    rows, marks = labelled(200)
    rows = [(k, f"{t}\ndocument {k} ends with its own words n{k} m{k} o{k}", "en", f"src{k % 7}") for k, t in rows]
    line = "all rights are reserved by the owner of this fine page"
    rows = [(k, f"{line}\n{t}" if k % 2 else t, g, s) for k, t, g, s in rows]
    clean = [r for r in rows if r[0] % 5]
    # Not of the first one, which keeps the shared line that its copy loses: under 0.8 alike by then.
    rows += [(1000 + r[0], f"{r[1]} tail", r[2], "src9") for r in clean[1:21]]
    df = spark.createDataFrame([(*r, len(r[1])) for r in rows], DOCS)
    write_tables(tmp_dir, documents=df, labels=spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    return rows, line


def test_planted_cases(spark, tmp_dir):
    rows, line = planted(spark, tmp_dir)
    docs, at = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, tmp_dir)
        assert docs.columns == columns
        docs = corpus_pipeline.materialize(docs, name)
        at[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert at["toxicity"].keys() == {r[0] for r in rows if r[0] % 1000 % 5}
    assert sum(line in t for t in at["line_dedup"].values()) == 1
    assert at["near_dup"].keys() == {k for k in at["line_dedup"] if k < 1000}
    assert set(at["mixing"]) <= set(at["near_dup"])
    assert all(at["near_dup"][k].startswith(t) for k, t in at["mixing"].items())
    words = lambda d: sum(len(t.split()) for t in d.values())
    assert 0.85 * words(at["near_dup"]) <= words(at["mixing"]) <= 0.9 * words(at["near_dup"])


def test_run_packs_what_the_stages_kept(spark, tmp_dir):
    planted(spark, tmp_dir)
    pieces = corpus_pipeline.run(spark, tmp_dir).collect()
    by_doc = defaultdict(int)
    for r in pieces:
        by_doc[r["doc_id"]] += r["length"]
        assert r["offset"] + r["length"] <= packing.WINDOW
    assert by_doc == {r["doc_id"]: r["doc_tokens"] for r in pieces}


def test_empty_table(spark, no_docs, tmp_dir):
    write_tables(tmp_dir, documents=no_docs.select("doc_id", "text", "lang", "source", "n_chars"),
                 labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
