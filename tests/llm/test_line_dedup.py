from collections import defaultdict

import duckdb

from hirelake.llm import line_dedup as ld

from .conftest import docs_frame


def brute(rows, min_sites):
    """(text, lines, removed) of unique (key, text, site) rows."""
    sites, first = defaultdict(set), {}
    for k, t, s in rows:
        for line in (t or "").split("\n"):
            x = line.strip(" ")
            if x:
                sites[x].add(s or "")
                first[x] = min(first.get(x, k), k)
    out = {}
    for k, t, _ in rows:
        if t is None:
            out[k] = (None, 0, 0)
            continue
        lines = t.split("\n")
        gone = [x.strip(" ") != "" and len(sites[x.strip(" ")]) >= min_sites and first[x.strip(" ")] != k for x in lines]
        out[k] = ("\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone))
    return out


def test_matches_brute_force_around_the_threshold(spark):
    rows = []
    for i in range(240):
        lines = [f"line shared by {m} sites, truly" for m in range(1, 60) if i < m] + [f"own line of {i}, which stays"]
        if i % 7 == 0:
            lines.insert(1, "  short ")
        rows.append((i, "\n".join(lines), "en", None if i == 11 else f"site{i}"))
    df = docs_frame(spark, rows)
    for min_sites in (2, 3, 20, 50):
        want = brute([(k, t, s) for k, t, _, s in rows], min_sites)
        got = ld.remove_lines(df, min_sites=min_sites).collect()
        assert {r["doc_id"]: (r["text"], r["lines"], r["removed_lines"]) for r in got} == want
        assert "component" in got[0].asDict()


def test_one_site_is_no_spread(spark):
    df = docs_frame(spark, [(i, "the same long line of text", "en", "hot") for i in range(500)])
    assert ld.remove_lines(df).where("removed_lines > 0").count() == 0


def test_very_many_lines(spark):
    many = "\n".join(f"line {i % 150000}" for i in range(200000))
    df = docs_frame(spark, [(i, many, "en", f"s{i}") for i in range(3)])
    got = {r["doc_id"]: (r["lines"], r["removed_lines"], r["text"]) for r in ld.remove_lines(df).collect()}
    assert got == {0: (200000, 0, many), 1: (200000, 200000, ""), 2: (200000, 200000, "")}


def test_query_matches_sql(spark, sf_small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    want = sorted(map(repr, con.sql(f"SELECT doc_id, lines, removed_lines, text FROM ({ld.SQL})").fetchall()))
    assert sorted(repr(tuple(r)) for r in ld.query(spark, sf_small).collect()) == want


def test_odd_rows(spark, odd, no_docs):
    got = ld.remove_lines(odd).collect()
    assert len(got) == odd.count()
    assert {r["text"] for r in got if r["doc_id"] == 2} == {None}
    assert ld.remove_lines(no_docs).count() == 0
    line = "a line that three sites have\n"
    rows = [(None, line, "en", "s1"), (3, line, "en", "s2"), (3, line, "en", "s2"), (4, line * 3 + "rest", "en", "s3")]
    out = sorted((str(r["doc_id"]), r["text"]) for r in ld.remove_lines(docs_frame(spark, rows)).collect())
    assert out == [("3", line), ("3", line), ("4", "rest"), ("None", "")]


def test_stage_drops_what_is_left_empty(spark):
    line = "a line that three sites have"
    df = docs_frame(spark, [(i, line, "en", f"s{i}") for i in range(4)] + [(9, "", "en", "s9"), (8, None, "en", "s9")])
    kept = ld.line_stage(spark, df, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 8, 9]
    assert kept[0].asDict().keys() == df.first().asDict().keys()


def test_stage_searches_short_lines(spark):
    rows = [(i, f"Les.\n   \n\nown line of {i}", "en", f"s{i}") for i in range(4)]
    kept = {r["doc_id"]: r["text"] for r in ld.line_stage(spark, docs_frame(spark, rows), "").collect()}
    assert kept == {0: rows[0][1], **{i: f"   \n\nown line of {i}" for i in range(1, 4)}}


def test_stage_compares_lines_without_white_space(spark):
    rows = [(i, f"a line of three sites{end}\n\r\n\t\nown {i}", "en", f"s{i}") for i, end in enumerate(["\r", "", "\t"])]
    kept = {r["doc_id"]: r["text"] for r in ld.line_stage(spark, docs_frame(spark, rows), "").collect()}
    assert kept == {0: rows[0][1], 1: "\r\n\t\nown 1", 2: "\r\n\t\nown 2"}
