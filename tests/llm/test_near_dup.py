import random
import re
from collections import defaultdict

import numpy as np
import pytest

from hirelake.llm import near_dup
from hirelake.llm.graph import components

from .conftest import docs_frame


def sets(rows, words):
    out = {}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out[k] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    return out


def brute(rows, words, similarity=80):
    """n_shingles and component of (id, text) rows with unique ids."""
    own = sets(rows, words)
    up = {k: k for k in own}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    holders = defaultdict(set)
    for k, s in own.items():
        for x in s:
            holders[x].add(k)
    for a, s in own.items():
        for b in {k for x in s for k in holders[x] if k > a}:
            both = len(s & own[b])
            if 100 * both >= similarity * (len(s) + len(own[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(s), top(k)) for k, s in own.items()}


def found(df, words):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(df, words=words).collect()}


def test_documents_match_brute_force(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = near_dup.query(spark, sf_small).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 4)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("edits", [1, 3])
def test_groups_larger_than_a_node(spark, edits):
    """Near copies around and below the threshold, more than are compared
    exhaustively, with a passage that all documents share."""
    rnd = random.Random(edits)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    passage = [word() for _ in range(30)]
    rows = []
    for g in range(6):
        base = [word() for _ in range(60 + 20 * g)]
        for _ in range(150 if g == 0 else 12):
            copy = list(base)
            for _ in range(rnd.randint(0, edits * 2)):
                copy[rnd.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(passage + [word() for _ in range(40)])))
    rows += [(len(rows) + i, " ".join(passage + [word() for _ in range(60)])) for i in range(80)]
    assert found(docs_frame(spark, rows), 4) == brute(rows, 4)


def test_odd_rows(spark, odd, no_docs):
    got = near_dup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    part = {(r["doc_id"], r["component_id"], r["kept"]) for r in got}
    assert part == {(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (None, None, True),
                    (7, 7, True), (8, 7, False), (9, 9, True), (10, 10, True)}
    assert near_dup.near_duplicates(no_docs).count() == 0
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "a b c d e f")]
    assert {r["component_id"] for r in near_dup.near_duplicates(docs_frame(spark, rows)).collect()} == {1}
    kept = near_dup.near_stage(spark, odd, "")
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2


def test_one_id_on_different_texts(spark):
    """Every text of an id is searched, and what they link with is one component."""
    a, b = "u v w x y z " * 3, " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, b + " more"), (3, "alone in the world it is"), (4, a)]
    got = {(r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 1)}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 400)] + [(5, 400), (399, 400), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 10 for i in range(10, 61)}, **{i: 5 for i in range(100, 401)}, 5: 5, 7: 7}
    assert got == want


def test_odd_sketch_keeps_every_link(spark):
    """Sets of any size with a similarity of 0.8 and more pass; sets of a few
    hundred shingles well below do not."""
    rnd = np.random.default_rng(5)
    rows = []
    for size, share in [(s, j) for s in (1, 5, 40, 150, 600, 3000, 20000) for j in (0.8, 0.81, 0.9, 1.0, 0.7)]:
        alike = max(1, int(np.ceil(share * size)))
        own = rnd.integers(0, 1 << 63, 2 * size - alike, np.uint64)
        x, y = own[:alike + (size - alike) // 2], np.r_[own[:alike], own[alike + (size - alike) // 2:size]]
        rows.append((size, alike / size, len(x), len(y), near_dup.parities(x).tolist(), near_dup.parities(y).tolist()))
    df = spark.createDataFrame(rows, "size long, share double, xn long, yn long, xodd array<long>, yodd array<long>")
    got = df.select("size", "share", near_dup._odd_may_link(80).alias("may")).collect()
    assert all(r["may"] for r in got if r["share"] >= 0.8)
    assert not any(r["may"] for r in got if r["share"] < 0.75 and 40 <= r["size"] <= 600)


def test_loosely_edited_group(spark):
    """Copies of one original, edited apart, that mostly link through it."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    base = [word() for _ in range(120)]
    rows = []
    for _ in range(200):
        copy = list(base)
        for _ in range(rnd.randint(2, 7)):
            copy[rnd.randrange(len(copy))] = word()
        rows.append((len(rows), " ".join(copy)))
    rows.append((len(rows), " ".join(base)))
    assert found(docs_frame(spark, rows), 4) == brute(rows, 4)
