import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from hirelake.llm import mixing

from .conftest import docs_frame


def shares(children, budget):
    """Water-filling of a whole-token budget among (name, cap, weight)."""
    order = sorted(children, key=lambda c: (c[1] / c[2] if c[2] else float("inf"), c[0]))
    out, rest = {}, sum(w for _, _, w in order)
    for i, (name, cap, weight) in enumerate(order):
        if cap * rest <= weight * budget:
            out[name], budget, rest = cap, budget - cap, rest - weight
        else:
            return {**out, **{n: max(0, w * budget // rest) if rest else 0 for n, _, w in order[i:]}}
    return out


def brute(rows, weights, budget, epochs, seed):
    """rows: (key, path, tokens); expected {(key, epoch): take}."""
    supply = defaultdict(int)
    for _, path, n in rows:
        supply[path] += n
    total = sum(supply.values()) * budget[0] // budget[1]
    given = {(): total}
    for depth in range(1, 4):
        kids = defaultdict(set)
        for p in supply:
            kids[p[:depth - 1]].add(p[:depth])
        nxt = {}
        for parent, own in kids.items():
            cap = lambda c: epochs * sum(n for p, n in supply.items() if p[:depth] == c)
            nxt.update(shares([(c, cap(c), weights.get(c, 1)) for c in own], given[parent]))
        given = nxt
    out = {}
    for path, share in given.items():
        docs = [(k, n) for k, p, n in rows if p == path]
        whole, left = divmod(share, supply[path])
        out.update({(k, e): n for k, n in docs for e in range(whole)})
        docs.sort(key=lambda d: (hashlib.md5(f"{seed}|{whole}|{d[0]}".encode()).hexdigest(), d[0]))
        for k, n in docs:
            if left > 0:
                out[(k, whole)] = min(n, left)
            left -= n
    return out


def frame(spark, n=300):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), "en" if i % 4 else "de", "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(n)]
    return rows, docs_frame(spark, rows)


def levels():
    return {"domain": F.when(F.col("source") == "hot", "web").otherwise("books"), "lang": F.col("lang"), "source": F.col("source")}


def test_matches_brute_force(spark):
    rows, df = frame(spark)
    tree = [(i, ("web" if s == "hot" else "books", g, s), len(t.split())) for i, t, g, s in rows]
    weights = {("web",): 1, ("books",): 6, ("books", "de"): 5}
    for budget, epochs in (((1, 1), 2), ((9, 10), 1), ((5, 2), 3), ((1, 50), 1)):
        got = mixing.mix(df, levels(), weights=weights, budget=budget, epochs=epochs, seed="t")
        seen = {(r["doc_id"], r["epoch"]): r["take_tokens"] for r in got.collect()}
        assert seen == brute(tree, weights, budget, epochs, "t")


def test_budget_is_met_and_texts_are_cut(spark):
    rows, df = frame(spark)
    got = mixing.mix(df, levels(), budget=(1, 2), epochs=1).collect()
    total = sum(len(t.split()) for _, t, *_ in rows)
    taken = sum(r["take_tokens"] for r in got)
    assert total // 2 - 20 <= taken <= total // 2  # a token is lost per node at most
    assert all(len(r["text"].split()) == r["take_tokens"] for r in got)
    assert {"id", "whole", "cut"} <= set(got[0].asDict())  # columns of clashing names pass


def test_odd_rows(spark, odd, no_docs):
    got = mixing.mix(odd, mixing._levels(), budget=(1, 1), epochs=1).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(["4", "5", "5", "6", "None", "7", "8", "9", "10"])
    assert mixing.mix(no_docs, mixing._levels()).count() == 0


def test_prefix_keeps_spacing(spark):
    df = docs_frame(spark, [(1, "  a  b\n c d ")])
    got = mixing.mix(df, mixing._levels(), budget=(1, 2), epochs=1).collect()
    assert [r["text"] for r in got] == ["  a  b"]
