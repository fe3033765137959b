import numpy as np
from pyspark.sql import functions as F

from hirelake.llm import ann


def truth(ids, x, k):
    out = {}
    for i, q in enumerate(ids):
        if q % ann.QUERY_EVERY == 0:
            s = (x * x[i]).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_and_scores(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want, got = truth(ids, x, 20), {}
    for r in ann.query(spark, sf_small).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys() and all(sorted(g) == list(range(1, 21)) for g in got.values())
    place = {int(k): i for i, k in enumerate(ids)}
    hits = 0
    for q, best in got.items():
        listed = [best[r] for r in sorted(best)]
        assert listed == sorted(listed, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - float(x[place[q]] @ x[place[v]])) < 1e-12 for v, s in listed)
        hits += len({v for v, _ in listed} & {v for v, _ in want[q]})
    assert hits >= 0.95 * 20 * len(want)


def test_odd_vectors(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.normal(size=3).tolist()) for i in range(12)]
    rows += [(20 + i, [1.0, 2.0, 2.0]) for i in range(30)]  # ties
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [float("nan"), 1.0, 1.0]),
           (180, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (200, []), (220, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows + odd], "vec_id long, embedding array<double>, id string, score double")
    got = {}
    for r in ann.nearest(df, F.col("id") % ann.QUERY_EVERY == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert got == truth(ids, x, 20)  # small enough for every candidate to be verified
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_chi_square():
    assert abs(ann.chi2_below(np.array(15.507), 8) - 0.95) < 1e-4
    assert abs(ann.chi2_quantile(0.95, 8) - 15.507) < 1e-2


def test_search_visits_part_of_the_block_when_vectors_cluster():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(16, 32)) * 5
    x = np.concatenate([c + rnd.normal(size=(64, 32)) * 0.05 for c in centres])
    block = ann.Block(np.arange(len(x)), x)
    for i in range(0, len(x), 37):
        s = x @ x[i]
        s[i] = -np.inf
        got = [v for v, _ in block.search(i, x[i])]
        assert len(set(got) & set(np.argsort(-s)[:20].tolist())) >= 18


def test_points_are_put_aside_by_their_own_projected_distance():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(4096, 24))  # isotropic: nearly every leaf's box is inside the stop
    ids, hits, asked = np.arange(len(x)), 0, range(0, len(x), 128)
    block = ann.Block(ids, x)
    for i in asked:
        got = block.search(i, x[i])
        s = (x * x[i]).sum(1)
        want = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        assert all(abs(score - s[v]) < 1e-12 for v, score in got)
        hits += len({v for v, _ in got} & set(want))
    assert hits >= 0.9 * 20 * len(asked)
    assert block.verified < 0.97 * len(x) * len(asked)


def test_equal_vectors_are_all_met():
    x = np.concatenate([np.tile([1.0, 2.0, 3.0], (300, 1)), np.random.default_rng(6).normal(size=(300, 3)) / 9])
    block = ann.Block(np.arange(600)[::-1].copy(), x)
    assert [v for v, _ in block.search(599, x[0])] == list(range(300, 320))
