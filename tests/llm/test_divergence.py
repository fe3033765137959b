import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from hirelake.llm import divergence as dv

from .conftest import docs_frame, write_tables

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, top=dv.TOP):
    """The contract, term by term, over rows (key, text, lang, source)."""
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        sources[lang].add(source)
    out = set()
    for lang, names in sources.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= 3), key=str.encode)
        total = Counter()
        for s in names:
            total.update({t: counts[lang, s][t] for t in kept})

        def share(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in names}
        q = share(total)
        for s in names:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in names - {s}]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, rows_, most in (("pair", pair, None), ("term", term, top)):
                rows_.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, i, v, r) for r, (v, i) in enumerate(rows_[:most], 1)}
    return out


def result(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def prose(seed, n, sources=5, words=400):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('abcdeé中')}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)]
    return [(i, " ".join(rng.choice(vocabulary[:int(words * rng.random()) + 1]).title() if rng.random() < 0.2
                         else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "de"]), f"s{rng.randrange(sources) if rng.random() < 0.6 else 0}") for i in range(n)]


def test_equals_brute_force(spark):
    for seed, n in ((1, 150), (2, 30)):
        rows = prose(seed, n)
        assert result(dv.audit(docs_frame(spark, rows))) == brute(rows)


def test_few_ranks_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD", 50)
    monkeypatch.setattr(dv, "BUFFER", 64)
    monkeypatch.setattr(dv, "PIECE", 11)
    rows = prose(3, 200)
    assert result(dv.audit(docs_frame(spark, rows).repartition(5), top=4)) == brute(rows, 4)


def test_query_equals_sql(spark, sf_small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    assert result(dv.query(spark, sf_small)) == set(con.sql(dv.SQL).fetchall())


def test_odd_rows(spark, odd, no_docs, tmp_dir):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in odd.collect()]
    rows += [(20 + i, t, g, s) for i, (t, g, s) in enumerate(
        [("A b Ö", "x", "s1"), ("a B ö", "x", "s2"), ("a b ö", "x", None), ("", "x", "s3"), ("q", "y", "s1"), (None, "y", "s2")])]
    df = docs_frame(spark, rows)
    assert result(dv.audit(df)) == brute(rows)
    assert dv.audit(no_docs).count() == 0


def test_sql_reads_the_same_odd_rows(spark, odd, tmp_dir):
    write_tables(tmp_dir, documents=odd.select("doc_id", "text", "lang", "source", "n_chars"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/documents.parquet/*.parquet'")
    assert result(dv.query(spark, tmp_dir)) == set(con.sql(dv.SQL).fetchall())


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = np.random.default_rng(4)
    for n, k in ((1, 1), (300, 1), (900, 7), (2000, 40)):
        c, total, rank = rng.integers(1, 9, n), rng.integers(1, 30, n), rng.permutation(n)
        over = ((c[None, :] >= c[:, None]) & (total[None, :] <= total[:, None]) & (rank[None, :] < rank[:, None])).sum(1)
        assert sorted(dv.skyband_rows(c, total, rank, k)) == np.flatnonzero(over < k).tolist()


def test_shares_stay_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    cases = [(1, 3), (7, 7), (10**15, 9 * 10**15), (123456789012345, 987654321098765), (1, 9 * 10**15)]
    df = spark.createDataFrame(cases, "c long, w long")
    got = [r[0] for r in df.select(dv._share(F.col("c"), F.col("w"))).collect()]
    assert got == [1 + 10**9 * c // w for c, w in cases]
