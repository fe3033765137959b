import hashlib
import random

from hirelake.llm import simhash

from .conftest import docs_frame, write_tables


def votes(terms):
    """Signs of weighted votes, from (weight, high, low) of a text's terms."""
    total, out = sum(w for w, *_ in terms), []
    for half in (1, 2):
        bits = 0
        for b in range(64):
            if 2 * sum(t[0] for t in terms if t[half] >> b & 1) > total:
                bits |= 1 << b
        out.append(bits)
    return "".join(f"{b:016X}" for b in out)


def test_signs_match_brute_force(spark):
    from pyspark.sql import functions as F

    texts = ["a bb a bb ccc", "one", "", " spaced  out\ttext\n", "x " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, said string")
    got = {r["id"]: r["f"] for r in simhash.fingerprints(df, ["id"], "said").select(
        "id", simhash.written(F.col("high"), F.col("low")).alias("f")).collect()}
    pairs = df.select("id", F.explode(simhash.terms("said")).alias("t")).select(
        "id", F.col("t.a").alias("a"), F.coalesce("t.b", F.lit("")).alias("b"))
    hashed = pairs.select("id", F.greatest(F.length("a") + F.length("b"), F.lit(1)).alias("w"),
                          F.xxhash64("a", "b").alias("h0"), F.xxhash64("b", "a", F.lit(1)).alias("h1")).collect()
    for i, _ in enumerate(texts):
        terms = [(r["w"], r["h0"] % (1 << 64), r["h1"] % (1 << 64)) for r in hashed if r["id"] == i]
        assert got[i] == votes(terms)
    assert [(r["a"], r["b"]) for r in pairs.where("id = 0").collect()] == [
        ("a", "bb"), ("bb", "a"), ("a", "bb"), ("bb", "ccc"), ("ccc", "")]


def test_successors_cross_blocks(spark):
    rnd = random.Random(3)
    ids = sorted({*range(-5, 40), *(rnd.randrange(-2**60, 2**60) for _ in range(200)), 5 << 20, -2**63, 2**63 - 1})
    got = {r["id"]: r["next"] for r in simhash.successors(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    assert got == dict(zip(ids, [*ids[1:], ids[0]]))


def test_radius_search_finds_all(spark):
    rnd = random.Random(5)
    base = [(rnd.getrandbits(64), rnd.getrandbits(64)) for _ in range(40)]
    rows = set(base)
    for h, low in base:
        for _ in range(6):
            x = h << 64 | low
            for b in rnd.sample(range(128), rnd.randint(1, 5)):
                x ^= 1 << b
            rows.add((x >> 64, x & (1 << 64) - 1))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(a), signed(b)) for a, b in rows]
    df = spark.createDataFrame(rows + rows[:5], "high long, low long")
    for radius in (0, 3, 5):
        got = {((r[0], r[1]), (r[2], r[3])): r[4] for r in simhash.within_radius(df, radius).collect()}
        want = {}
        for i, a in enumerate(sorted(rows)):
            for b in sorted(rows)[i + 1:]:
                d = bin((a[0] ^ b[0]) % (1 << 64)).count("1") + bin((a[1] ^ b[1]) % (1 << 64)).count("1")
                if d <= radius:
                    want[a, b] = d
        assert got == want


def edited(texts):
    """texts: sorted (id, text)."""
    out = {}
    for i, (k, t) in enumerate(texts):
        q = len(t) // 4
        out[k] = hashlib.sha256((t[:len(t) - q] + texts[(i + 1) % len(texts)][1][:q]).encode()).hexdigest()
    return out


def test_documents(spark, sf_small):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in simhash.query(spark, sf_small).collect()}
    assert {k: r["edited_sha256"] for k, r in got.items()} == edited(docs)
    assert all(got[k]["n_chars"] == len(t) for k, t in docs)
    by_text = {}
    for k, t in docs:
        assert by_text.setdefault(t, got[k]["fingerprint"]) == got[k]["fingerprint"]
    bits = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128
    for i, (k, _) in enumerate(docs):
        r, after = got[k], got[docs[(i + 1) % len(docs)][0]]
        assert abs(r["near_next"] - bits(r["fingerprint"], after["fingerprint"])) < 1e-12
        assert abs(r["near_edited"] - bits(r["fingerprint"], r["edited_fingerprint"])) < 1e-12
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) >= 0.97 * len(got)


def test_odd_rows(spark, odd, no_docs, tmp_dir):
    got = simhash.query(spark, write_tables(tmp_dir, documents=odd)).collect()
    assert len(got) == odd.select("doc_id", "text").distinct().count()
    assert {r["near_next"] for r in got if r["doc_id"] is None} == {None}
    assert simhash.query(spark, write_tables(tmp_dir + "/none", documents=no_docs)).count() == 0
    alone = write_tables(tmp_dir + "/one", documents=docs_frame(spark, [(4, "abcdefgh")]))
    row = simhash.query(spark, alone).collect()[0]
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and row["near_next"] == 1.0
