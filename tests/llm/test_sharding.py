import random
import zlib
from collections import Counter, defaultdict

import pytest

from hirelake.llm import sharding as sh

from .conftest import docs_frame, write_tables


def brute_difference(sizes, parts):
    """Sorted sums of the parts, with explicit lists of items and no heap."""
    found = [[(s, [i])] + [(0, [])] * (parts - 1) for i, s in enumerate(sizes)]
    while len(found) > 1:
        found.sort(key=lambda p: p[-1][0] - p[0][0])  # stable: the oldest of equal spread first
        x, y = found.pop(0), found.pop(0)
        both = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(x, reversed(y))]
        found.append(sorted(both, key=lambda p: -p[0]))
    return found[0]


@pytest.mark.parametrize("parts", [1, 2, 3, 24])
def test_difference_equals_brute_force(parts):
    rng = random.Random(parts)
    for n in (1, 2, 5, 40, 200):
        sizes = [rng.choice((rng.randint(1, 30), rng.randint(1, 10_000))) for _ in range(n)]
        own = sh.difference(sizes, parts)
        sums = Counter()
        for s, p in zip(sizes, own):
            sums[p] += s
        assert sorted(sums.values()) == sorted(s for s, items in brute_difference(sizes, parts) if items)
        assert set(own) <= set(range(parts))


def test_known_example():
    own = sh.difference([8, 7, 6, 5, 4], 2)
    assert abs(sum(s if p else -s for s, p in zip([8, 7, 6, 5, 4], own))) == 2
    assert sh.difference([], 3) == []


def test_tighter_than_greedy():
    rng = random.Random(3)
    sizes = [rng.randint(1, 10**6) for _ in range(2000)]
    loads = [0] * 24
    for s in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += s
    own = [0] * 24
    for s, p in zip(sizes, sh.difference(sizes, 24)):
        own[p] += s
    assert max(own) - min(own) < (max(loads) - min(loads)) / 4


def check(rows, shards):
    """What holds of any numbered result."""
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())
    assert set(slots) <= set(range(shards))


def test_query(spark, sf_small):
    rows = sh.query(spark, sf_small).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert {(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows} == {
        (k, len(t.encode()) + 8, zlib.crc32(t.encode()), "bytes", None) for k, t in texts.items()}
    check(rows, 24)


def test_bytes_are_near_equal_beside_a_hot_group(spark, tmp_dir):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 900) + f" {i}") for i in range(3000)]
    rows += [(10_000 + i, "hot text " * 9) for i in range(1500)]
    write_tables(tmp_dir, documents=docs_frame(spark, rows).repartition(7))
    got = sh.query(spark, tmp_dir).collect()
    check(got, 24)
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    hot = 1500 * (81 + 8)
    assert max(load.values()) == hot  # alone in its shard: heavier than a fair share
    rest = sorted(load.values())[:-1]
    assert len(rest) == 23 and max(rest) - min(rest) <= 0.001 * max(rest)


def test_odd_rows(spark, odd, no_docs, tmp_dir):
    placed = sh.place(odd, shards=5)
    assert placed.columns == [*odd.columns, "size", "shard"]
    rows = sh.number(placed).collect()
    assert len(rows) == odd.count()
    assert sorted(r["slot"] for r in rows if r["shard"] == 0) == list(range(sum(r["shard"] == 0 for r in rows)))
    assert len({r["shard"] for r in rows if not r["text"]}) == 1 and {r["size"] for r in rows if not r["text"]} == {8}
    assert len({r["shard"] for r in rows if r["text"] == "same text of five words"}) == 1
    assert sh.number(sh.place(no_docs)).count() == 0
    again = sh.place(odd.repartition(4), shards=5).select("doc_id", "text", "shard")
    assert again.exceptAll(placed.select("doc_id", "text", "shard")).count() == 0


def test_many_blocks_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(sh, "BLOCK", 7)
    df = docs_frame(spark, [(i % 50, f"t{i % 300}") for i in range(1000)]).repartition(3)
    rows = sh.number(sh.place(df, shards=3)).collect()
    for s in range(3):
        own = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))


def test_written_shards(spark, tmp_dir):
    df = docs_frame(spark, [(i, f"text {i}") for i in range(200)])
    sh.write_shards(df, f"{tmp_dir}/shards", shards=4)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.select("doc_id", "text").exceptAll(df.select("doc_id", "text")).count() == 0
    assert back.count() == 200 and back.select("shard").distinct().count() == 4
