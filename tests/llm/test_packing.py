import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import packing


def tokenizer():
    return packing.encoder(packing.public_vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aBzé ÀßİΣς'tsreld.,!?9²½_<|>\n\t\x85 \x1c中́", max_size=40))
def test_words_give_the_text_its_ids(text):
    e = tokenizer()
    assert np.frombuffer(e(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_are_as_in_the_vocabulary():
    e = tokenizer()
    for text in ("a<|endoftext|>b", "<|startoftext|> x", "<|endoftext", "don't I'LL we've x's"):
        assert np.frombuffer(e(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def brute_cost(at, cost, window):
    best = [0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            if at[j] - at[i] <= window:
                best[j] = min(best[j], best[i] + cost[j] + window - at[j] + at[i] + packing.SEQUENCE_PENALTY)
    return best[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=40), st.lists(st.integers(0, 5), min_size=41, max_size=41))
def test_queue_finds_the_cheapest_cuts(gaps, penalties):
    at = [0, *np.cumsum(gaps).tolist()]
    cost = [0, *penalties[:len(gaps)]]
    cuts = packing.best_cuts(at, cost, 12, True)
    price = dict(zip(at, cost))
    total = sum(price[b] + 12 - (b - a) + packing.SEQUENCE_PENALTY for a, b in zip([0, *cuts], cuts))
    assert cuts[-1] == at[-1] and total == brute_cost(at, cost, 12)


def check(rows, texts):
    """Every id once, sequences gapless and at most a window long."""
    e = tokenizer()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, text in texts.items():
        ids = np.array([*e.tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc.pop(key), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return [sum(n for _, n in p) for p in by_seq.values()]


def test_documents_are_packed_whole(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    lengths = check(packing.query(spark, sf_small).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    padding = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in lengths)
    assert padding <= 0.02 * sum(lengths)


def test_odd_rows(spark, odd, no_docs):
    rows = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check(packing.pack(rows, packing.public_vocabulary()).collect(), {r["doc_id"]: r["text"] for r in rows.collect()})
    whole = packing.pack(odd, packing.public_vocabulary(), with_ids=True).collect()
    assert sum(r["start"] == 0 for r in whole) == odd.count()  # repeated rows and null keys too
    assert all(len(r["ids"]) == r["length"] for r in whole)
    assert packing.pack(no_docs, packing.public_vocabulary()).count() == 0
