import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from hirelake.llm import alignment as al

from .conftest import docs_frame


class Reference:
    """Both libraries over whole texts, as the contract words it."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(al.VOCABULARY_A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(al.VOCABULARY_B))
        self.letters = al._byte_letters()

    def tokens(self, text):
        """(ids, bytes) of A and of B."""
        a = self.a.encode(" " + text, add_special_tokens=False)
        ids = self.b.encode(text)
        pieces = [self.b.id_to_piece(i) for i in ids]
        return ([(i, bytes(self.letters[c] for c in t)) for i, t in zip(a.ids, a.tokens)],
                [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, pieces)])

    def document(self, text):
        """n_a, n_b, groups, all links."""
        if not text:
            return 0, 0, "", []
        a, b = self.tokens(text)
        if not (b"".join(x[1] for x in a) == b"".join(x[1] for x in b) == (" " + text).encode()):
            return 0, 0, "", []
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(x[1]) for x in side]).tolist()
            spans.append([(e - len(x[1]), e, x[0]) for x, e in zip(side, ends)])
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if max(x[0], y[0]) < min(x[1], y[1])]
        groups, start = [], 0
        for cut in sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= cut) for side in spans))
            start = cut
        return len(a), len(b), ";".join(groups), links


@pytest.fixture(scope="module")
def reference():
    return Reference()


def brute(reference, rows):
    docs = [(k, *reference.document(t)) for k, t in rows]
    count = Counter(p for d in docs for p in set(d[4]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(repr((k, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links),
                        sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                        hashlib.sha256(groups.encode()).hexdigest() if groups else "")) for k, n_a, n_b, groups, links in docs)


def result(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(repr(tuple(r)) for r in df.collect())


def odd_texts(seed, n):
    rng = random.Random(seed)
    bits = ["the", "Word", "naïve", "x", "1", "12.5", "don't", "'s", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", ".", ",", "!?", "...",
            "a,b", "e.g.", "×", "²", "½", "中文", "\U0001F600", " ", " ", "\u0085", "\x1c", "<s>", "<|endoftext|>", "<0x41>",
            "é", "é", "ß", "_a_", "(x)", "--", "http://a.b/c?d=e;f", "ƻ.", "ǃ!", "​", "\x00", "ﬁ", "ÿ:", "÷,"]
    return ["".join(rng.choice(bits) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_pieces_equal_whole_texts(reference):
    pair = al.Pair(al.vocabulary(al.VOCABULARY_A), al.vocabulary(al.VOCABULARY_B))
    assert not pair.whole
    for text in [*odd_texts(7, 4000), "▁ is no space", "a▁b", " x", "x ", "\n", " ", "\ud800"]:
        if "\ud800" in text:
            assert pair(text) is None
            continue
        n_a, n_b, groups, links = reference.document(text)
        got = pair(text)
        if not groups:
            assert got is None, text
        else:
            assert (got[2], got[3], got[0].decode()) == (n_a, n_b, groups), text
            assert np.frombuffer(got[1], np.uint16).reshape(-1, 2).tolist() == [list(p) for p in links], text


def test_query(spark, sf_small, reference):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    short = [(k, t) for k, t in rows if len(t or "") < 1500]
    assert len(short) > 50
    got = {r["doc_id"]: r for r in al.query(spark, sf_small).collect()}
    assert set(got) == {k for k, _ in rows}
    for k, t in short:  # what depends on the document alone; counts are compared below, on whole tables
        n_a, n_b, groups, links = reference.document(t)
        assert (got[k]["n_a"], got[k]["n_b"], got[k]["n_links"]) == (n_a, n_b, len(links))
        assert got[k]["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_counts_equal_brute_force(spark, reference, monkeypatch):
    rows = [(i % 90, t) for i, t in enumerate(odd_texts(11, 150) * 2)] + [(500 + i, "the same words, " * 9) for i in range(40)]
    df = docs_frame(spark, rows).repartition(3)
    want = brute(reference, rows)
    assert result(al.align(df)) == want
    monkeypatch.setattr(al, "LINKS", 60)  # many small blocks
    monkeypatch.setattr(al, "KEPT", 9000)
    assert result(al.align(df)) == want
    monkeypatch.setattr(al, "DOCS", 5)
    assert result(al.align(df)) == want


def test_odd_rows(spark, odd, no_docs, reference):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 5000]
    assert result(al.align(odd.where("text IS NULL OR length(text) < 5000"))) == brute(reference, rows)
    assert al.align(odd).count() == odd.count()
    assert al.align(no_docs).count() == 0


def test_bitmaps_round_trip():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    for size in (1, 9, 300, 65536):
        docs = np.sort(rng.integers(0, size, 5000))
        links = rng.integers(0, 40, 5000) ** 2
        made = al.postings(links, docs, size)
        raw = [made["data"][s:e].tobytes() for s, e in zip(made["offsets"], made["offsets"][1:])]
        member, of = al._members(pa.table({"bitmap": pa.array(raw, pa.binary()), "dense": pa.array(made["dense"])}))
        got = Counter()
        for d, i in zip(member.tolist(), of.tolist()):
            pair, plane = int(made["keys"][i]) >> 8, int(made["keys"][i]) & 255
            got[pair, d] += 1 if plane == 0 else 1 << (plane - 1)
        assert got == Counter(zip(links.tolist(), docs.tolist()))
        assert np.bincount(of, minlength=len(raw)).tolist() == made["n"].tolist()
