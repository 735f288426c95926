"""Packing: tokens against the tokenizer, places against their definition."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from spanroute.llm import packing as P
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "<|endoftext|> a<|startoftext|>b", "ΑΣ ΣΟΦΟΣ 'S 've x'll", "a\x1cb c d e\x85f", "İSTANBUL ß ẞ ﬁ Å é ñ", "", "   ", None,
    "½²_a_ __ 1234 ª º µ ×÷", "日本語 テスト 👍🏽 a👍b", "x" * 5000, "''s 'S's ''", "q　w\xa0e",
]


def ids_of(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_tokens_are_the_tokenizers(spark, sf_small, monkeypatch):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = ids_of(texts)
    for cached, size in ((P.CACHED, P.SLICE), (50, 300)):
        monkeypatch.setattr(P, "CACHED", cached), monkeypatch.setattr(P, "KEPT_PIECES", cached), monkeypatch.setattr(P, "SLICE", size)
        assert [np.frombuffer(x, "<u4").tolist() for x in P.WordTokens(PATH).encode(texts)] == want


def check_places(rows, ids, capacity):
    """Every document once, its pieces right, sequences gapless from 0 and within the capacity."""
    filled = defaultdict(list)
    got = Counter()
    for doc, piece, start, length, crc, seq, offset in rows:
        filled[seq].append((offset, length))
        assert start == piece * capacity and 0 < length <= capacity
        got[doc, start, length, crc] += 1
    want = Counter()
    for doc, x in ids:
        x = [*x, P.END]
        for s in range(0, len(x), capacity):
            want[doc, s, len(x[s : s + capacity]), zlib.crc32(np.array(x[s : s + capacity], "<u4").tobytes())] += 1
    assert got == want
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    ids = list(zip([d for d, _ in rows], ids_of([t for _, t in rows]), strict=True))
    got = P.pack_documents(docs, PATH).collect()
    n = check_places(got, ids, P.CAPACITY)
    assert n <= 1.02 * sum(len(x) + 1 for _, x in ids) / P.CAPACITY + 1


def test_nulls_ties_and_names(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "word " * 9000), (2, "word " * 9000), (3, "a b")]
    docs = spark.createDataFrame([(d, t, 5, "x") for d, t in rows], "doc_id long, text string, length int, LENGTH string")
    ids = list(zip([d for d, _ in rows], ids_of([t for _, t in rows]), strict=True))
    check_places(P.pack_documents(docs, PATH).collect(), ids, P.CAPACITY)


def test_empty(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


@pytest.mark.parametrize("kind", ["mixed", "large", "hot", "tiny"])
def test_plan(kind):
    rng = np.random.default_rng(5)
    lengths = {
        "mixed": np.clip(rng.lognormal(6.6, 0.9, 20_000).astype(int), 1, 4096), "large": rng.integers(900, 2500, 9_000),
        "hot": np.r_[rng.integers(1, 4096, 6_000), np.full(3_000, 1366)], "tiny": rng.integers(1, 40, 5_000),
    }[kind]
    counts = Counter(lengths.tolist())
    bins = P.plan(dict(counts), groups=40)
    ranks = defaultdict(list)
    for b in bins:
        assert b.count > 0 and b.left >= 0 and sum(n * k for n, _, k in b.runs) + b.left == P.CAPACITY
        for n, first, k in b.runs:
            ranks[n].append((first, first + k * b.count))
    for n, c in counts.items():
        ends = sorted(ranks[n])
        assert [0, *(e for _, e in ends)] == [*(s for s, _ in ends), c]
    plain = []  # first fit by falling length
    for n in sorted(lengths.tolist(), reverse=True)[: 2_000 if kind == "hot" else None]:
        at = next((i for i, left in enumerate(plain) if left >= n), None) if kind == "hot" else None
        if at is None:
            plain.append(P.CAPACITY - n)
        else:
            plain[at] -= n
    total = sum(b.count for b in bins)
    if kind in ("mixed", "tiny"):
        assert total <= 1.03 * lengths.sum() / P.CAPACITY + 1
    if kind == "large":
        assert total <= 1.05 * lengths.sum() / P.CAPACITY
