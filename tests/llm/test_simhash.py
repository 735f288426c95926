"""SimHash groups against all pairs."""

import numpy as np
import pytest
import xxhash
from spanroute.llm import simhash as S
from tests.llm.plain import roots_of


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = roots_of(len(fps), pairs)
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, d), d)
    return sorted((d, f"{fp:016x}", least[r]) for (d, _), fp, r in zip(rows, fps, root, strict=True))


def test_fixture_tables(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = sorted(map(tuple, S.simhash_report(docs).collect()))
    assert got == plain_groups([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("small", [1, 2, 32, 10**9])
def test_planted_bits(spark, monkeypatch, small):
    """Chains, balls and strays around common halves, for each way of linking."""
    monkeypatch.setattr(S, "SMALL", small)
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(4):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            x = centre
            for b in rng.integers(0, 64, int(rng.integers(0, 7))):
                x ^= 1 << int(b)
            fps.add(x)
        for _ in range(60):  # the same low half with any other high half
            fps.add((centre & 0xFFFFFFFF) | int(rng.integers(0, 1 << 31)) << 32)
    fps = sorted(S._signed(x) for x in fps)
    got = dict(S.groups(spark.createDataFrame([(x,) for x in fps], "fp long")).collect())
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 4]
    root = roots_of(len(fps), pairs)
    mine, theirs = {}, {}
    for x, r in zip(fps, root, strict=True):
        mine.setdefault(got.get(x, x), set()).add(x)
        theirs.setdefault(r, set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_nulls_ties_and_names(spark):
    rows = [(5, None, "x"), (3, "", None), (3, "", None), (None, "a b c d e f", "y"), (7, "A  b c D e f", "y"), (8, "z " * 50_000, "q")]
    docs = spark.createDataFrame([(*r, r[0], "k") for r in rows], "doc_id long, text string, source string, DOC_ID long, component_id string")
    got = sorted(map(tuple, S.simhash_report(docs).collect()), key=str)
    assert [(a, c) for a, _, c in got] == [(3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (None, 7)]
    kept = S.simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == [3, 7, 8]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_report(docs).count() == 0
    assert S.simhash_dedup(docs).count() == 0
