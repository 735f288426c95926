"""Embedding near-dedup against all pairs."""

import math

import numpy as np
import pytest
from spanroute.llm import neighbours as N
from tests.llm.plain import roots_of


def plain(rows):
    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [i for i, (d, v, label) in enumerate(rows) if d is not None and good(v, label)]
    unit = {i: np.array(rows[i][1], np.float64) / np.linalg.norm(np.array(rows[i][1], np.float64)) for i in ok}
    pairs = [(i, j) for i in ok for j in ok if j < i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    root, links, least = roots_of(len(rows), pairs), [0] * len(rows), {}
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return sorted(((d, links[i], least.get(root[i]), d is not None and d == least[root[i]]) for i, (d, _, _) in enumerate(rows)), key=str)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<float>, label int, node int, VEC double")
    return sorted(map(tuple, N.near_vectors(table).collect()), key=str)


def test_fixture(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, N.near_vectors(spark.read.parquet(f"{sf_small}/embeddings.parquet")).collect()), key=str) == plain(rows)


@pytest.mark.parametrize("tile", [16, 256])
def test_groups_larger_than_lists(spark, monkeypatch, tile):
    """A dense group of many times a list's and a block's size, chains, exact copies and odd rows."""
    monkeypatch.setattr(N, "BLOCK", 40), monkeypatch.setattr(N, "TILE", tile), monkeypatch.setattr(N, "NEIGHBOURS", 6)
    rng = np.random.default_rng(2)
    rows, centre = [], rng.standard_normal(24)
    for _ in range(180):
        rows.append(((centre + 0.12 * rng.standard_normal(24)).tolist(), 1))
    at = rng.standard_normal(24)
    for _ in range(25):  # a chain of links whose ends are far apart
        at = at + 0.15 * rng.standard_normal(24)
        rows.append((at.tolist(), 2))
    rows += [(rng.standard_normal(24).tolist(), int(rng.integers(1, 4))) for _ in range(300)]
    rows += [(rows[5][0], 1)] * 4 + [(rows[5][0], 3), (rows[5][0], None), (None, 1), ([], 1), ([0.0] * 24, 1), ([math.nan] * 24, 1), ([math.inf] + [0.0] * 23, 1), ([None] + [1.0] * 23, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1)]
    rows = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, label) for i, (v, label) in enumerate(rows)]
    rows += [(None, rows[5][1], 1), rows[7], rows[7]]
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("size", [20, 120])
def test_tight_groups_that_link_across(spark, monkeypatch, size):
    """Every list is full of members of its own group; links between the groups stand in no list."""
    monkeypatch.setattr(N, "audit", lambda placed, *a: (placed.selectExpr("root a", "root b").limit(0), 0, 0))
    rng = np.random.default_rng(4)
    left = rng.standard_normal(24)
    right = rng.standard_normal(24)
    right -= left * (left @ right) / (left @ left)
    right = 0.9825 * left + math.sqrt(1 - 0.9825**2) * right * np.linalg.norm(left) / np.linalg.norm(right)
    rows = [(i, (c + 0.02 * rng.standard_normal(24)).astype(np.float32).tolist(), 1) for i, c in enumerate([left] * size + [right] * size)]
    want = plain(rows)
    assert len({r[2] for r in want}) == 1
    assert run(spark, rows) == want


def test_what_the_search_loses_is_found(spark, monkeypatch):
    """A search that finds nothing, over few twins: no audit of a few vectors passes it."""
    first = N.first_lists
    monkeypatch.setattr(N, "AUDIT", 20), monkeypatch.setattr(N, "ENOUGH", 4), monkeypatch.setattr(N, "REPEATS", 2), monkeypatch.setattr(N, "MOST", 4)
    monkeypatch.setattr(N, "first_lists", lambda *a: first(*a).limit(0))
    rng = np.random.default_rng(5)
    rows = [(rng.standard_normal(24), int(label)) for label in rng.integers(1, 4, 200)]
    rows += [(v + 0.01 * rng.standard_normal(24), label) for v, label in rows[:8]]
    rows = [(i, v.astype(np.float32).tolist(), label) for i, (v, label) in enumerate(rows)]
    assert run(spark, rows) == plain(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_links_of_a_dense_group_are_not_written(spark, monkeypatch):
    """Searches write lists and ties, some for each vector, however many links it has."""
    written, first, descend = [], N.first_lists, N.descend

    def noted(f):
        def run(*a):
            written.append(f(*a).cache())
            return written[-1]

        return run

    monkeypatch.setattr(N, "first_lists", noted(first)), monkeypatch.setattr(N, "descend", noted(descend))
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.08 * rng.standard_normal(32)).astype(np.float32).tolist(), 1) for i in range(700)]
    rows += [(700 + i, rng.standard_normal(32).astype(np.float32).tolist(), 1) for i in range(300)]
    want = plain(rows)
    assert sum(r[1] for r in want) // 2 > 200_000
    assert run(spark, rows) == want
    assert written[0].where("not tie").count() <= N.TABLES * N.NEIGHBOURS * 1000
    assert sum(w.where("tie").count() for w in written) <= 2 * N.TABLES * 1000
    assert sum(w.count() for w in written[1:]) <= 5_000


def test_double_vectors(spark, monkeypatch):
    """Doubles beyond and below the range of floats, and cosines that floats would round over the threshold."""
    monkeypatch.setattr(N, "AUDIT", 8)
    rng = np.random.default_rng(5)
    rows, angle = [], np.arccos(0.98)
    for i in range(60):
        a = rng.normal(size=6)
        a /= np.linalg.norm(a)
        b = rng.normal(size=6)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        for turn in (0.0, angle - 1e-10, angle + 1e-10):
            scale = [1e200, 1e-200, 1.0][i % 3]
            rows.append((len(rows), [float(v) for v in scale * (np.cos(turn) * a + np.sin(turn) * b)], i % 2))
    got = {r.vec_id: r.n_links for r in N.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = [np.array(v) / np.abs(v).max() for _, v, _ in rows]
    unit = [v / np.linalg.norm(v) for v in unit]
    assert got == {i: sum(j != i and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.98 for j in range(len(rows))) for i in range(len(rows))}
    assert {1, 2} <= set(got.values())


def test_audits_of_tables_without_links_are_bounded(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(N, "AUDIT", 16)
    monkeypatch.setattr(N, "LIMIT", 4)
    real = N.audit
    monkeypatch.setattr(N, "audit", lambda placed, draws, first, last: drawn.append(last - first + 1) or real(placed, draws, first, last))
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(size=24)], 0) for i in range(1_500)]
    got = N.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == 1_500 and {r.n_links for r in got} == {0} and sum(drawn) == 4
