"""Pairs of owners counted in tiles, against all pairs, over more owners than a block holds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanroute.operators import matching as M
from spanroute.operators import overlap as O
from spanroute.operators import tiles as T


def moved(spark) -> int:
    """Rows written to shuffles so far."""
    sc = spark.sparkContext
    empty = sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, *empty)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(5)
    held = rng.random((2 * T.BLOCK + 300, 250)) < 0.02
    held[:, :2] = True  # all have these
    held[5:40] |= held[100:135]
    o, e = np.nonzero(held)
    return held.astype(np.float32), spark.createDataFrame([(f"o{x:05d}", int(y)) for x, y in zip(o, e, strict=True)] + [(None, 1), ("o00001", None)], "o string, e long")


def test_shared_counts_over_blocks(spark, sets):
    held, rows = sets
    want, own = held @ held.T, held.sum(1)
    own[1] += 1  # null counts as had, but is never shared
    before = moved(spark)
    got = O.shared_counts(rows, "o", "e").agg(F.count("*"), F.sum("shared"), F.sum(F.col("shared") * F.col("own")), F.sum(F.col("shared") * F.substring("a", 2, 9).cast("long") * F.col("other"))).first()
    np.fill_diagonal(want, 0)
    want, own = want.astype(np.int64), own.astype(np.int64)
    assert tuple(got) == ((want > 0).sum(), want.sum(), (want.sum(1) * own).sum(), ((want * own[None, :]).sum(1) * np.arange(len(own))).sum())
    assert moved(spark) - before < 10 * rows.count()  # a row for each pair and element in common would be 11 million


@pytest.mark.parametrize("least", [0.0, 0.8])
def test_shared_in_blocks_of_few_elements_and_in_slices(spark, sets, least):
    held, rows = sets
    small = rows.where("o is null or o < 'o00150'")
    big = spark.range(250).selectExpr("'o9' as o", "id as e")
    every = np.vstack([held[:150], np.ones((1, 250), np.float32)]).astype(np.int64)
    want, own = every @ every.T, every.sum(1)
    own[1] += 1
    np.fill_diagonal(want, 0)
    want[want < least * own[:, None]] = 0
    of = {150: "o9"} | {i: f"o{i:05d}" for i in range(150)}
    for side in (1 << 20, 60, 7):  # one block, slices of the owner with 250, and more of these than owners have elements
        got = {(r.a, r.b): (r.shared, r.own, r.other) for r in T.shared(small.union(big), "o", "e", least, side=side).collect()}
        assert got == {(of[i], of[j]): (want[i, j], own[i], own[j]) for i, j in zip(*np.nonzero(want), strict=True)}
    named = small.union(big).selectExpr("o", "concat('e', e) as e")
    assert {(r.a, r.b): r.shared for r in T.shared(named, "o", "e", least, side=60).collect()} == {k: v[0] for k, v in got.items()}


def test_an_element_of_few_owners_goes_to_a_tile_for_each_block(spark):
    rows = spark.range(200_000).selectExpr("id % 20000 as o", "pmod(hash(id), 10000) as e")  # in many more blocks of 1,024 than elements have owners
    before = moved(spark)
    assert T.shared(rows, "o", "e", 0.9).count() < 100
    assert moved(spark) - before < 5 * 200_000  # a row for every two blocks with an element in common would come on top


def test_containments_over_blocks(spark, sets):
    held, rows = sets
    want, own = held @ held.T, held.sum(1)
    own[1] += 1
    hit = (want >= 0.8 * own[:, None]) & (own[None, :] >= 1.5 * own[:, None])
    np.fill_diagonal(hit, False)
    got = O.containments(rows, "o", "e", 0.8, 1.5).collect()
    assert {(int(r.a[1:]), int(r.b[1:]), r.shared, r.own, r.other) for r in got} == {(a, b, want[a, b], own[a], own[b]) for a, b in zip(*np.nonzero(hit), strict=True)}
    assert len(got) == hit.sum() > 30


def test_static_links_of_a_file_that_very_many_have(spark):
    rt = spark.range(3000).selectExpr("id as rt_id", "if(id < 2990, 0, id) as file", "id % 2 as host").union(spark.createDataFrame([(2995, 2996, 7)], "rt_id long, file long, host long"))
    st = spark.range(3000).selectExpr("10000 + id as static_id", "if(id < 2990, 0, id) as file", "5 as host")
    before = moved(spark)
    got = {r.rt_id: (r.static_id, r.method) for r in M.static_link(rt, st, spark.createDataFrame([], "rt_id long, static_id long")).collect()}
    assert got == {i: (10000 + i, "same_file") if i >= 2990 and i != 2995 else (None, "none") for i in range(3000)}
    assert moved(spark) - before < 100_000  # nine million pairs have that file


def test_lines_beside_counted_in_tiles(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(900):
        x, y = rng.uniform(-0.02, 0.02, 2)
        w, h = rng.choice([0, 0.004, 0.05], 2) * rng.random(2)
        rows.append((f"p{i % 2}", f"f{i % 37}", i, int(i % 3), "n" if i % 50 else None, float(x), float(x + w), float(y), float(y + h)))
    rows += [("p0", "f1", 5000, 0, "n", None, 1.0, 0.0, 1.0)]
    lines = spark.createDataFrame(rows, "place_id string, feed_id string, line_id long, family int, name string, xmin double, xmax double, ymin double, ymax double")
    met = O.beside(lines)
    assert sorted(T.beside_counts(lines).collect()) == sorted(met.groupBy("place_id", "a", "b").agg(F.count("*").alias("n")).collect())
    for least in (0.1, 0.6):
        assert sorted(T.beside_counts(lines, each=True, least=least).drop("n").collect()) == sorted(O.overlap_shares(lines, met, least).collect()) != []
    close = spark.range(2400).selectExpr("'p' as place_id", "concat('f', id % 300) as feed_id", "id as line_id", "1 as family", "'n' as name", "id % 7 / 7000 as xmin", "id % 7 / 7000 as xmax", "0d as ymin", "0d as ymax")
    before = moved(spark)
    assert {r.share for r in T.beside_counts(close, each=True).collect()} == {1.0}
    assert moved(spark) - before < 50_000  # nearly six million pairs of lines run beside each other


def test_lines_of_orders_in_tasks_of_a_bounded_size(spark, sf_small, monkeypatch):
    from spanroute.plans import bindings as B

    monkeypatch.setattr(B, "LINES", 300, raising=False)
    t = B.Tables(spark, sf_small)
    lines = t.read("lineitem").count()
    assert t.facts().rdd.getNumPartitions() == -(-lines // 300) > 8
    before = moved(spark)
    t.pairs().collect()
    assert moved(spark) - before < 2.6 * lines + 2 * t.read("orders").count()  # a row for each part and one for each order of a line were more


def test_changed_edges_read_the_lines_once(spark, sf_small):
    from spanroute import plans

    assert plans.QUERIES["W12_change_ranking"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


def test_cells_of_shapes_are_not_broadcast(spark, sf_small):
    from spanroute import plans

    plan = plans.QUERIES["G11_clear_of_borders"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=merge") >= 3


def test_days_of_trips_take_one_pass_for_calendars_and_one_for_exceptions(spark, sf_small):
    from spanroute import plans

    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    before = moved(spark)
    plans.QUERIES["T9_service_end"](spark, sf_small).collect()
    assert moved(spark) - before < 3 * lines  # a calendar for each use of it moved nearly five times as many
