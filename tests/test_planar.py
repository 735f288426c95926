"""Shapes with holes and parts against plain versions."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanroute.functions import wkb as W
from spanroute.operators import planar as P


def box(x0, y0, x1, y1):
    return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], float)


def star(rng, cx, cy, radius, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    away = [radius * rng.uniform(0.5, 1) for _ in turns]
    return np.array([(cx + r * math.cos(t), cy + r * math.sin(t)) for r, t in zip(away, turns, strict=True)])


def covered(parts, x, y):
    """A plain test: on any edge, or within an odd number of rings."""
    odd = False
    for ring in (r for p in parts for r in p):
        for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
            if (bx - ax) * (y - ay) - (by - ay) * (x - ax) == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def frame(spark, rows, names="id long, geometry binary"):
    return spark.createDataFrame([(*r[:-1], bytearray(W.encode(r[-1]))) for r in rows], names)


def shape_of(data):
    return [[r[:-1] for r in p] for p in W.polygons(bytes(data))]


def area_of(data):
    return sum(W.signed_area(r) if i == 0 else -abs(W.signed_area(r)) for p in shape_of(data) for i, r in enumerate(p))


def test_well_known_binary():
    parts = [[box(0, 0, 4, 4), box(1, 1, 2, 2)[::-1]], [box(6, 6, 7, 7)]]
    for some in (parts, parts[:1], []):
        back = list(W.polygons(W.encode(some)))
        assert [[r[:-1].tolist() for r in p] for p in back] == [[r.tolist() for r in p] for p in some]
    big = struct.pack(">BII", 0, 3, 1) + struct.pack(">I", 4) + struct.pack(">8d", 0, 0, 1, 0, 1, 1, 0, 0)
    high = struct.pack("<BIIII", 1, 0x80000000 | 0x20000000 | 3, 4326, 1, 4) + struct.pack("<12d", 0, 0, 9, 1, 0, 9, 1, 1, 9, 0, 0, 9)
    iso = struct.pack("<BIII", 1, 1003, 1, 4) + struct.pack("<12d", 0, 0, 9, 1, 0, 9, 1, 1, 9, 0, 0, 9)
    for data in (big, high, iso):
        assert next(W.polygons(data))[0].tolist() == [[0, 0], [1, 0], [1, 1], [0, 0]]
    for bad in (b"", big[:-3], big + b"x", struct.pack("<BIdd", 1, 1, 0, 0), b"\x01\x03"):
        with pytest.raises(ValueError):
            list(W.polygons(bad))


def test_thousand_shapes_cover_as_a_plain_test_says(spark):
    rng = random.Random(1)
    rows, points = [], []
    for i in range(1000):
        cx, cy = rng.randrange(-60, 60), rng.randrange(-40, 40)
        parts = [[star(rng, cx, cy, 3, rng.randrange(3, 12)), star(rng, cx, cy, 0.6, 5)]]
        if i % 3 == 0:
            parts.append([box(cx + 4, cy, cx + 6, cy + 2), box(cx + 4.5, cy + 0.5, cx + 5, cy + 1)])
        rows.append((i, parts))
    for i in range(400):
        points.append((i, float(rng.randrange(-60, 60)) if i % 2 else rng.uniform(-60, 60), float(rng.randrange(-40, 40)) if i % 2 else rng.uniform(-40, 40)))
    points += [(1000, None, 1.0), (1001, 1.0, None)]
    at = spark.createDataFrame(points, "p long, lon double, lat double")
    got = {tuple(r) for r in P.covers(at, frame(spark, rows), "p", "id").collect()}
    want = {(p, i) for p, x, y in points if x is not None and y is not None for i, parts in rows if abs(x - parts[0][0][:, 0].mean()) < 12 and covered(parts, x, y)}
    assert got == want and len(want) > 300


def test_edges_holes_and_parts(spark):
    parts = [[box(0, 0, 10, 10), box(2, 2, 5, 5)], [box(20, 0, 30, 10)]]
    points = [(0, 1.0, 1.0), (1, 3.0, 3.0), (2, 2.0, 3.0), (3, 0.0, 4.0), (4, 10.0, 10.0), (5, 15.0, 5.0), (6, 25.0, 5.0), (7, 10.0, 11.0), (8, 7.0, 10.0)]
    at = spark.createDataFrame(points, "p long, lon double, lat double")
    shapes = frame(spark, [(1, parts)])
    assert {r.p for r in P.covers(at, shapes, "p", "id").collect()} == {0, 2, 3, 4, 6, 8}
    assert {r.p for r in P.covers(at, shapes, "p", "id", edge=False).collect()} == {0, 6}
    assert P.covers(at, shapes.limit(0), "p", "id").count() == 0
    plan = P.covers(at, shapes, "p", "id")._jdf.queryExecution().executedPlan().toString()
    assert "points" not in plan.split("Join")[0]


def plain_union(boxes):
    xs, ys = sorted({v for b in boxes for v in b[::2]}), sorted({v for b in boxes for v in b[1::2]})
    return sum((x1 - x0) * (y1 - y0) for x0, x1 in zip(xs, xs[1:], strict=False) for y0, y1 in zip(ys, ys[1:], strict=False) if any(b[0] <= x0 and x1 <= b[2] and b[1] <= y0 and y1 <= b[3] for b in boxes))


def test_unions_of_rectangles(spark):
    rng = random.Random(2)
    rows, plain = [], {}
    for g in range(25):
        boxes = [(x, y, x + rng.randrange(1, 6), y + rng.randrange(1, 6)) for x, y in ((rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(1, 14)))]
        plain[g] = plain_union(boxes)
        rows += [(g, i, [[box(*b)[:: rng.choice([1, -1])]]]) for i, b in enumerate(boxes)]
    edge = P.union(frame(spark, rows, "g long, i long, geometry binary"), "g")
    assert {r.g: r.area for r in P.areas(edge, "g").collect()} == pytest.approx(plain)
    whole = P.assembled(P.traced(edge, "g"), "g")
    assert {r.g: area_of(r.geometry) for r in whole.collect()} == pytest.approx(plain)
    assert {r["valid"] for r in P.check(whole, "g").collect()} == {True}


def test_union_of_curved_shapes_by_sampling(spark):
    rng = random.Random(4)
    parts = [[star(rng, 5 * math.cos(i), 5 * math.sin(i), 4, 40)] for i in range(12)]
    edge = P.union(frame(spark, [(1, i, [p]) for i, p in enumerate(parts)], "g long, i long, geometry binary"), "g")
    whole = P.assembled(P.traced(edge, "g"), "g").collect()[0].geometry
    shape = shape_of(whole)
    for _ in range(1500):
        x, y = rng.uniform(-9, 9), rng.uniform(-9, 9)
        assert covered(shape, x, y) == any(covered([p], x, y) for p in parts)


def test_holes_of_members_stay_around_other_cities(spark):
    """A frame of four members around a hole with another group's city, and a frame whose hole holds its own."""
    rows = [(g, i, [[box(*b)]]) for g, dx in ((1, 0), (2, 20), (3, 40)) for i, b in enumerate([(dx, 0, dx + 10, 3), (dx, 7, dx + 10, 10), (dx, 3, dx + 3, 7), (dx + 7, 3, dx + 10, 7)])]
    cities = spark.createDataFrame([("a", 5.0, 5.0, 9), ("b", 25.0, 5.0, 2), ("c", 25.0, 3.0, None), ("d", 45.0, 5.0, None), ("e", 45.0, 5.5, 3)], "city string, lon double, lat double, owner long")
    got = {r.g: area_of(r.geometry) for r in P.member_union(frame(spark, rows, "g long, i long, geometry binary"), cities, "g").collect()}
    assert got == pytest.approx({1: 84.0, 2: 100.0, 3: 84.0})


def test_repair(spark):
    bow = [[np.array([(0, 0), (4, 4), (4, 0), (0, 4)], float)]]
    turn = [2 * math.pi * 2 * k / 5 for k in range(5)]
    pentagram = [[np.array([(math.cos(t), math.sin(t)) for t in turn])]]
    touching = [[box(0, 0, 6, 6), np.array([(0, 3), (2, 2), (2, 4)], float)]]
    twice = [[box(0, 0, 2, 2)], [box(1, 0, 3, 2)]]
    fine = [[box(0, 0, 4, 4), box(1, 1, 2, 2)]]
    shapes = frame(spark, list(enumerate([bow, pentagram, touching, twice, fine])))
    assert {r.id: r.valid for r in P.check(shapes, "id").collect()} == {0: False, 1: False, 2: True, 3: False, 4: True}
    done = P.repaired(shapes, "id")
    got = {r.id: shape_of(r.geometry) for r in done.collect()}
    assert sorted(abs(W.signed_area(p[0])) for p in got[0]) == [4.0, 4.0] and all(len(p[0]) == 3 for p in got[0])
    assert len(got[1]) == 5 and all(len(p[0]) == 3 for p in got[1])
    assert [len(p) for p in got[2]] == [2] and [len(p) for p in got[4]] == [2]
    assert sorted(abs(W.signed_area(p[0])) for p in got[3]) == [2.0, 2.0]
    assert {r["valid"] for r in P.check(done, "id").collect()} == {True}


def test_readable(spark):
    good, empty = W.encode([[box(0, 0, 1, 1)]]), W.encode([])
    point, endless = struct.pack("<BIdd", 1, 1, 0, 0), W.encode([[np.array([(0, 0), (1, math.inf), (2, 0)])]])
    rows = spark.createDataFrame([(i, None if d is None else bytearray(d)) for i, d in enumerate([good, empty, point, endless, None, b"\x01"])], "id long, geometry binary")
    assert [r.ok for r in rows.select("id", P.readable("geometry").alias("ok")).orderBy("id").collect()] == [True, False, False, False, False, False]


def test_a_hundred_thousand_corners(spark):
    n = 100_000
    t = np.linspace(0, 2 * math.pi, n, endpoint=False)
    ring = np.column_stack([(10 + np.sin(40 * t)) * np.cos(t), (10 + np.sin(40 * t)) * np.sin(t)])
    crossed = ring.copy()
    crossed[[10, 11]] = crossed[[11, 10]]
    shapes = frame(spark, [(1, [[ring]]), (2, [[crossed]])])
    assert {r.id: r.valid for r in P.check(shapes, "id").collect()} == {1: True, 2: False}


def test_grown_and_core(spark):
    square, sliver = [[box(0, 0, 10, 10), box(4, 4, 6, 6)]], [[box(20, 0, 30, 0.5)]]
    shapes = frame(spark, [(1, square), (2, sliver), (3, [*square, *sliver])])
    got = {r.id: r.area for r in P.areas(P.core(shapes, "id", 1.0), "id").collect()}
    hole = 4 + 4 * 2 * 1 + math.pi
    assert got == pytest.approx({1: 64 - hole, 2: 5.0, 3: 69 - hole}, abs=0.1)
    got = {r.id: r.area for r in P.areas(P.grown(shapes, "id", 0.5), "id").collect()}
    assert got == pytest.approx({1: 100 + 20 + math.pi / 4 - 1, 2: 5 + 10.5 + math.pi / 4, 3: 119 + 15.5 + math.pi / 2}, abs=0.05)


def test_what_both_cover(spark):
    a, b = frame(spark, [(1, [[box(0, 0, 4, 4), box(1, 1, 2, 2)]]), (2, [[box(0, 0, 1, 1)]])]), frame(spark, [(1, [[box(1, 1, 6, 3)]]), (2, [[box(1, 0, 2, 1)]])])
    assert {r.id: r.area for r in P.areas(P.shared(a, b, "id"), "id").collect()} == {1: 5.0}


def test_clear_of_other_owners(spark):
    rng = random.Random(7)
    rows = [(i, i % 3, [[star(rng, x, y, 1.5, 9)]]) for i, (x, y) in enumerate([(-178.4, 10), (-176, 10), (178.6, 11), (0, 85), (3, 85), (10, 50), (12, 50), (14, 50), (11, 52), (9, 89.4 - 1.5)])]
    points = [(i, rng.uniform(-180, 180), rng.uniform(83, 89.9)) for i in range(60)] + [(100 + i, ((x + 180) % 360) - 180, rng.uniform(8, 12)) for i, x in enumerate(rng.uniform(176, 187) for _ in range(200))] + [(400 + i, rng.uniform(8, 16), rng.uniform(48, 54)) for i in range(300)]
    km = 25.0

    def near(parts, x, y):
        if any(covered(parts, x + w, y) for w in (0,)):
            return True
        per = math.pi / 180 * P.EARTH_KM
        for ring in (r for p in parts for r in p):
            q = np.column_stack([((ring[:, 0] - x + 180) % 360 - 180) * per * math.cos(math.radians(y)), (ring[:, 1] - y) * per])
            for a, b in zip(q, np.roll(q, -1, axis=0), strict=True):
                d = b - a
                k = min(1, max(0, -(a @ d) / (d @ d)))
                if np.hypot(*(a + k * d)) <= km:
                    return True
        return False

    want = {}
    for p, x, y in points:
        owners = {o for _, o, parts in rows if near(parts, x, y)}
        if len(owners) == 1:
            want[p] = owners.pop()
    at = spark.createDataFrame(points, "p long, lon double, lat double")
    got = P.clear(at, frame(spark, rows, "id long, owner int, geometry binary"), "owner", "p", "id", km)
    assert {r.p: r.owner for r in got.collect()} == want and len(want) > 50
    assert got.where(F.col("owner").isNull()).count() == 0


def test_member_unions_of_the_tables(spark, sf_small):
    """Holes by flood fill over whole degrees, from outside."""
    from spanroute import plans

    rows = spark.read.parquet(f"{sf_small}/supplier.parquet").select("s_nationkey", "s_suppkey").collect()
    boxes = {r.s_suppkey: (r.s_nationkey, x := r.s_suppkey * 37 % 40, y := r.s_suppkey * 53 % 25, x + 5 + r.s_suppkey % 20, y + 4 + r.s_suppkey % 11) for r in rows}
    got = {r.s_nationkey: r for r in plans.QUERIES["G5_member_unions"](spark, sf_small).collect()}
    for nation in {b[0] for b in boxes.values()}:
        full = {(i, j) for n, x0, y0, x1, y1 in boxes.values() if n == nation for i in range(x0, x1) for j in range(y0, y1)}
        out, todo = set(), [(-1, -1)]
        while todo:
            i, j = todo.pop()
            if (i, j) in out or (i, j) in full or not (-1 <= i <= 70 and -1 <= j <= 45):
                continue
            out.add((i, j))
            todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
        holes = {(i, j) for i in range(-1, 71) for j in range(-1, 46)} - full - out
        assert not holes, "the smallest tables have no holes; larger ones are tested above"
        assert got[nation].area == len(full) and got[nation].holes == 0


def test_places_and_equal_shapes_are_held_against_borders_once(spark):
    from tests.test_tiles import moved

    box = F.array(F.array(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (3, 0), (3, 2), (0, 2))])))
    far = F.array(F.array(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((2, 0), (9, 0), (9, 2), (2, 2))])))
    shapes = spark.range(400).select(F.col("id").alias("s"), F.when(F.col("id") < 399, 1).otherwise(2).alias("o"), P.encoded(F.when(F.col("id") < 399, box).otherwise(far)).alias("geometry"))
    points = spark.range(400).selectExpr("id as p", "id % 4 + 0.8d as lon", "1d as lat").union(spark.createDataFrame([(1000, None, 1.0), (1001, 40.0, 1.0)], "p long, lon double, lat double"))
    before = moved(spark)
    got = {(r.p, r.o) for r in P.clear(points, shapes, "o", "p", "s", 40.0).collect()}
    assert got == {(i, 2 if i % 4 == 3 else 1) for i in range(400) if i % 4 in (0, 3)}
    assert moved(spark) - before < 10_000  # all points with all shapes that are near are over 100,000
