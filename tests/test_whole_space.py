"""Queries over shapes against all pairs."""

from spanroute import plans
from spanroute.operators import spatial as S
from spanroute.plans.bindings import Tables
from spanroute.plans.space import areas, coordinates, polygons


def test_shared_areas_of_all_pairs(spark, sf_small):
    t = Tables(spark, sf_small)
    pairs = polygons(t).select("label", "ring").crossJoin(areas(t).drop("label"))
    every: dict = {}
    for r in pairs.select("label", "place_id", S.shared_area("ring", "xmin", "ymin", "xmax", "ymax").alias("shared")).collect():
        every[r.label, r.place_id] = every.get((r.label, r.place_id), 0.0) + r.shared
    got = {(r.label, r.place_id): r.shared for r in plans.QUERIES["G7_shared_areas"](spark, sf_small).collect()}
    assert got == {k: round(v, 6) for k, v in every.items() if round(v, 6) > 0}


def test_hulls_hold_all_their_points(spark, sf_small):
    held = {(r.vec_id, r.place) for r in plans.QUERIES["J13_points_in_polygons"](spark, sf_small).collect()}
    own = {(r.vec_id, r.label) for r in coordinates(Tables(spark, sf_small)).collect()}
    assert own and own <= held


def test_hulls_across_the_antimeridian_have_two_parts(spark):
    rows = [("p", x, y) for x, y in [(179.3, 0.0), (178.1, 2.0), (-179.3, 1.0), (-178.7, -3.0), (-179.9, 2.5)]]
    rows += [("plain", -10.0, 0.0), ("plain", 10.0, 0.0), ("plain", 0.0, 9.0), ("edge", 180.0, 1.0), ("edge", -179.0, 2.0), ("one", 5.0, 5.0), ("none", None, 1.0)]
    rows += [("wide", float(x), float(x % 7)) for x in range(-180, 180, 10)]
    points = spark.createDataFrame(rows, "id string, lon double, lat double")
    hulls = S.hulls(points, "id")
    boxes = {(r.id, r.part): (r.xmin, r.xmax) for r in hulls.collect()}
    assert boxes == {("p", 0): (178.1, 180.0), ("p", 1): (-180.0, -178.7), ("plain", 0): (-10.0, 10.0), ("edge", 0): (180.0, 180.0), ("edge", 1): (-180.0, -179.0), ("one", 0): (5.0, 5.0), ("wide", 0): (-180.0, 170.0)}
    held = S.points_in_polygons(points.withColumnRenamed("id", "own"), hulls).select("own", "lon", "id").collect()
    assert {(r.own, r.lon) for r in held if r.own == r.id} == {r[:2] for r in rows if r[1] is not None}
    assert not [r for r in held if r.id == "p" and r.own in ("plain", "one")]


def test_widest_gap_is_that_of_all_longitudes(spark):
    import random

    rng = random.Random(3)
    sets = {k: sorted({round(rng.uniform(-180, 180) / w, 3) for _ in range(n)}) for k, (n, w) in enumerate([(1, 1), (2, 1), (7, 1), (40, 30), (400, 400), (900, 1)])}
    points = spark.createDataFrame([(k, x) for k, xs in sets.items() for x in xs], "k int, x double")
    got = {r.k: (r.west, r.east, r.cut) for r in S.widest_gap(points, "k", "x").collect()}
    for k, xs in sets.items():
        gaps = [(b - a, -a, a, b) for a, b in zip(xs, [*xs[1:], xs[0] + 360], strict=True)]
        size, _, east, west = max(gaps)
        cut = west if east < xs[-1] and size > xs[0] + 360 - xs[-1] else None
        assert got[k] == (west - 360 if west >= 180 else west, east, cut)


def test_simplified_rings_stay_valid():
    import numpy as np

    from spanroute.functions import geometry as G

    teeth = np.array([(0, 0), (4, 0), (4, 1), (2.1, 0.2), (2, 3), (1.9, 0.2), (0, 1)], float)
    for tolerance in (0.01, 0.5, 1.0, 10.0):
        assert G.valid(G.simplify_ring(teeth, tolerance))
    assert len(G.simplify_ring(np.array([(0, 0), (1, 0.01), (2, 0), (2, 2), (0, 2)], float), 0.1)) == 4
