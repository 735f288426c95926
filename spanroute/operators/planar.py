"""Shapes with holes and parts as relations of edges: cover, overlay, repair, buffers and clearance.

A shape is well-known binary in a column and, for work, rows of directed edges that have its
interior to their left. No operator hands a whole ring to a join: edges are dealt to the
cells of a grid of their group, meet there, and what they say is summed by aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from spanroute.functions import wkb as W
from spanroute.functions.geometry import EARTH_KM
from spanroute.sinks.scratch import written

from .spatial import cell, cells_of_boxes

#: Coordinates nearer than this, in degrees, are one place; rows of a group's grid at most.
PLACES, ROWS = 1e9, 4096
SNAP = 1 / PLACES
EDGE = ["x0", "y0", "x1", "y1"]


def rings_of(shapes: DataFrame, key: str, geometry: str) -> DataFrame:
    """key, part, ring (0 the shell), points (closed; shells counter-clockwise, holes clockwise) of shapes in well-known binary.

    Null and empty shapes have no rings; one that isn't a polygon or multipolygon, or holds
    a coordinate that isn't finite, is an error: :func:`readable` tells them beforehand.
    """
    rows = shapes.select(key, F.col(geometry).alias("_wkb")).where("_wkb is not null")
    of = f"`{key}` {rows.schema[key].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part, ring, points = [], [], [], []
            for i, data in enumerate(batch.column(1).to_pylist()):
                for p, polygon in enumerate(W.polygons(data)):
                    for r, corners in enumerate(polygon):
                        if not np.isfinite(corners).all():
                            raise ValueError("a shape has a coordinate that isn't finite")
                        if len(corners) > 3:
                            at.append(i), part.append(p), ring.append(r)
                            points.append(corners[::-1] if (W.signed_area(corners) > 0) == (r > 0) else corners)
            flat = np.vstack(points) if points else np.zeros((0, 2))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in points])]).astype("i4")
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["x", "y"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(part, pa.int32()), pa.array(ring, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pairs)], names=[key, "part", "ring", "points"]
            )

    return rows.mapInArrow(run, f"{of}, part int, ring int, points array<struct<x: double, y: double>>")


@F.pandas_udf(BooleanType())
def readable(geometry: pd.Series) -> pd.Series:
    """Whether well-known binary is a polygon or multipolygon, not empty, of finite coordinates."""

    def good(data: bytes | None) -> bool:
        try:
            found = [r for p in W.polygons(bytes(data)) for r in p] if data is not None else []
        except ValueError:
            return False
        return bool(found) and all(len(r) > 3 and np.isfinite(r).all() for r in found)

    return pd.Series([good(d) for d in geometry], dtype="bool")


@F.arrow_udf(BinaryType())
def encoded(shapes: pa.Array) -> pa.Array:
    """Well-known binary of lists of polygons, each a list of rings of structs (x, y); null of null."""

    def one(shape: list | None) -> bytes | None:
        return None if shape is None else W.encode([[np.array([(p["x"], p["y"]) for p in ring]) for ring in polygon] for polygon in shape])

    return pa.array([one(s) for s in shapes.to_pylist()], pa.binary())


def edges_of(rings: DataFrame, *keys: str) -> DataFrame:
    """keys, x0, y0, x1, y1: the edges of rings with ``points``."""
    n = F.size("points") - 1
    zipped = F.arrays_zip(F.slice("points", 1, n).alias("a"), F.slice("points", 2, n).alias("b"))
    rows = rings.where(F.size("points") > 1).select(*keys, F.explode(zipped).alias("e"))
    rows = rows.select(*keys, F.col("e.a.x").alias("x0"), F.col("e.a.y").alias("y0"), F.col("e.b.x").alias("x1"), F.col("e.b.y").alias("y1"))
    return rows.where("x0 <> x1 or y0 <> y1")


def _grids(edges: DataFrame, key: str) -> DataFrame:
    """key, box, rows and side: a grid for each group, its rows about as high as its edges, its cells about as large."""
    lie = edges.groupBy(key).agg(
        F.min(F.least("x0", "x1")).alias("west"), F.min(F.least("y0", "y1")).alias("south"), F.max(F.greatest("x0", "x1")).alias("east"), F.max(F.greatest("y0", "y1")).alias("north"),
        F.avg(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0")))).alias("long"), F.avg(F.abs(F.col("y1") - F.col("y0"))).alias("high"),
    )
    height, span = F.col("north") - F.col("south"), F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"))
    rows = F.greatest(F.lit(1), F.least(F.lit(ROWS), F.ceil(2 * height / F.col("high")))).cast("int")
    return lie.select(key, "west", "south", "east", "north", F.coalesce(rows, F.lit(1)).alias("rows"), F.greatest("long", span / 65536, F.lit(10 * SNAP)).alias("side"))


def _row(y: Column) -> Column:
    """The row of a height in its group's grid; it never falls as the height rises, so an edge at a height is in that height's row."""
    share = (y - F.col("south")) / (F.col("north") - F.col("south")) * F.col("rows")
    return F.coalesce(F.least(F.floor(share).cast("int"), F.col("rows") - 1), F.lit(0))


def _dealt_to_rows(edges: DataFrame) -> DataFrame:
    return edges.withColumn("row", F.explode(F.sequence(_row(F.least("y0", "y1")), _row(F.greatest("y0", "y1")))))


def _crossing(y: Column) -> Column:
    """Where an edge that spans a height is at it."""
    return (F.col("x1") - F.col("x0")) * (y - F.col("y0")) / (F.col("y1") - F.col("y0")) + F.col("x0")


def _spans(y: Column) -> Column:
    return (F.col("y0") > y) != (F.col("y1") > y)


def _alike(shapes: DataFrame, shape: str, geometry: str) -> tuple[DataFrame, DataFrame]:
    """shape, _as: each shape and the first of equal geometry; and the shapes that are the first."""
    made = shapes.where(F.col(geometry).isNotNull()).groupBy(shape).agg(F.array_sort(F.collect_list(F.sha2(F.col(geometry), 256))).alias("_made"))
    alike = written(made.join(made.groupBy("_made").agg(F.min(shape).alias("_as")), "_made").select(shape, "_as"))
    return alike, shapes.join(alike.where(F.col(shape) == F.col("_as")).select(shape), shape, "left_semi")


def covers(points: DataFrame, shapes: DataFrame, point: str, shape: str, geometry: str = "geometry", x: str = "lon", y: str = "lat", edge: bool = True) -> DataFrame:
    """point, shape: which shapes, with their holes and parts, cover which points; with ``edge`` false, those on an edge don't count.

    Points at one place, and shapes of equal geometry, are tested once and come back by joins. A place meets the
    shapes whose box holds it, then only the edges in its row of each, and the crossings of its ray are
    summed there; rings never travel with points. Ids of points are unique.
    """
    alike, first = _alike(shapes, shape, geometry)
    edges = written(edges_of(rings_of(first, shape, geometry), shape))
    grids = written(_grids(edges, shape))
    boxes = grids.select(F.col(shape), "south", "north", "rows", F.col("west").alias("xmin"), F.col("south").alias("ymin"), F.col("east").alias("xmax"), F.col("north").alias("ymax"))
    at = points.select(F.col(point), F.col(x).alias("px"), F.col(y).alias("py")).where("px is not null and py is not null")
    places = at.select("px", "py").distinct()
    near = places.withColumn("cx", cell(F.col("px"))).withColumn("cy", cell(F.col("py"))).join(cells_of_boxes(boxes).hint("merge"), ["cx", "cy"])
    near = near.where("px between xmin and xmax and py between ymin and ymax").select(shape, "px", "py", _row(F.col("py")).alias("row"))
    dealt = _dealt_to_rows(edges.join(grids, shape)).select(shape, "row", *EDGE)
    px, py = F.col("px"), F.col("py")
    beside = (F.col("x1") - F.col("x0")) * (py - F.col("y0")) - (F.col("y1") - F.col("y0")) * (px - F.col("x0")) == 0
    on = beside & px.between(F.least("x0", "x1"), F.greatest("x0", "x1")) & py.between(F.least("y0", "y1"), F.greatest("y0", "y1"))
    crossed = F.when(_spans(py) & (px < _crossing(py)), 1).otherwise(0)
    # A place has one row in a shape's grid, so with the row among the keys the sums need no other shuffle than the join.
    met = near.join(dealt.hint("merge"), [shape, "row"]).groupBy(shape, "row", "px", "py").agg(F.sum(crossed).alias("crossed"), F.max(on).alias("on"))
    held = met.where((F.col("on") | (F.col("crossed") % 2 == 1)) if edge else (~F.col("on") & (F.col("crossed") % 2 == 1)))
    every = held.select(F.col(shape).alias("_as"), "px", "py").join(alike, "_as").select(shape, "px", "py")
    return every.join(at, ["px", "py"]).select(point, shape)


def _cells_of_edges(edges: DataFrame, side: Column, pad: Column) -> DataFrame:
    """A row for each cell (cx, cy) that an edge comes within ``pad`` of, column by column, so a long edge takes as many cells as it is long."""
    west, east = F.least("x0", "x1") - pad, F.greatest("x0", "x1") + pad
    rows = edges.withColumn("_side", side).withColumn("_pad", pad).withColumn("cx", F.explode(F.sequence(F.floor(west / side).cast("long"), F.floor(east / side).cast("long"))))
    left, right = F.col("cx") * F.col("_side") - F.col("_pad"), (F.col("cx") + 1) * F.col("_side") + F.col("_pad")
    slope = (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0"))

    def height(x: Column) -> Column:
        inside = F.greatest(F.least("x0", "x1"), F.least(F.greatest("x0", "x1"), x))
        return F.when(F.col("x0") == F.col("x1"), F.col("y0")).otherwise(F.col("y0") + slope * (inside - F.col("x0")))

    flat = F.col("x0") == F.col("x1")
    low = F.when(flat, F.least("y0", "y1")).otherwise(F.least(height(left), height(right))) - F.col("_pad")
    high = F.when(flat, F.greatest("y0", "y1")).otherwise(F.greatest(height(left), height(right))) + F.col("_pad")
    rows = rows.withColumn("cy", F.explode(F.sequence(F.floor(low / F.col("_side")).cast("long"), F.floor(high / F.col("_side")).cast("long"))))
    return rows.drop("_side", "_pad")


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _place(c: Column) -> Column:
    """A coordinate at the nearest place of the grid of all places, ``SNAP`` apart."""
    return F.rint(c * PLACES) / PLACES


def noded(edges: DataFrame, key: str) -> DataFrame:
    """key, x0, y0, x1, y1, a, b, n, crosses: the different pieces of a group's edges once none crosses or touches another but at its ends.

    ``edges`` have a ``layer`` (0 or 1). A piece runs from its lesser end; ``a`` and ``b`` say how often edges of
    each layer run along it, less how often against it, ``n`` how many do either, and ``crosses`` whether
    it comes of an edge that another crosses between both their ends. Coordinates go to the nearest place;
    as that can bring edges together, cutting is repeated until nothing is left to cut.
    """
    x0, y0, x1, y1 = (_place(F.col(c)) for c in EDGE)
    turned = (x0 > x1) | ((x0 == x1) & (y0 > y1))
    lesser, greater = F.when(turned, _point(x1, y1)).otherwise(_point(x0, y0)), F.when(turned, _point(x0, y0)).otherwise(_point(x1, y1))
    along = F.when(turned, -1).otherwise(1)
    ways = edges.select(key, lesser.alias("p"), greater.alias("q"), F.when(F.col("layer") == 0, along).otherwise(0).alias("a"), F.when(F.col("layer") == 1, along).otherwise(0).alias("b")).where("p <> q")
    one = ways.groupBy(key, F.col("p.x").alias("x0"), F.col("p.y").alias("y0"), F.col("q.x").alias("x1"), F.col("q.y").alias("y1")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("*").alias("n"))
    one = written(one.withColumn("crosses", F.lit(False)))
    while True:
        cuts = written(_cuts(one, key))
        if cuts.isEmpty():
            return one
        one = written(_pieces(one, cuts, key))


def _cuts(one: DataFrame, key: str) -> DataFrame:
    """key, x0, y0, x1, y1, cuts, crosses: the places at which edges that others touch or cross are to be cut."""
    sides = _grids(one, key).select(key, "side")
    dealt = _cells_of_edges(one.select(key, *EDGE).join(sides, key), F.col("side"), F.lit(2 * SNAP)).select(key, "cx", "cy", *EDGE)
    left = dealt.select(key, "cx", "cy", *[F.col(c).alias(f"l{c}") for c in EDGE])
    lx, ly, mx, my, x0, y0, x1, y1 = (F.col(c) for c in ("lx0", "ly0", "lx1", "ly1", *EDGE))
    before = F.struct(lx, ly, mx, my) < F.struct(x0, y0, x1, y1)
    boxes = (F.least(lx, mx) <= F.greatest(x0, x1) + SNAP) & (F.least(x0, x1) <= F.greatest(lx, mx) + SNAP) & (F.least(ly, my) <= F.greatest(y0, y1) + SNAP) & (F.least(y0, y1) <= F.greatest(ly, my) + SNAP)
    met = left.join(dealt, [key, "cx", "cy"]).where(before & boxes)

    def on(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
        """Whether a point lies on an edge, beyond both its ends by more than is one place."""
        length = F.hypot(bx - ax, by - ay)
        off = F.abs((bx - ax) * (py - ay) - (by - ay) * (px - ax)) / length
        at = ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / length
        return (off <= SNAP) & (at > SNAP) & (at < length - SNAP)

    mine, theirs = (lx, ly, mx, my), (x0, y0, x1, y1)
    touches = [(on(px, py, *mine), "l", px, py) for px, py in ((x0, y0), (x1, y1))] + [(on(px, py, *theirs), "r", px, py) for px, py in ((lx, ly), (mx, my))]
    d = (mx - lx) * (y1 - y0) - (my - ly) * (x1 - x0)
    t = ((x0 - lx) * (y1 - y0) - (y0 - ly) * (x1 - x0)) / d
    u = ((x0 - lx) * (my - ly) - (y0 - ly) * (mx - lx)) / d
    none = ~(touches[0][0] | touches[1][0] | touches[2][0] | touches[3][0])
    ends = [(F.hypot(px - qx, py - qy) <= SNAP) for px, py in ((lx, ly), (mx, my)) for qx, qy in ((x0, y0), (x1, y1))]
    apart = ~(ends[0] | ends[1] | ends[2] | ends[3])
    proper = none & apart & (d != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
    cx, cy = lx + t * (mx - lx), ly + t * (my - ly)

    def cut(when: Column, side: str, px: Column, py: Column, crosses: bool) -> Column:
        of = (F.col(f"l{c}") if side == "l" else F.col(c) for c in EDGE)
        return F.when(when, F.struct(*[c.alias(n) for c, n in zip(of, EDGE, strict=True)], _point(_place(px), _place(py)).alias("at"), F.lit(crosses).alias("crosses")))

    cuts = [cut(w, s, px, py, False) for w, s, px, py in touches] + [cut(proper, "l", cx, cy, True), cut(proper, "r", cx, cy, True)]
    cuts = met.select(key, F.explode(F.array_compact(F.array(*cuts))).alias("c")).select(key, "c.*")
    cuts = cuts.where((F.col("at") != _point(x0, y0)) & (F.col("at") != _point(x1, y1)))  # so each cut makes two pieces, and cutting ends
    return cuts.groupBy(key, *EDGE).agg(F.collect_set("at").alias("cuts"), F.max("crosses").alias("cross"))


def _pieces(one: DataFrame, cuts: DataFrame, key: str) -> DataFrame:
    """Edges as their pieces in order, equal ones as one."""
    x0, y0, x1, y1 = (F.col(c) for c in EDGE)
    whole = one.join(cuts, [key, *EDGE], "left")
    far = F.transform(F.coalesce("cuts", F.array().cast("array<struct<x: double, y: double>>")), lambda p: F.struct(((p["x"] - x0) * (x1 - x0) + (p["y"] - y0) * (y1 - y0)).alias("d"), p.alias("p")))
    stops = F.concat(F.array(_point(x0, y0)), F.transform(F.array_sort(far), lambda s: s["p"]), F.array(_point(x1, y1)))
    whole = whole.withColumn("stops", stops).withColumn("crosses", F.col("crosses") | F.coalesce("cross", F.lit(False))).select(key, "a", "b", "n", "crosses", "stops")
    last = F.size("stops") - 1
    pieces = whole.select(key, "a", "b", "n", "crosses", F.explode(F.arrays_zip(F.slice("stops", 1, last).alias("p"), F.slice("stops", 2, last).alias("q"))).alias("e"))
    back = (F.col("e.p.x") > F.col("e.q.x")) | ((F.col("e.p.x") == F.col("e.q.x")) & (F.col("e.p.y") > F.col("e.q.y")))
    p, q = F.when(back, F.col("e.q")).otherwise(F.col("e.p")), F.when(back, F.col("e.p")).otherwise(F.col("e.q"))
    sign = F.when(back, -1).otherwise(1)
    pieces = pieces.select(key, p["x"].alias("x0"), p["y"].alias("y0"), q["x"].alias("x1"), q["y"].alias("y1"), (sign * F.col("a")).alias("a"), (sign * F.col("b")).alias("b"), "n", "crosses")
    return pieces.where("x0 <> x1 or y0 <> y1").groupBy(key, *EDGE).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n"), F.max("crosses").alias("crosses"))


def outline(pieces: DataFrame, key: str, inside: Callable[[Column, Column], Column], winding: bool = True) -> DataFrame:
    """key, x0, y0, x1, y1: the boundary of what ``inside`` says is within, the interior to its left.

    ``inside`` takes how many shapes of each layer cover a place: each piece of :func:`noded`
    sums, over the pieces to the right of its middle, how often shapes begin there, less how often they
    end, and so knows the count on both its sides. It is boundary if only one side is
    within. Without ``winding`` all pieces count alike, so that what is covered an odd number of times can be told.
    """
    grids = written(_grids(pieces, key))
    weights = [F.col("a"), F.col("b")] if winding else [F.col("n"), F.lit(0)]
    own = pieces.select(key, *EDGE, *[w.cast("long").alias(c) for w, c in zip(weights, "ab", strict=True)]).join(grids, key)
    middle = own.select(key, *[F.col(c).alias(f"l{c}") for c in EDGE], F.col("a").alias("la"), F.col("b").alias("lb"), ((F.col("x0") + F.col("x1")) / 2).alias("px"), ((F.col("y0") + F.col("y1")) / 2).alias("py"), "south", "north", "rows")
    middle = middle.withColumn("row", _row(F.col("py"))).drop("south", "north", "rows")
    dealt = _dealt_to_rows(own.where("y0 <> y1")).select(key, "row", *EDGE, "a", "b")
    other = (F.col("lx0") != F.col("x0")) | (F.col("ly0") != F.col("y0")) | (F.col("lx1") != F.col("x1")) | (F.col("ly1") != F.col("y1"))
    right = _spans(F.col("py")) & other & (_crossing(F.col("py")) > F.col("px"))
    up = F.when(F.col("y1") > F.col("y0"), 1).otherwise(-1 if winding else 1)
    group = [key, *[f"l{c}" for c in EDGE], "la", "lb"]
    beside = [F.sum(F.when(right, up * F.col(c)).otherwise(0)).alias(f"s{c}") for c in "ab"]
    met = middle.join(dealt, [key, "row"], "left").groupBy(*group).agg(*[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(beside, ("sa", "sb"), strict=True)])
    rising = F.col("ly1") > F.col("ly0")  # then the side summed is the right one, else the left
    sides = []
    for c in "ab":
        mine = F.col(f"l{c}")
        sides.append((F.when(rising, F.col(f"s{c}") + mine).otherwise(F.col(f"s{c}")), F.when(rising, F.col(f"s{c}")).otherwise(F.col(f"s{c}") - mine if winding else F.col(f"s{c}") + mine)))
    left_in, right_in = inside(sides[0][0], sides[1][0]), inside(sides[0][1], sides[1][1])
    kept = met.withColumn("left", left_in).withColumn("right", right_in).where(F.col("left") != F.col("right"))
    ends = [("lx0", "lx1"), ("ly0", "ly1"), ("lx1", "lx0"), ("ly1", "ly0")]
    return kept.select(key, *[F.when(F.col("left"), F.col(p)).otherwise(F.col(q)).alias(n) for (p, q), n in zip(ends, EDGE, strict=True)])


def traced(boundary: DataFrame, key: str) -> DataFrame:
    """key, nth, shell, size, geometry: the simple rings that a boundary runs along, each as a polygon of its own, and its place in the whole.

    Only the boundary of one group comes together, which is what its shape consists of.
    """
    of = f"`{key}` {boundary.schema[key].dataType.simpleString()}"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rings = W.trace(group[["x0", "y0"]].to_numpy(float), group[["x1", "y1"]].to_numpy(float))
        rings.sort(key=lambda r: (tuple(r.min(0)), tuple(r.max(0)), len(r)))
        rows = [(i, W.signed_area(r) > 0, abs(W.signed_area(r)), W.encode([[r]])) for i, r in enumerate(rings)]
        out = pd.DataFrame(rows, columns=["nth", "shell", "size", "geometry"])
        out.insert(0, key, group[key].iat[0] if len(group) else None)
        return out

    return boundary.groupBy(key).applyInPandas(run, f"{of}, nth int, shell boolean, size double, geometry binary")


def assembled(rings: DataFrame, key: str) -> DataFrame:
    """key, geometry: one shape of the ``rings`` of :func:`traced`, holes in the smallest shell around them."""
    of = f"`{key}` {rings.schema[key].dataType.simpleString()}"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [next(W.polygons(bytes(g)))[0][:-1] for g in group.sort_values("nth")["geometry"]]
        return pd.DataFrame({key: [group[key].iat[0]], "geometry": [W.encode(W.nest(parts))]})

    return rings.select(key, "nth", "geometry").groupBy(key).applyInPandas(run, f"{of}, geometry binary")


def areas(boundary: DataFrame, key: str) -> DataFrame:
    """key, area in square degrees of what a boundary has to its left; no ring need be put together for it."""
    piece = (F.col("x0") - F.col("x1")) * (F.col("y0") + F.col("y1")) / 2
    return boundary.groupBy(key).agg(F.sum(piece).alias("area"))


def layered(shapes: DataFrame, key: str, geometry: str = "geometry", layer: int = 0) -> DataFrame:
    """key, x0, y0, x1, y1, layer of the edges of the shapes of each group; each shape is valid by itself."""
    return edges_of(rings_of(shapes, key, geometry), key).select(key, *EDGE, F.lit(layer).alias("layer"))


def union(shapes: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """The boundary (key, x0, y0, x1, y1) of the union of each group's shapes."""
    return outline(noded(layered(shapes, key, geometry), key), key, lambda a, b: a > 0)


def shared(left: DataFrame, right: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """The boundary of what both shapes of a group cover."""
    both = layered(left, key, geometry).union(layered(right, key, geometry, 1))
    return outline(noded(both, key), key, lambda a, b: (a > 0) & (b > 0))


def member_union(members: DataFrame, cities: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """key, geometry: the union of each group's members, every hole filled but those that hold a city that is no member.

    ``cities`` have an id ``city``, lon and lat, and ``owner``, the key of the group they are a member of, or null.
    """
    rings = written(traced(union(members, key, geometry), key))
    holes = rings.where("not shell").select(F.struct(key, "nth").alias("hole"), "geometry")
    held = covers(cities, holes, "city", "hole", edge=False).join(cities.select("city", "owner"), "city")
    kept = held.where(~F.col("owner").eqNullSafe(F.col(f"hole.{key}"))).select("hole.*").distinct().withColumn("kept", F.lit(True))
    return assembled(rings.join(kept, [key, "nth"], "left").where("shell or kept"), key)


def check(shapes: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """key, valid: whether a shape's edges neither cross nor lie on each other; rings may touch at places."""
    one = shapes.select(F.col(key).alias("_k"), geometry)
    pieces = noded(edges_of(rings_of(one, "_k", geometry), "_k").withColumn("layer", F.lit(0)), "_k")
    found = pieces.groupBy("_k").agg((~F.max("crosses") & (F.max("n") == 1)).alias("valid"))
    return one.join(found, "_k", "left").select(F.col("_k").alias(key), F.coalesce("valid", F.lit(False)).alias("valid"))


def repaired(shapes: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """key, geometry: shapes that cross themselves taken apart where they do, and made of what lies within an odd number of their rings.

    A bow-tie gives two triangles. What lies on no area is left out, and so is a shape of nothing else.
    """
    one = edges_of(rings_of(shapes.select(key, geometry), key, geometry), key).withColumn("layer", F.lit(0))
    return assembled(traced(outline(noded(one, key), key, lambda a, b: a % 2 == 1, winding=False), key), key)


def _around(edges: DataFrame, key: str, radius: float, steps: int) -> DataFrame:
    """The edges of a shape around each edge: all within ``radius`` of it, round ends of ``steps`` sides."""
    turn = F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    corners = []
    for x, y, side in (("x1", "y1", -1), ("x0", "y0", 1)):
        for i in range(steps + 1):
            at = turn + F.lit(side * pi / 2 + pi * i / steps)
            corners.append(_point(F.col(x) + radius * F.cos(at), F.col(y) + radius * F.sin(at)))
    rings = edges.select(key, F.array(*corners, corners[0]).alias("points"))
    return edges_of(rings, key)


def grown(shapes: DataFrame, key: str, radius: float, geometry: str = "geometry", steps: int = 8) -> DataFrame:
    """The boundary of all within ``radius`` degrees of each shape."""
    edges = written(edges_of(rings_of(shapes, key, geometry), key))
    both = edges.select(key, *EDGE).union(_around(edges, key, radius, steps).select(key, *EDGE)).withColumn("layer", F.lit(0))
    return outline(noded(both, key), key, lambda a, b: a > 0)


def core(shapes: DataFrame, key: str, radius: float, geometry: str = "geometry", steps: int = 8) -> DataFrame:
    """The boundary of what lies more than ``radius`` degrees within each polygon of a shape; a polygon that has no such core keeps its own.

    Polygons of a shape are shrunk by themselves, and their cores united.
    """
    rings = rings_of(shapes, key, geometry).select(F.struct(key, "part").alias("_of"), "points")
    edges = written(edges_of(rings, "_of"))
    both = edges.select("_of", *EDGE, F.lit(0).alias("layer")).union(_around(edges, "_of", radius, steps).select("_of", *EDGE, F.lit(1).alias("layer")))
    inner = written(outline(noded(both, "_of"), "_of", lambda a, b: (a > 0) & (b == 0)))
    thin = edges.join(inner.select("_of").distinct(), "_of", "left_anti")
    all_ = inner.union(thin.select("_of", *EDGE)).select(F.col(f"_of.{key}").alias(key), *EDGE, F.lit(0).alias("layer"))
    return outline(noded(all_, key), key, lambda a, b: a > 0)


def reached(points: DataFrame, shapes: DataFrame, point: str, shape: str, margin_km: float, geometry: str = "geometry", x: str = "lon", y: str = "lat") -> DataFrame:
    """point, shape: shapes that cover a point or come within ``margin_km`` of it.

    Points meet the edges in the cells that the box around them touches, cut at the
    antimeridian and around the whole parallel at a pole; distances are taken on the plane that touches the sphere at the point.
    """
    per = pi / 180 * EARTH_KM
    up = margin_km / per
    poleward = F.least(F.abs(F.col("py")) + up, F.lit(90.0))
    wide = F.coalesce(F.least(up / F.nullif(F.greatest(F.cos(F.radians(poleward)), F.lit(1e-9)), F.lit(0.0)), F.lit(180.0)), F.lit(180.0))
    at = points.select(point, F.col(x).alias("px"), F.col(y).alias("py")).where("px is not null and py is not null").withColumn("wide", wide)
    all_round = F.col("wide") >= 180
    west, east = F.col("px") - F.col("wide"), F.col("px") + F.col("wide")
    boxes = at.withColumns({
        "xmin": F.when(all_round, -180.0).when(west < -180, west + 360).otherwise(west), "xmax": F.when(all_round, 180.0).when(east > 180, east - 360).otherwise(east),
        "ymin": F.greatest(F.col("py") - up, F.lit(-90.0)), "ymax": F.least(F.col("py") + up, F.lit(90.0)),
    })
    size = 0.25
    # A shape's cells are many times what Spark takes their size for, which is the shape's: they must not be broadcast.
    dealt = _cells_of_edges(edges_of(rings_of(shapes, shape, geometry), shape), F.lit(size), F.lit(SNAP))
    met = cells_of_boxes(boxes.select(point, "px", "py", "xmin", "ymin", "xmax", "ymax"), size).join(dealt.hint("merge"), ["cx", "cy"])

    # As a column expression this is more than Java compiles, and it would be interpreted for each row.
    @F.arrow_udf(BooleanType())
    def close(px: pa.Array, py: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        lon, lat, *ends = (np.asarray(c) for c in (px, py, x0, y0, x1, y1))
        across = per * np.cos(np.radians(lat))
        ax, bx = ((np.mod(e - lon + 180, 360.0) - 180) * across for e in ends[::2])
        ay, by = ((e - lat) * per for e in ends[1::2])
        dx, dy = bx - ax, by - ay
        square = dx * dx + dy * dy
        along = np.clip(-(ax * dx + ay * dy) / np.where(square == 0, 1.0, square), 0.0, 1.0)
        return pa.array(np.hypot(ax + along * dx, ay + along * dy) <= margin_km)

    near = met.where(close("px", "py", *EDGE)).select(point, shape)
    return near.union(covers(points, shapes, point, shape, geometry, x, y)).distinct()


def clear(points: DataFrame, shapes: DataFrame, owner: str, point: str, shape: str, margin_km: float, geometry: str = "geometry", x: str = "lon", y: str = "lat") -> DataFrame:
    """point and owner of points that the shapes of one owner alone cover or come within ``margin_km`` of.

    Only the least and the greatest owner near a place matter, so places and shapes of equal geometry meet once, however many
    points and owners have them.
    """
    alike, first = _alike(shapes, shape, geometry)
    owners = shapes.select(shape, owner).join(alike, shape).groupBy("_as").agg(F.min(owner).alias("_least"), F.max(owner).alias("_most"))
    at = points.select(point, F.struct(F.col(x).alias("x"), F.col(y).alias("y")).alias("_place"))
    places = at.select("_place", F.col("_place.x").alias("_x"), F.col("_place.y").alias("_y")).where("_x is not null and _y is not null").distinct()
    met = reached(places, written(first), "_place", shape, margin_km, geometry, "_x", "_y").withColumnRenamed(shape, "_as").join(owners, "_as")
    ends = met.groupBy("_place").agg(F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    found = at.join(ends, "_place").groupBy(point).agg(F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    return found.where("_least = _most").select(point, F.col("_least").alias(owner))
