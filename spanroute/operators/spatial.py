"""Spatial joins: equi joins on the cells of a grid, then exact tests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructField, StructType

from spanroute.functions import geometry as G

CELL = 5.0
RING = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))


def cell(x: Column, size: float = CELL) -> Column:
    return F.floor(x / size).cast("long")


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * G.EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def lon_span(west: Column, east: Column) -> Column:
    """Degrees from west to east, over the antimeridian where west is the greater."""
    return F.when(west > east, east - west + 360).otherwise(east - west)


def widest_gap(points: DataFrame, key: str, lon: str) -> DataFrame:
    """key, west, east, cut: the shortest stretch of longitudes that holds all points, which is what the widest gap leaves.

    Equal gaps: the most western. Null longitudes don't count. ``cut`` is the first longitude after the gap if that
    makes a stretch shorter than from the least to the greatest, which then crosses the antimeridian; else null.

    Gaps are taken within each degree first, then between the 361 degrees at most of a key, so no task sorts a whole key.
    """
    one = points.select(key, lon).where(F.col(lon).isNotNull()).distinct().withColumn("_cell", F.floor(lon))

    def gap(east: Column, after: Column) -> Column:
        return F.struct((after - east).alias("size"), (-east).alias("order"), east.alias("east"), after.alias("next"))

    after = F.lead(lon).over(Window.partitionBy(key, "_cell").orderBy(lon))
    cells = one.withColumn("gap", F.when(after.isNotNull(), gap(F.col(lon), after)))
    cells = cells.groupBy(key, "_cell").agg(F.min(lon).alias("lo"), F.max(lon).alias("hi"), F.max("gap").alias("gap"))
    first = F.min("lo").over(Window.partitionBy(key))
    cells = cells.withColumn("across", gap(F.col("hi"), F.coalesce(F.lead("lo").over(Window.partitionBy(key).orderBy("_cell")), first + 360)))
    wide = cells.groupBy(key).agg(F.max(F.greatest("gap", "across")).alias("g"), F.max("hi").alias("last"), F.min("lo").alias("first"))
    west = F.when(F.col("g.next") >= 180, F.col("g.next") - 360).otherwise(F.col("g.next"))
    inner = (F.col("g.east") < F.col("last")) & (F.col("g.size") > F.col("first") + 360 - F.col("last"))
    return wide.select(key, west.alias("west"), F.col("g.east").alias("east"), F.when(inner, F.col("g.next")).alias("cut"))


def cells_of_boxes(boxes: DataFrame, size: float = CELL) -> DataFrame:
    """A row for each cell (cx, cy) that a box (xmin, ymin, xmax, ymax) touches; one over the antimeridian gives both parts."""
    parts = F.when(F.col("xmin") > F.col("xmax"), F.array(F.struct(F.col("xmin").alias("a"), F.lit(180.0).alias("b")), F.struct(F.lit(-180.0).alias("a"), F.col("xmax").alias("b"))))
    parts = F.explode(parts.otherwise(F.array(F.struct(F.col("xmin").alias("a"), F.col("xmax").alias("b")))))
    split = boxes.withColumn("_part", parts)
    columns = F.explode(F.sequence(cell(F.col("_part.a"), size), cell(F.col("_part.b"), size))).alias("cx")
    wide = split.select(*boxes.columns, columns)
    return wide.select("*", F.explode(F.sequence(cell(F.col("ymin"), size), cell(F.col("ymax"), size))).alias("cy")).distinct()


def in_box(x: Column, y: Column) -> Column:
    wide = F.when(F.col("xmin") <= F.col("xmax"), (x >= F.col("xmin")) & (x <= F.col("xmax"))).otherwise((x >= F.col("xmin")) | (x <= F.col("xmax")))
    return wide & (y >= F.col("ymin")) & (y <= F.col("ymax"))


def points_in_boxes(points: DataFrame, boxes: DataFrame, x: str = "lon", y: str = "lat", size: float = CELL) -> DataFrame:
    """Every point with every box that holds it, edges included."""
    at = points.withColumn("cx", cell(F.col(x), size)).withColumn("cy", cell(F.col(y), size))
    return at.join(cells_of_boxes(boxes, size), ["cx", "cy"]).where(in_box(F.col(x), F.col(y))).drop("cx", "cy")


@F.pandas_udf(BooleanType())
def covered(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether (x, y) lies in the ring beside it; rows of one ring are tested together."""
    for x, y, rings in batches:
        out, known = np.zeros(len(x), bool), {}
        for i, ring in enumerate(rings):
            known.setdefault(tuple((p["x"], p["y"]) for p in ring), []).append(i)
        for ring, rows in known.items():
            out[rows] = G.inside(np.column_stack([x.to_numpy()[rows], y.to_numpy()[rows]]), np.array(ring))
        yield pd.Series(out)


def points_in_polygons(points: DataFrame, polygons: DataFrame, ring: str = "ring", x: str = "lon", y: str = "lat", size: float = CELL) -> DataFrame:
    """As :func:`points_in_boxes` over the polygons' boxes, then the ring itself."""
    return points_in_boxes(points, polygons, x, y, size).where(covered(F.col(x), F.col(y), F.col(ring))).drop(ring)


def hulls(points: DataFrame, key: str, x: str = "lon", y: str = "lat") -> DataFrame:
    """key, part, ring and box: the convex hull of each key's points, in one part, or two on both sides of the antimeridian.

    Where the shortest stretch of longitudes crosses the antimeridian and is narrower than the plain one, the hull is
    that of longitudes counted on beyond 180 degrees, cut there: part 0 lies before it, part 1 after. Points without a
    coordinate don't count.

    A hull of hulls is the hull: points shrink to the hull of each of a number of bins
    first, so a key that holds very many points isn't gathered in one task.
    """
    of = f"{key} {points.schema[key].dataType.simpleString()}"

    def shrink(group: pd.DataFrame) -> pd.DataFrame:
        ring = G.hull(group[["x", "y"]].to_numpy())
        plain = dict(zip(group["x"], group["plain"], strict=True))
        return pd.DataFrame({key: group[key].iat[0], "x": ring[:, 0], "y": ring[:, 1], "plain": [plain[v] for v in ring[:, 0]]})

    def close(group: pd.DataFrame) -> pd.DataFrame:
        ring = G.hull(group[["x", "y"]].to_numpy())
        parts = G.split_antimeridian(ring, dict(zip(group["x"], group["plain"], strict=True)))
        rows = [(n, [{"x": a, "y": b} for a, b in r.tolist()], *r.min(0), *r.max(0)) for n, r in parts]
        out = pd.DataFrame(rows, columns=["part", "ring", "xmin", "ymin", "xmax", "ymax"])
        out.insert(0, key, group[key].iat[0])
        return out

    one = points.select(key, F.col(x).alias("plain"), F.col(y).alias("y")).where("plain is not null and y is not null").distinct()
    cut = widest_gap(one, key, "plain").where("cut is not null").select(F.col(key).alias("_key"), "cut")
    shifted = F.when(F.col("plain") < F.col("cut"), F.col("plain") + 360).otherwise(F.col("plain"))
    one = one.join(cut, F.col(key).eqNullSafe(F.col("_key")), "left").select(key, shifted.alias("x"), "y", "plain")
    few = one.withColumn("bin", F.pmod(F.xxhash64("x", "y"), F.lit(32))).groupBy(key, "bin").applyInPandas(shrink, f"{of}, x double, y double, plain double")
    return few.groupBy(key).applyInPandas(close, f"{of}, part int, ring {RING.simpleString()}, xmin double, ymin double, xmax double, ymax double")


def overlaps(left: DataFrame, right: DataFrame, size: float = CELL) -> DataFrame:
    """Pairs of boxes (left_id, right_id) that share area, with it in square degrees, and the left box's own."""
    a = cells_of_boxes(left, size).select("cx", "cy", *[F.col(c).alias("l_" + c) for c in left.columns])
    b = cells_of_boxes(right, size).select("cx", "cy", *[F.col(c).alias("r_" + c) for c in right.columns])
    w = F.least("l_xmax", "r_xmax") - F.greatest("l_xmin", "r_xmin")
    h = F.least("l_ymax", "r_ymax") - F.greatest("l_ymin", "r_ymin")
    met = a.join(b, ["cx", "cy"]).where((w > 0) & (h > 0)).drop("cx", "cy").distinct()
    own = (F.col("l_xmax") - F.col("l_xmin")) * (F.col("l_ymax") - F.col("l_ymin"))
    return met.select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"), (w * h).alias("shared"), own.alias("own"))


def best_share(met: DataFrame, least: float, runner_up: float | None = None) -> DataFrame:
    """left_id, right_id, share: the right area with most of the left one, ties to the lower id.

    Shares below ``least`` don't count. With ``runner_up``, a second area of at least that
    part of the best makes the left one ambiguous, and its right_id null.
    """
    order = Window.partitionBy("left_id").orderBy(F.desc("shared"), "right_id")
    best = met.withColumn("share", F.col("shared") / F.col("own")).where(F.col("share") >= least)
    best = best.withColumn("nth", F.row_number().over(order)).withColumn("second", F.lead("shared").over(order)).where("nth = 1")
    if runner_up is None:
        return best.select("left_id", "right_id", "share")
    clear = F.coalesce(F.col("second") < runner_up * F.col("shared"), F.lit(True))
    return best.select("left_id", F.when(clear, F.col("right_id")).alias("right_id"), "share")


def deepest(met: DataFrame, depth: DataFrame) -> DataFrame:
    """Of the places that hold a thing (thing_id, place_id) that with most ancestors, then city before region before country, then by id."""
    kinds = F.array_position(F.array(F.lit("city"), F.lit("metro"), F.lit("region"), F.lit("country")), F.col("kind"))
    order = F.struct(-F.col("depth"), kinds, F.col("place_id"))
    return met.join(depth, "place_id").groupBy("thing_id").agg(F.min_by("place_id", order).alias("place_id"))


def _rings(rings: pd.Series) -> Iterator[np.ndarray]:
    for ring in rings:
        yield np.array([(p["x"], p["y"]) for p in ring])


@F.pandas_udf(DoubleType())
def ring_area_km2(rings: pd.Series) -> pd.Series:
    return pd.Series([G.area_km2(r) for r in _rings(rings)], dtype="float64")


@F.pandas_udf(BooleanType())
def ring_valid(rings: pd.Series) -> pd.Series:
    return pd.Series([G.valid(r) for r in _rings(rings)], dtype="bool")


def simplified(tolerance: float):
    """A function of a ring: its corners that stray more than ``tolerance``, more where these alone would cross."""

    @F.pandas_udf(RING)
    def run(rings: pd.Series) -> pd.Series:
        return pd.Series([[{"x": x, "y": y} for x, y in G.simplify_ring(r, tolerance).tolist()] for r in _rings(rings)])

    return run


@F.pandas_udf(DoubleType())
def shared_area(rings: pd.Series, xmin: pd.Series, ymin: pd.Series, xmax: pd.Series, ymax: pd.Series) -> pd.Series:
    """The area of a ring within a box, in square degrees."""
    boxes = zip(xmin, ymin, xmax, ymax, strict=True)
    cut = [G.clip(r, b) for r, b in zip(_rings(rings), boxes, strict=True)]
    return pd.Series([G.area(c) if len(c) > 2 else 0.0 for c in cut], dtype="float64")


POINT = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])


@F.pandas_udf(POINT)
def point_within(rings: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([G.representative(r) for r in _rings(rings)], columns=["x", "y"])


def border_clear(points: DataFrame, areas: DataFrame, owner: str, id_col: str, margin: float) -> DataFrame:
    """id and owner of points that only one owner's boxes, grown by ``margin``, hold."""
    grown = areas.withColumns({"xmin": F.col("xmin") - margin, "ymin": F.col("ymin") - margin, "xmax": F.col("xmax") + margin, "ymax": F.col("ymax") + margin})
    held = points_in_boxes(points, grown).groupBy(id_col).agg(F.countDistinct(owner).alias("n"), F.min(owner).alias(owner))
    return held.where("n = 1").select(id_col, owner)


def core_of(met: DataFrame, sizes: DataFrame, least: float = 0.5) -> DataFrame:
    """right_id, core: the largest of the left areas that lie in it by ``least`` and are no larger, ties to the lower id."""
    inside = met.where(F.col("shared") >= least * F.col("own")).join(sizes, F.col("right_id") == F.col("id")).where(F.col("own") <= F.col("area"))
    return inside.groupBy("right_id").agg(F.min_by("left_id", F.struct(-F.col("own"), F.col("left_id"))).alias("core"))
