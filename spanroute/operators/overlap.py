"""Feeds that contain, repeat or run beside each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanroute.sinks.scratch import written

from . import tiles


def shared_counts(rows: DataFrame, owner: str, element: str) -> DataFrame:
    """a, b, shared, own, other: for every two owners with an element in common, how many they share and have.

    Elements that very many owners hold make many pairs of owners; these are counted in
    tiles, and the rows put out are the owners with something in common, which is what is asked for.
    """
    return tiles.shared(rows, owner, element)


def containments(rows: DataFrame, owner: str, element: str, least: float, larger: float = 1.0) -> DataFrame:
    """a, b, shared, own, other: where b has ``larger`` times as many elements as a or more, and at least the share ``least`` of a's.

    All pairs with an element in common are counted in tiles, which put out only these.
    """
    return tiles.shared(rows, owner, element, least, larger)


def contained(points: DataFrame, routes: DataFrame, owner: str, point: str, route: str, least_points: int = 2, least_routes: int = 5) -> DataFrame:
    """a, b, rule: feed a lies in the larger feed b, by share of stops and routes or by all its routes."""
    p = containments(points, owner, point, 0.8, 1.5).where(F.col("own") >= least_points)
    one = written(routes.select(owner, route).distinct())
    met = p.join(one.select(F.col(owner).alias("a"), route), "a").join(one.select(F.col(owner).alias("b"), route), ["b", route]).groupBy("a", "b").agg(F.count("*").alias("r_shared"))
    both = p.join(met, ["a", "b"]).join(one.groupBy(F.col(owner).alias("a")).agg(F.count("*").alias("r_own")), "a")
    share = (F.col("shared") >= 0.9 * F.col("own")) & (F.col("r_shared") >= 0.9 * F.col("r_own"))
    every = (F.col("other") >= 3 * F.col("own")) & (F.col("r_shared") == F.col("r_own")) & (F.col("r_own") >= least_routes)
    return both.withColumn("rule", F.when(share, "share").when(every, "routes")).where("rule is not null").select("a", "b", "rule")


def near_duplicates(rows: DataFrame, key: str, same: list[str], tables: list[str]) -> DataFrame:
    """Groups of more than one feed that agree in ``same``, and which of ``tables`` differ within."""
    good = rows
    for c in same:
        good = good.where(F.col(c).isNotNull())
    differ = F.array_compact(F.array(*[F.when(F.countDistinct(F.coalesce(c, F.lit(""))) > 1, c) for c in tables]))
    return good.groupBy(*same).agg(F.array_sort(F.collect_set(key)).alias("members"), differ.alias("differ")).where(F.size("members") > 1)


def fold_identical(rows: DataFrame, key: str, digest: str, rank: str) -> DataFrame:
    """key, canonical_id, n: of equal content the row of the best source stands for all, ties to the lower id.

    Minima combine before the shuffle; ids come back by a join, so a content that very many
    rows hold isn't gathered anywhere.
    """
    best = rows.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(F.struct(rank, key)).alias("best"), F.count("*").alias("n"))
    return rows.join(best, digest).select(key, F.col(f"best.{key}").alias("canonical_id"), "n")


#: The least cells of the grid in which boxes meet, in degrees, how many times larger each next tier's are, and the number of tiers.
CELL, STEP, TIERS = 0.012, 4, 8


def _gridded(rows: DataFrame, key: list[str], side: str, slack: float) -> tuple[DataFrame, DataFrame]:
    """``rows`` at each cell of their own tier, that whose cells are no smaller than their box, and of all tiers above it."""
    box = [F.col(c) for c in ("xmin", "xmax", "ymin", "ymax")]
    extent = F.greatest(box[1] - box[0], box[3] - box[2])
    tier = F.least(F.lit(TIERS - 1), F.greatest(F.lit(0), F.ceil(F.log(float(STEP), F.greatest(extent, F.lit(CELL)) / CELL)))).cast("int")
    tiers = rows.withColumn("own", tier).withColumn("tier", F.explode(F.sequence("own", F.lit(TIERS - 1))))
    size = F.lit(CELL) * F.pow(F.lit(float(STEP)), F.col("tier"))

    def cells(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor((lo - slack) / size), F.floor((hi + slack) / size)))

    spread = tiers.withColumn("cx", cells(box[0], box[1])).withColumn("cy", cells(box[2], box[3]))
    spread = spread.select(*key, "tier", "cx", "cy", (F.col("own") == F.col("tier")).alias(side + "at_home"), *[F.col(c).alias(side + c) for c in ("feed_id", "line_id", "xmin", "xmax", "ymin", "ymax")])
    return spread.where(side + "at_home"), spread.where(f"not {side}at_home")


def beside(rows: DataFrame, tolerance: float = 0.003) -> DataFrame:
    """place_id, a, b, line_a, line_b: lines of other feeds with the same family and name whose stop boxes lie within ``tolerance``.

    ``rows`` has place_id, feed_id, line_id, family, name and a box (xmin, xmax, ymin, ymax).
    Boxes meet in cells of a grid, at the tier of the larger of both, so that a name which
    very many lines of a place have isn't compared in all pairs; a pair counts in the one
    cell that holds the lower left corner of what both have in common.
    """
    key, on = ["place_id", "family", "name"], ["place_id", "family", "name", "tier", "cx", "cy"]
    a_home, a_above = _gridded(rows, key, "a_", 1.001 * tolerance)
    b_home, b_above = _gridded(rows, key, "b_", 0.0)
    met = a_home.join(b_home.union(b_above), on).union(a_above.join(b_home, on).select(a_home.join(b_home, on).columns))
    near = (F.col("a_xmin") <= F.col("b_xmax") + tolerance) & (F.col("b_xmin") <= F.col("a_xmax") + tolerance) & (F.col("a_ymin") <= F.col("b_ymax") + tolerance) & (F.col("b_ymin") <= F.col("a_ymax") + tolerance)
    size = F.lit(CELL) * F.pow(F.lit(float(STEP)), F.col("tier"))

    def here(cell: str, axis: str) -> Column:
        corner = F.least(F.greatest(F.col(f"a_{axis}min") - tolerance, F.col(f"b_{axis}min")), F.col(f"b_{axis}max"))
        return F.col(cell) == F.floor(corner / size)

    met = met.where((F.col("a_feed_id") != F.col("b_feed_id")) & near & here("cx", "x") & here("cy", "y"))
    return met.select("place_id", "family", F.col("a_feed_id").alias("a"), F.col("b_feed_id").alias("b"), F.col("a_line_id").alias("line_a"), F.col("b_line_id").alias("line_b"))


def overlap_shares(lines: DataFrame, met: DataFrame, least: float = 0.01) -> DataFrame:
    """place_id, a, b, share: of a's lines at a place, those that run beside one of b's; from ``least`` on."""
    total = lines.groupBy("place_id", F.col("feed_id").alias("a")).agg(F.countDistinct("line_id").alias("lines"))
    shared = met.groupBy("place_id", "a", "b").agg(F.countDistinct("line_a").alias("shared"))
    return shared.join(total, ["place_id", "a"]).withColumn("share", F.col("shared") / F.col("lines")).where(F.col("share") >= least).select("place_id", "a", "b", "share")


def co_service(rows: DataFrame, owner: str, element: str, least: float = 0.9) -> DataFrame:
    """a < b, containment, kind: owners that share ``least`` of the smaller set; equal sets are duplicates."""
    met = containments(rows, owner, element, least)
    pair = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("shared") / F.col("own")).alias("containment"), ((F.col("own") == F.col("other")) & (F.col("shared") == F.col("own"))).alias("same")).distinct()
    return pair.select("a", "b", "containment", F.when(F.col("same"), "duplicate").otherwise("genuine").alias("kind"))


def pattern_sample(stops: DataFrame, routes: str = "route_id", trip: str = "trip_id", seq: str = "seq", stop: str = "stop_id", trips: int = 8, lengths: int = 8, patterns: int = 8) -> DataFrame:
    """A bounded sample of each route's patterns: the lowest trip ids of each of its longest lengths, distinct, the longest first."""
    one = stops.groupBy(routes, trip).agg(F.transform(F.array_sort(F.collect_list(F.struct(seq, stop))), lambda x: x[stop]).alias("pattern"))
    one = one.withColumn("length", F.size("pattern"))
    few = one.withColumn("nth", F.row_number().over(Window.partitionBy(routes, "length").orderBy(trip))).withColumn("rank", F.dense_rank().over(Window.partitionBy(routes).orderBy(F.desc("length"))))
    distinct = few.where((F.col("nth") <= trips) & (F.col("rank") <= lengths)).groupBy(routes, "pattern", "length").agg(F.min(trip).alias(trip))
    order = Window.partitionBy(routes).orderBy(F.desc("length"), trip)
    return distinct.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= patterns).select(routes, "nth", "length", trip, "pattern")
