"""How much a feed matters for a place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CATEGORY = {"local": "primary", "regional": "secondary", "national": "tertiary", "international": "international", "unknown": "unknown"}
STALE_DAYS = 30


def category(tier: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in CATEGORY.items() for x in pair])[tier]


def is_stale(service_end: Column, last_read: Column, days: int = STALE_DAYS) -> Column:
    """Service ended more than ``days`` before the feed was last read; unknown dates aren't stale."""
    return F.coalesce(F.date_diff(last_read, service_end) > days, F.lit(False))


def is_nominal(start: Column, end: Column, built: Column) -> Column:
    """A window that stands for no real one: from before 2000, or to more than five years ahead."""
    return F.coalesce(start < F.lit("2000-01-01").cast("date"), F.lit(False)) | F.coalesce(end > F.add_months(built, 60), F.lit(False))


def with_places(pairs: DataFrame, *totals: Column) -> DataFrame:
    """``pairs`` with totals of their place: aggregates, which combine before the shuffle, joined back."""
    own = pairs.groupBy(F.col("place_id").alias("_place")).agg(*totals)
    return pairs.join(own, F.col("place_id").eqNullSafe(F.col("_place"))).drop("_place")


def basis(pairs: DataFrame, active: str = "active") -> DataFrame:
    """``basis`` and ``value`` of each pair: departures where every active pair of its place reports them, else stops.

    Where no pair of a place is active, every pair counts.
    """
    reported = F.col("departures").isNotNull()
    both = with_places(pairs, F.bool_or(active).alias("_some"), F.bool_and(F.when(F.col(active), reported)).alias("_active"), F.bool_and(reported).alias("_all"))
    known = F.when(F.col("_some"), F.col("_active")).otherwise(F.col("_all"))
    value = F.when(known, F.col("departures")).otherwise(F.col("stops").cast("double"))
    return both.withColumn("basis", F.when(known, "departures").otherwise("stops")).withColumn("value", value).drop("_some", "_active", "_all")


def set_aside(pairs: DataFrame, modes: str = "modes", stale: str = "stale") -> DataFrame:
    """``active``: fresh pairs, and stale ones that run a mode which no fresh pair of their place runs.

    A stale pair without modes stays only where its place has no fresh pair. Of a place no
    more than its set of modes is gathered.
    """
    spread = pairs.select(F.col("place_id").alias("_place"), F.col(stale).alias("_stale"), F.explode_outer(F.when(~F.col(stale), F.col(modes))).alias("_mode"))
    own = spread.groupBy("_place").agg(F.collect_set("_mode").alias("_modes"), F.bool_or(~F.col("_stale")).alias("_fresh"))
    only = F.when(F.size(modes) > 0, F.size(F.array_except(modes, "_modes")) > 0).otherwise(~F.col("_fresh"))
    both = pairs.join(own, F.col("place_id").eqNullSafe(F.col("_place")))
    return both.withColumn("active", ~F.col(stale) | only).drop("_place", "_modes", "_fresh")


def relevance(pairs: DataFrame, feed_stops: DataFrame) -> DataFrame:
    """share_of_place, share_of_feed and relevance of pairs with ``basis``, ``value``, ``active``, ``stops``.

    ``feed_stops`` gives each feed's denominator (``scope_stops``): stops at home for a
    domestic feed, else all. Seven tenths weigh the place's share, three the feed's.
    """
    total = F.col("_total")
    shares = with_places(pairs, F.sum(F.when(F.col("active"), F.col("value"))).alias("_total")).join(feed_stops, "feed_id", "left")
    shares = shares.withColumn("share_of_place", F.when(F.col("active") & (total > 0), F.col("value") / total).otherwise(0.0)).drop("_total")
    of_feed = F.when(F.col("scope_stops") > 0, F.least(F.lit(1.0), F.col("stops") / F.col("scope_stops"))).otherwise(0.0)
    shares = shares.withColumn("share_of_feed", of_feed)
    return shares.withColumn("relevance", F.when(F.col("active"), 0.7 * F.col("share_of_place") + 0.3 * F.col("share_of_feed")).otherwise(0.0))


def breadth(served: DataFrame, places: DataFrame) -> DataFrame:
    """feed_id, country_code, breadth: cities of a country that a feed serves, of all its served cities."""
    cities = served.join(places.where("kind = 'city'").select("place_id", "country_code"), "place_id").select("feed_id", "country_code", "place_id").distinct()
    total = cities.select("country_code", "place_id").distinct().groupBy("country_code").agg(F.count("*").alias("served"))
    own = cities.groupBy("feed_id", "country_code").agg(F.count("*").alias("reached"))
    return own.join(total, "country_code").withColumn("breadth", F.col("reached") / F.col("served"))


def best_class(edges: DataFrame) -> DataFrame:
    """place_id, best: the first of the categories that a place has."""
    order = F.array(*[F.lit(c) for c in CATEGORY.values()])
    at = F.min(F.array_position(order, category(F.col("tier"))))
    return edges.groupBy("place_id").agg(F.element_at(order, at.cast("int")).alias("best"))
