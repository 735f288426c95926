"""Merging snapshots of several builds, and what changed between two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Of each key the first row in ``order``; the order must tell all rows of a key apart."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth = 1").drop("_nth")


def won_builds(feeds: DataFrame) -> DataFrame:
    """feed_id and build of the newest build that carries each feed (built, build_id); ties go to the lower id.

    A maximum combines before the shuffle, so many builds of one feed cost no more.
    """
    return feeds.groupBy("feed_id").agg(F.min_by("build_id", F.struct(-F.unix_date("built"), F.col("build_id"))).alias("build_id"))


def merge_edges(edges: DataFrame, won: DataFrame) -> DataFrame:
    """Edges of the build that won their feed only, so that no feed mixes two builds."""
    return edges.join(won, ["feed_id", "build_id"], "left_semi")


def merge_places(places: DataFrame, kept: DataFrame) -> DataFrame:
    """Each place from the build with most kept edges, then the newest, then the lower id (place_id, build_id, built)."""
    given = kept.groupBy("place_id", "build_id").agg(F.count("*").alias("kept"))
    rows = places.join(given, ["place_id", "build_id"], "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    return newest(rows, "place_id", [F.desc("kept"), F.desc("built"), F.col("build_id")])


def companions(realtime: DataFrame, won: DataFrame, built: str = "built") -> DataFrame:
    """Realtime feeds (feed_id, static_feed_id, build_id, built): those of a won feed come from its build, others from the newest."""
    static = won.select(F.col("feed_id").alias("static_feed_id"), F.col("build_id").alias("won_build"))
    met = realtime.join(static, "static_feed_id", "left")
    follow = met.where(F.col("build_id") == F.col("won_build")).drop("won_build")
    loose = newest(met.where("won_build is null").drop("won_build"), "feed_id", [F.desc(built), F.col("build_id"), F.col("static_feed_id")])
    return follow.unionByName(loose.join(follow.select("feed_id"), "feed_id", "left_anti"))


def propagate(realtime: DataFrame, edges: DataFrame) -> DataFrame:
    """An edge of unknown tier for every place of the static feed that a companion follows."""
    places = edges.select(F.col("feed_id").alias("static_feed_id"), "place_id").distinct()
    return realtime.select("feed_id", "static_feed_id").join(places, "static_feed_id").select("feed_id", "place_id", F.lit("unknown").alias("tier"), F.lit("inferred").alias("method")).distinct()


def outcomes(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key, change: keys whose outcome went wrong or was repaired between two maps, came or went."""
    a, b = old.select(key, F.col(value).alias("a")), new.select(key, F.col(value).alias("b"))
    met = a.join(b, key, "full")
    change = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "gone").when((F.col("a") == "ok") & (F.col("b") != "ok"), "regression").when((F.col("a") != "ok") & (F.col("b") == "ok"), "repaired")
    return met.withColumn("change", change).where("change is not null").select(key, "change")
