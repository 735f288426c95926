"""Curated edits, and constraints as queries whose results must be empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanroute.sinks.scratch import written

from .ranks import running


def apply_edits(edges: DataFrame, edits: DataFrame) -> DataFrame:
    """Edges (feed_id, place_id, tier) after edits (edit_id, feed_id, place_id, action, tier); null targets mean any.

    Of the edits that meet an edge the most specific holds: both ids, the place, the feed.
    ``remove`` drops the edge, ``set`` gives it a tier; ``add`` makes the edge where it isn't.
    """
    # Edits of one target are alike but for their ids, so the first of them stands for all before they meet any edge.
    change = edits.where("action in ('remove', 'set')").groupBy("feed_id", "place_id").agg(F.max_by(F.struct("action", F.col("tier").alias("new_tier")), F.struct(-F.col("edit_id"))).alias("e"))
    both = change.where("feed_id is not null and place_id is not null").withColumnRenamed("e", "e_both")
    feed = change.where("feed_id is not null and place_id is null").select("feed_id", F.col("e").alias("e_feed"))
    place = written(change.where("feed_id is null and place_id is not null").select("place_id", F.col("e").alias("e_place")))  # few, as Spark then knows
    rows = edges.select("feed_id", "place_id", "tier", F.lit(False).alias("added")).union(edits.where("action = 'add'").select("feed_id", "place_id", "tier", F.lit(True)))
    met = rows.join(place, "place_id", "left").join(feed, "feed_id", "left").join(both, ["feed_id", "place_id"], "left")
    # An edge without a tier is met by none, as in SQL.
    met = met.withColumn("e", F.when(~F.col("added") & F.col("tier").isNotNull(), F.coalesce("e_both", "e_place", "e_feed")))
    left = met.where(F.coalesce(F.col("e.action") != "remove", F.lit(True)))
    return left.select("feed_id", "place_id", F.coalesce("e.new_tier", "tier").alias("tier")).distinct()


def ambiguous_edits(edits: DataFrame) -> DataFrame:
    """Targets that more than one edit of the same kind and specificity names."""
    return edits.groupBy("feed_id", "place_id", "action").agg(F.count("*").alias("n")).where("n > 1")


def stale_edits(edits: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """Edits whose recorded digest of the evidence isn't today's."""
    return edits.join(evidence, key, "left").where(~F.col("seen").eqNullSafe(F.col("digest"))).select(key, "seen", "digest")


def renamed(feeds: DataFrame, renames: DataFrame) -> DataFrame:
    """Feeds (feed_id, aliases) after identity edits (old, new): the old id stays as an alias."""
    met = feeds.join(renames, F.col("feed_id") == F.col("old"), "left")
    aliases = F.when(F.col("new").isNotNull(), F.array_sort(F.array_union("aliases", F.array("old")))).otherwise(F.col("aliases"))
    return met.select(F.coalesce("new", "feed_id").alias("feed_id"), aliases.alias("aliases"), *[c for c in feeds.columns if c not in ("feed_id", "aliases")])


def replaced(rows: DataFrame, curated: DataFrame, key: str) -> DataFrame:
    """Rows, with all of a key's replaced by the curated ones where there are any."""
    return rows.join(curated.select(key).distinct(), key, "left_anti").unionByName(curated)


def repeated_ids(rows: DataFrame, id_col: str, aliases: str | None = None) -> DataFrame:
    """Ids that stand for more than one row, aliases being in the same namespace."""
    ids = rows.select(F.col(id_col).alias("id"))
    if aliases:
        ids = ids.union(rows.select(F.explode(aliases)))
    return ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def dangling(rows: DataFrame, column: str, known: DataFrame, id_col: str) -> DataFrame:
    """Values of a column that no row of ``known`` has."""
    values = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("missing")).agg(F.count("*").alias("n"))
    return values.join(known.select(F.col(id_col).alias("missing")), "missing", "left_anti")


def sole_tier(edges: DataFrame, whole: Column) -> DataFrame:
    """Pairs that have a whole-feed edge beside others."""
    return edges.groupBy("feed_id", "place_id").agg(F.count_if(whole).alias("whole"), F.count("*").alias("n")).where("whole > 0 and n > 1")


def history_breaks(old: DataFrame, new: DataFrame) -> DataFrame:
    """place_id, fault of rows (place_id, kind, state, into, names) that break the append-only contract between two versions.

    No row goes; a kind never changes; a merged or retired row isn't alive again; lists of a
    live row only gain at their end; a merged row's target changes only by flattening,
    which the target's own row must show.
    """
    a = old.select("place_id", *[F.col(c).alias("o_" + c) for c in ("kind", "state", "into", "names")])
    met = a.join(new, "place_id", "left").join(new.select(F.col("place_id").alias("o_into"), F.col("into").alias("flat")), "o_into", "left")
    fault = (
        F.when(F.col("state").isNull(), "removed").when(F.col("kind") != F.col("o_kind"), "kind").when((F.col("o_state") != "live") & (F.col("state") != F.col("o_state")), "revived")
        .when((F.col("state") == "live") & (F.slice("names", F.lit(1), F.size("o_names")) != F.col("o_names")), "names")
        .when((F.col("o_state") == "merged") & ~F.col("into").eqNullSafe(F.col("o_into")) & ~F.col("into").eqNullSafe(F.col("flat")), "into")
    )
    return met.withColumn("fault", fault).where("fault is not null").select("place_id", "fault")


def gate(golden: DataFrame, edges: DataFrame) -> DataFrame:
    """feed_id, missing, extra: of golden feeds (feed_id, tiers, exact) the tiers that an edge lacks, or has beyond them."""
    got = edges.groupBy("feed_id").agg(F.collect_set("tier").alias("got"))
    met = golden.join(got, "feed_id", "left").withColumn("got", F.coalesce("got", F.array().cast("array<string>")))
    missing = F.size(F.array_except("tiers", "got"))
    extra = F.when(F.col("exact"), F.size(F.array_except("got", "tiers"))).otherwise(0)
    return met.select("feed_id", missing.cast("long").alias("missing"), extra.cast("long").alias("extra"))


def not_once(rows: DataFrame, key: str, label: str, all_keys: DataFrame) -> DataFrame:
    """Keys that aren't in exactly one label, with their number of labels."""
    n = rows.groupBy(key).agg(F.countDistinct(label).alias("labels"))
    return all_keys.select(key).distinct().join(n, key, "left").withColumn("labels", F.coalesce("labels", F.lit(0))).where("labels <> 1")


def partition_labels(rows: DataFrame, country: str, order: str, cap: int) -> DataFrame:
    """``label`` of each row: its country, in ceil(n / cap) even parts in ``order`` where it has more than ``cap`` rows."""
    out = running(rows, country, order)
    parts = F.ceil(F.col("total") / cap)
    part = F.floor((F.col("upto") - 1) * parts / F.col("total")) + 1
    name = F.coalesce(country, F.lit("other"))
    return out.withColumn("label", F.when(parts > 1, F.concat(name, F.lit("-"), part.cast("string"))).otherwise(name)).drop("upto", "total")
