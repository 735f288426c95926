"""Place trees, memberships and closures; a walk is a join for each level of a tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanroute.sinks.scratch import written

from .matching import live_ends

#: How far up a chain of ancestors is listed.
MAX_DEPTH = 8


def closure(places: DataFrame, depth: int | None = None) -> DataFrame:
    """place_id, ancestor_id, depth: every place with itself (0) and all ancestors, or those up to ``depth``.

    A parent that isn't among the places ends the walk, as does a place met before. Levels
    are written one by one until one is empty, so a tree costs as many joins as it is deep.
    """
    known = places.select(F.col("place_id").alias("parent_id")).distinct()
    up = written(places.select(F.col("place_id").alias("p"), "parent_id").where("parent_id is not null").join(known, "parent_id").select("p", "parent_id"))
    level = written(places.select("place_id", F.col("place_id").alias("ancestor_id"), F.array("place_id").alias("path")))
    levels = [level.select("place_id", "ancestor_id", F.lit(0).alias("depth"))]
    while depth is None or len(levels) <= depth:
        met = level.join(up, F.col("ancestor_id") == F.col("p")).where(~F.array_contains("path", F.col("parent_id")))
        level = written(met.select("place_id", F.col("parent_id").alias("ancestor_id"), F.array_append("path", F.col("parent_id")).alias("path")))
        if level.isEmpty():
            break
        levels.append(level.select("place_id", "ancestor_id", F.lit(len(levels)).alias("depth")))
    return reduce(DataFrame.union, levels)


def ancestor_chains(places: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """place_id, chain: ids of the ancestors up to ``depth``, the farthest first."""
    up = closure(places, depth).where("depth > 0")
    chain = F.transform(F.sort_array(F.collect_list(F.struct("depth", "ancestor_id")), asc=False), lambda x: x["ancestor_id"])
    return places.select("place_id").join(up.groupBy("place_id").agg(chain.alias("chain")), "place_id", "left").withColumn("chain", F.coalesce("chain", F.array().cast("array<string>")))


def keep_set(places: DataFrame, wanted: DataFrame, members: DataFrame | None = None, depth: int | None = None) -> DataFrame:
    """place_id of wanted places, of the metros (members: place_id, metro_id) they are in, and of the ancestors of all."""
    some = wanted.select("place_id")
    if members is not None:
        some = some.union(wanted.join(members, "place_id").select(F.col("metro_id").alias("place_id"))).distinct()
    return closure(places, depth).join(some, "place_id", "left_semi").select(F.col("ancestor_id").alias("place_id")).distinct()


def nearest_kept(places: DataFrame, kept: DataFrame, depth: int | None = None) -> DataFrame:
    """place_id, kept_id, depth: the nearest ancestor, the place itself first, that is kept; places without one are left out."""
    near = closure(places, depth).join(kept.select(F.col("place_id").alias("ancestor_id")), "ancestor_id")
    return near.groupBy("place_id").agg(F.min_by("ancestor_id", "depth").alias("kept_id"), F.min("depth").alias("depth"))


METHODS = ["inferred", "crawl", "agent", "human"]


def rehome(edges: DataFrame, homes: DataFrame) -> DataFrame:
    """Edges (place_id, feed_id, tier, confidence, review, method) of dropped places at their nearest kept ancestor.

    Edges that meet on one key merge: the greatest confidence, review if any asks for it,
    the strongest method, and the places they came from.
    """
    moved = edges.join(homes.select("place_id", "kept_id"), "place_id")
    rank = F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.col("method"))
    origin = F.when(F.col("kept_id") != F.col("place_id"), F.col("place_id"))
    return moved.groupBy(F.col("kept_id").alias("place_id"), "feed_id", "tier").agg(
        F.max("confidence").alias("confidence"), F.bool_or("review").alias("review"), F.max_by("method", rank).alias("method"), F.array_sort(F.collect_set(origin)).alias("rehomed_from")
    )


def alias_stars(claims: DataFrame) -> DataFrame:
    """alias, feed_id of claims (feed_id, alias) that may be followed; all others conflict.

    A claim counts where nobody claims the claimant, its aliases are claimed by it alone,
    and they claim nothing themselves: a star, which each claim can tell by itself.
    """
    one = claims.where("feed_id <> alias").distinct()
    by = one.groupBy("alias").agg(F.count("*").alias("claimants"))
    owners = one.select(F.col("feed_id").alias("alias")).distinct().withColumn("owns", F.lit(True))
    marked = one.join(by, "alias").join(owners, "alias", "left")
    bad = marked.withColumn("bad", (F.col("claimants") > 1) | F.coalesce("owns", F.lit(False))).groupBy("feed_id").agg(F.bool_or("bad").alias("bad"))
    claimed = one.select(F.col("alias").alias("feed_id")).distinct()
    good = bad.where("not bad").join(claimed, "feed_id", "left_anti")
    return one.join(good.select("feed_id"), "feed_id", "left_semi").select("alias", "feed_id")


def majority(members: DataFrame, owner: str, value: str) -> DataFrame:
    """owner, value: what more than half of the members that have a value hold."""
    n = members.where(F.col(value).isNotNull()).groupBy(owner, value).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(owner))
    return n.withColumn("share", share).where("share > 0.5").select(owner, value)


def reciprocal(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both lists of a membership (place_id, metro_id): metros of each place, members of each metro."""
    one = members.select("place_id", "metro_id").distinct()
    return one.groupBy("place_id").agg(F.array_sort(F.collect_list("metro_id")).alias("metro_ids")), one.groupBy("metro_id").agg(F.array_sort(F.collect_list("place_id")).alias("member_ids"))


def rewrite_keys(rows: DataFrame, mapping: DataFrame, columns: list[str], lists: list[str] = ()) -> DataFrame:
    """``rows`` with old ids of ``mapping`` (old, new) replaced in columns and lists of ids.

    Lists are taken apart, joined and put together again in their order, without repeats.
    """
    for c in columns:
        rows = rows.join(mapping.select(F.col("old").alias(c), F.col("new").alias("_new")), c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    for c in lists:
        rows = written(rows.withColumn("_row", F.monotonically_increasing_id()))  # ids stay as they are
        parts = rows.select("_row", F.posexplode(c).alias("_at", "old")).join(mapping, "old", "left").select("_row", "_at", F.coalesce("new", "old").alias("id"))
        done = parts.groupBy("_row").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("_at", "id"))), lambda x: x["id"])).alias("_list"))
        rows = rows.join(done, "_row", "left").withColumn(c, F.coalesce("_list", c)).drop("_row", "_list")
    return rows


def numbered(fresh: DataFrame, next_id: int) -> DataFrame:
    """key, minted: new ids numbered on from ``next_id`` in the order of the distinct keys."""
    # Numbers without a global window: counts of ranges of keys, then rows within a range. The
    # ranges are written once, as another run could part the keys elsewhere.
    ranges = written(fresh.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    ranges = ranges.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("key")))
    sizes = ranges.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "before")
    return ranges.join(before, "part").select("key", F.concat(F.lit("tp_"), (F.col("before") + F.col("nth") - 1 + next_id).cast("string")).alias("minted"))


def identify(rows: DataFrame, concordance: DataFrame, next_id: int) -> DataFrame:
    """key, place_id, outcome: rows (key, values) against a registry's concordances (value, place_id).

    No place known: one is minted, numbered on from ``next_id`` in the order of keys; one:
    it is identified; more: it conflicts and stays without an id.
    """
    hits = rows.select("key", F.explode_outer("values").alias("value")).join(concordance, "value", "left")
    found = hits.groupBy("key").agg(F.countDistinct("place_id").alias("n"), F.min("place_id").alias("one"))
    minted = numbered(found.where("n = 0").select("key"), next_id)
    outcome = F.when(F.col("n") == 0, "minted").when(F.col("n") == 1, "identified").otherwise("conflict")
    return found.join(minted, "key", "left").select("key", F.when(F.col("n") == 0, F.col("minted")).when(F.col("n") == 1, F.col("one")).alias("place_id"), outcome.alias("outcome"))


def enlist(rows: DataFrame, concordance: DataFrame, places: DataFrame, detached: DataFrame, next_id: int) -> DataFrame:
    """key, place_id, outcome of rows (key, kind, values) that join a registry one after the other, in the order of their keys.

    ``concordance`` has value and place_id, ``places`` place_id and kind, ``detached``
    place_id and values once taken from it. A row whose values name one place is that place,
    if it is of the row's kind and none of the values was detached from it; the place gains the
    others. A row that names none mints the next id, with all its values. Rows that name several
    (``conflict``), one of another kind (``kind``) or one a value was detached from (``detached``),
    and rows without values (``empty``), get no place, and their values stay free.

    A value goes to the first row to take it and never changes hands, so a row only waits
    for values that an earlier row, still open, may take. Each pass settles all rows that
    wait for nothing; there are as many as rows wait for each other in a line.
    """
    values = F.array_distinct(F.filter(F.coalesce("values", F.array().cast("array<string>")), lambda v: v.isNotNull()))
    all_ = written(rows.select("key", "kind", values.alias("values")))
    open_ = all_.select("key", "kind", F.explode("values").alias("value"))
    # A value brings its place's kind along, so that no pass looks kinds up among all rows.
    index = concordance.join(places.select("place_id", F.col("kind").alias("_kind")), "place_id", "left")
    index = index.select("value", "place_id", F.lit(None).cast(all_.schema["key"].dataType).alias("minted"), "_kind").distinct()
    settled, place = [], F.struct("place_id", "minted", "_kind")
    while True:
        met = open_.join(index, "value", "left").withColumn("place", F.when(F.col("place_id").isNotNull() | F.col("minted").isNotNull(), place)).select("key", "kind", "value", "place")
        first = met.where("place is null").groupBy("value").agg(F.min("key").alias("first"))
        waits = F.max(F.coalesce(F.col("first") < F.col("key"), F.lit(False)))
        seen = met.join(first, "value", "left").withColumn("first", F.when(F.col("place").isNull(), F.col("first")))
        seen = seen.groupBy("key", "kind").agg(F.count_distinct("place").alias("n"), F.min("place").alias("place"), waits.alias("waits"), F.collect_set("value").alias("values"))
        ready = written(seen.where("n > 1 or not waits"))
        one = ready.where("n = 1").select("key", "kind", "place.place_id", "place.minted", F.explode("values").alias("value"))
        gone = one.join(detached.select("place_id", "value").distinct(), ["place_id", "value"], "left_semi").select("key", F.lit(True).alias("gone")).distinct()
        of = ready.join(gone, "key", "left")
        outcome = (
            F.when(F.col("n") > 1, "conflict").when(F.col("n") == 0, "minted").when(~F.col("place._kind").eqNullSafe(F.col("kind")), "kind").when(F.col("gone"), "detached").otherwise("identified")
        )
        done = of.select("key", outcome.alias("outcome"), F.col("place.place_id").alias("place_id"), F.coalesce("place.minted", F.when(F.col("n") == 0, F.col("key"))).alias("minted"), F.col("kind").alias("_kind"), "values")
        done = written(done)
        settled.append(done)
        good = done.where("outcome in ('minted', 'identified')").select(F.explode("values").alias("value"), "place_id", "minted", "_kind")
        index = written(index.union(good).distinct())
        open_ = written(open_.join(done.select("key"), "key", "left_anti"))
        if open_.isEmpty():
            break
    every = reduce(DataFrame.union, settled)
    ids = numbered(every.where("outcome = 'minted'").select("key"), next_id).select(F.col("key").alias("minted"), F.col("minted").alias("id"))
    found = every.join(ids, "minted", "left").withColumn("place_id", F.when(F.col("outcome").isin("minted", "identified"), F.coalesce("place_id", "id"))).select("key", "place_id", "outcome")
    return found.union(all_.where(F.size("values") == 0).select("key", F.lit(None).cast("string"), F.lit("empty")))


def survivors(registry: DataFrame) -> DataFrame:
    """place_id, live_id: every place of a registry (place_id, into) with the live one it was merged into, itself if live.

    ``into`` is null in live rows. A row that leads to no live place is absent.
    """
    live = registry.where("into is null").select("place_id", F.col("place_id").alias("live_id"))
    return live.unionByName(live_ends(registry.withColumn("_live", F.col("into").isNull()), "place_id", "into", "_live"))


def resolve(references: DataFrame, registry: DataFrame, concordance: DataFrame) -> DataFrame:
    """reference, place_id: the live place of an id (tp_1), of a bare Wikidata item (Q1) or of namespace:value; null if none.

    ``concordance`` has value, as namespace:value, and place_id, one place for each value.
    """
    one, ends = references.select("reference").distinct(), survivors(registry)
    value = F.when(F.col("reference").rlike("^Q[0-9]+$"), F.concat(F.lit("wikidata:"), "reference")).otherwise(F.col("reference"))
    named = one.withColumn("value", value).join(concordance.select("value", F.col("place_id").alias("by_value")), "value", "left")
    owner = F.when(F.col("reference").rlike("^tp_[0-9]+$"), F.col("reference")).otherwise(F.col("by_value"))
    found = named.select("reference", owner.alias("owner")).join(ends.withColumnRenamed("place_id", "owner"), "owner", "left")
    return found.select("reference", F.col("live_id").alias("place_id"))


def enrich(rows: DataFrame, identified: DataFrame, concordance: DataFrame, detached: DataFrame) -> DataFrame:
    """value, place_id: what a concordance gains from rows (key, values) that were identified or minted (key, place_id).

    A row with a value that was detached from its place adds nothing. A new value that rows
    of several places bring goes to the place of the least key. Conflicts (a null place) add nothing.
    """
    pairs = rows.select("key", F.explode("values").alias("value")).join(identified.where("place_id is not null").select("key", "place_id"), "key")
    barred = pairs.join(detached.select("value", "place_id").distinct(), ["value", "place_id"], "left_semi").select("key").distinct()
    fresh = pairs.join(barred, "key", "left_anti").where("value is not null").join(concordance, "value", "left_anti")
    return fresh.groupBy("value").agg(F.min_by("place_id", F.struct("key", "place_id")).alias("place_id"))


def merge(registry: DataFrame, merges: DataFrame, concordance: DataFrame | None = None, detached: DataFrame | None = None) -> DataFrame:
    """The registry after merges (place_id, into), one for a place: merged rows name the live place at the end of all.

    Refused, and without effect: a merge of or into a place that isn't live, into itself, of
    two places where either resolves a value detached from the other or from one merged into
    it, and merges that end in a cycle. ``concordance`` and ``detached`` have value, place_id.
    """
    live = registry.where("into is null").select("place_id")
    asked = merges.select("place_id", F.col("into").alias("target")).where("place_id <> target")
    asked = asked.join(live, "place_id", "left_semi").join(live.withColumnRenamed("place_id", "target"), "target", "left_semi")
    if concordance is not None and detached is not None:
        ends = written(survivors(registry))
        held = concordance.join(ends, "place_id").select("value", F.col("live_id").alias("holder")).distinct()
        taken = detached.join(ends, "place_id").select("value", F.col("live_id").alias("loser")).distinct()
        clash = written(held.join(taken, "value").select("holder", "loser").distinct())
        for a, b in (("holder", "loser"), ("loser", "holder")):
            asked = asked.join(clash.select(F.col(a).alias("place_id"), F.col(b).alias("target")), ["place_id", "target"], "left_anti")
    after = written(registry.join(asked, "place_id", "left"))
    ends = survivors(after.select("place_id", F.coalesce("into", "target").alias("into")))
    into = F.when(F.col("live_id").isNull(), F.col("into")).when(F.col("live_id") != F.col("place_id"), F.col("live_id"))
    return after.join(ends, "place_id", "left").withColumn("into", into).select(*registry.columns)


def supersede(registry: DataFrame, changes: DataFrame, next_id: int) -> DataFrame:
    """The registry (place_id, kind, into) after live places got another kind (place_id, kind), one change for a place.

    A kind never changes: a new place is minted, numbered on from ``next_id`` in the order
    of the places, and the old one merges into it. A change to the same kind has no effect.
    """
    live = registry.where("into is null").select("place_id", F.col("kind").alias("was"))
    due = changes.select("place_id", "kind").join(live, "place_id").where("kind <> was")
    minted = written(numbered(due.select(F.col("place_id").alias("key")), next_id))
    new = due.join(minted, F.col("place_id") == F.col("key")).select(F.col("minted").alias("place_id"), "kind", F.lit(None).cast("string").alias("into"))
    return merge(registry.unionByName(new, allowMissingColumns=True), minted.select(F.col("key").alias("place_id"), F.col("minted").alias("into")))
