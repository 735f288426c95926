"""Entity resolution: which records of two catalogues are the same feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanroute.sinks.scratch import written


def unique_keys(rows: DataFrame, id_col: str, key: str) -> DataFrame:
    """id and key of keys that only one record holds; a key repeated within a record counts once."""
    one = rows.where(F.col(key).isNotNull()).select(id_col, key).distinct()
    ids = one.groupBy(key).agg(F.min(id_col).alias(id_col), F.count("*").alias("n"))
    return ids.where("n = 1").select(id_col, key)


def unique_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str) -> DataFrame:
    """Pairs whose key is unique on both sides."""
    return unique_keys(left, left_id, key).join(unique_keys(right, right_id, key), key).select(left_id, right_id).distinct()


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def similar(left: DataFrame, right: DataFrame, left_id: str, right_id: str, block: str, tokens: str, least: float = 0.8) -> DataFrame:
    """Pairs within a block whose best overlap of token sets is ``least`` or more.

    Records hold one token set a row; ``least`` is above 0. Of two sets that overlap so much, the
    ``size - ceil(least * size) + 1`` rarest tokens of the block in one hold one of those in the
    other, so the join is on block and rare token: what all records of a busy host have in common
    makes no pairs. Sets of sizes that can't overlap enough aren't compared.
    """
    a = left.select(left_id, block, F.array_sort(F.array_distinct(tokens)).alias("a")).distinct()
    b = right.select(right_id, block, F.array_sort(F.array_distinct(tokens)).alias("b")).distinct()
    counts = b.select(block, F.explode("b").alias("t")).groupBy(block, "t").agg(F.count("*").alias("n"))

    def rare(rows: DataFrame, key: str, c: str) -> DataFrame:
        """Records with each of their rarest tokens, by how many records of the right side have them."""
        each = rows.withColumn("t", F.explode(c)).join(counts, [block, "t"], "left")
        ordered = each.groupBy(key, block, c).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t"))).alias("o"))
        kept = F.size(c) - F.ceil(F.lit(least) * F.size(c) - 1e-9).cast("int") + 1
        return ordered.select(key, block, c, F.explode(F.slice("o", 1, kept)["t"]).alias("t"))

    met = rare(a, left_id, "a").join(rare(b, right_id, "b"), [block, "t"]).where(F.least(F.size("a"), F.size("b")) >= F.lit(least) * F.greatest(F.size("a"), F.size("b")) - 1e-9)
    pairs = met.withColumn("overlap", jaccard(F.col("a"), F.col("b"))).where(F.col("overlap") >= least)
    return pairs.groupBy(left_id, right_id, block).agg(F.max("overlap").alias("overlap"))


def mutual(pairs: DataFrame, left_id: str, right_id: str) -> tuple[DataFrame, DataFrame]:
    """Pairs that are each other's only candidate, and the rest, which are provisional."""
    counted = pairs.withColumn("ln", F.count("*").over(Window.partitionBy(left_id))).withColumn("rn", F.count("*").over(Window.partitionBy(right_id)))
    clean = (F.col("ln") == 1) & (F.col("rn") == 1)
    return counted.where(clean).drop("ln", "rn"), counted.where(~clean).drop("ln", "rn")


def historic_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str, matched: DataFrame) -> DataFrame:
    """Pairs over current or past keys, unique on both sides, of records still unmatched; a record reached twice is left out."""
    a = left.join(matched.select(left_id), left_id, "left_anti")
    b = right.join(matched.select(right_id), right_id, "left_anti")
    return mutual(unique_join(a, b, left_id, right_id, key), left_id, right_id)[0]


def cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, steps: list[tuple[str, float, object]]) -> DataFrame:
    """Pairs by the first step that finds them: left, right, method, confidence.

    A step is a name, a confidence and a function that pairs the records still unmatched.
    """
    done = None
    for method, confidence, step in steps:
        a = left if done is None else left.join(done.select(left_id), left_id, "left_anti")
        b = right if done is None else right.join(done.select(right_id), right_id, "left_anti")
        new = step(a, b).select(left_id, right_id).withColumn("method", F.lit(method)).withColumn("confidence", F.lit(confidence))
        done = new if done is None else done.unionByName(new)
    return done


def residual_union(left: DataFrame, right: DataFrame, pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Matched pairs, then records that only one side has: left, right, method, confidence, source."""
    both = pairs.withColumn("source", F.lit("both"))
    rest = F.lit("none").alias("method"), F.lit(0.0).alias("confidence")
    one = left.select(left_id).distinct().join(pairs, left_id, "left_anti").select(left_id, F.lit(None).cast("long").alias(right_id), *rest, F.lit("left").alias("source"))
    two = right.select(right_id).distinct().join(pairs, right_id, "left_anti").select(F.lit(None).cast("long").alias(left_id), right_id, *rest, F.lit("right").alias("source"))
    return both.unionByName(one).unionByName(two)


def live_ends(rows: DataFrame, id_col: str, to: str, live: str, spec: str | None = None) -> DataFrame:
    """id and its live end along single redirects, however long the chain.

    Each round doubles the steps taken by the rows that haven't come to an end, and the
    last is that in which no more of them do: what is left then runs in cycles, which never
    meet a live row. ``rows`` has one row per id; ``to`` is null where a row names no
    single successor. A step to a row of another ``spec`` ends a chain without a live end.
    """
    kind = F.col(spec) if spec else F.lit(0)
    jump = rows.select(F.col(id_col).alias("id"), F.when(~F.coalesce(F.col(live), F.lit(False)), F.col(to)).alias("at"), F.coalesce(F.col(live), F.lit(False)).alias("live"), kind.alias("spec"))
    own = jump.select(F.col("id").alias("at"), F.col("live").alias("ends"), F.col("spec").alias("other"))
    steps = jump.where("not live").join(own, "at").where(F.col("spec").eqNullSafe(F.col("other"))).select("id", "at", "ends")
    done, open_ = [written(steps.where("ends")).select("id", "at")], written(steps.where("not ends")).select("id", "at")
    ends, left = done[0], open_.count()
    while left:
        further = written(open_.alias("x").join(open_.alias("y"), F.col("x.at") == F.col("y.id")).select("x.id", F.col("y.at").alias("at")))
        met = written(open_.alias("x").join(ends.alias("y"), F.col("x.at") == F.col("y.id")).select("x.id", F.col("y.at").alias("at")))
        if met.isEmpty():
            break
        done.append(met)
        ends = reduce(DataFrame.union, done)
        open_ = further
        left = open_.count()
    return ends.select(F.col("id").alias(id_col), F.col("at").alias("live_id"))


def co_listed(lists: DataFrame, owner: str, member: str) -> DataFrame:
    """Undirected pairs a < b of members that one owner lists."""
    one = lists.select(owner, member).distinct()
    return one.select(owner, F.col(member).alias("a")).join(one.select(owner, F.col(member).alias("b")), owner).where("a < b").select("a", "b").distinct()


def static_link(realtime: DataFrame, static: DataFrame, declared: DataFrame) -> DataFrame:
    """rt_id, static_id, method: declared (the only one, or the only one of the same file), lone in the file, lone on a host, none.

    ``realtime`` has rt_id, file, host; ``static`` has static_id, file, host; ``declared`` rt_id, static_id.
    """
    listed = declared.join(static.select("static_id", F.col("file").alias("static_file")).distinct(), "static_id")
    listed = listed.join(realtime.select("rt_id", "file").distinct(), "rt_id").distinct()
    near = F.when(F.col("static_file") == F.col("file"), F.col("static_id"))
    said = listed.groupBy("rt_id").agg(F.count("*").alias("n"), F.min("static_id").alias("one"), F.count(near).alias("n_file"), F.min(near).alias("in_file"))

    def lone(key: str, name: str) -> DataFrame:
        # A key is counted before it meets others: all that have it may be very many on both sides.
        one = static.where(F.col(key).isNotNull()).select(key, "static_id").distinct().groupBy(key).agg(F.min("static_id").alias(name), F.count("*").alias("_n"))
        met = realtime.select("rt_id", key).distinct().join(one, key)
        same = (F.max("_n") == 1) & F.min(name).eqNullSafe(F.max(name))
        return met.groupBy("rt_id").agg(F.min(name).alias(name), same.alias("_same")).where("_same").select("rt_id", name)

    every = realtime.select("rt_id").distinct().join(said, "rt_id", "left").join(lone("file", "by_file"), "rt_id", "left").join(lone("host", "by_host"), "rt_id", "left")
    declared_to = F.when(F.col("n") == 1, F.col("one")).when(F.col("n_file") == 1, F.col("in_file"))
    inferred = F.col("n").isNull()
    to = F.coalesce(declared_to, F.when(inferred, F.coalesce("by_file", "by_host")))
    method = F.when(declared_to.isNotNull(), "declared").when(inferred & F.col("by_file").isNotNull(), "same_file").when(inferred & F.col("by_host").isNotNull(), "same_host").otherwise("none")
    return every.select("rt_id", to.alias("static_id"), method.alias("method"))


def agreed_location(rows: DataFrame, key: str, levels: list[str]) -> DataFrame:
    """The finest location on which all rows of a key agree: levels from the coarsest, null from where they differ."""
    rows = rows.where(F.col(key).isNotNull())
    agg = rows.groupBy(key).agg(*[F.countDistinct(F.coalesce(c, F.lit(""))).alias("n_" + c) for c in levels], *[F.min(c).alias(c) for c in levels])
    out, good = [F.col(key)], F.lit(True)
    for c in levels:
        good = good & (F.col("n_" + c) == 1)
        out.append(F.when(good, F.col(c)).alias(c))
    return agg.select(*out)


def name_lookup(asked: DataFrame, known: DataFrame) -> DataFrame:
    """key, place_id, outcome of names (key, country, name, subdivision) among places (place_id, country, variants, parent_id).

    A place of the country that has the name as a variant is a candidate. The only one is
    taken (``unique``), as is the only one below the subdivision that is asked for
    (``corroborated``); several stay ``ambiguous``, none is ``unknown``.
    """
    named = known.select("country", F.explode(F.array_distinct("variants")).alias("name"), "place_id", "parent_id")
    met = asked.join(named, ["country", "name"], "left")
    below = F.when(F.col("parent_id") == F.col("subdivision"), F.col("place_id"))
    found = met.groupBy("key").agg(F.countDistinct("place_id").alias("n"), F.min("place_id").alias("one"), F.countDistinct(below).alias("n_below"), F.min(below).alias("below"))
    outcome = F.when(F.col("n") == 0, "unknown").when(F.col("n") == 1, "unique").when(F.col("n_below") == 1, "corroborated").otherwise("ambiguous")
    return found.select("key", F.when(F.col("n") == 1, F.col("one")).when(F.col("n_below") == 1, F.col("below")).alias("place_id"), outcome.alias("outcome"))


def canonical_ids(rows: DataFrame, feeds: DataFrame, column: str) -> DataFrame:
    """Rows with ``canonical``, the feed (feed_id, aliases) that ``column`` names by id or alias; null for none.

    An id of its own comes before an alias, and of aliases that several feeds claim the lowest feed.
    """
    names = feeds.select(F.col("feed_id").alias("_name"), F.lit(0).alias("_rank"), "feed_id").union(feeds.select(F.explode("aliases"), F.lit(1), "feed_id"))
    best = names.groupBy("_name").agg(F.min_by("feed_id", F.struct("_rank", "feed_id")).alias("canonical"))
    return rows.join(best, F.col(column) == F.col("_name"), "left").drop("_name")
