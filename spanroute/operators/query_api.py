"""What a reader of a published catalogue can ask; each returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanroute.operators.hierarchy import closure

LEVELS = {
    "local": (["city"], ["primary"], ["local"]), "regional": (["city", "region"], ["secondary"], ["regional"]), "national": (["country"], ["tertiary"], ["national"]),
    "international": (["city", "region", "country"], ["international"], ["international"]),
}


class SliceError(ValueError):
    """A slice that would be unbounded."""


def filter_places(places: DataFrame, kinds: list[str] | None = None, parent: str | None = None, bbox: tuple[float, float, float, float] | None = None, text: str | None = None, served: DataFrame | None = None) -> DataFrame:
    """Places of the given kinds, below a parent, touching a box, with a text in their name, that are served.

    A slice with cities needs a parent or a box; all conditions reach the scan.
    """
    if (not kinds or "city" in kinds) and parent is None and bbox is None:
        raise SliceError("a slice with cities needs a parent or a box")
    rows = places
    if kinds:
        rows = rows.where(F.col("kind").isin(kinds))
    if parent is not None:
        rows = rows.where(F.col("parent_id") == parent)
    if bbox is not None:
        w, s, e, n = bbox
        wide = (F.col("xmax") >= w) & (F.col("xmin") <= e) if w <= e else (F.col("xmax") >= w) | (F.col("xmin") <= e)
        rows = rows.where(wide & (F.col("ymax") >= s) & (F.col("ymin") <= n))
    if text:
        rows = rows.where(F.contains(F.lower("name"), F.lit(text.lower())))
    if served is not None:
        rows = rows.join(served.select("place_id").distinct(), "place_id", "left_semi")
    return rows


def level_view(edges: DataFrame, level: str) -> DataFrame:
    """Edges (kind, category, tier, cross_border) of a level; international ones must also cross a border."""
    kinds, categories, tiers = LEVELS[level]
    rows = edges.where(F.col("kind").isin(kinds) & F.col("category").isin(categories) & F.col("tier").isin(tiers))
    return rows.where("cross_border") if level == "international" else rows


def page(rows: DataFrame, sort: str, key: str, descending: bool = False, offset: int = 0, limit: int = 50) -> DataFrame:
    """A page in the order of a column, nulls last, ties by key, with the total of all rows beside each."""
    if sort not in rows.columns:
        raise ValueError(f"no column {sort}")
    order = F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()
    total = rows.agg(F.count("*")).scalar()
    return rows.orderBy(order, key).offset(offset).limit(limit).withColumn("total", total)


def search(rows: DataFrame, text: str, limit: int, name: str = "name") -> DataFrame:
    """Rows by how well they meet a text: the name, one of its lines, the start of a word, anywhere; then served, feeds, name."""
    low, q = F.lower(name), text.lower()
    lines = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.lower(a)) if "aliases" in rows.columns else F.array().cast("array<string>")
    rank = F.when(low == q, 0).when(F.array_contains(lines, q), 1).when(low.startswith(q) | F.contains(low, F.lit(" " + q)), 2).when(F.contains(low, F.lit(q)), 3)
    return rows.withColumn("rank", rank).where("rank is not null").orderBy("rank", F.desc("served"), F.desc("feeds"), name, "place_id").limit(limit)


def truncated(rows: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """The first ``limit`` rows, and on each whether there are more: one row more is read, not all."""
    few = rows.orderBy(*order).limit(limit + 1)
    nth = F.row_number().over(Window.orderBy(*order))  # of limit + 1 rows
    return few.withColumn("nth", nth).withColumn("more", F.max("nth").over(Window.partitionBy()) > limit).where(F.col("nth") <= limit).drop("nth")


def tree_level(places: DataFrame, parent: str | None, limit: int) -> DataFrame:
    """Children of a place with the number of their own, by name."""
    own = places.where(F.col("parent_id").isNull() if parent is None else F.col("parent_id") == parent)
    below = places.groupBy(F.col("parent_id").alias("up")).agg(F.count("*").alias("children"))
    met = own.join(below, F.col("place_id") == F.col("up"), "left").select("place_id", "name", F.coalesce("children", F.lit(0)).alias("children"))
    return met.orderBy("name", "place_id").limit(limit)


def place_record(places: DataFrame, members: DataFrame, edges: DataFrame) -> DataFrame:
    """place_id, name, kind, ancestors (root first), metros, feeds of every place; filter it by id."""
    up = closure(places).where("depth > 0").groupBy("place_id").agg(F.sort_array(F.collect_list(F.struct("depth", "ancestor_id")), asc=False).alias("up"))
    metros = members.groupBy("place_id").agg(F.array_sort(F.collect_set("metro_id")).alias("metros"))
    feeds = edges.groupBy("place_id").agg(F.countDistinct("feed_id").alias("feeds"))
    rows = places.join(up, "place_id", "left").join(metros, "place_id", "left").join(feeds, "place_id", "left")
    none = F.array().cast("array<string>")
    return rows.select("place_id", "name", "kind", F.coalesce(F.transform("up", lambda x: x["ancestor_id"]), none).alias("ancestors"), F.coalesce("metros", none).alias("metros"), F.coalesce("feeds", F.lit(0)).alias("feeds"))


def feeds_table(feeds: DataFrame, edges: DataFrame, tiers: list[str]) -> DataFrame:
    """Feeds with the places they serve and their edges of each tier."""
    counts = edges.groupBy("feed_id").agg(F.countDistinct("place_id").alias("places"), *[F.count_if(F.col("tier") == x).alias("n_" + x) for x in tiers])
    return feeds.join(counts, "feed_id", "left").na.fill(0)


def feature(rows: DataFrame, properties: list[str]) -> DataFrame:
    """key and GeoJSON text of boxes (xmin, ymin, xmax, ymax) as polygons."""
    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    ring = F.array(*[F.array(a, b) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return rows.select(*properties, F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("feature"))
