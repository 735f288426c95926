"""The domain's relations as views of the driver's tables, in Spark and in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The day on which snapshots count as built, and feeds as last read.
BUILT = "2001-10-01"
#: Lines of orders in a task.
LINES = 250_000
TIERS = {"1": "local", "2": "regional", "3": "national", "4": "international", "5": "unknown"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables and the views made of them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._tasks: int | None = None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def places(self) -> DataFrame:
        """Countries (regions), regions (nations) and cities (nation and segment)."""
        nation = self.read("nation")
        top = self.read("region").select(
            F.concat(F.lit("R"), "r_regionkey").alias("place_id"), F.lit("country").alias("kind"), F.col("r_name").alias("name"),
            F.lit(None).cast("string").alias("parent_id"), F.concat(F.lit("R"), "r_regionkey").alias("country_code"),
        )
        middle = nation.select(
            F.concat(F.lit("N"), "n_nationkey").alias("place_id"), F.lit("region").alias("kind"), F.col("n_name").alias("name"),
            F.concat(F.lit("R"), "n_regionkey").alias("parent_id"), F.concat(F.lit("R"), "n_regionkey").alias("country_code"),
        )
        city = self.read("customer").select("c_nationkey", "c_mktsegment").distinct().join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        city = city.select(
            F.concat(F.lit("C"), "c_nationkey", F.lit("-"), "c_mktsegment").alias("place_id"), F.lit("city").alias("kind"), F.concat("c_mktsegment", F.lit(" "), "n_name").alias("name"),
            F.concat(F.lit("N"), "c_nationkey").alias("parent_id"), F.concat(F.lit("R"), "n_regionkey").alias("country_code"),
        )
        return top.unionByName(middle).unionByName(city)

    def feeds(self) -> DataFrame:
        joined = self.read("supplier").join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select(
            F.concat(F.lit("F"), "s_suppkey").alias("feed_id"), F.col("s_name").alias("name"), F.concat(F.lit("R"), "n_regionkey").alias("home"),
            F.when(F.col("s_suppkey") % 2 == 0, "domestic").otherwise("international").alias("scope"),
        )

    def facts(self) -> DataFrame:
        """A line of an order as a stop of a trip: feed, city, stop, trip, vehicles, tier, day.

        Orders meet their buyers first, so lines are shuffled once, by order. A task has ``LINES`` of them at any size:
        shuffles that Spark may coalesce by their compressed bytes leave ten times as many to one.
        """
        if self._tasks is None:
            self._tasks = max(self.spark.sparkContext.defaultParallelism, -(-self.read("lineitem").count() // LINES))
        line = self.read("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
        order = self.read("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
        buyer = self.read("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        tier = F.create_map(*[F.lit(x) for pair in TIERS.items() for x in pair])[F.substring("o_orderpriority", 1, 1)]
        return (
            line.repartition(self._tasks, "l_orderkey").join(order.join(buyer, F.col("o_custkey") == F.col("c_custkey")).repartition(self._tasks, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat(F.lit("F"), "l_suppkey").alias("feed_id"), F.concat(F.lit("C"), "c_nationkey", F.lit("-"), "c_mktsegment").alias("place_id"),
                "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", tier.alias("tier"), F.to_date("l_shipdate").alias("day"), F.year("o_orderdate").alias("build"),
            )
        )

    def pairs(self) -> DataFrame:
        """Feed and city with their service; departures are unknown for each seventh feed."""
        known = F.when(F.first("l_suppkey") % 7 != 0, F.sum("l_quantity"))
        # Lines of an order lie together, so it is counted at one of them, and only stops need a shuffle of their own.
        one = F.row_number().over(Window.partitionBy("l_orderkey", "feed_id", "place_id").orderBy("l_linenumber")) == 1
        return self.facts().withColumn("one", one.cast("long")).groupBy("feed_id", "place_id").agg(
            F.countDistinct("l_partkey").alias("stops"), F.sum("one").alias("routes"), known.alias("departures"), F.max("day").alias("service_end")
        )

    def edges(self) -> DataFrame:
        return self.facts().select("feed_id", "place_id", "tier").distinct()

    def intervals(self) -> DataFrame:
        """Closed spells of service by feed and part's brand."""
        brand = self.read("part").select("p_partkey", "p_brand")
        joined = self.facts().join(brand, F.col("l_partkey") == F.col("p_partkey"))
        return joined.groupBy("feed_id", "p_brand").agg(F.min("day").alias("start"), F.date_add(F.min("day"), 40).alias("end"))


SQL = {
    "places": """
        SELECT 'R' || r_regionkey AS place_id, 'country' AS kind, r_name AS name, NULL::VARCHAR AS parent_id, 'R' || r_regionkey AS country_code FROM region
        UNION ALL SELECT 'N' || n_nationkey, 'region', n_name, 'R' || n_regionkey, 'R' || n_regionkey FROM nation
        UNION ALL SELECT 'C' || c_nationkey || '-' || c_mktsegment, 'city', c_mktsegment || ' ' || n_name, 'N' || c_nationkey, 'R' || n_regionkey
        FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) JOIN nation ON c_nationkey = n_nationkey""",
    "feeds": """
        SELECT 'F' || s_suppkey AS feed_id, s_name AS name, 'R' || n_regionkey AS home, CASE WHEN s_suppkey % 2 = 0 THEN 'domestic' ELSE 'international' END AS scope
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "facts": """
        SELECT 'F' || l_suppkey AS feed_id, 'C' || c_nationkey || '-' || c_mktsegment AS place_id, l_suppkey, l_partkey, l_orderkey, l_linenumber, l_quantity,
               CASE o_orderpriority[1] WHEN '1' THEN 'local' WHEN '2' THEN 'regional' WHEN '3' THEN 'national' WHEN '4' THEN 'international' WHEN '5' THEN 'unknown' END AS tier,
               l_shipdate::DATE AS day, year(o_orderdate)::INT AS build
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "pairs": """
        SELECT feed_id, place_id, count(DISTINCT l_partkey) AS stops, count(DISTINCT l_orderkey) AS routes,
               CASE WHEN any_value(l_suppkey) % 7 <> 0 THEN sum(l_quantity) END AS departures, max(day) AS service_end
        FROM facts GROUP BY ALL""",
    "edges": "SELECT DISTINCT feed_id, place_id, tier FROM facts",
    "intervals": """
        SELECT feed_id, p_brand, min(day) AS start, min(day) + 40 AS "end"
        FROM facts JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
}


def with_views(sql: str) -> str:
    """``sql`` (a query, or common table expressions before one) with the views that it names put first."""
    need: list[str] = []

    def add(text: str) -> None:
        for name, body in SQL.items():
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in need:
                add(body)
                need.append(name)

    add(sql)
    views = [f"{n} AS ({SQL[n]})" for n in need]
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    if own:
        return f"WITH {own[1] or ''}{', '.join([*views, sql[own.end():]])}"
    return f"WITH {', '.join(views)} {sql}" if views else sql


def query(name: str, sql: str | None = None):
    """Register a query over Tables and, where SQL can say the same, its oracle."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = with_views(sql)
        return f

    return register
