"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (least node reachable) for every node that ``edges`` (a, b) names.

    Each round hooks every node's root onto the least root among its neighbours and then
    halves the paths. Minima combine before the shuffle, so a node with very many links
    costs no task more than another. Each round ends in a written table, so that lineage
    stays short; only the count of changed edges reaches the driver.
    """
    # Edges are kept between roots: an edge inside a component is dropped as soon as both ends agree.
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = materialize(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")))
    live = edges
    for _ in range(max_rounds):
        # b is the larger root: it hooks onto the least smaller root it touches.
        hook = live.groupBy("b").agg(F.min("a").alias("to"))
        # Pointer jumping over the hooks (each points to a smaller root, so there are no cycles).
        hook = materialize(hook)
        while True:
            jumped = materialize(
                hook.alias("x").join(hook.alias("y"), F.col("x.to") == F.col("y.b"), "left")
                .select(F.col("x.b").alias("b"), F.coalesce("y.to", "x.to").alias("to"), F.col("y.to").isNotNull().alias("moved"))
            )
            if jumped.where("moved").isEmpty():
                break
            hook = jumped.select("b", "to")
        labels = labels.alias("l").join(hook.alias("h"), F.col("l.root") == F.col("h.b"), "left").select("l.node", F.coalesce("h.to", "l.root").alias("root"))
        labels = materialize(labels)
        one = live.alias("e").join(hook.alias("h"), F.col("e.a") == F.col("h.b"), "left").select(F.coalesce("h.to", "e.a").alias("a"), "e.b")
        two = one.alias("e").join(hook.alias("h"), F.col("e.b") == F.col("h.b"), "left").select("e.a", F.coalesce("h.to", "e.b").alias("b"))
        live = materialize(two.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if live.isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
