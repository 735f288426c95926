"""Aggregates with the domain's own rules for nulls, ties and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_map(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """keys and ``counts``, a map from each value of ``by`` to its number of rows."""
    one = rows.groupBy(*keys, by).count()
    pairs = F.array_sort(F.collect_list(F.struct(F.col(by).alias("key"), F.col("count").alias("value"))))
    return one.groupBy(*keys).agg(F.map_from_entries(pairs).alias("counts"))


def quartiles(value: str) -> list[Column]:
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return [q[i].alias(f"q{i + 1}") for i in range(3)]


def service_of_places(pairs: DataFrame, stale: Column) -> DataFrame:
    """Service of each place: one vote for each pair, stale feeds left out; departures are null only if no pair reports them."""
    one = pairs.where(~stale).dropDuplicates(["feed_id", "place_id"])
    return one.groupBy("place_id").agg(F.sum("stops").alias("stops"), F.sum("routes").alias("routes"), F.sum("departures").alias("departures"))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def span_reference(rows: DataFrame, country: str, mode: str, identity: list[str], value: str, least: int) -> DataFrame:
    """bucket, mode, p90 (interpolated), n per country and over all (``*``); an identity counts once in each bucket."""
    both = rows.withColumn("bucket", F.explode(F.array(F.col(country), F.lit("*"))))
    once = both.groupBy("bucket", mode, *identity).agg(F.max(value).alias(value))
    return once.groupBy("bucket", mode).agg(F.percentile(value, F.lit(0.9)).alias("p90"), F.count("*").alias("n")).where(F.col("n") >= least)


def all_agree(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys whose rows hold more than one value of ``columns`` together, nulls being values."""
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.groupBy(*keys).agg(F.countDistinct(value).alias("values")).where("values > 1")


def digest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A digest of each key's rows whatever their order."""
    row = F.sha2(F.to_json(F.struct(*columns)), 256)
    return rows.groupBy(*keys).agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(row))), 256).alias("digest"))


def least_squares(rows: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """One row of coefficients ``b0``, ``b1``, ... and ``r2`` of y on (1, xs): normal equations from one aggregate.

    The sums are a handful of numbers; solving them is done on one row by elimination.
    """
    terms = [F.lit(1.0), *[F.col(x).cast("double") for x in xs]]
    n, target = len(terms), F.col(y).cast("double")
    sums = {f"m{i}{j}": F.sum(terms[i] * terms[j]) for i in range(n) for j in range(i, n)} | {f"v{i}": F.sum(terms[i] * target) for i in range(n)} | {"yy": F.sum(target * target)}
    row = rows.agg(*[c.alias(k) for k, c in sums.items()])
    m = [[F.col(f"m{min(i, j)}{max(i, j)}") for j in range(n)] + [F.col(f"v{i}")] for i in range(n)]
    for k in range(n):  # Gauss and Jordan; the matrix is positive definite
        m[k] = [c / m[k][k] for c in m[k]]
        for i in range(n):
            if i != k:
                m[i] = [a - m[i][k] * b for a, b in zip(m[i], m[k], strict=True)]
    b = [m[i][n] for i in range(n)]
    explained = sum((b[i] * F.col(f"v{i}") for i in range(1, n)), b[0] * F.col("v0"))
    mean = F.col("v0") * F.col("v0") / F.col("m00")
    return row.select(*[c.alias(f"b{i}") for i, c in enumerate(b)], ((explained - mean) / (F.col("yy") - mean)).alias("r2"))
