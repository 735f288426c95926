"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: the space and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Project the columns called exactly ``names``.

    Works by position, so that other columns whose names differ only in case,
    or repeat a name, never make a reference ambiguous; of repeats the first counts.
    """
    where = {n: i for i, n in reversed(list(enumerate(df.columns)))}
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{where[n]}").alias(n) for n in names])


def pick_row(df: DataFrame, *names: str) -> DataFrame:
    """As :func:`pick`, with the whole row beside them in the struct ``row`` (fields by position)."""
    where = {n: i for i, n in reversed(list(enumerate(df.columns)))}
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{where[n]}").alias(n) for n in names], F.struct(*flat.columns).alias("row"))


def unpick(df: DataFrame, columns: list[str], **changed) -> DataFrame:
    """Undo :func:`pick_row`; ``changed`` gives new values for columns of these names."""
    out, seen = [], set()
    for i, c in enumerate(columns):
        new = changed.get(c) if c not in seen else None
        seen.add(c)
        out.append((F.col(f"row._{i}") if new is None else new).alias(c))
    return df.select(*out)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of this machine only where none is set and all run on it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spanroute-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there.

    Columns whose names differ only in case, or repeat, are written by position.
    """
    spark = df.sparkSession
    path, names = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}", df.columns
    if len({n.lower() for n in names}) < len(names):
        df = df.toDF(*[f"_{i}" for i in range(len(names))])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).toDF(*names)
