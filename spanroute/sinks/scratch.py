"""A folder that driver and executors share, for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spanroute-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    path = fresh_path(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
