"""Streams of events, beyond what batch queries need: windows, sessions, repeats, and running state per user."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType, DoubleType

EVENTS = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()), StructField("props", StringType()),
])


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by type and window; what is later than ``late`` is dropped, and windows close then."""
    by = events.withWatermark("ts", late).groupBy(F.window("ts", length).alias("w"), "event_type")
    return by.agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    by = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return by.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def once(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event id once, remembered for as long as repeats may come."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def error_runs(events: DataFrame, least: int = 2) -> DataFrame:
    """user_id, length: runs of ``least`` errors or more in a user's events, across batches; the state is one number a user."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        length = state.get[0] if state.exists else 0
        out = []
        for kind in pd.concat(list(batches)).sort_values(["ts", "event_id"])["event_type"]:
            if kind == "error":
                length += 1
            else:
                if length >= least:
                    out.append(length)
                length = 0
        state.update((length,))
        yield pd.DataFrame({"user_id": [key[0]] * len(out), "length": out})

    return events.groupBy("user_id").applyInPandasWithState(run, "user_id long, length long", "length long", "append", GroupStateTimeout.NoTimeout)
