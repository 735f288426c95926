"""Streams give what batches give."""

import pytest
from pyspark.sql import functions as F

from spanroute.streaming import events as E


@pytest.fixture
def folder(spark, sf_small, tmp_path):
    rows = spark.read.parquet(f"{sf_small}/events.parquet")
    for n in range(3):
        rows.where(F.col("event_id") % 3 == n).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def drained(stream, name, spark, tmp_path, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_windows(spark, folder, tmp_path):
    got = drained(E.windowed_counts(E.read_events(spark, folder), "1 day", "60 days"), "w", spark, tmp_path, "update")
    total = got.groupBy("start", "event_type").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
    assert total == spark.read.parquet(folder).count()


def test_once(spark, folder, tmp_path):
    spark.read.parquet(folder).limit(100).write.mode("append").parquet(folder)
    got = drained(E.once(E.read_events(spark, folder, 1), "90 days"), "o", spark, tmp_path)
    assert got.count() == spark.read.parquet(folder).select("event_id").distinct().count()


def test_error_runs(spark, folder, tmp_path):
    got = drained(E.error_runs(E.read_events(spark, folder, 100)), "r", spark, tmp_path)
    want = []
    for _, rows in spark.read.parquet(folder).toPandas().sort_values(["ts", "event_id"]).groupby("user_id"):
        n = 0
        for kind in rows["event_type"]:
            if kind != "error" and n >= 2:
                want.append(n)
            n = n + 1 if kind == "error" else 0
    assert sorted(r.length for r in got.collect()) == sorted(want)
