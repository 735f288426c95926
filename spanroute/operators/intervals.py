"""Sweeps over closed date intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coverage_windows(intervals: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """key, start, end, n: the longest windows that the same number of intervals covers, at least one.

    Starts add one and days after ends take one away; days on which both cancel out drop
    before the running sum, so that windows of equal count never lie side by side.
    Intervals without both dates, or that end before they start, cover nothing.
    """
    good = intervals.where(F.col(start) <= F.col(end))
    moves = good.select(F.col(key), F.col(start).alias("day"), F.lit(1).alias("delta")).union(good.select(F.col(key), F.date_add(F.col(end), 1), F.lit(-1)))
    days = moves.groupBy(key, "day").agg(F.sum("delta").alias("delta")).where("delta <> 0")
    order = Window.partitionBy(key).orderBy("day")
    run = days.select(key, F.col("day").alias("start"), F.date_sub(F.lead("day").over(order), 1).alias("end"), F.sum("delta").over(order).alias("n"))
    return run.where("n > 0")


def best_window(windows: DataFrame, key: str) -> DataFrame:
    """Of each key the window that most intervals cover, then the longest, then the first."""
    length = F.date_diff("end", "start")
    best = F.max_by(F.struct("start", "end", "n"), F.struct(F.col("n"), length, -F.unix_date("start")))
    return windows.groupBy(key).agg(best.alias("w")).select(key, "w.start", "w.end", "w.n")


def validity(intervals: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """Dated and undated intervals of each key, the span of the dated, and its best window."""
    dated = F.col(start).isNotNull() & F.col(end).isNotNull()
    counts = intervals.groupBy(key).agg(
        F.count_if(dated).alias("dated"), F.count_if(~dated).alias("undated"), F.min(F.when(dated, F.col(start))).alias("first"), F.max(F.when(dated, F.col(end))).alias("last")
    )
    best = best_window(coverage_windows(intervals, key, start, end), key).withColumnsRenamed({"start": "best_start", "end": "best_end", "n": "best_n"})
    return counts.join(best, key, "left")


def validity_counts(windows: DataFrame, built, start: str = "start", end: str = "end") -> DataFrame:
    """How many windows are valid, over, not begun, or end within 30 and 90 days of ``built``."""
    s, e = F.col(start), F.col(end)
    running = (s <= built) & (e >= built)
    return windows.agg(
        F.count_if(running).alias("valid"), F.count_if(e < built).alias("expired"), F.count_if(s > built).alias("not_started"),
        F.count_if(running & (F.date_diff(e, built) <= 30)).alias("ending_30"), F.count_if(running & (F.date_diff(e, built) <= 90)).alias("ending_90"),
    )
