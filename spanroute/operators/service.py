"""Service calendars: weekday windows with added and removed days.

A calendar has service_id, start, end, weekdays (seven booleans, Monday first) and trips; exceptions
have service_id, day, added (true or false). Days are never walked over a whole window,
which may be open-ended: windows are kept as runs of weeks for each weekday.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONDAY = "1970-01-05"


def week(day: Column) -> Column:
    """Weeks since the first Monday of the epoch."""
    return F.floor(F.date_diff(day, F.lit(MONDAY).cast("date")) / 7).cast("long")


def day_of(week_: Column, weekday: Column) -> Column:
    return F.date_add(F.lit(MONDAY).cast("date"), (week_ * 7 + weekday).cast("int"))


def read_calendar(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Dates from text as eight digits; windows without both, or ending before they start, have null dates."""

    def date(c: str) -> Column:
        return F.when(F.col(c).rlike("^[0-9]{8}$"), F.try_to_timestamp(F.col(c), F.lit("yyyyMMdd")).cast("date"))

    dated = rows.withColumns({start: date(start), end: date(end)})
    good = F.col(start) <= F.col(end)
    return dated.withColumns({start: F.when(good, F.col(start)), end: F.when(good, F.col(end))})


def runs(calendar: DataFrame) -> DataFrame:
    """service_id, trips, weekday, first, last: the weeks of each weekday on which a window runs."""
    days = calendar.select("service_id", "trips", "start", "end", F.posexplode("weekdays").alias("weekday", "on")).where("`on`")
    first, last = week(F.col("start")), week(F.col("end"))
    on = F.col("weekday")
    days = days.select(
        "service_id", "trips", "weekday",
        F.when(on < F.weekday("start"), first + 1).otherwise(first).alias("first"), F.when(on > F.weekday("end"), last - 1).otherwise(last).alias("last"),
    )
    return days.where("first <= last")


def effective_exceptions(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Exceptions that change something: an added day outside its running window and not removed, a removed one inside."""
    on = F.col("start").isNotNull() & F.col("day").between(F.col("start"), F.col("end")) & F.get("weekdays", F.weekday("day"))
    day = exceptions.groupBy("service_id", "day").agg(F.max((~F.col("added")).cast("int")).alias("gone"))
    met = day.join(calendar, "service_id").withColumn("inside", F.coalesce(on, F.lit(False)))
    return met.where(F.when(F.col("gone") == 1, F.col("inside")).otherwise(~F.col("inside"))).select("service_id", "day", (F.col("gone") == 0).alias("added"), "trips")


def daily_trips(calendar: DataFrame, exceptions: DataFrame, owner: DataFrame, first: str, last: str) -> DataFrame:
    """feed_id, day, trips on the days from ``first`` to ``last``; ``owner`` maps services to feeds.

    Runs of weeks become changes, whose running sum per weekday gives segments of constant
    trips; only these are spread over the days asked for, and exceptions are added.
    """
    spans = runs(calendar).join(owner, "service_id")
    change = spans.select("feed_id", "weekday", F.col("first").alias("week"), F.col("trips").alias("delta")).union(spans.select("feed_id", "weekday", F.col("last") + 1, -F.col("trips")))
    change = change.groupBy("feed_id", "weekday", "week").agg(F.sum("delta").alias("delta")).where("delta <> 0")
    order = Window.partitionBy("feed_id", "weekday").orderBy("week")
    segment = change.select("feed_id", "weekday", "week", (F.lead("week").over(order) - 1).alias("until"), F.sum("delta").over(order).alias("trips")).where("trips > 0")
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    from_, to = F.greatest("week", week(lo)), F.least("until", week(hi))
    weeks = segment.where(from_ <= to).select("feed_id", "weekday", "trips", F.explode(F.sequence(from_, to)).alias("week"))
    days = weeks.select("feed_id", day_of(F.col("week"), F.col("weekday")).alias("day"), "trips")
    moved = effective_exceptions(calendar, exceptions).join(owner, "service_id").select("feed_id", "day", F.when(F.col("added"), F.col("trips")).otherwise(-F.col("trips")).alias("trips"))
    both = days.union(moved).where(F.col("day").between(lo, hi))
    return both.groupBy("feed_id", "day").agg(F.sum("trips").alias("trips")).where("trips > 0")


def service_span(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """service_id, first, last day on which a service really runs.

    From either end of a window only so many weeks are looked at as there are removed days,
    and one more: one of them must have a running day, if any has.
    """
    gone = exceptions.where("not added").groupBy("service_id").agg(F.collect_set("day").alias("gone"))
    dated = calendar.where("start is not null").join(gone, "service_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<date>")))
    reach = 7 * (F.size("gone") + 1) - 1
    near = F.array_distinct(F.concat(F.sequence("start", F.least(F.col("end"), F.date_add("start", reach))), F.sequence(F.greatest(F.col("start"), F.date_sub("end", reach)), F.col("end"))))
    on = F.filter(near, lambda d: F.get("weekdays", F.weekday(d)) & ~F.array_contains("gone", d))
    edges = dated.select("service_id", F.explode(F.array(F.array_min(on), F.array_max(on))).alias("day")).where("day is not null")
    added = exceptions.where("added").join(exceptions.where("not added"), ["service_id", "day"], "left_anti").select("service_id", "day")
    return edges.union(added).groupBy("service_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))


def busiest_week(daily: DataFrame) -> DataFrame:
    """feed_id, week, trips, per_day: the Monday of the week of most trips, the first of equals.

    per_day averages over its five weekdays, or over all seven days if these have no trips.
    """
    weeks = daily.groupBy("feed_id", F.to_date(F.date_trunc("week", "day")).alias("week")).agg(
        F.sum("trips").alias("trips"), F.sum(F.when(F.weekday("day") < 5, F.col("trips")).otherwise(0)).alias("working")
    )
    best = weeks.groupBy("feed_id").agg(F.max_by(F.struct("week", "trips", "working"), F.struct("trips", -F.unix_date("week"))).alias("w"))
    per_day = F.when(F.col("w.working") > 0, F.col("w.working") / 5).otherwise(F.col("w.trips") / 7)
    return best.select("feed_id", "w.week", "w.trips", per_day.alias("per_day"))


def service_end(daily: DataFrame, share: float = 0.01) -> DataFrame:
    """The last day with at least ``share`` of the trips of a feed's busiest day."""
    most = F.max("trips").over(Window.partitionBy("feed_id"))
    return daily.withColumn("most", most).where(F.col("trips") >= share * F.col("most")).groupBy("feed_id").agg(F.max("day").alias("service_end"))
