"""T: intervals and calendars."""

from pyspark.sql import functions as F

from spanroute.operators import intervals as I
from spanroute.operators import service as S
from spanroute.sinks.scratch import written

from .bindings import BUILT, SQL, Tables, query

SQL["calendar"] = """
    SELECT 'S' || l_suppkey AS service_id, min(day) AS start, min(day) + 60 + any_value(l_suppkey)::INT % 40 AS "end",
           [(any_value(l_suppkey) + w) % 3 <> 0 FOR w IN range(7)] AS weekdays, count(DISTINCT l_orderkey) % 9 + 1 AS trips FROM facts GROUP BY l_suppkey"""
SQL["exceptions"] = """
    SELECT DISTINCT 'S' || l_suppkey AS service_id, day, l_quantity = 50 AS added FROM facts
    WHERE l_quantity IN (1, 50)"""
SQL["walked"] = """
    SELECT service_id, trips, day FROM (SELECT *, unnest(generate_series(start, "end", INTERVAL 1 DAY))::DATE AS day FROM calendar) c
    WHERE weekdays[isodow(day)] AND NOT EXISTS (FROM exceptions e WHERE e.service_id = c.service_id AND e.day = c.day AND NOT added)
    UNION SELECT e.service_id, trips, e.day FROM exceptions e JOIN calendar k ON e.service_id = k.service_id
    WHERE added AND NOT EXISTS (FROM exceptions x WHERE x.service_id = e.service_id AND x.day = e.day AND NOT x.added)"""
SQL["daily"] = """
    SELECT 'G' || (substr(service_id, 2)::INT % 10) AS feed_id, day, sum(trips)::BIGINT AS trips FROM walked GROUP BY ALL"""


def calendar(t: Tables):
    key = F.col("l_suppkey")
    one = t.facts().groupBy("l_suppkey").agg(F.min("day").alias("start"), F.max("day").alias("last"), (F.countDistinct("l_orderkey") % 9 + 1).alias("trips"))
    return one.select(
        F.concat(F.lit("S"), key).alias("service_id"), "start", F.date_add("start", (60 + key % 40).cast("int")).alias("end"), F.array(*[(key + w) % 3 != 0 for w in range(7)]).alias("weekdays"), "trips", "last"
    )


def exceptions(t: Tables):
    some = t.facts().where("l_quantity in (1, 50)")
    return some.select(F.concat(F.lit("S"), "l_suppkey").alias("service_id"), "day", (F.col("l_quantity") == 50).alias("added")).distinct()


def daily(t: Tables):
    windows = written(calendar(t))  # a row per service; all that is asked of it takes one pass over the lines
    owner = windows.select("service_id", F.concat(F.lit("G"), F.substring("service_id", 2, 20).cast("int") % 10).alias("feed_id"))
    first, last = windows.agg(F.min("start"), F.date_add(F.max("last"), 100)).first()  # no window is longer
    return S.daily_trips(windows, exceptions(t), owner, str(first), str(last))


_SWEEP = """
    WITH moves AS (SELECT feed_id, start AS day, 1 AS delta FROM intervals UNION ALL SELECT feed_id, "end" + 1, -1 FROM intervals),
    days AS (SELECT feed_id, day, sum(delta) AS delta FROM moves GROUP BY ALL HAVING sum(delta) <> 0),
    run AS (SELECT feed_id, day AS start, lead(day) OVER w - 1 AS "end", (sum(delta) OVER w)::BIGINT AS n FROM days WINDOW w AS (PARTITION BY feed_id ORDER BY day)),
    windows AS (SELECT * FROM run WHERE n > 0),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY n DESC, "end" - start DESC, start) AS nth FROM windows) WHERE nth = 1)"""


@query("T1_coverage_windows", _SWEEP + 'SELECT feed_id, start, "end", n FROM windows')
def t1(t: Tables):
    return I.coverage_windows(t.intervals(), "feed_id")


@query("T2_best_window", _SWEEP + 'SELECT feed_id, start, "end", n FROM best')
def t2(t: Tables):
    return I.best_window(I.coverage_windows(t.intervals(), "feed_id"), "feed_id")


@query("T3_validity", _SWEEP + """, c AS (SELECT feed_id, count(*) AS dated, 0::BIGINT AS undated, min(start) AS first, max("end") AS last FROM intervals GROUP BY feed_id)
    SELECT c.*, best.start AS best_start, best."end" AS best_end, best.n AS best_n FROM c LEFT JOIN best ON c.feed_id = best.feed_id""")
def t3(t: Tables):
    return I.validity(t.intervals(), "feed_id")


@query("T4_calendar_read", """
    WITH raw AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%Y%m%d') END AS a,
                        CASE WHEN l_linenumber = 4 THEN '20011399' ELSE strftime(l_shipdate + INTERVAL 5 DAY - INTERVAL (l_linenumber) DAY, '%Y%m%d') END AS b FROM lineitem),
    d AS (SELECT *, CASE WHEN regexp_full_match(a, '[0-9]{8}') THEN try_strptime(a, '%Y%m%d')::DATE END AS s, CASE WHEN regexp_full_match(b, '[0-9]{8}') THEN try_strptime(b, '%Y%m%d')::DATE END AS e FROM raw)
    SELECT l_linenumber, count(*) AS n, count(CASE WHEN s <= e THEN s END) AS good, min(CASE WHEN s <= e THEN s END) AS first, max(CASE WHEN s <= e THEN e END) AS last FROM d GROUP BY l_linenumber""")
def t4(t: Tables):
    line, n = t.read("lineitem"), F.col("l_linenumber")
    raw = line.select(
        "l_linenumber", F.when(n == 3, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise(F.date_format("l_shipdate", "yyyyMMdd")).alias("a"),
        F.when(n == 4, "20011399").otherwise(F.date_format(F.date_add("l_shipdate", 5 - n), "yyyyMMdd")).alias("b"),
    )
    done = S.read_calendar(raw, "a", "b")
    return done.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count("a").alias("good"), F.min("a").alias("first"), F.max("b").alias("last"))


@query("T5_service_span", "SELECT service_id, min(day) AS first, max(day) AS last FROM walked GROUP BY service_id")
def t5(t: Tables):
    return S.service_span(calendar(t), exceptions(t))


@query("T6_daily_trips", "SELECT feed_id, day, trips FROM daily")
def t6(t: Tables):
    return daily(t)


@query("T7_effective_exceptions", """
    WITH gone AS (SELECT service_id, day, bool_or(NOT added) AS gone FROM exceptions GROUP BY ALL)
    SELECT g.service_id, g.day, NOT gone AS added, trips FROM gone g JOIN calendar c ON g.service_id = c.service_id
    WHERE gone = (g.day BETWEEN start AND "end" AND weekdays[isodow(g.day)])""")
def t7(t: Tables):
    return S.effective_exceptions(calendar(t), exceptions(t))


@query("T8_busiest_week", """
    WITH w AS (SELECT feed_id, date_trunc('week', day)::DATE AS week, sum(trips)::BIGINT AS trips, coalesce(sum(trips) FILTER (WHERE isodow(day) < 6), 0) AS working FROM daily GROUP BY ALL)
    SELECT feed_id, week, trips, round(CASE WHEN working > 0 THEN working / 5 ELSE trips / 7 END, 6) AS per_day
    FROM (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY trips DESC, week) AS nth FROM w) WHERE nth = 1""")
def t8(t: Tables):
    return S.busiest_week(daily(t)).withColumn("per_day", F.round("per_day", 6))


@query("T9_service_end", "SELECT feed_id, max(day) AS service_end FROM (SELECT *, max(trips) OVER (PARTITION BY feed_id) AS most FROM daily) WHERE trips >= 0.2 * most GROUP BY feed_id")
def t9(t: Tables):
    return S.service_end(daily(t), 0.2)


@query("T10_validity_counts", f"""
    WITH v AS (SELECT *, start <= DATE '{BUILT}' AND "end" >= DATE '{BUILT}' AS running, date_diff('day', DATE '{BUILT}', "end") AS days FROM intervals)
    SELECT count(*) FILTER (WHERE running) AS valid, count(*) FILTER (WHERE "end" < DATE '{BUILT}') AS expired, count(*) FILTER (WHERE start > DATE '{BUILT}') AS not_started,
           count(*) FILTER (WHERE running AND days <= 30) AS ending_30, count(*) FILTER (WHERE running AND days <= 90) AS ending_90 FROM v""")
def t10(t: Tables):
    return I.validity_counts(t.intervals(), F.lit(BUILT).cast("date"))


@query("T11_long_windows", "SELECT feed_id, min(day) AS first, max(day) AS last, date_diff('day', min(day), max(day)) AS days FROM facts GROUP BY feed_id HAVING date_diff('day', min(day), max(day)) > 2400")
def t11(t: Tables):
    spans = t.facts().groupBy("feed_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return spans.withColumn("days", F.date_diff("last", "first").cast("long")).where("days > 2400")


@query("T12_monthly_budget", """
    SELECT user_id, date_trunc('month', ts)::DATE AS month, count(*) AS calls, round(sum(value), 4) AS spent, sum(value) > 60 AS over
    FROM events WHERE event_type = 'error' GROUP BY ALL""")
def t12(t: Tables):
    calls = t.read("events").where("event_type = 'error'")
    per = calls.groupBy("user_id", F.to_date(F.date_trunc("month", "ts")).alias("month")).agg(F.count("*").alias("calls"), F.sum("value").alias("spent"))
    return per.select("user_id", "month", "calls", F.round("spent", 4).alias("spent"), (F.col("spent") > 60).alias("over"))
