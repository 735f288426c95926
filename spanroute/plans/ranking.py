"""W, P15 and A12: relevance of feeds for places."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from spanroute.operators import ranking as R
from spanroute.sinks.scratch import written

from .bindings import BUILT, Tables, query

_ACTIVE = f"""
    WITH marked AS (
        SELECT *, coalesce(date_diff('day', service_end, DATE '{BUILT}') > 30, false) AS stale,
               coalesce(date_diff('day', service_end, DATE '{BUILT}') <= 30, true) AS active FROM pairs),
    based AS (
        SELECT *, CASE WHEN bool_and(CASE WHEN active OR NOT any_active THEN departures IS NOT NULL END) OVER (PARTITION BY place_id) THEN 'departures' ELSE 'stops' END AS basis
        FROM (SELECT *, bool_or(active) OVER (PARTITION BY place_id) AS any_active FROM marked)),
    valued AS (SELECT *, CASE WHEN basis = 'departures' THEN departures ELSE stops::DOUBLE END AS value FROM based),
    homes AS (SELECT place_id AS city, country_code FROM places WHERE kind = 'city'),
    reach AS (
        SELECT p.feed_id, sum(CASE WHEN scope = 'international' OR country_code = home THEN stops END)::BIGINT AS scope_stops
        FROM pairs p JOIN feeds f ON p.feed_id = f.feed_id JOIN homes h ON p.place_id = h.city GROUP BY p.feed_id),
    shares AS (
        SELECT v.*, CASE WHEN active AND sum(CASE WHEN active THEN value END) OVER (PARTITION BY place_id) > 0
                         THEN value / sum(CASE WHEN active THEN value END) OVER (PARTITION BY place_id) ELSE 0.0 END AS share_of_place,
               CASE WHEN scope_stops > 0 THEN least(1.0, stops / scope_stops) ELSE 0.0 END AS share_of_feed
        FROM valued v LEFT JOIN reach r ON v.feed_id = r.feed_id)"""


def marked(t: Tables, pairs=None):
    pairs = written(t.pairs()) if pairs is None else pairs  # several passes go over them
    stale = R.is_stale(F.col("service_end"), F.lit(BUILT).cast("date"))
    return pairs.withColumn("stale", stale).withColumn("active", ~stale)


def reach(t: Tables, pairs):
    city = t.places().where("kind = 'city'").select("place_id", "country_code")
    joined = pairs.join(t.feeds().select("feed_id", "home", "scope"), "feed_id").join(city, "place_id")
    own = (F.col("scope") == "international") | (F.col("country_code") == F.col("home"))
    return joined.groupBy("feed_id").agg(F.sum(F.when(own, F.col("stops"))).alias("scope_stops"))


def ranked(t: Tables):
    pairs = written(t.pairs())
    return R.relevance(written(R.basis(marked(t, pairs))), reach(t, pairs))


@query("W1_relevance", _ACTIVE + """
    SELECT feed_id, place_id, basis, round(share_of_place, 6) AS share_of_place, round(share_of_feed, 6) AS share_of_feed,
           round(CASE WHEN active THEN 0.7 * share_of_place + 0.3 * share_of_feed ELSE 0.0 END, 6) AS relevance FROM shares""")
def w1(t: Tables):
    done = ranked(t)
    return done.select("feed_id", "place_id", "basis", *[F.round(c, 6).alias(c) for c in ("share_of_place", "share_of_feed", "relevance")])


@query("W2_basis", _ACTIVE + "SELECT place_id, any_value(basis) AS basis, count(*) AS n_pairs, count(departures) AS n_known FROM valued GROUP BY place_id")
def w2(t: Tables):
    done = R.basis(marked(t))
    return done.groupBy("place_id").agg(F.any_value("basis").alias("basis"), F.count("*").alias("n_pairs"), F.count("departures").alias("n_known"))


@query("W3_stale_set_aside", f"""
    WITH modes AS (SELECT feed_id, place_id, list_sort(list(DISTINCT p_type)) AS modes FROM facts JOIN part ON l_partkey = p_partkey GROUP BY ALL),
    m AS (SELECT p.feed_id, p.place_id, coalesce(modes, []) AS modes, coalesce(date_diff('day', service_end, DATE '{BUILT}') > 30, false) AS stale
          FROM pairs p LEFT JOIN modes USING (feed_id, place_id)),
    fresh AS (SELECT place_id, list_distinct(flatten(list(modes))) AS fresh_modes FROM m WHERE NOT stale GROUP BY place_id)
    SELECT m.feed_id, m.place_id, m.stale,
           NOT m.stale OR CASE WHEN len(m.modes) > 0 THEN len(list_filter(m.modes, lambda x: NOT list_contains(coalesce(fresh_modes, []), x))) > 0
                               ELSE f.place_id IS NULL END AS active
    FROM m LEFT JOIN fresh f ON m.place_id = f.place_id""")
def w3(t: Tables):
    part = t.read("part").select("p_partkey", "p_type")
    modes = t.facts().join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("feed_id", "place_id").agg(F.sort_array(F.collect_set("p_type")).alias("modes"))
    pairs = marked(t, t.pairs()).drop("active").join(modes, ["feed_id", "place_id"], "left").withColumn("modes", F.coalesce("modes", F.array().cast("array<string>")))
    return R.set_aside(written(pairs)).select("feed_id", "place_id", "stale", "active")


@query("W4_breadth", """
    WITH cities AS (SELECT DISTINCT feed_id, country_code, p.place_id FROM pairs p JOIN places l ON p.place_id = l.place_id WHERE kind = 'city'),
    total AS (SELECT country_code, count(DISTINCT place_id) AS served FROM cities GROUP BY country_code)
    SELECT feed_id, country_code, count(*) AS reached, any_value(served) AS served, round(count(*) / any_value(served), 6) AS breadth
    FROM cities JOIN total USING (country_code) GROUP BY feed_id, country_code""")
def w4(t: Tables):
    return R.breadth(t.pairs(), t.places()).select("feed_id", "country_code", "reached", "served", F.round("breadth", 6).alias("breadth"))


@query("W5_newest_row_per_feed", """
    SELECT feed_id, build, n_edges FROM (
        SELECT feed_id, build, count(*) AS n_edges, row_number() OVER (PARTITION BY feed_id ORDER BY build DESC) AS nth FROM facts GROUP BY feed_id, build) WHERE nth = 1""")
def w5(t: Tables):
    newest = Window.partitionBy("feed_id").orderBy(F.desc("build"))
    counts = t.facts().groupBy("feed_id", "build").agg(F.count("*").alias("n_edges"))
    return counts.withColumn("nth", F.row_number().over(newest)).where("nth = 1").drop("nth")


@query("W6_best_class", """
    SELECT place_id, (['primary', 'secondary', 'tertiary', 'international', 'unknown'])[min(CASE tier WHEN 'local' THEN 1 WHEN 'regional' THEN 2 WHEN 'national' THEN 3 WHEN 'international' THEN 4 ELSE 5 END)] AS best
    FROM edges GROUP BY place_id""")
def w6(t: Tables):
    return R.best_class(t.edges())


@query("W7_repeated_keys", """
    SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY user_id, event_type) > 1
        THEN user_id || '/' || event_type || '#' || row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) ELSE user_id || '/' || event_type END AS key FROM events""")
def w7(t: Tables):
    same = Window.partitionBy("user_id", "event_type")
    key = F.concat(F.col("user_id").cast("string"), F.lit("/"), "event_type")
    nth = F.concat(key, F.lit("#"), F.row_number().over(same.orderBy("event_id")))
    return t.read("events").select("event_id", F.when(F.count("*").over(same) > 1, nth).otherwise(key).alias("key"))


@query("W8_cap_per_group", "SELECT feed_id, name, home FROM (SELECT *, row_number() OVER (PARTITION BY home ORDER BY feed_id) AS nth FROM feeds) WHERE nth <= 3")
def w8(t: Tables):
    order = Window.partitionBy("home").orderBy("feed_id")
    return t.feeds().withColumn("nth", F.row_number().over(order)).where("nth <= 3").select("feed_id", "name", "home")


@query("W11_two_best_candidates", """
    SELECT place_id, max(CASE WHEN nth = 1 THEN feed_id END) AS best, max(CASE WHEN nth = 2 THEN feed_id END) AS second,
           coalesce(max(CASE WHEN nth = 2 THEN stops END) >= 0.5 * max(CASE WHEN nth = 1 THEN stops END), false) AS ambiguous
    FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY stops DESC, feed_id) AS nth FROM pairs) WHERE nth <= 2 GROUP BY place_id""")
def w11(t: Tables):
    order = Window.partitionBy("place_id").orderBy(F.desc("stops"), "feed_id")
    two = t.pairs().withColumn("nth", F.row_number().over(order)).where("nth <= 2")
    first, second = (lambda c, n: F.max(F.when(F.col("nth") == n, F.col(c)))), 2
    return two.groupBy("place_id").agg(
        first("feed_id", 1).alias("best"), first("feed_id", second).alias("second"), F.coalesce(first("stops", second) >= 0.5 * first("stops", 1), F.lit(False)).alias("ambiguous")
    )


@query("W12_change_ranking", """
    WITH old AS (SELECT DISTINCT place_id, feed_id, tier FROM facts WHERE build = 1999), new AS (SELECT DISTINCT place_id, feed_id, tier FROM facts WHERE build = 2000),
    diff AS ((SELECT * FROM old EXCEPT SELECT * FROM new) UNION ALL (SELECT * FROM new EXCEPT SELECT * FROM old))
    SELECT place_id, count(*) AS changed, rank() OVER (ORDER BY count(*) DESC, place_id)::INT AS nth FROM diff GROUP BY place_id""")
def w12(t: Tables):
    edges = t.facts().where(F.col("build").isin(1999, 2000)).groupBy("place_id", "feed_id", "tier").agg(*[F.max(F.col("build") == y).alias(n) for y, n in ((1999, "old"), (2000, "new"))])
    changed = edges.where("old <> new").groupBy("place_id").agg(F.count("*").alias("changed"))
    # One row per place: a global order over these is small beside the edges.
    return changed.withColumn("nth", F.rank().over(Window.orderBy(F.desc("changed"), "place_id")))


@query("P15_staleness", f"""
    SELECT feed_id, max(service_end) AS service_end, date_diff('day', max(service_end), DATE '{BUILT}') > 30 AS stale,
           max(service_end) - INTERVAL 2000 DAY < DATE '2000-01-01' OR max(service_end) > DATE '{BUILT}' + INTERVAL 60 MONTH AS nominal FROM pairs GROUP BY feed_id""")
def p15(t: Tables):
    built, end = F.lit(BUILT).cast("date"), F.col("service_end")
    feeds = t.pairs().groupBy("feed_id").agg(F.max("service_end").alias("service_end"))
    return feeds.select("feed_id", "service_end", R.is_stale(end, built).alias("stale"), R.is_nominal(F.date_sub(end, 2000), end, built).alias("nominal"))


@query("A12_country_shares", """
    SELECT feed_id, country_code, sum(stops)::BIGINT AS stops, round(sum(stops) / sum(sum(stops)) OVER (PARTITION BY feed_id), 6) AS share
    FROM pairs p JOIN places l ON p.place_id = l.place_id GROUP BY feed_id, country_code""")
def a12(t: Tables):
    stops = t.pairs().join(t.places().select("place_id", "country_code"), "place_id").groupBy("feed_id", "country_code").agg(F.sum("stops").alias("stops"))
    return stops.withColumn("share", F.round(F.col("stops") / F.sum("stops").over(Window.partitionBy("feed_id")), 6))
