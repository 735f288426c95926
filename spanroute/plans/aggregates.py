"""A and X: aggregates and set operations."""

from pyspark.sql import functions as F

from spanroute.operators import aggregates as A
from spanroute.operators.ranks import nearest_rank
from spanroute.operators import ranking as R

from .bindings import BUILT, SQL, Tables, query

SQL["edge_service"] = "SELECT DISTINCT e.feed_id, e.place_id, tier, stops, routes, departures, service_end FROM edges e JOIN pairs p ON e.feed_id = p.feed_id AND e.place_id = p.place_id"
#: Licences as three values: yes, no, unknown.
SQL["licensed"] = "SELECT d.doc_id, d.source, d.lang, d.text, CASE quality WHEN 1 THEN true WHEN 0 THEN false END AS allowed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def edge_service(t: Tables):
    return t.edges().join(t.pairs(), ["feed_id", "place_id"])


def licensed(t: Tables):
    labels = t.read("labels").select("doc_id", "quality")
    return t.read("documents").select("doc_id", "source", "lang", "text").join(labels, "doc_id", "left").withColumn("allowed", F.when(F.col("quality") == 1, True).when(F.col("quality") == 0, False))


@query("A1_count_by_key", "SELECT home, list_sort(list(scope || '=' || n)) AS counts FROM (SELECT home, scope, count(*) AS n FROM feeds GROUP BY ALL) GROUP BY home")
def a1(t: Tables):
    done = A.count_map(t.feeds(), ["home"], "scope")
    return done.select("home", F.array_sort(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))).alias("counts"))


@query("A2_conditional_counts", """
    SELECT count(*) AS n, count(*) FILTER (WHERE scope = 'domestic') AS domestic, count(*) FILTER (WHERE home = 'R0') AS at_r0,
           count(*) FILTER (WHERE scope <> 'domestic' AND home IN ('R1', 'R2')) AS abroad FROM feeds""")
def a2(t: Tables):
    home, scope = F.col("home"), F.col("scope")
    return t.feeds().agg(
        F.count("*").alias("n"), F.count_if(scope == "domestic").alias("domestic"), F.count_if(home == "R0").alias("at_r0"), F.count_if((scope != "domestic") & home.isin("R1", "R2")).alias("abroad")
    )


@query("A3_two_key_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def a3(t: Tables):
    return t.read("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("A4_independent_distributions", """
    SELECT country_code, kind, tier, count(*) AS n, round(quantile_cont(stops, 0.5), 6) AS median_stops
    FROM edge_service e JOIN places p ON e.place_id = p.place_id GROUP BY GROUPING SETS ((country_code, tier), (kind, tier))""")
def a4(t: Tables):
    rows = edge_service(t).join(t.places().select("place_id", "country_code", "kind"), "place_id")
    keys = [F.col(c) for c in ("country_code", "kind", "tier")]
    sets = [[keys[0], keys[2]], [keys[1], keys[2]]]
    return rows.groupingSets(sets, *keys).agg(F.count("*").alias("n"), F.round(F.percentile("stops", F.lit(0.5)), 6).alias("median_stops"))


@query("A5_distinct_counts", "SELECT place_id, count(DISTINCT feed_id) AS feeds, count(DISTINCT tier) AS tiers FROM edges GROUP BY place_id")
def a5(t: Tables):
    return t.edges().groupBy("place_id").agg(F.countDistinct("feed_id").alias("feeds"), F.countDistinct("tier").alias("tiers"))


@query("A6_service_of_places", f"""
    SELECT place_id, sum(stops)::BIGINT AS stops, sum(routes)::BIGINT AS routes, sum(departures) AS departures
    FROM pairs WHERE NOT coalesce(date_diff('day', service_end, DATE '{BUILT}') > 30, false) GROUP BY place_id""")
def a6(t: Tables):
    return A.service_of_places(edge_service(t), R.is_stale(F.col("service_end"), F.lit(BUILT).cast("date")))


@query("A7_median", "SELECT feed_id, median(l_quantity) AS median_quantity FROM facts GROUP BY feed_id")
def a7(t: Tables):
    return t.facts().groupBy("feed_id").agg(F.median("l_quantity").alias("median_quantity"))


@query("A8_quartiles", "SELECT tier, round(quantile_cont(stops, 0.25), 6) AS q1, round(quantile_cont(stops, 0.5), 6) AS q2, round(quantile_cont(stops, 0.75), 6) AS q3 FROM edge_service GROUP BY tier")
def a8(t: Tables):
    done = edge_service(t).groupBy("tier").agg(*A.quartiles("stops"))
    return done.select("tier", *[F.round(c, 6).alias(c) for c in ("q1", "q2", "q3")])


@query("A9_nearest_rank_p95", "SELECT user_id, list_sort(list(value))[(round_even(0.95 * (count(value) - 1), 0))::INT + 1] AS p95 FROM events GROUP BY user_id")
def a9(t: Tables):
    return nearest_rank(t.read("events"), "user_id", "value", 0.95, "p95")


@query("A10_span_reference", """
    WITH keyed AS (SELECT unnest([feed_id, '*']) AS bucket, tier, place_id, l_quantity FROM facts),
    once AS (SELECT bucket, tier, place_id, max(l_quantity) AS q FROM keyed GROUP BY ALL)
    SELECT bucket, tier, round(quantile_cont(q, 0.9), 6) AS p90, count(*) AS n FROM once GROUP BY ALL HAVING count(*) >= 60""")
def a10(t: Tables):
    done = A.span_reference(t.facts(), "feed_id", "tier", ["place_id"], "l_quantity", 60)
    return done.withColumn("p90", F.round("p90", 6))


@query("A11_home_country", """
    SELECT feed_id, country_code AS home FROM (
        SELECT feed_id, country_code, row_number() OVER (PARTITION BY feed_id ORDER BY sum(stops) DESC, country_code) AS nth
        FROM pairs p JOIN places l ON p.place_id = l.place_id GROUP BY feed_id, country_code) WHERE nth = 1""")
def a11(t: Tables):
    stops = t.pairs().join(t.places().select("place_id", "country_code"), "place_id").groupBy("feed_id", "country_code").agg(F.sum("stops").alias("n"))
    return stops.groupBy("feed_id").agg(F.min_by("country_code", F.struct(-F.col("n"), F.col("country_code"))).alias("home"))


@query("A13_weighted_confidence", """
    WITH c AS (SELECT *, CASE tier WHEN 'local' THEN 0.9 WHEN 'regional' THEN 0.75 WHEN 'national' THEN 0.75 WHEN 'international' THEN 0.95 ELSE 0.0 END AS conf FROM edge_service)
    SELECT feed_id, round(sum(stops * conf) / sum(stops), 6) AS confidence FROM c GROUP BY feed_id""")
def a13(t: Tables):
    conf = {"local": 0.9, "regional": 0.75, "national": 0.75, "international": 0.95, "unknown": 0.0}
    value = F.create_map(*[F.lit(x) for pair in conf.items() for x in pair])[F.col("tier")]
    return edge_service(t).groupBy("feed_id").agg(F.round(A.weighted_mean(value, F.col("stops")), 6).alias("confidence"))


@query("A14_sorted_sets", "SELECT feed_id, list_sort(list(DISTINCT tier)) AS tiers FROM edges GROUP BY feed_id")
def a14(t: Tables):
    return t.edges().groupBy("feed_id").agg(F.array_sort(F.collect_set("tier")).alias("tiers"))


@query("A15_rule_counts", "SELECT place_id, list_sort(list(tier || '=' || n)) AS counts FROM (SELECT place_id, tier, count(*) AS n FROM edges GROUP BY ALL) GROUP BY place_id")
def a15(t: Tables):
    done = A.count_map(t.edges(), ["place_id"], "tier")
    return done.select("place_id", F.array_sort(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))).alias("counts"))


@query("A16_spread", "SELECT feed_id, tier, min(stops) AS least, max(stops) AS most, max(stops) - min(stops) AS spread FROM edge_service GROUP BY ALL")
def a16(t: Tables):
    lo, hi = F.min("stops"), F.max("stops")
    return edge_service(t).groupBy("feed_id", "tier").agg(lo.alias("least"), hi.alias("most"), (hi - lo).alias("spread"))


@query("A18_unions_over_builds", """
    SELECT place_id, max(n) AS population, list_sort(list_distinct(flatten(list(feeds)))) AS aliases
    FROM (SELECT place_id, build, count(*) AS n, list(DISTINCT feed_id) AS feeds FROM facts GROUP BY ALL) GROUP BY place_id""")
def a18(t: Tables):
    builds = t.facts().groupBy("place_id", "build").agg(F.count("*").alias("n"), F.collect_set("feed_id").alias("feeds"))
    return builds.groupBy("place_id").agg(F.max("n").alias("population"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("feeds")))).alias("aliases"))


@query("A19_all_agree", "SELECT feed_id, count(DISTINCT tier || '|' || l_linenumber) AS values FROM facts GROUP BY feed_id HAVING count(DISTINCT tier || '|' || l_linenumber) > 1")
def a19(t: Tables):
    return A.all_agree(t.facts(), ["feed_id"], ["tier", "l_linenumber"])


@query("A20_digests")
def a20(t: Tables):
    return A.digest(t.edges(), ["feed_id"], ["place_id", "tier"])


@query("A21_shares_of_table", """
    SELECT round(avg((tier = 'unknown')::INT), 6) AS unknown_share, round(avg((stops < 5)::INT), 6) AS margin_share,
           round(abs(avg((tier = 'unknown')::INT) - 0.2), 6) AS drift FROM edge_service""")
def a21(t: Tables):
    unknown = F.avg((F.col("tier") == "unknown").cast("int"))
    return edge_service(t).agg(F.round(unknown, 6).alias("unknown_share"), F.round(F.avg((F.col("stops") < 5).cast("int")), 6).alias("margin_share"), F.round(F.abs(unknown - 0.2), 6).alias("drift"))


@query("A22_license_inventory", """
    SELECT allowed, source, sum(n)::BIGINT AS rows, list_sort(list(lang || '=' || n)) AS langs
    FROM (SELECT allowed, source, lang, count(*) AS n FROM licensed GROUP BY ALL) GROUP BY allowed, source""")
def a22(t: Tables):
    one = licensed(t).groupBy("allowed", "source", "lang").agg(F.count("*").alias("n"))
    return one.groupBy("allowed", "source").agg(F.sum("n").alias("rows"), F.array_sort(F.collect_list(F.concat("lang", F.lit("="), F.col("n").cast("string")))).alias("langs"))


@query("A23_roll_up", """
    WITH once AS (SELECT DISTINCT l_orderkey, feed_id, build FROM facts)
    SELECT build, count(*) AS rows, count(DISTINCT feed_id) AS feeds, (SELECT count(*) FROM (SELECT l_orderkey FROM once GROUP BY l_orderkey HAVING count(DISTINCT build) > 1)) AS overlaps
    FROM once GROUP BY build""")
def a23(t: Tables):
    once = t.facts().select("l_orderkey", "feed_id", "build").distinct()
    overlaps = once.groupBy("l_orderkey").agg(F.countDistinct("build").alias("b")).where("b > 1").agg(F.count("*")).scalar()
    return once.groupBy("build").agg(F.count("*").alias("rows"), F.countDistinct("feed_id").alias("feeds")).withColumn("overlaps", overlaps)


@query("A24_service_level", "SELECT feed_id, place_id, stops, routes, departures FROM pairs")
def a24(t: Tables):
    return t.pairs().select("feed_id", "place_id", "stops", "routes", "departures")


@query("A25_weighted_events", """
    WITH w AS (SELECT l_orderkey, l_partkey, l_suppkey, min(l_quantity) AS q FROM facts GROUP BY ALL), k AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS members FROM w)
    SELECT l_suppkey AS route, count(*) AS events, round(sum(q / members), 4) AS weight FROM k GROUP BY l_suppkey""")
def a25(t: Tables):
    from pyspark.sql import Window

    # An event counts once for each trip and stop; what a group shares is split among its members.
    once = t.facts().groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.min("l_quantity").alias("q"))
    once = once.withColumn("members", F.count("*").over(Window.partitionBy("l_orderkey")))
    return once.groupBy(F.col("l_suppkey").alias("route")).agg(F.count("*").alias("events"), F.round(F.sum(F.col("q") / F.col("members")), 4).alias("weight"))


@query("A26_stop_artefacts", """
    WITH s AS (SELECT l_partkey, count(DISTINCT country_code) AS n FROM facts f JOIN places p ON f.place_id = p.place_id GROUP BY l_partkey)
    SELECT count(*) AS stops, count(*) FILTER (WHERE n > 1) AS in_several, count(*) FILTER (WHERE n = 1) AS in_one FROM s""")
def a26(t: Tables):
    stops = t.facts().join(t.places().select("place_id", "country_code"), "place_id").groupBy("l_partkey").agg(F.countDistinct("country_code").alias("n"))
    return stops.agg(F.count("*").alias("stops"), F.count_if(F.col("n") > 1).alias("in_several"), F.count_if(F.col("n") == 1).alias("in_one"))


@query("A27_least_squares", """
    WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b1, regr_intercept(l_extendedprice, l_quantity) AS b0, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem)
    SELECT round(b0, 3) AS b0, round(b1, 3) AS b1, round(r2, 6) AS r2 FROM s""")
def a27(t: Tables):
    fit = A.least_squares(t.read("lineitem"), "l_extendedprice", ["l_quantity"])
    return fit.select(F.round("b0", 3).alias("b0"), F.round("b1", 3).alias("b1"), F.round("r2", 6).alias("r2"))


@query("X1_union_with_promotion", "SELECT feed_id AS id, name, home, NULL::VARCHAR AS kind FROM feeds UNION ALL SELECT place_id, name, NULL, kind FROM places")
def x1(t: Tables):
    feeds, places = t.feeds().select(F.col("feed_id").alias("id"), "name", "home"), t.places().select(F.col("place_id").alias("id"), "name", "kind")
    return feeds.unionByName(places, allowMissingColumns=True)


@query("X2_snapshot_diff", """
    WITH old AS (SELECT DISTINCT feed_id, place_id, tier FROM facts WHERE build = 1999), new AS (SELECT DISTINCT feed_id, place_id, tier FROM facts WHERE build = 2000)
    SELECT place_id, count(*) FILTER (WHERE side = 1) AS added, count(*) FILTER (WHERE side = 0) AS removed
    FROM ((SELECT *, 0 AS side FROM (FROM old EXCEPT FROM new)) UNION ALL (SELECT *, 1 FROM (FROM new EXCEPT FROM old))) GROUP BY place_id""")
def x2(t: Tables):
    facts = t.facts()
    old, new = (facts.where(F.col("build") == y).select("feed_id", "place_id", "tier").distinct().withColumn(n, F.lit(1)) for y, n in ((1999, "o"), (2000, "n")))
    # One shuffle of either side tells what both differences hold.
    both = old.join(new, ["feed_id", "place_id", "tier"], "full").where("o is null or n is null")
    return both.groupBy("place_id").agg(F.count("n").alias("added"), F.count("o").alias("removed"))


@query("X3_membership_tests", """
    WITH g AS (SELECT feed_id, list_sort(list(DISTINCT tier)) AS got, CASE WHEN feed_id LIKE '%1' THEN ['local', 'national'] ELSE ['local', 'regional', 'national', 'international', 'unknown'] END AS want FROM edges GROUP BY feed_id)
    SELECT feed_id, len(list_filter(want, lambda x: NOT list_contains(got, x)))::BIGINT AS missing, len(list_filter(got, lambda x: NOT list_contains(want, x)))::BIGINT AS extra, got = list_sort(want) AS exact FROM g""")
def x3(t: Tables):
    tiers = t.edges().groupBy("feed_id").agg(F.array_sort(F.collect_set("tier")).alias("got"))
    five = [F.lit(x) for x in ("local", "regional", "national", "international", "unknown")]
    want = F.when(F.col("feed_id").endswith("1"), F.array(five[0], five[2])).otherwise(F.array(*five))
    return tiers.select(
        "feed_id", F.size(F.array_except(want, "got")).cast("long").alias("missing"), F.size(F.array_except("got", want)).cast("long").alias("extra"), (F.col("got") == F.array_sort(want)).alias("exact")
    )


@query("X4_token_sets", """
    WITH d AS (SELECT DISTINCT list_sort(list_distinct(string_split(p_name, ' '))) AS tokens, split_part(p_name, ' ', 1) AS first FROM part)
    SELECT array_to_string(list_sort(a.tokens), ' ') AS x, array_to_string(list_sort(b.tokens), ' ') AS y, count(*) AS n, round(any_value(len(list_intersect(a.tokens, b.tokens)) / len(list_distinct(list_concat(a.tokens, b.tokens)))), 6) AS jaccard
    FROM d a JOIN d b ON a.first = b.first GROUP BY ALL""")
def x4(t: Tables):
    names = t.read("part").select(F.array_sort(F.array_distinct(F.split("p_name", " "))).alias("tokens"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first")).distinct()
    pairs = names.select("first", F.col("tokens").alias("a")).join(names.select("first", F.col("tokens").alias("b")), "first")
    jaccard = F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))
    pairs = pairs.select(F.array_join(F.array_sort("a"), " ").alias("x"), F.array_join(F.array_sort("b"), " ").alias("y"), jaccard.alias("j"))
    return pairs.groupBy("x", "y").agg(F.count("*").alias("n"), F.round(F.any_value("j"), 6).alias("jaccard"))


@query("X5_provenance_union", "SELECT place_id, list_sort(list(DISTINCT build)) AS builds FROM facts GROUP BY place_id")
def x5(t: Tables):
    lists = t.facts().groupBy("place_id", "feed_id").agg(F.collect_set("build").alias("b"))
    return lists.groupBy("place_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("b")))).alias("builds"))


@query("X6_intersection_of_all", """
    WITH n AS (SELECT feed_id, count(DISTINCT l_linenumber) AS n FROM facts GROUP BY feed_id)
    SELECT f.feed_id, f.place_id FROM facts f JOIN n ON f.feed_id = n.feed_id GROUP BY ALL HAVING count(DISTINCT l_linenumber) = any_value(n)""")
def x6(t: Tables):
    # A place holds every member if it meets as many as there are: no list is intersected.
    facts = t.facts()
    total = facts.groupBy("feed_id").agg(F.countDistinct("l_linenumber").alias("n"))
    held = facts.groupBy("feed_id", "place_id").agg(F.countDistinct("l_linenumber").alias("held"))
    return held.join(total, "feed_id").where("held = n").select("feed_id", "place_id")
