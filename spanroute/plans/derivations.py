"""E and F13-F17: derivations composed of the other operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanroute.functions import text as T
from spanroute.operators import aggregates as G
from spanroute.operators import hierarchy as H
from spanroute.operators import notices as N
from spanroute.operators import ranking as R
from spanroute.operators import spatial as S

from .aggregates import edge_service
from .bindings import BUILT, SQL, Tables, query
from .matching import coordinates, geohash_sql
from .space import areas, overlapping
from .structure import membership


@query("F13_map_merge", """
    SELECT p_partkey, 'b' || p_size AS en, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS de, list_sort(list_filter(['x', p_brand, p_name], lambda v: v <> p_name)) AS aliases FROM part""")
def f13(t: Tables):
    k = F.col("p_partkey")
    one = F.map_from_arrays(F.array(F.lit("en"), F.lit("de")), F.array("p_type", "p_name"))
    one = F.when(k % 2 == 0, one).otherwise(F.map_filter(one, lambda key, _: key == "en"))
    two = F.map_from_arrays(F.array(F.lit("en")), F.array(F.concat(F.lit("b"), F.col("p_size").cast("string"))))
    merged = F.map_concat(F.map_filter(one, lambda key, _: ~F.array_contains(F.map_keys(two), key)), two)
    aliases = F.array_sort(F.array_except(F.array(F.lit("x"), "p_brand", "p_name"), F.array("p_name")))
    return t.read("part").select("p_partkey", merged["en"].alias("en"), F.try_element_at(merged, F.lit("de")).alias("de"), aliases.alias("aliases"))


@query("F15_entity_ids", r"SELECT page_id, nullif(regexp_extract(url, '/(\d+)', 1), '') AS relation, regexp_full_match('Q' || page_id, 'Q[1-9][0-9]*') AS good FROM pages")
def f15(t: Tables):
    return t.read("pages").select("page_id", F.nullif(F.regexp_extract("url", r"/(\d+)", 1), F.lit("")).alias("relation"), F.concat(F.lit("Q"), F.col("page_id").cast("string")).rlike("^Q[1-9][0-9]*$").alias("good"))


@query("F16_id_cascade", """
    WITH c AS (SELECT l_orderkey, count(DISTINCT l_suppkey % 3) AS n, min('Q' || l_suppkey % 3) AS q FROM lineitem GROUP BY ALL)
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'own' WHEN n = 1 THEN q WHEN n > 1 THEN 'conflict' END AS qid FROM orders LEFT JOIN c ON o_orderkey = l_orderkey""")
def f16(t: Tables):
    q = F.concat(F.lit("Q"), (F.col("l_suppkey") % 3).cast("string"))
    said = t.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.countDistinct(q).alias("n"), F.min(q).alias("q"))
    own = F.when(F.col("o_orderkey") % 4 == 0, "own").when(F.col("n") == 1, F.col("q")).when(F.col("n") > 1, "conflict")
    return t.read("orders").select("o_orderkey").join(said, "o_orderkey", "left").select("o_orderkey", own.alias("qid"))


@query("F17_country_codes", "SELECT c_custkey, upper(left(n_name, 3)) AS code FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20")
def f17(t: Tables):
    codes = t.read("nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), F.upper(F.left("n_name", F.lit(3))).alias("code"))
    return t.read("customer").select("c_custkey", "c_nationkey").join(codes, "c_nationkey", "left").select("c_custkey", "code")


@query("A17_containment_counts", "SELECT a.feed_id AS a, b.feed_id AS b, count(*) AS shared, any_value(x.n) AS own, any_value(y.n) AS other FROM lines a JOIN lines b ON a.line = b.line AND a.feed_id <> b.feed_id JOIN (SELECT feed_id, count(*) AS n FROM lines GROUP BY 1) x ON x.feed_id = a.feed_id JOIN (SELECT feed_id, count(*) AS n FROM lines GROUP BY 1) y ON y.feed_id = b.feed_id GROUP BY ALL")
def a17(t: Tables):
    from spanroute.operators.overlap import shared_counts

    from .structure import lines

    return shared_counts(lines(t), "feed_id", "line")


@query("E1_measured_edges", """
    WITH h AS (SELECT c.label AS feed, vec_id, place_id FROM coordinates c JOIN areas ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax), n AS (SELECT label AS feed, count(*) AS n FROM coordinates GROUP BY label)
    SELECT feed, place_id, count(DISTINCT vec_id) AS stops, round(count(DISTINCT vec_id) / any_value(n), 6) AS share FROM h JOIN n USING (feed) GROUP BY feed, place_id""")
def e1(t: Tables):
    points = coordinates(t).withColumnRenamed("label", "feed")
    total = points.groupBy("feed").agg(F.count("*").alias("n"))
    held = S.points_in_boxes(points, areas(t)).groupBy("feed", "place_id").agg(F.countDistinct("vec_id").alias("stops"))
    return held.join(total, "feed").select("feed", "place_id", "stops", F.round(F.col("stops") / F.col("n"), 6).alias("share"))


@query("E3_division_to_place", "SELECT c_custkey, coalesce(a.place_id, 'QID-' || b.n_name) AS place_id FROM customer LEFT JOIN places a ON a.place_id = 'C' || c_nationkey || '-' || c_mktsegment AND c_custkey % 3 > 0 LEFT JOIN nation b ON n_nationkey = c_nationkey")
def e3(t: Tables):
    rows = t.read("customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("C"), "c_nationkey", F.lit("-"), "c_mktsegment")).alias("division"))
    by_id = t.places().select(F.col("place_id").alias("division"), "place_id")
    by_qid = t.read("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("QID-"), "n_name").alias("by_qid"))
    return rows.join(by_id, "division", "left").join(by_qid, "c_nationkey", "left").select("c_custkey", F.coalesce("place_id", "by_qid").alias("place_id"))


@query("E5_id_locations", f"SELECT vec_id, 'f-' || left(hash, 4) || '~fr' AS id, floor((lon + 180) / 0.3515625) * 0.3515625 - 180 AS xmin, CASE WHEN label % 2 = 0 THEN 'FR' END AS country FROM ({geohash_sql(4)})")
def e5(t: Tables):
    rows = coordinates(t).select("vec_id", "label", T.geohash(F.col("lat"), F.col("lon"), 4).alias("hash"))
    rows = rows.withColumn("id", F.concat(F.lit("f-"), "hash", F.lit("~fr")))
    token = F.upper(F.element_at(F.split("id", "~"), -1))
    return rows.select("vec_id", "id", T.geohash_box(F.regexp_extract("id", "^f-([0-9b-hjkmnp-z]+)~", 1))["xmin"].alias("xmin"), F.when(F.col("label") % 2 == 0, token).alias("country"))


@query("E6_declared_countries", "SELECT feed_id FROM feeds WHERE home IN (SELECT country_code FROM places WHERE place_id = 'N6' OR place_id = 'N12')")
def e6(t: Tables):
    some = t.places().where("place_id in ('N6', 'N12')").select(F.col("country_code").alias("home"))
    return t.feeds().join(some, "home", "left_semi").select("feed_id")


@query("E7_finest_location", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN n_name END, r_name) AS location FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey")
def e7(t: Tables):
    rows = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("c_custkey")
    return rows.select("c_custkey", F.coalesce(F.when(k % 3 == 0, F.col("c_mktsegment")), F.when(k % 2 == 0, F.col("n_name")), F.col("r_name")).alias("location"))


@query("E8_operator_names", "SELECT l_suppkey, list_sort(list(DISTINCT p_name)) AS names FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey")
def e8(t: Tables):
    named = t.read("part").select("p_partkey", "p_name")
    return t.read("lineitem").join(named, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey").agg(F.array_sort(F.collect_set("p_name")).alias("names"))


@query("E9_seeded_centres", """
    WITH p AS (SELECT label, round(avg(lon)) AS x, round(avg(lat)) AS y, count(*) AS pop FROM coordinates GROUP BY label HAVING count(*) > 48), m AS (SELECT p.label, arg_max(place_id, a.label) AS place_id FROM p JOIN areas a ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax AND a.label % 3 = 0 GROUP BY p.label)
    SELECT p.label, pop, coalesce(place_id, 'own-' || p.label) AS place_id, m.place_id IS NULL AS own FROM p LEFT JOIN m ON p.label = m.label""")
def e9(t: Tables):
    centres = coordinates(t).groupBy(F.col("label").alias("centre")).agg(F.round(F.avg("lon")).alias("lon"), F.round(F.avg("lat")).alias("lat"), F.count("*").alias("pop")).where("pop > 48")
    met = S.points_in_boxes(centres, areas(t).where("label % 3 = 0")).groupBy("centre").agg(F.max_by("place_id", "label").alias("place_id"))
    own = F.concat(F.lit("own-"), F.col("centre").cast("string"))
    return centres.join(met, "centre", "left").select(F.col("centre").alias("label"), "pop", F.coalesce("place_id", own).alias("place_id"), F.col("place_id").isNull().alias("own"))


@query("E10_emitted_ancestors", "SELECT ancestor_id AS place_id, max(CASE depth WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END) AS precedence, count(DISTINCT place_id) AS below FROM closed WHERE place_id IN (SELECT place_id FROM wanted) GROUP BY ancestor_id")
def e10(t: Tables):
    from .structure import wanted

    up = H.closure(t.places()).join(wanted(t), "place_id", "left_semi")
    return up.groupBy(F.col("ancestor_id").alias("place_id")).agg(F.max(F.when(F.col("depth") == 0, 3).when(F.col("depth") == 1, 2).otherwise(1)).alias("precedence"), F.countDistinct("place_id").alias("below"))


@query("E11_council_cities", "SELECT place_id FROM places p WHERE kind = 'region' AND EXISTS (SELECT 1 FROM places c WHERE c.parent_id = p.place_id AND c.name LIKE 'AUTO%' AND c.country_code IN ('R1', 'R2'))")
def e11(t: Tables):
    below = t.places().where("name like 'AUTO%' and country_code in ('R1', 'R2')").select(F.col("parent_id").alias("place_id"))
    return t.places().where("kind = 'region'").join(below, "place_id", "left_semi").select("place_id")


@query("E12_identification_pass", """
    WITH o AS (SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) AS n, min(p_partkey) OVER (PARTITION BY p_name) AS one, count(DISTINCT p_type) OVER (PARTITION BY p_name) AS kinds FROM part)
    SELECT p_partkey, CASE WHEN n = 1 THEN 'id' WHEN kinds > 5 THEN 'conflict' WHEN p_partkey = one THEN 'kept' ELSE 'merged' END AS outcome FROM o""")
def e12(t: Tables):
    groups = t.read("part").groupBy("p_name").agg(F.count("*").alias("n"), F.min("p_partkey").alias("one"), F.countDistinct("p_type").alias("kinds"))
    outcome = F.when(F.col("n") == 1, "id").when(F.col("kinds") > 5, "conflict").when(F.col("p_partkey") == F.col("one"), "kept").otherwise("merged")
    return t.read("part").select("p_partkey", "p_name").join(groups, "p_name").select("p_partkey", outcome.alias("outcome"))


@query("E14_membership_status", """
    WITH o AS (SELECT a.place_id AS id, b.place_id AS o, (least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) / ((a.xmax - a.xmin) * (a.ymax - a.ymin)) AS s
               FROM areas a JOIN areas b ON a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax WHERE a.label % 2 = 0 AND b.label % 2 = 1), n AS (SELECT id, count(*) FILTER (WHERE s >= 0.8) AS k, max(s) AS m FROM o GROUP BY id)
    SELECT place_id, CASE WHEN m IS NULL THEN 'unplaceable' WHEN k = 1 THEN 'assigned' WHEN k > 1 THEN 'ambiguous' ELSE 'unassigned' END AS status FROM areas LEFT JOIN n ON place_id = id WHERE label % 2 = 0""")
def e14(t: Tables):
    share = F.col("shared") / F.col("own")
    n = overlapping(t).groupBy(F.col("left_id").alias("place_id")).agg(F.count_if(share >= 0.8).alias("k"))
    status = F.when(F.col("k").isNull(), "unplaceable").when(F.col("k") == 1, "assigned").when(F.col("k") > 1, "ambiguous").otherwise("unassigned")
    return areas(t).where("label % 2 = 0").select("place_id").join(n, "place_id", "left").select("place_id", status.alias("status"))


@query("E15_metro_publication", """
    SELECT metro_id, count(*) AS members, arg_max(m.place_id, (n, m.place_id)) AS named_after FROM membership m JOIN (SELECT place_id, count(*) AS n FROM edges GROUP BY place_id) e ON e.place_id = m.place_id GROUP BY metro_id""")
def e15(t: Tables):
    n = t.edges().groupBy("place_id").agg(F.count("*").alias("n"))
    return membership(t).join(n, "place_id").groupBy("metro_id").agg(F.count("*").alias("members"), F.max_by("place_id", F.struct("n", "place_id")).alias("named_after"))


@query("E16_urban_centre_region", "SELECT c_nationkey, c_mktsegment, arg_min(c_custkey, (-floor(c_acctbal / 1000), c_custkey)) AS centre FROM customer GROUP BY ALL")
def e16(t: Tables):
    order = F.struct(-F.floor(F.col("c_acctbal") / 1000), F.col("c_custkey"))
    return t.read("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.min_by("c_custkey", order).alias("centre"))


@query("E19_classification_modes", """
    WITH m AS (SELECT feed_id, CASE substr(feed_id, 2)::INT % 5 WHEN 0 THEN 'complete' WHEN 1 THEN 'whole_feed' WHEN 2 THEN 'no_evidence' WHEN 3 THEN 'no_service' ELSE 'declared' END AS mode FROM feeds)
    SELECT DISTINCT m.feed_id, m.mode, place_id, CASE WHEN mode = 'complete' THEN tier WHEN mode = 'whole_feed' THEN 'regional' ELSE 'unknown' END AS tier FROM m LEFT JOIN edges e ON m.feed_id = e.feed_id AND mode <> 'no_service'""")
def e19(t: Tables):
    k = F.substring("feed_id", 2, 20).cast("int") % 5
    mode = F.when(k == 0, "complete").when(k == 1, "whole_feed").when(k == 2, "no_evidence").when(k == 3, "no_service").otherwise("declared")
    feeds = t.feeds().select("feed_id", mode.alias("mode"))
    edges = t.edges().join(feeds.where("mode <> 'no_service'").select("feed_id"), "feed_id", "left_semi")
    tier = F.when(F.col("mode") == "complete", F.col("tier")).when(F.col("mode") == "whole_feed", "regional").otherwise("unknown")
    return feeds.join(edges, "feed_id", "left").select("feed_id", "mode", "place_id", tier.alias("tier")).distinct()


@query("E21_remeasured_overlap", "SELECT feed_id AS a, place_id, max(stops / routes) AS share, list_sort(list(DISTINCT tier)) AS compared FROM edge_service GROUP BY ALL")
def e21(t: Tables):
    return edge_service(t).groupBy(F.col("feed_id").alias("a"), "place_id").agg(F.max(F.col("stops") / F.col("routes")).alias("share"), F.array_sort(F.collect_set("tier")).alias("compared"))


@query("E23_homes_after_merge", """
    WITH s AS (SELECT e.feed_id, country_code, count(*) AS n FROM build_edges e JOIN won w ON e.feed_id = w.feed_id AND e.build_id = w.build_id JOIN places p ON e.place_id = p.place_id GROUP BY ALL),
    h AS (SELECT feed_id, arg_min(country_code, (-n, country_code)) AS home FROM s GROUP BY feed_id)
    SELECT s.feed_id, s.country_code, home, country_code <> home AS cross_border FROM s JOIN h USING (feed_id)""")
def e23(t: Tables):
    from spanroute.operators.merge import merge_edges

    from .snapshots import build_edges, won

    kept = merge_edges(build_edges(t), won(t)).join(t.places().select("place_id", "country_code"), "place_id")
    n = kept.groupBy("feed_id", "country_code").agg(F.count("*").alias("n"))
    home = n.groupBy("feed_id").agg(F.min_by("country_code", F.struct(-F.col("n"), F.col("country_code"))).alias("home"))
    return n.join(home, "feed_id").select("feed_id", "country_code", "home", (F.col("country_code") != F.col("home")).alias("cross_border"))


@query("E26_latest_stage", """
    WITH s AS (SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, event_type) AS nth FROM s WHERE ts >= TIMESTAMP '2024-01-20')
    SELECT user_id, event_type AS stage FROM r WHERE nth = 1""")
def e26(t: Tables):
    stages = t.read("events").groupBy("user_id", "event_type").agg(F.max("ts").alias("ts")).where("ts >= timestamp'2024-01-20'")
    kind = F.col("event_type")
    rank = F.when(kind == "purchase", 0).when(kind == "signup", 1).when(kind == "click", 2).otherwise(3)
    return stages.groupBy("user_id").agg(F.min_by("event_type", F.struct(rank, kind)).alias("stage"))


@query("E30_sample_cut", """
    WITH c AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS nth FROM customer WHERE c_nationkey IN (1, 2, 3) AND c_mktsegment <> 'MACHINERY') SELECT c_custkey, c_nationkey FROM c WHERE nth <= 10""")
def e30(t: Tables):
    some = t.read("customer").where(F.col("c_nationkey").isin(1, 2, 3) & (F.col("c_mktsegment") != "MACHINERY"))
    nth = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    return some.withColumn("nth", nth).where("nth <= 10").select("c_custkey", "c_nationkey")


@query("R1_reuse_by_digest", "SELECT doc_id FROM documents WHERE source = 'src0' AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source <> 'src0')")
def r1(t: Tables):
    docs = t.read("documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return docs.where("source = 'src0'").join(docs.where("source <> 'src0'").select("digest"), "digest", "left_anti").select("doc_id")


@query("R2_request_queue", "SELECT user_id, count(*) AS open FROM events WHERE event_type = 'error' AND event_id NOT IN (SELECT event_id FROM events WHERE value < 20) GROUP BY user_id")
def r2(t: Tables):
    events = t.read("events")
    done = events.where("value < 20").select("event_id")
    return events.where("event_type = 'error'").join(done, "event_id", "left_anti").groupBy("user_id").agg(F.count("*").alias("open"))


SQL["rates"] = f"SELECT feed_id, place_id, stops, coalesce(date_diff('day', service_end, DATE '{BUILT}') > 30, false) AS stale FROM pairs"


@query("E13_discovered_places", "SELECT DISTINCT place_id FROM rates WHERE place_id NOT IN (SELECT place_id FROM wanted) AND NOT stale")
def e13(t: Tables):
    from .structure import wanted

    fresh = t.pairs().where(~R.is_stale(F.col("service_end"), F.lit(BUILT).cast("date")))
    return fresh.select("place_id").distinct().join(wanted(t), "place_id", "left_anti")


@query("Q13_rebuild_estimate", "SELECT round(regr_intercept(l_extendedprice, l_quantity) + 30 * regr_slope(l_extendedprice, l_quantity), 2) AS minutes FROM lineitem")
def q13(t: Tables):
    fit = G.least_squares(t.read("lineitem"), "l_extendedprice", ["l_quantity"])
    return fit.select(F.round(F.col("b0") + 30 * F.col("b1"), 2).alias("minutes"))


OPENINGS = {"geometry": "Geometry from:", "catalogue": "Catalogues:", "provider": "Providers of keys:", "licence": "Licence:"}


def _notices(t: Tables):
    """A notice for each thousand suppliers of a nation, which credits sources and providers of keys."""
    k = F.col("s_suppkey")
    rows = t.read("supplier").select("s_name", k, F.concat_ws("-", F.col("s_nationkey").cast("string"), F.floor(k / 1000).cast("string")).alias("build"), "s_nationkey", (k % 20).cast("string").alias("p"))
    feeds = F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("\n      feed: "), "s_name"))), "")
    entry = F.concat(F.lit("\n  - p"), "p", F.lit(": Provider "), "p", F.lit("\n      notice: data of "), "p", feeds)
    each = rows.groupBy("build", "s_nationkey", "p").agg(entry.alias("entry"))
    lines = each.groupBy("build", "s_nationkey").agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("\n  - source "), "p"))), "").alias("sources"), F.array_join(F.sort_array(F.collect_list("entry")), "").alias("entries"))
    text = F.concat(F.lit("Geometry from:\n\n"), F.substring("sources", 2, 1 << 30), F.lit("\n\nCatalogues:\n  - nation "), F.col("s_nationkey").cast("string"), F.lit("\n\nProviders of keys:"), "entries", F.lit("\n\nLicence: open\n"))
    return lines.select("build", F.when(F.col("s_nationkey") % 7 == 3, F.concat(text, F.lit("\nA word more.\n"))).otherwise(text).cast("binary").alias("content"))


SQL["built"] = "SELECT s_name, s_suppkey % 20 AS p, s_nationkey AS n, s_nationkey || '-' || (s_suppkey // 1000) AS build FROM supplier"


@query("E34_merged_credits", """
    SELECT 'geometry' AS section, '  - source ' || p AS item, count(DISTINCT build) AS builds FROM built WHERE n % 7 <> 3 GROUP BY ALL
    UNION ALL SELECT 'catalogue', '  - nation ' || n, count(DISTINCT build) FROM built WHERE n % 7 <> 3 GROUP BY ALL
    UNION ALL SELECT 'provider', '  - p' || p || ': Provider ' || p, count(DISTINCT build) FROM built WHERE n % 7 <> 3 GROUP BY ALL""")
def e34_items(t: Tables):
    notices = _notices(t)
    blocks = N.paragraphs(notices, OPENINGS)
    bad = N.refused(notices, blocks, ["geometry", "catalogue", "licence"]).select("build")
    return N.merged_items(blocks.join(bad, "build", "left_anti"))


@query("E34_refused_notices", "SELECT DISTINCT build, 'unknown paragraph: A word more.' AS reason FROM built WHERE n % 7 = 3")
def e34_refused(t: Tables):
    notices = _notices(t)
    return N.refused(notices, N.paragraphs(notices, OPENINGS), ["geometry", "catalogue", "licence"])


@query("E34_provider_credits", """
    SELECT 'p' || p AS provider, 'Provider ' || p AS name, 'feed' AS kind, s_name AS line, count(DISTINCT build) AS builds FROM built GROUP BY ALL
    UNION ALL SELECT 'p' || p, 'Provider ' || p, 'notice', 'data of ' || p, count(DISTINCT build) FROM built GROUP BY ALL""")
def e34_providers(t: Tables):
    rows = N.entries(N.paragraphs(_notices(t), OPENINGS), "provider", "^  - ([^:]+): (.+)$", {"      feed: ": "feed", "      notice: ": "notice"})
    return N.merged_entries(rows).withColumnRenamed("key", "provider")


@query("E34_partition_conflicts", """
    SELECT 'L' || s_nationkey AS label, 'a ' || s_name AS id, 'label not listed' AS what FROM supplier WHERE s_nationkey >= 20
    UNION ALL SELECT 'L' || n_nationkey, NULL, 'no digests' FROM nation WHERE n_nationkey % 6 = 5 AND n_nationkey < 20""")
def e34_partition(t: Tables):
    key = F.col("n_nationkey")
    digests = F.when(key % 6 == 5, F.array(F.lit("none"))).otherwise(F.array(F.sha2("n_name", 256)))
    labels = t.read("nation").where(key < 20).select(F.concat(F.lit("L"), key.cast("string")).alias("label"), digests.alias("digests"))
    assigned = t.read("supplier").select(F.lit("a").alias("catalogue"), F.col("s_name").alias("id"), F.concat(F.lit("L"), F.col("s_nationkey").cast("string")).alias("label"))
    return N.partition_conflicts(labels, assigned)
