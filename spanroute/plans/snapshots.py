"""J27-J32, C, E, P16-P21: merging builds, curation and constraints."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanroute.functions import text as T
from spanroute.operators import curation as C
from spanroute.operators import merge as M

from .aggregates import edge_service
from .bindings import SQL, Tables, query

SQL["builds"] = "SELECT DISTINCT feed_id, build AS build_id, make_date(build, 1, 1) AS built FROM facts"
SQL["build_edges"] = "SELECT DISTINCT feed_id, place_id, tier, build AS build_id, make_date(build, 1, 1) AS built FROM facts"
SQL["won"] = "SELECT feed_id, max(build_id) AS build_id FROM builds GROUP BY feed_id"


def build_edges(t: Tables):
    return t.facts().select("feed_id", "place_id", "tier", F.col("build").alias("build_id"), F.make_date("build", F.lit(1), F.lit(1)).alias("built")).distinct()


def won(t: Tables):
    return M.won_builds(build_edges(t).select("feed_id", "build_id", "built").distinct())


@query("J27_enriched_rows", """
    SELECT d.doc_id, d.source, quality, n_edges, coalesce(c.status, 'none') AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    LEFT JOIN (SELECT 'F' || s_suppkey AS f, s_suppkey FROM supplier) s ON s.s_suppkey = d.doc_id LEFT JOIN (SELECT feed_id, count(*) AS n_edges FROM edges GROUP BY feed_id) e ON e.feed_id = s.f
    LEFT JOIN (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'ok' ELSE 'failed' END AS status FROM pages) c ON c.page_id = d.doc_id""")
def j27(t: Tables):
    docs = t.read("documents").select("doc_id", "source").join(t.read("labels").select("doc_id", "quality"), "doc_id", "left")
    counts = t.edges().groupBy("feed_id").agg(F.count("*").alias("n_edges"))
    feeds = t.read("supplier").select(F.col("s_suppkey").alias("doc_id"), F.concat(F.lit("F"), "s_suppkey").alias("feed_id")).join(counts, "feed_id", "left").drop("feed_id")
    crawl = t.read("pages").select(F.col("page_id").alias("doc_id"), F.when(F.col("page_id") % 2 == 0, "ok").otherwise("failed").alias("status"))
    return docs.join(feeds, "doc_id", "left").join(crawl, "doc_id", "left").withColumn("status", F.coalesce("status", F.lit("none")))


@query("J28_newest_wins", """
    WITH kept AS (SELECT e.* FROM build_edges e JOIN won w ON e.feed_id = w.feed_id AND e.build_id = w.build_id),
    n AS (SELECT place_id, build_id, count(*) AS kept FROM kept GROUP BY ALL), p AS (SELECT DISTINCT place_id, build_id, built FROM build_edges),
    r AS (SELECT p.*, coalesce(n.kept, 0) AS kept, row_number() OVER (PARTITION BY p.place_id ORDER BY coalesce(n.kept, 0) DESC, built DESC, p.build_id) AS nth FROM p LEFT JOIN n ON p.place_id = n.place_id AND p.build_id = n.build_id)
    SELECT place_id, build_id, kept FROM r WHERE nth = 1""")
def j28(t: Tables):
    edges = build_edges(t)
    places = edges.select("place_id", "build_id", "built").distinct()
    return M.merge_places(places, M.merge_edges(edges, won(t))).select("place_id", "build_id", "kept")


@query("J29_semi_and_anti", "SELECT feed_id, name FROM feeds WHERE feed_id NOT IN (SELECT feed_id FROM pairs WHERE stops >= 17)")
def j29(t: Tables):
    some = t.pairs().where("stops >= 17").select("feed_id")
    return t.feeds().join(some, "feed_id", "left_anti").select("feed_id", "name")


SQL["realtime"] = "SELECT 'T' || substr(feed_id, 2) AS feed_id, CASE WHEN substr(feed_id, 2)::INT % 5 = 0 THEN 'X' ELSE feed_id END AS static_feed_id, build_id, built FROM builds"


def realtime(t: Tables):
    one = build_edges(t).select("feed_id", "build_id", "built").distinct().withColumn("k", F.substring("feed_id", 2, 20).cast("int"))
    return one.select(F.concat(F.lit("T"), F.col("k").cast("string")).alias("feed_id"), F.when(F.col("k") % 5 == 0, "X").otherwise(F.col("feed_id")).alias("static_feed_id"), "build_id", "built")


@query("J30_propagated_edges", "SELECT DISTINCT r.feed_id, e.place_id, 'unknown' AS tier, 'inferred' AS method FROM realtime r JOIN edges e ON e.feed_id = r.static_feed_id")
def j30(t: Tables):
    return M.propagate(realtime(t), t.edges())


@query("J31_companion_routing", """
    WITH m AS (SELECT r.*, w.build_id AS wb FROM realtime r LEFT JOIN won w ON w.feed_id = r.static_feed_id), f AS (SELECT feed_id, static_feed_id, build_id, built FROM m WHERE build_id = wb),
    l AS (SELECT feed_id, static_feed_id, build_id, built FROM (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY built DESC, build_id) AS nth FROM m WHERE wb IS NULL) WHERE nth = 1)
    SELECT * FROM f UNION ALL SELECT * FROM l WHERE feed_id NOT IN (SELECT feed_id FROM f)""")
def j31(t: Tables):
    return M.companions(realtime(t), won(t)).select("feed_id", "static_feed_id", "build_id", "built")


@query("J32_code_lookup", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def j32(t: Tables):
    joined = t.read("customer").select("c_custkey", "c_nationkey").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


_EDITS = """
    SELECT s_suppkey AS edit_id, CASE WHEN s_suppkey % 4 <> 1 THEN 'F' || s_suppkey END AS feed_id, CASE WHEN s_suppkey % 4 IN (0, 1) THEN 'C' || s_nationkey || '-MACHINERY' END AS place_id,
           CASE s_suppkey % 3 WHEN 0 THEN 'remove' ELSE 'set' END AS action, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE 'regional' END AS tier FROM supplier
    UNION ALL SELECT 1000000 + s_suppkey, 'F' || s_suppkey, 'N' || s_nationkey, 'add', 'national' FROM supplier"""
SQL["edits"] = _EDITS


def edits(t: Tables):
    k, at = F.col("s_suppkey"), F.concat(F.lit("C"), "s_nationkey", F.lit("-MACHINERY"))
    feed, s = F.concat(F.lit("F"), "s_suppkey"), t.read("supplier")
    change = s.select(
        k.alias("edit_id"), F.when(k % 4 != 1, feed).alias("feed_id"), F.when((k % 4).isin(0, 1), at).alias("place_id"), F.when(k % 3 == 0, "remove").otherwise("set").alias("action"), F.when(k % 3 != 0, "regional").alias("tier")
    )
    return change.union(s.select(1000000 + k, feed, F.concat(F.lit("N"), "s_nationkey"), F.lit("add"), F.lit("national")))


@query("C1_edge_edits", """
    WITH m AS (SELECT e.feed_id, e.place_id, e.tier, d.action, d.tier AS new_tier, 2 * (d.place_id IS NOT NULL)::INT + (d.feed_id IS NOT NULL)::INT AS w, edit_id
               FROM edges e JOIN edits d ON (d.feed_id IS NULL OR d.feed_id = e.feed_id) AND (d.place_id IS NULL OR d.place_id = e.place_id) WHERE d.action <> 'add'),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, place_id, tier ORDER BY w DESC, edit_id) AS nth FROM m) WHERE nth = 1)
    SELECT e.feed_id, e.place_id, coalesce(new_tier, e.tier) AS tier FROM edges e LEFT JOIN b ON e.feed_id = b.feed_id AND e.place_id = b.place_id AND e.tier = b.tier WHERE coalesce(action <> 'remove', true)
    UNION SELECT feed_id, place_id, tier FROM edits WHERE action = 'add'""")
def c1(t: Tables):
    return C.apply_edits(t.edges(), edits(t))


@query("C2_stale_edits", """
    WITH e AS (SELECT p_partkey, sha256(p_name || p_size) AS digest FROM part), d AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN sha256(p_name || (p_size + 1)) ELSE sha256(p_name || p_size) END AS seen FROM part WHERE p_size > 40)
    SELECT d.p_partkey, seen, digest FROM d LEFT JOIN e ON d.p_partkey = e.p_partkey WHERE seen IS DISTINCT FROM digest""")
def c2(t: Tables):
    def digest(by: int):
        return F.sha2(F.concat("p_name", (F.col("p_size") + by).cast("string")), 256)

    part = t.read("part")
    edited = part.where("p_size > 40").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, digest(1)).otherwise(digest(0)).alias("seen"))
    return C.stale_edits(edited, part.select("p_partkey", digest(0).alias("digest")), "p_partkey")


@query("C3_feed_renames", """
    SELECT CASE WHEN s_suppkey % 4 = 0 THEN 'f-' || s_suppkey ELSE feed_id END AS feed_id, CASE WHEN s_suppkey % 4 = 0 THEN list_sort(['A' || s_suppkey, feed_id]) ELSE ['A' || s_suppkey] END AS aliases
    FROM (SELECT s_suppkey, 'F' || s_suppkey AS feed_id FROM supplier)""")
def c3(t: Tables):
    k = F.col("s_suppkey").cast("string")
    feeds = t.read("supplier").select(F.concat(F.lit("F"), k).alias("feed_id"), F.array(F.concat(F.lit("A"), k)).alias("aliases"))
    return C.renamed(feeds, t.read("supplier").where("s_suppkey % 4 = 0").select(F.concat(F.lit("F"), k).alias("old"), F.concat(F.lit("f-"), k).alias("new")))


@query("C4_place_edits", "SELECT place_id, CASE WHEN place_id LIKE 'N1%' THEN 'Curated ' || name ELSE name END AS name FROM places")
def c4(t: Tables):
    fixed = t.places().where("place_id like 'N1%'").select("place_id", F.concat(F.lit("Curated "), "name").alias("curated"))
    return t.places().join(fixed, "place_id", "left").select("place_id", F.coalesce("curated", "name").alias("name"))


@query("C5_replaced_placements", "SELECT feed_id, place_id FROM pairs WHERE substr(feed_id, 2)::INT % 10 <> 0 UNION ALL SELECT feed_id, 'R0' FROM feeds WHERE substr(feed_id, 2)::INT % 10 = 0")
def c5(t: Tables):
    curated = t.feeds().where("cast(substr(feed_id, 2) as int) % 10 = 0").select("feed_id", F.lit("R0").alias("place_id"))
    return C.replaced(t.pairs().select("feed_id", "place_id"), curated, "feed_id")


@query("C6_repeated_ids", "SELECT p_name AS id, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def c6(t: Tables):
    return C.repeated_ids(t.read("part"), "p_name")


@query("C7_dangling", "SELECT l_partkey AS missing, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY l_partkey")
def c7(t: Tables):
    return C.dangling(t.read("lineitem"), "l_partkey", t.read("part").where("p_size > 5"), "p_partkey")


@query("C8_sole_tier", "SELECT feed_id, place_id, count(*) FILTER (WHERE tier = 'unknown') AS whole, count(*) AS n FROM edges GROUP BY ALL HAVING count(*) FILTER (WHERE tier = 'unknown') > 0 AND count(*) > 1")
def c8(t: Tables):
    return C.sole_tier(t.edges(), F.col("tier") == "unknown")


@query("C9_lineage", """
    WITH m AS (SELECT feed_id, build_id, row_number() OVER (PARTITION BY feed_id ORDER BY build_id) AS gen FROM builds)
    SELECT a.feed_id, a.build_id FROM m a JOIN (SELECT feed_id, max(build_id) AS cur FROM m GROUP BY feed_id) c ON a.feed_id = c.feed_id WHERE a.build_id <> c.cur AND a.gen > 1""")
def c9(t: Tables):
    builds = build_edges(t).select("feed_id", "build_id").distinct()
    gens = builds.withColumn("gen", F.row_number().over(Window.partitionBy("feed_id").orderBy("build_id")))
    current = builds.groupBy("feed_id").agg(F.max("build_id").alias("cur"))
    return gens.join(current, "feed_id").where("build_id <> cur and gen > 1").select("feed_id", "build_id")


_HISTORY = """
    WITH o AS (SELECT p_partkey AS place_id, p_type AS kind, CASE p_partkey % 4 WHEN 0 THEN 'merged' WHEN 1 THEN 'retired' ELSE 'live' END AS state, CASE p_partkey % 4 WHEN 0 THEN p_partkey // 2 END AS into_, [p_name] AS names FROM part),
    n AS (SELECT place_id, CASE WHEN place_id % 50 = 2 THEN 'SMALL' ELSE kind END AS kind, CASE WHEN place_id % 60 = 1 THEN 'live' ELSE state END AS state, CASE WHEN place_id % 40 = 0 AND into_ IS NOT NULL THEN -1 ELSE into_ END AS into_,
                 CASE WHEN place_id % 70 = 3 THEN ['x'] ELSE list_append(names, 'y') END AS names FROM o WHERE place_id % 90 <> 7)
    SELECT o.place_id, CASE WHEN n.state IS NULL THEN 'removed' WHEN n.kind <> o.kind THEN 'kind' WHEN o.state <> 'live' AND n.state <> o.state THEN 'revived' WHEN n.state = 'live' AND n.names[1:len(o.names)] <> o.names THEN 'names'
        WHEN o.state = 'merged' AND n.into_ IS DISTINCT FROM o.into_ AND n.into_ IS DISTINCT FROM f.into_ THEN 'into' END AS fault
    FROM o LEFT JOIN n ON o.place_id = n.place_id LEFT JOIN n f ON f.place_id = o.into_ WHERE fault IS NOT NULL"""


@query("C10_history_contract", _HISTORY)
def c10(t: Tables):
    k = F.col("place_id")
    old = t.read("part").select(
        F.col("p_partkey").alias("place_id"), F.col("p_type").alias("kind"), F.when(F.col("p_partkey") % 4 == 0, "merged").when(F.col("p_partkey") % 4 == 1, "retired").otherwise("live").alias("state"),
        F.when(F.col("p_partkey") % 4 == 0, F.floor(F.col("p_partkey") / 2)).alias("into"), F.array("p_name").alias("names"),
    )
    new = old.where("place_id % 90 <> 7").select(
        k, F.when(k % 50 == 2, "SMALL").otherwise(F.col("kind")).alias("kind"), F.when(k % 60 == 1, "live").otherwise(F.col("state")).alias("state"),
        F.when((k % 40 == 0) & F.col("into").isNotNull(), -1).otherwise(F.col("into")).alias("into"), F.when(k % 70 == 3, F.array(F.lit("x"))).otherwise(F.array_append("names", F.lit("y"))).alias("names"),
    )
    return C.history_breaks(old, new)


@query("C11_golden_gate", """
    WITH got AS (SELECT feed_id, list(DISTINCT tier) AS got FROM edge_service WHERE stops >= 17 GROUP BY feed_id),
    g AS (SELECT feed_id, ['local', 'regional'] AS tiers, substr(feed_id, 2)::INT % 2 = 0 AS exact FROM feeds)
    SELECT g.feed_id, len(list_filter(tiers, lambda x: NOT list_contains(coalesce(got, []), x)))::BIGINT AS missing, CASE WHEN exact THEN len(list_filter(coalesce(got, []), lambda x: NOT list_contains(tiers, x)))::BIGINT ELSE 0 END AS extra
    FROM g LEFT JOIN got ON g.feed_id = got.feed_id""")
def c11(t: Tables):
    golden = t.feeds().select("feed_id", F.array(F.lit("local"), F.lit("regional")).alias("tiers"), (F.substring("feed_id", 2, 20).cast("int") % 2 == 0).alias("exact"))
    return C.gate(golden, edge_service(t).where("stops >= 17"))


@query("C12_partition_completeness", "SELECT o_orderkey, count(DISTINCT l_suppkey % 3) AS labels FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey HAVING count(DISTINCT l_suppkey % 3) <> 1")
def c12(t: Tables):
    rows = t.read("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_suppkey") % 3).alias("label"))
    return C.not_once(rows, "o_orderkey", "label", t.read("orders"))


@query("C13_partition_labels", """
    WITH n AS (SELECT c_custkey, 'N' || c_nationkey AS country, count(*) OVER (PARTITION BY c_nationkey) AS n, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS nth FROM customer)
    SELECT c_custkey, CASE WHEN ceil(n / 25) > 1 THEN country || '-' || (floor((nth - 1) * ceil(n / 25) / n) + 1)::BIGINT ELSE country END AS label FROM n""")
def c13(t: Tables):
    rows = t.read("customer").select("c_custkey", F.concat(F.lit("N"), "c_nationkey").alias("country"))
    return C.partition_labels(rows, "country", "c_custkey", 25).select("c_custkey", "label")


@query("P16_skip_predicate", """
    SELECT feed_id, build, l_partkey, count(DISTINCT tier) = 1 AND count(DISTINCT country_code) = 1 AND count(DISTINCT f.place_id) = 1 AS skip FROM facts f JOIN places p ON f.place_id = p.place_id GROUP BY feed_id, build, l_partkey""")
def p16(t: Tables):
    rows = t.facts().join(t.places().select("place_id", "country_code"), "place_id")
    one = (F.countDistinct("tier") == 1) & (F.countDistinct("country_code") == 1) & (F.countDistinct("place_id") == 1)
    return rows.groupBy("feed_id", "build", "l_partkey").agg(one.alias("skip"))


@query("P17_access", "SELECT event_id, CASE event_type WHEN 'error' THEN CASE WHEN value > 20 THEN 'key' ELSE 'refused' END WHEN 'view' THEN 'open' END AS access FROM events")
def p17(t: Tables):
    kind = F.col("event_type")
    return t.read("events").select("event_id", F.when((kind == "error") & (F.col("value") > 20), "key").when(kind == "error", "refused").when(kind == "view", "open").alias("access"))


@query("P18_provider_binding", "SELECT feed_id, CASE WHEN home = 'R0' THEN 'keyed' WHEN scope = 'domestic' THEN 'open' ELSE coalesce(r_name, 'none') END AS access FROM feeds LEFT JOIN region ON home = 'R' || r_regionkey AND r_regionkey > 2")
def p18(t: Tables):
    region = t.read("region").where("r_regionkey > 2").select(F.concat(F.lit("R"), "r_regionkey").alias("home"), "r_name")
    return t.feeds().join(region, "home", "left").select("feed_id", F.when(F.col("home") == "R0", "keyed").when(F.col("scope") == "domestic", "open").otherwise(F.coalesce("r_name", F.lit("none"))).alias("access"))


@query("P19_selector", "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_type IN ('SMALL', 'LARGE')")
def p19(t: Tables):
    return t.read("part").where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3") & F.col("p_type").isin("SMALL", "LARGE")).select("p_partkey")


@query("P21_shippable", """
    WITH s AS (SELECT l_orderkey, list(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, len(list_filter(flags, lambda x: x IN ('A', 'N'))) = len(flags) AS shippable FROM s""")
def p21(t: Tables):
    flags = t.read("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"))
    return flags.select("l_orderkey", F.forall("flags", lambda x: x.isin("A", "N")).alias("shippable"))


@query("E2_one_read_per_feed", "SELECT l_suppkey, min_by(l_orderkey, (CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END, l_orderkey)) AS read_id, count(*) AS reads FROM lineitem GROUP BY l_suppkey".replace("min_by", "arg_min"))
def e2(t: Tables):
    own = F.when(F.col("l_linenumber") == 1, 0).otherwise(1)
    return t.read("lineitem").groupBy("l_suppkey").agg(F.min_by("l_orderkey", F.struct(own, F.col("l_orderkey"))).alias("read_id"), F.count("*").alias("reads"))


@query("E4_coverage_assembly", """
    WITH curated AS (SELECT feed_id, 'R0' AS place_id, 'curated' AS method FROM feeds WHERE substr(feed_id, 2)::INT % 10 = 0), measured AS (SELECT feed_id, place_id, 'crawl' AS method FROM pairs WHERE stops > 8),
    declared AS (SELECT feed_id, home AS place_id, 'declared' AS method FROM feeds)
    FROM curated UNION ALL FROM measured WHERE feed_id NOT IN (SELECT feed_id FROM curated) UNION ALL FROM declared WHERE feed_id NOT IN (SELECT feed_id FROM curated UNION SELECT feed_id FROM measured)""")
def e4(t: Tables):
    curated = t.feeds().where("cast(substr(feed_id, 2) as int) % 10 = 0").select("feed_id", F.lit("R0").alias("place_id"), F.lit("curated").alias("method"))
    measured = t.pairs().where("stops > 8").select("feed_id", "place_id", F.lit("crawl").alias("method"))
    declared = t.feeds().select("feed_id", F.col("home").alias("place_id"), F.lit("declared").alias("method"))
    return C.replaced(C.replaced(declared, measured, "feed_id"), curated, "feed_id")


@query("E17_trip_routes", """
    WITH t AS (SELECT o_orderkey AS trip, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey % 50 END AS route FROM orders), s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT route, count(*) AS trips, count(*) FILTER (WHERE s.n IS NULL) AS empty, coalesce(sum(s.n), 0)::BIGINT AS stop_times FROM t LEFT JOIN s ON s.l_orderkey = trip GROUP BY route""")
def e17(t: Tables):
    trips = t.read("orders").select(F.col("o_orderkey").alias("trip"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 50).alias("route"))
    times = t.read("lineitem").groupBy(F.col("l_orderkey").alias("trip")).agg(F.count("*").alias("n"))
    return trips.join(times, "trip", "left").groupBy("route").agg(F.count("*").alias("trips"), F.count_if(F.col("n").isNull()).alias("empty"), F.coalesce(F.sum("n"), F.lit(0)).alias("stop_times"))


@query("E18_stop_reach", """
    SELECT l_partkey AS stop, list_sort(list(DISTINCT split_part(f.place_id, '-', 2))) AS metros, list_sort(list(DISTINCT country_code)) AS countries, count(DISTINCT f.place_id) AS cities FROM facts f JOIN places p ON f.place_id = p.place_id GROUP BY l_partkey""")
def e18(t: Tables):
    rows = t.facts().select("l_partkey", "place_id").distinct().join(t.places().select("place_id", "country_code"), "place_id")
    metro = F.split_part("place_id", F.lit("-"), F.lit(2))
    return rows.groupBy(F.col("l_partkey").alias("stop")).agg(F.array_sort(F.collect_set(metro)).alias("metros"), F.array_sort(F.collect_set("country_code")).alias("countries"), F.count("*").alias("cities"))


@query("E22_record_takeover", """
    WITH c AS (SELECT doc_id, source, lang, first_value(doc_id) OVER w AS canon, count(*) OVER (PARTITION BY sha256(text)) AS n FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY source, doc_id)),
    o AS (SELECT canon, min(source) AS other FROM c WHERE doc_id <> canon GROUP BY canon)
    SELECT c.doc_id, c.n, coalesce(other, source) AS record FROM c LEFT JOIN o ON o.canon = c.doc_id WHERE doc_id = c.canon""")
def e22(t: Tables):
    from spanroute.operators.overlap import fold_identical

    docs = t.read("documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    folded = fold_identical(docs, "doc_id", "digest", "source").join(docs.select("doc_id", "source"), "doc_id")
    other = folded.where("doc_id <> canonical_id").groupBy(F.col("canonical_id").alias("doc_id")).agg(F.min("source").alias("other"))
    return folded.where("doc_id = canonical_id").join(other, "doc_id", "left").select("doc_id", "n", F.coalesce("other", "source").alias("record"))


_OUT = "SELECT user_id, CASE WHEN max(value) > {0} THEN 'failed' ELSE 'ok' END AS outcome FROM events WHERE event_type = '{1}' AND user_id % 7 <> {2} GROUP BY user_id"


@query("E24_outcome_changes", f"""
    WITH a AS ({_OUT.format(60, 'view', 1)}), b AS ({_OUT.format(60, 'click', 2)})
    SELECT * FROM (SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN a.outcome IS NULL THEN 'new' WHEN b.outcome IS NULL THEN 'gone' WHEN a.outcome = 'ok' AND b.outcome <> 'ok' THEN 'regression' WHEN a.outcome <> 'ok' AND b.outcome = 'ok' THEN 'repaired' END AS change
    FROM a FULL JOIN b ON a.user_id = b.user_id) WHERE change IS NOT NULL""")
def e24(t: Tables):
    def outcome(kind: str, skip: int):
        rows = t.read("events").where((F.col("event_type") == kind) & (F.col("user_id") % 7 != skip))
        return rows.groupBy("user_id").agg(F.when(F.max("value") > 60, "failed").otherwise("ok").alias("outcome"))

    return M.outcomes(outcome("view", 1), outcome("click", 2), "user_id", "outcome")


@query("E25_published_rows", "SELECT place_id, kind, name, parent_id, country_code, [place_id, 'x:' || place_id] AS concordances FROM places")
def e25(t: Tables):
    return t.places().withColumn("concordances", F.array("place_id", F.concat(F.lit("x:"), "place_id")))


@query("E27_negative_cache", """
    WITH a AS (SELECT p_partkey AS id, [p_brand, p_type] AS req FROM part), n AS (SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN [p_brand, p_type, 'x'] ELSE [p_type] END AS covers FROM part WHERE p_partkey % 3 = 0)
    SELECT a.id FROM a LEFT JOIN n ON a.id = n.id AND list_has_all(n.covers, a.req) WHERE n.id IS NULL""")
def e27(t: Tables):
    part = t.read("part").withColumn("id", F.col("p_partkey"))
    asked = part.select("id", F.array("p_brand", "p_type").alias("req"))
    known = part.where("p_partkey % 3 = 0").select(F.col("id").alias("k"), F.when(F.col("p_size") % 2 == 0, F.array("p_brand", "p_type", F.lit("x"))).otherwise(F.array("p_type")).alias("covers"))
    return asked.join(known, (F.col("id") == F.col("k")) & (F.size(F.array_except("req", "covers")) == 0), "left_anti").select("id")


@query("E28_refused_sources", "SELECT source, count(*) AS refused FROM licensed WHERE allowed = false GROUP BY source")
def e28(t: Tables):
    from .aggregates import licensed

    return licensed(t).where("not allowed").groupBy("source").agg(F.count("*").alias("refused"))


@query("E29_row_lookup", """
    SELECT page_id, CASE WHEN doc_id IS NULL THEN 'unmatched' WHEN lang = 'fr' THEN 'not_transit' WHEN dup > 1 THEN 'folded' ELSE 'feed' END AS outcome
    FROM pages LEFT JOIN (SELECT doc_id, lang, count(*) OVER (PARTITION BY sha256(text)) AS dup FROM documents) d ON d.doc_id = page_id * 5""")
def e29(t: Tables):
    docs = t.read("documents").select("doc_id", "lang", F.sha2("text", 256).alias("digest"))
    folded = docs.join(docs.groupBy("digest").agg(F.count("*").alias("dup")), "digest").drop("digest")
    met = t.read("pages").select("page_id", (F.col("page_id") * 5).alias("doc_id")).join(folded.withColumn("known", F.lit(True)), "doc_id", "left")
    return met.select("page_id", F.when(F.col("known").isNull(), "unmatched").when(F.col("lang") == "fr", "not_transit").when(F.col("dup") > 1, "folded").otherwise("feed").alias("outcome"))


@query("E31_route_identity", """
    WITH r AS (SELECT feed_id, tier, l_linenumber AS name, sha256((l_partkey // 100) || '') AS digest, max(l_quantity) AS q FROM (SELECT unnest([feed_id, '*']) AS feed_id, tier, l_linenumber, l_partkey, l_quantity FROM facts) GROUP BY ALL)
    SELECT feed_id AS bucket, tier, count(*) AS n, round(quantile_cont(q, 0.9), 6) AS p90 FROM r GROUP BY ALL HAVING count(*) >= 100""")
def e31(t: Tables):
    from spanroute.operators.aggregates import span_reference

    rows = t.facts().withColumn("digest", F.sha2(F.floor(F.col("l_partkey") / 100).cast("string"), 256))
    return span_reference(rows, "feed_id", "tier", ["l_linenumber", "digest"], "l_quantity", 100).select("bucket", "tier", "n", F.round("p90", 6).alias("p90"))


@query("E33_golden_evidence", "SELECT coalesce(a.feed_id, b.feed_id) AS feed_id, a.feed_id IS NOT NULL AS golden, b.feed_id IS NOT NULL AS evidence FROM feeds a FULL JOIN (SELECT DISTINCT feed_id FROM pairs WHERE stops > 20) b ON a.feed_id = b.feed_id WHERE a.feed_id IS NULL OR b.feed_id IS NULL")
def e33(t: Tables):
    a = t.feeds().select("feed_id", F.lit(True).alias("a"))
    b = t.pairs().where("stops > 20").select("feed_id").distinct().withColumn("b", F.lit(True))
    met = a.join(b, "feed_id", "full").where("a is null or b is null")
    return met.select("feed_id", F.col("a").isNotNull().alias("golden"), F.col("b").isNotNull().alias("evidence"))


@query("K3_partition_router", """
    SELECT e.feed_id, e.place_id, CASE WHEN home IN ('R0', 'R1') THEN home ELSE 'international' END AS feed_partition, CASE WHEN home = country_code THEN country_code ELSE 'links' END AS edge_partition
    FROM (SELECT DISTINCT feed_id, place_id FROM edges) e JOIN feeds f ON e.feed_id = f.feed_id JOIN places p ON e.place_id = p.place_id""")
def k3(t: Tables):
    from spanroute.sinks.snapshots import edge_partition, feed_partition

    rows = t.edges().select("feed_id", "place_id").distinct().join(t.feeds(), "feed_id").join(t.places().select("place_id", "country_code"), "place_id")
    known = F.when(F.col("home").isin("R0", "R1"), F.col("home"))
    return rows.select("feed_id", "place_id", feed_partition(known).alias("feed_partition"), edge_partition(F.col("home"), F.col("country_code")).alias("edge_partition"))


@query("K4_core_rows", "SELECT feed_id, place_id, tier, stops, departures FROM edge_service")
def k4(t: Tables):
    from spanroute.sinks.snapshots import split_columns

    return split_columns(edge_service(t), ["feed_id", "place_id", "tier"], ["routes", "service_end"])[0]


@query("K5_json_blocks", """SELECT feed_id, place_id, '{"departures":' || coalesce(departures::VARCHAR, 'null') || ',"stops":' || stops || '}' AS service FROM pairs WHERE departures IS NOT NULL""")
def k5(t: Tables):
    return t.pairs().where("departures is not null").select("feed_id", "place_id", F.to_json(F.struct("departures", "stops")).alias("service"))


@query("K6_snapshot_ids", "SELECT feed_id, left(sha256(string_agg(DISTINCT place_id || tier, chr(10) ORDER BY place_id || tier)), 16) AS snapshot FROM edges GROUP BY feed_id")
def k6(t: Tables):
    rows = t.edges().groupBy("feed_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat("place_id", "tier"))), "\n").alias("rows"))
    return rows.select("feed_id", T.snapshot_id(F.col("rows")).alias("snapshot"))


@query("K11_safe_cells", "SELECT p_partkey, CASE WHEN regexp_matches(v, '^[=+@-]') THEN '''' || v ELSE v END AS v FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '=' || p_name WHEN 1 THEN '-' || p_size ELSE p_name END AS v FROM part)")
def k11(t: Tables):
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("="), "p_name")).when(k == 1, F.concat(F.lit("-"), F.col("p_size").cast("string"))).otherwise(F.col("p_name"))
    return t.read("part").select("p_partkey", T.csv_cell(raw).alias("v"))
