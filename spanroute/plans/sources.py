"""S, K1, K2: scans and sinks, by writing driver tables in each form and reading them back."""

from pyspark.sql import functions as F

from spanroute.sinks import archives as Z
from spanroute.sinks import snapshots as K
from spanroute.sinks import stages as G
from spanroute.sinks.scratch import fresh_path
from spanroute.sources import archives as A
from spanroute.sources import files as S
from spanroute.sources.delimited import read_delimited

from .bindings import Tables, query
from .space import areas


@query("S1_csv_scan", "SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer")
def s1(t: Tables):
    path = fresh_path(t.spark)
    rows = t.read("customer").select("c_mktsegment", "c_custkey", "c_name", "c_acctbal")
    rows.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise(" ")).write.option("header", True).csv(path)
    schema = rows.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").schema
    return S.read_csv(t.spark, path, schema)


@query("S1_csv_in_parts", r"""SELECT doc_id, nullif(trim(source), '') AS source, nullif(trim(text, chr(9) || chr(10) || chr(13) || ' '), '') AS text FROM documents""")
def s1_parts(t: Tables):
    """Whole texts, with quotes and line ends within cells, read back by splits that may begin in one."""
    path, rows = fresh_path(t.spark), t.read("documents").select("source", "text", "doc_id")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_delimited(t.spark, path, rows.select("doc_id", "source", "text").schema)


@query("S2_archived_catalogues", "SELECT 'o-' || s_nationkey AS onestop_id, 'N' || min(s_suppkey // 100) AS name, count(DISTINCT s_suppkey // 100) AS listings, count(*) AS feeds FROM supplier GROUP BY s_nationkey")
def s2(t: Tables):
    """Operators over a tar.gz for each tenth hundred suppliers, of a document for each hundred: once each, with all their feeds."""
    path, key = fresh_path(t.spark), F.col("s_suppkey")
    rows = t.read("supplier").select(F.floor(key / 100).alias("b"), F.concat(F.lit("f-"), key.cast("string")).alias("id"), F.concat(F.lit("o-"), F.col("s_nationkey").cast("string")).alias("o"))
    lists = rows.groupBy("b", "o").agg(F.collect_list(F.struct(F.col("id").alias("feed_onestop_id"))).alias("f"))
    operators = lists.groupBy("b").agg(F.collect_list(F.struct(F.col("o").alias("onestop_id"), F.concat(F.lit("N"), F.col("b").cast("string")).alias("name"), F.col("f").alias("associated_feeds"))).alias("operators"))
    feeds = rows.groupBy("b").agg(F.collect_list(F.struct("id", F.lit("GTFS").alias("spec"))).alias("feeds"))
    text = F.to_json(F.struct("feeds", "operators")).cast("binary").alias("content")
    members = feeds.join(operators, "b").select(F.concat(F.lit("a"), F.floor(F.col("b") / 10).cast("string")).alias("archive"), F.concat(F.lit("feeds/"), F.lpad(F.col("b").cast("string"), 12, "0"), F.lit(".json")).alias("member"), text)
    Z.write_archives(members, path, "tar.gz")
    documents = S.read_archives(t.spark, path)
    known = S.feeds_of(documents).select(F.col("onestop_id").alias("feed"))
    operators = S.operators_of(documents)
    listed = operators.select("onestop_id", F.explode("feeds").alias("feed")).join(known, "feed").groupBy("onestop_id").agg(F.count("*").alias("n"))
    return S.merged_operators(operators).join(listed, "onestop_id").where(F.size("feeds") == F.col("n")).select("onestop_id", "name", "listings", F.col("n").alias("feeds"))


@query("S3_catalogue_rows", "SELECT p_partkey, CASE WHEN p_size < 40 THEN p_retailprice END AS price, [p_type, p_brand] AS kinds, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag FROM part")
def s3(t: Tables):
    k = F.col("p_partkey") % 3
    raw = t.read("part").select(
        "p_partkey", F.when(F.col("p_size") < 40, F.concat(F.lit(" "), F.col("p_retailprice").cast("string"))).otherwise("n/a").alias("price"),
        F.concat("p_type", F.lit(" || "), "p_brand").alias("kinds"), F.when(k == 0, "Yes").when(k == 1, "no").otherwise("?").alias("flag"),
    )
    return S.catalogue_rows(raw, ["price"], ["kinds"], ["flag"])


@query("S4_json_lines", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier")
def s4(t: Tables):
    path, rows = fresh_path(t.spark), t.read("supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal")).alias("s_acctbal"))
    S.write_json_lines(rows, path)
    return S.read_json_lines(t.spark, path, rows.schema)


@query("S5_verified_snapshot", "SELECT feed_id, name, home, scope FROM feeds")
def s5(t: Tables):
    root = fresh_path(t.spark)
    K.publish({"feeds": t.feeds(), "places": t.places()}, root, {"places": "kind"})
    return K.resolve(t.spark, root)["feeds"]


@query("S6_partitioned_read", "SELECT feed_id, name, home, scope, 'feeds' AS partition, NULL::VARCHAR AS kind FROM feeds UNION ALL SELECT place_id, name, NULL, NULL, 'places', kind FROM places")
def s6(t: Tables):
    places = t.places().select(F.col("place_id").alias("feed_id"), "name", "kind")
    return S.read_partitions({"feeds": t.feeds(), "places": places}).select("feed_id", "name", "home", "scope", "partition", "kind")


@query("S7_boxes_scan", "SELECT place_id FROM areas WHERE (xmax >= -10 AND xmin <= 0 AND ymax >= -5 AND ymin <= 5) OR (xmax >= 30 AND xmin <= 40 AND ymax >= 0 AND ymin <= 10)")
def s7(t: Tables):
    path = fresh_path(t.spark)
    areas(t).select("place_id", F.struct("xmin", "ymin", "xmax", "ymax").alias("bbox")).write.parquet(path)
    return S.scan_boxes(t.spark.read.parquet(path), [(-10, -5, 0, 5), (30, 0, 40, 10)]).select("place_id")


@query("S8_projected_scan", "SELECT p_partkey, p_name FROM part WHERE p_type IN ('SMALL', 'PROMO') AND p_size > 10")
def s8(t: Tables):
    return t.read("part").where(F.col("p_type").isin("SMALL", "PROMO") & (F.col("p_size") > 10)).select("p_partkey", "p_name")


@query("S9_trimmed_members", "SELECT count(*) AS rows, count(*) FILTER (WHERE c_custkey % 4 = 0) + count(*) FILTER (WHERE c_custkey % 6 = 0) AS padded, count(DISTINCT c_name) AS ids FROM customer")
def s9(t: Tables):
    k = F.col("c_custkey")
    rows = t.read("customer").select(F.when(k % 4 == 0, F.concat("c_name", F.lit(" "))).otherwise(F.col("c_name")).alias("a"), F.when(k % 6 == 0, F.concat(F.lit(" "), "c_name")).otherwise(F.col("c_name")).alias("b"))
    done = S.trimmed_ids(rows, ["a", "b"]).where("a = b")
    return done.agg(F.count("*").alias("rows"), F.sum("padded").alias("padded"), F.countDistinct("a").alias("ids"))


@query("S10_stop_positions", "SELECT vec_id, CASE WHEN vec_id % 3 > 0 AND abs(embedding[1]::DOUBLE * 600) <= 180 AND abs(embedding[2]::DOUBLE * 300) <= 90 THEN round(embedding[1]::DOUBLE * 600, 6) END AS lon FROM embeddings")
def s10(t: Tables):
    at = F.col("embedding")
    raw = t.read("embeddings").select("vec_id", F.when(F.col("vec_id") % 3 == 0, "x").otherwise((at[0].cast("double") * 600).cast("string")).alias("lon"), (at[1].cast("double") * 300).cast("string").alias("lat"))
    return S.stop_positions(raw, "lon", "lat").select("vec_id", F.round("lon", 6).alias("lon"))


@query("S11_boarding_zones", """
    SELECT 'z' || s_suppkey AS id, 5 AS corners FROM supplier WHERE s_suppkey % 5 > 0
        AND s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_linenumber % 2 = 0 AND l_quantity <> 1)""")
def s11(t: Tables):
    """Zones of the suppliers with a row that lets riders board; a fifth of them reach beyond the range of coordinates."""
    key = F.col("s_suppkey")
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.array(F.when(key % 5 == 0, 200.0).otherwise(key % 90) + x, F.lit(float(y))) for x, y in corners])
    feature = F.struct(F.concat(F.lit("z"), key.cast("string")).alias("id"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    documents = t.read("supplier").groupBy(F.floor(key / 100).alias("b")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("text"))
    zone, odd = F.concat(F.lit("z"), F.col("l_suppkey").cast("string")), F.col("l_linenumber") % 2 == 1
    times = t.read("lineitem").select(F.when(F.col("l_linenumber") % 4 == 0, zone).alias("location_id"), F.when(F.col("l_linenumber") % 4 != 0, zone).alias("stop_id"), F.when(odd | (F.col("l_quantity") == 1), "1").when(F.col("l_linenumber") % 4 == 2, "2").alias("pickup_type"))
    zones = S.sound_zones(S.zone_rings(documents))
    return S.boarding_zones(times, zones).select("id", F.size("ring").alias("corners"))


@query("S14_pinned_inputs", "SELECT n_name AS name, sha256(n_name) AS digest FROM nation WHERE n_nationkey % 2 = 1")
def s14(t: Tables):
    rows = t.read("nation").select(F.col("n_name").alias("name"), F.sha2("n_name", 256).alias("digest"), "n_nationkey")
    return S.pinned(rows.drop("n_nationkey"), rows.where("n_nationkey % 2 = 0"))


def _timetables(t: Tables) -> str:
    """Archives of timetables, of 200 suppliers at most each: flat, in a folder with another beside it, or zipped in an archive."""
    path, key = fresh_path(t.spark), F.col("s_suppkey")
    rows = t.read("supplier").select("s_suppkey", "s_name", "s_acctbal", (key % 3).alias("kind"), F.floor(key / 600).alias("part"))
    rows = rows.withColumn("archive", F.concat(F.lit("feed-"), F.col("kind").cast("string"), F.lit("-"), F.col("part").cast("string")))
    cells = F.concat_ws(",", F.concat(F.lit('"'), "s_name", F.lit('\n"')), F.lit(" "), F.col("s_suppkey").cast("string"), F.col("s_acctbal").cast("string"))
    text = F.concat(F.lit("stop_name,zone,stop_id,value\n"), F.array_join(F.sort_array(F.collect_list(cells)), "\n"))
    stops = rows.groupBy("archive", "kind").agg(text.alias("text")).select("archive", "kind", F.when(F.col("kind") == 1, "gtfs/Stops.txt").otherwise("stops.txt").alias("member"), "text")
    each = stops.select("archive", "kind").distinct()
    routes = each.select("archive", "kind", F.when(F.col("kind") == 1, "gtfs/routes.txt").otherwise("routes.txt").alias("member"), F.lit("route_id\n").alias("text"))
    deep = each.where("kind = 1").select("archive", "kind", F.lit("gtfs/old/stops.txt").alias("member"), F.lit("stop_id\nx\n").alias("text"))
    members = stops.union(routes).union(deep).select("archive", "kind", "member", F.col("text").cast("binary").alias("content"))
    inner = Z.zipped(members.where("kind = 2")).select("archive", F.lit("feed.zip").alias("member"), "content")
    Z.write_archives(members.where("kind < 2").drop("kind").unionByName(inner), path)
    return path


@query("S16_ranged_members", "SELECT s_suppkey AS stop_id, s_name AS stop_name, s_acctbal AS value FROM supplier")
def s16(t: Tables):
    found = A.chosen(A.directory(t.spark, _timetables(t)), ["stops.txt", "routes.txt"])
    rows = A.read_table(found.where("name = 'stops.txt'"), ["stop_id", "stop_name", "value"])
    return rows.select(F.col("stop_id").cast("bigint").alias("stop_id"), "stop_name", F.col("value").cast("double").alias("value"))


@query("S17_root_files", """
    SELECT DISTINCT 'feed-' || (s_suppkey % 3) || '-' || (s_suppkey // 600) || '.zip' AS archive, CASE s_suppkey % 3 WHEN 1 THEN ['Stops.txt', 'routes.txt'] ELSE ['routes.txt', 'stops.txt'] END AS files,
        ['routes.txt'] AS empty_files FROM supplier""")
def s17(t: Tables):
    listed = A.root_files(A.directory(t.spark, _timetables(t)), ["stops.txt", "routes.txt"])
    return listed.select(F.substring_index("path", "/", -1).alias("archive"), "files", "empty_files")


@query("S18_answers", """
    SELECT d.doc_id, quality, CASE WHEN quality IS NOT NULL THEN 'known' WHEN page_id IS NOT NULL THEN 'absent' ELSE 'pending' END AS state FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id""")
def s18(t: Tables):
    covered = t.read("pages").select(F.col("page_id").alias("doc_id"))
    return S.answered(t.read("documents").select("doc_id"), covered, t.read("labels").select("doc_id", "quality"), "doc_id")


@query("S20_listed_builds", "SELECT DISTINCT 'build=' || year(o_orderdate) AS folder FROM orders")
def s20(t: Tables):
    path = fresh_path(t.spark)
    t.read("orders").withColumn("build", F.year("o_orderdate")).write.partitionBy("build").parquet(path)
    rows = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return rows.select(F.regexp_extract("path", "/(build=[^/]+)/", 1).alias("folder")).distinct()


@query("K1_published_generation", "SELECT place_id, kind, name, parent_id, country_code FROM places")
def k1(t: Tables):
    root = fresh_path(t.spark)
    for n in range(5):  # more often than generations are kept
        K.publish({"places": t.places() if n == 4 else t.places().limit(n)}, root, keep=2)
    return K.resolve(t.spark, root)["places"]


@query("K2_resolved_generation", "SELECT feed_id, count(*) AS edges FROM edges GROUP BY feed_id")
def k2(t: Tables):
    root = fresh_path(t.spark)
    K.publish({"edges": t.edges()}, root, {"edges": "tier"})
    return K.resolve(t.spark, root)["edges"].groupBy("feed_id").agg(F.count("*").alias("edges"))


def _stages(least: int):
    """Edges with their service, the largest of them, and counts by place and by feed."""
    return [
        G.Stage("service", ("facts",), lambda facts: facts.groupBy("feed_id", "place_id").agg(F.count("*").alias("stops"))),
        G.Stage("large", ("service",), lambda service, least: service.where(F.col("stops") >= least), {"least": least}),
        G.Stage("by_place", ("large",), lambda large: large.groupBy("place_id").agg(F.count("*").alias("feeds"))),
        G.Stage("by_feed", ("service",), lambda service: service.groupBy("feed_id").agg(F.count("*").alias("places"))),
    ]


@query("R3_rerun_stages", """
    WITH s AS (SELECT feed_id, place_id, count(*) AS stops FROM facts GROUP BY ALL), z AS (SELECT place_id, count(*) AS feeds FROM s WHERE stops >= 3 GROUP BY place_id)
    SELECT 'service' AS stage, true AS reused, count(*) AS n FROM s UNION ALL SELECT 'large', false, count(*) FROM s WHERE stops >= 3
    UNION ALL SELECT 'by_place', false, count(*) FROM z UNION ALL SELECT 'by_feed', true, count(DISTINCT feed_id) FROM s""")
def r3(t: Tables):
    """The run after a setting in the middle changed: what comes before and beside it is taken over."""
    root, facts = fresh_path(t.spark), {"facts": t.facts().select("feed_id", "place_id", "l_orderkey", "l_linenumber")}
    G.run_stages(t.spark, root, facts, _stages(2))
    _, done = G.run_stages(t.spark, root, facts, _stages(3))
    return t.spark.createDataFrame([(d.stage, d.reused, d.rows) for d in done], "stage string, reused boolean, n long")


@query("R4_published_run", """
    WITH s AS (SELECT feed_id, place_id, count(*) AS stops FROM facts GROUP BY ALL) SELECT place_id, count(*) AS feeds FROM s WHERE stops >= 2 GROUP BY place_id""")
def r4(t: Tables):
    root = fresh_path(t.spark)
    G.publish_run(t.spark, root, {"facts": t.facts().select("feed_id", "place_id")}, _stages(2))
    return K.resolve(t.spark, root)["by_place"]


@query("K9_report_lines", "SELECT '| ' || replace(name, '_', chr(92) || '_') || ' | ' || n || ' |' AS line FROM places p JOIN (SELECT place_id, count(*) AS n FROM edges GROUP BY place_id) e ON e.place_id = p.place_id")
def k9(t: Tables):
    from spanroute.functions.text import markdown_cell

    counts = t.edges().groupBy("place_id").agg(F.count("*").alias("n"))
    rows = t.places().join(counts, "place_id")
    return rows.select(F.concat(F.lit("| "), markdown_cell(F.col("name")), F.lit(" | "), F.col("n").cast("string"), F.lit(" |")).alias("line"))
