"""H, J20-J25, J26, W9: hierarchy, containment and overlap."""

from pyspark.sql import functions as F

from spanroute.operators import hierarchy as H
from spanroute.operators import overlap as O
from spanroute.operators import tiles
from spanroute.sinks.scratch import written

from .aggregates import edge_service
from .bindings import SQL, Tables, query

SQL["closed"] = """
    SELECT place_id, place_id AS ancestor_id, 0 AS depth FROM places UNION ALL SELECT place_id, parent_id, 1 FROM places WHERE parent_id IS NOT NULL
    UNION ALL SELECT p.place_id, q.parent_id, 2 FROM places p JOIN places q ON p.parent_id = q.place_id WHERE q.parent_id IS NOT NULL"""
SQL["wanted"] = "SELECT DISTINCT place_id FROM pairs WHERE stops >= 16"
SQL["membership"] = "SELECT place_id, 'M-' || split_part(place_id, '-', 2) AS metro_id FROM places WHERE kind = 'city'"


def wanted(t: Tables):
    return t.pairs().where("stops >= 16").select("place_id").distinct()


def membership(t: Tables):
    return t.places().where("kind = 'city'").select("place_id", F.concat(F.lit("M-"), F.split_part("place_id", F.lit("-"), F.lit(2))).alias("metro_id"))


@query("H2_ancestors", "SELECT p.place_id, coalesce(list(ancestor_id ORDER BY depth DESC) FILTER (WHERE depth > 0), []) AS chain FROM places p JOIN closed c ON p.place_id = c.place_id GROUP BY p.place_id")
def h2(t: Tables):
    return H.ancestor_chains(t.places())


@query("H3_keep_set", """
    WITH s AS (SELECT place_id FROM wanted), k AS (SELECT DISTINCT ancestor_id AS place_id FROM closed WHERE place_id IN (FROM s))
    SELECT place_id FROM k""")
def h3(t: Tables):
    return H.keep_set(t.places(), wanted(t), membership(t))


@query("H4_nearest_kept", """
    SELECT place_id, arg_min(ancestor_id, depth) AS kept_id, min(depth) AS depth FROM closed
    WHERE ancestor_id IN (SELECT place_id FROM wanted UNION SELECT place_id FROM places WHERE kind = 'country') GROUP BY place_id""")
def h4(t: Tables):
    kept = wanted(t).union(t.places().where("kind = 'country'").select("place_id"))
    return H.nearest_kept(t.places(), kept)


@query("H5_rehome", """
    WITH near AS (SELECT place_id, arg_min(ancestor_id, depth) AS kept_id FROM closed WHERE ancestor_id IN (SELECT place_id FROM wanted UNION SELECT place_id FROM places WHERE kind = 'country') GROUP BY place_id),
    e AS (SELECT *, round(stops / 40, 6) AS confidence, stops % 3 = 0 AS review, CASE stops % 4 WHEN 0 THEN 'inferred' WHEN 1 THEN 'crawl' WHEN 2 THEN 'agent' ELSE 'human' END AS method FROM edge_service)
    SELECT kept_id AS place_id, feed_id, tier, max(confidence) AS confidence, bool_or(review) AS review,
           arg_max(method, CASE method WHEN 'inferred' THEN 1 WHEN 'crawl' THEN 2 WHEN 'agent' THEN 3 ELSE 4 END) AS method,
           list_sort(coalesce(list(DISTINCT e.place_id) FILTER (WHERE e.place_id <> kept_id), [])) AS rehomed_from
    FROM e JOIN near ON e.place_id = near.place_id GROUP BY kept_id, feed_id, tier""")
def h5(t: Tables):
    stops = F.col("stops")
    edges = edge_service(t).withColumn("confidence", F.round(stops / 40, 6)).withColumn("review", stops % 3 == 0)
    edges = edges.withColumn("method", F.element_at(F.array(*[F.lit(m) for m in H.METHODS]), (stops % 4 + 1).cast("int")))
    kept = wanted(t).union(t.places().where("kind = 'country'").select("place_id"))
    return H.rehome(edges, H.nearest_kept(t.places(), kept))


@query("H6_alias_stars", """
    WITH c AS (SELECT DISTINCT p_partkey AS feed_id, p_partkey + p_size * 1000 AS alias FROM part),
    per AS (SELECT alias, count(*) AS n FROM c GROUP BY alias),
    bad AS (SELECT feed_id, bool_or(n > 1 OR alias IN (SELECT feed_id FROM c)) AS bad FROM c JOIN per USING (alias) GROUP BY feed_id)
    SELECT alias, feed_id FROM c WHERE feed_id IN (SELECT feed_id FROM bad WHERE NOT bad) AND feed_id NOT IN (SELECT alias FROM c)""")
def h6(t: Tables):
    claims = t.read("part").select(F.col("p_partkey").alias("feed_id"), (F.col("p_partkey") + F.col("p_size") * 1000).alias("alias"))
    return H.alias_stars(claims)


@query("H8_reciprocal_membership", "SELECT metro_id, list_sort(list(place_id)) AS member_ids FROM membership GROUP BY metro_id")
def h8(t: Tables):
    return H.reciprocal(membership(t))[1]


@query("H9_majority_country", """
    WITH n AS (SELECT m.metro_id, CASE WHEN p.country_code IN ('R0', 'R1', 'R2') THEN 'R0' ELSE p.country_code END AS country_code, count(*) AS n FROM membership m JOIN places p ON m.place_id = p.place_id GROUP BY ALL)
    SELECT metro_id, country_code FROM (SELECT *, n / sum(n) OVER (PARTITION BY metro_id) AS s FROM n) WHERE s > 0.5""")
def h9(t: Tables):
    three = F.when(F.col("country_code").isin("R0", "R1", "R2"), "R0").otherwise(F.col("country_code"))
    city = t.places().select("place_id", three.alias("country_code"))
    return H.majority(membership(t).join(city, "place_id"), "metro_id", "country_code")


@query("H10_identify", """
    WITH r AS (SELECT p_partkey AS key, unnest([p_brand || p_size, 'x' || p_partkey]) AS value FROM part),
    c AS (SELECT value, place_id FROM (SELECT p_brand || p_size AS value, 'tp_' || (p_partkey % 50) AS place_id FROM part WHERE p_size > 48 UNION SELECT 'x' || p_partkey, 'tp_' || (p_partkey % 40) FROM part WHERE p_size < 12)),
    f AS (SELECT key, count(DISTINCT place_id) AS n, min(place_id) AS one FROM r LEFT JOIN c USING (value) GROUP BY key)
    SELECT key, CASE n WHEN 0 THEN 'tp_' || (1000 + row_number() OVER (PARTITION BY n ORDER BY key) - 1) WHEN 1 THEN one END AS place_id, CASE n WHEN 0 THEN 'minted' WHEN 1 THEN 'identified' ELSE 'conflict' END AS outcome FROM f""")
def h10(t: Tables):
    part, key, size = t.read("part"), F.col("p_partkey"), F.concat("p_brand", F.col("p_size").cast("string"))
    own = F.concat(F.lit("x"), key.cast("string"))
    known = part.where("p_size > 48").select(size.alias("value"), F.concat(F.lit("tp_"), (key % 50).cast("string")).alias("place_id"))
    known = known.union(part.where("p_size < 12").select(own, F.concat(F.lit("tp_"), (key % 40).cast("string")))).distinct()
    return H.identify(part.select(key.alias("key"), F.array(size, own).alias("values")), known, 1000)


@query("H10_enlist")
def h10_enlist(t: Tables):
    """All parts as rows of which many share a brand and size, or a name, with others, against a registry of some."""
    part, key = t.read("part"), F.col("p_partkey")
    size, name = F.concat("p_brand", F.col("p_size").cast("string")), F.concat(F.lit("n"), (key % 700).cast("string"))
    kind = F.when(F.col("p_size") % 3 > 0, "city").otherwise("region")
    rows = part.select(key.alias("key"), kind.alias("kind"), F.array(size, name).alias("values"))
    known = part.where("p_partkey % 700 < 50").select(name.alias("value"), F.concat(F.lit("tp_"), (key % 700).cast("string")).alias("place_id")).distinct()
    places = known.select("place_id", F.lit("city").alias("kind"))
    detached = part.where("p_partkey % 700 < 5").select(F.concat(F.lit("tp_"), (key % 700).cast("string")).alias("place_id"), size.alias("value"))
    return H.enlist(rows, known, places, detached, 1000)


def registry(t: Tables):
    """Suppliers as places: of each four in a row the last three are merged, one into another."""
    key = F.col("s_suppkey")
    into = F.when(key % 4 != 0, F.concat(F.lit("tp_"), (key - 1).cast("string")))
    kind = F.when(F.col("s_nationkey") % 2 == 0, "city").otherwise("region")
    return t.read("supplier").select(F.concat(F.lit("tp_"), key.cast("string")).alias("place_id"), kind.alias("kind"), into.alias("into"))


@query("H10_resolve", """
    SELECT 'wikidata:Q' || c_custkey AS reference, CASE WHEN s_suppkey IS NOT NULL THEN 'tp_' || (s_suppkey - s_suppkey % 4) END AS place_id FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
    UNION ALL SELECT 'Q' || c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN 'tp_' || (s_suppkey - s_suppkey % 4) END FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
    UNION ALL SELECT 'tp_' || c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN 'tp_' || (s_suppkey - s_suppkey % 4) END FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def h10_resolve(t: Tables):
    key = F.col("c_custkey").cast("string")
    asked = t.read("customer").select(F.explode(F.array(F.concat(F.lit("wikidata:Q"), key), F.concat(F.lit("Q"), key), F.concat(F.lit("tp_"), key))).alias("reference"))
    own = F.col("s_suppkey").cast("string")
    known = t.read("supplier").select(F.concat(F.lit("wikidata:Q"), own).alias("value"), F.concat(F.lit("tp_"), own).alias("place_id"))
    return H.resolve(asked, registry(t), known)


@query("H10_supersede", """
    WITH r AS (SELECT s_suppkey AS k, CASE WHEN s_nationkey % 2 = 0 THEN 'city' ELSE 'region' END AS kind, s_acctbal > 5000 AS due, s_suppkey - s_suppkey % 4 AS head FROM supplier),
    m AS (SELECT k, 'tp_' || (1000000 + row_number() OVER (ORDER BY 'tp_' || k) - 1) AS minted FROM r WHERE k = head AND due AND kind = 'region')
    SELECT 'tp_' || r.k AS place_id, kind, coalesce(minted, CASE WHEN r.k <> head THEN 'tp_' || head END) AS merged_into FROM r LEFT JOIN m ON m.k = r.head
    UNION ALL SELECT minted, 'city', NULL FROM m""")
def h10_supersede(t: Tables):
    changes = t.read("supplier").where("s_acctbal > 5000").select(F.concat(F.lit("tp_"), F.col("s_suppkey").cast("string")).alias("place_id"), F.lit("city").alias("kind"))
    return H.supersede(registry(t), changes, 1000000).withColumnRenamed("into", "merged_into")


@query("H11_municipality_outcomes", """
    WITH m AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'C3-MACHINERY' WHEN 1 THEN 'N' || p_size % 25 WHEN 2 THEN 'R' || p_size % 5 ELSE 'nowhere' END AS claimed, 'C' || p_size % 25 || '-MACHINERY' AS seen FROM part)
    SELECT p_partkey, CASE WHEN p.place_id IS NULL THEN 'unplaceable' WHEN claimed = seen THEN 'in_place' WHEN c.place_id IS NOT NULL THEN 'region' ELSE 'elsewhere' END AS outcome
    FROM m LEFT JOIN places p ON p.place_id = claimed LEFT JOIN closed c ON c.place_id = seen AND c.ancestor_id = claimed AND c.depth > 0""")
def h11(t: Tables):
    n, key = (F.col("p_size") % 25).cast("string"), F.col("p_partkey")
    claimed = F.when(key % 4 == 0, "C3-MACHINERY").when(key % 4 == 1, F.concat(F.lit("N"), n)).when(key % 4 == 2, F.concat(F.lit("R"), (F.col("p_size") % 5).cast("string"))).otherwise("nowhere")
    rows = t.read("part").select("p_partkey", claimed.alias("claimed"), F.concat(F.lit("C"), n, F.lit("-MACHINERY")).alias("seen"))
    known = t.places().select(F.col("place_id").alias("claimed"), F.lit(True).alias("known"))
    above = H.closure(t.places()).where("depth > 0").select(F.col("place_id").alias("seen"), F.col("ancestor_id").alias("claimed"), F.lit(True).alias("above"))
    met = rows.join(known, "claimed", "left").join(above, ["seen", "claimed"], "left")
    outcome = F.when(F.col("known").isNull(), "unplaceable").when(F.col("claimed") == F.col("seen"), "in_place").when(F.col("above"), "region").otherwise("elsewhere")
    return met.select("p_partkey", outcome.alias("outcome"))


@query("H13_rewrite_keys", """
    WITH m AS (SELECT 'N' || n_nationkey AS old, 'Q' || n_nationkey AS new FROM nation WHERE n_nationkey % 2 = 0)
    SELECT coalesce(a.new, place_id) AS place_id, coalesce(b.new, parent_id) AS parent_id, [coalesce(b.new, parent_id), country_code] AS linked
    FROM places LEFT JOIN m a ON place_id = a.old LEFT JOIN m b ON parent_id = b.old WHERE kind = 'city'""")
def h13(t: Tables):
    key = F.col("n_nationkey")
    mapping = t.read("nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("N"), key).alias("old"), F.concat(F.lit("Q"), key).alias("new"))
    rows = t.places().where("kind = 'city'").select("place_id", "parent_id", F.array("parent_id", "country_code").alias("linked"))
    return H.rewrite_keys(rows, mapping, ["place_id", "parent_id"], ["linked"])


@query("J26_declared_reach", """
    WITH d AS (SELECT 'F' || s_suppkey AS feed_id, 'C' || s_nationkey || '-MACHINERY' AS at FROM supplier)
    SELECT DISTINCT feed_id, ancestor_id AS place_id FROM d JOIN closed c ON c.place_id = d.at UNION SELECT feed_id, metro_id FROM d JOIN membership m ON m.place_id = d.at""".replace("at FROM", "spot FROM").replace("d.at", "d.spot"))
def j26(t: Tables):
    declared = t.read("supplier").select(F.concat(F.lit("F"), "s_suppkey").alias("feed_id"), F.concat(F.lit("C"), "s_nationkey", F.lit("-MACHINERY")).alias("place_id"))
    up = declared.join(H.closure(t.places()), "place_id").select("feed_id", F.col("ancestor_id").alias("place_id"))
    return up.union(declared.join(membership(t), "place_id").select("feed_id", "metro_id")).distinct()


# Every line is a stop of its feed, and of the part of the feed that its number in the order names.
SQL["points"] = "SELECT DISTINCT feed_id, l_partkey AS point FROM facts UNION SELECT DISTINCT feed_id || '/' || l_linenumber, l_partkey FROM facts"
SQL["lines"] = "SELECT DISTINCT feed_id, l_partkey // 2 AS line FROM facts UNION SELECT DISTINCT feed_id || '/' || l_linenumber, l_partkey // 2 FROM facts"


def _stops(t: Tables):
    feeds = F.explode(F.array("feed_id", F.concat("feed_id", F.lit("/"), F.col("l_linenumber").cast("string"))))
    return t.facts().select(feeds.alias("feed_id"), F.col("l_partkey").alias("point"))


def lines(t: Tables):
    return _stops(t).select("feed_id", F.floor(F.col("point") / 2).cast("long").alias("line"))


@query("J20_containment", """
    WITH p AS (SELECT a.feed_id AS a, b.feed_id AS b, count(*) AS s FROM points a JOIN points b ON a.point = b.point AND a.feed_id <> b.feed_id GROUP BY ALL),
    r AS (SELECT a.feed_id AS a, b.feed_id AS b, count(*) AS rs FROM lines a JOIN lines b ON a.line = b.line AND a.feed_id <> b.feed_id GROUP BY ALL),
    pn AS (SELECT feed_id, count(*) AS n FROM points GROUP BY ALL), rn AS (SELECT feed_id, count(*) AS n FROM lines GROUP BY ALL),
    j AS (SELECT p.a, p.b, CASE WHEN s >= 0.9 * x.n AND y.n >= 1.5 * x.n AND rs >= 0.9 * z.n THEN 'share' WHEN s >= 0.8 * x.n AND y.n >= 3 * x.n AND rs = z.n AND z.n >= 5 THEN 'routes' END AS rule
          FROM p JOIN r ON p.a = r.a AND p.b = r.b JOIN pn x ON x.feed_id = p.a JOIN pn y ON y.feed_id = p.b JOIN rn z ON z.feed_id = p.a WHERE x.n >= 2)
    SELECT * FROM j WHERE rule IS NOT NULL""")
def j20(t: Tables):
    return O.contained(_stops(t), lines(t), "feed_id", "point", "line")


@query("J21_near_duplicates", """
    WITH c AS (SELECT doc_id, source, lang, sha256(n_chars::VARCHAR) AS head, sha256(text) AS body FROM documents)
    SELECT head, lang, list_sort(list(DISTINCT doc_id)) AS members, list_filter([CASE WHEN count(DISTINCT body) > 1 THEN 'body' END, CASE WHEN count(DISTINCT source) > 1 THEN 'source' END], lambda x: x IS NOT NULL) AS differ
    FROM c GROUP BY head, lang HAVING count(DISTINCT doc_id) > 1""")
def j21(t: Tables):
    docs = t.read("documents").select("doc_id", "source", "lang", F.sha2(F.col("n_chars").cast("string"), 256).alias("head"), F.sha2("text", 256).alias("body"))
    return O.near_duplicates(docs, "doc_id", ["head", "lang"], ["body", "source"])


@query("J22_fold_identical", """
    SELECT doc_id, first_value(doc_id) OVER (PARTITION BY sha256(text) ORDER BY source, doc_id) AS canonical_id, count(*) OVER (PARTITION BY sha256(text)) AS n FROM documents""")
def j22(t: Tables):
    docs = t.read("documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return O.fold_identical(docs, "doc_id", "digest", "source")


SQL["boxes"] = """
    SELECT place_id, feed_id, l_orderkey AS line_id, min(l_partkey) % 3 AS family, min(l_linenumber) AS name, min(l_partkey % 100) / 7000 AS xmin, max(l_partkey % 100) / 7000 AS xmax, l_orderkey % 20 / 1000 AS ymin, l_orderkey % 20 / 1000 AS ymax
    FROM facts GROUP BY place_id, feed_id, l_orderkey"""


def boxes(t: Tables):
    part, at = F.col("l_partkey"), F.first(F.col("l_orderkey") % 20 / 1000)
    return t.facts().groupBy("place_id", "feed_id", F.col("l_orderkey").alias("line_id")).agg(
        (F.min(part) % 3).alias("family"), F.min("l_linenumber").alias("name"), (F.min(part % 100) / 7000).alias("xmin"), (F.max(part % 100) / 7000).alias("xmax"), at.alias("ymin"), at.alias("ymax")
    )


_BESIDE = """
    WITH met AS (SELECT x.place_id, x.family, x.feed_id AS a, y.feed_id AS b, x.line_id AS line_a, y.line_id AS line_b FROM boxes x JOIN boxes y ON x.place_id = y.place_id AND x.family = y.family AND x.name = y.name
        WHERE x.feed_id <> y.feed_id AND x.xmin <= y.xmax + 0.003 AND y.xmin <= x.xmax + 0.003 AND x.ymin <= y.ymax + 0.003 AND y.ymin <= x.ymax + 0.003)"""


@query("J23_lines_beside", _BESIDE + " SELECT place_id, a, b, count(*) AS n FROM met GROUP BY ALL")
def j23(t: Tables):
    return tiles.beside_counts(written(boxes(t)))


@query("J24_overlap_shares", _BESIDE + """, n AS (SELECT place_id, feed_id AS a, count(DISTINCT line_id) AS lines FROM boxes GROUP BY ALL)
    SELECT met.place_id, met.a, b, round(count(DISTINCT line_a) / any_value(lines), 6) AS share FROM met JOIN n ON met.place_id = n.place_id AND met.a = n.a GROUP BY ALL HAVING count(DISTINCT line_a) / any_value(lines) >= 0.1""")
def j24(t: Tables):
    return tiles.beside_counts(written(boxes(t)), each=True, least=0.1).select("place_id", "a", "b", F.round("share", 6).alias("share"))


@query("J25_co_service", """
    WITH n AS (SELECT feed_id, count(*) AS n FROM points GROUP BY ALL), s AS (SELECT a.feed_id AS a, b.feed_id AS b, count(*) AS s FROM points a JOIN points b ON a.point = b.point AND a.feed_id < b.feed_id GROUP BY ALL)
    SELECT a, b, round(s / least(x.n, y.n), 6) AS containment, CASE WHEN x.n = y.n AND s = x.n THEN 'duplicate' ELSE 'genuine' END AS kind
    FROM s JOIN n x ON x.feed_id = a JOIN n y ON y.feed_id = b WHERE s / least(x.n, y.n) >= 0.9""")
def j25(t: Tables):
    return O.co_service(_stops(t), "feed_id", "point").withColumn("containment", F.round("containment", 6))


@query("J33_pairs_within_route", """
    WITH s AS (SELECT l_orderkey, l_linenumber AS i, max(l_partkey) AS p FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, count(*) AS pairs, max(abs(a.p - b.p)) AS span FROM s a JOIN s b USING (l_orderkey) WHERE a.i < b.i GROUP BY l_orderkey""")
def j33(t: Tables):
    stops = t.read("lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("i")).agg(F.max("l_partkey").alias("p"))
    met = stops.join(stops.select("l_orderkey", F.col("i").alias("j"), F.col("p").alias("q")), "l_orderkey").where("i < j")
    return met.groupBy("l_orderkey").agg(F.count("*").alias("pairs"), F.max(F.abs(F.col("p") - F.col("q"))).alias("span"))


@query("W9_pattern_sample", """
    WITH t AS (SELECT l_suppkey % 50 AS route_id, l_orderkey AS trip_id, list(l_partkey ORDER BY l_linenumber, l_partkey) AS pattern FROM lineitem GROUP BY ALL),
    f AS (SELECT *, len(pattern) AS length, row_number() OVER (PARTITION BY route_id, len(pattern) ORDER BY trip_id) AS a, dense_rank() OVER (PARTITION BY route_id ORDER BY len(pattern) DESC) AS b FROM t),
    d AS (SELECT route_id, pattern, length, min(trip_id) AS trip_id FROM f WHERE a <= 8 AND b <= 8 GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY length DESC, trip_id) AS nth FROM d)
    SELECT route_id, nth::INT AS nth, length::INT AS length, trip_id, pattern FROM r WHERE nth <= 8""")
def w9(t: Tables):
    stops = t.read("lineitem").select((F.col("l_suppkey") % 50).alias("route_id"), F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("stop_id"))
    return O.pattern_sample(stops)


@query("W10_legs", """
    WITH s AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY ALL), g AS (SELECT *, lead(p) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS q FROM s)
    SELECT l_orderkey, count(*) AS legs, max(abs(p - q)) AS longest FROM g WHERE q IS NOT NULL GROUP BY l_orderkey""")
def w10(t: Tables):
    from pyspark.sql import Window

    stops = t.read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    legs = stops.withColumn("q", F.lead("p").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber"))).where("q is not null")
    return legs.groupBy("l_orderkey").agg(F.count("*").alias("legs"), F.max(F.abs(F.col("p") - F.col("q"))).alias("longest"))
