"""F4-F7, J13-J19, J34, G, P12, P14, P20: space and tiers."""

from pyspark.sql import functions as F

from spanroute.functions import text as T
from spanroute.operators import planar as P
from spanroute.operators import spatial as S
from spanroute.operators import tiers as D
from spanroute.sinks.scratch import written

from .bindings import SQL, Tables, query
from .matching import coordinates

SQL["areas"] = """
    SELECT 'B' || label AS place_id, label, round(avg(lon)) - 25 - label AS xmin, round(avg(lat)) - 12 - label AS ymin, round(avg(lon)) + 25 AS xmax, round(avg(lat)) + 12 + label AS ymax FROM coordinates GROUP BY label"""


def areas(t: Tables):
    x, y, k = F.round(F.avg("lon")), F.round(F.avg("lat")), F.col("label")
    return coordinates(t).groupBy("label").agg(F.concat(F.lit("B"), k.cast("string")).alias("place_id"), (x - 25 - k).alias("xmin"), (y - 12 - k).alias("ymin"), (x + 25).alias("xmax"), (y + 12 + k).alias("ymax"))


@query("F4_haversine", "SELECT vec_id, round(2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(48.2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.2)) * pow(sin(radians(16.4 - lon) / 2), 2)))), 5) AS km FROM coordinates")
def f4(t: Tables):
    return coordinates(t).select("vec_id", F.round(S.haversine_km(F.col("lon"), F.col("lat"), F.lit(16.4), F.lit(48.2)), 5).alias("km"))


@query("F5_grid_cells", "SELECT floor(lon / 5)::BIGINT AS cx, floor(lat / 5)::BIGINT AS cy, count(*) AS n FROM coordinates GROUP BY ALL")
def f5(t: Tables):
    return coordinates(t).groupBy(S.cell(F.col("lon")).alias("cx"), S.cell(F.col("lat")).alias("cy")).agg(F.count("*").alias("n"))


@query("F6_antimeridian_span", """
    WITH d AS (SELECT DISTINCT label, lon FROM coordinates), g AS (SELECT label, lon AS east, coalesce(lead(lon) OVER (PARTITION BY label ORDER BY lon), min(lon) OVER (PARTITION BY label) + 360) AS nxt FROM d),
    w AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY nxt - east DESC, east) AS nth FROM g)
    SELECT label, round(CASE WHEN nxt >= 180 THEN nxt - 360 ELSE nxt END, 6) AS west, round(east, 6) AS east FROM w WHERE nth = 1""")
def f6(t: Tables):
    return S.widest_gap(coordinates(t), "label", "lon").select("label", F.round("west", 6).alias("west"), F.round("east", 6).alias("east"))


@query("F7_box_tests", "SELECT place_id, xmin <= 10 AND xmax >= 10 AND ymin <= 5 AND ymax >= 5 AS holds, (xmax - xmin) * (ymax - ymin) AS area, xmin <= 20 AND xmax >= -20 AND ymin <= 3 AND ymax >= -3 AS touches FROM areas")
def f7(t: Tables):
    touches = (F.col("xmin") <= 20) & (F.col("xmax") >= -20) & (F.col("ymin") <= 3) & (F.col("ymax") >= -3)
    return areas(t).select("place_id", S.in_box(F.lit(10.0), F.lit(5.0)).alias("holds"), ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"), touches.alias("touches"))


@query("J13_points_in_boxes", "SELECT vec_id, place_id FROM coordinates JOIN areas ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax")
def j13(t: Tables):
    return S.points_in_boxes(coordinates(t).drop("label"), areas(t)).select("vec_id", "place_id")


@query("J13_points_in_polygons")
def j13b(t: Tables):
    hulls = S.hulls(coordinates(t), "label").withColumnRenamed("label", "place")
    return S.points_in_polygons(coordinates(t), hulls).select("vec_id", "place")


_OVER = """
    WITH o AS (SELECT a.place_id AS left_id, b.place_id AS right_id, (least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS shared, (a.xmax - a.xmin) * (a.ymax - a.ymin) AS own
               FROM areas a JOIN areas b ON a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax WHERE a.label % 2 = 0 AND b.label % 2 = 1)"""


def overlapping(t: Tables):
    boxes = areas(t).withColumnRenamed("place_id", "id")
    return S.overlaps(boxes.where("label % 2 = 0").drop("label"), boxes.where("label % 2 = 1").drop("label"))


@query("J14_box_overlaps", _OVER + " SELECT left_id, right_id, round(shared, 6) AS shared FROM o")
def j14(t: Tables):
    return overlapping(t).select("left_id", "right_id", F.round("shared", 6).alias("shared"))


@query("J15_area_share", _OVER + " SELECT left_id, right_id, round(shared / own, 6) AS share FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY shared DESC, right_id) AS nth FROM o WHERE shared / own >= 0.5) WHERE nth = 1")
def j15(t: Tables):
    return S.best_share(overlapping(t), 0.5).withColumn("share", F.round("share", 6))


@query("J16_point_then_overlap", """
    WITH p AS (SELECT label, round(avg(lon)) AS x, round(avg(lat)) AS y FROM coordinates GROUP BY label)
    SELECT p.label, count(*) AS holders, arg_min(place_id, (xmax - xmin) * (ymax - ymin)) AS place_id FROM p JOIN areas a ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax AND p.label <> a.label GROUP BY p.label""")
def j16(t: Tables):
    points = coordinates(t).groupBy(F.col("label").alias("point")).agg(F.round(F.avg("lon")).alias("lon"), F.round(F.avg("lat")).alias("lat"))
    held = S.points_in_boxes(points, areas(t)).where("point <> label")
    size = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return held.groupBy(F.col("point").alias("label")).agg(F.count("*").alias("holders"), F.min_by("place_id", size).alias("place_id"))


@query("J17_runner_up", _OVER + """, b AS (SELECT *, row_number() OVER w AS nth, lead(shared) OVER w AS second FROM o WHERE shared / own >= 0.1 WINDOW w AS (PARTITION BY left_id ORDER BY shared DESC, right_id))
    SELECT left_id, CASE WHEN coalesce(second < 0.97 * shared, true) THEN right_id END AS right_id, round(shared / own, 6) AS share FROM b WHERE nth = 1""")
def j17(t: Tables):
    return S.best_share(overlapping(t), 0.1, 0.97).withColumn("share", F.round("share", 6))


@query("J18_point_and_name", """
    WITH h AS (SELECT vec_id, place_id, count(*) OVER (PARTITION BY vec_id) AS n FROM coordinates c JOIN areas a ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax AND (c.label + c.vec_id) % 4 = a.label % 4)
    SELECT vec_id, place_id FROM h WHERE n = 1""")
def j18(t: Tables):
    from pyspark.sql import Window

    named = coordinates(t).withColumn("name", (F.col("label") + F.col("vec_id")) % 4).drop("label")
    held = S.points_in_boxes(named, areas(t)).where("name = label % 4").withColumn("n", F.count("*").over(Window.partitionBy("vec_id")))
    return held.where("n = 1").select("vec_id", "place_id")


@query("J19_label_point_precedence", """
    WITH h AS (SELECT vec_id, place_id, xmin <= lon AND lon <= xmax AND ymin <= lat AND lat <= ymax AS inside, a.label FROM coordinates c JOIN areas a ON lon BETWEEN xmin - 2 AND xmax + 2 AND lat BETWEEN ymin - 2 AND ymax + 2)
    SELECT vec_id, place_id, inside FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY inside DESC, label % 2, label DESC, place_id) AS nth FROM h) WHERE nth = 1""")
def j19(t: Tables):
    from pyspark.sql import Window

    wide = areas(t).withColumns({"x0": F.col("xmin"), "y0": F.col("ymin"), "x1": F.col("xmax"), "y1": F.col("ymax")})
    wide = wide.withColumns({"xmin": F.col("xmin") - 2, "ymin": F.col("ymin") - 2, "xmax": F.col("xmax") + 2, "ymax": F.col("ymax") + 2})
    held = S.points_in_boxes(coordinates(t).drop("label"), wide)
    inside = F.col("lon").between(F.col("x0"), F.col("x1")) & F.col("lat").between(F.col("y0"), F.col("y1"))
    order = Window.partitionBy("vec_id").orderBy(F.desc("inside"), F.col("label") % 2, F.desc("label"), "place_id")
    return held.withColumn("inside", inside).withColumn("nth", F.row_number().over(order)).where("nth = 1").select("vec_id", "place_id", "inside")


@query("J34_deepest_container", """
    WITH c AS (SELECT DISTINCT floor(lon / 5)::BIGINT AS cx, floor(lat / 5)::BIGINT AS cy FROM coordinates),
    h AS (SELECT cx || ':' || cy AS thing_id, place_id, label FROM c JOIN areas ON cx * 5 >= xmin AND cx * 5 + 5 <= xmax AND cy * 5 >= ymin AND cy * 5 + 5 <= ymax)
    SELECT thing_id, place_id FROM (SELECT *, row_number() OVER (PARTITION BY thing_id ORDER BY label % 3 DESC, CASE label % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END, place_id) AS nth FROM h) WHERE nth = 1""")
def j34(t: Tables):
    cells = coordinates(t).select(S.cell(F.col("lon")).alias("gx"), S.cell(F.col("lat")).alias("gy")).distinct()
    cells = cells.select(F.concat(F.col("gx").cast("string"), F.lit(":"), F.col("gy").cast("string")).alias("thing_id"), (F.col("gx") * 5.0).alias("lon"), (F.col("gy") * 5.0).alias("lat"))
    held = S.points_in_boxes(cells, areas(t)).where("lon + 5 <= xmax and lat + 5 <= ymax").select("thing_id", "place_id")
    kind = F.element_at(F.array(F.lit("city"), F.lit("metro"), F.lit("region"), F.lit("country")), (F.col("label") % 4 + 1).cast("int"))
    return S.deepest(held, areas(t).select("place_id", (F.col("label") % 3).alias("depth"), kind.alias("kind")))


_ROUTES = """
    SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_size % 2 = 0 THEN p_partkey % 14 ELSE p_partkey % 1800 END AS kind, CASE p_partkey % 5 WHEN 0 THEN 'one_city' WHEN 1 THEN 'one_metro' END AS loc,
           p_size % 4 AS regions, CASE WHEN p_partkey % 7 > 0 THEN p_size * 3.0::DOUBLE END AS span, CASE WHEN p_partkey % 11 > 0 THEN 70.0::DOUBLE END AS ref, p_partkey % 13 = 0 AS zone, CASE WHEN p_partkey % 3 > 0 THEN p_size * 0.8::DOUBLE END AS gap FROM part"""
SQL["routes"] = _ROUTES


def routes(t: Tables):
    k, z = F.col("p_partkey"), F.col("p_size")
    return t.read("part").select(
        "p_partkey", F.when(k % 17 != 0, F.when(z % 2 == 0, k % 14).otherwise(k % 1800)).alias("kind"), F.when(k % 5 == 0, "one_city").when(k % 5 == 1, "one_metro").alias("loc"), (z % 4).alias("regions"),
        F.when(k % 7 > 0, z * 3.0).alias("span"), F.when(k % 11 > 0, 70.0).alias("ref"), (k % 13 == 0).alias("zone"), F.when(k % 3 > 0, z * 0.8).alias("gap"),
    )


def decided(t: Tables):
    args = [F.col(c) for c in ("kind", "mode", "loc", "regions", "span", "ref", "zone", "gap")]
    return routes(t).withColumn("mode", T.mode_of(F.col("kind"))).withColumn("d", D.decide(*args))


_DECIDE = """
    WITH r AS (SELECT *, kind // 100 AS family, coalesce(abs(gap - 25) <= 5.0, false) AS close, coalesce(abs(span - ref) <= 0.2 * ref, false) AS near FROM routes),
    d AS (SELECT *, CASE WHEN kind IS NULL THEN ['unknown', '0', 'unknown', 'n']
        WHEN kind IN (101, 102, 103, 105, 114, 202) THEN ['national', '0.95', 'declared', 'n'] WHEN kind = 201 THEN ['international', '0.95', 'declared', 'n']
        WHEN kind IN (106, 109, 204, 208, 701, 903) THEN ['regional', '0.95', 'declared', 'n'] WHEN kind IN (108, 400, 401, 402, 403, 404, 405, 704, 901, 902) THEN ['local', '0.95', 'declared', 'n']
        WHEN kind BETWEEN 1100 AND 1199 OR kind BETWEEN 1500 AND 1799 THEN ['unknown', '0', 'out_of_scope', 'n']
        WHEN NOT (kind IN (0, 1, 2, 3, 4, 5, 6, 7, 11, 12) OR (kind >= 100 AND family IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14))) THEN ['unknown', '0', 'unknown', 'n']
        WHEN loc = 'one_city' THEN ['local', '0.9', 'one_city', 'n'] WHEN loc = 'one_metro' AND (kind IN (2, 12) OR family = 1) THEN ['regional', '0.85', 'metro_rail', 'n'] WHEN loc = 'one_metro' THEN ['local', '0.85', 'one_metro', 'n']
        WHEN zone THEN ['regional', '0.75', CASE WHEN regions < 2 THEN 'regional' ELSE 'zone' END, 'n'] WHEN gap >= 25 THEN ['national', '0.75', 'intercity', CASE WHEN close THEN 'y' ELSE 'n' END]
        WHEN regions < 2 THEN ['regional', '0.75', 'regional', CASE WHEN close THEN 'y' ELSE 'n' END] WHEN span IS NULL OR ref IS NULL THEN ['regional', '0.6', 'regional', CASE WHEN close THEN 'y' ELSE 'n' END]
        WHEN span > ref THEN ['national', '0.75', 'regions_and_span', CASE WHEN close OR near THEN 'y' ELSE 'n' END] ELSE ['regional', '0.75', 'regional', CASE WHEN close OR near THEN 'y' ELSE 'n' END] END AS d FROM r),
    o AS (SELECT p_partkey, span, d[1] AS tier, round(d[2]::DOUBLE * CASE d[4] WHEN 'y' THEN 0.7 ELSE 1 END, 6) AS confidence, d[3] AS rule, d[4] = 'y' AS margin FROM d)"""


@query("P12_tier_decisions", _DECIDE + " SELECT p_partkey, tier, rule FROM o")
def p12(t: Tables):
    return decided(t).select("p_partkey", "d.tier", "d.rule")


@query("P14_margins", _DECIDE + " SELECT p_partkey, confidence, margin, tier = 'unknown' OR confidence < 0.7 OR margin AS review FROM o")
def p14(t: Tables):
    return decided(t).select("p_partkey", F.round("d.confidence", 6).alias("confidence"), "d.margin", D.needs_review(F.col("d")).alias("review"))


@query("P20_area_mismatch", """
    SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'no_qid' WHEN p_retailprice / (900 + p_size) > 1.1 THEN 'larger' WHEN p_retailprice / (900 + p_size) < 0.98 THEN 'smaller' END AS flag FROM part""")
def p20(t: Tables):
    ratio = F.col("p_retailprice") / (900 + F.col("p_size"))
    return t.read("part").select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, "no_qid").when(ratio > 1.1, "larger").when(ratio < 0.98, "smaller").alias("flag"))


@query("E20_country_agreement", """
    WITH o AS (SELECT feed_id, list_sort(list(DISTINCT country_code)) AS seen FROM pairs p JOIN places l ON p.place_id = l.place_id WHERE stops > 10 GROUP BY feed_id),
    d AS (SELECT f.feed_id, CASE WHEN scope = 'domestic' THEN [home] ELSE ['R0', 'R1', 'R2', 'R3', 'R4'] END AS said, coalesce(seen, []) AS seen FROM feeds f LEFT JOIN o ON f.feed_id = o.feed_id)
    SELECT feed_id, CASE WHEN len(said) * len(seen) = 0 THEN 'unknown' WHEN len(list_intersect(said, seen)) = 0 THEN 'different' WHEN len(list_intersect(said, seen)) = len(said) AND len(said) = len(seen) THEN 'same'
        WHEN len(list_intersect(said, seen)) = len(seen) THEN 'within' ELSE 'partial' END AS agreement FROM d""")
def e20(t: Tables):
    seen = t.pairs().where("stops > 10").join(t.places().select("place_id", "country_code"), "place_id").groupBy("feed_id").agg(F.collect_set("country_code").alias("seen"))
    said = F.when(F.col("scope") == "domestic", F.array("home")).otherwise(F.array(*[F.lit(f"R{i}") for i in range(5)]))
    return t.feeds().join(seen, "feed_id", "left").select("feed_id", D.agreement(said, F.col("seen")).alias("agreement"))


@query("G2_hulls")
def g2(t: Tables):
    return S.hulls(coordinates(t), "label")


def polygons(t: Tables):
    return S.hulls(coordinates(t), "label")


@query("F20_ring_areas")
def f20(t: Tables):
    areas_of = polygons(t).select("label", S.ring_area_km2("ring").alias("km2"))
    return areas_of.groupBy("label").agg(F.round(F.sum("km2"), 3).alias("km2"))


@query("G1_points_covered")
def g1(t: Tables):
    return S.points_in_polygons(coordinates(t).withColumnRenamed("label", "own"), polygons(t)).groupBy("label").agg(F.count("*").alias("points"))


@query("G3_simplified_rings")
def g3(t: Tables):
    return polygons(t).select("label", "part", F.size("ring").alias("corners"), F.size(S.simplified(2.0)("ring")).alias("left"))


@query("G4_valid_rings")
def g4(t: Tables):
    return polygons(t).select("label", "part", S.ring_valid("ring").alias("valid"))


@query("G7_shared_areas")
def g7(t: Tables):
    boxes = areas(t).select(F.col("place_id"), "xmin", "ymin", "xmax", "ymax")
    parts = written(polygons(t))
    around = parts.select(F.struct("label", "part").alias("id"), "xmin", "ymin", "xmax", "ymax")
    met = S.overlaps(around, boxes.withColumnRenamed("place_id", "id")).select("left_id.label", "left_id.part", F.col("right_id").alias("place_id"))
    shared = met.join(parts.select("label", "part", "ring"), ["label", "part"]).join(boxes, "place_id")
    shared = shared.select("label", "place_id", S.shared_area("ring", "xmin", "ymin", "xmax", "ymax").alias("shared"))
    return shared.groupBy("label", "place_id").agg(F.round(F.sum("shared"), 6).alias("shared")).where("shared > 0")


@query("G8_points_within")
def g8(t: Tables):
    largest = polygons(t).withColumn("area", S.ring_area_km2("ring")).groupBy("label").agg(F.max_by("ring", F.struct("area", -F.col("part"))).alias("ring"))
    inner = largest.withColumn("p", S.point_within("ring"))
    return inner.select("label", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"), S.covered(F.col("p.x"), F.col("p.y"), F.col("ring")).alias("covered"))


@query("G9_boundary_source", """
    SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN 'own' WHEN p_partkey IS NOT NULL THEN 'lender' WHEN n_nationkey IS NOT NULL THEN 'centre' ELSE 'none' END AS source
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN part ON p_partkey = c_custkey AND p_size > 25 LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3""")
def g9(t: Tables):
    own = t.read("supplier").select(F.col("s_suppkey").alias("c_custkey"), F.lit("own").alias("own"))
    lender = t.read("part").where("p_size > 25").select(F.col("p_partkey").alias("c_custkey"), F.lit("lender").alias("lender"))
    centre = t.read("nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), F.lit("centre").alias("centre"))
    rows = t.read("customer").select("c_custkey", "c_nationkey").join(own, "c_custkey", "left").join(lender, "c_custkey", "left").join(centre, "c_nationkey", "left")
    return rows.select("c_custkey", F.coalesce("own", "lender", "centre", F.lit("none")).alias("source"))


@query("G10_settled_centres")
def g10(t: Tables):
    centres = coordinates(t).groupBy("label").agg(F.round(F.avg("lon"), 3).alias("lon"), F.round(F.avg("lat"), 3).alias("lat"))
    met = centres.join(polygons(t).select("label", "ring"), "label")
    met = met.withColumn("in", S.covered(F.col("lon"), F.col("lat"), F.col("ring"))).groupBy("label", "lon", "lat").agg(F.max("in").alias("kept"))
    kept = F.col("kept")
    return met.select("label", F.when(kept, F.col("lon")).alias("lon"), F.when(kept, F.col("lat")).alias("lat"))


@query("G11_border_clear", """
    SELECT vec_id, min(a.label) AS owner FROM coordinates c JOIN areas a ON lon BETWEEN xmin - 0.2 AND xmax + 0.2 AND lat BETWEEN ymin - 0.2 AND ymax + 0.2 GROUP BY vec_id HAVING count(DISTINCT a.label) = 1""")
def g11(t: Tables):
    return S.border_clear(coordinates(t).drop("label"), areas(t).withColumnRenamed("label", "owner"), "owner", "vec_id", 0.2)


@query("H12_core_selection", _OVER + """, z AS (SELECT place_id, (xmax - xmin) * (ymax - ymin) AS area FROM areas)
    SELECT right_id, arg_min(left_id, (-own, left_id)) AS core FROM o JOIN z ON right_id = place_id WHERE shared >= 0.5 * own AND own <= area + 100 GROUP BY right_id""")
def h12(t: Tables):
    sizes = areas(t).select(F.col("place_id").alias("id"), ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) + 100).alias("area"))
    return S.core_of(overlapping(t), sizes)


# Shapes of suppliers in whole degrees, and stops of customers in hundredths of one.
SQL["blocks"] = """
    SELECT s_suppkey, s_nationkey, s_suppkey * 37 % 290 - 150.0::DOUBLE AS x, s_suppkey * 53 % 120 - 60.0::DOUBLE AS y, 5.0::DOUBLE + s_suppkey % 20 AS w, 4.0::DOUBLE + s_suppkey % 11 AS h FROM supplier"""
SQL["stops_at"] = "SELECT c_custkey, (c_custkey * 7919 % 36000) / 100.0::DOUBLE - 180 AS lon, (c_custkey * 104729 % 16000) / 100.0::DOUBLE - 80 AS lat FROM customer"


def blocks(t: Tables):
    k = F.col("s_suppkey")
    return t.read("supplier").select("s_suppkey", "s_nationkey", (k * 37 % 290 - 150.0).alias("x"), (k * 53 % 120 - 60.0).alias("y"), (5.0 + k % 20).alias("w"), (4.0 + k % 11).alias("h"))


def stops_at(t: Tables):
    k = F.col("c_custkey")
    return t.read("customer").select("c_custkey", ((k * 7919 % 36000) / 100.0 - 180).alias("lon"), ((k * 104729 % 16000) / 100.0 - 80).alias("lat"))


def _box(x, y, w, h):
    return F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))])


def shapes(t: Tables):
    """A block with a hole and, for each third supplier, a second part beside it, as well-known binary."""
    x, y, w, h = (F.col(c) for c in "xywh")
    first = F.array(_box(x, y, w, h), _box(x + 1, y + 1, w - 3, h - 3))
    second = F.array(_box(x + w + 1, y, F.lit(2.0), F.lit(2.0)))
    parts = F.when(F.col("s_suppkey") % 3 == 0, F.array(first, second)).otherwise(F.array(first))
    return blocks(t).select("s_suppkey", "s_nationkey", P.encoded(parts).alias("geometry"))


def plain_blocks(t: Tables):
    x, y, w, h = (F.col(c) for c in "xywh")
    return blocks(t).select("s_suppkey", "s_nationkey", P.encoded(F.array(F.array(_box(x, y, w, h)))).alias("geometry"))


@query("J13_points_in_shapes", """
    SELECT c_custkey, s_suppkey FROM stops_at JOIN blocks ON
        (lon BETWEEN x AND x + w AND lat BETWEEN y AND y + h AND NOT (lon > x + 1 AND lon < x + w - 2 AND lat > y + 1 AND lat < y + h - 2))
        OR (s_suppkey % 3 = 0 AND lon BETWEEN x + w + 1 AND x + w + 3 AND lat BETWEEN y AND y + 2)""")
def j13c(t: Tables):
    return P.covers(stops_at(t), written(shapes(t)), "c_custkey", "s_suppkey")


@query("G4_repaired_shapes", """
    SELECT s_suppkey, s_suppkey % 3 = 0 AS valid, round(CASE WHEN s_suppkey % 3 = 0 THEN w * h ELSE w * h / 2 END, 6) AS area FROM blocks""")
def g4b(t: Tables):
    """A block, or a bow-tie over it, which is to become two triangles."""
    x, y, w, h = (F.col(c) for c in "xywh")
    bow = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, y), (x + w, y + h), (x + w, y), (x, y + h))])
    made = written(blocks(t).select("s_suppkey", P.encoded(F.array(F.array(F.when(F.col("s_suppkey") % 3 == 0, _box(x, y, w, h)).otherwise(bow)))).alias("geometry")))
    done = P.layered(P.repaired(made, "s_suppkey"), "s_suppkey")
    return P.check(made, "s_suppkey").join(P.areas(done, "s_suppkey"), "s_suppkey").select("s_suppkey", "valid", F.round("area", 6).alias("area"))


SQL["members"] = "SELECT s_nationkey, s_suppkey, s_suppkey * 37 % 40 AS x0, s_suppkey * 53 % 25 AS y0, s_suppkey * 37 % 40 + 5 + s_suppkey % 20 AS x1, s_suppkey * 53 % 25 + 4 + s_suppkey % 11 AS y1 FROM supplier"


def members(t: Tables):
    """A block for each member of a nation, of which many overlap."""
    k = F.col("s_suppkey")
    box = _box((k * 37 % 40).cast("double"), (k * 53 % 25).cast("double"), (5 + k % 20).cast("double"), (4 + k % 11).cast("double"))
    return written(t.read("supplier").select("s_nationkey", "s_suppkey", P.encoded(F.array(F.array(box))).alias("geometry")))


@query("G5_unions", """
    WITH xs AS (SELECT s_nationkey, v AS x, lead(v) OVER (PARTITION BY s_nationkey ORDER BY v) AS nx FROM (SELECT s_nationkey, x0 AS v FROM members UNION SELECT s_nationkey, x1 FROM members)),
    ys AS (SELECT s_nationkey, v AS y, lead(v) OVER (PARTITION BY s_nationkey ORDER BY v) AS ny FROM (SELECT s_nationkey, y0 AS v FROM members UNION SELECT s_nationkey, y1 FROM members)),
    held AS (SELECT DISTINCT s_nationkey, x, nx, y, ny FROM xs JOIN ys USING (s_nationkey) JOIN members USING (s_nationkey) WHERE x0 <= x AND nx <= x1 AND y0 <= y AND ny <= y1)
    SELECT s_nationkey, round(sum((nx - x) * (ny - y))::DOUBLE, 6) AS area FROM held GROUP BY s_nationkey""")
def g5(t: Tables):
    edge = P.union(members(t), "s_nationkey")
    return P.areas(edge, "s_nationkey").select("s_nationkey", F.round("area", 6).alias("area"))


@query("G5_member_unions")
def g5b(t: Tables):
    """Unions of members, holes filled but around other nations' cities; a city stands in the middle of each member's block."""
    k = F.col("s_suppkey")
    cities = t.read("supplier").select(F.col("s_suppkey").alias("city"), (k * 37 % 40 + (5 + k % 20) / 2).alias("lon"), (k * 53 % 25 + (4 + k % 11) / 2).alias("lat"), F.col("s_nationkey").alias("owner"))
    whole = written(P.member_union(members(t), cities, "s_nationkey"))
    rings = P.rings_of(whole, "s_nationkey", "geometry").groupBy("s_nationkey").agg(F.count_if(F.col("ring") == 0).alias("parts"), F.count_if(F.col("ring") > 0).alias("holes"))
    return P.areas(P.layered(whole, "s_nationkey"), "s_nationkey").join(rings, "s_nationkey").select("s_nationkey", F.round("area", 6).alias("area"), "parts", "holes")


@query("G6_cores", "SELECT s_suppkey, round(CASE WHEN least(w, h) > 5 THEN (w - 5) * (h - 5) ELSE w * h END, 6) AS area FROM blocks")
def g6(t: Tables):
    return P.areas(P.core(plain_blocks(t), "s_suppkey", 2.5), "s_suppkey").select("s_suppkey", F.round("area", 6).alias("area"))


@query("G6_grown", "SELECT s_suppkey, round(w * h + w + h + 8 * 0.25 * sin(pi() / 8), 5) AS area FROM blocks")
def g6b(t: Tables):
    return P.areas(P.grown(plain_blocks(t), "s_suppkey", 0.5), "s_suppkey").select("s_suppkey", F.round("area", 5).alias("area"))


@query("G11_clear_of_borders", """
    WITH d AS (SELECT c_custkey, s_nationkey, greatest(x - lon, 0, lon - x - w) * 6371.0088 * pi() / 180 * cos(radians(lat)) AS dx, greatest(y - lat, 0, lat - y - h) * 6371.0088 * pi() / 180 AS dy FROM stops_at CROSS JOIN blocks)
    SELECT c_custkey, min(s_nationkey) AS s_nationkey FROM d WHERE sqrt(dx * dx + dy * dy) <= 40 GROUP BY c_custkey HAVING count(DISTINCT s_nationkey) = 1""")
def g11b(t: Tables):
    return P.clear(stops_at(t), written(plain_blocks(t)), "s_nationkey", "c_custkey", "s_suppkey", 40.0)
