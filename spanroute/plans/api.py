"""O, P5-P7, Q, K8, K10: what readers ask."""

from pyspark.sql import functions as F

from spanroute.operators import query_api as A
from spanroute.operators import ranking as R

from .bindings import SQL, Tables, query
from .space import areas
from .structure import membership
from .time import calendar

SQL["summary"] = "SELECT p.place_id, name, kind, parent_id, count(DISTINCT feed_id) AS feeds, count(feed_id) > 0 AS served FROM places p LEFT JOIN edges e ON p.place_id = e.place_id GROUP BY ALL"


def summary(t: Tables):
    counts = t.edges().groupBy("place_id").agg(F.countDistinct("feed_id").alias("feeds"))
    rows = t.places().join(counts, "place_id", "left")
    return rows.select("place_id", "name", "kind", "parent_id", F.coalesce("feeds", F.lit(0)).alias("feeds"), F.col("feeds").isNotNull().alias("served"))


@query("O1_page", "SELECT place_id, name, feeds, (SELECT count(*) FROM summary) AS total FROM summary ORDER BY feeds DESC NULLS LAST, place_id LIMIT 20 OFFSET 10")
def o1(t: Tables):
    return A.page(summary(t).select("place_id", "name", "feeds"), "feeds", "place_id", True, 10, 20)


_RANK = "CASE WHEN lower(name) = 'nation_1' THEN 0 WHEN lower(name) LIKE 'nation\\_1%' ESCAPE '\\' OR contains(lower(name), ' nation_1') THEN 2 WHEN contains(lower(name), 'nation_1') THEN 3 END"


@query("O2_search", f"SELECT place_id, name, rank FROM (SELECT *, {_RANK} AS rank FROM summary) WHERE rank IS NOT NULL ORDER BY rank, served DESC, feeds DESC, name, place_id LIMIT 25")
def o2(t: Tables):
    return A.search(summary(t), "NATION_1", 25).select("place_id", "name", "rank")


@query("O3_truncation", "SELECT feed_id, place_id, stops, true AS more FROM pairs ORDER BY stops DESC, feed_id, place_id LIMIT 100")
def o3(t: Tables):
    return A.truncated(t.pairs().select("feed_id", "place_id", "stops"), 100, [F.desc("stops"), F.col("feed_id"), F.col("place_id")])


@query("O4_top_k", "SELECT feed_id, place_id, stops FROM pairs ORDER BY stops DESC, feed_id, place_id LIMIT 8")
def o4(t: Tables):
    return t.pairs().select("feed_id", "place_id", "stops").orderBy(F.desc("stops"), "feed_id", "place_id").limit(8)


@query("O5_publish_order", "SELECT place_id, feed_id, tier, row_number() OVER (PARTITION BY place_id ORDER BY feed_id, tier) AS nth FROM edges")
def o5(t: Tables):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("place_id").orderBy("feed_id", "tier"))
    return t.edges().select("place_id", "feed_id", "tier", nth.cast("long").alias("nth"))


@query("O6_tree_level", "SELECT p.place_id, p.name, count(c.place_id) AS children FROM places p LEFT JOIN places c ON c.parent_id = p.place_id WHERE p.parent_id = 'R1' GROUP BY ALL ORDER BY name, place_id LIMIT 4")
def o6(t: Tables):
    return A.tree_level(t.places(), "R1", 4)


@query("P5_filtered_places", "SELECT place_id, name FROM places WHERE kind IN ('city', 'region') AND parent_id = 'N3' AND contains(lower(name), 'build') AND place_id IN (SELECT place_id FROM edges)")
def p5(t: Tables):
    return A.filter_places(t.places(), ["city", "region"], "N3", text="Build", served=t.edges()).select("place_id", "name")


@query("P6_bounded_slice", "SELECT place_id, name FROM places WHERE kind = 'city' AND parent_id = 'N7'")
def p6(t: Tables):
    return A.filter_places(t.places(), ["city"], "N7").select("place_id", "name")


@query("P7_level_view", """
    SELECT feed_id, e.place_id, tier FROM edges e JOIN places p ON e.place_id = p.place_id JOIN feeds f USING (feed_id) WHERE tier = 'international' AND home <> country_code""")
def p7(t: Tables):
    rows = t.edges().join(t.places().select("place_id", "kind", "country_code"), "place_id").join(t.feeds().select("feed_id", "home"), "feed_id")
    rows = rows.withColumn("category", R.category(F.col("tier"))).withColumn("cross_border", F.col("home") != F.col("country_code"))
    return A.level_view(rows, "international").select("feed_id", "place_id", "tier")


@query("Q1_builds", "SELECT build, count(DISTINCT feed_id) AS feeds, count(DISTINCT place_id) AS places, count(*) AS lines FROM facts GROUP BY build")
def q1(t: Tables):
    return t.facts().groupBy("build").agg(F.countDistinct("feed_id").alias("feeds"), F.countDistinct("place_id").alias("places"), F.count("*").alias("lines"))


@query("Q2_places_slice", "SELECT place_id FROM areas WHERE xmax >= -10 AND xmin <= 10 AND ymax >= -5 AND ymin <= 5")
def q2(t: Tables):
    return A.filter_places(areas(t).withColumn("kind", F.lit("region")), ["region"], bbox=(-10, -5, 10, 5)).select("place_id")


@query("Q3_places_table", "SELECT place_id, name, kind, feeds FROM summary ORDER BY name, place_id LIMIT 30")
def q3(t: Tables):
    return A.page(summary(t), "name", "place_id", limit=30).select("place_id", "name", "kind", "feeds")


@query("Q4_search", "SELECT place_id, name FROM summary WHERE contains(lower(name), 'auto') ORDER BY CASE WHEN lower(name) = 'auto' THEN 0 WHEN starts_with(lower(name), 'auto') OR contains(lower(name), ' auto') THEN 2 ELSE 3 END, served DESC, feeds DESC, name, place_id LIMIT 10")
def q4(t: Tables):
    return A.search(summary(t), "Auto", 10).select("place_id", "name")


@query("Q5_place_records", """
    SELECT p.place_id, name, kind, coalesce(a.up, []) AS ancestors, coalesce(m.metros, []) AS metros, coalesce(e.n, 0) AS feeds FROM places p
    LEFT JOIN (SELECT place_id, list(ancestor_id ORDER BY depth DESC) AS up FROM closed WHERE depth > 0 GROUP BY place_id) a ON a.place_id = p.place_id
    LEFT JOIN (SELECT place_id, list(metro_id) AS metros FROM membership GROUP BY place_id) m ON m.place_id = p.place_id
    LEFT JOIN (SELECT place_id, count(DISTINCT feed_id) AS n FROM edges GROUP BY place_id) e ON e.place_id = p.place_id""")
def q5(t: Tables):
    return A.place_record(t.places(), membership(t), t.edges())


@query("Q6_tree", "SELECT p.place_id, p.name, count(c.place_id) AS children FROM places p LEFT JOIN places c ON c.parent_id = p.place_id WHERE p.parent_id IS NULL GROUP BY ALL ORDER BY name, place_id LIMIT 50")
def q6(t: Tables):
    return A.tree_level(t.places(), None, 50)


@query("Q7_feeds_table", """
    SELECT f.feed_id, f.name, count(DISTINCT place_id) AS places, count(*) FILTER (WHERE tier = 'local') AS n_local, count(*) FILTER (WHERE tier = 'national') AS n_national FROM feeds f LEFT JOIN edges e ON e.feed_id = f.feed_id GROUP BY ALL""")
def q7(t: Tables):
    return A.feeds_table(t.feeds().select("feed_id", "name"), t.edges(), ["local", "national"])


@query("Q8_feed_record", "SELECT f.feed_id, f.name, f.home, list_sort(list('S' || substr(f.feed_id, 2))) AS services, any_value(trips) AS trips FROM feeds f JOIN calendar c ON c.service_id = 'S' || substr(f.feed_id, 2) WHERE f.feed_id = 'F7' GROUP BY ALL")
def q8(t: Tables):
    own = calendar(t).select("service_id", "trips", F.concat(F.lit("F"), F.substring("service_id", 2, 20)).alias("feed_id"))
    rows = t.feeds().where("feed_id = 'F7'").join(own, "feed_id")
    return rows.groupBy("feed_id", "name", "home").agg(F.array_sort(F.collect_list("service_id")).alias("services"), F.any_value("trips").alias("trips"))


@query("Q9_edges_of_feed", "SELECT e.place_id, p.name, tier FROM edges e JOIN places p ON e.place_id = p.place_id WHERE feed_id = 'F12'")
def q9(t: Tables):
    return t.edges().where("feed_id = 'F12'").join(t.places().select("place_id", "name"), "place_id").select("place_id", "name", "tier")


@query("Q10_merged_catalogue", "SELECT e.feed_id, e.place_id, e.tier, e.build_id FROM build_edges e JOIN won w ON e.feed_id = w.feed_id AND e.build_id = w.build_id")
def q10(t: Tables):
    from spanroute.operators.merge import merge_edges

    from .snapshots import build_edges, won

    return merge_edges(build_edges(t), won(t)).select("feed_id", "place_id", "tier", "build_id")


@query("Q11_release_totals", """
    SELECT build, tier, count(DISTINCT feed_id) AS feeds, count(DISTINCT place_id) AS places FROM facts GROUP BY build, tier""")
def q11(t: Tables):
    return t.facts().groupBy("build", "tier").agg(F.countDistinct("feed_id").alias("feeds"), F.countDistinct("place_id").alias("places"))


@query("Q12_statistics", "SELECT home, scope, count(*) AS feeds, count(*) FILTER (WHERE scope = 'domestic') AS domestic, median(n) AS median_places FROM feeds f JOIN (SELECT feed_id, count(DISTINCT place_id) AS n FROM edges GROUP BY feed_id) e USING (feed_id) GROUP BY ALL")
def q12(t: Tables):
    counts = t.edges().groupBy("feed_id").agg(F.countDistinct("place_id").alias("n"))
    return t.feeds().join(counts, "feed_id").groupBy("home", "scope").agg(F.count("*").alias("feeds"), F.count_if(F.col("scope") == "domestic").alias("domestic"), F.median("n").alias("median_places"))


@query("K8_features")
def k8(t: Tables):
    return A.feature(areas(t), ["place_id", "label"])


@query("K10_map_layer", "SELECT a.place_id, xmin, ymin, xmax, ymax, count(vec_id) > 0 AS served, count(vec_id) AS n FROM areas a LEFT JOIN coordinates c ON c.label = a.label GROUP BY ALL")
def k10(t: Tables):
    from .matching import coordinates

    counts = coordinates(t).groupBy("label").agg(F.count("*").alias("n"))
    rows = areas(t).join(counts, "label", "left")
    return rows.select("place_id", "xmin", "ymin", "xmax", "ymax", F.col("n").isNotNull().alias("served"), F.coalesce("n", F.lit(0)).alias("n"))
