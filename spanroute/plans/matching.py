"""P, F and J1-J10: URLs, names and entity resolution."""

from pyspark.sql import functions as F

from spanroute.functions import text as T
from spanroute.operators import matching as M

from .bindings import SQL, Tables, query

_URL = r"""
    SELECT page_id, url, CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?[^/?#@:]+(:[0-9]*)?([/?#]|$)') THEN url END AS clean,
           regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(.*)$', 2) AS authority, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(.*)$', 3) AS path,
           regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(.*)$', 4) AS tail FROM pages"""
SQL["urls"] = _URL
SQL["records"] = r"""
    SELECT page_id, page_id % 2 = 0 AS is_a, page_id % 4 <> 2 AS is_b, clean, nullif(lower(regexp_replace(regexp_replace(authority, '^.*@', ''), ':[0-9]*$', '')), '') AS host,
           'https://' || lower(authority) || regexp_replace(path, '/$', '') || tail AS form,
           'https://' || lower(authority) || regexp_replace(path, '/$', '') AS bare, CASE WHEN page_id % 4 < 2 THEN list_sort(list_distinct(regexp_extract_all(lower(p_name || ' ' || p_brand || ' ' || p_size), '[\p{L}\p{N}]+'))) ELSE [page_id::VARCHAR, 'name'] END AS tokens,
           nullif(lower(string_split(rtrim(path, '/'), '/')[-1]), '') AS file
    FROM urls u JOIN part ON p_partkey = u.page_id // 2"""
SQL["coordinates"] = """
    SELECT vec_id, label, greatest(-180.0, least(179.9999, embedding[1]::DOUBLE * 300)) AS lon, greatest(-90.0, least(89.9999, embedding[2]::DOUBLE * 150)) AS lat FROM embeddings"""


def coordinates(t: Tables):
    at = F.col("embedding")
    return t.read("embeddings").select(
        "vec_id", "label", F.greatest(F.lit(-180.0), F.least(F.lit(179.9999), at[0].cast("double") * 300)).alias("lon"), F.greatest(F.lit(-90.0), F.least(F.lit(89.9999), at[1].cast("double") * 150)).alias("lat")
    )


def records(t: Tables):
    pages = t.read("pages").select("page_id", "url").withColumn("half", F.floor(F.col("page_id") / 2))
    named = t.read("part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("named"))
    joined = pages.join(named, F.col("half") == F.col("p_partkey"))
    form = T.match_url(F.col("url"))
    own = F.array(F.col("page_id").cast("string"), F.lit("name"))
    return joined.select(
        "page_id", (F.col("page_id") % 2 == 0).alias("is_a"), (F.col("page_id") % 4 != 2).alias("is_b"), T.identity_url(F.col("url")).alias("clean"), T.host_of(F.col("url")).alias("host"), form.alias("form"),
        F.regexp_replace(form, "[?#].*$", "").alias("bare"), F.when(F.col("page_id") % 4 < 2, F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("named"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))))).otherwise(own).alias("tokens"),
        T.last_segment(F.col("url")).alias("file"),
    )


def sides(t: Tables):
    # Catalogue B has moved each fifth record: its current key differs, a past one doesn't.
    both = records(t).withColumn("past", F.col("bare"))
    moved = F.when(F.col("page_id") % 5 == 0, F.concat("bare", F.lit("?new"))).otherwise(F.col("bare"))
    return both.where("is_a").withColumnRenamed("page_id", "a_id"), both.where("is_b").withColumn("bare", moved).withColumnRenamed("page_id", "b_id")


@query("P1_identity_url", "SELECT page_id, clean FROM urls")
def p1(t: Tables):
    return t.read("pages").select("page_id", T.identity_url(F.col("url")).alias("clean"))


@query("P2_match_url", "SELECT page_id, 'https://' || lower(authority) || regexp_replace(path, '/$', '') || tail AS form FROM urls")
def p2(t: Tables):
    return t.read("pages").select("page_id", T.match_url(F.col("url")).alias("form"))


@query("P3_host_and_file", "SELECT page_id, lower(authority) AS host, nullif(lower(string_split(rtrim(path, '/'), '/')[-1]), '') AS file FROM urls")
def p3(t: Tables):
    return t.read("pages").select("page_id", T.host_of(F.col("url")).alias("host"), T.last_segment(F.col("url")).alias("file"))


@query("P4_scope_claims", "SELECT page_id, path LIKE '/en/%' OR path = '/en' AS claimed FROM urls")
def p4(t: Tables):
    url = F.col("url")
    scope = F.concat(F.regexp_extract(url, T.SHAPE, 1), F.lit("://"), F.upper(F.regexp_extract(url, T.SHAPE, 2)), F.lit("/en/"))
    return t.read("pages").select("page_id", T.claims(scope, url).alias("claimed"))


@query("P8_note_names", r"SELECT p_partkey, CASE WHEN regexp_matches(p_name, '\b(red|cold)\b') THEN nullif(p_brand, 'Brand#2') ELSE p_name END AS name FROM part")
def p8(t: Tables):
    return t.read("part").select("p_partkey", F.when(F.col("p_name").rlike(r"\b(red|cold)\b"), F.nullif("p_brand", F.lit("Brand#2"))).otherwise(F.col("p_name")).alias("name"))


_REASON = "CASE event_id % 9 WHEN 0 THEN 'HTTP 404 for it' WHEN 1 THEN 'HTTP 503' WHEN 2 THEN 'read timed out' WHEN 3 THEN 'TLS certificate' WHEN 4 THEN '' WHEN 5 THEN 'not a zip file' WHEN 6 THEN 'HTTP 418' WHEN 7 THEN 'getaddrinfo failed' ELSE event_type END"


@query("P9_failure_class", f"""
    SELECT event_id, CASE WHEN r = '' THEN NULL WHEN r LIKE 'HTTP 404%' THEN '404' WHEN r LIKE 'HTTP 5%' THEN '5xx' WHEN r LIKE 'HTTP%' THEN 'other_http' WHEN r LIKE '%timed out%' THEN 'timeout'
        WHEN r LIKE '%TLS%' THEN 'tls' WHEN r LIKE '%zip%' THEN 'not-an-archive' WHEN r LIKE '%getaddrinfo%' THEN 'dns' ELSE 'other' END AS cause FROM (SELECT event_id, {_REASON} AS r FROM events)""")
def p9(t: Tables):
    return t.read("events").select("event_id", T.failure_class(F.expr(_REASON)).alias("cause"))


@query("P10_redistribution", """
    SELECT doc_id, CASE WHEN q = 'yes' THEN true WHEN q = 'No ' THEN false WHEN source IN ('src1', 'src2') THEN true END AS allowed
    FROM (SELECT d.doc_id, source, CASE quality WHEN 1 THEN 'yes' WHEN 0 THEN 'No ' END AS q FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def p10(t: Tables):
    joined = t.read("documents").select("doc_id", "source").join(t.read("labels").select("doc_id", "quality"), "doc_id", "left")
    said = F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "No ")
    spdx = F.when(F.col("source") == "src1", "MIT").when(F.col("source") == "src2", "CC0-1.0").otherwise("GPL-3.0-only")
    return joined.select("doc_id", T.redistribution(said, spdx).alias("allowed"))


@query("P11_sanitise", "SELECT lang, count(*) AS rows, count(CASE WHEN allowed IS NOT false THEN text END) AS kept FROM licensed GROUP BY lang")
def p11(t: Tables):
    from .aggregates import licensed

    clean = licensed(t).withColumn("text", F.when(~F.coalesce(~F.col("allowed"), F.lit(False)), F.col("text")))
    return clean.groupBy("lang").agg(F.count("*").alias("rows"), F.count("text").alias("kept"))


@query("P13_modes", """
    SELECT p_partkey, CASE WHEN k IN (0, 5) THEN 'tram' WHEN k = 1 OR k BETWEEN 400 AND 404 THEN 'subway' WHEN k IN (2, 12) OR k BETWEEN 100 AND 199 THEN 'rail' WHEN k IN (3, 11) OR k BETWEEN 200 AND 299 OR k BETWEEN 700 AND 899 THEN 'bus' WHEN k = 4 THEN 'ferry' ELSE 'other' END AS mode
    FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_partkey % 14 ELSE 100 * (p_partkey % 9) + p_size % 30 END AS k FROM part)""")
def p13(t: Tables):
    kind = F.when(F.col("p_size") % 2 == 0, F.col("p_partkey") % 14).otherwise(100 * (F.col("p_partkey") % 9) + F.col("p_size") % 30)
    return t.read("part").select("p_partkey", T.mode_of(kind).alias("mode"))


@query("F1_name_tokens", r"SELECT s_suppkey, list_sort(list_distinct(list_filter(regexp_extract_all(lower(s_name || ' Inc'), '[\p{L}\p{N}]+'), lambda x: NOT list_contains(['inc', 'ltd', 'co'], x)))) AS tokens FROM supplier")
def f1(t: Tables):
    return t.read("supplier").select("s_suppkey", T.name_tokens(F.concat("s_name", F.lit(" Inc"))).alias("tokens"))


@query("F1_folded_tokens")
def f1b(t: Tables):
    return t.read("documents").select("doc_id", T.folded_tokens(F.col("text")).alias("tokens"))


@query("F2_name_key", r"SELECT c_custkey, regexp_replace(trim(regexp_replace(lower('City of ' || c_name), '[^\p{L}\p{N}]+', ' ', 'g')), '^city of | city$', '', 'g') AS key FROM customer")
def f2(t: Tables):
    return t.read("customer").select("c_custkey", T.name_key(F.concat(F.lit("City of "), "c_name")).alias("key"))


def geohash_sql(p: int) -> str:
    n, m = (5 * p + 1) // 2, 5 * p // 2
    chars = []
    for c in range(p):
        bits = []
        for b in range(5):
            k = 5 * c + b
            axis, at = ("x", n - 1 - k // 2) if k % 2 == 0 else ("y", m - 1 - k // 2)
            bits.append(f"((({axis} >> {at}) & 1) << {4 - b})")
        chars.append(f"'{T.BASE32}'[({' + '.join(bits)}) + 1]")
    return f"SELECT vec_id, label, lon, lat, {' || '.join(chars)} AS hash FROM (SELECT *, floor((lon + 180) / 360 * {1 << n})::BIGINT AS x, floor((lat + 90) / 180 * {1 << m})::BIGINT AS y FROM coordinates)"


SQL["hashed"] = geohash_sql(4)


@query("F3_geohash", "SELECT vec_id, hash FROM hashed")
def f3(t: Tables):
    return coordinates(t).select("vec_id", T.geohash(F.col("lat"), F.col("lon"), 4).alias("hash"))


@query("F3_geohash_box", "SELECT vec_id, hash, floor((lon + 180) / 0.3515625) * 0.3515625 - 180 AS xmin, floor((lat + 90) / 0.17578125) * 0.17578125 - 90 AS ymin FROM hashed")
def f3b(t: Tables):
    hashed = coordinates(t).select("vec_id", T.geohash(F.col("lat"), F.col("lon"), 4).alias("hash"))
    box = T.geohash_box(F.col("hash"))
    return hashed.select("vec_id", "hash", box["xmin"].alias("xmin"), box["ymin"].alias("ymin"))


@query("F8_minted_ids", "SELECT s_suppkey, 'f-mdb-' || regexp_replace(lower(s_name), '[^a-z0-9~.]+', '-', 'g') AS id FROM supplier")
def f8(t: Tables):
    return t.read("supplier").select("s_suppkey", T.minted_id("mdb", F.col("s_name")).alias("id"))


@query("F9_text_cleaning", r"""
    SELECT conv_id, turn, trim(regexp_replace(text, '[\x00-\x20\x7F]+', ' ', 'g')) AS line, regexp_replace(trim(regexp_replace(text, '[\x00-\x20\x7F]+', ' ', 'g')), '([\\|`*_<>\[\]])', '\\\1', 'g') AS cell FROM conversations""")
def f9(t: Tables):
    return t.read("conversations").select("conv_id", "turn", T.one_line(F.col("text")).alias("line"), T.markdown_cell(F.col("text")).alias("cell"))


@query("F10_lists", "SELECT p_partkey, list_filter(list_transform(string_split(p_type || '| ' || p_brand || '||', '|'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM part")
def f10(t: Tables):
    return t.read("part").select("p_partkey", T.listed(F.concat("p_type", F.lit("| "), "p_brand", F.lit("||")), r"\|").alias("parts"))


@query("F11_valid_ids", r"""
    SELECT page_id, coalesce(NOT regexp_matches(id, '[\x00-\x1F\x7F/\\]') AND id <> '' AND id NOT IN ('.', '..') AND strlen(id) <= 30, false) AS valid
    FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '..' WHEN 2 THEN regexp_replace(url, '[/:]', '', 'g') WHEN 3 THEN url END AS id FROM pages)""")
def f11(t: Tables):
    n = F.col("page_id") % 5
    raw = F.when(n == 0, "").when(n == 1, "..").when(n == 2, F.regexp_replace("url", "[/:]", "")).when(n == 3, F.col("url"))
    return t.read("pages").select("page_id", T.valid_id(raw, 30).alias("valid"))


@query("F12_date_text", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate::DATE END AS day, year(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate::DATE END)::INT AS year FROM orders""")
def f12(t: Tables):
    raw = F.date_format("o_orderdate", "yyyyMMdd")
    bad = F.when(F.col("o_orderkey") % 8 == 0, F.concat(F.lit("2001"), F.lit("1399"))).when(F.col("o_orderkey") % 4 == 0, F.concat(raw, F.lit("x"))).otherwise(raw)
    days = t.read("orders").select("o_orderkey", T.day_of_text(bad).alias("day"))
    return days.withColumn("year", F.year("day"))


@query("F14_json_extract", "SELECT event_id, (props ->> '$.k')::INT AS k FROM events")
def f14(t: Tables):
    return t.read("events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("F18_line_name", r"SELECT p_partkey, nullif(lower(regexp_replace(coalesce(nullif(trim(CASE WHEN p_size < 25 THEN ' ' ELSE p_brand END), ''), p_name), '\s+', '', 'g')), '') AS line FROM part")
def f18(t: Tables):
    return t.read("part").select("p_partkey", T.line_name(F.when(F.col("p_size") < 25, " ").otherwise(F.col("p_brand")), F.col("p_name")).alias("line"))


@query("F19_digests", "SELECT r_regionkey, sha256(r_regionkey || '|' || r_name) AS digest, left(sha256(r_name || chr(10) || r_regionkey), 16) AS snapshot FROM region")
def f19(t: Tables):
    key = F.col("r_regionkey").cast("string")
    return t.read("region").select("r_regionkey", F.sha2(F.concat(key, F.lit("|"), "r_name"), 256).alias("digest"), T.snapshot_id(F.col("r_name"), key).alias("snapshot"))


_UNIQUE = """
    WITH a AS (SELECT bare, min(page_id) AS a_id FROM records WHERE is_a AND clean IS NOT NULL GROUP BY bare HAVING count(DISTINCT page_id) = 1),
    b AS (SELECT CASE WHEN page_id % 5 = 0 THEN bare || '?new' ELSE bare END AS bare, min(page_id) AS b_id FROM records WHERE is_b AND clean IS NOT NULL GROUP BY 1 HAVING count(DISTINCT page_id) = 1),
    j1 AS (SELECT DISTINCT a_id, b_id FROM a JOIN b USING (bare)),"""
_SIMILAR = """
    j2 AS (SELECT a.page_id AS a_id, b.page_id AS b_id, a.host, max(len(list_intersect(a.tokens, b.tokens)) / len(list_distinct(list_concat(a.tokens, b.tokens)))) AS overlap
           FROM records a JOIN records b ON a.host = b.host AND a.is_a AND b.is_b GROUP BY ALL HAVING max(len(list_intersect(a.tokens, b.tokens)) / len(list_distinct(list_concat(a.tokens, b.tokens)))) >= 0.5),"""


@query("J1_unique_key_join", _UNIQUE + " z AS (SELECT 1) SELECT a_id, b_id FROM j1")
def j1(t: Tables):
    a, b = sides(t)
    return M.unique_join(a.where("clean is not null"), b.where("clean is not null"), "a_id", "b_id", "bare")


@query("J2_blocked_similarity", "WITH" + _SIMILAR + " z AS (SELECT 1) SELECT a_id, b_id, host, round(overlap, 6) AS overlap FROM j2")
def j2(t: Tables):
    a, b = sides(t)
    return M.similar(a, b, "a_id", "b_id", "host", "tokens", 0.5).withColumn("overlap", F.round("overlap", 6))


_MUTUAL = "m AS (SELECT *, count(*) OVER (PARTITION BY a_id) = 1 AND count(*) OVER (PARTITION BY b_id) = 1 AS clean FROM j2)"


@query("J3_mutual_pairs", "WITH" + _SIMILAR + _MUTUAL + " SELECT a_id, b_id, clean FROM m")
def j3(t: Tables):
    a, b = sides(t)
    clean, rest = M.mutual(M.similar(a, b, "a_id", "b_id", "host", "tokens", 0.5), "a_id", "b_id")
    return clean.withColumn("clean", F.lit(True)).unionByName(rest.withColumn("clean", F.lit(False))).select("a_id", "b_id", "clean")


@query("J4_geohash_join", """
    SELECT a.vec_id AS a_id, b.vec_id AS b_id FROM hashed a JOIN hashed b ON a.label = b.label AND left(a.hash, 2) = left(b.hash, 2) AND a.vec_id < b.vec_id""")
def j4(t: Tables):
    at = coordinates(t).select("vec_id", "label", T.geohash(F.col("lat"), F.col("lon"), 2).alias("cell"))
    a, b = at.withColumnRenamed("vec_id", "a_id"), at.withColumnRenamed("vec_id", "b_id")
    return a.join(b, ["label", "cell"]).where("a_id < b_id").select("a_id", "b_id")


_HISTORIC = """
    h AS (SELECT page_id, is_a, is_b, unnest([bare, 'https://' || host || '/' || file]) AS key FROM records WHERE clean IS NOT NULL),
    ha AS (SELECT key, min(page_id) AS a_id FROM h WHERE is_a AND page_id NOT IN (SELECT a_id FROM j1) GROUP BY key HAVING count(DISTINCT page_id) = 1 AND key IS NOT NULL),
    hb AS (SELECT key, min(page_id) AS b_id FROM h WHERE is_b AND page_id NOT IN (SELECT b_id FROM j1) GROUP BY key HAVING count(DISTINCT page_id) = 1 AND key IS NOT NULL),
    hp AS (SELECT DISTINCT a_id, b_id FROM ha JOIN hb USING (key)),
    j5 AS (SELECT a_id, b_id FROM (SELECT *, count(*) OVER (PARTITION BY a_id) AS x, count(*) OVER (PARTITION BY b_id) AS y FROM hp) WHERE x = 1 AND y = 1),"""


def historic_keys(rows):
    return rows.where("clean is not null").withColumn("key", F.explode(F.array("past", F.concat(F.lit("https://"), "host", F.lit("/"), "file"))))


@query("J5_historic_keys", _UNIQUE + _HISTORIC + " z AS (SELECT 1) SELECT a_id, b_id FROM j5")
def j5(t: Tables):
    a, b = sides(t)
    matched = M.unique_join(a.where("clean is not null"), b.where("clean is not null"), "a_id", "b_id", "bare")
    return M.historic_join(historic_keys(a), historic_keys(b), "a_id", "b_id", "key", matched)


def cascade(t: Tables):
    a, b = sides(t)
    exact = lambda x, y: M.unique_join(x.where("clean is not null"), y.where("clean is not null"), "a_id", "b_id", "bare")
    named = lambda x, y: M.mutual(M.similar(x, y, "a_id", "b_id", "host", "tokens", 0.5), "a_id", "b_id")[0]
    return M.cascade(a, b, "a_id", "b_id", [("url_exact", 1.0, exact), ("same_host", 0.8, named)])


_CASCADE = _UNIQUE + _SIMILAR + """
    r AS (SELECT * FROM j2 WHERE a_id NOT IN (SELECT a_id FROM j1) AND b_id NOT IN (SELECT b_id FROM j1)),
    n AS (SELECT a_id, b_id FROM (SELECT *, count(*) OVER (PARTITION BY a_id) AS x, count(*) OVER (PARTITION BY b_id) AS y FROM r) WHERE x = 1 AND y = 1),
    c AS (SELECT a_id, b_id, 'url_exact' AS method, 1.0::DOUBLE AS confidence FROM j1 UNION ALL SELECT a_id, b_id, 'same_host', 0.8 FROM n)"""


@query("J6_cascade", _CASCADE + " SELECT * FROM c")
def j6(t: Tables):
    return cascade(t)


@query("J7_residual_union", _CASCADE + """
    SELECT *, 'both' AS source FROM c UNION ALL SELECT page_id, NULL, 'none', 0.0, 'left' FROM records WHERE is_a AND page_id NOT IN (SELECT a_id FROM c)
    UNION ALL SELECT NULL, page_id, 'none', 0.0, 'right' FROM records WHERE is_b AND page_id NOT IN (SELECT b_id FROM c)""")
def j7(t: Tables):
    a, b = sides(t)
    return M.residual_union(a, b, cascade(t), "a_id", "b_id")


@query("J8_discovery_links", """
    WITH s AS (SELECT page_id, host || '/' || coalesce(file, '') AS system, is_a, count(*) OVER (PARTITION BY host, is_a) AS n FROM records)
    SELECT page_id, CASE WHEN n = 1 THEN 'f-gbfs-' || system WHEN page_id % 3 <> 0 THEN 'f-gbfs-' || system || '-' || page_id % 3 END AS id FROM s""")
def j8(t: Tables):
    from pyspark.sql import Window

    system = F.concat("host", F.lit("/"), F.coalesce("file", F.lit("")))
    rows = records(t).withColumn("n", F.count("*").over(Window.partitionBy("host", "is_a")))
    minted = F.when(F.col("n") == 1, F.concat(F.lit("f-gbfs-"), system)).when(F.col("page_id") % 3 != 0, F.concat(F.lit("f-gbfs-"), system, F.lit("-"), (F.col("page_id") % 3).cast("string")))
    return rows.select("page_id", minted.alias("id"))


_STATIC = """
    WITH rt AS (SELECT s_suppkey AS rt_id, s_suppkey % 40 AS file, s_suppkey % 9 AS host FROM supplier WHERE s_suppkey % 3 = 0),
    st AS (SELECT s_suppkey AS static_id, s_suppkey % 30 AS file, s_suppkey % 47 AS host FROM supplier WHERE s_suppkey % 3 <> 0),
    decl AS (SELECT s_suppkey AS rt_id, unnest([s_suppkey + 1, CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey + 2 END]) AS static_id FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 2 = 0),
    d AS (SELECT rt.rt_id, count(*) AS n, min(st.static_id) AS one, count(CASE WHEN st.file = rt.file THEN 1 END) AS nf, min(CASE WHEN st.file = rt.file THEN st.static_id END) AS inf
          FROM decl JOIN st USING (static_id) JOIN rt ON rt.rt_id = decl.rt_id GROUP BY ALL),
    f AS (SELECT rt_id, min(static_id) AS by_file FROM rt JOIN st ON rt.file = st.file GROUP BY ALL HAVING count(*) = 1),
    h AS (SELECT rt_id, min(static_id) AS by_host FROM rt JOIN st ON rt.host = st.host GROUP BY ALL HAVING count(*) = 1)
    SELECT rt.rt_id, CASE WHEN n = 1 THEN one WHEN nf = 1 THEN inf WHEN n IS NULL THEN coalesce(by_file, by_host) END AS static_id,
           CASE WHEN n = 1 OR nf = 1 THEN 'declared' WHEN n IS NOT NULL THEN 'none' WHEN by_file IS NOT NULL THEN 'same_file' WHEN by_host IS NOT NULL THEN 'same_host' ELSE 'none' END AS method
    FROM rt LEFT JOIN d ON d.rt_id = rt.rt_id LEFT JOIN f ON f.rt_id = rt.rt_id LEFT JOIN h ON h.rt_id = rt.rt_id"""


@query("J9_static_links", _STATIC)
def j9(t: Tables):
    key = F.col("s_suppkey")
    feeds = t.read("supplier").select("s_suppkey")
    rt = feeds.where("s_suppkey % 3 = 0").select(key.alias("rt_id"), (key % 40).alias("file"), (key % 9).alias("host"))
    st = feeds.where("s_suppkey % 3 <> 0").select(key.alias("static_id"), (key % 30).alias("file"), (key % 47).alias("host"))
    decl = feeds.where("s_suppkey % 3 = 0 and s_suppkey % 2 = 0").select(key.alias("rt_id"), F.explode(F.array(key + 1, F.when(key % 5 == 0, key + 2))).alias("static_id"))
    return M.static_link(rt, st, decl)


@query("J10_twin_location", """
    WITH l AS (SELECT host, 'R' || page_id % 2 AS country, 'N' || page_id % 4 AS sub, 'C' || page_id % 8 AS city FROM records WHERE host IS NOT NULL)
    SELECT host, CASE WHEN count(DISTINCT country) = 1 THEN min(country) END AS country, CASE WHEN count(DISTINCT country) = 1 AND count(DISTINCT sub) = 1 THEN min(sub) END AS sub,
           CASE WHEN count(DISTINCT country) = 1 AND count(DISTINCT sub) = 1 AND count(DISTINCT city) = 1 THEN min(city) END AS city FROM l GROUP BY host""")
def j10(t: Tables):
    n = F.col("page_id")
    rows = records(t).select("host", *[F.concat(F.lit(c), (n % m).cast("string")).alias(a) for c, m, a in (("R", 2, "country"), ("N", 4, "sub"), ("C", 8, "city"))])
    return M.agreed_location(rows, "host", ["country", "sub", "city"])


@query("H1_redirect_ends", """
    WITH RECURSIVE n AS (SELECT p_partkey AS id, p_size % 3 = 0 AS live, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey // 2 END AS nxt FROM part),
    walk AS (SELECT id, id AS cur, live, nxt, 0 AS depth FROM n UNION ALL SELECT w.id, n.id, n.live, n.nxt, depth + 1 FROM walk w JOIN n ON w.nxt = n.id WHERE NOT w.live AND depth < 60)
    SELECT id AS p_partkey, cur AS live_id FROM walk WHERE live AND id <> cur""")
def h1(t: Tables):
    part = t.read("part").select("p_partkey", (F.col("p_size") % 3 == 0).alias("live"), F.when(F.col("p_partkey") % 11 != 0, F.floor(F.col("p_partkey") / 2)).alias("to"))
    return M.live_ends(part, "p_partkey", "to", "live")


@query("H1_long_chains", """
    WITH RECURSIVE n AS (SELECT c_custkey AS id, c_custkey % 150 = 0 AS live, CASE WHEN c_custkey % 149 <> 0 THEN c_custkey - 1 END AS nxt, c_custkey // 400 AS spec FROM customer),
    walk AS (SELECT id, id AS cur, live, nxt, spec FROM n UNION ALL SELECT w.id, n.id, n.live, n.nxt, n.spec FROM walk w JOIN n ON w.nxt = n.id AND w.spec = n.spec WHERE NOT w.live)
    SELECT id AS c_custkey, cur AS live_id FROM walk WHERE live AND id <> cur""")
def h1_long(t: Tables):
    key = F.col("c_custkey")
    rows = t.read("customer").select(key, (key % 150 == 0).alias("live"), F.when(key % 149 != 0, key - 1).alias("to"), F.floor(key / 400).alias("spec"))
    return M.live_ends(rows, "c_custkey", "to", "live", "spec")


@query("H7_co_listing", """
    WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
    SELECT DISTINCT a.l_suppkey AS a, b.l_suppkey AS b FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey""")
def h7(t: Tables):
    return M.co_listed(t.read("lineitem"), "l_orderkey", "l_suppkey")


@query("J11_name_lookup", """
    WITH k AS (SELECT place_id, country_code AS country, parent_id, unnest(list_distinct([lower(split_part(name, ' ', 1)), lower(name)])) AS name FROM places WHERE kind = 'city'),
    a AS (SELECT c_custkey AS key, 'R' || n_regionkey AS country, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN lower(c_mktsegment) || ' ' || lower(n_name) ELSE 'nowhere' END AS name, CASE WHEN c_custkey % 2 = 0 THEN 'N' || c_nationkey END AS sub
          FROM customer JOIN nation ON c_nationkey = n_nationkey),
    f AS (SELECT key, count(DISTINCT place_id) AS n, min(place_id) AS one, count(DISTINCT CASE WHEN parent_id = sub THEN place_id END) AS nb, min(CASE WHEN parent_id = sub THEN place_id END) AS below FROM a LEFT JOIN k USING (country, name) GROUP BY key)
    SELECT key, CASE WHEN n = 1 THEN one WHEN nb = 1 THEN below END AS place_id, CASE WHEN n = 0 THEN 'unknown' WHEN n = 1 THEN 'unique' WHEN nb = 1 THEN 'corroborated' ELSE 'ambiguous' END AS outcome FROM f""")
def j11(t: Tables):
    known = t.places().where("kind = 'city'").select(
        "place_id", F.col("country_code").alias("country"), F.array(F.lower(F.split_part("name", F.lit(" "), F.lit(1))), F.lower("name")).alias("variants"), "parent_id"
    )
    rows, k = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")), F.col("c_custkey")
    name = F.when(k % 3 == 0, F.lower("c_mktsegment")).when(k % 3 == 1, F.concat(F.lower("c_mktsegment"), F.lit(" "), F.lower("n_name"))).otherwise("nowhere")
    asked = rows.select(k.alias("key"), F.concat(F.lit("R"), "n_regionkey").alias("country"), name.alias("name"), F.when(k % 2 == 0, F.concat(F.lit("N"), "c_nationkey")).alias("subdivision"))
    return M.name_lookup(asked, known)


@query("J12_canonical_ids", """
    SELECT l_orderkey, l_linenumber, named, CASE WHEN s_suppkey IS NOT NULL THEN 'F' || s_suppkey END AS canonical
    FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'F' || l_suppkey WHEN 1 THEN 'A' || l_suppkey ELSE 'B' || l_suppkey END AS named, l_suppkey FROM lineitem)
    LEFT JOIN supplier ON l_suppkey = s_suppkey AND named[1] IN ('F', 'A')""")
def j12(t: Tables):
    key = F.col("s_suppkey").cast("string")
    feeds = t.read("supplier").select(F.concat(F.lit("F"), key).alias("feed_id"), F.array(F.concat(F.lit("A"), key)).alias("aliases"))
    n, at = F.col("l_linenumber") % 3, F.col("l_suppkey").cast("string")
    named = F.concat(F.when(n == 0, "F").when(n == 1, "A").otherwise("B"), at)
    return M.canonical_ids(t.read("lineitem").select("l_orderkey", "l_linenumber", named.alias("named")), feeds, "named")
