"""Cases by hand for what the tables don't hold."""

import datetime as dt
import io
import json
import random
import tarfile
import threading
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanroute.functions import geometry as G
from spanroute.functions import text as T
from spanroute.operators import hierarchy as H
from spanroute.operators import intervals as I
from spanroute.operators import matching as M
from spanroute.operators import overlap as O
from spanroute.operators import query_api as A
from spanroute.operators import service as S
from spanroute.sinks import snapshots as K
from spanroute.sources import files as R


def day(text):
    return dt.date.fromisoformat(text)


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], list(values))
    return rows.select(column.alias("x")).first().x


@pytest.mark.parametrize(("url", "form"), [
    ("HTTP://User@Example.COM:80/A/?q=1#f", "https://User@example.com/A?q=1#f"), ("https://x.org:0443/", "https://x.org"), ("https://x.org:8443/a", "https://x.org:8443/a"),
    ("http://x.org:443/a", "https://x.org:443/a"), ("N/A", None), (" http://x.org", None), ("http:///p", None),
])
def test_match_url(spark, url, form):
    assert one(spark, T.match_url(F.col("u")), u=url) == form


def test_geohash(spark):
    assert one(spark, T.geohash(F.col("a"), F.col("b"), 9), a=57.64911, b=10.40744) == "u4pruydqq"
    box = one(spark, T.geohash_box(F.col("h")), h="u4pr")
    assert box.xmin <= 10.40744 <= box.xmax and box.ymin <= 57.64911 <= box.ymax


def test_fold():
    assert T.fold("Straßen-Bahn Zürich AG, Éclair") == ["bahn", "eclair", "strassen", "zurich"]


def test_modes(spark):
    for kind, mode in ((900, "tram"), (401, "subway"), (2, "rail"), (715, "bus"), (1200, "ferry"), (1700, "other")):
        assert one(spark, T.mode_of(F.col("k")), k=kind) == mode


def test_redirects_with_a_cycle(spark):
    rows = spark.createDataFrame([(1, 2, False), (2, 1, False), (3, 4, False), (4, 5, False), (5, None, True), (6, 99, False), (7, None, False)], "id long, to long, live boolean")
    assert sorted(map(tuple, M.live_ends(rows, "id", "to", "live").collect())) == [(3, 5), (4, 5)]


def test_sweep_merges_equal_counts(spark):
    rows = [("a", day("2020-01-01"), day("2020-01-10")), ("a", day("2020-01-11"), day("2020-01-20")), ("a", day("2020-01-05"), day("2020-01-06")), ("b", None, day("2020-01-01")), ("c", day("2020-02-01"), day("2020-01-01"))]
    got = sorted(map(tuple, I.coverage_windows(spark.createDataFrame(rows, "k string, start date, end date"), "k").collect()))
    assert got == [("a", day("2020-01-01"), day("2020-01-04"), 1), ("a", day("2020-01-05"), day("2020-01-06"), 2), ("a", day("2020-01-07"), day("2020-01-20"), 1)]


def test_open_ended_calendar(spark):
    """A window to the year 9999 isn't walked."""
    week = [True] * 5 + [False] * 2
    cal = spark.createDataFrame([("s", day("2024-01-06"), day("9999-12-31"), week, 3)], "service_id string, start date, end date, weekdays array<boolean>, trips long")
    exc = spark.createDataFrame([("s", day("2024-01-08"), False), ("s", day("2024-01-07"), True)], "service_id string, day date, added boolean")
    owner = spark.createDataFrame([("s", "f")], "service_id string, feed_id string")
    daily = S.daily_trips(cal, exc, owner, "2024-01-05", "2024-01-10")
    assert sorted(map(tuple, daily.collect())) == [("f", day(f"2024-01-{d:02d}"), 3) for d in (7, 9, 10)]
    span = S.service_span(cal, exc).first()
    assert (span["first"], span["last"]) == (day("2024-01-07"), day("9999-12-31"))


def test_registry_numbers_are_dense(spark):
    rows = spark.createDataFrame([(k, [f"v{k}"]) for k in range(100)], "key long, values array<string>")
    known = spark.createDataFrame([("v3", "p"), ("v4", "q")], "value string, place_id string")
    got = {r.key: (r.place_id, r.outcome) for r in H.identify(rows, known, 7).collect()}
    assert got[3] == ("p", "identified") and sorted(int(v[0][3:]) for v in got.values() if v[1] == "minted") == list(range(7, 105))


def test_registry_merges_flatten_and_refuse(spark):
    registry = spark.createDataFrame([(p, "city", i, 1) for p, i in [("tp_1", None), ("tp_2", None), ("tp_3", None), ("tp_4", "tp_1"), ("tp_5", None), ("tp_6", None), ("tp_7", None), ("tp_8", None)]], "place_id string, kind string, into string, extra int")
    merges = spark.createDataFrame([("tp_1", "tp_2"), ("tp_2", "tp_3"), ("tp_4", "tp_5"), ("tp_5", "tp_5"), ("tp_6", "tp_7"), ("tp_7", "tp_6"), ("tp_8", "tp_9")], "place_id string, into string")
    got = {r.place_id: r.into for r in H.merge(registry, merges).collect()}
    assert got == {"tp_1": "tp_3", "tp_2": "tp_3", "tp_3": None, "tp_4": "tp_3", "tp_5": None, "tp_6": None, "tp_7": None, "tp_8": None}
    known = spark.createDataFrame([("a", "tp_2")], "value string, place_id string")
    detached = spark.createDataFrame([("a", "tp_4")], "value string, place_id string")
    got = {r.place_id: r.into for r in H.merge(registry, merges, known, detached).collect()}
    assert (got["tp_1"], got["tp_2"], got["tp_4"]) == (None, "tp_3", "tp_1")
    assert H.merge(registry, merges.limit(0)).where("into is not null").count() == 1


def test_registry_gains_values_that_were_not_detached(spark):
    rows = spark.createDataFrame([(1, ["a", "b", None]), (2, ["b", "c"]), (3, ["d", "e"]), (4, ["f"])], "key int, values array<string>")
    ids = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r"), (4, None)], "key int, place_id string")
    known = spark.createDataFrame([("a", "p")], "value string, place_id string")
    detached = spark.createDataFrame([("d", "r"), ("c", "p")], "value string, place_id string")
    assert sorted(map(tuple, H.enrich(rows, ids, known, detached).collect())) == [("b", "p"), ("c", "q")]


def test_unbounded_slice_is_refused(spark):
    places = spark.createDataFrame([], "place_id string, kind string, name string, parent_id string")
    with pytest.raises(A.SliceError):
        A.filter_places(places, ["city"])


def test_polygons():
    square = np.array([(0, 0), (4, 0), (4, 4), (0, 4)], float)
    points = np.array([(2, 2), (0, 2), (4, 4), (5, 2), (-1, 0), (2, 4)], float)
    assert G.inside(points, square).tolist() == [True, True, True, False, False, True]
    assert G.area(square) == 16 and G.area(G.clip(square, (2, 2, 9, 9))) == 4 and not len(G.clip(square, (5, 5, 6, 6)))
    assert G.valid(square) and not G.valid(square[[0, 2, 1, 3]]) and not G.valid(square[:2])
    assert sorted(map(tuple, G.hull(np.vstack([square, points[:3]])))) == sorted(map(tuple, square))
    assert G.simplify(np.array([(0, 0), (1, 0.01), (2, 0), (3, 5)], float), 0.1).tolist() == [[0, 0], [2, 0], [3, 5]]
    shape = np.array([(0, 0), (10, 0), (10, 10), (9, 1), (0, 1)], float)
    assert G.inside(np.array([G.representative(shape)]), shape).all()
    assert abs(G.area_km2(np.array([(-180, -90), (180, -90), (180, 90), (-180, 90)], float)) / 5.1006e8 - 1) < 1e-3


def test_csv_headers(spark, tmp_path):
    schema = StructType.fromDDL("a int, b string")
    (tmp_path / "good.csv").write_text("﻿b,a,b\n x ,1,z\n,2,z\n")
    assert [tuple(r) for r in R.read_csv(spark, str(tmp_path / "good.csv"), schema, ["a"]).collect()] == [(1, "x"), (2, None)]
    with pytest.raises(R.HeaderError):
        R.read_csv(spark, str(tmp_path / "good.csv"), schema)


def test_archives(spark, tmp_path):
    feeds = {"feeds": [{"id": "f-1", "spec": "GTFS", "name": "A", "urls": {"static_current": "u"}}, {"id": "f-2", "spec": "other"}]}
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        for name, text in (("x/feeds/a.json", json.dumps(feeds)), ("x/readme.md", "no")):
            info = tarfile.TarInfo(name)
            info.size = len(text)
            t.addfile(info, io.BytesIO(text.encode()))
    got = R.feeds_of(R.read_archives(spark, str(tmp_path / "a.tar.gz"))).collect()
    assert [(r.onestop_id, r.spec, r.urls) for r in got] == [("f-1", "gtfs", {"static_current": "u"})]
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep/er/stops.txt", "no")
        z.writestr("feed/stops.txt", "﻿stop_id\n1\n")
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("only.zip", inner.getvalue())
    got = R.read_feed_members(spark, str(tmp_path / "f.zip"), ["stops.txt", "trips.txt"]).collect()
    assert [(r.folder, r.member, r.text) for r in got] == [("feed", "stops.txt", "stop_id\n1\n")]


def test_zone_rings(spark):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    doc = {"features": [{"id": "a", "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"id": "b", "geometry": {"type": "Point", "coordinates": [0, 0]}}]}
    got = R.zone_rings(spark.createDataFrame([(json.dumps(doc),)], "text string")).collect()
    assert [(r.id, len(r.ring)) for r in got] == [("a", 4)]


def test_overrides():
    allowed = {"set_tier": {"feed", "tier"}}
    assert R.read_overrides('[{"set_tier": {"feed": "f", "tier": "local"}}]', allowed)
    for bad in ('[{"drop": {}}]', '[{"set_tier": {"x": 1}}]', '[{"set_tier": {"feed": 1, "feed": 2}}]'):
        with pytest.raises(ValueError):
            R.read_overrides(bad, allowed)


def test_generations(spark, tmp_path):
    rows, root = spark.range(20).withColumn("p", F.col("id") % 3), str(tmp_path / "store")
    names = [K.publish({"t": rows.limit(n)}, root, {"t": "p"}, keep=2) for n in (5, 10, 20)]
    assert K.generations(spark, root) == sorted(names)[1:]
    assert K.resolve(spark, root)["t"].count() == 20
    part = next((tmp_path / "store" / names[-1] / "t").rglob("*.parquet"))
    part.unlink()
    with pytest.raises(ValueError):
        K.resolve(spark, root)


def test_digest_is_of_a_multiset(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    own = K.table_digest(rows).first().digest
    assert K.table_digest(rows.repartition(3)).first().digest == own != K.table_digest(rows.distinct()).first().digest


def test_thirty_publishes(spark, tmp_path):
    """Generations count on beyond those kept, and a reader always finds the pointer."""
    root, stop, seen, failed = str(tmp_path / "g"), threading.Event(), set(), []
    K.publish({"t": spark.range(1)}, root)

    def read():
        while not stop.is_set():
            try:
                seen.add(K.current(spark, root))
            except Exception as e:  # any miss counts
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    pinned = K.current(spark, root)
    for n in range(2, 32):
        name = K.publish({"t": spark.range(n)}, root, keep=3, pinned=[pinned])
        assert K.current(spark, root) == name
        if n % 10 == 0:
            assert K.resolve(spark, root)["t"].count() == n
    stop.set()
    reader.join()
    assert not failed and len(seen) > 3
    assert len(K.generations(spark, root)) == 4 and pinned in K.generations(spark, root)
    assert K.resolve(spark, root)["t"].count() == 31


def test_long_chains_and_deep_trees(spark):
    rows = [(i, i + 1 if i < 1000 else None, i == 1000, "a") for i in range(1001)] + [(2000, 2001, False, "a"), (2001, 2000, False, "a"), (2002, 2002, False, "a"), (2003, 1000, False, "b"), (2004, 9999, False, "a"), (2005, 500, None, "a")]
    table = spark.createDataFrame(rows, "id long, to long, live boolean, spec string")
    assert sorted(map(tuple, M.live_ends(table, "id", "to", "live", "spec").collect())) == [(i, 1000) for i in range(1000)] + [(2005, 1000)]
    assert (2003, 1000) in {tuple(r) for r in M.live_ends(table, "id", "to", "live").collect()}
    tree = [(f"p{i}", f"p{i - 1}" if i else None) for i in range(50)] + [("a", "b"), ("b", "c"), ("c", "b"), ("x", "x"), ("y", "gone")]
    up = H.closure(spark.createDataFrame(tree, "place_id string, parent_id string")).collect()
    assert sorted((int(r.ancestor_id[1:]), r.depth) for r in up if r.place_id == "p49") == [(49 - d, d) for d in range(49, -1, -1)]
    assert sorted((r.place_id, r.ancestor_id, r.depth) for r in up if r.place_id in "abcxy") == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("b", "b", 0), ("b", "c", 1), ("c", "b", 1), ("c", "c", 0), ("x", "x", 0), ("y", "y", 0)]


def test_containments_and_boxes_against_all_pairs(spark):
    rng = random.Random(4)
    sets = {o: {rng.randrange(30) for _ in range(rng.randrange(1, 25))} for o in range(60)} | {90: set(range(20)), 91: set(range(20)), 92: set(range(18))}
    table = spark.createDataFrame([(o, e) for o, s in sets.items() for e in s], "o long, e long")
    for least, larger in ((0.9, 1.0), (0.8, 1.5), (1.0, 1.0)):
        want = {(a, b, len(x & y), len(x), len(y)) for a, x in sets.items() for b, y in sets.items() if a != b and len(y) >= larger * len(x) and len(x & y) >= least * len(x)}
        assert {tuple(r) for r in O.containments(table, "o", "e", least, larger).select("a", "b", "shared", "own", "other").collect()} == want
    boxes = []
    for i in range(220):
        x, y, w, h = rng.uniform(-0.1, 0.1), rng.uniform(-0.1, 0.1), rng.choice([0, 0, 0.004, 0.05, 3, 90]) * rng.random(), rng.choice([0, 0.01, 2]) * rng.random()
        boxes.append(("p", f"f{i % 7}", i, i % 2, "n", x, x + w, y, y + h))
    boxes += [("p", "f8", 900, 0, "n", 0.012, 0.012, 0.0, 0.0), ("p", "f9", 901, 0, "n", 0.009, 0.009, 0.0, 0.003)]
    got = O.beside(spark.createDataFrame(boxes, "place_id string, feed_id string, line_id long, family int, name string, xmin double, xmax double, ymin double, ymax double")).select("line_a", "line_b").collect()
    t = 0.003
    want = [(a[2], b[2]) for a in boxes for b in boxes if a[1] != b[1] and a[3] == b[3] and a[5] <= b[6] + t and b[5] <= a[6] + t and a[7] <= b[8] + t and b[7] <= a[8] + t]
    assert sorted(map(tuple, got)) == sorted(want)
