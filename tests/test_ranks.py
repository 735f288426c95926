"""Ranks and similarity joins over hot groups, against plain versions."""

import random

from pyspark.sql import functions as F

from spanroute.operators.matching import similar
from spanroute.operators.ranks import nearest_rank, running
from spanroute.sources import files as S


def test_running_within_a_hot_group(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), None if i == 7 else i, rng.randrange(4)) for i in range(900)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o long, w long").repartition(5)
    assert running(df, "g", "o").count() == 900
    for weight in ("w", None):
        got = {(r.g, r.o): (r.upto, r.total) for r in running(df, "g", "o", weight).collect()}
        for g in ("hot", "a", "b", None):
            at, own = 0, sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0))
            total = sum(r[2] if weight else 1 for r in own)
            for r in own:
                at += r[2] if weight else 1
                assert got[g, r[1]] == (at, total)


def test_nearest_rank(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice([None, 1.5, 2.0, -3.0, rng.random()])) for _ in range(500)] + [("n", None), ("one", 4.0), (None, 1.0), (None, 3.0)]
    for share in (0.0, 0.5, 0.95, 1.0):
        got = {r.k: r.p for r in nearest_rank(spark.createDataFrame(rows, "k string, v double"), "k", "v", share, "p").collect()}
        for k in ("a", "b", "n", "one", None):
            own = sorted(v for key, v in rows if key == k and v is not None)
            assert got[k] == (own[round(share * (len(own) - 1))] if own else None)


def test_similar_as_all_pairs(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)]
    some = lambda n, off: [(off + i, rng.choice("xy"), ["common", *rng.sample(words, rng.randrange(6))] if rng.random() < 0.9 else rng.sample(words, rng.randrange(3))) for i in range(n) for _ in range(2)]
    left, right = some(60, 0), some(60, 100)
    schema = "id long, host string, tokens array<string>"
    for least in (0.5, 0.55, 0.7, 0.8, 1.0):
        want = {}
        for i, h, a in left:
            for j, k, b in right:
                if h == k and (set(a) | set(b)) and (o := len(set(a) & set(b)) / len(set(a) | set(b))) >= least:
                    want[i, j, h] = max(o, want.get((i, j, h), 0))
        got = similar(spark.createDataFrame(left, schema).withColumnRenamed("id", "l"), spark.createDataFrame(right, schema).withColumnRenamed("id", "r"), "l", "r", "host", "tokens", least)
        assert {(r.l, r.r, r.host): r.overlap for r in got.collect()} == want and want


def test_listed_operators(spark):
    text = '{"feeds":[{"id":"f-1","spec":"gtfs"},{"id":"f-1","spec":"gtfs"}],"operators":[{"onestop_id":"o-1","name":"B","associated_feeds":[{"feed_onestop_id":"f-1"},{}]},{"name":"none"}]}'
    docs = spark.createDataFrame([("b", text), ("a", text.replace("B", "A").replace("f-1", "f-2")), ("c", '{"operators":[{"onestop_id":"o-2"}]}')], "member string, text string")
    got = S.merged_operators(S.operators_of(docs)).select("onestop_id", "name", "listings", "feeds")
    assert sorted(tuple(r) for r in got.collect()) == [("o-1", "A", 2, ["f-1", "f-2"]), ("o-2", None, 1, [])]
    assert sorted(tuple(r) for r in S.repeated_feeds(S.feeds_of(docs)).collect()) == [("f-1", "b", "b"), ("f-2", "a", "a")]


def test_zones(spark):
    ring = lambda x: F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(b).alias("y")) for a, b in [(0, 0.0), (x, 0.0), (x, 1.0), (0, 0.0)]])
    rings = spark.createDataFrame([("a",), ("b",), ("c",)], "id string").select("id", F.when(F.col("id") == "b", ring(float("nan"))).otherwise(ring(1)).alias("ring"))
    rings = rings.union(spark.range(1).select(F.lit("c"), ring(181)))
    assert [r.id for r in S.sound_zones(rings).collect()] == ["a"]
    times = spark.createDataFrame([("a", None, " 1"), (None, " a ", "0"), ("c", None, None), (None, "b", "1")], "location_id string, stop_id string, pickup_type string")
    assert sorted(r.id for r in S.boarding_zones(times, rings.select("id").distinct()).collect()) == ["a", "c"]
