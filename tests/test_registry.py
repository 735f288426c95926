"""Rows that join a registry, against one that takes them row by row."""

import random

from spanroute import plans
from spanroute.operators import hierarchy as H


def row_by_row(rows, concordance, kinds, detached, next_id):
    index, kinds, out = dict(concordance), dict(kinds), {}
    for key, kind, values in sorted(rows):
        values = [v for v in dict.fromkeys(values or []) if v is not None]
        hits = {index[v] for v in values if v in index}
        place, outcome = None, "empty"
        if len(hits) > 1:
            outcome = "conflict"
        elif hits:
            (place,) = hits
            outcome = "kind" if kinds[place] != kind else "detached" if any((place, v) in detached for v in values) else "identified"
        elif values:
            place, outcome = f"tp_{next_id}", "minted"
            kinds[place] = kind
            next_id += 1
        if outcome in ("identified", "minted"):
            index.update(dict.fromkeys(values, place))
        out[key] = (place if outcome in ("identified", "minted") else None, outcome)
    return out


def check(spark, rows, concordance, kinds, detached):
    frames = [
        spark.createDataFrame(rows, "key long, kind string, values array<string>"), spark.createDataFrame(list(concordance.items()), "value string, place_id string"),
        spark.createDataFrame(list(kinds.items()), "place_id string, kind string"), spark.createDataFrame(sorted(detached), "place_id string, value string"),
    ]
    got = {r.key: (r.place_id, r.outcome) for r in H.enlist(*frames, 1000).collect()}
    want = row_by_row(rows, concordance, kinds, detached, 1000)
    assert got == want
    return {o for _, o in want.values()}


def test_random_registries(spark):
    seen = set()
    for seed, (n, names) in enumerate([(60, 25), (200, 60), (150, 400)]):
        rng = random.Random(seed)
        rows = [(k, rng.choice(["city", "region", "city"]), [f"v{rng.randrange(names)}" for _ in range(rng.randrange(4))] if k % 20 else rng.choice([None, [], [None]])) for k in range(n)]
        places = {f"tp_{i}": rng.choice(["city", "region"]) for i in range(6)}
        concordance = {f"v{rng.randrange(names)}": rng.choice(list(places)) for _ in range(8)}
        seen |= check(spark, rows, concordance, places, {(rng.choice(list(places)), f"v{rng.randrange(names)}") for _ in range(90)})
    assert seen == {"conflict", "kind", "detached", "identified", "minted", "empty"}


def test_shared_values_find_the_first_place(spark):
    rows = [(1, "city", ["x"]), (2, "city", ["x", "y"]), (3, "region", ["y"]), (4, "city", ["y", "z"]), (5, "city", ["z"]), (6, "city", ["w", "w"])]
    got = row_by_row(rows, {}, {}, set(), 1000)
    assert got[2] == ("tp_1000", "identified") and got[3] == (None, "kind") and got[5] == ("tp_1000", "identified")
    check(spark, rows, {}, {}, set())


def test_query(spark, sf_small):
    parts = spark.read.parquet(f"{sf_small}/part.parquet").collect()
    rows = [(p.p_partkey, "city" if p.p_size % 3 else "region", [f"{p.p_brand}{p.p_size}", f"n{p.p_partkey % 700}"]) for p in parts]
    known = {f"n{p.p_partkey % 700}": f"tp_{p.p_partkey % 700}" for p in parts if p.p_partkey % 700 < 50}
    detached = {(f"tp_{p.p_partkey % 700}", f"{p.p_brand}{p.p_size}") for p in parts if p.p_partkey % 700 < 5}
    got = {r.key: (r.place_id, r.outcome) for r in plans.QUERIES["H10_enlist"](spark, sf_small).collect()}
    assert got == row_by_row(rows, known, dict.fromkeys(known.values(), "city"), detached, 1000)
