"""Steps whose work is to grow no faster than their input: the rows that plans make, and results against plain versions."""

import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from spanroute.functions import text as T
from spanroute.functions import wkb as W
from spanroute.operators import curation as C
from spanroute.operators import hierarchy as H
from spanroute.operators import planar as P


def most_rows(node):
    """The largest number of rows that a step of an executed plan put out."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return most_rows(node.executedPlan())
    if "QueryStage" in name:
        return most_rows(node.plan())
    found, children = node.metrics().get("numOutputRows"), node.children()
    own = found.get().value() if found.isDefined() else 0
    return max([own] + [most_rows(children.apply(i)) for i in range(children.size())])


def executed(df):
    rows = df.collect()
    return rows, most_rows(df._jdf.queryExecution().executedPlan())


def test_many_edits_of_one_place_meet_an_edge_once(spark):
    rng = random.Random(5)
    edges = [(f"F{i % 150}", f"P{i % 3}", rng.choice(["local", "regional", None])) for i in range(300)]
    edits = [(i, rng.choice([None, None, f"F{i % 150}"]), f"P{i % 2}", rng.choice(["remove", "set"]), "national") for i in range(400)]
    edits += [(1000 + i, f"F{i}", None, "set", "unknown") for i in range(0, 300, 2)] + [(2000, "F1", "P1", "add", "local"), (None, "F2", "P2", "remove", None)]
    frames = spark.createDataFrame(edges, "feed_id string, place_id string, tier string"), spark.createDataFrame(edits, "edit_id long, feed_id string, place_id string, action string, tier string")
    want = {e[1:3] + e[4:] for e in edits if e[3] == "add"}
    for feed, place, tier in edges:
        met = [e for e in edits if e[3] != "add" and e[1:3] != (None, None) and e[1] in (None, feed) and e[2] in (None, place)] if tier else []
        best = min(met, key=lambda e: (e[2] is None, e[1] is None, e[0] is None, e[0]), default=None)
        if best is None or best[3] == "set":
            want.add((feed, place, best[4] if best else tier))
    rows, most = executed(C.apply_edits(*frames))
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert most <= len(edges) + len(edits)


def test_copies_of_points_and_shapes_are_tested_once(spark):
    def box(x0, y0, x1, y1):
        return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], float)

    kinds = [(0, 0, 4, 4), (1, 0, 5, 4), (0, 1, 4, 5)]  # with a hole each, in which most points lie
    shapes = [(i, bytes(W.encode([[box(*kinds[i % 3]), box(kinds[i % 3][0] + 0.5, kinds[i % 3][1] + 0.5, kinds[i % 3][2] - 0.5, kinds[i % 3][3] - 0.5)]]))) for i in range(60)] + [(60, None)]
    points = [(i, 2.0 + (i % 20) / 16, 2.0) for i in range(300)] + [(300, 0.25, 2.0), (301, 0.25, 2.0), (302, None, 2.0)]
    want = set()
    for point, x, y in points:
        for shape, _ in shapes[:60]:
            x0, y0, x1, y1 = kinds[shape % 3]
            if x is not None and x0 <= x <= x1 and y0 <= y <= y1 and not (x0 + 0.5 < x < x1 - 0.5 and y0 + 0.5 < y < y1 - 0.5):
                want.add((point, shape))
    rows, most = executed(P.covers(spark.createDataFrame(points, "p long, lon double, lat double"), spark.createDataFrame(shapes, "s long, geometry binary"), "p", "s"))
    assert {tuple(r) for r in rows} == want and len(rows) == len(want) and want
    assert most <= 1000


def test_passes_look_no_kinds_up_among_all_rows(spark, monkeypatch):
    made = []
    monkeypatch.setattr(H, "written", lambda rows, f=H.written: made.append(rows) or f(rows))
    rows = spark.createDataFrame([(0, "city", ["v"]), (1, "region", ["v"]), (2, "city", ["x"])], "key long, kind string, values array<string>")
    known, places = spark.createDataFrame([("v", "tp_1")], "value string, place_id string"), spark.createDataFrame([("tp_1", "city")], "place_id string, kind string")
    got = H.enlist(rows, known, places, known.select("place_id", "value").limit(0), 1000)
    assert {r.key: r.outcome for r in got.collect()} == {0: "identified", 1: "kind", 2: "minted"}
    assert not [line for df in made for line in df._jdf.queryExecution().analyzed().toString().split("\n") if "Join" in line and "<=>" in line]


def test_words_of_a_batch_are_not_held_as_objects_together():
    texts = [f"Straße {i} Éclair GmbH " + " ".join(f"w{i}x{j}" for j in range(60)) for i in range(2000)] + [None, ""]
    batch, want = pa.array(texts, pa.string()), [T.fold(t) for t in texts]
    tracemalloc.start()
    (got,) = T.folded_tokens.func(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == want
    assert peak < sum(sys.getsizeof(w) for words in want for w in words) / 5
