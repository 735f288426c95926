"""Stages that are taken over or run again, and writers that begin at the same time."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from spanroute.sinks import snapshots as K
from spanroute.sinks import stages as G


def stages(calls, add=1, version=1):
    def step(name, f):
        def make(*tables, **settings):
            calls.append(name)
            return f(*tables, **settings)

        return make

    return [
        G.Stage("a", ("x",), step("a", lambda x, add: x.select((F.col("id") + add).alias("id"))), {"add": add}, version),
        G.Stage("b", ("a",), step("b", lambda a: a.select((F.col("id") % 2).alias("id")).distinct())),
        G.Stage("c", ("b", "y"), step("c", lambda b, y: b.join(y, "id"))),
        G.Stage("d", ("y",), step("d", lambda y: y.groupBy().count())),
    ]


def test_only_what_follows_a_change_runs(spark, tmp_path):
    root, x, y, calls = str(tmp_path / "r"), spark.range(10), spark.range(3), []
    first, done = G.run_stages(spark, root, {"x": x, "y": y}, stages(calls))
    assert calls == ["a", "b", "c", "d"] and not any(d.reused for d in done) and first["c"].count() == 2
    calls.clear()
    again, done = G.run_stages(spark, root, {"x": x.repartition(7).orderBy(F.desc("id")), "y": y}, stages(calls))
    assert calls == [] and all(d.reused for d in done) and again["c"].count() == 2
    G.run_stages(spark, root, {"x": x, "y": spark.range(4)}, stages(calls))
    assert calls == ["c", "d"]
    calls.clear()
    G.run_stages(spark, root, {"x": x, "y": y}, stages(calls, add=3))  # b comes out as before, so c is taken over
    assert calls == ["a", "b"]
    calls.clear()
    G.run_stages(spark, root, {"x": x, "y": y}, stages(calls, version=2))
    assert calls == ["a"]


def test_a_broken_run_goes_on(spark, tmp_path):
    root, calls = str(tmp_path / "r"), []

    def broken(*_):
        raise KeyError("b")

    some = stages(calls)
    with pytest.raises(KeyError):
        G.publish_run(spark, root, {"x": spark.range(5), "y": spark.range(2)}, [some[0], G.Stage("b", ("a",), broken), *some[2:]])
    with pytest.raises(FileNotFoundError):
        K.current(spark, root)
    calls.clear()
    name, done = G.publish_run(spark, root, {"x": spark.range(5), "y": spark.range(2)}, some)
    assert calls == ["b", "c", "d"] and K.current(spark, root) == name and set(K.resolve(spark, root)) == {"a", "b", "c", "d"}


def test_claims_rise_and_are_had_once(spark, tmp_path):
    root = str(tmp_path / "r")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: K.claim(spark, root), range(24)))
    assert len(set(got)) == 24


def test_a_later_writer_supersedes(spark, tmp_path):
    root, rows = str(tmp_path / "r"), spark.range(3)
    K.publish({"t": rows}, root)
    early, late = K.claim(spark, root), K.claim(spark, root)
    with pytest.raises(K.Superseded):
        K.publish({"t": rows.limit(1)}, root, claimed=early)
    assert K.resolve(spark, root)["t"].count() == 3
    name = K.publish({"t": rows.limit(2)}, root, claimed=late)
    assert K.current(spark, root) == name and K.resolve(spark, root)["t"].count() == 2
    assert int(K.publish({"t": rows}, root).split("-")[1]) > late
