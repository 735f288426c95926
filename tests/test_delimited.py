"""Delimited files in parts, against the csv module over the whole file."""

import csv
import io
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql.types import StructType

from spanroute.sources import delimited as D
from spanroute.sources.delimited import RowError, inside_after, read_delimited
from spanroute.sources.files import HeaderError

TWO = StructType().add("a", "string").add("b", "string")


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def plain(text):
    rows = list(csv.DictReader(io.StringIO(text.removeprefix("﻿"))))
    return sorted(repr((r["a"].strip() or None, r["b"].strip() or None)) for r in rows)


def read(spark, path, **limits):
    return sorted(repr(tuple(r)) for r in read_delimited(spark, str(path), TWO, **limits).collect())


@pytest.mark.parametrize("seed", range(6))
def test_as_the_whole_file(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    sink = io.StringIO()
    sink.write("﻿" * (seed % 2))
    w = csv.writer(sink, lineterminator="\r\n" if seed % 3 == 0 else "\n")
    w.writerow(["b", "x\ny" if seed % 2 else "x", "a"])
    pieces = ["", " ", "é", "word", '"', '""', ",", "\n", '\n"', ',"', "\r\n", "long " * 30, "\n" * 200]
    for _ in range(150):
        w.writerow(["".join(rng.choices(pieces, weights=[9, 5, 5, 9, 2, 1, 3, 3, 1, 1, 1, 1, 0.2], k=rng.randrange(4))) for _ in range(2)] + [f"v{rng.randrange(9)}"])
        if rng.random() < 0.05:
            sink.write("\n")
            sink.write('5" pipe,1"2,z\n')  # quotes within a cell stand for themselves
    path = tmp_path / "f.csv"
    path.write_bytes(sink.getvalue().encode())
    got = read(spark, path)
    assert got == plain(sink.getvalue()) and len(got) > 149


def test_splits_wholly_within_a_cell(spark, tmp_path, small_splits):
    text = 'a,b\n1,"' + "x\n" * 2000 + '"\n2,"' + '"",\n' * 700 + '"\n3,z'
    (tmp_path / "f.csv").write_text(text)
    assert read(spark, tmp_path / "f.csv") == plain(text)


def test_several_files_and_none(spark, tmp_path):
    for i, rows in enumerate(["1,2\n", "", '3,"4\n5"\n']):
        (tmp_path / f"{i}.csv").write_text("a,b\n" + rows)
    (tmp_path / "empty.csv").write_text("")
    assert read(spark, tmp_path) == [repr(("1", "2")), repr(("3", "4\n5"))]
    (tmp_path / "other.csv").write_text("b,a\n1,2\n")
    with pytest.raises(HeaderError):
        read(spark, tmp_path)


def test_refusals(spark, tmp_path):
    at = tmp_path / "f.csv"
    for text, error in [("a,a,b\n", HeaderError), ("a\n1\n", HeaderError), ("", HeaderError), ('a,b\n1,"2\n', RowError)]:
        at.write_text(text)
        with pytest.raises(error):
            read(spark, at)
    for raw in [b"a,b\n1\n", b"a,b\n1,2,3\n", b"a,b\n1,\xff\n"]:
        at.write_bytes(raw)
        with pytest.raises(PythonException, match="RowError"):
            read(spark, at)
    at.write_text('a,b\n1,2\n\n3,"4\n"\n')
    assert len(read(spark, at, max_rows=2, max_bytes=16)) == 2
    for limit in ({"max_rows": 1}, {"max_bytes": 15}):
        with pytest.raises(RowError):
            read(spark, at, **limit)
    numbers = StructType().add("a", "integer").add("c", "string")
    assert [tuple(r) for r in read_delimited(spark, str(at), numbers, ["a"]).collect()] == [(1, None), (3, None)]


def test_states():
    for line, out, inn in [(b"a,b", False, True), (b'"', True, False), (b'a"b', False, False), (b'a,"b""', True, False), (b'x","', True, True), (b'""', False, True)]:
        assert (inside_after(line, False), inside_after(line, True)) == (out, inn)


def test_cells_longer_than_the_limit_of_the_csv_module(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1," + "é" * 150_000 + '\n2,"' + "x\n" * 100_000 + 'y"\n')
    assert {(r.a, len(r.b)) for r in read_delimited(spark, str(tmp_path), TWO).collect()} == {("1", 150_000), ("2", 200_001)}


@pytest.mark.parametrize("lines", [[b"1," + b"x" * 4000] * 10_000, [b'1,"'] + [b"xy"] * 400_000 + [b'"']])
def test_lines_of_a_batch_are_not_held_as_objects_together(lines):
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * len(lines), "split": pa.array([9] * len(lines), pa.int64()), "line": pa.array(lines, pa.binary()), "inside": [False] * len(lines)})
    for step, rows in ((D._functions, 1), (D._records(2, False), lines.count(lines[0])), (D._records(2, True), 0)):
        tracemalloc.start()
        got = sum(b.num_rows for b in step(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert got == rows
        assert peak < 24 * D.HELD
