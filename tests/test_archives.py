"""Archives by ranges, against the zipfile module over the whole file."""

import io
import os
import struct
import zipfile

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from spanroute.sinks.archives import write_archives
from spanroute.sources import archives as A

WANTED = ["stops.txt", "routes.txt"]


def make(path, members, comment=b"", method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, content in members:
            z.writestr(name, content)
        z.comment = comment
    return path


def read_of(data):
    return lambda n, start: data[start : start + n]


def test_entries_and_content_as_zipfile():
    big = os.urandom(3 << 20) + b"a" * (5 << 20)
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        sink = io.BytesIO()
        make(sink, [("a/", ""), ("a/é.txt", "x"), ("big", big), ("none", "")], b"note", method)
        data = sink.getvalue()
        entries = A.entries_of(read_of(data), len(data))
        marked = data[:-6] + struct.pack("<H", 44) + A.END_MARK + b"z" * 40  # a comment with the mark of an end record
        assert A.entries_of(read_of(marked), len(marked)) == entries
        with zipfile.ZipFile(sink) as z:
            assert [e["member"] for e in entries] == z.namelist()
            assert [b"".join(A.unpacked(read_of(data), e)) for e in entries] == [z.read(n) for n in z.namelist()]
            blocks = list(A.unpacked(read_of(data), entries[2]))
            assert max(map(len, blocks)) <= A.BLOCK


def test_streamed_members_have_a_descriptor():
    class Pipe(io.RawIOBase):
        def __init__(self):
            self.data = b""

        def writable(self):
            return True

        def write(self, b):
            self.data += bytes(b)
            return len(b)

    pipe = Pipe()
    with zipfile.ZipFile(pipe, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("stops.txt", "stop_id\n1\n")
    (entry,) = A.entries_of(read_of(pipe.data), len(pipe.data))
    assert entry["flags"] & A.DESCRIPTOR and b"".join(A.unpacked(read_of(pipe.data), entry)) == b"stop_id\n1\n"


def test_refusals():
    sink = io.BytesIO()
    make(sink, [("stops.txt", "stop_id\n" + "1\n" * 500)])
    data = sink.getvalue()
    at = data.index(A.ENTRY_MARK)
    for bad in (b"", b"short", data[:-1], data[:at] + b"XX" + data[at + 2 :], data[: at + 8] + b"\1" + data[at + 9 :], data[: at + 10] + b"\x0c" + data[at + 11 :]):
        with pytest.raises(A.ArchiveError):
            A.entries_of(read_of(bad), len(bad))
    (entry,) = A.entries_of(read_of(data), len(data))
    with pytest.raises(A.ArchiveError):  # larger than it says
        list(A.unpacked(read_of(data), {**entry, "size": 100}))
    changed = data[:14] + struct.pack("<I", entry["crc"] ^ 1) + data[18:]
    with pytest.raises(A.ArchiveError):
        list(A.unpacked(read_of(changed), entry))
    with pytest.raises(A.ArchiveError):
        list(A.unpacked(read_of(changed), {**entry, "crc": entry["crc"] ^ 1}))


@pytest.fixture
def folder(tmp_path):
    at = tmp_path / "with space"
    at.mkdir()
    stops = '﻿stop_id, stop_name ,stop_id\r\n1,"a\n""b"""\r\n\r\n2\r\n3,c,4,5\r\n'
    make(at / "flat.zip", [("STOPS.TXT", stops), ("stops.txt", "stop_id\n9\n"), ("__MACOSX/routes.txt", "x"), ("feed_info.txt", "feed_id\n\n")])
    make(at / "deep.zip", [("x/y/stops.txt", "stop_id\n8\n"), ("x/stops.txt", "stop_id\n7\n"), ("x/routes.txt", "route_id\nr")])
    make(at / "two.zip", [("x/stops.txt", "stop_id\n5\n"), ("z/stops.txt", "stop_id\n6\n")])
    inner = make(io.BytesIO(), [("stops.txt", "stop_id\n4\n")]).getvalue()
    make(at / "nested.zip", [("in/feed.zip", inner), ("__MACOSX/x", "")])
    (at / "broken.zip").write_bytes(b"no archive")
    return at


def test_roots_and_tables(spark, folder):
    entries = A.directory(spark, str(folder))
    name = F.regexp_extract("path", r"([a-z]+)\.zip$", 1).alias("file")
    got = A.read_table(A.chosen(entries, WANTED).where("name = 'stops.txt'"), ["stop_id", "stop_name", "absent"]).select(name, "row", "stop_id", "stop_name", "absent")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("deep", 1, "7", None, None), ("flat", 1, "1", 'a\n"b"', None), ("flat", 2, "2", None, None), ("flat", 3, "3", "c", None), ("nested", 1, "4", None, None),
    ]
    named = A.read_table(A.chosen(entries, WANTED, "z").where("name = 'stops.txt'"), ["stop_id"]).select(name, "stop_id")
    assert ("two", "6") in {tuple(r) for r in named.collect()}
    files = {r["file"]: (r["files"], r["empty_files"]) for r in A.root_files(entries, WANTED).select(name, "files", "empty_files").collect()}
    assert files == {"flat": (["STOPS.TXT", "feed_info.txt"], ["feed_info.txt"]), "deep": (["routes.txt", "stops.txt"], []), "two": ([], []), "nested": (["stops.txt"], [])}
    errors = {tuple(r) for r in entries.where("error is not null").select(name, "error").collect()}
    assert errors == {("broken", "no end record")}


def test_damaged_members_are_told(spark, tmp_path):
    path = make(tmp_path / "f.zip", [("stops.txt", "stop_id\n" + "123\n" * 99), ("routes.txt", "route_id\n1\n")], method=zipfile.ZIP_STORED)
    data = path.read_bytes()
    path.write_bytes(data.replace(b"123\n", b"124\n", 1))
    entries = A.directory(spark, str(tmp_path))
    assert {tuple(r) for r in A.verified(entries).select("member", F.col("error").isNull()).collect()} == {("stops.txt", False), ("routes.txt", True)}
    with pytest.raises(PythonException, match="ArchiveError"):
        A.read_table(A.chosen(entries, WANTED), ["stop_id"]).collect()


def test_written_archives_follow_from_their_members(spark, tmp_path):
    rows = [("a", "x.txt", b"1"), ("a", "b/y.txt", b"2" * 1000), ("b", "x.txt", b"")]
    one = write_archives(spark.createDataFrame(rows, "archive string, member string, content binary"), str(tmp_path / "1"))
    two = write_archives(spark.createDataFrame(rows[::-1], "archive string, member string, content binary"), str(tmp_path / "2"))
    assert sorted(one) == sorted(two) and sorted(os.listdir(tmp_path / "1")) == ["a.zip", "b.zip"]
    assert zipfile.ZipFile(tmp_path / "1" / "a.zip").read("b/y.txt") == b"2" * 1000
