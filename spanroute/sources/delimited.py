"""Delimited files read in parts: a large file with quoted line ends is still read by many tasks.

A quoted cell may hold line ends, so whether a split of a file begins within a cell depends on
all that comes before it. Each split is walked once from both states, which gives it a function
from the state at its start to that at its end; these functions are composed over the splits of
a file, and then every split knows where its first record begins. Records that lie in several
splits are put together from their fragments.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanroute.sinks.scratch import written

from .files import HeaderError

MARK = b"\xef\xbb\xbf"  # fixed value: the byte order mark of UTF-8
#: Bytes of lines that are Python objects at a time; one line or record may be longer.
HELD = 1 << 20
LINE = 64  # bytes that a line takes as an object besides its own
SPLIT = pa.schema([("file", pa.string()), ("split", pa.int64()), ("header", pa.binary()), ("bytes", pa.int64()), ("ends_out", pa.bool_()), ("ends_in", pa.bool_()), ("begun_out", pa.int64()), ("begun_in", pa.int64())])
PIECE = pa.schema([("file", pa.string()), ("split", pa.int64()), ("begins", pa.bool_()), ("text", pa.binary())])
CELLS = pa.schema([("cells", pa.list_(pa.string()))])

csv.field_size_limit(sys.maxsize)  # a cell may be longer than the 131,072 characters that the module allows


class RowError(ValueError):
    """A file whose rows don't fit its header, its encoding or the limits."""


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open after a line; a quote opens a cell only at its beginning."""
    at = 0
    if not inside:
        if line[:1] == b'"':
            at = 1
        elif (at := line.find(b',"') + 2) == 1:
            return False
    while (at := line.find(b'"', at)) >= 0:
        if line[at : at + 2] == b'""':
            at += 2
        elif (at := line.find(b',"', at + 1) + 2) == 1:
            return False
    return True


def cells_of(record: bytes | bytearray, where: str) -> list[str | None]:
    """Cells of a record, trimmed, blank ones null; none at all for a blank record."""
    try:
        (row,) = csv.reader([record.removesuffix(b"\r").decode()])
    except (UnicodeDecodeError, csv.Error) as error:
        raise RowError(f"{where}: {error}") from None
    return [c.strip() or None for c in row]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, split, line as bytes; a partition has the lines of a split in their order."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("line"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch, bool]]:
    """Runs of rows of one split, of some ``HELD`` bytes at most, each with whether the split begins there.

    A batch has up to 10,000 lines, which may be long: it stays in Arrow, and one run at a time becomes Python objects.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split = batch.column("file"), batch.column("split")
        lengths = pc.binary_length(batch.column("line")).to_numpy(zero_copy_only=False).astype(np.int64)
        block = np.cumsum(lengths + LINE) // HELD
        cut = (np.diff(block) != 0) | (np.diff(split.to_numpy()) != 0) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        for begin, end in pairwise([0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]):
            key = file[begin].as_py(), split[begin].as_py()
            yield *key, batch.slice(begin, end - begin), key != last
            last = key


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: the state after it and the records begun in it, from outside and from inside a cell."""
    at, out = None, None
    for file, split, run, begins in _by_split(batches):
        if begins:
            if at:
                yield pa.RecordBatch.from_pylist([out], SPLIT)
            at, out = (file, split), {"file": file, "split": split, "header": None, "bytes": 0, "ends_out": False, "ends_in": True, "begun_out": 0, "begun_in": 0}
            head = bytearray() if split == 0 else None
        for n, line in enumerate(run.column("line").to_pylist()):
            out["bytes"] += len(line) + 1
            if begins and n == 0 and split == 0:
                line = line.removeprefix(MARK)
            filled = line not in (b"", b"\r")
            out["begun_out"] += filled and not out["ends_out"]
            out["begun_in"] += filled and not out["ends_in"]
            out["ends_out"], out["ends_in"] = inside_after(line, out["ends_out"]), inside_after(line, out["ends_in"])
            if head is not None and (head or filled):
                head += line + b"\n"
                if not out["ends_out"]:
                    out["header"], head = bytes(head[:-1]), None
    if at:
        yield pa.RecordBatch.from_pylist([out], SPLIT)


def splits_of(lines: DataFrame) -> DataFrame:
    """A row per split with ``inside``, whether it begins within a cell, and ``ends`` and ``begun`` for that state.

    The state before a split is that of the last split whose end is the same from both states,
    turned once for each split since then that turns it. A window has one row per split of a file.
    """
    schema = "file string, split long, header binary, bytes long, ends_out boolean, ends_in boolean, begun_out long, begun_in long"
    each = lines.mapInArrow(_functions, schema)
    turns = F.sum((F.col("ends_out") & ~F.col("ends_in")).cast("long")).over(Window.partitionBy("file").orderBy("split"))
    fixed = F.when(F.col("ends_out") == F.col("ends_in"), F.struct(F.col("ends_out").alias("state"), F.col("turns")))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("turns", turns)
    each = each.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before)).withColumn("earlier", F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("split")), F.lit(0)))
    turned = (F.col("earlier") - F.coalesce(F.col("fixed.turns"), F.lit(0))) % 2 == 1
    each = each.withColumn("inside", F.coalesce(F.col("fixed.state"), F.lit(False)) != turned)
    pick = lambda c: F.when(F.col("inside"), F.col(f"{c}_in")).otherwise(F.col(f"{c}_out"))
    return each.select("file", "split", "header", "bytes", "inside", pick("ends").alias("ends"), pick("begun").alias("begun"))


def _records(width: int, fragments: bool):
    """Whole records of splits as cells or, instead, what lies before the first and after the last of them."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bytearray()  # lines of the record being read, each with its end
        at, inside, first, headed = None, False, False, True

        def rest() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": at[0], "split": at[1], "begins": not first, "text": bytes(held[:-1])}], PIECE)

        for file, split, run, begins in _by_split(batches):
            if begins:
                if fragments and at and held:
                    yield rest()
                at, held, inside = (file, split), bytearray(), run.column("inside")[0].as_py()
                first, headed = inside, split > 0
            done = []
            for n, line in enumerate(run.column("line").to_pylist()):
                if begins and n == 0 and split == 0:
                    line = line.removeprefix(MARK)
                if not held and not inside and line in (b"", b"\r"):
                    continue
                if fragments or not first:
                    held += line + b"\n"
                inside = inside_after(line, inside)
                if inside:
                    continue
                if first:  # the end of a record that began in an earlier split
                    if fragments:
                        yield rest()
                elif not headed:
                    headed = True
                elif not fragments:
                    held.pop()
                    done.append(cells_of(held, f"{file} from byte {split}"))
                    if len(done[-1]) != width:
                        raise RowError(f"{file} from byte {split}: {len(done[-1])} cells for {width} columns")
                held, first = bytearray(), False
            if done:
                yield pa.RecordBatch.from_pydict({"cells": done}, CELLS)
        if fragments and at and held:
            yield rest()

    return walk


def read_delimited(spark: SparkSession, path: str, schema: StructType, required: list[str] | None = None, *, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Rows of comma-separated files with one header, read in parts whatever their quoted cells hold.

    The header must name every required column (all of ``schema`` unless given) and none twice;
    the files of one read have the same header. Columns are taken by name, others are left out,
    and one of ``schema`` that isn't required may be absent (null). Cells are trimmed and blank
    ones are null. Blank lines aren't rows; a file without lines has none. An error is raised for
    a row with more or fewer cells than the header, bytes that aren't UTF-8, a cell that isn't of
    its type or is still open where the file ends, and more rows or bytes than the limits, which
    are counted by the first pass, before any row is made.

    Splits that begin within a cell are broadcast: they are at most those that the driver lists for the scan.
    """
    lines = _lines(spark, path)
    splits = written(splits_of(lines))
    last = splits.groupBy("file").agg(F.max_by("ends", "split").alias("open"), F.sum("bytes").alias("bytes"), F.sum("begun").alias("begun"), F.max("header").alias("header"))
    total = last.agg(
        F.max("open").alias("open"), F.sum("bytes").alias("bytes"), F.sum(F.col("begun") - F.col("header").isNotNull().cast("long")).alias("rows"),
        F.min("header").alias("least"), F.max("header").alias("most"), F.max(F.col("header").isNull() & (F.col("begun") > 0)).alias("cut"),
    ).first()
    if total["open"]:
        raise RowError(f"{path}: a file ends within a quoted cell")
    if total["least"] != total["most"] or total["cut"]:
        raise HeaderError(f"{path}: files with different headers, or a header longer than a split")
    header = cells_of(bytes(total["most"]), path) if total["most"] is not None else []
    wanted = schema.names if required is None else required
    if bad := [c for c in wanted if c not in header] + [c for c in header if c is not None and header.count(c) > 1]:
        raise HeaderError(f"{path}: {sorted(set(bad))} missing or repeated")
    if max_bytes is not None and total["bytes"] > max_bytes:
        raise RowError(f"{path}: {total['bytes']} bytes, more than {max_bytes}")
    if max_rows is not None and total["rows"] > max_rows:
        raise RowError(f"{path}: {total['rows']} rows, more than {max_rows}")

    width = len(header)
    begun_inside = splits.where("inside").select("file", "split", "inside")
    known = lines.join(F.broadcast(begun_inside), ["file", "split"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    whole = known.mapInArrow(_records(width, False), "cells array<string>")
    at_ends = F.broadcast(splits.where("inside or ends").select("file", "split"))
    pieces = known.join(at_ends, ["file", "split"]).mapInArrow(_records(width, True), "file string, split long, begins boolean, text binary")
    order = Window.partitionBy("file").orderBy("split", "begins")
    numbered = pieces.withColumn("record", F.sum(F.col("begins").cast("long")).over(order))
    together = numbered.groupBy("file", "record").agg(F.transform(F.array_sort(F.collect_list(F.struct("split", "begins", "text"))), lambda p: p["text"]).alias("texts"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, texts in zip(batch.column("file"), batch.column("texts"), strict=True):
                row = cells_of(b"\n".join(texts.as_py()), file.as_py())
                if len(row) != width:
                    raise RowError(f"{file}: a row that doesn't have {width} cells")
                yield pa.RecordBatch.from_pydict({"cells": [row]}, CELLS)

    rows = whole.unionByName(together.mapInArrow(cells, "cells array<string>"))
    return rows.select(*[F.get("cells", F.lit(header.index(f.name))).cast(f.dataType).alias(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
