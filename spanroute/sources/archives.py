"""Members of zip archives read by ranges: the end record, the directory, then only what is wanted.

An archive is never read whole (but one zipped within another, which is held in memory up to
MAX_NESTED bytes). Each member is a task of its own and streams through a window of BLOCK bytes.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import MARK, RowError, cells_of, inside_after

# fixed values: records of the zip format, their marks and limits
END, ENTRY, LOCAL = struct.Struct("<4s4H2IH"), struct.Struct("<4s6H3I5H2I"), struct.Struct("<4s5H3I2H")
END_MARK, ENTRY_MARK, LOCAL_MARK = b"PK\x05\x06", b"PK\x01\x02", b"PK\x03\x04"
ENCRYPTED, DESCRIPTOR, UTF8 = 1, 8, 2048
STORED, DEFLATED = 0, 8
MOST_16, MOST_32 = 0xFFFF, 0xFFFFFFFF

BLOCK = 1 << 20
MAX_DIRECTORY = 64 << 20
MAX_NESTED = 256 << 20
PROBED = 64 << 10

FIELDS = "path string, bytes long, within string, member string, place int, flags int, method int, crc long, packed long, size long, at long, limit long, error string"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
Read = Callable[[int, int], bytes]


class ArchiveError(ValueError):
    """An archive or a member that can't be read by ranges."""


def _ranges(uri: str) -> Read:
    system, at = fs.FileSystem.from_uri(uri)
    source = system.open_input_file(at)
    return lambda n, start: source.read_at(n, start)


def _part(read: Read, n: int, start: int) -> bytes:
    data = read(n, start)
    if len(data) != n:
        raise ArchiveError(f"{len(data)} of {n} bytes at {start}")
    return data


def entries_of(read: Read, size: int) -> list[dict]:
    """Entries of an archive's directory; names twice, encryption, 64-bit records and odd offsets are refused."""
    start = max(0, size - END.size - MOST_16)
    tail = _part(read, size - start, start)
    whole = [m.start() for m in re.finditer(END_MARK, tail) if m.start() + END.size <= len(tail)]
    ends = [p for p in whole if p + END.size + END.unpack_from(tail, p)[-1] == len(tail)]  # a comment may hold the mark too
    if not ends:
        raise ArchiveError("no end record")
    _, disk, first, here, count, length, begin, _ = END.unpack_from(tail, ends[-1])
    if disk or first or here != count or count == MOST_16 or MOST_32 in (length, begin):
        raise ArchiveError("several disks or 64-bit records")
    if begin + length != start + ends[-1] or length > MAX_DIRECTORY:
        raise ArchiveError("a directory that doesn't end at the end record, or is too large")
    data, p, out = _part(read, length, begin), 0, {}
    for place in range(count):
        if data[p : p + 4] != ENTRY_MARK or p + ENTRY.size > length:
            raise ArchiveError("a broken entry")
        _, _, _, flags, method, _, _, crc, packed, full, name_n, extra_n, note_n, disk, _, _, at = ENTRY.unpack_from(data, p)
        raw = data[p + ENTRY.size : p + ENTRY.size + name_n]
        p += ENTRY.size + name_n + extra_n + note_n
        try:
            name = raw.decode("utf-8" if flags & UTF8 else "cp437")
        except UnicodeDecodeError:
            raise ArchiveError(f"name {raw!r}") from None
        if p > length or flags & ENCRYPTED or method not in (STORED, DEFLATED) or disk or MOST_32 in (packed, full, at) or name in out:
            raise ArchiveError(f"entry {name!r} is cut, encrypted, packed in an unknown way, 64-bit or there twice")
        if at + LOCAL.size + packed > begin:
            raise ArchiveError(f"entry {name!r} reaches into the directory")
        out[name] = {"member": name, "place": place, "flags": flags, "method": method, "crc": crc, "packed": packed, "size": full, "at": at, "limit": begin}
    if p != length:
        raise ArchiveError("bytes behind the last entry")
    return list(out.values())


def unpacked(read: Read, entry: dict) -> Iterator[bytes]:
    """Blocks of a member; its size and CRC are checked at its end, its local header at the beginning."""
    _, _, flags, method, _, _, crc, packed, size, name_n, extra_n = LOCAL.unpack((head := _part(read, LOCAL.size, entry["at"])))
    at = entry["at"] + LOCAL.size + name_n + extra_n
    blank = (0,) if entry["flags"] & DESCRIPTOR else ()
    same = all(v == entry[k] or v in blank for k, v in (("crc", crc), ("packed", packed), ("size", size)))
    name = _part(read, name_n, entry["at"] + LOCAL.size).decode("utf-8" if flags & UTF8 else "cp437", "replace")
    if head[:4] != LOCAL_MARK or (flags, method, name) != (entry["flags"], entry["method"], entry["member"]) or not same or at + entry["packed"] > entry["limit"]:
        raise ArchiveError(f"{entry['member']}: the header differs from the directory")
    end, engine, seen, crc = at + entry["packed"], zlib.decompressobj(-15), 0, 0
    while at < end:
        raw = _part(read, min(BLOCK, end - at), at)
        at += len(raw)
        while True:
            if entry["method"] == STORED:
                out, raw = raw, b""
            else:
                try:
                    out = engine.decompress(raw, BLOCK)
                except zlib.error as error:
                    raise ArchiveError(f"{entry['member']}: {error}") from None
                raw = engine.unconsumed_tail
            seen, crc = seen + len(out), zlib.crc32(out, crc)
            if seen > entry["size"]:
                raise ArchiveError(f"{entry['member']} is larger than its entry says")
            if out:
                yield out
            if not raw and (len(out) < BLOCK or entry["method"] == STORED):
                break
    if seen != entry["size"] or crc != entry["crc"] or (entry["method"] == DEFLATED and not engine.eof):
        raise ArchiveError(f"{entry['member']} isn't what its entry says")


def _inner(read: Read, entry: dict) -> bytes:
    if entry["size"] > MAX_NESTED:
        raise ArchiveError(f"{entry['member']}: an archive within an archive of more than {MAX_NESTED} bytes")
    return b"".join(unpacked(read, entry))


def _source(row: dict) -> Read:
    """Ranges of the archive that an entry's places count in, the inner one where it is nested."""
    read = _ranges(row["path"])
    if row["within"] is None:
        return read
    data = _inner(read, next(e for e in entries_of(read, row["bytes"]) if e["member"] == row["within"]))
    return lambda n, start: data[start : start + n]


def _frame(rows: list[dict]) -> pd.DataFrame:
    """Entries as a batch; fields that a row lacks are null."""
    return pd.DataFrame([[r.get(n) for n in NAMES] for r in rows], columns=NAMES, dtype=object)


def _entries(batch: pd.DataFrame) -> list[dict]:
    """Rows of a batch, with whole numbers also where others are null."""
    rows = batch.astype(object).where(batch.notna(), None).to_dict("records")
    return [{k: int(v) if isinstance(v, float) else v for k, v in r.items()} for r in rows]


def _files(names: list[str]) -> list[str]:
    return [n for n in names if not n.endswith("/") and not n.startswith("__MACOSX/")]


def directory(spark: SparkSession, path: str) -> DataFrame:
    """A row per member of the archives at a path; of one that holds an archive alone, the members of that.

    An archive that can't be read has one row with ``error``. Only ends of files are read here.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size in zip(batch["path"], batch["bytes"], strict=True):
                rows, within = [], None
                try:
                    rows = entries_of(_ranges(path), int(size))
                    files = _files([r["member"] for r in rows])
                    if len(files) == 1 and files[0].lower().endswith(".zip"):
                        within = files[0]
                        data = _inner(_ranges(path), next(r for r in rows if r["member"] == within))
                        rows = entries_of(lambda n, start, data=data: data[start : start + n], len(data))
                except ArchiveError as error:
                    rows = [{"error": str(error)}]
                yield _frame([{"path": path, "bytes": size, "within": within, **r} for r in rows])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes")).mapInPandas(read, FIELDS)


def chosen(entries: DataFrame, wanted: list[str], folder: str | None = None) -> DataFrame:
    """Entries right under an archive's root, with ``name`` (without the root, in lower case).

    The root is the named folder where an archive has it; else the one nearest the top that holds
    a wanted file, whatever its case; where several are as near, there is none. Of names that
    differ in case only, the first counts.
    """
    files = entries.where(F.col("error").isNull() & ~F.endswith("member", F.lit("/")) & ~F.startswith("member", F.lit("__MACOSX/")))
    base = F.substring_index("member", "/", -1)
    files = files.withColumns({"base": base, "root": F.expr("left(member, length(member) - length(substring_index(member, '/', -1)))")})
    if folder is None:
        named = F.lit(False)
    else:
        named = F.startswith("member", F.lit(f"{folder}/"))
    known = F.lower("base").isin([w.lower() for w in wanted])
    depth = F.size(F.split("root", "/"))
    levels = files.groupBy("path", depth.alias("depth")).agg(F.min(F.when(known, F.col("root"))).alias("least"), F.max(F.when(known, F.col("root"))).alias("most"), F.max(named).alias("named"))
    nearest = F.min_by(F.struct("least", "most"), F.when(F.col("least").isNotNull(), F.col("depth")))
    roots = levels.groupBy("path").agg(nearest.alias("near"), F.max("named").alias("named"))
    at = F.when(F.col("named"), F.lit(f"{folder}/")).when(F.col("near.least") == F.col("near.most"), F.col("near.least"))
    met = files.join(roots.select("path", at.alias("top")), "path").where("root = top")
    first = F.min_by(F.struct(*NAMES), "place")
    return met.groupBy("path", F.lower("base").alias("name")).agg(first.alias("e")).select("e.*", "name")


def _rows_of(row: dict) -> Iterator[list[str | None]]:
    """Records of a delimited member, its header first, blank lines left out."""
    held, rest, inside, where = [], b"", False, f"{row['path']}: {row['member']}"

    def lines() -> Iterator[bytes]:
        nonlocal rest
        for block in unpacked(_source(row), row):
            *whole, rest = (rest + block).split(b"\n")
            yield from whole
        yield rest

    for n, line in enumerate(lines()):
        line = line.removeprefix(MARK) if n == 0 else line
        if not held and line in (b"", b"\r"):
            continue
        held.append(line)
        if not (inside := inside_after(line, inside)):
            yield cells_of(b"\n".join(held), where)
            held = []
    if held and held != [b""]:
        raise RowError(f"{where} ends within a quoted cell")


def read_table(entries: DataFrame, columns: list[str], batch: int = 4096) -> DataFrame:
    """path, row, and columns by name of delimited members, each read by one task.

    Cells are trimmed and blank ones null; of repeated names the first counts, absent columns
    and missing cells are null, cells beyond the header are left out.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch_ in batches:
            for row in _entries(batch_):
                rows = _rows_of(row)
                header = next(rows, [])
                places = [header.index(c) if c in header else None for c in columns]
                out, n = [], 0
                for n, cells in enumerate(rows, 1):
                    out.append((row["path"], n, *(cells[p] if p is not None and p < len(cells) else None for p in places)))
                    if len(out) == batch:
                        yield pd.DataFrame(out, columns=["path", "row", *columns], dtype=object)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=["path", "row", *columns], dtype=object)

    schema = "path string, row long, " + ", ".join(f"`{c}` string" for c in columns)
    return entries.select(NAMES).repartition("path", "member").mapInPandas(read, schema)


def verified(entries: DataFrame) -> DataFrame:
    """Entries with ``error`` where a member's size, header or CRC isn't what the directory says; content goes nowhere."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = _entries(batch)
            for row in rows:
                try:
                    for _ in unpacked(_source(row), row):
                        pass
                except ArchiveError as error:
                    row["error"] = str(error)
            yield _frame(rows)

    good = entries.select(NAMES).where("error is null").repartition("path", "member").mapInPandas(read, FIELDS)
    return entries.select(NAMES).where("error is not null").unionByName(good)


def root_files(entries: DataFrame, wanted: list[str], folder: str | None = None) -> DataFrame:
    """path, bytes, files (names in printable ASCII under the root, sorted), sizes by file, and empty_files.

    Empty is a ``.txt`` file of up to PROBED bytes without a row behind its header; one that can't
    be read counts as having rows. An archive without a root has no files.
    """

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = _entries(batch)
            for row in rows:
                try:
                    row["empty"] = len([None for _, _ in zip(_rows_of(row), range(2), strict=False)]) < 2
                except (ArchiveError, RowError):
                    row["empty"] = False
            yield pd.DataFrame([(r["path"], r["member"], r["empty"]) for r in rows], columns=["path", "member", "empty"])

    file = F.substring_index("member", "/", -1)
    found = chosen(entries, wanted, folder).where(file.rlike(r"^[\x20-\x7e]+$"))
    asked = found.where(F.endswith("name", F.lit(".txt")) & (F.col("size") <= PROBED)).select(NAMES).repartition("path", "member")
    probed = asked.mapInPandas(probe, "path string, member string, empty boolean")
    each = found.join(probed, ["path", "member"], "left").groupBy("path").agg(
        F.sort_array(F.collect_list(file)).alias("files"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(file, "size")))).alias("sizes"),
        F.sort_array(F.collect_list(F.when(F.col("empty"), file))).alias("empty_files"),
    )
    none = F.array().cast("array<string>")
    all_ = entries.where("error is null").select("path", "bytes").distinct().join(each, "path", "left")
    return all_.withColumns({"files": F.coalesce("files", none), "empty_files": F.coalesce("empty_files", none)})
