"""Published snapshots: partitions, digests, a manifest, and a pointer that is put last."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def feed_partition(home: Column) -> Column:
    return F.coalesce(home, F.lit("international"))


def edge_partition(home: Column, country: Column) -> Column:
    """An edge's country if its feed is at home there, else ``links``."""
    return F.when(home == country, country).otherwise("links")


def split_columns(rows: DataFrame, keys: list[str], details: list[str]) -> tuple[DataFrame, DataFrame]:
    """Core rows without, and detail rows with the keys and only the on-demand columns."""
    return rows.select(*[c for c in rows.columns if c not in details]), rows.select(*keys, *details)


def with_details(core: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    return core.join(details, keys, "left")


def table_digest(rows: DataFrame) -> DataFrame:
    """One row, ``rows`` and ``digest``: of the rows as a multiset, in any order.

    Each row's digest is cut into four numbers whose sums, exact as decimals, make up the
    table's; sums combine in each task, so no list of digests is gathered.
    """
    row = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    return rows.agg(F.count("*").alias("rows"), *[p.alias(f"p{i}") for i, p in enumerate(parts)]).select("rows", F.sha2(F.concat_ws(",", F.col("rows").cast("string"), *[F.coalesce(F.col(f"p{i}").cast("string"), F.lit("")) for i in range(4)]), 256).alias("digest"))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is there whole or not at all: written beside its place, then renamed."""
    fs, at = _fs(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(beside, at):
        raise OSError(f"{path} can't be put in place")


def _read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())  # a manifest has a line per table


def write_note(spark: SparkSession, path: str, said: dict) -> None:
    _write_text(spark, path, json.dumps(said, sort_keys=True))


def read_note(spark: SparkSession, path: str) -> dict | None:
    """What :func:`write_note` wrote; null if it isn't there."""
    fs, at = _fs(spark, path)
    return json.loads(_read_text(spark, path)) if fs.exists(at) else None


class Superseded(RuntimeError):
    """Another writer has begun since."""


def claim(spark: SparkSession, root: str) -> int:
    """A number greater than that of every generation and every claim, which no other writer has.

    It is a file that is created if it isn't there, which the file system does at once; of two
    writers that try one number, one has it and the other tries the next.
    """
    number = max((int(g.split("-")[1]) for g in [*generations(spark, root), *_pointers(spark, root)]), default=-1)
    number = max([number, *_claims(spark, root)]) + 1
    while True:
        if _created(spark, f"{root}/claims/claim-{number:08d}"):
            return number
        number += 1


def _created(spark: SparkSession, path: str) -> bool:
    """Whether an empty file was made here, by this call alone; a mounted folder's own call does that where Hadoop's looks first."""
    fs, at = _fs(spark, path)
    fs.mkdirs(at.getParent())
    if at.toUri().getScheme() not in (None, "file"):
        return fs.createNewFile(at)
    try:
        os.close(os.open(at.toUri().getPath(), os.O_CREAT | os.O_EXCL))
    except FileExistsError:
        return False
    return True


def _claims(spark: SparkSession, root: str) -> list[int]:
    return [int(n.split("-")[1]) for n in _names(spark, f"{root}/claims", "claim-")]


def publish(tables: dict[str, DataFrame], root: str, partitions: dict[str, str] | None = None, keep: int = 3, pinned: Iterable[str] = (), claimed: int | None = None) -> str:
    """Write a generation of tables below ``root`` with its manifest, then point to it; the newest ``keep`` stay.

    A reader finds the old generation or the new, never a part: the pointer is put last. A
    pointer is a file of its own in ``current``, named after its generation, of which the
    greatest counts, so none is ever replaced or missing. Generations count on from the
    greatest present: each is numbered by a claim (see :func:`claim`), made here unless ``claimed``
    gives one. If a greater claim is there once all is written, another writer has begun
    since: nothing is published, and :class:`Superseded` raised. The one that is current and those ``pinned`` (which
    something else refers to) are never removed.
    """
    spark = next(iter(tables.values())).sparkSession
    number = claim(spark, root) if claimed is None else claimed
    name = f"gen-{number:08d}-{uuid.uuid4().hex[:8]}"
    manifest = {}
    for table, rows in tables.items():
        writer = rows.write.mode("error")
        if by := (partitions or {}).get(table):
            writer = writer.partitionBy(by)
        writer.parquet(f"{root}/{name}/{table}")
        own = table_digest(spark.read.schema(rows.schema).parquet(f"{root}/{name}/{table}").select(*rows.columns)).first()
        manifest[table] = {"rows": own["rows"], "digest": own["digest"], "schema": rows.schema.json()}
    _write_text(spark, f"{root}/{name}/manifest.json", json.dumps(manifest, sort_keys=True))
    if max(_claims(spark, root), default=number) > number:
        fs, at = _fs(spark, f"{root}/{name}")
        fs.delete(at, True)
        raise Superseded(f"generation {number} of {root}: another writer has begun since")
    _write_text(spark, f"{root}/current/{name}", name)
    for old in _claims(spark, root):
        if old < number:  # the greatest stays, so that numbers go on from it
            fs, at = _fs(spark, f"{root}/claims/claim-{old:08d}")
            fs.delete(at, False)
    live = {name, current(spark, root), *pinned}
    for old in generations(spark, root)[: -keep or None]:
        if old not in live:
            for path in (f"{root}/current/{old}", f"{root}/{old}"):  # what names it goes first
                fs, at = _fs(spark, path)
                fs.delete(at, True)
    return name


def _names(spark: SparkSession, folder: str, begin: str = "gen-") -> list[str]:
    fs, at = _fs(spark, folder)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().startswith(begin))


def generations(spark: SparkSession, root: str) -> list[str]:
    return _names(spark, root)


def _pointers(spark: SparkSession, root: str) -> list[str]:
    return _names(spark, f"{root}/current")


def current(spark: SparkSession, root: str) -> str:
    """The generation that readers find."""
    pointers = _pointers(spark, root)
    if not pointers:
        raise FileNotFoundError(f"nothing is published in {root}")
    return pointers[-1]


def resolve(spark: SparkSession, root: str, verify: bool = True, tries: int = 3) -> dict[str, DataFrame]:
    """The tables of the generation that is current; with ``verify`` each is counted and digested first.

    Where the generation has gone by the time it is read, as others were published, the one
    that is current then is read, up to ``tries`` times.
    """
    for left in reversed(range(tries)):
        name = current(spark, root)
        try:
            return _tables(spark, root, name, verify)
        except Exception:
            if not left or current(spark, root) == name:
                raise
    raise AssertionError("unreachable")


def _tables(spark: SparkSession, root: str, name: str, verify: bool) -> dict[str, DataFrame]:
    tables = {}
    for table, said in json.loads(_read_text(spark, f"{root}/{name}/manifest.json")).items():
        schema = StructType.fromJson(json.loads(said["schema"]))
        rows = spark.read.schema(schema).parquet(f"{root}/{name}/{table}").select(*schema.names)
        if verify:
            own = table_digest(rows).first()
            if (own["rows"], own["digest"]) != (said["rows"], said["digest"]):
                raise ValueError(f"{table} of {name} isn't what its manifest says")
        tables[table] = rows
    return tables
