"""Files of catalogues, timetables and snapshots, read with declared schemas."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class HeaderError(ValueError):
    """A file without the columns that it must have, or with one twice."""


def header_of(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return [c.strip().strip('"').lstrip("﻿") for c in first[0][0].split(",")] if first else []


def read_csv(spark: SparkSession, path: str, schema: StructType, required: list[str] | None = None) -> DataFrame:
    """Rows of a CSV file with a header; blank cells are null.

    The header must name each required column once; columns are taken by name, whatever
    their order, others are left out. A cell that isn't of its type fails the read.
    """
    header = header_of(spark, path)
    wanted = required if required is not None else schema.names
    if missing := [c for c in wanted if header.count(c) != 1]:
        raise HeaderError(f"{path}: {missing} missing or repeated")
    kinds = {f.name: f.dataType for f in schema}
    text = StructType()
    for i, c in enumerate(header):
        text = text.add(c if header.index(c) == i else f"{c}_{i}", "string")  # of repeated names the first counts
    rows = spark.read.schema(text).option("header", True).option("enforceSchema", True).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(*[F.nullif(F.trim(c), F.lit("")).cast(kinds[c]).alias(c) if c in header else F.lit(None).cast(kinds[c]).alias(c) for c in schema.names])


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Canonical lines: fields in order of their names, nulls written out."""
    rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def read_partitions(parts: dict[str, DataFrame]) -> DataFrame:
    """Tables of several partitions as one, with ``partition``; columns that one lacks are null there."""
    out = None
    for name, rows in parts.items():
        rows = rows.withColumn("partition", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def scan_boxes(rows: DataFrame, windows: list[tuple[float, float, float, float]]) -> DataFrame:
    """Rows whose bbox touches one of some windows, as a filter that reaches the scan's statistics; never their hull."""
    any_ = F.lit(False)
    for w, s, e, n in windows:
        any_ = any_ | ((F.col("bbox.xmax") >= w) & (F.col("bbox.xmin") <= e) & (F.col("bbox.ymax") >= s) & (F.col("bbox.ymin") <= n))
    return rows.where(any_)


# --- catalogues ------------------------------------------------------------------------

MAX_MEMBER = 64 << 20


def read_archives(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """path, member, text of the JSON documents in tar.gz archives; an archive is read in one task, member by member.

    A member that expands beyond MAX_MEMBER bytes fails the read.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as archive:
                    for m in archive:
                        if m.isfile() and m.name.endswith(suffix):
                            if m.size > MAX_MEMBER:
                                raise ValueError(f"{m.name} is larger than {MAX_MEMBER} bytes")
                            yield pd.DataFrame({"path": [path], "member": [m.name], "text": [archive.extractfile(m).read().decode()]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(members, "path string, member string, text string")


FEED = "array<struct<id:string,spec:string,name:string,urls:map<string,string>,license:map<string,string>,operators:array<struct<onestop_id:string,name:string>>,associated_feeds:array<string>>>"


def feeds_of(documents: DataFrame) -> DataFrame:
    """A row per feed that documents (member, text) of a catalogue list, with typed fields."""
    listed = documents.select("member", F.explode(F.from_json("text", f"struct<feeds:{FEED}>")["feeds"]).alias("f"))
    spec = F.when(F.lower("f.spec").isin("gtfs", "gtfs-rt", "gbfs"), F.lower("f.spec"))
    return listed.select("member", F.col("f.id").alias("onestop_id"), spec.alias("spec"), "f.name", F.col("f.urls").alias("urls"), F.col("f.operators").alias("operators")).where("onestop_id is not null and spec is not null")


def operators_of(documents: DataFrame) -> DataFrame:
    """A row per operator that documents (member, text) list: member, place in it, id, name, ids of its feeds."""
    fields = "array<struct<onestop_id:string,name:string,associated_feeds:array<struct<feed_onestop_id:string>>>>"
    listed = documents.select("member", F.posexplode(F.from_json("text", f"struct<operators:{fields}>")["operators"]).alias("place", "o"))
    feeds = F.coalesce(F.filter(F.col("o.associated_feeds")["feed_onestop_id"], lambda f: f.isNotNull()), F.array().cast("array<string>"))
    return listed.select("member", "place", F.col("o.onestop_id").alias("onestop_id"), F.col("o.name").alias("name"), feeds.alias("feeds")).where("onestop_id is not null")


def merged_operators(operators: DataFrame) -> DataFrame:
    """onestop_id, name of its first listing (by member and place), ``listings``, ``feeds`` of all of them; more than one is a collision."""
    names = operators.groupBy("onestop_id").agg(F.min_by("name", F.struct("member", "place")).alias("name"), F.count("*").alias("listings"))
    feeds = operators.select("onestop_id", F.explode("feeds").alias("feed")).distinct().groupBy("onestop_id").agg(F.sort_array(F.collect_list("feed")).alias("feeds"))
    return names.join(feeds, "onestop_id", "left").withColumn("feeds", F.coalesce("feeds", F.array().cast("array<string>")))


def repeated_feeds(feeds: DataFrame) -> DataFrame:
    """onestop_id of feeds declared more than once, with the first and last member that does."""
    return feeds.groupBy("onestop_id").agg(F.count("*").alias("n"), F.min("member").alias("first"), F.max("member").alias("last")).where("n > 1").drop("n")


def catalogue_rows(rows: DataFrame, number: list[str], lists: list[str], flags: list[str]) -> DataFrame:
    """Typed columns of a catalogue's text: numbers or null, lists split at ``|``, flags of yes and no."""
    out = rows
    for c in number:
        out = out.withColumn(c, F.try_to_number(F.trim(c), F.lit("S999999999.999999")).cast("double"))
    for c in lists:
        out = out.withColumn(c, F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != ""))
    for c in flags:
        out = out.withColumn(c, F.when(F.lower(F.trim(c)).isin("true", "yes", "1"), True).when(F.lower(F.trim(c)).isin("false", "no", "0"), False))
    return out


# --- timetables ------------------------------------------------------------------------


def trimmed_ids(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with their ids trimmed, and ``padded``, how many ids of a row were not."""
    padded = sum((F.when(F.trim(c) != F.col(c), 1).otherwise(0) for c in columns[1:]), F.when(F.trim(columns[0]) != F.col(columns[0]), 1).otherwise(0))
    return rows.withColumn("padded", padded).withColumns({c: F.trim(c) for c in columns})


def stop_positions(rows: DataFrame, lon: str, lat: str) -> DataFrame:
    """Rows with numeric coordinates, null where they can't be read, are out of range or stand for none (0, 0)."""
    x, y = F.col(lon).try_cast("double"), F.col(lat).try_cast("double")
    good = x.between(-180, 180) & y.between(-90, 90) & ~((x == 0) & (y == 0))
    return rows.withColumns({lon: F.when(good, x), lat: F.when(good, y)})


def read_feed_members(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """path, folder, member, text of the wanted members of zipped feeds.

    The folder is the one nearest the root that holds any wanted member; an archive that
    holds nothing but one archive stands for that. Each archive is read in one task.
    """

    def pick(content: bytes) -> Iterator[tuple[str, str, str]]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = [n for n in z.namelist() if not n.endswith("/")]
            if len(names) == 1 and names[0].lower().endswith(".zip"):
                yield from pick(z.read(names[0]))
                return
            folders = sorted({n.rpartition("/")[0] for n in names if n.rpartition("/")[2] in wanted}, key=lambda f: (f.count("/") + bool(f), f))
            for member in wanted:
                at = f"{folders[0]}/{member}".lstrip("/") if folders else member
                if at in names:
                    yield folders[0], member, z.read(at).decode("utf-8-sig")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                if found := list(pick(content)):
                    yield pd.DataFrame([(path, *f) for f in found], columns=["path", "folder", "member", "text"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(members, "path string, folder string, member string, text string")


def zone_rings(documents: DataFrame) -> DataFrame:
    """id and ring of polygons in GeoJSON documents (text); other geometries and rings of under three corners are left out."""
    feature = "array<struct<id:string,geometry:struct<type:string,coordinates:string>>>"
    each = documents.select(F.explode(F.from_json("text", f"struct<features:{feature}>")["features"]).alias("f"))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.slice(one, 1, 1)).when(F.col("f.geometry.type") == "MultiPolygon", many)
    corners = F.transform("r", lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))
    return each.select(F.col("f.id").alias("id"), F.explode(rings).alias("r")).select("id", corners.alias("ring")).where(F.size("ring") >= 4)


def sound_zones(rings: DataFrame) -> DataFrame:
    """Rings (id, ring) of the zones all whose corners are finite and in range."""
    good = F.forall("ring", lambda p: F.coalesce(p["x"].between(-180, 180) & p["y"].between(-90, 90), F.lit(False)))
    return rings.join(rings.where(~good).select("id").distinct(), "id", "left_anti")


def boarding_zones(stop_times: DataFrame, zones: DataFrame) -> DataFrame:
    """Zones (id, ...) in which a row of stop_times lets riders board: by location_id, or by stop_id, and a pickup_type other than 1."""
    board = stop_times.where(F.coalesce(F.trim("pickup_type"), F.lit("")) != "1")
    ids = board.select(F.explode(F.array(F.trim("location_id"), F.trim("stop_id"))).alias("id")).distinct()
    return zones.join(ids, "id", "left_semi")


# --- answers and overrides -------------------------------------------------------------


def answered(asked: DataFrame, covered: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """asked keys with their answer and ``state``: known, absent (asked before, without an answer), pending."""
    met = asked.join(covered.select(key).distinct().withColumn("covered", F.lit(True)), key, "left").join(answers, key, "left")
    value = next(c for c in answers.columns if c != key)
    return met.withColumn("state", F.when(F.col(value).isNotNull(), "known").when(F.col("covered"), "absent").otherwise("pending")).drop("covered")


def read_overrides(text: str, allowed: dict[str, set[str]]) -> list[dict]:
    """Operations of an override file (a JSON list, which is YAML too), each of one known kind with known keys.

    Refused are unknown kinds and keys, and a repeated key within one operation.
    """

    def once(pairs: list[tuple[str, object]]) -> dict:
        if len({k for k, _ in pairs}) != len(pairs):
            raise ValueError(f"repeated key in {[k for k, _ in pairs]}")
        return dict(pairs)

    out = json.loads(text, object_pairs_hook=once)
    for op in out:
        (kind, body), *rest = op.items()
        if rest or kind not in allowed or set(body) - allowed[kind]:
            raise ValueError(f"unknown operation or key in {op}")
    return out


def pinned(inputs: DataFrame, cache: DataFrame) -> DataFrame:
    """inputs (name, digest) that have no derived table of that digest yet."""
    return inputs.join(cache.select("name", "digest"), ["name", "digest"], "left_anti")


