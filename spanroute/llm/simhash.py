"""SimHash fingerprints and their near-duplicate groups by ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import materialize, pick, pick_row, unpick
from .components import connected_components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints that share half a fingerprint but for a bit: up to so many are compared with each other, more by whole balls.
SMALL = 32
#: Shingles hashed at a time, so that a very long text needs no more memory than others.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the word shingles of a text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    whole, n = b" ".join(words), len(words) - size + 1
    starts = np.zeros(len(words), np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    ends = (starts + lengths)[size - 1 :]
    starts, digest, bits = starts[:n], xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        h = np.array([digest(whole[i:j], SEED) for i, j in part], ">u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@F.pandas_udf(LongType())
def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([_signed(fingerprint(t)) for t in batch], dtype="int64")


def _ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _half_variants(fp: Column) -> Column:
    """Each 32-bit half with at most one bit flipped, the half's number above it: 66 keys."""
    low, high = fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(32, 1)])
    return F.concat(
        F.transform(masks, lambda m: low.bitwiseXOR(m)),
        F.transform(masks, lambda m: high.bitwiseXOR(m).bitwiseOR(F.lit(1 << 32))),
    )


def _full_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The roots of fingerprints with all variants of at most half the radius: 2081 rows each."""
    masks = np.array(_ball(64, RADIUS // 2), np.uint64)
    for batch in batches:
        fps, roots = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        for at in range(0, len(fps), 64):
            keys = (fps[at : at + 64].view(np.uint64)[:, None] ^ masks[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(roots[at : at + 64], len(masks))), pa.array(keys)], names=["root", "key"])


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def groups(fps: DataFrame) -> DataFrame:
    """``node``, ``root`` for every ``fp`` that has a partner at RADIUS bits or fewer.

    Two fingerprints that differ in at most four bits differ in at most two in one of their
    halves, so they meet at a variant one bit from either in that half. Every fingerprint
    emits the 33 variants of each half; those that share a variant are verified over all
    64 bits. Comparing all pairs of many that share one would grow with the square of their
    number, so beyond SMALL the work is cut without losing a link:

    1. each is verified against the least of them and its two predecessors;
    2. where the components so found agree, nothing is left to link;
    3. else those outside the largest component, if at most SMALL, are verified against all;
    4. else each emits its whole ball of radius two, 2081 variants of all 64 bits. Whatever
       shares one of these is at most four bits apart, so a star links them.
    """
    variants = fps.select("fp", F.explode(_half_variants(F.col("fp"))).alias("key"))
    same = Window.partitionBy("key")
    ordered = same.orderBy("fp")
    met = variants.select("key", "fp", F.count("*").over(same).alias("n"), F.min("fp").over(same).alias("least"), F.lag("fp", 1).over(ordered).alias("prev"), F.lag("fp", 2).over(ordered).alias("before"))
    met = materialize(met.where("n > 1"))
    few, many = met.where(F.col("n") <= SMALL), met.where(F.col("n") > SMALL)
    pairs = few.select(F.col("fp").alias("a"), "key").join(few.select(F.col("fp").alias("b"), "key"), "key").where((F.col("a") < F.col("b")) & _near("a", "b")).select("a", "b")
    chains = many.select("fp", F.explode(F.array("least", "prev", "before")).alias("b")).where(F.col("b").isNotNull() & (F.col("fp") != F.col("b")) & _near("fp", "b")).select(F.col("fp").alias("a"), "b")
    roots = connected_components(pairs.union(chains))

    placed = many.select("key", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed)
    split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    placed = materialize(placed.join(split, "key", "left_semi"))
    if placed.isEmpty():
        return roots
    sizes = placed.groupBy("key", "root").count()
    largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("main"), (F.sum("count") - F.max("count")).alias("others"))
    placed = materialize(placed.join(largest, "key"))
    others = placed.where((F.col("root") != F.col("main")) & (F.col("others") <= SMALL))
    crossed = (
        others.select("key", F.col("fp").alias("a"), F.col("root").alias("x")).join(placed.select("key", F.col("fp").alias("b"), F.col("root").alias("y")), "key")
        .where((F.col("x") != F.col("y")) & _near("a", "b")).select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    scattered = placed.where(F.col("others") > SMALL).select("fp", "root").distinct()
    balls = materialize(scattered.repartition(200, "fp").mapInArrow(_full_balls, "root long, key long"))
    least = balls.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    stars = balls.join(least.select("key", "a"), "key").where("root <> a").select("a", F.col("root").alias("b"))
    joined = connected_components(crossed.union(stars).distinct()).toDF("inner", "outer")
    inner = roots.union(placed.select("fp", "root").where("fp = root")).distinct()
    return inner.join(joined, F.col("root") == F.col("inner"), "left").select("node", F.coalesce("outer", "root").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for row: id, version (digest of the text), fp (signed long), root (least fp of the component), component_id.

    component_id is the least id whose fingerprint can be reached over links of at most
    RADIUS differing bits. A null text counts as empty; texts without words have the
    fingerprint zero and link like others. Equal fingerprints are one node, so that copies
    are never expanded. Null ids never win over others; where a group holds only null ids,
    component_id is null. An empty table gives no rows. Other columns are left out.
    """
    rows = pick(docs, id_col, text_col).toDF("id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows = materialize(rows.select("id", F.unhex(F.md5("text")).alias("version"), simhash("text").alias("fp")))
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = groups(nodes.select("fp"))
    joined = materialize(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = joined.join(joined.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("id", "version", "fp", "root", "component_id")


def simhash_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 lowercase hex digits), component_id; see :func:`simhash_groups`."""
    groups = simhash_groups(docs, id_col, text_col)
    return groups.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one, that of the least id.

    A null id comes after all others. Among rows that share the least id, that of the least
    text digest stays, and of equal rows one. All columns are returned, whatever their names.
    """
    groups = simhash_groups(docs, id_col, text_col)
    winners = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "version")).alias("w"))
    keep = winners.select(F.col("w.id").alias("keep_id"), F.col("w.version").alias("keep_version"))
    rows = pick_row(docs, id_col, text_col).withColumnRenamed(id_col, "id").withColumnRenamed(text_col, "text")
    rows = rows.withColumn("version", F.unhex(F.md5(F.coalesce("text", F.lit(""))))).drop("text")
    met = rows.join(keep, rows["id"].eqNullSafe(keep["keep_id"]) & (rows["version"] == keep["keep_version"]), "left_semi")
    first = Window.partitionBy("id", "version").orderBy(F.lit(0))
    return unpick(met.withColumn("nth", F.row_number().over(first)).where("nth = 1"), docs.columns)
