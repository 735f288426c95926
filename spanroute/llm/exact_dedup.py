"""Exact deduplication with a heavy-hitter split; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, materialize, pick


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``digest`` (SHA-256 of the text with each run of white space as one space)."""
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " ")
    return rows.select("id", F.unhex(F.sha2(text, 256)).alias("digest"))


def frequent(rows: DataFrame, support: float) -> DataFrame:
    """Digests that at least ``support`` of all rows hold: digest, keep_id, group_size.

    ``freqItems`` keeps the counters of Misra and Gries in each task and merges them; it
    finds every digest above the support and some below. An exact count then drops the
    latter, so at most ``1 / support`` rows are left, however large the input.
    """
    counters = rows.select(F.xxhash64("digest").alias("k")).stat.freqItems(["k"], support)
    candidates = counters.select(F.explode("k_freqItems").alias("k"))
    total = rows.agg(F.count("*")).scalar()
    return (
        rows.withColumn("k", F.xxhash64("digest"))
        .join(F.broadcast(candidates), "k", "left_semi")
        .groupBy("digest")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") >= F.lit(support) * total)
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Digests held by ``support`` of the rows or more are found first (see :func:`frequent`)
    and broadcast, at most ``1 / support`` of them, so that their rows never shuffle. All
    other digests shuffle as usual: their minima and counts combine first and are joined
    back, so no group is gathered, whatever its size.

    A null text counts as empty and equals other empty texts. Rows that repeat an id are
    each returned; those that hold the smallest id of their group all have ``kept``. A null
    id is kept only where all ids of its group are null. An empty table gives no rows.
    Other columns, whatever their names, are left out.
    """
    rows = materialize(digests(docs, id_col, text_col))
    heavy = materialize(frequent(rows, support))
    hot = rows.join(F.broadcast(heavy), "digest")
    tail = rows.join(F.broadcast(heavy), "digest", "left_anti")
    rest = tail.join(tail.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")), "digest")
    both = hot.select(rest.columns).union(rest)
    return both.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
