"""Removal of boilerplate lines that spread over many sites."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, pick, pick_row, unpick

MIN_SITES = 8


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """A row per line that isn't blank: id, version (digest of its text), pos, line (digest), site."""
    rows = pick(docs, id_col, text_col, site_col).toDF("id", "text", "site")
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    cut = rows.select("id", _text_key(F.col("text")).alias("version"), F.coalesce("site", F.lit("")).alias("site"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return cut.withColumn("line", F.trim("line")).where("line <> ''").withColumn("line", F.unhex(F.md5("line")))


def widespread(cut: DataFrame, min_sites: int, lg_k: int = 12) -> DataFrame:
    """Lines on at least ``min_sites`` sites: line, first (its first id, version and pos).

    Sketches of sites merge by aggregation, so one line on a third of all rows costs each
    task one sketch. Where an estimate lies within four standard errors of the threshold,
    or one site of it, the sites are counted exactly. A line that occurs less often than
    ``min_sites`` can't be on so many sites and needs no sketch.
    """
    often = cut.groupBy("line").agg(F.count("*").alias("n"), F.min(F.struct("id", "version", "pos")).alias("first")).where(F.col("n") >= min_sites)
    often = materialize(often.select("line", "first"))
    near = max(1.0, 4 * min_sites * 1.04 / math.sqrt(1 << lg_k))
    spread = (
        cut.select("line", "site").join(often.select("line"), "line", "left_semi")
        .groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
    )
    spread = materialize(spread.where(F.col("sites") >= min_sites - near))
    sure = spread.where(F.col("sites") > min_sites + near).select("line")
    unsure = spread.where(F.col("sites") <= min_sites + near).select("line")
    exact = cut.select("line", "site").join(unsure, "line", "left_semi").distinct().groupBy("line").count().where(F.col("count") >= min_sites).select("line")
    return materialize(often.join(sure.union(exact), "line", "left_semi"))


def _cleaned(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int) -> DataFrame:
    """row (all columns by position), text without boilerplate, n_lines, n_removed."""
    cut = materialize(lines(docs, id_col, text_col, site_col))
    bad = widespread(cut, min_sites)
    drop = (
        cut.select("line", "id", "version", "pos").join(bad, "line")
        .where(~F.struct("id", "version", "pos").eqNullSafe(F.col("first")))
        .groupBy("id", "version").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
        .withColumnRenamed("id", "drop_id").withColumnRenamed("version", "drop_version")
    )
    rows = pick_row(docs, id_col, text_col).withColumnRenamed(id_col, "id").withColumnRenamed(text_col, "text")
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("version", _text_key(F.col("text")))
    met = rows.join(drop, rows["id"].eqNullSafe(drop["drop_id"]) & (rows["version"] == drop["drop_version"]), "left")
    met = met.withColumn("cut", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), "drop")
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("cut", i)), "\n"))
    return met.select("row", text.alias("text"), F.size("cut").cast("long").alias("n_lines"), F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_removed"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The rows of ``docs`` with boilerplate gone from the text, and ``n_lines``, ``n_removed``.

    A line, trimmed of spaces, that at least ``min_sites`` different sites hold goes from
    every document but its first place (the smallest id), which keeps it once. Blank lines
    stay. A null text counts as empty, a null site as one site without a name. Rows that
    repeat an id are told apart by their texts; equal ones are treated alike. Columns of
    ``docs`` called n_lines or n_removed are replaced. An empty table stays empty.
    """
    met = _cleaned(docs, id_col, text_col, site_col, min_sites)
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in ("n_lines", "n_removed")]
    where = docs.columns.index(text_col)
    return met.select(*[(F.col("text") if i == where else F.col(f"row._{i}")).alias(docs.columns[i]) for i in kept], "n_lines", "n_removed")


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", size_col: str = "n_chars", min_sites: int = MIN_SITES) -> DataFrame:
    """As :func:`line_dedup` with the columns of ``docs`` alone, whatever their names; ``size_col``, if there, is the new text's length."""
    met = _cleaned(docs, id_col, text_col, site_col, min_sites)
    return unpick(met, docs.columns, **{text_col: F.col("text"), size_col: F.length("text").cast("long")})
