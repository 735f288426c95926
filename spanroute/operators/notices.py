"""Notices of builds as paragraphs, their credits merged, and what can't be merged told."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ITEM = "  - "


def paragraphs(notices: DataFrame, openings: Mapping[str, str]) -> DataFrame:
    """build, place, section, begins, lines of the blocks of notices (build, content in bytes).

    Blocks are parted by blank lines. One whose first line begins with an opening begins that
    section; an indented one goes on with the section before it; any other has a null section,
    as has each of a notice that isn't UTF-8 (its one block has null lines). A window has the blocks
    of one notice, which is one row.
    """
    text = F.col("content").cast("string")
    valid = notices.where(F.is_valid_utf8(text)).select("build", F.posexplode(F.split(text, "\n\n")).alias("place", "block"))
    block = F.regexp_replace("block", r"\A\n+|\n+\z", "")
    each = valid.select("build", "place", F.split(block, "\n").alias("lines")).where("lines != array('')")
    key = F.lit(None).cast("string")
    for name, opening in reversed(openings.items()):
        key = F.when(F.startswith(F.col("lines")[0], F.lit(opening)), name).otherwise(key)
    each = each.withColumn("opens", key).withColumn("unknown", F.col("opens").isNull() & ~F.startswith(F.col("lines")[0], F.lit(" ")))
    before = F.last("opens", ignorenulls=True).over(Window.partitionBy("build").orderBy("place"))
    out = each.select("build", "place", F.when(~F.col("unknown"), before).alias("section"), F.col("opens").isNotNull().alias("begins"), "lines")
    odd = notices.where(~F.is_valid_utf8(text)).select("build", F.lit(0).alias("place"), F.lit(None).cast("string").alias("section"), F.lit(False).alias("begins"), F.lit(None).cast("array<string>").alias("lines"))
    return out.unionByName(odd)


def refused(notices: DataFrame, blocks: DataFrame, required: list[str]) -> DataFrame:
    """build, reason of each notice that can't be merged: its encoding, unknown, repeated or lacking paragraphs."""
    unknown = blocks.where("section is null").select("build", F.when(F.col("lines").isNull(), "not UTF-8").otherwise(F.concat(F.lit("unknown paragraph: "), F.col("lines")[0])).alias("reason"))
    begun = blocks.where("begins").groupBy("build", "section").agg(F.count("*").alias("n"))
    repeated = begun.where("n > 1").select("build", F.concat(F.lit("repeated paragraph: "), "section").alias("reason"))
    asked = notices.select("build").distinct().select("build", F.explode(F.array(*map(F.lit, required))).alias("section"))
    lacking = asked.join(begun, ["build", "section"], "left_anti").select("build", F.concat(F.lit("no paragraph: "), "section").alias("reason"))
    return unknown.unionByName(repeated).unionByName(lacking)


def _lines(blocks: DataFrame) -> DataFrame:
    """build, section, place, row, line of all sections."""
    return blocks.where("section is not null").select("build", "section", "place", F.posexplode("lines").alias("row", "line"))


def merged_items(blocks: DataFrame) -> DataFrame:
    """section, item, builds: each item of a section once, with the number of builds that list it."""
    items = _lines(blocks).where(F.startswith("line", F.lit(ITEM)))
    return items.groupBy("section", F.col("line").alias("item"), "build").agg(F.count("*").alias("n")).groupBy("section", "item").agg(F.count("*").alias("builds"))


def differing(blocks: DataFrame, sections: list[str]) -> DataFrame:
    """section of those whose lines but the items differ between builds that have them."""
    plain = _lines(blocks).where(~F.startswith("line", F.lit(ITEM)) & F.col("section").isin(sections))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "row", "line"))), lambda x: x["line"]), "\n")
    return plain.groupBy("section", "build").agg(F.sha2(text, 256).alias("digest")).groupBy("section").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a != b").select("section")


def entries(blocks: DataFrame, section: str, head: str, details: Mapping[str, str]) -> DataFrame:
    """build, key, name, kind, line of a section of entries: a line that ``head`` matches (key, name) and its detail lines.

    ``details`` are kinds by their prefix, which goes. An entry's own line is a
    row with a null kind; kind is ``unknown`` for lines of no kind and for those before the first entry (null key).
    """
    lines = _lines(blocks.withColumn("lines", F.when(F.col("begins"), F.slice("lines", 2, 1 << 30)).otherwise(F.col("lines")))).where(F.col("section") == section)
    key = F.regexp_extract("line", head, 1)
    begins = F.col("line").rlike(head)
    order = Window.partitionBy("build").orderBy("place", "row")
    held = F.last(F.when(begins, F.struct(key.alias("key"), F.regexp_extract("line", head, 2).alias("name"))), ignorenulls=True).over(order)
    kind, rest = F.lit("unknown"), F.col("line")
    for prefix, name in details.items():
        hit = F.startswith("line", F.lit(prefix))
        kind, rest = F.when(hit, name).otherwise(kind), F.when(hit, F.substring("line", len(prefix) + 1, 1 << 30)).otherwise(rest)
    kind = F.when(begins, None).when(F.col("held").isNull(), "unknown").otherwise(kind)
    return lines.withColumn("held", held).select("build", "held.key", "held.name", kind.alias("kind"), F.when(~begins, rest).alias("line"))


def merged_entries(rows: DataFrame) -> DataFrame:
    """key, name, kind, line, builds: every line of an entry once over all builds."""
    return rows.where("kind is not null").groupBy("key", "name", "kind", "line", "build").agg(F.count("*").alias("n")).groupBy("key", "name", "kind", "line").agg(F.count("*").alias("builds"))


def entry_conflicts(rows: DataFrame, agreed: list[str]) -> DataFrame:
    """key, what: unknown lines (null key before the first entry), names that differ and agreed kinds of lines that differ between builds."""
    unknown = rows.where("kind = 'unknown'").select("key", F.lit("unknown line").alias("what"))
    names = rows.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a != b").select("key", F.lit("name").alias("what"))
    of = rows.groupBy("build", "key").agg(*[F.sha2(F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("line")))), "\n"), 256).alias(k) for k in agreed])
    kinds = of.groupBy("key").agg(*[(F.min(k) != F.max(k)).alias(k) for k in agreed])
    odd = kinds.select("key", F.explode(F.array(*[F.when(F.col(k), F.lit(k)) for k in agreed])).alias("what")).where("what is not null")
    return unknown.unionByName(names).unionByName(odd).distinct()


def partition_conflicts(labels: DataFrame, assigned: DataFrame) -> DataFrame:
    """label, id, what: labels without digests of their cuts, ids in labels that aren't listed, ids in several labels.

    labels (label, digests array), assigned (catalogue, id, label); an id is told with its catalogue.
    """
    bad = F.col("digests").isNull() | (F.size("digests") == 0) | ~F.forall("digests", lambda d: F.coalesce(d.rlike("^[0-9a-f]{64}$"), F.lit(False)))
    pinless = labels.where(bad).select("label", F.lit(None).cast("string").alias("id"), F.lit("no digests").alias("what"))
    named = F.concat_ws(" ", "catalogue", "id")
    unlisted = assigned.join(labels.select("label").distinct(), "label", "left_anti").select("label", named.alias("id"), F.lit("label not listed").alias("what"))
    several = assigned.groupBy("catalogue", "id").agg(F.min("label").alias("label"), F.max("label").alias("last")).where("label != last").select("label", named.alias("id"), F.lit("several labels").alias("what"))
    return pinless.unionByName(unlisted).unionByName(several)
