"""Fill-in-the-middle: texts cut into units at zero-width boundaries, and rearranged."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

#: The class of no character but those that are given; ``WHITE`` as the contracts define it.
ANY, WHITE = r"\s\S", r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Grammar:
    """How texts fall into units, as classes of neighbouring characters.

    ``pattern`` is what a unit matches from left to right; ``seams`` are pairs (last
    character of a unit, first of the next) in the notation of a regex class. The
    constructors derive both from the same classes, so that they cut alike.
    """

    pattern: str
    seams: tuple[tuple[str, str], ...]

    @classmethod
    def ended_by(cls, end: str, run: bool = False) -> Grammar:
        """Units that go up to a character of the class ``end``, or to a run of them; what is left is the last unit."""
        more = "+" if run else ""
        return cls(f"[^{end}]*[{end}]{more}|[^{end}]+", ((end, f"^{end}" if run else ANY),))

    @classmethod
    def runs_of(cls, *classes: str) -> Grammar:
        """Units that are runs of one of some disjoint classes, or of all other characters."""
        rest = "^" + "".join(classes)
        return cls("|".join(f"[{c}]+" for c in (*classes, rest)), tuple((c, f"^{c}") for c in classes) + ((rest, "".join(classes)),))

    @property
    def boundary(self) -> str:
        """The regex that matches nothing but the places between two units: it looks back at one character and on at one."""
        return "|".join(f"(?<=[{a}])(?=[{b}])" for a, b in self.seams)


GRAMMARS = {
    "lines": Grammar.ended_by(r"\n"),
    "words": Grammar.ended_by(WHITE, run=True),
    "sentences": Grammar.ended_by(".!?", run=True),
    "statements": Grammar.ended_by(r";{}\n", run=True),
    "runs": Grammar.runs_of("A-Za-z", "0-9", WHITE),
    "characters": Grammar(r"[\s\S]", ((ANY, ANY),)),
}


def units(text: Column, grammar: Grammar) -> Column:
    """The units of a text in order; put together they are the text. Null and empty texts have none."""
    return F.when(F.length(text) > 0, F.split(text, grammar.boundary, -1)).otherwise(F.array().cast("array<string>"))


def _check(sentinels: Sequence[str]) -> None:
    for (i, a), (j, b) in product(enumerate(sentinels), repeat=2):
        overlap = any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b))))
        if not a or overlap or (i != j and a in b):
            raise ValueError("sentinels must not overlap or hold each other, or outputs could be read in two ways")


def _draws(seed: int, id_col: str) -> list[Column]:
    """Four unsigned 32-bit numbers of a row, the same in every run and on every cluster."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def infill(
    docs: DataFrame, grammar: Grammar = GRAMMARS["lines"], rate: int = 100, spm: int = 50, seed: int = 7,
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>"), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, n, form, prefix, middle, suffix and output of every row of ``docs``.

    A text of n units is cut at two of its n + 1 places, drawn from its id alone; ``rate``
    per cent of texts are rearranged, of these ``spm`` per cent with the suffix first.
    Texts that are empty or hold one of the ``sentinels`` (prefix, suffix, middle) stay
    plain: their parts are null and the output is the text. Null texts count as empty and a
    null id as one without digits; rows that repeat are each returned alike; other columns,
    whatever their names, are left out; an empty table gives no rows. All is done by
    column expressions, row by row, without a shuffle.
    """
    _check(sentinels)
    p, s, m = map(F.lit, sentinels)
    rows = pick(docs, id_col, text_col).select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text"))
    h1, h2, h3, h4 = _draws(seed, id_col)
    rows = rows.withColumn("units", units(F.col("text"), grammar)).withColumn("n", F.size("units").cast("long"))
    plain = (F.length("text") == 0) | (h3 % 100 >= rate)
    for sentinel in sentinels:
        plain |= F.contains("text", F.lit(sentinel))
    form = F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumn("form", form).withColumn("a", F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).cast("int")).withColumn("b", F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).cast("int"))

    def part(start: Column, length: Column) -> Column:
        return F.when(F.col("form") != "plain", F.array_join(F.slice("units", start + 1, length), ""))

    rows = rows.select(
        id_col, "n", "form", "text",
        part(F.lit(0), F.col("a")).alias("prefix"), part(F.col("a"), F.col("b") - F.col("a")).alias("middle"), part(F.col("b"), F.size("units") - F.col("b")).alias("suffix"),
    )
    output = (
        F.when(F.col("form") == "psm", F.concat(p, "prefix", s, "suffix", m, "middle"))
        .when(F.col("form") == "spm", F.concat(s, "suffix", p, "prefix", m, "middle"))
        .otherwise(F.col("text"))
    )
    return rows.select(id_col, "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that :func:`infill` took, from its output and form alone."""
    _check(sentinels)
    p, s, m = sentinels

    def parts(first: str, second: str) -> Column:
        quoted = "|".join(f"\\Q{x}\\E" for x in (second, m))
        return F.split(F.substring(output, F.lit(len(first) + 1), F.length(output)), quoted, -1)

    psm, spm = parts(p, s), parts(s, p)
    return F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output)


def infill_report(docs: DataFrame) -> DataFrame:
    """The digests of the contract: what :func:`infill` put out, and what :func:`restored` reads back from it."""
    done = infill(docs)
    back = restored(F.col("output"), F.col("form"))
    return done.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
