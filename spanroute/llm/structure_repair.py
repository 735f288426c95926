"""Repair of the structure of conversations: the cheapest edits that make roles alternate."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize, pick

#: Prices of edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Roles of the turn retained last (none yet: START); a turn's role may also be OTHER than these.
START, SYSTEM, USER, ASSISTANT = range(4)
OTHER = START
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a turn, the first that holds.
BLANK, DUPLICATE, TRUNCATED, FINE = range(4)
#: Turns to insert between two that are retained one after the other, by their roles; pairs left out can't be made legal.
BETWEEN = {
    START: {SYSTEM: 0, USER: 0, ASSISTANT: 1}, SYSTEM: {USER: 0, ASSISTANT: 1},
    USER: {USER: 1, ASSISTANT: 0}, ASSISTANT: {USER: 0, ASSISTANT: 1},
}
#: Turns to insert at the end, by the role retained last.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: A segment of a conversation is 2 ** SEGMENT places of the order at most.
SEGMENT = 16
NEVER = 1 << 60
WHITE = " \t\n\v\f\r"


class Choice(NamedTuple):
    """The turn retained next: its place in the segment, its role and how it got there (inserts, then K or R)."""

    at: int
    role: int
    edits: str


def _code(role: int, fault: int) -> str:
    return chr(97 + 4 * fault + role)


_OF_CODE = {_code(r, f): (r, f) for r in range(4) for f in range(4)}


def choose(codes: str, copies: list[int], after: list[int]) -> tuple[list[int], list[Choice | None], list[tuple]]:
    """For each role before a segment: the price of the best that follows, and the turn to retain next.

    ``codes`` are roles and faults of different turns in order, of which ``copies`` stand
    side by side; ``after`` is the price of all that follows the segment, by the role
    retained last in it. Retained turns are chosen from the last on. What lies between two
    of them is deleted, at the difference of two sums of deletions, so for each role a
    running minimum of the price less its sum is enough. Of equal prices the audit that
    is least wins: the longest run of deletions, which comes first of all letters, hence
    the latest turn; at one turn, the edits that are least. The third result has the
    choices that follow a turn retained in each role.
    """
    sums = [0, *accumulate(DELETE * c for c in copies)]
    least = [a + sums[-1] for a in after]
    choice: list[Choice | None] = [None] * 4
    following: list[tuple] = [()] * len(codes)
    for at in range(len(codes) - 1, -1, -1):
        role, fault = _OF_CODE[codes[at]]
        if fault in (BLANK, DUPLICATE):
            continue
        own = (CUT if fault == TRUNCATED else 0) + DELETE * (copies[at] - 1) - sums[at + 1] + sums[at]
        ways = [(role, "K", own + least[role])] if role != OTHER else []
        ways += [(r, "R", own + REROLE + least[r]) for r in (USER, ASSISTANT)]
        following[at] = tuple(choice)
        for before, gaps in BETWEEN.items():
            price, edits, to = min(((p + INSERT * gaps[r], "I" * gaps[r] + how, r) for r, how, p in ways if r in gaps), default=(NEVER, "", START))
            if price < least[before]:
                least[before], choice[before] = price, Choice(at, to, edits)
    return least, choice, following


def walk(codes: str, copies: list[int], after: list[int] | None, entry: int) -> tuple[int, int, list[tuple[str, str]]]:
    """The best edits of a segment: their price, the role retained last and, for each turn, its edits and what they put out.

    What is put out is a string of initials, that of the turn itself in upper case. Without
    ``after`` the conversation ends with the segment, and closing turns go to its last turn.
    """
    ends = after is None
    least, choice, following = choose(codes, copies, [INSERT * len(CLOSING[q]) for q in range(4)] if ends else after)
    done, role, now = [], entry, choice[entry]
    for at, n in enumerate(copies):
        if now is None or now.at > at:
            done.append(("D" * n, ""))
            continue
        initial = "?sua"[now.role]
        put = ("au"[now.role == ASSISTANT] if now.edits[0] == "I" else "") + initial.upper()
        done.append((now.edits + "D" * (n - 1), put))
        role, now = now.role, following[at][now.role]
    if ends and done and CLOSING[role]:
        edits, put = done[-1]
        done[-1] = (edits + "I" * len(CLOSING[role]), put + "".join("?sua"[r] for r in CLOSING[role]))
    price = sum(DELETE * e.count("D") + INSERT * e.count("I") + REROLE * e.count("R") for e, _ in done)
    price += CUT * sum(_OF_CODE[c][1] == TRUNCATED and bool({"K", "R"} & set(e)) for c, (e, _) in zip(codes, done, strict=True))
    return price, role, done


def transfers(codes: str, copies: list[int]) -> list[int]:
    """Prices of a segment, by the role before it and the role retained last when it ends."""
    columns = [choose(codes, copies, [0 if q == end else NEVER for q in range(4)])[0] for end in range(4)]
    return [columns[end][start] for start in range(4) for end in range(4)]


def afters(matrices: list[list[int]]) -> list[list[int] | None]:
    """What follows each of the segments of a conversation, by the role at its end; nothing follows the last."""
    out, after = [None], [INSERT * len(CLOSING[q]) for q in range(4)]
    for m in matrices[:0:-1]:
        after = [min(m[4 * q + r] + after[r] for r in range(4)) for q in range(4)]
        out.append(after)
    return out[::-1]


def entries(exits: list[list[int]]) -> list[int]:
    """The role before each of the segments of a conversation, of the roles that each ends in by the one before it."""
    return list(accumulate((e for e in exits[:-1]), lambda q, e: e[q], initial=START))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by a checksum of ``conv_id:turn``; nulls in it, in role and in text are one space."""
    rows = pick(rows, "conv_id", "turn", "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    draw = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = rows.select("conv_id", "turn", F.when(draw == 4, "user").otherwise(role).alias("role"), text.alias("text"), draw.alias("_draw")).where("_draw <> 0")
    return rows.withColumn("_draw", F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_draw")


def _keyed(rows: DataFrame) -> DataFrame:
    rows = pick(rows, "conv_id", "turn", "role", "text")
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))


def _faults(rows: DataFrame) -> DataFrame:
    """at, conv_id, turn, role, digest, copies, code of the different turns of all conversations, ``at`` rising with their order.

    Texts stay where they are; their digests are ordered, over all tasks, whatever the size
    of one conversation. A turn is a duplicate if an earlier one has its role and text.
    """
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    facts = _keyed(rows).select("conv_id", "turn", "role", "digest", last.alias("last")).groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("copies"), F.min("last").alias("last"))
    order = ["conv_id", "turn", "role", "digest"]
    placed = facts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed)  # places stay as they are
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("last") == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    role = F.substring("role", 1, 1)
    role = F.when(role == "s", SYSTEM).when(role == "u", USER).when(role == "a", ASSISTANT).otherwise(OTHER)
    placed = placed.join(firsts, "at", "left").withColumn("fault", fault)
    return placed.select("at", *order, "copies", "fault", F.char(F.lit(97) + 4 * F.col("fault") + role).alias("code"))


def _each(df: DataFrame, work: Callable, given: list[str], schema: str, **fields: pa.DataType) -> DataFrame:
    """conv_id, segment and what ``work`` makes of the columns ``given``, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [work(*values) for values in zip(*[part.column(2 + i).to_pylist() for i in range(len(given))], strict=True)]
                columns = [pa.array([m[i] for m in made], t) for i, t in enumerate(fields.values())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["conv_id", "segment", *fields])

    rows = df.select("conv_id", "segment", *given)
    return rows.mapInArrow(run, f"conv_id {rows.schema[0].dataType.simpleString()}, segment long, {schema}")


def _in_order(df: DataFrame, value: str, fold: Callable, name: str, schema: str, to: pa.DataType) -> DataFrame:
    """conv_id, segment, ``name``: what ``fold`` makes of the list of a conversation's values, one for each 65,536 turns."""
    lists = F.array_sort(F.collect_list(F.struct("segment", value)))
    rows = df.groupBy("conv_id").agg(lists.alias("l")).select("conv_id", F.lit(0).cast("long").alias("segment"), F.transform("l", lambda x: x[value]).alias("v"), F.transform("l", lambda x: x["segment"]).alias("s"))
    done = _each(rows, lambda v, s: (s, fold(v)), ["v", "s"], f"s array<long>, f array<{schema}>", s=pa.list_(pa.int64()), f=pa.list_(to))
    return done.select("conv_id", F.explode(F.arrays_zip("s", "f")).alias("z")).select("conv_id", F.col("z.s").alias("segment"), F.col("z.f").alias(name))


def _beside(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """A join on columns that may be null."""
    rest = [c for c in right.columns if c not in names]
    on = F.expr(" AND ".join(f"a.{n} <=> b.{n}" for n in names))
    return left.alias("a").join(right.alias("b"), on, how).select("a.*", *([f"b.{c}" for c in rest] if how == "left" else []))


def _illegal(codes: str, copies: list[int]) -> int:
    roles = [_OF_CODE[c][0] for c in codes]
    return sum(copies) - len(copies) + sum(p not in LEGAL for p in zip(roles, roles[1:], strict=False))


def plan_repairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text), texts left out.

    Gives conversations (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)
    and edits (conv_id, turn, role, digest, at, edits, put) of the turns at which something is
    put out. Turns are taken by ``turn``, nulls first, and, of equal ones, by role and SHA-256 of the
    text; rows that repeat stand side by side. Null roles and texts count as one space, a null
    conv_id is a conversation like others, other columns are left out, and an empty table
    has no conversations. A conversation of any length is repaired in segments: prices of
    all roles before and after each are combined in order, then each is walked by itself.
    """
    faults = materialize(_faults(rows))
    list_ = F.array_sort(F.collect_list(F.struct("at", "code", "copies")))
    segments = faults.groupBy("conv_id", F.shiftright("at", SEGMENT).alias("segment")).agg(list_.alias("l"))
    codes, copies = F.array_join(F.transform("l", lambda x: x["code"]), ""), F.transform("l", lambda x: x["copies"])
    segments = materialize(segments.select("conv_id", "segment", F.col("l")[0]["at"].alias("at"), codes.alias("codes"), copies.alias("copies")))

    # Only conversations of several segments have something before or after one.
    several = segments.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    parts = materialize(_beside(segments, several, ["conv_id"], "left_semi"))
    prices = _each(parts, lambda c, n: (transfers(c, n),), ["codes", "copies"], "m array<long>", m=pa.list_(pa.int64()))
    after = materialize(_in_order(prices, "m", afters, "after", "array<long>", pa.list_(pa.int64())))
    ended = _each(_beside(parts, after, ["conv_id", "segment"]), lambda c, n, a: ([walk(c, n, a, q)[1] for q in range(4)],), ["codes", "copies", "after"], "e array<int>", e=pa.list_(pa.int32()))
    before = _in_order(ended, "e", entries, "entry", "int", pa.int32())

    whole = _beside(_beside(segments, after, ["conv_id", "segment"]), before, ["conv_id", "segment"])

    def solve(at: int, codes: str, copies: list[int], after: list[int] | None, entry: int | None) -> tuple:
        price, _, done = walk(codes, copies, after, entry or START)
        put = [(at + i, edits, out) for i, (edits, out) in enumerate(done) if out]
        return price, "".join(e for e, _ in done), _illegal(codes, copies), _OF_CODE[codes[0]][0], _OF_CODE[codes[-1]][0], [dict(zip(("at", "edits", "put"), p, strict=True)) for p in put]

    solved = materialize(
        _each(
            whole, solve, ["at", "codes", "copies", "after", "entry"], "price long, audit string, illegal long, head int, tail int, put array<struct<at: long, edits: string, put: string>>",
            price=pa.int64(), audit=pa.string(), illegal=pa.int64(), head=pa.int32(), tail=pa.int32(), put=pa.list_(pa.struct([("at", pa.int64()), ("edits", pa.string()), ("put", pa.string())])),
        )
    )
    edits = solved.select(F.explode("put").alias("p")).select("p.*")
    edits = faults.select("at", "conv_id", "turn", "role", "digest").join(edits, "at").select("conv_id", "turn", "role", "digest", "at", "edits", "put")

    # One row for each 65,536 turns; the next segment's first role stands beside the last role of this one.
    beside = F.lead("head").over(Window.partitionBy("conv_id").orderBy("segment"))
    seam = F.when(~F.concat("tail", beside).isin([f"{a}{b}" for a, b in LEGAL]), 1).otherwise(0)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), "")
    sums = solved.withColumn("seam", seam).groupBy("conv_id").agg(F.sum(F.col("illegal") + F.col("seam")).alias("illegal"), F.sum("price").alias("cost"), audit.alias("audit"))

    def turns(*which: int) -> Column:
        return F.sum(F.when(F.col("fault").isin(*which), F.col("copies")).otherwise(0))

    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    again = F.sum(F.when(~F.col("fault").isin(BLANK, DUPLICATE), F.col("copies") - 1).otherwise(0))
    kept_first = F.sum(F.when(F.col("fault") == TRUNCATED, 1).otherwise(0)).cast("long")
    counts = faults.groupBy("conv_id").agg(gaps.alias("gaps"), turns(BLANK).alias("blank"), (turns(DUPLICATE) + again).alias("duplicate"), kept_first.alias("truncated"))
    return _beside(counts, sums, ["conv_id"]), edits


def repaired(rows: DataFrame, edits: DataFrame, whole: bool = False) -> DataFrame:
    """conv_id, at, nth, edit (K, R or I), role, text: the turns of all conversations after the ``edits`` of :func:`plan_repairs`.

    Edits are sorted in ahead of the rows they are for, so texts are shuffled once. Rows come in
    the order of the conversation within a partition; ``whole`` also keeps each conversation
    in one, which is read as a stream, else long ones are dealt to several.
    """
    order = ["conv_id", "turn", "role", "digest"]
    texts = _keyed(rows).select(*order, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("string").alias("edits"), F.lit(None).cast("string").alias("put"), "text")
    both = edits.select(*order, F.lit(0).alias("kind"), "at", "edits", "put", F.lit(None).cast("string").alias("text")).union(texts)
    dealt = both.repartition("conv_id") if whole else both.repartitionByRange(*order)

    def turns(now: dict, text: str) -> Iterator[tuple]:
        letters = [c for c in now["edits"] if c != "D"]
        for nth, initial in enumerate(now["put"]):
            own, name = initial.isupper(), {"u": "user", "a": "assistant"}.get(initial.lower())
            edit = next(c for c in letters if c != "I") if own else "I"
            yield now["conv_id"], now["at"], nth, edit, now["role"] if edit == "K" else name, text if own else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    if r["kind"] == 0:
                        now = r
                    elif now and all(now[c] == r[c] for c in order):
                        out += turns(now, r["text"])
                        now = None  # other copies are deleted
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 6, fields, strict=True)], schema=fields)

    of = both.schema["conv_id"].dataType
    fields = pa.schema([("conv_id", to_arrow_type(of)), ("at", pa.int64()), ("nth", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return dealt.sortWithinPartitions(*order, "kind").mapInArrow(run, f"conv_id {of.simpleString()}, at long, nth int, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of what :func:`repaired` gives with ``whole``: ``role:text``, joined by newlines.

    A digest is of one stream of bytes, so that of a conversation is made in one task, turn by turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def put(ids: list, hexes: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hexes, pa.string())], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            kind, ids, hexes = batch.schema.field(0).type, [], []
            for conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                turn = f"{role}:{text}".encode()
                if state is not None and conv == now:
                    state.update(b"\n" + turn)
                    continue
                if state is not None:
                    ids.append(now), hexes.append(state.hexdigest())
                now, state = conv, hashlib.sha256(turn)
            yield put(ids, hexes)
        if state is not None:
            yield put([now], [state.hexdigest()])

    rows = turns.select("conv_id", "role", "text")
    return rows.mapInArrow(run, f"conv_id {rows.schema[0].dataType.simpleString()}, repaired_sha256 string")


def repair_report(rows: DataFrame, original: DataFrame) -> DataFrame:
    """The contract's row of every conversation of ``original``: counts, cost, audit and digest of the repair of ``rows``.

    A conversation that has no rows left has zeros, an empty audit and the digest of an empty string.
    """
    conversations, edits = plan_repairs(rows)
    done = _beside(conversations, digests(repaired(rows, edits, whole=True)), ["conv_id"])
    out = _beside(pick(original, "conv_id").distinct(), done, ["conv_id"])
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
