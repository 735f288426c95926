"""Packing tokenised documents into as few sequences as possible: linear grouping, then best fit."""

from __future__ import annotations

import os
import re
import warnings
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import materialize, pick

CAPACITY, END = 4096, 1
#: Lengths above this share of the capacity are large, and are grouped.
LARGE = 1 / 4
GROUPS = 320
#: Words, and pieces of words, whose ids a worker keeps, so that its memory is bounded. Beyond that
#: words start anew, as they are soon put together from pieces; of pieces, which take the tokenizer,
#: those go that weren't met again among as many others.
CACHED, KEPT_PIECES = 350_000, 350_000
#: Characters tokenised at a time of a long text.
SLICE = 1 << 20

# The vocabulary's own pattern of pieces, and the characters for which
# lower-casing and composing here agree with the vocabulary's normaliser.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
PLAIN = re.compile(r"[\x21-\x7EÀ-ÖØ-öø-ÿ]+")
# Several plain words with a space between, their pieces with the spaces as pieces of their
# own, and what stands for a space among ids: every id has zeros in its upper bytes.
PLAIN_WORDS, SPACED = re.compile(r"[\x20-\x7EÀ-ÖØ-öø-ÿ]+"), re.compile(f"{PIECES.pattern}| ")
# Separators that only Python takes for white space.
SEPARATORS = re.compile("[\x1c-\x1f]")
GAP = b"\xff\xff\xff\xff"


class WordTokens:
    """Ids of texts, as bytes, by a vocabulary whose tokens never cross white space.

    The ids of a word don't depend on its neighbours, so each word goes through the
    tokenizer once while it is kept. Words of plain characters are cut further, into the
    vocabulary's pieces, of which there are far fewer; other words, and texts with the
    separators on which Python and the vocabulary differ, go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.ends, self.words, self.pieces, self.older = ends, {}, {}, {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        if len(self.words) + len(words) > CACHED:
            self.words.clear()
        if len(self.pieces) > KEPT_PIECES:
            self.pieces, self.older = {}, self.pieces
        plain, odd = list(words), []
        joined = " ".join(plain)
        if "<|" in joined or not PLAIN_WORDS.fullmatch(joined):
            plain = [w for w in words if PLAIN.fullmatch(w) and "<|" not in w]
            odd = list(words.difference(plain))
            joined = " ".join(plain)
        pieces, new = SPACED.findall(joined.lower()), []
        self.pieces[" "] = GAP
        for p in set(pieces).difference(self.pieces):
            if ids := self.older.pop(p, None):
                self.pieces[p] = ids
            else:
                new.append(p)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            raw = self._whole([" ".join(part)])[0]
            # Each piece ends in the one token that carries the end of a word.
            cuts = (4 * np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 4).tolist()
            if len(cuts) == len(part) and cuts[-1] == len(raw):
                self.pieces.update(zip(part, (raw[i:j] for i, j in zip([0, *cuts], cuts, strict=False)), strict=True))
            else:
                self.pieces.update(zip(part, self._whole(part), strict=True))
        if plain:
            self.words.update(zip(plain, b"".join(map(self.pieces.__getitem__, pieces)).split(GAP), strict=True))
        if odd:
            self.words.update(zip(odd, self._whole(odd), strict=True))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for text in texts:
            text = text or ""
            if SEPARATORS.search(text):
                yield self._whole([text])[0]
                continue
            out = []
            for part in _slices(text):
                words = part.split()
                if missing := set(words).difference(self.words):
                    if len(self.words) + len(missing) > CACHED:
                        missing = set(words)
                    self._learn(missing)
                out.append(b"".join(map(self.words.__getitem__, words)))
            yield b"".join(out)


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One for all tasks of a Python worker, so that a task finds the words of those before it."""
    return WordTokens(path)


def _slices(text: str) -> Iterator[str]:
    """A text in parts of about SLICE characters, cut at white space."""
    at = 0
    while len(text) - at > SLICE:
        gap = re.compile(r"\s").search(text, at + SLICE)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def _key(df: DataFrame, name: str, to: str = "id") -> StructField:
    return StructField(to, df.schema[name].dataType)


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32 and, if asked for, ids (binary, little-endian 32 bits).

    Each text's ids are followed by ``end``; only longer ones are cut, at every
    ``capacity`` tokens. A null text counts as empty and gives the one token ``end``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, last = word_tokens(path), np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, raw in enumerate(tokens.encode(part.column(1).to_pylist())):
                    raw += last
                    n = len(raw) // 4
                    for k, s in enumerate(range(0, n, capacity)):
                        own = raw[4 * s : 4 * (s + capacity)]
                        row.append(i), piece.append(k), start.append(s), length.append(len(own) // 4), crc.append(zlib.crc32(own))
                        ids.append(own if with_ids else None)
                out = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    rows = pick(docs, id_col, text_col).toDF("id", "text")
    kind = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(cut, kind)


@dataclass
class Bins:
    """``count`` sequences that hold the same lengths: runs (length, first rank, times in each)."""

    count: int
    left: int
    runs: list[tuple[int, int, int]] = field(default_factory=list)


def _best_pattern(sizes: np.ndarray, duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity of the greatest dual value.

    Layer k holds, for every room, the best value of at most k pieces and the last of them;
    the last layer is needed for the whole capacity only.
    """
    order = np.flatnonzero(duals > 1e-12)
    pattern = np.zeros(len(sizes), int)
    if not len(order):
        return 0.0, pattern
    by = np.full(capacity + 1, -1)
    for g in order[np.argsort(duals[order], kind="stable")]:  # the most valuable of those that fit
        by[sizes[g] :] = g
    value, took = np.where(by >= 0, duals[by], 0.0), [by]
    for _ in range(int(capacity // sizes.min()) - 2):
        more, last = value.copy(), np.full(capacity + 1, -1)
        for g in order:
            new = value[: capacity + 1 - sizes[g]] + duals[g]
            better = new > more[sizes[g] :] + 1e-12
            more[sizes[g] :][better] = new[better]
            last[sizes[g] :][better] = g
        value, took = more, [*took, last]
    at = duals[order] + value[capacity - sizes[order]]
    best, room = int(at.argmax()), capacity
    total = float(at[best])
    if total > value[capacity] + 1e-12:
        pattern[order[best]] += 1
        room -= sizes[order[best]]
    else:
        total = float(value[capacity])
    for by in reversed(took):
        if by[room] >= 0:
            pattern[by[room]] += 1
            room -= sizes[by[room]]
    return total, pattern


def _first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns that fill up with the largest sizes left, each used until one of its sizes is used up.

    No later pattern holds that size, so these columns are independent, and their use isn't negative.
    """
    left, alive, basis = demand.astype(float), list(np.argsort(-sizes, kind="stable")), np.zeros((len(sizes), len(sizes)))
    while alive:
        room, pattern = capacity, np.zeros(len(sizes))
        for g in alive:
            pattern[g], room = room // sizes[g], room % sizes[g]
        held = np.flatnonzero(pattern)
        out = held[int((left[held] / pattern[held]).argmin())]
        left -= left[out] / pattern[out] * pattern
        basis[:, out] = pattern
        alive.remove(out)
    return basis


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Patterns of few sizes and how often to use each: the linear relaxation, by column generation.

    It starts from patterns filled largest first and ends at the optimum, or where less than
    one sequence lies between it and the bound by volume, which no plan beats. If neither is
    reached in ``rounds`` it says so.
    """
    floor = float(sizes @ demand) / capacity
    basis = _first_basis(sizes, demand, capacity)
    inverse = np.linalg.inv(basis)
    for turn in range(rounds):
        if turn % 64 == 63:  # what rounding has gathered
            inverse = np.linalg.inv(basis)
        x = inverse @ demand
        if float(x.sum()) < floor + 1 - 1e-6:
            break
        value, pattern = _best_pattern(sizes, inverse.sum(0), capacity)
        if value <= 1 + 1e-7:
            break
        move = inverse @ pattern
        ratio = np.where(move > 1e-9, np.maximum(x, 0) / np.where(move > 1e-9, move, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / move[out]
        inverse -= np.outer(move, row)
        inverse[out] = row
    else:
        warnings.warn(f"configurations after {rounds} rounds: {float(np.sum(inverse @ demand)):.1f} sequences, {floor:.1f} by volume", stacklevel=2)
    x = np.linalg.solve(basis, demand)
    return [(basis[:, i].round().astype(int), float(v)) for i, v in enumerate(x) if v >= 1]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Bins]:
    """Sequences for so many pieces of each length; the input is a histogram of at most ``capacity`` lengths.

    Large lengths fall into ``groups`` groups of about equal cardinality and are rounded up
    to the largest of their group. The patterns of these few sizes are optimised; then the
    groups' actual pieces take the places in them, longest first, which leaves room. What
    is left over, and all small pieces, go best-fit: longest first, each into the fullest
    sequence that still holds it. Equal sequences are kept as one entry with a count.
    """
    counts = {n: c for n, c in counts.items() if c > 0}
    done = [Bins(counts[capacity], 0, [(capacity, 0, 1)])] if counts.get(capacity) else []
    used = Counter({capacity: counts.get(capacity, 0)})
    large = [n for n in sorted(counts, reverse=True) if LARGE * capacity < n < capacity]
    open_: dict[int, list[Bins]] = defaultdict(list)
    if large:
        each, pools, size = sum(counts[n] for n in large) / groups, [[]], 0
        for n in large:
            if pools[-1] and size >= each:
                pools.append([])
                size = 0
            pools[-1].append(n)
            size += counts[n]
        sizes = np.array([p[0] for p in pools])
        demand = np.array([sum(counts[n] for n in p) for p in pools], float)
        for pattern, times in configurations(sizes, demand, capacity):
            for b in _substitute(pattern, int(times + 1e-9), pools, counts, used):
                b.left = capacity - sum(n * k for n, _, k in b.runs)
                open_[b.left].append(b)
    for n in sorted(counts, reverse=True):
        _best_fit(n, counts[n] - used[n], used[n], open_, capacity)
    return done + [b for bins in open_.values() for b in bins]


def _substitute(pattern: np.ndarray, times: int, pools: list[list[int]], counts: dict[int, int], used: Counter) -> Iterator[Bins]:
    """``times`` sequences of one pattern, filled with the actual lengths of its groups."""
    slots = []
    for g, k in enumerate(pattern):
        for _ in range(k):
            need, runs = times, []
            for n in pools[g]:
                if need and (take := min(need, counts[n] - used[n])):
                    runs.append((n, used[n], take))
                    used[n] += take
                    need -= take
            slots.append(runs)
    # Cut wherever a slot goes over to its next length; a slot that ran out stays empty.
    cuts = sorted({0, times, *(int(e) for runs in slots for e in np.cumsum([c for _, _, c in runs]) if e < times)})
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        held = []
        for runs in slots:
            at = 0
            for n, first, c in runs:
                if at <= lo < at + c:
                    held.append((n, first + lo - at, 1))
                at += c
        if held:
            yield Bins(hi - lo, 0, held)


def _best_fit(n: int, todo: int, rank: int, open_: dict[int, list[Bins]], capacity: int) -> None:
    """Put ``todo`` pieces of length ``n``, ranked from ``rank``, into the fullest sequences that hold them."""
    for left in sorted(x for x in open_ if x >= n):
        while todo and open_[left]:
            b, per = open_[left].pop(), left // n
            full, rest = min(b.count, todo // per), 0
            if full:
                open_[left - per * n].append(Bins(full, left - per * n, [*b.runs, (n, rank, per)]))
                todo, rank = todo - full * per, rank + full * per
            if full < b.count:
                rest = todo  # fewer than one more sequence takes
                tail = [(m, f + full * k, k) for m, f, k in b.runs]
                if rest:
                    open_[left - rest * n].append(Bins(1, left - rest * n, [*tail, (n, rank, rest)]))
                    todo, rank = 0, rank + rest
                if b.count - full - bool(rest):
                    skip = bool(rest)
                    open_[left].append(Bins(b.count - full - skip, left, [(m, f + skip * k, k) for m, f, k in tail]))
        if not todo:
            return
    per = capacity // n
    if todo >= per:
        open_[capacity - per * n].append(Bins(todo // per, capacity - per * n, [(n, rank, per)]))
    if rest := todo % per:
        open_[capacity - rest * n].append(Bins(1, capacity - rest * n, [(n, rank + todo - rest, rest)]))


def _places(bins: list[Bins]) -> dict[int, np.ndarray]:
    """For each length, its runs by first rank: first rank, first sequence, times in each, offset."""
    places, sequence = defaultdict(list), 0
    for b in bins:
        offset = 0
        for n, first, per in b.runs:
            places[n].append((first, sequence, per, offset))
            offset += n * per
        sequence += b.count
    return {n: np.array(sorted(p), np.int64) for n, p in places.items()}


PLACE = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (id, piece, start, length, ids_crc32) with their sequence_id and offset.

    Only the histogram of lengths, at most ``capacity`` rows, reaches the driver, which
    plans how many sequences hold which lengths (:func:`plan`). Then every piece takes the
    place of its rank among those of its length. Ranks come from counts for shares of each
    length, so that a length that a third of all pieces have isn't sorted in one task.
    """
    total = pieces.count()
    shares = max(64, total // 50_000)
    spread = pieces.withColumn("share", F.pmod(F.xxhash64("id", "piece", "start", "ids_crc32"), F.lit(shares)))
    sized = materialize(spread.groupBy("length", "share").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in sized.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = pieces.sparkSession.sparkContext.broadcast(_places(plan(counts, capacity, groups)))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sized.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "share").orderBy("id", "piece", "start", "ids_crc32")
    ranked = spread.withColumn("nth", F.row_number().over(own)).join(firsts, ["length", "share"])

    @F.pandas_udf(PLACE)
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        out = np.zeros((2, len(ranks)), np.int64)
        for n in np.unique(lengths):
            at, runs = lengths == n, sent.value[int(n)]
            own = runs[np.searchsorted(runs[:, 0], ranks[at], "right") - 1]
            nth = ranks[at] - own[:, 0]
            out[0, at] = own[:, 1] + nth // own[:, 2]
            out[1, at] = own[:, 3] + nth % own[:, 2] * n
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    placed = ranked.withColumn("place", place("length", F.col("first") + F.col("nth") - 1))
    return placed.select("id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack: a row per piece, see :func:`token_pieces` and :func:`pack`.

    Rows that repeat an id or a text are packed each; a null id stays null; an empty table
    gives no rows. Other columns, whatever their names, are left out.
    """
    pieces = materialize(token_pieces(docs, path, id_col, text_col, capacity))
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
