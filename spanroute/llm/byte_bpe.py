"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by a UTF-8 machine."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pick

#: Bounds of what a task keeps: pieces with their ids, of which those not met again for as many
#: go; compiled moves; and pairs of tokens that stay or don't.
PIECES, MOVES, PAIRS = 220_000, 500_000, 400_000
#: Characters of a text cut into pieces at a time, and rows handed on at a time.
SLICE, ROWS = 1 << 20, 256
ROOT, NEVER = 0, 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


# Letters and numbers of a later Unicode version than that of the libraries whose
# ids are to be met, where they count as neither. The installed pattern library knows them.
LATER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB "
    "11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 16FF4-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F "
)
LATER_CLASS = "[" + "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in LATER.split()) + "]"


class Transducer:
    """Maps the bytes of a piece to the tokens that merging by rank gives.

    Merging gives the one sequence of tokens in which every two neighbours, merged by
    themselves, stay as they are. An automaton that may begin a token at every byte, and
    allows one only after a token that stays beside it, so has one path for each text. It
    is determinised while reading: a state stands for the longest beginning of a token that
    the bytes read end in, and so for all shorter ones, and its moves and the tokens that
    end in it are compiled when first met. Of these tokens exactly one may follow the token
    that ended where it begins; that one is kept for the place. A place is looked back on
    for as long as a token may still begin there, which is bounded by the longest token;
    what all places still open have in common is put out.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.trie: dict[int, int] = {}  # node * 256 + byte
        self.token, self.parent, self.depth = [-1], [0], [0]
        for token, rank in ranks.items():
            node = ROOT
            for b in token:
                key = node << 8 | b
                if key not in self.trie:
                    self.trie[key] = len(self.token)
                    self.token.append(-1)
                    self.parent.append(key)
                    self.depth.append(self.depth[node] + 1)
                node = self.trie[key]
            self.token[node] = rank
        self.moves: dict[int, int] = {}
        self.shorter: dict[int, int] = {ROOT: ROOT}
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {ROOT: ()}
        self.stays: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}

    def move(self, node: int, byte: int) -> int:
        key = node << 8 | byte
        to = self.moves.get(key)
        if to is None:
            to = self.trie.get(key)
            if to is None:
                to = ROOT if node == ROOT else self.move(self.fallback(node), byte)
            if len(self.moves) > MOVES:
                self.moves.clear()
            self.moves[key] = to
        return to

    def fallback(self, node: int) -> int:
        """The state of the longest beginning of a token that is shorter."""
        to = self.shorter.get(node)
        if to is None:
            before, byte = self.parent[node] >> 8, self.parent[node] & 255
            to = self.shorter[node] = ROOT if before == ROOT else self.move(self.fallback(before), byte)
        return to

    def ending(self, node: int) -> tuple[tuple[int, int], ...]:
        """Lengths and ids of the tokens that end in a state, the longest first."""
        found = self.ends.get(node)
        if found is None:
            own, token = (), self.token[node]
            if token >= 0 and self.halves_of(token) != (-1, -1):
                own = ((self.depth[node], token),)
            found = self.ends[node] = own + self.ending(self.fallback(node))
        return found

    def merged(self, left: bytes, right: bytes) -> int:
        """The rank of merging two neighbours, ``NEVER`` if they don't merge."""
        return self.ranks.get(left + right, NEVER)

    def halves_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; none for one byte, and (-1, -1) if merging never makes it."""
        if (known := self.halves.get(token, 0)) != 0:
            return known
        piece = self.bytes_of[token]
        parts, known = [piece[i : i + 1] for i in range(len(piece))], None
        while len(parts) > 1:
            ranks = [self.merged(a, b) for a, b in zip(parts, parts[1:], strict=False)]
            best = ranks.index(min(ranks))
            if ranks[best] == NEVER:
                known = (-1, -1)
                break
            if len(parts) == 2:
                known = (self.ranks[parts[0]], self.ranks[parts[1]])
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        self.halves[token] = known
        return known

    def may_follow(self, before: int, token: int) -> bool:
        """Whether merging leaves ``token`` and the one before it as they are.

        Merges are undone from the latest on. What then lies on both sides of the boundary
        would have merged across it if that has a rank below those of the merges undone;
        of equal ranks the left one comes first.
        """
        key = before << 32 | token
        if (known := self.stays.get(key)) is not None:
            return known
        a, b, limit, known = before, token, NEVER, None
        while known is None:
            if self.merged(self.bytes_of[a], self.bytes_of[b]) < limit:
                known = False
                break
            x, y = self.halves_of(a), self.halves_of(b)
            if x is None and y is None:
                known = True
            elif y is None or (x is not None and a > b):
                a, limit = x[1], a
            else:
                b, limit = y[0], b + 1
        if len(self.stays) > PAIRS:
            self.stays.clear()
        self.stays[key] = known
        return known

    def stream(self, piece: Iterator[int]) -> Iterator[int]:
        """Tokens of the bytes of a piece, each as soon as it is settled, looking ahead by a bounded stretch."""
        node, held, every = ROOT, [-1], 4 * self.longest  # held: the token that ends at each place looked back on
        moves, ends, stays = self.moves, self.ends, self.stays
        for byte in piece:
            node = moves.get(node << 8 | byte) or self.move(node, byte)
            at = len(held)
            for length, token in ends.get(node) or self.ending(node):
                if length > at:
                    continue
                before = held[at - length]
                if before < 0:
                    if length == at:  # the piece begins here
                        break
                elif stays.get(before << 32 | token) or self.may_follow(before, token):
                    break
            else:
                raise ValueError("these ranks have no way of merging")
            held.append(token)
            if at > every:
                out, held = self.settle(held, self.depth[node])
                yield from out
        yield from self.path(held, len(held) - 1)

    def path(self, held: list[int], at: int) -> list[int]:
        out = []
        while held[at] >= 0 and at > 0:
            out.append(held[at])
            at -= len(self.bytes_of[held[at]])
        return out[::-1]

    def settle(self, held: list[int], depth: int) -> tuple[list[int], list[int]]:
        """What the paths to all places at which a token may still begin have in common, and what is still held."""
        last = len(held) - 1
        paths = [self.path(held, at) for at in range(last - depth, last + 1)]
        first = paths[0]
        n = min(map(len, paths))
        while n and any(p[:n] != first[:n] for p in paths):
            n -= 1
        gone = sum(len(self.bytes_of[t]) for t in first[:n])
        return first[:n], held[gone:]

    def encode(self, piece: bytes) -> bytes:
        """The ids of a piece as little-endian unsigned 32-bit integers."""
        whole = self.ranks.get(piece)
        return _packed((whole,) if whole is not None else self.short(piece) if len(piece) <= 4 * self.longest else [*self.stream(piece)])

    def short(self, piece: bytes) -> list[int]:
        """As :func:`stream` for a piece that ends before anything need be put out."""
        node, held, move, ends, stays = ROOT, [-1], self.moves.get, self.ends.get, self.stays.get
        for at, byte in enumerate(piece, 1):
            node = move(node << 8 | byte) or self.move(node, byte)
            for length, token in ends(node) or self.ending(node):
                before = held[at - length]
                if before < 0:
                    if length == at:  # the piece begins here
                        break
                elif stays(before << 32 | token) or self.may_follow(before, token):
                    break
            else:
                raise ValueError("these ranks have no way of merging")
            held.append(token)
        return self.path(held, len(piece))


def _packed(ids: Sequence[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of whole texts: each match of a pattern by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.machine, self.pattern, self.known, self.older = Transducer(ranks), regex.compile(pattern), {}, {}
        self.later = re.compile(LATER_CLASS)

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not self.later.search(text):
            return self.pattern.findall(text)
        # Places are found with a stand-in of no class.
        return [text[m.start() : m.end()] for m in self.pattern.finditer(self.later.sub("\uFFFF", text))]

    def encode(self, text: str) -> bytes:
        out = []
        for part in slices(text):
            pieces, known = self.pieces(part), self.known
            for p in set(pieces).difference(known):
                known[p] = self.older.get(p) or self.machine.encode(p.encode("utf-8", "surrogatepass"))
            out.append(b"".join(map(known.__getitem__, pieces)))
            if len(known) > PIECES:
                self.known, self.older = {}, known
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for all tasks of a Python worker, so that a task finds what those before it compiled."""
    return Encoder(load_ranks(path), pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(load_ranks(path))


def slices(text: str) -> Iterator[str]:
    """A text in parts, cut before a lone space between words, where no match goes on."""
    at, gap = 0, re.compile(r"(?<=\S) (?=\S)")
    while len(text) - at > SLICE:
        found = gap.search(text, at + SLICE)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _complete(data: bytes) -> int:
    """How many bytes of ``data`` form whole code points; bytes that can't be in one count by themselves."""
    at = 0
    while at < len(data):
        lead = data[at]
        need = 1 if lead < 0xC2 or lead > 0xF4 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
        have = data[at + 1 : at + need]
        good = all((low if i == 0 else 0x80) <= b <= (high if i == 0 else 0xBF) for i, b in enumerate(have))
        if good and len(have) < need - 1:
            return at
        at += need if good else 1
    return at


class Decoder:
    """Bytes of ids, put out as soon as their code points are whole.

    A state of the machine is what has begun of a code point, three bytes at most. What a
    token puts out in a state, and the state after it, are worked out when first met.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.states: dict[bytes, dict] = {b"": {}}

    def step(self, pending: bytes, token: int) -> tuple[bytes, bytes]:
        data = pending + self.bytes_of[token]
        cut = _complete(data)
        self.states.setdefault(data[cut:], {})
        out = self.states[pending][token] = (data[:cut], data[cut:])
        return out

    def stream(self, ids: Iterator[int]) -> Iterator[bytes]:
        pending, states, step = b"", self.states, self.step
        for token in ids:
            whole, pending = states[pending].get(token) or step(pending, token)
            yield whole
        yield pending

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.stream(iter(ids.tolist())))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids (binary, little-endian unsigned 32-bit integers) of every row of ``docs``.

    A null text counts as empty and has no ids. Rows that repeat are each returned; other
    columns, whatever their names, are left out; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    rows = pick(docs, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, ids and decoded (the bytes of the text) of what :func:`encode` gives; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = [own.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names=[id_col, "ids", "decoded"])

    rows = pick(encoded, id_col, "ids")
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids binary, decoded binary")
