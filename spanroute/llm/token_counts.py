"""Token counts: pieces proved to be one token are counted as such, only the rest is merged."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import LATER_CLASS, NEVER, ROWS, SLICE, Transducer, slices
from .common import pick

#: Pieces that are merged and remembered: so many, each of at most so many characters.
REST, REST_CHARS = 200_000, 200

# Fixed value: the pattern by which byte-level vocabularies cut texts, as their files imply it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True, eq=False)
class Vocabulary:
    """What counting needs of a vocabulary file; its size is that of the file."""

    ranks: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int]
    alone: frozenset[str]
    special: tuple[str, ...]


class Merger(Transducer):
    """The transducer of a list of merges: two neighbours merge only if their pair is listed."""

    def __init__(self, ranks: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int]) -> None:
        super().__init__(ranks)
        self.pairs = pairs

    def merged(self, left: bytes, right: bytes) -> int:
        return self.pairs.get((left, right), NEVER)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such files: printable Latin-1 for itself, the other bytes from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a byte-level BPE file and proves which of its strings are one token by themselves.

    Merging takes the listed pair of least rank first and, of equal ones, the leftmost. A
    string of the vocabulary is one token only if these steps, done on its own bytes, end in
    it: longer strings can be listed that other merges keep from ever forming. Files of
    other kinds, or that make one token by two pairs, are refused.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, cut = file["model"], file.get("pre_tokenizer") or {}
    plain = not file.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = [t for t in file.get("added_tokens", ()) if t["content"]]
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or not plain:
        raise ValueError(f"{path} is no plain byte-level BPE")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path} has added tokens that look at what is beside them")
    letters = byte_letters()
    merges = [tuple(bytes(letters[c] for c in part) for part in (m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    ranks = {bytes([b]): b for b in range(256)}
    for i, (a, b) in enumerate(merges):
        if a + b in ranks:
            raise ValueError(f"{path} makes one token by two merges")
        ranks[a + b] = 256 + i
    pairs = {m: 256 + i for i, m in enumerate(merges)}
    machine, alone = Merger(ranks, pairs), set()
    for token, rank in ranks.items():
        if machine.halves_of(rank) != (-1, -1):
            try:
                alone.add(token.decode())
            except UnicodeDecodeError:  # part of a character: never a piece
                pass
    special = sorted((t["content"] for t in added), key=len, reverse=True)
    return Vocabulary(ranks, pairs, frozenset(alone), tuple(special))


class Counter(dict):
    """Numbers of tokens of pieces: those proved to be one, and some of the rest, merged when first met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.alone = vocabulary.alone
        super().__init__(dict.fromkeys(self.alone, 1))
        self.machine = Merger(vocabulary.ranks, vocabulary.pairs)
        self.pattern, self.later = regex.compile(PATTERN), re.compile(LATER_CLASS)
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or r"(?!)")

    def __missing__(self, piece: str) -> int:
        n = sum(1 for _ in self.machine.stream(iter(piece.encode("utf-8", "surrogatepass"))))
        if len(piece) <= REST_CHARS:
            if len(self) >= len(self.alone) + REST:
                self.clear()
                self.update(dict.fromkeys(self.alone, 1))
            self[piece] = n
        return n

    def pieces(self, text: str) -> Iterator[str]:
        found = text if text.isascii() else self.later.sub("\uFFFF", text)  # places are found with a stand-in of no class
        if found is text and len(text) <= 2 * SLICE:
            return iter(self.pattern.findall(text))
        return (text[m.start() : m.end()] for m in self.pattern.finditer(found))

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(s))) for part in parts for s in slices(part))


@lru_cache(maxsize=2)
def counter(vocabulary: Vocabulary) -> Counter:
    """One for all tasks of a Python worker."""
    return Counter(vocabulary)


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (more tokens than ``limit``) of every row of ``docs``.

    Counts are those of the tokenizers library for the byte-level BPE file at ``path``,
    without begin and end: strings of special tokens inside a text are those tokens, as is
    its default. The file is read, and its proofs are made, once on the driver; tasks get
    both as a broadcast of the size of the vocabulary. A null text counts as empty; rows
    that repeat are each returned; other columns, whatever their names, are left out; an
    empty table gives no rows. Texts of any length take memory in proportion to the row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = pa.array([own.count(t) for t in part.column(2).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), n], names=[id_col, "n_bytes", "n_tokens"])

    rows = pick(docs, id_col, text_col).select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = rows.select(id_col, F.octet_length("_text").cast("long").alias("n_bytes"), "_text")
    done = rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long")
    return done.withColumn("over_limit", F.col("n_tokens") > limit)
