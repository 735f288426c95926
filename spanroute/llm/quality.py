"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import materialize, pick, pick_row, unpick

#: N-grams are counted in so many buckets (a power of two).
BUCKETS = 1 << 18
#: Bytes looked at together, so that a very long text needs no more memory than others.
WINDOW = 1 << 20
GAP = re.compile(rb"[\x20\x09-\x0D]+")
#: At most so many labelled documents train a model, those of the least hashed ids.
MAX_TRAIN = 8_000
EPOCHS, COST, SMOOTHING = 12, 1.0, 1.0


def _grams(a: np.ndarray, flags: np.ndarray, n: int, salt: int) -> None:
    """Mark the bucket of every window of n bytes."""
    if len(a) < n:
        return
    code = a[: len(a) - n + 1].astype(np.uint32)
    for k in range(1, n):
        code |= a[k : len(a) - n + 1 + k].astype(np.uint32) << np.uint32(8 * k)
    flags[((code ^ np.uint32(salt)) * np.uint32(2654435761)) >> np.uint32(32 - 18)] = True


def _parts(raw: bytes) -> Iterator[bytes]:
    """A text in parts of about WINDOW bytes, cut after white space."""
    at = 0
    while len(raw) - at > WINDOW:
        gap = GAP.search(raw, at + WINDOW)
        if not gap:
            break
        yield raw[at : gap.end()]
        at = gap.end()
    yield raw[at:]


def features(text: str | None, flags: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that a text has: of 4 bytes, and of 4 neighbours that repeat or don't repeat a word.

    A long text is gone through in parts; n-grams over a cut count as others do.
    """
    before, word, repeats = b"", [], b""
    for part in _parts((text or "").encode("utf-8", "surrogatepass")):
        _grams(np.frombuffer(before + part, np.uint8), flags, 4, 0)
        words = word + part.split()
        repeats = repeats[-3:] + bytes(map(eq, words, words[1:]))
        _grams(np.frombuffer(repeats, np.uint8), flags, 4, 0x9E3779B1)
        before, word = (before + part[-3:])[-3:], words[-1:]
    hits = np.flatnonzero(flags)
    flags[hits] = False
    return hits


def packed(hits: np.ndarray) -> bytes:
    """Buckets as numbers or, where that is shorter, as a bit for every bucket: at most BUCKETS / 8 bytes."""
    if 4 * len(hits) < BUCKETS // 8:
        return hits.astype("<i4").tobytes()
    flags = np.zeros(BUCKETS, bool)
    flags[hits] = True
    return np.packbits(flags).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8))) if len(raw) == BUCKETS // 8 else np.frombuffer(raw, "<i4")


@dataclass
class Model:
    """Weights of the buckets, already scaled by the log-count ratios, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None, flags: np.ndarray) -> float:
        hits = features(text, flags)
        margin = self.bias + (float(self.weights[hits].sum()) / len(hits) ** 0.5 if len(hits) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(2 * margin, -500, 500))))


def fit(rows: list[bytes], labels: np.ndarray) -> Model:
    """Log-count ratios of the classes, then a hinge loss by dual coordinate descent.

    ``rows`` are the texts' buckets as :func:`packed` gives them, which bounds the memory of
    a row; ``labels`` are 1 and -1. With one class alone the model gives that class to all.
    """
    weights = np.zeros(BUCKETS)
    if not len(rows) or len(set(labels.tolist())) < 2:
        return Model(weights, float(labels[0]) if len(rows) else 1.0)
    p, q = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for raw, y in zip(rows, labels, strict=True):
        (p if y > 0 else q)[unpacked(raw)] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[p + q <= 2 * SMOOTHING + 1] = 0  # seen once: no evidence for other documents

    def scaled(hits: np.ndarray) -> np.ndarray:
        return ratio[hits] / max(1, len(hits)) ** 0.5

    norms = np.array([float(x @ x) + 1 for x in (scaled(unpacked(raw)) for raw in rows)])
    # The classes weigh alike, however rare one is.
    share = np.where(labels > 0, (labels > 0).mean(), (labels < 0).mean())
    top, alpha, bias = COST / (2 * share), np.zeros(len(rows)), 0.0
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            y, hits = labels[i], unpacked(rows[i])
            x = scaled(hits)
            gradient = y * (float(weights[hits] @ x) + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), top[i])
            if step := (new - alpha[i]) * y:
                alpha[i] = new
                weights[hits] += step * x
                bias += step
    return Model(weights * ratio, bias)


def _learn(batch: pd.DataFrame) -> pd.DataFrame:
    batch = batch.sort_values(["id", "version"], kind="stable")
    model = fit(batch["hits"].tolist(), np.where(batch["label"] > 0, 1, -1))
    at = np.flatnonzero(model.weights)
    return pd.DataFrame({"bucket": np.append(at, -1), "weight": np.append(model.weights[at], model.bias)})


def _hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flags = np.zeros(BUCKETS, bool)
    for b in batches:
        b["hits"] = [packed(features(t, flags)) for t in b["text"]]
        yield b[["id", "version", "label", "hits"]]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", where: Callable[[Column], Column] | None = None, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled documents, those of the least hashed ids.

    ``where`` selects, by the id, which labels may be learned from. Null ids and labels are
    left out; an id whose labels differ has the greatest. An id that repeats counts once
    for each of its different texts; the bound is one of texts. Without any labelled
    document the model accepts all.
    """
    known = pick(labels, id_col, label_col).toDF("id", "label").where("id is not null and label is not null")
    known = known.where(where(F.col("id"))) if where else known
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    known = materialize(known.orderBy(F.xxhash64("id"), "id").limit(max_train))
    rows = pick(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(known), "id").withColumn("version", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    chosen = materialize(rows.select("id", "version").distinct().orderBy(F.xxhash64("id"), "id", "version").limit(max_train))
    rows = rows.join(F.broadcast(chosen), ["id", "version"], "left_semi").select("id", "version", "label", "text")
    hits = rows.mapInPandas(_hits, f"id {dict(known.dtypes)['id']}, version binary, label {dict(known.dtypes)['label']}, hits binary").dropDuplicates(["id", "version"])
    learned = hits.withColumn("model", F.lit(1)).groupBy("model").applyInPandas(_learn, "bucket int, weight double")
    weights, bias = np.zeros(BUCKETS), 1.0
    for r in learned.collect():  # at most BUCKETS rows
        if r["bucket"] < 0:
            bias = r["weight"]
        else:
            weights[r["bucket"]] = r["weight"]
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """The column of scores, 0 to 1, of the texts in ``text_col``; a null text counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        flags, model = np.zeros(BUCKETS, bool), sent.value
        for batch in texts:
            yield pd.Series([model.score(t, flags) for t in batch], dtype="float64")

    return scores(F.col(text_col))


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns, whatever their names."""
    rows = pick_row(docs, text_col).withColumnRenamed(text_col, "text")
    return unpick(rows.where(score(rows, model) >= least), docs.columns)


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: the id's CRC-32, as text, leaves 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5) for every row of ``docs``.

    A null doc_id is in no fold (held_out is false). Other columns are left out and never
    are inputs. An empty table gives no rows.
    """
    model = train(docs, labels, where=lambda i: ~held_out(i))
    rows = pick(docs, "doc_id", "text")
    scored = rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score(rows, model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
