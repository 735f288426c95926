"""Quality classifier: held-out accuracy, folds and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from spanroute.llm import quality as Q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.quality_report(docs, labels).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in out) >= 0.97 * len(out)


def test_labels_of_the_fold_do_not_matter(spark, sf_small):
    docs, labels = spark.read.parquet(f"{sf_small}/documents.parquet"), spark.read.parquet(f"{sf_small}/labels.parquet")
    other = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, Q.quality_report(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_nulls_ties_names_and_empty(spark, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    docs = spark.createDataFrame([(0, None, 1.0, "a"), (0, "", 1.0, "a"), (None, "Pa " * 100_000, 2.0, None)], "doc_id long, text string, score double, TEXT string")
    rows = Q.quality_report(docs, labels).collect()
    assert len(rows) == 3 and rows[0].score == rows[1].score
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.predicted for r in Q.quality_report(docs, none).collect()} == {1}
    assert Q.quality_report(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("window", [1, 7, 100])
def test_parts_have_the_features_of_the_whole(monkeypatch, window):
    rng, flags = np.random.default_rng(1), np.zeros(Q.BUCKETS, bool)
    words = ["a", "a", "bé", "  ", "\n", "longer", "日本", "x" * 150]
    texts = ["", " ", "a", "a a a a a", "y" * 500] + [" ".join(rng.choice(words, 60)) for _ in range(30)]
    whole = [Q.features(t, flags).tolist() for t in texts]
    monkeypatch.setattr(Q, "WINDOW", window)
    assert [Q.features(t, flags).tolist() for t in texts] == whole
    assert not flags.any()
    for hits in (np.arange(5), np.arange(0, Q.BUCKETS, 3), np.array([], int)):
        assert Q.unpacked(Q.packed(hits)).tolist() == hits.tolist()


def test_against_a_plain_fit():
    """Dual coordinate descent ends near the least of the primal that a plain subgradient descent finds."""
    rng = np.random.default_rng(3)
    labels = np.where(rng.random(60) < 0.4, 1, -1)
    rows = [np.unique(np.append(rng.choice(200, 12), rng.choice(30, 4) + (1000 if y > 0 else 1010))) for y in labels]
    model = Q.fit([Q.packed(r) for r in rows], labels)
    p, q = np.ones(Q.BUCKETS), np.ones(Q.BUCKETS)
    for r, y in zip(rows, labels, strict=True):
        (p if y > 0 else q)[r] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[p + q <= 3] = 0
    x = np.zeros((60, 1100))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / len(r) ** 0.5
    x = np.hstack([x, np.ones((60, 1))])
    cost = Q.COST / (2 * np.where(labels > 0, (labels > 0).mean(), (labels < 0).mean()))

    def primal(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - labels * (x @ w))).sum()

    best, w = np.inf, np.zeros(1101)
    for t in range(20_000):
        w -= (w - (cost * labels * (labels * (x @ w) < 1)) @ x) / (t + 10)
        best = min(best, primal(w))
    own = np.append(np.divide(model.weights, ratio, out=np.zeros(Q.BUCKETS), where=ratio != 0)[:1100], model.bias)
    assert primal(own) <= 1.05 * best + 0.05
    flags = np.zeros(Q.BUCKETS, bool)
    assert Q.Model(np.zeros(Q.BUCKETS), 0.0).score("any", flags) == 0.5


def test_rows_of_training_are_bounded(spark, monkeypatch):
    docs = spark.range(400).selectExpr("id % 2 doc_id", "concat('text ', if(id % 2 = 0, 'good fine ', 'bad poor '), id % 50) text", "1 TEXT").repartition(7)
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, None), (None, 1)], "doc_id long, quality int")
    seen = []
    learn = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df: seen.append(learn(df)) or seen[-1])
    model = Q.train(docs, labels, max_train=30)
    assert seen[-1].count() == 30 and seen[-1].distinct().count() == 30
    kept = Q.accepted(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < 400
