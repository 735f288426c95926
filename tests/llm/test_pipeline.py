"""The pipeline's stages, each on its own input, against plain versions."""

import numpy as np
import pytest

import corpus_pipeline as C
from spanroute.llm import packing, quality
from spanroute.llm.common import materialize
from spanroute.llm.line_dedup import MIN_SITES
from tests.llm.test_dedup import plain_lines
from tests.llm.test_packing import check_places, ids_of
from tests.llm.test_simhash import plain_groups


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), []
    for _, f in C.STAGES:
        done = materialize(f(spark, docs, sf_small))
        out.append((docs, done))
        docs = done
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "line dedup", "near copies", "best-fit packing"]
    for before, after in stages[:-1]:
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)


def test_quality(spark, sf_small, stages):
    before, after = (rows(x) for x in stages[0])
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    model = quality.train(stages[0][0], labels, where=lambda i: ~quality.held_out(i))
    flags = np.zeros(quality.BUCKETS, bool)
    assert set(after) == {d for d, r in before.items() if model.score(r.text, flags) >= 0.5}
    assert all(after[d] == before[d] for d in after)
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert sum((d in after) == (q == 1) for d, q in known.items()) >= 0.9 * len(known)  # some 60 labels to learn from


def test_lines(stages):
    before, after = (rows(x) for x in stages[1])
    want = {d: t for d, t, _, _ in plain_lines([(r.doc_id, r.text, r.source) for r in before.values()], MIN_SITES)}
    assert {d: r.text for d, r in after.items()} == want
    assert all(r.n_chars == len(r.text) and (r.lang, r.source) == (before[d].lang, before[d].source) for d, r in after.items())


def test_near_copies(stages):
    before, after = (rows(x) for x in stages[2])
    groups = plain_groups([(r.doc_id, r.text) for r in before.values()])
    assert set(after) == {c for _, _, c in groups}
    assert all(after[d] == before[d] for d in after)


def test_packing(stages):
    docs, packed = stages[3]
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    ids = list(zip([d for d, _ in kept], ids_of([t for _, t in kept]), strict=True))
    n = check_places(packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect(), ids, packing.CAPACITY)
    assert n <= 1.02 * sum(len(x) + 1 for _, x in ids) / packing.CAPACITY + 1


def test_run_is_the_stages(spark, sf_small, stages):
    got = C.run(spark, sf_small)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, stages[3][1].select(key).collect()))


def test_odd_tables(spark, sf_small):
    """Nulls, ties, repeated rows, names that clash, and an empty table, through every stage."""
    long = "A line of its own. " * 40_000
    rows = [(1, None, None, None, None, "x", 1), (None, "", "en", "a", 0, None, 2), (2, "Same words here.\n" * 3, "en", "a", 51, "y", 3), (2, "Same words here.\n" * 3, "en", "a", 51, "y", 3), (3, long, "de", None, 5, "z", 4)]
    rows += [(10 + i, f"The same line.\nOwn words of number {i} and {i * 7} alone.", "en", f"s{i}", 40, "t", i) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, N_LINES int")
    for table in (docs, docs.limit(0)):
        for name, stage in C.STAGES:
            after = materialize(stage(spark, table, sf_small))
            if name != "best-fit packing":
                assert after.columns == docs.columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
            table = after
        assert (table.count() > 0) == (table.columns == after.columns and after.count() > 0)
    done = {tuple(r)[0]: tuple(r) for r in materialize(C.drop_boilerplate(spark, docs, sf_small)).collect()}
    assert done[10][1].startswith("The same line.\n") and done[11][1] == "Own words of number 1 and 7 alone." and done[11][4:] == (34, "t", 1)
    assert done[1][1] == "" and done[3][1] == long
    near = [tuple(r)[0] for r in C.drop_near_copies(spark, docs, sf_small).collect()]
    assert near.count(2) == 1 and len(near) == len(set(near))
