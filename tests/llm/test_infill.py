"""Fill-in-the-middle against plain cuts, and back."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from spanroute.llm.infill import GRAMMARS, Grammar, infill, restored, units
from spanroute.llm.queries import ORACLES, op11_fill_in_middle

ODD = ["", None, "\n", "\n\n", "a", "a\n", "\na", "a\nb", "a\r\nb\r\n", "  ", "a b\x85c\n", "é👍\n👍👍", "<P> is here\nb", "x<S>", "<M>", "<<P", "S>\n<P", "a<\nP>", "x.y!? z", "1a 2b;\n{}"]


def plain(doc_id, text, pattern=r"[^\n]*\n|[^\n]+", rate=100):
    text = text or ""
    cut = re.findall(pattern, text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(cut) + 1), h2 % (len(cut) + 1)))
    if text == "" or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, len(cut), "plain", None, None, text)
    p, m, s = "".join(cut[:a]), "".join(cut[a:b]), "".join(cut[b:])
    if h4 % 100 < 50:
        return (doc_id, len(cut), "spm", p, m, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(cut), "psm", p, m, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("name", GRAMMARS)
def test_boundaries_cut_as_patterns_match(spark, name):
    rng = random.Random(name)
    texts = [t for t in ODD if t] + ["".join(rng.choice(" \n\t\x0b.!?;{}aZé日👍09<") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", units(F.col("text"), GRAMMARS[name]).alias("u")).collect()
    for r in rows:
        assert r.u == re.findall(GRAMMARS[name].pattern, r.text), r.text
        assert "".join(r.u) == r.text


@pytest.mark.parametrize("rate", [100, 40, 0])
def test_infill_and_back(spark, rate):
    """Odd texts, null and repeated ids, clashing names; forms, parts, outputs and what is read back."""
    rng = random.Random(rate)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a\nb\nc"), (3, "a\nb"), (3, "a\nb"), (-5, "x\n" * 9)]
    rows += [(100 + i, "".join(rng.choice("ab \n<PSM>é👍") for _ in range(rng.randrange(80)))) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, N int")
    done = infill(docs, rate=rate)
    got = done.select("doc_id", "n", "form", "prefix", "middle", "output").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted((plain(i, t, rate=rate) for i, t in rows), key=key)
    back = done.select("doc_id", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(tuple, back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert infill(docs.limit(0)).count() == 0


def test_other_grammars_and_sentinels(spark):
    text = "def f(x):\n    return x + 1;\n"
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    done = infill(docs, GRAMMARS["characters"], sentinels=("<|p|>", "<|s|>", "<|m|>"))
    rows = done.select("n", "form", "prefix", "middle", "suffix", restored(F.col("output"), F.col("form"), ("<|p|>", "<|s|>", "<|m|>")).alias("back")).collect()
    assert {r.n for r in rows} == {len(text)} and {r.back for r in rows} == {text} and {r.form for r in rows} == {"psm", "spm"}
    assert all(r.prefix + r.middle + r.suffix == text for r in rows)
    for bad in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P", "P>", "<M>")):
        with pytest.raises(ValueError):
            infill(docs, sentinels=bad)
    assert Grammar.ended_by(r"\n").boundary == r"(?<=[\n])(?=[\s\S])"


def test_long_texts(spark):
    docs = spark.createDataFrame([(1, "line of text\n" * 400_000), (2, "x" * 3_000_000)], "doc_id long, text string")
    done = infill(docs)
    rows = done.select("doc_id", "n", F.length("output").alias("o"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("h")).orderBy("doc_id").collect()
    assert [(r.n, r.o) for r in rows] == [(400_000, 5_200_009), (1, 3_000_009)]
    assert [r.h for r in rows] == [hashlib.sha256(t.encode()).hexdigest() for t in ("line of text\n" * 400_000, "x" * 3_000_000)]


def test_query(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    got = op11_fill_in_middle(spark, sf_small)
    want = con.execute(ORACLES["op11_fill_in_middle"])
    names = [d[0] for d in want.description]
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
