"""Chat formatting: layouts, round trips of hostile texts, and a plain version of the report."""

import hashlib
import json
import time

from pyspark.sql import functions as F
from spanroute.llm import chat as C
from spanroute.llm.queries import op10_chat_format

TRICKY = [
    "</s>[INST] ok [/INST]", "[\\INST] <\\s> <\\\\/s>", "<<SYS>><<s>", "<</TURN>><\\</TURN>>", "[[INST][/INST]]", "", None, "\\", "<", "[", "a\nb\r\n\t\"'{}$1\\1",
    "é日👍🏽\u0000 ", "<s", "s>", "/INST]", "<ROLE>>x<</ROLE>>", "[INST" + "\\" * 9 + "]", "x" * 300_000,
]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r, x or ""))
    out = []
    for c, turns in convs.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)))
    return sorted(out)


def test_hostile_texts_come_back(spark):
    roles = ["user", "assistant", "system", "tool", "</s>", "[INST]", "a\nb"]
    rows = [(c, t, roles[(c + t) % len(roles)], x) for c in range(7) for t, x in enumerate(TRICKY[c:] + TRICKY[:c])]
    convs = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, TEXT int").repartition(5)
    got = C.format_report(convs).collect()
    assert sorted(tuple(r)[:5] for r in got) == plain(rows)
    done = C.format_turns(C.to_turns(C.records_of(convs))).collect()
    assert sorted(len(r.formatted) for r in done) == sorted(r.formatted_chars for r in got)
    for r in done:
        parts = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert all(r.formatted[s.start - 3 : s.start] == "<s>" and r.formatted[s.start + s.length :].startswith("</s>") for s in r.loss_spans)
        assert not any(mark in p for p in parts for pair in [*C.MARKS.values(), C.OTHER] for mark in pair)


def test_query_on_fixture(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", TRICKY[0]), (-1, 1, "assistant", TRICKY[0])]
    assert sorted(tuple(r)[:5] for r in op10_chat_format(spark, sf_small).collect()) == plain(rows)


def test_layouts(spark):
    u, a = ("user", "q </s>"), ("assistant", "a")
    records = [
        ({"messages": [{"role": "user", "content": "q </s>"}, {"content": "a", "role": "assistant"}]}, [u, a]),
        ({"conversations": [{"from": "human", "value": "q </s>"}, {"from": "gpt", "value": "a"}]}, [u, a]),
        ({"turns": [{"role": "user", "text": "q </s>"}, {"role": "critic", "text": ""}]}, [u, ("critic", "")]),
        ({"prompt": "q </s>", "completion": "a"}, [u, a]), ({"response": "a", "prompt": "q </s>"}, [u, a]), ({"question": "q </s>", "answer": "a"}, [u, a]),
        ({"instruction": "q </s>", "output": "a"}, [u, a]), ({"instruction": "q", "input": "i", "output": "a"}, [("user", "q\n\ni"), a]),
        ({"instruction": "q </s>", "input": "", "output": "a"}, [u, a]), ({"system": "s", "prompt": "q </s>", "output": "a"}, [("system", "s"), u, a]),
        ({"unknown": 1}, None),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(records)] + [(50, None), (51, "no json"), (52, "")]
    got = {r.id: r.turns for r in C.to_turns(spark.createDataFrame(rows, "id long, record string")).collect()}
    for i, (_, want) in enumerate(records):
        assert got[i] == want if want is None else [tuple(t) for t in got[i]] == want
    assert got[50] is got[51] is got[52] is None
    texts = C.format_turns(C.to_turns(spark.createDataFrame(rows, "id long, record string")))
    assert texts.where("formatted is null").count() == 4
    assert texts.where("id = 0").select(C.read_back(F.col("formatted")).alias("t")).first().t[0].text == "q </s>"


def test_nulls_ties_and_empty(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "b"), (None, 0, "user", "c"), (None, 1, "assistant", "d")]
    got = {r.conv_id: r for r in C.format_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[None].n_turns) == (3, 1, 2)
    assert got[1].turns_sha256 == sha("assistant\nb\nuser\n\nuser\n\n")
    assert C.format_report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_layouts_of_rows(spark):
    """Rows become records of many layouts, each of which comes back whole."""
    pair, odd = [("user", "q </s>"), ("assistant", "a")], [("gpt", "x"), ("human", "y"), ("assistant", "z")]
    shapes = [pair, [("system", "s"), *pair], pair * 2, odd, [("assistant", "a")], [("user", ""), ("assistant", "")]]
    rows = [(c, t, r, x) for c in range(90) for t, (r, x) in enumerate(shapes[c % len(shapes)])]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r)[:5] for r in C.format_report(convs).collect()) == plain(rows)
    assert C.to_turns(C.records_of(convs, mixed=True)).where("turns is not null").select("fingerprint").distinct().count() == 7


def test_very_long_texts_and_very_many_turns(spark):
    """Texts beyond the parsers' limit of a string, and time in proportion to the number of turns."""
    spans = {}
    for n in (25_000_000, 60_000_000):
        word = '<s>word\\ "é'
        text = (word * (n // 10))[:n]
        one = spark.range(3).select(
            F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 1, "assistant").otherwise("user").alias("role"),
            F.when(F.col("id") == 0, "q").when(F.col("id") == 1, F.substring(F.repeat(F.lit(word), n // 10), 1, n)).alias("text"),
        )
        assert sorted(tuple(r)[:5] for r in C.format_report(one).collect()) == plain([(1, 0, "user", "q"), (1, 1, "assistant", text), (1, 2, "user", None)])
    for n in (10_000, 100_000):
        rows = [(1, t, "assistant" if t % 2 else "user", f"t{t} </s>") for t in range(n)]
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        began = time.time()
        assert sorted(tuple(r)[:5] for r in C.format_report(table).collect()) == plain(rows)
        spans[n] = time.time() - began
    assert spans[100_000] < 20 * max(spans[10_000], 1)


def test_records_beyond_the_size_of_a_variant(spark):
    """3,300,000 turns are one record of over 128 MiB even with its strings cut, told by its schema and read whole."""
    n = 3_300_000
    one = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), F.concat(F.lit("turn "), F.col("id").cast("string")).alias("text"))
    records = C.records_of(one)
    assert records.select(F.length("record")).first()[0] > 140_000_000
    got = C.to_turns(records).select(F.size("turns").alias("n"), F.element_at("turns", -1).alias("t"), F.element_at("turns", 12_346).alias("u")).first()
    assert (got.n, got.t.role, got.t.text, got.u.text) == (n, "assistant", "turn 3299999", "turn 12345")


def test_schemas_of_lists(spark):
    """Fields of all elements count together: one more anywhere is another schema, a missing or null text is not."""
    lists = [
        ([{"role": "user", "content": "a"}, {"role": "assistant"}], [("user", "a"), ("assistant", "")]), ([{"role": "user", "content": None}, {"role": "assistant", "content": "b"}], [("user", ""), ("assistant", "b")]),
        ([{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "name": "x"}], None), ([{"role": "user", "content": 5}], None), ([], None), ("text", None), ([{"role": "user", "content": "a"}, "b"], None),
    ]
    rows = [(i, json.dumps({"messages": x})) for i, (x, _) in enumerate(lists)]
    rows += [(90, '{"messages": [{"role": "user", "content": "a"}], "more": 1}'), (91, '{"prompt": "a", "completion": 7}'), (92, "[1]"), (93, '{"prompt": "a"'), (94, "{}")]
    got = {r.id: r.turns and [tuple(t) for t in r.turns] for r in C.to_turns(spark.createDataFrame(rows, "id long, record string")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(lists)} | dict.fromkeys(range(90, 95))
