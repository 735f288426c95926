"""Repairs of conversations against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

from pyspark.sql import functions as F
from spanroute.llm import structure_repair as R
from spanroute.llm.queries import op13_structure_repair

WHITE = " \t\n\v\f\r"


def damage(rows):
    """A plain version of the planted faults; rows are (conv_id, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if draw == 3 else 1)
    return out


def repair(turns):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, sha of one conversation's rows (turn, role, text)."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
    if not turns:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.rstrip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    n = len(turns)
    # states of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, q, inserted):
        ways = []
        if i == n and q in (0, 3):
            ways.append((0, "", ()))
        if inserted < 3:
            for r in "ua":
                if (q, r) in step:
                    c, a, t = best(i, step[q, r], inserted + 1)
                    ways.append((c + 3, "I" + a, (({"u": "user", "a": "assistant"}[r], ""), *t)))
        if i < n:
            c, a, t = best(i + 1, q, 0)
            ways.append((c + 4, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                cut = 3 if faults[i] == "truncated" else 0
                role, text = turns[i][1:]
                if (q, role[:1]) in step:
                    c, a, t = best(i + 1, step[q, role[:1]], 0)
                    ways.append((c + cut, "K" + a, ((role, text), *t)))
                for r in ("user", "assistant"):
                    if (q, r[0]) in step:
                        c, a, t = best(i + 1, step[q, r[0]], 0)
                        ways.append((c + cut + 3, "R" + a, ((r, text), *t)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, out = best(0, 0, 0)
    known = [t[0] for t in turns if t[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha)


def report(rows, after=None):
    after = damage(rows) if after is None else after
    return sorted(((c, *repair([t[1:] for t in after if t[0] == c])) for c in {r[0] for r in rows}), key=str)


def conversations(rng, n, longest):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", "usher", None]
    texts = ["Yes.", "No", "", " \n", "Why?", "So it is!  ", "é👍.", "a ", None, "x."]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            turn = rng.choice([t, t, t, t, 2 * t, None])
            rows.append((c if c else None, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"{t}" + rng.choice([".", "", "!"])))
    return rows


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, AUDIT int")
    assert sorted((r.turn, r.role, r.text) for r in R.damaged(df).where("turn is not null").collect()) == sorted(r[1:] for r in damage(rows) if r[1] is not None)
    got = R.repair_report(R.damaged(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == report(rows)


def test_walk_is_the_plain_search():
    """All short conversations over four roles and three kinds of texts."""
    import itertools

    roles, kinds = ["system", "user", "assistant", "tool"], ["", "no", "yes."]
    for n in (1, 2, 3):
        for words in itertools.product(itertools.product(range(4), range(3)), repeat=n):
            turns = [(i, roles[r], f"{i}{kinds[k]}" if k else "") for i, (r, k) in enumerate(words)]
            codes = "".join(R._code((r + 1) % 4, (R.BLANK, R.TRUNCATED, R.FINE)[k]) for r, k in words)
            turns = [(i, r, t) for i, (_, r, t) in enumerate(turns)]
            plain = repair(turns)
            price, _, done = R.walk(codes, [1] * n, None, R.START)
            assert (price, "".join(e for e, _ in done)) == plain[5:7], turns


def test_segments_give_what_the_whole_gives():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randrange(1, 30)
        codes = "".join(R._code(rng.randrange(4), rng.choice([0, 1, 2, 3, 3, 3])) for _ in range(n))
        copies = [rng.choice([1, 1, 1, 3]) for _ in range(n)]
        cuts = sorted({0, n, *(rng.randrange(n) for _ in range(4))})
        parts = [(codes[a:b], copies[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        after = R.afters([R.transfers(*p) for p in parts])
        entry = R.entries([[R.walk(*p, a, q)[1] for q in range(4)] for p, a in zip(parts, after, strict=True)])
        got = [R.walk(*p, a, q) for p, a, q in zip(parts, after, entry, strict=True)]
        want = R.walk(codes, copies, None, R.START)
        assert sum(g[0] for g in got) == want[0] and [d for g in got for d in g[2]] == want[2]


def test_against_plain(spark):
    check(spark, conversations(random.Random(1), 300, 9))


def test_long_conversations_in_segments(spark, monkeypatch):
    monkeypatch.setattr(R, "SEGMENT", 3)
    rows = conversations(random.Random(2), 12, 120)
    check(spark, rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv, edits = R.plan_repairs(df)
    a, b = (sorted(map(tuple, R.repaired(df, edits, whole=w).collect()), key=str) for w in (True, False))
    assert a == b and len(a) == sum(len(r.audit.replace("D", "")) for r in conv.collect())


def test_one_hot_conversation(spark):
    """200,000 turns of one conversation, many of them copies: several segments, and rows dealt to several tasks."""
    df = spark.range(200_000).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 5 < 3, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 3 == 0, "Same.").otherwise(F.concat("id", F.lit("."))).alias("text"),
    )
    got = R.repair_report(df, df).collect()[0]
    rows = [(i, "user" if i % 5 < 3 else "assistant", "Same." if i % 3 == 0 else f"{i}.") for i in range(200_000)]
    seen, codes = set(), []
    for _, r, t in rows:
        codes.append(R._code(R.USER if r == "user" else R.ASSISTANT, R.DUPLICATE if (r, t) in seen else R.FINE))
        seen.add((r, t))
    price, _, done = R.walk("".join(codes), [1] * len(rows), None, R.START)
    assert (got.cost, got.duplicate, got.audit) == (price, 66_667 - 2, "".join(e for e, _ in done))


def test_empty_and_gone(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair_report(R.damaged(none), none).count() == 0
    one = spark.createDataFrame([(5, None, None, None), (6, 1, "user", " ")], "conv_id long, turn long, role string, text string")
    got = R.repair_report(one.where("conv_id = 6"), one)
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, got.collect())) == [(5, 0, 0, 0, 0, 0, 0, "", empty), (6, 0, 1, 0, 0, 0, 4, "D", empty)]


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op13_structure_repair(spark, sf_small).collect()), key=str) == report(rows)
