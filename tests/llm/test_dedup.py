"""Exact and line dedup against plain versions."""

import hashlib
import re
from collections import defaultdict

from spanroute.llm.exact_dedup import exact_dedup
from spanroute.llm.line_dedup import line_dedup


def plain_exact(rows):
    text = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (d, _), t in zip(rows, text, strict=True):
        groups[t].append(d)
    return sorted((d, min(groups[t]), len(groups[t]), d == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (d, _), t in zip(rows, text, strict=True))


def test_exact(spark):
    rows = [(i, f"x {i // 3}\t\n y" if i % 2 else f"x {i // 3} y") for i in range(90)] + [(100 + i, "hot\x0b\x0cline") for i in range(60)]
    rows += [(300, None), (301, ""), (302, " "), (303, "\n\n"), (303, "\n"), (304, "a\xa0b"), (305, "a b"), (306, "long " * 200_000)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, keep_id string, DIGEST int")
    for support in (0.001, 0.1, 0.9):
        got = sorted(map(tuple, exact_dedup(docs, support=support).collect()))
        assert got == plain_exact(rows)
    assert exact_dedup(docs.limit(0)).count() == 0
    assert exact_dedup(spark.createDataFrame([(None, "a"), (None, "b"), (1, "b")], "doc_id long, text string")).where("kept").count() == 2


def plain_lines(rows, least):
    sites, first = defaultdict(set), {}
    for d, t, s in rows:
        for i, x in enumerate((t or "").split("\n")):
            if key := x.strip(" "):
                sites[key].add(s or "")
                first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, t, s in rows:
        cut = (t or "").split("\n")
        keep = [x for i, x in enumerate(cut) if not (k := x.strip(" ")) or len(sites[k]) < least or first[k] == (d, i)]
        out.append((d, "\n".join(keep), len(cut), len(cut) - len(keep)))
    return sorted(out)


def test_lines(spark):
    rows = [(i, f"own {i}\n menu \n\nspread {i % 7}\n{'again' if i % 2 else 'menu'}\nend{i}", f"site{i % 9}") for i in range(120)]
    rows += [(900, None, "a"), (901, "", None), (902, "menu", None), (903, "\n\n", "b"), (904, "menu\n" * 20_000, "c")]
    docs = spark.createDataFrame([(d, t, s, len(t or ""), 3) for d, t, s in rows], "doc_id long, text string, source string, n_lines int, N_REMOVED int")
    for least in (2, 9, 40):
        got = line_dedup(docs, min_sites=least)
        assert got.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
        assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == plain_lines(rows, least)
    assert line_dedup(docs.limit(0)).count() == 0


def test_repeated_ids(spark):
    rows = [(1, "a\nb", f"s{i}") for i in range(9)] + [(1, "a\nc", "s0"), (None, "a\nd", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_dedup(docs, min_sites=3).collect()
    assert len(got) == 11
    assert [r.text for r in got if r.doc_id is None] == ["a\nd"]  # a null id comes first
    assert {r.text for r in got if r.doc_id == 1} <= {"b", "", "c"}
