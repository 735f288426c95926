"""Paragraphs of notices, their merge and their refusals."""

from spanroute.operators import notices as N

OPENINGS = {"geometry": "Geometry", "provider": "Keys", "licence": "Licence"}
DETAILS = {"      feed: ": "feed", "      notice: ": "notice"}
GOOD = "Geometry of places\n\n  - one\n  - two\n\n\n\nKeys of\n  - p: P\n      notice: n\n      feed: f\n  - q: Q\n\nLicence: x\nas is\n"


def table(spark, **texts):
    return spark.createDataFrame([(k, v if isinstance(v, bytes) else v.encode()) for k, v in texts.items()], "build string, content binary")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sections_and_items(spark):
    blocks = N.paragraphs(table(spark, a=GOOD, b=GOOD.replace("  - one\n", "").replace("f\n", "g\n")), OPENINGS)
    assert {r["section"] for r in blocks.collect()} == set(OPENINGS)
    assert rows(N.merged_items(blocks)) == [("geometry", "  - one", 1), ("geometry", "  - two", 2), ("provider", "  - p: P", 2), ("provider", "  - q: Q", 2)]
    entries = N.entries(blocks, "provider", "^  - ([^:]+): (.+)$", DETAILS)
    assert rows(N.merged_entries(entries)) == [("p", "P", "feed", "f", 1), ("p", "P", "feed", "g", 1), ("p", "P", "notice", "n", 2)]
    assert rows(N.entry_conflicts(entries, ["notice"])) == [] and rows(N.differing(blocks, ["licence", "geometry"])) == []


def test_refusals(spark):
    texts = table(spark, good=GOOD, bytes=b"\xff", unknown=GOOD + "\nWhat?\n", twice=GOOD + "\nLicence: y\n", none="", indented="  - x\n\n" + GOOD)
    reasons = rows(N.refused(texts, N.paragraphs(texts, OPENINGS), ["geometry", "licence"]))
    assert reasons == sorted(
        [("bytes", "not UTF-8"), ("bytes", "no paragraph: geometry"), ("bytes", "no paragraph: licence"), ("unknown", "unknown paragraph: What?"), ("twice", "repeated paragraph: licence"),
         ("none", "no paragraph: geometry"), ("none", "no paragraph: licence"), ("indented", "unknown paragraph:   - x")], key=repr)


def test_conflicts(spark):
    other = GOOD.replace("x\nas is", "x\nas it was").replace("notice: n", "notice: m").replace("q: Q", "q: R").replace("Keys of\n", "Keys of\n      feed: lost\n")
    blocks = N.paragraphs(table(spark, a=GOOD, b=other, c=GOOD.replace("      feed", "     feed")), OPENINGS)
    assert rows(N.differing(blocks, ["licence", "geometry"])) == [("licence",)]
    entries = N.entries(blocks, "provider", "^  - ([^:]+): (.+)$", DETAILS)
    assert rows(N.entry_conflicts(entries, ["notice"])) == sorted([(None, "unknown line"), ("p", "unknown line"), ("p", "notice"), ("q", "name")], key=repr)


def test_partitions(spark):
    d = "0" * 64
    labels = spark.createDataFrame([("a", [d, d]), ("b", [d, None]), ("c", None), ("e", [])], "label string, digests array<string>")
    assigned = spark.createDataFrame([("m", "1", "a"), ("m", "1", "b"), ("t", "1", "b"), ("t", "2", "x"), ("t", "3", None)], "catalogue string, id string, label string")
    assert rows(N.partition_conflicts(labels, assigned)) == sorted(
        [("b", None, "no digests"), ("c", None, "no digests"), ("e", None, "no digests"), ("a", "m 1", "several labels"), ("x", "t 2", "label not listed"), (None, "t 3", "label not listed")], key=repr)
