"""Quality rules and license scan against plain Python, edge rows and empty tables."""

import re
from collections import Counter

from conftest import SF001

from ragloom.llm import license as lic
from ragloom.llm import quality as q

SCHEMA = "doc_id long, text string, n_words string, label int, start string"
LONG = " ".join(f"w{i % 997}" for i in range(20000))
EDGE = [(1, None, "x", 1, "s"), (2, "", None, None, None), (3, " \t\n ", "", 0, ""), (4, "one", "y", 2, "t"),
        (4, "one", "y", 2, "t"), (None, "no id here", None, None, None), (5, LONG, "z", 3, "u"),
        (7, "a b c a b c a b c\n\na b\na b\nx #|< \x1cy", "", 1, ""), (8, "All rights reserved. CC BY-NC 4.0 all rights", "", 1, ""),
        (9, "GNU General\nPublic License, version 3; K general public license", "", 1, "")]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(tri)
    covered = {j for i, t in enumerate(tri) if n[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    got = q.quality_report(docs).collect()
    want = sorted((i if i is not None else -1, *measures(t)) for i, t, *_ in EDGE)
    assert sorted((r[0] if r[0] is not None else -1, *r[1:6]) for r in got) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_cascade_is_the_report(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = {r["doc_id"] for r in q.filter_quality(docs).collect()}
    assert kept == {r["doc_id"] for r in q.quality_report(docs).collect() if r["kept"]}
    some = q.filter_quality(docs)
    assert some.columns == docs.columns


def test_cascade_order_does_not_change_the_verdict(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = list(q.rules(docs["text"]))
    a = docs.filter(q.first_failed(docs["text"], names).isNull()).count()
    assert a == docs.filter(q.first_failed(docs["text"], names[::-1]).isNull()).count()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert q.quality_report(empty).count() == 0 and q.filter_quality(empty).count() == 0
    assert lic.scan_licenses(empty).count() == 0


def scan(text):
    low = (text or "").translate(str.maketrans(lic.UPPER, lic.LOWER))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(label, i) for p, label in lic.BASE_PHRASES.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    at = [i for _, i in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for x, _ in places})))


def test_license_places(spark):
    docs = spark.createDataFrame(EDGE, SCHEMA)
    got = lic.scan_licenses(docs).collect()
    assert sorted((str(r[0]), *map(str, r[1:6])) for r in got) == sorted((str(i), *map(str, scan(t))) for i, t, *_ in EDGE)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[8]["labels"] == "cc-by,cc-by-nc-4.0,reserved" and by_id[9]["labels"] == "gpl,gpl-3.0"
    assert by_id[1]["score"] == 0.0 and by_id[8]["score"] == 1.0


def test_partial_template_scores_below_one(spark):
    docs = spark.createDataFrame([(1, "the Apache License applies"), (2, "Apache License, Version 2.0")], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in lic.scan_licenses(docs).collect()}
    assert got == {1: ("", 0.5), 2: ("apache-2.0", 1.0)}


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for df in (q.quality_report(docs), q.filter_quality(docs), lic.scan_licenses(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
