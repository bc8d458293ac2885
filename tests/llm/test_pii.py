"""Base spans against plain Python; the trees' SQL against the model; redaction."""

import hashlib
import re

from conftest import SF001

from ragloom.llm import pii

SCHEMA = "doc_id long, text string, spans string, kind int"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow(text):
    text, out = text or "", []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(int(x) <= 255 for x in m[0].split("."))
            elif kind == "card":
                ok = 14 <= len(d) <= 19 and sum((x - 9 if x > 9 else x) for i, c in enumerate(reversed(d)) for x in [int(c) * (1 + i % 2)]) % 10 == 0
            else:
                ok = kind == "email" or 10 <= len(d) <= 15
            if ok:
                out.append((m.start(), k, kind, m.end()))
    out.sort()
    n = [sum(x[1] == k for x in out) for k in range(4)]
    return n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in out).encode()).hexdigest()


EDGE = [None, "", " \n", "a@b.c_x@d.e", "a@b.c@d.e f@g", "é.x@y.zé 😀 q%w@e-r.t-u.", "x@y..z a@b.c.d.", "1.2.3.4.5.6.7.8", "1.2.3 1.2.3.256 01.002.3.4",
        "999.1.1.1.1", "4539 1488 0343 6467", "4539-1488-0343-6467x", "45391488034364671", "0000 0000 0000 00", "1 2", "1  2 3", "+1 (017) 555-7713 x",
        "+1 ((((", "+1 2 +1 234 567 8901 +", "++12345678901", "+1234567890123456 1", "7" * 5000, "a" * 20000, ("1 " * 3000) + "x", "ip 1.2.3.4, card 4539148803436467.",
        "x@y.z " * 300, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "1.1.1.1" + "0" * 40]


def test_base_spans(spark):
    rows = [(i, t, "", 1) for i, t in enumerate(EDGE)] + [(None, "a@b.cd", None, None), (3, "a@b.cd", None, None), (3, "a@b.cd", None, None)]
    got = pii.pii_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str((r[0], list(r[1:5]), r[5])) for r in got) == sorted(str((i, *slow(t))) for i, t, *_ in rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = {r["doc_id"]: slow(r["text"]) for r in docs.collect()}
    for r in pii.pii_report(docs).collect():
        assert (list(r[1:5]), r["base_sha256"]) == want[r["doc_id"]]
        kinds = [x.split(":")[0] for x in r["spans"].split(",") if x]
        assert [kinds.count(k) for k in pii.BASE_KINDS] == list(r[1:5])


def test_model_and_sql_agree(spark):
    """Planted: secrets with and without a key; the trees add the first kind only."""
    rows = []
    for i in range(240):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        rows.append((i, f'word token = "{h}" and build-{i}-of-the-long-named-thing{i} then {i}@mail.example.com', "", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    model = pii.fit(docs)
    assert model is not None and 5 in model.thresholds
    got = pii.pii_report(docs).collect()
    assert all(r["spans"].count("secret:") == 1 and r["n_email"] == 1 for r in got)
    out = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert out[5].startswith('word token = "[SECRET]" and build-5') and out[5].endswith("then [EMAIL]")


def test_rare_secrets_among_many_addresses(spark):
    """Secrets are under one percent of the positive candidates, and one text is repeated very often."""
    rows = [(i, " ".join(f"{10 + i}.{j % 250}.{j // 250}.{100 + i} and" for j in range(200)), "", 0) for i in range(60)]
    for i in range(60):
        h = hashlib.sha1(str(i).encode()).hexdigest()
        rows.append((100 + i, f'word token = "{h}" and build-{i}-of-the-long-named-thing{i} then', "", 0))
    rows += [(200 + i, "mail a.b@example.com or 7.7.7.7", "", 0) for i in range(4000)]
    got = pii.pii_report(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()
    assert all(r["spans"].count("secret:") == 1 for r in got if 100 <= r["doc_id"] < 160)


def test_every_candidate_calibrates(spark):
    rows = [(i, f'secret = "{hashlib.sha1(b"x").hexdigest()}" then the-long-named-thing-{i % 7}-of-{i % 5}', "", 0) for i in range(500)]
    every = pii.labelled(spark.createDataFrame(rows, SCHEMA))
    assert every.filter("kind = 5").count() == 1000
    sample = pii.fitting_sample(every, pii.PiiParams())
    assert sample.filter("kind = 5 AND label = 1").count() == 1  # one candidate, however often it is there
    # 500 occurrences of one candidate: enough positive cases for a threshold
    assert 5 in pii.fit(spark.createDataFrame(rows, SCHEMA)).thresholds


def test_redact_keeps_the_rest(spark):
    rows = [(1, "a x@y.zz b 1.2.3.4\nc", "s", 1), (2, None, None, None), (3, "é +1 (017) 555-7713 é", "", 0), (4, "plain  text", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: (r["text"], r["spans"]) for r in out.collect()} == {
        1: ("a [EMAIL] b [IP]\nc", "s"), 2: (None, None), 3: ("é [PHONE] é", ""), 4: ("plain  text", "")}


def test_empty_and_native(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.pii_report(empty).count() == 0 and pii.redact(empty).count() == 0
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for df in (pii.pii_report(docs), pii.redact(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_long_secrets_are_proposed_whole(spark):
    """A letter-digit run of any length is one candidate, and a long run without digits costs linear time."""
    from pyspark.sql import functions as F

    runs = ["a1" * n for n in (9, 10, 32, 33, 100, 5000)] + ["x-" * 200_000, "-" * 100_000 + "7"]
    df = spark.createDataFrame([(i, f'token = "{r}" end') for i, r in enumerate(runs)], "i long, t string")
    got = {r["i"]: r["m"] for r in df.select("i", F.regexp_extract_all("t", F.lit(pii.SECRET), F.lit(0)).alias("m")).collect()}
    assert [got[i] for i in range(len(runs))] == [[]] + [[r] for r in runs[1:6]] + [[], [runs[7]]]
