"""Edge fixtures and a brute-force check against a plain loop."""

import pytest
from pyspark.sql import functions as F

from ragloom.functions.text import byte_length, char_length, file_ext_lower, normalize_ws, trim_unicode
from ragloom.operators.chunking import chunk_fixed, count_chunks, fixed_windows
from ragloom.params import ChunkParams

WS = " \t\n\x0b\x0c\r\x85\xa0       　"


def go_split(text, size=500, overlap=50, min_chars=10):
    """The reference's fixed-window loop, restated in Python (Unicode white space)."""
    text = text.strip(WS)
    if not text:
        return []
    out, n, i = [], len(text), 0
    while i < n:
        end = min(i + size, n)
        c = text[i:end].strip(WS)
        if c and len(c) >= min_chars:
            out.append(c)
            if end >= n:
                break
        i += size - overlap
    return out


def windows(spark, texts, params=ChunkParams(), min_chars=None):
    p = params if min_chars is None else ChunkParams(params.size, params.overlap, min_chars)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    staged = df.withColumn("_t", trim_unicode("text"))
    rows = staged.select("doc_id", fixed_windows(F.col("_t"), p).alias("w")).orderBy("doc_id").collect()
    return [r["w"] for r in rows]


def test_trim_unicode_and_normalize(spark):
    df = spark.createDataFrame([("　\xa0 a  b\t\n",)], "t string")
    r = df.select(trim_unicode("t").alias("a"), normalize_ws("t").alias("b"), F.trim("t").alias("c")).first()
    assert r["a"] == "a  b"
    assert r["b"] == "a b"
    assert r["c"] != "a  b"  # plain trim() only strips spaces


def test_lengths_ext(spark):
    df = spark.createDataFrame([("héllo😀", "dir.x/A.MD"), ("中文", "manual")], "t string, p string")
    r = df.select(char_length("t").alias("c"), byte_length("t").alias("b"), file_ext_lower("p").alias("e")).collect()
    assert (r[0]["c"], r[0]["b"], r[0]["e"]) == (6, 10, ".md")
    assert (r[1]["c"], r[1]["b"], r[1]["e"]) == (2, 6, "")


def test_window_edges(spark):
    # lengths 499, 500, 501, 950, 951 at 500/50 -> 1, 1, 2, 2, 3 windows (min_chars 1 keeps tails)
    texts = ["x" * n for n in (499, 500, 501, 950, 951)]
    got = [len(w) for w in windows(spark, texts, min_chars=1)]
    assert got == [1, 1, 2, 2, 3]


def test_blank_and_short(spark):
    got = windows(spark, ["", " \n\t", "　", "123456789", "1234567890", None])
    assert got == [[], [], [], [], ["1234567890"], []]


def test_multibyte_by_characters(spark):
    t = "中文字符😀é" * 100  # 700 characters, 2000+ bytes
    got = windows(spark, [t])[0]
    assert got == go_split(t)
    assert all(len(c) <= 500 for c in got)


def test_bad_step():
    with pytest.raises(ValueError):
        ChunkParams(500, 500)
    with pytest.raises(ValueError):
        ChunkParams(100, 150)


def test_against_loop_on_documents(spark):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for p in (ChunkParams(), ChunkParams(64, 16)):
        got = {}
        for r in chunk_fixed(docs, p).collect():
            got.setdefault(r["doc_id"], []).append((r["chunk_index"], r["content"]))
        for r in docs.collect():
            exp = go_split(r["text"] or "", p.size, p.overlap, p.min_chars)
            have = [c for _, c in sorted(got.get(str(r["doc_id"]), []))]
            assert have == exp, r["doc_id"]
        # chunk_index dense 0..n-1 and chunk_id deterministic
        for d, lst in got.items():
            assert sorted(i for i, _ in lst) == list(range(len(lst)))


def test_count_chunks_matches(spark):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n = {r["doc_id"]: r["n_chunks"] for r in count_chunks(docs).collect()}
    for r in docs.collect():
        assert n[r["doc_id"]] == len(go_split(r["text"] or ""))


def test_chunking_plan_has_no_shuffle(spark):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = chunk_fixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan or "text" in plan


def test_staged_arrays_not_inlined_into_lambdas(spark):
    """Each staged regex scan appears once in the optimized plan (not once per element)."""
    from conftest import SF001
    from ragloom.operators.chunking import chunk_markdown

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for df, pattern in ((chunk_fixed(docs), "(?s).{1,450}"), (count_chunks(docs), "(?s).{1,450}"),
                        (chunk_markdown(docs), "(```|~~~)")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(pattern) == 1, pattern
