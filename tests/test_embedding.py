"""Pluggable embedder, embed-missing, hashed tokens in the JVM and in Arrow."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ragloom.functions.vectors import vector_narrow, vector_widen
from ragloom.operators.chunking import drop_empty_documents
from ragloom.operators.embedding import (
    arrow_buckets,
    embed,
    embed_missing,
    hash_embed,
    hash_terms,
    hash_terms_grouped,
    needs_embedding,
    token_buckets,
)


def test_pluggable_embedder_batches(spark):
    calls = []

    def fn(texts):
        calls.append(len(texts))
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(i, "x" * i) for i in range(50)], "id long, content string")
    out = {r["id"]: r["embedding"] for r in embed(df, "content", fn).collect()}
    assert out[7] == [7.0, 1.0]


def test_embed_missing_only_touches_missing(spark):
    df = spark.createDataFrame([(1, "a", [9.0, 9.0]), (2, "bb", None), (3, "ccc", [])],
                               "id long, content string, embedding array<float>")
    out = {r["id"]: r["embedding"] for r in embed_missing(df, fn=lambda ts: [[float(len(t)), 0.0] for t in ts]).collect()}
    assert out == {1: [9.0, 9.0], 2: [2.0, 0.0], 3: [3.0, 0.0]}
    assert [r[0] for r in df.select(needs_embedding("embedding")).orderBy("id").collect()] == [False, True, True]


def test_jvm_and_arrow_tokens_agree(spark):
    from conftest import SF001

    d = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    jvm = {(r["doc_id"], r["bucket"], r["n"]) for r in hash_terms_grouped(d, ["doc_id"], "text", 256).collect()}
    arrow = {(r["doc_id"], r["bucket"], r["n"]) for r in hash_terms(d, ["doc_id"], "text", 256).collect()}
    assert jvm == arrow and len(jvm) > 1000
    b = spark.createDataFrame([("Hello, WORLD! héllo 42",)], "t string").select(token_buckets("t", 256)).first()[0]
    p, ab = arrow_buckets(pa.array(["Hello, WORLD! héllo 42"]), 256)
    assert sorted(b) == sorted(ab.tolist()) and len(b) == 4


def test_hash_embed_unit_length(spark):
    df = spark.createDataFrame([("a b c a",), ("",), ("!!!",)], "content string")
    vs = [r["embedding"] for r in hash_embed(df, "content", 64).collect()]
    assert abs(np.linalg.norm(vs[0]) - 1) < 1e-6 and len(vs[0]) == 64
    assert not any(vs[1]) and not any(vs[2])


def test_vector_casts_and_empty_docs(spark):
    df = spark.createDataFrame([([1.5, 2.0],), (None,)], "v array<double>")
    r = df.select(vector_narrow("v").alias("f")).select(vector_widen("f").alias("d")).collect()
    assert r[0]["d"] == [1.5, 2.0] and r[1]["d"] is None
    docs = spark.createDataFrame([(1, "text"), (2, " 　\n"), (3, None)], "doc_id long, text string")
    ok, bad = drop_empty_documents(docs)
    assert [r[0] for r in ok.collect()] == [1] and sorted(r[0] for r in bad.collect()) == [2, 3]
