"""The block join and the stored inverted index against brute force and the broadcast searches."""

import math
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from ragloom.operators.blockjoin import BlockParams, block_join
from ragloom.operators.chunking import chunk_fixed
from ragloom.operators.embedding import md5_bucket
from ragloom.operators.hybrid import bm25_search
from ragloom.operators.postings import PostingParams, Weighting, score_block, search_postings, write_postings
from ragloom.operators.search import search_batch

SMALL = BlockParams(pivots=5, slices=3, block_rows=7, group_queries=4, first_cells=1)


def key(rows, *cols):
    return sorted(str(tuple(r[c] for c in cols)) for r in rows)


def hot_vectors(seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.2 * rng.normal(size=8)], "p") for i in range(150)]
    rows += [(200 + i, rows[0][1], "copy") for i in range(60)]                   # a hot block of copies
    rows += [(300, None, "n"), (301, [], "e"), (302, [0.0] * 8, "z"), (303, [-x for x in rows[0][1]], "far")]
    return rows


def brute(rows, k, min_score=None):
    use = [(i, np.array(v)) for i, v, _ in rows if v and any(v)]
    out = []
    for i, v in use:
        s = sorted(((-round(float(v @ w / math.sqrt(v @ v) / math.sqrt(w @ w)), 9), j) for j, w in use))
        s = [x for x in s if min_score is None or -x[0] >= min_score][:k]
        out += [str((i, j, r + 1)) for r, (_, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("k, min_score", [(3, None), (70, 0.9), (500, None)])
def test_block_join_is_exact(spark, k, min_score):
    rows = hot_vectors()
    c = spark.createDataFrame(rows, "vec_id long, embedding array<double>, note string")
    q = c.select(F.col("vec_id").alias("query_id"), "embedding")
    got = block_join(c, q, k, dim=8, min_score=min_score, order=["vec_id"], round_digits=9, params=SMALL).collect()
    assert key(got, "query_id", "vec_id", "rank") == brute(rows, k, min_score)
    assert got[0].asDict().keys() == {"query_id", "vec_id", "note", "score", "rank"}


def test_block_join_empty_sides(spark):
    c = spark.createDataFrame(hot_vectors()[:5], "vec_id long, embedding array<double>, note string")
    q = c.select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    none = block_join(c, q.limit(0), 2, dim=8, order=["vec_id"])
    assert none.count() == 0 and none.schema["query_id"].dataType.simpleString() == "string"
    assert block_join(c.limit(0), q, 2, dim=8, order=["vec_id"]).count() == 0


def test_large_query_tables_take_the_block_join(spark):
    """Beyond one broadcast the result is the same, for each vector form, and nothing of the queries is collected."""
    ch = chunk_fixed(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")).cache()
    qs = spark.read.parquet(f"{SF001}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.col("text").alias("content"))
    kw = dict(vec="content", mode="text", dim=64, order=["doc_id", "chunk_index"])
    one, many = (search_batch(ch, qs, 4, max_broadcast_bytes=b, **kw).collect() for b in (1 << 20, 1 << 10))
    cols = ("query_id", "chunk_id", "content", "score", "rank")
    assert len(one) > 50 and key(one, *cols) == key(many, *cols)


def test_rounds_skip_cells(spark):
    """Far cells are not visited once the bound is known."""
    from ragloom.operators import blockjoin as bj
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16))
    rows = [(i, [float(x) for x in centres[i % 8] + 0.02 * rng.normal(size=16)]) for i in range(400)]
    c = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    sc = spark.sparkContext
    cells = sc.broadcast(bj.Cells(np.arange(8), np.zeros(8), np.full(8, 0.2), np.full(8, 50), np.ones(8, dtype=int)))
    q = bj.with_vectors(c.withColumnRenamed("vec_id", "_qid"), "embedding", "dense", 16, ["_qid"]).withColumn("_bound", F.lit(0.97))
    from ragloom.session import ship_package
    ship_package(spark)
    assert bj._visits(q, sc.broadcast(unit), cells, True, 1, None).count() == 400
    assert bj._visits(q, sc.broadcast(unit), cells, False, 1, None).count() == 0


# ------------------------------------------------------------------------------- inverted index


def chunk_rows():
    words = ["red", "green", "blue", "Straße", "数据", "a1", "the", "the", "the", "of", "of", "rare"]
    rng = np.random.default_rng(9)
    rows = [(f"d{i}:0", f"d{i}", 0, " ".join(rng.choice(words[:11], size=int(rng.integers(0, 30)))), "x") for i in range(160)]
    rows += [(f"copy{i}:0", f"copy{i}", 0, "red red blue", "x") for i in range(40)]
    rows += [("e:0", "e", 0, "", "x"), ("n:0", "n", 0, None, "x"), ("r:0", "r", 0, "rare the the", "x"), ("long:0", "long", 0, "the " * 20000 + "rare", "x")]
    return rows


QUESTIONS = [("q1", "the red thing"), ("q2", "rare"), ("q3", "THE of of the STRASSE straße"), ("q4", ""), ("q5", None), ("q6", "nothing known here"), ("q7", "数据 blue, blue; green")]
CHUNKS = "chunk_id string, doc_id string, chunk_index long, content string, index_id string"


@pytest.mark.parametrize("parts", [1, 3])
def test_bm25_from_the_index(spark, tmpdir_fresh, parts):
    rows = chunk_rows()
    ch = spark.createDataFrame(rows, CHUNKS).drop("index_id")
    qs = spark.createDataFrame(QUESTIONS, "query_id string, question string")
    p = PostingParams(block_chunks=16, salts=3, group_queries=2, first_blocks=1, pushed_terms=2)
    for i in range(parts):  # imports side by side: one set of statistics
        write_postings(ch.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == i), tmpdir_fresh, "words", params=p, index_id=f"index-{i}")
    cols = ("query_id", "chunk_id", "score", "rank")
    want = bm25_search(ch.withColumn("content", F.coalesce("content", F.lit(""))), qs, 7).collect()
    assert len(want) > 20 and key(search_postings(spark, tmpdir_fresh, qs, 7, params=p).collect(), *cols) == key(want, *cols)
    assert key(search_postings(spark, tmpdir_fresh, qs, 7).collect(), *cols) == key(want, *cols)


@pytest.mark.parametrize("min_score", [None, 0.6])
def test_cosine_from_the_index(spark, tmpdir_fresh, min_score):
    ch = spark.createDataFrame(chunk_rows(), CHUNKS).drop("index_id")
    qs = spark.createDataFrame(QUESTIONS, "query_id string, question string")
    p = PostingParams(block_chunks=16, salts=2, group_queries=2, first_blocks=1)
    write_postings(ch, tmpdir_fresh, "buckets", 32, params=p)
    got = search_postings(spark, tmpdir_fresh, qs, 6, min_score=min_score, params=p).collect()
    want = search_batch(ch, qs.withColumnRenamed("question", "content"), 6, vec="content", mode="text", dim=32, min_score=min_score, order=["doc_id", "chunk_index"]).where("score > 0").collect()
    cols = ("query_id", "chunk_id", "score", "rank")
    assert len(want) >= 10 and key(got, *cols) == key(want, *cols)


def test_empty_index_and_questions(spark, tmpdir_fresh):
    ch = spark.createDataFrame(chunk_rows()[:5], CHUNKS).drop("index_id")
    write_postings(ch.limit(0), tmpdir_fresh, "words")
    qs = spark.createDataFrame(QUESTIONS, "query_id string, question string")
    assert search_postings(spark, tmpdir_fresh, qs, 3).count() == 0
    assert search_postings(spark, tmpdir_fresh, qs.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        write_postings(ch, tmpdir_fresh, "letters")


def test_max_score_looks_up_only_chunks_in_the_running():
    """A long list whose impact cannot lift a new chunk to the bound adds to known chunks only."""
    n = 1000
    rare = (np.array([3, 500], np.int32), np.array([2, 1], np.int32), np.array([10, 10], np.int32), 2.2)
    common = (np.arange(n, dtype=np.int32), np.ones(n, np.int32), np.full(n, 10, np.int32), 1.0)
    full = score_block({"rare": rare, "the": common}, n, [("rare", 5.0), ("the", 0.1)], 1.0, float("-inf"), 3, Weighting("words", 10.0))
    cut = score_block({"rare": rare, "the": common}, n, [("rare", 5.0), ("the", 0.1)], 1.0, 1.0, 3, Weighting("words", 10.0))
    assert full[0].tolist() == [3, 500, 0] and cut[0].tolist() == [3, 500] and cut[1].tolist() == full[1][:2].tolist()


def test_index_reads_are_joins_on_the_term(spark, tmpdir_fresh):
    ch = spark.createDataFrame(chunk_rows(), CHUNKS).drop("index_id")
    write_postings(ch, tmpdir_fresh, "buckets", 32)
    qs = spark.createDataFrame(QUESTIONS, "query_id string, question string")
    plan = search_postings(spark, tmpdir_fresh, qs, 3)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    c = Counter(md5_bucket(t, 32) for t in ["red"])
    assert spark.read.parquet(f"{tmpdir_fresh}/postings").where(F.col("term") == str(next(iter(c)))).agg(F.sum("n")).first()[0] > 0
