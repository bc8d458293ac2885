"""Fixtures and brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragloom.operators.context import (
    assemble_context,
    dedup_by_chunk,
    dedup_by_content,
    no_hit_guard,
    pack_context,
    pack_flags,
    rank_hits,
    score_threshold,
)
from ragloom.operators.ivf import ivf_assign, ivf_fit, ivf_search
from ragloom.operators.search import DimensionError, search, search_batch
from ragloom.params import PackParams


def brute(emb, k):
    ids = np.array([r["vec_id"] for r in emb])
    m = np.array([r["embedding"] for r in emb], dtype=np.float64)
    n = np.linalg.norm(m, axis=1)
    s = (m @ m.T) / (n[:, None] * n[None, :])
    out = {}
    for qi, q in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda j: (-round(s[qi, j], 9), ids[j]))[:k]
        out[int(q)] = [int(ids[j]) for j in order]
    return out


def test_dense_batch_equals_brute_force_and_blocks(spark):
    from conftest import SF001

    e = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "label", "embedding")
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    exp = brute(e.collect(), 5)
    for limit in (64 << 20, 64 * 8 * 37):  # one block, then ~14 blocks
        hits = search_batch(e, q, 5, order=["vec_id"], round_digits=9, max_broadcast_bytes=limit).collect()
        got = {}
        for r in sorted(hits, key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert got == exp


def test_single_query_matches_batch(spark):
    from conftest import SF001

    e = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding")
    v = e.where("vec_id = 3").first()["embedding"]
    one = [r["vec_id"] for r in search(e, v, 5, order=["vec_id"]).collect()]
    q = e.where("vec_id = 3").select(F.col("vec_id").alias("query_id"), "embedding")
    batch = [r["vec_id"] for r in search_batch(e, q, 5, order=["vec_id"]).orderBy("rank").collect()]
    assert one == batch and one[0] == 3


def test_vector_fixtures(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [0.6, 0.8])]
    c = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<float>")
    got = search_batch(c, q, 10, order=["vec_id"]).collect()
    assert [r["vec_id"] for r in got] == [1, 5]  # zero, null and empty vectors never score
    bad = spark.createDataFrame([(9, [1.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception) as ei:
        search_batch(c.unionByName(bad), q, 3, dim=2).collect()
    assert "width" in str(ei.value)
    with pytest.raises(DimensionError):
        search_batch(c, spark.createDataFrame([(0, [1.0, 0.0, 1.0])], "query_id long, embedding array<float>"), 3, dim=2).collect()


def hits_df(spark, rows):
    return spark.createDataFrame(rows, "query_id long, chunk_id string, doc_id string, chunk_index long, content string, score double, rank int")


def test_threshold_inclusive(spark):
    h = hits_df(spark, [(1, "a:0", "a", 0, "x", 0.4999, 1), (1, "b:0", "b", 0, "y", 0.5, 2), (1, "c:0", "c", 0, "z", 0.5001, 3)])
    assert sorted(r["chunk_id"] for r in score_threshold(h, 0.5).collect()) == ["b:0", "c:0"]


def test_dedup_two_levels(spark):
    h = hits_df(spark, [
        (1, "a:0", "a", 0, "same", 0.7, 1), (1, "a:0", "a", 0, "same", 0.9, 2),  # same key twice
        (1, "b:1", "b", 1, "same", 0.8, 3),  # other key, same content
        (1, "c:0", "c", 0, "other", 0.6, 4),
    ])
    d = dedup_by_content(dedup_by_chunk(h)).collect()
    assert sorted((r["chunk_id"], r["score"]) for r in d) == [("a:0", 0.9), ("c:0", 0.6)]


def test_ties_order(spark):
    h = hits_df(spark, [(1, "b:0", "b", 0, "x", 0.7, 1), (1, "a:2", "a", 2, "y", 0.7, 2), (1, "a:1", "a", 1, "z", 0.7, 3)])
    r = rank_hits(h).orderBy("pos").collect()
    assert [x["chunk_id"] for x in r] == ["a:1", "a:2", "b:0"]


def test_packing(spark):
    def ctx(rows, pack):
        h = rank_hits(hits_df(spark, rows))
        return assemble_context(pack_flags(h, pack)).collect()

    # sizes 10, 95, 5 with budget 100: 11 + 96 > 100 -> stop after the first (not skip to the third)
    rows = [(1, "a:0", "a", 0, "x" * 10, 0.9, 1), (1, "b:0", "b", 0, "y" * 95, 0.8, 2), (1, "c:0", "c", 0, "z" * 5, 0.7, 3)]
    r = ctx(rows, PackParams(100, 10))[0]
    assert r["context"] == "x" * 10 + "\n" and r["n_chunks"] == 1 and r["n_bytes"] == 11
    # 12 small chunks with cap 10
    rows = [(1, f"d:{i}", "d", i, f"c{i}", 1.0 - i / 100, i + 1) for i in range(12)]
    assert ctx(rows, PackParams(2000, 10))[0]["n_chunks"] == 10
    # first chunk over the budget: empty context, still answerable
    rows = [(1, "a:0", "a", 0, "é" * 60, 0.9, 1)]  # 121 bytes with the newline
    r = ctx(rows, PackParams(100, 10))[0]
    assert r["context"] == "" and r["n_chunks"] == 0 and r["n_hits"] == 1
    # packed rows are a prefix
    rows = [(1, f"d:{i}", "d", i, "w" * 30, 1.0 - i / 100, i + 1) for i in range(8)]
    kept = pack_context(rank_hits(hits_df(spark, rows)), PackParams(100, 10)).orderBy("pos").collect()
    assert [x["pos"] for x in kept] == [1, 2, 3]


def test_no_hit_guard(spark):
    q = spark.createDataFrame([(1, "q1"), (2, "q2")], "query_id long, question string")
    h = hits_df(spark, [(1, "a:0", "a", 0, "text", 0.9, 1)])
    out = {r["query_id"]: r for r in no_hit_guard(q, assemble_context(pack_flags(rank_hits(h), PackParams()))).collect()}
    assert out[1]["answerable"] and "text\n" in out[1]["prompt"] and out[1]["fixed_reply"] is None
    assert not out[2]["answerable"] and out[2]["prompt"] is None and out[2]["fixed_reply"] == "我不知道。"


def test_ivf_recall(spark):
    from conftest import SF01

    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    model = ivf_fit(e, nlist=16)
    cells = ivf_assign(e, model)
    assert cells.select("cell").distinct().count() <= 16
    q = e.where("vec_id < 50").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = search_batch(e, q, 5, order=["vec_id"], round_digits=9).select("query_id", "vec_id").collect()
    exact = {(r[0], r[1]) for r in exact}
    recalls = []
    for nprobe in (1, 4, 16):
        got = ivf_search(cells, q, model, k=5, nprobe=nprobe, order=["vec_id"], round_digits=9).select("query_id", "vec_id").collect()
        recalls.append(len(exact & {(r[0], r[1]) for r in got}) / len(exact))
    assert recalls[-1] == 1.0
    assert recalls[0] <= recalls[1] <= recalls[2]


def test_ivf_partition_pruning(spark, tmpdir_fresh):
    import os

    from conftest import SF001
    from ragloom.operators.ivf import write_ivf_table

    e = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding")
    model = ivf_fit(e, nlist=8)
    path = os.path.join(tmpdir_fresh, "ivf")
    write_ivf_table(e, model, path)
    table = spark.read.parquet(path)
    q = e.where("vec_id = 1").select(F.col("vec_id").alias("query_id"), "embedding")
    res = ivf_search(table, q, model, k=3, nprobe=2, order=["vec_id"])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    got = res.orderBy("rank").collect()
    assert got[0]["vec_id"] == 1 and len(got) == 3


def test_ivf_join_equals_probe_search(spark):
    from conftest import SF01
    from ragloom.operators.ivf import ivf_join

    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    model = ivf_fit(e, nlist=8)
    cells = ivf_assign(e, model)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    a = ivf_search(cells, q, model, k=5, nprobe=3, order=["vec_id"], round_digits=9)
    # tiny groups force salting of every cell on both sides
    b = ivf_join(cells, q, model, k=5, nprobe=3, order=["vec_id"], round_digits=9, group_chunks=17, group_queries=29)
    ra = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in a.collect())
    rb = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in b.collect())
    assert ra == rb and len(ra) == 2500


def test_two_level_rank_equals_one_level(spark):
    from conftest import SF001
    from ragloom.operators.search import rank_within_query, search_candidates

    e = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").repartition(12)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    cands = search_candidates(e, q, 5, order=["vec_id"], round_digits=9)
    one = rank_within_query(cands, 5, ["vec_id"], groups=1).select("query_id", "vec_id", "rank").collect()
    two = rank_within_query(cands, 5, ["vec_id"], groups=4)
    assert "_grp" not in two.columns
    assert sorted(map(tuple, one)) == sorted(map(tuple, two.select("query_id", "vec_id", "rank").collect()))


def test_empty_and_null_queries(spark):
    from ragloom.operators.hybrid import bm25_search
    from ragloom.plans.rag import rag_contexts

    ch = spark.createDataFrame([("a:0", "a", 0, "some text here"), ("b:0", "b", 0, "other words")],
                               "chunk_id string, doc_id string, chunk_index long, content string")
    empty = spark.createDataFrame([], "query_id long, question string")
    assert rag_contexts(empty, ch).count() == 0
    assert bm25_search(ch, empty, 3).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, "")], "query_id long, question string")
    out = {r["query_id"]: r for r in rag_contexts(nulls, ch).collect()}
    assert not out[1]["answerable"] and not out[2]["answerable"]
    assert bm25_search(ch, nulls, 3).count() == 0
    e = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert search_batch(e, spark.createDataFrame([], "query_id long, embedding array<float>"), 3, dim=2).count() == 0


def test_bm25_blocks_equal_single_block(spark):
    from conftest import SF001
    from ragloom.operators.hybrid import bm25_search
    from ragloom.plans.catalog import doc_chunks, questions

    ch, qs = doc_chunks(spark, SF001), questions(spark, SF001)
    one = bm25_search(ch, qs, 5).select("query_id", "chunk_id", "rank").collect()
    many = bm25_search(ch, qs, 5, max_broadcast_bytes=20_000).select("query_id", "chunk_id", "rank").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) > 0


def test_sparse_jvm_buckets_equal_text_mode(spark):
    from conftest import SF001
    from ragloom.params import SearchParams
    from ragloom.plans.catalog import doc_chunks, questions
    from ragloom.plans.rag import retrieve, with_chunk_buckets, with_query_buckets

    ch, qs = doc_chunks(spark, SF001), questions(spark, SF001)
    text = retrieve(qs, ch, SearchParams(k=5)).select("query_id", "chunk_id", "score", "rank").collect()
    sparse = retrieve(with_query_buckets(qs, 256), with_chunk_buckets(ch, 256), SearchParams(k=5),
                      vec="buckets", query_vec="buckets", mode="sparse").select("query_id", "chunk_id", "score", "rank").collect()
    assert sorted(map(tuple, text)) == sorted(map(tuple, sparse))  # bit-identical scores


def test_keys_only_search_equals_carried_content(spark):
    from conftest import SF001
    from ragloom.params import SearchParams
    from ragloom.plans.catalog import doc_chunks, questions
    from ragloom.plans.rag import retrieve

    ch, qs = doc_chunks(spark, SF001), questions(spark, SF001)
    cols = ["query_id", "chunk_id", "doc_id", "chunk_index", "content", "score", "rank"]
    a = retrieve(qs, ch, SearchParams(k=5)).select(cols).collect()
    b = retrieve(qs, ch, SearchParams(k=5), carry_content=False).select(cols).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 200


def test_query_ids(spark):
    """Ids of any type; a null or repeated id is an error; blocks don't change the hits."""
    from ragloom.operators.hybrid import bm25_search, history_queries

    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.6, 0.8])], "query_id string, embedding array<float>")
    want = [("a", 1), ("b", 2), ("c", 2)]
    assert sorted((r["query_id"], r["vec_id"]) for r in search_batch(c, q, 1, order=["vec_id"]).collect()) == want
    many = search_batch(c, q, 1, order=["vec_id"], max_broadcast_bytes=20)
    assert sorted((r["query_id"], r["vec_id"]) for r in many.collect()) == want
    assert "MapInArrow" not in many._jdf.queryExecution().optimizedPlan().toString()  # beyond one broadcast: the block join
    for bad in ([(None, [1.0, 0.0])], [("a", [1.0, 0.0]), ("a", [0.0, 1.0])]):
        with pytest.raises(ValueError):
            search_batch(c, spark.createDataFrame(bad, "query_id string, embedding array<float>"), 1, order=["vec_id"])
    ch = spark.createDataFrame([("d:0", "d", 0, "die ΟΔΟΣ dort"), ("e:0", "e", 0, "nothing here")], "chunk_id string, doc_id string, chunk_index long, content string")
    qs = spark.createDataFrame([("x", "ΟΔΟΣ"), ("y", "dort dort")], "query_id string, question string")
    for limit in (64 << 20, 64):
        assert sorted((r["query_id"], r["doc_id"]) for r in bm25_search(ch, qs, 2, max_broadcast_bytes=limit).collect()) == [("x", "d"), ("y", "d")]
    with pytest.raises(ValueError):
        bm25_search(ch, spark.createDataFrame([(None, "x")], "query_id string, question string"), 2)
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 5, "user", "c"), (1, 9, "user", None), (2, 3, "user", "z")],
                                  "conv_id long, turn long, role string, text string")
    assert {r["query_id"]: r["question"] for r in history_queries(turns, 3).collect()} == {1: "b\nc\n", 2: "z"}
