"""Steps whose memory must not grow with the tables: what one batch, row or task holds."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ragloom.operators import blockjoin as bj
from ragloom.operators import ivf, postings, recursive, search
from ragloom.operators.embedding import TERM_ROWS, hash_terms
from ragloom.session import ship_package


def brute(q, m, k, floor, digits, min_score, mask):
    s = np.round((q @ m.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(m, axis=1)), digits)
    out = []
    for i, row in enumerate(s):
        ok = [j for j in range(len(m)) if mask[i, j] and row[j] >= floor[i] and (min_score is None or row[j] >= min_score)]
        out += [(i, j, row[j]) for j in sorted(ok, key=lambda j: (-row[j], j))[:k]]
    return out


@pytest.mark.parametrize("k, min_score, step", [(3, None, 7), (5, 0.2, 16), (40, None, 16), (3, None, 2048)])
def test_top_rows_is_exact_in_small_steps(monkeypatch, k, min_score, step):
    """One small score matrix at a time gives the result of the whole one, copies and ties included."""
    monkeypatch.setattr(search, "STEP", step)
    rng = np.random.default_rng(3)
    m = rng.integers(0, 4, size=(90, 6)).astype(np.float64) + 0.01 * rng.normal(size=(90, 6)).round(2)
    m[20:50] = m[3]                                    # copies
    q = np.r_[m[:25], rng.normal(size=(5, 6))]
    floor = np.full(len(q), -np.inf)
    floor[4] = 0.99
    mask = rng.random((len(q), len(m))) < 0.9
    found = search.top_rows(q, search.row_norms(q), m, search.row_norms(m), k, floor, min_score, 9, lambda a, b, lo, hi: mask[a:b, lo:hi])
    got = list(zip(*(x.tolist() for x in found)))
    assert got == brute(q, m, k, floor, 9, min_score, mask)


def test_kernel_holds_few_candidates():
    """A task's rows per query are k at the end, and later batches must reach the k-th best score."""
    rng = np.random.default_rng(5)
    q = rng.normal(size=(4, 3))
    state = (pa.array(range(4)), q, search.row_norms(q))
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    kern = search.topk_kernel([bj_held(state)], search.CosineScorer("v", "dense", 3), ["v"], 2, None, ["id"], schema, 9)
    m = rng.normal(size=(60, 3))
    batches = [pa.record_batch({"id": pa.array(range(lo, lo + 20)), "v": pa.array(m[lo:lo + 20].tolist())}) for lo in (40, 0, 20)]
    got = [(r["query_id"], r["id"], r["score"]) for b in kern(iter(batches)) for r in b.to_pylist()]
    assert got == brute(q, m, 2, np.full(4, -np.inf), 9, None, np.ones((4, 60), bool))


def test_score_matrices_are_small():
    """the room of a search does not depend on how many scores count."""
    rng = np.random.default_rng(7)
    m = rng.normal(size=(4096, 8))
    norms = search.row_norms(m)
    tracemalloc.start()
    search.top_rows(m, norms, m, norms, 5, np.full(len(m), -np.inf), None, 9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


@pytest.mark.parametrize("value, kind", [(0.1, np.float64), (0.5, np.float32), (3.0, np.uint8)])
def test_query_matrix_is_narrow_and_exact(spark, value, kind):
    """a task holds the broadcast vectors in the type that they need."""
    df = spark.createDataFrame([(i, [value, float(i)]) for i in range(5)], "query_id long, v array<double>")
    ids, q, norms = search._query_matrix(df, "query_id", "v", "dense", 2)
    assert q.dtype == kind and sorted(q.tolist()) == [[value, float(i)] for i in range(5)] and norms.dtype == np.float64


def test_candidates_count_for_the_broadcast(spark, monkeypatch):
    """vectors that fit the broadcast go to the block join where a task's candidates would not."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    c = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = c.withColumnRenamed("vec_id", "query_id")
    real, calls = bj.block_join, []
    monkeypatch.setattr(bj, "block_join", lambda *a, **k: calls.append(1) or real(*a, **k))
    few, many = (sorted(map(tuple, search.search_batch(c, q, 5, order=["vec_id"], round_digits=9, max_broadcast_bytes=b).collect()))
                 for b in (1 << 20, 60 * 4 * 8 + 1))
    assert calls == [1] and few == many and len(few) == 300


def bj_held(value):
    return type("Held", (), {"value": value})()


def test_block_join_names_a_cell_of_a_group_once(spark):
    """What the block join shuffles is a cell per group of queries, not a vector per query and cell."""
    ship_package(spark)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(300)]
    df = spark.createDataFrame(rows, "_qid long, embedding array<double>").repartition(2)
    q = bj.with_vectors(df, "embedding", "dense", 16, ["_qid"]).withColumn("_bound", F.lit(float("-inf"))).withColumn("_group", F.lit(0))
    unit = rng.normal(size=(8, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cells = spark.sparkContext.broadcast(bj.Cells(np.arange(8), np.zeros(8), np.full(8, 3.0), np.full(8, 50), np.ones(8, dtype=int)))
    got = bj._visits(q, spark.sparkContext.broadcast(unit), cells, False, 1, None)
    assert got.columns == ["_group", "cell"] and 8 <= got.count() <= 2 * 8


@pytest.mark.parametrize("kind", [np.uint8, np.float32, np.float64])
def test_packed_vectors_come_back_exactly(kind):
    m = (np.arange(12).reshape(4, 3) if kind is np.uint8 else np.random.default_rng(1).normal(size=(4, 3))).astype(kind).astype(np.float64)
    col = bj._packed(m)
    assert len(col[0].as_py()) == 3 * np.dtype(kind).itemsize and (bj._unpacked(col, 3) == m).all() and (bj._unpacked(col.slice(1), 3) == m[1:]).all()
    mixed = pa.chunked_array([col, bj._packed(np.ones((2, 3))), bj._packed(np.full((1, 3), 0.1))])
    assert (bj._unpacked(mixed, 3) == np.r_[m, np.ones((2, 3)), np.full((1, 3), 0.1)]).all()


def test_no_index_row_holds_a_block():
    """a block is written as one row of keys and one row per term, a few hundred rows at a time."""
    n = 400
    texts = [" ".join(f"w{(i * 7 + j) % 900}" for j in range(20)) for i in range(n)]
    rb = pa.record_batch({"chunk_id": [f"c{i:03}" for i in range(n)], "doc_id": [f"d{i:03}" for i in range(n)], "chunk_index": pa.array([0] * n, pa.int64()), "content": texts})
    made = list(postings._block_rows(rb, 1, "words", 1))
    assert max(b.num_rows for b in made) <= postings.ROWS
    rows = [r for b in made for r in b.to_pylist()]
    assert [r["term"] is None for r in rows] == [True] + [False] * 900 and len(rows[0]["keys"]) == n
    assert sum(r["n"] for r in rows[1:]) == 20 * n == sum(len(r["pos"]) for r in rows[1:])
    assert all(texts[p].split().count(r["term"]) == t for r in rows[1:] for p, t in zip(r["pos"], r["tf"]))


def test_probes_go_out_in_small_batches():
    """a batch of queries times all cells is not one Arrow batch."""
    class Cents:
        value = np.random.default_rng(2).normal(size=(128, 4))

    rb = pa.record_batch({"query_id": pa.array(range(1000)), "v": pa.array(np.random.default_rng(3).normal(size=(1000, 4)).tolist())})
    out = list(ivf._probe_rows(Cents, 128, "query_id", "v", 4)(iter([rb])))
    assert sum(b.num_rows for b in out) == 128_000 and max(b.num_rows for b in out) <= ivf.PROBE_ROWS


def test_texts_are_cut_and_hashed_in_slices(spark, monkeypatch):
    """The pieces and tokens of a few hundred texts are held at a time, not those of an Arrow batch."""
    import pandas as pd
    assert [len(s) for s in recursive.in_slices(iter([pd.Series(["x"] * 600), pd.Series([], dtype=object)]))] == [256, 256, 88]
    n = 3 * TERM_ROWS + 5
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: run)
    run = hash_terms(df, ["doc_id"], "text", 64)
    out = list(run(iter([pa.record_batch({"doc_id": pa.array(range(n)), "text": ["a b"] * n})])))
    assert max(len(set(b.column("doc_id").to_pylist())) for b in out) <= TERM_ROWS
    assert [r["doc_id"] for b in out for r in b.to_pylist()] == [i for i in range(n) for _ in range(2)]


def test_first_round_is_a_few_cells_of_a_group(spark):
    """round 1 has no bound yet; a group asks for the cells that most of its queries want, not for those of each."""
    ship_package(spark)
    rng = np.random.default_rng(9)
    unit = np.eye(16)[:8]
    near = [0] * 50 + [1] * 30 + list(range(2, 8)) * 4
    rows = [(i, [float(x) for x in unit[c] + 0.01 * rng.normal(size=16)]) for i, c in enumerate(near)]
    df = spark.createDataFrame(rows, "_qid long, embedding array<double>").repartition(3)
    q = bj.with_vectors(df, "embedding", "dense", 16, ["_qid"]).withColumn("_group", (F.col("_qid") % 2).cast("int"))
    sent = spark.sparkContext.broadcast
    cells = sent(bj.Cells(np.arange(8), np.zeros(8), np.full(8, 0.3), np.full(8, 50), np.ones(8, dtype=int)))
    got = sorted(map(tuple, bj._most_wanted(q, sent(unit), cells, 1, None).collect()))
    assert got == [(0, 0), (1, 0)]
    two = bj._most_wanted(q, sent(unit), cells, 2, None).collect()
    assert len(two) == 4 and all(any(r == (g, 0) for r in two) for g in (0, 1))
    assert bj._most_wanted(q.where("_qid < 50"), sent(unit), cells, 2, 0.9).count() == 2
    assert bj._most_wanted(q, sent(-unit), cells, 2, 0.9).count() == 0
