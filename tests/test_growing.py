"""Growing cells, the cell stream, table functions, the distinct embedder and streamed fragments."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from ragloom.operators.cells import CellParams, create_cells, insert_vectors, read_cells, read_manifest, search_cells
from ragloom.operators.embedding import embed_distinct, requests
from ragloom.operators.messages import merge_fragment_stream, merge_fragments
from ragloom.operators.search import search_batch
from ragloom.operators.table_splitter import register_splitter
from ragloom.streaming.jobs import search_cells_stream

VEC = "vec_id long, embedding array<double>"


def some(n, seed, start=0, centres=4, spread=0.3):
    rng = np.random.default_rng(seed)
    c = np.random.default_rng(99).normal(size=(centres, 6))
    return [(start + i, [float(x) for x in c[i % centres] + spread * rng.normal(size=6)]) for i in range(n)]


def nearest(rows, m):
    out = {}
    for i, v in rows:
        if v and any(v):
            out[i] = int(m.ids[int((np.array(v) @ m.unit.T).argmax())])
        else:
            out[i] = None
    return out


def state(spark, path):
    return {r["vec_id"]: r["cell"] for r in read_cells(spark, path).collect()}


def test_cells_split_merge_and_equal_a_full_assignment(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/t"
    rows = some(120, 1) + [(500, [0.0] * 6), (501, None)]
    cents = np.array([v for _, v in rows[:4]])
    create_cells(spark.createDataFrame(rows, VEC), path, cents)
    assert state(spark, path) == nearest(rows, read_manifest(spark, path))
    with pytest.raises(ValueError):
        create_cells(spark.createDataFrame(rows, VEC), path, cents)
    more = some(200, 2, 1000, centres=1) + [(3000 + i, rows[0][1]) for i in range(40)] + [(5000, [0.0] * 6)]
    insert_vectors(spark.createDataFrame(more, VEC), path, CellParams(max_rows=90, min_rows=0))
    m = read_manifest(spark, path)
    assert len(m.ids) > 4 and m.version == 1
    assert state(spark, path) == nearest(rows + more, m)
    assert sum(m.sizes) == sum(c is not None for c in state(spark, path).values())
    insert_vectors(spark.createDataFrame(some(3, 5, 9000), VEC), path, CellParams(max_rows=10_000, min_rows=60))
    n = read_manifest(spark, path)
    assert len(n.ids) < len(m.ids)
    assert state(spark, path) == nearest(rows + more + some(3, 5, 9000), n)


def test_an_import_leaves_other_cells_alone(spark, tmpdir_fresh):
    """Far cells keep their files, and readers of the old state keep theirs until the new one is published."""
    path, axes = f"{tmpdir_fresh}/t", np.eye(6)
    rng = np.random.default_rng(3)
    near = lambda a, n, start: [(start + i, [float(x) for x in axes[a] + 0.02 * rng.normal(size=6)]) for i in range(n)]
    create_cells(spark.createDataFrame(near(0, 30, 0) + near(1, 30, 100) + near(2, 30, 200), VEC), path, axes[:3])
    before = read_manifest(spark, path)
    old = read_cells(spark, path, before)
    two = [(300 + i, [float(x) for x in axes[0] + (0.1 if i % 2 else -0.1) * axes[5] + 0.001 * rng.normal(size=6)]) for i in range(60)]
    insert_vectors(spark.createDataFrame(two, VEC), path, CellParams(max_rows=50))
    m = read_manifest(spark, path)
    assert m.held_in[1] == [0] and m.held_in[2] == [0] and 0 not in m.held_in
    assert old.count() == 90 and read_cells(spark, path).count() == 150
    assert sorted(os.listdir(f"{path}/cells/v=0")) == sorted([*(f"cell={c}" for c in range(3)), "_SUCCESS", "._SUCCESS.crc"])
    insert_vectors(spark.createDataFrame(near(1, 5, 900), VEC), path)
    assert read_manifest(spark, path).held_in[1] == [0, 2] and read_cells(spark, path).count() == 155


def test_cell_search_and_its_stream(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/t"
    rows = some(200, 1)
    c = spark.createDataFrame(rows, VEC)
    create_cells(c.where("vec_id < 100"), path, np.array([v for _, v in rows[:4]]))
    insert_vectors(c.where("vec_id >= 100"), path, CellParams(max_rows=30))
    m = read_manifest(spark, path)
    q = c.where("vec_id % 9 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    cols = ("query_id", "vec_id", "rank")
    key = lambda d: sorted(tuple(r[x] for x in cols) for r in d.collect())
    exact = key(search_batch(c, q, 4, order=["vec_id"], round_digits=9))
    assert key(search_cells(spark, path, q, 4, len(m.ids), order=["vec_id"], round_digits=9)) == exact
    few = search_cells(spark, path, q.limit(1), 4, 1, order=["vec_id"])
    assert few.count() == 4
    plan = few._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and len(set(r["cell"] for r in read_cells(spark, path, m).select("cell").distinct().collect())) > 4
    src, out = f"{tmpdir_fresh}/q", f"{tmpdir_fresh}/a"
    q.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(q.schema).option("maxFilesPerTrigger", 1).parquet(src)
    search_cells_stream(spark, stream, path, out, k=4, nprobe=len(m.ids), order=["vec_id"], round_digits=9).awaitTermination()
    assert key(spark.read.parquet(out)) == exact


def test_table_function_splitter(spark):
    register_splitter(spark, "by_bar", lambda text: text.split("|"))
    spark.createDataFrame([("d", "a||b|c"), ("e", None), ("f", ""), (None, "x")], "doc_id string, text string").createOrReplaceTempView("bars")
    got = spark.sql("SELECT c.* FROM bars b, LATERAL by_bar(b.doc_id, b.text) c")
    assert got.schema.simpleString() == "struct<chunk_id:string,doc_id:string,chunk_index:bigint,content:string>"
    assert sorted(str(tuple(r)) for r in got.collect() if r["doc_id"]) == [str(("d:0", "d", 0, "a")), str(("d:1", "d", 1, "b")), str(("d:2", "d", 2, "c"))]
    with pytest.raises(Exception, match="must be a string"):
        spark.sql("SELECT * FROM by_bar('d', 5)").collect()


def test_distinct_texts_are_embedded_once(spark):
    log = tempfile.mkdtemp(prefix="ragloom-calls-")

    def counting(texts):
        import uuid
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(texts))
        return [[float(len(t)), 1.0] for t in texts]

    rows = [(i, "hot", None) for i in range(300)] + [(1000 + i, f"text {i % 7}", None) for i in range(50)] + [(2000, "kept", [9.0]), (2001, "", []), (2002, None, None)]
    df = spark.createDataFrame(rows, "id long, content string, embedding array<float>").repartition(4)
    got = {r["id"]: r["embedding"] for r in embed_distinct(df, fn=counting, hot_rows=100, salts=5, max_texts=3).collect()}
    assert len(got) == len(rows) and got[2000] == [9.0] and got[2001] == [0.0, 1.0] == got[2002] and got[5] == [3.0, 1.0]
    seen = [t for f in os.listdir(log) for t in open(f"{log}/{f}").read().split("\n")]
    assert sorted(seen) == sorted(["hot", "", *(f"text {i}" for i in range(7))])


def test_requests_are_packed_and_retried(spark):
    assert list(requests(["aa", "b", "é" * 5, "c", "d", "e"], 4, 2)) == [[0, 1], [2], [3, 4], [5]] and list(requests([], 4, 2)) == []
    mark = tempfile.mkdtemp(prefix="ragloom-retry-")

    def flaky(texts):
        tried = len(os.listdir(mark))
        open(f"{mark}/{tried}", "w").close()
        if tried < 2:
            raise ConnectionError("try again")
        return [[1.0] for _ in texts]

    df = spark.createDataFrame([(1, "x", None)], "id long, content string, embedding array<float>").coalesce(1)
    assert embed_distinct(df, fn=flaky, wait_seconds=0.01).collect()[0]["embedding"] == [1.0]
    with pytest.raises(Exception, match="2 vectors for 1"):
        embed_distinct(df, fn=lambda t: [[1.0], [2.0]], wait_seconds=0.01).collect()


def test_fragments_merged_as_they_arrive(spark, tmpdir_fresh):
    """Shuffled, late and repeated fragments over many micro-batches, with a restart in between: the batch result."""
    rng = np.random.default_rng(7)
    rows = []
    for m in range(12):
        n = int(rng.integers(1, 9))
        rows += [(f"m{m}", i, None if (m + i) % 11 == 0 else f"{m}.{i};", i == n - 1) for i in range(n)]
    want = {r["message_id"]: r["content"] for r in merge_fragments(spark.createDataFrame(rows, "message_id string, seq long, content string, last boolean")).collect()}
    sent = [rows[i] for i in rng.permutation(len(rows))] + [rows[i] for i in rng.integers(0, len(rows), 10)] + [("open", 1, "b", False), ("open", 0, "a", False)]
    schema, src, out = "message_id string, seq long, content string, last boolean", f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/out"
    half = len(sent) // 2
    for part in (sent[:half], sent[half:]):
        spark.createDataFrame(part, schema).repartition(3).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        merge_fragment_stream(stream, None).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmpdir_fresh}/ck").trigger(
            availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == len(want) and {r["message_id"]: r["content"] for r in got} == want and all(r["complete"] for r in got)
