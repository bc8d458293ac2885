"""File tree fixture, chunk table round trip, batch = stream."""

import os

import pytest
from pyspark.sql import functions as F

from ragloom.plans.ingest import ingest, ingest_to_table, store_chunks
from ragloom.sources.chunk_table import compact_chunks, read_chunks, read_quarantined, stored_ids, to_rows, write_chunks
from ragloom.sources.files import documents_from_files, documents_from_table, import_report_files, list_files, read_documents, read_files
from ragloom.sources.reports import import_totals
from ragloom.streaming.jobs import ingest_stream, read_stream_reports, search_stream

TEXT = "First paragraph of the file. " * 30


def make_tree(root):
    files = {
        "a.txt": TEXT, "B.TXT": TEXT, "sub/c.md": "## Head\n" + TEXT, "m.markdown": TEXT, ".h.txt": TEXT,
        ".hid/z.txt": TEXT, "e.txt": "", "_u.txt": TEXT, "blank.txt": " \n\t",
    }
    for rel, body in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(body)


def test_directory_scan_and_report(spark, tmpdir_fresh):
    make_tree(tmpdir_fresh)
    files = read_documents(spark, tmpdir_fresh)
    names = sorted(r["filename"] for r in files.collect())
    assert names == ["B.TXT", "a.txt", "blank.txt", "c.md"]  # .markdown not scanned; hidden/_/empty never listed
    chunks = ingest(files.select(F.col("path").alias("doc_id"), "text", F.col("path").alias("source")))
    counts = chunks.groupBy(F.col("doc_id").alias("path")).agg(F.count(F.lit(1)).alias("chunk_count"))
    rep = {os.path.basename(r["path"]): r for r in import_report_files(list_files(spark, tmpdir_fresh), counts).collect()}
    assert set(rep) == {"a.txt", "B.TXT", "c.md", "e.txt", "_u.txt", "blank.txt"}
    assert rep["a.txt"]["success"] and rep["c.md"]["success"] and rep["a.txt"]["chunk_count"] > 0
    assert not rep["e.txt"]["success"] and rep["e.txt"]["error"] == "文件内容为空"
    assert not rep["_u.txt"]["success"] and rep["_u.txt"]["error"].startswith("skipped")
    assert not rep["blank.txt"]["success"] and rep["blank.txt"]["error"] == "文档切分后没有有效分块"
    one = read_files(spark, [os.path.join(tmpdir_fresh, "m.markdown")]).collect()
    assert len(one) == 1 and one[0]["text"] == TEXT  # explicit file: no extension test, whole file as one row


def test_documents_from_table(spark):
    df = spark.createDataFrame([("", "body", "s"), (None, "body", "s"), ("x", "b", None)], "id string, content string, source string")
    r = documents_from_table(df).collect()
    assert r[0]["doc_id"] == r[1]["doc_id"] and len(r[0]["doc_id"]) == 32 and r[2]["doc_id"] == "x" and r[2]["source"] == ""


def test_chunk_table_roundtrip(spark, tmpdir_fresh):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    path = os.path.join(tmpdir_fresh, "chunks")
    ingest_to_table(docs, path, dim=64, splitter="fixed")
    back = read_chunks(spark, path, with_vector=True)
    n = back.count()
    assert n == ingest(docs, dim=64, splitter="fixed").count()
    r = back.where("chunk_index = 1").first()
    assert r["metadata"]["doc_id"] == r["doc_id"] and r["metadata"]["chunk_index"] == "1" and len(r["embedding"]) == 64
    ingest_to_table(docs, path, dim=64, splitter="fixed")  # re-import appends (no upsert)
    assert read_chunks(spark, path).count() == 2 * n
    assert "embedding" not in read_chunks(spark, path).columns
    wrong = to_rows(ingest(docs.limit(1), dim=8, splitter="fixed"))
    with pytest.raises(Exception):
        write_chunks(wrong.withColumn("metadata", F.lit(None).cast("map<string,string>")), os.path.join(tmpdir_fresh, "bad"), 64)


def _all_columns(df):
    return sorted(str(r) for r in df.withColumn("metadata", F.array_sort(F.map_entries("metadata"))).collect())


def test_stream_equals_batch(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    make_tree(src)
    out = os.path.join(tmpdir_fresh, "table")
    q = ingest_stream(spark, src, out, dim=32, checkpoint=os.path.join(tmpdir_fresh, "ck"))
    q.awaitTermination(120)
    streamed = _all_columns(read_chunks(spark, out, with_vector=True))
    batch = os.path.join(tmpdir_fresh, "batch")
    ingest_to_table(documents_from_files(read_documents(spark, src)), batch, dim=32)
    assert streamed == _all_columns(read_chunks(spark, batch, with_vector=True)) and "filepath" in streamed[0]
    # a second run with no new file adds nothing
    q = ingest_stream(spark, src, out, dim=32, checkpoint=os.path.join(tmpdir_fresh, "ck"))
    q.awaitTermination(120)
    assert read_chunks(spark, out).count() == len(streamed)


def test_stream_reports_equal_the_batch_report(spark, tmpdir_fresh):
    """S6 per micro-batch: the same entries and totals as one batch import; a restart adds only its new files."""
    src, out, reports, ck = (os.path.join(tmpdir_fresh, k) for k in ("in", "table", "reports", "ck"))
    make_tree(src)
    embed = lambda ts: [[float(len(t))] * 8 for t in ts]
    run = lambda: ingest_stream(spark, src, out, dim=8, checkpoint=ck, embed_fn=embed, max_files_per_trigger=3, report_path=reports).awaitTermination(120)
    run()
    got = read_stream_reports(spark, reports)
    rows = lambda df: sorted(map(str, df.select("doc_id", "chunk_count", "success", "error").collect()))
    batch = ingest_to_table(documents_from_files(read_documents(spark, src)), os.path.join(tmpdir_fresh, "batch"), dim=8, embed_fn=embed).report
    assert rows(got) == rows(batch) and got.select("ingest_id").distinct().count() == 2
    assert import_totals(got).collect() == import_totals(batch).collect() and got.where("NOT success").count() > 0
    with open(os.path.join(src, "later.txt"), "w") as f:
        f.write(TEXT)
    run()
    assert got.sparkSession.read.parquet(reports).count() == batch.count() + 1


def test_imports_never_lose_rows(spark, tmpdir_fresh):
    """Two streams, a batch import and a restart with a new checkpoint share one table."""
    table = os.path.join(tmpdir_fresh, "table")
    for k in ("one", "two"):
        os.makedirs(os.path.join(tmpdir_fresh, k))
        with open(os.path.join(tmpdir_fresh, k, f"{k}.txt"), "w") as f:
            f.write(f"{k} " + TEXT)
        ingest_stream(spark, os.path.join(tmpdir_fresh, k), table, dim=8, splitter="fixed",
                      embed_fn=lambda ts: [[float(len(t))] * 8 for t in ts]).awaitTermination(120)
    n = read_chunks(spark, table).count()
    assert {r["metadata"]["filename"] for r in read_chunks(spark, table).collect()} == {"one.txt", "two.txt"}
    ingest_to_table(spark.createDataFrame([("b", TEXT, "s")], "doc_id string, text string, source string"), table, dim=8, splitter="fixed")
    assert read_chunks(spark, table).count() == n + n // 2
    ingest_stream(spark, os.path.join(tmpdir_fresh, "one"), table, dim=8, splitter="fixed",
                  checkpoint=os.path.join(tmpdir_fresh, "new")).awaitTermination(120)
    assert read_chunks(spark, table).count() == 2 * n  # the file is imported again: rows are added, none replaced


def test_odd_file_names(spark, tmpdir_fresh):
    long = "/".join(["a" * 50] * 4)
    names = ["a b.txt", "100%.txt", "x+y.txt", "é中.md", "_u.txt", ".h.txt", "e.txt", f"{long}/deep.txt", "q%20r.txt"]
    for name in names:
        p = os.path.join(tmpdir_fresh, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write("" if name == "e.txt" else TEXT)
    paths = [os.path.join(tmpdir_fresh, n) for n in names]
    files = read_files(spark, paths)
    assert sorted((r["path"], r["text"]) for r in files.collect()) == sorted((p, "" if p.endswith("e.txt") and "/e.txt" in p else TEXT) for p in paths)
    result = ingest_to_table(documents_from_files(files), os.path.join(tmpdir_fresh, "t"), dim=8)
    report = result.report.collect()
    assert len(report) == len(names) and [r["error"] for r in report if not r["success"]] == ["文件内容为空"]
    stored = read_chunks(spark, os.path.join(tmpdir_fresh, "t")).collect()
    assert {r["metadata"]["filepath"] for r in stored} == set(paths) - {os.path.join(tmpdir_fresh, "e.txt")}
    assert all(len(r["doc_id"]) == 32 for r in stored)
    with pytest.raises(Exception):
        read_files(spark, [os.path.join(tmpdir_fresh, "not there")])
    scanned = read_documents(spark, tmpdir_fresh)
    counts = scanned.select("path", F.lit(1).alias("chunk_count"))
    rep = {os.path.basename(r["path"]): r["success"] for r in import_report_files(list_files(spark, tmpdir_fresh), counts).collect()}
    assert rep == {"a b.txt": True, "100%.txt": True, "x+y.txt": True, "é中.md": True, "q%20r.txt": True, "_u.txt": False, "e.txt": False, "deep.txt": True}


def test_a_long_markdown_section_is_stored(spark, tmpdir_fresh):
    text = "## Head\n" + "word " * 5000 + "\n## Next\nshort body"
    docs = spark.createDataFrame([("a", text, "a.md"), ("b", TEXT, "b.md")], "doc_id string, text string, source string")
    r = ingest_to_table(docs, os.path.join(tmpdir_fresh, "t"), dim=8)
    assert all(x["success"] for x in r.report.collect())
    got = [x["content"] for x in read_chunks(spark, os.path.join(tmpdir_fresh, "t")).where("doc_id = 'a'").orderBy("chunk_index").collect()]
    assert len(got) > 50 and all(len(x) <= 500 for x in got) and got[-1] == "## Next\nshort body"


def test_import_result_own_splitter_and_missing_vectors(spark, tmpdir_fresh):
    docs = spark.createDataFrame([("a", "one|two||three", "s"), ("b", " ", "s"), ("c", "", "s")], "doc_id string, text string, source string")
    path = os.path.join(tmpdir_fresh, "t")
    r = ingest_to_table(docs, path, dim=8, splitter=lambda t: F.split(F.trim(t), r"\|"))
    assert {x["doc_id"]: (x["chunk_count"], x["success"], x["error"]) for x in r.report.collect()} == {
        "a": (3, True, None), "b": (0, False, "文档切分后没有有效分块"), "c": (0, False, "文件内容为空")}
    chunks = spark.createDataFrame([("x:0", "x", 0, "has one", "s", [1.0, 2.0]), ("x:1", "x", 1, "none", "s", None), ("x:2", "x", 2, "empty", "s", [])],
                                   "chunk_id string, doc_id string, chunk_index long, content string, source string, embedding array<float>")

    def fn(texts):
        assert "has one" not in texts
        return [[float(len(t)), 0.0] for t in texts]
    own = store_chunks(chunks, path, dim=2, embed_fn=fn)
    got = {x["chunk_id"]: x["embedding"] for x in read_chunks(spark, path, with_vector=True, ingest_id=own).collect()}
    assert got == {"x:0": [1.0, 2.0], "x:1": [4.0, 0.0], "x:2": [5.0, 0.0]}


def test_search_stream(spark, tmpdir_fresh):
    from conftest import SF001
    from ragloom.plans.catalog import doc_chunks, q_rag_contexts

    qdir = os.path.join(tmpdir_fresh, "q")
    spark.read.parquet(f"{SF001}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")).write.parquet(qdir)
    stream = spark.readStream.schema("query_id long, question string").parquet(qdir)
    out = os.path.join(tmpdir_fresh, "ctx")
    q = search_stream(spark, stream, doc_chunks(spark, SF001), out, checkpoint=os.path.join(tmpdir_fresh, "ck2"))
    q.awaitTermination(180)
    got = sorted((r["query_id"], r["context"]) for r in spark.read.parquet(out).collect())
    exp = sorted((r["query_id"], r["context"]) for r in q_rag_contexts(spark, SF001).collect())
    assert got == exp


def test_rag_over_stored_dense_table(spark, tmpdir_fresh):
    """S4 -> S5 -> M9 with stored E4 vectors (dense mode) agrees with the in-task hashed search."""
    from conftest import SF001
    from ragloom.operators.embedding import hash_embed
    from ragloom.plans.catalog import doc_chunks, questions
    from ragloom.plans.rag import rag_contexts, retrieve
    from ragloom.params import SearchParams

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    path = os.path.join(tmpdir_fresh, "dense")
    ingest_to_table(docs, path, dim=256, splitter="fixed")
    stored = read_chunks(spark, path, with_vector=True)
    qs = hash_embed(questions(spark, SF001), "question", 256)
    dense = {(r["query_id"], r["chunk_id"]): r["score"] for r in
             retrieve(qs, stored, SearchParams(k=5), vec="embedding", query_vec="embedding", mode="dense").collect()}
    text = {(r["query_id"], r["chunk_id"]): r["score"] for r in
            retrieve(questions(spark, SF001), doc_chunks(spark, SF001), SearchParams(k=5)).collect()}
    same = set(dense) & set(text)
    assert len(same) >= 0.95 * len(text)
    assert all(abs(dense[k] - text[k]) < 1e-5 for k in same)
    ctx = rag_contexts(qs, stored, vec="embedding", mode="dense").collect()
    assert len(ctx) == 40 and sum(r["answerable"] for r in ctx) >= 25


def test_write_quarantine_and_dimension_split(spark, tmpdir_fresh):
    from ragloom.operators.search import split_by_dimension

    rows = spark.createDataFrame(
        [("a:0", "a", 0, "ok", "s", [1.0, 0.0]), ("b:0", "b", 0, "x" * 20000, "s", [0.0, 1.0]),
         ("c:0" + "9" * 70, "c", 0, "long id", "s", [1.0, 1.0])],
        "chunk_id string, doc_id string, chunk_index long, content string, source string, embedding array<float>")
    good = os.path.join(tmpdir_fresh, "good")
    own = write_chunks(rows, good, 2, quarantine=True)
    assert [r["chunk_id"] for r in read_chunks(spark, good).collect()] == ["a:0"]
    assert [r["chunk_id"] for r in stored_ids(spark, good, own).collect()] == ["a:0"]
    assert sorted(r["doc_id"] for r in read_quarantined(spark, good).collect()) == ["b", "c"]
    with pytest.raises(Exception):
        write_chunks(rows, os.path.join(tmpdir_fresh, "strict"), 2)  # no quarantine: the write fails
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [])], "id long, embedding array<float>")
    ok, wrong = split_by_dimension(v, 2)
    assert sorted(r["id"] for r in ok.collect()) == [1, 3, 4] and [r["id"] for r in wrong.collect()] == [2]


def test_import_totals_and_failures(spark):
    from ragloom.sources.reports import import_failures, import_report, import_totals

    empty = spark.createDataFrame([], "doc_id long, text string")
    r = import_totals(import_report(empty)).first()
    assert (r["n_success"], r["n_failed"], r["total_chunks"]) == (0, 0, 0)
    docs = spark.createDataFrame([(1, "x" * 30), (2, "  "), (3, "short")], "doc_id long, text string")
    rep = import_report(docs)
    t = import_totals(rep).first()
    assert (t["n_success"], t["n_failed"], t["total_chunks"]) == (1, 2, 1)
    assert sorted(r["doc_id"] for r in import_failures(rep).collect()) == ["2", "3"]


def test_a_replay_is_published_last(spark, tmpdir_fresh):
    """Readers keep the old rows until the new version is committed; a failed or unfinished one is never seen."""
    path = os.path.join(tmpdir_fresh, "t")
    rows = lambda text, n: spark.createDataFrame([(f"a:{i}", "a", i, text, "s", [1.0, 0.0]) for i in range(n)], "chunk_id string, doc_id string, chunk_index long, content string, source string, embedding array<float>")
    write_chunks(rows("old", 3), path, 2, ingest_id="one")
    write_chunks(rows("other", 1), path, 2, ingest_id="two")
    before = read_chunks(spark, path)
    with pytest.raises(Exception, match="width"):
        write_chunks(rows("bad", 2).withColumn("embedding", F.array(F.lit(1.0))), path, 2, ingest_id="one")
    os.makedirs(os.path.join(path, "ingest_id=one", "version=7", "quarantined=false"))  # a write that never ended
    got = lambda df: sorted((r["doc_id"], r["content"]) for r in df.collect())
    old = [("a", "old")] * 3 + [("a", "other")]
    assert got(read_chunks(spark, path)) == old
    write_chunks(rows("new", 2), path, 2, ingest_id="one")
    assert got(read_chunks(spark, path)) == [("a", "new")] * 2 + [("a", "other")] and got(before) == old
    for turn in range(3):
        write_chunks(rows(f"turn {turn}", 1), path, 2, ingest_id="one")
    assert got(read_chunks(spark, path)) == [("a", "other"), ("a", "turn 2")]
    assert len([x for x in os.listdir(os.path.join(path, "ingest_id=one")) if x.startswith("version=")]) == 2


def test_compaction_keeps_every_row(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    rows = lambda text, n: spark.range(n).select(
        F.concat(F.lit(text), F.col("id").cast("string")).alias("chunk_id"), F.lit("d").alias("doc_id"), F.col("id").alias("chunk_index"),
        F.lit(text).alias("content"), F.lit("s").alias("source"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    ids = lambda own=None: sorted(r["chunk_id"] for r in read_chunks(spark, path, ingest_id=own).collect())
    files = lambda: sum(f.endswith(".parquet") for d, _, fs in os.walk(path) for f in fs)
    for k in range(6):
        write_chunks(rows(f"a{k}-", 2), path, 2, ingest_id=f"i{k}")
    write_chunks(rows("long" * 5000, 1), path, 2, quarantine=True, ingest_id="q")  # over the field limit
    want, apart = ids(), read_quarantined(spark, path).select("ingest_id", "chunk_id").collect()
    assert compact_chunks(spark, path, max_bytes=1) is None
    first = compact_chunks(spark, path)
    assert ids() == want and ids("i3") == ["a3-0", "a3-1"] and len(want) == 12
    assert read_quarantined(spark, path).select("ingest_id", "chunk_id").collect() == apart and len(apart) == 1
    write_chunks(rows("new", 1), path, 2, ingest_id="i3")  # a replay after the merge
    write_chunks(rows("b", 1), path, 2, ingest_id="i9")
    now = sorted([x for x in want if not x.startswith("a3")] + ["new0", "b0"])
    assert ids() == now and ids("i3") == ["new0"]
    second = compact_chunks(spark, path)  # the merged folder, the replay and the new import
    assert ids() == now and ids("i3") == ["new0"] and first != second
    write_chunks(rows("newer", 1), path, 2, ingest_id="i3")
    third = compact_chunks(spark, path)
    now = sorted([x for x in now if x != "new0"] + ["newer0"])
    assert ids() == now and ids("i3") == ["newer0"] and ids("i0") == ["a0-0", "a0-1"] and third
    assert compact_chunks(spark, path) is None and ids() == now  # one folder is left, in at most one file by kind
    assert files() == 2 and len(read_quarantined(spark, path).collect()) == 1
    with pytest.raises(ValueError):
        write_chunks(rows("x", 1), path, 2, ingest_id="merged-x")


def test_an_unpublished_compaction_does_not_count(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    one = lambda c: spark.createDataFrame([(c, "d", 0, "x", "s", [1.0, 2.0])], "chunk_id string, doc_id string, chunk_index long, content string, source string, embedding array<float>")
    write_chunks(one("a"), path, 2, ingest_id="i0")
    write_chunks(one("b"), path, 2, ingest_id="i1")
    name = compact_chunks(spark, path)
    os.remove(os.path.join(path, "_merges", name, "_SUCCESS"))  # as if it had stopped before its list was committed
    assert sorted(r["chunk_id"] for r in read_chunks(spark, path).collect()) == ["a", "b"]
    assert compact_chunks(spark, path) and sorted(r["chunk_id"] for r in read_chunks(spark, path).collect()) == ["a", "b"]
    assert not os.path.exists(os.path.join(path, f"ingest_id={name}"))
