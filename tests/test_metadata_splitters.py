"""P4-P8, T3-T6 edge fixtures."""

from pyspark.sql import functions as F

from ragloom.functions.metadata import (
    base_metadata,
    hit_id_fallback,
    meta_long,
    meta_string,
    metadata_from_json,
    metadata_to_json,
    overlay_columns,
)
from ragloom.operators.chunking import chunk_markdown, chunk_recursive, chunk_routed, is_markdown_source, is_markdown_type
from ragloom.operators.recursive import split_recursive
from ragloom.params import ChunkParams


def test_metadata_json(spark):
    df = spark.createDataFrame([("",), ("{bad",), ("null",), ("{}",), ('{"b":"x","a":1}',), (None,)], "j string")
    rows = df.select(metadata_from_json("j").alias("m")).collect()
    assert [r["m"] for r in rows[:4]] == [{}, {}, {}, {}]
    assert rows[4]["m"] == {"a": "1", "b": "x"}
    assert rows[5]["m"] == {}
    out = df.select(metadata_to_json(metadata_from_json("j")).alias("t")).collect()
    assert out[4]["t"] == '{"a":"1","b":"x"}'
    assert out[0]["t"] == "{}"
    assert spark.range(1).select(metadata_to_json(F.lit(None).cast("map<string,string>")).alias("t")).first()["t"] == "{}"


def test_meta_long_and_string(spark):
    df = spark.createDataFrame([({"chunk_index": "3"},), ({"chunk_index": "3.9"},), ({"chunk_index": "x"},), ({},)],
                               "m map<string,string>")
    got = [r[0] for r in df.select(meta_long("m", "chunk_index")).collect()]
    assert got == [3, 3, 0, 0]
    assert [r[0] for r in df.select(meta_string("m", "doc_id")).collect()] == ["", "", "", ""]


def test_overlay_and_base(spark):
    df = spark.createDataFrame([({"doc_id": "old", "source": "s0", "k": "v"}, "new", 0, "")],
                               "m map<string,string>, d string, c long, s string")
    m = df.select(overlay_columns("m", "d", "c", "s").alias("m")).first()["m"]
    assert m == {"doc_id": "new", "source": "s0", "k": "v"}  # chunk_index 0 and empty source do not overlay
    b = spark.createDataFrame([("7", "src", "héllo ")], "d string, s string, t string").select(
        base_metadata("d", "s", "t").alias("m")).first()["m"]
    assert b == {"doc_id": "7", "source": "src", "original_length": "7"}  # bytes of the untrimmed text
    h = spark.createDataFrame([(None, 3), ("", 1), ("id9", 2)], "i string, r int").select(hit_id_fallback("i", "r")).collect()
    assert [r[0] for r in h] == ["hit_2", "hit_0", "id9"]


MD = "\n".join([
    "intro text",
    "# Title",
    "body",
    "## A",
    "a text",
    "```",
    "## not a heading",
    "```",
    "### B",
    "b text",
    "#### C deeper",
    "c text",
])


def test_markdown_sections(spark):
    df = spark.createDataFrame([(1, MD), (2, "no heading at all\nline 2"), (3, "## only\n"), (4, "")], "doc_id long, text string")
    got = {}
    for r in chunk_markdown(df).collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_index"], r["content"]))
    one = [c for _, c in sorted(got["1"])]
    assert one == [
        "intro text\n# Title\nbody",
        "## A\na text\n```\n## not a heading\n```",
        "### B\nb text\n#### C deeper\nc text",
    ]
    assert [c for _, c in got["2"]] == ["no heading at all\nline 2"]
    assert [c for _, c in got["3"]] == ["## only"]
    assert "4" not in got


def test_routing(spark):
    src = ["a.md", "A.MD", "b.markdown", "c.txt", "manual", None]
    df = spark.createDataFrame([(s,) for s in src], "s string")
    assert [r[0] for r in df.select(is_markdown_source("s")).collect()] == [True, True, True, False, False, False]
    t = spark.createDataFrame([(".md",), ("markdown",), (".MD",), (".txt",)], "t string")
    assert [r[0] for r in t.select(is_markdown_type("t")).collect()] == [True, True, True, False]
    docs = spark.createDataFrame(
        [(i, "## H1\nx\n## H2\ny. z. " + "w " * 400, s) for i, s in enumerate(src)], "doc_id long, text string, source string")
    out = chunk_routed(docs, ChunkParams(500, 50)).collect()
    by = {}
    for r in out:
        by.setdefault(r["source"], []).append(r["content"])
    assert by["a.md"][0] == "## H1\nx"  # header split
    assert all(len(c) <= 500 for c in by["c.txt"])  # recursive split


def test_recursive_invariants(spark):
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = chunk_recursive(docs, ChunkParams(200, 20)).collect()
    texts = {str(r["doc_id"]): r["text"] for r in docs.collect()}
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["chunk_index"], r["content"]))
    for d, lst in by.items():
        lst.sort()
        assert [i for i, _ in lst] == list(range(len(lst)))
        pos = 0
        for _, c in lst:
            assert len(c) <= 200
            at = texts[d].find(c, max(0, pos - 200))
            assert at >= 0  # every chunk is a piece of the text, in order
            pos = at + len(c)
    assert split_recursive("a b c", 3, 1) and split_recursive("", 10, 2) == []


def test_recursive_loses_no_text():
    t = "Para one. Second sentence!\n\nPara two line\nnext line? " + "word " * 200
    chunks = split_recursive(t, 100, 0)
    assert "".join(chunks) == t


def test_odd_metadata_never_fails(spark):
    from ragloom.functions.metadata import meta_long, metadata_from_json, overlay_columns

    rows = [('{"a":"1","a":"2","b":"x","a":"3"}',), ('{"n":"NaN"}',), ('{"n":"1e30"}',), ('{"n":"-3.9"}',), ('{"n":"-1e30"}',), (None,), ("{",)]
    df = spark.createDataFrame(rows, "j string").select(metadata_from_json("j").alias("m"))
    got = df.select("m", meta_long("m", "n").alias("n"), overlay_columns(F.col("m"), F.lit("d"), F.lit(1), F.lit("s")).alias("o")).collect()
    assert got[0]["m"] == {"a": "3", "b": "x"} and got[0]["o"]["a"] == "3"
    assert [r["n"] for r in got] == [0, 0, 0, -3, 0, 0, 0]


def test_only_the_opening_marker_closes_a_fence(spark):
    text = "\n".join(["## a", "```", "~~~", "## in code", "```", "## b", "~~~", "```", "### in tildes", "~~~ ", "### c", "```", "## never closed"])
    rows = chunk_markdown(spark.createDataFrame([("d", text)], "doc_id string, text string")).orderBy("chunk_index").collect()
    assert [r["content"].split("\n")[0] for r in rows] == ["## a", "## b", "### c"]
