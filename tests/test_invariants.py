"""SURVEY section 5 invariants, with generated inputs (Hypothesis). Each example is a whole
batch of texts / hit lists, checked with one Spark job against a plain-Python restatement."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ragloom.operators.chunking import chunk_fixed
from ragloom.operators.context import assemble_context, dedup_by_chunk, dedup_by_content, pack_flags, rank_hits
from ragloom.params import ChunkParams, PackParams
from test_text_chunking import go_split

ALPHABET = st.sampled_from(list("ab cdé中😀\n\t.") + ["　", "\xa0", " "])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=400), min_size=1, max_size=40)
SLOW = settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@SLOW
@given(texts=TEXTS, size=st.integers(5, 60), overlap_frac=st.floats(0, 0.9))
def test_fixed_windows_match_loop(spark, texts, size, overlap_frac):
    overlap = min(size - 1, int(size * overlap_frac))
    p = ChunkParams(size, overlap, 3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in chunk_fixed(df, p).collect():
        got.setdefault(int(r["doc_id"]), []).append((r["chunk_index"], r["content"]))
    for i, t in enumerate(texts):
        have = [c for _, c in sorted(got.get(i, []))]
        assert have == go_split(t, size, overlap, 3)
        assert all(len(c) <= size for c in have)


def pack_loop(contents, max_bytes, max_chunks):
    out, used = [], 0
    for c in contents:
        b = len(c.encode()) + 1
        if len(out) >= max_chunks or used + b > max_bytes:
            break
        out.append(c)
        used += b
    return out


HITS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.text(alphabet="xyé中", min_size=1, max_size=30),
                          st.integers(0, 20)), min_size=1, max_size=60)


@SLOW
@given(hits=HITS, max_bytes=st.integers(1, 200), max_chunks=st.integers(1, 6))
def test_pack_is_stop_not_skip_prefix(spark, hits, max_bytes, max_chunks):
    rows = [(q, f"d{d}:{i}", f"d{d}", i, c, s / 20.0, i + 1) for i, (q, d, c, s) in enumerate(hits)]
    df = spark.createDataFrame(rows, "query_id long, chunk_id string, doc_id string, chunk_index long, content string, "
                                     "score double, rank int")
    ctx = {r["query_id"]: r for r in assemble_context(pack_flags(rank_hits(df), PackParams(max_bytes, max_chunks))).collect()}
    for q in {h[0] for h in hits}:
        mine = sorted([r for r in rows if r[0] == q], key=lambda r: (-r[5], r[2], r[3]))
        exp = pack_loop([r[4] for r in mine], max_bytes, max_chunks)
        assert ctx[q]["context"] == "".join(c + "\n" for c in exp)
        assert ctx[q]["n_bytes"] <= max_bytes and ctx[q]["n_chunks"] <= max_chunks


def test_dedup_idempotent_and_budgets(spark):
    from conftest import SF01
    from ragloom.plans.catalog import q_rag_contexts, sparse_hits, questions

    hits = sparse_hits(spark, SF01, questions(spark, SF01), min_score=0.5)
    once = dedup_by_content(dedup_by_chunk(hits))
    twice = dedup_by_content(dedup_by_chunk(once))
    cols = ["query_id", "chunk_id", "score"]
    assert sorted(map(tuple, once.select(cols).collect())) == sorted(map(tuple, twice.select(cols).collect()))
    out = q_rag_contexts(spark, SF01)
    assert out.where((F.col("n_bytes") > 2000) | (F.col("n_chunks") > 10)).count() == 0
    assert out.where(F.col("n_bytes") != F.octet_length("context")).count() == 0


@settings(max_examples=300, deadline=None, derandomize=True)
@given(text=st.text(alphabet=st.sampled_from(list("ab .?!。\n ")), max_size=600), size=st.integers(2, 80),
       overlap=st.integers(0, 40))
def test_recursive_splitter_invariants(text, size, overlap):
    """Every chunk fits the size; with no overlap the chunks put back together are the text
    (separators stay with the left piece); with overlap every chunk is a piece of the text."""
    from ragloom.operators.recursive import split_recursive

    overlap = min(overlap, size - 1)
    chunks = split_recursive(text, size, overlap)
    assert all(len(c) <= size for c in chunks)
    assert all(c.strip() for c in chunks)
    if overlap == 0:  # no text lost: only all-white-space chunks are dropped
        import re

        assert re.sub(r"\s", "", "".join(chunks)) == re.sub(r"\s", "", text)
    pos = 0
    for c in chunks:
        at = text.find(c, max(0, pos - size))
        assert at >= 0
        pos = at + len(c)
