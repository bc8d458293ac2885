"""Round 4: searches whose queries grow with the input (tool calls, histories) repeat and multiply as little as may be."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from ragloom.operators import blockjoin as bj
from ragloom.operators import embedding, search
from ragloom.plans.rag import retrieve
from ragloom.session import ship_package


def counts(n, seed, dim=64, tokens=40):
    rng = np.random.default_rng(seed)
    return np.stack([np.bincount(rng.integers(0, dim, int(rng.integers(1, tokens))), minlength=dim) for _ in range(n)]).astype(np.uint8)


def brute(q, m, k, floor, digits):
    qn, cn = search.row_norms(q), search.row_norms(m)
    with np.errstate(invalid="ignore"):
        s = (q.astype(float) @ m.astype(float).T) / np.outer(qn, cn)
    s = s if digits is None else np.round(s, digits)
    return [(i, j, s[i, j]) for i in range(len(q)) for j in sorted((j for j in range(len(m)) if s[i, j] >= floor[i]), key=lambda j: (-s[i, j], j))[:k]]


def test_packs_are_small_and_come_back_exactly(spark):
    """what is repeated for each group is a few compressed packs, not a row per vector."""
    ship_package(spark)
    m = counts(3000, 1, 256, 100)
    rows = [(i % 3, f"d{i}", i, m[i].tobytes()) for i in range(len(m))]
    df = spark.createDataFrame(rows, "cell int, doc_id string, _row long, _v binary").coalesce(1)
    packs = bj._packs(df, ["cell"]).collect()
    assert len(packs) < 30 and sum(len(p["pack"]) for p in packs) < m.nbytes / 2
    back = []
    for p in packs:
        parts = list(bj._unpack(pa.chunked_array([pa.array([p["pack"]], pa.binary())])))
        back += [(p["cell"], *r.values()) for t in parts for r in t.to_pylist()]
    assert sorted(back, key=lambda r: r[2]) == rows


def test_rows_of_one_query_id_are_one_query(spark):
    """the number that stands for an id in the block join is that of the id, null included."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    c = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = spark.createDataFrame([("a", rows[0][1]), ("a", rows[0][1]), (None, rows[1][1]), (None, rows[2][1]), ("b", rows[3][1])], "query_id string, embedding array<double>")
    p = bj.BlockParams(pivots=3, slices=2, block_rows=7, group_queries=2, first_cells=1)
    got = bj.block_join(c, q, 3, dim=4, order=["vec_id"], params=p).collect()
    assert sorted((str(r["query_id"]), r["rank"]) for r in got) == [(i, r) for i in ("None", "a", "b") for r in (1, 2, 3)]
    assert {r["vec_id"] for r in got if r["query_id"] == "a" and r["rank"] < 3} == {0} and {r["vec_id"] for r in got if r["query_id"] is None and r["rank"] < 3} == {1, 2}


@pytest.mark.parametrize("digits, k", [(None, 3), (9, 5)])
def test_counts_share_products_and_stay_exact(monkeypatch, digits, k):
    """With a floor, count vectors of any length are scored several to a product, ties by row number."""
    monkeypatch.setattr(search, "STEP", 64)
    monkeypatch.setattr(search, "LEAST", 16)
    m = counts(900, 2)
    m[100:400] = m[7]                               # copies
    m[500:520] = 2 * m[7]                           # the same direction, other lengths
    m[600:640] = np.random.default_rng(3).integers(100, 256, (40, 64))  # two digits and one
    m[700] = 0
    q = np.r_[m[::31], counts(40, 4), np.full((2, 64), 255, np.uint8)]
    qn, cn = search.row_norms(q), search.row_norms(m)
    norms = {d for n in qn[qn > 0] for c in cn[cn > 0] for d, b in search.DIGITS if n * c < (1 << b) - 1}
    assert norms == {1, 2, 3}
    for floor in (np.full(len(q), -np.inf), np.full(len(q), 0.45)):
        found = search.top_rows(q, qn, m, cn, k, floor, None, digits)
        assert list(zip(*(x.tolist() for x in found))) == brute(q, m, k, floor, digits)
    monkeypatch.setattr(search, "_top_any", None)   # no pair is scored by itself
    floor = np.full(len(q), 0.45)
    found = search.top_rows(q, qn, m, cn, k, floor, None, digits)
    assert list(zip(*(x.tolist() for x in found))) == brute(q, m, k, floor, digits)


def test_queries_without_a_positive_score_keep_their_rows(monkeypatch):
    """Rows of score 0 count where there are no better ones, as before."""
    monkeypatch.setattr(search, "STEP", 8)
    m = np.zeros((40, 4), np.uint8)
    m[:, 0] = 1
    m[30:, 1] = 3
    q = np.array([[0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 0]], np.uint8)
    found = search.top_rows(q, search.row_norms(q), m, search.row_norms(m), 3, np.full(3, -np.inf))
    assert list(zip(*(x.tolist() for x in found))) == brute(q, m, 3, np.full(3, -np.inf), None)


def test_tokens_are_those_of_the_pattern():
    """The byte-wise tokeniser agrees with a split by the pattern, for each code point, nulls and slices included."""
    points = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000] + list(range(1, 0x3000))
    texts = pa.array([f"a{chr(c)}B {chr(c)}" for c in points] + ["", None, "Straße, 数据!x", " ", "é"], pa.string())
    for t in (texts, texts.slice(5, 1000), texts.slice(len(texts) - 5), pa.chunked_array([texts.slice(0, 9), texts.slice(9, 9)])):
        whole = t.combine_chunks() if isinstance(t, pa.ChunkedArray) else t
        parts = pc.split_pattern_regex(pc.utf8_lower(whole), embedding.TOKEN_SPLIT)
        keep = pc.not_equal(pc.list_flatten(parts), "")
        row, toks = embedding.arrow_tokens(t)
        assert toks.equals(pc.list_flatten(parts).filter(keep))
        assert row.tolist() == pc.list_parent_indices(parts).filter(keep).to_pylist()


def test_token_hashes_are_kept_within_a_bound(monkeypatch):
    monkeypatch.setattr(embedding, "MEMO_TOKENS", 50)
    texts = pa.array([" ".join(f"w{i * 13 + j}" for j in range(40)) for i in range(30)])
    for lo in range(30):
        row, b = embedding.arrow_buckets(texts.slice(lo, 1), 64)
        assert b.tolist() == [embedding.md5_bucket(t, 64) for t in texts[lo].as_py().split()] and len(embedding._MEMO) <= 50


def test_hits_by_key_carry_no_text(spark):
    """a search for keys neither writes nor shuffles the chunks' texts."""
    ch = spark.createDataFrame([(f"c{i}", f"d{i}", 0, f"word{i} common text") for i in range(20)], "chunk_id string, doc_id string, chunk_index long, content string")
    qs = spark.createDataFrame([(1, "word3 common"), (2, "word7")], "query_id long, question string")
    keys = retrieve(qs, ch, keys_only=True)
    whole = retrieve(qs, ch)
    assert "content" in whole.columns and keys.columns == [c for c in whole.columns if c != "content"]
    assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, whole.drop("content").collect()))
