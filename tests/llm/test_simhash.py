"""SimHash groups against all pairs in plain Python; the pigeonhole plan; hot buckets; components."""

import random

import numpy as np
import xxhash
from conftest import SF001

from ragloom.llm import simhash as sh
from ragloom.llm.graph import components


def slow_fingerprint(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < n else [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(items):
    """(id, fp) pairs -> id -> smallest id reachable."""
    parent = list(range(len(items)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(items)):
        for j in range(i):
            if bin(items[i][1] ^ items[j][1]).count("1") <= 3:
                parent[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(items):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return [(k, format(f, "016x"), low.get(root(i))) for i, (k, f) in enumerate(items)]


def check(spark, rows, schema="doc_id long, text string, fp string, component long"):
    got = sh.simhash_groups(spark.createDataFrame(rows, schema)).collect()
    want = slow_groups([(r[0], slow_fingerprint(r[1])) for r in rows])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"], "x", 1) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows += [(1000, None, None, None), (1001, " \n", "", 0), (None, "", "", 0), (1002, "Two words", "", 0), (1002, "Two words", "", 0),
             (1003, "cafÉ TWO İ \x1c words here", "", 0), (None, "only this one without id", "", 0)]
    check(spark, rows)


def test_empty(spark):
    assert sh.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_one(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = [r["doc_id"] for r in sh.keep_one(docs).collect()]
    groups = sh.simhash_groups(docs).collect()
    assert sorted(kept) == sorted({r["component_id"] for r in groups})


def test_keep_one_decides_by_row(spark):
    """Clashing and null ids, repeated rows, extra columns with the key's name."""
    text = " ".join(f"word{k}" for k in range(300))
    other = " ".join(f"thing{k * 7}" for k in range(300))
    rows = [(1, text, "a", 1), (2, text, "b", 2), (2, other, "c", 3), (2, other, "c", 3), (None, text, "d", 4), (None, "alone " + other[:900], "e", 5),
            (None, "alone " + other[:900], "f", 6), (7, None, None, None), (8, "", "g", 7), (None, " ", "h", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Row_Key_0 string, fp int")
    assert sh.fingerprint("alone " + other[:900]) not in {sh.fingerprint(other), sh.fingerprint(text)}
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(map(str, (tuple(r)[:2] for r in kept.collect())))
    assert got == sorted(map(str, [(1, text), (2, other), (None, "alone " + other[:900]), (7, None)]))


def test_very_long_text(spark):
    text = " ".join(f"w{k % 6007}" for k in range(200000))
    rows = [(1, text), (2, text + " x"), (3, "short")]
    got = {r["doc_id"]: r["component_id"] for r in sh.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_pigeonhole_with_uneven_thresholds():
    """Any four disjoint (t_i + 1) that add up to 4 keep every pair within 3 bits."""
    rng = random.Random(5)
    costs = [[0.0, 9, 1, 9, 9], [0.0, 9, 9, 9, 9], [0.0, 1, 9, 9, 9], [0.0, 1, 9, 9, 9]]
    t = sh.allocate(costs, 3)
    assert sum(x + 1 for x in t) == 4 and t[0] == 1 and t[1] == -1
    groups = sh.group_bits(np.eye(64), 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    for _ in range(500):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(k >= 0 and bin(diff & sh._mask(g)).count("1") <= k for g, k in zip(groups, t))


def test_probes_and_hot_buckets(spark, monkeypatch):
    """Uneven thresholds and tiny bucket bounds give the same groups."""
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = list({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(15)})
    classes = spark.createDataFrame([(sh._signed(f),) for f in fps], "fp long")
    groups = sh.group_bits(np.eye(64), 4)
    want = {k: c for k, _, c in slow_groups([(sh._signed(f), f) for f in fps])}
    for plan in ([(g, 0) for g in groups], [(groups[0], 1), (groups[2], 0), (groups[3], 0)]):
        monkeypatch.setattr(sh, "plan_partitions", lambda c, p, plan=plan: plan)
        for rows in (4096, 3):
            linked = {r["node"]: r["component"] for r in components(sh.near_pairs(classes, sh.SimHashParams(bucket_rows=rows))).collect()}
            assert {k: linked.get(k, k) for k in want} == want


def test_wide_bucket_edges():
    rng = np.random.default_rng(3)
    fps = (np.uint64(1) << rng.integers(0, 20, 300).astype(np.uint64)) | (np.uint64(1) << rng.integers(0, 20, 300).astype(np.uint64))
    fps = np.unique(fps)
    a, b = sh.bucket_edges(np.zeros(len(fps), int), fps, np.zeros(len(fps), bool), 3)
    assert len(a) == len(fps) - 1  # one component, one edge a row


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 201: 200}
