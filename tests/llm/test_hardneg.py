"""Hard negatives against all scores."""

import math
import random

import numpy as np
from conftest import SF01

from ragloom.llm import hardneg as hn

SCHEMA = "vec_id long, embedding array<float>, label int, q string, rank int, dim int"


def slow(rows, p):
    use = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(p.scale * float(np.float32(x))) for x in v]
        if all(abs(x) < 1 << 25 for x in q):
            use.append((vec_id, label, q))
    out = []
    last = lambda k: (k is None, k)
    for a, label, q in use:
        if a is None or a % p.anchor_every:
            continue
        scored = [(sum(x * y for x, y in zip(q, r)), k, lab) for k, lab, r in use if len(r) == len(q)]
        best = sorted(((s, k) for s, k, lab in scored if lab == label and k != a), key=lambda x: (-x[0], last(x[1])))[:p.positives]
        for ps, pk in best:
            hits = sorted(((s, k) for s, k, lab in scored if lab != label and p.low_pct * ps <= 100 * s <= p.high_pct * ps), key=lambda x: (-x[0], last(x[1])))
            out += [(a, pk, i + 1, k, ps, s) for i, (s, k) in enumerate(hits[:p.negatives])]
    return sorted(map(str, out))


def fast(spark, rows, p, parts=3):
    return sorted(str(tuple(r)) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(parts), p).collect())


def planted(n=700, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        v = rng.normal(size=dim) * rng.choice([0.02, 0.3, 1.0, 4.0]) + (rng.integers(0, 3) == 0)
        label = 0 if rng.random() < 0.4 else int(rng.integers(0, 6))
        rows.append((k, [float(x) for x in v], label, "x", 1, 2))
    one = rows[100][1]
    rows += [(n + i, one, i % 3, "", 0, 0) for i in range(40)]                       # ties and copies
    rows += [(n + 100, None, 1, "", 0, 0), (n + 200, one, None, "", 0, 0), (n + 300, [None] + one[1:], 1, "", 0, 0),
             (n + 400, [float("nan")] + one[1:], 1, "", 0, 0), (n + 500, [float("inf")] + one[1:], 1, "", 0, 0),
             (n + 600, [0.0] * dim, 0, "", 0, 0), (n + 700, one[:3], 1, "", 0, 0), (n + 701, one[:3], 2, "", 0, 0), (n + 702, [x / 2 for x in one[:3]], 1, "", 0, 0),
             (n + 800, [], 1, "", 0, 0), (n + 801, [], 2, "", 0, 0), (n + 802, [], 1, "", 0, 0), (n + 900, [1e30] + one[1:], 1, "", 0, 0),
             (None, one, 1, "", 0, 0), (None, one, 2, "", 0, 0), (200, one, 1, "", 0, 0), rows[300], rows[301], (-100, one, 0, "", 0, 0)]
    return rows


def test_planted(spark):
    rows = planted()
    for p in (hn.HardNegativeParams(anchor_every=20), hn.HardNegativeParams(anchor_every=50, shard_rows=60, block_anchors=5, bucket_rows=16, focus=3)):
        want = slow(rows, p)
        assert want and fast(spark, rows, p) == want


def test_hot_label_and_tiny_tables(spark):
    rng = random.Random(5)
    rows = [(k, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], 0 if k % 3 else k % 5, "", 0, 0) for k in range(300)]
    p = hn.HardNegativeParams(anchor_every=10, shard_rows=20, block_anchors=4, bucket_rows=8)
    assert fast(spark, rows, p) == slow(rows, p)
    for few in ([], rows[:1], rows[:2]):
        assert fast(spark, few, p) == slow(few, p)


def test_exact_beyond_doubles(spark):
    """Scores above 2**53 keep their last digit."""
    rng = random.Random(6)
    rows = [(k, [float(rng.randint(60000, 65000)) * 2 for _ in range(40)], k % 2, "", 0, 0) for k in range(40)]
    p = hn.HardNegativeParams(anchor_every=5, high_pct=100)
    assert slow(rows, p) and fast(spark, rows, p) == slow(rows, p)


def test_coordinate_ranges_prune_and_lose_nothing():
    """Clustered vectors: the ranges leave few candidates, and every row that reaches the bound is among them."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    q = np.floor(256 * (centres[rng.integers(0, 12, 3000)] + 0.03 * rng.normal(size=(3000, 8))))
    kept = seen = 0
    for bucket in hn.buckets_of(q, np.arange(3000), 500):
        for anchor in q[:40]:
            length = float(np.linalg.norm(anchor))
            bound = 0.9 * length * length
            axes = np.argsort(-np.abs(anchor))[:4]
            found = bucket.candidates(anchor / length, axes, length, bound)
            found = np.empty(0, dtype=int) if found is None else found
            assert set(np.flatnonzero(bucket.q @ anchor >= bound)) <= set(found.tolist())
            kept, seen = kept + len(found), seen + len(bucket.ids)
    assert kept < 0.35 * seen
    assert hn.buckets_of(q * 0.01, np.arange(3000), 3000)[0].candidates(q[0] / np.linalg.norm(q[0]), axes, float(np.linalg.norm(q[0])), 1e6) is None


def test_given_vectors(spark):
    df = hn.relabelled(spark.read.parquet(f"{SF01}/embeddings.parquet"))
    rows = [tuple(r) + ("", 0, 0) for r in df.select("vec_id", "embedding", "label").collect()]
    got = sorted(str(tuple(r)) for r in hn.hard_negatives(df, hn.HardNegativeParams(anchor_every=25, shard_rows=80)).collect())
    assert got == slow(rows, hn.HardNegativeParams(anchor_every=25))
