"""The metric range join against all pairs."""

import numpy as np
from conftest import SF01

from ragloom.llm import metricjoin as mj

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cls int"


def slow(rows, threshold=0.93):
    def ok(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    use = [ok(v, lab) for _, v, lab, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if use[i] and use[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    parent[root(i)] = root(j)
    low = {}
    for i, (k, *_) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return sorted(str((k, n[i], low.get(root(i)), k == low.get(root(i)))) for i, (k, *_) in enumerate(rows))


def planted(seed=0):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(60):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 6))):
                v = (base + rng.normal(size=16) * rng.uniform(0, 0.35)) * rng.uniform(0.1, 9)
                rows.append((k, [float(x) for x in v.astype(np.float32)], label, "x", 1))
                k += 1
    one = rows[0][1]
    rows += [(k, one, 0, "", 0), (k + 1, one, 1, "", 0), (k + 2, one, None, "", 0), (k + 3, None, 0, None, None), (k + 4, [], 0, "", 0),
             (k + 5, [0.0] * 16, 0, "", 0), (k + 6, [float("nan")] + one[1:], 0, "", 0), (k + 7, [float("inf")] + one[1:], 0, "", 0),
             (k + 8, [None] + one[1:], 0, "", 0), (k + 9, one[:8], 0, "", 0), (None, one, 0, "", 0), (k + 10, one, 7, "", 0), (k + 11, [-x for x in one], 0, "", 0)]
    rows += [(1000 + i, one, 2, "", 0) for i in range(200)]  # a hot vector
    return rows


def test_planted(spark):
    rows = planted()
    want = slow(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    for p in (mj.MetricJoinParams(), mj.MetricJoinParams(cell_rows=8), mj.MetricJoinParams(cell_rows=16, block_rows=5, group_rows=3)):
        assert sorted(str(tuple(r)) for r in mj.near_vectors(docs, p).collect()) == want


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert sorted(str(tuple(r)) for r in mj.near_vectors(df, mj.MetricJoinParams(cell_rows=20)).collect()) == slow(rows)


def test_empty(spark):
    assert mj.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
