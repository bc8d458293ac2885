"""The quality classifier: statistics against plain counts, trees against a walk by hand, held-out accuracy."""

import math
import zlib

import numpy as np
from conftest import SF01
from pyspark.sql import functions as F

from ragloom.llm import classifier as cl

SCHEMA = "doc_id long, text string, lang string, x string, score int"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_statistics():
    value = dict(zip(cl.STATISTICS, cl.statistics("Ab ab ab. É ZZ!\n\nab ab ab.\nab ab ab.\n\x01 9#".encode())))
    assert math.isclose(math.expm1(value["log_words"]), 13) and math.isclose(math.expm1(value["log_lines"]), 4) and math.isclose(value["repeated_lines"], 1 / 4)
    assert math.isclose(value["distinct_words"], 7 / 13) and math.isclose(value["top_word"], 5 / 13)
    assert math.isclose(value["repeated_windows"], 2 / 11)
    assert math.isclose(value["capital_words"], 1 / 13) and value["controls"] > 0 and value["symbols"] > 0 and value["exclamations"] > 0
    for text in (b"", b" \n", b"\x00", "é".encode(), b"a" * 3_000_000, b"a b " * 200_000):
        assert all(math.isfinite(v) for v in cl.statistics(text))
    assert len(cl.statistics(b"")) == len(cl.STATISTICS)


def walk(trees, row):
    total = trees.start
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        node = 0
        while node < len(f):
            node = 2 * node + (2 if row[f[node]] > t[node] else 1)
        total += leaf[node - len(f)]
    return 1 / (1 + math.exp(-total))


def test_trees_learn_an_interaction_and_flat_traversal_is_the_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > -0.2)).astype(float)
    trees = cl.fit_trees(x[:3000], y[:3000], np.ones(3000), cl.ClassifierParams(trees=40))
    s = trees.scores(x[3000:])
    assert ((s >= 0.5) == (y[3000:] == 1)).mean() > 0.97
    assert np.allclose(s[:200], [walk(trees, r) for r in x[3000:3200]])
    assert len(trees.scores(x[:0])) == 0


def test_weights_keep_scores_probabilities():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(2000, 3)).astype(np.float32), (rng.random(2000) < 0.5).astype(float)
    s = cl.fit_trees(x, y, np.where(y == 1, 9.0, 1.0) / 5, cl.ClassifierParams(trees=5)).scores(x)
    assert abs(s.mean() - 0.9) < 0.05


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = cl.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    p = cl.ClassifierParams(trees=10)
    get = lambda of: {r["doc_id"]: r["score"] for r in cl.quality_scores(docs, of, p).collect()}
    assert get(labels) == get(flipped)


def test_sample_is_bounded_and_needs_no_order(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    p = cl.ClassifierParams(trees=5, sample_docs=60)
    a = {r["doc_id"]: r["score"] for r in cl.quality_scores(docs, labels, p).collect()}
    b = {r["doc_id"]: r["score"] for r in cl.quality_scores(docs.repartition(5), labels.repartition(4), p).collect()}
    assert a == b


def test_odd_rows(spark):
    rows = [(1, None, None, "", 0), (2, "", "", "", 0), (None, "no id", "", "", 0), (4, "same same", "", "", 0), (4, "same same", "", "", 0), (4, "other text", "", "", 0),
            (5, "word " * 200000, "", "", 0), (6, "y" * 2_000_000, "", "", 0), (7, "!!! ###", "", "", 0)]
    labels = [(k, k % 2, 0, "x") for k in (1, 2, 4, 5, 6, 7)] + [(4, 0, 0, "x"), (7, 0, 0, ""), (None, 1, 0, ""), (2, None, None, None), (99, 1, 0, ""), (98, 7, 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for lab in (labels, labels[:1], [(k, 1, 0, "") for k in (1, 2, 4, 5)], []):
        got = cl.quality_scores(docs, spark.createDataFrame(lab, LABELS)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got} == {0.5}
    assert cl.quality_scores(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, LABELS)).count() == 0
