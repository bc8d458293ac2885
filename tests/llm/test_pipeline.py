"""The pipeline's stages against brute force on a small input, and the registry."""

import importlib.util
import os
import sys

import pytest
from conftest import SF001

sys.path.insert(0, os.path.dirname(__file__))
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
import test_pii  # noqa: E402
import test_simhash  # noqa: E402
import test_substring  # noqa: E402

from ragloom.llm import quality  # noqa: E402
from ragloom.llm.common import materialize  # noqa: E402


def test_registry():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "simhash_dedup", "substring_dedup", "pii_redaction", "best_fit_packing"]
    read = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    a = materialize(stages["quality_rules"](spark, docs, SF001))
    assert a.columns == docs.columns
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality_report(docs).collect()}
    assert read(a) == {k: t for k, t in read(docs).items() if verdict[k]}
    b = materialize(stages["simhash_dedup"](spark, a, SF001))
    groups = test_simhash.slow_groups([(k, test_simhash.slow_fingerprint(t)) for k, t in read(a).items()])
    assert read(b) == {k: t for k, t in read(a).items() if k in {g for *_, g in groups}}
    c = materialize(stages["substring_dedup"](spark, b, SF001))
    removed = {eval(x)[0]: eval(x) for x in test_substring.slow(list(read(b).items()))}
    for k, t in read(c).items():
        assert len(t.encode().split()) == removed[k][1] - removed[k][2]
    d = materialize(stages["pii_redaction"](spark, c, SF001))
    assert d.columns == docs.columns and set(read(d)) == set(read(c))
    assert all(sum(test_pii.slow(t)[0]) == 0 for t in read(d).values())
    e = stages["best_fit_packing"](spark, d, SF001).collect()
    assert {r["doc_id"] for r in e} == set(read(d)) and max(r["offset"] + r["length"] for r in e) <= 2048


def test_empty(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001))
    assert docs.count() == 0


@pytest.mark.parametrize("name", ["ragloom.plans.catalog", "ragloom.streaming.jobs", "ragloom.operators.search"])
def test_the_rest_does_not_need_it(name):
    source = open(importlib.util.find_spec(name).origin).read()
    assert "ragloom.llm" not in source
