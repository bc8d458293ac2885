"""The corpus pipeline over ``documents``: quality rules, SimHash near-dedup, substring dedup, PII redaction and
best-fit packing. Each stage reads what its predecessor kept, as written Parquet; all but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ragloom.llm.common import materialize, read_table
from ragloom.llm.packing import pack
from ragloom.llm.pii import redact
from ragloom.llm.quality import filter_quality
from ragloom.llm.simhash import keep_one
from ragloom.llm.substring import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return filter_quality(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints: the one with the smallest doc_id."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word passages that a document with a smaller doc_id holds."""
    return remove_repeats(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the kind's name."""
    return redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, each with its place in a sequence of at most 2048 tokens."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup),
          ("pii_redaction", pii_redaction), ("best_fit_packing", best_fit_packing)]

#: Tokenizer ids, XXH64 and boosted trees have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
