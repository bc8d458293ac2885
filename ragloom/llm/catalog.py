"""The registered queries of the corpus operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ragloom.llm import (
    bpe, classifier, divergence, hardneg, license, lm, metricjoin, packing, pii, quality, simhash, substring, tokenfile,
)
from ragloom.llm.common import new_path, read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the file in the shared checkpoint folder, then reads it back."""
    path = new_path(spark)
    tokenfile.write_token_file(read_table(spark, sf_dir, "documents"), path)
    return tokenfile.token_report(spark, path)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metricjoin.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_report(read_table(spark, sf_dir, "documents"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(read_table(spark, sf_dir, "documents")).drop("places")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_report(read_table(spark, sf_dir, "documents"))


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read_table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives(hardneg.relabelled(read_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_token_file": op2_token_file,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_bpe": op4_bpe,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_lattice_lm": op10_lattice_lm,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op3_embedding_dedup": metricjoin.ORACLE_SQL,
    "op6_license_scan": license.ORACLE_SQL,
    "op7_quality_rules": quality.ORACLE_SQL,
    "op9_substring_dedup": substring.ORACLE_SQL,
    "op11_divergence_audit": divergence.ORACLE_SQL,
    "op13_hard_negatives": hardneg.ORACLE_SQL,
}
