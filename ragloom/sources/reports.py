"""Import outcome reports (S6, A1) and stored-field limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.functions.metadata import base_metadata, metadata_to_json
from ragloom.functions.text import byte_length
from ragloom.operators.chunking import count_chunks
from ragloom.params import ChunkParams

# Failure texts of an import that yields no chunk (by splitter path), and of an empty file.
NO_CHUNKS_FIXED = "文本切分后没有有效分块"
NO_CHUNKS_ROUTED = "文档切分后没有有效分块"
EMPTY_FILE = "文件内容为空"

# Declared maximum lengths of the stored fields (id, content, doc_id, source, metadata_json).
FIELD_LIMITS = [("chunk_id", 64), ("content", 16384), ("doc_id", 64), ("source", 256), ("metadata_json", 4096)]


def import_report(documents: DataFrame, params: ChunkParams = ChunkParams(), text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """S6 per document: ``doc_id, chunk_count, success, error``. One document's failure
    never stops the others. Counting uses T2 on the row (no explode, no shuffle)."""
    counted = count_chunks(documents.select(doc_id, text), params, text, "chunk_count")
    n = F.col("chunk_count")
    return counted.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        n,
        (n > 0).alias("success"),
        F.when(n == 0, F.lit(NO_CHUNKS_FIXED)).alias("error"),
    )


def import_totals(report: DataFrame) -> DataFrame:
    """A1: one row ``n_success, n_failed, total_chunks`` (zeros for an empty import)."""
    return report.agg(
        F.count_if(F.col("success")).cast("long").alias("n_success"),
        F.count_if(~F.col("success")).cast("long").alias("n_failed"),
        F.coalesce(F.sum("chunk_count"), F.lit(0)).cast("long").alias("total_chunks"),
    )


def import_failures(report: DataFrame) -> DataFrame:
    """S6 failed list: the failed entries with their errors. It stays a DataFrame (write
    or show it); collecting an unbounded list to the driver is left to the caller."""
    return report.where(~F.col("success")).drop("success")


def stored_rows_unsplit(documents: DataFrame) -> DataFrame:
    """Documents as they would be stored without splitting (one chunk per document)."""
    return documents.select(
        F.concat_ws(":", F.col("doc_id").cast("string"), F.lit("0")).alias("chunk_id"),
        F.col("text").alias("content"),
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        metadata_to_json(base_metadata(F.col("doc_id"), F.col("source"), F.col("text"))).alias("metadata_json"),
    )


def field_violations(rows: DataFrame) -> DataFrame:
    """one row per field over its byte limit: ``doc_id, field, n_bytes, max_bytes``."""
    checks = F.array(*[
        F.struct(F.lit(name).alias("field"), byte_length(F.col(name)).cast("long").alias("n_bytes"),
                 F.lit(limit).cast("long").alias("max_bytes"))
        for name, limit in FIELD_LIMITS
    ])
    return (rows.select("doc_id", F.explode(checks).alias("c"))
            .select("doc_id", "c.field", "c.n_bytes", "c.max_bytes")
            .where(F.col("n_bytes") > F.col("max_bytes")))


def field_limit_violations(documents: DataFrame) -> DataFrame:
    return field_violations(stored_rows_unsplit(documents))


def within_field_limits():
    """F7 predicate: every stored field within its byte limit."""
    ok = F.lit(True)
    for name, limit in FIELD_LIMITS:
        ok = ok & (F.coalesce(byte_length(F.col(name)), F.lit(0)) <= limit)
    return ok


def split_by_field_limits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F7, quarantine form: (rows within every limit, rows over some limit)."""
    ok = within_field_limits()
    return rows.where(ok), rows.where(~ok)
