"""The whole write side.

    documents ─► T5 route (T4 / T3 per row) ─► T7 number ─► P2/P3 metadata ─► E2 embed
    missing vectors ─► F6/F7 checks ─► P9 rows ─► S4 append ─► F1/S6 import report

Narrow from the document scan to the Parquet sink: nothing between them shuffles. The report joins
the documents with the chunk counts of the stored import.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.functions.metadata import base_metadata, file_metadata
from ragloom.operators.chunking import chunk_fixed, chunk_routed, explode_chunks
from ragloom.operators.embedding import embed, embed_missing
from ragloom.params import ChunkParams
from ragloom.sources.chunk_table import read_chunks, write_chunks
from ragloom.sources.reports import EMPTY_FILE, FIELD_LIMITS, NO_CHUNKS_FIXED, NO_CHUNKS_ROUTED

CONTENT_LIMIT = dict(FIELD_LIMITS)["content"]

# a splitter of one's own: the text column -> array<string> of chunks
Splitter = str | Callable[[Column], Column]


@dataclass(frozen=True)
class ImportResult:
    """``ingest_id`` of the import, and its report ``doc_id, chunk_count, success, error`` per document."""

    ingest_id: str
    report: DataFrame


def ingest(documents: DataFrame, params: ChunkParams = ChunkParams(), dim: int = 256, embed_fn=None,
           splitter: Splitter = "routed", max_section_bytes: int | None = CONTENT_LIMIT) -> DataFrame:
    """Chunk rows with metadata and vectors, ready for ``write_chunks``. A Markdown section over
    ``max_section_bytes`` (the stored content limit) is cut further, so it cannot fail the import.

    ``documents``: ``doc_id, text, source``. ``splitter``: ``routed`` (T5, the live path), ``fixed`` (T1), or a
    function from the text column to an ``array<string>`` of chunks."""
    meta = base_metadata(F.col("doc_id"), F.col("source"), F.col("text"))
    if "path" in documents.columns:  # file imports also carry P3 file metadata
        meta = F.map_concat(F.map_filter(meta, lambda k, v: k != "source"), file_metadata(F.col("path")))
    docs = documents.withColumn("_meta", meta)
    if callable(splitter):
        kept = F.filter(splitter(F.col("text")), lambda c: F.coalesce(c, F.lit("")) != "")
        ch = explode_chunks(docs, kept, keep=["source", "_meta"])
    elif splitter == "fixed":
        ch = chunk_fixed(docs, params, keep=["source", "_meta"])
    elif splitter == "routed":
        ch = chunk_routed(docs, params, keep=["_meta"], max_section_bytes=max_section_bytes)
    else:
        raise ValueError(f"splitter must be 'routed', 'fixed' or a function, got {splitter!r}")
    ch = ch.withColumn(
        "metadata",
        F.map_concat(F.col("_meta"), F.create_map(F.lit("chunk_index"), F.col("chunk_index").cast("string"))),
    ).drop("_meta")
    return embed(ch, "content", embed_fn, dim, "embedding")


def ingest_report(documents: DataFrame, stored: DataFrame, splitter: Splitter = "routed") -> DataFrame:
    """F1 + S6: per document ``doc_id, chunk_count, success, error``; a document without stored chunks failed."""
    counts = stored.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    none = NO_CHUNKS_FIXED if splitter == "fixed" else NO_CHUNKS_ROUTED
    docs = documents.select(F.col("doc_id").cast("string").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) == 0).alias("_empty"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return docs.join(counts, "doc_id", "left").select(
        "doc_id", n.alias("chunk_count"), (n > 0).alias("success"),
        F.when(n == 0, F.when(F.col("_empty"), F.lit(EMPTY_FILE)).otherwise(F.lit(none))).alias("error"))


def ingest_to_table(documents: DataFrame, path: str, params: ChunkParams = ChunkParams(), dim: int = 256,
                    embed_fn=None, splitter: Splitter = "routed", quarantine: bool = False,
                    ingest_id: str | None = None) -> ImportResult:
    """Split, embed and store ``documents``; the result names the import and reports every document."""
    made = write_chunks(ingest(documents, params, dim, embed_fn, splitter), path, dim, quarantine, ingest_id)
    stored = read_chunks(documents.sparkSession, path, ingest_id=made)
    return ImportResult(made, ingest_report(documents, stored, splitter))


def store_chunks(chunks: DataFrame, path: str, dim: int = 256, embed_fn=None, quarantine: bool = False,
                 ingest_id: str | None = None) -> str:
    """E2 + S4 for ready chunks ``chunk_id, doc_id, chunk_index, content, source[, embedding, metadata]``:
    only rows without a vector are embedded."""
    if "embedding" not in chunks.columns:
        chunks = chunks.withColumn("embedding", F.lit(None).cast("array<float>"))
    return write_chunks(embed_missing(chunks, "content", "embedding", embed_fn, dim), path, dim, quarantine, ingest_id)
