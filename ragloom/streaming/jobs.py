"""Structured Streaming jobs.

Both are append-only and need no state beyond the stream checkpoint: the file source remembers which
files it has taken, and each micro-batch runs the batch plan in ``foreachBatch``. A micro-batch owns
the partition named by the stream's own id (kept in its checkpoint) and the batch number, so a batch
replayed after a failure replaces its own output, and no other stream or import can be overwritten.
Default checkpoints live under the cluster's shared ``spark.checkpoint.dir``, one for each source and target.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ragloom.operators.cells import search_cells
from ragloom.params import CONFIGURED_PACK, ChunkParams, PackParams, SearchParams
from ragloom.plans.ingest import Splitter, ingest, ingest_report
from ragloom.plans.rag import rag_contexts
from ragloom.session import checkpoint_dir, write_once
from ragloom.sources.chunk_table import read_chunks, write_chunks
from ragloom.sources.files import SCAN_EXTENSIONS, _ci_glob, documents_from_files, with_file_columns

REPORT_SCHEMA = "doc_id string, chunk_count long, success boolean, error string, ingest_id string"


def _ckpt(spark: SparkSession, kind: str, location: str | None, *ends: str) -> str:
    if location:
        return location
    name = hashlib.sha256("\0".join(ends).encode()).hexdigest()[:16]
    return os.path.join(checkpoint_dir(spark), "streams", f"{kind}-{name}")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint: the same after a restart, another for a new checkpoint."""
    text = "".join(r["value"] for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"]


def ingest_stream(spark: SparkSession, src_dir: str, table_path: str, *, params: ChunkParams = ChunkParams(),
                  dim: int = 256, checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None, embed_fn=None, splitter: Splitter = "routed",
                  quarantine: bool = False, report_path: str | None = None) -> StreamingQuery:
    """Every new ``.txt``/``.md`` file under ``src_dir`` is split, embedded, checked (F6, F7) and added to
    the chunk table, with the same columns and metadata (P3) as a batch import.

    With ``report_path`` each micro-batch also leaves its import report (S6) there, under the import's id and only
    after its chunks are published (``read_stream_reports``). A replayed batch replaces its own report. The report
    counts the stored rows by their keys and reads the batch's own files once more for the ones that gave none."""
    reader = (spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", _ci_glob(SCAN_EXTENSIONS)))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = documents_from_files(with_file_columns(reader.load(src_dir)))
    location = _ckpt(spark, "ingest", checkpoint, src_dir, table_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        own = f"stream-{stream_id(batch.sparkSession, location)}-{batch_id:09d}"
        write_chunks(ingest(batch, params, dim, embed_fn, splitter), table_path, dim, quarantine, own)
        if report_path:
            stored = read_chunks(batch.sparkSession, table_path, ingest_id=own)
            ingest_report(batch, stored, splitter).write.mode("overwrite").parquet(os.path.join(report_path, f"ingest_id={own}"))

    w = docs.writeStream.foreachBatch(run).option("checkpointLocation", location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_stream_reports(spark: SparkSession, report_path: str) -> DataFrame:
    """S6 of streams: ``ingest_id, doc_id, chunk_count, success, error`` of every finished micro-batch (``import_totals`` takes it)."""
    return spark.read.schema(REPORT_SCHEMA).parquet(report_path).select("ingest_id", "doc_id", "chunk_count", "success", "error")


def search_stream(spark: SparkSession, questions: DataFrame, chunks: DataFrame, out_path: str, *,
                  search: SearchParams = SearchParams(), pack: PackParams = CONFIGURED_PACK,
                  checkpoint: str | None = None, available_now: bool = True, name: str = "questions") -> StreamingQuery:
    """Each micro-batch of questions ``(query_id, question)`` goes through M9 against the static chunk
    table; contexts are added to ``out_path``. ``name`` tells streams into one path apart (default checkpoint)."""
    location = _ckpt(spark, "search", checkpoint, name, out_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        own = f"stream-{stream_id(batch.sparkSession, location)}-{batch_id:09d}"
        rag_contexts(batch, chunks, search, pack).write.mode("overwrite").parquet(os.path.join(out_path, f"answer_id={own}"))

    w = questions.writeStream.foreachBatch(run).option("checkpointLocation", location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def search_cells_stream(spark: SparkSession, questions: DataFrame, cells_path: str, out_path: str, *, k: int = 5, nprobe: int = 8,
                        order: list[str] | None = None, round_digits: int | None = None, checkpoint: str | None = None, available_now: bool = True,
                        name: str = "cells") -> StreamingQuery:
    """S8 over a stored cell table (R7): each micro-batch of ``(query_id, embedding)`` reads only the folders of the cells
    that its questions probe, in the newest published state. Hits are added to ``out_path``."""
    location = _ckpt(spark, "cells", checkpoint, name, cells_path, out_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        own = f"stream-{stream_id(batch.sparkSession, location)}-{batch_id:09d}"
        asked = write_once(batch)  # its probes and its vectors are read from what was written
        search_cells(batch.sparkSession, cells_path, asked, k, nprobe, order=order, round_digits=round_digits).write.mode("overwrite").parquet(
            os.path.join(out_path, f"answer_id={own}"))

    w = questions.writeStream.foreachBatch(run).option("checkpointLocation", location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
