"""The chunk table (S4, S5): Parquet, append-only, fixed schema.

Written rows: ``chunk_id, doc_id, chunk_index, content, source, embedding, metadata_json``. Every import,
batch or stream, owns one partition ``ingest_id=<id>`` of the table and writes only there, so imports
never overwrite each other and a replayed import replaces just its own rows. A replay writes a new
``version=<n>`` folder and counts once its write is committed (its ``_SUCCESS`` file); readers take the newest
committed version, and the one before it stays for those that are still reading it. A further partition
column ``quarantined`` separates rows over a field limit (F7) in the same single write. Every write
checks the vector width (F6: a wrong width fails the whole write, as in the reference).

``compact_chunks`` gathers small imports in one folder ``ingest_id=merged-<id>``, whose rows name their import
in ``origin``. It counts once its list of replaced folders, ``_merges/merged-<id>``, is committed; from then on the
listed folders do not count, and the next compaction deletes them. An import that is replayed later gets a
version that no list holds, and hides its merged rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.functions.metadata import metadata_from_json, metadata_to_json
from ragloom.operators.search import check_dimension
from ragloom.sources.reports import within_field_limits

STORED_COLUMNS = ["chunk_id", "doc_id", "chunk_index", "content", "source", "embedding", "metadata_json"]
STORED_SCHEMA = ("chunk_id string, doc_id string, chunk_index long, content string, source string, "
                 "embedding array<float>, metadata_json string, origin string, ingest_id string, version int, quarantined boolean")
MERGED = "merged-"
MERGE_SCHEMA = "merge string, own string, version int"


def to_rows(chunks: DataFrame) -> DataFrame:
    """Chunk documents -> stored rows (metadata map flattened to sorted-key JSON; the
    vector is never put inside the metadata)."""
    meta = F.col("metadata") if "metadata" in chunks.columns else F.lit(None).cast("map<string,string>")
    return chunks.select(
        F.col("chunk_id").cast("string"),
        F.col("doc_id").cast("string"),
        F.col("chunk_index").cast("long"),
        F.col("content").cast("string"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        metadata_to_json(meta).alias("metadata_json"),
    )


def new_ingest_id() -> str:
    return f"batch-{uuid.uuid4().hex}"


def write_chunks(chunks: DataFrame, path: str, dim: int, quarantine: bool = False, ingest_id: str | None = None) -> str:
    """Add one import to the chunk table and return its ``ingest_id``.

    Re-importing adds rows (no upsert, like the reference); giving the same ``ingest_id`` again replaces
    that import. An empty input adds no rows. Rows over a field limit fail the write, or with
    ``quarantine`` are kept apart (``read_quarantined``). The plan runs once.
    """
    ingest_id = ingest_id or new_ingest_id()
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9._-]*", ingest_id):
        raise ValueError(f"ingest_id must be a plain name starting with a letter, got {ingest_id!r}")
    if ingest_id.startswith(MERGED):
        raise ValueError(f"ingest_id must not start with {MERGED!r}")
    rows = check_dimension(to_rows(chunks), dim)
    ok = within_field_limits()
    if quarantine:
        flagged = rows.withColumn("quarantined", ~ok)
    else:
        failed = F.raise_error(F.concat(F.lit("field over its limit in chunk "), F.col("chunk_id"))).cast("boolean")
        flagged = rows.withColumn("quarantined", F.when(ok, F.lit(False)).otherwise(failed))
    spark, root = chunks.sparkSession, path.rstrip("/")
    known = _versions(spark, root, ingest_id).get(ingest_id, {})
    used = [*known, *(v for _, own, v in _merges(spark, root) if own == ingest_id)]
    # never an earlier number: an unfinished folder may still be written by a task that lost its executor
    flagged.write.partitionBy("quarantined").parquet(f"{root}/ingest_id={ingest_id}/version={max(used, default=-1) + 1}")
    done = sorted(v for v, committed in known.items() if committed)
    fs, to = _file_system(spark, root)
    for v in known:
        if v != (done[-1] if done else None):
            fs.delete(to(f"{root}/ingest_id={ingest_id}/version={v}"), True)
    return ingest_id


def _file_system(spark: SparkSession, path: str):
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return to(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to


def _versions(spark: SparkSession, root: str, ingest_id: str = "*") -> dict[str, dict[int, bool]]:
    """Import -> version -> committed, from the folder names (no data file is listed)."""
    fs, to = _file_system(spark, root)
    out: dict[str, dict[int, bool]] = {}
    for committed, pattern in ((False, "version=*"), (True, "version=*/_SUCCESS")):
        for s in fs.globStatus(to(f"{root}/ingest_id={ingest_id}/{pattern}")) or []:
            p = s.getPath().getParent() if committed else s.getPath()
            out.setdefault(p.getParent().getName().partition("=")[2], {})[int(p.getName().partition("=")[2])] = committed
    return out


def _merges(spark: SparkSession, root: str) -> list[tuple[str, str, int]]:
    """(merged folder, replaced import, its version) of all committed compactions: folder names, no rows."""
    fs, to = _file_system(spark, root)
    done = [s.getPath().getParent().toString() for s in fs.globStatus(to(f"{root}/_merges/*/_SUCCESS")) or []]
    return [tuple(r) for r in spark.read.schema(MERGE_SCHEMA).json(done).collect()] if done else []


def _counting(spark: SparkSession, root: str) -> tuple[dict[str, int], list[str]]:
    """Import -> its newest committed version that no compaction replaced; and the folders that do not count."""
    merges = _merges(spark, root)
    replaced, published = {(own, v) for _, own, v in merges}, {m for m, _, _ in merges}
    newest, stale = {}, []
    for own, versions in _versions(spark, root).items():
        live = [v for v, committed in versions.items() if committed and (own, v) not in replaced and (not own.startswith(MERGED) or own in published)]
        if live:
            newest[own] = max(live)
        stale += [f"{own}/{v}" for v in versions if v != newest.get(own)]
    return newest, stale


def _stored(spark: SparkSession, path: str, newest: dict[str, int] | None = None, stale: list[str] | None = None) -> DataFrame:
    """The rows of every import's newest committed version; other folders (few: replays and what the last compaction
    replaced) are left out by a partition filter. ``origin`` names the import of merged rows."""
    if newest is None:
        newest, stale = _counting(spark, path.rstrip("/"))
    df = spark.read.schema(STORED_SCHEMA).parquet(path)
    if stale:
        df = df.where(~F.concat_ws("/", "ingest_id", F.col("version").cast("string")).isin(stale))
    own = [k for k in newest if not k.startswith(MERGED)]
    if own and len(own) < len(newest):  # a replay hides the merged rows of its import
        df = df.where(F.col("origin").isNull() | ~F.col("origin").isin(own))
    return df.drop("version")


def compact_chunks(spark: SparkSession, path: str, max_bytes: int = 1 << 27) -> str | None:
    """Gather the imports below ``max_bytes`` in one folder of files of about that size (no shuffle); its name, or None
    where fewer than two are small. Readers see each row once at any time; imports may be added or replayed
    meanwhile, but only one compaction may run. The folders that the one before replaced are deleted first."""
    root = path.rstrip("/")
    fs, to = _file_system(spark, root)
    merges = _merges(spark, root)
    published = {m for m, _, _ in merges}
    for own in _versions(spark, root, f"{MERGED}*"):
        if own not in published:  # left by a compaction that stopped before its list was committed
            fs.delete(to(f"{root}/ingest_id={own}"), True)
            fs.delete(to(f"{root}/_merges/{own}"), True)
    for _, own, v in merges:
        fs.delete(to(f"{root}/ingest_id={own}/version={v}"), True)
        if own.startswith(MERGED):
            fs.delete(to(f"{root}/_merges/{own}"), True)
    newest, stale = _counting(spark, root)
    sizes = {own: fs.getContentSummary(to(f"{root}/ingest_id={own}/version={v}")).getLength() for own, v in newest.items()}
    small = [own for own, n in sizes.items() if n < max_bytes]
    if len(small) < 2:
        return None
    name = f"{MERGED}{uuid.uuid4().hex}"
    rows = _stored(spark, root, newest, stale).where(F.col("ingest_id").isin(small))
    rows = rows.withColumn("origin", F.coalesce("origin", "ingest_id")).drop("ingest_id")
    files = max(1, -(-sum(sizes[own] for own in small) // max_bytes))
    rows.coalesce(files).write.partitionBy("quarantined").parquet(f"{root}/ingest_id={name}/version=0")
    spark.createDataFrame([(name, own, newest[own]) for own in small], MERGE_SCHEMA).coalesce(1).write.json(f"{root}/_merges/{name}")
    return name


def read_chunks(spark: SparkSession, path: str, with_vector: bool = False, ingest_id: str | None = None) -> DataFrame:
    """The chunk table with the metadata parsed back (P5), of all imports or one; the vector column is
    read only when asked for (column pruning keeps it out of the scan otherwise)."""
    df = _stored(spark, path).where(~F.col("quarantined"))
    if ingest_id is not None:  # the first filter picks folders, the second one rows
        df = df.where((F.col("ingest_id") == ingest_id) | F.col("ingest_id").startswith(MERGED))
        df = df.where(F.coalesce("origin", "ingest_id") == ingest_id)
    cols = ["chunk_id", "doc_id", "chunk_index", "content", "source"]
    if with_vector:
        cols.append("embedding")
    return df.select(*cols, metadata_from_json(F.col("metadata_json")).alias("metadata"))


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """the stored rows that were kept apart, with their import."""
    return _stored(spark, path).where("quarantined").withColumn("ingest_id", F.coalesce("origin", "ingest_id")).drop("quarantined", "origin")


def stored_ids(spark: SparkSession, path: str, ingest_id: str) -> DataFrame:
    """The chunk ids that one import added."""
    return read_chunks(spark, path, ingest_id=ingest_id).select("chunk_id")
