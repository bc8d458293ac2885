"""Document sources (S1-S3, S6 listing).

Files are read with Spark's text source in ``wholetext`` mode (one row per file) and
the path comes from the hidden ``_metadata`` column, so reading is a normal distributed
scan. Spark's file index never lists names starting with ``.`` or ``_``, nor empty files;
the import report therefore takes its own listing of names (metadata only) to say what was
skipped and why.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.sources.reports import EMPTY_FILE, NO_CHUNKS_ROUTED

# Extensions accepted by a directory scan (compared lower-cased).
SCAN_EXTENSIONS = (".txt", ".md")


def _ci_glob(exts) -> str:
    """Case-insensitive glob for the extensions (``pathGlobFilter`` is case-sensitive)."""
    alts = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in exts]
    return "*.{" + ",".join(alts) + "}"


def _local_path(c):
    """A path as it is named in the file system: the hidden column holds a URI, percent-encoded."""
    plain = F.regexp_replace(c, r"^file:(//)?", "")
    return F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, root: str, extensions=SCAN_EXTENSIONS) -> DataFrame:
    """Every ``.txt``/``.md`` file (any case) under ``root``, recursively, one row each:
    ``path, filename, file_type, text``. Names that start with ``.`` are hidden (as in the reference);
    Spark's file sources also skip names that start with ``_``, which the import report lists as skipped."""
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _ci_glob(extensions))
        .text(root, wholetext=True)
    )
    return with_file_columns(df)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files that the caller names, whatever their name or extension, one row each.

    A missing file is an error at once. An empty file is a row with an empty text (the import
    reports it as failed). Spark's file sources skip names that start with ``_`` or ``.``; the few
    that a caller names are read by one task each through the path's own file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    plain, odd, empty = [], [], []
    for name in paths:  # named by the caller, one by one
        p = jvm.org.apache.hadoop.fs.Path(name)
        status = p.getFileSystem(conf).getFileStatus(p)
        full = status.getPath().toUri().getPath() if status.getPath().toUri().getScheme() in (None, "file") else status.getPath().toString()
        last = status.getPath().getName()
        (empty if status.getLen() == 0 else odd if last.startswith(("_", ".")) else plain).append(
            full if status.getLen() == 0 or last.startswith(("_", ".")) else status.getPath().toString())
    out = None
    if plain:
        out = with_file_columns(spark.read.text([_escape_glob(x) for x in plain], wholetext=True))
    rows = spark.createDataFrame([(x, "") for x in empty], "path string, text string") if empty else None
    if odd:
        hidden = spark.createDataFrame([(x,) for x in odd], "path string").repartition(len(odd)).select("path", _read_text("path").alias("text"))
        rows = hidden if rows is None else rows.unionByName(hidden)
    if rows is not None:
        rows = _named(rows)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no file named")
    return out


def _escape_glob(path: str) -> str:
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _read_text(path: str):
    @F.pandas_udf("string")
    def read(names: pd.Series) -> pd.Series:
        from pyarrow import fs

        out = []
        for name in names:
            system, at = fs.FileSystem.from_uri(name) if "://" in name else (fs.LocalFileSystem(), name)
            with system.open_input_stream(at) as f:
                out.append(f.read().decode("utf-8", "replace"))
        return pd.Series(out)

    return read(F.col(path))


def with_file_columns(df: DataFrame) -> DataFrame:
    """A whole-text scan as ``path, filename, file_type, text``."""
    return _named(df.select(_local_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text")))


def _named(df: DataFrame) -> DataFrame:
    name = F.regexp_extract(F.col("path"), r"([^/]*)$", 1)
    return df.select("path", name.alias("filename"), F.regexp_extract(name, r"\.([^.]*)$", 1).alias("file_type"), "text")


def file_id(path) -> Column:
    """A short deterministic document id for a file (re-importing gives the same id); the path itself
    can be longer than an id may be and stays in the metadata."""
    return F.substring(F.sha2(path, 256), 1, 32)


def documents_from_files(files: DataFrame) -> DataFrame:
    """Files as documents: a short id from the path, and the path as source (P3 metadata)."""
    return files.select(file_id(F.col("path")).alias("doc_id"), "text", F.col("path").alias("source"), "path")


def documents_from_table(df: DataFrame, id_col: str = "id", content: str = "content", source: str = "source") -> DataFrame:
    """S3: ``(doc_id, text, source)`` rows from a table; an empty or null id gets a
    deterministic id from the content's SHA-256 (re-running gives the same id)."""
    i = F.col(id_col).cast("string")
    gen = F.substring(F.sha2(F.concat_ws("\u0000", F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(content), F.lit(""))), 256), 1, 32)
    return df.select(
        F.when(F.coalesce(i, F.lit("")) == "", gen).otherwise(i).alias("doc_id"),
        F.col(content).alias("text"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Listing of every file under ``root`` (names and sizes only, through the Hadoop file
    system of the path): ``path, name, length, hidden``. ``hidden`` marks a name, or a
    directory below ``root``, starting with ``.``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    base = fs.makeQualified(p).toUri().getPath().rstrip("/")
    rows = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        full = st.getPath().toUri().getPath()
        rel = full[len(base):].lstrip("/")
        parts = rel.split("/")
        rows.append((full, parts[-1], int(st.getLen()), any(x.startswith(".") for x in parts)))
    return spark.createDataFrame(rows, "path string, name string, length long, hidden boolean")


def import_report_files(listing: DataFrame, chunk_counts: DataFrame, extensions=SCAN_EXTENSIONS) -> DataFrame:
    """S6 for a directory import: per listed file ``path, chunk_count, success, error``.

    Hidden names and other extensions are not part of the import (as in the scan);
    ``_``-prefixed names are reported as skipped (the file source never lists them);
    empty files and files that give no chunk are failures. ``chunk_counts``:
    ``(path, chunk_count)`` from the ingest."""
    ext = F.lower(F.regexp_extract(F.col("name"), r"(\.[^.]*)$", 1))
    cand = listing.where(~F.col("hidden") & ext.isin(*extensions))
    j = cand.join(chunk_counts, "path", "left")
    n = F.coalesce(F.col("chunk_count"), F.lit(0)).cast("long")
    err = (
        F.when(F.col("name").startswith("_"), F.lit("skipped: name starts with '_'"))
        .when(F.col("length") == 0, F.lit(EMPTY_FILE))
        .when(n == 0, F.lit(NO_CHUNKS_ROUTED))
    )
    return j.select("path", n.alias("chunk_count"), err.isNull().alias("success"), err.alias("error"))
