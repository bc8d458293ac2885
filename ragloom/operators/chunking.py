"""Chunking (T1, T2, T5-T7): documents -> chunk rows.

The fixed-window splitter is one array expression per document (no UDF, no shuffle):
windows of ``size`` characters start every ``size - overlap`` characters of the trimmed
text, each window is trimmed again, windows under ``min_chars`` are dropped, and the
window list stops at the first window that reaches the end of the text. ``posexplode``
then numbers the kept chunks densely, so the chunk index needs no window function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.functions.metadata import chunk_id as chunk_id_expr
from ragloom.functions.text import char_length, file_ext_lower, trim_unicode
from ragloom.params import ChunkParams
from ragloom.session import ship_package


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_empty_documents(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with text after Unicode trimming, documents without: import failures)."""
    has = F.coalesce(char_length(trim_unicode(_c(text))), F.lit(0)) > 0
    return df.where(has), df.where(~has)


def fixed_windows(t: Column, params: ChunkParams = ChunkParams(), pieces: Column | None = None) -> Column:
    """T1 on an already-trimmed text: ``array<string>`` of the kept windows, in text order.

    With ``pieces`` (a column holding ``step_pieces(t)``) window i is the concatenation of
    pieces i .. i+span-1 cut to ``size`` characters. The pieces are zipped with shifted
    copies of themselves, so the window lambda reads only its own element: linear in the
    text. (``substring`` on UTF-8 text walks from the start of the string, so cutting every
    window from ``t`` is quadratic in the length of a long document; and a column read
    inside a lambda may be inlined there by the optimizer and recomputed per element.)
    Without ``pieces``, windows are cut from ``t``, which must then be a column reference."""
    step = params.step
    last = F.greatest(F.lit(0), F.ceil((char_length(t) - F.lit(params.size)) / F.lit(float(step)))).cast("int")
    if pieces is None:
        windows = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: trim_unicode(F.substring(t, i * step + 1, F.lit(params.size))),
        )
    else:
        span = -(-params.size // step)  # pieces a window touches
        n = last + 1
        shifted = [F.slice(pieces, j + 1, n).alias(f"p{j}") for j in range(span)]
        windows = F.transform(
            F.arrays_zip(*shifted),
            lambda z: trim_unicode(F.substring(F.concat_ws("", *[z[f"p{j}"] for j in range(span)]), 1, params.size)),
        )
        # an empty text has no piece: keep the single empty window of the plain form
        windows = F.when(F.size(pieces) > 0, windows).otherwise(F.array(F.lit("")))
    return F.filter(windows, lambda c: char_length(c) >= params.min_chars)


def step_pieces(t: Column, params: ChunkParams = ChunkParams()) -> Column:
    """The trimmed text cut into consecutive pieces of ``step`` characters (one linear regex pass)."""
    return F.regexp_extract_all(t, F.lit(f"(?s).{{1,{params.step}}}"), 0)


def with_fixed_chunks(df: DataFrame, params: ChunkParams = ChunkParams(), text: str = "text", out: str = "chunks") -> DataFrame:
    """Adds ``out``: T1 chunks of ``text`` (the trimmed text is projected first, once)."""
    staged = df.withColumn("_t", trim_unicode(_c(text)))
    staged = staged.withColumn("_p", step_pieces(F.col("_t"), params))
    return staged.withColumn(out, fixed_windows(F.col("_t"), params, F.col("_p"))).drop("_t", "_p")


def count_chunks(df: DataFrame, params: ChunkParams = ChunkParams(), text: str = "text", out: str = "n_chunks") -> DataFrame:
    """Adds ``out``, the number of chunks T1 gives (no explode)."""
    return with_fixed_chunks(df, params, text, "_chunks").withColumn(out, F.size("_chunks").cast("long")).drop("_chunks")


def explode_chunks(df: DataFrame, chunks_col: Column, doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """One row per chunk with a dense 0-based ``chunk_index`` and a deterministic ``chunk_id``."""
    keep = list(keep or [])
    # posexplode_outer + a filter on its output, not posexplode: for an inner explode the
    # optimizer infers ``size(array) > 0`` and pushes it below the projections that
    # stage the text, inlining every staged array into that filter.
    out = df.select(
        _c(doc_id).cast("string").alias("doc_id"),
        *[_c(k) for k in keep],
        F.posexplode_outer(chunks_col).alias("chunk_index", "content"),
    ).where(F.col("content").isNotNull())
    return out.select(
        chunk_id_expr("doc_id", "chunk_index").alias("chunk_id"),
        "doc_id",
        F.col("chunk_index").cast("long").alias("chunk_index"),
        "content",
        *keep,
    )


def chunk_fixed(
    df: DataFrame,
    params: ChunkParams = ChunkParams(),
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """T1 + T7 on a documents table: ``chunk_id, doc_id, chunk_index, content, *keep``.

    Narrow transformation only: partitions of the document scan become partitions of
    chunks, nothing is shuffled, and the scan reads just ``doc_id``, ``text`` and ``keep``.
    """
    keep = list(keep or [])
    staged = df.select(_c(doc_id).alias(doc_id), *[_c(k) for k in keep if k != doc_id],
                       trim_unicode(_c(text)).alias("_t"))
    staged = staged.withColumn("_p", step_pieces(F.col("_t"), params))
    return explode_chunks(staged, fixed_windows(F.col("_t"), params, F.col("_p")), doc_id=doc_id, keep=keep)


def is_markdown_source(source) -> Column:
    """T5 routing test: ``.md`` / ``.markdown`` extension in any case."""
    ext = file_ext_lower(F.coalesce(_c(source), F.lit("")))
    return ext.isin(".md", ".markdown")


def is_markdown_type(file_type) -> Column:
    """T6 routing test on an explicit type; the dot is optional."""
    t = F.lower(F.coalesce(_c(file_type), F.lit("")))
    return t.isin(".md", ".markdown", "md", "markdown")


def chunk_routed(
    df: DataFrame,
    params: ChunkParams = ChunkParams(),
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    keep: list[str] | None = None,
    file_type: str | None = None,
    max_section_bytes: int | None = None,
) -> DataFrame:
    """Markdown rows (``.md``/``.markdown`` source, any case; or an explicit
    ``file_type``) go through the header splitter, all others through the recursive
    splitter. The choice is made per row (the reference routes a whole batch by its first
    document); the two branches are one ``when`` expression, so there is no union and no
    shuffle, and only the recursive branch reaches Python. With ``max_section_bytes`` a Markdown section
    above it is cut further by the recursive splitter (T4's sections have no bound of their own)."""
    from ragloom.operators.markdown import with_markdown_sections
    from ragloom.operators.recursive import chunk_recursive_array, split_long_array

    ship_package(df.sparkSession)
    md = is_markdown_type(F.col(file_type)) if file_type else is_markdown_source(F.col(source))
    keep = list(keep or [])
    if source not in keep and source in df.columns:
        keep.append(source)
    staged = with_markdown_sections(df.withColumn("_md", md).withColumn("_mdtext", F.when(F.col("_md"), F.col(text))),
                                    "_mdtext", "_sections")
    sections = F.col("_sections")
    if max_section_bytes:
        long = F.exists(sections, lambda c: F.octet_length(c) > max_section_bytes)
        sections = F.when(long, split_long_array(F.when(long, sections), max_section_bytes, params.size, params.overlap)).otherwise(sections)
    arr = F.when(F.col("_md"), sections).otherwise(
        chunk_recursive_array(F.when(~F.col("_md"), F.col(text)), params.size, params.overlap))
    return explode_chunks(staged, arr, doc_id=doc_id, keep=keep)


def chunk_markdown(df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """T4 + T7 on a documents table."""
    from ragloom.operators.markdown import with_markdown_sections

    staged = with_markdown_sections(df, text, "_sections")
    return explode_chunks(staged, F.col("_sections"), doc_id=doc_id, keep=keep)


def chunk_recursive(df: DataFrame, params: ChunkParams = ChunkParams(), text: str = "text", doc_id: str = "doc_id",
                    keep: list[str] | None = None) -> DataFrame:
    """T3 + T7 on a documents table."""
    from ragloom.operators.recursive import chunk_recursive_array

    ship_package(df.sparkSession)
    return explode_chunks(df, chunk_recursive_array(F.col(text), params.size, params.overlap), doc_id=doc_id, keep=keep)
