"""Document / chunk-row metadata functions.

Metadata is a ``map<string,string>`` column; at the sink it is flattened to JSON text
with sorted keys so the stored text is stable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ragloom.functions.text import byte_length



def empty_map() -> Column:
    """An empty ``map<string,string>`` (built lazily: Columns need an active session)."""
    return F.create_map().cast("map<string,string>")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def build_document(doc_id, content, metadata=None) -> Column:
    """``struct(doc_id, content, metadata)``; null metadata -> empty map."""
    meta = empty_map() if metadata is None else F.coalesce(_c(metadata), empty_map())
    return F.struct(_c(doc_id).cast("string").alias("doc_id"), _c(content).alias("content"), meta.alias("metadata"))


def base_metadata(doc_id, source, text) -> Column:
    """doc_id, source and original_length (UTF-8 bytes of the untrimmed text, as text)."""
    return F.create_map(
        F.lit("doc_id"), _c(doc_id).cast("string"),
        F.lit("source"), F.coalesce(_c(source), F.lit("")),
        F.lit("original_length"), byte_length(text).cast("string"),
    )


def file_metadata(path) -> Column:
    """Filename (base name), filepath and source (full path), file_type (extension, case kept)."""
    p = _c(path)
    return F.create_map(
        F.lit("filename"), F.regexp_extract(p, r"([^/]*)$", 1),
        F.lit("filepath"), p,
        F.lit("source"), p,
        F.lit("file_type"), F.regexp_extract(p, r"\.([^./]*)$", 1),
    )


def metadata_to_json(m) -> Column:
    """Map -> JSON text with sorted keys; null -> ``{}``."""
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries(_c(m))))
    return F.coalesce(F.to_json(sorted_map), F.lit("{}"))


def metadata_from_json(c) -> Column:
    """P5: JSON text -> map; empty, malformed or ``null`` text -> empty map (never an error).
    A repeated key keeps its last value."""
    def last_wins(entries: Column) -> Column:
        return F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])))

    m = F.from_json(_c(c), "map<string,string>", {"mode": "PERMISSIVE"})
    # the one-element array holds the entries, so they are parsed once
    return F.coalesce(F.element_at(F.transform(F.array(F.map_entries(m)), last_wins), 1), empty_map())


def meta_string(m, key: str) -> Column:
    """The value under ``key``, '' when absent."""
    return F.coalesce(F.try_element_at(_c(m), F.lit(key)), F.lit(""))


def meta_long(m, key: str) -> Column:
    """Numeric value truncated toward zero; absent, not a number or beyond a long -> 0."""
    return F.coalesce(F.try_element_at(_c(m), F.lit(key)).try_cast("double").try_cast("long"), F.lit(0).cast("long"))


def overlay_columns(meta, doc_id, chunk_index, source) -> Column:
    """Stored columns win over metadata entries: non-empty doc_id, non-zero chunk_index,
    non-empty source replace what the parsed metadata holds."""
    m = F.coalesce(_c(meta), empty_map())
    d = _c(doc_id).cast("string")
    ci = _c(chunk_index).cast("long")
    s = _c(source)
    over = F.map_from_entries(
        F.transform(
            F.filter(
                F.array(
                    F.struct(F.lit("doc_id").alias("key"), d.alias("value"), (F.coalesce(d, F.lit("")) != "").alias("keep")),
                    F.struct(F.lit("chunk_index").alias("key"), ci.cast("string").alias("value"),
                             (F.coalesce(ci, F.lit(0)) != 0).alias("keep")),
                    F.struct(F.lit("source").alias("key"), s.alias("value"), (F.coalesce(s, F.lit("")) != "").alias("keep")),
                ),
                lambda e: e["keep"],
            ),
            lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")),
        )
    )
    kept = F.map_filter(m, lambda k, v: ~F.array_contains(F.map_keys(over), k))
    return F.map_concat(kept, over)


def hit_id_fallback(hit_id, rank) -> Column:
    """The hit's id, else ``hit_<i>`` with i its 0-based position in the result."""
    h = _c(hit_id).cast("string")
    return F.coalesce(F.nullif(h, F.lit("")), F.concat(F.lit("hit_"), (_c(rank) - 1).cast("string")))


def chunk_id(doc_id, chunk_index) -> Column:
    """Deterministic chunk key ``doc_id:chunk_index`` (re-running a job gives the same ids)."""
    return F.concat_ws(":", _c(doc_id).cast("string"), _c(chunk_index).cast("string"))
