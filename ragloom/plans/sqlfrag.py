"""SQL text pieces shared by the DuckDB oracle strings (literals and the T1/E4 fragments)."""

from __future__ import annotations

from ragloom.functions.text import WS_CHARS
from ragloom.operators.embedding import TOKEN_SPLIT


def lit(s: str) -> str:
    """A SQL string literal (newlines kept as they are)."""
    return "'" + s.replace("'", "''") + "'"


# the white-space set as a DuckDB expression
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WS_CHARS) + ")"


def chunks_sql(size: int = 500, overlap: int = 50, min_chars: int = 10, source: str = "documents",
               extra: str = "") -> str:
    """T1 + T7 in DuckDB: ``chunk_id, doc_id, chunk_index, content`` (+ ``extra`` columns)."""
    step = size - overlap
    ex = (", " + extra) if extra else ""
    return f"""
    (SELECT doc_id || ':' || CAST(chunk_index AS VARCHAR) AS chunk_id, doc_id, chunk_index, content{ex}
     FROM (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS chunk_index,
                  c AS content{ex}
           FROM (SELECT doc_id, i, trim(substring(t, CAST(i * {step} + 1 AS BIGINT), {size}), {WS_SQL}) AS c{ex}
                 FROM (SELECT doc_id, t, unnest(range(0, CAST(greatest(0, ceil((length(t) - {size}) / {float(step)}))
                                                     AS BIGINT) + 1)) AS i{ex}
                       FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, trim(text, {WS_SQL}) AS t{ex} FROM {source})))
           WHERE length(c) >= {min_chars}))"""


def bucket_sql(tok: str, dim: int) -> str:
    return f"(CAST(('0x' || substr(md5({tok}), 1, 8)) AS BIGINT) % {dim})"


def terms_sql(rel: str, key: str, text: str, dim: int) -> str:
    """E4 as rows ``(key, bucket, n)``."""
    return f"""
    (SELECT {key}, {bucket_sql('tok', dim)} AS bucket, count(*) AS n
     FROM (SELECT {key}, unnest(regexp_split_to_array(lower({text}), '{TOKEN_SPLIT}')) AS tok FROM {rel})
     WHERE tok <> ''
     GROUP BY ALL)"""
