"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space set used for trimming and word splitting
# (tab, LF, VT, FF, CR, space, NEL, NBSP, OGHAM SPACE MARK, EN QUAD .. HAIR SPACE,
# LINE SEPARATOR, PARAGRAPH SEPARATOR, NARROW NBSP, MEDIUM MATHEMATICAL SPACE,
# IDEOGRAPHIC SPACE).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# the same set as a regex class (works in Java regex and in RE2)
WS_CLASS = (
    r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_unicode(c) -> Column:
    """Strip Unicode white space at both ends (``trim()`` alone strips only spaces)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def normalize_ws(c) -> Column:
    """Runs of white space become one space; ends trimmed."""
    return F.regexp_replace(trim_unicode(c), WS_CLASS + "+", " ")


def char_length(c) -> Column:
    """Length in characters (code points): the chunking unit."""
    return F.length(_c(c))


def byte_length(c) -> Column:
    """Length in UTF-8 bytes: the context-budget unit."""
    return F.octet_length(_c(c))


def file_ext_lower(c) -> Column:
    """Lower-cased extension of the last path element, with its dot ('' when none)."""
    return F.lower(F.regexp_extract(_c(c), r"(\.[^./]*)$", 1))


def dedup_key(doc_id, chunk_index) -> Column:
    """``doc_id:chunk_index``."""
    return F.concat_ws(":", _c(doc_id).cast("string"), _c(chunk_index).cast("string"))
