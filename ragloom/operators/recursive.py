"""Recursive separator splitting (T3), our specification of the library splitter.

Separators in order: blank line, newline, sentence ends (``. ? ! 。 ？ ！``), space, then
single characters. A text is cut at the first separator present in it; separators stay
with the piece on their left, so no character is lost. Pieces are packed greedily while
the chunk stays within ``size`` characters; a piece longer than ``size`` is cut again with
the next separators. Each new chunk starts with whole trailing pieces of the previous one
worth at most ``overlap`` characters. Chunks that are only white space are dropped.

This is a per-document helper run on Arrow batches (``pandas_udf``); Spark parallelises
it over document partitions and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separator order.
SEPARATORS = ["\n\n", "\n", ".", "?", "!", "。", "？", "！", " ", ""]


def _split_keep(text: str, sep: str) -> list[str]:
    if sep == "":
        return list(text)
    parts = text.split(sep)
    out = [p + sep for p in parts[:-1]]
    if parts[-1]:
        out.append(parts[-1])
    return [p for p in out if p]


def _merge(pieces: list[str], size: int, overlap: int) -> list[str]:
    out: list[str] = []
    first = total = 0  # the open chunk is pieces[first:i]
    for i, p in enumerate(pieces):
        if first < i and total + len(p) > size:
            out.append("".join(pieces[first:i]))
            while first < i and (total > overlap or total + len(p) > size):
                total -= len(pieces[first])
                first += 1
        total += len(p)
    if pieces:
        out.append("".join(pieces[first:]))
    return out


def split_recursive(text: str, size: int = 500, overlap: int = 50, separators: list[str] | None = None) -> list[str]:
    """Plain-Python reference of T3 for one text."""
    if overlap >= size:
        raise ValueError(f"overlap ({overlap}) must be smaller than size ({size})")
    seps = SEPARATORS if separators is None else separators

    def go(t: str, seps: list[str]) -> list[str]:
        i = next((j for j, s in enumerate(seps) if s == "" or s in t), len(seps) - 1)
        sep, rest = seps[i], seps[i + 1:]
        chunks: list[str] = []
        good: list[str] = []
        for p in _split_keep(t, sep):
            if len(p) <= size:
                good.append(p)
                continue
            if good:
                chunks.extend(_merge(good, size, overlap))
                good = []
            chunks.extend(go(p, rest) if rest else [p])
        if good:
            chunks.extend(_merge(good, size, overlap))
        return chunks

    if not text:
        return []
    return [c for c in go(text, list(seps)) if c.strip()]


SLICE = 256  # texts whose chunks are held at a time


def in_slices(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Arrow batches (thousands of rows) a few hundred rows at a time, so their results go out in small batches."""
    for values in batches:
        for lo in range(0, len(values), SLICE):
            yield values.iloc[lo:lo + SLICE]


def chunk_recursive_array(text, size: int = 500, overlap: int = 50) -> Column:
    """T3 as a column: ``array<string>``."""
    if overlap >= size:
        raise ValueError(f"overlap ({overlap}) must be smaller than size ({size})")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in in_slices(batches):
            yield pd.Series([split_recursive(t or "", size, overlap) for t in texts], dtype=object)

    t = F.col(text) if isinstance(text, str) else text
    return _split(t)


def split_long_array(sections, max_bytes: int, size: int = 500, overlap: int = 50) -> Column:
    """Sections over ``max_bytes`` bytes through T3; the others as they are. Null stays null."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in in_slices(batches):
            out = []
            for one in lists:
                if one is None:
                    out.append(None)
                    continue
                parts: list[str] = []
                for text in one:
                    parts += [text] if len(text.encode("utf-8")) <= max_bytes else split_recursive(text, size, overlap)
                out.append(parts)
            yield pd.Series(out, dtype=object)

    return _split(F.col(sections) if isinstance(sections, str) else sections)
