"""Embedding.

E4, the offline default, is feature hashing of word tokens (Weinberger et al., 2009):
tokens are runs of letters/digits of the lower-cased text; a token's bucket is the first
32 bits of its MD5 modulo ``dim``; a text's vector is its bucket counts (L2-normalised for
storage). Tokenising and hashing run in the JVM (``split``/``md5`` inside ``transform``);
only the count-to-dense step runs in an Arrow batch, with ``numpy.bincount``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import hashlib
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from ragloom.session import ship_package, write_once

# Fixed value: a token is a maximal run of letters and digits.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
TERM_ROWS = 1024
# Two tokenisers apply it: the JVM one (``tokens``: Java regex, ``lower``) and the Arrow
# one (``arrow_tokens``: RE2, ``utf8_lower``, the same engine family as the DuckDB oracle).
# They agree on the given tables (tested); lower-casing rules differ for a few scripts
# (the JVM maps a word-final Greek sigma to its final form), so one index is best hashed
# with one of them. The default text-mode search uses the Arrow one for both sides.


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """Lower-cased word tokens, empty strings removed."""
    return F.filter(F.split(F.lower(_c(text)), TOKEN_SPLIT), lambda t: t != "")


def token_bucket(tok: Column, dim: int) -> Column:
    """Bucket of one token: first 8 hex digits of md5 as an unsigned 32-bit number, mod ``dim``."""
    return F.pmod(F.conv(F.substring(F.md5(tok), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def token_buckets(text, dim: int) -> Column:
    """E4 sparse form: ``array<int>`` of the bucket of every token (with repeats)."""
    return F.transform(tokens(text), lambda t: token_bucket(t, dim))


_UNKNOWN = 2
_KINDS = np.full(0x110000, _UNKNOWN, dtype=np.uint8)  # 1: a token's character, as RE2 says; filled as code points are met


def _kinds(points: np.ndarray) -> np.ndarray:
    kinds = _KINDS[points]
    if (kinds == _UNKNOWN).any():
        new = np.unique(points[kinds == _UNKNOWN])
        parted = pc.match_substring_regex(pa.array([chr(c) for c in new.tolist()]), TOKEN_SPLIT)
        _KINDS[new] = ~parted.to_numpy(zero_copy_only=False)
        kinds = _KINDS[points]
    return kinds


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """Mask of the bytes of valid UTF-8 that belong to a token's character."""
    high = data >= 0x80
    word = _kinds(np.where(high, 0, data)).astype(bool)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        point = first & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
        for i in (1, 2, 3):
            more = size > i
            point[more] = point[more] << 6 | data[lead[more] + i] & 0x3F
        kind = _kinds(point).astype(bool)
        for i in range(4):
            word[lead[size > i] + i] = kind[size > i]
    return word


def arrow_tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Vectorised tokeniser for Arrow batches (same tokens as ``tokens``): returns the row
    of every token and the tokens themselves. A split by the pattern, byte by byte in NumPy."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    low = pc.fill_null(pc.utf8_lower(texts.cast(pa.string())), "")
    bounds = np.frombuffer(low.buffers()[1], dtype=np.int32, count=low.offset + len(low) + 1)[low.offset:] if len(low) else np.zeros(1, dtype=np.int32)
    if bounds[-1] == bounds[0]:
        return np.zeros(0, dtype=np.int64), pa.array([], pa.string())
    data = np.frombuffer(low.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    word = _word_bytes(data)
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    rows = bounds[:-1][bounds[:-1] < len(data)]
    begin[rows] = word[rows]
    at = np.flatnonzero(begin)
    ends = np.r_[np.cumsum(word)[at] - 1, np.count_nonzero(word)].astype(np.int32)
    toks = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data[word]))
    return np.searchsorted(bounds, at, side="right").astype(np.int64) - 1, toks


def md5_bucket(tok: str, dim: int) -> int:
    """Bucket of one token: first 32 bits of md5 (big-endian) modulo ``dim``."""
    return int.from_bytes(hashlib.md5(tok.encode("utf-8")).digest()[:4], "big") % dim


MEMO_TOKENS = 1 << 17
_MEMO: dict[bytes, int] = {}  # the first 32 bits of MD5 of tokens met before, at most ``MEMO_TOKENS`` or one batch


def _token_numbers(toks: pa.Array) -> np.ndarray:
    """The first 32 bits of MD5 of each token."""
    ends = np.frombuffer(toks.buffers()[1], dtype=np.int32, count=toks.offset + len(toks) + 1)[toks.offset:].tolist()
    data = toks.buffers()[2].to_pybytes() if toks.buffers()[2] else b""
    words = [data[a:z] for a, z in zip(ends, ends[1:])]
    if len(_MEMO) + len(words) > MEMO_TOKENS:
        _MEMO.clear()
    out = [_MEMO.get(t) for t in words]
    for i, n in enumerate(out):
        if n is None:
            t = words[i]
            out[i] = _MEMO[t] = int.from_bytes(hashlib.md5(t).digest()[:4], "big")
    return np.array(out, dtype=np.int64)


def arrow_buckets(texts: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every token of an Arrow string array; each distinct token of the
    batch is hashed once, if at all."""
    parent, toks = arrow_tokens(texts)
    if len(toks) == 0:
        return parent, np.zeros(0, dtype=np.int64)
    enc = pc.dictionary_encode(toks)
    return parent, (_token_numbers(enc.dictionary) % dim)[enc.indices.to_numpy(zero_copy_only=False)]


def bucket_counts(texts: pa.Array, dim: int) -> np.ndarray:
    """(rows × dim) float64 matrix of hashed-token counts (E4 before normalisation)."""
    n = len(texts)
    parent, b = arrow_buckets(texts, dim)
    return np.bincount(parent * dim + b, minlength=n * dim).astype(np.float64).reshape(n, dim)


def _dense_embed_udf(dim: int):
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def dense(texts: pd.Series) -> pd.Series:
        m = bucket_counts(pa.array(texts, type=pa.string()), dim)
        n = np.sqrt(np.einsum("ij,ij->i", m, m))
        with np.errstate(divide="ignore", invalid="ignore"):
            v = np.where(n[:, None] > 0, m / n[:, None], 0.0).astype(np.float32)
        return pd.Series(list(v))

    return dense


def hash_embed(df: DataFrame, text: str = "content", dim: int = 256, out: str = "embedding") -> DataFrame:
    """E4 dense form: unit-length ``array<float>`` of width ``dim`` (all-zero for a text
    with no token), computed per Arrow batch."""
    ship_package(df.sparkSession)
    return df.withColumn(out, _dense_embed_udf(dim)(_c(text)))


def hash_terms(df: DataFrame, key: list[str], text: str, dim: int = 256) -> DataFrame:
    """E4 as rows ``(*key, bucket, n)`` for rows whose ``key`` is unique: each row's
    counts are complete inside its task, so nothing is shuffled (``mapInArrow``)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(df.sparkSession)
    fields = [f for f in df.select(*key).schema.fields]
    schema = T.StructType(fields + [T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        # tokens take many times the room of their texts: those of about a thousand rows are held at a time
        for rb in (b.slice(lo, TERM_ROWS) for b in batches for lo in range(0, b.num_rows, TERM_ROWS)):
            parent, b = arrow_buckets(rb.column(text), dim)
            codes, n = np.unique(parent * dim + b, return_counts=True)
            rows = codes // dim
            cols = [rb.column(k).take(pa.array(rows)) for k in key]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array((codes % dim).astype(np.int32)), pa.array(n.astype(np.int64))], schema=arrow_schema)

    return df.select(*key, text).mapInArrow(run, schema)


def hash_terms_grouped(df: DataFrame, key: list[str], text: str, dim: int = 256) -> DataFrame:
    """E4 as rows when ``key`` repeats across rows: JVM tokens, then a grouped count with a
    partial aggregate before the shuffle (at most ``dim`` rows per key per task)."""
    return (
        df.select(*key, F.explode(token_buckets(_c(text), dim)).alias("bucket"))
        .groupBy(*key, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def embedder_udf(fn: Callable[[list[str]], list[list[float]]]):
    """Wrap any batch embedder (list of texts -> list of vectors) as an Arrow-batched UDF.

    The function sees whole Arrow batches (``spark.sql.execution.arrow.maxRecordsPerBatch``
    rows), so a remote model gets one request per batch instead of one per chunk.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            vecs = fn([("" if t is None else t) for t in texts.tolist()])
            yield pd.Series([None if v is None else np.asarray(v, dtype=np.float32) for v in vecs])

    return embed


def embed(df: DataFrame, text: str = "content", fn=None, dim: int = 256, out: str = "embedding") -> DataFrame:
    """Embed ``text`` with ``fn`` (a batch callable), or with E4 when ``fn`` is None."""
    if fn is None:
        return hash_embed(df, text, dim, out)
    ship_package(df.sparkSession)
    return df.withColumn(out, embedder_udf(fn)(_c(text)))


def needs_embedding(vec) -> Column:
    """vector missing or empty."""
    v = _c(vec)
    return v.isNull() | (F.size(v) == 0)


def embed_missing(df: DataFrame, text: str = "content", vec: str = "embedding", fn=None, dim: int = 256) -> DataFrame:
    """Embed only rows whose vector is missing; the rest pass through untouched.

    One pass: the text of a row that has a vector is masked, and the embedder is called on the
    unmasked texts of each Arrow batch only.
    """
    ship_package(df.sparkSession)
    plain = fn if fn is not None else _hash_batch(dim)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def missing(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            todo = [i for i, t in enumerate(texts) if t is not None]
            out: list = [None] * len(texts)
            if todo:
                for i, v in zip(todo, plain([texts.iloc[i] for i in todo])):
                    out[i] = None if v is None else np.asarray(v, dtype=np.float32)
            yield pd.Series(out, dtype=object)

    need = needs_embedding(vec)
    masked = F.when(need, F.coalesce(_c(text), F.lit("")))
    made = df.withColumn("_new", missing(masked))
    return made.withColumn(vec, F.when(need, F.col("_new")).otherwise(F.col(vec).cast("array<float>"))).select(*df.columns)


def _hash_batch(dim: int):
    """E4 as a batch embedder."""
    def fn(texts: list[str]):
        m = bucket_counts(pa.array(texts, pa.string()), dim)
        n = np.sqrt(np.einsum("ij,ij->i", m, m))
        with np.errstate(divide="ignore", invalid="ignore"):
            return list(np.where(n[:, None] > 0, m / n[:, None], 0.0).astype(np.float32))

    return fn


def requests(texts: list[str], max_bytes: int, max_texts: int) -> Iterator[list[int]]:
    """Positions of the texts in consecutive requests of at most ``max_texts`` texts and ``max_bytes`` bytes
    (a longer text makes a request of its own)."""
    now, held = [], 0
    for i, t in enumerate(texts):
        size = len(t.encode("utf-8"))
        if now and (len(now) >= max_texts or held + size > max_bytes):
            yield now
            now, held = [], 0
        now.append(i)
        held += size
    if now:
        yield now


def _asked(fn, texts: list[str], attempts: int, wait_seconds: float) -> list:
    """One request, tried at most ``attempts`` times; the last failure fails the task (Spark then tries it elsewhere)."""
    for attempt in range(attempts):
        try:
            vecs = fn(texts)
            if len(vecs) != len(texts):
                raise ValueError(f"embedder gave {len(vecs)} vectors for {len(texts)} texts")
            return vecs
        except Exception:
            if attempt + 1 == attempts:
                raise
            time.sleep(wait_seconds * 2 ** attempt)
    return []


def embed_distinct(df: DataFrame, text: str = "content", vec: str = "embedding", fn=None, dim: int = 256, *, max_bytes: int = 1 << 20,
                   max_texts: int = 256, attempts: int = 3, wait_seconds: float = 0.1, hot_rows: int = 100_000, salts: int = 64) -> DataFrame:
    """E1 + E2 for an embedder that is dear: each distinct missing text is embedded once, whatever its copies.

    The missing texts are counted by value (map-side), embedded in packed requests with bounded retries, and
    written; the rows then take their vector from that table by the text. A text of more than ``hot_rows`` rows is
    salted: its rows are dealt over ``salts`` keys and its vector is repeated for each, so no task takes all its
    copies. Rows that have a vector pass by the join."""
    ship_package(df.sparkSession)
    call = fn if fn is not None else _hash_batch(dim)
    need = needs_embedding(vec)
    todo = df.where(need).select(F.coalesce(_c(text).cast("string"), F.lit("")).alias("_text"))

    def run(batches):
        for rb in batches:
            texts = rb.column(0).to_pylist()
            out: list = [None] * len(texts)
            for at in requests(texts, max_bytes, max_texts):
                for i, v in zip(at, _asked(call, [texts[i] for i in at], attempts, wait_seconds)):
                    out[i] = None if v is None else np.asarray(v, dtype=np.float32)
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(out, pa.list_(pa.float32()))], names=["_text", "_rows", "_new"])

    counted = todo.groupBy("_text").agg(F.count(F.lit(1)).alias("_rows"))
    made = write_once(counted.mapInArrow(run, "_text string, _rows long, _new array<float>"))
    hot = made.where(F.col("_rows") > hot_rows).select("_text").withColumn("_hot", F.lit(True))  # few: each stands for hot_rows rows
    copies = made.withColumn("_salt", F.explode(F.when(F.col("_rows") > hot_rows, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    rows = df.withColumn("_text", F.when(need, F.coalesce(_c(text).cast("string"), F.lit(""))))
    with_salt = rows.join(F.broadcast(hot) if hot.count() * salts < 1 << 16 else hot, "_text", "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    filled = with_salt.where(F.col("_text").isNotNull()).join(copies.select("_text", "_salt", "_new"), ["_text", "_salt"], "left")
    had = with_salt.where(F.col("_text").isNull()).withColumn("_new", F.lit(None).cast("array<float>"))
    both = filled.unionByName(had.select(*filled.columns))
    return both.withColumn(vec, F.when(F.col("_text").isNotNull(), F.col("_new")).otherwise(F.col(vec).cast("array<float>"))).select(*df.columns)
