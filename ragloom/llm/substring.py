r"""Substring dedup: FM-indexes over the passages that documents may share.

Words are 64-bit hashes. Every window of ``window`` words picks its smallest ``gram``-word hash as its
anchor, so equal windows pick equal anchors; consecutive windows of one anchor form a segment of
the document. Only anchors of two or more doc_ids go on. Their distinct segments (one row for any
number of copies, owned by the smallest doc_id) are dealt by anchor into shards of bounded size. Each
shard builds an FM-index and streams its segments through it: backward search over the wavelet levels
gives the matching statistics, and every full-length match reports the smallest owner. A word goes if
a window that covers it has an owner with a smaller doc_id.

An anchor with more than ``shard_segments`` distinct segments is dealt again: its segments are cut by the
smallest hash of twice as many words, and in the last round by the windows themselves, of which a group
holds one. Equal windows meet in every round, all groups go through the FM-index, and none outgrows a shard.

A very long text is read whole; its segments are rows of their own.

Defined results: a null or blank text has no words and loses none; texts below ``window`` words lose
none; rows without a doc_id come after all others and lose what those hold, none among themselves;
repeated rows are treated alike; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package
from ragloom.llm.fmindex import DEPTH, FMIndex

NO_ID = 2**63 - 1
BASE, BASE2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd


@dataclass(frozen=True)
class SubstringParams:
    window: int = 50
    gram: int = 16                 # a power of two, below the window
    shard_words: int = 1 << 17     # words of an FM-index, but for a single anchor with more
    shard_segments: int = 1 << 10  # distinct segments of one anchor; beyond: dealt again by longer grams


def word_hashes(text: str | None) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in (text or "").encode("utf-8").split()], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * BASE2
    return x ^ (x >> np.uint64(29))


def _sums(h: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of h[i] * base**i (mod 2**64) and the powers of base's inverse."""
    n = len(h)
    powers = np.cumprod(np.r_[np.uint64(1), np.full(n, base, dtype=np.uint64)])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    back = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, dtype=np.uint64)])
    return np.r_[np.uint64(0), np.cumsum(h * powers[:n], dtype=np.uint64)], back


def _runs(h: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Hashes of the word runs [start, end)."""
    sums, back = _sums(h, base)
    return _mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    h, out = 1, x
    while h * 2 <= width:
        out = np.minimum(out[:-h], out[h:])
        h *= 2
    return np.minimum(out[:len(out) - (width - h)], out[width - h:]) if width > h else out


def segments(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows) of each segment of a document."""
    if len(h) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    g, size = h, 1
    while size < gram:
        g = _mix(g[:-size] * BASE + g[size:])
        size *= 2
    return _by_smallest(g, window - gram + 1)


def _by_smallest(g: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of ``width`` grams that share their smallest gram: its hash, first window, windows."""
    key = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)  # ties: the leftmost
    anchor = (_sliding_min(key, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return g[anchor[first]], first, np.diff(np.r_[first, len(anchor)])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _docs(docs: DataFrame) -> DataFrame:
    """did: the doc_id, for ordering; th with it names a row's content."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"),
                       F.xxhash64("text").alias("th"), "text")


def occurrences(docs: DataFrame, p: SubstringParams) -> DataFrame:
    """All segments: anchor, seg (content hash), did, th, s0 (first window), nw (windows)."""
    def run(batches):
        for b in batches:
            cols = [[] for _ in range(6)]
            for did, th, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                h = word_hashes(text.as_py())
                anchor, s0, nw = segments(h, p.window, p.gram)
                if len(anchor):
                    for c, x in zip(cols, (anchor, _runs(h, s0, s0 + nw + p.window - 1), np.full(len(s0), did), np.full(len(s0), th), s0, nw)):
                        c.append(x)
            if cols[0]:
                a = [np.concatenate(c) for c in cols]
                yield pa.RecordBatch.from_arrays(
                    [_signed(a[0]), _signed(a[1]), pa.array(a[2], pa.int64()), pa.array(a[3], pa.int64()),
                     pa.array(a[4].astype(np.int32)), pa.array(a[5].astype(np.int32))], names=["anchor", "seg", "did", "th", "s0", "nw"])

    return docs.mapInArrow(run, "anchor long, seg long, did long, th long, s0 int, nw int")


def _contents(docs: DataFrame, wanted: DataFrame, p: SubstringParams) -> DataFrame:
    """The word hashes of each wanted segment, cut from its owner's text."""
    asked = wanted.groupBy("did", "th").agg(F.collect_list(F.struct("anchor", "seg", "s0", "nw")).alias("ask"))

    def run(batches):
        for b in batches:
            out = [[], [], [], []]
            for did, text, ask in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                h = word_hashes(text.as_py())
                for a in ask:
                    for c, x in zip(out, (a["anchor"], a["seg"], did, h[a["s0"]:a["s0"] + a["nw"] + p.window - 1].tobytes())):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())],
                                             names=["anchor", "seg", "did", "words"])

    one = docs.join(asked, ["did", "th"]).select("did", "text", "ask")
    return one.mapInArrow(run, "anchor long, seg long, did long, words binary").dropDuplicates(["anchor", "seg"])


def match_runs(lengths: np.ndarray, owners: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """Runs (first, last, owner) of full-length matches with one owner."""
    full = np.flatnonzero(lengths >= limit)
    if not len(full):
        return []
    new = np.flatnonzero(np.r_[True, (np.diff(full) > 1) | (owners[full][1:] != owners[full][:-1])])
    last = np.r_[new[1:] - 1, len(full) - 1]
    return [(int(full[a]), int(full[b]), int(owners[full[a]])) for a, b in zip(new, last)]


def _matches(contents: DataFrame, p: SubstringParams) -> DataFrame:
    """Per distinct segment the runs of windows with their smallest owner, from a shard's FM-index."""
    def shard(rows):
        texts = [np.frombuffer(w, dtype=np.uint64) for *_, w in rows]
        index = FMIndex(texts, np.array([r[2] for r in rows], dtype=np.int64), p.window)
        out = []
        for at in range(0, len(rows), 1 << 14):
            part = texts[at:at + (1 << 14)]
            length, owner = index.matching(part)
            ends = np.cumsum([len(t) for t in part])
            for (anchor, seg, *_), a, b in zip(rows[at:], np.r_[0, ends[:-1]], ends):
                out += [(anchor, seg, *r) for r in match_runs(length[a:b], owner[a:b], p.window)]
        cols = list(zip(*out)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                                           pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64())],
                                          names=["anchor", "seg", "j0", "j1", "owner"])

    def run(batches):
        rows, words = [], 0
        for b in batches:
            for r in zip(*(b.column(k).to_pylist() for k in range(4))):
                if words >= p.shard_words and r[0] != rows[-1][0]:
                    yield shard(rows)
                    rows, words = [], 0
                rows.append(r)
                words += len(r[3]) // 8 + 1
        if rows:
            yield shard(rows)

    return (contents.repartition("anchor").sortWithinPartitions("anchor", "seg")
            .mapInArrow(run, "anchor long, seg long, j0 int, j1 int, owner long"))


def _parts(contents: DataFrame, gram: int, p: SubstringParams) -> DataFrame:
    """Segments cut by their smallest ``gram``-word hash: anchor, seg, at (the part's first window), anchor2, seg2, did, words."""
    def run(batches):
        for b in batches:
            out = [[] for _ in range(7)]
            for anchor, seg, did, w in zip(*(b.column(k).to_pylist() for k in range(4))):
                h = np.frombuffer(w, dtype=np.uint64)
                j = np.arange(len(h) - gram + 1)
                key, s0, nw = _by_smallest(_runs(h, j, j + gram), p.window - gram + 1)
                ends = s0 + nw + p.window - 1
                key = _mix(key * BASE + np.array([anchor], dtype=np.int64).view(np.uint64))
                for c, x in zip(out, ([anchor] * len(s0), [seg] * len(s0), s0.tolist(), key.view(np.int64).tolist(),
                                      _runs(h, s0, ends).view(np.int64).tolist(), [did] * len(s0), [h[i:k].tobytes() for i, k in zip(s0, ends)])):
                    c += x
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["anchor", "seg", "at", "anchor2", "seg2", "did", "words"])

    return contents.mapInArrow(run, "anchor long, seg long, at int, anchor2 long, seg2 long, did long, words binary")


def _all_matches(contents: DataFrame, p: SubstringParams, grams: list[int]) -> DataFrame:
    """``_matches`` of all anchors; one with too many segments is dealt again by the next of ``grams``."""
    wide = materialize(contents.groupBy("anchor").count().filter(F.col("count") > p.shard_segments).select("anchor"))
    if not grams or wide.isEmpty():
        return _matches(contents, p)
    parts = materialize(_parts(contents.join(wide, "anchor", "left_semi"), grams[0], p))
    distinct = parts.groupBy("anchor2", "seg2").agg(F.min(F.struct("did", "words")).alias("own"))
    below = _all_matches(materialize(distinct.select(F.col("anchor2").alias("anchor"), F.col("seg2").alias("seg"), "own.*")), p, grams[1:])
    below = materialize(below.withColumnsRenamed({"anchor": "anchor2", "seg": "seg2"}))
    back = parts.select("anchor", "seg", "at", "anchor2", "seg2").join(below, ["anchor2", "seg2"]).select(
        "anchor", "seg", (F.col("j0") + F.col("at")).alias("j0"), (F.col("j1") + F.col("at")).alias("j1"), "owner")
    return _matches(contents.join(wide, "anchor", "left_anti"), p).union(back)


def repeated_ranges(docs: DataFrame, p: SubstringParams = SubstringParams()) -> DataFrame:
    """Word ranges to remove: did, th, ranges array<struct<a int, b int>> (end exclusive), from ``_docs``."""
    if p.window >= DEPTH:
        raise ValueError(f"windows of up to {DEPTH - 1} words")
    with_package(docs.sparkSession)
    found = materialize(occurrences(docs, p))
    # written, so that both sides of the join are exchanges of their own and a hot anchor can be split
    shared = materialize(found.groupBy("anchor").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).filter("lo < hi").select("anchor"))
    found = materialize(found.join(shared, "anchor"))
    owned = found.groupBy("anchor", "seg").agg(F.min(F.struct("did", "th", "s0", "nw")).alias("own")).select("anchor", "seg", "own.*")
    contents = materialize(_contents(docs, owned, p))
    matches = _all_matches(contents, p, [g for g in (2 * p.gram,) if g < p.window] + [p.window])
    hits = found.join(matches, ["anchor", "seg"]).filter("owner < did").select(
        "did", "th", F.struct((F.col("s0") + F.col("j0")).alias("a"), (F.col("s0") + F.col("j1") + p.window).alias("b")).alias("r"))
    return hits.groupBy("did", "th").agg(F.collect_set("r").alias("ranges"))


def kept_words(text: str | None, ranges) -> tuple[list[bytes], int]:
    """The words outside all ranges, and how many there were."""
    words = (text or "").encode("utf-8").split()
    if not ranges:
        return words, len(words)
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for r in ranges:
        gone[r["a"]] += 1
        gone[r["b"]] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return [w for w, k in zip(words, keep) if k], len(words)


def substring_report(docs: DataFrame, p: SubstringParams = SubstringParams()) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space)."""
    own = _docs(docs)
    ranges = repeated_ranges(own, p)

    def run(batches):
        for b in batches:
            n, gone, sha = [], [], []
            for text, rs in zip(b.column(1), b.column(2).to_pylist()):
                kept, total = kept_words(text.as_py(), rs)
                n.append(total)
                gone.append(total - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            did = b.column(0)
            yield pa.RecordBatch.from_arrays([did, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return (own.join(ranges, ["did", "th"], "left").select(F.when(F.col("did") != NO_ID, F.col("did")).alias("doc_id"), "text", "ranges")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, p: SubstringParams = SubstringParams()) -> DataFrame:
    """The documents without their repeated words; all columns stay, ``n_chars`` follows the text if it is there.

    A text that loses words becomes its kept words joined by one space; any other text stays as it is.
    No document is dropped, one that loses all its words becomes empty."""
    ranges = repeated_ranges(_docs(docs), p)
    with_package(docs.sparkSession)

    r = ranges.select(F.col("did").alias("_did"), F.col("th").alias("_th"), F.col("ranges").alias("_ranges"))
    out = docs.join(r, (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == r["_did"]) & (F.xxhash64(docs["text"]) == r["_th"]), "left")
    out = out.select(*[docs[c] for c in docs.columns], "_ranges")
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            cut = [t.as_py() if not rs else b" ".join(kept_words(t.as_py(), rs)[0]).decode("utf-8")
                   for t, rs in zip(b.column(at), b.column(b.num_columns - 1).to_pylist())]
            cols = [b.column(k) for k in range(b.num_columns - 1)]
            cols[at] = pa.array(cut, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=docs_names)

    docs_names = docs.columns
    out = out.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, doc_id, i, array_to_string(ws[i:i+49], ' ') AS k FROM (SELECT rid, doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM d)),
m AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT rid, i + j AS pos FROM w JOIN m USING (k), (SELECT unnest(generate_series(0, 49)) AS j) WHERE least < doc_id),
x AS (SELECT rid, list(pos) AS gone FROM g GROUP BY rid),
y AS (SELECT doc_id, ws, CASE WHEN gone IS NULL THEN ws ELSE list_transform(list_filter(generate_series(1, len(ws)),
        lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END AS kept FROM d LEFT JOIN x USING (rid))
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM y
"""
