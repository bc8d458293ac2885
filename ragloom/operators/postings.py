"""A stored inverted index over chunks: BM25 (X1) and hashed-token cosine (R8) that read matching postings only.

Written once per import, from one pass over the chunk texts::

    blocks    one row per ``block_chunks`` chunks: their keys, in tie-break order (a position is a rank)
    postings  one row per (term, block): positions, counts and lengths, with the block's best impact; sorted by term
    stats     one row per import: chunks and total length

A term is a word (``kind="words"``: length = words of the chunk) or a hashed-token bucket (``kind="buckets"``:
length = squared norm of the counts). Imports stand side by side (``index_id`` partitions): document frequencies
are sums of the postings' sizes and the mean length a sum over ``stats``, so no text is read again.

A search joins the questions' terms with the heads of the postings (no arrays) on the term, salted because a
frequent term has a head in every block, and adds up the heads' best impacts map-side: an upper bound for each
(question, block). Round 1 scores each question's most promising blocks and takes its k-th best score; round 2
scores only the blocks whose bound reaches it (and ``min_score``). A scoring task holds the postings of one block
for a group of questions; within it the terms are added best impact first, and once the rest cannot lift a new
chunk to the bound, they are looked up for the chunks still in the running only (max-score). Nothing is
broadcast but query-independent scalars, and no (question, chunk) pair leaves a task below its local top k.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.operators.embedding import arrow_tokens, md5_bucket
from ragloom.operators.search import check_query_ids, rank_within_query
from ragloom.session import checkpoint_dir, ship_package, write_once

# BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 9
SLACK = 1e-9


@dataclass(frozen=True)
class PostingParams:
    block_chunks: int = 1024
    salts: int = 16             # of the join of terms with posting heads
    group_queries: int = 1024   # questions of a scoring task, on average
    first_blocks: int = 4       # blocks that a question scores in round 1
    pushed_terms: int = 1000    # up to this many question terms are pushed into the scan as a filter


KEYS = "chunk_id string, doc_id string, chunk_index long"
POSTING = "term string, pos array<int>, tf array<int>, len array<int>, n int, max_tf int, min_len int, best double"


def _coded(texts: pa.Array, kind: str, dim: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row, code of the term) of every token, and the terms."""
    parent, toks = arrow_tokens(texts)
    if not len(toks):
        return parent, np.zeros(0, dtype=np.int64), []
    enc = pc.dictionary_encode(toks)
    codes, terms = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary.to_pylist()
    if kind == "words":
        return parent, codes, terms
    return parent, np.fromiter((md5_bucket(t, dim) for t in terms), dtype=np.int64, count=len(terms))[codes], [str(b) for b in range(dim)]


INDEX_ROW = pa.schema([("block", pa.int64()), ("total", pa.int64()),
                       ("keys", pa.list_(pa.struct([("chunk_id", pa.string()), ("doc_id", pa.string()), ("chunk_index", pa.int64())]))),
                       ("term", pa.string()), ("pos", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())), ("len", pa.list_(pa.int32())),
                       ("n", pa.int32()), ("max_tf", pa.int32()), ("min_len", pa.int32()), ("best", pa.float64())])
ROWS = 256  # index rows of one Arrow batch


def _block_rows(batch: pa.RecordBatch, block: int, kind: str, dim: int) -> Iterator[pa.RecordBatch]:
    """One index block: a row with its keys in tie-break order (no term), and one row per term."""
    order = pc.sort_indices(batch.select(["doc_id", "chunk_index", "chunk_id"]), sort_keys=[(c, "ascending") for c in ("doc_id", "chunk_index", "chunk_id")], null_placement="at_end")
    batch = batch.take(order)
    n = batch.num_rows
    row, code, terms = _coded(batch.column("content"), kind, dim)
    pairs, tf = np.unique(code * n + row, return_counts=True)  # by term, then position
    term, pos = pairs // n, pairs % n
    length = np.bincount(pos, weights=tf.astype(np.float64) ** 2 if kind == "buckets" else tf, minlength=n).astype(np.int64)
    keys = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.StructArray.from_arrays([batch.column(c) for c in ("chunk_id", "doc_id", "chunk_index")], ["chunk_id", "doc_id", "chunk_index"]))
    head = {"block": [block], "total": [int(length.sum())], "keys": keys, "n": [n]}
    yield pa.RecordBatch.from_arrays([pa.array(head.get(f.name, [None]), f.type) for f in INDEX_ROW], schema=INDEX_ROW)
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, dtype=np.int64)
    lens = length[pos]
    for lo in range(0, len(starts), ROWS):
        first = starts[lo:lo + ROWS]
        a, z = int(first[0]), int(starts[lo + ROWS]) if lo + ROWS < len(starts) else len(term)
        at = first - a
        lists = lambda x: pa.ListArray.from_arrays(pa.array(np.r_[at, z - a].astype(np.int32)), pa.array(x[a:z].astype(np.int32)))
        made = {"block": pa.array(np.full(len(at), block)), "term": pa.array([terms[c] for c in term[first]], pa.string()), "pos": lists(pos), "tf": lists(tf), "len": lists(lens),
                "n": np.diff(np.r_[at, z - a]).astype(np.int32), "max_tf": np.maximum.reduceat(tf[a:z], at).astype(np.int32), "min_len": np.minimum.reduceat(lens[a:z], at).astype(np.int32),
                "best": np.maximum.reduceat(tf[a:z] / np.sqrt(lens[a:z]), at)}
        yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else pa.nulls(len(at), f.type) for f in INDEX_ROW], schema=INDEX_ROW)


def write_postings(chunks: DataFrame, path: str, kind: str = "words", dim: int = 256, index_id: str | None = None, params: PostingParams = PostingParams()) -> str:
    """Add one import ``(chunk_id, doc_id, chunk_index, content)`` to the index at ``path`` and return its id."""
    if kind not in ("words", "buckets"):
        raise ValueError(f"kind must be 'words' or 'buckets', got {kind!r}")
    spark = chunks.sparkSession
    ship_package(spark)
    index_id = index_id or f"index-{uuid.uuid4().hex}"
    rows = chunks.select(F.col("chunk_id").cast("string"), F.col("doc_id").cast("string"), F.col("chunk_index").cast("long"), F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"))
    def run(batches):
        block, waiting, held = TaskContext.get().partitionId() << 32, [], 0

        def done(table):
            nonlocal block
            block += 1
            yield from _block_rows(table.combine_chunks().to_batches()[0], block, kind, dim)

        for b in batches:
            for at in range(0, b.num_rows, params.block_chunks):
                waiting.append(b.slice(at, params.block_chunks))
                held += waiting[-1].num_rows
                if held >= params.block_chunks:
                    table = pa.Table.from_batches(waiting)
                    yield from done(table.slice(0, params.block_chunks))
                    waiting, held = table.slice(params.block_chunks).to_batches(), held - params.block_chunks
        if held:
            yield from done(pa.Table.from_batches(waiting))

    # flat rows: a reader of Parquet holds thousands of rows of a column at a time, so no row may hold a block's postings
    made = write_once(rows.mapInArrow(run, f"block long, total long, keys array<struct<{KEYS.replace(' ', ':').replace(',:', ',')}>>, {POSTING}"))
    heads = made.where(F.col("term").isNull())
    heads.select("block", "n", "keys").write.mode("overwrite").parquet(f"{path}/blocks/index_id={index_id}")
    made.where(F.col("term").isNotNull()).drop("total", "keys").repartitionByRange("term", "block").sortWithinPartitions(
        "term", F.desc("best")).write.mode("overwrite").parquet(f"{path}/postings/index_id={index_id}")
    heads.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("chunks"), F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("total")).withColumn(
        "kind", F.lit(kind)).withColumn("dim", F.lit(dim)).write.mode("overwrite").parquet(f"{path}/stats/index_id={index_id}")
    return index_id


def _read(spark: SparkSession, path: str, part: str) -> DataFrame:
    schema = {"blocks": f"block long, n int, keys array<struct<{KEYS.replace(' ', ':').replace(',:', ',')}>>, index_id string",
              "postings": f"block long, {POSTING}, index_id string", "stats": "chunks long, total long, kind string, dim int, index_id string"}[part]
    return spark.read.schema(schema).parquet(f"{path}/{part}")


def question_terms(queries: DataFrame, question: str, kind: str, dim: int) -> DataFrame:
    """(query_id, term, tf) of every question, by the tokeniser that made the index."""
    ship_package(queries.sparkSession)
    id_type = queries.schema["query_id"].dataType.simpleString()

    def run(batches):
        for rb in batches:
            row, code, terms = _coded(pc.fill_null(rb.column(1), ""), kind, dim)
            k = max(1, len(terms))
            pairs, tf = np.unique(row * k + code, return_counts=True)
            yield pa.RecordBatch.from_arrays([rb.column(0).take(pa.array(pairs // k)), pa.array([terms[c] for c in pairs % k], pa.string()), pa.array(tf.astype(np.int32))],
                                             names=["query_id", "term", "tf"])

    return queries.select("query_id", F.col(question).cast("string")).mapInArrow(run, f"query_id {id_type}, term string, tf int")


@dataclass(frozen=True)
class Weighting:
    """How a posting adds to a score: BM25, or (``buckets``) the integer product of counts."""

    kind: str
    avg: float
    k1: float = BM25_K1
    b: float = BM25_B

    def impact(self, tf, length, w) -> np.ndarray:
        if self.kind == "buckets":
            return tf.astype(np.float64) * w
        return w * (tf * (self.k1 + 1)) / (tf + self.k1 * (1 - self.b + self.b * length / self.avg))


def score_block(lists: dict, size: int, terms: list, norm: float, bound: float, k: int, by: Weighting) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of a block's k best chunks for one question. lists: term -> (pos, tf, len, best possible
    impact per weight); terms: (term, w). ``bound``: chunks below it are not wanted (bounds are in score units)."""
    mine = sorted(((w * lists[t][3], w, lists[t]) for t, w in terms if t in lists), key=lambda x: -x[0])
    rest = np.r_[np.cumsum([x[0] for x in mine][::-1])[::-1], 0.0] / norm  # what the terms from here on can add, at most
    acc, length = np.zeros(size), np.zeros(size)
    alive = None  # positions still in the running, once no new chunk can reach the bound
    for i, (_, w, (pos, tf, lens, _)) in enumerate(mine):
        if alive is None and rest[i] * (1 + SLACK) < bound - SLACK:
            alive = np.flatnonzero(acc)
        if alive is not None:
            now = acc[alive] / (norm * np.sqrt(length[alive])) if by.kind == "buckets" else acc[alive]
            alive = alive[now + rest[i] * (1 + SLACK) >= bound - SLACK]
            if not len(alive):
                return alive, np.zeros(0)
            at = np.searchsorted(pos, alive)
            hit = (at < len(pos)) & (pos[np.minimum(at, len(pos) - 1)] == alive)
            pos, tf, lens = alive[hit], tf[at[hit]], lens[at[hit]]
        acc[pos] += by.impact(tf, lens, w)
        length[pos] = lens
    at = np.flatnonzero(acc) if alive is None else alive
    s = acc[at]
    if by.kind == "buckets":
        s = s / (norm * np.sqrt(length[at]))
    else:
        s = np.round(s, SCORE_DIGITS)
    keep = s >= bound - SLACK
    at, s = at[keep], s[keep]
    top = np.lexsort((at, -s))[:k]
    return at[top], s[top]


def search_postings(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, *, question: str = "question", min_score: float | None = None,
                    k1: float = BM25_K1, b: float = BM25_B, params: PostingParams = PostingParams()) -> DataFrame:
    """Top-k chunks per question: ``query_id, chunk_id, doc_id, chunk_index, score, rank`` (BM25 or cosine, as the index was written).

    A question without terms has no hits; a null or repeated query_id is an error, as in the other searches."""
    p = params
    ship_package(spark)
    n_queries = check_query_ids(queries, "query_id")
    stats = _read(spark, path, "stats").agg(F.sum("chunks"), F.sum("total"), F.first("kind"), F.first("dim")).first()  # one row
    n_chunks, kind, dim = stats[0] or 0, stats[2] or "words", stats[3] or 1
    avg = (stats[1] / n_chunks if n_chunks and stats[1] else 1.0)
    by = Weighting(kind, avg, k1, b)
    asked = write_once(question_terms(queries, question, kind, dim))
    terms = asked.select("term").distinct()
    few = [r[0] for r in terms.limit(p.pushed_terms + 1).collect()]
    postings = _read(spark, path, "postings")
    if len(few) <= p.pushed_terms:
        postings = postings.where(F.col("term").isin(few))  # skips row groups: the files are sorted by term
    else:
        postings = postings.join(terms, "term", "left_semi")
    heads = write_once(postings.select("index_id", "block", "term", "n", "max_tf", "min_len", "best"))
    if kind == "words":
        df = heads.groupBy("term").agg(F.sum("n").cast("double").alias("df"))
        weighted = asked.join(df, "term").select("query_id", "term", F.log((F.lit(float(n_chunks)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0).alias("w")).withColumn("norm", F.lit(1.0))
        top_impact: Column = F.col("max_tf") * (k1 + 1) / (F.col("max_tf") + k1 * (1 - b + b * F.col("min_len") / F.lit(avg)))
    else:
        norms = asked.groupBy("query_id").agg(F.sqrt(F.sum(F.col("tf").cast("double") * F.col("tf"))).alias("norm"))
        weighted = asked.join(norms, "query_id").select("query_id", "term", F.col("tf").cast("double").alias("w"), "norm")
        top_impact = F.col("best")
    weighted = write_once(weighted)
    salted = heads.select("index_id", "block", "term", top_impact.alias("top"), F.pmod(F.xxhash64("index_id", "block"), F.lit(p.salts)).cast("int").alias("salt"))
    every = weighted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))))
    bounds = salted.join(every, ["term", "salt"]).groupBy("query_id", "index_id", "block").agg((F.sum(F.col("top") * F.col("w")) / F.first("norm")).alias("most"))
    if min_score is not None:
        bounds = bounds.where(F.col("most") >= min_score - SLACK)
    bounds = write_once(rank_within_query(bounds.withColumnRenamed("most", "score"), None, ["index_id", "block"]).withColumnRenamed("score", "most").withColumnRenamed("rank", "place"))

    whole = weighted.groupBy("query_id", "norm").agg(F.collect_list(F.struct("term", "w")).alias("terms"))  # one question's terms
    groups = max(1, -(-n_queries // p.group_queries))
    key = ["index_id", "block", "_group"]
    key_type = f"array<struct<{KEYS.replace(' ', ':').replace(',:', ',')}>>"
    id_type = queries.schema["query_id"].dataType.simpleString()
    floor = float("-inf") if min_score is None else min_score
    out = pa.schema([("at", pa.int64()), ("chunk_id", pa.string()), ("doc_id", pa.string()), ("chunk_index", pa.int64()), ("score", pa.float64())])

    def score(block: pa.Table, asks: pa.Table) -> pa.Table:
        lists, keys = {}, None
        for held in block.column("keys").drop_null().to_pylist():
            keys = held
        arrays = {c: block.column(c).combine_chunks() for c in ("pos", "tf", "len")}
        for i, (t, max_tf, min_len, best) in enumerate(zip(*(block.column(c).to_pylist() for c in ("term", "max_tf", "min_len", "best")))):
            if t is not None:
                pos, tf, lens = (arrays[c][i].values.to_numpy() for c in ("pos", "tf", "len"))
                top = best if kind == "buckets" else float(by.impact(np.array([max_tf]), np.array([min_len]), 1.0)[0])
                lists[t] = (pos, tf, lens, top)
        rows, found = [], []
        for i, (terms_, norm, bound) in enumerate(zip(*(asks.column(c).to_pylist() for c in ("terms", "norm", "bound")))):
            if keys:
                at, s = score_block(lists, len(keys), [(x["term"], x["w"]) for x in terms_], norm, bound, k, by)
                rows += [i] * len(at)
                found += [(keys[a], v) for a, v in zip(at.tolist(), s.tolist())]
        ids = asks.column("query_id").take(pa.array(rows, pa.int64()))
        cols = [pa.array([x[c] for x, _ in found], out.field(c).type) for c in ("chunk_id", "doc_id", "chunk_index")]
        return pa.table([ids, *cols, pa.array([v for _, v in found], pa.float64())], names=["query_id", "chunk_id", "doc_id", "chunk_index", "score"])

    empty = {"term": "string", "pos": "array<int>", "tf": "array<int>", "len": "array<int>", "max_tf": "int", "min_len": "int", "best": "double"}

    def scored(pairs: DataFrame) -> DataFrame:
        """Candidates of the (query_id, index_id, block, bound) pairs."""
        pairs = write_once(pairs.withColumn("_group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")))
        to = pairs.select(*(F.col(c).alias(c) for c in key)).distinct()  # columns of their own: both sides come from ``pairs``
        lists = postings.select("index_id", "block", *empty).join(to, ["index_id", "block"]).withColumn("keys", F.lit(None).cast(key_type))
        heads_ = _read(spark, path, "blocks").select("index_id", "block", "keys").join(to, ["index_id", "block"]).select(
            "index_id", "block", *(F.lit(None).cast(t).alias(c) for c, t in empty.items()), "_group", "keys")
        asks = pairs.join(whole, "query_id")
        return lists.select(*heads_.columns).union(heads_).groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(
            score, f"query_id {id_type}, {KEYS}, score double")

    order = ["doc_id", "chunk_index", "chunk_id"]
    first = write_once(rank_within_query(scored(bounds.where(F.col("place") <= p.first_blocks).select("query_id", "index_id", "block", F.lit(floor).alias("bound"))), k, order))
    kth = first.where(F.col("rank") == k).select(F.col("query_id"), F.col("score").alias("kth"))
    later = bounds.where(F.col("place") > p.first_blocks).join(kth, "query_id", "left").withColumn("bound", F.coalesce("kth", F.lit(floor)))
    rest = scored(later.where(F.col("most") * (1 + SLACK) >= F.col("bound") - 2 * SLACK).select("query_id", "index_id", "block", "bound"))
    return rank_within_query(first.drop("rank").unionByName(rest), k, order)


def index_chunks(chunks: DataFrame, kind: str = "words", dim: int = 256, params: PostingParams = PostingParams()) -> str:
    """A new index of ``chunks`` in the shared checkpoint folder; its path."""
    path = f"{checkpoint_dir(chunks.sparkSession).rstrip('/')}/postings-{uuid.uuid4().hex}"
    write_postings(chunks, path, kind, dim, params=params)
    return path
