"""Hard negatives by exact inner-product search with length buckets and coordinate pruning.

Vectors become integers (floor of ``scale`` times a component), so every score is exact. Rows are dealt
into shards of bounded size and anchors into blocks; a shard meets a block in one task. There the rows,
longest first, form length buckets, and a bucket holds a sorted list per coordinate of its unit vectors. An
anchor with the score bound t can only match rows within the angle g = arccos(t / (|anchor| longest)), so
by each focus coordinate (its largest ones) only rows whose own angle to that axis is within g of
the anchor's: a range of the sorted list. The narrowest range is intersected with the other focus ranges, and
the rows left are verified by their exact score. The bound rises to the worst of the k best rows so far.

Two searches run this way: the anchor's best rows of its own label (positives), then for each positive
the best rows of other labels within a band of the positive's score. Each search first visits about
sqrt(shards) shards an anchor, merges what they give, and takes the worst of its k best as the starting bound
for all the others, so about 2 k sqrt(shards) rows an anchor and band are shuffled instead of k a shard.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part,
nor do components beyond 2**25 after scaling (their scores would leave a long); an empty vector scores 0 against
other empty ones, and vectors of unlike length never meet; a null vec_id is no anchor and comes last among ties;
rows with the anchor's vec_id are not its positives; repeated rows count one by one, and a repeated
anchor gives its rows again; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package

NO_ID = (1 << 63) - 1   # stands for a null vec_id: last among ties
FAR = 1 << 62           # beyond any score
SLACK = 1e-9            # on angles' cosines; scores themselves are integers


@dataclass(frozen=True)
class HardNegativeParams:
    scale: int = 256
    anchor_every: int = 100    # anchors: rows whose vec_id is divisible by this
    positives: int = 5
    negatives: int = 10
    low_pct: int = 30          # a negative's score in percent of the positive's
    high_pct: int = 90
    shard_rows: int = 8192     # rows of a shard, on average
    block_anchors: int = 1024  # anchors of a block, on average
    bucket_rows: int = 2048    # rows of a length bucket
    focus: int = 4             # focus coordinates of an anchor


class Bucket:
    """Rows of like length: integer vectors, unit coordinates and a sorted list per coordinate."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, length: np.ndarray):
        self.q, self.ids, self.longest, self.shortest = q, ids, float(length[0]), float(length[-1])
        unit = q / np.where(length > 0, length, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.lists = np.take_along_axis(unit, self.order, axis=0)
        self.rank = np.empty_like(self.order)
        np.put_along_axis(self.rank, self.order, np.arange(len(ids))[:, None], axis=0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, bound: float) -> np.ndarray | None:
        """Places of the rows in all focus ranges of an anchor; None if no row can reach the bound."""
        reach = length * (self.longest if bound >= 0 else self.shortest)
        if reach <= 0:
            return np.arange(len(self.ids)) if bound <= 0 else None
        cos = bound / reach
        if cos > 1 + SLACK:
            return None
        if cos <= -1:
            return np.arange(len(self.ids))
        angle = math.acos(min(1.0, cos))
        ranges = []
        for f in focus:
            own = math.acos(max(-1.0, min(1.0, unit[f])))
            low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            ranges.append((*np.searchsorted(self.lists[:, f], (low, high)), f))
        if not ranges:
            return np.arange(len(self.ids))
        ranges.sort(key=lambda r: r[1] - r[0])
        a, b, f = ranges[0]
        found = self.order[a:b, f]
        for a, b, f in ranges[1:]:
            if b - a < len(self.ids):
                at = self.rank[found, f]
                found = found[(at >= a) & (at < b)]
        return found

    def scores(self, anchor: np.ndarray, found: np.ndarray) -> np.ndarray:
        if 2 * len(found) > len(self.ids):
            return (self.q @ anchor)[found]
        return self.q[found] @ anchor


def buckets_of(q: np.ndarray, ids: np.ndarray, rows: int) -> list[Bucket]:
    length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    by = np.argsort(-length, kind="stable")
    return [Bucket(q[at], ids[at], length[at]) for at in (by[k:k + rows] for k in range(0, len(by), rows))]


def best_in_bands(buckets: list[Bucket], anchor: np.ndarray, own_id: int | None, bands: list[tuple[int, int]], k: int, focus: int) -> list[tuple]:
    """Per band (low, high): scores and ids of the k best rows within it, best first, ties by id."""
    length = math.sqrt(float((anchor.astype(np.float64) ** 2).sum()))
    unit = anchor / length if length else anchor.astype(np.float64)
    axes = np.argsort(-np.abs(unit), kind="stable")[:focus]
    best = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for _ in bands]
    bound = [low for low, _ in bands]
    for bucket in buckets:
        found = bucket.candidates(unit, axes, length, float(min(bound)))
        if found is None:
            continue
        s = bucket.scores(anchor, found).astype(np.int64)
        ids = bucket.ids[found]
        for j, (_, high) in enumerate(bands):
            keep = (s >= bound[j]) & (s <= high)
            if own_id is not None:
                keep &= ids != own_id
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            if len(at) > 4 * k:  # the k best scores, with all their ties
                at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
            both = np.r_[best[j][0], s[at]], np.r_[best[j][1], ids[at]]
            top = np.lexsort((both[1], -both[0]))[:k]
            best[j] = both[0][top], both[1][top]
            if len(top) == k:
                bound[j] = int(best[j][0][-1])
    return best


def _matrix(column, dim: int) -> np.ndarray:
    """Integer vectors as doubles where every score is exact in them, else as 64-bit integers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), dim)
    return x if x.size and int(np.abs(x).max()) ** 2 * dim >= 1 << 53 else x.astype(np.float64)


FOUND = pa.schema([("aid", pa.int64()), ("b", pa.int32()), ("id", pa.int64()), ("s", pa.int64())])
KEY = ("dim", "g", "block")


def _visit(rows: DataFrame, asked: DataFrame, k: int, same: bool, blocks: int, p: HardNegativeParams) -> DataFrame:
    """The k best rows of each visited shard, per anchor and band. ``same``: of the anchor's label, else of other labels."""
    def run(shard, asks):
        out = [[], [], [], []]
        if shard.num_rows and asks.num_rows:
            dim = asks.column("dim")[0].as_py()
            q, ids, label = _matrix(shard.column("q"), dim), shard.column("id").to_numpy(), np.array(shard.column("label").to_pylist(), dtype=object)
            a, mine = _matrix(asks.column("q"), dim), asks.column("label").to_pylist()
            if a.dtype != q.dtype:
                a, q = a.astype(np.int64), q.astype(np.int64)
            index = {}
            if not same:  # one index; an anchor's own label is told apart by a second one over the rest
                counts = dict(zip(*np.unique(label.astype(str), return_counts=True)))
            asked_rows = list(zip(*(asks.column(c).to_pylist() for c in ("aid", "id", "bands"))))
            for i in sorted(range(len(mine)), key=mine.__getitem__):  # by label, so that few indexes are held at once
                aid, vec_id, bands = asked_rows[i]
                name = mine[i] if same or mine[i] in counts else None
                if name not in index:
                    use = np.flatnonzero(label == name) if same else np.flatnonzero(label != name)
                    index[name] = buckets_of(q[use], ids[use], p.bucket_rows)
                best = best_in_bands(index[name], a[i], vec_id if same else None, [(x["lo"], x["hi"]) for x in bands], k, p.focus)
                for x, (s, found) in zip(bands, best):
                    out[0].append(np.full(len(s), aid, dtype=np.int64))
                    out[1].append(np.full(len(s), x["b"], dtype=np.int32))
                    out[2].append(found)
                    out[3].append(s)
                if len(index) > 2:
                    index.pop(next(k for k in index if k is not None))
        return pa.table([pa.array(np.concatenate(c) if c else np.empty(0), f.type) for c, f in zip(out, FOUND)], schema=FOUND)

    sent = rows.select("dim", "g", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "label", "q")
    asks = asked.select("dim", F.explode("visits").alias("g"), "block", "aid", "id", "label", "q", "bands")
    return sent.groupBy(*KEY).cogroup(asks.groupBy(*KEY)).applyInArrow(run, "aid long, b int, id long, s long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """rank from 1 of the k best rows per (aid, b); in two levels, so that no task ranks all shards' rows of one anchor."""
    order = (F.col("s").desc(), F.col("id"))
    part = Window.partitionBy("aid", "b", F.pmod(F.xxhash64("id"), F.lit(16))).orderBy(*order)
    whole = Window.partitionBy("aid", "b").orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k).drop("rank")
    return few.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)


def _search(rows: DataFrame, anchors: DataFrame, bands: DataFrame, k: int, same: bool, shards: int, blocks: int, p: HardNegativeParams) -> DataFrame:
    """(aid, b, id, s, rank): the k best rows of all shards within each band (aid, b, lo, hi)."""
    step = math.ceil(math.sqrt(shards)) if shards > 4 else 1

    def visit(asked_bands, first: bool):
        lists = asked_bands.groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("b", "lo", "hi"))).alias("bands"))
        turn = lambda g: F.pmod(g + F.xxhash64("aid"), F.lit(step)) == 0
        visits = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), turn if first else lambda g: ~turn(g))
        return materialize(_visit(rows, anchors.join(lists, "aid").withColumn("visits", visits), k, same, blocks, p))

    found = visit(bands, True)
    if step > 1:
        seeds = materialize(_ranked(found, k))
        worst = seeds.filter(F.col("rank") == k).select("aid", "b", F.col("s").alias("worst"))
        raised = bands.join(worst, ["aid", "b"], "left").select("aid", "b", F.greatest("lo", "worst").alias("lo"), "hi")
        found = seeds.drop("rank").unionByName(visit(raised, False))
    return _ranked(found, k)


def hard_negatives(vectors: DataFrame, p: HardNegativeParams = HardNegativeParams()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, from vec_id, label and embedding."""
    with_package(vectors.sparkSession)
    v = F.col("v")
    whole = F.transform(v, lambda x: F.floor(F.lit(float(p.scale)) * x))
    fits = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * p.scale < float(1 << 25)))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    usable = own.filter(F.coalesce(F.col("label").isNotNull() & fits, F.lit(False))).select(
        F.monotonically_increasing_id().alias("aid"), F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), "label", whole.cast("array<int>").alias("q"), F.size("v").alias("dim"),
        F.coalesce(F.col("vec_id") % p.anchor_every == 0, F.lit(False)).alias("is_anchor"))
    usable = materialize(usable)
    n, n_anchors = usable.agg(F.count(F.lit(1)), F.sum(F.col("is_anchor").cast("long"))).first()
    shards, blocks = max(1, -(-n // p.shard_rows)), max(1, -(-(n_anchors or 0) // p.block_anchors))
    deal = lambda of: F.pmod(F.xxhash64(F.col("aid"), F.lit(of)), F.lit(of)).cast("int")
    rows = usable.select("dim", deal(shards).alias("g"), "id", "label", "q")
    anchors = materialize(usable.filter("is_anchor").select("aid", "id", "label", "q", "dim", deal(blocks).alias("block")))

    every = anchors.select("aid", F.lit(0).alias("b"), F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi"))
    liked = _search(rows, anchors, every, p.positives, True, shards, blocks, p)
    score = F.col("positive_score")
    positives = materialize(liked.select("aid", F.col("rank").alias("b"), F.col("id").alias("positive_id"), F.col("s").alias("positive_score")).join(
        anchors.select("aid", F.col("id").alias("anchor_id")), "aid").select(
        "aid", "anchor_id", "b", "positive_id", "positive_score",
        # percent of a score below 0 give an empty band
        F.when(score >= 0, F.expr(f"({p.low_pct} * positive_score + 99) div 100")).alias("lo"),
        F.when(score >= 0, F.expr(f"({p.high_pct} * positive_score) div 100")).alias("hi")))
    bands = positives.filter("lo <= hi").select("aid", "b", "lo", "hi")
    found = _search(rows, anchors, bands, p.negatives, False, shards, blocks, p)
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.join(positives, ["aid", "b"]).select(
        "anchor_id", known("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("id").alias("negative_id"),
        "positive_score", F.col("s").alias("negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """The contract's labels: where vec_id is divisible by 7, the next of ten labels."""
    label = F.col("label")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))


ORACLE_SQL = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS s
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND len(a.q) = len(b.q) AND (a.label <> b.label OR a.vec_id IS DISTINCT FROM b.vec_id)),
p AS (SELECT r, anchor_id, vec_id AS positive_id, s AS positive_score, row_number() OVER (PARTITION BY r ORDER BY s DESC, vec_id NULLS LAST) AS b FROM s WHERE same),
n AS (SELECT p.*, s.vec_id AS negative_id, s.s AS negative_score, row_number() OVER (PARTITION BY p.r, p.b ORDER BY s.s DESC, s.vec_id NULLS LAST) AS rank
      FROM p JOIN s ON p.r = s.r AND NOT s.same AND p.b <= 5 AND 30 * p.positive_score <= 100 * s.s AND 100 * s.s <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
