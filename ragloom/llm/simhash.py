"""SimHash near-dedup with the generalised pigeonhole principle.

Every document gets a 64-bit fingerprint of its word shingles (Arrow batches); equal fingerprints
are one class from then on. The bits are put into partitions so that correlated bits stand
together. Two fingerprints within ``max_bits`` agree up to t_i bits in some partition i whenever
sum(t_i + 1) = max_bits + 1; dynamic programming picks the t_i (-1 leaves a partition out) of least
estimated candidates from the partitions' value counts. Fingerprints meet in buckets (partition
value, and its neighbours up to t_i flipped bits) and are verified bit by bit.

A bucket above ``bucket_rows`` is never cut: it is split again by the pigeonhole principle over its
remaining bits, until it is small or its remaining bits bound its size. A bucket emits at most one
edge a row (its local components), never all pairs.

Defined results: null and blank texts get fingerprint zero, linked like any other; a very long text has one
fingerprint of all its shingles; rows with a null doc_id take part, their id never names a component unless no
other id is there (then null); repeated rows share a class; an empty table gives an empty result; other
columns are left alone, whatever their names. What ``keep_one`` does with ids that clash is stated there.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package
from ragloom.llm.graph import components

BITS = 64


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 3
    max_bits: int = 3
    seed: int = 42
    partitions: int = 4
    bucket_rows: int = 4096


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Bit j is 1 if it is set in over half of the shingles' XXH64 values. A-Z are lowered."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII lowering, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        hashes = [digest(joined[a:b - 1], seed) for a, b in zip([0, *ends], ends[shingle - 1:])]
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at:at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, p: SimHashParams = SimHashParams(), key: str | None = None) -> DataFrame:
    """(doc_id, fp): fp as a signed long; with ``key``, that long column too, as row."""
    with_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), p.shingle, p.seed) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.array(fps, dtype=np.uint64).view(np.int64), pa.int64())], names=names)

    own = [F.col("doc_id").cast("long").alias("doc_id"), *([F.col(key).alias("row")] if key else [])]
    names = ["doc_id", "row", "fp"] if key else ["doc_id", "fp"]
    return docs.select("text", *own).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlations(classes: DataFrame) -> np.ndarray:
    """64 x 64 correlations over all distinct fingerprints; a task sends its 64 x 64 sums."""
    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            if b.num_rows:
                x = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
                total += x.T @ x
                n += len(x)
        if n:
            i, j = np.triu_indices(BITS)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j]),
                                              pa.array(np.full(len(i), n), pa.int64())], names=["i", "j", "s", "n"])

    rows = classes.select("fp").mapInArrow(run, "i int, j int, s double, n long").groupBy("i", "j").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # 2080 rows
    both, n = np.zeros((BITS, BITS)), 1
    for r in rows:
        both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["s"]
        n = r["n"]
    both /= n
    mean = np.diag(both).copy()
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return (both - np.outer(mean, mean)) / np.outer(sd, sd)


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width; each group grows by the bit most correlated with it."""
    left, out = set(range(BITS)), []
    strength = np.abs(corr)
    for k in range(parts):
        width = (len(left) + parts - k - 1) // (parts - k)
        order = sorted(left)
        pairs = [(strength[i, j], -i, -j) for i, j in combinations(order, 2)]
        group = [-max(pairs)[1], -max(pairs)[2]] if width > 1 and pairs else order[:1]
        while len(group) < width:
            group.append(max((strength[b, group].mean(), -b) for b in left - set(group))[1] * -1)
        left -= set(group)
        out.append(sorted(group))
    return out


def flips(bits: list[int], t: int) -> list[int]:
    """XOR masks of at most ``t`` of the bits, the zero mask first."""
    return [sum(1 << b for b in c) for k in range(t + 1) for c in combinations(bits, k)]


def estimated_candidates(counts: np.ndarray, width: int, t: int) -> float:
    """Pairs that meet when values within ``t`` bits are probed, from the counts of all 2**width values."""
    values = np.arange(len(counts))
    return float(sum(np.dot(counts, counts[values ^ m]) for m in flips(list(range(width)), t)))


def allocate(costs: list[list[float]], max_bits: int) -> list[int]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1 of least total cost; costs[i][e]: cost of t_i = e - 1."""
    best = {0: (0.0, [])}
    for cost in costs:
        step = {}
        for used, (total, chosen) in best.items():
            for e, c in enumerate(cost):
                if used + e <= max_bits + 1 and (used + e not in step or total + c < step[used + e][0]):
                    step[used + e] = (total + c, [*chosen, e - 1])
        best = step
    return best[max_bits + 1][1]


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def plan_partitions(classes: DataFrame, p: SimHashParams) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed."""
    groups = group_bits(bit_correlations(classes), p.partitions)
    rows = classes.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(_mask(g)))) for g in groups]))
                          ).groupBy("pos", "col").count().toArrow()  # at most partitions x 2**16 rows
    pos, col, n = (rows.column(k).to_numpy() for k in range(3))
    total, costs = max(1, int(n[pos == 0].sum())), []
    for k, g in enumerate(groups):
        counts = np.zeros(1 << len(g))
        bits = _bits(col[pos == k].astype(np.int64))[:, g].astype(np.int64)
        np.add.at(counts, bits @ (1 << np.arange(len(g))), n[pos == k])
        # threshold 2 and above would probe hundreds of values a fingerprint: priced by its probes
        costs.append([0.0, *(estimated_candidates(counts, len(g), t) + total * len(flips(g, t)) for t in (0, 1)),
                      *(1e6 * total * (t + 1) for t in range(2, p.max_bits + 1))])
    return [(g, t) for g, t in zip(groups, allocate(costs, p.max_bits)) if t >= 0]


def _contract(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (smallest member) after joining the rows a[i] and b[i]."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def bucket_edges(key: np.ndarray, fps: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket; star edges of each bucket's components over the verified links."""
    n = len(fps)
    label = np.arange(n)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.r_[starts[1:], n]
    size = ends - starts
    last = np.repeat(ends, size)
    wide = np.repeat(size > 64, size)
    rows = np.flatnonzero(~wide)
    d = 1
    while len(rows):  # neighbours at distance d inside small buckets
        rows = rows[rows + d < last[rows]]
        ok = (np.bitwise_count(fps[rows] ^ fps[rows + d]) <= max_bits) & ~(probe[rows] & probe[rows + d])
        label = _contract(label, rows[ok], rows[ok] + d)
        d += 1
    for s, e in zip(starts[size > 64], ends[size > 64]):
        for at in range(s, e, 512):
            i, j = np.nonzero(np.bitwise_count(fps[at:min(at + 512, e), None] ^ fps[None, s:e]) <= max_bits)
            i, j = i + at, j + s
            ok = (i < j) & ~(probe[i] & probe[j])
            label = _contract(label, i[ok], j[ok])
    linked = np.flatnonzero(label != np.arange(n))
    return fps[linked], fps[label[linked]]


def _verify(rows: DataFrame, p: SimHashParams) -> DataFrame:
    """Edges (a, b) between fingerprints of one bucket; rows(mask, value, fp, probe)."""
    def run(batches):
        held = None
        for b in _then_none(batches):
            if b is None:
                part, held = held, None
            else:
                cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
                cols = [cols[0].astype(np.int64), cols[1].astype(np.int64), cols[2].astype(np.int64).view(np.uint64), cols[3].astype(bool)]
                part = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
                same = (part[0] == part[0][-1]) & (part[1] == part[1][-1])
                cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
                held, part = [x[cut:] for x in part], [x[:cut] for x in part]  # the last bucket may go on
            if part is None or not len(part[0]):
                continue
            key = np.cumsum(np.r_[0, (part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])])
            a, c = bucket_edges(key, part[2], part[3], p.max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(c.view(np.int64))], names=["a", "b"])

    return (rows.select("mask", "value", "fp", "probe").repartition("mask", "value").sortWithinPartitions("mask", "value")
            .mapInArrow(run, "a long, b long"))


def _then_none(batches):
    for b in batches:
        if b.num_rows:
            yield b
    yield None


def _refine(rows: DataFrame, masks: list[int], p: SimHashParams) -> tuple[DataFrame, list[int]]:
    """Split buckets over max_bits + 1 blocks of their remaining bits: near pairs agree on one block."""
    pairs, out = [], []
    for m in masks:
        rest = [b for b in range(BITS) if not m >> b & 1]
        blocks = [_mask(rest[k::p.max_bits + 1]) for k in range(p.max_bits + 1)]
        out += [m | x for x in blocks]
        pairs += [F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in blocks])]
    rows = rows.select("mask", "value", "fp", "probe", F.explode(F.element_at(F.create_map(*pairs), F.col("mask"))).alias("block"))
    return rows.select(F.col("mask").bitwiseOR(F.col("block")).alias("mask"),
                       F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.col("block"))).alias("value"), "fp", "probe"), sorted(set(out))


def near_pairs(classes: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """Edges (a, b) over distinct fingerprints whose components are those of all links within max_bits."""
    with_package(classes.sparkSession)
    rows = None
    masks = []
    for g, t in plan_partitions(classes, p):
        mask, fp = _mask(g), F.col("fp")
        masks.append(mask)
        own = fp.bitwiseAND(F.lit(_signed(mask)))
        part = classes.select(F.lit(_signed(mask)).alias("mask"), own.alias("value"), fp, F.lit(False).alias("probe"))
        if t > 0:
            part = part.union(classes.select(
                F.lit(_signed(mask)).alias("mask"),
                F.explode(F.array(*[own.bitwiseXOR(F.lit(_signed(m))) for m in flips(g, t)[1:]])).alias("value"), fp, F.lit(True).alias("probe")))
        rows = part if rows is None else rows.union(part)
    edges = None
    while rows is not None:
        sizes = materialize(rows.groupBy("mask", "value").count().filter(F.col("count") > p.bucket_rows))
        hot = sizes.count() > 0 and any(bin(m).count("1") < BITS - 12 for m in masks)
        small = rows.join(sizes.drop("count"), ["mask", "value"], "left_anti") if hot else rows
        found = _verify(small, p)
        edges = found if edges is None else edges.union(found)
        rows, masks = _refine(rows.join(sizes.drop("count"), ["mask", "value"], "left_semi"), masks, p) if hot else (None, [])
    return edges


def class_components(classes: DataFrame, p: SimHashParams) -> DataFrame:
    """``classes`` (one row per distinct fp) with the component of each fingerprint; written once."""
    linked = components(near_pairs(classes.select("fp"), p))
    return materialize(classes.join(linked, classes["fp"] == linked["node"], "left").select(
        *[classes[c] for c in classes.columns], F.coalesce("component", "fp").alias("component")))


def simhash_groups(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    fps = materialize(fingerprints(docs, p))
    member = class_components(materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))), p)
    smallest = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_fp = member.join(smallest, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """One row of each group: the one with the smallest doc_id, rows without an id last.

    Rows are told apart by a key that is written with them, not by their id: of repeated rows one stays, rows
    without an id take part, and a row that shares its doc_id with a row of another group is judged on its own.
    Among rows of one group and id any one stays. All columns are unchanged, whatever their names."""
    key = next(name for k in range(len(docs.columns) + 1) if (name := f"row_key_{k}") not in {c.lower() for c in docs.columns})
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()))
    fps = materialize(fingerprints(rows, p, key))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    member = class_components(materialize(fps.groupBy("fp").agg(F.min(order).alias("first"))), p)
    kept = member.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row").alias(key))
    return rows.join(kept, key, "left_semi").drop(key)
