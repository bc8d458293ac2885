"""Best-fit packing of token sequences by a configuration linear program.

A document is its ids and one end id. Only documents above ``capacity`` tokens are cut: into full pieces
after a first one that takes the rest. A configuration is a multiset of piece lengths that fits one
sequence. The linear program asks for the fewest configurations that cover the length histogram; it
is solved by multiplicative weights: lengths that are covered beyond their share lose weight, and
each step prices the best configuration by knapsack dynamic programming. The fractional solution is
rounded down, the program is solved again on what is left, and best-fit-decreasing configurations
take the last rest. Best fit over the whole histogram bounds the plan: where rounding leaves more sequences
than that, its configurations are taken, so the result is never worse than plain best fit.

The driver holds the length histogram (at most ``capacity`` rows) and the configurations, whose
number depends on the capacity alone. Pieces are numbered within their length by two-level counts
(task, then task offsets), so no length is gathered in one task however common it is.

Defined results: a null or empty text is its end id alone; rows without a doc_id and repeated rows are
packed like any others; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package
from ragloom.llm.tokens import byte_encoder

END = 0


@dataclass(frozen=True)
class PackingParams:
    capacity: int = 2048
    tokenizer: str | None = None   # path; None: the installed byte_bpe_50k.json
    rounds: int = 6                # solve, round down, solve the rest
    steps: int = 48                # multiplicative-weight steps a round
    rate: float = 0.35             # weight lost for a share covered once over


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, p: PackingParams) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; part and nth number the pieces of one length within a task."""
    with_package(docs.sparkSession)

    def run(batches):
        encoder, part, seen = byte_encoder(p.tokenizer), TaskContext.get().partitionId(), np.zeros(p.capacity + 1, dtype=np.int64)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encoder.ids(text.as_py()).astype("<u4"), np.uint32(END)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), p.capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[start:start + length].tobytes()), part, int(seen[length])))
                    seen[length] += 1
            cols = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long")


def price(value: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of most value: unbounded knapsack over the lengths with value[length] > 0."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, dtype=np.int64)
    lengths = np.flatnonzero(value > 0)
    values = value[lengths]
    for c in range(1, capacity + 1):
        k = np.searchsorted(lengths, c, side="right")
        best[c] = best[c - 1]
        if k:
            total = values[:k] + best[c - lengths[:k]]
            i = int(np.argmax(total))
            if total[i] > best[c] + 1e-15:
                best[c], pick[c] = total[i], lengths[i]
    out, c = {}, capacity
    while c > 0:
        if pick[c]:
            out[int(pick[c])] = out.get(int(pick[c]), 0) + 1
            c -= int(pick[c])
        else:
            c -= 1
    return out


def solve_lp(counts: np.ndarray, capacity: int, steps: int, rate: float) -> list[tuple[dict[int, int], float]]:
    """Fractional (configuration, amount) pairs for the covering program, by multiplicative weights."""
    length = np.arange(capacity + 1)
    amount = max(float(counts @ length) / capacity / steps, 1e-9)
    covered = np.zeros(capacity + 1)
    share = np.maximum(counts, 1e-9)
    out = []
    for _ in range(steps):
        weight = np.exp(-rate * covered / share * steps / 8)
        value = np.where(counts > 0, length / capacity * (0.5 + 0.5 * weight), 0.0)
        config = price(value, capacity)
        if not config:
            break
        # no more of it than the scarcest length allows, so that rare lengths don't block a step
        x = min(amount, min(counts[i] / a for i, a in config.items()))
        for i, a in config.items():
            covered[i] += a * x
        out.append((config, x))
    return out


def take(left: np.ndarray, config: dict[int, int], most: float) -> int:
    """Use a configuration at most ``most`` times within what is left."""
    n = int(min([most, *(left[i] // a for i, a in config.items())]))
    if n > 0:
        for i, a in config.items():
            left[i] -= a * n
    return n


def best_fit(left: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest piece that is left, then again and again the longest one that fits the rest."""
    config, room = {}, capacity
    while room > 0:
        fits = np.flatnonzero(left[:room + 1] > 0)
        fits = [i for i in fits[::-1] if left[i] > config.get(int(i), 0)]
        if not fits:
            break
        i = int(fits[0])
        a = int(min(room // i, left[i] - config.get(i, 0)))
        config[i] = config.get(i, 0) + a
        room -= a * i
    return config


def finish(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit-decreasing configurations until nothing is left."""
    plan = []
    while left.sum():
        config = best_fit(left, capacity)
        plan.append((config, take(left, config, np.inf)))
    return plan


def plan_configurations(counts: np.ndarray, p: PackingParams = PackingParams()) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) that use every piece of the histogram exactly once: the rounded program, or best fit where that is fewer."""
    plain = finish(counts.astype(np.int64).copy(), p.capacity)
    rounded = rounded_program(counts, p)
    return min(rounded, plain, key=lambda plan: sum(n for _, n in plan))


def rounded_program(counts: np.ndarray, p: PackingParams = PackingParams()) -> list[tuple[dict[int, int], int]]:
    """The plan of the rounded linear program, its last rest by best fit."""
    left = counts.astype(np.int64).copy()
    plan = []
    if left[p.capacity]:
        plan.append(({p.capacity: 1}, int(left[p.capacity])))
        left[p.capacity] = 0
    for _ in range(p.rounds):
        if left.sum() == 0:
            break
        solution = solve_lp(left.astype(float), p.capacity, p.steps, p.rate)
        used = [(config, take(left, config, np.floor(x))) for config, x in solution]
        plan += [(c, n) for c, n in used if n > 0]
        if not any(n for _, n in used):
            break
    return plan + finish(left, p.capacity)


def slot_table(plan) -> tuple[np.ndarray, ...]:
    """Per (length, first rank): times, first sequence, offset; sorted by length and rank."""
    rows, rank, sequence = [], {}, 0
    for config, n in plan:
        offset = 0
        for i in sorted(config, reverse=True):
            rows.append((i, rank.get(i, 0), n, sequence, offset))
            rank[i] = rank.get(i, 0) + config[i] * n
            offset += i * config[i]
        sequence += n
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in (zip(*rows) if rows else [[]] * 5))


def locate(slots, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces with the given length and rank within the length."""
    sl, sr, times, sequence, offset = slots
    order = np.lexsort((rank, length))
    at = np.empty(len(length), dtype=np.int64)
    merged_l, merged_r = np.r_[sl, length[order]], np.r_[sr, rank[order]]
    kind = np.r_[np.zeros(len(sl), dtype=int), np.ones(len(order), dtype=int)]
    sort = np.lexsort((kind, merged_r, merged_l))
    at[order] = (np.cumsum(kind[sort] == 0) - 1)[kind[sort] == 1]
    r = rank - sr[at]
    return sequence[at] + r % times[at], offset[at] + r // times[at] * length


def pack(docs: DataFrame, p: PackingParams = PackingParams()) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = with_package(docs.sparkSession)
    cuts = materialize(pieces(docs, p))
    by_task = cuts.groupBy("length", "part").count()
    histogram = np.zeros(p.capacity + 1, dtype=np.int64)
    for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most ``capacity`` rows
        histogram[r["length"]] = r["n"]
    slots = spark.sparkContext.broadcast(slot_table(plan_configurations(histogram, p)))  # bounded by the capacity
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))

    def run(batches):
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5))
            sequence, offset = locate(slots.value, length, rank)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), pa.array(length), b.column(4), pa.array(sequence), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cuts.join(offsets, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
