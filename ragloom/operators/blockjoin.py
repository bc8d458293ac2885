"""Exact top-k cosine for query tables of any size (R2, R8): a join of bounded blocks.

Neither table passes through the driver and no task holds more than one block of chunks and one group of queries::

    chunks ─► vectors (packed), written once with the other columns; nearest of at most ``pivots`` pivots, angle to it
    (pivot, slice of angles) = cell; its angle interval and size: at most pivots × slices rows
    queries ─► sorted by (pivot, angle) into groups ─► upper bound of every cell
           ─► round 1: the few cells that most queries of the group count among their best ─► k-th best score of each query
           ─► round 2: the other cells whose bound reaches that score for a query of the group
    round: packs of (cell, salt) × packs of a group ─► cogroup ─► local top-k ─► rank per query ─► the other columns by row key

For unit vectors the angle is a metric: a chunk whose angle to a pivot lies in ``[lo, hi]`` is at least
``max(0, a - hi, lo - a)`` away from a query at the angle ``a``. The cosine of that is the cell's bound, so a
cell below a query's k-th best score (or below ``min_score``) cannot change the result and is skipped. A cell of
many rows (copies of one text, a hot region) is salted into blocks of ``block_rows``; there are about as many cells as
blocks. Round 1 is a small part of the work; in round 2 a row must reach the k-th best score so far to be a candidate, so
few are. What is repeated for each block that meets a group are packs: some thousand rows (vector, row key, tie-break
columns) as one compressed value, a vector of counts in some 50 bytes; a pair of a query and a cell is never a row.
A task unpacks ``part_bytes`` of its block at a time. Without pruning this is the work of all pairs, in
``rows / block_rows × queries / group_queries`` pieces of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ragloom.operators.search import _in_order, _matrix, _reduce, narrowed, out_schema, rank_within_query, row_norms, top_rows
from ragloom.session import ship_package, write_once

SLACK = 1e-6  # on angles: arccos loses half the digits near 0
BATCH = 1024  # rows of an Arrow batch that are made into numbers at a time


PACK_ROWS = 16_384    # rows of a pack, at most
PACK_BYTES = 1 << 24  # that a task gathers before it packs them
SEND_BYTES = 1 << 23  # of packs in an Arrow batch, about


@dataclass(frozen=True)
class BlockParams:
    pivots: int = 64
    slices: int = 16            # angle slices of a pivot, at most
    block_rows: int = 524_288   # chunk rows of a block on average, at most
    least_rows: int = 16_384    # smaller blocks are not made for the sake of more pieces
    group_queries: int = 262_144  # queries of a group, on average
    first_cells: int = 4        # cells that a group asks for in the first round, at most one in eight
    block_bytes: int = 1 << 25  # of the packed vectors of a block, at most
    group_bytes: int = 1 << 26  # of the vectors of a group, at most
    part_bytes: int = 1 << 25   # of the vectors of a block that are unpacked at a time
    sent_rows: int = 1 << 20    # row keys of the hits in a broadcast, at most


def _packed(m: np.ndarray) -> pa.Array:
    """Rows as bytes in the narrowest type that holds the batch exactly: counts up to 255, single or double precision."""
    data = narrowed(m)
    offsets = np.arange(len(m) + 1, dtype=np.int32) * (data.itemsize * m.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(column, dim: int) -> np.ndarray:
    """The rows of ``_packed``; doubles only where a row needs them."""
    col = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    ends = np.frombuffer(col.buffers()[1], dtype=np.int32, count=col.offset + len(col) + 1)[col.offset:] if len(col) else np.zeros(1, np.int32)
    widths = np.diff(ends)
    types = [t for t in (np.uint8, np.float32, np.float64) if (widths == dim * np.dtype(t).itemsize).any()]
    if len(types) == 1:
        return np.frombuffer(col.buffers()[2], dtype=types[0], count=len(col) * dim, offset=int(ends[0])).reshape(-1, dim)
    m = np.zeros((len(col), dim), dtype=types[-1] if types else np.float64)
    for t in types:
        at = np.flatnonzero(widths == dim * np.dtype(t).itemsize)
        m[at] = np.frombuffer(b"".join(col.take(pa.array(at)).to_pylist()), dtype=t).reshape(-1, dim)
    return m


def with_vectors(df: DataFrame, vec: str, mode: str, dim: int, keep: list[str]) -> DataFrame:
    """``keep`` and ``_v``, the packed vector; rows without a direction (no vector, all zero) match nothing and go."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("_v", T.BinaryType())])
    cols = list(dict.fromkeys([*keep, vec]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in (b.slice(lo, BATCH) for b in batches for lo in range(0, b.num_rows, BATCH)):
            m = _matrix(rb.column(vec), mode, dim)
            at = np.flatnonzero(row_norms(m) > 0)
            if len(at):
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([*(rb.column(c).take(take) for c in keep), _packed(m[at])], names=[*keep, "_v"])

    return df.select(*cols).mapInArrow(run, schema)


def _key_runs(t: pa.Table, key: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, in packs."""
    t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in key])).combine_chunks()
    new = np.zeros(t.num_rows, dtype=bool)
    new[:1] = True
    for c in key:
        v = t.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    starts = np.r_[np.flatnonzero(new), t.num_rows]
    most = max(1, min(PACK_ROWS, PACK_BYTES // 4 * t.num_rows // max(1, t.nbytes)))
    for a, z in zip(starts, starts[1:]):
        for lo in range(a, z, most):
            yield t.slice(lo, min(z, lo + most) - lo)


def _packs(rows: DataFrame, key: list[str]) -> DataFrame:
    """``key`` (whole numbers) and ``pack``: rows of one key without it, as one compressed value (an Arrow stream)."""
    schema = T.StructType([*(rows.schema[c] for c in key), T.StructField("pack", T.BinaryType())])
    names = [*key, "pack"]

    def pack(held: list) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        for t in _key_runs(pa.Table.from_batches(held), key):
            sink = pa.BufferOutputStream()
            bare = t.drop_columns(key).combine_chunks()
            with pa.ipc.new_stream(sink, bare.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(bare)
            done.append([t.column(c)[0].as_py() for c in key] + [sink.getvalue().to_pybytes()])
            size += len(done[-1][-1])
            if size >= SEND_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
                done, size = [], 0
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    def run(batches):
        held, size = [], 0
        for rb in batches:
            held.append(rb)
            size += rb.nbytes
            if size >= PACK_BYTES:
                yield from pack(held)
                held, size = [], 0
        if size:
            yield from pack(held)

    arrow = to_arrow_schema(schema)
    return rows.select(*key, *(c for c in rows.columns if c not in key)).mapInArrow(run, schema).select(*names)


def _unpack(packs: pa.ChunkedArray, part_bytes: int | None = None) -> Iterator[pa.Table]:
    """The rows of packs, about ``part_bytes`` at a time (``None``: all)."""
    held, size = [], 0
    for p in packs:
        held.append(pa.ipc.open_stream(p.as_buffer()).read_all())
        size += held[-1].nbytes
        if part_bytes is not None and size >= part_bytes:
            yield pa.concat_tables(held)
            held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def _angles(v, pivots: np.ndarray) -> np.ndarray:
    m = _unpacked(v, pivots.shape[1]).astype(np.float64)
    return np.arccos(np.clip((m / row_norms(m)[:, None]) @ pivots.T, -1.0, 1.0))


def _placed(rows: DataFrame, pivots) -> DataFrame:
    """Adds ``_pivot`` (the nearest) and ``_angle`` to it."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_pivot", T.IntegerType()), T.StructField("_angle", T.DoubleType())])

    def run(batches):
        for rb in (b.slice(lo, BATCH) for b in batches for lo in range(0, b.num_rows, BATCH)):
            a = _angles(rb.column("_v"), pivots.value)
            near = a.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(near.astype(np.int32)), pa.array(a[np.arange(len(a)), near])], names=schema.names)

    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class Cells:
    """At most pivots × slices cells: pivot, angle interval, rows, blocks."""

    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    salts: np.ndarray

    def bounds(self, angles: np.ndarray) -> np.ndarray:
        """Upper bounds (queries × cells) of the cosine, from the queries' angles to all pivots."""
        a = angles[:, self.pivot]
        return np.cos(np.clip(np.maximum(a - self.high, self.low - a) - SLACK, 0.0, np.pi))


def _visits(queries: DataFrame, pivots, cells, first: bool, first_cells: int, min_score: float | None) -> DataFrame:
    """Rows (``_group``, cell), or (``_qid``, cell) of queries without groups: the ``first_cells`` best cells of a query, or
    all others, whose bound reaches its ``_bound``. A task names a cell of a group once for some thousand queries."""
    asker = "_group" if "_group" in queries.columns else "_qid"
    schema = T.StructType([queries.schema[asker], T.StructField("cell", T.IntegerType())])

    def run(batches):
        for rb in (b.slice(lo, BATCH) for b in batches for lo in range(0, b.num_rows, BATCH)):
            c = cells.value
            bound = c.bounds(_angles(rb.column("_v"), pivots.value))
            best = np.zeros(bound.shape, dtype=bool)
            np.put_along_axis(best, np.argsort(-bound, axis=1, kind="stable")[:, :first_cells], True, axis=1)
            floor = rb.column("_bound").to_numpy(zero_copy_only=False)[:, None] - SLACK
            go = (best if first else ~best) & (bound >= floor)
            if min_score is not None:
                go &= bound >= min_score - SLACK
            qi, ci = np.nonzero(go)
            found = pa.table([rb.column(asker).take(pa.array(qi)), pa.array(ci.astype(np.int32))], names=schema.names)
            if asker == "_group":
                found = found.group_by(schema.names).aggregate([]).select(schema.names)
            yield from found.to_batches()

    return queries.mapInArrow(run, schema)


def _most_wanted(queries: DataFrame, pivots, cells, first_cells: int, min_score: float | None) -> DataFrame:
    """Rows (``_group``, cell): the ``first_cells`` cells that most queries of a group count among their ``first_cells`` best."""

    def run(batches):
        for rb in (b.slice(lo, BATCH) for b in batches for lo in range(0, b.num_rows, BATCH)):
            bound = cells.value.bounds(_angles(rb.column("_v"), pivots.value))
            best = np.argsort(-bound, axis=1, kind="stable")[:, :first_cells]
            qi, at = np.nonzero(np.take_along_axis(bound, best, axis=1) >= (-np.inf if min_score is None else min_score - SLACK))
            named = pa.table([rb.column("_group").take(pa.array(qi)), pa.array(best[qi, at].astype(np.int32))], names=["_group", "cell"])
            yield from named.group_by(["_group", "cell"]).aggregate([([], "count_all")]).rename_columns(["_group", "cell", "n"]).to_batches()

    wanted = queries.mapInArrow(run, "_group int, cell int, n long").groupBy("_group", "cell").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("_group").orderBy(F.col("n").desc(), "cell"))
    return wanted.withColumn("_place", place).where(F.col("_place") <= first_cells).select("_group", "cell")


def block_join(chunks: DataFrame, queries: DataFrame, k: int, *, vec: str = "embedding", query_id: str = "query_id", query_vec: str | None = None,
               mode: str = "dense", dim: int, min_score: float | None = None, order: list[str] | None = None, round_digits: int | None = None,
               carry_text: bool = True, params: BlockParams = BlockParams()) -> DataFrame:
    """The rows of ``search.search_batch``: ``query_id, <chunk columns>, score, rank``."""
    spark, p, order = chunks.sparkSession, params, list(order or [])
    sc = spark.sparkContext
    ship_package(spark)
    payload = [c for c in chunks.columns if c != vec or (mode == "text" and carry_text)]
    asked = write_once(with_vectors(queries.withColumnRenamed(query_id, "_qid"), query_vec or vec, mode, dim, ["_qid"]).withColumn("_q", F.monotonically_increasing_id()), "zstd")
    rows = write_once(with_vectors(chunks, vec, mode, dim, payload).withColumn("_row", F.monotonically_increasing_id()), "zstd")
    (n_asked, wide), (n_rows, wider) = (t.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("_v")), F.lit(1))).first() for t in (asked, rows))
    # a short number stands for an id; rows of one id are one query, as in the ranking
    names = write_once(asked.groupBy("_qid").agg(F.min("_q").alias("_q")))
    if names.count() < n_asked:
        same = asked.select("_qid", "_v").join(names.withColumnRenamed("_qid", "_name"), F.col("_qid").eqNullSafe(F.col("_name")))
        asked = write_once(same.select("_qid", "_v", "_q"), "zstd")
    groups = max(1, -(-n_asked // max(1, min(p.group_queries, p.group_bytes // wide))))
    # as large as may be, so that little is repeated, but some pieces of work for each core; counts pack to a quarter at most
    packed_width = max(1, wider // 4) if wider == dim else wider
    block_rows = max(1, min(p.block_rows, p.block_bytes // packed_width, max(p.least_rows, n_rows * groups // (8 * sc.defaultParallelism))))
    # at most ``pivots`` vectors, of smallest hash: any choice is right, a spread one prunes
    picked = rows.select("_v").orderBy(F.xxhash64("_v")).limit(4 * p.pivots).toArrow().column("_v")
    schema = out_schema(rows.select(*payload), [], queries.schema[query_id].dataType)
    if not n_asked or not len(picked):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("rank", T.IntegerType(), False)]))
    blocks_wanted = -(-n_rows // block_rows)
    m = _unpacked(picked, dim).astype(np.float64)
    unit = {u.tobytes(): u for u in m / row_norms(m)[:, None]}  # copies are one pivot
    units = np.array(list(unit.values())[: max(1, min(p.pivots, blocks_wanted))])
    slices = max(1, min(p.slices, -(-blocks_wanted // len(units))))
    pivots = sc.broadcast(units)

    # found anew where it is read: to write the vectors twice is dearer
    keys = list(dict.fromkeys([*order, "_row"]))
    placed = _placed(rows.select(*keys, "_v"), pivots)
    sliced = placed.withColumn("_slice", F.lit(0))
    if slices > 1:
        cuts = placed.groupBy("_pivot").agg(F.percentile_approx("_angle", [i / slices for i in range(1, slices)]).alias("cuts"))
        cuts = F.broadcast(spark.createDataFrame(cuts.collect(), cuts.schema))  # at most ``pivots`` rows
        sliced = placed.join(cuts, "_pivot").withColumn("_slice", F.size(F.filter("cuts", lambda c: c < F.col("_angle")))).drop("cuts")
    found = sliced.groupBy("_pivot", "_slice").agg(F.min("_angle").alias("low"), F.max("_angle").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("_pivot", "_slice").collect()
    column = lambda name: np.array([r[name] for r in found])
    salts = -(-column("n") // block_rows)
    cells = sc.broadcast(Cells(column("_pivot"), column("low"), column("high"), column("n"), salts))
    sizes = spark.createDataFrame([(r["_pivot"], r["_slice"], i, int(s)) for i, (r, s) in enumerate(zip(found, salts))], "_pivot int, _slice int, cell int, salts int")

    # queries that lie near each other ask for the same cells
    grouped = _placed(asked, pivots).repartitionByRange(groups, "_pivot", "_angle", "_q")
    now = write_once(grouped.select("_q", "_v", F.spark_partition_id().alias("_group"), F.lit(float("-inf")).alias("_bound")), "zstd")
    keyed = out_schema(rows.select(*keys), [], T.LongType())
    arrow_schema = to_arrow_schema(keyed)

    def score(ct: pa.Table, qt: pa.Table) -> pa.Table:
        if not ct.num_rows or not qt.num_rows:
            return arrow_schema.empty_table()
        (asks,) = _unpack(qt.column("pack"))
        q = _unpacked(asks.column("_v"), dim)
        norms, floor, best = row_norms(q), asks.column("_bound").to_numpy() - SLACK, None
        for part in _unpack(ct.column("pack"), p.part_bytes):
            part = _in_order(part, order)
            m = _unpacked(part.column("_v"), dim)
            hits = top_rows(q, norms, m, row_norms(m), k, floor, min_score, round_digits)
            if hits is None or not len(hits[0]):
                continue
            qi, ri, s = hits
            new = part.select(keyed.names[1:-1]).take(pa.array(ri)).append_column("__q", pa.array(qi)).append_column("score", pa.array(s))
            best = _reduce(new if best is None else pa.concat_tables([best, new]), k, order)
            at, s = best.column("__q").to_numpy(), best.column("score").to_numpy()
            n = np.bincount(at, minlength=len(q))
            floor[n == k] = np.maximum(floor[n == k], s[np.cumsum(n)[n == k] - 1])
        if best is None:
            return arrow_schema.empty_table()
        ids = asks.column("_q").take(best.column("__q"))
        return pa.table([ids, *(best.column(c) for c in keyed.names[1:])], names=keyed.names).cast(arrow_schema)

    def round_of(pairs: DataFrame, now: DataFrame) -> DataFrame:
        """Candidates of the (``_group``, cell) pairs, of which there are as many as pieces of work."""
        sized = sizes.join(pairs.select(F.col("cell").alias("_cell")).distinct(), F.col("cell") == F.col("_cell"), "left_semi")
        pieces = pairs.join(F.broadcast(sizes.select("cell", "salts")), "cell").select("cell", "_group", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        pieces = write_once(pieces.withColumn("piece", F.row_number().over(Window.orderBy("cell", "salt", "_group"))))  # a few hundred rows
        spread = max(1, min(4 * pieces.count(), 4096))  # most pieces get a task of their own, however few bytes they have
        blocks = sliced.join(F.broadcast(sized), ["_pivot", "_slice"]).withColumn("salt", F.pmod(F.xxhash64("_row"), F.col("salts")).cast("int"))
        left = _packs(blocks.select("cell", "salt", *keys, "_v"), ["cell", "salt"]).join(F.broadcast(pieces), ["cell", "salt"])
        right = _packs(now.select("_group", "_q", "_v", "_bound"), ["_group"]).join(F.broadcast(pieces), "_group")
        dealt = [t.select(F.col("piece").alias("piece"), F.col("pack").alias("pack")).repartition(spread, "piece").groupBy("piece") for t in (left, right)]
        return dealt[0].cogroup(dealt[1]).applyInArrow(score, keyed)

    first_cells = min(p.first_cells, -(-len(found) // 8))
    early = write_once(_most_wanted(now, pivots, cells, first_cells, min_score))
    best = write_once(rank_within_query(round_of(early, now), k, order))
    # the k-th best score so far bounds what can still come in (rounded scores: half a unit less)
    less = 0.0 if round_digits is None else 10.0 ** -round_digits
    kth = best.where(F.col("rank") == k).select(F.col("query_id").alias("_id"), (F.col("score") - less).alias("_kth"))
    raised = write_once(now.join(kth, now["_q"] == kth["_id"], "left").select("_q", "_v", "_group", F.coalesce("_kth", "_bound").alias("_bound")), "zstd")
    wanted = _visits(raised, pivots, cells, False, 0, min_score).distinct()
    rest = round_of(wanted.join(early, ["_group", "cell"], "left_anti"), raised)
    hits = write_once(rank_within_query(best.drop("rank").unionByName(rest), k, order).select(F.col("query_id").alias("_q"), "_row", "score", "rank"))
    texts, ids = rows.select("_row", *payload), hits.select("_row").distinct()
    if ids.count() <= p.sent_rows:  # only the rows of hits are shuffled
        texts = texts.join(F.broadcast(ids), "_row", "left_semi")
    named = hits.join(names.withColumnRenamed("_qid", "query_id"), "_q")
    return named.join(texts, "_row").select("query_id", *payload, "score", "rank")
