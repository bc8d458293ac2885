"""Clustered (IVF) search.

R6 fits ``nlist`` cosine k-means centroids with ``pyspark.ml`` and tags every vector with
its cell; written with ``partitionBy('cell')`` the chunk table can then be pruned by cell.
R7 scans only the ``nprobe`` cells nearest to each query: the cells probed by a query block
become a partition filter on the scan, and inside the task a chunk scores for a query
only if its cell is one of that query's probes. ``nprobe == nlist`` is the exact search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ragloom.operators.search import (
    CosineScorer,
    _matrix,
    _query_matrix,
    check_query_ids,
    out_schema,
    rank_within_query,
    row_norms,
    top_rows,
    topk_kernel,
)
from ragloom.params import SearchParams
from ragloom.session import ship_package, write_once

# Index lists and probed lists of the reference's index (all probed: exact).
NLIST = 128
NPROBE = 128
PROBE_ROWS = 8192  # pairs of a query and a cell in one Arrow batch


def _usable(vec) -> Column:
    """A vector with a direction: not null, not empty, not all zero."""
    return F.coalesce(F.exists(F.col(vec), lambda x: x != 0), F.lit(False))


def ivf_fit(vectors: DataFrame, vec: str = "embedding", nlist: int = NLIST, seed: int = 42, max_iter: int = 20):
    """R6 training: cosine k-means over the vectors that have a direction; returns the fitted model
    (centroids: nlist × dim). Fit once and pass the model, or its centroids, to the searches."""
    # up to ``max_iter`` passes read the vectors: written once
    data = write_once(vectors.where(_usable(vec)).select(F.col(vec).cast("array<double>").alias("v"))).select(array_to_vector("v").alias("features"))
    return KMeans(k=nlist, seed=seed, maxIter=max_iter, distanceMeasure="cosine", featuresCol="features").fit(data)


def ivf_assign(vectors: DataFrame, model_or_centroids, vec: str = "embedding", out: str = "cell") -> DataFrame:
    """Every row with the id of the centroid of highest cosine (the first one of equals), a narrow
    transform; rows without a direction (null, empty or zero vectors) stay and get a null cell."""
    spark = vectors.sparkSession
    ship_package(spark)
    cents = model_or_centroids if isinstance(model_or_centroids, np.ndarray) else centroids(model_or_centroids)
    unit = spark.sparkContext.broadcast(cents / np.linalg.norm(cents, axis=1, keepdims=True))
    dim = cents.shape[1]

    def run(batches):
        for rb in batches:
            m = _matrix(rb.column(vec), "dense", dim)
            cell = (m @ unit.value.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(cell, mask=~m.any(axis=1))], names=[*rb.schema.names, out])

    return vectors.mapInArrow(run, T.StructType([*vectors.schema.fields, T.StructField(out, T.IntegerType())]))


def write_ivf_table(vectors: DataFrame, model, path: str, vec: str = "embedding", cell: str = "cell",
                    mode: str = "overwrite") -> None:
    """R6 storage: the cell-tagged table written with ``partitionBy(cell)``, so R7's probe
    filter on ``cell`` becomes partition pruning (only probed cells are read)."""
    ivf_assign(vectors, model, vec, cell).write.mode(mode).partitionBy(cell).parquet(path)


def centroids(model) -> np.ndarray:
    return np.asarray(model.clusterCenters(), dtype=np.float64)


def _probes(q: np.ndarray, cents: np.ndarray, nprobe: int) -> np.ndarray:
    """(queries × nlist) bool: the ``nprobe`` cells of highest cosine per query."""
    nq, nl = q.shape[0], cents.shape[0]
    mask = np.zeros((nq, nl), dtype=bool)
    if nq == 0:
        return mask
    if nprobe >= nl:
        mask[:] = True
        return mask
    qn = np.linalg.norm(q, axis=1, keepdims=True)
    cn = np.linalg.norm(cents, axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.nan_to_num((q / qn) @ (cents / cn).T, nan=-np.inf)
    top = np.argpartition(-s, nprobe - 1, axis=1)[:, :nprobe]
    np.put_along_axis(mask, top, True, axis=1)
    return mask


def ivf_search(
    chunks: DataFrame,
    queries: DataFrame,
    model_or_centroids,
    k: int = 5,
    nprobe: int = NPROBE,
    *,
    vec: str = "embedding",
    cell: str = "cell",
    query_id: str = "query_id",
    query_vec: str | None = None,
    dim: int | None = None,
    order: list[str] | None = None,
    round_digits: int | None = None,
    max_broadcast_bytes: int = SearchParams().max_broadcast_bytes,
    cell_ids: np.ndarray | None = None,
) -> DataFrame:
    """Top-k by cosine among the chunks of each query's ``nprobe`` nearest cells. ``cell_ids``: the cell of each
    centroid, where cells are not numbered as the centroids are (the filter stays one on ``cell`` itself)."""
    query_vec = query_vec or vec
    order = list(order or [])
    cents = model_or_centroids if isinstance(model_or_centroids, np.ndarray) else centroids(model_or_centroids)
    dim = dim or cents.shape[1]
    spark = chunks.sparkSession
    ship_package(spark)
    schema = out_schema(chunks, [vec, cell], queries.schema[query_id].dataType)
    # a query row ships its vector (dim doubles) and its probe mask (nlist booleans)
    if check_query_ids(queries, query_id) * (dim * 8 + cents.shape[0]) > max_broadcast_bytes:
        if cell_ids is not None:
            place = F.create_map(*[F.lit(int(x)) for pair in zip(cell_ids, range(len(cell_ids))) for x in pair])
            chunks = chunks.withColumn(cell, place[F.col(cell)])
        return ivf_join(chunks, queries, cents, k, nprobe, vec=vec, cell=cell, query_id=query_id, query_vec=query_vec, order=order,
                        round_digits=round_digits)
    ids, q, qn = _query_matrix(queries, query_id, query_vec, "dense", dim)
    probe = _probes(q.astype(np.float64), cents, nprobe)
    probed = {int(c) for c in np.nonzero(probe.any(axis=0))[0]}
    blocks = [spark.sparkContext.broadcast((ids, q, qn, probe))]
    names = np.arange(cents.shape[0]) if cell_ids is None else np.asarray(cell_ids)
    scan = chunks.where(F.col(cell).isin([int(names[c]) for c in sorted(probed)])) if len(probed) < cents.shape[0] else chunks
    kern = topk_kernel(blocks, _ProbeScorer(vec, dim, cell, names), [vec, cell], k, None, order, to_arrow_schema(schema), round_digits)
    return rank_within_query(scan.mapInArrow(kern, schema), k, order)


class _ProbeScorer(CosineScorer):
    """Cosine for the queries that probe a row's cell."""

    def __init__(self, vec: str, dim: int, cell: str, names: np.ndarray):
        super().__init__(vec, "dense", dim)
        self.cell, self.names, self.at = cell, np.sort(names), np.argsort(names)

    def features(self, rb: pa.RecordBatch):
        cells = pc.fill_null(rb.column(self.cell), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place = np.minimum(np.searchsorted(self.names, cells), len(self.names) - 1)  # cell -> row of the centroids
        return super().features(rb), np.where(self.names[place] == cells, self.at[place], -1)

    def select(self, features, state, k: int, floor: np.ndarray, min_score, round_digits):
        ((m, cn), cells), (_, q, qn, probe) = features, state

        def allowed(a: int, b: int, lo: int, hi: int) -> np.ndarray:
            return probe[a:b][:, cells[lo:hi]] & (cells[lo:hi] >= 0)

        return top_rows(q, qn, m, cn, k, floor, min_score, round_digits, allowed)


def _probe_rows(bc, nprobe: int, query_id: str, query_vec: str, dim: int):
    """``mapInArrow`` body: every query with each of its ``nprobe`` cells, some thousand pairs at a time."""
    some = max(1, PROBE_ROWS // max(1, nprobe))

    def run(batches):
        cents = bc.value
        for rb in (b.slice(lo, some) for b in batches for lo in range(0, b.num_rows, some)):
            q = _matrix(rb.column(query_vec), "dense", dim)
            probe = _probes(q, cents, nprobe)
            qi, ci = np.nonzero(probe)
            yield pa.RecordBatch.from_arrays(
                [rb.column(query_id).take(pa.array(qi)), pa.array(ci.astype(np.int32)), rb.column(query_vec).take(pa.array(qi))],
                names=[query_id, "cell", query_vec],
            )

    return run


class _GroupQueries:
    """Stands in for the broadcast query state inside one co-group (same ``.value`` shape)."""

    def __init__(self, value):
        self.value = value


def _score_group(ct: pa.Table, qt: pa.Table, vec: str, dim: int, k: int, order: list[str], round_digits,
                 drop: list[str], arrow_schema: pa.Schema) -> pa.Table:
    """Score one (cell, chunk salt, query salt) group with the search kernel: local top-k per query."""
    if ct.num_rows == 0 or qt.num_rows == 0:
        return arrow_schema.empty_table()
    ids = qt.column("_qid").combine_chunks()
    q = _matrix(qt.column("_qv"), "dense", dim)
    run = topk_kernel([_GroupQueries((ids, q, row_norms(q)))], CosineScorer(vec, "dense", dim), drop, k, None, order,
                      arrow_schema, round_digits)
    out = list(run(iter(ct.to_batches())))
    return pa.Table.from_batches(out, schema=arrow_schema) if out else arrow_schema.empty_table()


def ivf_join(
    chunks: DataFrame,
    queries: DataFrame,
    model_or_centroids,
    k: int = 5,
    nprobe: int = NPROBE,
    *,
    vec: str = "embedding",
    cell: str = "cell",
    query_id: str = "query_id",
    query_vec: str | None = None,
    order: list[str] | None = None,
    round_digits: int | None = None,
    group_chunks: int = 50_000,
    group_queries: int = 20_000,
) -> DataFrame:
    """R7 for query tables of any size: a skew-aware partitioned join on the cell.

    Each cell is split into ``S_c = ceil(chunks_c / group_chunks)`` salted chunk groups and
    ``T_c = ceil(probes_c / group_queries)`` query groups (sizes from two small per-cell
    counts); chunk rows are replicated ``T_c`` times and probe rows ``S_c`` times, so a hot
    cell becomes many bounded groups instead of one huge task. Each co-group is scored in
    NumPy and emits only its local top-k per query; the global rank is the usual window.
    No (query, chunk) pair is emitted. Same result as ``ivf_search`` with the same probes.
    """
    query_vec = query_vec or vec
    order = list(order or [])
    cents = model_or_centroids if isinstance(model_or_centroids, np.ndarray) else centroids(model_or_centroids)
    nl, dim = cents.shape
    spark = chunks.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(cents)
    check_query_ids(queries, query_id)
    id_type = queries.schema[query_id].dataType
    # read by the counts and by the join: written once, in the type that the vectors have
    probes = write_once(queries.select(query_id, query_vec).mapInArrow(
        _probe_rows(bc, nprobe, query_id, query_vec, dim),
        f"{query_id} {id_type.simpleString()}, cell int, {query_vec} {queries.schema[query_vec].dataType.simpleString()}",
    ))
    chunks = write_once(chunks.where(F.col(cell).isNotNull()))  # vectors without a direction match nothing
    n_chunks = {r[0]: r[1] for r in chunks.groupBy(cell).count().collect()}  # <= nlist rows
    n_probes = {r[0]: r[1] for r in probes.groupBy("cell").count().collect()}
    # per-cell group counts: a table of nlist rows (its size is the index parameter), broadcast
    sizes = spark.createDataFrame(
        [(c, max(1, -(-n_chunks.get(c, 0) // group_chunks)), max(1, -(-n_probes.get(c, 0) // group_queries)))
         for c in range(nl)],
        "_cell int, _ns int, _nt int",
    )
    key = F.xxhash64(*[F.col(c) for c in (order or [vec])])
    # the co-group keys must have the same types on both sides: int and bigint hash
    # differently, and cogroup does not coerce them
    c_side = (chunks.withColumn("_cell", F.col(cell).cast("int")).drop(cell)
              .join(F.broadcast(sizes), "_cell")
              .withColumn("_s", F.pmod(key, F.col("_ns")).cast("int"))
              .withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_nt") - 1)))
              .drop("_ns", "_nt"))
    q_side = (probes.withColumn("_cell", F.col("cell").cast("int"))
              .join(F.broadcast(sizes), "_cell")
              .withColumn("_t", F.pmod(F.xxhash64(query_id), F.col("_nt")).cast("int"))
              .withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_ns") - 1)))
              .select("_cell", "_s", "_t", F.col(query_id).alias("_qid"), F.col(query_vec).alias("_qv")))

    drop = [vec, "_cell", "_s", "_t"]
    schema = out_schema(c_side, drop, id_type)
    arrow_schema = to_arrow_schema(schema)

    def score_group(ct, qt):
        return _score_group(ct, qt, vec, dim, k, order, round_digits, drop, arrow_schema)

    cands = (c_side.groupBy("_cell", "_s", "_t")
             .cogroup(q_side.groupBy("_cell", "_s", "_t"))
             .applyInArrow(score_group, schema))
    return rank_within_query(cands, k, order)


__all__ = ["ivf_fit", "ivf_assign", "ivf_search", "ivf_join", "write_ivf_table", "centroids"]
