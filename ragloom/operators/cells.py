"""A cell table that grows (R6): imports into existing cells, splits, merges, and searches over probed cells only.

Layout under one path::

    cells/v=<version>/cell=<id>/   rows as they were written by one import
    manifest/v=<version>           one row per cell: centroid, size, radius (largest angle), and the versions that hold it

An import writes new rows under its own version and publishes a manifest last, so readers keep a whole older
state until then, and nothing that they read is changed. A cell over ``max_rows`` is split by a local 2-means, a cell
under ``min_rows`` is dissolved. Afterwards every row is in the cell of its nearest centroid, but only cells
that a change can reach are read and written again: a row of cell j (angle r <= R_j to its centroid) can be nearer
to a new centroid n only if angle(n, j) < 2 R_j. All other cells stay as they are and only take new rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragloom.operators.ivf import ivf_search
from ragloom.operators.search import _matrix
from ragloom.session import ship_package, write_once

NO_CELL = -1    # rows without a direction
SLACK = 1e-6    # on angles


@dataclass(frozen=True)
class CellParams:
    max_rows: int = 1 << 20   # a larger cell is split
    min_rows: int = 0         # a smaller cell is dissolved
    rounds: int = 8           # of splitting, per import


@dataclass(frozen=True)
class Manifest:
    """At most the number of cells in rows; ``live`` are the cells that take vectors."""

    version: int
    ids: np.ndarray
    centroids: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray
    held_in: dict[int, list[int]]

    @property
    def unit(self) -> np.ndarray:
        return self.centroids / np.linalg.norm(self.centroids, axis=1, keepdims=True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions: the manifests whose write was committed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    names = [s.getPath() for s in fs.listStatus(root)]  # one folder an import
    return sorted(int(p.getName()[2:]) for p in names if p.getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


MANIFEST = "cell int, centroid array<double>, n long, radius double, versions array<int>"


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no published cells at {path}")
    rows = sorted(spark.read.schema(MANIFEST).parquet(f"{path}/manifest/v={versions[-1]}").collect(), key=lambda r: r["cell"])
    live = [r for r in rows if r["cell"] != NO_CELL]
    return Manifest(versions[-1], np.array([r["cell"] for r in live]), np.array([r["centroid"] for r in live]), np.array([r["n"] for r in live]),
                    np.array([r["radius"] for r in live]), {r["cell"]: list(r["versions"]) for r in rows})


def _publish(spark: SparkSession, path: str, version: int, ids, cents, stats: dict, held_in: dict) -> None:
    rows = [(int(c), [float(x) for x in v], int(stats.get(int(c), (0, 0.0))[0]), float(stats.get(int(c), (0, 0.0))[1]), held_in.get(int(c), [])) for c, v in zip(ids, cents)]
    rows.append((NO_CELL, [], int(stats.get(NO_CELL, (0, 0.0))[0]), 0.0, held_in.get(NO_CELL, [])))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/v={version}")


def _placed(rows: DataFrame, ids: np.ndarray, cents: np.ndarray, vec: str) -> DataFrame:
    """``rows`` with ``cell`` (nearest centroid by cosine, the first of equals) and ``angle`` to it."""
    spark = rows.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast((ids, cents / np.linalg.norm(cents, axis=1, keepdims=True)))
    dim = cents.shape[1]
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def run(batches):
        names, unit = sent.value
        for rb in batches:
            m = _matrix(rb.column(vec), "dense", dim)
            norm = np.linalg.norm(m, axis=1)
            s = (m @ unit.T)
            best = s.argmax(axis=1)
            cos = s[np.arange(len(m)), best] / np.where(norm > 0, norm, 1.0)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(np.where(norm > 0, names[best], NO_CELL).astype(np.int32)),
                                              pa.array(np.where(norm > 0, np.arccos(np.clip(cos, -1, 1)), 0.0))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _stats(placed: DataFrame) -> dict[int, tuple[int, float]]:
    """Rows and radius by cell: one row a cell."""
    return {r["cell"]: (r["n"], r["radius"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()}


def _rows_of(spark: SparkSession, path: str, held_in: dict[int, list[int]], schema: T.StructType | None = None) -> DataFrame:
    """The rows of the given cells, by partition filters on version and cell."""
    table = spark.read
    if schema is not None:
        table = table.schema(T.StructType([*schema.fields, T.StructField("angle", T.DoubleType()), T.StructField("v", T.IntegerType()), T.StructField("cell", T.IntegerType())]))
    table = table.parquet(f"{path}/cells")
    wanted = F.lit(False)
    for v in sorted({v for vs in held_in.values() for v in vs}):
        wanted = wanted | ((F.col("v") == v) & F.col("cell").isin([c for c, vs in held_in.items() if v in vs]))
    return table.where(wanted).drop("v")


def create_cells(vectors: DataFrame, path: str, cents: np.ndarray, vec: str = "embedding") -> int:
    """A new cell table of ``vectors`` around ``cents``; its version."""
    spark = vectors.sparkSession
    if _versions(spark, path):
        raise ValueError(f"there are cells at {path} already: use insert_vectors")
    ids = np.arange(len(cents))
    placed = write_once(_placed(vectors, ids, np.asarray(cents, dtype=np.float64), vec))
    placed.write.partitionBy("cell").parquet(f"{path}/cells/v=0")
    stats = _stats(placed)
    _publish(spark, path, 0, ids, cents, stats, {c: [0] for c in stats})
    return 0


def read_cells(spark: SparkSession, path: str, manifest: Manifest | None = None) -> DataFrame:
    """All rows of the newest published state with ``cell`` (null without a direction); a filter on ``cell`` prunes folders."""
    m = manifest or read_manifest(spark, path)
    return _rows_of(spark, path, m.held_in).drop("angle").withColumn("cell", F.when(F.col("cell") != NO_CELL, F.col("cell")))


def _split_in_two(rows: DataFrame, vec: str, seed: int) -> np.ndarray:
    data = rows.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    return np.asarray(KMeans(k=2, seed=seed, maxIter=10, distanceMeasure="cosine", featuresCol="features").fit(data).clusterCenters())


def insert_vectors(vectors: DataFrame, path: str, params: CellParams = CellParams(), vec: str = "embedding", seed: int = 42) -> int:
    """Add an import (the columns of the table) and mend the cells; the new version. Publishing is the last step."""
    spark = vectors.sparkSession
    m = read_manifest(spark, path)
    version = m.version + 1
    ids, cents, held_in = m.ids, m.centroids, dict(m.held_in)
    moved = write_once(_placed(vectors, ids, cents, vec))     # new rows, and rows of cells that a change reached
    base = moved.drop("cell", "angle").schema
    kept = {int(c): (int(n), float(r)) for c, n, r in zip(m.ids, m.sizes, m.radii)}  # cells still as they were written
    if NO_CELL in held_in:
        kept[NO_CELL] = (_rows_of(spark, path, {NO_CELL: held_in[NO_CELL]}).count(), 0.0)
    for turn in range(params.rounds):
        fresh = _stats(moved)
        size = {int(c): kept.get(int(c), (0, 0.0))[0] + fresh.get(int(c), (0, 0.0))[0] for c in ids}
        over = [c for c in size if size[c] > params.max_rows]
        under = [c for c in size if size[c] < params.min_rows]
        if len(ids) - len(under) < 1 or not (over or under):
            break
        new = []
        for c in over:
            rows = moved.where(F.col("cell") == c).select(vec)
            if c in kept and held_in.get(c):
                rows = rows.unionByName(_rows_of(spark, path, {c: held_in[c]}, base).select(vec))
            two = _split_in_two(write_once(rows), vec, seed + turn)
            if len(two) == 2 and float(two[0] @ two[1]) < (1 - 1e-12) * np.linalg.norm(two[0]) * np.linalg.norm(two[1]):
                new.append((c, two))  # else: copies of one vector, nothing to split
        if not new and not under:
            break
        gone = {c for c, _ in new} | set(under)
        stay = np.array([int(c) not in gone for c in ids])
        added = np.concatenate([two for _, two in new]) if new else np.zeros((0, cents.shape[1]))
        unit_new = added / np.linalg.norm(added, axis=1, keepdims=True) if len(added) else added
        unit_old = cents / np.linalg.norm(cents, axis=1, keepdims=True)
        reach = np.arccos(np.clip(unit_old @ unit_new.T, -1, 1)).min(axis=1) if len(added) else np.full(len(ids), np.inf)
        again = {int(c) for c, d in zip(ids, reach) if int(c) in kept and (int(c) in gone or d < 2 * kept[int(c)][1] + SLACK)}
        old = _rows_of(spark, path, {c: held_in[c] for c in again if held_in.get(c)}, base).drop("cell", "angle") if again else None
        ids = np.r_[ids[stay], np.arange(len(added)) + ids.max() + 1]
        cents = np.concatenate([cents[stay], added])
        rows = moved.drop("cell", "angle")
        moved = write_once(_placed(rows.unionByName(old.select(*rows.columns)) if old is not None else rows, ids, cents, vec))
        for c in again:
            kept.pop(c)
            held_in.pop(c, None)
        for c in gone:
            held_in.pop(c, None)
    fresh = _stats(moved)
    moved.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells/v={version}")
    stats = {}
    for c in [*map(int, ids), NO_CELL]:
        a, b = kept.get(c, (0, 0.0)), fresh.get(c, (0, 0.0))
        stats[c] = (a[0] + b[0], max(a[1], b[1]))
        held_in[c] = [*(held_in.get(c, []) if c in kept else []), *([version] if c in fresh else [])]
    _publish(spark, path, version, ids, cents, stats, held_in)
    return version


def search_cells(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, nprobe: int = 8, *, vec: str = "embedding", query_id: str = "query_id",
                 query_vec: str | None = None, order: list[str] | None = None, round_digits: int | None = None) -> DataFrame:
    """R7 over the stored cells: only folders of probed cells are read. ``nprobe`` of all cells is the exact search."""
    m = read_manifest(spark, path)
    return ivf_search(read_cells(spark, path, m), queries, m.centroids, k, nprobe, vec=vec, cell="cell", query_id=query_id, query_vec=query_vec, order=order,
                      round_digits=round_digits, cell_ids=m.ids)
