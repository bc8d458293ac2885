"""Embedding near-dedup as an exact metric range join.

Vectors link when their labels are equal and their cosine is at least ``threshold``; for unit vectors
that is a Euclidean distance of at most r = sqrt(2 - 2 threshold). Equal vectors are one class from
then on. Each label gets pivots (the classes of smallest hash, more for a larger label); a vector
belongs to the cell of its nearest pivot i. It is also sent to every other cell j that may hold a
vector within r: by the triangle inequality a vector nearest to j lies beyond the plane between the
two pivots, so only if (d_j^2 - d_i^2) / (2 |p_i - p_j|) <= r and d_j <= R_j + r, with R_j the radius of
cell j. So every cell sees all neighbours of its own vectors, and cells join independently.

A cell is dealt into blocks of bounded size (own vectors by members) when it is large, so no task
holds a whole label or cell. Tasks emit a count a vector and one edge a vector and block, never pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows
without a label, link with nothing; a null vec_id takes part but names no component unless alone; repeated
rows count as copies; vectors of unlike length never link; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package
from ragloom.llm.graph import components
from ragloom.llm.simhash import _contract

SLACK = 1e-7  # on distances; the cosine itself is compared without any


@dataclass(frozen=True)
class MetricJoinParams:
    threshold: float = 0.93
    cell_rows: int = 512       # wanted classes a cell
    pivots: int = 64           # most pivots a label
    block_rows: int = 2048     # rows of a block of a large cell
    group_rows: int = 16384    # rows of a label that meet its pivots in one group


def _matrix(column) -> np.ndarray:
    """A list column of one length as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes_of(vectors: DataFrame) -> DataFrame:
    """Distinct usable (label, v): cls (a hash id), rep (smallest vec_id), copies."""
    v = F.col("v")
    usable = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0)
    return vectors.filter(F.coalesce(usable, F.lit(False))).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))


def _label_pivots(classes: DataFrame, sizes: DataFrame, p: MetricJoinParams) -> DataFrame:
    """Per (label, dim): the pivots, at most ``pivots`` vectors; a task sends no more than that of a label.

    label is a string here."""
    def run(batches):
        kept = {}
        for b in batches:
            for label, dim, n, h, v in zip(*(b.column(k).to_pylist() for k in range(5))):
                mine = kept.setdefault((label, dim), [])
                mine.append((h, v))
                if len(mine) > 4 * p.pivots:
                    mine.sort(key=lambda x: x[0])
                    del mine[p.pivots:]
        for (label, dim), mine in kept.items():
            for h, v in sorted(mine, key=lambda x: x[0])[:p.pivots]:
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.string()), pa.array([dim], pa.int32()), pa.array([h], pa.int64()),
                                                  pa.array([v], pa.list_(pa.float64()))], names=["label", "dim", "h", "v"])

    few = classes.select("label", "dim", F.lit(0).alias("n"), "h", "v").mapInArrow(run, "label string, dim int, h long, v array<double>")
    wanted = F.greatest(F.lit(1), F.least(F.lit(p.pivots), F.ceil(F.col("count") / p.cell_rows))).cast("int")
    merged = few.groupBy("label", "dim").agg(F.sort_array(F.collect_list(F.struct("h", "v"))).alias("all"))
    return merged.join(sizes, ["label", "dim"]).select(
        "label", "dim", "salts", F.transform(F.slice("all", F.lit(1), wanted), lambda x: x["v"]).alias("pivots"))


KEY = ("label", "dim", "salt")


def _salted(table: DataFrame) -> DataFrame:
    """A label's table once for each of its salts."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def _own_cells(classes: DataFrame, pivots: DataFrame) -> DataFrame:
    """Each class with its nearest pivot and its distance; a label's salted groups are of bounded size."""
    out = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("salt", pa.int32()), ("cls", pa.int64()), ("v", pa.list_(pa.float64())),
                     ("cell", pa.int32()), ("far", pa.float64())])

    def run(rows, label):
        if not rows.num_rows:  # a salt without rows
            return out.empty_table()
        piv = _unit(np.array(label.column("pivots")[0].as_py(), dtype=np.float64))
        d = np.sqrt(np.maximum(2 - 2 * _unit(_matrix(rows.column("v"))) @ piv.T, 0))
        return pa.table([*(rows.column(k) for k in ("label", "dim", "salt", "cls", "v")), pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(d.min(axis=1))],
                        names=["label", "dim", "salt", "cls", "v", "cell", "far"])

    return classes.select(*KEY, "cls", "v").groupBy(*KEY).cogroup(_salted(pivots).groupBy(*KEY)).applyInArrow(
        run, "label string, dim int, salt int, cls long, v array<double>, cell int, far double")


def _members(placed: DataFrame, pivots: DataFrame, radii: DataFrame, r: float) -> DataFrame:
    """A row for the own cell of each class and for every other cell that may hold a neighbour."""
    out = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("cls", pa.int64()), ("v", pa.list_(pa.float64())), ("cell", pa.int32()), ("own", pa.bool_())])

    def run(rows, label):
        if not rows.num_rows:
            return out.empty_table()
        piv = _unit(np.array(label.column("pivots")[0].as_py(), dtype=np.float64))
        radius = np.full(len(piv), -np.inf)
        for c in label.column("radii")[0].as_py():
            radius[c["cell"]] = c["radius"]
        cell, far = rows.column("cell").to_numpy(), rows.column("far").to_numpy()
        d = np.sqrt(np.maximum(2 - 2 * _unit(_matrix(rows.column("v"))) @ piv.T, 0))
        between = np.sqrt(np.maximum(2 - 2 * piv @ piv.T, 0))[cell]
        near = (d <= radius[None, :] + r + SLACK) & ((d * d - far[:, None] ** 2) <= 2 * between * (r + SLACK) + SLACK)
        near[np.arange(len(cell)), cell] = True
        i, j = np.nonzero(near)
        take = pa.array(i)
        return pa.table([*(rows.column(k).take(take) for k in ("label", "dim", "cls", "v")), pa.array(j.astype(np.int32)), pa.array(cell[i] == j)],
                        names=["label", "dim", "cls", "v", "cell", "own"])

    cells = radii.groupBy("label", "dim").agg(F.collect_list(F.struct("cell", "radius")).alias("radii"))
    sent = _salted(pivots.join(cells, ["label", "dim"]))
    return placed.groupBy(*KEY).cogroup(sent.groupBy(*KEY)).applyInArrow(
        run, "label string, dim int, cls long, v array<double>, cell int, own boolean")


def _joined(members: DataFrame, copies: DataFrame, p: MetricJoinParams) -> DataFrame:
    """Per (cell block, own class): n, the linked copies of other classes, and edges cls -> least linked class."""
    key = ["label", "dim", "cell"]
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("n_all"), F.sum(F.col("own").cast("long")).alias("n_own"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / p.block_rows)).cast("int")
    rows = members.join(copies, "cls").join(sizes.select(*key, blocks("n_own").alias("S"), blocks("n_all").alias("T")), key)
    mix = F.pmod(F.xxhash64("cls"), F.lit(1 << 30)).cast("int")
    left = rows.filter("own").select(*key, (mix % F.col("S")).alias("s"), F.explode(F.sequence(F.lit(0), F.col("T") - 1)).alias("t"),
                                     "cls", "v", "copies", F.lit(True).alias("left"))
    right = rows.select(*key, F.explode(F.sequence(F.lit(0), F.col("S") - 1)).alias("s"), (mix % F.col("T")).alias("t"),
                        "cls", "v", "copies", F.lit(False).alias("left"))

    def run(t):
        is_left = t.column("left").to_numpy()
        cls, n = t.column("cls").to_numpy(), t.column("copies").to_numpy()
        x = _unit_double(_matrix(t.column("v")))
        a, b = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        label, total = np.arange(len(cls)), np.zeros(len(cls), dtype=np.int64)
        order = np.argsort(cls, kind="stable")  # copies of a class in both roles are one node
        same = np.flatnonzero(cls[order][1:] == cls[order][:-1])
        label = _contract(label, order[same], order[same + 1])
        for at in range(0, len(a), 512):
            rows_ = a[at:at + 512]
            i, j = np.nonzero(x[0][rows_] @ x[0][b].T >= p.threshold * np.outer(x[1][rows_], x[1][b]))
            i, j = rows_[i], b[j]
            other = cls[i] != cls[j]
            i, j = i[other], j[other]
            np.add.at(total, i, n[j])
            label = _contract(label, i, j)
        away = b[cls[label[b]] != cls[b]]
        return pa.table([pa.array(np.r_[cls[a], cls[away]]), pa.array(np.r_[total[a], np.zeros(len(away), dtype=np.int64)]),
                         pa.array(np.r_[cls[label[a]], cls[label[away]]])], names=["cls", "n", "to"])

    return left.union(right).groupBy(*key, "s", "t").applyInArrow(run, "cls long, n long, to long")


def _unit_double(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors and their norms; scaled by powers of two so that no product leaves the doubles."""
    scale = np.exp2(-np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True))))
    x = x * scale
    return x, np.sqrt((x * x).sum(axis=1))


def near_vectors(vectors: DataFrame, p: MetricJoinParams = MetricJoinParams()) -> DataFrame:
    """Per row: vec_id, n_links (other vectors linked directly), component_id, kept (vec_id = component_id)."""
    with_package(vectors.sparkSession)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                         F.col("embedding").cast("array<double>").alias("v"))
    own = materialize(own)
    classes = classes_of(own)
    # a class is named by its hash order: one number for each distinct (label, vector), written once
    classes = materialize(classes.withColumn("h", F.xxhash64("label", "v")).withColumn("dim", F.size("v")).withColumn(
        "cls", F.monotonically_increasing_id()))
    sizes = materialize(classes.groupBy("label", "dim").count().withColumn("salts", F.ceil(F.col("count") / p.group_rows).cast("int")))
    pivots = materialize(_label_pivots(classes, sizes, p))
    classes = classes.join(sizes.drop("count"), ["label", "dim"]).withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts").cast("long")).cast("int"))
    placed = materialize(_own_cells(classes, pivots))
    radii = placed.groupBy("label", "dim", "cell").agg(F.max("far").alias("radius"))
    r = float(np.sqrt(2 - 2 * p.threshold))
    found = materialize(_joined(_members(placed, pivots, radii, r), classes.select("cls", "copies"), p))
    links = found.groupBy("cls").agg(F.sum("n").alias("n"))
    linked = components(found.filter("cls <> to").select("cls", "to").distinct())
    member = materialize(classes.join(links, "cls", "left").join(linked, classes["cls"] == linked["node"], "left").select(
        "label", "v", "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component")))
    least = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    result = member.join(least, "component").select(F.xxhash64("label", "v").alias("h"), F.col("label").alias("_label"), F.col("v").alias("_v"), "n_links", "component_id")
    o = own.withColumn("h", F.xxhash64("label", "v"))
    return o.join(result, (o["h"] == result["h"]) & o["label"].eqNullSafe(result["_label"]) & o["v"].eqNullSafe(result["_v"]), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").isNull() & F.col("component_id").isNull()).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""
