"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import materialize


def _minima(both: DataFrame) -> DataFrame:
    """Per node u its smallest neighbour or itself; combined map-side, so a hot node costs one row a task."""
    return both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minima(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` holds u > v only."""
    m = e.groupBy("u").agg(F.min("v").alias("m"))
    return e.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(m)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns); component: its smallest node.

    Each step is written once in the shared checkpoint folder; only two sums of a step reach the
    driver, to see when nothing changes. Null ends and loops are left out; repeated edges count once."""
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = materialize(e.distinct())
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        e = materialize(_small_star(_large_star(e).distinct()).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
