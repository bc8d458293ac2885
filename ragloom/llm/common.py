"""Shared helpers of the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ragloom.session import checkpoint_dir, ship_package

#: ASCII white space: space, tab, newline, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]+"


def new_path(spark: SparkSession) -> str:
    """A path of its own in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the shared files, and values that a
    task numbered (partition ids, row positions) stay as written."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_package(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers."""
    ship_package(spark)
    return spark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` uses it.

    A lambda variable is never inlined by the optimizer, unlike a column of an earlier projection."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words between ASCII white space, in order; an empty array for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")
