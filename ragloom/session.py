"""Session helpers: a tuned builder for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "ragloom",
              scan_split_bytes: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, the UI off and Arrow enabled.

    On a cluster pass ``master=None`` and let spark-submit decide; partitions are
    sized by AQE from the advisory size, so the initial number only bounds it.
    ``scan_split_bytes`` sets ``spark.sql.files.maxPartitionBytes``: larger scan splits mean
    fewer search tasks, and each task emits at most ``queries × k`` candidates.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RAGLOOM_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if scan_split_bytes:
        b = b.config("spark.sql.files.maxPartitionBytes", str(scan_split_bytes))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) a fresh scratch folder is
    created and registered; on a cluster the configured shared folder is used.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="ragloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def write_once(df: DataFrame, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: its plan runs once, however
    often the result is read, and a lost executor costs a re-read of the written files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ragloom`` importable in the Python workers of this application.

    Operators that run Python in tasks (``mapInArrow``, ``pandas_udf``, ``applyInPandas``)
    call this first. The package is zipped once per SparkContext and added with
    ``addPyFile``, which Spark distributes to every executor (the same as ``--py-files``).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="ragloom-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "ragloom"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="ragloom")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
