"""Session helpers: a local session for tests, the shared scratch folder, scan spreading."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str | int = "*", app: str = "redactory", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Executors and driver must both reach it, so a machine-local folder is only accepted for a
    ``local[...]`` master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _own_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df``, written to the shared scratch folder and read again: it is computed once, and what was written survives
    lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="redactory-")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that cannot keep the cores busy; leave every larger scan alone.

    Pattern matching is CPU work, and a small file with a single row group is read by one task
    whatever the number of splits. Spark cuts small inputs into about one split per core, so
    fewer than two splits per core marks an input that is cheap to shuffle. Large inputs have
    far more splits and keep the shuffle-free plan. Name a unique column in ``keys``: rows that are
    dealt out without one are sorted first, so that repeated tasks deal them out alike.
    """
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a table or stream dealt out to all cores by their keys, whatever files they come from.

    For tables whose rows are small but take long: a million keys from which texts are made fill one row group, which one
    task reads. Rows of equal keys stay together, so repeated tasks deal them out alike; name keys that rarely repeat.
    A stream reads some files at a time, which may have been dealt out by the same keys: it goes by a hash of its own, or
    the rows of each file would meet in one task again.
    """
    by = [F.xxhash64(*keys)] if df.isStreaming else keys
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *by)
