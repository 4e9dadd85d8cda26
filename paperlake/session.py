"""Session helpers shared by every layer: table loading, shared working folder, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; a file or a directory of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """For work that costs much more than moving the rows: an input of fewer partitions than there are cores (a small
    single file) is spread by ``keys``; any other stays as it was read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir if the cluster names one.

    Only where the setting is absent (single-JVM sessions, tests) a temporary folder is made; it is then set for the
    whole session, so later calls agree.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if configured is None:
        configured = tempfile.mkdtemp(prefix="paperlake-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the frame once into the shared folder and read it back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only when the optimizer's own size estimate is below the limit; else leave the join to AQE."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= limit else df


def fs(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for a path, whatever the storage."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
