"""Session construction and scratch-space helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes are cluster-neutral defaults; a cluster
# submit overrides shuffle partitions and file split size for its data volume.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MB input splits and writes: partitions stay well inside executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "quayside", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict):
    """The session with these settings within, as before after it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def released_shuffles(spark: SparkSession):
    """Shuffle files of a statement that ends within go with it, not when the driver's heap is next collected: several
    statements one after the other hold the disk of the largest, not of them all."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, to shared storage (HDFS/S3/ABFS): executors
    can't read a folder of the driver's machine. Only a local master gets a
    fresh local folder when it is unset (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory under the checkpoint root for staged tables."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
