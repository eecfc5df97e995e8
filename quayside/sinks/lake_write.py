"""Lake sinks: partitioned Parquet, single-file tables, keyed merges and the
control table that commits a run's marks last."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path

MAX_RECORDS_PER_FILE = 250_000
ROW_GROUP_BYTES = 128 * 1024 * 1024
CODEC = "zstd"  # of lake tables and of what is staged or landed for them


# ---- file-system helpers (Hadoop FS: works on HDFS/S3/ABFS alike) ------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def make_directory(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    _, q = _fs(spark, dst)
    return fs.rename(p, q)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if it doesn't exist."""
    fs, p = _fs(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def has_parquet(spark: SparkSession, path: str) -> bool:
    if not path_exists(spark, path):
        return False
    fs, p = _fs(spark, path)
    it = fs.listFiles(p, True)
    while it.hasNext():
        if it.next().getPath().getName().endswith(".parquet"):
            return True
    return False


# ---- sinks -------------------------------------------------------------------

def sink_partitioned(df: DataFrame, root: str, partition_col: str,
                     max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Hive layout; replaces only the partitions present in ``df``.

    ``rebalance`` on the partition column lets AQE split a hot partition value
    (one busy day) across tasks and merge small ones, so file count and size
    track data volume instead of task count x partition values. An empty frame
    replaces nothing.
    """
    (df.hint("rebalance", partition_col)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records)
       .option("parquet.block.size", ROW_GROUP_BYTES)
       .partitionBy(partition_col)
       .parquet(root))


def sink_single(df: DataFrame, path: str) -> None:
    """Small dimension (partners: bounded by partners x versions) as one file.

    ``repartition``, not ``coalesce``: only the write is one task, what leads to
    the rows keeps its own."""
    df.repartition(1).write.mode("overwrite").parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    whole plan) and lets a job overwrite the table it read from.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for f in frames:
        delete_path(f.sparkSession, f._staged)


def latest_by_key(rows: DataFrame, keys, order) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert_keyed(target: DataFrame | None, delta: DataFrame, keys, order=None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET <all other columns>``.

    Returns the merged snapshot: per key the delta row wins over the target
    row (``_src`` rank); inside the delta the greatest ``order`` (then the
    later ``_seq``) wins. ``order`` given -> that order decides across target
    and delta too (payments: greatest (partition, offset)). Rows that neither
    tells apart go by a hash of all their columns, so the winner never depends
    on how the rows lie in files or partitions.
    """
    keys = list(keys)
    cols = [c for c in delta.columns if c != "_seq"]
    d = delta.withColumn("_src", F.lit(1))
    if "_seq" not in delta.columns:
        d = d.withColumn("_seq", F.lit(0).cast("bigint"))
    if target is None:
        rows = d
    else:
        t = target.select(*cols).withColumn("_src", F.lit(0)).withColumn("_seq", F.lit(0).cast("bigint"))
        rows = t.unionByName(d.select(*cols, "_src", "_seq"))
    rank = ([F.col(c) if isinstance(c, str) else c for c in order] if order else []) + \
        [F.col("_src"), F.col("_seq"), F.xxhash64(*cols)]
    return latest_by_key(rows, keys, rank).select(*cols)


# ---- control table -----------------------------------------------------------

def read_control(spark: SparkSession, state_root: str) -> dict:
    """Latest committed marks: {'events': iso, 'transactions': iso,
    'payment_offsets': {partition: offset}}; {} before the first run."""
    path = f"{state_root.rstrip('/')}/control"
    if not has_parquet(spark, path):
        return {}
    rows = (spark.read.parquet(path).orderBy(F.col("run_id").desc()).limit(1).collect())
    return json.loads(rows[0]["marks"]) if rows else {}


def commit_control(spark: SparkSession, state_root: str, marks: dict, run_id: int) -> None:
    """Append one control row; written only after every sink succeeded, so a
    crashed run leaves the previous marks in force (the rerun redoes it)."""
    row = [(run_id, json.dumps(marks, sort_keys=True, default=str),
            _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))]
    df = spark.createDataFrame(row, "run_id long, marks string, committed_at timestamp_ntz")
    df.coalesce(1).write.mode("append").parquet(f"{state_root.rstrip('/')}/control")
