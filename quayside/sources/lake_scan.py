"""Lake scans: Parquet datasets and the file inventory of a lake root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_lake(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


ARRIVAL = ["arrived_at", "arrived_in", "arrived_as"]


def in_arrival_order(spark: SparkSession, path: str, schema=None) -> tuple[DataFrame, list[str]]:
    """A landed Parquet feed and the columns that order its rows as they arrived: modification time of the
    file, its path, the row's position in it. Files that one job wrote at once can finish in
    any order: where their paths carry the order, use the last two columns alone."""
    rows = scan_lake(spark, path, schema)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("arrived_at"),
                       F.col("_metadata.file_path").alias("arrived_in"), F.col("_metadata.row_index").alias("arrived_as")), list(ARRIVAL)


def scan_file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``.parquet`` file under ``root``: path, bytes, dataset, partition.

    ``binaryFile`` lists files in parallel; selecting only ``path``/``length``
    prunes the ``content`` column, so no file body is read. ``dataset`` is the
    first directory under ``root``; ``partition`` the deepest ``k=v`` directory.
    """
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(root).select("path", "length"))
    rel = F.regexp_extract("path", r"^.*?" + _escape(root.split("://")[-1]) + r"/(.*)$", 1)
    return files.select(
        "path", F.col("length").alias("bytes"),
        F.regexp_extract(rel, r"^([^/]+)/", 1).alias("dataset"),
        F.regexp_extract("path", r"/([^/=]+=[^/]*)/[^/]+$", 1).alias("partition"),
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("partition_path"),
    )


def _escape(text: str) -> str:
    import re
    return re.escape(text)
