"""High-water marks and per-partition offsets (the incremental state)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_mark(raw: DataFrame, column: str) -> DataFrame:
    """One row: max(column) over all raw rows (NULL when empty)."""
    return raw.agg(F.max(column).alias("high_water_mark"))


def max_offset_by_partition(seen: DataFrame, saved: DataFrame | None = None,
                            partition_col: str = "kafka_partition",
                            offset_col: str = "kafka_offset", strict: bool = True) -> DataFrame:
    """max(saved, seen) per partition.

    Partial aggregation collapses the feed to one row per (map task, partition)
    before the shuffle, so a partition holding most of the topic costs nothing
    extra.
    """
    number = lambda c, t: F.col(c).cast(t) if strict else F.col(c).try_cast(t)
    rows = seen.select(number(partition_col, "int").alias("kafka_partition"), number(offset_col, "bigint").alias("kafka_offset"))
    if not strict:  # what is no number is quarantined, not remembered
        rows = rows.where("kafka_partition is not null and kafka_offset is not null")
    if saved is not None:
        rows = rows.unionByName(saved.select(F.col("kafka_partition").cast("int"),
                                             F.col("kafka_offset").cast("bigint")))
    return rows.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("kafka_offset"))
