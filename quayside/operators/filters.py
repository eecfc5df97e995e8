"""Incremental-window and offset filters."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_since(df: DataFrame, column: str, start) -> DataFrame:
    """Keep ``column >= start``; ``start=None`` keeps everything.

    ``start`` may be a Python value or a Column (e.g. a scalar subquery). On a
    partition column the predicate becomes a partition filter.
    """
    if start is None:
        return df
    if isinstance(start, Column):
        bound = start
    elif isinstance(start, _dt.datetime):
        # naive datetime -> NTZ literal from text: no time-zone conversion
        bound = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    elif isinstance(start, _dt.date):
        bound = F.lit(start.isoformat()).cast("date")
    else:
        bound = F.lit(start)
    return df.where(F.col(column) >= bound)


def filter_new_offsets(df: DataFrame, saved_offsets: DataFrame | None,
                       partition_col: str = "kafka_partition",
                       offset_col: str = "kafka_offset", strict: bool = True) -> DataFrame:
    """Keep rows whose offset is beyond the saved offset of their partition
    (an unseen partition counts as -1). Lenient, rows whose partition or offset
    is no number are kept too.

    ``saved_offsets`` has one row per Kafka partition (partition, offset) - a
    few dozen rows - so it is broadcast; the feed itself is never shuffled.
    """
    if saved_offsets is None:
        return df
    saved = F.broadcast(saved_offsets.select(
        F.col(partition_col).cast("int").alias("_p"), F.col(offset_col).cast("bigint").alias("_saved")))
    number = lambda c, t: F.col(c).cast(t) if strict else F.col(c).try_cast(t)
    joined = df.join(saved, number(partition_col, "int") == F.col("_p"), "left")
    offset = number(offset_col, "bigint")
    keep = offset > F.coalesce(F.col("_saved"), F.lit(-1).cast("bigint"))
    if not strict:
        keep = keep | offset.isNull() | number(partition_col, "int").isNull()
    return joined.where(keep).drop("_p", "_saved")


def window_start(mark, watermark_days: int):
    """``mark - N days`` for a Python date/datetime/ISO string (None stays None)."""
    if mark is None:
        return None
    if isinstance(mark, str):
        mark = _dt.datetime.fromisoformat(mark)
    return mark - _dt.timedelta(days=watermark_days)


def incremental_window(raw: DataFrame, column: str, watermark_days: int = 7,
                       floor_to_day: bool = False, mark: Column | None = None) -> DataFrame:
    """Re-read ``[mark - N days, ...]`` where ``mark`` is the high-water mark.

    Without an explicit ``mark`` it is ``max(column)`` of the feed, planned as a
    scalar subquery (one small job, no join). ``floor_to_day`` widens the start
    to midnight so a day partition that is replaced whole is also re-read whole.
    """
    if mark is None:
        mark = raw.select(F.max(column)).scalar()
    start = mark - F.make_dt_interval(F.lit(watermark_days))
    if floor_to_day:
        start = F.to_date(start).cast("timestamp_ntz")  # zone-free midnight
    if dict(raw.dtypes).get(column) == "date":
        start = F.to_date(start)
    return filter_since(raw, column, start)
