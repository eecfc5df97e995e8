"""Dense per-group sequence numbers without a single-task window.

``row_number() OVER (PARTITION BY g ORDER BY k)`` puts each group in one task;
a Kafka partition can hold an eighth of a topic (or a third under skew). This
computes the same numbers in three distributed steps:

1. range-partition on (g, k) - sampled bounds split a hot group across many
   slices - and sort inside each slice, so a group's rows in one slice are
   contiguous and ``monotonically_increasing_id`` rises along the sort order;
2. aggregate (slice, g) -> first id and row count: at most slices x groups rows;
3. a running sum over that small table gives each slice's starting number;
   rows get ``start + (id - first id)``.

The numbered frame is written once as a Parquet table in the shared
``spark.checkpoint.dir`` (columnar, compressed - cheaper than an RDD
checkpoint): ids depend on the physical layout, so both sides of the join -
and any task retried after an executor loss - must read the same materialised
rows rather than re-run the range shuffle. The small side isn't
forced into a broadcast: the planner goes by its real size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.sinks.lake_write import stage


def dense_sequence(df: DataFrame, group_col: str, order_cols: list[str], out_col: str,
                   slices: int | None = None) -> DataFrame:
    ranged = stage(slice_and_number(df, group_col, order_cols, slices), "dense-sequence")
    return assign_sequence(ranged, group_col, out_col)


def slice_and_number(df: DataFrame, group_col: str, order_cols: list[str],
                     slices: int | None = None) -> DataFrame:
    """Step 1: range-partition, sort, and tag rows with (slice, row id).

    Must be materialised (staged or landed) before :func:`assign_sequence`."""
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(slices, group_col, *order_cols)
              .sortWithinPartitions(group_col, *order_cols)
              .withColumn("_slice", F.spark_partition_id())
              .withColumn("_rid", F.monotonically_increasing_id()))


def assign_sequence(ranged: DataFrame, group_col: str, out_col: str) -> DataFrame:
    """Steps 2-3 over a materialised :func:`slice_and_number` output."""
    return number_by_slice(ranged, slice_starts(ranged, group_col), group_col, out_col)


def slice_starts(ranged: DataFrame, group_col: str) -> DataFrame:
    """Step 2 and the running sum: per (slice, group) its first id and its starting number."""
    stats = ranged.groupBy("_slice", group_col).agg(F.min("_rid").alias("_first"),
                                                    F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group_col).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return stats.select("_slice", group_col, "_first",
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))


def number_by_slice(ranged: DataFrame, starts: DataFrame, group_col: str, out_col: str) -> DataFrame:
    """Step 3: ``start + (id - first id)``."""
    joined = ranged.join(starts, ["_slice", group_col])
    return (joined.withColumn(out_col, F.col("_start") + F.col("_rid") - F.col("_first"))
                  .drop("_slice", "_rid", "_first", "_start"))


def running_max_before(df: DataFrame, group_col: str, order_col: str, value_col: str, out_col: str,
                       slice_size: int = 1_000_000) -> DataFrame:
    """``max(value) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING TO 1 PRECEDING)``
    for an integral, dense-ish order column (a Kafka offset), without one task
    per group.

    Rows are cut into slices of ``slice_size`` consecutive order values. The
    running max inside a slice is a window over (g, slice) - at most
    ``slice_size`` rows each; the carry-in from earlier slices is a running max
    over the per-slice maxima, a table of (rows / slice_size) + groups rows.
    That table grows with the data, so it is not force-broadcast: the join is
    on (g, slice), which the in-slice window already hash-partitioned the big
    side by, so only the small carry table moves (or AQE broadcasts it once
    its real size is known).
    """
    sliced = df.withColumn("_slice", F.floor(F.col(order_col) / F.lit(slice_size)))
    per_slice = sliced.groupBy(group_col, "_slice").agg(F.max(value_col).alias("_slice_max"))
    earlier = Window.partitionBy(group_col).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(group_col, "_slice", F.max("_slice_max").over(earlier).alias("_carry"))
    inside = Window.partitionBy(group_col, "_slice").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_local", F.max(value_col).over(inside))
    out = local.join(carry, [group_col, "_slice"], "left")
    best = F.when(F.col("_carry").isNull(), F.col("_local")).when(F.col("_local").isNull(), F.col("_carry")) \
        .otherwise(F.greatest("_carry", "_local"))
    return out.withColumn(out_col, best).drop("_slice", "_local", "_carry")


def _in_slices(df: DataFrame, group_cols, order_cols, name: str) -> DataFrame:
    """Rows range-partitioned by (group, order) and tagged with their slice; written once, as slices are sampled."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(slices, *group_cols, *order_cols).withColumn("_slice", F.spark_partition_id()), name)


def _joined(rows: DataFrame, per_slice: DataFrame, group_cols) -> DataFrame:
    """``rows`` with the other columns of ``per_slice``, one row per (slice, group); null groups are groups."""
    same = rows["_slice"] == per_slice["_slice"]
    for g in group_cols:
        same = same & rows[g].eqNullSafe(per_slice[g])
    more = [per_slice[c] for c in per_slice.columns if c not in ("_slice", *group_cols)]
    return rows.join(per_slice, same, "left").select(*[rows[c] for c in rows.columns], *more)


def running_sum(df: DataFrame, group_cols, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """``sum(value) OVER (PARTITION BY group ORDER BY order)`` for rows whose (group, order) is unique,
    a group of any size being spread over slices: a sum within the slice, plus the sums of the
    group's slices before it, a table of slices x groups rows."""
    rows = _in_slices(df, group_cols, [order_col], "running-sum")
    per_slice = rows.groupBy("_slice", *group_cols).agg(F.sum(value_col).alias("_total"))
    earlier = Window.partitionBy(*group_cols).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select("_slice", *group_cols, F.sum("_total").over(earlier).alias("_carry"))
    inside = Window.partitionBy("_slice", *group_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", F.sum(value_col).over(inside))
    return _joined(local, carry, group_cols).withColumn(
        out_col, F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0))).drop("_slice", "_local", "_carry")


def previous_value(df: DataFrame, group_cols, order_cols, value_col: str, out_col: str, slice_cols=()) -> DataFrame:
    """``lag(value) OVER (PARTITION BY group ORDER BY order)``, a group of any size being spread over
    slices: the lag within the slice, before whose first row stands a row with the last value of the slice before.

    ``slice_cols``: columns that rise with the order (equal orders, equal slices) and cut it into slices that a task
    can hold. Without any the rows are range-partitioned by sampled bounds, and written once for that."""
    rows = df if slice_cols else _in_slices(df, group_cols, order_cols, "previous-value")
    slices = list(slice_cols) or ["_slice"]
    per_slice = rows.groupBy(*slices, *group_cols).agg(F.max(F.struct(*order_cols, value_col)).alias("_last"))
    carry = per_slice.select(*slices, *group_cols, F.lit(True).alias("_carry"), F.lag(F.col(f"_last.{value_col}")).over(
        Window.partitionBy(*group_cols).orderBy(*slices)).alias(value_col)).where(F.col(value_col).isNotNull())
    every = rows.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    inside = Window.partitionBy(*slices, *group_cols).orderBy(F.col("_carry").desc(), *order_cols)
    return every.withColumn(out_col, F.lag(value_col).over(inside)).where(~F.col("_carry")).select(*df.columns, out_col)
