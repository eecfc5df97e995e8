"""Event-time windows over the payment and click streams (batch form; the
streaming form is in :mod:`quayside.streaming.payments`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.time import epoch_micros, micros_to_ntz
from quayside.operators.sequence import running_sum

MICROS = 1_000_000


def payment_windows(payments: DataFrame, size: str = "1 day", slide: str | None = None,
                    keys=("status",)) -> DataFrame:
    """Tumbling (or sliding, with ``slide``) windows: count and amount per key."""
    w = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
    return (payments.groupBy(w.start.alias("window_start"), w.end.alias("window_end"), *keys)
            .agg(F.count(F.lit(1)).alias("payments"),
                 F.sum("amount").cast("decimal(38,2)").alias("amount")))


def counts_in_span(times: DataFrame, group_cols, time_col: str, count_col: str, span: int) -> DataFrame:
    """(group, time, ``in_span``, ``count_col``): the counts at times in (time - span, time], for rows whose
    (group, time) is unique; times and span are integers.

    A sweep: a count comes in at its time and goes out ``span`` later, so what is in the span is
    a running sum of both. That sum is spread over slices, so neither a hot group nor
    a hot hour of it is one task's.
    """
    comes = times.select(*group_cols, time_col, F.col(count_col).alias("_d"), F.col(count_col))
    goes = times.where(F.col(time_col).isNotNull()).select(
        *group_cols, (F.col(time_col) + F.lit(span)).alias(time_col), (-F.col(count_col)).alias("_d"), F.lit(0).cast("bigint").alias(count_col))
    steps = comes.withColumn("_d", F.when(F.col(time_col).isNotNull(), F.col("_d")).otherwise(0)).unionByName(goes)
    steps = steps.groupBy(*group_cols, time_col).agg(F.sum("_d").alias("_d"), F.sum(count_col).alias(count_col))
    return running_sum(steps, group_cols, time_col, "_d", "in_span").drop("_d")


def spike_windows(payments: DataFrame, size_seconds: int = 16 * 3600, share: float = 0.1, ts: str = "event_ts") -> DataFrame:
    """(window_start, window_end, payments, share) of the densest intervals of ``size_seconds``, from any
    start, that hold ``share`` of all payments or more.

    Payments are counted per event time first. Of intervals that overlap, however many in a chain, the one
    with most payments is returned (the earliest of those). Rows without a time count in the total alone.
    """
    size = size_seconds * MICROS
    times = payments.where(F.col(ts).isNotNull()).groupBy((-epoch_micros(ts)).alias("back")).agg(F.count(F.lit(1)).alias("n"))
    # backwards in time, what lies in the span behind is what an interval that starts here holds
    starts = counts_in_span(times, [], "back", "n", size).where("n > 0").select((-F.col("back")).alias("us"), "in_span")
    total = payments.select(F.count(F.lit(1)).alias("n")).scalar()
    dense = starts.where(F.col("in_span") >= F.lit(share) * total)
    # starts less than a size apart overlap: those of a block all do, so a block is one row
    blocks = dense.groupBy(F.floor(F.col("us") / F.lit(size)).alias("block")).agg(
        F.min("us").alias("first"), F.max("us").alias("last"), F.max(F.struct("in_span", (-F.col("us")).alias("back"))).alias("best"))
    order = Window.orderBy("block")  # a few rows: each spike spans two or three blocks, and there are at most 1 / share of them
    new = F.coalesce(F.col("first") - F.lag("last").over(order) >= F.lit(size), F.lit(True))
    chains = blocks.withColumn("_new", new.cast("int")).withColumn("chain", F.sum("_new").over(order))
    best = chains.groupBy("chain").agg(F.max("best").alias("best"))
    start = micros_to_ntz(-F.col("best.back"))
    return best.select(start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(size_seconds))).alias("window_end"),
                       F.col("best.in_span").alias("payments"), (F.col("best.in_span") / total).alias("share"))


def max_events_in_span(events: DataFrame, key: str, ts: str, span_seconds: int = 240) -> DataFrame:
    """Per key: its events and the largest number of them inside any ``span`` (strictly shorter than
    ``span_seconds``, counted back from each event). Events are counted per (key, time) first, map-side;
    events without a time are in no span."""
    times = events.groupBy(F.col(key), epoch_micros(ts).alias("us")).agg(F.count(F.lit(1)).alias("n"))
    return counts_in_span(times, [key], "us", "n", span_seconds * MICROS).groupBy(key).agg(
        F.max("in_span").alias("max_events_in_span"), F.sum("n").alias("events"))


def bot_sessions(events: DataFrame, min_events: int = 120, span_seconds: int = 240) -> DataFrame:
    """Sessions with ``min_events`` or more events inside ``span_seconds``."""
    return (max_events_in_span(events, "session_id", "event_ts", span_seconds)
            .withColumn("is_bot", F.col("max_events_in_span") >= F.lit(min_events)))
