"""The payment feed as a Structured Streaming job.

Source: files landing in a directory (a Kafka topic in production: swap
``readStream.parquet`` for ``readStream.format("kafka")``; the rest is
unchanged). The stream checkpoint records which input was consumed, so a
restart resumes exactly after the last committed micro-batch.

Latest delivery wins, in two places. Streaming state (RocksDB) holds, for ``life`` after a key's
first delivery in it, the key's delivery of greatest (partition, offset), so repeated deliveries
collapse before they reach the table. The state's clock is arrival: nothing can come too late for
it. Older deliveries are in the target, a :class:`~quayside.sinks.lake_table.LakeTable`, whose key
locator leads a micro-batch to its own keys. The merge is idempotent, so a replayed batch is
harmless: exactly-once effect on an at-least-once feed.

Event-time windows have a watermark: what is behind it goes to a table of late rows instead
of a window, so windows and late rows together are the feed. Watermark and windows change by one
commit, which also names the micro-batch, so a replayed one isn't added twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.contracts import SCHEMAS
from quayside.functions.time import epoch_micros, micros_to_ntz
from quayside.operators.normalize import normalize_payments
from quayside.session import released_shuffles, settings
from quayside.sinks.lake_table import LakeTable
from quayside.sinks.lake_write import CODEC, stage, unstage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

WINDOW_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("status", T.StringType()), T.StructField("payments", T.LongType()), T.StructField("amount", T.DecimalType(38, 2)),
    T.StructField("window_month", T.DateType())])
LATE_SCHEMA = T.StructType([*SCHEMAS["payments"].fields, T.StructField("watermark", T.TimestampNTZType()),
                            T.StructField("event_month", T.DateType())])


def ntz_to_instant(c) -> Column:
    """NTZ wall clock -> the TIMESTAMP instant with the same UTC wall clock."""
    return F.timestamp_micros(epoch_micros(c))


def instant_to_ntz(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return micros_to_ntz(F.unix_micros(c))


def land_in_chunks(feed: DataFrame, landing: str, order_col, chunks: int, after=None) -> list[int]:
    """Write ``feed`` into ``landing`` as ``chunks`` successive deliveries cut on
    ``order_col`` (an arrival order). ``after`` runs after each, e.g. a stream
    that consumes what is there, so a delivery is a micro-batch of its own
    however many files it has. Rows without an order come with the last. Returns the
    row count per chunk; all of them together must be the feed's."""
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    lo, hi, rows = feed.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    if not rows:
        return []
    if lo is None:
        lo_v = hi_v = 0.0
        key = F.lit(None).cast("double")
    elif hasattr(lo, "timestamp"):  # naive wall clock: seconds from the epoch, no local zone
        import datetime as _dt
        epoch = _dt.datetime(1970, 1, 1)
        lo_v, hi_v = (lo - epoch).total_seconds(), (hi - epoch).total_seconds()
        key = (epoch_micros(order) / 1_000_000).cast("double")
    else:
        lo_v, hi_v, key = float(lo), float(hi), order.cast("double")
    width = (hi_v - lo_v) / chunks or 1.0
    counts = []
    for k in range(chunks):
        start, end = lo_v + k * width, lo_v + (k + 1) * width
        cond = (key >= start) & (key < end) if k < chunks - 1 else (key >= start) | key.isNull()
        seen = Observation(f"chunk-{k}")
        feed.where(cond).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").option("compression", CODEC).parquet(landing)
        counts.append(seen.get["rows"])
        if after:
            after()
    if sum(counts) != rows:
        raise RuntimeError(f"landed {sum(counts)} of {rows} rows")
    return counts


def payment_stream(spark: SparkSession, landing: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """``files_per_trigger`` bounds a micro-batch; None takes all that is there."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(landing)


def _rocksdb(spark: SparkSession, release: bool = False):
    """Streams started within keep their state in RocksDB: on local disk and in the checkpoint, not on the heap, in
    blocks of zstd large enough to hold many rows of a kind. ``release``: a task gives up its local copy once it has
    committed, as no later micro-batch of the run needs it; the next run loads the checkpoint's."""
    rocksdb = "spark.sql.streaming.stateStore.rocksdb"
    return settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, f"{rocksdb}.compression": CODEC,
                            f"{rocksdb}.blockSizeKB": "32", "spark.sql.streaming.stateStore.unloadOnCommit": str(release).lower()})


def _run(query) -> int:
    """Wait for an availableNow query; rows it took in."""
    q = query.trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(p.get("numInputRows", 0) for p in q.recentProgress)


def latest_deliveries(stream: DataFrame, key: str, partition: str, offset: str, life: str) -> DataFrame:
    """Per key the delivery of greatest (partition, offset) among those of the last ``life`` (in update mode:
    of keys that were delivered again). State is dropped when its arrival window is over."""
    columns = stream.columns
    order = F.struct(F.col(partition).cast("int").alias("p"), F.col(offset).cast("bigint").alias("o"))
    arriving = stream.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", "0 seconds")
    best = arriving.groupBy(F.col(key).alias("_key"), F.window("_arrival", life)).agg(
        F.max_by(F.struct(*columns), order).alias("r"))
    return best.select("r.*")


def merge_payments_batch(table: LakeTable, done: list | None = None):
    """foreachBatch body: merge the keys of a micro-batch, normalized, by event_id. The batch is
    written once to the shared folder, as the merge reads it several times."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        rows = stage(normalize_payments(batch), "micro-batch")
        result = table.merge(rows, [F.col("kafka_partition"), F.col("kafka_offset")])
        unstage(rows)
        if done is not None:
            done.append(result)
    return apply


def run_payment_stream(spark: SparkSession, landing: str, table: str, checkpoint: str, schema,
                       files_per_trigger: int | None = None, life: str = "7 days") -> dict:
    """Consume everything available now, merge it, stop. Returns totals and what each merge did."""
    done: list[dict] = []
    stream = payment_stream(spark, landing, schema, files_per_trigger)
    with _rocksdb(spark, release=not files_per_trigger), released_shuffles(spark):
        rows = _run(latest_deliveries(stream, "event_id", "kafka_partition", "kafka_offset", life).writeStream
                    .outputMode("update").option("checkpointLocation", checkpoint)
                    .foreachBatch(merge_payments_batch(LakeTable.of(spark, table, "payments"), done)))
    return {"batches": sum(1 for d in done if d["batch_rows"]), "input_rows": rows, "merges": done}


# ---- event-time windows with a watermark and a table of late rows ------------------

def window_table(spark: SparkSession, root: str) -> LakeTable:
    return LakeTable(spark, root, WINDOW_SCHEMA, ["window_start", "window_end", "status"], "window_month", "window_start")


def late_table(spark: SparkSession, root: str) -> LakeTable:
    """Rows that came behind the watermark, each with the watermark it was behind; a record of the feed once."""
    return LakeTable(spark, root, LATE_SCHEMA, ["kafka_partition", "kafka_offset"], "event_month", "event_ts")


def _count_in_windows(rows: DataFrame, size: str, slide: str | None) -> DataFrame:
    """Counts and amounts per window and status; rows without an event time are a null window."""
    none = F.lit(None).cast("timestamp_ntz")
    w = F.window("event_ts", size, slide) if slide else F.window("event_ts", size)
    timed = rows.where(F.col("event_ts").isNotNull()).select(w.alias("w"), "status", "amount").select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "status", "amount")
    untimed = rows.where(F.col("event_ts").isNull()).select(none.alias("window_start"), none.alias("window_end"), "status", "amount")
    return timed.unionByName(untimed).groupBy("window_start", "window_end", "status").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").cast("decimal(38,2)").alias("amount"))


def add_to_windows(table: LakeTable, counts: DataFrame, properties: dict) -> None:
    """Add counts per window to the table's, reading the months of these windows alone; ``properties``
    are committed with them."""
    counts = stage(counts.withColumn("window_month", F.trunc(F.to_date("window_start"), "month")), "window-counts")
    months = [r[0] for r in counts.select(F.col("window_month").cast("string")).distinct().collect()]  # a row per month
    old = table.of_partitions(months)
    same = F.lit(True)
    for k in table.keys:
        same = same & counts[k].eqNullSafe(old[k])
    both = counts.join(old, same, "left").select(
        *[counts[k] for k in table.keys], (counts["payments"] + F.coalesce(old["payments"], F.lit(0))).alias("payments"),
        F.when(counts["amount"].isNull() & old["amount"].isNull(), F.lit(None)).otherwise(
            F.coalesce(counts["amount"], F.lit(0)) + F.coalesce(old["amount"], F.lit(0))).cast("decimal(38,2)").alias("amount"),
        counts["window_month"])
    both = stage(both, "window-sums")
    table.merge(both, properties=properties)
    unstage(counts, both)


def window_batch(windows: LakeTable, late: LakeTable, size: str, delay_seconds: int, slide: str | None):
    """foreachBatch body. The watermark of a batch is the greatest event time of the batches before it,
    less the delay; rows below it are late. Late rows are written first, by a merge that can be
    repeated; then windows, watermark and epoch by one commit."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        state = windows.manifest().get("properties", {})
        if state.get("epoch", -1) >= epoch_id:  # a replay of what is committed
            return
        rows = stage(normalize_payments(batch), "micro-batch")
        seen = state.get("greatest")
        time = epoch_micros(F.col("event_ts"))
        if seen is not None:
            mark = seen - delay_seconds * 1_000_000
            behind = F.coalesce(time < F.lit(mark), F.lit(False))
            passed = stage(rows.where(behind).withColumns({
                "watermark": micros_to_ntz(F.lit(mark)), "event_month": F.trunc(F.to_date("event_ts"), "month")}), "late")
            late.merge(passed)
            unstage(passed)
        else:
            behind = F.lit(False)
        top, n, n_late = rows.agg(F.max(time), F.count(F.lit(1)), F.count_if(behind)).first()
        greatest = max((x for x in (seen, top) if x is not None), default=None)
        add_to_windows(windows, _count_in_windows(rows.where(~behind), size, slide), {
            "epoch": epoch_id, "greatest": greatest, "rows": state.get("rows", 0) + n, "late": state.get("late", 0) + n_late})
        unstage(rows)
    return apply


def run_window_stream(spark: SparkSession, landing: str, table: str, late: str, checkpoint: str, schema, size: str = "1 day",
                      watermark_seconds: int = 7 * 86400, slide: str | None = None, files_per_trigger: int | None = None) -> dict:
    """Consume everything available now into the window table and the table of late rows. Returns the rows taken in
    now, and in all, and those of them that were late."""
    windows = window_table(spark, table)
    stream = payment_stream(spark, landing, schema, files_per_trigger)
    rows = _run(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        window_batch(windows, late_table(spark, late), size, watermark_seconds, slide)))
    state = windows.manifest().get("properties", {})
    return {"input_rows": rows, "rows": state.get("rows", 0), "late": state.get("late", 0)}


# ---- first delivery wins -------------------------------------------------------------

def first_deliveries(stream: DataFrame, key: str, life: str) -> DataFrame:
    """Drop re-deliveries of a key within ``life`` of arrival; state is released after it."""
    arriving = stream.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", life)
    return arriving.dropDuplicatesWithinWatermark([key]).drop("_arrival")


def run_dedupe_stream(spark: SparkSession, landing: str, table: str, checkpoint: str, schema, key: str,
                      life: str = "30 days", files_per_trigger: int | None = None) -> dict:
    """Insert every key of the feed once. State drops re-deliveries within ``life`` of each other, whatever their event
    time; the table's locator knows the keys that state has let go. Returns rows taken in and keys inserted."""
    target = LakeTable(spark, table, T.StructType([schema[key]]), [key])
    inserted: list[int] = []

    def apply(batch: DataFrame, epoch_id: int) -> None:
        rows = stage(batch, "new-keys")
        inserted.append(target.insert(rows)["batch_rows"])
        unstage(rows)

    stream = payment_stream(spark, landing, schema, files_per_trigger).select(key)
    with _rocksdb(spark):
        rows = _run(first_deliveries(stream, key, life).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    return {"input_rows": rows, "inserted": sum(inserted)}
