"""Registered streaming queries: a file stream built from the payment feed,
consumed with availableNow triggers, checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.plans.catalog import _feeds, register
from quayside.plans.oracle import with_ctes
from quayside.session import scratch_path
from quayside.sinks.lake_table import LakeTable, read_lake
from quayside.sinks.lake_write import CODEC
from quayside.streaming import payments as st


DELIVERIES = 2


def _deliver(spark, sf, consume):
    """Land the payment feed in event-time order, ``consume(landing, schema)`` after
    each delivery: as many micro-batches, or more."""
    raw = _feeds(spark, sf).raw("raw_payment_stream")
    landing = scratch_path(spark, "landing-payments")
    st.land_in_chunks(raw, landing, F.col("event_ts"), DELIVERIES, after=lambda: consume(landing, raw.schema))


def _read_payments(spark, table):
    return read_lake(spark, table, "payments")


@register("stream_payments", with_ctes(["pm_all"]) + "SELECT * FROM pm_all")
def q_stream_payments(spark, sf):
    """Two deliveries (cut on event time), each consumed by an availableNow run
    and merged into the table, whose days lie together by month: a key delivered again later keeps
    its greatest (partition, offset)."""
    table, ckpt = scratch_path(spark, "stream-payments"), scratch_path(spark, "stream-ckpt")
    _deliver(spark, sf, lambda landing, schema: st.run_payment_stream(spark, landing, table, ckpt, schema))
    return _read_payments(spark, table)


@register("stream_offset_resume", with_ctes(["pm_all"]) + "SELECT * FROM pm_all")
def q_stream_offset_resume(spark, sf):
    """Run, stop, land more, restart from the checkpoint: the restart reads
    only the new input and the table equals one pass over everything."""
    raw = _feeds(spark, sf).raw("raw_payment_stream")
    landing = scratch_path(spark, "landing-payments")
    table = scratch_path(spark, "stream-payments")
    ckpt = scratch_path(spark, "stream-ckpt")
    from quayside.functions.time import epoch_micros
    secs = epoch_micros("event_ts") / 1_000_000
    half = raw.agg(F.percentile_approx(secs, 0.5)).first()[0]
    early = secs <= F.lit(half)
    raw.where(early).write.mode("append").option("compression", CODEC).parquet(landing)
    first = st.run_payment_stream(spark, landing, table, ckpt, raw.schema)
    again = st.run_payment_stream(spark, landing, table, ckpt, raw.schema)
    raw.where(~early).write.mode("append").option("compression", CODEC).parquet(landing)
    second = st.run_payment_stream(spark, landing, table, ckpt, raw.schema)
    if again["input_rows"] != 0:
        raise RuntimeError(f"restart without new input re-read {again['input_rows']} rows")
    if first["input_rows"] + second["input_rows"] != raw.count():
        raise RuntimeError("resumed stream did not read every row exactly once")
    return _read_payments(spark, table)


@register("stream_payment_windows", with_ctes(["raw_payment_stream"]) + """SELECT
  time_bucket(INTERVAL '1 day', CAST(event_ts AS TIMESTAMP), TIMESTAMP '1970-01-01 00:00:00') AS window_start,
  time_bucket(INTERVAL '1 day', CAST(event_ts AS TIMESTAMP), TIMESTAMP '1970-01-01 00:00:00') + INTERVAL 1 DAY AS window_end,
  lower(trim(status)) AS status, COUNT(*) AS payments, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
  FROM raw_payment_stream GROUP BY 1, 2, 3""")
def q_stream_payment_windows(spark, sf):
    """Daily windows per status with a 7-day watermark over files landing in
    event-time order (no row is later than the watermark, so the streamed
    result equals the batch one); rows without an event time are a null window."""
    table, late, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("windows", "late", "ckpt"))
    _deliver(spark, sf, lambda landing, schema: st.run_window_stream(spark, landing, table, late, ckpt, schema))
    return st.window_table(spark, table).read().drop("window_month")


EARLY_SQL = "CAST(kafka_offset AS BIGINT) % 2 = 0"


@register("stream_late_payments", with_ctes(["raw_payment_stream"], {
    "mark": f"SELECT max(CAST(event_ts AS TIMESTAMP)) - INTERVAL 7 DAY AS w FROM raw_payment_stream WHERE {EARLY_SQL}",
    "rows": f"""SELECT CAST(event_ts AS TIMESTAMP) AS t, lower(trim(status)) AS status, CAST(amount AS DECIMAL(18,2)) AS amount,
      COALESCE(NOT {EARLY_SQL} AND CAST(event_ts AS TIMESTAMP) < (SELECT w FROM mark), false) AS late FROM raw_payment_stream"""})
    + """SELECT late, CASE WHEN late THEN CAST(CAST(t AS DATE) AS TIMESTAMP)
      ELSE time_bucket(INTERVAL '1 day', t, TIMESTAMP '1970-01-01 00:00:00') END AS day, status, COUNT(*) AS payments,
      CAST(SUM(amount) AS DECIMAL(38,2)) AS amount FROM rows GROUP BY 1, 2, 3""")
def q_stream_late_payments(spark, sf):
    """Even offsets are delivered first: of the odd ones, most then lie behind the watermark.
    Windows and late rows, counted by day, are the whole feed; that is checked here too."""
    raw = _feeds(spark, sf).raw("raw_payment_stream")
    landing, table, late, ckpt = (scratch_path(spark, f"late-{x}") for x in ("landing", "windows", "rows", "ckpt"))
    for early in (True, False):
        raw.where(F.expr(EARLY_SQL) == early).write.mode("append").parquet(landing)
        got = st.run_window_stream(spark, landing, table, late, ckpt, raw.schema)
    windows = st.window_table(spark, table).read().select(
        F.lit(False).alias("late"), F.col("window_start").alias("day"), "status", "payments", "amount")
    rows = st.late_table(spark, late).read()
    behind = rows.groupBy(F.lit(True).alias("late"), F.to_date("event_ts").cast("timestamp_ntz").alias("day"), "status").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
    if (got["rows"], got["late"]) != (raw.count(), rows.count()):
        raise RuntimeError(f"the stream took in {got}, the late table has {rows.count()} rows")
    return windows.unionByName(behind)


@register("payment_watermark_dedupe", with_ctes(["raw_payment_stream"]) +
          "SELECT DISTINCT event_id FROM raw_payment_stream")
def q_payment_watermark_dedupe(spark, sf):
    """Streaming dedupe of re-deliveries within 30 days of arrival, inserted into a table whose
    locator knows all keys. Every event id survives exactly once, however far apart its
    deliveries are and however they fall into micro-batches."""
    table, ckpt = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "stream-ckpt")
    _deliver(spark, sf, lambda landing, schema: st.run_dedupe_stream(spark, landing, table, ckpt, schema, "event_id"))
    return LakeTable.opened(spark, table).read()
