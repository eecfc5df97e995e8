"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracles.

Every query reads the whole driver tables through the fixture adapters; the
oracle states the same result in DuckDB SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import analytics
from quayside.plans.flows import Feeds
from quayside.plans.oracle import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


# Parameters of the parameterised API queries. The wide ranges cover every
# row; the narrow ones exercise the optional filters.
FULL_RANGE = ("1900-01-01", "2099-12-31")
EVENT_RANGE = ("2024-01-05", "2024-01-20")
TXN_RANGE = ("1996-01-01", "1998-12-31")


# ---- 2.5 / 2.7: serving queries -------------------------------------------

def _funnel_sql(start, end, channel=None):
    where = f"event_ts >= TIMESTAMP '{start} 00:00:00' AND event_ts < CAST(DATE '{end}' + INTERVAL 1 DAY AS TIMESTAMP)"
    if channel:
        where += f" AND channel = '{channel}'"
    return with_ctes(["ev_good"]) + f"""SELECT COALESCE(channel, 'unknown') AS channel, event_type,
        COUNT(*) AS events, COUNT(DISTINCT session_id) AS sessions FROM ev_good WHERE {where}
        GROUP BY 1, 2 ORDER BY 1, 2"""


@register("funnel", _funnel_sql(*FULL_RANGE))
def q_funnel(spark, sf):
    return analytics.funnel(Feeds(spark, sf).events(), *FULL_RANGE)


@register("funnel_channel", _funnel_sql(*EVENT_RANGE, channel="direct"))
def q_funnel_channel(spark, sf):
    return analytics.funnel(Feeds(spark, sf).events(), *EVENT_RANGE, channel="direct")


# ---- 2.5 dedupe, 2.2 normalizers, 2.3 splits --------------------------------

def _feeds(spark, sf):
    return Feeds(spark, sf)


@register("dedupe_events", with_ctes(["ev_dd"]) + "SELECT * FROM ev_dd")
def q_dedupe_events(spark, sf):
    from quayside.operators.dedupe import dedupe_events
    return dedupe_events(_feeds(spark, sf).raw("raw_events"))


@register("dedupe_transactions", with_ctes(["tx_dd"]) + "SELECT * FROM tx_dd")
def q_dedupe_transactions(spark, sf):
    from quayside.operators.dedupe import dedupe_transactions
    return dedupe_transactions(_feeds(spark, sf).raw("raw_transactions"))


@register("dedupe_partners", with_ctes(["pt_all"]) + "SELECT * FROM pt_all")
def q_dedupe_partners(spark, sf):
    return _feeds(spark, sf).partners()


@register("dedupe_payments", with_ctes(["pm_dd"]) + "SELECT * FROM pm_dd")
def q_dedupe_payments(spark, sf):
    from quayside.operators.dedupe import dedupe_payments
    return dedupe_payments(_feeds(spark, sf).raw("raw_payment_stream"))


@register("normalize_events", with_ctes(["ev_all"]) + "SELECT * FROM ev_all")
def q_normalize_events(spark, sf):
    return _feeds(spark, sf).events_all()


@register("normalize_transactions", with_ctes(["tx_all"]) + "SELECT * FROM tx_all")
def q_normalize_transactions(spark, sf):
    return _feeds(spark, sf).transactions_all()


@register("normalize_partners", with_ctes(["pt_norm"]) + "SELECT * FROM pt_norm")
def q_normalize_partners(spark, sf):
    from quayside.operators.normalize import normalize_partners
    return normalize_partners(_feeds(spark, sf).raw("raw_partner_catalog"))


@register("normalize_partners_by_version", with_ctes(["pt_norm"]) + "SELECT * FROM pt_norm")
def q_normalize_partners_by_version(spark, sf):
    """Schema evolution: v1/v2/v3 arrive as separate feeds with only their own
    columns and are unified by name (missing columns -> NULL)."""

    from quayside.operators.normalize import normalize_partners, union_partner_versions
    raw = _feeds(spark, sf).raw("raw_partner_catalog")
    version = F.lower(F.trim("schema_version"))
    base = ["_seq", "partner_id", "schema_version", "name", "country_code", "status", "tier",
            "commission_rate", "created_at", "updated_at"]
    v1 = normalize_partners(raw.where(version == "v1").select(*base).withColumns(
        {c: F.lit("") for c in ("sla_hours", "avg_rating", "api_endpoint", "webhook_enabled")}))
    v2 = normalize_partners(raw.where(version == "v2").select(*base, "sla_hours", "avg_rating").withColumns(
        {c: F.lit("") for c in ("api_endpoint", "webhook_enabled")}))
    v3 = normalize_partners(raw.where(version == "v3"))
    rest = normalize_partners(raw.where(~version.isin("v1", "v2", "v3")))
    return union_partner_versions(v1, v2, v3, rest)


@register("normalize_payments", with_ctes(["pm_all"]) + "SELECT * FROM pm_all")
def q_normalize_payments(spark, sf):
    return _feeds(spark, sf).payments()


@register("split_bots", with_ctes(["ev_bots"]) + "SELECT * FROM ev_bots")
def q_split_bots(spark, sf):
    return _feeds(spark, sf).bots()


@register("split_bots_good", with_ctes(["ev_good"]) + "SELECT * FROM ev_good")
def q_split_bots_good(spark, sf):
    return _feeds(spark, sf).events()


@register("split_quarantine", with_ctes(["tx_quarantine"]) + "SELECT * FROM tx_quarantine")
def q_split_quarantine(spark, sf):
    return _feeds(spark, sf).quarantine()


@register("split_quarantine_good", with_ctes(["tx_good"]) + "SELECT * FROM tx_good")
def q_split_quarantine_good(spark, sf):
    return _feeds(spark, sf).transactions()


# ---- serving queries ---------------------------------------------------------

PERF_SQL = """SELECT partner_id, COUNT(*) AS transaction_count,
  CAST(SUM(CASE WHEN status IN ('confirmed','completed') THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS revenue,
  CAST(SUM(CASE WHEN status IN ('confirmed','completed') THEN 1 ELSE 0 END) AS BIGINT) AS approved_count
  FROM tx_good GROUP BY partner_id"""

LATEST_SQL = """SELECT * FROM pt_all QUALIFY row_number() OVER (PARTITION BY partner_id
  ORDER BY COALESCE(updated_at, created_at) DESC, schema_version DESC, created_at DESC) = 1"""


@register("partner_performance", with_ctes(["tx_good"]) + PERF_SQL)
def q_partner_performance(spark, sf):
    return analytics.partner_performance(_feeds(spark, sf).transactions())


@register("latest_partner_version", with_ctes(["pt_all"]) + LATEST_SQL)
def q_latest_partner_version(spark, sf):
    return analytics.latest_partner_version(_feeds(spark, sf).partners())


@register("partner_lookup", with_ctes(["pt_all"]) + "SELECT * FROM (" + LATEST_SQL + ") WHERE partner_id = 'PRT0004'")
def q_partner_lookup(spark, sf):
    return analytics.partner_profile(_feeds(spark, sf).partners(), "PRT0004")


@register("partner_lookup_not_found", with_ctes(["pt_all"]) + "SELECT * FROM (" + LATEST_SQL + ") WHERE partner_id = 'PRT9999'")
def q_partner_lookup_not_found(spark, sf):
    return analytics.partner_profile(_feeds(spark, sf).partners(), "PRT9999")


@register("partner_profile_performance", with_ctes(["pt_all", "tx_good"], {"perf": PERF_SQL, "latest": LATEST_SQL}) + """
  SELECT l.*, CAST(COALESCE(p.transaction_count, 0) AS BIGINT) AS transaction_count, p.revenue, p.approved_count
  FROM latest l LEFT JOIN perf p USING (partner_id)""")
def q_partner_profile_performance(spark, sf):
    f = _feeds(spark, sf)
    return analytics.partner_profile_performance(f.partners(), f.transactions())


def _summary_sql(start, end, partner=None, currency=None):
    where = f"created_at >= TIMESTAMP '{start} 00:00:00' AND created_at < CAST(DATE '{end}' + INTERVAL 1 DAY AS TIMESTAMP)"
    if partner:
        where += f" AND partner_id = '{partner}'"
    if currency:
        where += f" AND currency = '{currency.upper()}'"
    return with_ctes(["tx_good"]) + f"""SELECT partner_id, currency, status, COUNT(*) AS transaction_count,
      CAST(SUM(amount) AS DECIMAL(38,2)) AS total_amount,
      CAST(CASE WHEN COUNT(amount) > 0 THEN ((2 * CAST(SUM(amount) * 100 AS HUGEINT) + COUNT(amount))
           // (2 * COUNT(amount))) / 100 END AS DECIMAL(38,2)) AS average_amount
      FROM tx_good WHERE {where} GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""


@register("transaction_summary", _summary_sql(*FULL_RANGE))
def q_transaction_summary(spark, sf):
    return analytics.transaction_summary(_feeds(spark, sf).transactions(), *FULL_RANGE)


@register("transaction_summary_filtered", _summary_sql(*TXN_RANGE, partner="PRT0003", currency="brl"))
def q_transaction_summary_filtered(spark, sf):
    return analytics.transaction_summary(_feeds(spark, sf).transactions(), *TXN_RANGE,
                                         partner_id="PRT0003", currency="brl")


# ---- 2.3 / 2.9 incremental filters and marks --------------------------------

@register("incremental_window_events", with_ctes(["raw_events"]) + """SELECT * FROM raw_events
  WHERE ingest_date >= (SELECT max(ingest_date) FROM raw_events) - INTERVAL 7 DAY""")
def q_incremental_window_events(spark, sf):
    from quayside.operators.filters import incremental_window
    return incremental_window(_feeds(spark, sf).raw("raw_events"), "ingest_date", 7)


@register("incremental_window_transactions", with_ctes(["raw_transactions"]) + """SELECT * FROM raw_transactions
  WHERE ingest_ts >= date_trunc('day', (SELECT max(ingest_ts) FROM raw_transactions) - INTERVAL 7 DAY)""")
def q_incremental_window_transactions(spark, sf):
    from quayside.operators.filters import incremental_window
    return incremental_window(_feeds(spark, sf).raw("raw_transactions"), "ingest_ts", 7, floor_to_day=True)


@register("reconcile_30d", with_ctes(["raw_transactions"]) + """SELECT * FROM raw_transactions
  WHERE ingest_ts >= date_trunc('day', (SELECT max(ingest_ts) FROM raw_transactions) - INTERVAL 30 DAY)""")
def q_reconcile_30d(spark, sf):
    from quayside.operators.filters import incremental_window
    return incremental_window(_feeds(spark, sf).raw("raw_transactions"), "ingest_ts", 30, floor_to_day=True)


@register("filter_since", with_ctes(["raw_transactions"]) +
          "SELECT * FROM raw_transactions WHERE ingest_ts >= TIMESTAMP '1998-06-01 00:00:00'")
def q_filter_since(spark, sf):
    import datetime as dt

    from quayside.operators.filters import filter_since
    return filter_since(_feeds(spark, sf).raw("raw_transactions"), "ingest_ts", dt.datetime(1998, 6, 1))


SAVED_OFFSETS_SQL = """SELECT CAST(kafka_partition AS INTEGER) AS kafka_partition,
  CAST(count(*) // 2 AS BIGINT) AS kafka_offset FROM raw_payment_stream GROUP BY 1"""


def _saved_offsets(raw):
    """A consumer that stopped half-way through every partition."""
    return raw.groupBy(F.col("kafka_partition").cast("int").alias("kafka_partition")).agg(
        F.floor(F.count(F.lit(1)) / 2).cast("bigint").alias("kafka_offset"))


@register("filter_new_offsets", with_ctes(["raw_payment_stream"], {"saved": SAVED_OFFSETS_SQL}) + """
  SELECT r.* FROM raw_payment_stream r LEFT JOIN saved s ON CAST(r.kafka_partition AS INTEGER) = s.kafka_partition
  WHERE CAST(r.kafka_offset AS BIGINT) > COALESCE(s.kafka_offset, -1)""")
def q_filter_new_offsets(spark, sf):
    from quayside.operators.filters import filter_new_offsets
    raw = _feeds(spark, sf).raw("raw_payment_stream")
    return filter_new_offsets(raw, _saved_offsets(raw))


@register("max_offset_by_partition", with_ctes(["raw_payment_stream"], {"saved": SAVED_OFFSETS_SQL}) + """
  SELECT kafka_partition, max(kafka_offset) AS kafka_offset FROM (
    SELECT kafka_partition, kafka_offset FROM saved
    UNION ALL SELECT CAST(kafka_partition AS INTEGER), CAST(kafka_offset AS BIGINT) FROM raw_payment_stream)
  GROUP BY 1""")
def q_max_offset_by_partition(spark, sf):
    from quayside.operators.marks import max_offset_by_partition
    raw = _feeds(spark, sf).raw("raw_payment_stream")
    return max_offset_by_partition(raw, _saved_offsets(raw))


@register("high_water_mark_events", with_ctes(["raw_events"]) +
          "SELECT max(ingest_date) AS high_water_mark FROM raw_events")
def q_hwm_events(spark, sf):
    from quayside.operators.marks import high_water_mark
    return high_water_mark(_feeds(spark, sf).raw("raw_events"), "ingest_date")


@register("high_water_mark_transactions", with_ctes(["raw_transactions"]) +
          "SELECT max(ingest_ts) AS high_water_mark FROM raw_transactions")
def q_hwm_transactions(spark, sf):
    from quayside.operators.marks import high_water_mark
    return high_water_mark(_feeds(spark, sf).raw("raw_transactions"), "ingest_ts")


@register("output_counts", with_ctes(["ev_good", "ev_bots", "tx_good", "tx_quarantine", "pt_all", "pm_all"]) + """
  SELECT 'events' AS output, COUNT(*) AS rows FROM ev_good
  UNION ALL SELECT 'bots', COUNT(*) FROM ev_bots
  UNION ALL SELECT 'transactions', COUNT(*) FROM tx_good
  UNION ALL SELECT 'rejected_transactions', COUNT(*) FROM tx_quarantine
  UNION ALL SELECT 'partners', COUNT(*) FROM pt_all
  UNION ALL SELECT 'payments', COUNT(*) FROM pm_all""")
def q_output_counts(spark, sf):
    from quayside.plans.batch_run import output_counts
    f = _feeds(spark, sf)
    return output_counts({"events": f.events(), "bots": f.bots(), "transactions": f.transactions(),
                          "rejected_transactions": f.quarantine(), "partners": f.partners(),
                          "payments": f.payments()})


# ---- 2.5 / 2.11 operational metrics and alerts --------------------------------

RUN_STATUS_SQL = """SELECT pipeline_name AS pipeline, lower(status) AS status, COUNT(*) AS runs
  FROM pipeline_runs GROUP BY 1, 2"""
RUN_DURATION_SQL = """SELECT pipeline_name AS pipeline, greatest(max(CAST(duration_sec AS DOUBLE)), 0.0) AS max_duration_sec
  FROM pipeline_runs GROUP BY 1"""
STREAM_LAG_SQL = """SELECT COALESCE(max(CASE WHEN processing_lag_ms <> '' THEN CAST(processing_lag_ms AS DOUBLE) / 1000 END), 0.0)
  AS max_lag_sec FROM raw_payment_stream"""
ALERT_FAILURE_SQL = """SELECT 'PipelineFailureRateHigh' AS alert, 'critical' AS severity,
  'Pipeline failure rate is above 15%' AS summary, CAST(NULL AS VARCHAR) AS series,
  SUM(CASE WHEN status IN ('failed','timeout') THEN runs ELSE 0 END) / SUM(runs) AS value,
  SUM(CASE WHEN status IN ('failed','timeout') THEN runs ELSE 0 END) / SUM(runs) > 0.15 AS firing
  FROM run_status"""
ALERT_DURATION_SQL = """SELECT 'PipelineDurationHigh' AS alert, 'critical' AS severity,
  'Pipeline execution exceeded two hours' AS summary, pipeline AS series, max_duration_sec AS value,
  max_duration_sec > 7200 AS firing FROM run_duration"""
ALERT_LAG_SQL = """SELECT 'StreamingLagHigh' AS alert, 'warning' AS severity,
  'Payment stream lag is above five minutes' AS summary, CAST(NULL AS VARCHAR) AS series, max_lag_sec AS value,
  max_lag_sec > 300 AS firing FROM stream_lag"""


def _runs(spark, sf):
    return _feeds(spark, sf).raw("pipeline_runs")


@register("run_status_counts", with_ctes(["pipeline_runs"]) + RUN_STATUS_SQL)
def q_run_status_counts(spark, sf):
    from quayside.operators.ops_metrics import run_status_counts
    return run_status_counts(_runs(spark, sf))


@register("run_max_duration", with_ctes(["pipeline_runs"]) + RUN_DURATION_SQL)
def q_run_max_duration(spark, sf):
    from quayside.operators.ops_metrics import run_max_duration
    return run_max_duration(_runs(spark, sf))


@register("max_stream_lag", with_ctes(["raw_payment_stream"]) + STREAM_LAG_SQL)
def q_max_stream_lag(spark, sf):
    from quayside.operators.ops_metrics import max_stream_lag
    return max_stream_lag(_feeds(spark, sf).raw("raw_payment_stream"))


@register("alert_failure_rate", with_ctes(["pipeline_runs"], {"run_status": RUN_STATUS_SQL}) + ALERT_FAILURE_SQL)
def q_alert_failure_rate(spark, sf):
    from quayside.operators.ops_metrics import alert_failure_rate
    return alert_failure_rate(_runs(spark, sf))


@register("alert_duration", with_ctes(["pipeline_runs"], {"run_duration": RUN_DURATION_SQL}) + ALERT_DURATION_SQL)
def q_alert_duration(spark, sf):
    from quayside.operators.ops_metrics import alert_duration
    return alert_duration(_runs(spark, sf))


@register("alert_stream_lag", with_ctes(["raw_payment_stream"], {"stream_lag": STREAM_LAG_SQL}) + ALERT_LAG_SQL)
def q_alert_stream_lag(spark, sf):
    from quayside.operators.ops_metrics import alert_stream_lag
    return alert_stream_lag(_feeds(spark, sf).raw("raw_payment_stream"))


LATENCY_SQL = """SELECT {keys} COUNT(*) AS requests, COUNT(*) FILTER (WHERE status_code >= 400) AS errors,
  CAST(quantile_cont(latency_ms, 0.5) AS DOUBLE) AS p50_ms,
  CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms) AS DOUBLE) AS p95_ms
  FROM request_log {group}"""


@register("latency_summary", with_ctes(["request_log"]) + LATENCY_SQL.format(keys="", group=""))
def q_latency_summary(spark, sf):
    from quayside.operators.ops_metrics import latency_summary
    return latency_summary(_feeds(spark, sf).raw("request_log"))


@register("latency_by_path", with_ctes(["request_log"]) + LATENCY_SQL.format(keys="path,", group="GROUP BY path"))
def q_latency_by_path(spark, sf):
    from quayside.operators.ops_metrics import latency_summary
    return latency_summary(_feeds(spark, sf).raw("request_log"), ["path"])


@register("request_rates", with_ctes(["request_log"]) + """SELECT
  time_bucket(INTERVAL '5 minutes', request_ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start,
  COUNT(*) AS requests, COUNT(*) / 300.0 AS rate_per_sec,
  100.0 * COUNT(*) FILTER (WHERE status_code >= 500) / COUNT(*) AS error_5xx_pct,
  CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms) AS DOUBLE) AS p95_ms
  FROM request_log GROUP BY 1""")
def q_request_rates(spark, sf):
    from quayside.operators.ops_metrics import request_rates
    return request_rates(_feeds(spark, sf).raw("request_log"))


# ---- 2.11 ingest contract ------------------------------------------------------

VALIDATE_SQL = """SELECT event_id, event_type, session_id, user_id, event_ts, page, partner_id,
  COALESCE(device, 'unknown') AS device, COALESCE(country, 'unknown') AS country, channel,
  TRY_CAST(trim(price_usd) AS DOUBLE) AS price_usd, metadata_json, false AS is_bot_flag,
  CASE WHEN regexp_full_match(ingest_date, '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(ingest_date AS DATE) END AS ingest_date,
  concat_ws(';',
    CASE WHEN event_id IS NULL OR length(event_id) < 8 THEN 'event_id_too_short' END,
    CASE WHEN event_type IS NULL THEN 'event_type_missing' END,
    CASE WHEN session_id IS NULL THEN 'session_id_missing' END,
    CASE WHEN event_ts IS NULL THEN 'event_ts_missing' END,
    CASE WHEN ingest_date IS NULL THEN 'ingest_date_missing' END,
    CASE WHEN ingest_date IS NOT NULL AND TRY_CAST(ingest_date AS DATE) IS NULL THEN 'ingest_date_invalid' END,
    CASE WHEN price_usd IS NOT NULL AND TRY_CAST(trim(price_usd) AS DOUBLE) IS NULL THEN 'price_usd_invalid' END
  ) AS rejection_reasons, _seq FROM api_payloads"""
VALIDATED_SQL = "SELECT *, rejection_reasons = '' AS is_valid FROM (" + VALIDATE_SQL + ")"


@register("validate_event_input", with_ctes(["api_payloads"]) + VALIDATED_SQL)
def q_validate_event_input(spark, sf):
    from quayside.operators.quality import validate_event_input
    return validate_event_input(_feeds(spark, sf).raw("api_payloads"))


@register("insert_ignore", with_ctes(["api_payloads"], {"v": VALIDATED_SQL}) + """SELECT b.*,
  (row_number() OVER (PARTITION BY b.event_id ORDER BY b._seq) = 1 AND t.event_id IS NULL) AS accepted,
  NOT (row_number() OVER (PARTITION BY b.event_id ORDER BY b._seq) = 1 AND t.event_id IS NULL) AS idempotent
  FROM (SELECT * FROM v WHERE is_valid) b
  LEFT JOIN (SELECT DISTINCT event_id FROM v WHERE is_valid AND event_ts < '2024-01-15') t USING (event_id)""")
def q_insert_ignore(spark, sf):
    """Serving table = payloads already ingested (event time before the 15th);
    batch = every valid payload again, re-deliveries included."""

    from quayside.operators.quality import insert_ignore, validate_event_input
    valid = validate_event_input(_feeds(spark, sf).raw("api_payloads")).where("is_valid")
    target = valid.where(F.col("event_ts") < F.lit("2024-01-15"))
    return insert_ignore(target, valid)


# ---- 2.13 rules stated by the feed documentation ----------------------------

TOKEN_KEY = b"quayside-demo-key"  # run-time parameter; fixed here for the check


def _hmac_sql(col: str) -> str:
    block = TOKEN_KEY.ljust(64, b"\x00")  # RFC 2104, of a key no longer than a block
    ipad, opad = (bytes(b ^ pad for b in block) for pad in (0x36, 0x5C))
    inner = f"unhex(sha256(unhex('{ipad.hex()}') || encode({col})))"
    return f"sha256(unhex('{opad.hex()}') || {inner})"


@register("offset_continuity", with_ctes(["raw_payment_stream"]) + """SELECT
  CAST(kafka_partition AS INTEGER) AS kafka_partition, min(CAST(kafka_offset AS BIGINT)) AS min_offset,
  max(CAST(kafka_offset AS BIGINT)) AS max_offset, COUNT(*) AS rows,
  COUNT(DISTINCT CAST(kafka_offset AS BIGINT)) AS distinct_offsets,
  max(CAST(kafka_offset AS BIGINT)) - min(CAST(kafka_offset AS BIGINT)) + 1 - COUNT(DISTINCT CAST(kafka_offset AS BIGINT)) AS gaps,
  (max(CAST(kafka_offset AS BIGINT)) - min(CAST(kafka_offset AS BIGINT)) + 1 - COUNT(DISTINCT CAST(kafka_offset AS BIGINT))) = 0
    AND COUNT(*) = COUNT(DISTINCT CAST(kafka_offset AS BIGINT)) AS monotonic
  FROM raw_payment_stream GROUP BY 1""")
def q_offset_continuity(spark, sf):
    from quayside.operators.quality import offset_continuity
    return offset_continuity(_feeds(spark, sf).raw("raw_payment_stream"))


LATE_OFFSET = "CAST(kafka_offset AS BIGINT) % 10 >= 7"


@register("offset_monotonic", with_ctes(["raw_payment_stream"], {"arrived": f"""SELECT CAST(kafka_partition AS INTEGER) AS p,
    CAST(kafka_offset AS BIGINT) AS o, {LATE_OFFSET} AS late FROM raw_payment_stream""",
    "pairs": "SELECT p, late, o, lag(o) OVER (PARTITION BY p ORDER BY late, o) AS before FROM arrived"}) + """SELECT p AS kafka_partition,
  COUNT(*) AS rows, COUNT(*) FILTER (o < before) AS reversals, COUNT(*) FILTER (o = before) AS repeats,
  COALESCE(max(before - o) FILTER (o < before), 0) AS largest_step_back,
  arg_min(o, (late, o)) FILTER (o < before) AS first_reversed_offset,
  COUNT(*) FILTER (o < before) = 0 AND COUNT(*) FILTER (o = before) = 0 AS monotonic FROM pairs GROUP BY 1""")
def q_offset_monotonic(spark, sf):
    """The feed lands in two deliveries, the second with offsets that the first passed over."""
    from quayside.operators.quality import offset_monotonic
    from quayside.session import scratch_path
    from quayside.sources.lake_scan import in_arrival_order
    raw = _feeds(spark, sf).raw("raw_payment_stream")
    landing = scratch_path(spark, "landing-arrival")
    order = [F.col("kafka_partition").cast("int"), F.col("kafka_offset").cast("bigint")]
    for late in (False, True):  # files of a delivery are numbered in the order of its rows
        rows = raw.where(F.expr(LATE_OFFSET) == late)
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{landing}/delivery={int(late)}")
    rows, arrival = in_arrival_order(spark, landing, raw.schema)
    return offset_monotonic(rows, arrival[1:])


@register("out_of_order_payments", with_ctes(["raw_payment_stream"]) + """SELECT * FROM (
  SELECT *, max(event_ts) OVER (PARTITION BY CAST(kafka_partition AS INTEGER) ORDER BY CAST(kafka_offset AS BIGINT)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_max_ts FROM raw_payment_stream)
  WHERE event_ts < previous_max_ts""")
def q_out_of_order_payments(spark, sf):
    from quayside.operators.quality import out_of_order
    return out_of_order(_feeds(spark, sf).raw("raw_payment_stream"))


# A sixth of the payments fall into 16 hours that cross a 16-hour boundary counted from 1970.
def spiked(payments):
    """Payments with a spike: by a number of their own, some move into 16 hours of 1997-03-05."""
    n = F.regexp_extract("event_id", r"^(\d+)-", 1).cast("bigint") * 7 + F.regexp_extract("event_id", r"-(\d+)$", 1).cast("bigint")
    at = F.lit("1997-03-05 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(n % 57600).cast("decimal(18,6)"))
    return payments.withColumn("event_ts", F.when(n % 6 == 1, at).otherwise(F.col("event_ts")))


SPIKED_SQL = """SELECT CASE WHEN n % 6 = 1 THEN TIMESTAMP '1997-03-05 00:00:00' + to_seconds(n % 57600) ELSE event_ts END AS t FROM (
  SELECT event_ts, CAST(split_part(event_id, '-', 1) AS BIGINT) * 7 + CAST(split_part(event_id, '-', 2) AS BIGINT) AS n FROM pm_all)"""


@register("spike_windows", with_ctes(["pm_all"], {
    "moved": SPIKED_SQL,
    "times": "SELECT epoch_us(t) AS us, COUNT(*) AS n FROM moved WHERE t IS NOT NULL GROUP BY 1",
    "spans": "SELECT us, SUM(n) OVER (ORDER BY us RANGE BETWEEN CURRENT ROW AND 57599999999 FOLLOWING) AS c FROM times",
    "dense": """SELECT *, CASE WHEN us - lag(us) OVER (ORDER BY us) < 57600000000 THEN 0 ELSE 1 END AS fresh
      FROM spans WHERE c >= 0.1 * (SELECT COUNT(*) FROM moved)""",
    "chains": "SELECT *, SUM(fresh) OVER (ORDER BY us) AS chain FROM dense"}) + """SELECT
  make_timestamp(us) AS window_start, make_timestamp(us) + INTERVAL 16 HOUR AS window_end, CAST(c AS BIGINT) AS payments,
  c / (SELECT COUNT(*) FROM moved) AS share FROM chains QUALIFY row_number() OVER (PARTITION BY chain ORDER BY c DESC, us) = 1""")
def q_spike_windows(spark, sf):
    from quayside.operators.windows import spike_windows
    return spike_windows(spiked(_feeds(spark, sf).payments()))


@register("payment_windows", with_ctes(["pm_all"]) + """SELECT
  time_bucket(INTERVAL '1 day', event_ts, TIMESTAMP '1970-01-01 00:00:00') AS window_start,
  time_bucket(INTERVAL '1 day', event_ts, TIMESTAMP '1970-01-01 00:00:00') + INTERVAL 1 DAY AS window_end,
  status, COUNT(*) AS payments, CAST(SUM(amount) AS DECIMAL(38,2)) AS amount FROM pm_all GROUP BY 1, 2, 3""")
def q_payment_windows(spark, sf):
    from quayside.operators.windows import payment_windows
    return payment_windows(_feeds(spark, sf).payments(), "1 day")


@register("payment_sliding_windows", with_ctes(["pm_all"]) + """SELECT window_start,
  window_start + INTERVAL 7 DAY AS window_end, status, COUNT(*) AS payments,
  CAST(SUM(amount) AS DECIMAL(38,2)) AS amount FROM (
    SELECT time_bucket(INTERVAL '1 day', event_ts, TIMESTAMP '1970-01-01 00:00:00') - (k * INTERVAL 1 DAY) AS window_start,
      status, amount FROM pm_all, range(0, 7) AS r(k))
  GROUP BY 1, 2, 3""")
def q_payment_sliding_windows(spark, sf):
    from quayside.operators.windows import payment_windows
    return payment_windows(_feeds(spark, sf).payments(), "7 days", "1 day")


def with_bot(events):
    """Events with a bot: every seventh event is one of a session whose events lie within four minutes,
    but for every 21st, an hour later."""
    n = F.col("event_id").cast("bigint")
    at = F.lit("2024-01-10 11:59:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(n * 13 % 239 + F.when(n % 21 == 0, 3600).otherwise(0)).cast("decimal(18,6)"))
    return events.withColumns({"session_id": F.when(n % 7 == 0, F.lit("S-bot")).otherwise(F.col("session_id")),
                               "event_ts": F.when(n % 7 == 0, at).otherwise(F.col("event_ts"))})


@register("bot_sessions", with_ctes(["ev_all"], {"seen": """SELECT CASE WHEN n % 7 = 0 THEN 'S-bot' ELSE session_id END AS session_id,
    CASE WHEN n % 7 = 0 THEN TIMESTAMP '2024-01-10 11:59:00' + to_seconds(n * 13 % 239 + CASE WHEN n % 21 = 0 THEN 3600 ELSE 0 END)
         ELSE event_ts END AS event_ts FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM ev_all)"""}) + """SELECT session_id, max(n) AS max_events_in_span,
  COUNT(*) AS events, max(n) >= 120 AS is_bot FROM (
    SELECT session_id, COUNT(*) OVER (PARTITION BY session_id ORDER BY epoch_us(event_ts)
      RANGE BETWEEN 239999999 PRECEDING AND CURRENT ROW) AS n FROM seen)
  GROUP BY session_id""")
def q_bot_sessions(spark, sf):
    from quayside.operators.windows import bot_sessions
    return bot_sessions(with_bot(_feeds(spark, sf).events_all()))


@register("booking_reconciliation", with_ctes(["ev_good", "tx_good"], {
    "booked": """SELECT partner_id, user_id, CAST(event_ts AS DATE) AS day FROM ev_good WHERE event_type = 'purchase'
            UNION ALL SELECT partner_id, NULLIF(user_id, ''), CAST(created_at AS DATE) FROM tx_good
            WHERE CAST(substr(transaction_id, 4) AS BIGINT) % 3 = 0""",
    "b": "SELECT partner_id, user_id, day, COUNT(*) AS bookings FROM booked GROUP BY 1, 2, 3",
    "t": """SELECT partner_id, NULLIF(user_id, '') AS user_id, CAST(created_at AS DATE) AS day,
            COUNT(*) AS transactions FROM tx_good GROUP BY 1, 2, 3"""}) + """SELECT
  COALESCE(b.partner_id, t.partner_id) AS partner_id, COALESCE(b.user_id, t.user_id) AS user_id,
  COALESCE(b.day, t.day) AS day, COALESCE(bookings, 0) AS bookings, COALESCE(transactions, 0) AS transactions,
  CASE WHEN COALESCE(bookings, 0) = COALESCE(transactions, 0) THEN 'matched'
       WHEN COALESCE(bookings, 0) > COALESCE(transactions, 0) THEN 'missing_transaction'
       ELSE 'missing_booking' END AS status
  FROM b FULL OUTER JOIN t ON b.partner_id IS NOT DISTINCT FROM t.partner_id
    AND b.user_id IS NOT DISTINCT FROM t.user_id AND b.day IS NOT DISTINCT FROM t.day""")
def q_booking_reconciliation(spark, sf):
    """The click feed and the transactions lie years apart: a third of the transactions get the event that confirms them."""
    from quayside.operators.quality import booking_reconciliation
    f = _feeds(spark, sf)
    columns = ["event_type", "partner_id", "user_id", "event_ts"]
    confirmed = f.transactions().where(F.substring("transaction_id", 4, 20).cast("bigint") % 3 == 0).select(
        F.lit("purchase").alias("event_type"), "partner_id", F.nullif(F.col("user_id"), F.lit("")).alias("user_id"), F.col("created_at").alias("event_ts"))
    return booking_reconciliation(f.events().select(*columns).unionByName(confirmed), f.transactions(), booking_event="purchase")


@register("orphan_payments", with_ctes(["pm_all", "tx_all"]) + """SELECT * FROM pm_all p
  WHERE p.transaction_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tx_all t WHERE t.transaction_id = p.transaction_id)""")
def q_orphan_payments(spark, sf):
    from quayside.operators.quality import orphans
    f = _feeds(spark, sf)
    return orphans(f.payments(), f.transactions_all(), "transaction_id")


@register("orphan_transactions", with_ctes(["tx_all", "pt_all"]) + """SELECT * FROM tx_all x
  WHERE x.partner_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pt_all p WHERE p.partner_id = x.partner_id)""")
def q_orphan_transactions(spark, sf):
    from quayside.operators.quality import orphans
    f = _feeds(spark, sf)
    return orphans(f.transactions_all(), f.partners(), "partner_id")


@register("orphan_event_partners", with_ctes(["ev_good", "pt_all"]) + """SELECT * FROM ev_good e
  WHERE e.partner_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pt_all p WHERE p.partner_id = e.partner_id)""")
def q_orphan_event_partners(spark, sf):
    from quayside.operators.quality import orphans
    f = _feeds(spark, sf)
    return orphans(f.events(), f.partners(), "partner_id")


@register("metadata_fields", with_ctes(["ev_all"]) + """SELECT *,
  TRY_CAST(json_extract(metadata_json, '$.k') AS INTEGER) AS meta_k,
  json_extract_string(metadata_json, '$.ab_test') AS meta_ab_test FROM ev_all""")
def q_metadata_fields(spark, sf):
    from quayside.operators.quality import json_fields
    return json_fields(_feeds(spark, sf).events_all(), "metadata_json",
                       {"meta_k": ("$.k", "int"), "meta_ab_test": ("$.ab_test", "string")})


@register("notes_json_drift", with_ctes(["tx_all"]) + """SELECT *,
  TRY_CAST(json_extract(notes, '$.legacy_id') AS BIGINT) AS legacy_id FROM tx_all
  WHERE json_valid(notes) AND json_type(notes) = 'OBJECT'""")
def q_notes_json_drift(spark, sf):
    from quayside.operators.quality import json_fields, json_object_drift
    drift = json_object_drift(_feeds(spark, sf).transactions_all(), "notes")
    return json_fields(drift, "notes", {"legacy_id": ("$.legacy_id", "bigint")})


@register("amount_outliers", with_ctes(["tx_all"]) + """SELECT *,
  CASE WHEN amount > 20000 THEN 'amount_above_limit' ELSE 'approved_not_positive' END AS outlier_reason
  FROM tx_all WHERE amount > 20000 OR (status IN ('confirmed','completed') AND amount <= 0)""")
def q_amount_outliers(spark, sf):
    from quayside.operators.quality import amount_outliers
    return amount_outliers(_feeds(spark, sf).transactions_all())


@register("retry_eligible", with_ctes(["pipeline_runs"]) +
          "SELECT * FROM pipeline_runs WHERE lower(status) = 'failed' AND retry_attempt < 3")
def q_retry_eligible(spark, sf):
    from quayside.operators.quality import retry_eligible
    return retry_eligible(_runs(spark, sf))


@register("scheduled_success_sla", with_ctes(["pipeline_runs"]) + """SELECT pipeline, scheduled_runs, successful_runs,
  successful_runs / scheduled_runs AS success_rate, successful_runs / scheduled_runs >= 0.95 AS meets_sla FROM (
  SELECT pipeline_name AS pipeline, COUNT(*) AS scheduled_runs,
    COUNT(*) FILTER (WHERE lower(status) = 'success') AS successful_runs
  FROM pipeline_runs WHERE run_type = 'scheduled' GROUP BY 1)""")
def q_scheduled_success_sla(spark, sf):
    from quayside.operators.quality import scheduled_success_sla
    return scheduled_success_sla(_runs(spark, sf))


@register("unknown_version_quarantine", with_ctes(["pt_norm"]) + """SELECT *,
  'unknown_schema_version' AS quarantine_reason FROM pt_norm
  WHERE NOT COALESCE(schema_version IN ('v1','v2','v3'), false)""")
def q_unknown_version_quarantine(spark, sf):
    from quayside.operators.normalize import normalize_partners
    from quayside.operators.quality import unknown_version_quarantine
    return unknown_version_quarantine(normalize_partners(_feeds(spark, sf).raw("raw_partner_catalog")))


@register("user_id_token", with_ctes(["tx_good"]) + f"""SELECT transaction_id, partner_id,
  CASE WHEN NULLIF(user_id, '') IS NOT NULL THEN {_hmac_sql("user_id")} END AS user_id FROM tx_good""")
def q_user_id_token(spark, sf):
    from quayside.operators.quality import user_id_token
    txns = _feeds(spark, sf).transactions().select("transaction_id", "partner_id", "user_id")
    return user_id_token(txns, TOKEN_KEY)


@register("freshness", with_ctes(["tx_all"]) + """SELECT COUNT(*) AS rows,
  CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY date_diff('second', created_at, ingest_ts) / 60.0) AS DOUBLE) AS p95_lag_minutes,
  percentile_disc(0.95) WITHIN GROUP (ORDER BY date_diff('second', created_at, ingest_ts) / 60.0) < 60 AS meets_target
  FROM tx_all""")
def q_freshness(spark, sf):
    from quayside.operators.quality import freshness
    return freshness(_feeds(spark, sf).transactions_all())
