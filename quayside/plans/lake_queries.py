"""Registered queries that write to the lake and read back.

Writes go under the shared checkpoint folder (``spark.checkpoint.dir``); each
call works in a fresh directory, except the two-run batch lake, which is built
once per (session, data directory) and shared by the read-back queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import KEYS, NOT_NULL, RAW_TXN_FIELDS, SCHEMAS
from quayside.plans.catalog import (
    ALERT_DURATION_SQL, ALERT_FAILURE_SQL, ALERT_LAG_SQL, EVENT_RANGE, RUN_DURATION_SQL, RUN_STATUS_SQL, STREAM_LAG_SQL, _feeds,
    _funnel_sql, register,
)
from quayside.plans.oracle import with_ctes
from quayside.session import scratch_path

# First delivery of the two-run lake: rows up to these marks, and the first
# half of every Kafka partition.
FIRST_EVENTS_UNTIL = "2024-01-15"
FIRST_TXNS_UNTIL = "1998-06-01 00:00:00"

KNOWN_SQL = "schema_version IN ('v1', 'v2', 'v3')"

_LAKES: dict[tuple, dict] = {}


def _first_half(raw: DataFrame) -> DataFrame:
    from quayside.plans.catalog import _saved_offsets
    saved = _saved_offsets(raw).select(F.col("kafka_partition").alias("_p"), F.col("kafka_offset").alias("_half"))
    joined = raw.join(F.broadcast(saved), F.col("kafka_partition").cast("int") == F.col("_p"), "left")
    return joined.where(F.col("kafka_offset").cast("bigint") <= F.col("_half")).select(*raw.columns)


def raw_feeds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    f = _feeds(spark, sf)
    return {n: f.raw(n) for n in ("raw_events", "raw_transactions", "raw_partner_catalog",
                                  "raw_payment_stream")}


def two_run_lake(spark: SparkSession, sf: str) -> dict:
    """Full run over the first delivery, then an incremental run over all."""
    from quayside.plans.batch_run import run_batch
    from quayside.sinks.lake_table import LakeTable
    key = (spark.sparkContext.applicationId, sf)
    if key in _LAKES and LakeTable.of(spark, f"{_LAKES[key]['root']}/events", "events").exists():
        return _LAKES[key]
    root = scratch_path(spark, "lake")
    raw = raw_feeds(spark, sf)
    payments = raw["raw_payment_stream"]
    first = {
        "raw_events": raw["raw_events"].where(F.col("ingest_date") <= F.lit(FIRST_EVENTS_UNTIL).cast("date")),
        "raw_transactions": raw["raw_transactions"].where(
            F.col("ingest_ts") <= F.lit(FIRST_TXNS_UNTIL).cast("timestamp_ntz")),
        "raw_partner_catalog": raw["raw_partner_catalog"],
        "raw_payment_stream": _first_half(payments),
    }
    m1 = run_batch(spark, first, root).collect()[0].asDict()
    m2 = run_batch(spark, raw, root).collect()[0].asDict()
    _LAKES[key] = {"root": root, "first": m1, "second": m2}
    return _LAKES[key]


def _lake(spark, sf, path, dataset):
    """The current snapshot of a table of the two-run lake."""
    from quayside.sinks.lake_table import read_lake
    return read_lake(spark, f"{two_run_lake(spark, sf)['root']}/{path}", dataset)


def _read(spark, path, dataset):
    """A lake table by its contract: no inference, the partition column typed."""
    from quayside.sources.lake_scan import scan_lake
    return scan_lake(spark, path, SCHEMAS[dataset]).select(*SCHEMAS[dataset].names)


@register("batch_incremental_events", with_ctes(["ev_good"]) + "SELECT * FROM ev_good")
def q_batch_incremental_events(spark, sf):
    return _lake(spark, sf, "events", "events")


@register("batch_incremental_bots", with_ctes(["ev_bots"]) + "SELECT * FROM ev_bots")
def q_batch_incremental_bots(spark, sf):
    return _lake(spark, sf, "events_bots", "events_bots")


@register("batch_incremental_transactions", with_ctes(["tx_good"]) + "SELECT * FROM tx_good")
def q_batch_incremental_transactions(spark, sf):
    return _lake(spark, sf, "transactions", "transactions")


@register("batch_incremental_quarantine", with_ctes(["tx_quarantine"]) + "SELECT * FROM tx_quarantine")
def q_batch_incremental_quarantine(spark, sf):
    return _lake(spark, sf, "quarantine/transactions", "quarantine_transactions")


@register("batch_incremental_payments", with_ctes(["pm_all"]) + "SELECT * FROM pm_all")
def q_batch_incremental_payments(spark, sf):
    return _lake(spark, sf, "payments", "payments")


@register("batch_serving_partners", with_ctes(["pt_all"]) + "SELECT * FROM pt_all")
def q_batch_serving_partners(spark, sf):
    return _lake(spark, sf, "serving/partners", "partners")


@register("batch_quarantine_partners", with_ctes(["pt_all"])
          + f"SELECT *, 'unknown_schema_version' AS quarantine_reason FROM pt_all WHERE NOT COALESCE({KNOWN_SQL}, false)")
def q_batch_quarantine_partners(spark, sf):
    return _lake(spark, sf, "quarantine/partners", "quarantine_partners")


def _window_counts(run: int, mode: str, events: str, txns: str, offsets: str) -> str:
    """Counts of a run over the rows in its windows, deduplicated within them."""
    return f"""SELECT CAST({run} AS BIGINT) AS run, '{mode}' AS mode, e.good AS events, e.bots AS bots, t.good AS transactions,
  t.bad AS rejected_transactions, (SELECT COUNT(*) FROM pt_all) AS partners, p.n AS payments FROM
  (SELECT COUNT(*) FILTER (NOT bot) AS good, COUNT(*) FILTER (bot) AS bots FROM (
     SELECT COALESCE(lower(trim(is_bot_flag)) IN ('true', '1', 'yes'), false) AS bot FROM raw_events WHERE {events}
     QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_date DESC, _seq DESC) = 1)) e,
  (SELECT COUNT(*) FILTER (NOT neg) AS good, COUNT(*) FILTER (neg) AS bad FROM (
     SELECT COALESCE(CAST(amount AS DECIMAL(18,2)) < 0, false) AS neg FROM raw_transactions WHERE {txns}
     QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_ts DESC, _seq DESC) = 1)) t,
  (SELECT COUNT(DISTINCT event_id) AS n FROM raw_payment_stream JOIN half USING (kafka_partition) WHERE {offsets}) p"""


@register("batch_run_metrics", with_ctes(["raw_events", "raw_transactions", "raw_payment_stream", "pt_all"], {
    "half": "SELECT kafka_partition, COUNT(*) // 2 AS h FROM raw_payment_stream GROUP BY 1",
    "marks": f"""SELECT (SELECT max(ingest_date) FROM raw_events WHERE ingest_date <= DATE '{FIRST_EVENTS_UNTIL}') - 7 AS e,
      CAST(CAST((SELECT max(ingest_ts) FROM raw_transactions WHERE ingest_ts <= TIMESTAMP '{FIRST_TXNS_UNTIL}')
        - INTERVAL 7 DAY AS DATE) AS TIMESTAMP) AS t"""})
    + _window_counts(1, "full", f"ingest_date <= DATE '{FIRST_EVENTS_UNTIL}'", f"ingest_ts <= TIMESTAMP '{FIRST_TXNS_UNTIL}'",
                     "CAST(kafka_offset AS BIGINT) <= h") + " UNION ALL "
    + _window_counts(2, "incremental", "ingest_date >= (SELECT e FROM marks)", "ingest_ts >= (SELECT t FROM marks)",
                     "CAST(kafka_offset AS BIGINT) > h"))
def q_batch_run_metrics(spark, sf):
    """Counts of both runs: full, then incremental over its windows."""
    lake = two_run_lake(spark, sf)
    runs = [dict(lake["first"], run=1), dict(lake["second"], run=2)]
    cols = ["run", "mode", "events", "bots", "transactions", "rejected_transactions", "partners", "payments"]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in runs], "run long, mode string, " + ", ".join(
        f"{c} long" for c in cols[2:]))


@register("batch_full_refresh_events", with_ctes(["ev_good"]) + "SELECT * FROM ev_good")
def q_batch_full_refresh_events(spark, sf):
    from quayside.plans.batch_run import run_batch
    from quayside.sinks.lake_table import read_lake
    root = scratch_path(spark, "lake-full")
    run_batch(spark, raw_feeds(spark, sf), root, full_refresh=True).collect()
    return read_lake(spark, f"{root}/events", "events")


# ---- sources and sinks ---------------------------------------------------------

RAW_TXN_TEXT_SQL = "SELECT CAST(_seq AS VARCHAR) AS _seq, " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in RAW_TXN_FIELDS) + " FROM raw_transactions"


@register("scan_csv", with_ctes(["raw_transactions"]) + RAW_TXN_TEXT_SQL)
def q_scan_csv(spark, sf):
    """Land the transaction feed as CSV (quoted JSON in ``notes``, blanks),
    then read it back the header-driven, all-STRING way."""
    from quayside.sources.csv_feed import scan_csv, write_csv
    raw = _feeds(spark, sf).raw("raw_transactions")
    cols = ["_seq", *RAW_TXN_FIELDS]
    path = scratch_path(spark, "landing-transactions")
    write_csv(raw.select(*[F.col(c).cast("string").alias(c) for c in cols]), path)
    return scan_csv(spark, path, cols)


@register("sink_partitioned", with_ctes(["ev_good"]) + "SELECT * FROM ev_good")
def q_sink_partitioned(spark, sf):
    from quayside.sinks.lake_write import sink_partitioned
    path = scratch_path(spark, "sink-events")
    sink_partitioned(_feeds(spark, sf).events(), path, "ingest_date")
    return _read(spark, path, "events")


@register("sink_single", with_ctes(["pt_all"]) + "SELECT * FROM pt_all")
def q_sink_single(spark, sf):
    from quayside.sinks.lake_write import sink_single
    path = scratch_path(spark, "sink-partners")
    sink_single(_feeds(spark, sf).partners(), path)
    return spark.read.parquet(path)


@register("upsert_keyed", with_ctes(["tx_all"]) + "SELECT * FROM tx_all")
def q_upsert_keyed(spark, sf):
    """Two overlapping deliveries merged by key equal one full dedupe."""
    from quayside.plans.flows import transactions_all
    from quayside.sinks.lake_write import upsert_keyed
    raw = _feeds(spark, sf).raw("raw_transactions")
    ts = F.col("ingest_ts")
    first = transactions_all(raw.where(ts < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")))
    second = transactions_all(raw.where(ts >= F.lit("1997-12-25 00:00:00").cast("timestamp_ntz")))
    return upsert_keyed(first, second, ["transaction_id"])


@register("merge_partitioned", with_ctes(["tx_all"]) + "SELECT * FROM tx_all")
def q_merge_partitioned(spark, sf):
    """Same two deliveries merged in place into a table whose days lie together by
    month (re-delivered rows move to a later day, or a later month's partition)."""
    from quayside.plans.flows import transactions_all
    from quayside.sinks.lake_table import LakeTable
    from quayside.sinks.lake_write import stage
    raw = _feeds(spark, sf).raw("raw_transactions")
    ts = F.col("ingest_ts")
    first = transactions_all(raw.where(ts < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")))
    second = transactions_all(raw.where(ts >= F.lit("1997-12-25 00:00:00").cast("timestamp_ntz")))
    table = LakeTable.of(spark, scratch_path(spark, "merge-transactions"), "transactions")
    table.replace(first)
    table.merge(stage(second, "merge-delta"))
    return table.read()


def _contract_sql(dataset: str, cte: str) -> str:
    keys = ", ".join(KEYS[dataset])
    nulls = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in NOT_NULL[dataset])
    return with_ctes([cte]) + f"""SELECT COUNT(*) AS rows, {nulls},
      COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM {cte})) AS repeated_keys FROM {cte}"""


def _contract_query(dataset: str, cte: str, frame: str):
    @register(f"contract_check_{dataset}", _contract_sql(dataset, cte))
    def check(spark, sf):
        from quayside.contracts import conform, contract_check
        return contract_check(conform(getattr(_feeds(spark, sf), frame)(), dataset), dataset)


for _dataset, _cte, _frame in (("events", "ev_good", "events"), ("transactions", "tx_good", "transactions"),
                               ("partners", "pt_all", "partners"), ("payments", "pm_all", "payments")):
    _contract_query(_dataset, _cte, _frame)


@register("contract_gate", with_ctes(["ev_good"]) + """SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after,
  COUNT(*) FILTER (CAST(event_id AS BIGINT) % 50 = 0) AS null_event_id, false AS published FROM ev_good""")
def q_contract_gate(spark, sf):
    """A batch that breaks the contract of a table (some keys are missing) changes nothing in it."""
    from quayside.sinks.lake_table import ContractBroken, LakeTable
    from quayside.sinks.lake_write import stage
    events = stage(_feeds(spark, sf).events(), "gate-events")
    table = LakeTable.of(spark, scratch_path(spark, "gate"), "events")
    before = table.replace(events)
    key = F.col("event_id")
    broken = events.withColumn("event_id", F.when(key.cast("bigint") % 50 != 0, key)).withColumn("page", F.lit("/broken"))
    try:
        table.merge(stage(broken.dropDuplicates(["event_id", "ingest_date", "event_ts", "session_id"]), "gate-broken"))
        missing, published = 0, True
    except ContractBroken as e:
        missing, published = e.broken["null_event_id"], False
    after = table.read().where("page <> '/broken' or page is null").count()
    return spark.createDataFrame([(before["rows"], after, missing, published)],
                                 "rows_before long, rows_after long, null_event_id long, published boolean")


# Fixed values of the lenient fixture: the transaction feed as text, with values of each kind that don't parse.
DIRTY = {
    "amount": "CASE WHEN _seq % 97 = 5 THEN 'abc' WHEN _seq % 101 = 9 THEN '12,50' ELSE amount END",
    "retry_count": "CASE WHEN _seq % 89 = 4 THEN '1.0' ELSE retry_count END",
    "processing_ms": "CASE WHEN _seq % 83 = 7 THEN '99999999999' ELSE processing_ms END",
    "created_at": """CASE WHEN _seq % 79 = 3 THEN '2024' WHEN _seq % 73 = 2 THEN '1997-13-01 00:00:00'
      WHEN _seq % 71 = 6 THEN '1997-01-01T10:00:00+03:00' WHEN _seq % 67 = 8 THEN '' ELSE CAST(created_at AS STRING) END""",
    "ingest_ts": "CASE WHEN _seq % 61 = 1 THEN 'yesterday' ELSE CAST(ingest_ts AS STRING) END",
}


def dirty_transactions(spark, sf):
    raw = _feeds(spark, sf).raw("raw_transactions")
    return raw.withColumns({c: F.expr(x) for c, x in DIRTY.items()})


def _lenient_ctes() -> dict[str, str]:
    ws = r"'^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$'"
    ts = lambda c: f"CASE WHEN regexp_matches({c}, {ws}) THEN TRY_CAST({c} AS TIMESTAMP) END"
    dirty = ", ".join(f"{x} AS {c}" for c, x in DIRTY.items())
    rest = ", ".join(c for c in ("_seq", *RAW_TXN_FIELDS) if c not in DIRTY)
    reason = lambda c, rule, typed: (f"SELECT transaction_id, '{c}' AS \"column\", '{rule}' AS rule, trim({c}) AS text "  # noqa: E731
                                     f"FROM typed WHERE NULLIF(trim({c}), '') IS NOT NULL AND {typed} IS NULL")
    whole = r"'^\d+$'"
    return {
        "dirty": f"SELECT {rest}, {dirty} FROM raw_transactions",
        "typed": f"""SELECT *, TRY_CAST(NULLIF(amount, '') AS DECIMAL(18,2)) AS amount_t, {ts('created_at')} AS created_t, {ts('ingest_ts')} AS ingest_t,
          CASE WHEN regexp_matches(retry_count, {whole}) THEN TRY_CAST(retry_count AS INTEGER) END AS retry_t,
          CASE WHEN regexp_matches(processing_ms, {whole}) THEN TRY_CAST(processing_ms AS INTEGER) END AS ms_t
          FROM dirty QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_ts DESC, _seq DESC) = 1""",
        "reasons": " UNION ALL ".join([
            reason("created_at", "timestamp", "created_t"), reason("ingest_ts", "timestamp", "ingest_t"), reason("amount", "number", "amount_t"),
            reason("retry_count", "integer", "retry_t"), reason("processing_ms", "integer", "ms_t"),
            "SELECT transaction_id, 'created_at', 'missing', '' FROM typed WHERE NULLIF(trim(created_at), '') IS NULL"]),
    }


@register("lenient_transactions", with_ctes(["raw_transactions"], _lenient_ctes()) + """SELECT transaction_id, booking_ref, partner_id, user_id,
  created_t AS created_at, ingest_t AS ingest_ts, amount_t AS amount, upper(currency) AS currency, lower(trim(status)) AS status, payment_method, gateway,
  retry_t AS retry_count, error_code, notes, ms_t AS processing_ms, CAST(ingest_t AS DATE) AS ingest_date, ingest_t - created_t > INTERVAL 7 DAY AS is_late
  FROM typed WHERE transaction_id NOT IN (SELECT transaction_id FROM reasons)""")
def q_lenient_transactions(spark, sf):
    """The records of a feed with invalid values that do parse, typed."""
    from quayside.operators.splits import split_errors
    from quayside.plans.flows import transactions_all
    return split_errors(transactions_all(dirty_transactions(spark, sf), strict=False))[0]


@register("lenient_quarantine", with_ctes(["raw_transactions"], _lenient_ctes())
          + 'SELECT transaction_id AS record_key, "column", rule, text FROM reasons')
def q_lenient_quarantine(spark, sf):
    """The other records, one row per reason."""
    from quayside.operators.splits import as_invalid, split_errors
    from quayside.plans.flows import transactions_all
    rejected = split_errors(transactions_all(dirty_transactions(spark, sf), strict=False))[1]
    return as_invalid(rejected, "transactions", KEYS["transactions"]).select("record_key", F.inline("reasons"))


# ---- 2.10 lake maintenance ------------------------------------------------------

MICRO_BATCHES = 5


def fragmented_events(spark: SparkSession, sf: str) -> str:
    """Good events as a stream of micro-batches leaves them: each batch (event id
    modulo ``MICRO_BATCHES``) appends one file to every day it has rows of."""
    from quayside.sinks.lake_write import stage, unstage
    path = scratch_path(spark, "fragmented-events")
    events = stage(_feeds(spark, sf).events(), "events-to-fragment")
    for k in range(MICRO_BATCHES):
        (events.where(F.pmod(F.col("event_id").cast("bigint"), F.lit(MICRO_BATCHES)) == k)
         .repartition("ingest_date").write.mode("append").partitionBy("ingest_date").parquet(path))
    unstage(events)
    return path


# What the writer must leave: files per day, whatever their names and bytes.
FILES_SQL = f"""SELECT 'ingest_date=' || CAST(ingest_date AS VARCHAR) AS partition,
  COUNT(DISTINCT CAST(event_id AS BIGINT) % {MICRO_BATCHES}) AS file_count FROM ev_good GROUP BY 1"""


@register("scan_file_inventory", with_ctes(["ev_good"], {"files": FILES_SQL})
          + "SELECT partition, file_count, true AS all_have_bytes, true AS all_in_partition FROM files")
def q_scan_file_inventory(spark, sf):
    """The inventory summed per partition (file names and sizes are the writer's)."""
    from quayside.sources.lake_scan import scan_file_inventory
    files = scan_file_inventory(spark, fragmented_events(spark, sf))
    return files.groupBy("partition").agg(
        F.count_distinct("path").alias("file_count"), F.bool_and(F.col("bytes") > 0).alias("all_have_bytes"),
        F.bool_and(F.col("path").startswith(F.col("partition_path"))
                   & F.col("partition_path").endswith(F.col("partition"))).alias("all_in_partition"))


@register("partition_file_stats", with_ctes(["ev_good"], {"files": FILES_SQL})
          + "SELECT partition, file_count, true AS bytes_add_up FROM files")
def q_partition_file_stats(spark, sf):
    from quayside.operators.maintenance import partition_file_stats
    from quayside.sources.lake_scan import scan_file_inventory
    stats = partition_file_stats(scan_file_inventory(spark, fragmented_events(spark, sf)))
    return stats.select("partition", "file_count", (
        (F.col("total_bytes") > 0) & (F.round(F.col("average_bytes") * F.col("file_count")) == F.col("total_bytes")))
        .alias("bytes_add_up"))


SMALL_FILES_SQL = """SELECT 'SmallFilesPerPartitionHigh' AS alert, 'warning' AS severity,
  '{summary}' AS summary, partition || '/' || partition AS series,
  CAST(file_count AS DOUBLE) AS value, file_count > 1 AS firing FROM files"""


def _small_files_sql() -> str:
    from quayside.operators.ops_metrics import ALERT_LABELS
    severity, summary = ALERT_LABELS["SmallFilesPerPartitionHigh"]
    return SMALL_FILES_SQL.format(summary=summary).replace("'warning'", f"'{severity}'")


def _file_stats(spark, sf):
    from quayside.operators.maintenance import partition_file_stats
    from quayside.sources.lake_scan import scan_file_inventory
    return partition_file_stats(scan_file_inventory(spark, fragmented_events(spark, sf)))


@register("alert_small_files", with_ctes(["ev_good"], {"files": FILES_SQL}) + _small_files_sql())
def q_alert_small_files(spark, sf):
    """Every file of the check is far under the small-file size, so a day fires
    as soon as it has more than one."""
    from quayside.operators.ops_metrics import alert_small_files
    return alert_small_files(_file_stats(spark, sf))


@register("alerts", with_ctes(["ev_good", "pipeline_runs", "raw_payment_stream"], {
    "run_status": RUN_STATUS_SQL, "run_duration": RUN_DURATION_SQL, "stream_lag": STREAM_LAG_SQL, "files": FILES_SQL,
    "evaluated": " UNION ALL ".join([ALERT_FAILURE_SQL, ALERT_DURATION_SQL, ALERT_LAG_SQL, _small_files_sql()])})
    + "SELECT alert, severity, summary, series, value FROM evaluated WHERE firing")
def q_alerts(spark, sf):
    from quayside.operators import ops_metrics as om
    f = _feeds(spark, sf)
    runs = f.raw("pipeline_runs")
    return om.alerts(om.alert_failure_rate(runs), om.alert_duration(runs),
                     om.alert_stream_lag(f.raw("raw_payment_stream")), om.alert_small_files(_file_stats(spark, sf)))


@register("small_partitions", with_ctes(["ev_good"], {"files": FILES_SQL})
          + "SELECT partition, file_count, file_count > 1 AS needs_compaction FROM files ORDER BY partition")
def q_small_partitions(spark, sf):
    from quayside.operators.maintenance import small_partitions
    found = small_partitions(spark, fragmented_events(spark, sf))
    return found.select(F.regexp_extract("partition", r"([^/]+)$", 1).alias("partition"), "file_count", "needs_compaction")


@register("compact_partitions", with_ctes(["ev_good"]) + "SELECT * FROM ev_good")
def q_compact_partitions(spark, sf):
    """Compact every fragmented day in place, then read the table back: the
    rows must be exactly the rows written."""
    from quayside.operators.maintenance import compact_partitions
    path = fragmented_events(spark, sf)
    compact_partitions(spark, path, apply=True).collect()
    return _read(spark, path, "events")


@register("compact_table", with_ctes(["ev_good"]) + "SELECT * FROM ev_good")
def q_compact_table(spark, sf):
    from quayside.operators.maintenance import compact_table
    source = fragmented_events(spark, sf)
    destination = scratch_path(spark, "compacted-events")
    compact_table(spark, source, destination, "ingest_date")
    return _read(spark, destination, "events")


@register("compaction_report", with_ctes(["ev_good"], {"files": FILES_SQL}) + """SELECT
  bool_or(file_count > 1) AS detected, CAST(SUM(file_count) AS BIGINT) AS files_before, COUNT(*) AS files_after,
  (SELECT COUNT(*) FROM ev_good) AS rows_before, (SELECT COUNT(*) FROM ev_good) AS rows_after, true AS rows_preserved,
  round((1 - COUNT(*) / SUM(file_count)) * 100, 2) AS reduction_percent FROM files""")
def q_compaction_report(spark, sf):
    """Detection, files and rows before/after, reduction %."""
    from quayside.operators.maintenance import compact_partitions, compaction_report, small_partitions
    from quayside.sources.lake_scan import scan_file_inventory
    path = fragmented_events(spark, sf)
    before = scan_file_inventory(spark, path).count()
    rows_before = spark.read.parquet(path).count()
    detected = small_partitions(spark, path).where("needs_compaction").count() > 0
    compact_partitions(spark, path, apply=True).collect()
    after = scan_file_inventory(spark, path).count()
    rows_after = spark.read.parquet(path).count()
    return compaction_report(spark, before, after, rows_before, rows_after, detected)


@register("control_table", with_ctes(["raw_events", "raw_transactions", "raw_payment_stream"]) + f"""
SELECT run_id, CAST(max(d) AS VARCHAR) AS events, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS transactions,
  CAST(max(o) AS BIGINT) AS offset_sum FROM (
  SELECT CAST(1 AS BIGINT) AS run_id, max(ingest_date) AS d, NULL AS t, NULL AS o FROM raw_events WHERE ingest_date <= DATE '{FIRST_EVENTS_UNTIL}'
  UNION ALL SELECT 2, max(ingest_date), NULL, NULL FROM raw_events
  UNION ALL SELECT 1, NULL, max(ingest_ts), NULL FROM raw_transactions WHERE ingest_ts <= TIMESTAMP '{FIRST_TXNS_UNTIL}'
  UNION ALL SELECT 2, NULL, max(ingest_ts), NULL FROM raw_transactions
  UNION ALL SELECT 1, NULL, NULL, SUM(n // 2) FROM (SELECT COUNT(*) AS n FROM raw_payment_stream GROUP BY kafka_partition)
  UNION ALL SELECT 2, NULL, NULL, SUM(n - 1) FROM (SELECT COUNT(*) AS n FROM raw_payment_stream GROUP BY kafka_partition))
GROUP BY run_id""")
def q_control_table(spark, sf):
    """The committed marks of the two runs, as columns; the offsets by their sum."""
    lake = two_run_lake(spark, sf)
    marks = spark.read.parquet(f"{lake['root']}/_state/control").withColumn("m", F.from_json(
        "marks", "events string, transactions string, payment_offsets map<string, bigint>"))
    return marks.select("run_id", "m.events", "m.transactions", F.aggregate(
        F.map_values("m.payment_offsets"), F.lit(0).cast("bigint"), lambda a, o: a + o).alias("offset_sum"))


@register("scan_run_log", with_ctes(["pipeline_runs"]) +
          """SELECT pipeline_name AS pipeline, lower(status) AS status, COUNT(*) AS runs
             FROM pipeline_runs GROUP BY 1, 2""")
def q_scan_run_log(spark, sf):
    """Run log landed as CSV, scanned as text, then counted by status."""
    from quayside.operators.ops_metrics import run_status_counts
    from quayside.sources.csv_feed import scan_run_log, write_csv
    runs = _feeds(spark, sf).raw("pipeline_runs")
    path = scratch_path(spark, "landing-runs")
    write_csv(runs.select(*[F.col(c).cast("string").alias(c) for c in runs.columns]), path)
    return run_status_counts(scan_run_log(spark, path, runs.columns))


@register("funnel_lake", _funnel_sql(*EVENT_RANGE))
def q_funnel_lake(spark, sf):
    """The funnel served from the events table: its zones say which days can hold the range, whatever
    day the rows came in on; the range is also pushed to the scan of those days."""
    import datetime as dt

    from quayside.operators.analytics import funnel
    from quayside.sinks.lake_table import LakeTable
    table = LakeTable(spark, scratch_path(spark, "lake-events"), SCHEMAS["events"], (), "ingest_date", "event_ts")  # nothing is merged into it
    table.replace(_feeds(spark, sf).events())
    start, end = (dt.datetime.fromisoformat(d) for d in EVENT_RANGE)
    return funnel(table.read(start, end + dt.timedelta(days=1)), *EVENT_RANGE)
