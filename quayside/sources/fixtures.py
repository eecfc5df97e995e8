"""Adapter views that shape the driver tables into the five raw feeds.

The SQL text is shared verbatim by Spark (temp views over the Parquet tables)
and by the DuckDB oracle (CTEs), so both engines see identical raw rows.
``_seq`` is the arrival order that breaks ties ("the later row wins").

``raw_payment_stream`` needs a dense per-partition offset. DuckDB computes it
with ``row_number() OVER (PARTITION BY partition ...)``; Spark computes the same
numbers with :func:`quayside.operators.sequence.dense_sequence`, which never
funnels one Kafka partition (an eighth of the data, or more under skew) through
a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

RAW_EVENTS_SQL = """
WITH src AS (
  SELECT *, CAST(ts AS DATE) AS d, 0 AS copy_no FROM events
  UNION ALL
  SELECT *, CAST(ts AS DATE) AS d, 1 AS copy_no FROM events WHERE event_id % 50 = 0
)
SELECT event_id * 2 + copy_no AS _seq,
  CAST(event_id AS STRING) AS event_id,
  CASE WHEN event_id % 7 = 0 THEN upper(event_type) ELSE event_type END AS event_type,
  'S' || CAST(user_id AS STRING) || '-' || CAST(d AS STRING) AS session_id,
  CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS user_id,
  ts AS event_ts,
  CASE WHEN copy_no = 1 THEN '/redelivered' WHEN event_id % 33 = 1 THEN '  ' ELSE '/' END AS page,
  CASE WHEN event_id % 9 < 4 THEN '' WHEN event_id % 401 = 8 THEN 'PRT7777'
    ELSE 'PRT' || lpad(CAST(user_id % 20 + 1 AS STRING), 4, '0') END AS partner_id,
  CASE event_id % 4 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'mobile' ELSE ' desktop' END AS device,
  CASE event_id % 5 WHEN 0 THEN 'BR' WHEN 1 THEN 'br' WHEN 2 THEN 'Br' WHEN 3 THEN ' ar' ELSE '' END AS country,
  CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'google_cpc' WHEN 2 THEN 'direct' ELSE ' email ' END AS channel,
  CASE WHEN event_id % 2 = 0 THEN CAST(value AS STRING) ELSE '' END AS price_usd,
  props AS metadata_json,
  CASE event_id % 33 WHEN 0 THEN 'True' WHEN 5 THEN 'no' WHEN 6 THEN '' ELSE 'False' END AS is_bot_flag,
  d + CASE WHEN event_id % 100 = 0 THEN copy_no * 10 WHEN event_id % 53 = 0 THEN 9 ELSE 0 END AS ingest_date
FROM src
"""

RAW_TRANSACTIONS_SQL = """
WITH src AS (
  SELECT *, 0 AS copy_no FROM orders
  UNION ALL
  SELECT *, 1 AS copy_no FROM orders WHERE o_orderkey % 60 = 0
)
SELECT o_orderkey * 2 + copy_no AS _seq,
  'TXN' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS transaction_id,
  CASE WHEN o_orderkey % 25 = 0 THEN '' ELSE 'BKG' || lpad(CAST(o_orderkey AS STRING), 7, '0') END AS booking_ref,
  CASE WHEN o_orderkey % 301 = 5 THEN 'PRT8888'
    ELSE 'PRT' || lpad(CAST(o_custkey % 20 + 1 AS STRING), 4, '0') END AS partner_id,
  CASE WHEN o_orderkey % 16 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS user_id,
  o_orderdate AS created_at,
  CASE o_orderkey % 40 WHEN 0 THEN o_orderdate + INTERVAL '8' DAY WHEN 1 THEN o_orderdate + INTERVAL '7' DAY
    WHEN 2 THEN o_orderdate + INTERVAL '3' DAY ELSE o_orderdate + INTERVAL '1' HOUR END
    + CASE WHEN copy_no = 1 THEN INTERVAL '1' DAY ELSE INTERVAL '0' DAY END AS ingest_ts,
  CASE WHEN o_orderkey % 200 = 3 THEN '-' ELSE '' END
    || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS amount,
  CASE o_orderkey % 3 WHEN 0 THEN 'brl' WHEN 1 THEN 'BRL' ELSE 'USD' END AS currency,
  CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'CONFIRMED' ELSE 'Confirmed' END
    WHEN 'O' THEN 'completed' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'FAILED' ELSE 'refunded' END END AS status,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'pix' WHEN 2 THEN 'boleto' ELSE 'credit_card' END AS payment_method,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'stripe' END AS gateway,
  CASE WHEN o_orderkey % 20 = 0 THEN '' ELSE CAST(o_orderkey % 3 AS STRING) END AS retry_count,
  CASE WHEN o_orderstatus = 'P' THEN 'E001' ELSE '' END AS error_code,
  CASE WHEN o_orderkey % 100 = 7 THEN '{"legacy_id":' || CAST(o_orderkey AS STRING) || '}' ELSE 'ok' END AS notes,
  CASE WHEN o_orderkey % 26 = 0 THEN '' ELSE CAST(o_orderkey % 9000 AS STRING) END AS processing_ms
FROM src
"""

RAW_PARTNER_CATALOG_SQL = """
SELECT s_suppkey AS _seq,
  'PRT' || lpad(CAST(s_suppkey % 20 + 1 AS STRING), 4, '0') AS partner_id,
  CASE WHEN s_suppkey % 7 = 3 THEN 'v9' WHEN s_suppkey % 3 = 0 THEN 'v1' WHEN s_suppkey % 3 = 1 THEN 'V2' ELSE 'v3' END AS schema_version,
  s_name AS name,
  CASE WHEN s_suppkey % 25 = 0 THEN '' WHEN s_suppkey % 2 = 0 THEN 'br' ELSE 'MX' END AS country_code,
  CASE s_suppkey % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'Active' WHEN 2 THEN 'inactive' ELSE 'suspended' END AS status,
  CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'gold' ELSE 'bronze' END AS tier,
  CAST(CAST(0.05 + (s_suppkey % 15) * 0.01 AS DECIMAL(8,4)) AS STRING) AS commission_rate,
  CAST(DATE '2019-01-01' + CAST(s_suppkey AS INT) AS STRING) || ' 09:00:00' AS created_at,
  CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE CAST(DATE '2021-01-01' + CAST(s_suppkey % 60 AS INT) AS STRING) || ' 10:00:00' END AS updated_at,
  CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE CAST(s_suppkey % 72 AS STRING) END AS sla_hours,
  CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '4.5' END AS avg_rating,
  CASE WHEN s_suppkey % 3 = 2 THEN 'https://api.example.com/v1' ELSE '' END AS api_endpoint,
  CASE WHEN s_suppkey % 3 <> 2 THEN '' WHEN s_suppkey % 2 = 0 THEN 'True' ELSE 'false' END AS webhook_enabled
FROM supplier
"""

# Columns of the payment feed apart from the offset; shared by both engines.
_PAYMENT_COLUMNS_SQL = """
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS event_id,
  CASE l_returnflag WHEN 'A' THEN 'payment_approved' WHEN 'R' THEN 'chargeback' ELSE 'payment_refused' END AS event_type,
  CASE WHEN l_orderkey % 211 = 9 THEN 'GONE' ELSE 'TXN' END || lpad(CAST(l_orderkey AS STRING), 8, '0') AS transaction_id,
  CASE WHEN l_orderkey % 16 = 0 THEN '' ELSE CAST(l_orderkey % 5000 AS STRING) END AS user_id,
  'PRT' || lpad(CAST(l_suppkey % 20 + 1 AS STRING), 4, '0') AS partner_id,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS amount,
  'BRL' AS currency,
  CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'Refunded' ELSE 'refused' END AS status,
  CASE l_partkey % 3 WHEN 0 THEN 'adyen' WHEN 1 THEN 'stripe' ELSE '' END AS gateway,
  l_shipdate AS event_ts,
  CAST(l_suppkey % 8 AS STRING) AS kafka_partition,"""

_PAYMENT_TAIL_SQL = """
  CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_partkey % 400 * 1000 AS STRING) END AS processing_lag_ms,
  CASE WHEN l_partkey % 6 = 0 THEN 'True' ELSE 'False' END AS is_spike"""

# Total order that defines arrival inside a Kafka partition.
PAYMENT_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")

RAW_PAYMENT_STREAM_SQL = (
    "SELECT" + _PAYMENT_COLUMNS_SQL + """
  CAST(row_number() OVER (PARTITION BY l_suppkey % 8 ORDER BY """ + ", ".join(PAYMENT_ORDER) + """) - 1 AS STRING) AS kafka_offset,"""
    + _PAYMENT_TAIL_SQL + "\nFROM lineitem\n")

PIPELINE_RUNS_SQL = """
SELECT 'RUN' || lpad(CAST(o_orderkey AS STRING), 7, '0') AS run_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'ingest_events' WHEN 1 THEN 'transform_funnel' ELSE 'load_serving' END AS pipeline_name,
  CASE o_orderkey % 5 WHEN 0 THEN 'manual' WHEN 1 THEN 'backfill' ELSE 'scheduled' END AS run_type,
  o_orderdate AS started_at,
  CASE WHEN o_orderkey % 200 = 0 THEN 7300 ELSE CAST(o_orderkey % 3000 AS INT) END AS duration_sec,
  CASE WHEN o_orderkey % 100 < 12 THEN 'Failed' WHEN o_orderkey % 100 < 15 THEN 'timeout' ELSE 'success' END AS status,
  CAST(o_orderkey % 4 AS INT) AS retry_attempt
FROM orders
"""

# A request log for the latency / rate summaries (the reference computes them
# from HTTP traffic; here every clickstream event is one served request).
REQUEST_LOG_SQL = """
SELECT event_id AS request_id, ts AS request_ts, '/v1/' || event_type AS path,
  CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 97 = 0 THEN 429 ELSE 200 END AS status_code,
  CAST(round(value * 3) AS BIGINT) AS latency_ms
FROM events
"""

# API ingest payloads: clickstream rows re-sent through the ingest endpoint,
# with some re-deliveries and some invalid fields.
API_PAYLOADS_SQL = """
WITH src AS (
  SELECT *, 0 AS copy_no FROM events
  UNION ALL
  SELECT *, 1 AS copy_no FROM events WHERE event_id % 45 = 0
)
SELECT event_id * 2 + copy_no AS _seq,
  CASE WHEN event_id % 41 = 0 THEN 'e' || CAST(event_id AS STRING)
    ELSE 'evt-' || lpad(CAST(event_id AS STRING), 8, '0') END AS event_id,
  event_type,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE 'S' || CAST(user_id AS STRING) END AS session_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
  CAST(ts AS STRING) AS event_ts,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE '/' || event_type END AS page,
  CASE WHEN event_id % 9 < 4 THEN NULL ELSE 'PRT' || lpad(CAST(user_id % 20 + 1 AS STRING), 4, '0') END AS partner_id,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'mobile' END AS device,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'BR' END AS country,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'direct' END AS channel,
  CASE WHEN event_id % 47 = 0 THEN '12,5' WHEN event_id % 2 = 0 THEN CAST(value AS STRING) ELSE NULL END AS price_usd,
  props AS metadata_json,
  CASE WHEN event_id % 43 = 0 THEN '2024-13-01' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS ingest_date
FROM src
"""

ADAPTERS = {
    "api_payloads": API_PAYLOADS_SQL,
    "raw_events": RAW_EVENTS_SQL,
    "raw_transactions": RAW_TRANSACTIONS_SQL,
    "raw_partner_catalog": RAW_PARTNER_CATALOG_SQL,
    "raw_payment_stream": RAW_PAYMENT_STREAM_SQL,
    "pipeline_runs": PIPELINE_RUNS_SQL,
    "request_log": REQUEST_LOG_SQL,
}


def register_base_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def _sql(spark: SparkSession, sf_dir: str, text: str, tables) -> DataFrame:
    register_base_tables(spark, sf_dir, tables)
    return spark.sql(text)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RAW_EVENTS_SQL, ["events"])


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RAW_TRANSACTIONS_SQL, ["orders"])


def raw_partner_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RAW_PARTNER_CATALOG_SQL, ["supplier"])


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PIPELINE_RUNS_SQL, ["orders"])


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, REQUEST_LOG_SQL, ["events"])


_LANDED_FEEDS: dict[tuple, str] = {}


def raw_payment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment topic, landed once per (session, data directory).

    Numbering offsets is ingest work (a Kafka topic carries them): the feed is
    sorted and written once to the shared checkpoint folder, each row with its place
    in its slice, and beside it the number at which each slice starts; an offset is the
    sum of both. Every payment query reads that landed table.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    from quayside.operators.sequence import number_by_slice, slice_starts
    from quayside.session import released_shuffles, scratch_path
    from quayside.sinks.lake_write import CODEC, has_parquet

    if key not in _LANDED_FEEDS or not has_parquet(spark, f"{_LANDED_FEEDS[key]}/starts"):
        path = scratch_path(spark, "landed-payment-stream")
        with released_shuffles(spark):
            _slice_payment_stream(spark, sf_dir).write.mode("overwrite").option("compression", CODEC).parquet(f"{path}/rows")
        slice_starts(spark.read.parquet(f"{path}/rows"), "kafka_partition").write.mode("overwrite").parquet(f"{path}/starts")
        _LANDED_FEEDS[key] = path
    # the slices cut the sorted feed, so there are as many starts as slices and Kafka partitions together
    rows, starts = (spark.read.parquet(f"{_LANDED_FEEDS[key]}/{x}") for x in ("rows", "starts"))
    numbered = number_by_slice(rows, F.broadcast(starts), "kafka_partition", "kafka_offset")
    return numbered.withColumn("kafka_offset", F.col("kafka_offset").cast("string")).select(*PAYMENT_FEED_COLUMNS)


SLICE_ROWS = 500_000  # at most about as many rows are sorted by one task

PAYMENT_FEED_COLUMNS = ["event_id", "event_type", "transaction_id", "user_id", "partner_id", "amount", "currency",
                        "status", "gateway", "event_ts", "kafka_partition", "kafka_offset", "processing_lag_ms",
                        "is_spike"]


def _slice_payment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's rows, in slices; only the columns that order them are shuffled, the text is made of them after it."""
    from quayside.operators.sequence import slice_and_number

    register_base_tables(spark, sf_dir, ["lineitem"])
    columns = spark.sql("SELECT CAST(l_suppkey % 8 AS STRING) AS _group, " + ", ".join(PAYMENT_ORDER) + " FROM lineitem")
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-columns.count() // SLICE_ROWS))
    sliced = slice_and_number(columns, "_group", list(PAYMENT_ORDER), slices)
    feed = spark.sql("SELECT *," + _PAYMENT_COLUMNS_SQL + _PAYMENT_TAIL_SQL + "\nFROM {sliced}", sliced=sliced)
    return feed.select(*[c for c in PAYMENT_FEED_COLUMNS if c != "kafka_offset"], "_slice", "_rid")


def api_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, API_PAYLOADS_SQL, ["events"])


RAW_LOADERS = {
    "api_payloads": api_payloads,
    "raw_events": raw_events,
    "raw_transactions": raw_transactions,
    "raw_partner_catalog": raw_partner_catalog,
    "raw_payment_stream": raw_payment_stream,
    "pipeline_runs": pipeline_runs,
    "request_log": request_log,
}


def cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({ADAPTERS[n]})" for n in names)
