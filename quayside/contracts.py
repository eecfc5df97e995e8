"""Dataset contracts: column order, keys, partition columns and typed schemas.

Types are explicit everywhere (no inference): timestamps are TIMESTAMP_NTZ,
money is DECIMAL(18,2), commission DECIMAL(8,6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(), "timestamp_ntz": TimestampNTZType(), "date": DateType(), "boolean": BooleanType(),
    "int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "money": DecimalType(18, 2),
    "rate": DecimalType(8, 6),
}


def _fields(text: str) -> StructType:
    """``name type, name type, ...`` without a session (a DDL parser needs one)."""
    pairs = [f.split() for f in text.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# The fields of the lake tables, in their order, with their types.
SCHEMAS = {
    "events": _fields(
        "event_id string, event_type string, session_id string, user_id string, event_ts timestamp_ntz, "
        "page string, partner_id string, device string, country string, channel string, price_usd double, "
        "metadata_json string, is_bot_flag boolean, ingest_date date"),
    "transactions": _fields(
        "transaction_id string, booking_ref string, partner_id string, user_id string, "
        "created_at timestamp_ntz, ingest_ts timestamp_ntz, amount money, currency string, "
        "status string, payment_method string, gateway string, retry_count int, error_code string, "
        "notes string, processing_ms int, ingest_date date, is_late boolean"),
    "partners": _fields(
        "partner_id string, schema_version string, name string, country_code string, status string, "
        "tier string, commission_rate rate, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "sla_hours int, avg_rating double, api_endpoint string, webhook_enabled boolean"),
    "payments": _fields(
        "event_id string, event_type string, transaction_id string, user_id string, partner_id string, "
        "amount money, currency string, status string, gateway string, event_ts timestamp_ntz, "
        "kafka_offset bigint, kafka_partition int, processing_lag_ms bigint, is_spike boolean, "
        "event_date date"),
}
SCHEMAS["invalid"] = StructType([
    StructField("feed", StringType()), StructField("record_key", StringType()),
    StructField("reasons", ArrayType(StructType([StructField(c, StringType()) for c in ("column", "rule", "text")]))),
    StructField("record", StringType())])
SCHEMAS["events_bots"] = SCHEMAS["events"]
SCHEMAS["quarantine_partners"] = StructType(
    [*SCHEMAS["partners"].fields, StructField("quarantine_reason", StringType())])
SCHEMAS["quarantine_transactions"] = StructType(
    [*SCHEMAS["transactions"].fields, StructField("quarantine_reason", StringType())])

EVENT_COLUMNS = tuple(SCHEMAS["events"].names)
TXN_COLUMNS = tuple(SCHEMAS["transactions"].names)
PARTNER_COLUMNS = tuple(SCHEMAS["partners"].names)
PAYMENT_COLUMNS = tuple(SCHEMAS["payments"].names)

# Serving keys (conflict targets of the upsert) and lake partition columns.
KEYS = {
    "events": ("event_id",),
    "transactions": ("transaction_id",),
    "partners": ("partner_id", "schema_version", "created_at"),
    "payments": ("event_id",),
    "invalid": ("feed", "record_key"),
}
PARTITION_BY = {
    "events": "ingest_date",
    "events_bots": "ingest_date",
    "transactions": "ingest_date",
    "quarantine_transactions": "ingest_date",
    "payments": "event_date",
    "invalid": "feed",
}
# Feeds whose days are many and small are laid out by the month of that column.
PARTITION_GRAIN = {"transactions": "month", "quarantine_transactions": "month", "payments": "month"}
NOT_NULL = {
    "events": ("event_id", "event_type", "session_id", "event_ts", "is_bot_flag", "ingest_date"),
    "transactions": ("transaction_id", "partner_id", "created_at", "ingest_ts"),
    "partners": ("partner_id", "schema_version", "created_at"),
    "payments": ("event_id",),
    "invalid": ("feed", "record_key"),
}

# What a table does with rows that break a rule, where it isn't to fail the commit:
# an event whose bot flag is missing counts as no bot.
ON_BROKEN = {"events": {"null_is_bot_flag": "warn"}}

# Raw feeds have the lake's fields, less those that the lake derives.
RAW_EVENT_FIELDS = EVENT_COLUMNS
RAW_TXN_FIELDS = tuple(c for c in TXN_COLUMNS if c not in ("ingest_date", "is_late"))
RAW_PARTNER_FIELDS = PARTNER_COLUMNS
RAW_PAYMENT_FIELDS = tuple(c for c in PAYMENT_COLUMNS if c != "event_date")


def conform(df: DataFrame, dataset: str) -> DataFrame:
    """``df`` as its contract: the columns, in order; a wrong type is an error."""
    wrong = [f"{f.name}: {df.schema[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}"
             for f in SCHEMAS[dataset] if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    if missing := [c for c in SCHEMAS[dataset].names if c not in df.columns]:
        wrong.append(f"missing {missing}")
    if wrong:
        raise TypeError(f"{dataset}: " + "; ".join(wrong))
    return df.select(*SCHEMAS[dataset].names)


def string_schema(columns) -> StructType:
    """Raw feeds are read as all-STRING so every cast is an explicit rule."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def contract_check(df: DataFrame, dataset: str) -> DataFrame:
    """One row: row count, NULL count per NOT NULL column and repeated-key count.

    One grouped pass over the key (partial-aggregated map-side), then a global
    sum over the per-key counts.
    """
    keys = list(KEYS[dataset])
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NOT_NULL[dataset]])
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).cast("bigint").alias(f"null_{c}")
          for c in NOT_NULL[dataset]],
        F.coalesce(F.sum(F.greatest(F.col("_n") - 1, F.lit(0))), F.lit(0)).cast("bigint")
         .alias("repeated_keys"))
