"""Typed projections of the four raw feeds (one ``select`` each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.contracts import PARTNER_COLUMNS, PAYMENT_COLUMNS, TXN_COLUMNS
from quayside.functions.cleaning import Fields, clean, lower_clean, upper_or_empty

# ``strict=False`` adds ``_errors`` (see :class:`~quayside.functions.cleaning.Fields`) to each projection.


def normalize_events(df: DataFrame, strict: bool = True) -> DataFrame:
    f = Fields(df, strict)
    return df.select(
        F.col("event_id").cast("string").alias("event_id"),
        lower_clean("event_type").alias("event_type"),
        F.col("session_id").cast("string").alias("session_id"),
        clean("user_id").alias("user_id"),
        f.timestamp("event_ts").alias("event_ts"),
        clean("page").alias("page"),
        clean("partner_id").alias("partner_id"),
        lower_clean("device").alias("device"),
        upper_or_empty("country").alias("country"),
        clean("channel").alias("channel"),
        f.number("price_usd").alias("price_usd"),
        clean("metadata_json").alias("metadata_json"),
        f.boolean("is_bot_flag").alias("is_bot_flag"),
        f.date("ingest_date").alias("ingest_date"),
        *f.errors(["event_id", "event_type", "session_id", "event_ts", "ingest_date"]),
    )


def normalize_transactions(df: DataFrame, watermark_days: int = 7, strict: bool = True) -> DataFrame:
    """Text columns pass through as delivered ('' kept); six typed overrides.

    ``is_late`` is strict: exactly ``watermark_days`` after creation is on time.
    """
    f = Fields(df, strict)
    created, ingested = f.timestamp("created_at"), f.timestamp("ingest_ts")
    return df.select(
        "transaction_id", "booking_ref", "partner_id", "user_id",
        created.alias("created_at"),
        ingested.alias("ingest_ts"),
        f.decimal("amount").alias("amount"),
        F.upper("currency").alias("currency"),
        lower_clean("status").alias("status"),
        "payment_method", "gateway",
        f.integer("retry_count").alias("retry_count"),
        "error_code", "notes",
        f.integer("processing_ms").alias("processing_ms"),
        F.to_date(ingested).alias("ingest_date"),
        ((ingested - created) > F.make_dt_interval(F.lit(watermark_days))).alias("is_late"),
        *f.errors(["transaction_id", "partner_id", "created_at", "ingest_ts"]),
    ).select(*TXN_COLUMNS, *([] if strict else ["_errors"]))


def normalize_partners(df: DataFrame, strict: bool = True) -> DataFrame:
    """One superset schema over v1/v2/v3 (fields missing in a version are NULL)."""
    f = Fields(df, strict)
    return df.select(
        "partner_id",
        lower_clean("schema_version").alias("schema_version"),
        "name",
        upper_or_empty("country_code").alias("country_code"),
        lower_clean("status").alias("status"),
        lower_clean("tier").alias("tier"),
        f.decimal("commission_rate", 8, 6).alias("commission_rate"),
        f.timestamp("created_at").alias("created_at"),
        f.timestamp("updated_at").alias("updated_at"),
        f.integer("sla_hours").alias("sla_hours"),
        f.number("avg_rating").alias("avg_rating"),
        clean("api_endpoint").alias("api_endpoint"),
        f.boolean("webhook_enabled").alias("webhook_enabled"),
        *f.errors(["partner_id", "schema_version", "created_at"]),
        *([F.col("_seq")] if "_seq" in df.columns else []),
    )


def union_partner_versions(*feeds: DataFrame) -> DataFrame:
    """Separate per-version feeds -> one frame; absent columns become NULL."""
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def normalize_payments(df: DataFrame, strict: bool = True) -> DataFrame:
    f = Fields(df, strict)
    ts = f.timestamp("event_ts")
    return df.select(
        "event_id", "event_type", "transaction_id", "user_id", "partner_id",
        f.decimal("amount").alias("amount"),
        "currency",
        lower_clean("status").alias("status"),
        "gateway",
        ts.alias("event_ts"),
        f.integer("kafka_partition").alias("kafka_partition"),
        f.integer("kafka_offset", "bigint").alias("kafka_offset"),
        f.integer("processing_lag_ms", "bigint").alias("processing_lag_ms"),
        f.boolean("is_spike").alias("is_spike"),
        F.to_date(ts).alias("event_date"),
        *f.errors(["event_id"]),
    ).select(*PAYMENT_COLUMNS, *([] if strict else ["_errors"]))


def select_partner_columns(df: DataFrame, keep_order: bool = False) -> DataFrame:
    """The partner contract; ``keep_order`` carries the arrival order along."""
    return df.select(*PARTNER_COLUMNS, *[c for c in ("_errors",) if c in df.columns],
                     *(["_seq"] if keep_order and "_seq" in df.columns else []))
