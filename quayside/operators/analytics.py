"""The three serving queries, over DataFrames instead of a database.

Date ranges compare the raw timestamp with [start, end + 1 day) rather than
``to_date(ts) BETWEEN``: same rows, but the predicate stays a plain range that
Parquet statistics can skip row groups with.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REVENUE_STATUSES = ("confirmed", "completed")


def _as_date(value) -> _dt.date:
    return value if isinstance(value, _dt.date) else _dt.date.fromisoformat(str(value))


def check_range(start_date, end_date) -> tuple[_dt.date, _dt.date]:
    start, end = _as_date(start_date), _as_date(end_date)
    if end < start:
        raise ValueError("end_date must be on or after start_date")
    return start, end


def _ntz(day: _dt.date):
    """Midnight of ``day`` as a TIMESTAMP_NTZ literal (built from text, so no
    Python or session time zone is involved)."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def _ts_between(col: str, start: _dt.date, end: _dt.date):
    return (F.col(col) >= _ntz(start)) & (F.col(col) < _ntz(end + _dt.timedelta(days=1)))


def funnel(events: DataFrame, start_date, end_date, channel: str | None = None) -> DataFrame:
    """Events and distinct sessions by (channel, event_type) in a date range.

    The range compares the raw timestamp, so a lake scan skips row groups by
    their minimum and maximum event time; no partition is skipped by its ingest
    date, which nothing forces to follow the event.
    """
    start, end = check_range(start_date, end_date)
    rows = events.where(_ts_between("event_ts", start, end))
    if channel:
        rows = rows.where(F.col("channel") == F.lit(channel))
    return (rows.groupBy(F.coalesce("channel", F.lit("unknown")).alias("channel"), "event_type")
                .agg(F.count(F.lit(1)).alias("events"),
                     F.count_distinct("session_id").alias("sessions"))
                .orderBy("channel", "event_type"))


def _approved(col_status="status"):
    return F.col(col_status).isin(*REVENUE_STATUSES)


def partner_performance(transactions: DataFrame) -> DataFrame:
    """Per partner: transaction count, revenue and approved count."""
    return transactions.groupBy("partner_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum(F.when(_approved(), F.col("amount")).otherwise(F.lit(0)))
         .cast("decimal(38,2)").alias("revenue"),
        F.sum(F.when(_approved(), F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("approved_count"),
    )


def latest_partner_version(partners: DataFrame) -> DataFrame:
    """Per partner the profile with the latest coalesce(updated_at, created_at).

    Ties (unspecified in a LIMIT 1 lookup) are broken by schema_version, then
    created_at, both descending, so the answer is stable.
    """
    w = Window.partitionBy("partner_id").orderBy(
        F.coalesce("updated_at", "created_at").desc(), F.col("schema_version").desc(),
        F.col("created_at").desc())
    return partners.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def partner_profile(partners: DataFrame, partner_id: str) -> DataFrame:
    """Point lookup; an empty frame is the "not found" answer."""
    return latest_partner_version(partners.where(F.col("partner_id") == F.lit(partner_id)))


def partner_profile_performance(partners: DataFrame, transactions: DataFrame) -> DataFrame:
    """Latest profile of every partner with its performance; no transactions ->
    (0, NULL, NULL) like the single-partner SQL answer."""
    profile = latest_partner_version(partners)
    perf = partner_performance(transactions)
    joined = profile.join(perf, "partner_id", "left")
    return joined.withColumn("transaction_count", F.coalesce("transaction_count", F.lit(0)).cast("bigint"))


def transaction_summary(transactions: DataFrame, start_date, end_date,
                        partner_id: str | None = None, currency: str | None = None) -> DataFrame:
    """Count, total and average amount by (partner, currency, status).

    Money stays DECIMAL. The average is rounded half-up from exact cents:
    ``(2 * cents + n) div (2 * n)`` (amounts are >= 0 after quarantine), which
    avoids double rounding of a DECIMAL average.
    """
    start, end = check_range(start_date, end_date)
    if currency is not None and currency != "" and len(currency) != 3:
        raise ValueError("currency must have exactly 3 characters")
    rows = transactions.where(_ts_between("created_at", start, end))
    if partner_id:
        rows = rows.where(F.col("partner_id") == F.lit(partner_id))
    if currency:
        rows = rows.where(F.col("currency") == F.lit(currency.upper()))
    grouped = rows.groupBy("partner_id", "currency", "status").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("_total"),
        F.count("amount").alias("_n"))
    avg_cents = F.expr("(2 * _total * 100 + _n) div (2 * _n)")
    return (grouped.select(
                "partner_id", "currency", "status", "transaction_count",
                F.round("_total", 2).cast("decimal(38,2)").alias("total_amount"),
                F.when(F.col("_n") > 0, avg_cents / 100).cast("decimal(38,2)").alias("average_amount"))
            .orderBy("partner_id", "currency", "status"))
