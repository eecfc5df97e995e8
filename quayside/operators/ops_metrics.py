"""Operational metrics and alert rules over run logs, the payment feed, the
lake file inventory and request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Alert thresholds, severities and summaries.
FAILURE_RATE_THRESHOLD = 0.15
DURATION_THRESHOLD_SEC = 7200
STREAM_LAG_THRESHOLD_SEC = 300
SMALL_FILE_COUNT = 20
SMALL_FILE_BYTES = 134217728
ALERT_LABELS = {
    "PipelineFailureRateHigh": ("critical", "Pipeline failure rate is above 15%"),
    "PipelineDurationHigh": ("critical", "Pipeline execution exceeded two hours"),
    "StreamingLagHigh": ("warning", "Payment stream lag is above five minutes"),
    "SmallFilesPerPartitionHigh": ("warning", "Partition contains too many small files"),
}


def run_status_counts(runs: DataFrame) -> DataFrame:
    return (runs.groupBy(F.col("pipeline_name").alias("pipeline"), F.lower("status").alias("status"))
                .agg(F.count(F.lit(1)).alias("runs")))


def run_max_duration(runs: DataFrame) -> DataFrame:
    return (runs.groupBy(F.col("pipeline_name").alias("pipeline"))
                .agg(F.greatest(F.max(F.col("duration_sec").cast("double")), F.lit(0.0))
                      .alias("max_duration_sec")))


def max_stream_lag(payments_raw: DataFrame) -> DataFrame:
    """Max processing lag in seconds over rows that report one; 0 if none."""
    lag = F.when(F.col("processing_lag_ms") != "", F.col("processing_lag_ms").cast("double") / 1000)
    return payments_raw.agg(F.coalesce(F.max(lag), F.lit(0.0)).alias("max_lag_sec"))


def _labels(name: str):
    severity, summary = ALERT_LABELS[name]
    return F.lit(name).alias("alert"), F.lit(severity).alias("severity"), F.lit(summary).alias("summary")


def alert_failure_rate(runs: DataFrame) -> DataFrame:
    counts = run_status_counts(runs)
    rate = counts.agg(
        (F.sum(F.when(F.col("status").isin("failed", "timeout"), F.col("runs")).otherwise(0))
         / F.sum("runs")).alias("value"))
    return rate.select(*_labels("PipelineFailureRateHigh"), F.lit(None).cast("string").alias("series"),
                       "value", (F.col("value") > FAILURE_RATE_THRESHOLD).alias("firing"))


def alert_duration(runs: DataFrame) -> DataFrame:
    return run_max_duration(runs).select(
        *_labels("PipelineDurationHigh"), F.col("pipeline").alias("series"),
        F.col("max_duration_sec").alias("value"),
        (F.col("max_duration_sec") > DURATION_THRESHOLD_SEC).alias("firing"))


def alert_stream_lag(payments_raw: DataFrame) -> DataFrame:
    return max_stream_lag(payments_raw).select(
        *_labels("StreamingLagHigh"), F.lit(None).cast("string").alias("series"),
        F.col("max_lag_sec").alias("value"), (F.col("max_lag_sec") > STREAM_LAG_THRESHOLD_SEC).alias("firing"))


def alert_small_files(file_stats: DataFrame) -> DataFrame:
    """``file_stats`` from :func:`quayside.operators.maintenance.partition_file_stats`."""
    firing = ((F.col("file_count") > SMALL_FILE_COUNT)
              | ((F.col("average_bytes") < SMALL_FILE_BYTES) & (F.col("file_count") > 1)))
    return file_stats.select(
        *_labels("SmallFilesPerPartitionHigh"),
        F.concat_ws("/", "dataset", "partition").alias("series"),
        F.col("file_count").cast("double").alias("value"), firing.alias("firing"))


def alerts(*evaluations: DataFrame) -> DataFrame:
    """Union of evaluated rules, keeping the ones that fire."""
    out = evaluations[0]
    for e in evaluations[1:]:
        out = out.unionByName(e)
    return out.where("firing").drop("firing")


def latency_summary(requests: DataFrame, group_cols=()) -> DataFrame:
    """Requests, errors (status >= 400), median and nearest-rank p95 latency.

    Exact percentiles keep a value -> count map per group: its size is bounded
    by the number of distinct latency values (ms resolution), not by rows.
    """
    return requests.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status_code") >= 400).alias("errors"),
        F.percentile(F.col("latency_ms").cast("double"), F.lit(0.5)).cast("double").alias("p50_ms"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms)").cast("double").alias("p95_ms"))


def request_rates(requests: DataFrame, every: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """Per time bucket: request count and rate, 5xx percentage and p95."""
    w = F.window("request_ts", every)
    return (requests.groupBy(w.start.alias("window_start"))
            .agg(F.count(F.lit(1)).alias("requests"),
                 (F.count(F.lit(1)) / F.lit(float(seconds))).alias("rate_per_sec"),
                 (F.lit(100.0) * F.count_if(F.col("status_code") >= 500) / F.count(F.lit(1)))
                 .alias("error_5xx_pct"),
                 F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms)").cast("double")
                 .alias("p95_ms")))
