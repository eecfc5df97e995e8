"""Input validation (the ingest contract) and the data-quality rules the feed
documentation states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.cleaning import FLOAT_PATTERN, clean

# Ingest contract.
MIN_EVENT_ID_LENGTH = 8
DEFAULT_DEVICE = "unknown"
DEFAULT_COUNTRY = "unknown"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _reason(cond, text):
    return F.when(cond, F.lit(text))


def validate_event_input(payloads: DataFrame) -> DataFrame:
    """Check API ingest payloads row by row.

    Output: the typed event columns, ``is_bot_flag`` forced false,
    ``rejection_reasons`` (';'-joined, '' when valid) and ``is_valid``.
    """
    ingest_ok = F.col("ingest_date").rlike(DATE_PATTERN) & F.try_to_date("ingest_date").isNotNull()
    price = F.col("price_usd")
    price_ok = price.isNull() | F.trim(price).rlike(FLOAT_PATTERN)
    reasons = F.concat_ws(";", F.array_compact(F.array(
        _reason(F.col("event_id").isNull() | (F.length("event_id") < MIN_EVENT_ID_LENGTH),
                "event_id_too_short"),
        _reason(F.col("event_type").isNull(), "event_type_missing"),
        _reason(F.col("session_id").isNull(), "session_id_missing"),
        _reason(F.col("event_ts").isNull(), "event_ts_missing"),
        _reason(F.col("ingest_date").isNull(), "ingest_date_missing"),
        _reason(F.col("ingest_date").isNotNull() & ~ingest_ok, "ingest_date_invalid"),
        _reason(~price_ok, "price_usd_invalid"),
    )))
    return payloads.select(
        "event_id", "event_type", "session_id", "user_id", "event_ts", "page", "partner_id",
        F.coalesce("device", F.lit(DEFAULT_DEVICE)).alias("device"),
        F.coalesce("country", F.lit(DEFAULT_COUNTRY)).alias("country"),
        "channel",
        F.when(price_ok, F.trim(price).cast("double")).alias("price_usd"),
        "metadata_json",
        F.lit(False).alias("is_bot_flag"),
        F.when(ingest_ok, F.try_to_date("ingest_date")).alias("ingest_date"),
        reasons.alias("rejection_reasons"),
        (reasons == "").alias("is_valid"),
        *([F.col("_seq")] if "_seq" in payloads.columns else []),
    )


def insert_ignore(target: DataFrame, batch: DataFrame, key: str = "event_id",
                  arrival: str = "_seq") -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` for a batch of rows.

    Returns one row per input row with ``accepted`` (first arrival of a key
    absent from the target) and ``idempotent`` (everything else).

    First arrival is ``min(arrival)`` per key - an aggregate, partial per map
    task, so a key re-sent millions of times costs one row per task - joined
    back to the batch (a skewed key there is split by AQE's skew join). The
    target contributes its distinct keys only.
    """
    first = batch.groupBy(key).agg(F.min(arrival).alias("_first"))
    existing = target.select(key).distinct().withColumn("_exists", F.lit(True))
    per_key = first.join(existing, key, "left")
    flagged = batch.join(per_key, key, "left")
    accepted = (F.col(arrival) == F.col("_first")) & F.col("_exists").isNull()
    return flagged.select(*batch.columns, accepted.alias("accepted"), (~accepted).alias("idempotent"))


def append_accepted(spark: SparkSession, root: str, batch: DataFrame, key: str = "event_id", arrival: str = "_seq",
                    partition_col: str = "ingest_date") -> DataFrame:
    """The ingest write: append the accepted rows of ``batch`` to the partitioned
    table at ``root`` and return every row's flags (as of before the write).

    The flags are staged first, so what is answered is what was written. A batch
    sent again finds its keys and appends nothing.
    """
    from quayside.sinks.lake_write import has_parquet, stage
    known = spark.read.parquet(root).select(key) if has_parquet(spark, root) else batch.select(key).limit(0)
    flagged = stage(insert_ignore(known, batch, key, arrival), "ingest")
    accepted = flagged.where("accepted").drop("accepted", "idempotent", arrival)
    (accepted.hint("rebalance", partition_col).write.mode("append").partitionBy(partition_col).parquet(root))
    return flagged


# ---- rules stated by the feed documentation ---------------------------------

def amount_outliers(transactions: DataFrame, limit: float = 20000.0) -> DataFrame:
    """Amount above ``limit``, or an approved transaction with amount <= 0."""
    approved = F.col("status").isin("confirmed", "completed")
    over = F.col("amount") > F.lit(limit)
    non_positive = approved & (F.col("amount") <= 0)
    return (transactions.where(over | non_positive)
            .withColumn("outlier_reason", F.when(over, F.lit("amount_above_limit"))
                        .otherwise(F.lit("approved_not_positive"))))


def retry_eligible(runs: DataFrame, max_attempts: int = 3) -> DataFrame:
    return runs.where((F.lower("status") == "failed") & (F.col("retry_attempt") < max_attempts))


def scheduled_success_sla(runs: DataFrame, target: float = 0.95) -> DataFrame:
    """Success share of scheduled runs (backfills excluded) per pipeline."""
    scheduled = runs.where(F.col("run_type") == "scheduled")
    return (scheduled.groupBy(F.col("pipeline_name").alias("pipeline"))
            .agg(F.count(F.lit(1)).alias("scheduled_runs"),
                 F.count_if(F.lower("status") == "success").alias("successful_runs"))
            .withColumn("success_rate", F.col("successful_runs") / F.col("scheduled_runs"))
            .withColumn("meets_sla", F.col("success_rate") >= F.lit(target)))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL reference is missing from the parent."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def unknown_version_quarantine(partners: DataFrame, known=("v1", "v2", "v3")) -> DataFrame:
    return (partners.where(~F.coalesce(F.col("schema_version").isin(*known), F.lit(False)))
            .withColumn("quarantine_reason", F.lit("unknown_schema_version")))


def json_fields(df: DataFrame, column: str, fields: dict) -> DataFrame:
    """Typed optional fields out of an open-schema JSON text column.

    ``fields`` maps output name -> (json path, SQL type). Missing keys, wrong
    types and non-JSON text give NULL, never an error.
    """
    parsed = F.try_parse_json(column)
    return df.withColumns({name: F.try_variant_get(parsed, path, typ)
                           for name, (path, typ) in fields.items()})


def json_object_drift(df: DataFrame, column: str) -> DataFrame:
    """Rows whose free-text column actually holds a JSON object."""
    parsed = F.try_parse_json(clean(column))
    return df.where(F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False)))


def offset_continuity(feed: DataFrame, partition_col: str = "kafka_partition",
                      offset_col: str = "kafka_offset") -> DataFrame:
    """Per Kafka partition: offset range, rows, distinct offsets, gaps and
    whether offsets form one strictly increasing run.

    Pure aggregation (partial per map task, then per partition) - no window
    that would put a whole partition in one task.
    """
    off = F.col(offset_col).cast("bigint")
    per = feed.groupBy(F.col(partition_col).cast("int").alias("kafka_partition")).agg(
        F.min(off).alias("min_offset"), F.max(off).alias("max_offset"),
        F.count(F.lit(1)).alias("rows"), F.count_distinct(off).alias("distinct_offsets"))
    gaps = F.col("max_offset") - F.col("min_offset") + 1 - F.col("distinct_offsets")
    return (per.withColumn("gaps", gaps)
               .withColumn("monotonic", (gaps == 0) & (F.col("rows") == F.col("distinct_offsets"))))


def offset_monotonic(feed: DataFrame, arrival: list[str], partition_col: str = "kafka_partition",
                     offset_col: str = "kafka_offset", slice_size: int = 1_000_000) -> DataFrame:
    """Per Kafka partition, whether its offsets rise in the order of arrival: rows, reversals (an offset below the
    one that arrived before it), repeats, the largest step back, the first offset that came too late.

    ``arrival``: columns that order the rows, such as those of :func:`quayside.sources.lake_scan.in_arrival_order`.
    Where the last is a whole number, such as a position in a file, slices are cut at its multiples of ``slice_size``.
    Rows without an offset are not compared.
    """
    from quayside.operators.sequence import previous_value
    rows = feed.select(F.col(partition_col).cast("int").alias("kafka_partition"), F.col(offset_col).cast("bigint").alias("o"), *arrival)
    slices = []
    if dict(rows.dtypes)[arrival[-1]] in ("int", "bigint"):
        rows, slices = rows.withColumn("_nth", F.floor(F.col(arrival[-1]) / slice_size)), [*arrival[:-1], "_nth"]
    pairs = previous_value(rows.where("o is not null"), ["kafka_partition"], arrival, "o", "before", slices)
    back = F.col("o") < F.col("before")
    first = F.min(F.when(back, F.struct(*arrival, "o")))
    return pairs.groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(back).alias("reversals"),
        F.count_if(F.col("o") == F.col("before")).alias("repeats"),
        F.coalesce(F.max(F.when(back, F.col("before") - F.col("o"))), F.lit(0)).cast("bigint").alias("largest_step_back"),
        first["o"].alias("first_reversed_offset")).withColumn("monotonic", (F.col("reversals") == 0) & (F.col("repeats") == 0))


def out_of_order(feed: DataFrame, partition_col: str = "kafka_partition",
                 offset_col: str = "kafka_offset", ts_col: str = "event_ts",
                 slice_size: int = 1_000_000) -> DataFrame:
    """Rows whose event time is below the max event time of every earlier
    offset in their partition."""
    from quayside.operators.sequence import running_max_before
    rows = feed.withColumn("_p", F.col(partition_col).cast("int")).withColumn(
        "_o", F.col(offset_col).cast("bigint"))
    marked = running_max_before(rows, "_p", "_o", ts_col, "previous_max_ts", slice_size)
    return marked.where(F.col(ts_col) < F.col("previous_max_ts")).drop("_p", "_o")


def booking_reconciliation(events: DataFrame, transactions: DataFrame,
                           booking_event: str = "booking_confirm") -> DataFrame:
    """Booking confirmations vs transactions per (partner, user, day).

    Both sides are counted per key first, so the full outer join matches one
    row per key and side - never all pairs of a busy key.
    """
    keys = ["partner_id", "user_id", "day"]
    b = (events.where(F.col("event_type") == booking_event)
         .select("partner_id", "user_id", F.to_date("event_ts").alias("day"))
         .groupBy(*keys).agg(F.count(F.lit(1)).alias("bookings")))
    t = (transactions.select("partner_id", F.nullif(F.col("user_id"), F.lit("")).alias("user_id"),
                             F.to_date("created_at").alias("day"))
         .groupBy(*keys).agg(F.count(F.lit(1)).alias("transactions")))
    j = b.join(t, [b[k].eqNullSafe(t[k]) for k in keys], "full_outer").select(
        *[F.coalesce(b[k], t[k]).alias(k) for k in keys],
        F.coalesce("bookings", F.lit(0)).alias("bookings"),
        F.coalesce("transactions", F.lit(0)).alias("transactions"))
    status = (F.when(F.col("bookings") == F.col("transactions"), F.lit("matched"))
              .when(F.col("bookings") > F.col("transactions"), F.lit("missing_transaction"))
              .otherwise(F.lit("missing_booking")))
    return j.withColumn("status", status)


def _hmac_pads(key: bytes, block: int = 64):
    import hashlib
    if len(key) > block:
        key = hashlib.sha256(key).digest()
    key = key.ljust(block, b"\x00")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256_hex(column, key: bytes):
    """HMAC-SHA256(key, column) as hex, from two ``sha2`` calls (RFC 2104) -
    JVM-side, no Python UDF. The key is given at run time."""
    ipad, opad = _hmac_pads(key)
    msg = F.encode(F.col(column) if isinstance(column, str) else column, "UTF-8")
    inner = F.unhex(F.sha2(F.concat(F.lit(ipad), msg), 256))
    return F.sha2(F.concat(F.lit(opad), inner), 256)


def user_id_token(df: DataFrame, key: bytes, column: str = "user_id") -> DataFrame:
    """Replace ``user_id`` by its keyed hash before data reaches curated."""
    cleaned = clean(column)
    return df.withColumn(column, F.when(cleaned.isNotNull(), hmac_sha256_hex(cleaned, key)))


def freshness(transactions: DataFrame, target_minutes: float = 60.0) -> DataFrame:
    """Nearest-rank p95 of ingest lag (minutes) against the freshness target.

    Lags are counted by whole second first; the rank is found in the counts, a
    table as long as the spread of the lags, not as the feed.
    """
    from quayside.functions.time import seconds_between
    counts = transactions.select(F.floor(seconds_between("created_at", "ingest_ts")).alias("s")).groupBy("s").agg(
        F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = counts.where("s is not null").withColumn("upto", F.sum("n").over(upto)).withColumn(
        "total", F.sum("n").over(Window.partitionBy()))
    rank = known.where(F.col("upto") >= F.ceil(F.col("total") * F.lit(0.95))).agg(F.min("s").alias("p95"))
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return rows.crossJoin(rank).select(  # one row each
        "rows", (F.col("p95") / 60).cast("double").alias("p95_lag_minutes"),
        (F.col("p95") / 60 < F.lit(target_minutes)).alias("meets_target"))
