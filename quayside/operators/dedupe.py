"""Latest-record-wins deduplication.

Per key keep the row with the greatest order value; ties go to the later
arrival (``_seq``), or - when a feed carries no arrival number - to a total
order over all columns, so the result never depends on task scheduling.

``row_number() = 1`` is planned with ``WindowGroupLimit`` on both sides of the
shuffle: each map task keeps at most one row per key before the exchange, so a
key repeated millions of times (redelivery storms) ships one row per map task,
not all its copies.

That limit sorts the whole rows of a map task's input, which grows with the input's splits. A feed
of more rows than one task should sort goes by key first, in parts of a bounded number of
rows; only keys that crowd a part keep the limit before the shuffle (:func:`dedupe_in_parts`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

TASK_ROWS = 500_000  # about as many rows are sorted by one task
# Up to as many shuffle partitions (spark.shuffle.sort.bypassMergeThreshold) a task streams its rows to their files;
# beyond, it holds them. More of them only once a partition would get four times TASK_ROWS.
STREAMED_PARTS = 200
COUNTED_BUCKETS = 16_384


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dedupe_latest(df: DataFrame, keys, order, tiebreak: str | None = "_seq",
                  order_is_unique: bool = False) -> DataFrame:
    """``order_is_unique``: the order value never repeats (a Kafka
    (partition, offset) pair), so no tie-break columns are added to the sort."""
    keys = [_as_col(k) for k in (keys if isinstance(keys, (list, tuple)) else [keys])]
    order = [_as_col(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    if order_is_unique:
        ties = []
    elif tiebreak and tiebreak in df.columns:
        ties = [F.col(tiebreak).desc()]
    else:
        orderable = [f.name for f in df.schema.fields
                     if not isinstance(f.dataType, (MapType, ArrayType, StructType))]
        ties = [F.col(c).desc_nulls_last() for c in orderable]
    w = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order], *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_in_parts(df: DataFrame, key: str, order, order_is_unique: bool = False, task_rows: int = TASK_ROWS) -> DataFrame:
    """:func:`dedupe_latest` with a bounded number of rows a task, whatever the rows of ``df``.

    A first pass counts rows by buckets of the key (a table of ``COUNTED_BUCKETS`` numbers). It says how many
    parts the rows need, and which buckets hold a key so frequent that its copies are to be
    cut before they move."""
    bucket = F.pmod(F.xxhash64(key), F.lit(COUNTED_BUCKETS))
    full = F.when(F.col("count") > task_rows, F.struct("bucket", "count"))
    seen = df.groupBy(bucket.alias("bucket")).count().agg(F.sum("count").alias("rows"), F.collect_list(full).alias("full")).first()
    total = seen["rows"] or 0
    if total <= task_rows:
        return dedupe_latest(df, key, order, order_is_unique=order_is_unique)
    need = lambda rows: -(-total // rows)
    parts = max(min(need(task_rows), STREAMED_PARTS), need(4 * task_rows), df.sparkSession.sparkContext.defaultParallelism)
    crowded = [r["bucket"] for r in seen["full"] if r["count"] > 8 * total // COUNTED_BUCKETS]
    latest = lambda rows: dedupe_latest(rows, key, order, order_is_unique=order_is_unique)
    if not crowded:
        return latest(df.repartition(parts, key))
    frequent = bucket.isin(crowded)
    return latest(df.where(~frequent).repartition(parts, key)).union(latest(df.where(frequent)))


def dedupe_events(raw: DataFrame) -> DataFrame:
    return dedupe_in_parts(raw, "event_id", "ingest_date")


def dedupe_transactions(raw: DataFrame) -> DataFrame:
    return dedupe_in_parts(raw, "transaction_id", "ingest_ts")


def dedupe_partners(normalized: DataFrame) -> DataFrame:
    """Key (partner_id, version, updated_at); NULL updated_at is its own key value."""
    return dedupe_latest(normalized, ["partner_id", "schema_version", "updated_at"],
                         F.coalesce("updated_at", "created_at"))


def dedupe_payments(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Key event_id; the greatest (partition, offset) delivery wins. Lenient, one whose
    partition or offset is no number comes before all others."""
    number = lambda c, t: F.col(c).cast(t) if strict else F.col(c).try_cast(t)
    order = F.struct(number("kafka_partition", "int"), number("kafka_offset", "bigint"))
    return dedupe_in_parts(raw, "event_id", order, order_is_unique=True)
