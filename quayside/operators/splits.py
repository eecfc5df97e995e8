"""Row routing: bots vs good events, quarantine vs good transactions.

Both sides of each split are complementary predicates over one cached input,
so every input row lands in exactly one output (NULL flags included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUARANTINE_NEGATIVE = "negative_amount"


def split_bots(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bots): true -> bots; false or NULL -> good."""
    flag = F.coalesce(F.col("is_bot_flag"), F.lit(False))
    return events.where(~flag), events.where(flag)


def good_events(events: DataFrame) -> DataFrame:
    return split_bots(events)[0]


def bot_events(events: DataFrame) -> DataFrame:
    return split_bots(events)[1]


def split_quarantine(txns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): amount < 0 is quarantined; NULL and 0 stay good."""
    negative = F.coalesce(F.col("amount") < 0, F.lit(False))
    good = txns.where(~negative)
    rejected = txns.where(negative).withColumn("quarantine_reason", F.lit(QUARANTINE_NEGATIVE))
    return good, rejected


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) of a lenient projection by its ``_errors``; the good side has them dropped."""
    wrong = F.size("_errors") > 0
    return rows.where(~wrong).drop("_errors"), rows.where(wrong)


def as_invalid(rows: DataFrame, feed: str, keys) -> DataFrame:
    """Rows of a lenient projection in the form of the quarantine of invalid records: the feed, the
    key as text, the reasons and the record as typed, as JSON (its invalid values stand in the reasons)."""
    columns = [c for c in rows.columns if c not in ("_errors", "_seq")]
    key = F.array_join(F.array(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), "|")
    return rows.select(F.lit(feed).alias("feed"), key.alias("record_key"), F.col("_errors").alias("reasons"),
                       F.to_json(F.struct(*columns)).alias("record"))
