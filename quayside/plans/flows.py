"""Curated frames built from the raw feeds: scan -> dedupe -> normalize -> split.

These are the batch building blocks shared by the registered queries, the
batch run and the bench. Everything is lazy; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.dedupe import (
    dedupe_events, dedupe_partners, dedupe_payments, dedupe_transactions,
)
from quayside.operators.normalize import (
    normalize_events, normalize_partners, normalize_payments, normalize_transactions,
    select_partner_columns,
)
from quayside.operators.splits import split_bots, split_quarantine
from quayside.sources import fixtures


def events_all(raw: DataFrame, strict: bool = True) -> DataFrame:
    return normalize_events(dedupe_events(raw), strict)


def transactions_all(raw: DataFrame, watermark_days: int = 7, strict: bool = True) -> DataFrame:
    return normalize_transactions(dedupe_transactions(raw), watermark_days, strict)


def partners_all(raw: DataFrame, keep_order: bool = False, strict: bool = True) -> DataFrame:
    return select_partner_columns(dedupe_partners(normalize_partners(raw, strict)), keep_order)


def payments_all(raw: DataFrame, strict: bool = True) -> DataFrame:
    return normalize_payments(dedupe_payments(raw, strict), strict)


class Feeds:
    """Lazy accessors for the curated frames of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, watermark_days: int = 7):
        self.spark, self.sf_dir, self.watermark_days = spark, sf_dir, watermark_days

    def raw(self, name: str) -> DataFrame:
        return fixtures.RAW_LOADERS[name](self.spark, self.sf_dir)

    def events_all(self) -> DataFrame:
        return events_all(self.raw("raw_events"))

    def events(self) -> DataFrame:
        return split_bots(self.events_all())[0]

    def bots(self) -> DataFrame:
        return split_bots(self.events_all())[1]

    def transactions_all(self) -> DataFrame:
        return transactions_all(self.raw("raw_transactions"), self.watermark_days)

    def transactions(self) -> DataFrame:
        return split_quarantine(self.transactions_all())[0]

    def quarantine(self) -> DataFrame:
        return split_quarantine(self.transactions_all())[1]

    def partners(self) -> DataFrame:
        return partners_all(self.raw("raw_partner_catalog"))

    def payments(self) -> DataFrame:
        return payments_all(self.raw("raw_payment_stream"))
