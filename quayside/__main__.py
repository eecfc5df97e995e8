"""Command line: ``python -m quayside run ...`` and ``python -m quayside compact ...``.

``run`` reads the four raw CSV feeds from a directory (raw_events.csv,
raw_transactions.csv, raw_partner_catalog.csv, raw_payment_stream.csv), runs a
full or incremental batch into the lake and prints the run metrics as JSON.
``compact`` lists small-file partitions of a table and, with ``--apply``,
compacts them.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import RAW_EVENT_FIELDS, RAW_PARTNER_FIELDS, RAW_PAYMENT_FIELDS, RAW_TXN_FIELDS
from quayside.sources.csv_feed import scan_csv

FEEDS = {
    "raw_events": RAW_EVENT_FIELDS,
    "raw_transactions": RAW_TXN_FIELDS,
    "raw_partner_catalog": RAW_PARTNER_FIELDS,
    "raw_payment_stream": RAW_PAYMENT_FIELDS,
}


def read_feed(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV feed plus ``_seq``: the row's position in the file (splits of one
    file are numbered in offset order), so "the later row wins" ties follow
    input order as in the source."""
    return scan_csv(spark, path, columns).withColumn("_seq", F.monotonically_increasing_id())


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="quayside")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--watermark-days", type=int, default=7)
    run.add_argument("--full-refresh", action="store_true")
    run.add_argument("--lenient", action="store_true", help="quarantine records that don't parse instead of failing")
    compact = sub.add_parser("compact")
    compact.add_argument("root")
    compact.add_argument("--threshold-mb", type=int, default=128)
    compact.add_argument("--apply", action="store_true")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"quayside-{args.command}").getOrCreate()
    if args.command == "run":
        from quayside.plans.batch_run import run_batch
        raw = {name: read_feed(spark, f"{args.input.rstrip('/')}/{name}.csv", cols)
               for name, cols in FEEDS.items()}
        if not args.lenient:  # lenient runs take text, so that what doesn't parse stays visible
            raw["raw_events"] = raw["raw_events"].withColumn("ingest_date", F.to_date("ingest_date"))
            raw["raw_transactions"] = raw["raw_transactions"].withColumn(
                "ingest_ts", F.col("ingest_ts").cast("timestamp_ntz"))
        metrics = run_batch(spark, raw, args.output, args.watermark_days, args.full_refresh, strict=not args.lenient)
        print(json.dumps(metrics.collect()[0].asDict(), indent=2))
    else:
        for row in compact_root(spark, args.root, args.threshold_mb, args.apply):
            print(json.dumps(row))


def compact_root(spark: SparkSession, root: str, threshold_mb: int, apply: bool) -> list[dict]:
    """A table of snapshots by a commit, a plain directory of partitions by swapping directories."""
    from quayside.operators.maintenance import compact_partitions
    from quayside.sinks.lake_table import LakeTable
    from quayside.sinks.lake_write import path_exists
    if path_exists(spark, f"{root.rstrip('/')}/snapshots"):
        return LakeTable.opened(spark, root).compact(threshold_mb, threshold_mb, apply)
    return [r.asDict() for r in compact_partitions(spark, root, threshold_mb, threshold_mb, apply=apply).collect()]


if __name__ == "__main__":
    main()
