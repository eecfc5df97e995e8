"""Batch run: full refresh or incremental window into the lake, marks last.

Tables under ``lake_root`` (each a chain of snapshots, see :mod:`quayside.sinks.lake_table`)::

    events                   good events            key event_id
    events_bots              bot events             key event_id
    transactions             good transactions      key transaction_id
    quarantine/transactions  negative amounts       key transaction_id
    payments                 payments               key event_id, greatest (partition, offset)
    partners                 partner versions of this run
    quarantine/partners      partner versions whose schema version isn't known
    quarantine/invalid       records that don't parse, with reasons (lenient runs)
    serving/partners         partners merged on (partner_id, schema_version, created_at)
    _state/control           committed marks, one row per run

The events/transactions lake tables are also the serving snapshots (same key,
same rows); partners need their own snapshot because their serving key differs
from the dedupe key.

Incremental runs re-read ``[mark - N days, ...]`` (transactions from midnight)
and only new payment offsets, and merge the batch into each table: a key that moved
partition or changed side (bot <-> good, quarantined <-> good, invalid <-> valid) ends up in
exactly one place, holding its latest row. Every table changes by one atomic commit, which
its contract can refuse; the reported counts are what the commits observed, compared with
what was staged. Marks are committed after every table, so a failed run is simply re-run.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.contracts import KEYS, PARTNER_COLUMNS, SCHEMAS
from quayside.operators.filters import filter_new_offsets, filter_since, window_start
from quayside.operators.marks import max_offset_by_partition
from quayside.operators.quality import unknown_version_quarantine, user_id_token
from quayside.operators.splits import as_invalid, split_errors
from quayside.plans import flows
from quayside.sinks.lake_table import LakeTable
from quayside.sinks.lake_write import commit_control, read_control, stage, unstage

#: The partner schema versions that are no case for the quarantine.
KNOWN_VERSIONS = ("v1", "v2", "v3")


def output_counts(outputs: dict[str, DataFrame]) -> DataFrame:
    """(output, rows) per named frame; each count is a partial aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("output"), "rows")
             for name, df in outputs.items()]
    return reduce(DataFrame.unionByName, parts)


def _bot():
    return F.coalesce(F.col("is_bot_flag"), F.lit(False))


def _negative():
    return F.coalesce(F.col("amount") < 0, F.lit(False))


def _write(table: LakeTable, rows: DataFrame, keep, full: bool, order=None) -> int:
    """Full refresh: a new snapshot of the kept rows. Incremental: merge all rows of the batch,
    kept or not, so that a key that switched side leaves this table. Returns the batch's
    kept rows as the commit has them; fails if those aren't the staged ones."""
    staged = rows.where(keep).count()
    done = table.replace(rows.where(keep)) if full or not table.exists() else table.merge(rows, order, keep)
    if done["batch_rows"] + done["rejected"] != staged:
        raise RuntimeError(f"{table.root}: {staged} rows staged, {done['batch_rows']} written, {done['rejected']} rejected")
    return done["batch_rows"]


def run_batch(spark: SparkSession, raw: dict[str, DataFrame], lake_root: str, watermark_days: int = 7,
              full_refresh: bool = False, run_id: int | None = None, strict: bool = True,
              token_key: bytes | None = None) -> DataFrame:
    """One run over the raw feeds; returns a one-row metrics frame.

    ``raw`` holds the frames ``raw_events``, ``raw_transactions``,
    ``raw_partner_catalog`` and ``raw_payment_stream`` (e.g. from
    :func:`quayside.sources.csv_feed.scan_csv` or the fixture adapters).

    ``strict``: a value that doesn't parse ends the run. Lenient: its record goes to
    ``quarantine/invalid`` with its reasons, until a later delivery of its key is valid; an
    earlier valid row of the key stays. ``token_key``: user ids reach the lake only as keyed
    hashes. Partner versions outside ``KNOWN_VERSIONS`` are quarantined; a strict run
    serves them too.
    """
    root = lake_root.rstrip("/")
    state = f"{root}/_state"
    control = read_control(spark, state)
    full = full_refresh or not control

    event_start = None if full else window_start(control.get("events"), watermark_days)
    txn_start = None if full else window_start(control.get("transactions"), watermark_days)
    if txn_start is not None:
        txn_start = _dt.datetime.combine(txn_start.date(), _dt.time())  # whole first day
    saved = None
    if not full and control.get("payment_offsets"):
        saved = spark.createDataFrame(
            [(int(p), int(o)) for p, o in control["payment_offsets"].items()],
            "kafka_partition int, kafka_offset bigint")

    ev_batch = _since(raw["raw_events"], "ingest_date",
                      event_start.date() if isinstance(event_start, _dt.datetime) else event_start, strict)
    tx_batch = _since(raw["raw_transactions"], "ingest_ts", txn_start, strict)
    pm_batch = filter_new_offsets(raw["raw_payment_stream"], saved, strict=strict)

    # Each is read several times below: written once to the shared folder, where a
    # lost executor takes nothing with it and a full refresh fits whatever its size.
    token = (lambda df: user_id_token(df, token_key)) if token_key else (lambda df: df)
    frames = {
        "events": stage(token(flows.events_all(ev_batch, strict)), "batch-events"),
        "transactions": stage(token(flows.transactions_all(tx_batch, watermark_days, strict)), "batch-transactions"),
        "partners": stage(flows.partners_all(raw["raw_partner_catalog"], True, strict), "batch-partners"),
        "payments": stage(token(flows.payments_all(pm_batch, strict)), "batch-payments"),
    }
    good = dict(frames) if strict else {name: split_errors(df)[0] for name, df in frames.items()}
    events, txns, payments = good["events"], good["transactions"], good["payments"]
    is_bot = F.coalesce(F.col("is_bot_flag"), F.lit(False))
    negative = F.coalesce(F.col("amount") < 0, F.lit(False))
    known = F.coalesce(F.col("schema_version").isin(*KNOWN_VERSIONS), F.lit(False))
    table = lambda path, dataset: LakeTable.of(spark, f"{root}/{path}", dataset)

    counts = {"events": _write(table("events", "events"), events, ~is_bot, full),
              "bots": _write(table("events_bots", "events_bots"), events, is_bot, full),
              "transactions": _write(table("transactions", "transactions"), txns, ~negative, full)}
    reasoned = txns.withColumn("quarantine_reason", F.when(negative, F.lit("negative_amount")))
    counts["rejected_transactions"] = _write(
        table("quarantine/transactions", "quarantine_transactions"), reasoned, negative, full)
    order = [F.col("kafka_partition"), F.col("kafka_offset")]
    counts["payments"] = _write(table("payments", "payments"), payments, F.lit(True), full, order)

    # A strict run serves every version, as the source does, and lists the unknown ones in the quarantine besides; a
    # lenient one serves the known ones. A record without a version has no serving key.
    partners = good["partners"].where(F.col("schema_version").isNotNull() if strict else known)
    versions = LakeTable(spark, f"{root}/partners", SCHEMAS["partners"])  # a key may recur under another updated_at
    counts["partners"] = versions.replace(partners.select(*PARTNER_COLUMNS))["batch_rows"]
    LakeTable(spark, f"{root}/quarantine/partners", SCHEMAS["quarantine_partners"]).replace(
        unknown_version_quarantine(good["partners"].select(*PARTNER_COLUMNS), KNOWN_VERSIONS))
    serving = table("serving/partners", "partners")
    if full:
        serving.replace(_one_per_key(partners))
    else:
        serving.merge(partners)
    counts["invalid_records"] = 0
    if not strict:
        keys = {"events": KEYS["events"], "transactions": KEYS["transactions"], "payments": KEYS["payments"],
                "partners": ("partner_id", "schema_version", "created_at", "updated_at")}
        records = stage(_one_per_record(reduce(DataFrame.unionByName, [
            as_invalid(df, name, keys[name]) for name, df in frames.items()])), "batch-invalid")
        counts["invalid_records"] = _write(table("quarantine/invalid", "invalid"), records, F.size("reasons") > 0, full)
        unstage(records)

    # Marks come from every raw row (not just the window); collected values are
    # one date, one timestamp and one offset per Kafka partition.
    ev_mark = raw["raw_events"].agg(F.max(_typed(raw["raw_events"], "ingest_date", "date", strict))).first()[0]
    tx_mark = raw["raw_transactions"].agg(F.max(_typed(raw["raw_transactions"], "ingest_ts", "timestamp_ntz", strict))).first()[0]
    offsets = {str(r["kafka_partition"]): int(r["kafka_offset"])
               for r in max_offset_by_partition(raw["raw_payment_stream"], saved, strict=strict).collect()}
    marks = dict(control)
    if ev_mark is not None:
        marks["events"] = str(ev_mark)
    if tx_mark is not None:
        marks["transactions"] = str(tx_mark)
    marks["payment_offsets"] = offsets
    run_id = run_id if run_id is not None else int(control.get("run_id", 0)) + 1
    marks["run_id"] = run_id
    commit_control(spark, state, marks, run_id)
    unstage(*frames.values())
    row = dict(counts, mode="full" if full else "incremental",
               event_window_start=str(event_start) if event_start else None,
               transaction_window_start=str(txn_start) if txn_start else None)
    return spark.createDataFrame(
        [row], "events long, bots long, transactions long, rejected_transactions long, partners long, payments long, "
               "invalid_records long, mode string, event_window_start string, transaction_window_start string")


def _typed(raw: DataFrame, column: str, kind: str, strict: bool):
    c = F.col(column)
    return c if strict or dict(raw.dtypes)[column] != "string" else c.try_cast(kind)


def _since(raw: DataFrame, column: str, start, strict: bool) -> DataFrame:
    """:func:`filter_since`; lenient, what is no date is kept, for the quarantine."""
    if strict or start is None or dict(raw.dtypes)[column] != "string":
        return filter_since(raw, column, start)
    kind = "timestamp_ntz" if isinstance(start, _dt.datetime) else "date"
    typed = raw.withColumn("_since", F.col(column).try_cast(kind))
    return filter_since(typed.withColumn("_since", F.coalesce("_since", F.lit(str(start)).cast(kind))), "_since", start).drop("_since")


def _one_per_key(partners: DataFrame) -> DataFrame:
    from quayside.sinks.lake_write import upsert_keyed
    return upsert_keyed(None, partners, KEYS["partners"])


def _one_per_record(records: DataFrame) -> DataFrame:
    """Per (feed, key) an invalid record, if there is any: keys that are missing themselves share one."""
    best = F.max_by(F.struct("reasons", "record"), F.struct(F.size("reasons").alias("n"), F.col("record")))
    return records.groupBy("feed", "record_key").agg(best.alias("b")).select("feed", "record_key", "b.reasons", "b.record")
