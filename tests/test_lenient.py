"""A batch run over feeds with invalid values, unknown partner versions and user ids."""

import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from quayside.contracts import RAW_EVENT_FIELDS, RAW_PARTNER_FIELDS, RAW_PAYMENT_FIELDS, RAW_TXN_FIELDS
from quayside.plans.batch_run import run_batch
from quayside.sinks.lake_table import read_lake


def feed(spark, columns, *rows):
    """Text rows given by their set fields."""
    return spark.createDataFrame([(k, *[r.get(c, "") for c in columns]) for k, r in enumerate(rows)],
                                 "_seq long, " + ", ".join(f"{c} string" for c in columns))


def event(key, **more):
    return dict(event_id=key, event_type="View", session_id="s", user_id="u1", event_ts="2025-03-01 10:00:00",
                ingest_date="2025-03-01", price_usd="1.5", is_bot_flag="no") | more


def txn(key, **more):
    return dict(transaction_id=key, partner_id="P1", user_id="u1", created_at="2025-03-01 10:00:00",
                ingest_ts="2025-03-01 11:00:00", amount="10.00", retry_count="0") | more


def partner(key, version="v1", **more):
    return dict(partner_id=key, schema_version=version, created_at="2025-01-01 00:00:00", commission_rate="0.1") | more


def payment(key, offset, **more):
    return dict(event_id=key, kafka_partition="0", kafka_offset=offset, event_ts="2025-03-01 10:00:00", amount="1.00", user_id="u1") | more


def feeds(spark, events, txns, partners, payments):
    return {"raw_events": feed(spark, RAW_EVENT_FIELDS, *events), "raw_transactions": feed(spark, RAW_TXN_FIELDS, *txns),
            "raw_partner_catalog": feed(spark, RAW_PARTNER_FIELDS, *partners), "raw_payment_stream": feed(spark, RAW_PAYMENT_FIELDS, *payments)}


def keys(df, key):
    return sorted(r[0] for r in df.select(key).collect())


def test_invalid_records_go_to_quarantine_until_they_are_right(spark, scratch):
    root = scratch("lenient")
    first = feeds(spark,
                  [event("e1"), event("e2", is_bot_flag="maybe"), event("e3", event_ts="2024"), event("e4", ingest_date="soon"), event("e5", is_bot_flag="yes")],
                  [txn("t1"), txn("t2", amount="abc", retry_count="1.0"), txn("t3", amount="-5"), txn("t4", ingest_ts="2025-03-01T10:00:00+03:00")],
                  [partner("P1"), partner("P2", commission_rate="x"), partner("P3", "v9")],
                  [payment("p1", "0"), payment("p2", "one"), payment("p3", "2", event_ts="")])
    m = run_batch(spark, first, root, strict=False).first()
    assert (m.events, m.bots, m.transactions, m.rejected_transactions, m.partners, m.payments, m.invalid_records) == (1, 1, 1, 1, 1, 2, 7)
    invalid = {(r.feed, r.record_key): sorted((x["column"], x["rule"], x["text"]) for x in r.reasons)
               for r in read_lake(spark, f"{root}/quarantine/invalid", "invalid").collect()}
    assert invalid == {
        ("events", "e2"): [("is_bot_flag", "boolean", "maybe")],
        ("events", "e3"): [("event_ts", "timestamp", "2024")],
        ("events", "e4"): [("ingest_date", "date", "soon")],
        ("transactions", "t2"): [("amount", "number", "abc"), ("retry_count", "integer", "1.0")],
        ("transactions", "t4"): [("ingest_ts", "timestamp", "2025-03-01T10:00:00+03:00")],
        ("partners", "P2|v1|2025-01-01 00:00:00|"): [("commission_rate", "number", "x")],
        ("payments", "p2"): [("kafka_offset", "integer", "one")]}
    record = read_lake(spark, f"{root}/quarantine/invalid", "invalid").where("record_key = 't2'").first().record
    assert json.loads(record)["transaction_id"] == "t2" and "amount" not in json.loads(record)
    pay = {r.event_id: r.event_date for r in read_lake(spark, f"{root}/payments", "payments").collect()}
    assert pay == {"p1": dt.date(2025, 3, 1), "p3": None}  # a payment without a time stays, here in a full run
    assert keys(read_lake(spark, f"{root}/quarantine/partners", "quarantine_partners"), "partner_id") == ["P3"]
    assert keys(read_lake(spark, f"{root}/serving/partners", "partners"), "partner_id") == ["P1"]

    second = feeds(spark,
                   [event("e1", page="/new"), event("e2"), event("e3", event_ts="2024"), event("e6", price_usd="1d", ingest_date="2025-03-02")],
                   [txn("t1", amount="bad", ingest_ts="2025-03-02 00:00:00"), txn("t2"), txn("t3", amount="5")],
                   [partner("P1"), partner("P2")], [payment("p2", "3"), payment("p4", "4", event_ts="")])
    m = run_batch(spark, second, root, strict=False).first()
    assert m.mode == "incremental" and m.invalid_records == 3 and m.payments == 2
    left = {(r.feed, r.record_key) for r in read_lake(spark, f"{root}/quarantine/invalid", "invalid").collect()}
    assert left == {("events", "e3"), ("events", "e4"), ("events", "e6"), ("transactions", "t1"), ("transactions", "t4")}
    events = {r.event_id: r.page for r in read_lake(spark, f"{root}/events", "events").collect()}
    assert events == {"e1": "/new", "e2": None}
    txns = {r.transaction_id: float(r.amount) for r in read_lake(spark, f"{root}/transactions", "transactions").collect()}
    assert txns == {"t1": 10.0, "t2": 10.0, "t3": 5.0}  # the last valid t1 stays
    assert keys(read_lake(spark, f"{root}/payments", "payments"), "event_id") == ["p1", "p2", "p3", "p4"]
    assert keys(read_lake(spark, f"{root}/serving/partners", "partners"), "partner_id") == ["P1", "P2"]


def typed(raw):
    return raw | {"raw_events": raw["raw_events"].withColumn("ingest_date", F.to_date("ingest_date")),
                  "raw_transactions": raw["raw_transactions"].withColumn("ingest_ts", F.col("ingest_ts").cast("timestamp_ntz"))}


def test_a_strict_run_fails_on_the_same_value_and_on_a_missing_key(spark, scratch):
    good = ([event("e1")], [txn("t1")], [partner("P1")], [payment("p1", "0")])
    root = scratch("strict")
    run_batch(spark, typed(feeds(spark, *good)), root).collect()
    bad = feeds(spark, [event("e1", page="/x")], [txn("t1", amount="abc")], [partner("P1")], [payment("p1", "1")])
    with pytest.raises(Exception, match="invalid number"):
        run_batch(spark, typed(bad), root)
    keyless = typed(feeds(spark, *good))
    keyless["raw_payment_stream"] = keyless["raw_payment_stream"].withColumns({"event_id": F.lit(None).cast("string"), "kafka_offset": F.lit("5")})
    with pytest.raises(ValueError, match="null_event_id"):
        run_batch(spark, keyless, root)
    assert keys(read_lake(spark, f"{root}/payments", "payments"), "event_id") == ["p1"]


def test_user_ids_reach_the_lake_as_keyed_hashes(spark, scratch):
    root, key = scratch("tokens"), b"k" * 70
    raw = feeds(spark, [event("e1"), event("e2", user_id="")], [txn("t1")], [partner("P1")], [payment("p1", "0")])
    run_batch(spark, typed(raw), root, token_key=key).collect()
    want = hmac.new(key, b"u1", hashlib.sha256).hexdigest()
    assert {r.event_id: r.user_id for r in read_lake(spark, f"{root}/events", "events").collect()} == {"e1": want, "e2": None}
    assert read_lake(spark, f"{root}/transactions", "transactions").first().user_id == want == read_lake(
        spark, f"{root}/payments", "payments").first().user_id


def test_row_groups_stay_within_their_bounds(spark, scratch):
    """From the footers of what the sink wrote: rows per file and bytes per row group."""
    import pyarrow.parquet as pq

    from quayside.sinks.lake_write import ROW_GROUP_BYTES, sink_partitioned
    path = scratch("groups")
    rows = spark.range(300_000, numPartitions=1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("2025-03-01").cast("date").alias("d"))
    sink_partitioned(rows, path, "d")
    files = [f.replace("file://", "") for f in spark.read.parquet(path).inputFiles()]
    footers = [pq.ParquetFile(f).metadata for f in files]
    assert sorted(m.num_rows for m in footers) == [50_000, 250_000]
    assert all(m.row_group(k).total_byte_size <= ROW_GROUP_BYTES for m in footers for k in range(m.num_row_groups))
    sizes = [m.row_group(k).num_rows for m in footers for k in range(m.num_row_groups)]
    assert all(n >= 10_000 for n in sizes)


def test_a_strict_run_serves_every_version_and_lists_the_unknown_ones(spark, scratch):
    root = scratch("versions")
    raw = typed(feeds(spark, [event("e1")], [txn("t1")], [partner("P1"), partner("P3", "v9"), partner("P4", "")], [payment("p1", "0")]))
    for mode in ("full", "incremental"):
        m = run_batch(spark, raw, root).first()
        assert (m.mode, m.partners) == (mode, 2)
        assert keys(read_lake(spark, f"{root}/serving/partners", "partners"), "partner_id") == ["P1", "P3"]
        assert keys(read_lake(spark, f"{root}/quarantine/partners", "quarantine_partners"), "partner_id") == ["P3", "P4"]
