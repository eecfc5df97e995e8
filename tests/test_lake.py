"""Sinks, keyed merges, the batch run and compaction."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.sinks.lake_table import read_lake
from quayside.sinks.lake_write import sink_partitioned, upsert_keyed


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dynamic_overwrite_replaces_only_batch_partitions(spark, scratch):
    path = scratch("sink")
    d1, d2 = dt.date(2025, 3, 30), dt.date(2025, 3, 31)
    sink_partitioned(spark.createDataFrame([("a", d1), ("b", d2)], "k string, d date"), path, "d")
    sink_partitioned(spark.createDataFrame([("c", d2)], "k string, d date"), path, "d")
    sink_partitioned(spark.createDataFrame([], "k string, d date"), path, "d")  # no-op
    assert _rows(spark.read.parquet(path), ["k"]) == [("a",), ("c",)]


def test_upsert_later_row_wins_and_empty_delta_is_noop(spark):
    target = spark.createDataFrame([("1", "old", 1), ("2", "keep", 1)], "id string, v string, n int")
    delta = spark.createDataFrame([(1, "1", "new", 2), (2, "3", "add", 3)], "_seq long, id string, v string, n int")
    assert _rows(upsert_keyed(target, delta, ["id"]), ["id", "v"]) == [("1", "new"), ("2", "keep"), ("3", "add")]
    empty = spark.createDataFrame([], "id string, v string, n int")
    assert _rows(upsert_keyed(target, empty, ["id"]), ["id", "v"]) == [("1", "old"), ("2", "keep")]


def test_batch_run_is_idempotent_and_incremental_equals_full(spark, scratch):
    """Full run on a first delivery + incremental run on everything == one
    full refresh; rerunning with no new input changes nothing and reports no
    new payments."""
    from quayside.plans.batch_run import run_batch
    from quayside.plans.lake_queries import two_run_lake, raw_feeds
    from tests.conftest import SMALL_SF
    lake = two_run_lake(spark, SMALL_SF)
    root = lake["root"]
    assert lake["first"]["mode"] == "full" and lake["second"]["mode"] == "incremental"
    full_root = scratch("lake-full")
    run_batch(spark, raw_feeds(spark, SMALL_SF), full_root, full_refresh=True).collect()
    for table, dataset, key in [("events", "events", "event_id"), ("transactions", "transactions", "transaction_id"),
                                ("payments", "payments", "event_id"), ("events_bots", "events_bots", "event_id"),
                                ("quarantine/transactions", "quarantine_transactions", "transaction_id")]:
        a = read_lake(spark, f"{root}/{table}", dataset)
        b = read_lake(spark, f"{full_root}/{table}", dataset)
        assert a.count() == b.count() > 0, table
        assert a.exceptAll(b.select(*a.columns)).count() == 0, table
        assert a.select(key).distinct().count() == a.count(), table
    before = read_lake(spark, f"{root}/events", "events").count()
    rerun = run_batch(spark, raw_feeds(spark, SMALL_SF), root).collect()[0]
    assert rerun["payments"] == 0 and rerun["mode"] == "incremental"
    assert read_lake(spark, f"{root}/events", "events").count() == before


def test_compaction_detects_reduces_and_preserves_rows(spark, scratch):
    from quayside.operators.maintenance import compact_partitions
    from quayside.sources.lake_scan import scan_file_inventory
    root = scratch("small-files")
    part = f"{root}/ingest_date=2025-03-31"
    for i in range(5):
        rows = [(f"demo-{i * 10 + j}", i * 10 + j) for j in range(10)]
        spark.createDataFrame(rows, "event_id string, value long").coalesce(1).write.mode("append").parquet(part)
    assert scan_file_inventory(spark, root).count() == 5
    result = compact_partitions(spark, root, apply=True).collect()
    assert len(result) == 1 and result[0]["needs_compaction"] and result[0]["compacted"]
    assert result[0]["rows_before"] == result[0]["rows_after"] == 50
    assert scan_file_inventory(spark, root).count() == 1
    assert spark.read.parquet(root).count() == 50
    # dry run: detection only
    again = compact_partitions(spark, root, apply=False).collect()
    assert not again[0]["needs_compaction"]


def test_contract_check_counts_repeated_keys(spark):
    from quayside.contracts import contract_check
    df = spark.createDataFrame([("p", "v1", dt.datetime(2024, 1, 1))] * 3 + [("q", "v1", None)],
                               "partner_id string, schema_version string, created_at timestamp_ntz")
    r = contract_check(df, "partners").collect()[0]
    assert r["rows"] == 4 and r["repeated_keys"] == 2 and r["null_created_at"] == 1
    assert F is not None


def test_repeated_keys_of_a_delta_have_one_winner_however_they_lie(spark, scratch):
    rows = [("k", f"v{i}", i) for i in range(6)] + [("j", "only", 0)]
    for order, parts in ((rows, 1), (rows[::-1], 3), (rows[3:] + rows[:3], 7)):
        plain = spark.createDataFrame(order, "k string, v string, _seq int").repartition(parts)
        assert _rows(upsert_keyed(None, plain, ["k"]), ["k", "v"]) == [("j", "only"), ("k", "v5")]
        unordered = upsert_keyed(None, plain.drop("_seq"), ["k"])
        assert {r["v"] for r in unordered.where("k = 'k'").collect()} == {
            r["v"] for r in upsert_keyed(None, spark.createDataFrame(rows, "k string, v string, s int").drop("s"), ["k"])
            .where("k = 'k'").collect()}


def test_lake_scans_push_filters_and_columns(spark, scratch):
    from quayside.operators.analytics import funnel, transaction_summary
    from quayside.plans.flows import Feeds
    from tests.conftest import SMALL_SF
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated scan metadata
    path = scratch("lake-events")
    sink_partitioned(Feeds(spark, SMALL_SF).events(), path, "ingest_date")
    q = funnel(spark.read.parquet(path), "2024-01-05", "2024-01-10")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in plan
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<event_type:string,session_id:string,event_ts:timestamp_ntz,channel:string>" in scan
    assert q.count() > 0

    tpath = scratch("lake-transactions")
    txns = Feeds(spark, SMALL_SF).transactions()
    txns.write.parquet(tpath)
    s = transaction_summary(spark.read.parquet(tpath), "1996-01-01", "1996-12-31", currency="brl")
    splan = s._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in splan and "EqualTo(currency,BRL)" in splan


def test_compaction_report_reproduces_the_published_demo(spark, scratch):
    """25 micro-batch files x 100 rows in one day partition -> 1 file, 2,500
    rows kept, 96% fewer files."""
    from quayside.operators.maintenance import compact_partitions, compaction_report, small_partitions
    from quayside.sources.lake_scan import scan_file_inventory
    root = scratch("demo-small-files")
    part = f"{root}/ingest_date=2025-03-31"
    for i in range(25):  # one file per micro-batch
        spark.range(i * 100, (i + 1) * 100, numPartitions=1).selectExpr(
            "concat('demo-', id) AS event_id", "id AS value").write.mode("append").parquet(part)
    files_before = scan_file_inventory(spark, root).count()
    rows_before = spark.read.parquet(root).count()
    detected = small_partitions(spark, root).where("needs_compaction").count() == 1
    compact_partitions(spark, root, apply=True).collect()
    report = compaction_report(spark, files_before, scan_file_inventory(spark, root).count(),
                               rows_before, spark.read.parquet(root).count(), detected).collect()[0]
    assert report["detected"] and report["rows_preserved"]
    assert (report["files_before"], report["files_after"], report["rows_after"]) == (25, 1, 2500)
    assert report["reduction_percent"] == 96.0


def test_sink_caps_rows_per_file(spark, scratch):
    from quayside.sources.lake_scan import scan_file_inventory
    path = scratch("capped")
    df = spark.range(10).selectExpr("id", "date'2025-03-31' AS d").coalesce(1)
    sink_partitioned(df, path, "d", max_records=3)
    assert scan_file_inventory(spark, path).count() == 4
    assert spark.read.parquet(path).count() == 10


def test_offset_filter_broadcasts_saved_offsets_and_never_shuffles_the_feed(spark):
    from quayside.operators.filters import filter_new_offsets
    feed = spark.range(1000).selectExpr("cast(id % 8 AS string) AS kafka_partition",
                                        "cast(id div 8 AS string) AS kafka_offset")
    saved = spark.createDataFrame([(p, 60) for p in range(8)], "kafka_partition int, kafka_offset bigint")
    out = filter_new_offsets(feed, saved)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert out.count() == 8 * (125 - 61)


def test_file_inventory_never_reads_file_bodies(spark, scratch):
    from quayside.sources.lake_scan import scan_file_inventory
    path = scratch("inventory")
    spark.range(100).selectExpr("id", "date'2025-03-31' AS d").write.partitionBy("d").parquet(path)
    inv = scan_file_inventory(spark, path)
    scan = [line for line in inv._jdf.queryExecution().executedPlan().toString().split("\n")
            if "FileScan" in line][0]
    assert "content" not in scan.split("ReadSchema")[-1] and "length" in scan
    row = inv.collect()[0]
    assert row["partition"] == "d=2025-03-31" and row["bytes"] > 0 and row["dataset"] == "d=2025-03-31"


def _fragmented(spark, path, rows, schema, parts):
    spark.createDataFrame(rows, schema).repartition(4).write.partitionBy(*parts).parquet(path)


def test_compaction_keeps_nested_padded_null_and_escaped_partitions(spark, scratch):
    from quayside.operators.maintenance import compact_partitions, small_partitions
    path = scratch("nested")
    rows = [(i, f"{i % 3:02d}", None if i % 5 == 0 else f"a:b {i % 2}/c") for i in range(200)]
    _fragmented(spark, path, rows, "k int, hour string, place string", ["hour", "place"])
    read = lambda: sorted(tuple(str(c) for c in r) for r in spark.read.schema("k int, hour string, place string").parquet(path).collect())
    before = read()
    done = compact_partitions(spark, path, apply=True).collect()
    assert done and all(r["compacted"] and r["rows_before"] == r["rows_after"] for r in done)
    assert read() == before == sorted(tuple(str(c) for c in r) for r in rows)
    assert small_partitions(spark, path).where("needs_compaction").count() == 0
    assert compact_partitions(spark, path, apply=True).where("compacted").count() == 0


def test_a_failed_rename_leaves_every_row(spark, scratch, monkeypatch):
    import pytest
    from quayside.operators import maintenance
    path = scratch("failing")
    _fragmented(spark, path, [(i, i % 2) for i in range(100)], "k int, d int", ["d"])
    real, calls = maintenance.rename_path, []

    def fails(spark, src, dst):
        calls.append(src)
        return False if len(calls) == 4 else real(spark, src, dst)

    monkeypatch.setattr(maintenance, "rename_path", fails)
    with pytest.raises(RuntimeError, match="its files are back"):
        maintenance.compact_partitions(spark, path, apply=True)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == list(range(100))


def test_contracts_refuse_a_wrong_type_and_a_missing_column(spark):
    import pytest
    from quayside.contracts import SCHEMAS, conform
    good = spark.createDataFrame([], SCHEMAS["payments"])
    assert conform(good.withColumn("extra", F.lit(1)), "payments").schema.names == SCHEMAS["payments"].names
    for bad in (good.withColumn("amount", F.lit("1.0")), good.drop("gateway")):
        with pytest.raises(TypeError):
            conform(bad, "payments")
