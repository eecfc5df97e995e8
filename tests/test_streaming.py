"""Stream restart equals batch; windows and late rows; dedupe by state and locator."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from quayside.sinks.lake_table import LakeTable, read_lake
from quayside.streaming import payments as st


def _feed(spark, n=60):
    rows = []
    for i in range(n):
        p = i % 3
        rows.append((f"e{i % 45}", "payment_approved", f"TXN{i}", f"u{i}", "PRT0001", f"{i}.50", "BRL",
                     "APPROVED" if i % 2 else "refused", "stripe", dt.datetime(2025, 3, 1) + dt.timedelta(hours=i),
                     str(p), str(i // 3), str(i * 10), "False"))
    cols = ("event_id event_type transaction_id user_id partner_id amount currency status gateway event_ts "
            "kafka_partition kafka_offset processing_lag_ms is_spike").split()
    schema = ", ".join(f"{c} {'timestamp_ntz' if c == 'event_ts' else 'string'}" for c in cols)
    return spark.createDataFrame(rows, schema)


def test_stream_restart_equals_batch(spark, scratch):
    from quayside.plans.flows import payments_all
    feed = _feed(spark)
    landing, table, ckpt = scratch("landing"), scratch("table"), scratch("ckpt")
    st.land_in_chunks(feed, landing, F.col("kafka_offset").cast("bigint"), 3)
    first = st.run_payment_stream(spark, landing, table, ckpt, feed.schema)
    again = st.run_payment_stream(spark, landing, table, ckpt, feed.schema)
    assert first["input_rows"] == 60 and again["input_rows"] == 0
    got = read_lake(spark, table, "payments")
    want = payments_all(feed)
    assert got.count() == want.count() == 45
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_a_shuffled_feed_file_by_file_equals_batch(spark, scratch):
    """Deliveries of a key far apart and out of order, one file a micro-batch; a batch touches its own keys alone."""
    from quayside.plans.flows import payments_all
    feed = _feed(spark, 90).withColumn("r", F.xxhash64("event_id", "kafka_offset"))
    landing, table, ckpt = scratch("landing"), scratch("table"), scratch("ckpt")
    for k in range(4):
        feed.where(F.pmod("r", F.lit(4)) == k).drop("r").coalesce(1).write.mode("append").parquet(landing)
    done = st.run_payment_stream(spark, landing, table, ckpt, feed.drop("r").schema, files_per_trigger=1)
    want = payments_all(feed.drop("r"))
    got = read_lake(spark, table, "payments")
    assert done["input_rows"] == 90 and len([m for m in done["merges"] if m["batch_rows"]]) == 4
    assert got.count() == want.count() == 45 and got.exceptAll(want).count() == 0
    before = LakeTable.of(spark, table, "payments").manifest()
    feed.drop("r").limit(1).withColumn("kafka_offset", F.lit("500")).write.mode("append").parquet(landing)
    one = st.run_payment_stream(spark, landing, table, ckpt, feed.drop("r").schema)["merges"]
    touched = [m for m in one if m["batch_rows"]]
    assert len(touched) == 1 and (touched[0]["buckets_read"], touched[0]["partitions_read"]) == (1, 1)
    assert len(before["parts"]) > 1 and read_lake(spark, table, "payments").where("kafka_offset = 500").count() == 1


def test_state_is_kept_in_rocksdb_and_released(spark, scratch):
    feed = _feed(spark)
    landing = scratch("landing")
    feed.write.parquet(landing)
    stream = st.payment_stream(spark, landing, feed.schema)
    with st._rocksdb(spark):
        q = (st.latest_deliveries(stream, "event_id", "kafka_partition", "kafka_offset", "1 second").writeStream
             .outputMode("update").format("noop").option("checkpointLocation", scratch("ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
    progress = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert any("rocksdb" in name for name in progress[0]["customMetrics"]) and progress[0]["numRowsUpdated"] == 45
    assert all(p["numRowsDroppedByWatermark"] == 0 for p in progress)


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in (x.getName() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()))
            if f.startswith("shuffle_")}


def _state_files(spark):
    """Of the state's copies on local disk."""
    root = spark.sparkContext._jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    return {os.path.join(d, f) for x in os.listdir(root) if x.startswith("StateStoreId")
            for d, _, files in os.walk(os.path.join(root, x)) for f in files if f.endswith(".sst")}


def test_a_run_leaves_no_shuffle_files_and_merges_without_local_state(spark, scratch, monkeypatch):
    """Else the disk holds every shuffle of the run, and the state twice."""
    feed, merge, held = _feed(spark), LakeTable.merge, []
    landing, table, ckpt = scratch("landing"), scratch("table"), scratch("ckpt")
    st.land_in_chunks(feed, landing, F.col("kafka_offset").cast("bigint"), 2)
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(landing).inputFiles())
    shuffles, state = _shuffle_files(spark), _state_files(spark)

    def watched(self, rows, *args, **kwargs):
        held.append((_shuffle_files(spark) - shuffles, _state_files(spark) - state))
        return merge(self, rows, *args, **kwargs)

    monkeypatch.setattr(LakeTable, "merge", watched)
    st.run_payment_stream(spark, landing, table, ckpt, feed.schema)
    assert held[0][0] and not any(files for _, files in held)
    end = time.time() + 10  # they are deleted in the background
    while (left := _shuffle_files(spark) - shuffles) and time.time() < end:
        time.sleep(0.2)
    assert not left


def _windows(spark, table):
    return st.window_table(spark, table).read().drop("window_month")


def test_window_stream_equals_batch_when_nothing_is_late(spark, scratch):
    from quayside.operators.windows import payment_windows
    from quayside.operators.normalize import normalize_payments
    feed = _feed(spark)
    for slide in (None, "12 hours"):
        landing, table, late, ckpt = scratch("landing"), scratch("windows"), scratch("late"), scratch("ckpt")
        consume = lambda: st.run_window_stream(spark, landing, table, late, ckpt, feed.schema, "1 day", 86400, slide)  # noqa: E731, B023
        st.land_in_chunks(feed, landing, "event_ts", 2, after=consume)
        got, want = _windows(spark, table), payment_windows(normalize_payments(feed), "1 day", slide)
        assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0
        assert not st.late_table(spark, late).exists() or st.late_table(spark, late).read().count() == 0


def test_windows_and_late_rows_are_the_feed_and_replays_add_nothing(spark, scratch):
    feed = _feed(spark)
    landing, table, late, ckpt = scratch("landing"), scratch("windows"), scratch("late"), scratch("ckpt")
    hours = F.col("kafka_offset").cast("int")
    for part in (hours >= 15, (hours >= 5) & (hours < 15), hours < 5):
        feed.where(part).coalesce(1).write.mode("append").parquet(landing)
        got = st.run_window_stream(spark, landing, table, late, ckpt, feed.schema, "6 hours", 10 * 3600)
    behind = [r.event_ts for r in st.late_table(spark, late).read().collect()]
    mark = dt.datetime(2025, 3, 1) + dt.timedelta(hours=59 - 10)
    want = [r.event_ts for r in feed.collect() if int(r.kafka_offset) < 15 and r.event_ts < mark]
    assert sorted(behind) == sorted(want) and {r.watermark for r in st.late_table(spark, late).read().collect()} == {mark}
    total = _windows(spark, table).agg(F.sum("payments")).first()[0]
    assert (got["rows"], got["late"], total) == (60, len(behind), 60 - len(behind)) and behind and total
    last = st.window_table(spark, table).manifest()["properties"]["epoch"]
    before = sorted(map(str, _windows(spark, table).collect()))
    replay = st.window_batch(st.window_table(spark, table), st.late_table(spark, late), "6 hours", 36000, None)
    replay(feed, last)
    assert sorted(map(str, _windows(spark, table).collect())) == before


def test_first_deliveries_survive_however_far_apart(spark, scratch):
    feed = _feed(spark, 6).withColumn("event_ts", F.expr("event_ts + make_dt_interval(60 * int(kafka_offset))"))
    feed = feed.withColumn("event_id", F.when(F.col("event_id") != "e5", F.col("event_id")))
    landing, table, ckpt = scratch("landing"), scratch("dedupe"), scratch("ckpt")
    done = []
    for k in ("1", "0", "1"):  # the later files first, then 60 days back, then again
        feed.where(F.col("kafka_offset") == k).coalesce(1).write.mode("append").parquet(landing)
        done.append(st.run_dedupe_stream(spark, landing, table, ckpt, feed.schema, "event_id", files_per_trigger=1)["inserted"])
    got = [r.event_id for r in LakeTable.opened(spark, table).read().collect()]
    assert sorted(got, key=str) == [None, "e0", "e1", "e2", "e3", "e4"] and done == [3, 3, 0]


def test_rows_without_event_time_are_landed_merged_and_counted(spark, scratch):
    from quayside.plans.flows import payments_all
    some = F.col("event_id").isin("e3", "e20", "e40")
    feed = _feed(spark).withColumn("event_ts", F.when(~some, F.col("event_ts")))
    landing, table, windows, late = scratch("landing"), scratch("table"), scratch("windows"), scratch("late")
    ckpt, ckpt2 = scratch("ckpt"), scratch("ckpt")

    def consume():
        st.run_payment_stream(spark, landing, table, ckpt, feed.schema)
        st.run_window_stream(spark, landing, windows, late, ckpt2, feed.schema)

    assert sum(st.land_in_chunks(feed, landing, "event_ts", 2, after=consume)) == 60
    # a null day holds rows already when another comes, and one leaves it for a day
    more = feed.where("event_id = 'e41' or event_id = 'e3' and kafka_offset = '1'").withColumn("kafka_offset", F.lit("99"))
    at = F.lit("2025-03-02 00:00:00").cast("timestamp_ntz")
    more = more.withColumn("event_ts", F.when(F.col("event_id") == "e3", at))
    more.write.mode("append").parquet(landing)
    consume()
    want = payments_all(feed.union(more))
    got = read_lake(spark, table, "payments")
    assert got.count() == want.count() == 45 and got.exceptAll(want).count() == 0
    assert {r.event_id for r in got.where("event_date is null").collect()} == {"e20", "e40", "e41"}
    every = feed.union(more)
    none = {r.status: r.payments for r in _windows(spark, windows).where("window_start is null").collect()}
    assert none == {r.s: r["count"] for r in every.where("event_ts is null").groupBy(F.lower("status").alias("s")).count().collect()}
    assert _windows(spark, windows).agg(F.sum("payments")).first()[0] == every.count()


def test_a_feed_without_any_event_time_is_landed(spark, scratch):
    feed = _feed(spark, 3).withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
    landing = scratch("landing")
    assert sum(st.land_in_chunks(feed, landing, "event_ts", 2)) == 3 == spark.read.parquet(landing).count()
