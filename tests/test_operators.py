"""Operator tests on the fixture tables and on small inline frames."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.plans.flows import Feeds
from tests.conftest import SMALL_SF


def test_every_raw_event_key_lands_on_the_side_of_its_latest_flag(spark):
    """Against a plain walk over the raw feed: the last delivery of a key decides where it goes."""
    raw = Feeds(spark, SMALL_SF).raw("raw_events").select("_seq", "event_id", "ingest_date", "is_bot_flag").collect()
    flag = {r.event_id: (r.is_bot_flag or "").strip().lower() in ("true", "1", "yes")
            for r in sorted(raw, key=lambda r: (r.ingest_date, r._seq))}
    f = Feeds(spark, SMALL_SF)
    sides = {True: f.bots(), False: f.events()}
    for side, df in sides.items():
        got = [r.event_id for r in df.select("event_id").collect()]
        assert sorted(got) == sorted(k for k, bot in flag.items() if bot == side) and got


def test_the_sign_of_the_latest_amount_decides_the_quarantine(spark):
    rows = [(1, "t1", "2025-01-01 00:00:00", "-1.00"), (2, "t1", "2025-01-02 00:00:00", "5.00"), (3, "t2", "2025-01-01 00:00:00", "3.00"),
            (4, "t2", "2025-01-01 00:00:00", "-0.01"), (5, "t3", "2025-01-01 00:00:00", "0"), (6, "t4", "2025-01-01 00:00:00", "")]
    from quayside.contracts import RAW_TXN_FIELDS
    from quayside.operators.splits import split_quarantine
    from quayside.plans.flows import transactions_all
    df = spark.createDataFrame(rows, "_seq int, transaction_id string, ingest_ts string, amount string")
    df = df.withColumn("created_at", F.col("ingest_ts"))
    for c in RAW_TXN_FIELDS:
        df = df if c in df.columns else df.withColumn(c, F.lit(""))
    good, bad = split_quarantine(transactions_all(df))
    assert {r.transaction_id: r.amount and float(r.amount) for r in good.collect()} == {"t1": 5.0, "t3": 0, "t4": None}
    assert [(r.transaction_id, r.quarantine_reason) for r in bad.collect()] == [("t2", "negative_amount")]


def test_partner_versions_share_one_projection(spark):
    """Fields that a version lacks are null in it, and set somewhere in a version that has them."""
    partners = Feeds(spark, SMALL_SF).partners()
    filled = {r["schema_version"]: r for r in partners.groupBy("schema_version").agg(
        *[F.count(c).alias(c) for c in ("name", "sla_hours", "avg_rating", "webhook_enabled")]).collect()}
    assert set(filled) == {"v1", "v2", "v3", "v9"}  # v9: the fixture's unknown version
    assert filled["v1"]["sla_hours"] == filled["v1"]["avg_rating"] == 0 < filled["v1"]["name"]
    assert filled["v2"]["webhook_enabled"] == 0 < filled["v2"]["sla_hours"] and filled["v3"]["webhook_enabled"] > 0


def test_incremental_window_and_offsets(spark):
    from quayside.operators.filters import filter_new_offsets, filter_since, window_start
    start = window_start("2025-03-31", 7)
    assert start == dt.datetime(2025, 3, 24)
    events = spark.createDataFrame([(dt.date(2025, 3, 23),), (dt.date(2025, 3, 24),)], "ingest_date date")
    kept = filter_since(events, "ingest_date", start.date()).collect()
    assert [r[0] for r in kept] == [dt.date(2025, 3, 24)]
    payments = spark.createDataFrame([("0", "10"), ("0", "11"), ("1", "4")], "kafka_partition string, kafka_offset string")
    saved = spark.createDataFrame([(0, 10), (1, 5)], "kafka_partition int, kafka_offset bigint")
    assert [tuple(r) for r in filter_new_offsets(payments, saved).collect()] == [("0", "11")]
    assert filter_new_offsets(payments, None).count() == 3


def test_dedupe_ties_go_to_the_later_arrival(spark):
    from quayside.operators.dedupe import dedupe_latest
    rows = [(1, "a", "2025-01-01", "first"), (2, "a", "2025-01-01", "second"),
            (3, "b", "2025-01-02", "new"), (4, "b", "2025-01-01", "old")]
    df = spark.createDataFrame(rows, "_seq long, k string, d string, v string")
    out = {r["k"]: r["v"] for r in dedupe_latest(df, "k", "d").collect()}
    assert out == {"a": "second", "b": "new"}


def test_dense_sequence_matches_row_number(spark):
    from quayside.operators.sequence import dense_sequence
    li = spark.read.parquet(f"{SMALL_SF}/lineitem.parquet").withColumn("g", F.col("l_suppkey") % 3)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    mine = dense_sequence(li, "g", order, "seq", slices=13)
    w = Window.partitionBy("g").orderBy(*order)
    ref = li.withColumn("seq", F.row_number().over(w) - 1)
    cols = ["g", *order, "seq"]
    assert sorted(map(tuple, mine.select(*cols).collect())) == sorted(map(tuple, ref.select(*cols).collect()))


def test_running_max_before_matches_window(spark):
    from quayside.operators.sequence import running_max_before
    rows = [(p, o, (o * 37 + p * 11) % 50) for p in range(3) for o in range(200)]
    df = spark.createDataFrame(rows, "p int, o long, v long")
    mine = running_max_before(df, "p", "o", "v", "m", slice_size=17)
    w = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("m", F.max("v").over(w))
    assert sorted(map(tuple, mine.select("p", "o", "v", "m").collect())) == \
        sorted(map(tuple, ref.select("p", "o", "v", "m").collect()))


def test_bot_session_span_count_matches_brute_force(spark):
    """A 130-event burst in < 4 minutes straddling an hour boundary."""
    from quayside.operators.windows import bot_sessions
    base = dt.datetime(2025, 3, 31, 9, 58, 30)
    rows = [("bot", base + dt.timedelta(seconds=i * 1.5)) for i in range(130)]
    rows += [("human", base + dt.timedelta(minutes=i * 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "session_id string, event_ts timestamp_ntz")
    out = {r["session_id"]: r for r in bot_sessions(df).collect()}

    def brute(ts):
        return max(sum(1 for u in ts if 0 <= (t - u).total_seconds() < 240) for t in ts)

    assert out["bot"]["is_bot"] and out["bot"]["max_events_in_span"] == brute([t for s, t in rows if s == "bot"])
    assert not out["human"]["is_bot"]
    assert out["human"]["max_events_in_span"] == brute([t for s, t in rows if s == "human"])


def test_insert_ignore_accepts_once(spark):
    from quayside.operators.quality import insert_ignore
    target = spark.createDataFrame([("seed-event",)], "event_id string")
    batch = spark.createDataFrame([(1, "event-test-0001"), (2, "event-test-0001"), (3, "seed-event")],
                                  "_seq long, event_id string")
    out = {r["_seq"]: (r["accepted"], r["idempotent"]) for r in insert_ignore(target, batch).collect()}
    assert out == {1: (True, False), 2: (False, True), 3: (False, True)}


def test_validation_defaults_and_reasons(spark):
    from quayside.operators.quality import validate_event_input
    rows = [("event-test-0001", "page_view", "session-1", None, "2025-03-31 12:00:00", None, None, None,
             None, None, None, None, "2025-03-31"),
            ("short", "page_view", None, None, "2025-03-31 12:00:00", None, None, "mobile", "BR", None,
             "abc", None, "2025-02-30")]
    cols = ("event_id event_type session_id user_id event_ts page partner_id device country channel "
            "price_usd metadata_json ingest_date").split()
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    out = {r["event_id"]: r for r in validate_event_input(df).collect()}
    ok = out["event-test-0001"]
    assert ok["is_valid"] and ok["device"] == "unknown" and ok["country"] == "unknown" and ok["is_bot_flag"] is False
    bad = out["short"]["rejection_reasons"].split(";")
    assert bad == ["event_id_too_short", "session_id_missing", "ingest_date_invalid", "price_usd_invalid"]


def test_hmac_token_matches_python(spark):
    import hashlib
    import hmac
    from quayside.operators.quality import user_id_token
    key = b"k" * 70  # longer than one block: hashed first
    df = spark.createDataFrame([("u1",), ("",), ("  ",), ("ü-2",)], "user_id string")
    got = [r[0] for r in user_id_token(df, key).collect()]
    want = [hmac.new(key, u.encode(), hashlib.sha256).hexdigest() if u.strip() else None
            for u in ("u1", "", "  ", "ü-2")]
    assert got == want


def test_payment_windows_tumbling_and_sliding(spark):
    from quayside.operators.windows import payment_windows
    rows = [(dt.datetime(2025, 3, 1, 10), "ok", 1), (dt.datetime(2025, 3, 1, 23), "ok", 2),
            (dt.datetime(2025, 3, 2, 1), "ok", 3)]
    df = spark.createDataFrame(rows, "event_ts timestamp_ntz, status string, amount int").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)"))
    tumbling = {r["window_start"].day: r["payments"] for r in payment_windows(df, "1 day").collect()}
    assert tumbling == {1: 2, 2: 1}
    sliding = payment_windows(df, "2 days", "1 day").collect()
    assert sorted((r["window_start"].day, r["payments"]) for r in sliding) == [(1, 3), (2, 1), (28, 2)]


def test_hot_group_is_spread_over_slices_and_numbered_exactly(spark):
    """One Kafka partition holding a third of the rows is split across many
    range slices (no single task owns it), and its numbers stay dense."""
    from quayside.operators.sequence import assign_sequence, slice_and_number
    n = 3000
    rows = [(0 if i % 3 == 0 else 1 + i % 7, i) for i in range(n)]  # group 0 = one third
    df = spark.createDataFrame(rows, "g int, o long")
    from quayside.sinks.lake_write import stage
    sliced = stage(slice_and_number(df, "g", ["o"], slices=12), "hot-slices")
    hot_slices = sliced.where("g = 0").select("_slice").distinct().count()
    assert hot_slices >= 3
    seq = assign_sequence(sliced, "g", "seq").where("g = 0").orderBy("o").collect()
    assert [r["seq"] for r in seq] == list(range(n // 3))


def test_dedupe_of_a_hot_key_is_limited_before_the_shuffle(spark):
    from quayside.operators.dedupe import dedupe_latest
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "_seq long, k string, v long").repartition(6)
    out = dedupe_latest(df, "k", "v")
    lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k#" in line)
    assert exchange < partial  # printed root-first: the partial limit runs before (below) the shuffle
    assert out.where("k = 'hot'").collect()[0]["v"] == 2997
    assert out.count() == 2001


def test_dedupe_in_parts_sorts_a_bounded_number_of_rows_and_cuts_frequent_keys_first(spark):
    from quayside.operators.dedupe import dedupe_in_parts, dedupe_latest
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 1500}", i * 7919 % 3001) for i in range(3000)]
    df = spark.createDataFrame(rows, "_seq long, k string, v long").repartition(6)
    out = dedupe_in_parts(df, "k", "v", task_rows=100)
    lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
    assert any("Exchange hashpartitioning(k#" in line and "30" in line for line in lines)  # 3,000 rows, 100 a part
    partial = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    exchange = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(k#" in line]
    assert exchange[1] < partial[-1]  # the frequent key's copies are cut before its shuffle
    assert sorted(out.collect(), key=str) == sorted(dedupe_latest(df, "k", "v").collect(), key=str)
    # without a frequent key no task sorts its input before the shuffle
    plain = dedupe_in_parts(df.where("k <> 'hot'"), "k", "v", task_rows=100)
    lines = plain._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("Sort" in line for line in lines[next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k#" in line):])
    assert plain.count() == df.where("k <> 'hot'").select("k").distinct().count()


def test_argument_checks_and_empty_partner_performance(spark):
    import pytest
    from quayside.operators import analytics
    txns = spark.createDataFrame(
        [("PRT0001", "confirmed", 100, dt.datetime(2025, 3, 31, 10)),
         ("PRT0001", "failed", 7, dt.datetime(2025, 3, 31, 11))],
        "partner_id string, status string, amount int, created_at timestamp_ntz").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")).withColumn("currency", F.lit("BRL"))
    with pytest.raises(ValueError, match="end_date"):
        analytics.transaction_summary(txns, "2025-03-31", "2025-03-30")
    with pytest.raises(ValueError, match="3 characters"):
        analytics.transaction_summary(txns, "2025-03-01", "2025-03-31", currency="BR")
    with pytest.raises(ValueError, match="end_date"):
        analytics.funnel(txns, "2025-03-31", "2025-03-01")
    partners = spark.createDataFrame(
        [("PRT0001", "v1", dt.datetime(2024, 1, 1), None), ("PRT0002", "v3", dt.datetime(2024, 1, 1),
                                                             dt.datetime(2025, 1, 1))],
        "partner_id string, schema_version string, created_at timestamp_ntz, updated_at timestamp_ntz")
    out = {r["partner_id"]: r for r in analytics.partner_profile_performance(partners, txns).collect()}
    assert (out["PRT0001"]["transaction_count"], str(out["PRT0001"]["revenue"]), out["PRT0001"]["approved_count"]) \
        == (2, "100.00", 1)
    assert (out["PRT0002"]["transaction_count"], out["PRT0002"]["revenue"], out["PRT0002"]["approved_count"]) \
        == (0, None, None)
    summary = analytics.transaction_summary(txns, "2025-03-31", "2025-03-31", currency="brl").collect()
    assert [(r["status"], r["transaction_count"], str(r["average_amount"])) for r in summary] == \
        [("confirmed", 1, "100.00"), ("failed", 1, "7.00")]


def test_average_amount_rounds_half_up_from_exact_cents(spark):
    from quayside.operators import analytics
    rows = [("P", "ok", a) for a in ("0.01", "0.02")] + [("Q", "ok", a) for a in ("1.00", "1.01", "1.01")] \
        + [("R", "ok", a) for a in ("0.00", "0.00", "0.01")] + [("S", "ok", None)]
    txns = spark.createDataFrame(rows, "partner_id string, status string, amount string").select(
        "partner_id", "status", F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.lit("BRL").alias("currency"), F.lit("2025-03-31 10:00:00").cast("timestamp_ntz").alias("created_at"))
    out = {r["partner_id"]: (str(r["total_amount"]), None if r["average_amount"] is None else str(r["average_amount"]))
           for r in analytics.transaction_summary(txns, "2025-03-31", "2025-03-31").collect()}
    assert out == {"P": ("0.03", "0.02"),   # 0.015 -> 0.02 (half up)
                   "Q": ("3.02", "1.01"),   # 1.00666.. -> 1.01
                   "R": ("0.01", "0.00"),   # 0.00333.. -> 0.00
                   "S": ("None", None)}     # no amounts -> NULL total and average


def test_ingest_appends_accepted_rows_once(spark, scratch):
    from quayside.operators.quality import append_accepted
    root = scratch("ingest")
    batch = spark.createDataFrame([(1, "k1", "a", "2024-01-01"), (2, "k1", "b", "2024-01-02"), (3, "k2", "c", "2024-01-01")],
                                  "_seq long, event_id string, v string, ingest_date string")
    first = {r["_seq"]: r["accepted"] for r in append_accepted(spark, root, batch).collect()}
    again = [r["idempotent"] for r in append_accepted(spark, root, batch).collect()]
    assert first == {1: True, 2: False, 3: True} and again == [True] * 3
    assert sorted((r["event_id"], r["v"]) for r in spark.read.parquet(root).collect()) == [("k1", "a"), ("k2", "c")]


def test_freshness_takes_the_nearest_rank(spark):
    import datetime as dt

    from quayside.operators.quality import freshness
    t = dt.datetime(2024, 1, 1)
    rows = [(t, t + dt.timedelta(seconds=60 * k)) for k in range(1, 21)] + [(None, t)]
    (r,) = freshness(spark.createDataFrame(rows, "created_at timestamp_ntz, ingest_ts timestamp_ntz")).collect()
    assert (r["rows"], r["p95_lag_minutes"], r["meets_target"]) == (21, 19.0, True)


def test_a_cluster_needs_a_shared_checkpoint_folder(monkeypatch):
    import pytest

    from quayside import session

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    fake = type("Session", (), {"conf": Conf, "sparkContext": Context})
    with pytest.raises(ValueError):
        session.checkpoint_root(fake)


def densest(times, size, least):
    """Brute force: intervals from every event, chained where they overlap, the fullest of each chain."""
    spans = [(t, sum(t <= u < t + size for u in times)) for t in sorted(set(times))]
    chains = []
    for t, n in (x for x in spans if x[1] >= least):
        if chains and t - chains[-1][-1][0] < size:
            chains[-1].append((t, n))
        else:
            chains.append([(t, n)])
    return sorted(min(c, key=lambda x: (-x[1], x[0])) for c in chains)


def test_a_spike_across_a_boundary_fires_once_with_its_true_share(spark):
    import random
    from quayside.operators.windows import spike_windows
    r = random.Random(2)
    hour = dt.timedelta(hours=1)
    start = dt.datetime(1970, 1, 1) + 16 * hour * 30_000  # a tumbling boundary lies in the middle of each spike
    times = [start + r.random() * 4000 * hour for _ in range(700)]
    times += [start + 1000 * hour + (r.random() * 16 - 8) * hour for _ in range(200)]
    times += [start + 3000 * hour - 8 * hour, start + 3000 * hour - 8 * hour] + [start + 3000 * hour + r.random() * hour for _ in range(110)]
    times = [t.replace(microsecond=0) for t in times]
    df = spark.createDataFrame([(t,) for t in times] + [(None,)] * 5, "event_ts timestamp_ntz")
    got = sorted((x.window_start, x.payments, round(x.share, 9), x.window_end - x.window_start) for x in spike_windows(df).collect())
    want = densest(times, 16 * hour, 0.1 * (len(times) + 5))
    assert len(want) == 2 and got == [(t, n, round(n / (len(times) + 5), 9), 16 * hour) for t, n in want]
    assert spike_windows(df, share=0.5).count() == 0 and spike_windows(df.where("event_ts is null")).count() == 0


def test_a_hot_session_hour_is_spread_over_tasks(spark):
    """Half of all events in one session-hour: every slice of the sweep stays near the mean size."""
    from quayside.operators.sequence import _in_slices
    from quayside.operators.windows import max_events_in_span
    n = 40_000
    at = lambda us: F.lit("2025-03-01 12:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(us / 1e6).cast("decimal(18,6)"))
    hot = spark.range(n).select(F.lit("bot").alias("s"), at(F.col("id") * 90_000).alias("t"))
    rest = spark.range(n).select(F.concat(F.lit("h"), F.col("id") % 500).alias("s"), at(F.col("id") * 997_000 % 86_000_000_000).alias("t"))
    events = hot.union(rest)
    got = {r.s: (r.max_events_in_span, r.events) for r in max_events_in_span(events, "s", "t").collect()}
    assert got["bot"] == (-(-240_000_000 // 90_000), n) and sum(e for _, e in got.values()) == 2 * n
    slices = _in_slices(events.withColumn("us", F.unix_micros(F.col("t").cast("timestamp"))), ["s"], ["us"], "test").groupBy("_slice").count()
    most, mean = slices.agg(F.max("count"), F.avg("count")).first()
    assert most < 3 * mean and slices.count() >= 4


def test_offsets_in_arrival_order_come_from_the_files(spark, scratch):
    """A feed that arrives 3, 2, 1 isn't monotonic, though its offsets are dense; times of the files decide."""
    import os
    from quayside.operators.quality import offset_continuity, offset_monotonic
    from quayside.sources.lake_scan import in_arrival_order
    path = scratch("arrival")
    feeds = [("z", [("0", "3"), ("1", "0")]), ("y", [("0", "2"), ("1", "1"), ("1", "2")]), ("a", [("0", "1"), ("1", "2"), (None, "7"), ("1", None)])]
    for k, (name, rows) in enumerate(feeds):
        spark.createDataFrame(rows, "kafka_partition string, kafka_offset string").coalesce(1).write.parquet(f"{path}/{name}")
        for f in os.listdir(f"{path}/{name}"):
            os.utime(f"{path}/{name}/{f}", (1_700_000_000 + 60 * k,) * 2)
    feed, arrival = in_arrival_order(spark, f"{path}/*", spark.read.parquet(f"{path}/z").schema)
    got = {r.kafka_partition: tuple(r)[1:] for r in offset_monotonic(feed, arrival).collect()}
    assert got == {0: (3, 2, 0, 1, 2, False), 1: (4, 0, 1, 0, None, False), None: (1, 0, 0, 0, None, True)}
    assert {r.kafka_partition: r.monotonic for r in offset_continuity(feed.where("kafka_partition = '0'")).collect()} == {0: True}


def test_running_sum_and_previous_value_match_windows(spark):
    from quayside.operators.sequence import previous_value, running_sum
    df = spark.range(3000).select(F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(
        (F.col("id") % 11).cast("string")).alias("g"), (F.col("id") * 7919 % 3001).alias("o"), (F.col("id") % 13 - 6).alias("v"))
    w = Window.partitionBy("g").orderBy("o")
    want = df.select("g", "o", F.sum("v").over(w).alias("s"), F.lag("v").over(w).alias("p"))
    assert running_sum(df, ["g"], "o", "v", "s").select("g", "o", "s").exceptAll(want.select("g", "o", "s")).count() == 0
    back = previous_value(df, ["g"], ["o"], "v", "p").select("g", "o", "p")
    assert back.count() == 3000 and back.exceptAll(want.select("g", "o", "p")).count() == 0


def test_previous_values_by_given_slices_move_the_rows_once(spark, monkeypatch):
    from quayside.operators import sequence
    monkeypatch.setattr(sequence, "stage", lambda *a: pytest.fail("rows are written"))
    df = spark.range(3000).select(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("g"),
                                  F.when(F.col("id") % 5 > 0, F.lit("a")).alias("file"), (F.col("id") * 7919 % 3001).alias("o"),
                                  F.when(F.col("id") % 4 > 0, F.col("id") % 13).alias("v"))
    df = df.withColumn("nth", F.floor(F.col("o") / 100))
    back = sequence.previous_value(df, ["g"], ["file", "o"], "v", "p", ["file", "nth"])
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("g").orderBy("file", "o")))
    assert back.columns == want.columns and back.count() == 3000 and back.exceptAll(want).count() == 0
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 3  # last of each slice, these in order, the rows


def test_landing_payments_shuffles_what_orders_them_in_slices_that_grow_in_number(spark, monkeypatch):
    from quayside.sources import fixtures
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(fixtures, "SLICE_ROWS", 300)
    monkeypatch.setattr(fixtures, "_LANDED_FEEDS", {})
    sliced = fixtures._slice_payment_stream(spark, sf)
    plan = sliced._jdf.queryExecution().optimizedPlan().toString()
    assert "payment_approved" in plan and "payment_approved" not in plan.split("RepartitionByExpression")[1]
    assert sliced.select("_slice").distinct().count() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    mine, want = fixtures.raw_payment_stream(spark, sf), spark.sql(fixtures.RAW_PAYMENT_STREAM_SQL)
    assert mine.count() == want.count() and want.select(*mine.columns).exceptAll(mine).count() == 0
