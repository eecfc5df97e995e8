"""The driver contract and a fast oracle comparison at sf0.001."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_mod
from quayside.sources.fixtures import BASE_TABLES
from tests.conftest import SMALL_SF

FAST = ["funnel", "funnel_channel", "dedupe_events", "dedupe_partners", "dedupe_payments",
        "normalize_transactions", "split_quarantine", "partner_profile_performance",
        "transaction_summary", "transaction_summary_filtered", "incremental_window_transactions",
        "filter_new_offsets", "alerts", "latency_by_path", "request_rates", "validate_event_input",
        "insert_ignore", "out_of_order_payments", "bot_sessions", "booking_reconciliation",
        "notes_json_drift", "user_id_token", "freshness", "payment_sliding_windows", "scan_csv",
        "upsert_keyed"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["channel", "event_type", "events", "sessions"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(entry_mod.queries()) >= 80


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return str(v.normalize())
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SMALL_SF)
    rel = duck.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    s = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    idx = [rel.columns.index(c) for c in cols]
    d = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert s == d


TZ_SENSITIVE = ["funnel_channel", "transaction_summary_filtered", "incremental_window_transactions",
                "reconcile_30d", "filter_since", "request_rates", "bot_sessions", "payment_windows",
                "freshness", "stream_payment_windows", "normalize_transactions", "spike_windows"]


@pytest.mark.parametrize("name", TZ_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        test_query_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
