"""The parsing traps: Python's strip/float/int/bool grammar, not Spark's casts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions import cleaning as C


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr("v").alias("r")).collect()[0]["r"]


def test_clean_strips_all_unicode_whitespace(spark):
    assert _one(spark, C.clean, "\t  x \n　") == "x"
    assert _one(spark, C.clean, " \t ") is None
    assert _one(spark, C.clean, "") is None
    assert _one(spark, C.clean, None) is None


def test_lower_and_upper_defaults(spark):
    assert _one(spark, C.lower_clean, " DESKTOP ") == "desktop"
    assert _one(spark, C.upper_or_empty, " br") == "BR"
    assert _one(spark, C.upper_or_empty, "  ") == ""  # missing country -> '' not NULL


@pytest.mark.parametrize("text,expected", [("True", True), (" yes ", True), ("1", True),
                                           ("FALSE", False), ("no", False), ("0", False),
                                           ("", None), (None, None)])
def test_parse_bool_grammar(spark, text, expected):
    assert _one(spark, C.parse_bool, text) is expected


@pytest.mark.parametrize("text", ["t", "y", "maybe"])
def test_parse_bool_rejects_what_spark_cast_accepts(spark, text):
    with pytest.raises(Exception, match="invalid boolean"):
        _one(spark, C.parse_bool, text)
    assert _one(spark, lambda c: C.parse_bool(c, strict=False), text) is None


def test_parse_float_grammar(spark):
    assert _one(spark, C.parse_float, " 249.90 ") == 249.9
    assert _one(spark, C.parse_float, "1_000") == 1000.0
    assert _one(spark, C.parse_float, "1e3") == 1000.0
    assert _one(spark, C.parse_float, "") is None
    with pytest.raises(Exception, match="invalid number"):
        _one(spark, C.parse_float, "1d")  # Spark's cast would accept it


def test_parse_int_rejects_decimal_text(spark):
    assert _one(spark, C.parse_int, "42") == 42
    with pytest.raises(Exception, match="invalid integer"):
        _one(spark, C.parse_int, "1.0")


def test_is_late_is_strict(spark):
    from quayside.operators.normalize import normalize_transactions
    base = dict(transaction_id="t", booking_ref="", partner_id="p", user_id="", amount="1.00",
                currency="brl", status="OK", payment_method="", gateway="", retry_count="",
                error_code="", notes="", processing_ms="")
    rows = [dict(base, created_at="2025-03-01 00:00:00", ingest_ts="2025-03-08 00:00:00"),
            dict(base, transaction_id="u", created_at="2025-03-01 00:00:00", ingest_ts="2025-03-08 00:00:01")]
    out = {r["transaction_id"]: r for r in normalize_transactions(spark.createDataFrame(rows), 7).collect()}
    assert out["t"]["is_late"] is False  # exactly seven days is on time
    assert out["u"]["is_late"] is True
    assert out["t"]["currency"] == "BRL" and out["t"]["status"] == "ok"
    assert out["t"]["ingest_date"] == dt.date(2025, 3, 8)


def test_csv_scan_reads_quoted_json_and_blanks(spark, scratch, tmp_path):
    from quayside.sources.csv_feed import scan_csv
    path = tmp_path / "feed.csv"
    path.write_text('id,notes,other\n1,"{""legacy_id"":12,""x"":""a,b""}",\n2,,""\n', encoding="utf-8")
    rows = {r["id"]: r for r in scan_csv(spark, str(path), ["id", "notes", "other"]).collect()}
    assert rows["1"]["notes"] == '{"legacy_id":12,"x":"a,b"}'
    assert rows["1"]["other"] == "" and rows["2"]["notes"] == "" and rows["2"]["other"] == ""


def test_csv_scan_checks_header_names(spark, tmp_path):
    from quayside.sources.csv_feed import scan_csv
    path = tmp_path / "feed.csv"
    path.write_text("a,b\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception):
        scan_csv(spark, str(path), ["a", "c"]).collect()


def test_no_python_udf_in_curated_plan(spark):
    from quayside.plans.flows import Feeds
    from tests.conftest import SMALL_SF
    plan = Feeds(spark, SMALL_SF).events()._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


@pytest.mark.parametrize("text,expected", [
    ("2024-01-02", dt.datetime(2024, 1, 2)), ("2024-01-02 03:04", dt.datetime(2024, 1, 2, 3, 4)),
    ("2024-01-02T03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02 03:04:05.25", dt.datetime(2024, 1, 2, 3, 4, 5, 250000)),
    ("", None), (None, None)])
def test_iso_timestamps(spark, text, expected):
    assert _one(spark, C.parse_timestamp, text) == expected


@pytest.mark.parametrize("text", ["2024", "2024-01", "2024-1-2", "2024-01-02T03:04:05+03:00", "2024-01-02T03:04:05Z", "yesterday",
                                  "2024-13-01", "2024-02-30 00:00:00", "2024-01-02 25:00:00"])
def test_partial_zoned_and_impossible_timestamps_are_errors(spark, text):
    with pytest.raises(Exception):  # noqa: B017 - the rule's own error or the cast's
        _one(spark, C.parse_timestamp, text)
    assert _one(spark, lambda c: C.parse_timestamp(c, strict=False), text) is None


def test_numbers_out_of_range_are_null_when_lenient(spark):
    for parse in (lambda c: C.parse_int(c, "int", False), lambda c: C.parse_decimal(c, 18, 2, False)):
        assert _one(spark, parse, "9" * 25) is None


def test_plain_texts_are_not_stripped_and_odd_ones_parse_as_before(spark):
    """The forms with and without the short way, over texts on either side of it."""
    texts = ["12", "-3", "+4.50", " 7 ", "8\n", "9\u2028", "\u00a05", "1_000", "1_0.5", ".5", "2.", "1e3", "inf", "", "  ", "\x1c", None, "abc",
             "1d", "_1", "12 3", "\u0663", "2024-01-02", "2024-01-02\n", "2024-01-02 03:04", " 2024-01-02T03:04:05.6", "2024", "True", "TRUE ",
             " no", "0", "nope", "\u00e9", "\u00e9t\u00e9 ", "x\u3000", "a b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    v = F.nullif(F.btrim("v", F.lit(C.WHITESPACE)), F.lit(""))
    guarded = lambda pattern, text, kind: F.when(v.rlike(pattern), text.try_cast(kind))
    number = F.regexp_replace(v, "_", "")
    pairs = {"clean": (C.clean("v"), v), "float": (C.parse_float("v", False), guarded(C.FLOAT_PATTERN, number, "double")),
             "money": (C.parse_decimal("v", strict=False), guarded(C.FLOAT_PATTERN, number, "decimal(18,2)")),
             "int": (C.parse_int("v", strict=False), guarded(C.INT_PATTERN, number, "int")),
             "time": (C.parse_timestamp("v", False), guarded(C.ISO_PATTERN, v, "timestamp_ntz")),
             "date": (C.parse_date("v", False), guarded(C.DATE_PATTERN, v, "date")),
             "bool": (C.parse_bool("v", False), F.when(F.lower(v).isin(*C.TRUE_WORDS), True).when(F.lower(v).isin(*C.FALSE_WORDS), False))}
    for name, (new, old) in pairs.items():
        assert df.select(new.alias("r")).schema["r"].dataType == df.select(old.alias("r")).schema["r"].dataType
        assert [r for r in df.select("v", new.alias("a"), old.alias("b")).collect() if str(r.a) != str(r.b)] == [], name
    plan = df.select(C.parse_int("v"), C.clean("v"), C.parse_bool("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_common_expr" not in plan  # nothing is stripped ahead of the short way
