"""CSV feeds are read by the names in their header, and landed without loss."""

import pytest

from quayside.sources.csv_feed import scan_csv, write_csv


def _land(tmp_path, text, name="feed.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns_go_by_name_in_any_order(spark, tmp_path):
    path = _land(tmp_path, "b,extra,a\n2,x,1\n4,y,3\n")
    assert _rows(scan_csv(spark, path, ["a", "b"])) == [("1", "2"), ("3", "4")]


def test_short_and_long_rows_and_missing_columns(spark, tmp_path):
    path = _land(tmp_path, 'a,b,c\n1,2\n3\n4,5,6,7\n"","",\n')
    assert _rows(scan_csv(spark, path, ["a", "c", "new"], optional=["new"])) == [("", "", ""), ("1", "", ""), ("3", "", ""), ("4", "6", "")]


def test_quoted_newlines_when_asked_for(spark, tmp_path):
    path = _land(tmp_path, 'a,b\n1,"two\nlines ""q"""\n')
    assert _rows(scan_csv(spark, path, ["a", "b"], multiline=True)) == [("1", 'two\nlines "q"')]


def test_a_foreign_header_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        scan_csv(spark, _land(tmp_path, "x,y\n1,2\n"), ["a", "b"])


def test_landing_keeps_blanks_and_quotes(spark, scratch):
    rows = [("  x ", '{"k": "v"}', ""), ("", " ", "a,b"), ("tail\t", "é", '"')]
    path = scratch("csv")
    write_csv(spark.createDataFrame(rows, "a string, b string, c string"), path)
    assert _rows(scan_csv(spark, path, ["a", "b", "c"])) == sorted(rows)


@pytest.mark.parametrize("second", ["b,a\n4,3\n", "a,b,new\n3,4,5\n", "a\n3\n"])
@pytest.mark.parametrize("multiline", [False, True])
def test_files_with_another_header_are_refused(spark, tmp_path, second, multiline):
    _land(tmp_path, "a,b\n1,2\n", "1.csv")
    same = tmp_path / "2.csv"
    same.write_text("a,b\n3,4\n")
    assert _rows(scan_csv(spark, str(tmp_path), ["b", "a"], multiline)) == [("2", "1"), ("4", "3")]
    same.write_text(second)
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, str(tmp_path), ["a"], multiline, optional=["new"]).collect()
