"""Every query that has a DuckDB statement gives its rows on the small tables."""

import math

import duckdb
import pytest

from quayside.llm import queries as Q

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def same(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_gives_the_rows_of_its_statement(spark, duck, name):
    df = Q.QUERIES[name](spark, SMALL)
    rel = duck.sql(Q.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted((tuple(same(r[c]) for c in cols) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(same(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
