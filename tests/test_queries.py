"""Registered queries against their SQL, at the smallest scale."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import TABLES, rows_of  # noqa: E402

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n in ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_every_analytics_query_has_sql():
    from eventmart.workload.queries import QUERIES

    assert set(QUERIES) <= set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 5
