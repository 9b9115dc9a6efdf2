"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from galeframe.plans.registry import ORACLE_SQL, QUERIES, load

load()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 8) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    want = duck.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    a = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
