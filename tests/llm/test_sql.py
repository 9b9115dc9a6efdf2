"""Every text query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from galeframe.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        duck.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert columns == sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    a = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
