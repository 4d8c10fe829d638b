"""Every registered query gives the rows of its SQL, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import checks
from checks.roles import TABLES

checks.load()
SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def tidy(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(checks.ORACLES))
def test_query_agrees_with_sql(spark, db, name):
    df = checks.QUERIES[name](spark, SF)
    expected = db.sql(checks.ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    order = sorted(df.columns)
    at = [expected.columns.index(c) for c in order]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got = sorted((tuple(tidy(r[c]) for c in order) for r in df.collect()), key=key)
    want = sorted((tuple(tidy(r[i]) for i in at) for r in expected.fetchall()), key=key)
    assert got == want
