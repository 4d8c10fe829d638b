"""Every query of the subpackage that has SQL gives the same rows."""

import math

import duckdb
import pytest

from catalog_lineage.llm import registry

SF = "/root/testdata/sf0.001"


def tidy(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_agrees_with_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    expected = db.sql(registry.ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(expected.columns)
    at = [expected.columns.index(c) for c in order]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got = sorted((tuple(tidy(r[c]) for c in order) for r in df.collect()), key=key)
    assert got == sorted((tuple(tidy(r[i]) for i in at) for r in expected.fetchall()), key=key)
