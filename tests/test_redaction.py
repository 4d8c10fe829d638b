import duckdb
import pytest

import checks

checks.load()

#: Texts on which engines differ: blank ones, vertical tabs, letters that fold to s and k only in Unicode, doubled quotes.
TEXTS = [
    None, "", " \n", "\x0b", "pwd\x0b=x", "pwd=\x0b", "token\x0bx", "secret = a\x0bb c", "toKen: x", "ſecret=y", "paſſword z", "api-Key='a;b' c",
    "apıkey=x", "authorİzation: x", "Password = 'a b'; x", "PASSWD=\"\"", "token = x", "pwd: x", "secret=\x1cx", "token=$1\\1", "x" * 170 + "pwd=1", "pwd=" + "é" * 200,
]


@pytest.mark.parametrize("name", ["redact_secrets"])
def test_odd_texts_agree_with_sql(spark, tmp_path, name):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = db.sql(checks.ORACLES[name])
    got = sorted(checks.QUERIES[name](spark, str(tmp_path)).select(*expected.columns).collect())
    assert [tuple(r) for r in got] == sorted(expected.fetchall())
