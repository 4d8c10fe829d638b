"""Scanning by distinct texts, in one pass: what repeats is scanned once, and the code is cut as before."""

from unittest import mock

import pyarrow as pa
import pytest

from catalog_lineage.operators import extract, scan


def test_repeated_texts_are_scanned_once():
    texts = ["a = DB('x', 1);", None, "b = 2;", "a = DB('x', 1);"] * 50
    with mock.patch.object(scan, "calls", wraps=scan.calls) as calls, mock.patch.object(scan.F, "arrow_udf", lambda kind: lambda f: lambda c: f):
        run = scan.call_rows(None, "DB")
        rows = next(run(iter([pa.array(texts, pa.string())]))).to_pylist()
    assert calls.call_count == 2
    assert rows[0] == rows[3] == [{"name": "DB", "call": "DB('x', 1)", "line": 1, "arguments": ["'x'", "1"]}] and rows[2] == [] and not rows[1]


@pytest.mark.parametrize("text, expected", [
    ("DB(a, F(b, (c, d)), ',')", [["a", "F(b, (c, d))", "','"]]), ("DB()", [[]]), ("DB( )", [[]]), ("DB( , )", [["", ""]]),
    (") DB(DB(x), 'y'", [["x"]]), ("XDB(1) DB2(2) db\n(3)", [["3"]]), ("DB(1, 'open)", []),
])
def test_arguments_come_with_the_scan(text, expected):
    assert [c[3] for c in scan.calls(text, scan.name_pattern("DB"))] == expected


def test_statements_in_parentheses_stay_whole():
    assert scan.statements("f(a; b); c; d(e; (f; g)", True) == [("f(a; b);", 0), (" c;", 0), (" d(e; (f; g)", 0)]
    assert scan.statements("f(a; b); c; d(e; (f; g)", False) == [("f(a; b);", 0), (" c;", 0), (" d(e;", 0), (" (f; g)", 0)]


def test_rules_are_scanned_once_for_their_profile(spark):
    rules = spark.createDataFrame([(f"c{i}", "['x'] = DB('a', !B);") for i in range(8)], "cube_name string, rule_text string")
    read = []
    real = extract.discovered_calls
    with mock.patch.object(extract, "cut", side_effect=lambda df: read.append(df) or extract.asof_last.__globals__["cut"](df)), \
            mock.patch.object(extract, "discovered_calls", side_effect=real) as scans:
        row = extract.function_coverage(rules).first()
    assert scans.call_count == len(read) == 1 and (row.function_name, row.occurrence_count, row.cube_count) == ("DB", 8, 8)
