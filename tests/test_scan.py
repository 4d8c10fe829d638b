"""Scanners of code text: nesting of any depth, long texts, long chains of assignments."""

import pytest
from pyspark.sql import functions as F

from catalog_lineage import vocab
from catalog_lineage.operators import extract, scan


@pytest.mark.parametrize("depth", [1, 16, 17, 40, 500])
def test_depth_of_nesting_does_not_matter(spark, depth):
    inner = "(" * depth + "x" + ")" * depth
    line = f"a = DB{inner}; b = 2; c = 'DB(1)';"
    df = spark.createDataFrame([(1, line)], "line_number int, line_text string")
    calls = extract.extract_calls(df, ["DB"]).collect()
    assert [(r.function_name, r.call_text) for r in calls] == [("DB", "DB" + inner)]
    code = df.select(F.col("line_text").alias("code"))
    assert [r.statement for r in extract.explode_statements(code).orderBy("statement_position").collect()] == [f"a = DB{inner};", "b = 2;", "c = 'DB(1)';"]
    assert scan.concat_parts(f"a | F{inner} | 'x|y'") == ["a", f"F{inner}", "'x|y'"]
    found = extract.discovered_calls(df.select(F.lit("c").alias("cube_name"), F.col("line_text").alias("rule_text"))).collect()
    assert [(r.function_name, r.is_complete) for r in found] == [("DB", True)]


def test_nested_calls_are_all_found():
    names = scan.name_pattern("DB|ATTRS")
    text = "DB(" * 60 + "1" + ")" * 60
    assert len(scan.calls(text, names)) == 60
    assert scan.calls("DB (1,\n ATTRS('a(', 2)) DB(3", names) == [("DB", "DB (1,\n ATTRS('a(', 2))", 1, ["1", "ATTRS('a(', 2)"]), ("ATTRS", "ATTRS('a(', 2)", 2, ["'a('", "2"])]
    assert [c[1] for c in scan.calls("DB(3; DB(1)", names, complete=False)] == [None, "DB(1)"]


def test_open_parenthesis():
    assert scan.statements("a; b(c; d", True) == [("a;", 0), (" b(c; d", 0)]
    assert scan.statements("a;\n b(c; d", False) == [("a;", 0), ("\n b(c;", 0), (" d", 1)]
    assert scan.statements("x = 'a;", True) == [("x = 'a;", 0)]
    assert scan.concat_parts("a | b(c | 'd'") == ["a", "b(c", "'d'"]


def test_long_text(spark):
    text = "\n".join(f"v{i} = DB(v{i - 1}, 'x;');" for i in range(100_000))
    rows = extract.explode_statements(spark.createDataFrame([(text,)], "code string"))
    last = rows.orderBy(F.desc("statement_position")).first()
    assert rows.count() == 100_000 and last.statement == "v99999 = DB(v99998, 'x;');" and last.statement_line == 99_999


def test_chain_of_a_thousand_assignments(spark):
    chain = ["s = 'a'"] + [f"s = s | '{i % 10}'" for i in range(1000)] + ["DB(s, t)", "s = STR(1)", "DB(s, 'c')"]
    code = spark.createDataFrame([("p", "prolog", "\n".join(chain))], "process_name string, procedure string, code string")
    lines = extract.explode_lines(code).withColumn("seq", F.col("line_number"))
    uses = spark.createDataFrame([(1, "p", 500, "s"), (2, "p", 1001, " s "), (3, "p", 1003, "s"), (4, "q", 1001, "s"), (5, "p", 1, "'l''t'")], "use_id int, process_name string, seq int, expression string")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    got = {r.use_id: (r.resolved_value, r.confidence) for r in extract.resolve_expressions(extract.assignments(lines), uses).collect()}
    assert len(jobs.getJobIdsForGroup("chain")) <= 6
    digits = "".join(str(i % 10) for i in range(1000))
    assert got == {"1": ("a" + digits[:499], "RESOLVED"), "2": ("a" + digits, "RESOLVED"), "3": ("s", "UNRESOLVED"), "4": ("s", "UNRESOLVED"), "5": ("l't", "CONFIRMED")}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_process_evidence_of_a_long_chain(spark):
    chain = ["sCube = 'Cube'"] + ["sCube = sCube | '_'"] * 200 + ["x = CELLGETN(sCube, 'm');"]
    code = spark.createDataFrame([("p", "prolog", "\n".join(chain))], "process_name string, procedure string, code string")
    rows = extract.process_evidence(code, vocab.code_registry(spark)).collect()
    assert [(r.target_name, r.confidence, r.line_number) for r in rows] == [("Cube" + "_" * 200, "RESOLVED", 202)]
