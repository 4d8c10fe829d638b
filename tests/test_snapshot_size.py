"""The catalog snapshot: relationships are grouped once and written, evidence needs no lookup of its source."""

from catalog_lineage.operators import summarize
from catalog_lineage.plans import snapshot

ROWS = "lineage_source string, source_type string, source_name string, relationship_type string, target_type string, target_name string, target_expression string, confidence string, reference_count bigint, procedures array<string>, functions array<string>, evidence_lines array<int>"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_relationships_are_grouped_once_and_evidence_is_not_joined(spark):
    objects = spark.createDataFrame([("cube", "Sales", 1), ("cube", "SALES", 2), ("process", "Load", 3)], "object_type string, object_name string, seq int")
    row = lambda source, target, count, function, expression="'x'": ("TI", "process", source, "READS_FROM_CUBE", "cube", target, expression, "CONFIRMED", count, ["Data"], [function], [7])
    rows = spark.createDataFrame([row("Load", "sales", 2, "F"), row("LOAD", " Sales", 5, "F"), row("load", "sales", 3, "G"), row("Load", None, 1, "F"), row("Load", " ", 1, "F"), row("New", "gone", 1, "F")], ROWS)
    s = snapshot.catalog_snapshot(objects, rows, rows, rows, "test", "main", "run")
    assert "Aggregate" not in plan_of(s.relationships) and "Join" not in plan_of(s.evidence)
    got = {(r.source_qualified_name, r.target_qualified_name): r for r in s.relationships.collect()}
    assert set(got) == {("process::Load", "cube::Sales"), ("process::Load", "cube::<blank target>"), ("process::New", "cube::gone")}
    hit = got["process::Load", "cube::Sales"]
    assert (hit.reference_count, hit.aggregated_row_count, hit.functions, hit.confidence, hit.validation_status) == (8, 3, ["F", "G"], "RESOLVED", "VALID")
    ids = {r.qualified_name: r.object_id for r in s.objects.collect()}
    assert hit.source_object_id == ids["process::Load"] and hit.target_object_id == ids["cube::Sales"]
    assert {r.source_object_id for r in s.evidence.collect()} == {ids["process::Load"], ids["process::New"]}
    assert {r.relationship_id: r.source_validation_record_count for r in s.validations.where("relationship_id is not null").collect()} == {r.relationship_id: r.aggregated_row_count for r in got.values()}


def test_consolidation_of_repeats_and_missing_values(spark):
    rows = [("a", "m", 2, ["q", "p"], ["x"], [1]), ("a", "m", 7, ["p", "q"], ["x"], [1]), ("a", "n", 3, ["p", None], None, [2]), ("a", "m", None, ["p", "q"], ["x"], [1]), ("b", None, None, [], [], []), ("c", "m", 4, ["z", "z"], ["y"], None)]
    edges = spark.createDataFrame(rows, "relationship_id string, discovery_method string, reference_count int, functions array<string>, procedures array<string>, evidence_lines array<int>")
    got = {r.relationship_id: (r.reference_count, r.aggregated_row_count, r.discovery_methods, r.functions, r.procedures, r.evidence_lines) for r in summarize.consolidate(edges).collect()}
    assert got == {"a": (10, 4, ["m", "n"], ["p", "q"], ["x"], [1, 2]), "b": (None, 1, [], None, None, None), "c": (4, 1, ["m"], ["z"], ["y"], [])}
