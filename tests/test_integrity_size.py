"""Ids are counted, and parents met, in a given number of parts: not in a hash table over a whole split or in a lookup table."""

from catalog_lineage.operators import resolve, window


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_are_dealt_before_they_are_counted(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), (" ",), (" ",), (None,), (None,)], "object_id string")
    found = window.duplicate_ids(rows, "object_id")
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 1 and f", {window.dealt_parts(rows)})" in plan.replace(", REPARTITION_BY_NUM", ")")
    assert [tuple(r) for r in found.collect()] == [("a", 2)]


def test_parents_are_merged_in_given_parts(spark):
    child = spark.createDataFrame([("1", "a"), ("2", "x"), ("3", ""), ("4", None), ("5", "b")], "relationship_id string, source_id string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "node_id string")
    found = resolve.orphans(child, parent, "source_id", "node_id")
    assert "BroadcastHashJoin" not in plan_of(found) and "REPARTITION_BY_NUM" in plan_of(found)
    assert [r.relationship_id for r in found.collect()] == ["2"]
