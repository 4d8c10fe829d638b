"""The object graph: unique objects are not grouped, relationships are grouped and counted in one go before two lookups."""

from catalog_lineage.plans import objects


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_repeated_objects_are_grouped(spark):
    rows = [("cube::A", "CUBE", "A", "x", None), ("cube::B", "CUBE", "B", None, None), (None, "CUBE", " ", None, None)]
    again = [(" cube::A ", "CUBE", "B", None, "y"), ("cube::A", "CUBE", "C", "z", None)]
    frame = lambda data: spark.createDataFrame(data, "node_id string, node_type string, object_name string, first string, second string")
    unique = objects.catalog_objects(frame(rows))
    assert "Aggregate" not in plan_of(unique) and "Generate" not in plan_of(unique)
    assert {r.object_id: r.display_name for r in unique.collect()} == {"cube::A": "A", "cube::B": "B"}
    got = {r.object_id: (r.display_name, r.properties) for r in objects.catalog_objects(frame(rows + again)).collect()}
    assert got == {"cube::A": ("A", {"first": "z", "node_id": "cube::A", "node_type": "CUBE", "object_name": "C", "second": "y"}),
                   "cube::B": ("B", {"node_id": "cube::B", "node_type": "CUBE", "object_name": "B"})}


def test_relationships_are_counted_with_their_group(spark):
    nodes = spark.createDataFrame([("cube::A", "CUBE", "A"), ("CUBE::A", "CUBE", "A"), ("p", "PROCESS", "p")], "node_id string, node_type string, object_name string")
    hot = [(f"e{i:03}", "cube::A", "R", "p", "VALID") for i in range(90)]
    rest = [("e000", "cube::A", "R", "p", "DYNAMIC"), ("e001", "CUBE::A", "r", "p", "VALID"), ("f", "CUBE::A", "R", "p", "PLANNED"), (None, "p", "R", "cube::A", None), ("g", "p", "R", "gone", "VALID")]
    edges = spark.createDataFrame(hot + rest, "graph_relationship_id string, source_id string, relationship_type string, target_id string, endpoint_state string")
    none = spark.createDataFrame([], "process_name string, source_type string, shared_source_id string")
    g = objects.object_graph(nodes, edges, none)
    assert plan_of(g.relationships).count("Join") == 2
    got = {(r.source_object_id, r.target_object_id): (r.evidence_count, r.validation_status, r.generated) for r in g.relationships.collect()}
    # the id ignores letter case, so both ways of writing it have the edges of both
    assert got == {("cube::A", "p"): (91, "DYNAMIC", False), ("CUBE::A", "p"): (91, "VALID", False), ("p", "cube::A"): (1, "VALID", False)}
    assert [(r.source_object_id, r.target_object_id) for r in g.errors.collect()] == [("p", "gone")] and g.links.count() == 93
