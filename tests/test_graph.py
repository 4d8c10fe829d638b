import pytest
from pyspark.sql import functions as F

from catalog_lineage import vocab
from catalog_lineage.operators import resolve, summarize, traverse
from catalog_lineage.sources import io

EDGE = "graph_relationship_id string, source_id string, target_id string, relationship_type string, endpoint_state string"


def edges(spark):
    rows = [("e1", "process::P", "cube::A", "READS_FROM_CUBE", "CANONICAL"), ("e2", "process::P", "cube::B", "WRITES_TO_CUBE", "CANONICAL"),
            ("e3", "process::P", "planned::X", "WRITES_TO_CUBE", "PLANNED"), ("e4", "chore-task::T", "process::P", "CALLS_PROCESS", "CANONICAL")]
    return spark.createDataFrame(rows, EDGE)


def test_outbound_neighborhood(spark):
    found = traverse.neighborhood(edges(spark), "process::P", "outbound", 1)
    assert found.edges.count() == 3 and found.nodes.count() == 4 and not found.truncated


def test_back_steps_are_flagged_cycles(spark):
    capped = traverse.impact(edges(spark), "cube::A", "both", 3)
    whole = traverse.impact(edges(spark), "cube::A", "both", 3, max_nodes=None, max_edges=None)
    shape = lambda t: sorted((tuple(r["node_ids"]), tuple(r["relationship_ids"]), r["cycle"]) for r in t.paths.collect())
    assert shape(capped) == shape(whole) and any(c for _, _, c in shape(whole)) and capped.nodes.count() == 5


def test_caps_truncate_in_order(spark):
    found = traverse.neighborhood(edges(spark), "process::P", "both", 1, max_nodes=3, max_edges=10)
    assert found.truncated and sorted(r[0] for r in found.nodes.collect()) == ["cube::A", "cube::B", "process::P"]
    found = traverse.neighborhood(edges(spark), "process::P", "both", 1, max_nodes=10, max_edges=1)
    assert found.truncated and [r[0] for r in found.edges.collect()] == ["e1"]


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        traverse.neighborhood(edges(spark), "x", "sideways", 1)
    with pytest.raises(ValueError):
        traverse.neighborhood(edges(spark), "x", "both", 6)


def test_planned_edges_are_dotted(spark):
    none = spark.createDataFrame([], "graph_relationship_id string, validation_status string")
    view = {r["id"]: r["line_style"] for r in resolve.edge_view(edges(spark), vocab.edge_semantics(spark), none, none).collect()}
    assert view["e3"] == "dotted" and view["e1"] == "solid"


def test_same_view_name_in_two_cubes(spark):
    objects = spark.createDataFrame([("v1", "VIEW", {"cube_name": "A", "view_name": "V"}), ("v2", "VIEW", {"cube_name": "B", "view_name": "V"})], "object_id string, object_type string, properties map<string,string>")
    refs = spark.createDataFrame([("VIEW", "b", "v"), ("VIEW", "A", "W"), ("VIEW", "", "V")], "reference_kind string, cube_name string, view_name string")
    got = sorted((r["cube_name"], r["resolution_status"], r["resolved_target_object_id"]) for r in resolve.resolve_references(refs, objects).collect())
    assert got == [("", "INSUFFICIENT_CONTEXT", None), ("A", "TARGET_NOT_IN_PUBLIC_CATALOG", None), ("b", "CANONICAL_EXACT_MATCH", "v2")]


def test_partial_run_leaves_current_alone(spark, tmp_path):
    root, df = str(tmp_path / "out"), spark.range(3)
    none = spark.createDataFrame([], "error string")
    io.publish({"t": df}, none, root, "one")
    state = io.publish({"t": df}, spark.createDataFrame([("bad",)], "error string"), root, "two").collect()[0]
    assert state["status"] == "PARTIAL" and not state["published_current"]
    assert io.current_snapshot(spark, root) == "one" and io.read_current(spark, root, ["t"])["t"].count() == 3


def test_reading_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": "x"}, {"n": "y"}]')
    (tmp_path / "w.json").write_text('{"count": 1, "items": [{"n": "z"}]}')
    (tmp_path / "bad.json").write_text('[{"n": "x"}, 7]')
    read = lambda name, **kw: sorted(r["n"] for r in io.read_records(spark, str(tmp_path / name), "n string", **kw).collect())
    assert read("a.json") == ["x", "y"] and read("a.json", wrapper_keys=("items",)) == ["x", "y"] and read("w.json", wrapper_keys=("objects", "items")) == ["z"]
    assert read("none.json", required=False) == []
    with pytest.raises(FileNotFoundError):
        read("none.json")
    with pytest.raises(Exception):
        read("bad.json")


def test_impact_behaviour_comes_from_the_semantics(spark):
    from catalog_lineage import vocab
    from catalog_lineage.operators import resolve

    edges = spark.createDataFrame([("1", "a", "b", "references_view", None), ("2", "a", "c", "CALLS", None)], "graph_relationship_id string, source_id string, target_id string, relationship_type string, endpoint_state string")
    none = spark.createDataFrame([], "graph_relationship_id string, validation_status string")
    behaviour = lambda semantics: {r.id: (r.impact_behavior, r.category) for r in resolve.edge_view(edges, semantics, none, none).collect()}
    assert behaviour(vocab.object_edge_semantics(spark)) == {"1": ("UPSTREAM_DEPENDENCY", "REFERENCE"), "2": ("EDGE_DIRECTION", "OTHER")}
    assert behaviour(vocab.edge_semantics(spark)) == {"1": ("EDGE_DIRECTION", "OTHER"), "2": ("EDGE_DIRECTION", "OTHER")}


def test_a_node_without_edges_has_a_summary(spark):
    from catalog_lineage.operators import traverse

    nodes = spark.createDataFrame([("cube::a", "CUBE", "a"), ("cube::b", "CUBE", "b")], "node_id string, node_type string, object_name string")
    edges = spark.createDataFrame([("1", "cube::a", "cube::c", "R")], "graph_relationship_id string, source_id string, target_id string, relationship_type string")
    alone, tied = traverse.node_summary(nodes, edges, "cube::b").collect(), traverse.node_summary(nodes, edges, "cube::a").collect()
    assert [(r.label, r.inbound_count, r.other_id) for r in alone] == [("b", 0, None)] and [(r.outbound_count, r.other_id) for r in tied] == [(1, "cube::c")]


def test_a_page_past_the_last_hit_keeps_the_totals(spark):
    from catalog_lineage.operators import window

    nodes = spark.createDataFrame([("cube::a1", "CUBE", "a1"), ("view::a2", "VIEW", "a2"), ("cube::b", "CUBE", "b")], "node_id string, node_type string, label string")
    last = window.search(nodes, "a", node_type="cube", offset=5).collect()
    assert [(r.node_id, r.total, r.type_counts) for r in last] == [(None, 1, {"CUBE": 1, "VIEW": 1})]


def scanned(df):
    """Rows that the scans of a plan handed on, of which skipped row groups are no part."""
    def visit(plan):
        kind = plan.nodeName()
        if kind.startswith("AdaptiveSparkPlan"):
            return visit(plan.executedPlan())
        if "QueryStage" in kind:
            return visit(plan.plan())
        if kind.startswith("ReusedExchange"):
            return 0
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        return sum(map(visit, children)) if children else plan.metrics().apply("numOutputRows").value() if kind.startswith("Scan parquet") else 0

    df.collect()
    return visit(df._jdf.queryExecution().executedPlan())


def test_point_queries_skip_most_of_a_published_graph(spark, tmp_path):
    from catalog_lineage.operators import traverse

    n = 60_000
    edges = spark.range(n).selectExpr("concat('e', lpad(id * 7919 % 60000, 6, '0')) as graph_relationship_id", "concat('s', id % 5000) as source_id", "concat('t', id % 4999) as target_id", "'R' as relationship_type")
    nodes = edges.selectExpr("source_id as node_id", "'PROCESS' as node_type", "source_id as object_name").distinct()
    root = str(tmp_path / "laid")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.publish({"nodes": nodes, "edges": edges}, spark.createDataFrame([], "error string"), root, "one")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tables = io.read_current(spark, root, ["nodes", "edges"])
    assert tables["edges"].count() == n
    by = lambda column, value: tables["edges"].where(F.col(column) == value)
    for column, value in (("graph_relationship_id", "e000017"), ("source_id", "s77"), ("target_id", "t99")):
        found = by(column, value)
        assert 0 < found.count() == edges.where(F.col(column) == value).count()
        assert scanned(found) < 0.5 * n
    assert scanned(by("graph_relationship_id", "e000017")) <= n / 10 and scanned(by("source_id", "s77")) <= n / 10
    summary = traverse.node_summary(tables["nodes"], tables["edges"], "s77")
    assert summary.count() == 12
    assert scanned(summary) < 0.5 * n


def test_lists_of_small_keys_take_one_shuffle(spark):
    """Only keys with more rows than a chunk are counted and dealt; repeats and nulls of the others vanish in their list."""
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", None), (None, "y")] + [("h", f"v{i % 40:02d}") for i in range(200)], "k string, v string")
    small = summarize.chunked_lists(df, "k", "v", "vs")
    assert small._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {r.k: (r.chunk, len(r.vs)) for r in small.collect()} == {"a": (0, 1), "b": (0, 0), "h": (0, 40)}
    cut_up = summarize.chunked_lists(df, "k", "v", "vs", chunk_rows=15).collect()
    assert {r.k: r.vs for r in cut_up if r.k != "h"} == {"a": ["x"], "b": []}
    hot = [r for r in cut_up if r.k == "h"]
    assert len({r.chunk for r in hot}) == 3 and sorted(v for r in hot for v in r.vs) == [f"v{i:02d}" for i in range(40)]


def test_consolidation_takes_one_shuffle(spark):
    """Rows are dealt by relationship once; repeats, nulls and empty lists are as before."""
    schema = "relationship_id string, discovery_method string, functions array<string>, procedures array<string>, evidence_lines array<int>, reference_count bigint"
    rows = [("a", "m", ["g", "f"], ["p"], [3], 2), ("a", "m", ["f", "g"], ["p"], [3], 5), ("a", "k", ["f"], [], [1, None], 1), ("b", "m", [], [], [], 4), (None, "m", ["f"], [], [], 1)]
    got = summarize.consolidate(spark.createDataFrame(rows, schema))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {r.relationship_id: tuple(r)[1:] for r in got.collect()} == {
        "a": (6, 3, ["k", "m"], ["f", "g"], ["p"], [1, 3]), "b": (4, 1, ["m"], None, None, None), None: (1, 1, ["m"], ["f"], [], [])}
