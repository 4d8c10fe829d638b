"""Plans that grew with the rows: tests written out for every name, wide rows shuffled again."""

from catalog_lineage.operators import resolve
from catalog_lineage.plans import graph


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_are_tested_once_as_a_list(spark):
    names = ("cube_name", "dimension_name", "hierarchy_name", "attribute_name", "subset_name", "view_name")
    refs = spark.createDataFrame([("VIEW", "READS", "c.v", "c", "", "", "", "", "v"), ("VIEW", "READS", "x", "sVar", "", "", "", "", "v")], ["domain", "relationship_type", "target_name", *names])
    candidates = spark.createDataFrame([("VIEW", "view::c::v", "c", "", "v", False)], "domain string, node_id string, parent_key string, hierarchy_key string, own_key string, is_default boolean")
    matched = resolve.match_candidates(refs, candidates)
    assert plan_of(matched).count("[snpv]") == 1
    assert {r.cube_name: r.match_classification for r in matched.collect()} == {"c": "EXACT_MATCH", "sVar": "DYNAMIC_REFERENCE"}


def test_wide_rows_of_the_projection_are_written_before_ids_are_counted(spark, monkeypatch):
    written, real = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: written.append(df) or real(df))
    semantic = spark.createDataFrame([("s1", "p", "READS", "CUBE", "A", "VALID", "PARSER_PRESERVED", "m"), ("s2", "p", "READS", "CUBE", "B", "VALID", "PARSER_PRESERVED", "m")],
                                     "semantic_validation_id string, process_name string, relationship_type string, domain string, target_name string, semantic_validation_status string, decision_type string, resolution_method string")
    relationships = spark.createDataFrame([(1, "p", "READS", "CUBE", "A"), (2, "p", "READS", "CUBE", "B")], "position int, process_name string, relationship_type string, target_type string, target_name string")
    nodes = spark.createDataFrame([("cube::A", "CUBE")], "node_id string, node_type string")
    p = graph.project_semantic("TI", "TI", semantic, relationships, nodes)
    wide = next(df for df in written if "projection_outcome" in df.columns)
    assert "_first" not in plan_of(wide)
    assert p.kept.select("graph_relationship_id").distinct().count() == p.kept.count() == 2
    assert p.outcomes.where("projection_outcome = 'ERROR'").count() == p.outcomes.count() - 2 == 0
