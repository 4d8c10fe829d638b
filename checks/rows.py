"""Windows, ranks, aggregates and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_lineage.functions import text
from catalog_lineage.operators import sets, summarize, window
from . import check
from .columns import PATTERN_SQL, norm, t

LIST = lambda x, order="": f"array_to_string(list_sort(list(DISTINCT {x}) FILTER (WHERE {x} IS NOT NULL)), '|')"

# ---- windows and ranks ------------------------------------------------------------------


@check("first_wins", f"SELECT object_type, object_name, seq FROM (SELECT *, row_number() OVER (PARTITION BY object_type, {norm('object_name')} ORDER BY seq) AS rn FROM v_objects) WHERE rn = 1")
def first_wins(d):
    return window.first_wins_by_name(d.v_objects, ["object_type", "object_name"], "seq").select("object_type", "object_name", "seq")


@check("duplicate_warnings", f"SELECT object_type, object_name, seq, CASE WHEN rn = 1 THEN 'KEPT' ELSE 'DUPLICATE' END AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY object_type, {norm('object_name')} ORDER BY seq) AS rn FROM v_objects)")
def duplicate_warnings(d):
    kept, later = window.split_duplicates(d.v_objects.withColumn("k", text.norm_key("object_name")), ["object_type", "k"], "seq")
    both = kept.withColumn("verdict", F.lit("KEPT")).unionByName(later.withColumn("verdict", F.lit("DUPLICATE")))
    return both.select("object_type", "object_name", "seq", "verdict")


RICH = "SELECT p_name AS node_id, p_partkey AS seq, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS brand, CASE WHEN p_partkey % 5 = 0 THEN p_type END AS kind FROM part"


@check("richest_row", f"SELECT node_id, seq, brand, kind FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY (brand IS NOT NULL)::INT + (kind IS NOT NULL)::INT DESC, seq) AS rn FROM ({RICH})) WHERE rn = 1")
def richest_row(d):
    rows = d.part.select(F.col("p_name").alias("node_id"), F.col("p_partkey").alias("seq"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_brand END").alias("brand"), F.expr("CASE WHEN p_partkey % 5 = 0 THEN p_type END").alias("kind"))
    return window.richest(rows, "node_id", "seq")


@check("merge_properties", """
    WITH e AS (SELECT p_name AS object_id, p_partkey AS seq, 'brand' AS k, p_brand AS v FROM part UNION ALL SELECT p_name, p_partkey, 'size' || CAST(p_partkey % 3 AS STRING), CAST(p_size AS STRING) FROM part)
    SELECT object_id, string_agg(k || '=' || v, ';' ORDER BY k) AS properties FROM (SELECT *, row_number() OVER (PARTITION BY object_id, k ORDER BY seq DESC) AS rn FROM e) WHERE rn = 1 GROUP BY 1""")
def merge_properties(d):
    rows = d.part.select(F.col("p_name").alias("object_id"), F.col("p_partkey").alias("seq"), F.create_map(
        F.lit("brand"), F.col("p_brand"), F.concat(F.lit("size"), (F.col("p_partkey") % 3).cast("string")), F.col("p_size").cast("string")).alias("properties"))
    merged = window.merge_properties(rows, "object_id", "properties", "seq")
    return merged.select("object_id", F.array_join(F.transform(F.map_entries("properties"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("properties"))


@check("ordering_invariant", """
    SELECT conv_id, count(*) AS row_count, count(*) - count(DISTINCT turn) AS duplicate_positions, count(*) - count(DISTINCT member) AS duplicate_members, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS pass FROM v_turns GROUP BY 1""")
def ordering_invariant(d):
    return window.check_positions(d.v_turns, "conv_id", "turn", "member", start=0).select("conv_id", "row_count", "duplicate_positions", "duplicate_members", "pass")


@check("duplicate_ids", """
    SELECT (SELECT count(*) FROM v_validations) AS row_count, (SELECT count(*) FROM v_validations WHERE validation_seq % 55 = 0) AS missing_ids, count(*) FILTER (WHERE n > 1) AS duplicate_ids, CAST(sum(n - 1) AS BIGINT) AS surplus_rows, false AS pass
    FROM (SELECT relationship_id, count(*) AS n FROM v_validations WHERE validation_seq % 55 <> 0 GROUP BY 1)""")
def duplicate_ids(d):
    holes = d.v_validations.withColumn("relationship_id", F.expr("CASE WHEN validation_seq % 55 = 0 THEN ' ' ELSE relationship_id END"))
    return window.identity_check(holes, "relationship_id")


@check("top_k", "SELECT target_expression, count(*) AS relationship_count FROM v_evidence GROUP BY 1 ORDER BY 2 DESC, min(line_number), 1 LIMIT 50")
def top_k(d):
    return window.top_k(d.v_evidence, "target_expression", 50, "line_number")


@check("sample_per_group", """
    SELECT function_name, process_name, CAST(line_number AS BIGINT) AS line_number, target_name, sample_rank FROM (SELECT *, row_number() OVER (PARTITION BY function_name ORDER BY process_name, line_number, target_name) AS sample_rank FROM v_evidence) WHERE sample_rank <= 5""")
def sample_per_group(d):
    rows = d.v_evidence.select("function_name", "process_name", "line_number", "target_name")
    return window.sample_per_group(rows, "function_name", ["process_name", "line_number", "target_name"], 5)


@check("ranked_search", """
    WITH n AS (SELECT upper(object_type) AS node_type, object_name, lower(object_type) || '::' || object_name || '#' || CAST(seq AS STRING) AS node_id FROM v_objects),
    h AS (SELECT *, CASE WHEN lower(object_name) = 'red' THEN 0 WHEN contains(lower(object_name), 'red') THEN 1 ELSE 2 END AS score FROM n WHERE contains(lower(object_name) || ' ' || lower(node_id), 'red')),
    f AS (SELECT string_agg(node_type || '=' || CAST(k AS STRING), '|' ORDER BY node_type) AS type_counts FROM (SELECT node_type, count(*) AS k FROM h GROUP BY 1)),
    page AS (SELECT 'all' AS kind, *, (SELECT count(*) FROM h) AS total FROM (SELECT * FROM h ORDER BY score, lower(object_name), node_id LIMIT 40 OFFSET 5)
      UNION ALL SELECT 'cube', *, (SELECT count(*) FROM h WHERE node_type = 'CUBE') FROM (SELECT * FROM h WHERE node_type = 'CUBE' ORDER BY score, lower(object_name), node_id LIMIT 25)),
    whole AS (SELECT kind, node_type, object_name, node_id, CAST(score AS BIGINT) AS score, total FROM page
      UNION ALL SELECT 'cube', NULL, NULL, NULL, NULL, 0 WHERE NOT EXISTS (SELECT 1 FROM h WHERE node_type = 'CUBE'))
    SELECT whole.*, type_counts FROM whole, f""")
def ranked_search(d):
    nodes = d.v_objects.select(F.upper("object_type").alias("node_type"), "object_name", F.concat(F.lower("object_type"), F.lit("::"), "object_name", F.lit("#"), F.col("seq").cast("string")).alias("node_id"))
    shown = F.array_join(F.transform(F.map_entries("type_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|").alias("type_counts")
    page = lambda kind, **a: window.search(nodes, " RED ", label="object_name", **a).select(F.lit(kind).alias("kind"), "node_type", "object_name", "node_id", "score", "total", shown)
    return page("all", limit=40, offset=5).unionByName(page("cube", node_type="cube"))


# ---- aggregates ------------------------------------------------------------------------------

RANK = "CASE confidence WHEN 'CONFIRMED' THEN 4 WHEN 'RESOLVED' THEN 3 ELSE 1 END"


@check("summarize_evidence", f"""
    SELECT process_name, relationship_type, target_type, target_name, arg_max(confidence, {RANK}) AS confidence, count(*) AS reference_count, {LIST('procedure')} AS procedures, {LIST('function_name')} AS functions, {LIST('line_number')} AS evidence_lines,
      {LIST('target_expression')} AS target_expressions, CASE WHEN count(DISTINCT target_expression) = 1 THEN min(target_expression) END AS target_expression FROM v_evidence GROUP BY ALL""")
def summarize_evidence(d):
    return summarize.summarize_evidence(d.v_evidence)


@check("summarize_rules", f"""
    SELECT source_cube, relationship_type, target_object_type, target_name, function_name, dimension_name, count(*) AS evidence_count, CAST(min(line_number) AS BIGINT) AS first_line, min(confidence) AS confidence, {LIST('target_expression')} AS target_expressions,
      CASE WHEN count(DISTINCT target_expression) = 1 THEN min(target_expression) END AS target_expression FROM v_rule_evidence GROUP BY ALL""")
def summarize_rules(d):
    return summarize.summarize_rules(d.v_rule_evidence).drop("hierarchy_name", "attribute_name")


@check("consolidate_edges", f"""
    WITH s AS (SELECT relationship_id, discovery_method, function_name, procedure, line_number, max(reference_count) AS m, count(*) AS n FROM v_catalog_edges GROUP BY ALL)
    SELECT relationship_id, CAST(sum(m) AS BIGINT) AS reference_count, CAST(sum(n) AS BIGINT) AS aggregated_row_count, {LIST('discovery_method')} AS discovery_methods, {LIST('function_name')} AS functions, {LIST('procedure')} AS procedures, {LIST('line_number')} AS evidence_lines FROM s GROUP BY 1""")
def consolidate_edges(d):
    return summarize.consolidate(d.v_catalog_edges.withColumns({"functions": F.array("function_name"), "procedures": F.array("procedure"), "evidence_lines": F.array("line_number")}))


@check("count_by", f"SELECT coalesce(nullif(upper({t('target_type')}), ''), '<BLANK>') AS value, count(*) AS row_count FROM v_backlog GROUP BY 1")
def count_by(d):
    return summarize.count_by(d.v_backlog, "target_type")


@check("multi_distribution", f"""
    WITH b AS (SELECT coalesce(nullif({t('target_type')}, ''), '<BLANK>') AS target_type, relationship_type, discovery_method FROM v_backlog)
    SELECT 'target_type' AS distribution, target_type AS value, count(*) AS row_count FROM b GROUP BY 2 UNION ALL SELECT 'relationship_type', relationship_type, count(*) FROM b GROUP BY 2 UNION ALL SELECT 'discovery_method', discovery_method, count(*) FROM b GROUP BY 2
    UNION ALL SELECT 'target_type+relationship_type', target_type || ', ' || relationship_type, count(*) FROM b GROUP BY 2""")
def multi_distribution(d):
    return summarize.distributions(d.v_backlog, [["target_type"], ["relationship_type"], ["discovery_method"], ["target_type", "relationship_type"]])


@check("resolution_profile", f"""
    WITH l AS (SELECT relationship_id, arg_max(validation_status, validation_seq) AS status FROM v_validations GROUP BY 1),
    r AS (SELECT *, coalesce(l.status, 'NOT_CROSS_CHECKED') AS st, coalesce(nullif(lower(target_type), ''), 'unknown') AS tt, greatest(CAST(reference_count AS BIGINT), 1) AS w FROM v_backlog LEFT JOIN l USING (relationship_id)),
    d AS (SELECT *, CASE tt WHEN 'view' THEN 'VIEW_INVENTORY_AND_RESOLUTION' WHEN 'cube' THEN 'TI_DYNAMIC_CUBE_RESOLUTION' WHEN 'attribute' THEN 'ATTRIBUTE_INVENTORY_AND_RESOLUTION' ELSE 'OTHER_' || upper(tt) END AS domain FROM r),
    m AS (SELECT count(*) AS n, count(*) FILTER (WHERE st <> 'VALID') AS o FROM d)
    SELECT domain, count(*) AS relationship_count, count(DISTINCT lower(target_qualified_name)) AS distinct_target_count, CAST(sum(w) AS BIGINT) AS reference_weighted_count, round(100.0::DOUBLE * count(*) / (SELECT o FROM m), 2) AS share_of_backlog_percent,
      round(100.0::DOUBLE * count(*) / (SELECT n FROM m), 2) AS maximum_resolution_uplift_points FROM d WHERE st <> 'VALID' GROUP BY 1
    UNION ALL SELECT 'ALL', (SELECT n FROM m), count(*) FILTER (WHERE st = 'VALID'), count(*) FILTER (WHERE st = 'UNRESOLVED_DYNAMIC_REFERENCE'), round(100.0::DOUBLE * count(*) FILTER (WHERE st = 'VALID') / count(*), 2), round(100.0::DOUBLE * count(*) FILTER (WHERE st IN ('VALID', 'NOT_YET_CATALOGED')) / count(*), 2) FROM d""")
def resolution_profile(d):
    rated = summarize.backlog(d.v_backlog, d.v_validations)
    profile = summarize.resolution_profile(rated)
    whole = summarize.resolution_metrics(rated).select(
        F.lit("ALL").alias("domain"), F.col("total_relationships").alias("relationship_count"), F.col("resolved_relationships").alias("distinct_target_count"), F.col("dynamic_relationships").alias("reference_weighted_count"),
        F.col("resolution_rate_percent").alias("share_of_backlog_percent"), F.col("potential_rate_percent").alias("maximum_resolution_uplift_points"))
    return profile.unionByName(whole)


PROVENANCE_SQL = {
    "source_graph_relationship_ids": "graph_relationship_id", "source_artifacts": "source_type", "source_record_ids": "target_id", "source_snapshot_ids": "endpoint_state",
    "source_validation_ids": "CAST(edge_key % 7 AS STRING)", "semantic_validation_ids": "CASE WHEN edge_key % 31 = 0 THEN relationship_type END",
}


@check("merge_provenance", f"""
    WITH v AS ({" UNION ALL ".join(f"SELECT DISTINCT source_id || '>' || target_type AS k, '{f}' AS f, {x} AS x FROM v_graph" for f, x in PROVENANCE_SQL.items())}),
    n AS (SELECT *, (row_number() OVER (PARTITION BY k, f ORDER BY x) - 1) // 100000 AS chunk FROM v WHERE x IS NOT NULL), e AS (SELECT k, count(*) AS n FROM n WHERE f = 'source_graph_relationship_ids' GROUP BY 1)
    SELECT k AS object_relationship_id, CAST(chunk AS BIGINT) AS chunk, {", ".join(f"coalesce(array_to_string(list_sort(list(x) FILTER (WHERE f = '{f}')), '|'), '') AS {f}" for f in PROVENANCE_SQL)}, min(e.n) AS evidence_count FROM n JOIN e USING (k) GROUP BY 1, 2""")
def merge_provenance(d):
    edges = d.v_graph.select(F.concat("source_id", F.lit(">"), "target_type").alias("object_relationship_id"), F.array("graph_relationship_id").alias("source_graph_relationship_ids"),
                             F.array("source_type", "source_type").alias("source_artifacts"), F.array(F.col("target_id"), F.lit(None)).alias("source_record_ids"),
                             F.array("endpoint_state").alias("source_snapshot_ids"), F.array(F.lit(" "), (F.col("edge_key") % 7).cast("string")).alias("source_validation_ids"),
                             F.array(F.when(F.col("edge_key") % 31 == 0, F.col("relationship_type"))).alias("semantic_validation_ids"))
    return summarize.merge_provenance(edges)


@check("adjacency_index", f"SELECT 'out' AS side, source_id AS node_id, CAST(0 AS BIGINT) AS chunk, {LIST('graph_relationship_id')} AS edge_ids FROM v_graph GROUP BY 2 UNION ALL SELECT 'in', target_id, 0, {LIST('graph_relationship_id')} FROM v_graph GROUP BY 2")
def adjacency_index(d):
    out, inn = summarize.adjacency(d.v_graph)
    return out.withColumn("side", F.lit("out")).unionByName(inn.withColumn("side", F.lit("in")))


@check("duration_metrics", """
    WITH s AS (SELECT seconds, row_number() OVER (ORDER BY seconds) - 1 AS rn, count(*) OVER () AS n FROM v_durations)
    SELECT max(n) AS request_count, round(avg(seconds), 6) AS mean_seconds, round(max(seconds), 6) AS maximum_seconds, count(*) FILTER (WHERE seconds > 60) AS slow_request_count, round(median(seconds), 6) AS median_seconds,
      round(max(seconds) FILTER (WHERE rn = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)), 6) AS p95_seconds FROM s""")
def duration_metrics(d):
    return summarize.duration_metrics(d.v_durations, "seconds", 60)


@check("dynamic_profile", f"""
    WITH r AS (SELECT {PATTERN_SQL('target_expression')} AS expression_pattern, {norm('target_expression')} AS k, target_expression, relationship_type, process_name FROM v_evidence WHERE confidence <> 'CONFIRMED'),
    g AS (SELECT expression_pattern, k, relationship_type, count(*) AS row_count, count(DISTINCT process_name) AS distinct_sources, min(target_expression) AS example_expression, list_sort(list(DISTINCT process_name)) AS s FROM r GROUP BY 1, 2, 3)
    SELECT row_count, expression_pattern, relationship_type, example_expression, distinct_sources, array_to_string(s[1:5], '; ') AS example_sources, 'Follow the variable to its assignment, parameter or caller' AS candidate_action FROM g""")
def dynamic_profile(d):
    rows = d.v_evidence.where("confidence <> 'CONFIRMED'").withColumn("validation_status", F.lit("unresolved_dynamic_reference"))
    return summarize.dynamic_profile(rows, source="process_name")


@check("signature_conflicts", "SELECT p_name AS shared_id, count(DISTINCT p_brand || '/' || p_type) AS signature_count FROM part GROUP BY 1 HAVING count(DISTINCT p_brand || '/' || p_type) > 1")
def signature_conflicts(d):
    return summarize.signature_conflicts(d.part.withColumnRenamed("p_name", "shared_id"), "shared_id", ["p_brand", "p_type"])


@check("run_manifest", """
    WITH t AS (SELECT relationship_type AS k, count(*) AS n FROM v_edges GROUP BY 1)
    SELECT CAST(0 AS BIGINT) AS error_count, 'run' AS snapshot_id, (SELECT count(*) FROM v_edges) AS edges_count, (SELECT count(*) FROM v_nodes) AS nodes_count, 'COMPLETE' AS status, true AS published_current, (SELECT string_agg(k || '=' || CAST(n AS STRING), ';' ORDER BY k) FROM t) AS edge_types""")
def run_manifest(d):
    row = summarize.manifest({"edges": (d.v_edges, "relationship_type"), "nodes": (d.v_nodes, None)}, d.v_edges.where("false"), "run")
    types = F.array_join(F.transform(F.map_entries("edges_relationship_type_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return row.select("error_count", "snapshot_id", "edges_count", "nodes_count", "status", "published_current", types.alias("edge_types"))


# ---- sets -----------------------------------------------------------------------------------------

@check("union_domains", "SELECT 'edges' AS origin, relationship_id, relationship_type FROM v_edges UNION ALL SELECT 'backlog', relationship_id, relationship_type FROM v_backlog UNION ALL SELECT 'validations', relationship_id, NULL FROM v_validations")
def union_domains(d):
    return sets.union_domains({"edges": d.v_edges, "backlog": d.v_backlog, "validations": d.v_validations}).select("origin", "relationship_id", "relationship_type")


@check("reconcile_ids", """
    WITH e AS (SELECT left(relationship_id, 1) AS domain, relationship_id, count(*) AS r FROM v_edges GROUP BY ALL), v AS (SELECT left(replace(relationship_id, 'gone::', ''), 1) AS domain, relationship_id, count(*) AS n FROM v_validations GROUP BY ALL),
    j AS (SELECT coalesce(e.domain, v.domain) AS domain, coalesce(r, 0) AS r, coalesce(n, 0) AS n FROM e FULL OUTER JOIN v ON e.relationship_id = v.relationship_id)
    SELECT *, relationships = validations AND duplicate_relationship_ids + duplicate_validation_ids + missing_validations + orphan_validations = 0 AS pass FROM (
      SELECT domain, CAST(sum(r) AS BIGINT) AS relationships, CAST(sum(n) AS BIGINT) AS validations, true AS id_coverage, CAST(sum(greatest(r - 1, 0)) AS BIGINT) AS duplicate_relationship_ids, CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS duplicate_validation_ids,
        count(*) FILTER (WHERE r > 0 AND n = 0) AS missing_validations, count(*) FILTER (WHERE r = 0 AND n > 0) AS orphan_validations FROM j GROUP BY 1)""")
def reconcile_ids(d):
    domain = F.left(F.replace("relationship_id", F.lit("gone::"), F.lit("")), F.lit(1))
    return sets.reconcile(d.v_edges.withColumn("domain", domain), d.v_validations.withColumn("domain", domain), domain="domain")


@check("partition_check", f"""
    WITH o AS (SELECT object_type, {norm('object_name')} AS k, seq, left(object_name, 1) = '}}' AS c FROM v_objects),
    w AS (SELECT object_type, k, count(*) AS n, bool_or(NOT c AND seq % 50 <> 4) AS r, bool_or(c OR seq % 300 = 4) AS k2 FROM o GROUP BY 1, 2)
    SELECT (SELECT count(*) FROM o) AS whole_rows, (SELECT count(*) FROM o WHERE NOT c AND seq % 50 <> 4) AS regular_rows, (SELECT count(*) FROM o WHERE c OR seq % 300 = 4) AS control_rows, count(*) FILTER (WHERE r AND k2) AS overlapping_keys, count(*) FILTER (WHERE NOT r AND NOT k2) AS missing_keys,
      CAST(0 AS BIGINT) AS foreign_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS invalid_regular_rows, (SELECT count(*) FROM o WHERE NOT c AND seq % 300 = 4) AS invalid_control_rows, false AS pass FROM w""")
def partition_check(d):
    from catalog_lineage.functions.classify import with_scope
    scoped = with_scope(d.v_objects, "object_name")
    return sets.check_partition(scoped, scoped.where("NOT is_control AND seq % 50 <> 4"), scoped.where("is_control OR seq % 300 = 4"))


@check("coverage_reconcile", """
    SELECT 'artifact' AS part, relationship_type AS source_artifact, count(*) AS source_records, count(*) FILTER (WHERE edge_key % 41 <> 0) AS outcomes, count(*) = count(*) FILTER (WHERE edge_key % 41 <> 0) AS reconciles FROM v_edges GROUP BY 2
    UNION ALL SELECT 'graph', 'all', count(*), count(*) FILTER (WHERE edge_key % 41 <> 0), false FROM v_edges""")
def coverage_reconcile(d):
    expected = d.v_edges.select(F.col("relationship_type").alias("source_artifact"))
    outcomes = d.v_edges.where("edge_key % 41 <> 0").select(F.col("relationship_type").alias("source_artifact"), F.lit("PROJECTED").alias("projection_outcome"))
    by_artifact = sets.outcomes_by_artifact(expected, outcomes).withColumn("part", F.lit("artifact"))
    whole = sets.reconcile_outcomes(outcomes, d.v_edges, d.v_nodes, d.v_nodes.limit(0)).select(
        F.lit("all").alias("source_artifact"), F.col("edges").alias("source_records"), F.col("projected_outcomes").alias("outcomes"), F.col("pass").alias("reconciles"), F.lit("graph").alias("part"))
    return by_artifact.unionByName(whole)


@check("index_reconcile", """SELECT (SELECT count(DISTINCT graph_relationship_id) FROM v_graph) AS edges, (SELECT count(*) FROM v_graph WHERE source_id = 'process::order_1' ) AS missing_outbound, CAST(0 AS BIGINT) AS missing_inbound, CAST(0 AS BIGINT) AS unknown_ids, false AS pass""")
def index_reconcile(d):
    out, inn = summarize.adjacency(d.v_graph)
    return sets.check_adjacency(d.v_graph, out.where("node_id <> 'process::order_1'"), inn)
