"""Derived tables and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_lineage import vocab
from catalog_lineage.operators import traverse
from catalog_lineage.operators.resolve import node_label
from catalog_lineage.plans import graph, inventory, objects, operational, profile, snapshot
from . import check
from .columns import SOURCE_SQL, norm, t
from .joins import MATCH_SQL, candidates

# ---- inventory and structure ------------------------------------------------------------


@check("object_inventory", f"""
    WITH f AS (SELECT object_type, object_name, left(object_name, 1) = '}}' AS is_control FROM (SELECT *, row_number() OVER (PARTITION BY object_type, {norm('object_name')} ORDER BY seq) AS rn FROM v_objects) WHERE rn = 1)
    SELECT 'object' AS part, object_type, object_name, CASE WHEN is_control THEN 'CONTROL' ELSE 'REGULAR' END AS scope, CAST(1 AS BIGINT) AS object_count FROM f UNION ALL SELECT 'count', object_type, '', 'REGULAR', count(*) FILTER (WHERE NOT is_control) FROM f GROUP BY 2 UNION ALL SELECT 'count', object_type, '', 'CONTROL', count(*) FILTER (WHERE is_control) FROM f GROUP BY 2""")
def object_inventory(d):
    found, counts = inventory.object_inventory(d.v_objects)
    rows = found.select(F.lit("object").alias("part"), "object_type", "object_name", F.col("catalog_scope").alias("scope"), F.lit(1).cast("bigint").alias("object_count"))
    tall = counts.select(F.lit("count").alias("part"), "object_type", F.lit("").alias("object_name"), F.expr("stack(2, 'REGULAR', regular_count, 'CONTROL', control_count) AS (scope, object_count)"))
    return rows.unionByName(tall)


@check("ownership_edges", """
    SELECT 'hierarchy-ownership::' || dimension_name || '::' || hierarchy_name AS relationship_id, 'hierarchy::' || dimension_name || '::' || hierarchy_name AS source_id, 'dimension::' || dimension_name AS target_id, 'BELONGS_TO_DIMENSION' AS relationship_type, 'VALID' AS validation_status, CAST(0 AS BIGINT) AS position, '' AS definition_kind FROM v_hierarchies
    UNION ALL SELECT 'view-ownership::' || cube_name || '::' || view_name, 'view::' || cube_name || '::PUBLIC::<none>::' || view_name, 'cube::' || cube_name, 'BELONGS_TO_CUBE', 'VALID', 0, CASE WHEN seq % 4 = 1 THEN 'MDX' ELSE 'STATIC' END FROM v_views
    UNION ALL SELECT 'subset-ownership::' || dimension_name || '::' || hierarchy_name || '::' || subset_name || '::hierarchy', 'subset::' || dimension_name || '::' || hierarchy_name || '::PUBLIC::<none>::' || subset_name, 'hierarchy::' || dimension_name || '::' || hierarchy_name, 'BELONGS_TO_HIERARCHY', 'VALID', 0, CASE WHEN seq % 3 = 1 THEN 'MDX' ELSE 'STATIC' END FROM v_subsets
    UNION ALL SELECT 'subset-ownership::' || dimension_name || '::' || hierarchy_name || '::' || subset_name || '::dimension', 'subset::' || dimension_name || '::' || hierarchy_name || '::PUBLIC::<none>::' || subset_name, 'dimension::' || dimension_name, 'BELONGS_TO_DIMENSION', 'VALID', 0, CASE WHEN seq % 3 = 1 THEN 'MDX' ELSE 'STATIC' END FROM v_subsets
    UNION ALL SELECT 'cube-dimension::' || cube || '::000' || CAST(pos AS STRING) || '::' || dim, 'cube::' || cube, 'dimension::' || dim, 'USES_DIMENSION', CASE WHEN dim LIKE 'NATION%' AND CAST(substr(dim, 8) AS INT) < 25 THEN 'VALID' ELSE 'DIMENSION_NOT_IN_CATALOG' END, pos, ''
      FROM (SELECT p_name || CAST(p_partkey AS STRING) AS cube, unnest([p_brand, 'NATION_' || CAST(p_size % 30 AS STRING)]) AS dim, unnest([1, 2])::BIGINT AS pos FROM part)""")
def ownership_edges(d):
    cubes = d.part.select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("cube_name"), F.array(F.col("p_brand"), F.concat(F.lit("NATION_"), (F.col("p_size") % 30).cast("string"))).alias("dimensions"))
    edges = (inventory.ownership_edges(d.v_hierarchies, "hierarchy").unionByName(inventory.ownership_edges(d.v_views.withColumn("mdx", F.when(F.col("seq") % 4 == 1, "{[a].[b]}").when(F.col("seq") % 4 == 2, " ")), "view")).unionByName(inventory.ownership_edges(d.v_subsets.withColumn("mdx", F.when(F.col("seq") % 3 == 1, "{[a].[b]}")), "subset"))
             .unionByName(inventory.ownership_edges(cubes, "cube", d.nation.select("n_name"))))
    return edges.select("relationship_id", "source_id", "target_id", "relationship_type", "validation_status", F.coalesce("position", F.lit(0)).alias("position"), F.coalesce("definition_kind", F.lit("")).alias("definition_kind"))


@check("task_edges", """
    WITH tk AS (SELECT 'Chore ' || CAST(CAST(floor(o_orderkey / 16) AS BIGINT) AS STRING) AS chore, row_number() OVER (PARTITION BY CAST(floor(o_orderkey / 16) AS BIGINT) ORDER BY o_orderkey) AS pos, o_orderkey, 'proc_' || CAST(o_orderkey % 2000 AS STRING) AS proc, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 5 + 1 END AS given FROM orders),
    s AS (SELECT *, coalesce(given, pos) AS step FROM tk), k AS (SELECT *, row_number() OVER (PARTITION BY chore, step ORDER BY pos) AS rn, printf('%04d', step) AS s4 FROM s), p AS (SELECT DISTINCT process_name AS proc FROM v_params)
    SELECT 'duplicate' AS part, chore || '::' || s4 AS relationship_id, proc AS target_id, '' AS validation_status FROM k WHERE rn > 1
    UNION ALL SELECT 'HAS_TASK', 'chore-task-ownership::' || chore || '::' || s4, 'chore-task::' || chore || '::' || s4, 'VALID' FROM k WHERE rn = 1
    UNION ALL SELECT 'CALLS_PROCESS', 'chore-task-call::' || chore || '::' || s4 || '::' || k.proc, 'process::' || k.proc, CASE WHEN p.proc IS NULL THEN 'PROCESS_NOT_IN_CATALOG' ELSE 'VALID' END FROM k LEFT JOIN p ON p.proc = k.proc WHERE rn = 1
    UNION ALL SELECT 'PASSES_PARAMETER', 'chore-binding::' || chore || '::' || s4 || '::0001', 'process-parameter::' || k.proc || '::PDIM', CASE WHEN p.proc IS NULL THEN 'UNKNOWN_PROCESS_PARAMETER' ELSE 'VALID_PARAMETER_BINDING' END FROM k LEFT JOIN p ON p.proc = k.proc WHERE rn = 1
    UNION ALL SELECT 'PASSES_PARAMETER', 'chore-binding::' || chore || '::' || s4 || '::0002', 'process-parameter::' || proc || '::pOther', 'UNKNOWN_PROCESS_PARAMETER' FROM k WHERE rn = 1 AND o_orderkey % 2 = 0""")
def task_edges(d):
    key = F.col("o_orderkey")
    values = lambda name: F.struct(F.lit(name).alias("Name"), F.lit("v").alias("Value"))
    task = F.struct(key.alias("k"), F.when(key % 3 == 0, key % 5 + 1).cast("string").alias("step"), F.concat(F.lit("proc_"), (key % 2000).cast("string")).alias("process_name"),
                    F.when(key % 2 == 0, F.array(values("PDIM"), values("pOther"))).otherwise(F.array(values("PDIM"))).alias("parameters"))
    # a chore lists the orders of one run of 16 keys, so no list grows with the data
    chores = d.orders.groupBy(F.concat(F.lit("Chore "), F.floor(key / 16).cast("string")).alias("name")).agg(F.array_sort(F.collect_list(task)).alias("tasks"))
    _, edges, repeated = inventory.task_edges(chores, d.v_params.select("process_name"), d.v_params)
    late = repeated.select(F.lit("duplicate").alias("part"), F.concat_ws("::", "chore_name", F.format_string("%04d", "task_step")).alias("relationship_id"), F.col("process_name").alias("target_id"), F.lit("").alias("validation_status"))
    return edges.select(F.col("relationship_type").alias("part"), "relationship_id", "target_id", "validation_status").unionByName(late)


@check("source_edges", f"""
    WITH s AS (SELECT *, 'data-source::' || source_type || '::' || sha256(source_identity) AS node, CAST(substr(process_name, 5) AS BIGINT) AS k FROM ({SOURCE_SQL}) WHERE source_type <> 'NONE'),
    v AS (SELECT DISTINCT lower(cube_name) || '::' || lower(view_name) AS x FROM v_views), b AS (SELECT DISTINCT lower(dimension_name) || '::' || lower(hierarchy_name) || '::' || lower(subset_name) AS x FROM v_subsets)
    SELECT 'USES_DATA_SOURCE' AS relationship_type, 'process-data-source::' || process_name || '::' || node AS relationship_id, node AS target_id, CASE WHEN k % 10 = 1 THEN 'PROCESS_NOT_IN_CATALOG' ELSE 'VALID' END AS validation_status FROM s
    UNION ALL SELECT 'READS_FROM_FILE', 'process-source-target::' || process_name || '::READS_FROM_FILE::' || sha256(path), 'file::' || sha256(lower(path)), 'EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED' FROM s WHERE source_type IN ('ASCII_FILE', 'JSON')
    UNION ALL SELECT 'READS_FROM_ODBC', 'process-source-target::' || process_name || '::READS_FROM_ODBC::' || sha256(source_identity), node, 'EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED' FROM s WHERE source_type = 'ODBC'
    UNION ALL SELECT 'READS_FROM_VIEW', 'process-source-target::' || process_name || '::READS_FROM_VIEW::' || sha256(effective_cube_name || '::' || view_name), 'view::' || effective_cube_name || '::PUBLIC::<none>::' || view_name, CASE WHEN v.x IS NULL THEN 'VIEW_NOT_IN_CATALOG' ELSE 'VALID' END
      FROM s LEFT JOIN v ON v.x = {norm('effective_cube_name')} || '::' || {norm('view_name')} WHERE source_type = 'CUBE_VIEW' AND coalesce(effective_cube_name, '') <> ''
    UNION ALL SELECT 'READS_FROM_SUBSET', 'process-source-target::' || process_name || '::READS_FROM_SUBSET::' || sha256(dimension_name || '::' || effective_hierarchy_name || '::' || subset_name), 'subset::' || dimension_name || '::' || effective_hierarchy_name || '::PUBLIC::<none>::' || subset_name, CASE WHEN b.x IS NULL THEN 'SUBSET_NOT_IN_CATALOG' ELSE 'VALID' END
      FROM s LEFT JOIN b ON b.x = {norm('dimension_name')} || '::' || {norm('effective_hierarchy_name')} || '::' || {norm('subset_name')} WHERE source_type = 'DIMENSION_SUBSET'
    UNION ALL SELECT DISTINCT 'RESOLVES_TO_FILE', 'data-source-file::' || node || '::' || 'file::' || sha256(lower(path)), 'file::' || sha256(lower(path)), 'EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED' FROM s WHERE source_type IN ('ASCII_FILE', 'JSON')""")
def source_edges(d):
    known = d.v_sources.where("CAST(substr(process_name, 5) AS BIGINT) % 10 <> 1").select(F.lit("process").alias("object_type"), F.upper("process_name").alias("object_name"))
    _, _, edges = inventory.source_edges(d.v_sources, known, d.v_views, d.v_subsets)
    return edges.select("relationship_type", "relationship_id", "target_id", "validation_status")


@check("operational_edges", """
    WITH r AS (SELECT o_orderkey AS k, 'p' || CAST(o_custkey % 50 AS STRING) AS proc, CASE o_orderkey % 4 WHEN 0 THEN 'out/f' || CAST(o_orderkey % 90 AS STRING) || '.csv' WHEN 1 THEN 'cmd /c run' || CAST(o_orderkey % 30 AS STRING) || '.bat' WHEN 2 THEN 'sDir | x' || CAST(o_orderkey % 9 AS STRING) ELSE '' END AS x,
        CASE o_orderkey % 4 WHEN 1 THEN 'EXECUTES_COMMAND' ELSE 'WRITES_FILE' END AS rt FROM orders),
    n AS (SELECT *, CASE k % 4 WHEN 0 THEN replace(x, '/', chr(92)) ELSE x END AS path FROM r WHERE x <> ''),
    i AS (SELECT *, CASE k % 4 WHEN 1 THEN 'command::CMD::' || sha256(lower(x)) WHEN 2 THEN 'file::DYNAMIC::' || sha256(lower(path)) ELSE 'file::RELATIVE::' || sha256(lower(path)) END AS node, CASE k % 4 WHEN 1 THEN 'COMMAND' ELSE 'FILE' END AS nt FROM n),
    e AS (SELECT proc, rt, lower(x) AS x, count(*) AS c FROM r WHERE k % 2 = 0 GROUP BY 1, 2, 3)
    SELECT 'edge' AS part, 'operational::process::' || i.proc || '::' || i.rt || '::' || node AS id, CASE WHEN k % 4 = 2 THEN 'DYNAMIC_EXTERNAL_FILE' ELSE 'EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED' END AS detail, coalesce(max(c), 1) AS evidence_count FROM i LEFT JOIN e ON e.proc = i.proc AND e.rt = i.rt AND e.x = lower(i.x) GROUP BY 2, 3
    UNION ALL SELECT DISTINCT 'edge', 'operational-command::' || node || '::INVOKES_EXECUTABLE::executable::cmd', 'EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED', 1 FROM i WHERE nt = 'COMMAND'
    UNION ALL SELECT DISTINCT 'edge', 'operational-command::' || node || '::REFERENCES_SCRIPT::script::RELATIVE::' || sha256(substr(x, 8)), 'EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED', 1 FROM i WHERE nt = 'COMMAND'
    UNION ALL SELECT DISTINCT 'node', node, nt, 0 FROM i UNION ALL SELECT 'node', 'executable::cmd', 'EXECUTABLE', 0 UNION ALL SELECT DISTINCT 'node', 'script::RELATIVE::' || sha256(substr(x, 8)), 'SCRIPT', 0 FROM i WHERE nt = 'COMMAND'
    UNION ALL SELECT 'error', 'Missing process name or target expression', '', count(*) FROM r WHERE x = ''""")
def operational_edges(d):
    e = F.expr
    refs = d.orders.select(
        F.col("o_orderkey").alias("seq"), e("'p' || CAST(o_custkey % 50 AS STRING)").alias("process_name"), e("CASE o_orderkey % 4 WHEN 1 THEN 'EXECUTES_COMMAND' ELSE 'WRITES_FILE' END").alias("relationship_type"),
        e("CASE o_orderkey % 4 WHEN 0 THEN 'out/f' || CAST(o_orderkey % 90 AS STRING) || '.csv' WHEN 1 THEN 'cmd /c run' || CAST(o_orderkey % 30 AS STRING) || '.bat' WHEN 2 THEN 'sDir | x' || CAST(o_orderkey % 9 AS STRING) ELSE '' END").alias("target_expression"))
    nodes, edges, errors = operational.operational_edges(refs, refs.where("seq % 2 = 0"))
    row = lambda df, part, ident, detail, n: df.select(F.lit(part).alias("part"), ident.alias("id"), detail.alias("detail"), n.alias("evidence_count"))
    zero = F.lit(0).cast("bigint")
    lost = errors.groupBy("error").agg(F.count("*").alias("n"))
    return (row(edges, "edge", F.col("relationship_id"), F.col("validation_status"), F.col("evidence_count")).unionByName(row(nodes, "node", F.col("node_id"), F.col("node_type"), zero))
            .unionByName(row(lost, "error", F.col("error"), F.lit(""), F.col("n"))))


# ---- profile, plan, semantic validations --------------------------------------------------

def refs(d):
    return d.v_refs.withColumn("row_key", F.lpad(F.col("ref_key").cast("string"), 12, "0"))


PROFILE_SQL = f"""{MATCH_SQL},
    q AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY lower(process_name), relationship_type, target_type, lower(target_name)) AS n FROM matched WINDOW w AS (PARTITION BY lower(process_name), relationship_type, target_type, lower(target_name) ORDER BY ref_key)),
    prof AS (SELECT *, 'semantic::ti::' || lower(process_name) || '::' || relationship_type || '::' || target_type || '::' || lower(target_name) || CASE WHEN n > 1 THEN '::occurrence::' || printf('%04d', pos) ELSE '' END AS relationship_id FROM q)"""


@check("match_profile", f"""{PROFILE_SQL} SELECT relationship_id, CASE WHEN n = 1 THEN 'SEMANTIC_KEY' ELSE 'SEMANTIC_GROUP_ORDINAL' END AS join_method, pos AS semantic_group_position, n AS semantic_group_size, validation_status AS input_validation_status, domain, match_classification,
    CAST(candidate_count AS BIGINT) AS candidate_count, match_classification IN ('AMBIGUOUS_MATCH', 'TARGET_NOT_IN_CATALOG', 'DYNAMIC_REFERENCE', 'MISSING_DELETE_TARGET', 'INSUFFICIENT_CONTEXT', 'EXISTING_CREATE_TARGET') AS in_review_queue FROM prof""")
def match_profile(d):
    rows, _ = profile.match_profile(refs(d), refs(d), candidates(d), "TI")
    return rows.select("relationship_id", "join_method", "semantic_group_position", "semantic_group_size", "input_validation_status", "domain", "match_classification", "candidate_count", "in_review_queue")


PLAN_SQL = f"""{PROFILE_SQL},
    plan AS (SELECT *, 'semantic-resolution-plan::' || sha256('ti::' || relationship_id) AS plan_id, CASE match_classification WHEN 'EXACT_MATCH' THEN 'VALID' WHEN 'DEFAULT_HIERARCHY_MATCH' THEN 'VALID_DEFAULT_HIERARCHY_MATCH' WHEN 'UNIQUE_HIERARCHY_MATCH' THEN 'VALID_UNIQUE_HIERARCHY_MATCH' WHEN 'VALID_CREATE_TARGET' THEN 'VALID_CREATE_TARGET'
        WHEN 'EXISTING_CREATE_TARGET' THEN 'REVIEW_EXISTING_CREATE_TARGET' WHEN 'DYNAMIC_REFERENCE' THEN 'UNRESOLVED_DYNAMIC_REFERENCE' WHEN 'MISSING_DELETE_TARGET' THEN 'REVIEW_MISSING_DELETE_TARGET' WHEN 'AMBIGUOUS_MATCH' THEN 'AMBIGUOUS_REFERENCE' WHEN 'INSUFFICIENT_CONTEXT' THEN 'INSUFFICIENT_REFERENCE_CONTEXT'
        WHEN 'UNIQUE_GLOBAL_MATCH' THEN 'REVIEW_UNQUALIFIED_GLOBAL_MATCH' ELSE domain || '_NOT_IN_CATALOG' END AS proposed_validation_status,
      CASE WHEN match_classification IN ('EXACT_MATCH', 'DEFAULT_HIERARCHY_MATCH', 'UNIQUE_HIERARCHY_MATCH', 'VALID_CREATE_TARGET') THEN 'AUTOMATIC' ELSE 'REVIEW' END AS decision_type FROM prof)"""


def plan(d):
    return profile.resolution_plan(profile.match_profile(refs(d), refs(d), candidates(d), "TI")[0])


@check("resolution_plan", f"{PLAN_SQL} SELECT plan_id, relationship_id, domain, proposed_validation_status, decision_type, CASE WHEN decision_type = 'AUTOMATIC' THEN candidate_node_id END AS resolved_target_node_id FROM plan")
def resolution_plan(d):
    return plan(d)[0].select("plan_id", "relationship_id", "domain", "proposed_validation_status", "decision_type", "resolved_target_node_id")


@check("semantic_validations", f"""{PLAN_SQL}
    SELECT 'semantic-validation::' || sha256(lower('TI::plan::' || plan_id)) AS semantic_validation_id, relationship_id, proposed_validation_status AS semantic_validation_status, decision_type, decision_type = 'REVIEW' AS review_required FROM plan
    UNION ALL SELECT 'semantic-validation::' || sha256(lower('TI::parser::' || CAST(l_key AS STRING) || '::::::' || process_name || '::::' || relationship_type || '::' || target_type || '::' || target_name || '::VALID')), '', 'VALID', 'PARSER_PRESERVED', false
      FROM (SELECT *, ref_key + 1 AS l_key FROM v_refs)""")
def semantic_validations(d):
    preserved = d.v_refs.withColumns({"validation_status": F.lit("valid"), "source_validation_index": F.col("ref_key") + 1})
    every = d.v_refs.withColumn("source_validation_index", -F.col("ref_key")).unionByName(preserved)
    rows, _ = profile.semantic_validations(every, plan(d)[0], "TI")
    return rows.select("semantic_validation_id", "relationship_id", "semantic_validation_status", "decision_type", "review_required")


# ---- graph layers -----------------------------------------------------------------------------

STATUS = "(SELECT relationship_id, max(validation_status) AS s FROM v_validations GROUP BY 1)"


@check("project_direct", f"""
    SELECT 'edge' AS part, 'graph::structure::' || e.relationship_id AS id, CASE WHEN s LIKE '%DYNAMIC%' THEN 'DYNAMIC' ELSE 'CANONICAL' END AS detail, coalesce(s, 'PROJECTED') AS status FROM v_edges e LEFT JOIN {STATUS} v USING (relationship_id) WHERE edge_key % 19 <> 0
    UNION ALL SELECT 'outcome', relationship_id, CASE WHEN edge_key % 19 = 0 THEN 'ERROR' ELSE 'PROJECTED' END, '' FROM v_edges UNION ALL SELECT 'error', relationship_id, 'Source relationship is missing required fields: source_id', '' FROM v_edges WHERE edge_key % 19 = 0""")
def project_direct(d):
    holes = d.v_edges.withColumn("source_id", F.when(F.col("edge_key") % 19 == 0, " ").otherwise(F.col("source_id")))
    p = graph.project_direct("Structure", "structure", holes, d.v_validations)
    row = lambda df, part, ident, detail, status: df.select(F.lit(part).alias("part"), F.col(ident).alias("id"), F.col(detail).alias("detail"), status.alias("status"))
    edges = p.edges.join(p.validations.select("graph_relationship_id", "validation_status"), "graph_relationship_id")
    return (row(edges, "edge", "graph_relationship_id", "endpoint_state", F.col("validation_status")).unionByName(row(p.outcomes, "outcome", "source_record_id", "projection_outcome", F.lit("")))
            .unionByName(row(p.errors, "error", "source_record_id", "error", F.lit(""))))


def semantic_rows(d):
    e = F.expr
    base = d.orders.select(
        F.col("o_orderkey").alias("position"), e("'order_' || CAST(o_orderkey AS STRING)").alias("process_name"), e("CASE o_orderstatus WHEN 'F' THEN 'READS_FROM_CUBE' ELSE 'WRITES_TO_CUBE' END").alias("relationship_type"),
        e("'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0')").alias("target_name"), F.lit("cube").alias("target_type"), e("'sCube' || CAST(o_orderkey % 3 AS STRING)").alias("target_expression"))
    k = F.col("position") % 4
    semantic = base.withColumns({
        "semantic_validation_id": e("'sv' || CAST(position AS STRING)"), "origin": F.lit("TI"), "domain": F.lit("CUBE"), "source_name": F.col("process_name"), "semantic_group_position": F.lit(1).cast("bigint"),
        "semantic_validation_status": F.when(k == 0, "VALID").when(k == 1, "VALID").when(k == 2, "UNRESOLVED_DYNAMIC_REFERENCE").otherwise("VALID_CREATE_TARGET"),
        "decision_type": F.when(k == 0, "PARSER_PRESERVED").when(k == 2, "REVIEW").otherwise("AUTOMATIC"), "resolution_method": F.lit("m"), "review_required": k == 2, "profiler_classification": F.lit(None).cast("string"),
        "resolved_target_node_id": F.when(k == 1, F.concat(F.lit("cube::"), "target_name")), "relationship_type": F.when(F.col("position") % 50 == 49, "NOTHING").otherwise(F.col("relationship_type")),
    })
    return semantic, base.withColumn("origin", F.lit("TI"))


SEMANTIC_SQL = """
    WITH b AS (SELECT o_orderkey AS k, 'order_' || CAST(o_orderkey AS STRING) AS proc, CASE o_orderstatus WHEN 'F' THEN 'READS_FROM_CUBE' ELSE 'WRITES_TO_CUBE' END AS rt, 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS name, 'sCube' || CAST(o_orderkey % 3 AS STRING) AS x, 'sv' || CAST(o_orderkey AS STRING) AS sv, o_custkey FROM orders),
    n AS (SELECT *, CASE WHEN k % 50 = 49 THEN 'ERROR' WHEN k % 4 = 1 OR k % 4 = 0 AND o_custkey % 50 <> 7 THEN 'PROJECTED' WHEN k % 4 = 2 THEN 'PROJECTED_AS_DYNAMIC_REFERENCE' ELSE 'PROJECTED_AS_PLANNED_TARGET' END AS outcome,
        'semantic-source::ti::' || sha256(lower('TI' || chr(31) || 'process::' || proc || chr(31) || rt || chr(31) || 'CUBE' || chr(31) || name || chr(31) || '1')) AS record, sha256(lower('TI' || chr(31) || 'CUBE' || chr(31) || name || chr(31) || x)) AS h FROM b),
    e AS (SELECT *, CASE outcome WHEN 'PROJECTED' THEN 'cube::' || name WHEN 'PROJECTED_AS_DYNAMIC_REFERENCE' THEN 'reference-expression::ti::' || h ELSE 'planned-target::ti::' || h END AS target FROM n),
    sem AS (SELECT *, 'graph::semantic::ti::' || sha256(lower(record || '|' || target || '|' || sv)) AS gid FROM e)"""


@check("project_semantic", f"{SEMANTIC_SQL} SELECT CASE WHEN outcome = 'ERROR' THEN sv ELSE record END AS source_record_id, CASE WHEN outcome <> 'ERROR' THEN gid END AS graph_relationship_id, outcome AS projection_outcome, CASE WHEN outcome <> 'ERROR' THEN target END AS target_id FROM sem")
def project_semantic(d):
    semantic, relationships = semantic_rows(d)
    p = graph.project_semantic("TI", "TI", semantic, relationships, d.v_nodes)
    return p.outcomes.join(p.edges.select("graph_relationship_id", "target_id"), "graph_relationship_id", "left").select("source_record_id", "graph_relationship_id", "projection_outcome", "target_id")


# earlier domains bring stub nodes for every customer, so every canonical name is found
UNIFIED_SQL = SEMANTIC_SQL.replace(" AND o_custkey % 50 <> 7", "")


@check("unified_graph", f"""{UNIFIED_SQL},
    d AS (SELECT count(*) AS n FROM v_edges), s AS (SELECT count(*) AS n FROM v_edges WHERE relationship_id LIKE 's-%'), o AS (SELECT outcome, count(*) AS n FROM sem GROUP BY 1)
    SELECT 'nodes' AS part, '' AS name, (SELECT count(*) FROM v_nodes) + (SELECT count(*) FROM customer WHERE c_custkey % 50 = 7 AND true) + (SELECT count(DISTINCT target) FROM sem WHERE outcome LIKE 'PROJECTED\\_%' ESCAPE '\\') AS row_count
    UNION ALL SELECT 'edges', '', (SELECT n FROM d) + (SELECT count(*) FROM sem WHERE outcome <> 'ERROR') UNION ALL SELECT 'errors', '', (SELECT count(*) FROM sem WHERE outcome = 'ERROR')
    UNION ALL SELECT 'outcome', outcome, n + CASE WHEN outcome = 'PROJECTED' THEN (SELECT n FROM d) ELSE 0 END FROM o UNION ALL SELECT 'outcome', 'EXCLUDED_REDUNDANT_WITH_PROVENANCE', n FROM s
    UNION ALL SELECT 'coverage', left(relationship_id, 1), count(*) FROM v_edges GROUP BY 2 UNION ALL SELECT 'coverage', 'DataSource', n FROM s UNION ALL SELECT 'coverage', 'TI', count(*) FROM sem
    UNION ALL SELECT 'edge', 'graph::' || CASE left(relationship_id, 1) WHEN 's' THEN 'operational' ELSE left(relationship_id, 1) END || '::' || relationship_id || '>' || source_id || '>' || target_id || '>' || relationship_type, 1 FROM v_edges
    UNION ALL SELECT 'edge', gid || '>process::' || proc || '>' || target || '>' || rt, 1 FROM sem WHERE outcome <> 'ERROR'""")
def unified_graph(d):
    semantic, relationships = semantic_rows(d)
    kind = F.left("relationship_id", F.lit(1))
    direct = {name: (d.v_edges.where(kind == ("s" if name == "Operational" else name)), d.v_validations) for name in ("n", "c", "Operational", "o")}
    again = d.v_edges.where(kind == "s").withColumn("relationship_id", F.concat(F.lit("again-"), "relationship_id"))
    g = graph.build_graph(graph.GraphInputs({"nodes": d.v_nodes}, direct, (again, d.v_validations), {"TI": (semantic, relationships)}), "run")
    row = lambda df, part, name: df.select(F.lit(part).alias("part"), name.alias("name"))
    total = lambda df, part: row(df, part, F.lit("")).groupBy("part", "name").agg(F.count("*").alias("row_count"))
    outcomes = row(g.outcomes, "outcome", F.col("projection_outcome")).groupBy("part", "name").agg(F.count("*").alias("row_count"))
    name = F.when(F.col("source_artifact") == "Operational", "s").otherwise(F.col("source_artifact"))
    coverage = g.coverage.where("reconciles").select(F.lit("coverage").alias("part"), name.alias("name"), F.col("outcomes").alias("row_count"))
    edges = g.edges.select(F.lit("edge").alias("part"), F.concat_ws(">", "graph_relationship_id", "source_id", "target_id", "relationship_type").alias("name"), F.lit(1).cast("bigint").alias("row_count"))
    return (total(g.nodes, "nodes").unionByName(total(g.edges, "edges")).unionByName(total(g.errors, "errors"))
            .unionByName(outcomes).unionByName(coverage).unionByName(edges))


@check("object_graph", f"""
    WITH s AS (SELECT *, 'data-source::' || source_type || '::' || sha256(source_identity) AS node FROM ({SOURCE_SQL}) WHERE source_type <> 'NONE'),
    r AS (SELECT *, CASE source_type WHEN 'CUBE_VIEW' THEN {norm('effective_cube_name')} || chr(31) || {norm('view_name')} WHEN 'DIMENSION_SUBSET' THEN {norm('dimension_name')} || chr(31) || {norm('effective_hierarchy_name')} || chr(31) || {norm('subset_name')} WHEN 'ODBC' THEN NULL ELSE {norm("replace(path, '/', chr(92))")} END AS ref FROM s),
    v AS (SELECT lower(cube_name) || chr(31) || lower(view_name) AS k, count(DISTINCT cube_name || view_name) AS n FROM v_views GROUP BY 1),
    g AS (SELECT DISTINCT source_id, relationship_type, target_id, graph_relationship_id FROM v_graph WHERE source_id IN (SELECT node_id FROM v_nodes) AND target_id IN (SELECT node_id FROM v_nodes))
    SELECT relationship_type, CASE relationship_type WHEN 'BELONGS_TO_DIMENSION' THEN 'STRUCTURAL' WHEN 'USES_DIMENSION' THEN 'STRUCTURAL' WHEN 'CALLS_PROCESS' THEN 'EXECUTION' WHEN 'TOUCHES_CUBE' THEN 'OTHER' ELSE 'DATA_FLOW' END AS relationship_class, count(*) AS relationships, CAST(sum(n) AS BIGINT) AS evidence FROM (SELECT source_id, relationship_type, target_id, count(*) AS n FROM g GROUP BY ALL) GROUP BY 1
    UNION ALL SELECT 'BELONGS_TO_CUBE', 'STRUCTURAL', count(*), count(*) FROM (SELECT DISTINCT cube_name, view_name FROM v_views)
    UNION ALL SELECT 'HAS_CONFIGURED_SOURCE', 'CONFIGURATION', count(*), count(*) FROM r
    UNION ALL SELECT CASE source_type WHEN 'CUBE_VIEW' THEN 'REFERENCES_VIEW' WHEN 'DIMENSION_SUBSET' THEN 'REFERENCES_SUBSET' ELSE 'REFERENCES_FILE' END, 'REFERENCE', count(*), count(*) FROM r WHERE source_type <> 'ODBC' GROUP BY 1
    UNION ALL SELECT 'RESOLVES_TO_VIEW', 'RESOLUTION', count(DISTINCT ref), count(DISTINCT ref) FROM r JOIN v ON v.k = r.ref AND v.n = 1 WHERE source_type = 'CUBE_VIEW' AND coalesce(effective_cube_name, '') <> ''""")
def object_graph(d):
    views = d.v_views.select(F.concat_ws("::", F.lit("view"), "cube_name", "view_name").alias("node_id"), F.lit("VIEW").alias("node_type"), "cube_name", "view_name").distinct()
    cubes = d.v_views.select(F.concat_ws("::", F.lit("cube"), "cube_name").alias("node_id"), F.lit("CUBE").alias("node_type"), F.col("cube_name").alias("object_name")).distinct()
    owners = d.v_sources.select(F.concat_ws("::", F.lit("process"), "process_name").alias("node_id"), F.lit("PROCESS").alias("node_type"), F.col("process_name").alias("object_name"))
    nodes = d.v_nodes.unionByName(views, allowMissingColumns=True).unionByName(cubes, allowMissingColumns=True).unionByName(owners, allowMissingColumns=True)
    _, declarations, _ = inventory.source_edges(d.v_sources, d.v_objects)
    g = objects.object_graph(nodes, d.v_graph, declarations)
    return g.relationships.groupBy("relationship_type", "relationship_class").agg(F.count("*").alias("relationships"), F.sum("evidence_count").alias("evidence"))


@check("catalog_snapshot", f"""
    WITH c AS (SELECT object_type, lower({t('object_name')}) AS k, arg_min({t('object_name')}, seq) AS nm FROM v_objects GROUP BY 1, 2),
    e AS (SELECT v.*, lower({t('target_name')}) AS tk, c.nm AS hit FROM v_evidence v LEFT JOIN c ON c.object_type = v.target_type AND c.k = lower({t('v.target_name')})),
    r AS (SELECT *, CASE WHEN hit IS NOT NULL THEN 'RESOLVED' WHEN left(target_expression, 1) = chr(39) THEN confidence ELSE 'UNRESOLVED' END AS conf FROM e),
    i AS (SELECT lower(process_name) AS p, relationship_type, target_type, tk, procedure, line_number, hit IS NOT NULL AS found, max(conf) AS any_conf, min(conf) AS conf, count(DISTINCT function_name) AS refs FROM r GROUP BY ALL),
    s AS (SELECT *, CASE WHEN found THEN 'VALID' WHEN conf = 'UNRESOLVED' THEN 'UNRESOLVED_DYNAMIC_REFERENCE' WHEN target_type <> 'cube' THEN 'NOT_YET_CATALOGED' ELSE 'BROKEN_REFERENCE' END AS status FROM i)
    SELECT 'relationships' AS part, relationship_type || '/' || target_type || '/' || found AS name, count(*) AS row_count, CAST(sum(refs) AS BIGINT) AS weight FROM s GROUP BY 2
    UNION ALL SELECT 'objects', object_type, count(*), 0 FROM c GROUP BY 2 UNION ALL SELECT 'warnings', 'DUPLICATE_LEGACY_OBJECT', (SELECT count(*) FROM v_objects) - (SELECT count(*) FROM c), 0
    UNION ALL SELECT 'validations', 'linked', (SELECT count(*) FROM s), 0 UNION ALL SELECT 'evidence', 'all', (SELECT count(*) FROM v_evidence), 0""")
def catalog_snapshot(d):
    code = d.v_evidence.withColumns({"functions": F.array("function_name"), "procedures": F.array("procedure"), "evidence_lines": F.array("line_number")})
    rows = snapshot.conform(code, "TI")
    s = snapshot.catalog_snapshot(d.v_objects, rows, rows, rows, "test", "main", "run")
    count = lambda df, part, name, weight=F.lit(0).cast("bigint"): df.select(F.lit(part).alias("part"), name.alias("name"), weight.alias("w")).groupBy("part", "name").agg(F.count("*").alias("row_count"), F.coalesce(F.sum("w"), F.lit(0)).alias("weight"))
    name = F.concat_ws("/", "relationship_type", "target_type", F.col("target_object_id").isNotNull().cast("string"))
    return (count(s.relationships, "relationships", name, F.col("reference_count")).unionByName(count(s.objects, "objects", F.col("object_type"))).unionByName(count(s.warnings, "warnings", F.col("warning_type")))
            .unionByName(count(s.validations.where("relationship_id IS NOT NULL"), "validations", F.lit("linked"))).unionByName(count(s.evidence, "evidence", F.lit("all"))))


@check("build_lineage", "SELECT n_name AS domain, CASE WHEN n_nationkey % 3 <> 0 THEN r_name END AS source_snapshot_id, 'graph' AS graph_snapshot_id FROM nation JOIN region ON n_regionkey = r_regionkey")
def build_lineage(d):
    manifests = d.nation.where("n_nationkey % 3 <> 0").join(d.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("domain"), F.col("r_name").alias("snapshot_id"))
    return graph.build_lineage(d.nation.select(F.col("n_name").alias("domain")), manifests, "graph").drop("pipeline_run_id")


# ---- graph queries ------------------------------------------------------------------------------

def paths_sql(start: str, direction: str, depth: int) -> str:
    hop = {"inbound": "SELECT target_id AS a, '1' || graph_relationship_id AS st, graph_relationship_id AS e, source_id AS b FROM v_graph", "outbound": "SELECT source_id AS a, '0' || graph_relationship_id AS st, graph_relationship_id AS e, target_id AS b FROM v_graph"}
    hops = " UNION ALL ".join(hop.values()) if direction == "both" else hop[direction]
    return f"""hops AS ({hops}), p(nodes, edges, cyc, last, depth) AS (SELECT ['{start}'], CAST([] AS VARCHAR[]), false, '{start}', 0 UNION ALL
      SELECT list_append(p.nodes, h.b), list_append(p.edges, h.e), list_contains(p.nodes, h.b), h.b, p.depth + 1 FROM p JOIN hops h ON h.a = p.last WHERE NOT p.cyc AND p.depth < {depth}),
    leaf AS (SELECT p.* FROM p WHERE p.depth > 0 AND (p.cyc OR p.depth = {depth} OR NOT EXISTS (SELECT 1 FROM hops h WHERE h.a = p.last)))"""


@check("neighborhood", f"WITH RECURSIVE {paths_sql('cube::Customer#000000001', 'both', 3)} SELECT CAST(depth AS BIGINT) AS depth, array_to_string(nodes, '|') AS node_ids, array_to_string(edges, '|') AS relationship_ids, cyc AS cycle FROM leaf")
def neighborhood(d):
    return traverse.neighborhood(d.v_graph, "cube::Customer#000000001", "both", 3, max_nodes=None, max_edges=None).paths.select("depth", "node_ids", "relationship_ids", "cycle")


@check("neighborhood_capped", """
    WITH h AS (SELECT source_id AS a, '0' || graph_relationship_id AS step, graph_relationship_id AS edge, target_id AS b FROM v_graph UNION ALL SELECT target_id, '1' || graph_relationship_id, graph_relationship_id, source_id FROM v_graph),
    l1 AS (SELECT a AS start, step, edge, b, a = b AS cyc FROM h WHERE a = 'hierarchy::NATION_1'),
    n1 AS (SELECT b FROM l1 WHERE NOT cyc GROUP BY b ORDER BY min(step) LIMIT 499),
    i1 AS (SELECT * FROM l1 WHERE cyc OR b IN (SELECT b FROM n1)),
    e1 AS (SELECT min(step) AS low FROM i1 GROUP BY edge ORDER BY low LIMIT 600),
    k1 AS MATERIALIZED (SELECT * FROM i1 WHERE step <= (SELECT max(low) FROM e1)),
    nodes AS (SELECT start AS n FROM l1 UNION SELECT b FROM k1), edges AS (SELECT DISTINCT edge FROM k1),
    l2 AS MATERIALIZED (SELECT k1.start, k1.b AS via, h.b, k1.edge AS edge1, h.edge, [k1.step, h.step] AS steps, h.b IN (k1.start, k1.b) AS cyc FROM k1 JOIN h ON h.a = k1.b WHERE NOT k1.cyc),
    n2 AS (SELECT b FROM (SELECT b, min(steps) AS low FROM l2 WHERE b NOT IN (SELECT n FROM nodes) GROUP BY b) QUALIFY row_number() OVER (ORDER BY low) <= 500 - (SELECT count(*) FROM nodes)),
    i2 AS MATERIALIZED (SELECT * FROM l2 WHERE b IN (SELECT n FROM nodes) OR b IN (SELECT b FROM n2)),
    fresh AS (SELECT edge, min(steps) AS low FROM i2 WHERE edge NOT IN (SELECT edge FROM edges) GROUP BY edge),
    e2 AS (SELECT low FROM fresh QUALIFY row_number() OVER (ORDER BY low) <= 600 - (SELECT count(*) FROM edges)),
    k2 AS MATERIALIZED (SELECT * FROM i2 WHERE (SELECT count(*) FROM edges) < 600 AND ((SELECT count(*) FROM fresh) < 600 - (SELECT count(*) FROM edges) OR steps <= (SELECT max(low) FROM e2)))
    SELECT 'path::2::' || edge AS path_id, 2 AS depth, start || ',' || via || ',' || b AS node_ids, edge1 || ',' || edge AS relationship_ids, cyc AS cycle FROM k2
    UNION ALL SELECT 'path::1::' || edge, 1, start || ',' || b, edge, cyc FROM k1 WHERE step NOT IN (SELECT steps[1] FROM k2)""")
def neighborhood_capped(d):
    return traverse.neighborhood(d.v_graph, "hierarchy::NATION_1", "both", 2, max_nodes=500, max_edges=600).paths.select(
        "path_id", "depth", F.array_join("node_ids", ",").alias("node_ids"), F.array_join("relationship_ids", ",").alias("relationship_ids"), "cycle")


@check("impact", f"WITH RECURSIVE {paths_sql('dimension::AFRICA', 'inbound', 3)} SELECT DISTINCT unnest(nodes) AS node_id FROM leaf")
def impact(d):
    return traverse.reachable(d.v_graph, "dimension::AFRICA").select("node_id")


@check("impact_distance", """
    WITH a AS (SELECT source_id AS n FROM v_graph WHERE target_id = 'dimension::AFRICA'), b AS (SELECT source_id AS n FROM v_graph WHERE target_id IN (SELECT n FROM a)), c AS (SELECT source_id AS n FROM v_graph WHERE target_id IN (SELECT n FROM b))
    SELECT n AS node_id, CAST(min(distance) AS BIGINT) AS distance FROM (SELECT 'dimension::AFRICA' AS n, 0 AS distance UNION ALL SELECT n, 1 FROM a UNION ALL SELECT n, 2 FROM b UNION ALL SELECT n, 3 FROM c) GROUP BY 1""")
def impact_distance(d):
    return traverse.reachable(d.v_graph, "dimension::AFRICA")


@check("node_summary", """
    SELECT 'hierarchy::NATION_3' AS node_id, 'NATION_3' AS label, (SELECT count(*) FROM v_graph WHERE target_id = 'hierarchy::NATION_3') AS inbound_count, (SELECT count(*) FROM v_graph WHERE source_id = 'hierarchy::NATION_3') AS outbound_count, graph_relationship_id,
      CASE WHEN source_id = 'hierarchy::NATION_3' THEN target_id ELSE source_id END AS other_id, CASE WHEN source_id = 'hierarchy::NATION_3' THEN 'outbound' ELSE 'inbound' END AS direction FROM v_graph WHERE 'hierarchy::NATION_3' IN (source_id, target_id)""")
def node_summary(d):
    return traverse.node_summary(d.v_nodes, d.v_graph, "hierarchy::NATION_3").select("node_id", "label", "inbound_count", "outbound_count", "graph_relationship_id", "other_id", "direction")


@check("process_story", "SELECT CASE relationship_type WHEN 'CALLS_PROCESS' THEN 'EXECUTION' WHEN 'TOUCHES_CUBE' THEN 'OTHER' ELSE 'DATA_FLOW' END AS category, count(*) AS edge_count FROM v_graph WHERE 'process::order_7' IN (source_id, target_id) GROUP BY 1")
def process_story(d):
    return traverse.process_story(d.v_graph, vocab.edge_semantics(d.spark), "order_7")


@check("explain_edge", """
    SELECT 'c-1' AS id, 'Uses dimension' AS label, source_id AS source, target_id AS target, s.object_name AS source_name, t.object_name AS target_name, coalesce((SELECT max(validation_status) FROM v_validations WHERE relationship_id = 'c-1'), 'UNKNOWN') AS validation_status, CAST(1 AS BIGINT) AS provenance_count, 'USES_DIMENSION' AS source_artifacts
    FROM v_graph g LEFT JOIN v_nodes s ON s.node_id = source_id LEFT JOIN v_nodes t ON t.node_id = target_id WHERE graph_relationship_id = 'c-1'""")
def explain_edge(d):
    validations = d.v_validations.withColumnRenamed("relationship_id", "graph_relationship_id")
    provenance = d.v_graph.select("graph_relationship_id", F.col("relationship_type").alias("source_artifact"))
    row = traverse.explain(d.v_nodes, d.v_graph, vocab.edge_semantics(d.spark), validations, provenance, "c-1")
    return row.select("id", "label", "source", "target", F.col("source_node.object_name").alias("source_name"), F.col("target_node.object_name").alias("target_name"), "validation_status", "provenance_count", "source_artifacts")


@check("path_text", f"""WITH RECURSIVE {paths_sql('dimension::AFRICA', 'inbound', 3)}, label AS (SELECT node_id, coalesce(object_name, replace(node_id, 'process::', '')) AS label FROM v_nodes)
    SELECT 'path::' || CAST(depth AS STRING) || '::' || edges[-1] AS path_id, CAST(depth AS BIGINT) AS depth, edges[-1] AS last_relationship_id, cyc AS cycle,
      array_to_string([coalesce((SELECT label FROM label WHERE node_id = nodes[1]), nodes[1]), coalesce((SELECT label FROM label WHERE node_id = nodes[2]), nodes[2]), coalesce((SELECT label FROM label WHERE node_id = nodes[3]), nodes[3]), coalesce((SELECT label FROM label WHERE node_id = nodes[4]), nodes[4])], ' -> ') AS interpretation FROM leaf""")
def path_text(d):
    found = traverse.impact(d.v_graph, "dimension::AFRICA", max_nodes=None, max_edges=None)
    return traverse.path_text(found.paths, d.v_nodes.withColumn("label", node_label(d.v_nodes)))


@check("graph_facets", """
    WITH a AS (SELECT graph_relationship_id AS e, source_id AS n, relationship_type AS r FROM v_graph WHERE target_id = 'hierarchy::NATION_3'), b AS (SELECT graph_relationship_id, source_id, relationship_type FROM v_graph WHERE target_id IN (SELECT n FROM a)), x AS (SELECT * FROM a UNION SELECT * FROM b)
    SELECT 'node_types' AS facet, node_type AS value, count(*) AS row_count FROM v_nodes WHERE node_id IN (SELECT n FROM x) OR node_id = 'hierarchy::NATION_3' GROUP BY 2 UNION ALL SELECT 'relationship_types', r, count(*) FROM x GROUP BY 2
    UNION ALL SELECT 'relationship_categories', CASE r WHEN 'USES_DIMENSION' THEN 'STRUCTURAL' WHEN 'CALLS_PROCESS' THEN 'EXECUTION' WHEN 'TOUCHES_CUBE' THEN 'OTHER' ELSE 'DATA_FLOW' END, count(*) FROM x GROUP BY 2""")
def graph_facets(d):
    found = traverse.neighborhood(d.v_graph, "hierarchy::NATION_3", "inbound", 2, max_nodes=None, max_edges=None)
    return traverse.facets(found, d.v_nodes, d.v_graph, vocab.edge_semantics(d.spark))
