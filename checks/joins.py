"""Joins of references with the catalog, pairing, parameters, display views."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_lineage import vocab
from catalog_lineage.functions import ids
from catalog_lineage.operators import filters, pairing, parameters, resolve, window
from . import check
from .columns import CONTEXT_SQL, EXCEPTIONS, SOURCE_SQL, exceptions, norm, t

CLASSIFIED = f"""
    (SELECT e.*, c.object_name AS catalog_match_name, CASE WHEN left(c.object_name, 1) = '}}' THEN 'CONTROL' ELSE 'REGULAR' END AS scope,
      CASE WHEN confidence = 'UNRESOLVED' THEN CASE target_type WHEN 'view' THEN 'RUNTIME_VIEW_REFERENCE' WHEN 'subset' THEN 'RUNTIME_SUBSET_REFERENCE' WHEN 'attribute' THEN 'ATTRIBUTE_CATALOG_DEFERRED' ELSE 'UNRESOLVED_DYNAMIC_REFERENCE' END
        WHEN target_type IN ('view', 'subset') THEN 'NOT_CROSS_CHECKED' WHEN target_type = 'attribute' THEN 'ATTRIBUTE_CATALOG_DEFERRED' WHEN target_type = 'hierarchy' THEN 'HIERARCHY_CATALOG_DEFERRED'
        WHEN c.object_name IS NOT NULL THEN 'VALID' WHEN confidence = 'CONFIRMED' THEN 'BROKEN_REFERENCE' ELSE 'RESOLVED_TARGET_NOT_IN_CATALOG' END AS validation_status
    FROM v_evidence e LEFT JOIN (SELECT object_type, {norm('object_name')} AS k, arg_min(object_name, seq) AS object_name FROM v_objects GROUP BY 1, 2) c ON c.object_type = e.target_type AND c.k = {norm('e.target_name')})"""


@check("catalog_lookup", f"""SELECT target_type, target_name, confidence, validation_status, CASE WHEN validation_status = 'VALID' THEN catalog_match_name END AS catalog_match_name, CASE WHEN validation_status = 'VALID' THEN scope END AS catalog_match_scope, count(*) AS row_count FROM {CLASSIFIED} GROUP BY ALL""")
def catalog_lookup(d):
    return resolve.classified_counts(d.v_evidence, d.v_objects).groupBy("target_type", "target_name", "confidence", "validation_status", "catalog_match_name", "catalog_match_scope").agg(F.sum("row_count").alias("row_count"))


@check("exception_join", f"""
    WITH x AS (SELECT target_type, lower(target_name) AS k, min(exception_id) AS exception_id FROM {EXCEPTIONS} WHERE exception_status IN ('REGISTERED', 'active') AND coalesce(applies_to_validation_records, true) AND target_type <> '' GROUP BY 1, 2),
    j AS (SELECT v.validation_status, CASE WHEN v.validation_status IN ('BROKEN_REFERENCE', 'RESOLVED_TARGET_NOT_IN_CATALOG') THEN coalesce(x.exception_id, '') ELSE '' END AS exception_id FROM {CLASSIFIED} v LEFT JOIN x ON x.target_type = v.target_type AND x.k = {norm('v.target_name')})
    SELECT validation_status, exception_id, exception_id <> '' AS exclude_from_quality_score, count(*) AS row_count FROM j GROUP BY ALL""")
def exception_join(d):
    register = exceptions(d).withColumn("exclude_from_quality_score", F.lit(True))
    return resolve.classified_counts(d.v_evidence, d.v_objects, register).groupBy("validation_status", "exception_id", "exclude_from_quality_score").agg(F.sum("row_count").alias("row_count"))


@check("pair_by_id", """
    SELECT 'pair' AS part, validation_id, v.relationship_id AS relationship_key, 'RELATIONSHIP_ID' AS detail FROM v_validations v JOIN v_edges e USING (relationship_id)
    UNION ALL SELECT 'error', validation_id, NULL, 'No relationship has this key; semantic_candidate_count=0' FROM v_validations WHERE relationship_id NOT IN (SELECT relationship_id FROM v_edges)""")
def pair_by_id(d):
    pairs, errors = pairing.pair(d.v_validations.withColumn("row_key", F.col("validation_id")), d.v_edges.withColumn("row_key", F.col("relationship_id")))
    return pairs.select(F.lit("pair").alias("part"), F.col("validation_key").alias("validation_id"), "relationship_key", F.col("join_method").alias("detail")).unionByName(
        errors.select(F.lit("error").alias("part"), F.col("validation_key").alias("validation_id"), F.lit(None).cast("string").alias("relationship_key"), F.col("error").alias("detail")))


ORDINAL_SQL = """(SELECT CAST(o_orderkey AS STRING) AS row_key, 'p' || CAST(o_custkey % 100 AS STRING) || '/' || o_orderstatus || '/' || o_orderpriority AS k, CAST(o_orderkey % 60 AS STRING) AS line, o_orderkey FROM orders)"""


@check("pair_by_ordinal", f"""
    WITH v AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line, row_key) AS pos, count(*) OVER (PARTITION BY k) AS n FROM {ORDINAL_SQL} WHERE o_orderkey % 400 <> 3 AND NOT (k LIKE 'p7/%')), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line, row_key) AS pos, count(*) OVER (PARTITION BY k) AS n FROM {ORDINAL_SQL} WHERE NOT (k LIKE 'p9/%'))
    SELECT v.row_key AS validation_key, CASE WHEN v.n = r.n THEN r.row_key END AS relationship_key, CASE WHEN r.row_key IS NULL AND rn.n IS NULL THEN 'No relationship has this key; semantic_candidate_count=0' WHEN rn.n <> v.n
        THEN 'Validations and relationships of this key differ in number; validation_count=' || CAST(v.n AS STRING) || '; relationship_count=' || CAST(rn.n AS STRING) WHEN v.n = 1 THEN 'SEMANTIC_KEY' ELSE 'SEMANTIC_GROUP_ORDINAL' END AS detail
    FROM v LEFT JOIN (SELECT k, count(*) AS n FROM r GROUP BY 1) rn ON rn.k = v.k LEFT JOIN r ON r.k = v.k AND r.pos = v.pos AND r.n = v.n""")
def pair_by_ordinal(d):
    rows = d.orders.select(F.col("o_orderkey").cast("string").alias("row_key"), F.concat(F.lit("p"), (F.col("o_custkey") % 100).cast("string")).alias("process_name"), F.col("o_orderstatus").alias("relationship_type"),
                           F.lit("cube").alias("target_type"), F.col("o_orderpriority").alias("target_name"), (F.col("o_orderkey") % 60).alias("line_number"), "o_orderkey")
    pairs, errors = pairing.pair(rows.where("o_orderkey % 400 <> 3 AND process_name <> 'p7'"), rows.where("process_name <> 'p9'"))
    return pairs.select("validation_key", "relationship_key", F.col("join_method").alias("detail")).unionByName(errors.select("validation_key", F.lit(None).cast("string").alias("relationship_key"), F.col("error").alias("detail")))


MATCH_SQL = f"""
    WITH refs AS (SELECT *, CASE WHEN domain = 'VIEW' THEN lower(cube_name) ELSE lower(dimension_name) END AS parent, CASE WHEN domain IN ('SUBSET', 'ATTRIBUTE') THEN lower(hierarchy_name) ELSE '' END AS h,
        lower(CASE domain WHEN 'VIEW' THEN view_name WHEN 'SUBSET' THEN subset_name WHEN 'ATTRIBUTE' THEN attribute_name ELSE hierarchy_name END) AS own FROM ({CONTEXT_SQL})),
    c AS (SELECT 'HIERARCHY' AS domain, 'hierarchy::' || dimension_name || '::' || hierarchy_name AS id, lower(dimension_name) AS parent, '' AS h, lower(hierarchy_name) AS own, false AS dflt FROM v_hierarchies
      UNION ALL SELECT 'VIEW', 'view::' || cube_name || '::' || view_name, lower(cube_name), '', lower(view_name), false FROM v_views
      UNION ALL SELECT 'SUBSET', 'subset::' || dimension_name || '::' || hierarchy_name || '::' || subset_name, lower(dimension_name), lower(hierarchy_name), lower(subset_name), dimension_name = hierarchy_name FROM v_subsets
      UNION ALL SELECT 'ATTRIBUTE', 'attribute::' || dimension_name || '::' || hierarchy_name || '::' || attribute_name, lower(dimension_name), lower(hierarchy_name), lower(attribute_name), dimension_name = hierarchy_name FROM v_attributes),
    f AS (SELECT domain, parent, h, own, count(*) AS n, min(id) AS id FROM c GROUP BY 1, 2, 3, 4), p AS (SELECT domain, parent, own, count(*) AS n, min(id) AS id, count(*) FILTER (WHERE dflt) AS dn, min(id) FILTER (WHERE dflt) AS did FROM c GROUP BY 1, 2, 3),
    g AS (SELECT domain, own, count(*) AS n, min(id) AS id FROM c GROUP BY 1, 2),
    m AS (SELECT r.*, regexp_matches(r.target_name, '^[snpv][A-Z_][A-Za-z0-9_]*$') AS dyn, r.domain IN ('SUBSET', 'ATTRIBUTE') AS deep, coalesce(f.n, 0) AS fn, f.id AS fid, coalesce(p.n, 0) AS pn, p.id AS pid, coalesce(p.dn, 0) AS dn, p.did, coalesce(g.n, 0) AS gn, g.id AS gid
      FROM refs r LEFT JOIN f ON f.domain = r.domain AND f.parent = r.parent AND f.h = r.h AND f.own = r.own LEFT JOIN p ON p.domain = r.domain AND p.parent = r.parent AND p.own = r.own LEFT JOIN g ON g.domain = r.domain AND g.own = r.own),
    b AS (SELECT *, CASE WHEN dyn THEN 'DYNAMIC_REFERENCE' WHEN own = '' THEN 'INSUFFICIENT_CONTEXT' WHEN deep AND parent <> '' AND h <> '' THEN CASE WHEN fn = 1 THEN 'EXACT_MATCH' ELSE 'TARGET_NOT_IN_CATALOG' END
        WHEN NOT deep AND parent <> '' THEN CASE WHEN pn = 1 THEN 'EXACT_MATCH' ELSE 'TARGET_NOT_IN_CATALOG' END WHEN parent <> '' THEN CASE WHEN dn = 1 THEN 'DEFAULT_HIERARCHY_MATCH' WHEN pn = 1 THEN 'UNIQUE_HIERARCHY_MATCH' WHEN pn > 1 THEN 'AMBIGUOUS_MATCH' ELSE 'TARGET_NOT_IN_CATALOG' END
        ELSE CASE WHEN gn = 1 THEN 'UNIQUE_GLOBAL_MATCH' WHEN gn > 1 THEN 'AMBIGUOUS_MATCH' ELSE 'TARGET_NOT_IN_CATALOG' END END AS base,
        CASE WHEN dyn OR own = '' THEN 0 WHEN deep AND parent <> '' AND h <> '' THEN fn WHEN parent <> '' AND deep AND dn = 1 THEN 1 WHEN parent <> '' THEN pn ELSE gn END AS candidate_count,
        CASE WHEN deep AND parent <> '' AND h <> '' THEN fid WHEN parent <> '' AND deep AND dn = 1 THEN did WHEN parent <> '' THEN pid ELSE gid END AS cid FROM m),
    matched AS (SELECT *, CASE WHEN base = 'TARGET_NOT_IN_CATALOG' AND relationship_type IN ('CREATES_ATTRIBUTE', 'CREATES_SUBSET', 'CREATES_VIEW', 'UPDATES_HIERARCHY') THEN 'VALID_CREATE_TARGET' WHEN base = 'TARGET_NOT_IN_CATALOG' AND relationship_type LIKE 'DELETES%' THEN 'MISSING_DELETE_TARGET'
        WHEN base IN ('EXACT_MATCH', 'DEFAULT_HIERARCHY_MATCH', 'UNIQUE_HIERARCHY_MATCH', 'UNIQUE_GLOBAL_MATCH') AND relationship_type IN ('CREATES_ATTRIBUTE', 'CREATES_SUBSET', 'CREATES_VIEW', 'UPDATES_HIERARCHY') THEN 'EXISTING_CREATE_TARGET' ELSE base END AS match_classification, CASE WHEN candidate_count = 1 THEN cid END AS candidate_node_id FROM b)"""


def candidates(d):
    return resolve.candidate_catalog(d.v_hierarchies, d.v_views, d.v_subsets, d.v_attributes)


@check("candidate_match", f"""{MATCH_SQL},
    named AS (SELECT *, CASE WHEN dyn OR own = '' THEN NULL WHEN deep AND parent <> '' AND h <> '' THEN 'FULL' WHEN deep AND parent <> '' AND dn = 1 THEN 'DEFAULT' WHEN parent <> '' THEN 'PARENT' ELSE 'NAME' END AS level,
        CASE WHEN dyn THEN 'The expression depends on the run' WHEN own = '' THEN 'A name that the lookup needs is missing' WHEN deep AND parent <> '' AND h <> '' THEN 'Looked up by dimension, hierarchy and name'
          WHEN deep AND parent <> '' THEN 'Looked up by dimension and name, hierarchy unknown' WHEN deep THEN 'Looked up by name alone' WHEN domain = 'HIERARCHY' AND parent <> '' THEN 'Looked up by dimension and hierarchy'
          WHEN domain = 'HIERARCHY' THEN 'Looked up by hierarchy, dimension unknown' WHEN parent <> '' THEN 'Looked up by cube and view' ELSE 'Looked up by view, cube unknown' END
          || CASE match_classification WHEN 'VALID_CREATE_TARGET' THEN '; a create needs no such entry' WHEN 'MISSING_DELETE_TARGET' THEN '; nothing there to delete' WHEN 'EXISTING_CREATE_TARGET' THEN '; already there before the create' ELSE '' END AS reason FROM matched),
    keyed AS (SELECT *, CASE level WHEN 'FULL' THEN parent || chr(31) || h || chr(31) || own WHEN 'NAME' THEN own ELSE CASE WHEN level IS NOT NULL THEN parent || chr(31) || own END END AS key FROM named),
    l AS (SELECT domain, 'FULL' AS level, parent || chr(31) || h || chr(31) || own AS key, id FROM c WHERE domain IN ('SUBSET', 'ATTRIBUTE') UNION ALL SELECT domain, 'PARENT', parent || chr(31) || own, id FROM c
      UNION ALL SELECT domain, 'NAME', own, id FROM c UNION ALL SELECT domain, 'DEFAULT', parent || chr(31) || own, id FROM c WHERE dflt),
    asked AS (SELECT domain, level, key, id, (row_number() OVER (PARTITION BY domain, level, key ORDER BY id) - 1) // 100000 AS chunk FROM l SEMI JOIN (SELECT DISTINCT domain, level, key FROM keyed WHERE candidate_count > 0) a USING (domain, level, key))
    SELECT 'reference' AS part, ref_key, domain, match_classification, reason AS match_reason, CAST(candidate_count AS BIGINT) AS candidate_count, candidate_node_id, level AS candidate_level, key AS candidate_key, CAST(NULL AS BIGINT) AS chunk, NULL AS candidate_node_ids FROM keyed
    UNION ALL SELECT 'candidates', NULL, domain, NULL, NULL, count(*), NULL, level, key, CAST(chunk AS BIGINT), array_to_string(list_sort(list(id)), '|') FROM asked GROUP BY domain, level, key, chunk""")
def candidate_match(d):
    """Every reference with its class, reason and count, and every list of candidates that references name by level and key, once."""
    deferred, _ = filters.split_deferred(d.v_refs)
    matched = resolve.match_candidates(resolve.with_context(deferred), candidates(d)).select(
        "ref_key", "domain", "match_classification", "match_reason", "candidate_count", "candidate_node_id", "candidate_level", "candidate_key")
    matched = window.cut(matched)
    lists = resolve.candidate_lists(matched, candidates(d)).withColumn("candidate_count", F.size("candidate_node_ids").cast("bigint"))
    return matched.withColumn("part", F.lit("reference")).unionByName(lists.withColumn("part", F.lit("candidates")), allowMissingColumns=True)


@check("candidate_groups", """
    WITH c AS (SELECT 'HIERARCHY' AS domain, lower(dimension_name) AS parent, NULL AS h, lower(hierarchy_name) AS own, 'hierarchy::' || dimension_name || '::' || hierarchy_name AS id FROM v_hierarchies
      UNION ALL SELECT 'VIEW', lower(cube_name), NULL, lower(view_name), 'view::' || cube_name || '::' || view_name FROM v_views
      UNION ALL SELECT 'SUBSET', lower(dimension_name), lower(hierarchy_name), lower(subset_name), 'subset::' || dimension_name || '::' || hierarchy_name || '::' || subset_name FROM v_subsets
      UNION ALL SELECT 'ATTRIBUTE', lower(dimension_name), lower(hierarchy_name), lower(attribute_name), 'attribute::' || dimension_name || '::' || hierarchy_name || '::' || attribute_name FROM v_attributes),
    l AS (SELECT domain, 'FULL' AS level, parent || chr(31) || h || chr(31) || own AS key, id FROM c WHERE h IS NOT NULL UNION ALL SELECT domain, 'PARENT', parent || chr(31) || own, id FROM c UNION ALL SELECT domain, 'NAME', own, id FROM c)
    SELECT domain, level, key, CAST(0 AS BIGINT) AS chunk, array_to_string(list_sort(list(DISTINCT id)), '|') AS candidate_node_ids FROM l GROUP BY 1, 2, 3""")
def candidate_groups(d):
    return resolve.candidate_groups(candidates(d))


#: Fields by which rows of one source dispute its relationships; names may be missing, and there are more rows than relationships.
DISPUTED = {
    "source": "'q' || CAST(floor(o_orderkey / 32) AS BIGINT)", "row_type": "CASE WHEN o_custkey % 2 = 0 THEN 'CUBE' ELSE 'VIEW' END",
    "row_name": "CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'c' END", "row_expression": "CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'e1' ELSE 'e2' END",
    "rel_type": "CASE WHEN o_orderkey % 3 = 0 THEN 'CUBE' ELSE 'VIEW' END", "rel_name": "CASE o_orderkey % 5 WHEN 0 THEN 'a' WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'c' END",
    "rel_expression": "CASE o_orderkey % 7 WHEN 0 THEN 'e1' WHEN 1 THEN '' ELSE 'e2' END",
}


@check("best_score_pairing", f"""
    WITH RECURSIVE r AS (
      SELECT 'd' || CAST(o_orderkey AS STRING) AS row_id, {DISPUTED['source']} AS bucket, row_number() OVER (PARTITION BY floor(o_orderkey / 32) ORDER BY o_orderkey DESC) AS k,
        {DISPUTED['row_type']} AS t, coalesce(nullif({DISPUTED['row_name']}, ''), {DISPUTED['row_expression']}) AS n, {DISPUTED['row_expression']} AS e FROM orders),
    x AS (
      SELECT 'x' || CAST(o_orderkey AS STRING) AS rel_id, {DISPUTED['source']} AS bucket, o_orderkey AS place,
        {DISPUTED['rel_type']} AS t, {DISPUTED['rel_name']} AS n, {DISPUTED['rel_expression']} AS e FROM orders WHERE o_orderkey % 6 <> 1),
    served AS (
      SELECT DISTINCT bucket, 0::BIGINT AS k, []::VARCHAR[] AS used, NULL::VARCHAR AS row_id, NULL::VARCHAR AS rel_id, NULL::BIGINT AS score FROM r
      UNION ALL
      SELECT bucket, k, CASE WHEN best[3] IS NULL THEN used ELSE list_append(used, best[3]) END, row_id, best[3], -best[1] FROM (
        SELECT r.bucket, r.k, s.used, r.row_id, min(CASE WHEN x.rel_id IS NOT NULL THEN ROW(-(100 + 20 * (r.t = x.t)::BIGINT + 40 * (r.n <> '' AND r.n = x.n)::BIGINT + 10 * (r.e <> '' AND r.e = x.e)::BIGINT), x.place, x.rel_id) END) AS best
        FROM served s JOIN r ON r.bucket = s.bucket AND r.k = s.k + 1 LEFT JOIN x ON x.bucket = r.bucket AND NOT list_contains(s.used, x.rel_id) GROUP BY r.bucket, r.k, s.used, r.row_id)
    )
    SELECT 's' || CAST(o_orderkey AS STRING) AS row_id, CASE WHEN o_orderkey % 10 <> 4 THEN CAST(o_orderkey AS STRING) END AS rel_id, CASE WHEN o_orderkey % 10 <> 4 THEN CASE WHEN o_orderkey % 3 = 0 THEN 160 ELSE 170 END END::BIGINT AS score,
      CASE WHEN o_orderkey % 10 = 4 THEN 'UNMATCHED' ELSE 'EXACT_SEMANTIC_SIGNATURE' END AS source_pairing_method FROM orders
    UNION ALL SELECT row_id, rel_id, score, CASE WHEN rel_id IS NULL THEN 'UNMATCHED' WHEN score >= 160 THEN 'EXACT_SEMANTIC_SIGNATURE' ELSE 'RELAXED_SEMANTIC_SIGNATURE' END FROM served WHERE k > 0""")
def best_score_pairing(d):
    key = F.col("o_orderkey")
    common = {"origin": F.lit("TI"), "relationship_type": F.lit("READS_FROM_CUBE"), "target_type": F.lit("cube"), "target_name": F.concat(F.lit("Cube "), key.cast("string"))}
    name = F.concat(F.lit("p"), (F.col("o_custkey") % 200).cast("string"), F.when(key % 10 == 4, "?").otherwise(""))
    semantic = d.orders.withColumns({**common, "row_id": F.concat(F.lit("s"), key.cast("string")), "row_order": F.xxhash64("o_orderkey"), "process_name": name, "target_expression": F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("'e"), key.cast("string"), F.lit("'")))})
    rels = d.orders.where("o_orderkey % 10 <> 4").withColumns({**common, "rel_id": key.cast("string"), "position": key, "process_name": F.upper(name), "target_expression": F.concat(F.lit("'e"), key.cast("string"), F.lit("'"))})
    shared = {"origin": F.lit("RULES"), "relationship_type": F.lit("WRITES_TO_CUBE"), "process_name": F.expr(DISPUTED["source"])}
    side = lambda kind: {"target_type": F.expr(DISPUTED[f"{kind}_type"]), "target_name": F.expr(DISPUTED[f"{kind}_name"]), "target_expression": F.expr(DISPUTED[f"{kind}_expression"])}
    rows = d.orders.withColumns({**shared, **side("row"), "row_id": F.concat(F.lit("d"), key.cast("string")), "row_order": -key})
    members = d.orders.where("o_orderkey % 6 <> 1").withColumns({**shared, **side("rel"), "rel_id": F.concat(F.lit("x"), key.cast("string")), "position": key})
    return pairing.pair_best(semantic.unionByName(rows), rels.unionByName(members)).select("row_id", "rel_id", "score", "source_pairing_method")


@check("overlap_merge", """
    SELECT 'fresh' AS part, relationship_id, NULL AS existing_graph_id FROM v_graph_new WHERE edge_key % 3 <> 0 UNION ALL SELECT 'overlap', relationship_id, 'g-' || relationship_id FROM v_graph_new WHERE edge_key % 3 = 0""".replace("v_graph_new", "v_edges"))
def overlap_merge(d):
    existing = d.v_edges.where("edge_key % 3 = 0").withColumn("graph_relationship_id", F.concat(F.lit("g-"), "relationship_id"))
    fresh, overlap = resolve.merge_overlap(d.v_edges, existing)
    return fresh.select(F.lit("fresh").alias("part"), "relationship_id", F.lit(None).cast("string").alias("existing_graph_id")).unionByName(overlap.select(F.lit("overlap").alias("part"), "relationship_id", "existing_graph_id"))


@check("complete_endpoints", """
    SELECT node_id, node_type, 'CATALOG' AS node_origin FROM v_nodes UNION ALL SELECT DISTINCT target_id, target_type, 'RELATIONSHIP_ENDPOINT' FROM v_edges WHERE target_id NOT IN (SELECT node_id FROM v_nodes)
    UNION ALL SELECT DISTINCT source_id, source_type, 'RELATIONSHIP_ENDPOINT' FROM v_edges WHERE source_id NOT IN (SELECT node_id FROM v_nodes) AND source_id NOT IN (SELECT target_id FROM v_edges)""")
def complete_endpoints(d):
    return resolve.complete_endpoints(d.v_nodes.withColumn("node_origin", F.lit("CATALOG")), d.v_edges).select("node_id", "node_type", "node_origin")


@check("orphan_checks", """
    SELECT 'source' AS part, relationship_id FROM v_edges WHERE source_id NOT IN (SELECT node_id FROM v_nodes) UNION ALL SELECT 'target', relationship_id FROM v_edges WHERE target_id NOT IN (SELECT node_id FROM v_nodes)
    UNION ALL SELECT 'validation', relationship_id FROM v_validations WHERE relationship_id NOT IN (SELECT relationship_id FROM v_edges)""")
def orphan_checks(d):
    part = lambda df, name: df.select(F.lit(name).alias("part"), "relationship_id")
    return (part(resolve.orphans(d.v_edges, d.v_nodes, "source_id", "node_id"), "source").unionByName(part(resolve.orphans(d.v_edges, d.v_nodes, "target_id", "node_id"), "target"))
            .unionByName(part(resolve.orphans(d.v_validations, d.v_edges, "relationship_id", "relationship_id"), "validation")))


@check("position_join", """
    SELECT relationship_id, CASE WHEN edge_key % 7 = 0 THEN 'embedded' ELSE (CASE WHEN edge_key % 13 = 0 THEN 'BROKEN_REFERENCE' WHEN edge_key % 11 = 0 THEN 'UNRESOLVED_DYNAMIC_REFERENCE' ELSE 'VALID' END) END AS source_validation_status
    FROM v_edges WHERE edge_key % 97 <> 0""")
def position_join(d):
    first = d.v_validations.where("validation_id LIKE 'val::%' AND validation_seq % 7 <> 0").withColumn("position", F.col("validation_seq") + 1)
    rows = d.v_edges.where("edge_key % 97 <> 0").withColumns({"source_validation_index": F.col("edge_key") + 1, "source_validation": F.struct(F.lit("embedded").alias("validation_status"))})
    return resolve.join_position(rows, first, "source_validation_index", "position", "source_validation", ["validation_status"]).select("relationship_id", "source_validation_status")


PARAM_SQL = f"""
    WITH b AS (SELECT *, lower(called_process) AS proc FROM v_bindings), bs AS (SELECT proc, count(*) FILTER (WHERE resolved_value IS NOT NULL) AS nr, count(*) FILTER (WHERE resolved_value IS NULL) AS no FROM b GROUP BY 1),
    df AS (SELECT process_name AS proc, default_value FROM v_params WHERE parameter_name = 'pDim' AND default_value IS NOT NULL),
    o AS (SELECT *, lower(process_name) AS proc, CAST(substr(row_key, 5) AS BIGINT) AS k FROM v_open_refs WHERE confidence = 'UNRESOLVED'),
    u AS (SELECT o.*, CASE WHEN target_expression = 'sAlias' THEN CASE WHEN k % 8 = 3 THEN '' ELSE 'no ' END END AS pre, coalesce(nr, 0) AS nr, coalesce(no, 0) AS no, default_value FROM o LEFT JOIN bs USING (proc) LEFT JOIN df USING (proc) WHERE target_expression = 'sAlias' OR bs.proc IS NOT NULL OR df.proc IS NOT NULL),
    x AS (SELECT DISTINCT row_key, target_type, coalesce(pre, '') || b.resolved_value AS value, 'EXECUTE_PROCESS_ARGUMENT' AS source_kind, calling_process, line_number FROM u JOIN b USING (proc) WHERE nr > 0 AND b.resolved_value IS NOT NULL
      UNION ALL SELECT row_key, target_type, coalesce(pre, '') || default_value, CASE WHEN pre IS NULL THEN 'PARAMETER_DEFAULT' ELSE 'PARAMETER_ALIAS' END, NULL, NULL FROM u WHERE nr = 0 AND default_value IS NOT NULL),
    l AS (SELECT x.*, c.k IS NOT NULL AS hit, c.object_name FROM x LEFT JOIN (SELECT object_type, lower(object_name) AS k, arg_min(object_name, seq) AS object_name FROM v_objects GROUP BY 1, 2) c ON c.object_type = x.target_type AND c.k = lower(x.value)),
    cov AS (SELECT u.row_key, bool_and((nr > 0 OR default_value IS NOT NULL) AND no = 0) AS covered FROM u GROUP BY 1),
    rep AS (SELECT row_key FROM l JOIN cov USING (row_key) GROUP BY 1 HAVING bool_and(covered) AND bool_and(hit))"""


@check("parameter_resolution", f"""{PARAM_SQL}
    SELECT 'summary' AS part, row_key, target_name AS value, confidence AS detail FROM v_open_refs WHERE row_key NOT IN (SELECT row_key FROM rep) UNION ALL SELECT DISTINCT 'summary', row_key, object_name, 'RESOLVED' FROM l WHERE hit
    UNION ALL SELECT 'provenance', row_key, value, source_kind FROM l WHERE hit UNION ALL SELECT 'rejection', row_key, value, CASE WHEN target_type = 'view' THEN 'VIEW_CATALOG_DEFERRED' ELSE 'CANDIDATE_NOT_IN_OBJECT_CATALOG' END FROM l WHERE NOT hit""")
def parameter_resolution(d):
    refs = d.v_open_refs
    aliases = d.customer.where("c_custkey % 4 = 3").select(F.concat(F.lit("proc_"), F.col("c_custkey").cast("string")).alias("process_name"), F.lit("salias").alias("variable"),
                                                           F.when(F.col("c_custkey") % 8 == 3, "pDim").otherwise("'no ' | pDim").alias("expression"), F.array(F.lit("pDim")).alias("dependencies"))
    result, provenance, rejections = parameters.resolve_parameters(refs, d.v_params, d.v_bindings, aliases, d.v_objects)
    part = lambda df, name, value, detail: df.select(F.lit(name).alias("part"), "row_key", F.col(value).alias("value"), F.col(detail).alias("detail"))
    return part(result, "summary", "target_name", "confidence").unionByName(part(provenance, "provenance", "value", "source_kind")).unionByName(part(rejections, "rejection", "candidate_value", "rejection_reason"))


@check("parameter_candidates", """
    WITH v AS (SELECT lower(process_name) AS p, lower(parameter_name) AS n, default_value AS value FROM v_params WHERE coalesce(default_value, '') <> '' UNION ALL SELECT lower(called_process), parameter_name, resolved_value FROM v_bindings WHERE resolved_value IS NOT NULL
      UNION ALL SELECT 'proc_' || CAST(c_custkey AS STRING), 'salias', 'V' || CAST(c_custkey % 3 AS STRING) FROM customer WHERE c_custkey % 4 = 3),
    g AS (SELECT p, n, count(DISTINCT value) AS c, min(value) AS one, count(*) AS s FROM v GROUP BY 1, 2)
    SELECT row_key, coalesce(c, 0) AS candidate_count, CASE WHEN c IS NULL THEN 'NO_STATIC_CANDIDATE' WHEN c = 1 THEN 'SINGLE_STATIC_CANDIDATE' ELSE 'FINITE_CANDIDATE_SET' END AS resolution_status, CASE WHEN c = 1 THEN one END AS single_value, coalesce(s, 0) AS provenance_count
    FROM v_open_refs LEFT JOIN g ON p = lower(process_name) AND n = lower(target_expression)""")
def parameter_candidates(d):
    key = F.col("c_custkey")
    aliases = d.customer.where("c_custkey % 4 = 3").select(F.concat(F.lit("proc_"), key.cast("string")).alias("process_name"), F.lit("sAlias").alias("variable"), F.concat(F.lit("V"), (key % 3).cast("string")).alias("resolved_value"))
    classed, _ = parameters.parameter_candidates(d.v_open_refs, d.v_params, d.v_bindings, aliases)
    return classed.select("row_key", "candidate_count", "resolution_status", "single_value", "provenance_count")


REFERENCES = f"""(SELECT process_name, CASE source_type WHEN 'CUBE_VIEW' THEN 'VIEW' WHEN 'DIMENSION_SUBSET' THEN 'SUBSET' ELSE 'FILE' END AS kind, effective_cube_name, view_name, dimension_name, effective_hierarchy_name, subset_name, path FROM ({SOURCE_SQL}) WHERE source_type IN ('CUBE_VIEW', 'DIMENSION_SUBSET', 'ASCII_FILE', 'JSON'))"""


def declared(d):
    from catalog_lineage.functions.classify import with_source_class
    rows = with_source_class(d.v_sources).where("source_type IN ('CUBE_VIEW', 'DIMENSION_SUBSET', 'ASCII_FILE', 'JSON')")
    return rows.select("process_name", F.expr("CASE source_type WHEN 'CUBE_VIEW' THEN 'VIEW' WHEN 'DIMENSION_SUBSET' THEN 'SUBSET' ELSE 'FILE' END").alias("reference_kind"), F.col("effective_cube_name").alias("cube_name"), "view_name", "dimension_name",
                       F.col("effective_hierarchy_name").alias("hierarchy_name"), "subset_name", F.coalesce("server_source_name", "client_source_name").alias("path"))


@check("reference_resolution", f"""
    WITH c AS (SELECT 'VIEW' AS kind, lower(cube_name) || chr(31) || lower(view_name) AS k, 'v' || CAST(seq AS STRING) AS id FROM v_views UNION ALL SELECT 'SUBSET', lower(dimension_name) || chr(31) || lower(hierarchy_name) || chr(31) || lower(subset_name), 's' || CAST(seq AS STRING) FROM v_subsets
      UNION ALL SELECT 'FILE', lower(replace('/in/' || p_brand || '.csv', '/', chr(92))), 'f' || p_brand FROM (SELECT DISTINCT p_brand FROM part)),
    r AS (SELECT *, CASE kind WHEN 'VIEW' THEN {norm('effective_cube_name')} || chr(31) || {norm('view_name')} WHEN 'SUBSET' THEN {norm('dimension_name')} || chr(31) || {norm('effective_hierarchy_name')} || chr(31) || {norm('subset_name')} ELSE {norm("replace(path, '/', chr(92))")} END AS k,
      CASE kind WHEN 'VIEW' THEN coalesce(effective_cube_name, '') = '' ELSE false END AS short FROM {REFERENCES}), g AS (SELECT kind, k, count(*) AS n, min(id) AS id FROM c GROUP BY 1, 2)
    SELECT process_name, CASE WHEN short THEN 'INSUFFICIENT_CONTEXT' WHEN n = 1 THEN 'CANONICAL_EXACT_MATCH' WHEN n > 1 THEN 'AMBIGUOUS_REFERENCE' WHEN r.kind = 'FILE' THEN 'EXTERNAL_UNVERIFIED' ELSE 'TARGET_NOT_IN_PUBLIC_CATALOG' END AS resolution_status, CASE WHEN short THEN 0 ELSE coalesce(n, 0) END AS candidate_count,
      CASE WHEN n = 1 AND NOT short THEN id END AS resolved_target_object_id, short OR coalesce(n, 0) <> 1 AS review_required FROM r LEFT JOIN g ON g.kind = r.kind AND g.k = r.k""")
def reference_resolution(d):
    props = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)])
    obj = lambda df, kind, ident, p: df.select(ident.alias("object_id"), F.lit(kind).alias("object_type"), p.alias("properties"))
    c = F.col
    objects = (obj(d.v_views, "view", F.concat(F.lit("v"), c("seq").cast("string")), props(cube_name=c("cube_name"), view_name=c("view_name")))
               .unionByName(obj(d.v_subsets, "subset", F.concat(F.lit("s"), c("seq").cast("string")), props(dimension_name=c("dimension_name"), hierarchy_name=c("hierarchy_name"), subset_name=c("subset_name"))))
               .unionByName(obj(d.part.select("p_brand").distinct(), "file", F.concat(F.lit("f"), "p_brand"), props(display_value=F.concat(F.lit("/in/"), "p_brand", F.lit(".csv"))))))
    return resolve.resolve_references(declared(d), objects).select("process_name", "resolution_status", "candidate_count", "resolved_target_object_id", "review_required")


@check("evidence_count_join", f"""
    WITH e AS (SELECT {norm('process_name')} AS p, relationship_type, {norm('target_expression')} AS x, count(*) AS n FROM v_evidence WHERE line_number < 20 GROUP BY ALL)
    SELECT DISTINCT process_name, v.relationship_type, target_expression, coalesce(n, 1) AS evidence_count FROM v_evidence v LEFT JOIN e ON e.p = {norm('process_name')} AND e.relationship_type = v.relationship_type AND e.x = {norm('target_expression')}""")
def evidence_count_join(d):
    refs = d.v_evidence.select("process_name", "relationship_type", "target_expression").distinct()
    return resolve.with_evidence_count(refs, d.v_evidence.where("line_number < 20"))


@check("edge_semantics", """
    WITH v AS (SELECT relationship_id, max(validation_status) AS s FROM v_validations GROUP BY 1)
    SELECT g.graph_relationship_id AS id, CASE relationship_type WHEN 'BELONGS_TO_DIMENSION' THEN 'Belongs to dimension' WHEN 'USES_DIMENSION' THEN 'Uses dimension' WHEN 'READS_FROM_CUBE' THEN 'Reads from' WHEN 'CALLS_PROCESS' THEN 'Calls' WHEN 'WRITES_TO_CUBE' THEN 'Writes to' ELSE 'Touches Cube' END AS label,
      CASE relationship_type WHEN 'BELONGS_TO_DIMENSION' THEN 'STRUCTURAL' WHEN 'USES_DIMENSION' THEN 'STRUCTURAL' WHEN 'READS_FROM_CUBE' THEN 'DATA_FLOW' WHEN 'CALLS_PROCESS' THEN 'EXECUTION' WHEN 'WRITES_TO_CUBE' THEN 'DATA_FLOW' ELSE 'OTHER' END AS category, coalesce(v.s, 'UNKNOWN') AS validation_status,
      endpoint_state IN ('DYNAMIC', 'PLANNED') AS review_required, edge_key % 10 = 0 AS provenance_available, CASE endpoint_state WHEN 'DYNAMIC' THEN 'dashed' WHEN 'PLANNED' THEN 'dotted' ELSE 'solid' END AS line_style FROM v_graph g LEFT JOIN v ON v.relationship_id = g.graph_relationship_id""")
def edge_semantics(d):
    validations = d.v_validations.withColumnRenamed("relationship_id", "graph_relationship_id")
    provenance = d.v_graph.where("edge_key % 10 = 0").select("graph_relationship_id")
    return resolve.edge_view(d.v_graph, vocab.edge_semantics(d.spark), validations, provenance).select("id", "label", "category", "validation_status", "review_required", "provenance_available", "line_style")


@check("provenance_enrich", f"""
    {PARAM_SQL}, p AS (SELECT row_key, array_to_string(list_sort(list(DISTINCT source_kind)), '|') AS kinds, array_to_string(list_sort(list(DISTINCT calling_process) FILTER (WHERE calling_process IS NOT NULL)), '|') AS callers FROM l WHERE hit GROUP BY 1)
    SELECT r.row_key, p.row_key IS NOT NULL AS parameter_resolution_applied, p.kinds AS resolution_source, coalesce(p.callers, CASE WHEN p.row_key IS NOT NULL THEN '' END) AS calling_processes FROM v_open_refs r LEFT JOIN p ON p.row_key = r.row_key""")
def provenance_enrich(d):
    aliases = d.customer.where("c_custkey % 4 = 3").select(F.concat(F.lit("proc_"), F.col("c_custkey").cast("string")).alias("process_name"), F.lit("sAlias").alias("variable"),
                                                           F.when(F.col("c_custkey") % 8 == 3, "pDim").otherwise("'no ' | pDim").alias("expression"), F.array(F.lit("pDim")).alias("dependencies"))
    _, provenance, _ = parameters.resolve_parameters(d.v_open_refs, d.v_params, d.v_bindings, aliases, d.v_objects)
    # read by the enrichment, the count of callers and their lists
    keyed = window.cut(provenance.join(d.v_open_refs.select("row_key", "process_name", "relationship_type", "target_type", "target_name"), "row_key"))
    enriched = resolve.provenance_enrich(d.v_open_refs, keyed)
    # one row for each chunk of callers, and one where there are none
    listed = enriched.join(resolve.provenance_callers(keyed), "provenance_key", "left")
    callers = F.coalesce("calling_processes", F.when(F.col("parameter_resolution_applied"), F.array().cast("array<string>"))).alias("calling_processes")
    return listed.select("row_key", "parameter_resolution_applied", "resolution_source", callers)


@check("node_view", """
    WITH o AS (SELECT source_id AS id, count(*) AS n FROM v_graph GROUP BY 1), i AS (SELECT target_id AS id, count(*) AS n FROM v_graph GROUP BY 1)
    SELECT node_id, node_type AS type, coalesce(object_name, replace(node_id, 'process::', '')) AS label, coalesce(i.n, 0) AS inbound_count, coalesce(o.n, 0) AS outbound_count, CASE WHEN node_type = 'PROCESS' THEN 'EXECUTION' ELSE 'MODEL_OBJECT' END AS visual_group,
      CASE node_type WHEN 'PROCESS' THEN 'workflow' WHEN 'CUBE' THEN 'database' WHEN 'DIMENSION' THEN 'layers' ELSE 'box' END AS visual_shape, upper(left(node_type, 1)) || lower(substr(node_type, 2)) AS subtitle FROM v_nodes LEFT JOIN o ON o.id = node_id LEFT JOIN i ON i.id = node_id""")
def node_view(d):
    return resolve.node_view(d.v_nodes, d.v_graph).select("node_id", "type", "label", "inbound_count", "outbound_count", "visual_group", "visual_shape", "subtitle")
