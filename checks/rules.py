"""Quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_lineage.operators import quality, sets, window
from . import check
from .columns import EXCEPTIONS, SECRET_SQL, exceptions, t


def model_objects(d):
    return d.v_nodes.select(F.col("node_id").alias("object_id"), F.col("node_type").alias("object_type"), F.coalesce("object_name", F.lit("")).alias("object_name"),
                            F.concat_ws("::", "node_type", F.coalesce("object_name", "node_id")).alias("qualified_name"))


def model_edges(d):
    return d.v_edges.select("relationship_id", "edge_key", F.col("source_id").alias("source_object_id"), F.col("target_id").alias("target_object_id"), F.col("source_id").alias("source_qualified_name"), F.col("target_id").alias("target_qualified_name"), "relationship_type")


NODES = "(SELECT node_id, node_type, object_name FROM v_nodes)"


@check("integrity_checks", f"""
    SELECT 'missing_target' AS check_name, relationship_id AS subject, 'BROKEN_REFERENCE' AS validation_status, 'ERROR' AS severity FROM v_edges WHERE target_id NOT IN (SELECT node_id FROM v_nodes)
    UNION ALL SELECT 'missing_source', relationship_id, 'BROKEN_REFERENCE', 'ERROR' FROM v_edges WHERE source_id NOT IN (SELECT node_id FROM v_nodes)
    UNION ALL SELECT 'duplicate_object_id', node_id, 'DUPLICATE_OBJECT', 'ERROR' FROM v_nodes WHERE node_type IN ('DIMENSION', 'HIERARCHY')
    UNION ALL SELECT 'duplicate_qualified_name', lower(node_type || '::' || object_name), 'DUPLICATE_OBJECT', 'ERROR' FROM v_nodes WHERE node_type IN ('DIMENSION', 'HIERARCHY')
    UNION ALL SELECT 'missing_parent', node_id, 'BROKEN_REFERENCE', 'ERROR' FROM v_nodes WHERE node_type = 'CUBE'""")
def integrity_checks(d):
    own = model_objects(d)
    twice = own.unionByName(own.where("object_type IN ('DIMENSION', 'HIERARCHY')"))
    return quality.integrity(twice.withColumn("parent_object_id", F.when(F.col("object_type") == "CUBE", "cube::gone")), model_edges(d))


ACCEPTED = "(SELECT * FROM v_edges WHERE edge_key % 13 = 0 AND edge_key % 97 <> 0)"


def accepted(d):
    return d.v_edges.where("edge_key % 39 = 0 OR edge_key % 60 = 59").select(
        F.concat(F.lit("X"), "relationship_id").alias("exception_id"), F.when(F.col("edge_key") % 5 == 0, "other").otherwise(" Test ").alias("environment"), F.lit("main").alias("database"), F.lit("accepted_known_issue").alias("disposition"),
        F.lower("source_id").alias("source_object"), "relationship_type", F.col("target_id").alias("target_object"))


JUDGED = """j AS (SELECT v.validation_id, v.relationship_id, v.validation_status, CASE WHEN e.edge_key % 39 = 0 AND e.edge_key % 5 <> 0 THEN 'X' || v.relationship_id WHEN e.edge_key % 60 = 59 AND e.edge_key % 5 <> 0 THEN 'X' || v.relationship_id END AS exception_id
    FROM v_validations v LEFT JOIN v_edges e USING (relationship_id) WHERE v.validation_status = 'BROKEN_REFERENCE')"""


@check("exception_classification", f"""WITH {JUDGED}
    SELECT 'error' AS part, validation_id AS id, exception_id, CASE WHEN exception_id IS NULL THEN 'UNACCEPTED' ELSE 'ACCEPTED' END AS disposition FROM j
    UNION ALL SELECT 'unmatched', '', 'X' || relationship_id, '' FROM v_edges WHERE (edge_key % 39 = 0 OR edge_key % 60 = 59) AND edge_key % 5 <> 0 AND 'X' || relationship_id NOT IN (SELECT exception_id FROM j WHERE exception_id IS NOT NULL)""")
def exception_classification(d):
    judged, unmatched = quality.classify_exceptions(model_edges(d), d.v_validations, accepted(d), "TEST", "Main")
    return judged.select(F.lit("error").alias("part"), F.col("validation_id").alias("id"), "exception_id", "disposition").unionByName(
        unmatched.select(F.lit("unmatched").alias("part"), F.lit("").alias("id"), "exception_id", F.lit("").alias("disposition")))


@check("quality_report", f"""WITH {JUDGED},
    u AS (SELECT count(*) AS n FROM v_edges WHERE (edge_key % 39 = 0 OR edge_key % 60 = 59) AND edge_key % 5 <> 0 AND 'X' || relationship_id NOT IN (SELECT exception_id FROM j WHERE exception_id IS NOT NULL)),
    g AS (SELECT 'catalog_status_complete' AS gate, 0 AS failures UNION ALL SELECT 'source_manifests_complete', 0 UNION ALL SELECT 'adapter_warning_count_zero', 0 UNION ALL SELECT 'object_ids_unique', 0 UNION ALL SELECT 'relationship_ids_unique', 0 UNION ALL SELECT 'unknown_object_count_zero', 0
      UNION ALL SELECT 'blank_object_name_count_zero', (SELECT count(*) FROM v_nodes WHERE object_name IS NULL) UNION ALL SELECT 'orphan_relationship_source_count_zero', (SELECT count(*) FROM v_edges WHERE source_id NOT IN (SELECT node_id FROM v_nodes))
      UNION ALL SELECT 'invalid_relationship_target_link_count_zero', (SELECT count(*) FROM v_edges WHERE target_id NOT IN (SELECT node_id FROM v_nodes)) UNION ALL SELECT 'blank_relationship_source_count_zero', 0 UNION ALL SELECT 'blank_relationship_target_count_zero', 0
      UNION ALL SELECT 'orphan_evidence_source_count_zero', (SELECT count(*) FROM v_evidence WHERE 'process::' || process_name NOT IN (SELECT node_id FROM v_nodes)) UNION ALL SELECT 'blank_evidence_target_count_zero', 0
      UNION ALL SELECT 'orphan_validation_relationship_count_zero', (SELECT count(*) FROM v_validations WHERE relationship_id NOT IN (SELECT relationship_id FROM v_edges)) UNION ALL SELECT 'relationship_validation_coverage_100', (SELECT count(*) FROM v_edges WHERE relationship_id NOT IN (SELECT relationship_id FROM v_validations))
      UNION ALL SELECT 'unaccepted_error_validation_count_zero', (SELECT count(*) FROM j WHERE exception_id IS NULL) UNION ALL SELECT 'accepted_exceptions_are_matched', (SELECT n FROM u))
    SELECT gate, CAST(failures AS BIGINT) AS failures, failures = 0 AS pass, CASE WHEN (SELECT bool_and(failures = 0) FROM g) THEN 'PASS' ELSE 'FAIL' END AS quality_status, (SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE failures = 0) / count(*), 2) FROM g) AS control_score,
      (SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE relationship_id IN (SELECT relationship_id FROM v_validations)) / count(*), 2) FROM v_edges) AS coverage, (SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE validation_status = 'VALID') / count(*), 2) FROM v_validations) AS resolution_rate FROM g""")
def quality_report(d):
    edges = model_edges(d)
    evidence = d.v_evidence.select(F.concat(F.lit("process::"), "process_name").alias("source_object_id"), "target_expression")
    judged, unmatched = quality.classify_exceptions(edges, d.v_validations, accepted(d), "test", "main")
    judged, unmatched = window.cut(judged), window.cut(unmatched)
    counts = window.cut(quality.quality_counts(model_objects(d), edges, evidence, d.v_validations, d.v_edges.where("false"), judged, unmatched))
    gates = quality.quality_gates(counts)
    scores = quality.quality_scores(counts, gates).select("quality_status", F.col("quality_control_score_percent").alias("control_score"), F.col("relationship_validation_coverage_percent").alias("coverage"), F.col("validation_resolution_rate_percent").alias("resolution_rate"))
    return gates.crossJoin(F.broadcast(scores))


@check("exception_register_check", f"""
    WITH r AS (SELECT *, CASE WHEN p_partkey % 50 = 1 THEN 'DUP' ELSE exception_id END AS xid FROM {EXCEPTIONS}), v AS (SELECT p_partkey, CASE WHEN p_partkey % 20 = 3 THEN 'unknown' ELSE 'E' || CAST(p_partkey AS STRING) END AS xid FROM part WHERE p_partkey % 10 = 3)
    SELECT 'exception_ids_unique' AS gate, (SELECT count(*) FROM (SELECT xid FROM r GROUP BY 1 HAVING count(*) > 1)) AS failures UNION ALL SELECT 'targets_present', (SELECT count(*) FROM r WHERE target_type = '')
    UNION ALL SELECT 'targets_unique', (SELECT count(*) FROM (SELECT target_name FROM r WHERE target_type <> '' GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'statuses_active', (SELECT count(*) FROM r WHERE exception_status = 'CLOSED') UNION ALL SELECT 'relationship_counts_positive', (SELECT count(*) FROM r WHERE p_partkey % 30 = 0)
    UNION ALL SELECT 'applied_ids_known', (SELECT count(*) FROM v WHERE xid = 'unknown') UNION ALL SELECT 'applied_to_right_target', (SELECT count(*) FROM v WHERE xid <> 'unknown' AND p_partkey % 7 = 0)
    UNION ALL SELECT unnest(['exception_ids_present', 'excluded_from_score', 'not_required_for_success', 'applied_not_required']), 0 UNION ALL SELECT 'applied_count_matches_register', abs((SELECT count(*) FROM v) - (SELECT sum(p_partkey % 30) FROM r WHERE coalesce(applies_to_validation_records, true)))::BIGINT""")
def exception_register_check(d):
    key = F.expr("CAST(substr(exception_id, 2) AS BIGINT)")
    register = exceptions(d).withColumns({"k": key, "relationship_count": (key % 30).cast("int"), "exclude_from_quality_score": F.lit(True), "required_for_holistic_success": F.lit(False)})
    register = register.withColumn("exception_id", F.when(F.col("k") % 50 == 1, "DUP").otherwise(F.col("exception_id")))
    applied = d.part.where("p_partkey % 10 = 3").select(F.expr("CASE WHEN p_partkey % 20 = 3 THEN 'unknown' ELSE 'E' || CAST(p_partkey AS STRING) END").alias("exception_id"), F.lit("CUBE").alias("target_type"),
                                                        F.expr("CASE WHEN p_partkey % 7 = 0 THEN 'other' ELSE 'MISSING ' || p_name END").alias("target_name"), F.lit(False).alias("required_for_holistic_success"))
    return quality.check_register(register, applied).select("gate", "failures")


@check("exception_register_upsert", """
    WITH r AS (SELECT 'E' || CAST(p_partkey AS STRING) AS id, 'cube' AS tt, 'name ' || CAST(p_partkey AS STRING) AS tn, CAST(p_partkey % 9 AS INT) AS n, p_partkey AS k FROM part),
    up AS (SELECT CASE WHEN k % 3 = 0 THEN id WHEN k % 3 = 1 THEN 'N' || CAST(k AS STRING) ELSE 'I' || CAST(k AS STRING) END AS id, CASE WHEN k % 3 = 2 THEN 'fresh ' || CAST(k AS STRING) ELSE 'NAME ' || CAST(k AS STRING) END AS tn, 100 AS n, k FROM r WHERE k % 7 = 0),
    a AS (SELECT id, tn, n, true AS live FROM r WHERE NOT (k % 7 = 0 AND k % 3 IN (0, 1)) UNION ALL SELECT id, tn, n, false FROM up)
    SELECT id AS exception_id, tn AS target_name, CAST(n AS BIGINT) AS relationship_count, live AS applies_to_validation_records FROM a UNION ALL SELECT 'TOTAL', CAST(count(*) AS STRING), CAST(sum(n) AS BIGINT), true FROM a UNION ALL SELECT 'CANDIDATES', CAST(count(*) AS STRING), CAST(sum(n) AS BIGINT), false FROM a WHERE NOT live""")
def exception_register_upsert(d):
    e = F.expr
    register = d.part.select(e("'E' || CAST(p_partkey AS STRING)").alias("exception_id"), F.lit(None).cast("string").alias("exception_type"), F.lit("cube").alias("target_type"), e("'name ' || CAST(p_partkey AS STRING)").alias("target_name"), e("CAST(p_partkey % 9 AS INT)").alias("relationship_count"))
    updates = d.part.where("p_partkey % 7 = 0").select(
        e("CASE p_partkey % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'N' ELSE 'I' END || CAST(p_partkey AS STRING)").alias("exception_id"), F.lit("DERIVED").alias("exception_type"), F.lit("Cube").alias("target_type"),
        e("CASE WHEN p_partkey % 3 = 2 THEN 'fresh ' ELSE 'NAME ' END || CAST(p_partkey AS STRING)").alias("target_name"), F.lit(100).alias("relationship_count"))
    result, totals = quality.upsert_register(register, updates, "snap", "2026-01-01")
    rows = result.select("exception_id", "target_name", F.col("relationship_count").cast("bigint").alias("relationship_count"), "applies_to_validation_records")
    total = lambda name, count, weight, live: totals.select(F.lit(name).alias("exception_id"), F.col(count).cast("string").alias("target_name"), F.col(weight).alias("relationship_count"), F.lit(live).alias("applies_to_validation_records"))
    return rows.unionByName(total("TOTAL", "exception_count", "relationship_count", True)).unionByName(total("CANDIDATES", "provenance_candidate_exception_count", "provenance_candidate_relationship_count", False))


@check("attribute_inventory_check", """
    WITH a AS (SELECT *, dimension_name || '::' || hierarchy_name || '::' || attribute_name AS q FROM v_attributes)
    SELECT 'identity_present' AS gate, CAST(0 AS BIGINT) AS failures UNION ALL SELECT 'identity_unique', count(*) - count(DISTINCT lower(q)) FROM a UNION ALL SELECT 'names_match', 2 * count(*) FILTER (WHERE seq % 40 = 0) FROM a UNION ALL SELECT 'object_type', 0 UNION ALL SELECT 'data_type', count(*) FILTER (WHERE seq % 9 = 7) FROM a
    UNION ALL SELECT 'alias_flag', count(*) FILTER (WHERE seq % 9 IN (1, 2) AND seq % 60 = 1) FROM a UNION ALL SELECT 'control_flag', count(*) FILTER (WHERE seq % 70 = 0) FROM a UNION ALL SELECT 'parent_known', count(DISTINCT dimension_name) FROM a WHERE dimension_name IN ('NATION_3', 'NATION_4') UNION ALL SELECT 'not_empty', 0""")
def attribute_inventory_check(d):
    from catalog_lineage.functions.classify import attribute_type
    full = F.concat_ws("::", "dimension_name", "hierarchy_name", "attribute_name")
    rows = d.v_attributes.withColumns({"object_type": F.lit("attribute"), "qualified_name": F.when(F.col("seq") % 40 == 0, "wrong").otherwise(full), "a": attribute_type("raw_type"), "is_control": F.col("seq") % 70 == 0})
    rows = rows.withColumns({"object_name": F.col("qualified_name"), "attribute_data_type": F.col("a.data_type"), "is_alias": F.col("a.is_alias") & ~(F.col("seq") % 60 == 1)})
    return quality.check_attributes(rows, d.v_objects.where("object_name NOT IN ('NATION_3', 'NATION_4')")).select("gate", "failures")


@check("manifest_checks", """
    SELECT c_name AS name, c_custkey % 10 <> 0 AS present, CASE WHEN c_custkey % 10 = 0 THEN 'MISSING' WHEN c_custkey % 11 = 1 THEN 'PARTIAL' ELSE 'COMPLETE' END AS status, c_custkey % 10 <> 0 AND c_custkey % 12 <> 5 AS in_order, c_custkey % 10 <> 0 AND c_custkey % 13 <> 2 AS counts_match,
      c_custkey % 10 <> 0 AND c_custkey % 11 <> 1 AND c_custkey % 12 <> 5 AND c_custkey % 13 <> 2 AND c_custkey % 14 <> 3 AND c_custkey % 15 <> 4 AS pass FROM customer""")
def manifest_checks(d):
    e = F.expr
    manifests = d.customer.where("c_custkey % 10 <> 0").select(
        F.col("c_name").alias("name"), e("CASE WHEN c_custkey % 11 = 1 THEN 'PARTIAL' ELSE 'complete' END").alias("status"), e("CASE WHEN c_custkey % 14 = 3 THEN 2 ELSE 0 END").alias("error_count"), e("c_custkey % 15 <> 4").alias("published_current"),
        F.col("c_custkey").alias("declared_count"), F.lit("2026-01-02T00:00:00+00:00").alias("started_at"), e("CASE WHEN c_custkey % 12 = 5 THEN '2026-01-01T00:00:00Z' ELSE '2026-01-02T00:00:01Z' END").alias("completed_at"))
    actual = d.customer.select(F.col("c_name").alias("name"), e("c_custkey + CASE WHEN c_custkey % 13 = 2 THEN 1 ELSE 0 END").alias("actual_count"))
    return quality.check_manifests(d.customer.select(F.col("c_name").alias("name")), manifests, actual)


@check("sensitive_scan", rf"""
    WITH d AS (SELECT '{{"doc_id":' || CAST(doc_id AS STRING) || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}}' AS x, doc_id FROM documents), q AS (SELECT replace(x, '=<redacted>', '') AS x, doc_id FROM d)
    SELECT 'password' AS pattern, count(*) FILTER (WHERE regexp_matches(x, '(?i)password\s*=\s*[^;,\s"]+')) AS row_count FROM q UNION ALL SELECT 'passwd', count(*) FILTER (WHERE regexp_matches(x, '(?i)passwd\s*=\s*[^;,\s"]+')) FROM q UNION ALL SELECT 'pwd', count(*) FILTER (WHERE regexp_matches(x, '(?i)pwd\s*=\s*[^;,\s"]+')) FROM q
    UNION ALL SELECT 'token', count(*) FILTER (WHERE regexp_matches(x, '(?i)token\s*=\s*[^;,\s"]+')) FROM q UNION ALL SELECT 'api_key', count(*) FILTER (WHERE regexp_matches(x, '(?i)api[_-]?key\s*=\s*[^;,\s"]+')) FROM q UNION ALL SELECT 'authorization', count(*) FILTER (WHERE regexp_matches(x, '(?i)authorization\s*=\s*[^;,\s"]+')) FROM q
    UNION ALL SELECT 'bearer', count(*) FILTER (WHERE regexp_matches(x, '(?i)bearer\s+[A-Za-z0-9._~+/-]+=*')) FROM q UNION ALL SELECT 'flagged_not_redacted', count(*) FILTER (WHERE doc_id % 9 = 0 AND doc_id % 2 = 1) FROM q""")
def sensitive_scan(d):
    rows = d.documents.select("doc_id", "text")
    flags = quality.scan_secrets(rows.withColumns({"credential_present": F.col("doc_id") % 9 == 0, "credential_redacted": F.col("doc_id") % 2 == 0})).where("pattern = 'flagged_not_redacted'")
    return quality.scan_secrets(rows).where("pattern <> 'flagged_not_redacted'").unionByName(flags).select("pattern", "row_count")


@check("structural_gates", """
    SELECT 'Cube' AS domain, 'USES_DIMENSION' AS relationship_type, (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 7) AS entity_count, (SELECT count(*) FROM customer) AS edge_count, (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 7) = (SELECT count(*) FROM customer) AS pass
    UNION ALL SELECT 'Hierarchy', 'BELONGS_TO_DIMENSION', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation), true UNION ALL SELECT 'Cube', 'BELONGS_TO_CUBE', (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 7), 0, false""")
def structural_gates(d):
    rules = d.region.limit(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("domain"), F.lit(b).alias("relationship_type")) for a, b in (("Cube", "USES_DIMENSION"), ("Hierarchy", "BELONGS_TO_DIMENSION"), ("Cube", "BELONGS_TO_CUBE"))])))
    return quality.structural_gates(d.v_nodes.withColumn("domain", F.initcap("node_type")), d.v_edges.withColumn("domain", F.initcap("source_type")), rules)


@check("acceptance_decision", """
    SELECT count(*) AS gate_count, count(*) FILTER (WHERE NOT pass) AS failure_count, bool_and(pass) AS overall_pass, CASE WHEN bool_and(pass) THEN 'READY_FOR_SEMANTIC_RESOLUTION' ELSE 'BLOCKED_PENDING_REVIEW' END AS decision FROM (
      SELECT bool_and(ok) AS pass FROM (SELECT count(*) = max(turn) + 1 AND count(DISTINCT turn) = count(*) AS ok FROM v_turns GROUP BY conv_id) UNION ALL SELECT count(*) = 0 FROM v_edges WHERE target_id NOT IN (SELECT node_id FROM v_nodes)
      UNION ALL SELECT count(*) = count(DISTINCT relationship_id) FROM v_edges UNION ALL SELECT (SELECT count(*) FROM v_edges) = (SELECT count(*) FROM v_validations) AND false)""")
def acceptance_decision(d):
    from catalog_lineage.operators.resolve import orphans
    gate = lambda df, name: df.agg(F.lit(name).alias("gate"), F.coalesce(F.bool_and("pass"), F.lit(True)).alias("pass"))
    dangling = orphans(d.v_edges, d.v_nodes, "target_id", "node_id").agg(F.lit("endpoints").alias("gate"), (F.count("*") == 0).alias("pass"))
    return quality.acceptance([
        gate(window.check_positions(d.v_turns, "conv_id", "turn", "member", 0), "ordering"), dangling, gate(window.identity_check(d.v_edges, "relationship_id"), "identity"), gate(sets.reconcile(d.v_edges, d.v_validations), "reconciliation")])
