"""References mined from code text. The expected rows come from the columns the text was made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_lineage import vocab
from catalog_lineage.operators import extract
from catalog_lineage.operators.window import cut
from . import check

LINES = "(SELECT *, string_split(code, chr(10)) AS l FROM v_code)"


@check("explode_statements", f"""
    SELECT 'line' AS part, process_name, unnest([1, 2, 3, 4, 5, 6])::BIGINT AS position, unnest([1, 2, 3, 4, 5, 6])::BIGINT AS line_number, unnest([regexp_replace(l[1], ' # old.*$', ''), l[2], l[3], l[4], l[5], l[6]]) AS statement FROM {LINES}
    UNION ALL SELECT 'statement', process_name, unnest([0, 1, 2, 3, 4, 5])::BIGINT, unnest([1, 1, 2, 3, 4, 5])::BIGINT, unnest([regexp_replace(l[1], ' # old.*$', ''), l[2], l[3], l[4], l[5], l[6]]) FROM {LINES} WHERE o_orderkey % 10 <> 0
    UNION ALL SELECT 'statement', process_name, unnest([0, 1, 2, 3])::BIGINT, unnest([1, 1, 2, 3])::BIGINT, unnest([regexp_replace(l[1], ' # old.*$', ''), l[2], l[3], l[4] || chr(10) || l[5] || chr(10) || l[6]]) FROM {LINES} WHERE o_orderkey % 10 = 0""")
def explode_statements(d):
    text = code(d).select("process_name", "code")
    lines = extract.explode_lines(text).select(F.lit("line").alias("part"), "process_name", F.col("line_number").alias("position"), "line_number", F.col("line_text").alias("statement"))
    parts = extract.explode_statements(text).select(F.lit("statement").alias("part"), "process_name", F.col("statement_position").alias("position"), F.col("statement_line").alias("line_number"), "statement")
    return lines.unionByName(parts)


@check("strip_comments", """
    SELECT cube_name, array_to_string([l[1], '', '', l[5], l[6]], chr(10)) AS stripped, length(rule_text) AS masked_length, 5::BIGINT AS masked_breaks FROM (SELECT *, string_split(rule_text, chr(10)) AS l FROM v_rules)""")
def strip_comments(d):
    masked = extract.mask_comments("rule_text", ("#", "//", "/*"))
    return d.v_rules.select("cube_name", extract.strip_comments("rule_text", ("#", "//", "/*")).alias("stripped"), F.length(masked).alias("masked_length"), F.length(F.regexp_replace(masked, r"[^\n]", "")).alias("masked_breaks"))


CALLS = """
    (SELECT process_name, procedure, o_orderkey, o_custkey, 2 AS line_number, 'CELLGETN' AS function_name, 'sCube|' || q || 'a,b' || q || '|ATTRS(' || q || 'Dim' || CAST(o_custkey % 7 AS STRING) || q || ', sEl, ' || q || 'Cap' || q || q || 'tion' || q || ')' AS args FROM c
    UNION ALL SELECT process_name, procedure, o_orderkey, o_custkey, 2, 'ATTRS', q || 'Dim' || CAST(o_custkey % 7 AS STRING) || q || '|sEl|' || q || 'Cap' || q || q || 'tion' || q FROM c
    UNION ALL SELECT process_name, procedure, o_orderkey, o_custkey, 3, 'CELLPUTN', 'nVal|' || q || 'Target (x)' || q || '|' || q || 'm' || CAST(o_orderkey % 5 AS STRING) || q FROM c WHERE o_orderstatus = 'F'
    UNION ALL SELECT process_name, procedure, o_orderkey, o_custkey, 3, 'ViewZeroOut', q || 'Cube C1' || q || '|sView' FROM c WHERE o_orderstatus = 'O'
    UNION ALL SELECT process_name, procedure, o_orderkey, o_custkey, 3, 'ExecuteProcess', q || 'proc_' || CAST(o_orderkey + 1 AS STRING) || q || '|' || q || 'pDim' || q || '|' || q || 'D' || CAST(o_orderkey % 9 AS STRING) || q || '|' || q || 'pCube' || q || '|sCube' FROM c WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT process_name, procedure, o_orderkey, o_custkey, 6, 'CELLGETS', 'sFull|' || q || 'm' || q FROM c)"""
C = "WITH c AS (SELECT *, chr(39) AS q FROM v_code)"


def code(d):
    """The code table, spread out: a driver table is one small file, which would be read by one task."""
    return d.v_code.select("process_name", "procedure", "code").repartition("process_name")


def calls(d):
    lines = extract.explode_lines(code(d))
    return extract.extract_calls(lines, vocab.code_function_names())


@check("extract_calls", f"{C} SELECT process_name, line_number::BIGINT AS line_number, function_name, args AS arguments FROM {CALLS}")
def extract_calls(d):
    return calls(d).select("process_name", "line_number", "function_name", "arguments")


@check("registry_join", f"""{C} SELECT process_name, function_name, CASE upper(function_name) WHEN 'CELLGETN' THEN 'READS_FROM_CUBE' WHEN 'CELLGETS' THEN 'READS_FROM_CUBE' WHEN 'ATTRS' THEN 'READS_ATTRIBUTE' WHEN 'CELLPUTN' THEN 'WRITES_TO_CUBE' WHEN 'VIEWZEROOUT' THEN 'CLEARS_CUBE' ELSE 'CALLS_PROCESS' END AS relationship,
    CASE upper(function_name) WHEN 'ATTRS' THEN 'attribute' WHEN 'EXECUTEPROCESS' THEN 'process' ELSE 'cube' END AS target_type, CASE upper(function_name) WHEN 'CELLPUTN' THEN string_split(args, '|')[2] ELSE string_split(args, '|')[1] END AS target_expression FROM {CALLS}""")
def registry_join(d):
    return extract.apply_registry(calls(d), vocab.code_registry(d.spark)).select("process_name", "function_name", "relationship", F.col("registry_target_type").alias("target_type"), "target_expression")


@check("symbol_asof", "SELECT process_id, seq, variable, last_value(CASE WHEN is_set THEN {'v': val} END IGNORE NULLS) OVER (PARTITION BY process_id, variable ORDER BY seq).v AS value_at_use FROM v_assign")
def symbol_asof(d):
    rows = extract.resolve_symbols(d.v_assign, ["process_id", "variable"], "seq", F.col("is_set"), F.col("val"))
    return rows.select("process_id", "seq", "variable", "value_at_use")


@check("resolve_concat", """
    WITH RECURSIVE defs AS (SELECT process_id, seq, variable, kind, dep, CASE WHEN kind = 'lit' THEN 'L' || CAST(seq % 50 AS STRING) ELSE '_s' END AS part FROM v_assign WHERE kind <> 'use'),
    point AS (SELECT process_id, seq, variable, 0 AS is_read FROM defs UNION ALL SELECT process_id, seq, dep, 1 FROM defs WHERE kind = 'concat'),
    link AS (SELECT process_id, seq, is_read, max(CASE WHEN is_read = 0 THEN seq END) OVER (PARTITION BY process_id, variable ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dep_seq FROM point),
    val(process_id, seq, value) AS (SELECT process_id, seq, part FROM defs WHERE kind = 'lit' UNION ALL
      SELECT f.process_id, f.seq, val.value || f.part FROM val JOIN link ON link.process_id = val.process_id AND link.dep_seq = val.seq AND link.is_read = 1 JOIN defs f ON f.process_id = link.process_id AND f.seq = link.seq),
    use_point AS (SELECT process_id, seq, variable, 0 AS is_read FROM defs UNION ALL SELECT process_id, seq, variable, 1 FROM v_assign WHERE kind = 'use'),
    use_link AS (SELECT process_id, seq, variable, is_read, max(CASE WHEN is_read = 0 THEN seq END) OVER (PARTITION BY process_id, variable ORDER BY seq) AS dep_seq FROM use_point)
    SELECT CAST(u.seq AS STRING) AS use_id, coalesce(val.value, u.variable) AS resolved_value, CASE WHEN val.value IS NULL THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS confidence
    FROM use_link u LEFT JOIN val ON val.process_id = u.process_id AND val.seq = u.dep_seq WHERE u.is_read = 1""")
def resolve_concat(d):
    rows = d.v_assign.withColumnRenamed("process_id", "process_name")
    expression = F.expr("CASE kind WHEN 'lit' THEN chr(39) || 'L' || CAST(seq % 50 AS STRING) || chr(39) WHEN 'concat' THEN dep || ' | ' || chr(39) || '_s' || chr(39) WHEN 'bad' THEN 'STR(1, 2)' ELSE variable END")
    defs = rows.where("kind <> 'use'").select("process_name", "seq", "variable", expression.alias("expression"))
    uses = rows.where("kind = 'use'").select(F.col("seq").alias("use_id"), "process_name", "seq", expression.alias("expression"))
    return extract.resolve_expressions(defs, uses).select("use_id", "resolved_value", "confidence")


@check("target_compose", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '<missing argument>' ELSE concat_ws('.', CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'T' || o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 'H' END, CASE WHEN o_orderkey % 5 = 0 THEN 'A' END) END AS target_name,
      CASE WHEN o_orderkey % 11 = 0 THEN 'UNRESOLVED' WHEN o_orderkey % 2 = 0 AND o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 AND o_orderkey % 4 = 1 THEN 'UNRESOLVED' WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 AND o_orderkey % 4 = 2 THEN 'RESOLVED' ELSE 'CONFIRMED' END AS confidence FROM orders""")
def target_compose(d):
    e = F.expr
    rows = d.orders.select(
        "o_orderkey", e("CASE WHEN o_orderkey % 11 = 0 THEN '<missing argument>' ELSE 'x' END").alias("target_expression"), e("'T' || o_orderstatus").alias("target_value"), F.lit("CONFIRMED").alias("target_confidence"),
        e("CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END").alias("parent_value"), e("CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'UNRESOLVED' ELSE 'CONFIRMED' END END").alias("parent_confidence"),
        e("CASE WHEN o_orderkey % 3 = 0 THEN 'H' END").alias("hierarchy_value"), e("CASE WHEN o_orderkey % 3 = 0 THEN 'RESOLVED' END").alias("hierarchy_confidence"),
        e("CASE WHEN o_orderkey % 5 = 0 THEN 'A' END").alias("attribute_value"), e("CASE WHEN o_orderkey % 5 = 0 THEN CASE o_orderkey % 4 WHEN 1 THEN 'UNRESOLVED' WHEN 2 THEN 'RESOLVED' ELSE 'CONFIRMED' END END").alias("attribute_confidence"))
    return extract.compose_target(rows).select("o_orderkey", "target_name", "confidence")


@check("edge_rewrite", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'READS_ATTRIBUTE' WHEN o_orderkey % 3 = 1 THEN 'READS_FROM_CUBE' ELSE 'CLEARS_CUBE' END AS relationship_type, CASE WHEN o_orderkey % 3 = 0 THEN 'attribute' ELSE 'cube' END AS target_type,
      CASE WHEN o_orderkey % 3 = 0 THEN 'Dim' || o_orderstatus || '.last' ELSE 'Cube ' || o_orderstatus END AS target_name, CASE WHEN o_orderkey % 3 = 0 THEN 'UNRESOLVED' ELSE 'CONFIRMED' END AS confidence FROM orders
    UNION ALL SELECT o_orderkey, 'USES_VIEW', 'view', 'Cube ' || o_orderstatus || '.v', 'RESOLVED' FROM orders WHERE o_orderkey % 3 = 2""")
def edge_rewrite(d):
    e = F.expr
    rows = d.orders.select(
        "o_orderkey", e("CASE WHEN o_orderkey % 3 = 2 THEN 'VIEWZEROOUT' ELSE 'CELLGETS' END").alias("function_key"), e("CASE WHEN o_orderkey % 3 = 2 THEN 'CLEARS_CUBE' ELSE 'READS_FROM_CUBE' END").alias("relationship"),
        F.lit("cube").alias("registry_target_type"), e("CASE WHEN o_orderkey % 3 = 0 THEN '}ElementAttributes_Dim' || o_orderstatus ELSE 'Cube ' || o_orderstatus END").alias("target_name"), F.lit("x").alias("target_expression"),
        F.lit("CONFIRMED").alias("confidence"), F.lit(None).cast("string").alias("attribute_name"), F.array(F.lit("a"), F.lit("b"), F.lit("last")).alias("arguments"), F.lit("last").alias("last_value"), F.lit("UNRESOLVED").alias("last_confidence"),
        e("CASE WHEN o_orderkey % 3 = 2 THEN 'USES_VIEW' END").alias("second_relationship"), e("CASE WHEN o_orderkey % 3 = 2 THEN 'view' END").alias("second_type"), F.lit(1).alias("second_target_arg"),
        F.lit("v").alias("second_target_value"), F.lit("CONFIRMED").alias("second_target_confidence"), e("'Cube ' || o_orderstatus").alias("second_parent_value"), F.lit("RESOLVED").alias("second_parent_confidence"))
    return extract.rewrite_edges(rows).select("o_orderkey", "relationship_type", "target_type", "target_name", "confidence")


@check("process_evidence", f"""{C}
    SELECT process_name, procedure, line_number::BIGINT AS line_number, function_name, CASE upper(function_name) WHEN 'CELLGETN' THEN 'READS_FROM_CUBE' WHEN 'CELLGETS' THEN 'READS_FROM_CUBE' WHEN 'ATTRS' THEN 'READS_ATTRIBUTE' WHEN 'CELLPUTN' THEN 'WRITES_TO_CUBE' WHEN 'VIEWZEROOUT' THEN 'CLEARS_CUBE' ELSE 'CALLS_PROCESS' END AS relationship_type,
      CASE upper(function_name) WHEN 'CELLGETN' THEN 'Cube C' || CAST(o_custkey % 50 AS STRING) WHEN 'CELLGETS' THEN 'Cube C' || CAST(o_custkey % 50 AS STRING) || '_x' WHEN 'ATTRS' THEN 'Dim' || CAST(o_custkey % 7 AS STRING) || '.Cap' || chr(39) || 'tion' WHEN 'CELLPUTN' THEN 'Target (x)' WHEN 'VIEWZEROOUT' THEN 'Cube C1' ELSE 'proc_' || CAST(o_orderkey + 1 AS STRING) END AS target_name,
      CASE WHEN upper(function_name) IN ('CELLGETN', 'CELLGETS') THEN 'RESOLVED' ELSE 'CONFIRMED' END AS confidence, CASE WHEN function_name = 'CELLPUTN' THEN 'm' || CAST(o_orderkey % 5 AS STRING) END AS target_measure FROM {CALLS}
    UNION ALL SELECT process_name, procedure, 3, 'ViewZeroOut', 'USES_VIEW', 'Cube C1.sView', 'UNRESOLVED', NULL FROM c WHERE o_orderstatus = 'O'""")
def process_evidence(d):
    rows = extract.process_evidence(code(d), vocab.code_registry(d.spark))
    return rows.select("process_name", "procedure", "line_number", "function_name", "relationship_type", "target_name", "confidence", "target_measure")


@check("feeder_flag", """
    WITH r AS (SELECT * FROM v_rules)
    SELECT cube_name AS source_cube, 'READS_FROM' AS relationship_type, p_name AS target_name, 'DB' AS function_name, 1::BIGINT AS line_number, false AS is_feeder, 'HIGH' AS confidence, NULL AS dimension_name, NULL AS attribute_name FROM r
    UNION ALL SELECT cube_name, 'USES_ATTRIBUTE', p_brand, 'ATTRN', 1, false, 'HIGH', p_brand, 'W' FROM r UNION ALL SELECT cube_name, 'FEEDS', p_brand, 'DB', 5, true, 'HIGH', NULL, NULL FROM r
    UNION ALL SELECT cube_name, 'READS_FROM', NULL, 'DB', 6, false, 'MEDIUM', NULL, NULL FROM r WHERE p_size % 2 = 0""")
def feeder_flag(d):
    rows = extract.rule_evidence(d.v_rules.select("cube_name", "rule_text"), vocab.rule_registry(d.spark))
    return rows.select("source_cube", "relationship_type", "target_name", "function_name", "line_number", "is_feeder", "confidence", "dimension_name", "attribute_name")


@check("parameter_tables", """
    WITH c AS (SELECT *, chr(39) AS q FROM v_code)
    SELECT 'parameter' AS part, process_name AS owner, parameter_name AS name, nullif(default_value, '') AS value, position::BIGINT AS position FROM v_params
    UNION ALL SELECT 'binding', 'proc_' || CAST(o_orderkey + 1 AS STRING), 'pDim', 'D' || CAST(o_orderkey % 9 AS STRING), 3 FROM c WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT 'binding', 'proc_' || CAST(o_orderkey + 1 AS STRING), 'pCube', NULL, 3 FROM c WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT 'alias', process_name, 'sFull', 'sCube', 5 FROM c""")
def parameter_tables(d):
    definitions = d.v_params.groupBy("process_name").agg(F.array_sort(F.collect_list(F.struct("position", F.col("parameter_name").alias("name"), F.col("default_value").alias("value")))).alias("parameters"))
    row = lambda df, part, owner, name, value, position: df.select(F.lit(part).alias("part"), F.col(owner).alias("owner"), F.col(name).alias("name"), value.alias("value"), F.col(position).alias("position"))
    lines = extract.explode_lines(code(d))
    return (
        row(extract.parameters(definitions), "parameter", "process_name", "parameter_name", F.col("default_value"), "position")
        .unionByName(row(extract.bindings(calls(d)), "binding", "called_process", "parameter_name", F.col("resolved_value"), "line_number"))
        .unionByName(row(extract.aliases(extract.assignments(lines)), "alias", "process_name", "variable", F.array_join("dependencies", "|"), "line_number"))
    )


SUMMARY = (
    "unique_function_count", "unclassified_function_count", "total_function_occurrences", "supported_occurrences", "lineage_function_occurrences", "dynamic_function_occurrences",
    "syntactic_coverage_percent", "lineage_coverage_percent", "unsupported_or_review_functions", "ruled_cube_count", "malformed_call_count",
)


@check("function_coverage", """
    WITH o AS (SELECT 'DB' AS function_name, cube_name, 1 AS line_number FROM v_rules UNION ALL SELECT 'DB', cube_name, 5 FROM v_rules UNION ALL SELECT 'DB', cube_name, 6 FROM v_rules WHERE p_size % 2 = 0 UNION ALL SELECT 'ATTRN', cube_name, 1 FROM v_rules
      UNION ALL SELECT 'FOO' || CAST(p_size % 4 AS STRING), cube_name, 6 FROM v_rules WHERE p_size % 2 = 0
      UNION ALL SELECT unnest(['IF', 'ROUND', 'CONSOLIDATECHILDREN', 'CUBEATTRS']), cube_name, 7 FROM v_rules WHERE p_size % 3 = 0),
    r AS (SELECT * FROM (VALUES ('DB', 'SUPPORTED', 'DIRECT'), ('ATTRN', 'SUPPORTED', 'DIRECT'), ('IF', 'PARTIALLY_SUPPORTED', 'DYNAMIC'), ('ROUND', 'INTENTIONALLY_IGNORED', 'NON_LINEAGE'), ('CONSOLIDATECHILDREN', 'SUPPORTED', 'CONTEXTUAL'), ('CUBEATTRS', 'NOT_SUPPORTED', 'CONTEXTUAL')) AS t(function_name, status, category)),
    s AS (SELECT o.*, status, category, row_number() OVER (PARTITION BY function_name ORDER BY cube_name, line_number) AS rn FROM o LEFT JOIN r USING (function_name)),
    k AS (SELECT count(DISTINCT function_name) AS unique_function_count, count(DISTINCT function_name) FILTER (WHERE status IS NULL) AS unclassified_function_count, count(*) AS total_function_occurrences,
      count(*) FILTER (WHERE status = 'SUPPORTED') AS supported_occurrences, count(*) FILTER (WHERE category IN ('DIRECT', 'CONTEXTUAL')) AS lineage_function_occurrences, count(*) FILTER (WHERE category = 'DYNAMIC') AS dynamic_function_occurrences,
      round(100.0::DOUBLE * count(status) / count(*), 2) AS syntactic_coverage_percent, round(100.0::DOUBLE * count(*) FILTER (WHERE category IN ('DIRECT', 'CONTEXTUAL') AND status = 'SUPPORTED') / count(*) FILTER (WHERE category IN ('DIRECT', 'CONTEXTUAL')), 2) AS lineage_coverage_percent,
      array_to_string(list_sort(list(DISTINCT function_name) FILTER (WHERE status IS NULL OR status IN ('NOT_SUPPORTED', 'PARTIALLY_SUPPORTED'))), '|') AS unsupported_or_review_functions,
      (SELECT count(*) FROM v_rules) AS ruled_cube_count, (SELECT count(*) FROM v_rules WHERE p_size % 5 = 0) AS malformed_call_count FROM s)
    SELECT function_name, count(*) AS occurrence_count, count(DISTINCT cube_name) AS cube_count, coalesce(any_value(status), 'REVIEW_REQUIRED') AS parser_status, coalesce(any_value(category), 'REVIEW_REQUIRED') AS lineage_category, CASE WHEN any_value(status) IS NULL THEN 'UNCLASSIFIED' ELSE 'CLASSIFIED' END AS registry_status,
      string_agg(cube_name || ':' || CAST(line_number AS STRING), '|' ORDER BY rn) FILTER (WHERE rn <= 5) AS sample_evidence, any_value(k.*) FROM s, k GROUP BY 1""".replace("any_value(k.*)", ", ".join(f"any_value({c}) AS {c}" for c in SUMMARY)))
def function_coverage(d):
    more = F.concat("rule_text", F.when(F.col("p_size") % 3 == 0, "\nx = IF(a, ROUND(b), CONSOLIDATECHILDREN('d')) | CUBEATTRS('c', 'd');").otherwise(""), F.when(F.col("p_size") % 5 == 0, "\ny = TRIM(z;").otherwise(""))
    rules = d.v_rules.select("cube_name", more.alias("rule_text")).repartition("cube_name")
    profile = cut(extract.function_coverage(rules))
    return profile.crossJoin(F.broadcast(extract.coverage_summary(profile, rules).select(*SUMMARY))).select("function_name", "occurrence_count", "cube_count", "parser_status", "lineage_category", "registry_status", "sample_evidence", *SUMMARY)
