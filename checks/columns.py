"""Sources, sinks, column functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_lineage.functions import classify, ids, text
from catalog_lineage.operators import filters
from catalog_lineage.sources import io
from catalog_lineage.vocab import MISSING_STATUS_BY_DOMAIN, lookup
from . import check, scratch

WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def t(x: str) -> str:
    return f"trim(coalesce({x}, ''), {WS})"


def norm(x: str) -> str:
    return rf"lower(regexp_replace({t(x)}, '\s+', ' ', 'g'))"


OBJECT_SCHEMA = "object_type string, object_name string, seq bigint"

# ---- sources and sinks --------------------------------------------------------------


@check("read_records", "SELECT object_type, object_name, seq FROM v_objects")
def read_records(d):
    path = scratch(d.spark) + "/objects.json"
    d.v_objects.write.json(path)
    return io.read_records(d.spark, path, OBJECT_SCHEMA, lines=True)


@check("read_wrapped", "SELECT object_type, object_name, seq FROM v_objects")
def read_wrapped(d):
    """All objects, a thousand to a JSON line: half of the lines as arrays, half as objects that hold the array under a key."""
    base = scratch(d.spark)
    record = F.struct("object_type", "object_name", "seq")
    lists = d.v_objects.groupBy(F.expr("seq div 1000").alias("part")).agg(F.collect_list(record).alias("items"))
    lists.where("part % 2 = 0").select(F.to_json("items").alias("value")).write.text(f"{base}/arrays.json")
    lists.where("part % 2 = 1").select(F.to_json(F.struct(F.size("items").alias("count"), "items")).alias("value")).write.text(f"{base}/wrapped.json")
    read = lambda name: io.read_records(d.spark, f"{base}/{name}.json", OBJECT_SCHEMA, wrapper_keys=("records", "items"), lines=True)
    return read("arrays").unionByName(read("wrapped"))


@check("read_optional", "SELECT object_type, CAST(count(*) AS BIGINT) AS row_count FROM v_objects GROUP BY 1")
def read_optional(d):
    base = scratch(d.spark)
    d.v_objects.write.parquet(f"{base}/objects")
    here = io.read_records(d.spark, f"{base}/objects", OBJECT_SCHEMA, required=False)
    gone = io.read_records(d.spark, f"{base}/nowhere", OBJECT_SCHEMA, required=False)
    return here.unionByName(gone).groupBy("object_type").agg(F.count("*").alias("row_count"))


@check("read_preferred", "SELECT 'LEGACY_INPUT_USED' AS warning_type, object_type, CAST(count(*) AS BIGINT) AS row_count FROM v_objects GROUP BY 2")
def read_preferred(d):
    base = scratch(d.spark)
    d.v_objects.write.parquet(f"{base}/legacy")
    df, warnings = io.read_preferred(d.spark, [f"{base}/preferred", f"{base}/legacy"], OBJECT_SCHEMA)
    return df.groupBy("object_type").agg(F.count("*").alias("row_count")).crossJoin(F.broadcast(warnings.select("warning_type")))


@check("publish_complete", """
    SELECT 'first' AS snapshot_id, 'COMPLETE' AS status, true AS published_current, CAST(0 AS BIGINT) AS error_count, (SELECT count(*) FROM v_objects) AS objects_count, (SELECT count(*) FROM v_edges) AS edges_count
    UNION ALL SELECT 'second', 'PARTIAL', false, (SELECT count(*) FROM v_edges WHERE edge_key % 97 = 0), (SELECT count(*) FROM v_objects), (SELECT count(*) FROM v_edges)""")
def publish_complete(d):
    root = scratch(d.spark)
    errors = d.v_edges.where("edge_key % 97 = 0").select("relationship_id")
    outputs = {"objects": d.v_objects, "edges": d.v_edges}
    first = io.publish(outputs, errors.where("false"), root, "first")
    second = io.publish(outputs, errors, root, "second")
    return first.unionByName(second).select("snapshot_id", "status", "published_current", "error_count", "objects_count", "edges_count")


@check("read_current", "SELECT relationship_type, CAST(count(*) AS BIGINT) AS row_count FROM v_edges GROUP BY 1")
def read_current(d):
    root = scratch(d.spark)
    io.publish({"edges": d.v_edges}, d.v_edges.where("false"), root, "kept")
    io.publish({"edges": d.v_edges.where("edge_key % 2 = 0")}, d.v_edges.select("relationship_id"), root, "refused")
    return io.read_current(d.spark, root, ["edges"])["edges"].groupBy("relationship_type").agg(F.count("*").alias("row_count"))


@check("review_export", """SELECT relationship_id, relationship_type, source_id || ' | ' || target_id AS endpoints FROM v_edges WHERE edge_key % 5 = 0""")
def review_export(d):
    path = scratch(d.spark) + "/review"
    rows = d.v_edges.withColumns({
        "decision_type": F.when(F.col("edge_key") % 5 == 0, "REVIEW").otherwise("AUTOMATIC"), "endpoints": F.array("source_id", "target_id"),
    })
    io.write_review_csv(rows, path, ["relationship_id", "relationship_type", "endpoints"])
    return d.spark.read.schema("relationship_id string, relationship_type string, endpoints string").option("header", True).csv(path)


# ---- columns -------------------------------------------------------------------------

@check("norm_clean_token", f"SELECT seq, {t('name')} AS clean_name, replace(upper({t('name')}), ' ', '_') AS token_name FROM v_names")
def norm_clean_token(d):
    return d.v_names.select("seq", text.clean("name").alias("clean_name"), text.token("name").alias("token_name"))


@check("norm_key", f"""SELECT seq, {norm('name')} AS name_key, {norm(f"CASE WHEN left({t('name')}, 1) = chr(34) AND right({t('name')}, 1) = chr(34) AND length({t('name')}) > 1 THEN substr({t('name')}, 2, length({t('name')}) - 2) ELSE name END")} AS match_key FROM v_names""")
def norm_key(d):
    return d.v_names.select("seq", text.norm_key("name").alias("name_key"), text.match_value("name").alias("match_key"))


@check("first_nonblank", f"SELECT seq, CASE WHEN {t('name')} <> '' THEN name WHEN seq % 60 = 2 THEN object_type ELSE 'none' END AS chosen FROM v_names")
def first_nonblank(d):
    other = F.when(F.col("seq") % 60 == 2, F.col("object_type"))
    return d.v_names.select("seq", text.first_nonblank("name", other, F.lit("none")).alias("chosen"))


@check("object_scope", """SELECT seq, left(object_name, 1) = '}' AS is_control, CASE WHEN left(object_name, 1) = '}' THEN 'CONTROL' ELSE 'REGULAR' END AS catalog_scope,
    left(object_name, 1) = '}' OR lower(object_name) LIKE 'sys!_%' ESCAPE '!' OR lower(object_name) LIKE 'sys %' AS is_system_object
    FROM (SELECT seq, CASE WHEN seq % 9 = 1 THEN 'SYS_' || object_name WHEN seq % 9 = 2 THEN 'sys ' || object_name ELSE object_name END AS object_name FROM v_objects)""")
def object_scope(d):
    named = d.v_objects.withColumn("object_name", F.expr("CASE WHEN seq % 9 = 1 THEN 'SYS_' || object_name WHEN seq % 9 = 2 THEN 'sys ' || object_name ELSE object_name END"))
    return classify.with_scope(named, "object_name").select("seq", "is_control", "catalog_scope", "is_system_object")


JSON_TEXT = """'{"a_type":"' || object_type || '","b_seq":' || CAST(seq AS VARCHAR) || ',"c_none":null,"d_name":"' || object_name || '"}'"""


@check("stable_hash", f"SELECT seq, sha256({JSON_TEXT}) AS full_hash, left(sha256({JSON_TEXT}), 24) AS short_hash FROM v_objects")
def stable_hash(d):
    fields = {"d_name": F.col("object_name"), "a_type": F.col("object_type"), "c_none": F.lit(None).cast("string"), "b_seq": F.col("seq")}
    return d.v_objects.select("seq", ids.stable_hash(**fields).alias("full_hash"), ids.stable_hash(24, **fields).alias("short_hash"))


@check("hash_parts", f"SELECT seq, sha256(lower({t('object_type')} || chr(31) || {t('name')})) AS parts_hash FROM v_names")
def hash_parts(d):
    return d.v_names.select("seq", ids.hash_parts("object_type", "name").alias("parts_hash"))


@check("qualified_name", f"SELECT seq, CASE WHEN {t('name')} <> '' THEN object_type || '::' || {t('name')} END AS own_name, CASE WHEN {t('name')} <> '' THEN 'database::main::' || object_type || '::' || {t('name')} END AS child_name FROM v_names")
def qualified_name(d):
    return d.v_names.select("seq", ids.qualified_name(F.col("object_type"), F.col("name")).alias("own_name"),
                            ids.qualified_name(F.col("object_type"), F.col("name"), F.lit("database::main")).alias("child_name"))


@check("canonical_key", f"""
    SELECT 'o' AS part, seq, upper(object_type) || '|' || {norm('object_name')} AS identity, object_type || '::' || {t('object_name')} AS object_id FROM v_objects
    UNION ALL SELECT 'a', seq, 'ATTRIBUTE|' || lower(dimension_name) || '|' || lower(hierarchy_name) || '|' || lower(attribute_name), 'attribute::' || dimension_name || '::' || hierarchy_name || '::' || attribute_name FROM v_attributes
    UNION ALL SELECT 's', seq, 'SUBSET|' || lower(dimension_name) || '|' || lower(hierarchy_name) || '|PUBLIC|<none>|' || lower(subset_name), 'subset::' || subset_name FROM v_subsets""")
def canonical_key(d):
    shape = lambda df, part: df.select(F.lit(part).alias("part"), "seq", ids.canonical_key(df).alias("identity"), ids.canonical_id(df).alias("object_id"))
    attributes = d.v_attributes.withColumn("object_type", F.lit("attribute"))
    subsets = d.v_subsets.withColumns({"object_type": F.lit("subset"), "object_name": F.col("subset_name")})
    return shape(d.v_objects, "o").unionByName(shape(attributes, "a")).unionByName(shape(subsets, "s"))


@check("relationship_identity", """
    SELECT relationship_id, 'object-relationship::' || sha256(lower(source_id || chr(31) || relationship_type || chr(31) || target_id || chr(31) || 'STRUCTURAL')) AS object_relationship_id,
      left(sha256('{"line_number":' || CAST(edge_key AS VARCHAR) || ',"ordinal":null,"procedure":"Data","relationship_type":"' || relationship_type || '","snapshot_id":"s1","source_object_id":"' || source_id || '","target_object_id":"' || target_id || '","target_qualified_name":"' || lower(target_id) || '"}'), 24) AS catalog_id FROM v_edges""")
def relationship_identity(d):
    return d.v_edges.select("relationship_id", ids.relationship_id("source_id", "relationship_type", "target_id", F.lit("structural")).alias("object_relationship_id"),
                            ids.catalog_relationship_id(F.lit("s1"), "source_id", "target_id", "target_id", "relationship_type", F.lit(None).cast("int"), F.lit("Data"), F.col("edge_key")).alias("catalog_id"))


@check("reference_identity", f"""
    SELECT seq, 'view-reference::' || sha256(lower('VIEW_REFERENCE' || chr(31) || {norm('cube_name')} || chr(31) || {norm('view_name')})) AS view_ref,
      'file-reference::' || sha256(lower('FILE_REFERENCE' || chr(31) || {norm("replace('/in/' || cube_name, '/', chr(92))")})) AS file_ref,
      'subset-reference::' || sha256(lower('SUBSET_REFERENCE' || chr(31) || {norm('cube_name')} || chr(31) || {norm('cube_name')} || chr(31) || {norm('view_name')})) AS subset_ref,
      'configured-source::' || sha256(lower('CONFIGURED_SOURCE' || chr(31) || {norm('cube_name')} || chr(31) || 'ODBC' || chr(31) || {norm('view_name')})) AS source_ref FROM v_views""")
def reference_identity(d):
    return d.v_views.select(
        "seq", ids.view_reference_id("cube_name", "view_name").alias("view_ref"), ids.file_reference_id(F.concat(F.lit("/in/"), "cube_name")).alias("file_ref"),
        ids.subset_reference_id("cube_name", F.lit(None).cast("string"), "view_name").alias("subset_ref"), ids.configured_source_id("cube_name", F.lit("odbc"), "view_name").alias("source_ref"))


@check("enum_map", """
    SELECT seq, CASE WHEN object_type IN ('chore', 'dimension', 'process', 'cube') THEN object_type ELSE 'unknown' END AS object_type, CASE seq % 5 WHEN 0 THEN 'READS_FROM_CUBE' WHEN 1 THEN 'FEEDS_CUBE' WHEN 2 THEN 'REFERENCES' WHEN 3 THEN 'USES_VIEW' ELSE 'REFERENCES' END AS rel,
      CASE seq % 4 WHEN 0 THEN 'RESOLVED' WHEN 1 THEN 'PARAMETERIZED' WHEN 2 THEN 'CONFIRMED' ELSE 'UNRESOLVED' END AS rating, CASE seq % 3 WHEN 0 THEN 'VALID' ELSE 'NOT_CROSS_CHECKED' END AS status FROM v_objects""")
def enum_map(d):
    pick = lambda n, *vals: F.element_at(F.array(*[F.lit(v) for v in vals]), (F.col("seq") % n + 1).cast("int"))
    return d.v_objects.select(
        "seq", classify.object_type_of(F.concat(F.lit(" "), F.upper("object_type"))).alias("object_type"),
        classify.relationship_type_of(pick(5, "reads_from", "FEEDS", "USES_ATTRIBUTE", "Uses_View", "nonsense")).alias("rel"),
        classify.confidence_of(pick(4, "high", "MEDIUM", "Confirmed", "")).alias("rating"), classify.validation_status_of(pick(3, "valid", "??", None)).alias("status"))


@check("attribute_type_norm", """
    SELECT seq, CASE WHEN raw_type = '' THEN 'S' ELSE raw_type END AS raw_type, CASE WHEN upper(raw_type) IN ('1', 'N', 'NUMERIC', 'NUMBER') THEN 'NUMERIC' WHEN upper(raw_type) IN ('3', 'A', 'ALIAS') THEN 'ALIAS'
      WHEN upper(raw_type) IN ('2', 'S', 'STRING', 'TEXT', '') THEN 'STRING' ELSE 'UNKNOWN' END AS data_type, upper(raw_type) IN ('3', 'A', 'ALIAS') AS is_alias FROM v_attributes""")
def attribute_type_norm(d):
    return d.v_attributes.select("seq", classify.attribute_type("raw_type").alias("x")).select("seq", "x.*")


@check("split_parent_leaf", """
    SELECT ref_key, CASE WHEN contains(target_name, '.') THEN regexp_extract(target_name, '^(.*)\\.[^.]*$', 1) ELSE '' END AS parent, CASE WHEN contains(target_name, '.') THEN regexp_extract(target_name, '\\.([^.]*)$', 1) ELSE target_name END AS leaf,
      array_to_string(list_filter(string_split(target_name, '::'), lambda x: x <> ''), '|') AS parts FROM v_refs""")
def split_parent_leaf(d):
    parent, leaf = text.split_parent_leaf("target_name")
    return d.v_refs.select("ref_key", parent.alias("parent"), leaf.alias("leaf"), text.split_qualified("target_name").alias("parts"))


CONTEXT_SQL = """
    SELECT ref_key, domain, CASE WHEN domain = 'VIEW' THEN CASE WHEN n >= 2 THEN parts[-2] ELSE parent END ELSE '' END AS cube_name,
      CASE WHEN domain IN ('SUBSET', 'ATTRIBUTE') THEN CASE WHEN n >= 3 THEN parts[-3] ELSE parent END WHEN domain = 'HIERARCHY' THEN CASE WHEN n >= 2 THEN parts[-2] ELSE parent END ELSE '' END AS dimension_name,
      CASE WHEN domain IN ('SUBSET', 'ATTRIBUTE') THEN CASE WHEN n >= 2 THEN parts[-2] ELSE '' END WHEN domain = 'HIERARCHY' THEN leaf ELSE '' END AS hierarchy_name,
      CASE WHEN domain = 'ATTRIBUTE' THEN leaf ELSE '' END AS attribute_name, CASE WHEN domain = 'SUBSET' THEN leaf ELSE '' END AS subset_name, CASE WHEN domain = 'VIEW' THEN leaf ELSE '' END AS view_name, target_name, relationship_type, validation_status, target_type, process_name
    FROM (SELECT *, len(parts) AS n, CASE WHEN contains(target_name, '.') THEN regexp_extract(target_name, '^(.*)\\.[^.]*$', 1) ELSE '' END AS parent,
        CASE WHEN contains(target_name, '.') THEN regexp_extract(target_name, '\\.([^.]*)$', 1) ELSE target_name END AS leaf
      FROM (SELECT *, list_filter(string_split(target_name, '::'), lambda x: x <> '') AS parts, CASE WHEN target_type = 'view' THEN 'VIEW' WHEN target_type = 'subset' THEN 'SUBSET' WHEN target_type = 'attribute' THEN 'ATTRIBUTE' ELSE 'HIERARCHY' END AS domain FROM v_refs))"""


@check("extract_context", f"SELECT ref_key, cube_name, dimension_name, hierarchy_name, attribute_name, subset_name, view_name, target_name FROM ({CONTEXT_SQL})")
def extract_context(d):
    from catalog_lineage.operators.resolve import with_context
    return with_context(d.v_refs).select("ref_key", "cube_name", "dimension_name", "hierarchy_name", "attribute_name", "subset_name", "view_name", "target_name")


DYNAMIC = lambda x: " OR ".join(f"contains({x}, '{m}')" for m in ("|", "${", "@{", "%", "&", "[", "]", "??")) + f" OR regexp_matches({x}, '^[snpv][A-Z_][A-Za-z0-9_]*$')"


@check("dynamic_reference_flag", f"""
    SELECT 'd' AS part, doc_id AS id, {DYNAMIC(t('text'))} AS is_dynamic, false AS is_dynamic_expression FROM documents
    UNION ALL SELECT 'p', page_id, {DYNAMIC('url')}, contains(url, '#') OR contains(url, '%') OR contains(url, '&') OR contains(url, '|') OR contains(url, '[') OR contains(url, ']') OR regexp_matches(url, '(?i)\\b[vp][A-Za-z0-9_]+\\b') FROM pages
    UNION ALL SELECT 'r', ref_key, {DYNAMIC('target_name')}, contains(target_name, '#') OR regexp_matches(target_name, '(?i)\\b[vp][A-Za-z0-9_]+\\b') FROM v_refs""")
def dynamic_reference_flag(d):
    shape = lambda df, part, key, c, wide: df.select(F.lit(part).alias("part"), F.col(key).alias("id"), text.is_dynamic(c).alias("is_dynamic"),
                                                     (text.is_dynamic_expression(c) if wide else F.lit(False)).alias("is_dynamic_expression"))
    return shape(d.documents, "d", "doc_id", "text", False).unionByName(shape(d.pages, "p", "page_id", "url", True)).unionByName(shape(d.v_refs, "r", "ref_key", "target_name", True))


PATTERN_SQL = lambda x: f"""CASE WHEN {x} = '<missing expression>' THEN 'MISSING_EXPRESSION' WHEN left({x}, 1) IN (chr(39), chr(34)) AND right({x}, 1) = left({x}, 1) AND length({x}) > 1 THEN 'QUOTED_LITERAL'
    WHEN regexp_matches({x}, '^[A-Za-z_][A-Za-z0-9_]*$') THEN 'SIMPLE_VARIABLE' WHEN contains({x}, '|') THEN 'CONCATENATION' WHEN regexp_matches({x}, '^[A-Za-z_][A-Za-z0-9_]*\\s*\\(') THEN 'FUNCTION_RESULT'
    WHEN contains({x}, '%') THEN 'PARAMETER_OR_EXPAND_TOKEN' WHEN regexp_matches({x}, '[\\[\\]{{}}]') THEN 'STRUCTURED_EXPRESSION' ELSE 'COMPLEX_EXPRESSION' END"""
EXPRESSIONS = """(SELECT seq, CASE seq % 8 WHEN 0 THEN '<missing expression>' WHEN 1 THEN chr(39) || object_name || chr(39) WHEN 2 THEN 'sVar' || CAST(seq AS VARCHAR) WHEN 3 THEN 'a | ' || object_name WHEN 4 THEN 'TRIM(' || object_name || ')'
    WHEN 5 THEN '?' || object_name || '%x%' WHEN 6 THEN '!{' || object_name ELSE '- ' || object_name END AS expression FROM v_objects)"""


@check("expression_pattern", f"SELECT seq, expression, {PATTERN_SQL('expression')} AS pattern FROM {EXPRESSIONS}")
def expression_pattern(d):
    name, q = F.col("object_name"), F.lit("'")
    k = F.col("seq") % 8
    e = (F.when(k == 0, "<missing expression>").when(k == 1, F.concat(q, name, q)).when(k == 2, F.concat(F.lit("sVar"), F.col("seq").cast("string"))).when(k == 3, F.concat(F.lit("a | "), name))
         .when(k == 4, F.concat(F.lit("TRIM("), name, F.lit(")"))).when(k == 5, F.concat(F.lit("?"), name, F.lit("%x%"))).when(k == 6, F.concat(F.lit("!{"), name)).otherwise(F.concat(F.lit("- "), name)))
    return d.v_objects.select("seq", e.alias("expression")).withColumn("pattern", text.expression_pattern("expression"))


@check("path_class", r"""
    WITH p AS (SELECT p_partkey, p_brand, 'f' || CAST(p_partkey AS STRING) AS f, chr(92) AS b FROM part),
    x AS (SELECT p_partkey, CASE p_partkey % 6
        WHEN 0 THEN 'C:' || b || 'data' || b || f || '.csv' WHEN 1 THEN b || b || 'srv' || b || 'share' || b || p_brand || b || f || '.ps1' WHEN 2 THEN 'http://h/' || p_brand WHEN 3 THEN 'in' || b || f || '.sql' WHEN 4 THEN '..' || b || f ELSE 'sDir | ' || f END AS display_value,
        CASE p_partkey % 6 WHEN 0 THEN 'LOCAL_ABSOLUTE' WHEN 1 THEN 'UNC' WHEN 2 THEN 'URL' WHEN 5 THEN 'DYNAMIC' ELSE 'RELATIVE' END AS location_class,
        CASE p_partkey % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.ps1' WHEN 3 THEN '.sql' END AS extension, p_partkey % 6 = 5 OR p_brand LIKE '%#%' AND p_partkey % 6 IN (1, 2) OR p_partkey % 6 = 3 AND false AS is_dynamic,
        CASE WHEN p_partkey % 6 IN (1, 3) THEN 'SCRIPT' ELSE 'FILE' END AS node_type FROM p)
    SELECT *, lower(node_type) || '::' || location_class || '::' || sha256(lower(display_value)) AS node_id FROM x""")
def path_class(d):
    b, name, brand = F.lit("\\"), F.concat(F.lit("f"), F.col("p_partkey").cast("string")), F.col("p_brand")
    k = F.col("p_partkey") % 6
    raw = (F.when(k == 0, F.concat(F.lit("'C:/data/./old/../"), name, F.lit(".csv'"))).when(k == 1, F.concat(F.lit("//srv/share/"), brand, F.lit("//x/../"), name, F.lit(".ps1")))
           .when(k == 2, F.concat(F.lit("http://h/"), brand)).when(k == 3, F.concat(F.lit("./in/"), name, F.lit(".sql"))).when(k == 4, F.concat(F.lit("a/../../"), name)).otherwise(F.concat(F.lit("sDir | "), name)))
    return classify.with_path_class(d.part.withColumn("raw", raw), "raw").select("p_partkey", "display_value", "location_class", "extension", "is_dynamic", "node_type", "node_id")


SECRET_SQL = r"""'(?i)(password|passwd|pwd|secret|token|api[_-]?key|authorization)(\s*[:=]\s*|\s+)([^;\s,''"]+|[''"][^''"]*[''"])'"""


@check("redact_secrets", rf"""
    SELECT doc_id, regexp_matches(c, {SECRET_SQL}) AS redacted, sha256(regexp_replace(c, {SECRET_SQL}, '\1=<redacted>', 'g')) AS text_hash, left(regexp_replace(c, '(?i)(password|passwd|pwd|secret|token|api[_-]?key)\s*=\s*[^;\s]+', '\1=<redacted>', 'g'), 160) AS preview
    FROM (SELECT doc_id, {t('text')} AS c FROM documents)""")
def redact_secrets(d):
    return d.documents.select("doc_id", text.redact("text").alias("r"), text.safe_preview("text").alias("preview")).select(
        "doc_id", F.col("r.redacted").alias("redacted"), F.sha2("r.text", 256).alias("text_hash"), F.coalesce("preview", F.lit("")).alias("preview"))


@check("command_class", """
    SELECT p_partkey, kind AS command_kind, child_relationship_type, operand FROM (
      SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'POWERSHELL' WHEN 1 THEN 'CMD' WHEN 2 THEN 'SCRIPT' WHEN 3 THEN 'EXECUTABLE' ELSE 'UNKNOWN' END AS kind,
        unnest(CASE p_partkey % 5 WHEN 0 THEN ['INVOKES_EXECUTABLE', 'REFERENCES_SCRIPT'] WHEN 1 THEN ['INVOKES_EXECUTABLE', 'REFERENCES_SCRIPT', 'REFERENCES_SCRIPT'] WHEN 3 THEN ['INVOKES_EXECUTABLE'] ELSE [] END) AS child_relationship_type,
        unnest(CASE p_partkey % 5 WHEN 0 THEN ['powershell.exe', 'C:' || chr(92) || 'my dir' || chr(92) || 'f' || CAST(p_partkey AS STRING) || '.ps1'] WHEN 1 THEN ['cmd', 'a' || CAST(p_partkey AS STRING) || '.bat', 'b.py'] WHEN 3 THEN ['tool.exe'] ELSE [] END) AS operand FROM part)""")
def command_class(d):
    n = F.col("p_partkey").cast("string")
    k = F.col("p_partkey") % 5
    raw = (F.when(k == 0, F.concat(F.lit("C:\\Windows\\PowerShell.exe -File \"C:\\my dir\\f"), n, F.lit(".ps1\" 1"))).when(k == 1, F.concat(F.lit("cmd /c a"), n, F.lit(".bat, b.py")))
           .when(k == 2, F.concat(F.lit("go"), n, F.lit(".sh"))).when(k == 3, F.concat(F.lit("D:\\bin\\Tool.exe -x "), n)).otherwise(F.concat(F.lit("ls "), n)))
    kinds = classify.with_command_kind(d.part.withColumn("raw", raw), "raw")
    return classify.command_children(kinds.select("p_partkey", "command_kind", "sanitized_expression")).select("p_partkey", "command_kind", "child_relationship_type", "operand")


SOURCE_SQL = f"""
    SELECT *, CASE source_type WHEN 'CUBE_VIEW' THEN source_type || '::' || {norm('effective_cube_name')} || '::' || {norm('view_name')}
        WHEN 'DIMENSION_SUBSET' THEN source_type || '::' || {norm('dimension_name')} || '::' || {norm('effective_hierarchy_name')} || '::' || {norm('subset_name')}
        WHEN 'ASCII_FILE' THEN source_type || '::' || path WHEN 'JSON' THEN source_type || '::' || path WHEN 'ODBC' THEN source_type || '::' || coalesce(server_source_name, '') || '::' || coalesce(query, '') ELSE source_type || '::' || process_name END AS source_identity
    FROM (SELECT *, CASE declared_type WHEN 'ASCII' THEN 'ASCII_FILE' WHEN 'ODBC' THEN 'ODBC' WHEN 'CubeView' THEN 'CUBE_VIEW' WHEN 'DimensionSubset' THEN 'DIMENSION_SUBSET' WHEN 'JSON' THEN 'JSON' ELSE 'NONE' END AS source_type,
        coalesce(cube_name, server_source_name, client_source_name) AS effective_cube_name, coalesce(hierarchy_name, dimension_name) AS effective_hierarchy_name, coalesce(server_source_name, client_source_name, '') AS path FROM v_sources)"""


@check("source_class", rf"""
    SELECT process_name, source_type, effective_cube_name, effective_hierarchy_name, 'data-source::' || source_type || '::' || sha256(source_identity) AS source_node_id,
      regexp_replace(query, '(?i)(password|passwd|pwd|secret|token|api[_-]?key)\s*=\s*[^;\s]+', '\1=<redacted>', 'g') AS query_preview, sha256(query) AS query_hash, user_name IS NOT NULL AS username_present, sha256(user_name) AS username_hash, password IS NOT NULL AS credential_redacted FROM ({SOURCE_SQL})""")
def source_class(d):
    return classify.with_source_class(d.v_sources).select("process_name", "source_type", "effective_cube_name", "effective_hierarchy_name", "source_node_id", "query_preview", "query_hash",
                                                          "username_present", "username_hash", "credential_redacted")


@check("effective_confidence", """
    WITH c AS (SELECT DISTINCT lower(trim(regexp_replace(object_name, '\\s+', ' ', 'g'))) AS k FROM v_objects WHERE object_type = 'cube'),
    e AS (SELECT *, c.k IS NOT NULL AS hit FROM v_evidence LEFT JOIN c ON target_type = 'cube' AND c.k = lower(trim(regexp_replace(target_name, '\\s+', ' ', 'g')))),
    r AS (SELECT *, CASE WHEN hit THEN 'RESOLVED' WHEN left(target_expression, 1) = chr(39) THEN confidence ELSE 'UNRESOLVED' END AS effective_confidence FROM e),
    s AS (SELECT *, CASE WHEN hit THEN 'VALID' WHEN effective_confidence = 'UNRESOLVED' THEN 'UNRESOLVED_DYNAMIC_REFERENCE' WHEN target_type <> 'cube' THEN 'NOT_YET_CATALOGED' ELSE 'BROKEN_REFERENCE' END AS catalog_status FROM r)
    SELECT target_type, effective_confidence, catalog_status, CASE catalog_status WHEN 'BROKEN_REFERENCE' THEN 'ERROR' WHEN 'VALID' THEN 'INFO' ELSE 'WARNING' END AS severity, count(*) AS row_count FROM s GROUP BY ALL""")
def effective_confidence(d):
    cubes = d.v_objects.where("object_type = 'cube'").select(text.norm_key("object_name").alias("k")).distinct().withColumn("hit", F.lit(True))
    joined = d.v_evidence.withColumn("k", F.when(F.col("target_type") == "cube", text.norm_key("target_name"))).join(cubes, "k", "left")
    return classify.with_effective_status(joined, F.coalesce("hit", F.lit(False))).groupBy("target_type", "effective_confidence", "catalog_status", "severity").agg(F.count("*").alias("row_count"))


@check("lenient_cast", """
    SELECT seq, CASE seq % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'true' WHEN 3 THEN 'none' WHEN 4 THEN 'false' ELSE 'none' END AS as_bool, CASE WHEN seq % 6 = 2 THEN CAST(1 AS BIGINT) WHEN seq % 6 = 5 THEN seq ELSE CAST(-7 AS BIGINT) END AS as_int,
      CASE WHEN seq % 2 = 0 THEN object_name ELSE 'none' END AS only_name FROM v_objects""")
def lenient_cast(d):
    raw = F.element_at(F.array(F.lit(" TRUE"), F.lit("no"), F.lit("1"), F.lit("x"), F.lit("False "), F.col("seq").cast("string")), (F.col("seq") % 6 + 1).cast("int"))
    items = F.when(F.col("seq") % 2 == 0, F.array("object_name")).otherwise(F.array("object_name", "object_type"))
    flag = F.when(F.col("seq") % 6 == 5, F.lit(None).cast("boolean")).otherwise(text.lenient_bool(raw))
    return d.v_objects.select("seq", F.coalesce(flag.cast("string"), F.lit("none")).alias("as_bool"), text.lenient_int(raw, -7).alias("as_int"), F.coalesce(text.only_item(items), F.lit("none")).alias("only_name"))


@check("endpoint_state", """
    SELECT graph_relationship_id, CASE WHEN edge_key % 5 = 0 THEN 'DYNAMIC' WHEN edge_key % 5 = 1 THEN 'PLANNED' WHEN edge_key % 5 = 2 THEN 'EXTERNAL_UNVERIFIED' WHEN endpoint_state = 'DYNAMIC' THEN 'DYNAMIC' ELSE 'CANONICAL' END AS state FROM v_graph""")
def endpoint_state(d):
    kind = F.element_at(F.array(F.lit("reference expression"), F.lit("PLANNED_TARGET"), F.lit("file"), F.col("target_type"), F.col("target_type")), (F.col("edge_key") % 5 + 1).cast("int"))
    return d.v_graph.select("graph_relationship_id", classify.endpoint_state(kind, F.concat(F.lit("x_"), "endpoint_state")).alias("state"))


@check("conform_sources", f"""
    SELECT lineage_source, source_type, source_name, target_type, target_name, CAST(sum(reference_count) AS BIGINT) AS reference_count, count(*) AS row_count, array_to_string(list_sort(list(DISTINCT function_name)), '|') AS functions FROM (
      SELECT 'TI' AS lineage_source, 'process' AS source_type, process_name AS source_name, target_type, {t('target_name')} AS target_name, 1 AS reference_count, function_name FROM v_evidence
      UNION ALL SELECT 'RULE', 'cube', source_cube, target_object_type, coalesce(target_name, ''), CASE WHEN line_number > 0 THEN line_number ELSE 1 END, function_name FROM v_rule_evidence) GROUP BY ALL""")
def conform_sources(d):
    from catalog_lineage.plans.snapshot import conform
    code = d.v_evidence.withColumns({"functions": F.array("function_name"), "procedures": F.array("procedure"), "evidence_lines": F.array("line_number"), "reference_count": F.lit(1)})
    rules = d.v_rule_evidence.withColumn("evidence_count", F.col("line_number"))
    both = conform(code, "TI").unionByName(conform(rules, "RULE"), allowMissingColumns=True)
    return both.groupBy("lineage_source", "source_type", "source_name", "target_type", "target_name").agg(
        F.sum("reference_count").alias("reference_count"), F.count("*").alias("row_count"), F.array_sort(F.collect_set(F.col("functions")[0])).alias("functions"))


# ---- filters ------------------------------------------------------------------------------

@check("scope_filter", """
    SELECT 'control' AS part, object_name AS name FROM v_objects WHERE left(object_name, 1) = '}'
    UNION ALL SELECT 'named', object_name FROM v_objects WHERE lower(object_name) IN (SELECT lower(n_name) FROM nation) UNION ALL SELECT 'absent', 'no ' || r_name FROM region""")
def scope_filter(d):
    control, _ = filters.filter_scope(d.v_objects, "control")
    wanted = d.nation.select(F.upper("n_name").alias("n")).union(d.region.select(F.concat(F.lit("no "), "r_name")))
    named, absent = filters.filter_scope(d.v_objects, names=wanted)
    part = lambda df, label, c: df.select(F.lit(label).alias("part"), F.col(c).alias("name"))
    return part(control, "control", "object_name").unionByName(part(named, "named", "object_name")).unionByName(part(absent, "absent", "requested_name"))


@check("deferred_filter", """
    SELECT coalesce(domain, 'PRESERVED') AS domain, validation_status, count(*) AS row_count FROM (SELECT validation_status, CASE validation_status WHEN 'RUNTIME_VIEW_REFERENCE' THEN 'VIEW' WHEN 'RUNTIME_SUBSET_REFERENCE' THEN 'SUBSET'
      WHEN 'ATTRIBUTE_CATALOG_DEFERRED' THEN 'ATTRIBUTE' WHEN 'HIERARCHY_CATALOG_DEFERRED' THEN 'HIERARCHY' END AS domain FROM (SELECT CASE WHEN ref_key % 7 = 0 THEN 'VALID' ELSE validation_status END AS validation_status FROM v_refs)) GROUP BY ALL""")
def deferred_filter(d):
    rows = d.v_refs.withColumn("validation_status", F.expr("CASE WHEN ref_key % 7 = 0 THEN 'VALID' ELSE validation_status END"))
    deferred, others = filters.split_deferred(rows)
    return deferred.unionByName(others.withColumn("domain", F.lit("PRESERVED"))).groupBy("domain", "validation_status").agg(F.count("*").alias("row_count"))


EXCEPTIONS = """(SELECT 'E' || CAST(p_partkey AS VARCHAR) AS exception_id, CASE p_partkey % 4 WHEN 0 THEN 'REGISTERED' WHEN 1 THEN 'active' ELSE 'CLOSED' END AS exception_status, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'cube' END AS target_type,
    'missing ' || p_name AS target_name, CASE WHEN p_partkey % 8 = 0 THEN false WHEN p_partkey % 8 = 1 THEN NULL ELSE true END AS applies_to_validation_records, p_partkey FROM part)"""


def exceptions(d):
    return d.part.select(
        F.concat(F.lit("E"), F.col("p_partkey").cast("string")).alias("exception_id"), F.expr("CASE p_partkey % 4 WHEN 0 THEN 'REGISTERED' WHEN 1 THEN 'active' ELSE 'CLOSED' END").alias("exception_status"),
        F.expr("CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'cube' END").alias("target_type"), F.concat(F.lit("missing "), "p_name").alias("target_name"),
        F.expr("CASE WHEN p_partkey % 8 = 0 THEN false WHEN p_partkey % 8 = 1 THEN NULL ELSE true END").alias("applies_to_validation_records"))


@check("active_exceptions", f"SELECT exception_id, target_name FROM {EXCEPTIONS} WHERE exception_status IN ('REGISTERED', 'active') AND coalesce(applies_to_validation_records, true) AND target_type <> ''")
def active_exceptions(d):
    return filters.active_exceptions(exceptions(d)).select("exception_id", "target_name")


@check("missing_fields", """
    SELECT array_to_string(list_filter([CASE WHEN edge_key % 19 = 0 THEN 'source_id' END, CASE WHEN edge_key % 23 = 0 THEN 'target_id' END], lambda x: x IS NOT NULL), '|') AS missing_fields, count(*) AS row_count FROM v_edges GROUP BY 1""")
def missing_fields(d):
    holes = d.v_edges.withColumns({"source_id": F.expr("CASE WHEN edge_key % 19 = 0 THEN ' ' ELSE source_id END"), "target_id": F.expr("CASE WHEN edge_key % 23 = 0 THEN NULL ELSE target_id END")})
    whole, lacking = filters.require_fields(holes, ["source_id", "source_type", "target_id", "target_type", "relationship_type"])
    return whole.withColumn("missing_fields", F.array().cast("array<string>")).unionByName(lacking).groupBy("missing_fields").agg(F.count("*").alias("row_count"))


@check("relationship_filter", """SELECT relationship_type, count(*) AS row_count FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'writes file' WHEN 1 THEN 'EXECUTES_COMMAND' WHEN 2 THEN 'RESOLVES_TO_FILE' WHEN 3 THEN 'READS_FROM_CUBE' ELSE 'X' END AS relationship_type FROM orders)
    WHERE relationship_type IN ('writes file', 'EXECUTES_COMMAND', 'RESOLVES_TO_FILE') GROUP BY 1""")
def relationship_filter(d):
    typed = d.orders.select(F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'writes file' WHEN 1 THEN 'EXECUTES_COMMAND' WHEN 2 THEN 'RESOLVES_TO_FILE' WHEN 3 THEN 'READS_FROM_CUBE' ELSE 'X' END").alias("relationship_type"))
    return filters.filter_types(typed).groupBy("relationship_type").agg(F.count("*").alias("row_count"))
