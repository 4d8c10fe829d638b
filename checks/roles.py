"""Driver tables in the roles of catalog, edges, evidence and code.

Every role is one projection in SQL that both engines run. Quotes, line breaks and backslashes are written as chr()
because the engines read them differently inside literals.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

ROLES = {
    "v_objects": """
        SELECT 'chore' AS object_type, r_name AS object_name, CAST(r_regionkey AS BIGINT) * 8 AS seq FROM region
        UNION ALL SELECT 'dimension', n_name, CAST(n_nationkey AS BIGINT) * 8 + 1 FROM nation
        UNION ALL SELECT 'dimension', c_name, c_custkey * 8 + 2 FROM customer
        UNION ALL SELECT 'process', s_name, s_suppkey * 8 + 3 FROM supplier
        UNION ALL SELECT 'cube', CASE WHEN p_size % 10 = 0 THEN '}' || p_name WHEN p_size % 7 = 0 THEN upper(p_name) ELSE p_name END, p_partkey * 8 + 4 FROM part
    """,
    "v_names": """
        SELECT seq, object_type, CASE WHEN seq % 3 = 0 THEN '  ' || replace(object_name, ' ', '   ') || chr(9)
            WHEN seq % 3 = 1 THEN '"' || object_name || '"' WHEN seq % 30 = 2 THEN '   ' ELSE upper(object_name) || ' ' END AS name FROM v_objects
    """,
    "v_edges": """
        SELECT 'n-' || CAST(n_nationkey AS STRING) AS relationship_id, CAST(n_nationkey AS BIGINT) * 4 AS edge_key, 'hierarchy::' || n_name AS source_id, 'HIERARCHY' AS source_type,
            'BELONGS_TO_DIMENSION' AS relationship_type, 'dimension::' || r_name AS target_id, 'DIMENSION' AS target_type FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'c-' || CAST(c_custkey AS STRING), c_custkey * 4 + 1, 'cube::' || c_name, 'CUBE', 'USES_DIMENSION', 'hierarchy::NATION_' || CAST(c_nationkey AS STRING), 'HIERARCHY' FROM customer
        UNION ALL SELECT 's-' || CAST(s_suppkey AS STRING), s_suppkey * 4 + 2, 'process::' || s_name, 'PROCESS', 'READS_FROM_CUBE', 'hierarchy::NATION_' || CAST(s_nationkey AS STRING), 'HIERARCHY' FROM supplier
        UNION ALL SELECT 'o-' || CAST(o_orderkey AS STRING), o_orderkey * 4 + 3, 'process::order_' || CAST(o_orderkey AS STRING), 'PROCESS',
            CASE o_orderstatus WHEN 'F' THEN 'CALLS_PROCESS' WHEN 'O' THEN 'WRITES_TO_CUBE' ELSE 'TOUCHES_CUBE' END, 'cube::Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0'), 'CUBE' FROM orders
    """,
    "v_graph": """
        SELECT relationship_id AS graph_relationship_id, edge_key, source_id, source_type, relationship_type, target_id, target_type,
            CASE WHEN edge_key % 31 = 0 THEN 'DYNAMIC' WHEN edge_key % 37 = 0 THEN 'PLANNED' ELSE 'CANONICAL' END AS endpoint_state FROM v_edges
    """,
    "v_nodes": """
        SELECT 'dimension::' || r_name AS node_id, 'DIMENSION' AS node_type, r_name AS object_name FROM region
        UNION ALL SELECT 'hierarchy::' || n_name, 'HIERARCHY', n_name FROM nation
        UNION ALL SELECT 'cube::' || c_name, 'CUBE', c_name FROM customer WHERE c_custkey % 50 <> 7
        UNION ALL SELECT 'process::' || s_name, 'PROCESS', CASE WHEN s_suppkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE s_name END FROM supplier
        UNION ALL SELECT 'process::order_' || CAST(o_orderkey AS STRING), 'PROCESS', 'order ' || CAST(o_orderkey AS STRING) FROM orders
    """,
    "v_validations": """
        SELECT 'val::' || relationship_id AS validation_id, relationship_id, edge_key AS validation_seq,
            CASE WHEN edge_key % 13 = 0 THEN 'BROKEN_REFERENCE' WHEN edge_key % 11 = 0 THEN 'UNRESOLVED_DYNAMIC_REFERENCE' WHEN edge_key % 7 = 0 THEN 'NOT_YET_CATALOGED' ELSE 'VALID' END AS validation_status
            FROM v_edges WHERE edge_key % 97 <> 0
        UNION ALL SELECT 'val2::' || relationship_id, relationship_id, edge_key + 1, 'NOT_CROSS_CHECKED' FROM v_edges WHERE edge_key % 89 = 0
        UNION ALL SELECT 'val3::' || relationship_id, 'gone::' || relationship_id, edge_key + 2, 'VALID' FROM v_edges WHERE edge_key % 101 = 0
    """,
    "v_evidence": """
        SELECT 'Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0') AS process_name,
            CASE l_linenumber % 4 WHEN 0 THEN 'Prolog' WHEN 1 THEN 'Metadata' WHEN 2 THEN 'Data' ELSE 'Epilog' END AS procedure,
            CAST(l_orderkey % 40 AS INT) AS line_number,
            CASE l_returnflag WHEN 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'CELLGETN' ELSE 'CELLGETS' END WHEN 'A' THEN 'CELLPUTN' ELSE 'CELLINCREMENTN' END AS function_name,
            CASE l_returnflag WHEN 'R' THEN 'READS_FROM_CUBE' WHEN 'A' THEN 'WRITES_TO_CUBE' ELSE 'INCREMENTS_CUBE' END AS relationship_type,
            CASE WHEN l_partkey % 13 = 0 THEN 'view' WHEN l_partkey % 17 = 0 THEN 'subset' WHEN l_partkey % 19 = 0 THEN 'attribute' WHEN l_partkey % 23 = 0 THEN 'hierarchy' ELSE 'cube' END AS target_type,
            CASE WHEN l_partkey % 7 = 0 THEN 'sCube' || CAST(l_linenumber AS STRING) WHEN l_partkey % 11 = 0 THEN 'missing ' || p_name WHEN l_linenumber % 2 = 0 THEN upper(p_name) ELSE replace(p_name, ' ', '  ') END AS target_name,
            CASE WHEN l_partkey % 7 = 0 THEN 'sCube' || CAST(l_linenumber AS STRING) WHEN l_partkey % 5 = 0 THEN 'sVar' || CAST(l_partkey % 3 AS STRING) ELSE chr(39) || p_name || chr(39) END AS target_expression,
            CASE WHEN l_partkey % 7 = 0 THEN 'UNRESOLVED' WHEN l_partkey % 5 = 0 THEN 'RESOLVED' ELSE 'CONFIRMED' END AS confidence
        FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
    "v_rule_evidence": """
        SELECT 'Cube ' || p_brand AS source_cube, CASE WHEN p_size % 3 = 0 THEN 'FEEDS' ELSE 'READS_FROM' END AS relationship_type, 'CUBE' AS target_object_type,
            CASE WHEN p_size % 5 = 0 THEN CAST(NULL AS STRING) ELSE p_name END AS target_name, 'DB' AS function_name, CAST(p_partkey % 97 AS INT) AS line_number,
            CASE WHEN p_size % 5 = 0 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence, CASE WHEN p_size % 5 = 0 THEN 'vCube' || CAST(p_size AS STRING) ELSE chr(39) || p_name || chr(39) END AS target_expression,
            CASE WHEN p_size % 2 = 0 THEN p_type ELSE CAST(NULL AS STRING) END AS dimension_name, CAST(NULL AS STRING) AS hierarchy_name, CAST(NULL AS STRING) AS attribute_name FROM part
    """,
    "v_assign": """
        SELECT CAST(user_id AS STRING) AS process_id, event_id AS seq, 'v' || CAST(event_id % 4 AS STRING) AS variable, event_type IN ('purchase', 'signup', 'error') AS is_set,
            CASE WHEN event_type = 'error' THEN CAST(NULL AS STRING) ELSE 'x' || CAST(event_id % 50 AS STRING) END AS val,
            CASE WHEN event_type = 'purchase' THEN 'lit' WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'concat' WHEN event_type = 'signup' THEN 'lit' WHEN event_type = 'error' THEN 'bad' ELSE 'use' END AS kind,
            'v' || CAST((event_id + 1) % 4 AS STRING) AS dep FROM events
    """,
    "v_code": """
        SELECT 'proc_' || CAST(o_orderkey AS STRING) AS process_name, CASE o_orderkey % 4 WHEN 0 THEN 'Prolog' WHEN 1 THEN 'Metadata' WHEN 2 THEN 'Data' ELSE 'Epilog' END AS procedure,
            o_orderkey, o_custkey, o_orderstatus,
            'sCube = ' || q || 'Cube C' || CAST(o_custkey % 50 AS STRING) || q || '; # old: CELLGETN(' || q || 'no' || q || ', ' || q || 'x' || q || ')' || nl
            || 'nVal = CELLGETN(sCube, ' || q || 'a,b' || q || ', ATTRS(' || q || 'Dim' || CAST(o_custkey % 7 AS STRING) || q || ', sEl, ' || q || 'Cap' || q || q || 'tion' || q || '));' || nl
            || CASE o_orderstatus WHEN 'F' THEN 'CELLPUTN(nVal, ' || q || 'Target (x)' || q || ', ' || q || 'm' || CAST(o_orderkey % 5 AS STRING) || q || ');'
                WHEN 'O' THEN 'ViewZeroOut(' || q || 'Cube C1' || q || ', sView);'
                ELSE 'ExecuteProcess(' || q || 'proc_' || CAST(o_orderkey + 1 AS STRING) || q || ', ' || q || 'pDim' || q || ', ' || q || 'D' || CAST(o_orderkey % 9 AS STRING) || q || ', ' || q || 'pCube' || q || ', sCube);' END || nl
            || CASE WHEN o_orderkey % 10 = 0 THEN 'CELLPUTS(' || q || 'bad' || q || ', sCube' ELSE 'sTxt = ' || q || 'ASCIIOUTPUT(1)' || q || ';' END || nl
            || 'sFull = sCube | ' || q || '_x' || q || ';' || nl || 'CELLGETS(sFull, ' || q || 'm' || q || ');' AS code
        FROM (SELECT *, chr(39) AS q, chr(10) AS nl FROM orders) o
    """,
    "v_rules": """
        SELECT 'Cube ' || CAST(p_partkey AS STRING) AS cube_name, p_partkey, p_name, p_brand, p_size,
            '[' || q || 'x' || q || '] = N: DB(' || q || p_name || q || ', !A, ' || q || 'm' || q || ') * ATTRN(' || q || p_brand || q || ', !A, ' || q || 'W' || q || ');' || nl
            || '# DB(' || q || 'skip' || q || ')' || nl || '/* ELPAR(' || q || 'skip' || q || ')' || nl || ' */' || nl
            || '[' || q || 'y' || q || '] => DB(' || q || p_brand || q || ', !B);' || nl
            || CASE WHEN p_size % 2 = 0 THEN 'x = FOO' || CAST(p_size % 4 AS STRING) || '(1) + DB(vCube);' ELSE 'y = ' || q || 'Count (System)' || q || ';' END AS rule_text
        FROM (SELECT *, chr(39) AS q, chr(10) AS nl FROM part) p
    """,
    "v_params": """
        SELECT 'proc_' || CAST(c_custkey AS STRING) AS process_name, 'pDim' AS parameter_name, 1 AS position, CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'Customer#' || lpad(CAST(c_custkey AS STRING), 9, '0') END AS default_value FROM customer
        UNION ALL SELECT 'proc_' || CAST(c_custkey AS STRING), 'pCube', 2, CASE WHEN c_custkey % 2 = 0 THEN 'nothing ' || c_mktsegment ELSE '' END FROM customer
    """,
    "v_bindings": """
        SELECT 'order_' || CAST(o_orderkey AS STRING) AS calling_process, 'PROC_' || CAST(o_custkey AS STRING) AS called_process, 'pdim' AS parameter_name, CAST(o_orderkey % 60 AS INT) AS line_number,
            CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE 'NATION_' || CAST(o_orderkey % 30 AS STRING) END AS resolved_value FROM orders
    """,
    "v_open_refs": """
        SELECT 'ref_' || CAST(c_custkey AS STRING) AS row_key, 'Proc_' || CAST(c_custkey AS STRING) AS process_name, 'UPDATES_DIMENSION' AS relationship_type,
            CASE WHEN c_custkey % 7 = 0 THEN 'view' ELSE 'dimension' END AS target_type,
            CASE WHEN c_custkey % 10 = 9 THEN 'known' WHEN c_custkey % 4 = 3 THEN 'sAlias' ELSE 'pDim' END AS target_name,
            CASE WHEN c_custkey % 4 = 3 THEN 'sAlias' ELSE 'pDim' END AS target_expression, CASE WHEN c_custkey % 10 = 9 THEN 'CONFIRMED' ELSE 'UNRESOLVED' END AS confidence FROM customer
    """,
    "v_sources": """
        SELECT 'src_' || CAST(p_partkey AS STRING) AS process_name, CASE p_partkey % 6 WHEN 0 THEN 'ASCII' WHEN 1 THEN 'ODBC' WHEN 2 THEN 'CubeView' WHEN 3 THEN 'DimensionSubset' WHEN 4 THEN 'JSON' ELSE 'None' END AS declared_type,
            CASE WHEN p_partkey % 6 IN (0, 4) AND p_partkey % 5 <> 0 THEN '/in/' || p_brand || '.csv' WHEN p_partkey % 6 = 1 THEN 'dsn_' || p_type ELSE CAST(NULL AS STRING) END AS server_source_name,
            CASE WHEN p_partkey % 6 IN (0, 4) THEN 'C:' || p_brand || '.txt' WHEN p_partkey % 6 = 2 AND p_partkey % 4 = 0 THEN 'Client ' || p_name ELSE CAST(NULL AS STRING) END AS client_source_name,
            CASE WHEN p_partkey % 6 = 2 AND p_partkey % 4 <> 0 THEN upper(p_name) ELSE CAST(NULL AS STRING) END AS cube_name, CASE WHEN p_partkey % 6 = 2 THEN p_brand ELSE CAST(NULL AS STRING) END AS view_name,
            CASE WHEN p_partkey % 6 = 3 THEN 'NATION_' || CAST(p_size % 25 AS STRING) ELSE CAST(NULL AS STRING) END AS dimension_name, CASE WHEN p_partkey % 12 = 3 THEN 'BUILDING' ELSE CAST(NULL AS STRING) END AS hierarchy_name,
            CASE WHEN p_partkey % 6 = 3 THEN 'S' || CAST(p_partkey % 400 AS STRING) ELSE CAST(NULL AS STRING) END AS subset_name,
            CASE WHEN p_partkey % 6 = 1 THEN 'select * from t where password = ' || p_type || '; ' || CAST(p_size AS STRING) ELSE CAST(NULL AS STRING) END AS query,
            CASE WHEN p_size % 3 = 0 THEN p_type ELSE CAST(NULL AS STRING) END AS user_name, CASE WHEN p_size % 9 = 0 THEN 'pw' || CAST(p_size AS STRING) ELSE CAST(NULL AS STRING) END AS password FROM part
    """,
    "v_hierarchies": """
        SELECT DISTINCT 'NATION_' || CAST(c_nationkey AS STRING) AS dimension_name, CASE WHEN c_custkey % 5 = 0 THEN 'NATION_' || CAST(c_nationkey AS STRING) ELSE c_mktsegment END AS hierarchy_name FROM customer
    """,
    "v_subsets": """
        SELECT 'NATION_' || CAST(c_nationkey AS STRING) AS dimension_name, CASE WHEN c_custkey % 3 = 0 THEN 'NATION_' || CAST(c_nationkey AS STRING) ELSE c_mktsegment END AS hierarchy_name, 'S' || CAST(c_custkey % 400 AS STRING) AS subset_name, c_custkey AS seq FROM customer
    """,
    "v_views": "SELECT p_name AS cube_name, p_brand AS view_name, p_partkey AS seq FROM part",
    "v_attributes": """
        SELECT 'NATION_' || CAST(c_nationkey AS STRING) AS dimension_name, CASE WHEN c_custkey % 4 = 0 THEN 'NATION_' || CAST(c_nationkey AS STRING) ELSE c_mktsegment END AS hierarchy_name, 'A' || CAST(c_custkey % 300 AS STRING) AS attribute_name, c_custkey AS seq,
            CASE c_custkey % 9 WHEN 0 THEN 'N' WHEN 1 THEN 'alias' WHEN 2 THEN '3' WHEN 3 THEN 'text' WHEN 4 THEN '' WHEN 5 THEN 'S' WHEN 6 THEN '1' WHEN 7 THEN 'weird' ELSE 'Numeric' END AS raw_type FROM customer
    """,
    "v_refs": """
        SELECT o_orderkey AS ref_key, 'order_' || CAST(o_custkey AS STRING) AS process_name,
            CASE o_orderkey % 9 WHEN 0 THEN 'USES_VIEW' WHEN 1 THEN 'CREATES_VIEW' WHEN 2 THEN 'UPDATES_SUBSET' WHEN 3 THEN 'DELETES_SUBSET' WHEN 4 THEN 'READS_ATTRIBUTE' WHEN 5 THEN 'CREATES_ATTRIBUTE' WHEN 6 THEN 'UPDATES_HIERARCHY' WHEN 7 THEN 'REFERENCES_HIERARCHY' ELSE 'DELETES_VIEW' END AS relationship_type,
            CASE WHEN o_orderkey % 9 IN (0, 1, 8) THEN 'view' WHEN o_orderkey % 9 IN (2, 3) THEN 'subset' WHEN o_orderkey % 9 IN (4, 5) THEN 'attribute' ELSE 'hierarchy' END AS target_type,
            CASE WHEN o_orderkey % 9 IN (0, 1, 8) THEN 'RUNTIME_VIEW_REFERENCE' WHEN o_orderkey % 9 IN (2, 3) THEN 'RUNTIME_SUBSET_REFERENCE' WHEN o_orderkey % 9 IN (4, 5) THEN 'ATTRIBUTE_CATALOG_DEFERRED' ELSE 'HIERARCHY_CATALOG_DEFERRED' END AS validation_status,
            CASE WHEN o_orderkey % 29 = 0 THEN 'sRef' || CAST(o_orderkey % 5 AS STRING)
                WHEN o_orderkey % 9 IN (0, 1, 8) THEN CASE WHEN o_orderkey % 2 = 0 THEN p_name || '.' || p_brand ELSE p_brand END
                WHEN o_orderkey % 9 IN (2, 3) THEN CASE WHEN o_orderkey % 4 = 0 THEN 'S' || CAST(o_custkey % 450 AS STRING) WHEN o_orderkey % 4 = 1 THEN n_name || '::' || c_mktsegment || '::S' || CAST(o_custkey % 400 AS STRING) ELSE n_name || '.S' || CAST(o_custkey % 400 AS STRING) END
                WHEN o_orderkey % 9 IN (4, 5) THEN CASE WHEN o_orderkey % 4 = 0 THEN 'A' || CAST(o_custkey % 310 AS STRING) WHEN o_orderkey % 4 = 1 THEN n_name || '::' || c_mktsegment || '::A' || CAST(o_custkey % 300 AS STRING) ELSE n_name || '.A' || CAST(o_custkey % 300 AS STRING) END
                ELSE CASE WHEN o_orderkey % 3 = 0 THEN c_mktsegment ELSE n_name || '.' || c_mktsegment END END AS target_name
        FROM (SELECT orders.*, o_orderkey % parts + first_part AS named_part FROM orders CROSS JOIN (SELECT min(p_partkey) AS first_part, max(p_partkey) - min(p_partkey) + 1 AS parts FROM part)) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON p_partkey = named_part
    """,
    "v_turns": """
        SELECT conv_id, CASE WHEN conv_id % 17 = 3 AND turn = 1 THEN CAST(0 AS BIGINT) ELSE turn END AS turn, role || CAST(turn AS STRING) AS member FROM conversations
    """,
    "v_durations": "SELECT l_extendedprice / 1000.0 AS seconds FROM lineitem",
    "v_catalog_edges": """
        SELECT 'r' || CAST(l_suppkey AS STRING) || '-' || CAST(l_partkey % 50 AS STRING) AS relationship_id, CASE WHEN l_linestatus = 'F' THEN 'code_parser' ELSE 'rule_parser' END AS discovery_method,
            CASE l_returnflag WHEN 'R' THEN 'CELLGETN' WHEN 'A' THEN 'CELLPUTN' ELSE 'DB' END AS function_name, CASE WHEN l_linenumber % 2 = 0 THEN 'Data' ELSE 'Prolog' END AS procedure,
            l_linenumber AS line_number, CAST(l_quantity AS BIGINT) AS reference_count FROM lineitem
    """,
    "v_backlog": """
        SELECT 'o-' || CAST(o_orderkey AS STRING) AS relationship_id, 'process::order_' || CAST(o_orderkey AS STRING) AS source_qualified_name, 'cube::Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS target_qualified_name,
            CASE o_orderkey % 5 WHEN 0 THEN 'View' WHEN 1 THEN 'cube' WHEN 2 THEN 'attribute' WHEN 3 THEN 'widget' ELSE '' END AS target_type, CASE o_orderstatus WHEN 'F' THEN 'CALLS_PROCESS' WHEN 'O' THEN 'WRITES_TO_CUBE' ELSE 'TOUCHES_CUBE' END AS relationship_type,
            CASE WHEN o_orderkey % 2 = 0 THEN 'code_parser' ELSE 'rule_parser' END AS discovery_method, CAST(o_orderkey % 4 AS STRING) AS reference_count, o_orderpriority AS target_expression, o_orderkey AS seq FROM orders
    """,
}

_NAME = re.compile(r"\b(v_[a-z_]+)\b")


def _needed(sql: str) -> list[str]:
    """Roles a statement uses, those they use first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in ROLES and name not in order:
                visit(ROLES[name])
                order.append(name)

    visit(sql)
    return order


def with_roles(sql: str) -> str:
    """The statement with the roles it uses in front, for an engine that knows the driver tables by name."""
    parts = [f"{name} AS ({ROLES[name]})" for name in _needed(sql)]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + body[len("WITH RECURSIVE"):]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[len("WITH "):]
    return "WITH " + ",\n".join(parts) + "\n" + body


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or role of one scale factor."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    roles = _needed(name)
    text = " ".join(ROLES[r] for r in roles)
    tables = [t for t in TABLES if re.search(rf"\b{t}\b", text)]
    parts = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in tables] + [f"{r} AS ({ROLES[r]})" for r in roles]
    return spark.sql("WITH " + ",\n".join(parts) + f" SELECT * FROM {name}")
