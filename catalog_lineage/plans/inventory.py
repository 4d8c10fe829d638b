"""Inventory and structural edges derived from definition tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import is_control, with_scope, with_source_class
from ..functions.ids import node_id, opt, source_declaration_id, subset_node_id, view_node_id
from ..functions.text import blank_to_null, clean, first_nonblank, lenient_int, norm_key, padded
from ..operators.window import first_wins, first_wins_by_name, split_duplicates


def object_inventory(df: DataFrame, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(objects with scope, counts per type and scope); the first spelling of a name wins."""
    named = df.withColumn("object_name", clean("object_name")).where(clean("object_name") != "")
    objects = with_scope(first_wins_by_name(named, ["object_type", "object_name"], [order, "object_name"]), "object_name")
    counts = objects.groupBy("object_type").pivot("catalog_scope", ["REGULAR", "CONTROL"]).agg(F.count(F.lit(1))).na.fill(0, ["REGULAR", "CONTROL"])
    return objects, counts.select(
        "object_type", F.col("REGULAR").alias("regular_count"), F.col("CONTROL").alias("control_count"), (F.col("REGULAR") + F.col("CONTROL")).alias("object_count")
    )


def sorted_inventory(objects: DataFrame) -> DataFrame:
    """For the sink: by type, then name."""
    return objects.orderBy("object_type", F.lower("object_name"))


def _edge(rel_id: Column, source: Column, source_type: str, target: Column, target_type: str, rel_type: str, method: str, status: Column | None = None, position: Column | None = None) -> Column:
    return F.struct(
        rel_id.alias("relationship_id"), source.alias("source_id"), F.lit(source_type).alias("source_type"), target.alias("target_id"),
        F.lit(target_type).alias("target_type"), F.lit(rel_type).alias("relationship_type"), F.lit(method).alias("resolution_method"),
        (F.lit("VALID") if status is None else status).alias("validation_status"),
        (F.lit(None).cast("int") if position is None else position.cast("int")).alias("position"),
    )


def ownership_edges(df: DataFrame, kind: str, dimensions: DataFrame | None = None) -> DataFrame:
    """Ownership edges with their validation, from hierarchies, subsets, views or cubes with ordered dimensions. Subsets and views
    say how they are defined: by an expression in ``mdx`` or as they stand."""
    c = lambda name: clean(name)
    if kind == "hierarchy":
        owned = F.array(_edge(
            node_id("hierarchy-ownership", "dimension_name", "hierarchy_name"), node_id("hierarchy", "dimension_name", "hierarchy_name"), "HIERARCHY",
            node_id("dimension", "dimension_name"), "DIMENSION", "BELONGS_TO_DIMENSION", "CATALOG_MATCH",
        ))
    elif kind == "subset":
        own = subset_node_id("dimension_name", "hierarchy_name", "subset_name")
        edge_id = lambda suffix: F.concat_ws("::", F.lit("subset-ownership"), c("dimension_name"), c("hierarchy_name"), c("subset_name"), F.lit(suffix))
        owned = F.array(
            _edge(edge_id("hierarchy"), own, "SUBSET", node_id("hierarchy", "dimension_name", "hierarchy_name"), "HIERARCHY", "BELONGS_TO_HIERARCHY", "CATALOG_MATCH"),
            _edge(edge_id("dimension"), own, "SUBSET", node_id("dimension", "dimension_name"), "DIMENSION", "BELONGS_TO_DIMENSION", "CATALOG_MATCH"),
        )
    elif kind == "view":
        owned = F.array(_edge(
            node_id("view-ownership", "cube_name", "view_name"), view_node_id("cube_name", "view_name"), "VIEW", node_id("cube", "cube_name"), "CUBE", "BELONGS_TO_CUBE", "CATALOG_MATCH",
        ))
    elif kind == "cube":
        return _cube_dimensions(df, dimensions).withColumn("definition_kind", F.lit(None).cast("string"))
    else:
        raise ValueError(f"unknown kind: {kind}")
    defined = definition_kind(opt(df, "mdx")) if kind in ("subset", "view") else F.lit(None).cast("string")
    return df.select(F.inline(owned), defined.alias("definition_kind"))


def _cube_dimensions(df: DataFrame, dimensions: DataFrame | None) -> DataFrame:
    members = df.select("cube_name", F.posexplode("dimensions").alias("_pos", "dimension_name"))
    if dimensions is not None:
        known = dimensions.select(norm_key(dimensions.columns[0]).alias("_k")).distinct().withColumn("_known", F.lit(True))
        members = members.withColumn("_k", norm_key("dimension_name")).join(known, "_k", "left")
        status = F.when(F.col("_known"), "VALID").otherwise("DIMENSION_NOT_IN_CATALOG")
    else:
        status = F.lit("VALID")
    place = F.col("_pos") + 1
    edge_id = F.concat_ws("::", F.lit("cube-dimension"), clean("cube_name"), padded(place), clean("dimension_name"))
    return members.select(F.inline(F.array(_edge(
        edge_id, node_id("cube", "cube_name"), "CUBE", node_id("dimension", "dimension_name"), "DIMENSION", "USES_DIMENSION", "CUBE_DEFINITION", status, place,
    ))))


def definition_kind(mdx: Column | str) -> Column:
    """MDX when an expression is present, else STATIC."""
    return F.when(clean(mdx) != "", "MDX").otherwise("STATIC")


def task_edges(chores: DataFrame, processes: DataFrame, parameters: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tasks, edges with validation, duplicate tasks). Steps fall back to list position; of equal steps the first stays."""
    listed = chores.where(clean("name") != "").select(clean("name").alias("chore_name"), F.posexplode("tasks").alias("_pos", "task"))
    tasks = listed.select(
        "chore_name", F.coalesce(lenient_int("task.step"), F.col("_pos") + 1).alias("task_step"), "_pos",
        clean("task.process_name").alias("process_name"), F.col("task.parameters").alias("parameters"),
    )
    kept, repeated = split_duplicates(tasks, ["chore_name", "task_step"], "_pos")
    kept = kept.withColumn("node_id", F.concat_ws("::", F.lit("chore-task"), "chore_name", padded("task_step")))
    known = processes.select(norm_key(processes.columns[0]).alias("_p")).distinct().withColumn("_known", F.lit(True))
    called = kept.withColumn("_p", norm_key("process_name")).join(known, "_p", "left")
    call_status = F.when(F.col("_known") & (F.col("process_name") != ""), "VALID").otherwise("PROCESS_NOT_IN_CATALOG")
    name = F.concat_ws("::", "chore_name", padded("task_step"))
    direct = called.select(F.inline(F.array(
        _edge(F.concat(F.lit("chore-task-ownership::"), name), node_id("chore", "chore_name"), "CHORE", F.col("node_id"), "CHORE_TASK", "HAS_TASK", "CATALOG_MATCH", position=F.col("task_step")),
        _edge(F.concat(F.lit("chore-task-call::"), name, F.lit("::"), F.col("process_name")), F.col("node_id"), "CHORE_TASK", node_id("process", "process_name"), "PROCESS", "CALLS_PROCESS", "CATALOG_MATCH", call_status, F.col("task_step")),
    )))
    passed = kept.select("chore_name", "task_step", "node_id", "process_name", F.posexplode("parameters").alias("_at", "p"))
    declared = parameters.select(norm_key("process_name").alias("_p"), norm_key("parameter_name").alias("_n")).distinct().withColumn("_known", F.lit(True))
    checked = passed.withColumns({"_p": norm_key("process_name"), "_n": norm_key("p.Name")}).join(declared, ["_p", "_n"], "left").withColumn("_at", F.col("_at") + 1)
    bound = checked.select(F.inline(F.array(_edge(
        F.concat_ws("::", F.lit("chore-binding"), "chore_name", padded("task_step"), padded("_at")), F.col("node_id"), "CHORE_TASK",
        F.concat_ws("::", F.lit("process-parameter"), "process_name", clean("p.Name")), "PROCESS_PARAMETER", "PASSES_PARAMETER", "LITERAL_BINDING",
        F.when(F.col("_known"), "VALID_PARAMETER_BINDING").otherwise("UNKNOWN_PROCESS_PARAMETER"), F.col("_at"),
    ))))
    return kept.drop("parameters", "_pos"), direct.unionByName(bound), repeated.drop("parameters", "_pos")


def source_edges(processes: DataFrame, objects: DataFrame, views: DataFrame | None = None, subsets: DataFrame | None = None, prefix: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source nodes, declarations, edges with validation) of the configured data sources of processes."""
    classed = with_source_class(processes, prefix).where((clean("process_name") != "") & (F.col("source_type") != "NONE"))
    nodes = first_wins(
        classed.select(F.col("source_node_id").alias("node_id"), F.lit("EXTERNAL_DATA_SOURCE").alias("node_type"), "source_type", "process_name", "query_preview", "credential_present", "credential_redacted"),
        "node_id", ["process_name", "source_type"],
    )
    declarations = classed.select(
        "process_name", node_id("process", "process_name").alias("process_id"),
        source_declaration_id("process_name", F.col("source_type"), F.col("source_node_id")).alias("configured_data_source_id"),
        F.col("source_node_id").alias("shared_source_id"), "source_type", "effective_cube_name", opt(classed, "view_name").alias("view_name"),
        opt(classed, "dimension_name").alias("dimension_name"), "effective_hierarchy_name", opt(classed, "subset_name").alias("subset_name"),
        opt(classed, "server_source_name").alias("server_source_name"), opt(classed, "client_source_name").alias("client_source_name"),
    )
    path = clean(first_nonblank(opt(classed, "server_source_name"), opt(classed, "client_source_name")))
    kind = F.col("source_type")
    view, dim, hier, subset = clean(opt(classed, "view_name")), clean(opt(classed, "dimension_name")), clean("effective_hierarchy_name"), clean(opt(classed, "subset_name"))
    cube = clean("effective_cube_name")
    is_file = kind.isin("ASCII_FILE", "JSON") & (path != "")
    is_view, is_subset = (kind == "CUBE_VIEW") & (cube != "") & (view != ""), (kind == "DIMENSION_SUBSET") & (dim != "") & (hier != "") & (subset != "")
    expression = (
        F.when(is_file, path).when(kind == "ODBC", F.col("source_identity")).when(is_view, F.concat_ws("::", cube, view))
        .when(is_subset, F.concat_ws("::", dim, hier, subset))
    )
    file_id = F.concat(F.lit("file::"), F.sha2(F.lower(path), 256))
    typed = classed.withColumns({
        "target_expression": expression,
        "read_type": F.when(is_file, "READS_FROM_FILE").when(kind == "ODBC", "READS_FROM_ODBC").when(is_view, "READS_FROM_VIEW").when(is_subset, "READS_FROM_SUBSET"),
        "read_target": F.when(is_file, file_id).when(kind == "ODBC", F.col("source_node_id")).when(is_view, view_node_id(cube, view)).when(is_subset, subset_node_id(dim, hier, subset)),
        "read_target_type": F.when(is_file, "FILE").when(kind == "ODBC", "EXTERNAL_DATA_SOURCE").when(is_view, "VIEW").when(is_subset, "SUBSET"),
        "_p": norm_key("process_name"), "_x": norm_key(expression),
    })
    names = lambda df, cond, col: df.where(cond).select(norm_key(col).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    process_keys = names(objects, norm_key("object_type") == "process", "object_name").withColumnsRenamed({"_k": "_p", "_hit": "_process"})
    joined = typed.join(process_keys, "_p", "left")
    def check(df, table, name, needed):
        if table is None:
            return df.withColumn(name, F.lit(True))
        keys = table.select(F.concat_ws("::", *[norm_key(c) for c in needed]).alias("_x")).distinct().withColumn(name, F.lit(True))
        return df.join(keys, "_x", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    joined = check(check(joined, views, "_view", ["cube_name", "view_name"]), subsets, "_subset", ["dimension_name", "hierarchy_name", "subset_name"])
    unchecked = F.lit("EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED")
    verdict = lambda known, table, miss: F.when(F.lit(table is None), unchecked).when(F.col(known), "VALID").otherwise(miss)
    read_status = (
        F.when(F.col("read_type") == "READS_FROM_VIEW", verdict("_view", views, "VIEW_NOT_IN_CATALOG"))
        .when(F.col("read_type") == "READS_FROM_SUBSET", verdict("_subset", subsets, "SUBSET_NOT_IN_CATALOG")).otherwise(unchecked)
    )
    process = node_id("process", "process_name")
    shape = lambda rel, src, src_type, tgt, tgt_type, rel_type, method, status: F.struct(
        rel.alias("relationship_id"), src.alias("source_id"), F.lit(src_type).alias("source_type"), tgt.alias("target_id"), tgt_type.alias("target_type"),
        rel_type.alias("relationship_type"), method.alias("resolution_method"), status.alias("validation_status"), F.col("target_expression").alias("target_expression"),
        F.col("process_name").alias("process_name"), F.col("source_node_id").alias("configured_data_source_id"),
    )
    uses = shape(F.concat_ws("::", F.lit("process-data-source"), "process_name", "source_node_id"), process, "PROCESS", F.col("source_node_id"), F.lit("EXTERNAL_DATA_SOURCE"),
                 F.lit("USES_DATA_SOURCE"), F.lit("CATALOG_EXTRACTION"), F.when(F.col("_process"), "VALID").otherwise("PROCESS_NOT_IN_CATALOG"))
    reads = F.when(F.col("read_type").isNotNull(), shape(
        F.concat_ws("::", F.lit("process-source-target"), "process_name", "read_type", F.sha2("target_expression", 256)), process, "PROCESS",
        F.col("read_target"), F.col("read_target_type"), F.col("read_type"), F.lit("DATA_SOURCE_DEFINITION"), read_status))
    bridge = F.when(F.col("read_type") == "READS_FROM_FILE", shape(
        F.concat_ws("::", F.lit("data-source-file"), "source_node_id", "read_target"), F.col("source_node_id"), "EXTERNAL_DATA_SOURCE", F.col("read_target"), F.lit("FILE"),
        F.lit("RESOLVES_TO_FILE"), F.when(clean(opt(classed, "server_source_name")) != "", "SERVER_SOURCE_NAME").otherwise("CLIENT_SOURCE_NAME"), unchecked))
    flat = joined.select(F.explode(F.array_compact(F.array(uses, reads, bridge))).alias("e")).select("e.*")
    bridged = F.col("relationship_type") == "RESOLVES_TO_FILE"
    # one bridge per source and file, however many processes declare it
    bridges = first_wins(flat.where(bridged), "relationship_id", "process_name").withColumn("process_name", F.lit(None).cast("string"))
    return nodes, declarations, flat.where(~bridged).unionByName(bridges)
