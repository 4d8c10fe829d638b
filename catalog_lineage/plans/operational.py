"""Files, scripts, commands and executables as nodes and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions.classify import command_children, with_command_kind, with_path_class
from ..functions.ids import opt
from ..functions.text import clean, first_nonblank, norm_key, token
from ..operators.filters import filter_types
from ..operators.resolve import with_evidence_count
from ..operators.window import first_wins

NODE_COLUMNS = ["node_id", "node_type", "display_value", "is_dynamic", "credential_redacted"]


def operational_edges(refs: DataFrame, evidence: DataFrame, order: str = "seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges with evidence count and validation, errors) from code and source relationships."""
    name = lambda df: clean(first_nonblank(opt(df, "process_name"), opt(df, "source_name")))
    expression = lambda df: clean(first_nonblank(opt(df, "target_expression"), opt(df, "target_name")))
    picked = filter_types(refs).withColumns({
        "process_name": name(refs), "target_expression": expression(refs), "relationship_type": token("relationship_type"),
        "_given_source": clean(opt(refs, "source_id")), "_given_target": clean(opt(refs, "target_id")), "_origin": token(opt(refs, "relationship_origin")),
    })
    bridge = F.col("relationship_type").isin(*vocab.BRIDGE_TYPES)
    complete = F.when(
        bridge, (F.col("_given_source") != "") & (token(opt(refs, "source_type")) == "EXTERNAL_DATA_SOURCE") & (F.col("target_expression") != "")
    ).otherwise((F.col("process_name") != "") & (F.col("target_expression") != ""))
    errors = picked.where(~complete).select(
        F.lit("NORMALIZE_OPERATIONAL_RELATIONSHIP").alias("stage"), "relationship_type", "process_name",
        F.when(bridge, "Missing external data-source identity or target expression").otherwise("Missing process name or target expression").alias("error"),
    )
    whole = picked.where(complete)
    command = F.col("relationship_type").isin(*vocab.COMMAND_TYPES)
    common = lambda df: df.withColumn("node_id", F.when((F.col("_given_target") != "") & (F.col("_origin") == "PROCESS_DEFINITION"), F.col("_given_target")).otherwise(F.col("node_id")))
    files = common(with_path_class(whole.where(~command), "target_expression"))
    commands = common(with_command_kind(whole.where(command), "target_expression")).withColumn("display_value", F.col("sanitized_expression"))
    columns = ["relationship_type", "process_name", "target_expression", "_given_source", order, *NODE_COLUMNS]
    seen = files.select(*columns).unionByName(commands.select(*columns))
    source = F.when(bridge, F.col("_given_source")).otherwise(F.concat(F.lit("process::"), F.col("process_name")))
    placed = seen.withColumns({
        "source_id": source, "source_type": F.when(bridge, "EXTERNAL_DATA_SOURCE").otherwise("PROCESS"),
        "relationship_id": F.concat_ws("::", F.lit("operational"), norm_key(source), "relationship_type", "node_id"),
    })
    edges = first_wins(
        placed.select("relationship_id", "source_id", "source_type", F.col("node_id").alias("target_id"), F.col("node_type").alias("target_type"),
                      "relationship_type", "process_name", "target_expression", "is_dynamic", order),
        "relationship_id", [order, "target_expression"],
    )
    dynamic = F.when(F.col("target_type") == "COMMAND", "DYNAMIC_EXTERNAL_COMMAND").otherwise("DYNAMIC_EXTERNAL_FILE")
    edges = with_evidence_count(edges, evidence.withColumns({"process_name": name(evidence), "target_expression": expression(evidence)})).select(
        "relationship_id", "source_id", "source_type", "target_id", "target_type", "relationship_type",
        F.when(F.col("is_dynamic"), "DYNAMIC_EXPRESSION").otherwise("NORMALIZED_LITERAL").alias("resolution_method"), "evidence_count",
        F.when(F.col("is_dynamic"), dynamic).otherwise("EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED").alias("validation_status"),
    )
    own_commands = first_wins(commands.select("node_id", "sanitized_expression", order), "node_id", order)
    children = command_children(own_commands)
    scripts = with_path_class(children.where(F.col("child_relationship_type") == "REFERENCES_SCRIPT").withColumnRenamed("node_id", "command_id"), "operand")
    runs = children.where(F.col("child_relationship_type") == "INVOKES_EXECUTABLE").select(
        F.col("node_id").alias("command_id"), "child_relationship_type", F.concat(F.lit("executable::"), F.col("operand")).alias("node_id"), F.lit("EXECUTABLE").alias("node_type"),
        F.col("operand").alias("display_value"), F.lit(False).alias("is_dynamic"), F.lit(False).alias("credential_redacted"), order,
    )
    below = scripts.select("command_id", "child_relationship_type", *NODE_COLUMNS, order).unionByName(runs)
    child_edges = below.select(
        F.concat_ws("::", F.lit("operational-command"), "command_id", "child_relationship_type", "node_id").alias("relationship_id"),
        F.col("command_id").alias("source_id"), F.lit("COMMAND").alias("source_type"), F.col("node_id").alias("target_id"), F.col("node_type").alias("target_type"),
        F.col("child_relationship_type").alias("relationship_type"), F.lit("TOKEN_PARSE").alias("resolution_method"), F.lit(1).cast("bigint").alias("evidence_count"),
        F.lit("EXTERNAL_DEPENDENCY_NOT_CROSS_CHECKED").alias("validation_status"),
    ).distinct()
    nodes = first_wins(seen.select(*NODE_COLUMNS, order).unionByName(below.select(*NODE_COLUMNS, order)), "node_id", [order, "display_value"]).drop(order)
    return nodes, edges.unionByName(child_edges), errors
