"""Objects, relationships, evidence and validations conformed to the catalog model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classify import (
    confidence_of, effective_confidence, is_control, missing_target_status, object_type_of, relationship_type_of, severity, with_scope,
)
from ..functions.ids import UNIT_SEPARATOR, catalog_relationship_id, object_id, opt, qualified_name, stable_hash
from ..functions.text import blank_to_null, clean, first_nonblank, only_item, positive_int
from ..operators.summarize import consolidate
from ..operators.window import cut, dealt_parts, split_duplicates

#: Tasks over which the relationships of one source may spread.
SOURCE_PARTS = 8


def conform(df: DataFrame, origin: str) -> DataFrame:
    """Relationships of process code (TI) or cube rules (RULE) in one shape."""
    rule = origin == "RULE"
    source = clean(first_nonblank(*[opt(df, c) for c in (("source_cube",) if rule else ("source_name", "process_name"))]))
    kind = clean(first_nonblank(opt(df, "target_object_type"), opt(df, "target_type")))
    name, dimension, attribute = clean(opt(df, "target_name")), clean(opt(df, "dimension_name")), clean(opt(df, "attribute_name"))
    # attribute names are unique only within their dimension
    target = F.when(F.lit(rule) & (F.upper(kind) == "ATTRIBUTE") & (dimension != "") & (attribute != ""), F.concat_ws("::", dimension, attribute)).otherwise(name)
    as_array = lambda column, single, t: opt(df, column, f"array<{t}>") if not rule else F.array_compact(F.array(opt(df, single, t)))
    return df.select(
        F.lit(origin).alias("lineage_source"), F.lit("cube" if rule else "process").alias("source_type"), source.alias("source_name"),
        opt(df, "relationship_type").alias("relationship_type"), kind.alias("target_type"), target.alias("target_name"), opt(df, "target_expression").alias("target_expression"),
        opt(df, "confidence").alias("confidence"), positive_int(opt(df, "evidence_count" if rule else "reference_count")).cast("bigint").alias("reference_count"),
        F.coalesce(as_array("procedures", "procedure", "string") if not rule else F.array().cast("array<string>"), F.array().cast("array<string>")).alias("procedures"),
        F.coalesce(as_array("functions", "function_name", "string"), F.array().cast("array<string>")).alias("functions"),
        F.coalesce(as_array("evidence_lines", "first_line", "int"), F.array().cast("array<int>")).alias("evidence_lines"),
    )


@dataclass
class CatalogSnapshot:
    objects: DataFrame
    relationships: DataFrame
    evidence: DataFrame
    validations: DataFrame
    warnings: DataFrame


def _object_id(kind: Column, key: Column, environment: str, database: str) -> Column:
    """All spellings of a name have one key, and the id is made of that, so rows know the id of their source without a lookup."""
    return object_id(F.lit(environment), F.lit(database), qualified_name(kind, key))


def _shape_object(df: DataFrame, kind: Column, name: Column, environment: str, database: str, snapshot_id: str) -> DataFrame:
    full = qualified_name(kind, name)
    shaped = df.select(
        F.lit(snapshot_id).alias("snapshot_id"), kind.alias("object_type"), name.alias("object_name"), full.alias("qualified_name"),
        _object_id(kind, F.lower(clean(name)), environment, database).alias("object_id"), *[c for c in df.columns if c.startswith("_")],
    )
    return with_scope(shaped, "object_name").drop("catalog_scope")


def catalog_snapshot(objects: DataFrame, relationships: DataFrame, evidence: DataFrame, validations: DataFrame, environment: str, database: str,
                     snapshot_id: str, order: str = "seq") -> CatalogSnapshot:
    """The conformed catalog. ``relationships``, ``evidence`` and ``validations`` have the shape of ``conform``.

    Sources missing from the objects become placeholders with a warning validation, targets resolve by type and name,
    and every published relationship has exactly one validation, with the number of source records behind it.
    """
    typed = objects.select(object_type_of("object_type").alias("_type"), clean("object_name").alias("_name"), F.lower(clean("object_name")).alias("_key"), F.col(order).alias("_order"))
    blank = typed.where(F.col("_name") == "").select(F.lit("SKIPPED_BLANK_OBJECT").alias("warning_type"), F.col("_type").alias("subject"))
    kept, repeated = split_duplicates(typed.where(F.col("_name") != ""), ["_type", "_key"], ["_order", "_name"])
    twice = repeated.select(F.lit("DUPLICATE_LEGACY_OBJECT").alias("warning_type"), F.concat_ws("::", "_type", "_name").alias("subject"))
    kept = cut(kept)
    known = _shape_object(kept.drop("_order"), F.col("_type"), F.col("_name"), environment, database, snapshot_id)
    source_kind = F.when(object_type_of("source_type") != "unknown", object_type_of("source_type")).when(F.upper(clean("lineage_source")) == "RULE", "cube").otherwise("process")
    keyed = lambda df: df.withColumns({"_stype": source_kind, "_sname": clean("source_name"), "_skey": F.lower(clean("source_name"))})
    rel, ev = keyed(relationships), keyed(evidence)
    nameless = rel.where(F.col("_sname") == "").select(F.lit("SKIPPED_RELATIONSHIP_WITHOUT_SOURCE").alias("warning_type"), F.col("target_name").alias("subject")).unionByName(
        ev.where(F.col("_sname") == "").select(F.lit("SKIPPED_EVIDENCE_WITHOUT_SOURCE").alias("warning_type"), F.col("target_name").alias("subject")))
    rel, ev = rel.where(F.col("_sname") != ""), ev.where(F.col("_sname") != "")
    # sources repeat, so their spellings are told apart by hash, as they stand, before keys are made and the least of them is taken
    spelled = lambda df: df.select("source_type", "lineage_source", "source_name").distinct()
    sources = cut(keyed(spelled(relationships).unionByName(spelled(evidence))).where(F.col("_sname") != "").groupBy("_stype", "_skey").agg(F.min("_sname").alias("_name")))
    absent = sources.withColumnsRenamed({"_stype": "_type", "_skey": "_key"}).join(kept, ["_type", "_key"], "left_anti")
    placeholders = _shape_object(absent.select("_type", "_key", "_name"), F.col("_type"), F.col("_name"), environment, database, snapshot_id)
    everything = cut(known.withColumn("adapter_generated", F.lit(False)).unionByName(placeholders.withColumn("adapter_generated", F.lit(True))))
    catalog = everything.select("_type", "_key", F.col("object_id").alias("_oid"), F.col("qualified_name").alias("_qname"))
    as_source = catalog.select(F.col("_type").alias("_stype"), F.col("_key").alias("_skey"), F.col("_oid").alias("source_object_id"), F.col("_qname").alias("source_qualified_name"))
    as_target = catalog.select(F.col("_type").alias("_ttype"), F.col("_key").alias("_tkey"), F.col("_oid").alias("target_object_id"), F.col("_qname").alias("_tq"))
    fallback = lambda kind, name: F.concat_ws("::", kind, F.coalesce(blank_to_null(name), F.lit("<blank target>")))
    to_target = lambda df: df.withColumns({"_ttype": object_type_of("target_type"), "_tkey": F.lower(clean("target_name"))}).join(as_target, ["_ttype", "_tkey"], "left").withColumn(
        "target_qualified_name", F.coalesce("_tq", fallback(F.col("_ttype"), F.col("target_name"))))
    # Targets repeat, so each is looked up once as it stands, and rows meet the few results. What is made of a row comes after the
    # shuffle: in one stage with the scan, the generated code outgrows what the JVM compiles.
    as_written = {"_type_written": F.coalesce("target_type", F.lit("")), "_name_written": F.coalesce("target_name", F.lit(""))}
    targets = cut(to_target(rel.select(*[c.alias(n) for n, c in as_written.items()]).distinct().withColumns({"target_type": F.col("_type_written"), "target_name": F.col("_name_written")})).select(
        *as_written, "_ttype", "target_object_id", "target_qualified_name", F.lower(clean("target_qualified_name")).alias("_tqk")))
    source = F.concat_ws(UNIT_SEPARATOR, "_stype", "_skey").alias("_source")
    met = rel.withColumns(as_written).drop("target_type", "target_name").join(targets, [*as_written], "left").withColumn("_part", F.pmod(F.xxhash64("_tqk"), F.lit(SOURCE_PARTS)))
    # One shuffle, by source and part of its targets, serves both groupings by relationship and the lookup of the source. The source is
    # one column, as a type that is constant would leave the keys but not the shuffle, and rows would be dealt again.
    dealt = met.select(source, "_part", "_ttype", "_tqk", "target_object_id", "target_qualified_name", "relationship_type", "confidence", "target_expression", "lineage_source",
                       "reference_count", "procedures", "functions", "evidence_lines").repartition(dealt_parts(rel), "_source", "_part")
    hit = F.col("target_object_id").isNotNull()
    rated = dealt.withColumns({
        "relationship_type": relationship_type_of("relationship_type"), "confidence": effective_confidence("confidence", "target_expression", hit),
        "procedure": only_item("procedures"), "line_number": only_item("evidence_lines"),
        "discovery_method": F.when(F.col("lineage_source") == "RULE", "rule_parser").otherwise("code_parser"),
    })
    parts = as_source.join(sources.select("_stype", "_skey"), ["_stype", "_skey"], "left_semi").select(source, "_stype", "source_object_id", "source_qualified_name").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SOURCE_PARTS - 1).cast("bigint"))))
    consolidated = consolidate(rated, ["_source", "_part", "_ttype", "_tqk", "target_object_id", "relationship_type", "procedure", "line_number"],
                               ["confidence", "target_expression", "target_qualified_name"], dealt=True)
    joined = consolidated.join(parts.hint("merge"), ["_source", "_part"])
    status = F.when(hit, "VALID").otherwise(missing_target_status(F.col("confidence"), F.col("_ttype")))
    relationship_id = catalog_relationship_id(F.lit(snapshot_id), "source_object_id", "target_object_id", "target_qualified_name", "relationship_type", F.lit(None).cast("int"), "procedure", "line_number")
    published = cut(joined.select(
        relationship_id.alias("relationship_id"), "source_object_id", "source_qualified_name", "target_object_id", "target_qualified_name", F.col("_stype").alias("source_type"), F.col("_ttype").alias("target_type"),
        "relationship_type", "confidence", status.alias("validation_status"), "target_expression", "reference_count", "aggregated_row_count", "discovery_methods", "functions", "procedures", "evidence_lines"))
    ev_rows = ev.withColumn("source_object_id", _object_id(F.col("_stype"), F.col("_skey"), environment, database)).withColumns({
        "relationship_type": relationship_type_of("relationship_type"), "confidence": confidence_of("confidence"),
        "target_expression": clean(first_nonblank(F.col("target_expression"), F.col("target_name"))),
        "procedure": only_item("procedures"), "function_name": only_item("functions"), "line_number": only_item("evidence_lines"),
    }).withColumn("evidence_id", stable_hash(24, snapshot_id=F.lit(snapshot_id), source_object_id=F.col("source_object_id"), relationship_type=F.col("relationship_type"),
                                             target_expression=F.col("target_expression"), procedure=F.col("procedure"), function_name=F.col("function_name"), line_number=F.col("line_number")))
    match = ["_sq", "_rt", "_tqk"]
    alike = validations.groupBy("source_type", "lineage_source", "source_name", "relationship_type", "target_type", "target_name").agg(F.count("*").alias("_records"))
    val = to_target(keyed(alike).join(as_source, ["_stype", "_skey"])).select(
        F.lower("source_qualified_name").alias("_sq"), relationship_type_of("relationship_type").alias("_rt"), F.lower("target_qualified_name").alias("_tqk"), "_records")
    behind = val.groupBy(*match).agg(F.sum("_records").alias("source_validation_record_count"))
    checked = published.withColumns({"_sq": F.lower("source_qualified_name"), "_rt": F.col("relationship_type"), "_tqk": F.lower("target_qualified_name")}).join(behind, match, "left")
    message = F.concat_ws(" ", F.concat(F.lit("Catalog validation "), "validation_status", F.lit(":")), "source_qualified_name", "relationship_type", "target_qualified_name")
    ident = lambda oid, rid, status, text: stable_hash(24, snapshot_id=F.lit(snapshot_id), validation_status=status, object_id=oid, relationship_id=rid, message=text)
    none = F.lit(None).cast("string")
    of_edges = checked.select(ident(none, F.col("relationship_id"), F.col("validation_status"), message).alias("validation_id"), "relationship_id", none.alias("object_id"), "validation_status",
                              severity(F.col("validation_status")).alias("severity"), F.coalesce("source_validation_record_count", F.lit(0)).alias("source_validation_record_count"))
    text = F.concat(F.lit("The relationship source object was missing from the catalog and was created as a placeholder: "), F.col("qualified_name"))
    of_objects = placeholders.select(ident(F.col("object_id"), none, F.lit("NOT_YET_CATALOGED"), text).alias("validation_id"), none.alias("relationship_id"), "object_id",
                                     F.lit("NOT_YET_CATALOGED").alias("validation_status"), F.lit("WARNING").alias("severity"), F.lit(0).cast("bigint").alias("source_validation_record_count"))
    return CatalogSnapshot(
        everything.drop("_type", "_key", "_name"), published,
        ev_rows.select("evidence_id", "source_object_id", "relationship_type", "target_expression", "procedure", "function_name", "line_number", "confidence"),
        of_edges.unionByName(of_objects), blank.unionByName(twice).unionByName(nameless),
    )
