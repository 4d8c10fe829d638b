"""The object-to-object catalog derived from the unified graph."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import vocab
from ..functions.ids import canonical_id, canonical_key, configured_source_id, file_reference_id, opt, relationship_digest, subset_reference_id, view_reference_id
from ..functions.text import blank_to_null, clean, first_nonblank, norm_key, token
from ..operators.resolve import node_label, resolve_references
from ..operators.summarize import signature_conflicts
from ..operators.window import cut, duplicate_ids, first_wins


#: Into how many parts the graph edges of one relationship are dealt.
EDGE_PARTS = 16


@dataclass
class ObjectGraph:
    objects: DataFrame
    relationships: DataFrame
    resolutions: DataFrame
    outcomes: DataFrame
    errors: DataFrame
    source_conflicts: DataFrame
    links: DataFrame


def object_class(kind: Column) -> Column:
    return F.when(kind.isin(*vocab.SYNTHETIC_NODE_TYPES), "CONCEPTUAL_REFERENCE").when(kind.isin(*vocab.EXTERNAL_NODE_TYPES), "EXTERNAL").otherwise("CANONICAL")


def _properties(df: DataFrame, names, columns=None) -> Column:
    filled = F.filter(F.array(*[F.struct(F.lit(n).alias("key"), F.col(c).cast("string").alias("value")) for n, c in zip(names, columns or names)]), lambda e: e["value"].isNotNull())
    return F.map_from_entries(filled)


def catalog_objects(nodes: DataFrame) -> DataFrame:
    """One object per identity; later properties overlay earlier ones."""
    kind = token(first_nonblank(opt(nodes, "node_type"), opt(nodes, "object_type")))
    names = sorted(nodes.columns)
    held = [f"_p{i}" for i in range(len(names))]
    shaped = nodes.select(
        canonical_id(nodes).alias("object_id"), kind.alias("object_type"), object_class(kind).alias("object_class"), node_label(nodes).alias("display_name"),
        canonical_key(nodes).alias("identity_components"), *[F.col(n).cast("string").alias(p) for n, p in zip(names, held)],
    ).where(F.col("object_id") != "")
    # hardly any id repeats, so ids are counted first and only the rows of repeated ones are grouped
    repeated = cut(duplicate_ids(shaped, "object_id").select("object_id"))
    with_properties = lambda df: df.select("object_id", "object_type", "object_class", "display_name", "identity_components", _properties(df, names, held).alias("properties"))
    if repeated.isEmpty():
        return with_properties(shaped)
    # properties are the columns, so the last value of each is kept beside the first row: no row for each property, nothing to join
    order = F.struct("object_type", "display_name")
    first = F.min_by(F.struct("object_type", "object_class", "display_name", "identity_components"), order)
    merged = shaped.join(repeated, "object_id", "left_semi").groupBy("object_id").agg(first.alias("_row"), *[F.max_by(p, F.when(F.col(p).isNotNull(), order)).alias(p) for p in held])
    return with_properties(shaped.join(repeated, "object_id", "left_anti")).unionByName(with_properties(merged.select("object_id", "_row.*", *held)))


def declared_references(declarations: DataFrame, shared: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Declarations with effective names, their own id and the id of the view, subset or file they refer to."""
    fields = ["effective_cube_name", "cube_name", "server_source_name", "client_source_name", "view_name", "dimension_name", "effective_hierarchy_name", "hierarchy_name", "subset_name"]
    own = declarations.select(
        clean(first_nonblank(opt(declarations, "process_id"), F.concat(F.lit("process::"), clean(opt(declarations, "process_name"))))).alias("process_id"),
        clean(first_nonblank(opt(declarations, "shared_source_id"), opt(declarations, "source_id"))).alias("shared_source_id"),
        token("source_type").alias("source_type"), clean(opt(declarations, "configured_data_source_id")).alias("_given"),
        *[opt(declarations, f).alias(f) for f in fields],
    )
    if shared is not None:
        fallback = shared.select(F.col("node_id").alias("shared_source_id"), *[opt(shared, f).alias(f"_s_{f}") for f in fields])
        own = own.join(first_wins(fallback, "shared_source_id", [f"_s_{f}" for f in fields]), "shared_source_id", "left")
    pick = lambda *names: clean(first_nonblank(*[F.col(n) for n in names], *[opt(own, f"_s_{n}") for n in names]))
    named = own.select(
        "process_id", "shared_source_id", "source_type",
        F.coalesce(F.nullif("_given", F.lit("")), configured_source_id(F.col("process_id"), F.col("source_type"), F.col("shared_source_id"))).alias("configured_id"),
        pick("effective_cube_name", "cube_name", "server_source_name", "client_source_name").alias("cube_name"), pick("view_name").alias("view_name"),
        pick("dimension_name").alias("dimension_name"), pick("effective_hierarchy_name", "hierarchy_name", "dimension_name").alias("hierarchy_name"),
        pick("subset_name").alias("subset_name"), pick("server_source_name", "client_source_name").alias("path"),
    )
    kind = F.col("source_type")
    return named.withColumns({
        "reference_kind": F.when(kind == "CUBE_VIEW", "VIEW").when(kind == "DIMENSION_SUBSET", "SUBSET").when(kind.isin("ASCII_FILE", "JSON"), "FILE"),
        "reference_object_id": F.when(kind == "CUBE_VIEW", view_reference_id("cube_name", "view_name", prefix))
        .when(kind == "DIMENSION_SUBSET", subset_reference_id("dimension_name", "hierarchy_name", "subset_name", prefix))
        .when(kind.isin("ASCII_FILE", "JSON"), file_reference_id("path")),
    })


def _relationship_id() -> Column:
    return F.concat(F.lit("object-relationship::"), F.lower(F.hex("_id")))


def consolidated(every: DataFrame) -> DataFrame:
    """One row per relationship, with the status of its first graph edge, whether it is generated alone, and how many graph edges its id has.

    Rows are dealt once by id and part of the edges' ids and once by id; all groups are made where the rows lie then. Between the two a
    relationship has one row for each part, so that the edges of a hot one are spread.
    """
    names = ["source_object_id", "relationship_type", "target_object_id", "relationship_class"]
    edge, status = F.col("graph_relationship_id"), F.col("validation_status")
    dealt = every.withColumn("_part", F.pmod(F.xxhash64(F.coalesce(edge, F.lit(""))), F.lit(EDGE_PARTS))).repartition("_id", "_part")
    # names of one id may differ in letter case and an edge may be repeated under them, so its first row alone counts it
    place = F.row_number().over(W.partitionBy("_id", "_part", "graph_relationship_id").orderBy(*names))
    marked = dealt.withColumn("_counts", (edge.isNotNull() & (place == 1)).cast("bigint"))
    parts = marked.groupBy("_id", "_part", *names).agg(
        F.min(F.struct(F.coalesce(edge, F.lit("\uffff")).alias("e"), status.alias("s"))).alias("_first"), F.bool_and(edge.isNull()).alias("generated"), F.sum("_counts").alias("_n"))
    grouped = parts.repartition("_id").groupBy("_id", *names).agg(F.min("_first")["s"].alias("validation_status"), F.bool_and("generated").alias("generated"), F.sum("_n").alias("_n"))
    return grouped.withColumn("evidence_count", F.greatest(F.sum("_n").over(W.partitionBy("_id")), F.lit(1))).drop("_n")


def object_graph(nodes: DataFrame, edges: DataFrame, declarations: DataFrame, shared: DataFrame | None = None, prefix: str = "") -> ObjectGraph:
    """Objects with class, edges consolidated by class, ownership made explicit, declared sources and references resolved.

    ``links`` holds each contributing graph edge once per consolidated relationship; its counts are the evidence counts.
    """
    # each of these is read by several of the outputs
    base, refs = cut(catalog_objects(nodes)), cut(declared_references(declarations, shared, prefix))
    wanted = first_wins(refs.where(F.col("reference_kind").isNotNull()).select(
        "reference_object_id", "reference_kind", "cube_name", "view_name", "dimension_name", "hierarchy_name", "subset_name", "path"), "reference_object_id", ["cube_name", "view_name", "dimension_name", "hierarchy_name", "subset_name", "path"])
    resolved = cut(resolve_references(wanted, base.where(F.col("object_type").isin("VIEW", "SUBSET", "FILE")).select("object_id", "object_type", "properties")))
    label = (
        F.when(F.col("reference_kind") == "VIEW", F.concat_ws(" / ", "cube_name", "view_name"))
        .when(F.col("reference_kind") == "SUBSET", F.concat_ws(" / ", "dimension_name", "hierarchy_name", "subset_name")).otherwise(F.col("path"))
    )
    kind_name = F.when(F.col("reference_kind") == "FILE", "FILE_REFERENCE").otherwise(F.concat(F.lit(prefix), "reference_kind", F.lit("_REFERENCE")))
    extra = lambda df, ident, kind, klass, name, columns: df.select(
        F.col(ident).alias("object_id"), kind.alias("object_type"), F.lit(klass).alias("object_class"), name.alias("display_name"),
        F.array(kind, F.col(ident)).alias("identity_components"), _properties(df, columns).alias("properties"))
    configured = first_wins(refs.select("configured_id", "process_id", "source_type", "shared_source_id"), "configured_id", ["process_id", "shared_source_id"])
    objects = base.unionByName(extra(configured, "configured_id", F.lit("CONFIGURED_DATA_SOURCE"), "CONFIGURATION", F.substring_index("configured_id", "::", -1), ["process_id", "source_type", "shared_source_id"])).unionByName(
        extra(resolved, "reference_object_id", kind_name, "CONCEPTUAL_REFERENCE", label, ["cube_name", "view_name", "dimension_name", "hierarchy_name", "subset_name", "path", "resolution_status"]))
    # relationships ask for the types alone; an id has a row at most from each of the three, so ids are dealt once, without a grouping before
    types = objects.select("object_id", "object_class", "object_type").repartition("object_id").groupBy("object_id").agg(F.min(F.struct("object_class", "object_type"))["object_type"].alias("object_type"))
    objects = first_wins(objects, "object_id", ["object_class", "object_type"])

    def links(df: DataFrame, source: Column, rel: Column, target: Column, klass: Column, status: Column, graph_id: Column | None = None) -> DataFrame:
        return df.select(source.alias("source_object_id"), rel.alias("relationship_type"), target.alias("target_object_id"), klass.alias("relationship_class"),
                         status.alias("validation_status"), (F.lit(None).cast("string") if graph_id is None else graph_id).alias("graph_relationship_id"))

    rel = token("relationship_type")
    from_graph = links(edges, clean("source_id"), rel, clean("target_id"), F.coalesce(vocab.lookup(vocab.RELATIONSHIP_CLASS, rel), F.lit("OTHER")),
                       F.coalesce(blank_to_null("endpoint_state"), F.lit("VALID")), clean("graph_relationship_id"))
    prop = lambda n: clean(F.try_element_at(F.col("properties"), F.lit(n)))
    owner = lambda r, t: F.struct(F.lit(r).alias("r"), t.alias("t"))
    hierarchy, dimension = F.concat_ws("::", F.lit("hierarchy"), prop("dimension_name"), prop("hierarchy_name")), F.concat_ws("::", F.lit("dimension"), prop("dimension_name"))
    owned = F.when(F.col("object_type").isin("ATTRIBUTE", "SUBSET"), F.array(owner("BELONGS_TO_HIERARCHY", hierarchy), owner("BELONGS_TO_DIMENSION", dimension))).when(
        F.col("object_type") == "VIEW", F.array(owner("BELONGS_TO_CUBE", F.concat_ws("::", F.lit("cube"), prop("cube_name")))))
    valid = F.lit("VALID")
    ownership = base.where(F.col("object_type").isin("ATTRIBUTE", "SUBSET", "VIEW")).select("object_id", F.explode(owned).alias("o"))
    generated = [
        links(ownership, F.col("object_id"), F.col("o.r"), F.col("o.t"), F.lit("STRUCTURAL"), valid),
        links(refs, F.col("process_id"), F.lit("HAS_CONFIGURED_SOURCE"), F.col("configured_id"), F.lit("CONFIGURATION"), valid),
        links(refs.join(base.select(F.col("object_id").alias("shared_source_id")), "shared_source_id", "left_semi"), F.col("configured_id"), F.lit("REFERENCES_SHARED_SOURCE"), F.col("shared_source_id"), F.lit("REFERENCE"), valid),
        links(refs.where(F.col("reference_kind").isNotNull()).join(resolved.select("reference_object_id", "resolution_status"), "reference_object_id"), F.col("configured_id"),
              F.when(F.col("reference_kind") == "FILE", "REFERENCES_FILE").otherwise(F.concat(F.lit(f"REFERENCES_{prefix}"), "reference_kind")), F.col("reference_object_id"), F.lit("REFERENCE"), F.col("resolution_status")),
        links(resolved.where(F.col("resolved_target_object_id").isNotNull()), F.col("reference_object_id"), F.concat(F.lit("RESOLVES_TO_"), "reference_kind"), F.col("resolved_target_object_id"), F.lit("RESOLUTION"), F.col("resolution_status")),
    ]
    # digests do not compress, so they are made again from the written rows
    every = cut(reduce(lambda a, b: a.unionByName(b), [from_graph, *generated])).withColumn("_id", F.unhex(relationship_digest("source_object_id", "relationship_type", "target_object_id", "relationship_class")))
    ends = lambda side: types.select(F.col("object_id").alias(f"{side}_object_id"), F.col("object_type").alias(f"{side}_object_type"))
    # group before the endpoint joins: a relationship seen a million times is looked up once
    looked = consolidated(every).join(ends("source"), "source_object_id", "left").join(ends("target"), "target_object_id", "left").withColumn("object_relationship_id", _relationship_id())
    present = F.col("source_object_type").isNotNull() & F.col("target_object_type").isNotNull()
    contributing = every.where(F.col("graph_relationship_id").isNotNull()).select("_id", "graph_relationship_id").distinct().select(_relationship_id().alias("object_relationship_id"), "graph_relationship_id")
    columns = ["object_relationship_id", "target_object_id", "source_object_id", "relationship_type", "relationship_class", "validation_status", "generated", "source_object_type", "target_object_type", "evidence_count"]
    relationships = looked.where(present).select(columns)
    errors = looked.where(~present).select("object_relationship_id", "source_object_id", "relationship_type", "target_object_id", F.lit("Relationship endpoint is missing").alias("error"))
    outcomes = contributing.join(relationships.select("object_relationship_id").withColumn("_ok", F.lit(True)), "object_relationship_id", "left").select(
        F.col("graph_relationship_id").alias("source_graph_relationship_id"), F.when(F.col("_ok"), F.col("object_relationship_id")).alias("object_relationship_id"),
        F.when(F.col("_ok"), "PROJECTED").otherwise("ERROR").alias("projection_outcome"))
    signature = [norm_key(c).alias(f"_{c}") for c in ("cube_name", "view_name", "dimension_name", "hierarchy_name", "subset_name", "path")]
    conflicts = signature_conflicts(refs.select("shared_source_id", "source_type", *signature), "shared_source_id", ["source_type", *[f"_{c}" for c in ("cube_name", "view_name", "dimension_name", "hierarchy_name", "subset_name", "path")]])
    return ObjectGraph(objects, relationships, resolved, outcomes, errors, conflicts, contributing)
