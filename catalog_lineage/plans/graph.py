"""The unified property graph: every edge with its validation, provenance and outcome."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions.classify import endpoint_state
from ..functions.ids import UNIT_SEPARATOR, opt
from ..functions.text import blank_to_null, clean, first_nonblank, token
from ..operators.filters import require_fields
from ..operators.pairing import SOURCE_FIELDS, pair_best
from ..operators.resolve import complete_endpoints, merge_overlap
from ..operators.sets import outcomes_by_artifact, reconcile_outcomes, sided_counts
from ..operators.summarize import adjacency, distributions, manifest
from ..operators.window import cut, first_wins, richest

REQUIRED_FIELDS = ["source_id", "source_type", "target_id", "target_type", "relationship_type"]
EDGE = ["graph_relationship_id", "source_id", "source_type", "target_id", "target_type", "relationship_type", "resolution_method",
        "endpoint_state", "source_relationship_id", "review_required"]
VALIDATION = ["graph_relationship_id", "validation_status", "endpoint_state", "review_required"]
KEPT = list(dict.fromkeys(EDGE + VALIDATION))
PROVENANCE = ["graph_relationship_id", "source_artifact", "source_record_id", "derivation_method"]
OUTCOME = ["source_artifact", "source_record_id", "graph_relationship_id", "projection_outcome"]
ERROR = ["stage", "source_artifact", "source_record_id", "error"]


@dataclass
class Projection:
    #: One row for each edge, with its validation.
    kept: DataFrame
    provenance: DataFrame
    outcomes: DataFrame
    errors: DataFrame
    stubs: DataFrame | None = None

    @property
    def edges(self) -> DataFrame:
        return self.kept.select(*EDGE)

    @property
    def validations(self) -> DataFrame:
        return self.kept.select(*VALIDATION)


def _error(df: DataFrame, stage: str, artifact: str, record: Column, text) -> DataFrame:
    return df.select(F.lit(stage).alias("stage"), F.lit(artifact).alias("source_artifact"), record.cast("string").alias("source_record_id"),
                     (text if isinstance(text, Column) else F.lit(text)).alias("error"))


def _all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def graph_nodes(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(nodes, rows without identity). Node tables in one; of equal ids the richer row stays, the earlier one on ties."""
    columns = ["node_id", "node_type", "object_name", "display_value", "is_control", "endpoint_state", "dimension_name", "hierarchy_name", "attribute_name",
               "subset_name", "view_name", "cube_name"]
    shaped = []
    for rank, (name, df) in enumerate(tables.items()):
        kind = F.lower(clean(first_nonblank(opt(df, "node_type"), opt(df, "object_type"))))
        own = clean(opt(df, "object_name"))
        parts = [clean(opt(df, c)) for c in ("dimension_name", "hierarchy_name", "attribute_name")]
        derived = (
            F.when((kind == "attribute") & (parts[0] != "") & (parts[1] != "") & (parts[2] != ""), F.concat_ws("::", F.lit("attribute"), *parts))
            .when((kind != "") & (own != ""), F.concat_ws("::", kind, own)).otherwise("")
        )
        shaped.append(df.select(
            F.coalesce(blank_to_null(opt(df, "node_id")), derived).alias("node_id"), token(kind).alias("node_type"),
            *[opt(df, c, "boolean" if c == "is_control" else "string").alias(c) for c in columns[2:]],
            F.lit(name).alias("source_artifact"), F.lit("CATALOG").alias("node_origin"), F.lit(rank).alias("_rank"),
        ))
    union = _all(shaped)
    missing = _error(union.where(F.col("node_id") == ""), "PROJECT_NODE", "nodes", F.col("source_artifact"), "Unable to derive node_id")
    return richest(union.where(F.col("node_id") != ""), "node_id", ["_rank", "object_name", "display_value"]).drop("_rank"), missing


def _direct_rows(rows: DataFrame) -> Projection:
    """Edge, validation, provenance and outcome rows of validated structural relationships of any domain."""
    rows = rows.withColumns({
        "graph_relationship_id": F.concat_ws("::", F.lit("graph"), F.lower("_domain"), "relationship_id"),
        "endpoint_state": endpoint_state("target_type", F.col("_status")),
        "source_relationship_id": F.col("relationship_id"), "review_required": F.lit(False),
        "validation_status": F.coalesce(blank_to_null("_status"), F.lit("PROJECTED")),
        "resolution_method": opt(rows, "resolution_method"),
        "source_artifact": F.col("_artifact"), "source_record_id": F.col("relationship_id"), "derivation_method": F.lit("DIRECT_PROJECTION"),
        "projection_outcome": F.lit("PROJECTED"),
    })
    rows = cut(rows.select(*dict.fromkeys(EDGE + VALIDATION + PROVENANCE + OUTCOME)))
    once = first_wins(rows.select(*KEPT), "graph_relationship_id", ["source_id", "target_id"])
    return Projection(once, rows.select(*PROVENANCE), rows.select(*OUTCOME), None)


def _validated(relationships: DataFrame, validations: DataFrame) -> DataFrame:
    status = validations.groupBy("_domain", "relationship_id").agg(F.max("validation_status").alias("_status"))
    return relationships.join(status, ["_domain", "relationship_id"], "left")


def _tidy(df: DataFrame) -> DataFrame:
    return df.withColumns({
        **{c: clean(c) for c in ("relationship_id", "source_id", "target_id")}, **{c: token(c) for c in ("source_type", "target_type", "relationship_type")},
    })


def _in_domain(df: DataFrame, domain: str, artifact: str) -> DataFrame:
    return df.withColumns({"_domain": F.lit(domain), "_artifact": F.lit(artifact)})


def project_domains(domains: dict[str, tuple[DataFrame, DataFrame]]) -> Projection:
    """Structural relationships of all domains as graph edges, in one pass over their union.

    Rows lacking a field become errors with an ERROR outcome, rows without an id only errors.
    """
    shape = lambda df: df.select("relationship_id", *REQUIRED_FIELDS, opt(df, "resolution_method").alias("resolution_method"), "_domain", "_artifact")
    relationships = _all([shape(rel if "_domain" in rel.columns else _in_domain(rel, name, name)) for name, (rel, _) in domains.items()])
    validations = _all([(val if "_domain" in val.columns else _in_domain(val, name, name)).select("_domain", "relationship_id", "validation_status") for name, (_, val) in domains.items()])
    named = clean("relationship_id") != ""
    whole, lacking = require_fields(relationships.where(named), REQUIRED_FIELDS)
    out = _direct_rows(_validated(_tidy(whole), validations))
    out.outcomes = out.outcomes.unionByName(lacking.select(
        F.col("_artifact").alias("source_artifact"), F.col("relationship_id").alias("source_record_id"), F.lit(None).cast("string").alias("graph_relationship_id"), F.lit("ERROR").alias("projection_outcome")))
    failed = lambda df, text: df.select(F.lit("PROJECT_RELATIONSHIP").alias("stage"), F.col("_artifact").alias("source_artifact"), F.col("relationship_id").cast("string").alias("source_record_id"), text.alias("error"))
    out.errors = failed(relationships.where(~named), F.lit("Source relationship has no relationship_id")).unionByName(
        failed(lacking, F.concat(F.lit("Source relationship is missing required fields: "), F.array_join("missing_fields", ", "))))
    return out


def project_direct(domain: str, artifact: str, relationships: DataFrame, validations: DataFrame) -> Projection:
    """One domain of structural relationships as graph edges."""
    return project_domains({artifact: (_in_domain(relationships, domain, artifact), _in_domain(validations, domain, artifact))})


def project_overlapping(artifact: str, relationships: DataFrame, validations: DataFrame, existing: DataFrame) -> Projection:
    """Edges of a domain that overlaps another: known ones only add provenance, the rest are projected."""
    fresh, overlap = merge_overlap(_tidy(_in_domain(relationships, "datasource", artifact)), existing)
    out = _direct_rows(_validated(fresh, _in_domain(validations, "datasource", artifact)))
    added = overlap.select(F.col("existing_graph_id").alias("graph_relationship_id"), F.lit(artifact).alias("source_artifact"),
                           F.col("relationship_id").alias("source_record_id"), F.lit("DIRECT_PROJECTION").alias("derivation_method"))
    out.provenance = out.provenance.unionByName(added)
    out.outcomes = out.outcomes.unionByName(added.select("source_artifact", "source_record_id", "graph_relationship_id", F.lit("EXCLUDED_REDUNDANT_WITH_PROVENANCE").alias("projection_outcome")))
    out.errors = _error(relationships.limit(0), "PROJECT_RELATIONSHIP", artifact, F.lit(None), "")
    return out


def _source_identity(domain: str, df: DataFrame) -> Column:
    name = clean(first_nonblank(*[opt(df, c) for c in (("process_name", "source_name") if domain == "TI" else ("source_cube", "source_name", "cube_name"))]))
    return F.concat(F.lit("process::" if domain == "TI" else "cube::"), name)


def project_semantic(domain: str, artifact: str, semantic: DataFrame, relationships: DataFrame, nodes: DataFrame,
                     row_order: str = "semantic_validation_id", position: str = "position") -> Projection:
    """Semantic validations as graph edges.

    The target is the resolved node, else the canonical name if it has a node, else a synthetic reference or planned
    target. Rows that meet no relationship of their type, and repeated edge ids, are errors with an ERROR outcome.
    """
    pairs = pair_best(semantic.withColumn("row_id", F.col("semantic_validation_id")).withColumn("row_order", F.col(row_order)),
                      relationships.withColumn("rel_id", F.col(position).cast("string")), position=position)
    source = relationships.select(
        F.col(position).cast("string").alias("rel_id"), _source_identity(domain, relationships).alias("_source"), token("relationship_type").alias("_rel_type"),
        token(first_nonblank(opt(relationships, "target_type"), opt(relationships, "target_object_type"))).alias("_rel_target_type"),
        clean(opt(relationships, "target_name")).alias("_rel_target"), clean(opt(relationships, "target_expression")).alias("_expression"),
    )
    # a row without a partner gets a key of its own in the joins, so that such rows do not meet in one task
    alone = F.concat(F.lit("\u0001"), "semantic_validation_id")
    joined = (
        semantic.join(pairs.withColumnRenamed("row_id", "semantic_validation_id"), "semantic_validation_id", "left")
        .withColumn("_rel", F.coalesce("rel_id", alone)).join(source.withColumnRenamed("rel_id", "_rel"), "_rel", "left")
    )
    paired = F.coalesce(F.col("_rel_type").isNotNull() & (token("relationship_type") == F.col("_rel_type")), F.lit(False))
    status, decision = token("semantic_validation_status"), token("decision_type")
    target_type = token(first_nonblank(F.col("domain"), F.col("_rel_target_type")))
    target_name = clean(first_nonblank(F.col("target_name"), F.col("_rel_target")))
    staged = joined.withColumns({"_paired": paired, "_type": target_type, "_name": target_name, "_status": status})
    resolved = clean(opt(semantic, "resolved_target_node_id"))
    named = F.when(F.col("_type").isin("CUBE", "DIMENSION", "PROCESS", "CHORE") & (F.col("_name") != ""), F.concat_ws("::", F.lower("_type"), "_name"))
    kept_valid = (decision == "PARSER_PRESERVED") & F.contains("_status", F.lit("VALID"))
    known = nodes.select(F.col("node_id").alias("_canonical"), F.col("node_type").alias("_canonical_type"))
    wanted = F.when(resolved != "", resolved).when(kept_valid, named)
    located = staged.withColumn("_wanted", wanted).join(known, F.coalesce("_wanted", alone) == F.col("_canonical"), "left")
    dynamic = F.contains("_status", F.lit("DYNAMIC")) | (token(opt(semantic, "profiler_classification")) == "DYNAMIC_REFERENCE")
    outcome = (
        F.when(resolved != "", "PROJECTED").when(kept_valid, F.when(F.col("_canonical").isNotNull(), "PROJECTED").otherwise("PROJECTED_AS_PLANNED_TARGET"))
        .when(dynamic, "PROJECTED_AS_DYNAMIC_REFERENCE").otherwise("PROJECTED_AS_PLANNED_TARGET")
    )
    kind = F.when(F.col("projection_outcome") == "PROJECTED_AS_DYNAMIC_REFERENCE", "REFERENCE_EXPRESSION").otherwise("PLANNED_TARGET")
    basis = F.concat_ws(UNIT_SEPARATOR, F.lit(domain), "_type", "_name", "_expression")
    synthetic = F.concat(F.replace(F.lower(kind), F.lit("_"), F.lit("-")), F.lit(f"::{domain.lower()}::"), F.sha2(F.lower(basis), 256))
    ordinal = F.coalesce(opt(semantic, "semantic_group_position", "bigint"), F.lit(1)).cast("string")
    source_record = F.concat(F.lit(f"semantic-source::{domain.lower()}::"), F.sha2(F.lower(F.concat_ws(
        UNIT_SEPARATOR, F.lit(domain), "_source", "_rel_type", "_rel_target_type", F.coalesce(F.nullif("_rel_target", F.lit("")), F.col("_expression")), ordinal)), 256))
    rows = located.withColumn("projection_outcome", outcome).withColumns({
        "target_id": F.when(F.col("projection_outcome") == "PROJECTED", F.col("_wanted")).otherwise(synthetic),
        "target_type": F.when(F.col("projection_outcome") == "PROJECTED", F.coalesce("_canonical_type", "_type")).otherwise(kind),
        "source_id": F.col("_source"), "source_type": F.lit("PROCESS" if domain == "TI" else "CUBE"),
        "relationship_type": F.col("_rel_type"), "source_record_id": source_record,
        "source_artifact": F.lit(artifact), "derivation_method": F.lit("SEMANTIC_PROJECTION"),
    })
    rows = rows.withColumns({
        "graph_relationship_id": F.concat(F.lit(f"graph::semantic::{domain.lower()}::"), F.sha2(F.lower(F.concat_ws("|", "source_record_id", "target_id", "semantic_validation_id")), 256)),
        "endpoint_state": endpoint_state("target_type", F.col("_status")), "source_relationship_id": F.col("source_record_id"),
        "validation_status": F.col("semantic_validation_status"), "review_required": F.coalesce(opt(semantic, "review_required", "boolean"), F.lit(False)),
    })
    # one wide table, written once, from which everything is selected; of repeated ids the first row stays. Ids are counted by a short
    # hash, so that only those that may repeat are compared, and the wide rows are not shuffled again.
    edge_id = F.when(F.col("_paired"), F.col("graph_relationship_id")).otherwise(alone)
    wide = [*KEPT, *PROVENANCE, *OUTCOME, "semantic_validation_id", "_type", "_name", "_expression", "_paired"]
    rows = cut(rows.select(*dict.fromkeys(wide), edge_id.alias("_id"), F.coalesce("rel_id", F.lit("")).alias("_place")))
    short = F.xxhash64("_id").alias("_short")
    again = cut(rows.groupBy(short).agg(F.count("*").alias("_n")).where("_n > 1").select("_short"))
    place = F.struct("semantic_validation_id", "_place")
    first = cut(rows.select("_id", short, place.alias("_at")).join(again, "_short", "left_semi").groupBy("_id").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    rows = rows.join(first, "_id", "left").withColumn("_kept", F.col("_paired") & (F.col("_first").isNull() | (place == F.col("_first"))))
    keep, repeated, unpaired = rows.where("_kept"), rows.where("_paired and not _kept"), rows.where("not _paired")
    lost = lambda df, record: df.select(F.lit(artifact).alias("source_artifact"), record.alias("source_record_id"), F.lit(None).cast("string").alias("graph_relationship_id"), F.lit("ERROR").alias("projection_outcome"))
    errors = _error(unpaired, "PAIR_SEMANTIC_SOURCE", artifact, F.col("semantic_validation_id"), "no relationship answers to this validation").unionByName(
        _error(repeated, "PROJECT_SEMANTIC_RELATIONSHIP", artifact, F.col("source_record_id"), "an earlier row has this edge id"))
    stubs = keep.where(F.col("projection_outcome") != "PROJECTED").select(
        F.col("target_id").alias("node_id"), F.col("target_type").alias("node_type"), F.coalesce(F.nullif("_name", F.lit("")), F.col("_expression")).alias("display_value"),
        F.when(F.col("target_type") == "REFERENCE_EXPRESSION", "DYNAMIC").otherwise("PLANNED").alias("endpoint_state"),
        F.col("_type").alias("target_domain"), F.nullif("_expression", F.lit("")).alias("target_expression"), F.lit("SEMANTIC_PROJECTION").alias("node_origin"),
    )
    return Projection(
        keep.select(*KEPT), keep.select(*PROVENANCE),
        _all([keep.select(*OUTCOME), lost(repeated, F.col("source_record_id")), lost(unpaired, F.col("semantic_validation_id"))]), errors,
        first_wins(stubs, "node_id", "display_value"),
    )


@dataclass
class GraphInputs:
    """node tables by artifact; (relationships, validations) by domain; sources overlap the 'Operational' domain."""
    nodes: dict[str, DataFrame]
    direct: dict[str, tuple[DataFrame, DataFrame]] = field(default_factory=dict)
    sources: tuple[DataFrame, DataFrame] | None = None
    semantic: dict[str, tuple[DataFrame, DataFrame]] = field(default_factory=dict)


@dataclass
class Graph:
    nodes: DataFrame
    edges: DataFrame
    validations: DataFrame
    provenance: DataFrame
    unresolved: DataFrame
    outcomes: DataFrame
    errors: DataFrame
    outbound: DataFrame
    inbound: DataFrame
    coverage: DataFrame
    type_summary: DataFrame
    manifest: DataFrame


def build_graph(inputs: GraphInputs, snapshot_id: str = "", promote: bool = True) -> Graph:
    """Nodes, edges, validations, provenance, unresolved targets, outcomes, indexes, coverage and manifest in one build."""
    nodes, node_errors = graph_nodes(inputs.nodes)
    parts, expected = [], []
    if inputs.direct:
        parts.append(project_domains(inputs.direct))
    for domain, (relationships, _) in inputs.direct.items():
        expected.append(relationships.where(clean("relationship_id") != "").select(F.lit(domain).alias("source_artifact")))
    if inputs.sources is not None:
        known = parts[0].edges if parts else inputs.sources[0].limit(0).withColumn("graph_relationship_id", F.lit(""))
        existing = known.where(F.startswith("graph_relationship_id", F.lit("graph::operational::")))
        parts.append(project_overlapping("DataSource", *inputs.sources, existing))
        expected.append(inputs.sources[0].select(F.lit("DataSource").alias("source_artifact")))
    structural = cut(complete_endpoints(nodes, _all([p.edges for p in parts]))) if parts else nodes
    for domain, (semantic, relationships) in inputs.semantic.items():
        parts.append(project_semantic(domain, domain, semantic, relationships, structural))
        expected.append(semantic.select(F.lit(domain).alias("source_artifact")))
    # edges and validations are one table, read by indexes, checks and counts; provenance and outcomes are columns of written tables
    kept = cut(_all([p.kept for p in parts]))
    edges, validations = kept.select(*EDGE), kept.select(*VALIDATION)
    provenance, outcomes = _all([p.provenance for p in parts]), _all([p.outcomes for p in parts])
    stub_frames = [p.stubs for p in parts if p.stubs is not None]
    unresolved = first_wins(_all(stub_frames), "node_id", "display_value") if stub_frames else structural.limit(0).select("node_id", "node_type")
    everyone = cut(complete_endpoints(structural.unionByName(unresolved, allowMissingColumns=True), edges))
    coverage = outcomes_by_artifact(_all(expected), outcomes)
    mismatch = sided_counts({"edge": edges.select("graph_relationship_id"), "val": validations.select("graph_relationship_id"),
                             "prov": provenance.select("graph_relationship_id").distinct()}, "graph_relationship_id")
    wrong = mismatch.where((F.col("edge") != 1) | (F.col("val") != 1) | (F.col("prov") != 1))
    checks = reconcile_outcomes(outcomes, edges, everyone, unresolved)
    errors = cut(_all([
        node_errors, *[p.errors for p in parts],
        _error(wrong, "VALIDATE_GRAPH", "edges", F.col("graph_relationship_id"), "edges, validations and provenance hold different ids"),
        _error(coverage.where(~F.col("reconciles")), "VALIDATE_GRAPH", "outcomes", F.col("source_artifact"), "relationships and outcomes differ in number"),
        _error(checks.where(~F.col("pass")), "VALIDATE_GRAPH", "outcomes", F.lit(None), "outcomes and graph differ"),
    ]))
    outbound, inbound = adjacency(edges)
    summary = distributions(edges, [["relationship_type"], ["endpoint_state"], ["source_type", "target_type"]])
    tables = {"nodes": (everyone, "node_type"), "edges": (edges, "relationship_type"), "validations": (validations, None), "outcomes": (outcomes, "projection_outcome"), "unresolved": (unresolved, None)}
    return Graph(everyone, edges, validations, provenance, unresolved, outcomes, errors, outbound, inbound, coverage, summary,
                 manifest(tables, errors, snapshot_id, promote))


def build_lineage(domains: DataFrame, manifests: DataFrame, graph_snapshot_id: str, run_id: str | None = None) -> DataFrame:
    """Which source snapshot each part of a build came from; parts without a manifest have none."""
    return domains.select("domain").join(manifests.select("domain", "snapshot_id"), "domain", "left").select(
        "domain", F.col("snapshot_id").alias("source_snapshot_id"), F.lit(graph_snapshot_id).alias("graph_snapshot_id"), F.lit(run_id).cast("string").alias("pipeline_run_id")
    )
