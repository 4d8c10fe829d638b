"""Unions and reconciliation of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean, norm_key, token


def union_domains(domains: dict[str, DataFrame], label: str = "origin") -> DataFrame:
    """All domains in one table, each row labelled with the domain it came from."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in domains.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def sided_counts(sides: dict[str, DataFrame], on) -> DataFrame:
    """One row per key with its row count on each side: one shuffle, combined before it."""
    on = [on] if isinstance(on, str) else list(on)
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(*on, *[F.lit(1 if other == name else 0).alias(other) for other in sides]) for name, df in sides.items()],
    )
    return stacked.groupBy(*on).agg(*[F.sum(name).alias(name) for name in sides])


def reconcile(relationships: DataFrame, validations: DataFrame, on: str = "relationship_id", domain: str | None = None) -> DataFrame:
    """Whether both tables hold the same ids once each; per domain when a domain column is named."""
    keys = [domain, on] if domain else [on]
    sides = {"rel": relationships, "val": validations}
    counts = sided_counts({n: df.withColumn(on, clean(on)) for n, df in sides.items()}, keys)
    named = F.col(on) != ""
    covered = F.coalesce(F.bool_and(named), F.lit(True))
    guarded = lambda c: F.when(covered, c).otherwise(F.lit(0))
    grouped = counts.groupBy(*keys[:-1]).agg(
        F.coalesce(F.sum("rel"), F.lit(0)).alias("relationships"),
        F.coalesce(F.sum("val"), F.lit(0)).alias("validations"),
        covered.alias("id_coverage"),
        guarded(F.coalesce(F.sum(F.greatest(F.col("rel") - 1, F.lit(0))), F.lit(0))).alias("duplicate_relationship_ids"),
        guarded(F.coalesce(F.sum(F.greatest(F.col("val") - 1, F.lit(0))), F.lit(0))).alias("duplicate_validation_ids"),
        guarded(F.count_if((F.col("rel") > 0) & (F.col("val") == 0))).alias("missing_validations"),
        guarded(F.count_if((F.col("rel") == 0) & (F.col("val") > 0))).alias("orphan_validations"),
    )
    issues = ["duplicate_relationship_ids", "duplicate_validation_ids", "missing_validations", "orphan_validations"]
    clear = F.col("relationships") == F.col("validations")
    for name in issues:
        clear = clear & (F.col(name) == 0)
    return grouped.withColumn("pass", clear)


def check_partition(whole: DataFrame, regular: DataFrame, control: DataFrame, type_col="object_type", name_col="object_name") -> DataFrame:
    """Whether two tables split a third: disjoint, complete, free of duplicates, rightly flagged."""
    keyed = lambda df: df.select(norm_key(type_col).alias("t"), norm_key(name_col).alias("n"))
    counts = sided_counts({"whole": keyed(whole), "regular": keyed(regular), "control": keyed(control)}, ["t", "n"])
    keys = counts.agg(
        F.coalesce(F.sum("whole"), F.lit(0)).alias("whole_rows"),
        F.coalesce(F.sum("regular"), F.lit(0)).alias("regular_rows"),
        F.coalesce(F.sum("control"), F.lit(0)).alias("control_rows"),
        F.count_if((F.col("regular") > 0) & (F.col("control") > 0)).alias("overlapping_keys"),
        F.count_if((F.col("whole") > 0) & (F.col("regular") + F.col("control") == 0)).alias("missing_keys"),
        F.count_if((F.col("whole") == 0) & (F.col("regular") + F.col("control") > 0)).alias("foreign_keys"),
        F.coalesce(F.sum(F.greatest(F.col("whole") - 1, F.lit(0))), F.lit(0)).alias("duplicate_rows"),
    )
    starts = F.startswith(clean(name_col), F.lit("}"))
    bad = lambda df, control_side: df.agg(F.count_if(~(
        (starts == F.lit(control_side))
        & F.coalesce(F.col("is_control") == F.lit(control_side), F.lit(False))
        & (token("catalog_scope") == ("CONTROL" if control_side else "REGULAR"))
    )).alias(f"invalid_{'control' if control_side else 'regular'}_rows"))
    row = keys.crossJoin(F.broadcast(bad(regular, False))).crossJoin(F.broadcast(bad(control, True)))
    clear = F.col("whole_rows") == F.col("regular_rows") + F.col("control_rows")
    for name in ("overlapping_keys", "missing_keys", "foreign_keys", "duplicate_rows", "invalid_regular_rows", "invalid_control_rows"):
        clear = clear & (F.col(name) == 0)
    return row.withColumn("pass", clear)


PROJECTED = ("PROJECTED", "PROJECTED_AS_DYNAMIC_REFERENCE", "PROJECTED_AS_PLANNED_TARGET")


def outcomes_by_artifact(expected: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Source rows and outcomes of each artifact side by side."""
    counts = sided_counts(
        {"source_records": expected.select("source_artifact"), "outcomes": outcomes.select("source_artifact")}, "source_artifact"
    )
    return counts.withColumn("reconciles", F.col("source_records") == F.col("outcomes"))


def reconcile_outcomes(outcomes: DataFrame, edges: DataFrame, nodes: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Projected outcomes equal edges; synthetic nodes equal the unresolved list."""
    projected = outcomes.agg(
        F.count_if(token("projection_outcome").isin(*PROJECTED)).alias("projected_outcomes"),
        F.count_if(clean("projection_outcome") == "").alias("blank_outcomes"),
    )
    edge_count = edges.agg(F.count("*").alias("edges"))
    synthetic = nodes.where(token("node_type").isin("REFERENCE_EXPRESSION", "PLANNED_TARGET")).select("node_id").distinct()
    ends = sided_counts({"synthetic": synthetic, "listed": unresolved.select("node_id").distinct()}, "node_id").agg(
        F.coalesce(F.sum("synthetic"), F.lit(0)).alias("synthetic_nodes"),
        F.count_if((F.col("synthetic") > 0) & (F.col("listed") == 0)).alias("missing_unresolved"),
        F.count_if((F.col("synthetic") == 0) & (F.col("listed") > 0)).alias("orphan_unresolved"),
    )
    row = projected.crossJoin(F.broadcast(edge_count)).crossJoin(F.broadcast(ends))
    return row.withColumn(
        "pass",
        (F.col("projected_outcomes") == F.col("edges")) & (F.col("blank_outcomes") == 0)
        & (F.col("missing_unresolved") == 0) & (F.col("orphan_unresolved") == 0),
    )


def check_adjacency(edges: DataFrame, outbound: DataFrame, inbound: DataFrame, edge_id: str = "graph_relationship_id") -> DataFrame:
    """The ids in both adjacency indexes are exactly the edge ids."""
    flat = lambda df: df.select(F.explode("edge_ids").alias(edge_id))
    counts = sided_counts({"edge": edges.select(edge_id), "outb": flat(outbound), "inb": flat(inbound)}, edge_id)
    return counts.agg(
        F.count_if(F.col("edge") > 0).alias("edges"),
        F.count_if((F.col("edge") > 0) & (F.col("outb") == 0)).alias("missing_outbound"),
        F.count_if((F.col("edge") > 0) & (F.col("inb") == 0)).alias("missing_inbound"),
        F.count_if((F.col("edge") == 0)).alias("unknown_ids"),
    ).withColumn("pass", (F.col("missing_outbound") == 0) & (F.col("missing_inbound") == 0) & (F.col("unknown_ids") == 0))
