"""Match profile of deferred references, resolution plan, semantic validations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions.ids import opt
from ..functions.text import clean, first_nonblank, padded, token
from ..operators.filters import split_deferred
from ..operators.pairing import SOURCE_FIELDS, pair
from ..operators.resolve import match_candidates, with_context

CONTEXT = ["cube_name", "dimension_name", "hierarchy_name", "attribute_name", "subset_name", "view_name", "target_name"]


def match_profile(validations: DataFrame, relationships: DataFrame, candidates: DataFrame, origin: str, row_key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """(one profiled row per deferred validation, pairing errors) of one origin."""
    deferred, _ = split_deferred(validations)
    pairs, errors = pair(deferred, relationships, row_key)
    status = deferred.select(F.col(row_key).cast("string").alias("validation_key"), token("validation_status").alias("input_validation_status"), "domain",
                             clean(opt(deferred, "relationship_id")).alias("_explicit"))
    own = [c for c in relationships.columns if c not in ("relationship_id", "domain", row_key)]
    source = relationships.select(F.col(row_key).cast("string").alias("relationship_key"), *own, clean(opt(relationships, "relationship_id")).alias("_own_id"))
    joined = pairs.join(status, "validation_key").join(source, "relationship_key")
    base = (
        F.when(F.col("_explicit") != "", F.col("_explicit")).when(F.col("_own_id") != "", F.col("_own_id"))
        .otherwise(F.concat(F.lit(f"semantic::{origin.lower()}::"), F.replace("semantic_key", F.lit("\u001f"), F.lit("::"))))
    )
    occurrence = F.concat(base, F.lit("::occurrence::"), padded("position"))
    numbered = joined.withColumns({
        "relationship_id": F.when((F.col("group_size") > 1) & (F.col("_explicit") == ""), occurrence).otherwise(base),
        "relationship_type": token("relationship_type"),
    })
    matched = match_candidates(with_context(numbered), candidates)
    profile = matched.select(
        F.lit(origin).alias("origin"), "relationship_id", "join_method", F.col("position").alias("semantic_group_position"), F.col("group_size").alias("semantic_group_size"),
        "relationship_type", "input_validation_status", "domain", "match_classification", "match_reason", "candidate_count", "candidate_node_id",
        "candidate_level", "candidate_key", clean(first_nonblank(*[opt(joined, c) for c in SOURCE_FIELDS])).alias("profile_source"), *CONTEXT,
        F.col("match_classification").isin(*vocab.REVIEW_CLASSES).alias("in_review_queue"),
    )
    return profile, errors.withColumn("origin", F.lit(origin))


def profile_counts(profile: DataFrame) -> DataFrame:
    from ..operators.summarize import distributions
    return distributions(profile, [["input_validation_status"], ["domain"], ["match_classification"]])


def resolution_plan(profile: DataFrame, source_snapshot_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one decision per profiled reference, integrity errors)."""
    klass, domain = F.upper(clean("match_classification")), F.upper(clean("domain"))
    keyed = profile.withColumns({"profiler_classification": klass, "domain": domain, "_single": F.col("candidate_count") == 1})
    decided = keyed.join(F.broadcast(vocab.decision_table(profile.sparkSession)), "profiler_classification", "left")
    missing = F.col("profiler_classification") == "TARGET_NOT_IN_CATALOG"
    needs_one = F.col("profiler_classification").isin("EXACT_MATCH", "DEFAULT_HIERARCHY_MATCH", "UNIQUE_HIERARCHY_MATCH")
    unknown = F.col("decision_type").isNull()
    blank = (clean("origin") == "") | (clean("relationship_id") == "")
    error = (
        F.when(blank, "The row lacks its origin or relationship id.")
        .when(unknown, F.concat(F.lit("No decision is defined for "), F.col("profiler_classification")))
        .when(needs_one & ~F.col("_single"), F.concat(F.col("profiler_classification"), F.lit(" needs exactly one candidate.")))
    )
    plan = decided.withColumns({
        "plan_id": F.concat(F.lit("semantic-resolution-plan::"), F.sha2(F.concat(F.lower(clean("origin")), F.lit("::"), clean("relationship_id")), 256)),
        "origin": F.upper(clean("origin")),
        "original_validation_status": F.upper(clean("input_validation_status")),
        "proposed_validation_status": F.when(missing, F.coalesce(vocab.lookup(vocab.MISSING_STATUS_BY_DOMAIN, F.col("domain")), F.col("base_status"))).otherwise(F.col("base_status")),
        "resolved_target_node_id": F.when((F.col("decision_type") == "AUTOMATIC") & F.col("_single"), F.col("candidate_node_id")),
        "review_reason": F.when(missing, F.concat(
            F.lit("The catalog has no such "), F.coalesce(F.nullif(F.lower("domain"), F.lit("")), F.lit("target")), F.lit(".")
        )).otherwise(F.col("base_reason")),
        "source_snapshot_id": F.lit(source_snapshot_id).cast("string"),
        "_error": error,
    })
    rows = plan.where(F.col("_error").isNull()).select(
        "plan_id", "origin", "relationship_id", "relationship_type", "domain", "original_validation_status", "profiler_classification", "proposed_validation_status",
        "decision_type", "resolution_method", "resolved_target_node_id", "candidate_count", "candidate_node_id", "candidate_level", "candidate_key",
        "semantic_group_position", "semantic_group_size", "join_method", *CONTEXT, "review_reason", "source_snapshot_id",
        *(["profile_source"] if "profile_source" in profile.columns else []),
    )
    failed = plan.where(F.col("_error").isNotNull()).select("origin", "relationship_id", F.lit("BUILD_PLAN").alias("stage"), F.col("_error").alias("error"))
    repeated = rows.groupBy("origin", "relationship_id").agg(F.count("*").alias("_n")).where("_n > 1").select(
        "origin", "relationship_id", F.lit("PLAN_INTEGRITY").alias("stage"), F.lit("Resolution plan contains duplicate origin/relationship identities.").alias("error")
    )
    return rows, failed.unionByName(repeated)


def _stable_id(*parts) -> F.Column:
    return F.concat(F.lit("semantic-validation::"), F.sha2(F.lower(F.concat_ws("::", *[clean(p) for p in parts])), 256))


def semantic_validations(validations: DataFrame, plan: DataFrame, origin: str, position: str = "source_validation_index", expected: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(semantic validations of one origin, integrity errors): other rows preserved, deferred rows replaced by plan rows.

    ``expected`` may name totals to check: ``plan``, ``automatic``, ``review``, ``total``.
    """
    deferred, others = split_deferred(validations)
    status = token("validation_status")
    none = lambda t="string": F.lit(None).cast(t)
    source = clean(first_nonblank(*[opt(validations, c) for c in SOURCE_FIELDS]))
    kept = others.select(
        _stable_id(F.lit(origin), F.lit("parser"), F.col(position), opt(others, "relationship_id"), opt(others, "source_name"), opt(others, "process_name"),
                   opt(others, "cube_name"), opt(others, "relationship_type"), opt(others, "target_type"), opt(others, "target_name"), status).alias("semantic_validation_id"),
        F.lit(origin).alias("origin"), clean(opt(others, "relationship_id")).alias("relationship_id"), F.col("relationship_type"), F.col("target_type").alias("domain"),
        status.alias("original_validation_status"), status.alias("semantic_validation_status"), F.lit("PARSER_PRESERVED").alias("decision_type"),
        F.lit("ORIGINAL_PARSER_VALIDATION").alias("resolution_method"), none().alias("resolved_target_node_id"), F.lit(False).alias("review_required"),
        none().alias("review_reason"), none().alias("plan_id"), none().alias("profiler_classification"), F.lit(1).cast("bigint").alias("semantic_group_position"),
        F.col(position).cast("bigint").alias("source_validation_index"), opt(others, "target_name").alias("target_name"), opt(others, "target_expression").alias("target_expression"),
        source.alias("source_name"),
    )
    mine = plan.where(F.col("origin") == origin.upper())
    planned = mine.select(
        _stable_id(F.lit(origin), F.lit("plan"), F.col("plan_id")).alias("semantic_validation_id"), F.lit(origin).alias("origin"), "relationship_id",
        token("relationship_type").alias("relationship_type"), token("domain").alias("domain"), "original_validation_status",
        F.col("proposed_validation_status").alias("semantic_validation_status"), "decision_type", "resolution_method", "resolved_target_node_id",
        (F.col("decision_type") == "REVIEW").alias("review_required"), "review_reason", "plan_id", "profiler_classification",
        F.col("semantic_group_position").cast("bigint").alias("semantic_group_position"), none("bigint").alias("source_validation_index"), "target_name",
        none().alias("target_expression"), opt(mine, "profile_source").alias("source_name"),
    )
    result = kept.unionByName(planned)
    counts = deferred.agg(F.count("*").alias("deferred")).crossJoin(F.broadcast(mine.agg(
        F.count("*").alias("plan"), F.count_if(F.col("decision_type") == "AUTOMATIC").alias("automatic"), F.count_if(F.col("decision_type") == "REVIEW").alias("review"),
    ))).crossJoin(F.broadcast(result.groupBy("semantic_validation_id").agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count_if(F.col("_n") > 1).alias("repeated")
    )))
    checks = [
        (F.col("plan") != F.col("deferred"), F.format_string(f"{origin} plan count %d does not equal deferred source count %d.", F.col("plan"), F.col("deferred"))),
        (F.col("repeated") > 0, F.lit("Duplicate semantic validation IDs detected.")),
        *[(F.col(k) != v, F.format_string(f"Expected {v} for {k}; found %d.", F.col(k))) for k, v in (expected or {}).items()],
    ]
    found = F.array_compact(F.array(*[F.when(bad, text) for bad, text in checks]))
    errors = counts.select(F.lit("SEMANTIC_INTEGRITY").alias("stage"), F.explode(found).alias("error"))
    return result, errors
