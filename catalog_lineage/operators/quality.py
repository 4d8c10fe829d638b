"""Quality rules: each is an aggregate or an anti join, and ends as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions.ids import opt
from ..functions.text import blank_to_null, clean, first_nonblank, norm_key, token
from .resolve import orphans
from .sets import sided_counts
from .summarize import percent
from .window import cut, duplicate_ids, first_wins


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _one_row(frames) -> DataFrame:
    """One-row aggregates side by side."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), frames)


def as_gates(row: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """One row per gate from a row of counts; a gate is the number of its failures."""
    entries = F.array(*[F.struct(F.lit(n).alias("gate"), F.coalesce(f.cast("bigint"), F.lit(0)).alias("failures")) for n, f in gates.items()])
    return row.select(F.explode(entries).alias("g")).select("g.gate", "g.failures", (F.col("g.failures") == 0).alias("pass"))


# ---- K1 ----------------------------------------------------------------------------

def integrity(objects: DataFrame, edges: DataFrame) -> DataFrame:
    """Duplicate ids and names, missing parents and endpoints as validation rows."""
    def rows(df, kind, key, status):
        return df.select(F.lit(kind).alias("check_name"), F.col(key).cast("string").alias("subject"), F.lit(status).alias("validation_status"), F.lit("ERROR").alias("severity"))
    names = objects.withColumn("name_key", F.lower(clean("qualified_name")))
    parents = objects.where(clean("parent_object_id") != "").select("object_id", "parent_object_id") if "parent_object_id" in objects.columns else None
    found = [
        rows(duplicate_ids(objects, "object_id"), "duplicate_object_id", "object_id", "DUPLICATE_OBJECT"),
        rows(duplicate_ids(names, "name_key"), "duplicate_qualified_name", "name_key", "DUPLICATE_OBJECT"),
        rows(orphans(edges, objects, "source_object_id", "object_id"), "missing_source", "relationship_id", "BROKEN_REFERENCE"),
        rows(orphans(edges, objects, "target_object_id", "object_id"), "missing_target", "relationship_id", "BROKEN_REFERENCE"),
    ]
    if parents is not None:
        found.append(rows(orphans(parents, objects, "parent_object_id", "object_id"), "missing_parent", "object_id", "BROKEN_REFERENCE"))
    return _union(found)


# ---- K2 ----------------------------------------------------------------------------

def _upper(c) -> Column:
    return F.upper(clean(c))


def classify_exceptions(relationships: DataFrame, validations: DataFrame, exceptions: DataFrame, environment: str, database: str):
    """(errors with their exception, active exceptions that match nothing)."""
    active = exceptions.where(
        (_upper("environment") == environment.strip().upper()) & (_upper("database") == database.strip().upper())
        & (_upper("disposition") == "ACCEPTED_KNOWN_ISSUE")
    ).select(_upper("source_object").alias("_s"), _upper("relationship_type").alias("_r"), _upper("target_object").alias("_t"), "exception_id")
    active = active.groupBy("_s", "_r", "_t").agg(F.max("exception_id").alias("exception_id"))
    edges = relationships.where(clean("relationship_id") != "").select(
        "relationship_id", _upper("source_qualified_name").alias("_s"), _upper("relationship_type").alias("_r"), _upper("target_qualified_name").alias("_t")
    )
    errors = validations.where(_upper("validation_status").isin(*vocab.ERROR_STATUSES)).select("validation_id", "relationship_id", "validation_status")
    judged = errors.join(edges, "relationship_id", "left").join(active, ["_s", "_r", "_t"], "left").withColumn(
        "disposition", F.when(F.col("exception_id").isNotNull(), "ACCEPTED").otherwise("UNACCEPTED")
    )
    unmatched = active.join(judged.where(F.col("disposition") == "ACCEPTED").select("exception_id"), "exception_id", "left_anti")
    return judged.drop("_s", "_r", "_t"), unmatched.select("exception_id")


# ---- K3 ----------------------------------------------------------------------------

def quality_counts(objects, relationships, evidence, validations, warnings, judged, unmatched) -> DataFrame:
    """All counts behind the quality gates in one row."""
    ids = lambda df, key: df.where(clean(key) != "").groupBy(key).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    named = lambda df, key, name: df.where(clean(key) != "").groupBy(key).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name), F.count("*").alias(f"distinct_{key}s")
    )
    linked = relationships.where(clean("relationship_id") != "").select("relationship_id").distinct().join(
        validations.select("relationship_id").distinct(), "relationship_id", "left_semi"
    )
    lacking = lambda child, key, parent, pkey, name: child.join(parent.select(F.col(pkey).alias("_k")), clean(key) == F.col("_k"), "left_anti").agg(F.count("*").alias(name))
    # sources of evidence repeat, so evidence is read once and its sources are counted before they meet the objects
    cited = cut(evidence.groupBy("source_object_id").agg(F.count("*").alias("_n"), F.count_if(clean("target_expression") == "").alias("_blank")))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    known = objects.select(F.col("object_id").alias("_k"))
    return _one_row([
        objects.agg(F.count("*").alias("objects"), F.count_if(_upper("object_type") == "UNKNOWN").alias("unknown_objects"), F.count_if(clean("object_name") == "").alias("blank_object_names")),
        named(objects, "object_id", "duplicate_object_ids"),
        relationships.agg(
            F.count("*").alias("relationships"), F.count_if(clean("source_qualified_name") == "").alias("blank_relationship_sources"),
            F.count_if(clean("target_qualified_name") == "").alias("blank_relationship_targets"),
        ),
        named(relationships, "relationship_id", "duplicate_relationship_ids"),
        lacking(relationships, "source_object_id", objects, "object_id", "orphan_relationship_sources"),
        orphans(relationships, objects, "target_object_id", "object_id").agg(F.count("*").alias("invalid_target_links")),
        cited.agg(total("_n", "evidence"), total("_blank", "blank_evidence_targets")),
        cited.join(known, clean("source_object_id") == F.col("_k"), "left_anti").agg(total("_n", "orphan_evidence_sources")),
        validations.agg(
            F.count("*").alias("validations"), F.count_if(_upper("validation_status") == "VALID").alias("valid_validations"),
            F.count_if(_upper("validation_status").isin(*vocab.TRACKED_STATUSES)).alias("tracked_validations"),
            F.count_if(_upper("validation_status").isin(*vocab.ERROR_STATUSES)).alias("error_validations"),
        ),
        orphans(validations, relationships, "relationship_id", "relationship_id").agg(F.count("*").alias("orphan_validations")),
        count(linked, "validated_relationships"),
        count(warnings, "adapter_warnings"),
        judged.agg(F.count_if(F.col("disposition") == "ACCEPTED").alias("accepted_errors"), F.count_if(F.col("disposition") == "UNACCEPTED").alias("unaccepted_errors")),
        count(unmatched, "unmatched_exceptions"),
    ])


def quality_gates(counts: DataFrame, manifest_complete: Column | None = None, sources_complete: Column | None = None) -> DataFrame:
    """The 17 gates over the counts of ``quality_counts``."""
    c = F.col
    flag = lambda ok: F.when(ok if ok is not None else F.lit(True), 0).otherwise(1)
    return as_gates(counts, {
        "catalog_status_complete": flag(manifest_complete),
        "source_manifests_complete": flag(sources_complete),
        "adapter_warning_count_zero": c("adapter_warnings"),
        "object_ids_unique": c("duplicate_object_ids"),
        "relationship_ids_unique": c("duplicate_relationship_ids"),
        "unknown_object_count_zero": c("unknown_objects"),
        "blank_object_name_count_zero": c("blank_object_names"),
        "orphan_relationship_source_count_zero": c("orphan_relationship_sources"),
        "invalid_relationship_target_link_count_zero": c("invalid_target_links"),
        "blank_relationship_source_count_zero": c("blank_relationship_sources"),
        "blank_relationship_target_count_zero": c("blank_relationship_targets"),
        "orphan_evidence_source_count_zero": c("orphan_evidence_sources"),
        "blank_evidence_target_count_zero": c("blank_evidence_targets"),
        "orphan_validation_relationship_count_zero": c("orphan_validations"),
        "relationship_validation_coverage_100": c("distinct_relationship_ids") - c("validated_relationships"),
        "unaccepted_error_validation_count_zero": c("unaccepted_errors"),
        "accepted_exceptions_are_matched": c("unmatched_exceptions"),
    })


def quality_scores(counts: DataFrame, gates: DataFrame) -> DataFrame:
    """Control score, validation coverage, resolution rate and the verdict."""
    passed = gates.agg(F.count_if("pass").alias("passed_gates"), F.count("*").alias("gate_count"))
    return counts.crossJoin(F.broadcast(passed)).select(
        F.when(F.col("passed_gates") == F.col("gate_count"), "PASS").otherwise("FAIL").alias("quality_status"),
        percent(F.col("passed_gates"), F.col("gate_count")).alias("quality_control_score_percent"),
        percent(F.col("validated_relationships"), F.col("distinct_relationship_ids")).alias("relationship_validation_coverage_percent"),
        percent(F.col("valid_validations"), F.col("validations")).alias("validation_resolution_rate_percent"),
    )


# ---- K4, K5 ------------------------------------------------------------------------

def check_register(register: DataFrame, validations: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """Consistency of the exception register and of its applications, as gates."""
    n = F.coalesce(opt(register, "relationship_count", "int"), F.lit(0))
    applies = F.coalesce(opt(register, "applies_to_validation_records", "boolean"), F.lit(True))
    row_checks = register.agg(
        F.count("*").alias("entries"), F.coalesce(F.sum(n), F.lit(0)).alias("entry_relationships"),
        F.coalesce(F.sum(F.when(applies, n)), F.lit(0)).alias("published_relationships"),
        F.count_if(clean("exception_id") == "").alias("missing_id"),
        F.count_if((norm_key("target_type") == "") | (norm_key("target_name") == "")).alias("missing_target"),
        F.count_if(~token("exception_status").isin("REGISTERED", "ACTIVE")).alias("inactive"), F.count_if(n <= 0).alias("bad_count"),
        F.count_if(~F.coalesce(F.col("exclude_from_quality_score"), F.lit(False))).alias("scored"),
        F.count_if(F.coalesce(F.col("required_for_holistic_success"), F.lit(True))).alias("required"),
    )
    surplus = lambda df, keys, name: df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias(name))
    targets = register.select(norm_key("target_type").alias("t"), norm_key("target_name").alias("n")).where((F.col("t") != "") & (F.col("n") != ""))
    applied = validations.where(clean("exception_id") != "")
    own = first_wins(register.select(
        F.col("exception_id"), norm_key("target_type").alias("_t"), norm_key("target_name").alias("_n"),
    ).where(clean("exception_id") != ""), "exception_id", ["_t", "_n"])
    looked = applied.select(
        "exception_id", norm_key(first_nonblank(opt(applied, "target_type"), opt(applied, "target_object_type"))).alias("vt"), norm_key("target_name").alias("vn"),
        F.coalesce(opt(applied, "required_for_holistic_success", "boolean"), F.lit(False)).alias("req"),
    ).join(own, "exception_id", "left")
    application = looked.agg(
        F.count("*").alias("applied"), F.count_if(F.col("_t").isNull()).alias("unknown_id"),
        F.count_if(F.col("_t").isNotNull() & ((F.col("vt") != F.col("_t")) | (F.col("vn") != F.col("_n")))).alias("wrong_target"),
        F.count_if("req").alias("required_applied"),
    )
    row = _one_row([
        row_checks, surplus(register.where(clean("exception_id") != ""), ["exception_id"], "duplicate_id"), surplus(targets, ["t", "n"], "duplicate_target"), application,
    ])
    gates = {
        "exception_ids_present": F.col("missing_id"), "exception_ids_unique": F.col("duplicate_id"),
        "targets_present": F.col("missing_target"), "targets_unique": F.col("duplicate_target"),
        "statuses_active": F.col("inactive"), "relationship_counts_positive": F.col("bad_count"),
        "excluded_from_score": F.col("scored"), "not_required_for_success": F.col("required"),
        "applied_ids_known": F.col("unknown_id"), "applied_to_right_target": F.col("wrong_target"),
        "applied_not_required": F.col("required_applied"),
        "applied_count_matches_register": F.when(F.col("applied") > 0, F.abs(F.col("applied") - F.col("published_relationships"))).otherwise(F.lit(0)),
    }
    if declared is not None:
        row = row.crossJoin(F.broadcast(declared.select(F.col("exception_count").alias("d_count"), F.col("relationship_count").alias("d_rel")).limit(1)))
        gates["declared_exception_count"] = F.abs(F.col("d_count") - F.col("entries"))
        gates["declared_relationship_count"] = F.abs(F.col("d_rel") - F.col("entry_relationships"))
    return as_gates(row, gates)


UPSERT_DEFAULTS = {
    "source_validation_status": "UNRESOLVED_DYNAMIC_REFERENCE", "exception_status": "REGISTERED",
    "disposition": "PROVENANCE_CANDIDATE_NOT_IN_CATALOG", "application_scope": "PROVENANCE_CANDIDATE",
}


def upsert_register(register: DataFrame, updates: DataFrame, snapshot_id: str, day: str) -> tuple[DataFrame, DataFrame]:
    """(register, totals). An update meets its entry by id, else by target; the rest are inserted."""
    keyed = lambda df: df.withColumn("_target", F.concat_ws("\u001f", norm_key("target_type"), norm_key("target_name")))
    old, new = keyed(register), keyed(updates)
    by_id = new.join(old.select("exception_id"), "exception_id", "left_semi").withColumn("_old", F.col("exception_id"))
    owners = old.groupBy("_target").agg(F.max("exception_id").alias("_old"))
    others = new.join(old.select("exception_id"), "exception_id", "left_anti").join(owners, "_target", "left")
    fields = ["exception_id", "exception_type", "target_type", "target_name", "relationship_count"]
    shaped = by_id.select("_old", *fields).unionByName(others.select("_old", *fields))
    stamp = {
        **{k: F.lit(v) for k, v in UPSERT_DEFAULTS.items()},
        "applies_to_validation_records": F.lit(False), "exclude_from_quality_score": F.lit(True), "required_for_holistic_success": F.lit(False),
    }
    verified = {"last_verified_snapshot_id": F.lit(snapshot_id), "last_verified_on": F.lit(day)}
    kept = register.join(shaped.where(F.col("_old").isNotNull()).select(F.col("_old").alias("exception_id")), "exception_id", "left_anti")
    default_type = F.when(
        opt(register, "source_validation_status") == "BROKEN_REFERENCE", "CONFIRMED_LITERAL_NOT_IN_CATALOG"
    ).otherwise("RESOLVED_VARIABLE_NOT_IN_CATALOG")
    kept = kept.withColumns({
        "exception_type": F.coalesce(blank_to_null(opt(register, "exception_type")), default_type),
        "application_scope": F.lit("PUBLISHED_VALIDATION"), "applies_to_validation_records": F.lit(True), **verified,
    })
    result = kept.unionByName(shaped.drop("_old").withColumns({**stamp, **verified}), allowMissingColumns=True)
    n, live = F.coalesce(F.col("relationship_count"), F.lit(0)), F.col("applies_to_validation_records")
    some = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    totals = result.agg(
        F.count("*").alias("exception_count"), F.coalesce(F.sum(n), F.lit(0)).alias("relationship_count"),
        F.count_if(live).alias("published_validation_exception_count"), some(live).alias("published_validation_relationship_count"),
        F.count_if(~live).alias("provenance_candidate_exception_count"), some(~live).alias("provenance_candidate_relationship_count"),
    )
    return result, totals


# ---- K6, K7 ------------------------------------------------------------------------

def check_attributes(attributes: DataFrame, objects: DataFrame, declared_count: int | None = None) -> DataFrame:
    """Attribute rows: identity, names, types, flags and parents, as gates."""
    keys = [norm_key(c).alias(f"k{i}") for i, c in enumerate(("dimension_name", "hierarchy_name", "attribute_name"))]
    expected = F.concat_ws("::", *[F.coalesce(F.col(c), F.lit("")) for c in ("dimension_name", "hierarchy_name", "attribute_name")])
    control = F.startswith(clean("dimension_name"), F.lit("}")) | F.startswith(clean("hierarchy_name"), F.lit("}")) | F.startswith(clean("attribute_name"), F.lit("}"))
    data_type = token("attribute_data_type")
    alias = F.coalesce(F.col("is_alias"), F.lit(False))
    wrong = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != expected, 1).otherwise(0)
    rows = attributes.agg(
        F.count("*").alias("attributes"),
        F.count_if((norm_key("dimension_name") == "") | (norm_key("hierarchy_name") == "") | (norm_key("attribute_name") == "")).alias("missing_identity"),
        F.coalesce(F.sum(wrong("qualified_name") + wrong("object_name")), F.lit(0)).alias("bad_names"),
        F.count_if(token("object_type") != "ATTRIBUTE").alias("bad_object_type"),
        F.count_if(~data_type.isin("STRING", "NUMERIC", "ALIAS")).alias("bad_data_type"),
        F.count_if((data_type == "ALIAS") != alias).alias("bad_alias_flag"),
        F.count_if(~F.coalesce(F.col("is_control") == control, F.lit(False))).alias("bad_control_flag"),
    )
    repeats = attributes.select(*keys).groupBy("k0", "k1", "k2").agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    dims = objects.where(norm_key("object_type") == "dimension").select(norm_key("object_name").alias("_d"))
    unknown = attributes.select(norm_key("dimension_name").alias("_d")).where(F.col("_d") != "").distinct().join(dims, "_d", "left_anti").agg(F.count("*").alias("unknown_parents"))
    gates = {
        "identity_present": F.col("missing_identity"), "identity_unique": F.col("duplicates"), "names_match": F.col("bad_names"),
        "object_type": F.col("bad_object_type"), "data_type": F.col("bad_data_type"), "alias_flag": F.col("bad_alias_flag"),
        "control_flag": F.col("bad_control_flag"), "parent_known": F.col("unknown_parents"),
        "not_empty": F.when(F.col("attributes") == 0, 1).otherwise(0),
    }
    if declared_count is not None:
        gates["declared_count"] = F.abs(F.col("attributes") - F.lit(declared_count))
    return as_gates(_one_row([rows, repeats, unknown]), gates)


def check_manifests(expected: DataFrame, manifests: DataFrame, actual: DataFrame | None = None) -> DataFrame:
    """One row per expected manifest: present, COMPLETE, no errors, promoted, counts as declared, times in order."""
    times = lambda c: F.try_to_timestamp(F.col(c)) if dict(manifests.dtypes).get(c) == "string" else F.col(c)
    shaped = manifests.select(
        "name", F.lit(True).alias("present"), token("status").alias("status"), F.coalesce(opt(manifests, "error_count", "int"), F.lit(0)).alias("error_count"),
        F.coalesce(opt(manifests, "published_current", "boolean"), F.lit(True)).alias("published"),
        opt(manifests, "declared_count", "bigint").alias("declared_count"),
        F.coalesce(times("completed_at") >= times("started_at"), F.lit(True)).alias("in_order"),
    )
    joined = expected.select("name").join(shaped, "name", "left")
    if actual is not None:
        joined = joined.join(actual.select("name", "actual_count"), "name", "left")
    else:
        joined = joined.withColumn("actual_count", F.lit(None).cast("bigint"))
    present = F.coalesce("present", F.lit(False))
    counts_match = F.col("declared_count").isNull() | F.col("actual_count").isNull() | (F.col("declared_count") == F.col("actual_count"))
    good = F.coalesce((F.col("status") == "COMPLETE") & (F.col("error_count") == 0) & F.col("published") & F.col("in_order") & counts_match, F.lit(False))
    return joined.select("name", present.alias("present"), F.coalesce("status", F.lit("MISSING")).alias("status"),
                         F.coalesce(F.col("in_order"), F.lit(False)).alias("in_order"), F.coalesce(counts_match & present, F.lit(False)).alias("counts_match"), (present & good).alias("pass"))


# ---- K8-K10 ------------------------------------------------------------------------

def scan_secrets(df: DataFrame) -> DataFrame:
    """Rows that still hold a credential, per pattern, and rows flagged as bearing one without being redacted."""
    text = F.to_json(F.struct(*df.columns))
    present = F.coalesce(opt(df, "credential_present", "boolean"), F.lit(False)) & ~F.coalesce(opt(df, "credential_redacted", "boolean"), F.lit(False))
    counts = df.select(text.alias("_t"), present.alias("_p")).agg(
        *[F.count_if(F.rlike("_t", F.lit(p))).alias(n) for n, p in vocab.UNREDACTED_PATTERNS.items()], F.count_if("_p").alias("flagged_not_redacted")
    )
    return as_gates(counts, {n: F.col(n) for n in [*vocab.UNREDACTED_PATTERNS, "flagged_not_redacted"]}).withColumnsRenamed({"gate": "pattern", "failures": "row_count"})


def structural_gates(entities: DataFrame, edges: DataFrame, rules: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Parent-edge counts equal entity counts. ``rules(domain, relationship_type)`` lists what must match."""
    have = entities.groupBy("domain").agg(F.count("*").alias("entity_count"))
    links = edges.groupBy("domain", "relationship_type").agg(F.count("*").alias("edge_count"))
    joined = rules.join(have, "domain", "left").join(links, ["domain", "relationship_type"], "left").withColumns({
        "entity_count": F.coalesce("entity_count", F.lit(0)), "edge_count": F.coalesce("edge_count", F.lit(0)),
    })
    good = F.col("entity_count") == F.col("edge_count")
    if expected is not None:
        joined = joined.join(expected.select("domain", "expected_count"), "domain", "left")
        good = good & (F.col("expected_count").isNull() | (F.col("entity_count") == F.col("expected_count")))
    return joined.select("domain", "relationship_type", "entity_count", "edge_count", good.alias("pass"))


def acceptance(gates) -> DataFrame:
    """The decision over all gate rows."""
    rows = _union([g.select("gate", "pass") for g in gates]) if not isinstance(gates, DataFrame) else gates
    failed = F.count_if(~F.col("pass"))
    return rows.agg(
        F.count("*").alias("gate_count"), failed.alias("failure_count"), (failed == 0).alias("overall_pass"),
        F.when(failed == 0, "READY_FOR_SEMANTIC_RESOLUTION").otherwise("BLOCKED_PENDING_REVIEW").alias("decision"),
    )
