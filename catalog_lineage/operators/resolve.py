"""Joins of references with the catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions.classify import is_control
from ..functions.ids import opt
from ..functions.text import (
    blank_to_null, clean, col, first_nonblank, is_dynamic, norm_key, split_parent_leaf, split_qualified, token,
)
from .filters import active_exceptions
from .summarize import ADJACENCY_CHUNK, chunked_lists
from .window import cut, dealt_parts, first_wins


def catalog_index(objects: DataFrame, order: str = "seq") -> DataFrame:
    """Catalog by (type key, name key), the first row of each key winning."""
    keyed = objects.withColumns({"type_key": norm_key("object_type"), "name_key": norm_key("object_name")}).where(
        (F.col("type_key") != "") & (F.col("name_key") != "")
    )
    control = F.coalesce(opt(objects, "is_control", "boolean"), is_control("object_name"))
    scope = F.coalesce(blank_to_null(opt(objects, "catalog_scope")), F.when(control, "CONTROL").otherwise("REGULAR"))
    shaped = keyed.select(
        "type_key", "name_key", order, F.col("object_name").alias("catalog_match_name"),
        scope.alias("catalog_match_scope"), control.alias("catalog_match_is_control"),
    )
    # a dense file is one split of millions of rows, so the rows are dealt before they are sorted by key
    return first_wins(shaped.repartition(dealt_parts(shaped), "type_key", "name_key"), ["type_key", "name_key"], [order, "catalog_match_name"]).drop(order)


def classify_targets(refs: DataFrame, objects: DataFrame, exceptions: DataFrame | None = None, order: str = "seq") -> DataFrame:
    """Validation status of every reference, with the catalog row it met and the registered exception of a miss."""
    keyed = refs.withColumns({
        "type_key": norm_key("target_type"), "name_key": norm_key("target_name"), "_rating": F.upper(clean("confidence")),
    })
    matched = keyed.join(catalog_index(objects, order), ["type_key", "name_key"], "left")
    dependable = (F.col("name_key") != "") & F.col("_rating").isin(*vocab.DEPENDABLE_CONFIDENCES)
    deferred = vocab.lookup(vocab.DEFERRED_STATUS_BY_TYPE, F.col("type_key"))
    hit = F.col("catalog_match_name").isNotNull()
    literal = F.col("_rating").isin("CONFIRMED", "HIGH")
    dynamic = F.coalesce(vocab.lookup(vocab.DYNAMIC_STATUS_BY_TYPE, F.col("type_key")), F.lit("UNRESOLVED_DYNAMIC_REFERENCE"))
    status = (
        F.when(~dependable, dynamic).when(deferred.isNotNull(), deferred).when(hit, "VALID")
        .when(literal, "BROKEN_REFERENCE").otherwise("RESOLVED_TARGET_NOT_IN_CATALOG")
    )
    reason = (
        F.when(~dependable, F.coalesce(vocab.lookup(vocab.STATUS_REASONS, dynamic), F.lit("No dependable name came out of the expression.")))
        .when(deferred.isNotNull(), "The name is known, but things of this type are catalogued later.")
        .when(hit, "The catalog has this object.")
        .when(literal, "The code names it outright, and the catalog does not have it.")
        .otherwise("The variable leads to a name that the catalog does not have.")
    )
    result = matched.withColumns({"validation_status": status, "reason": reason})
    shown = F.col("validation_status") == "VALID"
    result = result.withColumns({
        c: F.when(shown, F.col(c)) for c in ("catalog_match_name", "catalog_match_scope", "catalog_match_is_control")
    })
    result = attach_exceptions(result, exceptions) if exceptions is not None else result
    return result.drop("type_key", "name_key", "_rating")


def classified_counts(refs: DataFrame, objects: DataFrame, exceptions: DataFrame | None = None, order: str = "seq") -> DataFrame:
    """classify_targets for each type, name and rating that references have, with the number of references as ``row_count``. Names
    repeat, so references are counted before they meet the catalog, and no name brings all its references to one task."""
    alike = cut(refs.groupBy("target_type", "target_name", "confidence").agg(F.count("*").alias("row_count")))
    keys = lambda kind, name: [norm_key(kind).alias("_asked_type"), norm_key(name).alias("_asked_name")]
    asked = alike.select(*keys("target_type", "target_name")).distinct()
    # only objects that somebody asks for are sorted by key, and no task holds a lookup table of the whole catalog
    wanted = objects.select("*", *keys("object_type", "object_name")).join(asked, ["_asked_type", "_asked_name"], "left_semi").drop("_asked_type", "_asked_name")
    return classify_targets(alike, wanted, exceptions, order)


def attach_exceptions(validated: DataFrame, exceptions: DataFrame) -> DataFrame:
    """The active exception of each missing target; other rows keep the defaults."""
    fields = {"exception_id": "string", "exception_status": "string", "exception_type": "string"}
    staged = active_exceptions(exceptions).select(
        norm_key("target_type").alias("type_key"), norm_key("target_name").alias("name_key"), F.col("exception_id").alias("_order"),
        *[opt(exceptions, f, t).alias(f"_{f}") for f, t in fields.items()],
        F.coalesce(opt(exceptions, "exclude_from_quality_score", "boolean"), F.lit(False)).alias("_exclude"),
        F.coalesce(opt(exceptions, "required_for_holistic_success", "boolean"), F.lit(True)).alias("_required"),
    )
    index = first_wins(staged, ["type_key", "name_key"], "_order").drop("_order")
    joined = validated.join(index, ["type_key", "name_key"], "left")
    applies = F.col("validation_status").isin(*vocab.ISSUE_STATUSES) & F.col("_exclude").isNotNull()
    return joined.withColumns({
        **{f: F.when(applies, F.coalesce(f"_{f}", F.lit(""))).otherwise(F.lit("")) for f in fields},
        "exclude_from_quality_score": F.when(applies, F.col("_exclude")).otherwise(F.lit(False)),
        "required_for_holistic_success": F.when(applies, F.col("_required")).otherwise(F.lit(True)),
    }).drop(*[f"_{f}" for f in fields], "_exclude", "_required")


# ---- context of a reference -----------------------------------------------------------

def with_context(df: DataFrame) -> DataFrame:
    """Cube, dimension, hierarchy, attribute, subset and view names: explicit columns first, else parts of the target name."""
    given = df
    # what several names are made of is worked out once, in columns of its own
    field = lambda *names: clean(first_nonblank(*[opt(given, n) for n in names]))
    df = df.withColumns({"_target": field("target_name", "resolved_target_name", "target_expression", "object_name"),
                         "_domain_of": F.coalesce(vocab.lookup(vocab.CONTEXT_BY_TYPE, token("relationship_type")), opt(df, "domain"))})
    target, domain = F.col("_target"), F.col("_domain_of")
    parent, leaf = split_parent_leaf(target)
    df = df.withColumns({"_parts_of": split_qualified(target), "_parent": parent, "_leaf": leaf})
    parts, parent, leaf = F.col("_parts_of"), F.col("_parent"), F.col("_leaf")
    size = F.size(parts)
    either = lambda given, other: F.when(given != "", given).otherwise(F.coalesce(other, F.lit("")))
    at = lambda i: F.try_element_at(parts, F.lit(i))
    cube = field("cube_name", "target_cube", "source_cube")
    dimension = field("dimension_name", "target_dimension", "dimension")
    hierarchy = field("hierarchy_name", "target_hierarchy", "hierarchy")
    attribute, subset, view = field("attribute_name", "attribute"), field("subset_name", "subset"), field("view_name", "view")
    owned = domain.isin("ATTRIBUTE", "SUBSET")
    deep = F.when(size >= 3, at(-3)).otherwise(parent)
    flat = F.when(size >= 2, at(-2)).otherwise(parent)
    return df.withColumns({
        "cube_name": F.when(domain == "VIEW", either(cube, flat)).otherwise(cube),
        "dimension_name": F.when(owned, either(dimension, deep)).when(domain == "HIERARCHY", either(dimension, flat)).otherwise(dimension),
        "hierarchy_name": F.when(owned, either(hierarchy, F.when(size >= 2, at(-2)))).when(domain == "HIERARCHY", either(hierarchy, leaf)).otherwise(hierarchy),
        "attribute_name": F.when(domain == "ATTRIBUTE", either(attribute, leaf)).otherwise(attribute),
        "subset_name": F.when(domain == "SUBSET", either(subset, leaf)).otherwise(subset),
        "view_name": F.when(domain == "VIEW", either(view, leaf)).otherwise(view),
        "target_name": target,
    }).drop("_target", "_domain_of", "_parts_of", "_parent", "_leaf")


# ---- J5 candidates ----------------------------------------------------------------------

def candidate_catalog(hierarchies: DataFrame, views: DataFrame, subsets: DataFrame, attributes: DataFrame) -> DataFrame:
    """All referable nodes in one shape: domain, node id, parent, hierarchy, name and default flag."""
    part = lambda df, domain, parent, hierarchy, name: df.select(
        F.lit(domain).alias("domain"),
        F.coalesce(blank_to_null(opt(df, "node_id")), F.concat_ws("::", F.lit(domain.lower()), *[F.col(c) for c in (parent, hierarchy, name) if c])).alias("node_id"),
        norm_key(parent).alias("parent_key"),
        (norm_key(hierarchy) if hierarchy else F.lit("")).alias("hierarchy_key"),
        norm_key(name).alias("own_key"),
        F.coalesce((norm_key(hierarchy) == norm_key(parent)) | F.coalesce(opt(df, "is_default_hierarchy", "boolean"), F.lit(False)), F.lit(False)).alias("is_default") if hierarchy else F.lit(False).alias("is_default"),
    )
    return (
        part(hierarchies, "HIERARCHY", "dimension_name", None, "hierarchy_name")
        .unionByName(part(views, "VIEW", "cube_name", None, "view_name"))
        .unionByName(part(subsets, "SUBSET", "dimension_name", "hierarchy_name", "subset_name"))
        .unionByName(part(attributes, "ATTRIBUTE", "dimension_name", "hierarchy_name", "attribute_name"))
    )


def _levels(candidates: DataFrame) -> DataFrame:
    """Every node under each key it can be found by: full key, parent and name, name only."""
    key = lambda level, *cols: F.struct(F.lit(level).alias("level"), F.concat_ws("\u001f", *cols).alias("key"))
    deep = F.col("domain").isin("SUBSET", "ATTRIBUTE")
    keys = F.array_compact(F.array(
        F.when(deep, key("FULL", "parent_key", "hierarchy_key", "own_key")),
        key("PARENT", "parent_key", "own_key"),
        key("NAME", "own_key"),
    ))
    return candidates.select("domain", "node_id", "is_default", F.explode(keys).alias("k")).select("domain", "k.level", "k.key", "node_id", "is_default")


def candidate_groups(candidates: DataFrame) -> DataFrame:
    """Node ids behind each key, in chunks: the candidates of every reference that carries the key."""
    from .summarize import chunked_lists
    return chunked_lists(_levels(candidates), ["domain", "level", "key"], "node_id", "candidate_node_ids")


def match_candidates(refs: DataFrame, candidates: DataFrame, ambiguous_exact: bool = False) -> DataFrame:
    """Match class, reason, candidate count and the single candidate of each reference, and the name of its list of candidates.

    References with the same key have the same candidates: ``domain``, ``candidate_level`` and ``candidate_key`` name the list, and
    ``candidate_lists`` holds it once. Level DEFAULT stands for the entries of the default hierarchy among those of level PARENT.
    """
    names = ("cube_name", "dimension_name", "hierarchy_name", "attribute_name", "subset_name", "view_name")
    domain = F.col("domain")
    deep = domain.isin("SUBSET", "ATTRIBUTE")
    named = (
        F.when(domain == "HIERARCHY", F.col("hierarchy_name")).when(domain == "VIEW", F.col("view_name"))
        .when(domain == "SUBSET", F.col("subset_name")).when(domain == "ATTRIBUTE", F.col("attribute_name"))
    )
    # Everything read more than once is a column of its own, and each test stands once, over the names as a list: written out for
    # every name, the generated code outgrows what the JVM compiles.
    staged = refs.withColumns({
        "_dynamic": F.exists(F.array(*[clean(c) for c in (*names, "target_name")]), is_dynamic), "_deep": deep, "_own": norm_key(named),
        "_parent": norm_key(F.when(domain == "VIEW", F.col("cube_name")).otherwise(F.col("dimension_name"))),
        "_hierarchy": F.when(deep, norm_key("hierarchy_name")).otherwise(F.lit("")),
        "_creates": token("relationship_type").isin(*vocab.CREATE_TYPES), "_deletes": token("relationship_type").isin(*vocab.DELETE_TYPES),
    })
    dynamic, deep, parent, own, hierarchy = (F.col(c) for c in ("_dynamic", "_deep", "_parent", "_own", "_hierarchy"))
    level = (
        F.when(dynamic | (own == ""), F.lit(None))
        .when(deep & (parent != "") & (hierarchy != ""), "FULL")
        .when(parent != "", "PARENT")
        .otherwise("NAME")
    )
    staged = staged.withColumn("candidate_level", level)
    level = F.col("candidate_level")
    key = (
        F.when(level == "FULL", F.concat_ws("\u001f", parent, hierarchy, own))
        .when(level == "PARENT", F.concat_ws("\u001f", parent, own))
        .when(level == "NAME", own)
    )
    stats = _levels(candidates).groupBy(
        "domain", F.col("level").alias("candidate_level"), F.col("key").alias("candidate_key")
    ).agg(
        F.count("*").alias("_all"), F.min("node_id").alias("_one"),
        F.count_if("is_default").alias("_defaults"), F.min(F.when(F.col("is_default"), F.col("node_id"))).alias("_default"),
    )
    staged = staged.withColumn("candidate_key", key).select(*refs.columns, "candidate_level", "candidate_key", "_dynamic", "_deep", "_creates", "_deletes")
    joined = staged.join(stats, ["domain", "candidate_level", "candidate_key"], "left")
    n = F.coalesce("_all", F.lit(0))
    full = (F.col("candidate_level") == "FULL") | (~F.col("_deep") & (F.col("candidate_level") == "PARENT"))
    by_default = F.col("_deep") & (F.col("candidate_level") == "PARENT") & (F.coalesce("_defaults", F.lit(0)) == 1)
    miss = F.lit("TARGET_NOT_IN_CATALOG")
    base = (
        F.when(F.col("_dynamic"), "DYNAMIC_REFERENCE")
        .when(F.col("candidate_level").isNull(), "INSUFFICIENT_CONTEXT")
        .when(full, F.when(n == 1, "EXACT_MATCH").when((n > 1) & F.lit(ambiguous_exact), "AMBIGUOUS_MATCH").otherwise(miss))
        .when(F.col("candidate_level") == "PARENT", F.when(by_default, "DEFAULT_HIERARCHY_MATCH").when(n == 1, "UNIQUE_HIERARCHY_MATCH").when(n > 1, "AMBIGUOUS_MATCH").otherwise(miss))
        .otherwise(F.when(n == 1, "UNIQUE_GLOBAL_MATCH").when(n > 1, "AMBIGUOUS_MATCH").otherwise(miss))
    )
    supplied = (
        F.when(F.col("_dynamic"), "The expression depends on the run")
        .when(F.col("candidate_level").isNull(), "A name that the lookup needs is missing")
        .when(F.col("candidate_level") == "FULL", "Looked up by dimension, hierarchy and name")
        .when(F.col("_deep") & (F.col("candidate_level") == "PARENT"), "Looked up by dimension and name, hierarchy unknown")
        .when(F.col("_deep"), "Looked up by name alone")
        .when((domain == "HIERARCHY") & (F.col("candidate_level") == "PARENT"), "Looked up by dimension and hierarchy")
        .when(domain == "HIERARCHY", "Looked up by hierarchy, dimension unknown")
        .when(F.col("candidate_level") == "PARENT", "Looked up by cube and view")
        .otherwise("Looked up by view, cube unknown")
    )
    joined = joined.withColumn("_base", base)
    base, creates, deletes = F.col("_base"), F.col("_creates"), F.col("_deletes")
    found = base.isin("EXACT_MATCH", "DEFAULT_HIERARCHY_MATCH", "UNIQUE_HIERARCHY_MATCH", "UNIQUE_GLOBAL_MATCH")
    shown = F.when(F.col("_dynamic") | F.col("candidate_level").isNull(), F.lit(0)).when(by_default, F.lit(1)).otherwise(n)
    return joined.withColumns({
        "match_classification": F.when((base == miss) & creates, "VALID_CREATE_TARGET").when((base == miss) & deletes, "MISSING_DELETE_TARGET")
        .when(found & creates, "EXISTING_CREATE_TARGET").otherwise(base),
        "match_reason": F.concat(supplied, F.when((base == miss) & creates, "; a create needs no such entry")
                                 .when((base == miss) & deletes, "; nothing there to delete")
                                 .when(found & creates, "; already there before the create").otherwise("")),
        "candidate_count": shown.cast("bigint"),
        "candidate_node_id": F.when(shown == 1, F.when(by_default, F.col("_default")).otherwise(F.col("_one"))),
        "candidate_level": F.when(by_default, "DEFAULT").otherwise(F.col("candidate_level")),
    }).drop("_dynamic", "_deep", "_creates", "_deletes", "_base", "_all", "_one", "_defaults", "_default")


def candidate_lists(matched: DataFrame, candidates: DataFrame, chunk_rows: int = ADJACENCY_CHUNK) -> DataFrame:
    """The candidates of the references that ``match_candidates`` gave: every list that a reference names, once, in order and with
    repeats, so its length is the reference's candidate_count. Lists longer than a chunk come in numbered chunks."""
    keys = ["domain", "candidate_level", "candidate_key"]
    found = _levels(candidates).withColumnsRenamed({"level": "candidate_level", "key": "candidate_key"})
    default = found.where((F.col("candidate_level") == "PARENT") & F.col("is_default")).withColumn("candidate_level", F.lit("DEFAULT"))
    asked = matched.where("candidate_count > 0").select(*keys).distinct()
    listed = found.unionByName(default).join(asked, keys, "left_semi")
    return chunked_lists(listed, keys, "node_id", "candidate_node_ids", chunk_rows, repeats=True)


# ---- J7-J10, J13-J17 ------------------------------------------------------------------------

def merge_overlap(new: DataFrame, existing: DataFrame, signature=("source_id", "relationship_type", "target_id")) -> tuple[DataFrame, DataFrame]:
    """(rows to project, provenance to append to edges that exist already)."""
    signature = list(signature)
    known = existing.groupBy(*signature).agg(F.max("graph_relationship_id").alias("existing_graph_id"))
    fresh = new.join(known, signature, "left_anti")
    overlap = new.join(known, signature).select("existing_graph_id", "relationship_id", *signature)
    return fresh, overlap


def complete_endpoints(nodes: DataFrame, edges: DataFrame, origin: str = "RELATIONSHIP_ENDPOINT") -> DataFrame:
    """The nodes plus a stub for every edge endpoint that has none."""
    end = lambda side: edges.select(F.col(f"{side}_id").alias("node_id"), token(f"{side}_type").alias("node_type"))
    ends = end("source").unionByName(end("target")).where(clean("node_id") != "").groupBy("node_id").agg(F.min("node_type").alias("node_type"))
    stubs = ends.join(nodes.select("node_id"), "node_id", "left_anti").select(
        "node_id", F.coalesce(F.nullif("node_type", F.lit("")), F.lit("UNKNOWN")).alias("node_type"), F.lit(origin).alias("node_origin")
    )
    return nodes.unionByName(stubs, allowMissingColumns=True)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose non-blank key points at nothing."""
    # parents are dealt by key and merged: as a table for lookups, or in parts joined by their shuffled bytes, they need memory that grows
    keys = parent.select(F.col(parent_key).alias("_k")).repartition(dealt_parts(parent), "_k")
    return child.where(clean(child_key) != "").join(keys.hint("merge"), F.col(child_key) == F.col("_k"), "left_anti")


def join_position(df: DataFrame, other: DataFrame, position: str, other_position: str, embedded: str, columns) -> DataFrame:
    """Fields of the row at a 1-based position of the other table, else of the record embedded in the row."""
    side = other.select(F.col(other_position).alias("_p"), F.struct(*columns).alias("_at"))
    joined = df.join(side, F.col(position) == F.col("_p"), "left")
    return joined.withColumns({f"source_{c}": F.coalesce(F.col(f"_at.{c}"), F.col(f"{embedded}.{c}")) for c in columns}).drop("_p", "_at")


def resolve_references(refs: DataFrame, objects: DataFrame) -> DataFrame:
    """Canonical object of each view, subset or file reference: exact, ambiguous, absent or short of context.

    ``refs(reference_kind, cube_name, view_name, dimension_name, hierarchy_name, subset_name, path)``;
    ``objects(object_id, object_type, properties)``. Candidates are counted per key before the join.
    """
    def keys(kind: Column, f, path: Column) -> Column:
        deep = F.array(norm_key(f("dimension_name")), norm_key(F.coalesce(blank_to_null(f("hierarchy_name")), f("dimension_name"))), norm_key(f("subset_name")))
        return (
            F.when(kind == "VIEW", F.array(norm_key(f("cube_name")), norm_key(f("view_name"))))
            .when(kind == "SUBSET", deep)
            .when(kind == "FILE", F.array(norm_key(F.replace(clean(path), F.lit("/"), F.lit("\\")))))
        )
    prop = lambda name: F.try_element_at(F.col("properties"), F.lit(name))
    catalog = objects.select(
        token("object_type").alias("_kind"), "object_id",
        keys(token("object_type"), prop, first_nonblank(prop("display_value"), prop("path"))).alias("_parts"),
    ).where(F.col("_parts").isNotNull() & ~F.exists("_parts", lambda p: p == "") & (clean("object_id") != ""))
    index = catalog.groupBy("_kind", F.array_join("_parts", "\u001f").alias("_key")).agg(
        F.count("*").alias("_rows"), F.count_distinct("object_id").alias("candidate_count"), F.min("object_id").alias("_id")
    )
    wanted = refs.withColumn("_kind", token("reference_kind"))
    parts = keys(F.col("_kind"), lambda n: opt(refs, n), opt(refs, "path"))
    wanted = wanted.withColumn("_parts", parts).withColumn("_key", F.array_join("_parts", "\u001f"))
    short = F.exists("_parts", lambda p: p == "")
    joined = wanted.join(index, ["_kind", "_key"], "left")
    status = (
        F.when(short, "INSUFFICIENT_CONTEXT").when(F.col("_rows") == 1, "CANONICAL_EXACT_MATCH")
        .when(F.col("_rows") > 1, "AMBIGUOUS_REFERENCE")
        .when(F.col("_kind") == "FILE", "EXTERNAL_UNVERIFIED").otherwise("TARGET_NOT_IN_PUBLIC_CATALOG")
    )
    found = F.when(short, F.lit(0)).otherwise(F.coalesce("candidate_count", F.lit(0)))
    return joined.withColumns({
        "resolution_status": status,
        "candidate_count": found,
        "resolved_target_object_id": F.when(found == 1, F.col("_id")),
        "review_required": found != 1,
    }).drop("_kind", "_parts", "_key", "_rows", "_id")


def with_evidence_count(df: DataFrame, evidence: DataFrame, keys=("process_name", "relationship_type", "target_expression")) -> DataFrame:
    """Number of matching evidence rows, 1 when there is none."""
    names = [f"_e{i}" for i in range(len(keys))]
    shaped = lambda c: token(c) if c == "relationship_type" else norm_key(c)
    counted = evidence.groupBy(*[shaped(c).alias(n) for c, n in zip(keys, names)]).agg(F.count("*").alias("_n"))
    keyed = df.withColumns({n: shaped(c) for c, n in zip(keys, names)})
    return keyed.join(counted, names, "left").withColumn("evidence_count", F.coalesce("_n", F.lit(1))).drop(*names, "_n")


def edge_view(edges: DataFrame, semantics: DataFrame, validations: DataFrame, provenance: DataFrame) -> DataFrame:
    """Display row of each edge: label, category, roles, line style, validation and provenance flags."""
    kind = F.coalesce(F.nullif(F.upper(clean("relationship_type")), F.lit("")), F.lit("UNKNOWN"))
    state = F.coalesce(F.nullif(F.upper(clean("endpoint_state")), F.lit("")), F.lit("CANONICAL"))
    base = edges.withColumns({"type": kind, "endpoint_state": state})
    rules = semantics.withColumnRenamed("relationship_type", "type")
    val = validations.groupBy("graph_relationship_id").agg(
        F.max("validation_status").alias("validation_status"), F.bool_or(F.coalesce(opt(validations, "review_required", "boolean"), F.lit(False))).alias("_vr")
    )
    prov = provenance.select("graph_relationship_id").distinct().withColumn("_has", F.lit(True))
    joined = base.drop("validation_status").join(rules, "type", "left").join(val, "graph_relationship_id", "left").join(prov, "graph_relationship_id", "left")
    open_end = F.col("endpoint_state").isin("DYNAMIC", "PLANNED")
    return joined.select(
        F.col("graph_relationship_id").alias("id"), F.col("source_id").alias("source"), F.col("target_id").alias("target"), "type",
        F.coalesce("label", F.initcap(F.replace("type", F.lit("_"), F.lit(" ")))).alias("label"),
        F.coalesce("category", F.lit("OTHER")).alias("category"),
        F.coalesce("source_role", F.lit("Source")).alias("source_role"), F.coalesce("target_role", F.lit("Target")).alias("target_role"),
        F.coalesce(opt(semantics, "impact_behavior"), F.lit("EDGE_DIRECTION")).alias("impact_behavior"), "endpoint_state",
        F.coalesce("validation_status", F.lit("UNKNOWN")).alias("validation_status"),
        (F.coalesce(opt(edges, "review_required", "boolean"), F.lit(False)) | F.coalesce("_vr", F.lit(False)) | open_end).alias("review_required"),
        F.coalesce("_has", F.lit(False)).alias("provenance_available"),
        F.when(F.col("endpoint_state") == "DYNAMIC", "dashed").when(F.col("endpoint_state") == "PLANNED", "dotted").otherwise("solid").alias("line_style"),
        F.when(open_end, "review").otherwise("validated").alias("visual_state"),
        F.coalesce("visual_group", "category", F.lit("OTHER")).alias("visual_group"),
    )


def _provenance_key(source: str) -> Column:
    return F.array_join(F.array(*[norm_key(c) for c in (source, "relationship_type", "target_type", "target_name")]), "\u001f")


def provenance_enrich(df: DataFrame, provenance: DataFrame, source: str = "process_name") -> DataFrame:
    """Source kinds and count of parameter resolution, for the rows it touched, with the key by which ``provenance_callers`` lists the
    calling processes. Source kinds are a fixed vocabulary; callers are not, so they stay in rows of their own."""
    gathered = provenance.groupBy(_provenance_key("process_name").alias("provenance_key")).agg(
        F.array_sort(F.collect_set(blank_to_null("source_kind"))).alias("resolution_source"), F.count("*").alias("provenance_count"),
    )
    keyed = df.withColumn("_key", _provenance_key(source))
    return keyed.join(gathered, F.col("_key") == F.col("provenance_key"), "left").withColumn(
        "parameter_resolution_applied", F.col("provenance_count").isNotNull()
    ).drop("_key")


def provenance_callers(provenance: DataFrame, chunk_rows: int = ADJACENCY_CHUNK) -> DataFrame:
    """Distinct calling processes of each provenance_key, in numbered chunks; keys without a caller have none."""
    callers = provenance.select(_provenance_key("process_name").alias("provenance_key"), blank_to_null("calling_process").alias("calling_process"))
    return chunked_lists(callers.where("calling_process is not null"), "provenance_key", "calling_process", "calling_processes", chunk_rows)


def node_label(df: DataFrame) -> Column:
    named = first_nonblank(*[opt(df, c) for c in ("display_value", "object_name", "attribute_name", "view_name", "subset_name")])
    return F.coalesce(named, F.substring_index("node_id", "::", -1))


def visual_group(kind: Column) -> Column:
    return (
        F.when(kind.isin(*vocab.MODEL_NODE_TYPES), "MODEL_OBJECT").when(kind.isin(*vocab.EXECUTION_NODE_TYPES), "EXECUTION")
        .when(kind.isin(*vocab.EXTERNAL_NODE_TYPES), "OPERATIONAL").when(kind.isin(*vocab.SYNTHETIC_NODE_TYPES), "UNRESOLVED").otherwise("OTHER")
    )


def node_view(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Display row of each node: label, state, degrees, group and shape."""
    degree = lambda end, name: edges.groupBy(F.col(end).alias("node_id")).agg(F.count("*").alias(name))
    kind = F.coalesce(F.nullif(F.upper(clean(first_nonblank(opt(nodes, "node_type"), opt(nodes, "object_type")))), F.lit("")), F.lit("UNKNOWN"))
    state = F.coalesce(F.nullif(F.upper(clean(opt(nodes, "endpoint_state"))), F.lit("")), F.lit("CANONICAL"))
    shaped = nodes.select(
        "node_id", kind.alias("type"), node_label(nodes).alias("label"), state.alias("status"),
        F.coalesce(opt(nodes, "is_control", "boolean"), F.lit(False)).alias("control_object"),
    )
    joined = shaped.join(degree("source_id", "outbound_count"), "node_id", "left").join(degree("target_id", "inbound_count"), "node_id", "left")
    return joined.withColumns({
        "subtitle": F.initcap(F.replace("type", F.lit("_"), F.lit(" "))),
        "inbound_count": F.coalesce("inbound_count", F.lit(0)), "outbound_count": F.coalesce("outbound_count", F.lit(0)),
        "review_required": F.col("status").isin("DYNAMIC", "PLANNED"),
        "visual_group": visual_group(F.col("type")),
        "visual_shape": F.coalesce(vocab.lookup(vocab.NODE_SHAPES, F.col("type")), F.lit("box")),
    })
