"""Identity of objects, references and relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import blank_to_null, clean, col, first_nonblank, norm_key, token

UNIT_SEPARATOR = "\u001f"


def opt(df: DataFrame, name: str, type_name: str = "string") -> Column:
    """The column if the table has it, else a null of that type."""
    return F.col(name) if name in df.columns else F.lit(None).cast(type_name)


def stable_hash(length: int | None = None, **fields: Column) -> Column:
    """SHA-256 of compact JSON with sorted keys; nulls count as nulls."""
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    digest = F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)
    return digest if length is None else F.left(digest, F.lit(length))


def hash_parts(*parts: Column | str, sep: str = UNIT_SEPARATOR) -> Column:
    return F.sha2(F.lower(F.concat_ws(sep, *[clean(p) for p in parts])), 256)


def qualified_name(object_type: Column, name: Column, parent: Column | None = None) -> Column:
    """parent::type::name, null when the name is blank."""
    own = F.concat_ws("::", clean(object_type), blank_to_null(name))
    full = own if parent is None else F.concat_ws("::", blank_to_null(parent), own)
    return F.when(clean(name) != "", full)


def object_id(environment: Column, database: Column, qualified: Column) -> Column:
    return stable_hash(
        24,
        environment=F.lower(clean(environment)),
        database_name=F.lower(clean(database)),
        qualified_name=F.lower(clean(qualified)),
    )


def _owner(df: DataFrame) -> Column:
    return F.coalesce(blank_to_null(opt(df, "owner")), F.lit("<none>"))


def canonical_key(df: DataFrame) -> Column:
    """Identity components of an object, chosen by its type."""
    kind = token(first_nonblank(opt(df, "node_type"), opt(df, "object_type")))
    name = first_nonblank(opt(df, "object_name"), opt(df, "display_value"))
    part = lambda field: norm_key(opt(df, field))
    visibility = token(F.coalesce(blank_to_null(opt(df, "visibility")), F.lit("PUBLIC")))
    empty = F.array().cast("array<string>")
    node = clean(opt(df, "node_id"))
    return (
        F.when(
            kind.isin("CUBE", "DIMENSION", "PROCESS", "CHORE"),
            F.when(clean(name) != "", F.array(kind, norm_key(name))).otherwise(empty),
        )
        .when(kind == "HIERARCHY", F.array(kind, part("dimension_name"), part("hierarchy_name")))
        .when(kind == "ATTRIBUTE", F.array(kind, part("dimension_name"), part("hierarchy_name"), part("attribute_name")))
        .when(
            kind == "SUBSET",
            F.array(kind, part("dimension_name"), part("hierarchy_name"), visibility, norm_key(_owner(df)), part("subset_name")),
        )
        .when(kind == "VIEW", F.array(kind, part("cube_name"), visibility, norm_key(_owner(df)), part("view_name")))
        .when(node != "", F.array(F.coalesce(F.nullif(kind, F.lit("")), F.lit("UNKNOWN")), norm_key(node)))
        .otherwise(empty)
    )


def canonical_id(df: DataFrame) -> Column:
    """Supplied node id, else type and display name, else the attribute triple."""
    key = canonical_key(df)
    kind = F.lower(F.get(key, F.lit(0)))
    name = clean(first_nonblank(opt(df, "object_name"), opt(df, "display_value")))
    attribute = F.concat_ws(
        "::", kind, clean(opt(df, "dimension_name")), clean(opt(df, "hierarchy_name")), clean(opt(df, "attribute_name"))
    )
    return (
        F.when(clean(opt(df, "node_id")) != "", clean(opt(df, "node_id")))
        .when(F.size(key) == 0, F.lit(""))
        .when(kind == "attribute", attribute)
        .otherwise(F.concat_ws("::", kind, name))
    )


def node_id(kind: str, *parts: Column | str) -> Column:
    return F.concat_ws("::", F.lit(kind), *[clean(p) for p in parts])


def view_node_id(cube: Column | str, view: Column | str) -> Column:
    return F.concat_ws("::", F.lit("view"), clean(cube), F.lit("PUBLIC::<none>"), clean(view))


def subset_node_id(dimension: Column | str, hierarchy: Column | str, subset: Column | str) -> Column:
    return F.concat_ws("::", F.lit("subset"), clean(dimension), clean(hierarchy), F.lit("PUBLIC::<none>"), clean(subset))


def relationship_id(source: Column | str, rel_type: Column | str, target: Column | str, rel_class: Column | str) -> Column:
    return F.concat(F.lit("object-relationship::"), relationship_digest(source, rel_type, target, rel_class))


def relationship_digest(source: Column | str, rel_type: Column | str, target: Column | str, rel_class: Column | str) -> Column:
    return hash_parts(clean(source), token(rel_type), clean(target), token(rel_class))


def catalog_relationship_id(snapshot, source, target, target_name, rel_type, ordinal, procedure, line) -> Column:
    """24 characters over snapshot, endpoints, type, ordinal, procedure and line."""
    return stable_hash(
        24,
        snapshot_id=col(snapshot),
        source_object_id=col(source),
        target_object_id=col(target),
        target_qualified_name=F.lower(clean(target_name)),
        relationship_type=col(rel_type),
        ordinal=col(ordinal),
        procedure=col(procedure),
        line_number=col(line),
    )


def reference_id(kind: str, *parts: Column | str, prefix: str = "") -> Column:
    """Id of a conceptual reference. ``prefix`` is put before the kind where another catalog's ids must be met."""
    name = f"{prefix}{kind}"
    return F.concat(F.lit(name.lower().replace("_", "-") + "::"), hash_parts(F.lit(name), *parts))


def view_reference_id(cube, view, prefix: str = "") -> Column:
    return reference_id("VIEW_REFERENCE", norm_key(cube), norm_key(view), prefix=prefix)


def subset_reference_id(dimension, hierarchy, subset, prefix: str = "") -> Column:
    effective = F.coalesce(blank_to_null(hierarchy), clean(dimension))
    return reference_id("SUBSET_REFERENCE", norm_key(dimension), norm_key(effective), norm_key(subset), prefix=prefix)


def file_reference_id(path) -> Column:
    return reference_id("FILE_REFERENCE", norm_key(F.replace(clean(path), F.lit("/"), F.lit("\\"))))


def configured_source_id(process, source_type, shared) -> Column:
    """Id used by the object graph when a declaration brings none."""
    return F.concat(
        F.lit("configured-source::"),
        hash_parts(F.lit("CONFIGURED_SOURCE"), norm_key(process), token(source_type), norm_key(shared)),
    )


def source_declaration_id(process_name, source_type, shared) -> Column:
    """Id of one process's declaration of a source."""
    raw = F.concat_ws(UNIT_SEPARATOR, node_id("process", process_name), col(source_type), col(shared))
    return F.concat(F.lit("configured-source::"), F.sha2(F.lower(raw), 256))
