"""Classes of names, paths, commands, sources and statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from .ids import opt
from .text import (
    blank_to_null, clean, col, first_nonblank, is_dynamic_expression, norm_key, redact, safe_preview, token,
)


def is_control(c: Column | str, prefix: str = vocab.CONTROL_PREFIX) -> Column:
    return F.startswith(clean(c), F.lit(prefix))


def with_scope(df: DataFrame, name_col: str, prefix: str = vocab.CONTROL_PREFIX) -> DataFrame:
    """Control flag, scope label and the wider system flag."""
    control = is_control(name_col, prefix)
    lowered = F.lower(clean(name_col))
    return df.withColumns({
        "is_control": control,
        "catalog_scope": F.when(control, "CONTROL").otherwise("REGULAR"),
        "is_system_object": control | F.startswith(lowered, F.lit("sys_")) | F.startswith(lowered, F.lit("sys ")),
    })


def map_enum(c: Column | str, values, aliases: dict | None = None, default: str = "UNKNOWN", fold=F.upper) -> Column:
    """Member of a closed vocabulary, through aliases, with a default."""
    key = fold(clean(c))
    if aliases:
        key = F.coalesce(vocab.lookup(aliases, key), key)
    return F.when(key.isin(*values), key).otherwise(F.lit(default))


def object_type_of(c) -> Column:
    return map_enum(c, vocab.OBJECT_TYPES, default="unknown", fold=F.lower)


def relationship_type_of(c) -> Column:
    return map_enum(c, vocab.RELATIONSHIP_TYPES, vocab.RELATIONSHIP_ALIASES, "REFERENCES")


def confidence_of(c) -> Column:
    return map_enum(c, vocab.CONFIDENCES, vocab.CONFIDENCE_ALIASES, "UNRESOLVED")


def validation_status_of(c) -> Column:
    return map_enum(c, vocab.VALIDATION_STATUSES, default="NOT_CROSS_CHECKED")


def attribute_type(c: Column | str) -> Column:
    """struct(raw_type, data_type, is_alias)."""
    raw = clean(c)
    key = F.upper(raw)
    kind = (
        F.when(key.isin("1", "N", "NUMERIC", "NUMBER"), "NUMERIC")
        .when(key.isin("3", "A", "ALIAS"), "ALIAS")
        .when(key.isin("2", "S", "STRING", "TEXT", ""), "STRING")
        .otherwise("UNKNOWN")
    )
    return F.struct(
        F.when(raw == "", "S").otherwise(raw).alias("raw_type"), kind.alias("data_type"), (kind == "ALIAS").alias("is_alias")
    )


# ---- paths -----------------------------------------------------------------

def _fold_segments(path: Column, absolute: bool) -> Column:
    """Drop empty and '.' segments and apply '..', keeping leading '..' of relative paths."""
    segments = F.filter(F.split(path, r"\\"), lambda x: (x != "") & (x != "."))
    can_pop = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1)) != "..", F.lit(False))
    step = lambda acc, x: (
        F.when((x == "..") & can_pop(acc), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when((x == "..") & F.lit(absolute), acc)
        .otherwise(F.array_append(acc, x))
    )
    return F.array_join(F.aggregate(segments, F.array().cast("array<string>"), step), "\\")


def path_struct(c: Column | str) -> Column:
    """struct(path, location_class, is_dynamic)."""
    text = F.btrim(F.btrim(clean(c)), F.lit("'\""))
    dynamic = is_dynamic_expression(text)
    slashed = F.replace(text, F.lit("/"), F.lit("\\"))
    share = F.regexp_extract(slashed, r"^(\\\\[^\\]+\\[^\\]+)", 1)
    unc_rest = _fold_segments(F.substr(slashed, F.length(share) + 1), True)
    unc = F.when(share == "", slashed).when(unc_rest == "", F.when(F.length(slashed) > F.length(share), F.concat(share, F.lit("\\"))).otherwise(share)).otherwise(F.concat(share, F.lit("\\"), unc_rest))
    drive = F.concat(F.left(slashed, F.lit(2)), F.lit("\\"), _fold_segments(F.substr(slashed, F.lit(4)), True))
    relative_folded = _fold_segments(slashed, False)
    rooted = F.startswith(slashed, F.lit("\\"))
    relative = (
        F.when(rooted, F.concat(F.lit("\\"), _fold_segments(slashed, True)))
        .when(relative_folded == "", F.lit("."))
        .otherwise(relative_folded)
    )
    kind = (
        F.when(F.rlike(text, F.lit(r"(?i)^(?:https?|s?ftp):")), "URL")
        .when(F.startswith(slashed, F.lit("\\\\")), "UNC")
        .when(F.rlike(slashed, F.lit(r"^[A-Za-z]:\\")), "LOCAL_ABSOLUTE")
        .when(dynamic, "DYNAMIC")
        .when(slashed != "", "RELATIVE")
        .otherwise("UNKNOWN")
    )
    path = (
        F.when(kind == "URL", text).when(kind == "UNC", unc).when(kind == "LOCAL_ABSOLUTE", drive)
        .when(kind == "RELATIVE", relative).otherwise(slashed)
    )
    return F.struct(path.alias("path"), kind.alias("location_class"), dynamic.alias("is_dynamic"))


def extension(path: Column | str) -> Column:
    name = F.regexp_extract(col(path), r"([^\\/]*)[\\/]*$", 1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def with_path_class(df: DataFrame, column: str) -> DataFrame:
    """File node columns for a path expression: redacted, normalised, classed and hashed."""
    staged = df.withColumn("_red", redact(column)).withColumn("_path", path_struct(F.col("_red.text")))
    staged = staged.withColumn("_ext", extension("_path.path"))
    kind = F.when(F.col("_ext").isin(*vocab.SCRIPT_EXTENSIONS), "SCRIPT").otherwise("FILE")
    digest = F.sha2(F.lower(F.col("_path.path")), 256)
    return staged.withColumns({
        "display_value": F.col("_path.path"),
        "location_class": F.col("_path.location_class"),
        "extension": F.nullif(F.col("_ext"), F.lit("")),
        "is_dynamic": F.col("_path.is_dynamic"),
        "credential_redacted": F.col("_red.redacted"),
        "node_type": kind,
        "node_id": F.concat_ws("::", F.lower(kind), F.col("_path.location_class"), digest),
        "path_hash": digest,
    }).drop("_red", "_path", "_ext")


# ---- commands ---------------------------------------------------------------

def command_kind(c: Column | str) -> Column:
    text = col(c)
    low = F.lower(text)
    ends_with_script = F.lit(False)
    for ext in vocab.SCRIPT_EXTENSIONS:
        ends_with_script = ends_with_script | F.endswith(low, F.lit(ext))
    return (
        F.when(F.contains(low, F.lit("powershell")) | F.contains(low, F.lit("pwsh")), "POWERSHELL")
        .when(F.rlike(low, F.lit(r"(^|[\\\s])cmd(?:\.exe)?\b")), "CMD")
        .when(ends_with_script, "SCRIPT")
        .when(is_dynamic_expression(text), "DYNAMIC")
        .when(F.rlike(low, F.lit(r"\.exe(?:\s|$)")), "EXECUTABLE")
        .otherwise("UNKNOWN")
    )


def with_command_kind(df: DataFrame, column: str) -> DataFrame:
    staged = df.withColumn("_red", redact(column))
    text = F.col("_red.text")
    return staged.withColumns({
        "sanitized_expression": text,
        "command_kind": command_kind(text),
        "is_dynamic": is_dynamic_expression(text),
        "credential_redacted": F.col("_red.redacted"),
        "node_type": F.lit("COMMAND"),
        "node_id": F.concat_ws("::", F.lit("command"), command_kind(text), F.sha2(F.lower(text), 256)),
    }).drop("_red")


COMMAND_TOKEN = r"\"[^\"]*\"|'[^']*'|[^\s\"'][^\s]*"


def command_tokens(c: Column | str) -> Column:
    """Words of a command line, quoted words kept whole; unbalanced quotes fall back to whitespace."""
    text = col(c)
    words = F.regexp_extract_all(text, F.lit(COMMAND_TOKEN), F.lit(0))
    leftover = F.regexp_replace(text, COMMAND_TOKEN, "")
    plain = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    return F.when(F.rlike(leftover, F.lit(r"['\"]")), plain).otherwise(words)


def command_children(df: DataFrame, column: str = "sanitized_expression") -> DataFrame:
    """One row per executable and script operand of each command."""
    staged = df.withColumn("_words", command_tokens(column)).where(F.size("_words") > 0)
    first = F.btrim(F.col("_words")[0], F.lit("'\""))
    name = F.lower(F.regexp_extract(first, r"([^\\/]*)[\\/]*$", 1))
    runs = extension(first).isin(*vocab.EXECUTABLE_EXTENSIONS) | F.lower(first).isin(*vocab.EXECUTABLE_NAMES)
    operands = F.filter(
        F.transform(F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0))), lambda w: F.btrim(w, F.lit("'\",;"))),
        lambda w: extension(w).isin(*vocab.SCRIPT_EXTENSIONS),
    )
    children = F.concat(
        F.when(runs, F.array(F.struct(F.lit("INVOKES_EXECUTABLE").alias("relationship_type"), name.alias("operand")))).otherwise(
            F.array().cast("array<struct<relationship_type:string,operand:string>>")
        ),
        F.transform(operands, lambda w: F.struct(F.lit("REFERENCES_SCRIPT").alias("relationship_type"), w.alias("operand"))),
    )
    return staged.withColumn("_child", F.explode(children)).select(
        *[c for c in df.columns], F.col("_child.relationship_type").alias("child_relationship_type"), F.col("_child.operand").alias("operand")
    )


# ---- data sources ------------------------------------------------------------

def source_type(df: DataFrame) -> Column:
    """Class of a configured source: its declared type, else whichever detail is filled."""
    declared = F.regexp_replace(F.upper(clean(opt(df, "declared_type"))), "[^A-Z0-9]", "")
    has = lambda *names: first_nonblank(*[opt(df, n) for n in names]).isNotNull()
    contains = lambda *marks: F.rlike(declared, F.lit("|".join(marks)))
    return (
        F.when(declared.isin("", "NONE", "PROCESS", "DICT", "MAPPING"), "NONE")
        .when(contains("ODBC", "SQL", "DATABASE"), "ODBC")
        .when(contains("CUBEVIEW"), "CUBE_VIEW")
        .when(contains("SUBSET"), "DIMENSION_SUBSET")
        .when(contains("JSON"), "JSON")
        .when(contains("ASCII", "CHARACTERDELIMITED", "FILE"), "ASCII_FILE")
        .when(has("query"), "ODBC")
        .when(has("view_name"), "CUBE_VIEW")
        .when(has("subset_name"), "DIMENSION_SUBSET")
        .when(has("json_root_pointer"), "JSON")
        .when(has("server_source_name", "client_source_name"), "ASCII_FILE")
        .otherwise("UNKNOWN")
    )


def with_source_class(df: DataFrame, prefix: str = "") -> DataFrame:
    """Source class, effective names, identity, node id and redacted details.

    ``prefix`` is put before the two catalog-internal classes inside identities, for catalogs whose ids carry one.
    """
    staged = df.withColumn("source_type", source_type(df))
    staged = staged.withColumns({
        "effective_cube_name": blank_to_null(first_nonblank(opt(df, "cube_name"), opt(df, "server_source_name"), opt(df, "client_source_name"))),
        "effective_hierarchy_name": blank_to_null(first_nonblank(opt(df, "hierarchy_name"), opt(df, "dimension_name"))),
    })
    kind = F.col("source_type")
    internal = F.when(kind.isin("CUBE_VIEW", "DIMENSION_SUBSET"), F.concat(F.lit(prefix), kind)).otherwise(kind)
    path = clean(first_nonblank(opt(df, "server_source_name"), opt(df, "client_source_name")))
    identity = (
        F.when(kind == "CUBE_VIEW", F.concat_ws("::", internal, norm_key("effective_cube_name"), norm_key(opt(df, "view_name"))))
        .when(
            kind == "DIMENSION_SUBSET",
            F.concat_ws("::", internal, norm_key(opt(df, "dimension_name")), norm_key("effective_hierarchy_name"), norm_key(opt(df, "subset_name"))),
        )
        .when(kind.isin("ASCII_FILE", "JSON"), F.concat_ws("::", internal, path))
        .when(kind == "ODBC", F.concat_ws("::", internal, clean(opt(df, "server_source_name")), clean(opt(df, "query"))))
        .otherwise(F.concat_ws("::", internal, clean("process_name")))
    )
    hashed = lambda c: F.when(clean(c) != "", F.sha2(clean(c), 256))
    return staged.withColumn("source_identity", identity).withColumns({
        "source_node_id": F.concat_ws("::", F.lit("data-source"), internal, F.sha2(F.col("source_identity"), 256)),
        "query_hash": hashed(opt(df, "query")),
        "query_preview": safe_preview(opt(df, "query")),
        "username_present": clean(opt(df, "user_name")) != "",
        "username_hash": hashed(opt(df, "user_name")),
        "credential_present": clean(opt(df, "password")) != "",
        "credential_redacted": clean(opt(df, "password")) != "",
    }).drop("password", "user_name", "query")


# ---- statuses -----------------------------------------------------------------

def endpoint_state(node_type: Column | str, status: Column | str = "") -> Column:
    kind = token(node_type)
    validation = token(status if isinstance(status, Column) or status else F.lit(""))
    return (
        F.when(kind == "REFERENCE_EXPRESSION", "DYNAMIC")
        .when(kind == "PLANNED_TARGET", "PLANNED")
        .when(kind.isin(*vocab.EXTERNAL_NODE_TYPES), "EXTERNAL_UNVERIFIED")
        .when(F.contains(validation, F.lit("DYNAMIC")), "DYNAMIC")
        .otherwise("CANONICAL")
    )


def effective_confidence(confidence, target_expression, matched: Column) -> Column:
    """A catalogued target is RESOLVED; an uncatalogued literal keeps its rating; an uncatalogued expression has none."""
    text = clean(target_expression)
    literal = F.startswith(text, F.lit("'")) & F.endswith(text, F.lit("'")) & (F.length(text) >= 2)
    rated = confidence_of(confidence)
    return F.when(text == "", rated).when(matched, "RESOLVED").when(literal, rated).otherwise("UNRESOLVED")


def missing_target_status(confidence: Column, target_type: Column) -> Column:
    return (
        F.when(confidence == "PARAMETERIZED", "PARAMETERIZED_REFERENCE")
        .when(confidence == "UNRESOLVED", "UNRESOLVED_DYNAMIC_REFERENCE")
        .when(target_type.isin(*vocab.LATER_CATALOGED_TYPES), "NOT_YET_CATALOGED")
        .otherwise("BROKEN_REFERENCE")
    )


def severity(status: Column) -> Column:
    return (
        F.when(status.isin("BROKEN_REFERENCE", "DUPLICATE_OBJECT", "INVALID_DEFINITION"), "ERROR")
        .when(status == "VALID", "INFO")
        .otherwise("WARNING")
    )


def with_effective_status(df: DataFrame, matched: Column) -> DataFrame:
    """Effective confidence, status and severity of references whose catalog match is known."""
    rated = df.withColumn("effective_confidence", effective_confidence("confidence", opt(df, "target_expression"), matched))
    status = F.when(matched, "VALID").otherwise(
        missing_target_status(F.col("effective_confidence"), object_type_of("target_type"))
    )
    return rated.withColumn("catalog_status", status).withColumn("severity", severity(F.col("catalog_status")))
