"""References mined from tables of code text: built-in expressions, and the token scanner of `scan.py` for nested calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import vocab
from ..functions.text import QUOTED, WHITESPACE, clean, col, is_identifier, norm_key, trim_all, unquote
from . import scan
from .window import asof_last, cut, sample_per_group

LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
COMMENT = {"#": r"#[^\r\n]*", "//": r"//[^\r\n]*", "/*": r"/\*[\s\S]*?(?:\*/|\z)"}
COMMENT_START = {"#": "#", "//": "/", "/*": "/"}
OPEN_QUOTE = r"['\"][\s\S]*"


def procedure_rank(c: Column | str) -> Column:
    return F.coalesce(vocab.lookup(vocab.PROCEDURE_ORDER, col(c)), F.lit(99))


# ---- X2 comments -----------------------------------------------------------

def _may_comment(c: Column | str, styles) -> Column:
    """A literal test: text without any of these signs needs no scan."""
    return reduce(lambda a, b: a | b, [F.contains(col(c), F.lit(s)) for s in styles])


def mask_comments(c: Column | str, styles=("#",)) -> Column:
    """Comments become spaces; offsets, line breaks and quoted text stay."""
    stops = "".join(sorted({COMMENT_START[s] for s in styles}))
    pattern = "|".join([QUOTED, OPEN_QUOTE, *[COMMENT[s] for s in styles], rf"[^'\"{stops}]++", rf"[{stops}]"])
    begins = "|".join(COMMENT[s] for s in styles)
    pieces = F.regexp_extract_all(col(c), F.lit(pattern), F.lit(0))
    masked = F.transform(
        pieces, lambda t: F.when(F.rlike(t, F.lit(rf"^(?:{begins})")), F.regexp_replace(t, r"[^\r\n]", " ")).otherwise(t)
    )
    return F.when(_may_comment(c, styles), F.array_join(masked, "")).otherwise(col(c))


def strip_comments(c: Column | str, styles=("#",)) -> Column:
    """Comments removed without touching quoted text."""
    comments = "|".join(COMMENT[s] for s in styles)
    stripped = F.regexp_replace(col(c), rf"({QUOTED}|{OPEN_QUOTE})|{comments}", "$1")
    return F.btrim(F.when(_may_comment(c, styles), stripped).otherwise(col(c)), F.lit(WHITESPACE))


def mask_quoted(c: Column | str) -> Column:
    """Text between quotes becomes spaces, quotes and offsets stay."""
    pieces = F.regexp_extract_all(col(c), F.lit(rf"{QUOTED}|{OPEN_QUOTE}|[^'\"]++"), F.lit(0))
    quoted = lambda t: F.rlike(t, F.lit(r"^['\"]"))
    closed = lambda t: F.rlike(t, F.lit(rf"^(?:{QUOTED})$"))
    blank = lambda t: F.concat(
        F.left(t, F.lit(1)),
        F.regexp_replace(F.substr(t, F.lit(2), F.length(t) - F.when(closed(t), 2).otherwise(1)), r"[^\r\n]", " "),
        F.when(closed(t), F.right(t, F.lit(1))).otherwise(F.lit("")),
    )
    return F.array_join(F.transform(pieces, lambda t: F.when(quoted(t), blank(t)).otherwise(t)), "")


# ---- X1 lines and statements --------------------------------------------------

def explode_lines(code: DataFrame, text: str = "code") -> DataFrame:
    """One row per non-empty line, comments removed, numbered from 1."""
    keep = [c for c in code.columns if c != text]
    return (
        code.select(*keep, F.posexplode(F.split(col(text), LINE_BREAK)).alias("_pos", "_line"))
        .select(*keep, (F.col("_pos") + 1).alias("line_number"), strip_comments("_line").alias("line_text"))
        .where(F.col("line_text") != "")
    )


def explode_statements(code: DataFrame, text: str = "code", styles=("#", "//", "/*")) -> DataFrame:
    """One row per statement, closed by ';' outside quotes and parentheses, with its start line."""
    keep = [c for c in code.columns if c != text]
    found = scan.statement_rows(mask_comments(text, styles), rest_in_open=True)
    return (
        code.select(*keep, F.posexplode(found).alias("statement_position", "_s"))
        .select(*keep, "statement_position", (F.col("_s.lines_before") + 1).alias("statement_line"), clean("_s.text").alias("statement"))
        .where(F.col("statement") != "")
    )


# ---- X3 calls -------------------------------------------------------------------

def call_arguments(call: Column | str) -> Column:
    """Trimmed arguments of a call; empty arguments survive, an empty list has none."""
    return scan.argument_rows(col(call))


def extract_calls(df: DataFrame, names, text: str = "line_text", line: str | None = "line_number") -> DataFrame:
    """One row per call of a named function, nested calls included, with its arguments.

    Names inside quoted text are not calls, unbalanced calls are left out. With ``line`` the input is one row per
    line; with ``line=None`` the text spans lines and the line of each call is counted.
    """
    named = "|".join(sorted(names, key=lambda n: (-len(n), n)))
    keep = [c for c in df.columns if c != text]
    # a literal test first: most lines of most code call nothing and need no scan
    staged = df.where(F.contains(col(text), F.lit("(")) & F.rlike(col(text), F.lit(rf"(?i)\b(?=\w++\s*\()(?:{named})\s*\(")))
    rows = staged.select(*keep, F.posexplode(scan.call_rows(col(text), named)).alias("call_position", "_c"))
    lines = [F.col("_c.line").alias("line_number")] if line is None else []
    return rows.select(*keep, "call_position", F.col("_c.call").alias("call_text"), *lines, F.col("_c.name").alias("function_name"), F.col("_c.arguments").alias("arguments"))


# ---- X4 registry ------------------------------------------------------------------

def argument(position: Column | str, arguments: Column | str = "arguments") -> Column:
    return F.try_element_at(col(arguments), col(position) + 1)


def apply_registry(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """Typed relationship of each call: relationship, target type and the argument texts by role."""
    joined = calls.withColumn("function_key", F.upper("function_name")).join(registry, "function_key")
    return joined.withColumns({
        "target_expression": F.coalesce(argument("target_arg"), F.lit("<missing argument>")),
        "parent_expression": argument("parent_arg"),
        "hierarchy_expression": argument("hierarchy_arg"),
        "attribute_expression": argument("attribute_arg"),
    })


# ---- X5/X6 symbols and expressions -----------------------------------------------------

ASSIGNED = r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*="
ASSIGNMENT = r"(?s)^\s*([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*;?\s*$"
FLAT_PART = rf"((?:[^|'\"]++|{QUOTED}|['\"])*+)\|"


def expression_text(c: Column | str) -> Column:
    return clean(F.regexp_replace(clean(c), r";+\s*$", ""))


def concat_parts(c: Column | str) -> Column:
    """Parts of a '|' concatenation; a plain expression is its own single part."""
    nests = F.contains(col(c), F.lit("("))
    flat = trim_all(F.regexp_extract_all(F.concat(col(c), F.lit("|")), F.lit(FLAT_PART), F.lit(1)))
    return F.when(nests, scan.nested_parts(F.when(nests, col(c)))).otherwise(flat)


def assignments(lines: DataFrame, text: str = "line_text") -> DataFrame:
    """Rows that assign a variable, with its name and expression."""
    return (
        lines.where(F.contains(text, F.lit("=")) & F.rlike(text, F.lit(ASSIGNED)))
        .withColumn("variable", F.regexp_extract(text, ASSIGNED, 1))
        .withColumn("expression", expression_text(F.regexp_extract(text, ASSIGNMENT, 2)))
    )


def resolve_symbols(statements: DataFrame, keys, order: str, is_assign: Column, value: Column,
                    bucket_width: int | None = None) -> DataFrame:
    """Value of each row's variable at that point: its last earlier assignment, cleared by an unresolvable one. A variable with very
    many rows is cut into ranges of its own order values."""
    return asof_last(statements, keys, order, is_assign, value, "value_at_use", bucket_width)


def resolve_lists(defs: DataFrame, uses: DataFrame, scope: str = "process_name") -> DataFrame:
    """Resolve literals, variables and '|' concatenations of them, in one pass over each scope.

    ``defs(scope, seq, variable, expression)`` are assignments; ``uses(scope, seq, expressions, payload)`` hold expressions to
    resolve. A use sees assignments at its own seq; an assignment sees only earlier ones; of assignments of one variable at one
    seq the last in text order counts. The rows of a scope are sorted by seq and streamed, with the variables' present values as
    the only state, so a chain of any length costs its own length. Returns the payload's columns and ``resolved_values``.
    """
    payload = uses.schema["payload"].dataType
    nothing = F.lit(None)
    rows = defs.select(
        col(scope).alias("scope"), F.col("seq").cast("bigint").alias("seq"), F.lit(0).alias("kind"), norm_key("variable").alias("variable"),
        F.array("expression").alias("expressions"), nothing.cast(payload).alias("payload"),
    ).unionByName(uses.select(
        col(scope).alias("scope"), F.col("seq").cast("bigint").alias("seq"), F.lit(1).alias("kind"), nothing.cast("string").alias("variable"),
        F.col("expressions").cast("array<string>").alias("expressions"), "payload",
    ))
    ordered = rows.repartition("scope").sortWithinPartitions("scope", "seq", "kind", "expressions")
    schema = T.StructType([T.StructField("payload", payload), T.StructField("resolved_values", T.ArrayType(T.StringType()))])
    return ordered.mapInArrow(scan.resolve_stream, schema).select("payload.*", "resolved_values")


def rated(expression: Column, value: Column) -> tuple[Column, Column]:
    """Resolved value of an expression (its own text where there is none) and how sure it is."""
    text = expression_text(expression)
    return F.coalesce(value, text), _sure(text, value)


def _sure(text: Column, value: Column) -> Column:
    return F.when(value.isNull(), "UNRESOLVED").when(unquote(text).isNotNull(), "CONFIRMED").otherwise("RESOLVED")


def resolve_expressions(defs: DataFrame, uses: DataFrame, scope: str = "process_name") -> DataFrame:
    """resolve_lists for ``uses(use_id, scope, seq, expression)``; returns ``use_id, expression, resolved_value, confidence``."""
    listed = uses.select(
        col(scope), "seq", F.array("expression").alias("expressions"),
        F.struct(F.col("use_id").cast("string").alias("use_id"), "expression").alias("payload"),
    )
    value, sure = rated(F.col("expression"), F.col("resolved_values")[0])
    return resolve_lists(defs, listed, scope).select("use_id", "expression", value.alias("resolved_value"), sure.alias("confidence"))


# ---- X7/X8 targets ---------------------------------------------------------------------

def weakest(*confidences: Column) -> Column:
    """The lowest rating among the given ones; nulls do not count."""
    rank = F.least(*[vocab.lookup(vocab.CONFIDENCE_RANK, c) for c in confidences]) if len(confidences) > 1 else vocab.lookup(
        vocab.CONFIDENCE_RANK, confidences[0]
    )
    return vocab.lookup({v: k for k, v in vocab.CONFIDENCE_RANK.items()}, rank)


def compose_target(df: DataFrame) -> DataFrame:
    """parent.target.hierarchy.attribute from resolved parts, rated by the weakest part."""
    missing = F.col("target_expression") == "<missing argument>"
    full = F.concat_ws(".", "parent_value", "target_value", "hierarchy_value", "attribute_value")
    rated = weakest(*[F.col(f"{p}_confidence") for p in ("target", "parent", "hierarchy", "attribute")])
    return df.withColumns({
        "target_name": F.when(missing, "<missing argument>").otherwise(full),
        "confidence": F.when(missing, "UNRESOLVED").otherwise(rated),
        "attribute_name": F.col("attribute_value"),
    })


def rewrite_edges(df: DataFrame) -> DataFrame:
    """Reads of attribute-holding control cubes become attribute reads; a two-sided call yields both relationships."""
    reads_attributes = F.col("function_key").isin("CELLGETN", "CELLGETS") & F.startswith(
        "target_name", F.lit(vocab.ATTRIBUTE_CUBE_PREFIX)
    ) & (F.size("arguments") >= 3)
    dimension = F.substr("target_name", F.lit(len(vocab.ATTRIBUTE_CUBE_PREFIX) + 1))
    primary = F.struct(
        F.when(reads_attributes, "READS_ATTRIBUTE").otherwise(F.col("relationship")).alias("relationship_type"),
        F.when(reads_attributes, "attribute").otherwise(F.col("registry_target_type")).alias("target_type"),
        F.when(reads_attributes, F.concat_ws(".", dimension, "last_value")).otherwise(F.col("target_name")).alias("target_name"),
        F.col("target_expression").alias("target_expression"),
        F.when(reads_attributes, weakest(F.col("confidence"), F.col("last_confidence"))).otherwise(F.col("confidence")).alias("confidence"),
        F.when(reads_attributes, F.col("last_value")).otherwise(F.col("attribute_name")).alias("attribute_name"),
    )
    has_second = F.col("second_relationship").isNotNull()
    has_target = F.col("second_target_value").isNotNull()
    secondary = F.when(has_second, F.struct(
        F.col("second_relationship").alias("relationship_type"),
        F.col("second_type").alias("target_type"),
        F.when(has_target, F.concat_ws(".", "second_parent_value", "second_target_value")).otherwise("<missing argument>").alias("target_name"),
        F.coalesce(argument("second_target_arg"), F.lit("<missing argument>")).alias("target_expression"),
        F.when(has_target, weakest(F.col("second_target_confidence"), F.col("second_parent_confidence"))).otherwise("UNRESOLVED").alias("confidence"),
        F.lit(None).cast("string").alias("attribute_name"),
    ))
    sides = F.filter(F.array(primary, secondary), lambda x: x.isNotNull())
    drop = ["target_name", "target_expression", "confidence", "attribute_name"]
    return df.withColumn("_sides", sides).drop(*drop).select("*", F.posexplode("_sides").alias("side", "_side")).select(
        "*", "_side.*"
    ).drop("_sides", "_side")


PART_ROLES = {
    "target": "target_arg", "parent": "parent_arg", "hierarchy": "hierarchy_arg", "attribute": "attribute_arg",
    "second_target": "second_target_arg", "second_parent": "second_parent_arg",
}


def process_evidence(code: DataFrame, registry: DataFrame, names=None) -> DataFrame:
    """Evidence rows of process code: one per reference, targets resolved through the symbols of the process."""
    names = names or vocab.code_function_names()
    lines = explode_lines(code).withColumn(
        "seq", procedure_rank("procedure").cast("bigint") * 1_000_000_000 + F.col("line_number")
    )
    calls = apply_registry(extract_calls(lines, names), registry)
    expressions = F.array(*[argument(arg) for arg in PART_ROLES.values()], F.try_element_at("arguments", F.lit(-1)))
    # the registry is small: its columns are joined again afterwards rather than carried through the sort
    carried = [c for c in calls.columns if c not in {*registry.columns, "parent_expression", "hierarchy_expression", "attribute_expression"}]
    payload = F.struct("function_key", *carried, "expressions")
    uses = calls.withColumn("expressions", expressions).select("process_name", "seq", "expressions", payload.alias("payload"))
    solved = resolve_lists(assignments(lines), uses)
    # text, value and rating of each part are worked out once, then named
    texts = solved.withColumn("_texts", F.transform("expressions", lambda e: F.when(e.isNotNull(), expression_text(e))))
    parts = F.zip_with("_texts", "resolved_values", lambda t, v: F.when(t.isNotNull(), F.struct(F.coalesce(v, t).alias("value"), _sure(t, v).alias("sure"))))
    solved = texts.withColumn("_parts", parts).drop("_texts").join(registry, "function_key")
    wide = {}
    for i, role in enumerate([*PART_ROLES, "last"]):
        wide |= {f"{role}_value": F.col("_parts")[i]["value"], f"{role}_confidence": F.col("_parts")[i]["sure"]}
    composed = compose_target(solved.withColumns(wide))
    writes = ("WRITES_TO_CUBE", "INCREMENTS_CUBE", "SPREADS_TO_CUBE")
    return rewrite_edges(composed).select(
        "process_name", "procedure", "line_number", "function_name", "relationship_type", "target_type", "target_name",
        "target_expression", "confidence", F.col("call_text").alias("code_reference"), "attribute_name",
        F.when(F.col("relationship_type").isin(*writes), F.col("last_value")).alias("target_measure"), "call_position", "side",
    )


# ---- X9 rules ------------------------------------------------------------------------------

def rule_evidence(rules: DataFrame, registry: DataFrame, names=None, styles=("#", "//", "/*")) -> DataFrame:
    """Evidence rows of cube rules; a cube read inside a feeder statement is a feed."""
    names = names or vocab.rule_function_names()
    staged = rules.where(clean("rule_text") != "").withColumn("code", mask_comments("rule_text", styles)).drop("rule_text")
    calls = apply_registry(extract_calls(with_feeder(staged), names, text="statement", line=None), registry)
    return _rule_rows(calls)


def with_feeder(df: DataFrame, text: str = "code") -> DataFrame:
    """Statements of rule text, cut at ';' outside quotes, flagged as feeders when they hold '=>'."""
    keep = [c for c in df.columns if c != text]
    return (
        df.select(*keep, F.posexplode(scan.statement_rows(col(text), rest_in_open=False)).alias("statement_position", "_s"))
        .select(*keep, "statement_position", F.col("_s.lines_before").alias("lines_before"), F.col("_s.text").alias("statement"))
        .where(clean("statement") != "")
        .withColumn("is_feeder", F.contains("statement", F.lit("=>")))
    )


def _rule_rows(calls: DataFrame) -> DataFrame:
    target = F.when(F.col("target_expression") != "<missing argument>", F.col("target_expression"))
    name = unquote(target)
    owner_typed = F.col("registry_target_type").isin("DIMENSION", "HIERARCHY", "ATTRIBUTE")
    return calls.select(
        F.col("cube_name").alias("source_cube"),
        F.when((F.col("function_key") == "DB") & F.col("is_feeder"), "FEEDS").otherwise(F.col("relationship")).alias("relationship_type"),
        F.col("registry_target_type").alias("target_object_type"),
        name.alias("target_name"),
        target.alias("target_expression"),
        F.col("function_key").alias("function_name"),
        (F.col("line_number") + F.col("lines_before")).alias("line_number"),
        F.col("call_text").alias("expression"),
        "is_feeder",
        F.when(F.coalesce(name, F.lit("")) != "", "HIGH").otherwise("MEDIUM").alias("confidence"),
        F.when(owner_typed, name).alias("dimension_name"),
        unquote("hierarchy_expression").alias("hierarchy_name"),
        unquote("attribute_expression").alias("attribute_name"),
    )


# ---- X10 parameters ---------------------------------------------------------------------------

def parameters(definitions: DataFrame, array: str = "parameters") -> DataFrame:
    """One row per process parameter with position and non-empty default."""
    return (
        definitions.select("process_name", F.posexplode(array).alias("_pos", "_p"))
        .where(clean("_p.name") != "")
        .select(
            "process_name", clean("_p.name").alias("parameter_name"), (F.col("_pos") + 1).alias("position"),
            F.nullif(clean("_p.value"), F.lit("")).alias("default_value"),
        )
    )


def bindings(calls: DataFrame) -> DataFrame:
    """Name and value argument pairs of process calls; a name without a value is left out."""
    pairs = F.when(
        F.size("arguments") >= 3, F.sequence(F.lit(2), F.size("arguments") - 1, F.lit(2))
    )
    return (
        calls.where(F.upper("function_name").isin(*vocab.CALL_FUNCTIONS))
        .withColumn("_at", F.explode(pairs))
        .withColumns({
            "called_expression": F.col("arguments")[0],
            "parameter_expression": F.element_at("arguments", F.col("_at")),
            "argument_expression": F.element_at("arguments", F.col("_at") + 1),
        })
        .withColumns({
            "called_process": unquote("called_expression"),
            "parameter_name": unquote("parameter_expression"),
            "resolved_value": unquote("argument_expression"),
        })
        .withColumn("resolution_status", F.when(F.col("resolved_value").isNotNull(), "CONFIRMED").otherwise("UNRESOLVED"))
        .drop("_at")
    )


def aliases(assigned: DataFrame) -> DataFrame:
    """Assignments that depend on other names, with the sorted distinct names."""
    names = F.array_sort(F.array_distinct(F.filter(concat_parts("expression"), lambda p: is_identifier(p))))
    return assigned.withColumn("dependencies", names).where(F.size("dependencies") > 0)


# ---- X11 coverage -----------------------------------------------------------------------------------

ANY_NAME = r"[A-Za-z_][A-Za-z0-9_]*"


def discovered_calls(rules: DataFrame, text: str = "rule_text", key: str = "cube_name", styles=("#", "//", "/*")) -> DataFrame:
    """Every name followed by '(' outside quotes and comments, with its line and whether it closes."""
    staged = rules.where(clean(text) != "").select(key, mask_quoted(mask_comments(text, styles)).alias("_t"))
    return (
        staged.select(key, F.posexplode(scan.call_rows(F.col("_t"), ANY_NAME, complete=False)).alias("call_position", "_c"))
        .select(
            key, "call_position", F.upper("_c.name").alias("function_name"), F.col("_c.line").alias("line_number"),
            F.coalesce("_c.call", "_c.name").alias("expression"), F.col("_c.call").isNotNull().alias("is_complete"),
        )
    )


def function_coverage(rules: DataFrame, registry: DataFrame | None = None, key: str = "cube_name", samples: int = 5) -> DataFrame:
    """One row per function that rules call: occurrences, cubes, what the coverage registry knows of it and the first sample calls."""
    # counts and samples both read the calls, so the rules are scanned once
    calls = cut(discovered_calls(rules, key=key).where("is_complete").select(key, "call_position", "function_name", "line_number"))
    counts = calls.groupBy("function_name").agg(
        F.count("*").alias("occurrence_count"), F.count_distinct(key).alias("cube_count")
    )
    evidence = (
        sample_per_group(calls, "function_name", [key, "line_number", "call_position"], samples)
        .groupBy("function_name")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("sample_rank", key, "line_number"))),
                         lambda s: F.concat_ws(":", s[key], s["line_number"].cast("string"))).alias("sample_evidence"))
    )
    known = (registry if registry is not None else vocab.function_coverage(rules.sparkSession)).withColumn("_known", F.lit(True))
    unknown = F.lit("REVIEW_REQUIRED")
    return counts.join(evidence, "function_name").join(known, "function_name", "left").select(
        "function_name", "occurrence_count", "cube_count",
        F.coalesce("parser_status", unknown).alias("parser_status"), F.coalesce("lineage_category", unknown).alias("lineage_category"),
        "relationship_type", "target_object_type",
        F.when(F.col("_known"), "CLASSIFIED").otherwise("UNCLASSIFIED").alias("registry_status"), "sample_evidence",
    )


def malformed_calls(rules: DataFrame, key: str = "cube_name") -> DataFrame:
    """Calls whose parenthesis never closes, one row each."""
    return discovered_calls(rules, key=key).where(~F.col("is_complete")).select(key, "function_name", "line_number")


def coverage_summary(profile: DataFrame, rules: DataFrame, key: str = "cube_name") -> DataFrame:
    """Counts and coverage percentages over the function profile of rules, in one row."""
    sums = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("occurrence_count"))), F.lit(0))
    percent = lambda n, d: F.when(d > 0, F.round(100.0 * n / d, 2)).otherwise(F.lit(100.0))
    classified, of_lineage = F.col("registry_status") == "CLASSIFIED", F.col("lineage_category").isin("DIRECT", "CONTEXTUAL")
    supported, total = F.col("parser_status") == "SUPPORTED", F.coalesce(F.sum("occurrence_count"), F.lit(0))
    open_status = F.col("parser_status").isin("NOT_SUPPORTED", "PARTIALLY_SUPPORTED", "REVIEW_REQUIRED")
    counts = profile.agg(
        F.count("*").alias("unique_function_count"), F.count_if(classified).alias("classified_function_count"), F.count_if(~classified).alias("unclassified_function_count"),
        total.alias("total_function_occurrences"), sums(classified).alias("classified_occurrences"), sums(supported).alias("supported_occurrences"),
        sums(of_lineage).alias("lineage_function_occurrences"), sums(of_lineage & supported).alias("supported_lineage_occurrences"),
        sums(F.col("lineage_category") == "DYNAMIC").alias("dynamic_function_occurrences"),
        percent(sums(classified), total).alias("syntactic_coverage_percent"), percent(sums(of_lineage & supported), sums(of_lineage)).alias("lineage_coverage_percent"),
        # names of functions, of which there are few
        F.array_sort(F.collect_set(F.when(open_status, F.col("function_name")))).alias("unsupported_or_review_functions"),
    )
    ruled = rules.agg(F.count_if(clean("rule_text") != "").alias("ruled_cube_count"))
    malformed = malformed_calls(rules, key).agg(F.count("*").alias("malformed_call_count"))
    return counts.crossJoin(F.broadcast(ruled)).crossJoin(F.broadcast(malformed))
