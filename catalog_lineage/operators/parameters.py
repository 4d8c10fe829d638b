"""Unresolved targets resolved through the parameters of their process.

References that ask the same (process, parameter, alias, type) are one question, and calls that hand over the same value one answer.
Values are composed and looked up once per question and answer, so references and callers of a busy process never meet; the rows
that name both (provenance and rejections) are joined from three linked tables, and only when they are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions.text import blank_to_null, clean, is_identifier, norm_key, unquote
from .extract import concat_parts
from .resolve import catalog_index
from .window import cut, first_wins, join_counted

CORE_TYPES = ("cube", "dimension", "process", "chore")


def _upstream(refs: DataFrame, aliases: DataFrame, known: DataFrame) -> DataFrame:
    """Parameters an expression may stand for: itself when known, or the only dependency of an alias or of itself."""
    text = clean("target_expression")
    base = refs.withColumns({"_proc": norm_key("process_name"), "_expr": text, "_simple": is_identifier(text)})
    direct = base.where(F.col("_simple")).withColumn("_param", norm_key("_expr")).join(
        known.select("_proc", "_param").distinct(), ["_proc", "_param"], "left_semi"
    ).withColumn("alias_expression", F.lit(None).cast("string"))
    single = aliases.where(F.size("dependencies") == 1).select(
        norm_key("process_name").alias("_proc"), norm_key("variable").alias("_var"),
        F.col("dependencies")[0].alias("_dep"), F.col("expression").alias("alias_expression"),
    ).distinct()
    aliased = base.where(F.col("_simple")).withColumn("_var", norm_key("_expr")).join(single, ["_proc", "_var"]).withColumn(
        "_param", norm_key("_dep")
    ).drop("_var", "_dep")
    names = F.array_distinct(F.filter(concat_parts("_expr"), lambda p: is_identifier(p)))
    composed = base.where(~F.col("_simple") & (F.size(names) == 1)).withColumns({
        "_param": norm_key(names[0]), "alias_expression": F.col("_expr"),
    })
    return direct.unionByName(aliased).unionByName(composed).drop("_simple")


def _evaluate(alias_expression, parameter, value):
    """The alias with its only variable replaced; null when another part is not a literal."""
    parts = F.transform(concat_parts(alias_expression), lambda p: F.coalesce(unquote(p), F.when(norm_key(p) == parameter, value)))
    return F.when(alias_expression.isNull(), value).when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, ""))


class ParameterLinks(NamedTuple):
    """references(key, question, target_expression, covered), answers(question, value, its catalog entry, the raw value),
    callers(process, parameter, raw value, calling process and line)."""

    references: DataFrame
    answers: DataFrame
    callers: DataFrame


def link_parameters(summaries: DataFrame, params: DataFrame, bindings: DataFrame, aliases: DataFrame, objects: DataFrame,
                    key: str = "row_key") -> ParameterLinks:
    """The linked tables behind resolve_parameters. Values of explicit call arguments win over defaults."""
    open_refs = summaries.where(F.upper(clean("confidence")) == "UNRESOLVED")
    callers = bindings.where((clean("called_process") != "") & (clean("parameter_name") != "")).select(
        norm_key("called_process").alias("_proc"), norm_key("parameter_name").alias("_param"), F.col("resolved_value").alias("_raw"),
        F.col("calling_process"), F.col("line_number").alias("calling_line_number"),
    )
    values = callers.select("_proc", "_param", "_raw").distinct()
    status = values.groupBy("_proc", "_param").agg(F.max(F.col("_raw").isNotNull()).alias("_given"), F.max(F.col("_raw").isNull()).alias("_open"))
    defaults = params.where(clean("default_value") != "").select(
        norm_key("process_name").alias("_proc"), norm_key("parameter_name").alias("_param"), clean("default_value").alias("default_value")
    ).groupBy("_proc", "_param").agg(F.max("default_value").alias("default_value"))
    known = cut(status.join(defaults, ["_proc", "_param"], "full").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_given", "_open")}))
    asked = ("_proc", "_param", "target_type", "alias_expression")
    upstream = _upstream(open_refs.select(key, "process_name", "target_type", "target_expression"), aliases, known)
    upstream = cut(upstream.withColumn("_question", F.md5(F.to_json(F.struct(*asked), {"ignoreNullFields": "false"}))))

    # One row for each question; what it was asked by stays behind.
    questions = upstream.groupBy("_question").agg(*[F.first(c).alias(c) for c in asked], F.count("*").alias("_asked")).join(known, ["_proc", "_param"], "left")
    given = F.coalesce("_given", F.lit(False))
    explicit = questions.where(given).join(values.where(F.col("_raw").isNotNull()), ["_proc", "_param"]).withColumn("source_kind", F.lit("EXECUTE_PROCESS_ARGUMENT"))
    implicit = questions.where(~given & F.col("default_value").isNotNull()).withColumns({
        "_raw": F.col("default_value"), "source_kind": F.when(F.col("alias_expression").isNull(), "PARAMETER_DEFAULT").otherwise("PARAMETER_ALIAS"),
    })
    columns = ["_question", *asked, "source_kind", "_raw"]
    answers = explicit.select(*columns).unionByName(implicit.select(*columns)).withColumn(
        "value", blank_to_null(_evaluate(F.col("alias_expression"), F.col("_param"), F.col("_raw")))
    ).where(F.col("value").isNotNull())
    looked = cut(answers.withColumns({"type_key": norm_key("target_type"), "name_key": norm_key("value")}).join(catalog_index(objects), ["type_key", "name_key"], "left"))
    counted = looked.groupBy("_question").agg(F.count("*").alias("_answers"), F.count("catalog_match_name").alias("_hits"))
    judged = questions.join(counted, "_question", "left").select(
        "_question", "_asked", ((given | F.col("default_value").isNotNull()) & ~F.coalesce("_open", F.lit(False))).alias("_covered"),
        F.coalesce("_answers", F.lit(0)).alias("_answers"), F.coalesce("_hits", F.lit(0)).alias("_hits"),
    )
    references = join_counted(upstream.select(key, "_question", "target_expression"), judged, "_question", "_asked", key).drop("_asked")
    return ParameterLinks(references, looked, callers)


def _contexts(links: ParameterLinks, answers: DataFrame, key: str) -> DataFrame:
    """One row for each reference, value and call behind it: as many as references times calls."""
    called = F.col("source_kind") == "EXECUTE_PROCESS_ARGUMENT"
    at_call = answers.where(called).join(links.callers.where(F.col("_raw").isNotNull()), ["_proc", "_param", "_raw"])
    alone = answers.where(~called).withColumns({"calling_process": F.lit(None).cast("string"), "calling_line_number": F.lit(None).cast("int")})
    rows = links.references.select(key, "_question", "target_expression").join(at_call.unionByName(alone), "_question")
    identity = {"_v": F.col("name_key"), "_c": norm_key("calling_process"), "_l": F.coalesce("calling_line_number", F.lit(-1))}
    return first_wins(rows.withColumns(identity), [key, "_v", "_c", "_l", "_param", "source_kind"], ["value", "_raw"])


def resolve_parameters(summaries: DataFrame, params: DataFrame, bindings: DataFrame, aliases: DataFrame, objects: DataFrame,
                       key: str = "row_key") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summaries, provenance, rejections). Catalog hits are published as RESOLVED rows; the unresolved row stays unless every
    value behind it is known and published. The summaries do not touch the calls; provenance and rejections list each."""
    links = link_parameters(summaries, params, bindings, aliases, objects, key)
    hits = links.answers.where(F.col("catalog_match_name").isNotNull())
    replaced = links.references.groupBy(key).agg(
        F.bool_and("_covered").alias("_covered"), F.sum("_answers").alias("_answers"), F.sum("_hits").alias("_hits")
    ).where(F.col("_covered") & (F.col("_hits") > 0) & (F.col("_hits") == F.col("_answers"))).select(key)
    names = hits.groupBy("_question", "name_key").agg(F.min("catalog_match_name").alias("target_name"))
    published = links.references.where(F.col("_hits") > 0).select(key, "_question").join(names, "_question").groupBy(key, "name_key").agg(F.min("target_name").alias("target_name"))
    derived = summaries.drop("target_name", "confidence").join(published.drop("name_key"), key).withColumn("confidence", F.lit("RESOLVED"))
    result = summaries.join(replaced, key, "left_anti").unionByName(derived.select(*summaries.columns))
    provenance = _contexts(links, hits, key).select(
        key, F.col("catalog_match_name"), "source_kind", "value", "calling_process", "calling_line_number",
        F.col("_param").alias("parameter_name"), "alias_expression", F.col("target_expression").alias("original_target_expression"),
    )
    core = F.lower(clean("target_type")).isin(*CORE_TYPES)
    catalog_status = F.when(core, "CANDIDATE_NOT_IN_OBJECT_CATALOG").otherwise(
        F.coalesce(vocab.lookup(vocab.REJECTION_STATUS_BY_TYPE, norm_key("target_type")), F.lit("TARGET_TYPE_NOT_CATALOGED"))
    )
    rejections = _contexts(links, links.answers.where(F.col("catalog_match_name").isNull()), key).select(
        key, "target_type", "target_expression", F.col("value").alias("candidate_value"), catalog_status.alias("rejection_reason"),
        F.when(core, "CORE_OBJECT").otherwise("DEFERRED_NONCORE").alias("reference_class"), core.alias("requires_quality_exception"), "source_kind",
    )
    return result, provenance, rejections


def parameter_candidates(refs: DataFrame, params: DataFrame, bindings: DataFrame, aliases: DataFrame, key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """(class per unresolved expression, its distinct values with their source). Values come from defaults, call
    arguments and resolved aliases; the class says none, single or a finite set."""
    wanted = refs.select(key, norm_key("process_name").alias("_proc"), norm_key("target_expression").alias("_name"))
    source = lambda df, proc, name, value, kind: df.where(clean(value) != "").select(
        norm_key(proc).alias("_proc"), norm_key(name).alias("_name"), clean(value).alias("value"), F.lit(kind).alias("source_kind")
    )
    values = (
        source(params, "process_name", "parameter_name", "default_value", "PARAMETER_DEFAULT")
        .unionByName(source(bindings, "called_process", "parameter_name", "resolved_value", "EXECUTE_PROCESS_ARGUMENT"))
        .unionByName(source(aliases, "process_name", "variable", "resolved_value", "LOCAL_ALIAS"))
        .groupBy("_proc", "_name", "value").agg(F.array_sort(F.collect_set("source_kind")).alias("source_kinds"), F.count("*").alias("source_count"))
    )
    sizes = values.groupBy("_proc", "_name").agg(
        F.count("*").alias("candidate_count"), F.min("value").alias("_only"), F.sum("source_count").alias("provenance_count")
    )
    n = F.coalesce("candidate_count", F.lit(0))
    classed = wanted.join(sizes, ["_proc", "_name"], "left").select(
        key, F.col("_proc").alias("process_key"), F.col("_name").alias("expression_key"), n.alias("candidate_count"),
        F.when(n == 0, "NO_STATIC_CANDIDATE").when(n == 1, "SINGLE_STATIC_CANDIDATE").otherwise("FINITE_CANDIDATE_SET").alias("resolution_status"),
        F.when(n == 1, F.col("_only")).alias("single_value"), F.coalesce("provenance_count", F.lit(0)).alias("provenance_count"),
    )
    used = values.join(wanted.select("_proc", "_name").distinct(), ["_proc", "_name"], "left_semi")
    return classed, used.select(F.col("_proc").alias("process_key"), F.col("_name").alias("expression_key"), "value", "source_kinds", "source_count")
