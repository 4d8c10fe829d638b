"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions.ids import opt
from ..functions.text import clean, is_blank, norm_key, string_array, token


def filter_scope(df: DataFrame, scope: str = "all", names: DataFrame | None = None, name_col: str = "object_name"):
    """(kept, requested names that do not exist). ``names`` is a one-column table and overrides ``scope``."""
    if scope not in ("regular", "control", "all"):
        raise ValueError(f"unknown scope: {scope}")
    if names is not None:
        wanted = names.select(norm_key(names.columns[0]).alias("_k"), F.col(names.columns[0]).alias("requested_name"))
        keyed = df.withColumn("_k", norm_key(name_col))
        kept = keyed.join(wanted.select("_k").distinct(), "_k", "left_semi").drop("_k")
        absent = wanted.join(keyed.select("_k"), "_k", "left_anti").select("requested_name")
        return kept, absent
    control = F.startswith(clean(name_col), F.lit(vocab.CONTROL_PREFIX))
    flag = F.coalesce(F.col("is_control"), control) if "is_control" in df.columns else control
    kept = df if scope == "all" else df.where(flag if scope == "control" else ~flag)
    return kept, df.sparkSession.createDataFrame([], "requested_name string")


def split_deferred(validations: DataFrame, status: str = "validation_status") -> tuple[DataFrame, DataFrame]:
    """(deferred with their domain, all others)."""
    key = token(status)
    deferred = validations.where(key.isin(*vocab.DEFERRED_DOMAIN)).withColumn("domain", vocab.lookup(vocab.DEFERRED_DOMAIN, key))
    return deferred, validations.where(~key.isin(*vocab.DEFERRED_DOMAIN))


def active_exceptions(df: DataFrame) -> DataFrame:
    """Exceptions that apply to published validations now."""
    applies = F.coalesce(opt(df, "applies_to_validation_records", "boolean"), F.lit(True))
    return df.where(
        norm_key("exception_status").isin("registered", "active") & applies & ~is_blank("target_type") & ~is_blank("target_name")
    )


def require_fields(df: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows lacking a field with the names of what they lack)."""
    missing = F.array_compact(F.array(*[F.when(is_blank(c), F.lit(c)) for c in columns]))
    marked = df.withColumn("missing_fields", missing)
    return marked.where(F.size("missing_fields") == 0).drop("missing_fields"), marked.where(F.size("missing_fields") > 0)


OPERATIONAL_TYPES = vocab.FILE_TYPES + vocab.COMMAND_TYPES + vocab.BRIDGE_TYPES


def filter_types(df: DataFrame, types=OPERATIONAL_TYPES, column: str = "relationship_type") -> DataFrame:
    return df.where(token(column).isin(*types))
