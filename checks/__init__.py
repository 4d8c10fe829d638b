"""Queries over the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog_lineage.operators.window import work_dir

from .roles import role, with_roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The role tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return role(self.spark, self.sf_dir, name)


def check(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; lists become '|'-joined text and small integers bigint."""
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: flat(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_roles(sql)
        return fn
    return wrap


def flat(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which every executor can reach."""
    return f"{work_dir(spark)}/tables-{uuid.uuid4().hex}"


def load() -> None:
    from . import columns, extraction, graphs, joins, rows, rules  # noqa: F401
