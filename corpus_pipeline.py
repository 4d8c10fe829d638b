"""The corpus pipeline: toxic documents go, one of each class of near duplicates stays, documents with benchmark items go, the sources are
mixed to their weights (documents repeat, or are left out, as the mix says), and the rows are dealt into shards. Each stage is written
as Parquet and read again as the next one's input.

Defined results: rows without text, words or id pass the stages that judge texts, and the near-duplicate stage keeps each of them; the mix
takes them as often as whole repetitions of their source (a source without words is not taken). Repeated rows are near duplicates of each
other; of equal ones any stays. Without labels no document is toxic, without benchmark items none goes, without documents nothing comes
out. Columns of the documents go on unchanged; the last stage replaces those named shard and slot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalog_lineage.llm import decontamination, mixing, neardup, sharding, toxicity
from catalog_lineage.llm.common import cut, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from the labels rejects go."""
    return toxicity.gentle_documents(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return neardup.unique_documents(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each repetition that the mix takes of a document."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return sharding.shard_rows(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mix", mixed),
    ("shard", sharded),
]
#: The learned stage and the searched ones have no SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
