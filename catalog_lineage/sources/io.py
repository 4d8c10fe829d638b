"""Reading record tables, publishing snapshots, reading the promoted one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import clean
from ..operators.summarize import manifest as run_manifest
from ..vocab import literal_table


class SnapshotError(RuntimeError):
    pass


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whichever file system it names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _struct(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_records(spark: SparkSession, path: str, schema, wrapper_keys=(), required: bool = True, lines: bool = False) -> DataFrame:
    """Records from Parquet, or from JSON that is an array, or an object holding the array under one of the keys.

    Entries that are not objects fail the read. An optional table that is missing has no rows.
    """
    fields = _struct(schema)
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], fields)
    if not path.endswith((".json", ".jsonl")):
        return spark.read.schema(fields).parquet(path)
    wrapped = T.StructType(list(fields) + [T.StructField(k, T.ArrayType(fields)) for k in wrapper_keys])
    raw = spark.read.schema(wrapped).option("mode", "FAILFAST").option("multiLine", not lines).json(path)
    if not wrapper_keys:
        return raw
    own = F.array(F.struct(*[f.name for f in fields]))
    return raw.select(F.inline(F.coalesce(*wrapper_keys, own)))


def read_preferred(spark: SparkSession, paths, schema, wrapper_keys=()) -> tuple[DataFrame, DataFrame]:
    """(table, warnings): the first path that exists; using a later one, or none, is a warning row."""
    paths = list(paths)
    found = next((i for i, p in enumerate(paths) if exists(spark, p)), None)
    empty = spark.createDataFrame([], "warning_type string, message string")
    if found is None:
        warning = literal_table(spark, "warning_type string, message string", [("MISSING_INPUT", f"No input found: {', '.join(paths)}")])
        return spark.createDataFrame([], _struct(schema)), warning
    df = read_records(spark, paths[found], schema, wrapper_keys)
    if found == 0:
        return df, empty
    return df, literal_table(spark, "warning_type string, message string", [("LEGACY_INPUT_USED", f"{paths[found]} was used instead of {paths[0]}")])


#: Order of published tables, and the columns by which single rows are looked up. The order of edges ends with their id, so that the
#: edges of one popular source are still dealt to several files.
LAYOUT = {
    "nodes": (("node_id",), ("node_id",)),
    "edges": (("source_id", "graph_relationship_id"), ("source_id", "target_id", "graph_relationship_id")),
    "validations": (("graph_relationship_id",), ("graph_relationship_id",)),
    "provenance": (("graph_relationship_id",), ("graph_relationship_id",)),
}
ROW_GROUP_BYTES = 16 << 20


def write_laid_out(df: DataFrame, path: str, order=(), lookups=(), row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Writes a table in ranges of ``order``, sorted within, with a Bloom filter for each lookup column in every row group. A lookup by
    an order column skips row groups by their limits, one by another column by the filters. Columns that are not there are passed over."""
    order, lookups = ([c for c in names if c in df.columns] for names in (order, lookups))
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = df.write.mode("errorifexists").option("parquet.block.size", row_group_bytes).option("parquet.bloom.filter.adaptive.enabled", True)
    for c in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True)
    writer.parquet(path)


def publish(outputs: dict[str, DataFrame], errors: DataFrame, root: str, snapshot_id: str, promote: bool = True) -> DataFrame:
    """Write every table of a run under its snapshot id and return its manifest.

    A run without errors is COMPLETE and, if asked, becomes current by one appended pointer row; a run with errors is
    PARTIAL and leaves the current snapshot alone. Counts come from what was written, not from a second computation.
    """
    spark = errors.sparkSession
    base = f"{root}/snapshot={snapshot_id}"
    for name, df in {**outputs, "errors": errors}.items():
        write_laid_out(df, f"{base}/{name}", *LAYOUT.get(name, ()))
    written = {name: (spark.read.parquet(f"{base}/{name}"), None) for name in outputs}
    run_manifest(written, spark.read.parquet(f"{base}/errors"), snapshot_id, promote).write.mode("errorifexists").parquet(f"{base}/manifest")
    result = spark.read.parquet(f"{base}/manifest")
    pointer = result.where("published_current").select("snapshot_id", F.current_timestamp().alias("promoted_at"))
    if not pointer.isEmpty():
        pointer.coalesce(1).write.mode("append").parquet(f"{root}/pointer")
    return result


def current_snapshot(spark: SparkSession, root: str) -> str:
    if not exists(spark, f"{root}/pointer"):
        raise SnapshotError(f"nothing was promoted under {root}")
    return spark.read.parquet(f"{root}/pointer").orderBy(F.desc("promoted_at"), F.desc("snapshot_id")).head()["snapshot_id"]


def read_current(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    """Tables of the promoted snapshot; refused unless it is COMPLETE, promoted and free of errors."""
    base = f"{root}/snapshot={current_snapshot(spark, root)}"
    state = spark.read.parquet(f"{base}/manifest").head()
    if state["status"] != "COMPLETE":
        raise SnapshotError("manifest status must be COMPLETE")
    if not state["published_current"]:
        raise SnapshotError("snapshot must be promoted")
    if state["error_count"] != 0:
        raise SnapshotError("manifest error_count must be zero")
    return {name: spark.read.parquet(f"{base}/{name}") for name in names}


def review_rows(df: DataFrame, columns) -> DataFrame:
    """The review columns, arrays joined by ' | '."""
    kinds = dict(df.dtypes)
    flat = lambda c: F.array_join(c, " | ") if kinds.get(c, "").startswith("array") else F.col(c)
    return df.select(*[(flat(c) if c in kinds else F.lit(None).cast("string")).alias(c) for c in columns])


def write_review_csv(df: DataFrame, path: str, columns, decision: str | None = "decision_type") -> None:
    rows = df.where(F.upper(clean(decision)) == "REVIEW") if decision else df
    review_rows(rows, columns).write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
