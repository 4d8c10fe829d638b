"""First-wins, duplicates, ordinals, ranks and top-k, written so that one hot key cannot fill a task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.text import clean, col, norm_key

HOT_KEY_ROWS = 1_000_000
SPLITTERS = 64
HOT_PARTS = 256
#: Least parts of rows that are dealt by key; up to so many are written without a sort in memory.
DEALT_PARTS = 200


def work_dir(spark: SparkSession) -> str:
    """The shared folder for tables between steps: spark.checkpoint.dir, or the checkpoint folder set on the context. Only plain
    local mode, one process, may do without."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    made = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared folder: computed once, written compressed, of known size. Gone when the driver ends."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/cut-{uuid.uuid4().hex}"
    void = [f.name for f in df.schema.fields if f.dataType.typeName() == "void"]
    df.withColumns({c: F.col(f"`{c}`").cast("string") for c in void}).write.parquet(path) if void else df.write.parquet(path)
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(made)
    written = spark.read.parquet(path)
    return written.withColumns({c: F.lit(None) for c in void}) if void else written


def dealt_parts(df: DataFrame) -> int:
    """Into how many parts rows are dealt that are grouped or joined where they lie. The number is given, as that needs much more memory
    than the shuffled bytes by which adaptive execution would join parts."""
    return max(DEALT_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _columns(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def first_wins(df: DataFrame, keys, order) -> DataFrame:
    """First row of each key in the given order. An aggregate, so each key shrinks before the shuffle."""
    keys, order = _columns(keys), _columns(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def first_wins_by_name(df: DataFrame, columns, order) -> DataFrame:
    """first_wins on normalised text keys; rows with a blank key are left out."""
    columns = _columns(columns)
    staged = df.withColumns({f"_k{i}": norm_key(c) for i, c in enumerate(columns)})
    for i in range(len(columns)):
        staged = staged.where(F.col(f"_k{i}") != "")
    keys = [f"_k{i}" for i in range(len(columns))]
    return first_wins(staged, keys, order).drop(*keys)


def join_counted(rows: DataFrame, groups: DataFrame, keys, count: str, spread, hot_rows: int = 10_000) -> DataFrame:
    """Rows joined with the one row of their key in ``groups``, which also counts them.

    A key with more than one part in HOT_PARTS of all rows is cut into as many parts as it is larger: its row in ``groups`` is
    repeated for each part, and its rows are dealt to the parts by a hash of the columns ``spread``. There are at most HOT_PARTS such
    keys, so they are broadcast.
    """
    keys, spread = _columns(keys), _columns(spread)
    limit = F.greatest(F.col("_all") / HOT_PARTS, F.lit(hot_rows))
    everything = F.broadcast(groups.agg(F.sum(count).alias("_all")))
    hot = groups.select(*keys, count).crossJoin(everything).where(F.col(count) > limit).select(*keys, F.ceil(F.col(count) / limit).cast("int").alias("_parts"))
    marked = lambda df: df.join(F.broadcast(hot), keys, "left")
    left = marked(rows).withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*spread), "_parts"), F.lit(0)).cast("int")).drop("_parts")
    right = marked(groups).withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, [*keys, "_part"]).drop("_part")


def split_duplicates(df: DataFrame, keys, order) -> tuple[DataFrame, DataFrame]:
    """(kept, later duplicates). ``order`` must tell the rows of a key apart."""
    keys, order = _columns(keys), _columns(order)
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_n"))
    marked = join_counted(df, firsts, keys, "_n", order)
    is_first = F.struct(*order) == F.col("_first")
    return (
        marked.where(is_first).select(*df.columns),
        marked.where(~is_first).select(*df.columns),
    )


def _in_ranges(df: DataFrame, keys: list[str], order: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame] | None:
    """(rows of the keys above ``hot_rows`` with their ``_range``, rows of all other keys), or None when no key is that large.

    Keys are counted first. A hot key is cut into ranges by splitters taken from a hash sample of its own order values, at least
    SPLITTERS of them and one for each ``hot_rows`` rows, so that no range is as large as the key. Rows of equal order share a range.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    if counted.isEmpty():
        return None
    hot, shape = cut(counted), F.struct(*order)
    rows = df.join(hot, keys)
    step = F.greatest(F.floor(F.col("_n") / F.greatest(F.lit(SPLITTERS), F.col("_n") / hot_rows)), F.lit(1)).cast("bigint")
    splitters = rows.where(F.pmod(F.xxhash64(*order), step) == 0).groupBy(*keys).agg(F.array_sort(F.collect_set(shape)).alias("_splits"))
    ranged = cut(rows.drop("_n").join(splitters, keys, "left").withColumn(
        "_range", F.coalesce(F.size(F.filter("_splits", lambda s: s <= shape)), F.lit(0))
    ).drop("_splits"))
    return ranged, df.join(hot.select(*keys), keys, "left_anti")


def ordinals(df: DataFrame, keys, order, name: str = "ordinal", hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """1-based position of every row in its key.

    Keys above ``hot_rows`` are cut into ranges, so that no task sorts a whole hot key; positions continue across the ranges.
    ``order`` must be a total order without nulls; feed a table that is cheap to read again.
    """
    keys, order = _columns(keys), _columns(order)
    plain = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    split = _in_ranges(df, keys, order, hot_rows)
    if split is None:
        return df.withColumn(name, plain)
    ranged, cold = split
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_n")).withColumn(
        "_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))
    ).drop("_n")
    local = ranged.withColumn("_local", F.row_number().over(W.partitionBy(*keys, "_range").orderBy(*order)))
    placed = local.join(offsets, [*keys, "_range"]).withColumn(name, (F.col("_local") + F.col("_offset")).cast("int"))
    return cold.withColumn(name, plain).select(*df.columns, name).unionByName(placed.select(*df.columns, name))


def sample_per_group(df: DataFrame, group, order, n: int, salt: int = 32) -> DataFrame:
    """First n rows of each group: n per salted part first, then n of those."""
    group, order = _columns(group), _columns(order)
    part = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salt)))
    inner = part.withColumn("_rn", F.row_number().over(W.partitionBy(*group, "_salt").orderBy(*order))).where(F.col("_rn") <= n)
    outer = inner.withColumn("sample_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("sample_rank") <= n)
    return outer.drop("_salt", "_rn")


def richest(df: DataFrame, key: str, order) -> DataFrame:
    """On equal keys keep the row with more filled fields, the earlier one on ties."""
    filled = sum([F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in df.columns], F.lit(0))
    staged = df.withColumn("_missing", -filled)
    return first_wins(staged, key, ["_missing", *_columns(order)]).drop("_missing")


def merge_properties(df: DataFrame, key: str, properties: str, order) -> DataFrame:
    """On equal keys lay later properties over earlier ones."""
    order = _columns(order)
    flat = df.select(key, *order, F.explode(properties).alias("_name", "_value"))
    latest = flat.groupBy(key, "_name").agg(F.max_by("_value", F.struct(*order)).alias("_value"))
    return latest.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("_name", "_value")))).alias(properties)
    )


def check_positions(df: DataFrame, group, position: str, member: str, start: int = 1) -> DataFrame:
    """One row per group: positions run from ``start`` without gap or repeat and no member repeats."""
    group = _columns(group)
    by_position = df.groupBy(*group, position).agg(F.count("*").alias("_n"))
    by_member = df.groupBy(*group, F.col(member).alias("_m")).agg(F.count("*").alias("_n"))
    left = by_position.groupBy(*group).agg(
        F.sum("_n").alias("row_count"),
        (F.sum("_n") - F.count("*")).alias("duplicate_positions"),
        ((F.min(position) == start) & (F.max(position) == F.count("*") + start - 1)).alias("_covers"),
    )
    right = by_member.groupBy(*group).agg((F.sum("_n") - F.count("*")).alias("duplicate_members"))
    return left.join(right, group).select(
        *group, "row_count", "duplicate_positions", "duplicate_members",
        (F.col("_covers") & (F.col("duplicate_positions") == 0)).alias("continuous"),
        (F.col("_covers") & (F.col("duplicate_positions") == 0) & (F.col("duplicate_members") == 0)).alias("pass"),
    )


def identity_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, missing ids, ids that occur more than once and the surplus rows."""
    per_id = df.groupBy(clean(key).alias("_id")).agg(F.count("*").alias("_n"))
    named = F.col("_id") != ""
    return per_id.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(~named, F.col("_n"))), F.lit(0)).alias("missing_ids"),
        F.count_if(named & (F.col("_n") > 1)).alias("duplicate_ids"),
        F.coalesce(F.sum(F.when(named, F.col("_n") - 1)), F.lit(0)).alias("surplus_rows"),
    ).withColumn("pass", (F.col("missing_ids") == 0) & (F.col("duplicate_ids") == 0))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Non-blank ids with more than one row. Hardly any repeats, so rows are dealt by id before they are counted: no hash table fills up
    over a whole input split."""
    return df.select(key).repartition(dealt_parts(df), key).groupBy(key).agg(F.count("*").alias("row_count")).where((F.col("row_count") > 1) & (clean(key) != ""))


def top_k(df: DataFrame, column: str, k: int, first_position: str | None = None) -> DataFrame:
    """The k most frequent values; equal counts go by first position, else by value."""
    tie = F.min(first_position) if first_position else F.min(column)
    counted = df.groupBy(column).agg(F.count("*").alias("relationship_count"), tie.alias("_tie"))
    return counted.orderBy(F.desc("relationship_count"), "_tie", column).limit(k).drop("_tie")


def search(nodes: DataFrame, text: str, node_type: str | None = None, limit: int = 25, offset: int = 0,
           label: str = "label", node_id: str = "node_id", type_col: str = "node_type") -> DataFrame:
    """Page of nodes whose label or id holds the text: exact label, then label, then id hits, with the total and the hits of each
    type before the type filter. A page past the last hit is one row with the counts alone."""
    needle = " ".join(text.split()).lower()
    low = F.lower(col(label))
    hits = nodes.where(F.contains(F.concat_ws(" ", low, F.lower(col(node_id))), F.lit(needle)))
    facet = type_facet(hits, type_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("node_type", "node_count")))).alias("type_counts"))
    if node_type:
        hits = hits.where(F.upper(col(type_col)) == node_type.upper())
    scored = hits.withColumn(
        "score", F.when(low == needle, 0).when(F.contains(low, F.lit(needle)), 1).otherwise(2)
    )
    page = scored.orderBy("score", low, node_id).offset(offset).limit(max(1, min(limit, 500)))
    counts = hits.agg(F.count("*").alias("total")).crossJoin(F.broadcast(facet))
    return counts.join(F.broadcast(page), F.lit(True), "left").select(*page.columns, "total", "type_counts")


def type_facet(nodes: DataFrame, type_col: str = "node_type") -> DataFrame:
    """How many nodes there are of each type, of which there are few."""
    return nodes.groupBy(F.upper(col(type_col)).alias("node_type")).agg(F.count("*").alias("node_count"))


def asof_last(df: DataFrame, keys, order: str, is_set: Column, value: Column, name: str = "value_at_use",
              bucket_width: int | None = None, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """For every row the value of the last earlier-or-equal setting row of its key; a null setting clears it.

    Keys above ``hot_rows`` are cut into ranges of the order column, or all keys into buckets of ``bucket_width`` where that is given:
    the last setting of each range is aggregated, carried forward over one row for each range, and rows are windowed inside their
    range. A hot key then spreads over as many tasks as it has ranges. Without a width, feed a table that is cheap to read again.
    """
    keys = _columns(keys)
    if bucket_width is not None:
        return _carried_last(df.withColumn("_range", F.floor(col(order) / bucket_width)), keys, order, is_set, value, name)
    run = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    plain = F.last(F.when(is_set, F.struct(value.alias("v"))), ignorenulls=True).over(run)["v"]
    split = _in_ranges(df, keys, [order], hot_rows)
    if split is None:
        return df.withColumn(name, plain)
    ranged, cold = split
    hot = _carried_last(ranged, keys, order, is_set, value, name)
    return cold.withColumn(name, plain).select(*df.columns, name).unionByName(hot.select(*df.columns, name))


def _carried_last(ranged: DataFrame, keys: list[str], order: str, is_set: Column, value: Column, name: str) -> DataFrame:
    """asof_last inside each ``_range``, with the last setting of the ranges before it."""
    staged = ranged.withColumn("_boxed", F.when(is_set, F.struct(value.alias("v"))))
    ends = staged.groupBy(*keys, "_range").agg(F.max_by("_boxed", F.when(is_set, col(order))).alias("_end"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        *[col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"), F.last("_end", ignorenulls=True).over(earlier).alias("_carry")
    )
    run = W.partitionBy(*keys, "_range").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    local = staged.withColumn("_seen", F.last("_boxed", ignorenulls=True).over(run))
    same = F.col("_range").eqNullSafe(F.col("_at"))
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(carried, same, "left").withColumn(name, F.coalesce("_seen", "_carry")["v"]).drop(
        "_range", "_at", "_boxed", "_seen", "_carry", *[f"_k{i}" for i in range(len(keys))]
    )
