"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import vocab
from ..functions.ids import opt
from ..functions.text import blank_to_null, clean, col, expression_pattern, norm_key, positive_int, token
from .window import cut, dealt_parts, ordinals

ADJACENCY_CHUNK = 100_000


def percent(part: Column, total: Column, empty: float = 100.0) -> Column:
    return F.when(total > 0, F.round(F.lit(100.0) * part / total, 2)).otherwise(F.lit(empty))


def _distinct(c: Column) -> Column:
    """Sorted distinct non-blank values. Repeats vanish before the shuffle."""
    return F.array_sort(F.collect_set(c))


def summarize_evidence(evidence: DataFrame) -> DataFrame:
    """One row per (source, relationship, target): strongest rating, count, where it was seen, the expression if unique."""
    keys = ["process_name", "relationship_type", "target_type", "target_name"]
    rank = vocab.lookup(vocab.CONFIDENCE_RANK, F.col("confidence"))
    grouped = evidence.groupBy(*keys).agg(
        F.max_by("confidence", rank).alias("confidence"),
        F.count("*").alias("reference_count"),
        _distinct(F.col("procedure")).alias("procedures"),
        _distinct(F.col("function_name")).alias("functions"),
        _distinct(F.col("line_number")).alias("evidence_lines"),
        _distinct(blank_to_null("target_expression")).alias("target_expressions"),
    )
    return grouped.withColumn("target_expression", F.when(F.size("target_expressions") == 1, F.col("target_expressions")[0]))


def summarize_rules(evidence: DataFrame) -> DataFrame:
    """The same for rules, on eight columns; nulls group together."""
    keys = ["source_cube", "relationship_type", "target_object_type", "target_name", "function_name", "dimension_name", "hierarchy_name", "attribute_name"]
    rank = vocab.lookup(vocab.RULE_CONFIDENCE_RANK, F.col("confidence"))
    grouped = evidence.groupBy(*keys).agg(
        F.count("*").alias("evidence_count"),
        F.min("line_number").alias("first_line"),
        F.min_by("confidence", rank).alias("confidence"),
        _distinct(blank_to_null("target_expression")).alias("target_expressions"),
    )
    return grouped.withColumn("target_expression", F.when(F.size("target_expressions") == 1, F.col("target_expressions")[0]))


def consolidate(edges: DataFrame, key="relationship_id", first=(), dealt: bool = False) -> DataFrame:
    """One row per relationship id: reference count is the sum, over distinct evidence, of the largest count seen. Of the columns
    ``first`` it has the least row. ``dealt`` rows lie by relationship already."""
    lists, keys = ["functions", "procedures", "evidence_lines"], [key] if isinstance(key, str) else list(key)
    # Rows are dealt by relationship once, so both groupings run where the rows are: no hash table fills up over a whole input split,
    # in which hardly any row repeats. The number of parts is given, as the grouping needs much more memory than its shuffled bytes.
    rows = edges.select(*keys, "discovery_method", "reference_count", *[F.when(F.size(c) > 1, F.array_sort(c)).otherwise(F.col(c)).alias(c) for c in lists], *first)
    rows = rows if dealt else rows.repartition(dealt_parts(edges), *keys)
    signature = ["discovery_method", *lists]
    least = [F.min(F.struct(*first)).alias("_first")] if first else []
    # Repeats vanish in the set. Most relationships have one row, which stays as it is.
    found = rows.groupBy(*keys).agg(F.collect_set(F.struct(*signature, "reference_count")).alias("_set"), F.count("*").alias("aggregated_row_count"), *least).withColumn(
        "_items", F.when(F.size("_set") == 1, F.col("_set")).otherwise(F.array_sort("_set"))).drop("_set")
    items, alone = F.col("_items"), F.size("_items") == 1
    only = F.get(items, F.lit(0))
    of = lambda item: F.struct(*[item[c] for c in signature])
    # items are in order, so the largest count of a signature is in its last one
    largest = F.transform(items, lambda x, i: F.when(of(x).eqNullSafe(of(F.get(items, i + 1))), F.lit(None)).otherwise(x["reference_count"]))
    total = F.aggregate(F.array_compact(largest), F.lit(None).cast("bigint"), lambda a, x: F.coalesce(a + x, x.cast("bigint")))
    plain = lambda c: alone & (F.size(only[c]) == 1) & F.get(only[c], F.lit(0)).isNotNull()
    listed = lambda c: F.when(plain(c), only[c]).otherwise(F.array_sort(F.array_compact(F.array_distinct(F.flatten(F.array_compact(F.transform(items, lambda x: x[c])))))))
    methods = F.array_sort(F.array_distinct(F.array_compact(F.transform(items, lambda x: x["discovery_method"]))))
    gathered = found.select(
        *keys, F.when(alone, only["reference_count"].cast("bigint")).otherwise(total).alias("reference_count"), "aggregated_row_count",
        F.when(alone & only["discovery_method"].isNotNull(), F.array(only["discovery_method"])).otherwise(methods).alias("discovery_methods"),
        *[listed(c).alias(c) for c in lists], *(["_first"] if first else []),
    )
    some = sum([F.size(c) for c in lists], F.lit(0)) > 0
    shown = gathered.withColumns({c: F.when(some, F.col(c)) for c in lists})
    return shown.select("*", "_first.*").drop("_first") if first else shown


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, blank ones under one label, sorted by value."""
    label = F.coalesce(F.nullif(F.upper(clean(column)), F.lit("")), F.lit("<BLANK>"))
    return df.groupBy(label.alias("value")).agg(F.count("*").alias("row_count")).orderBy("value")


def distributions(df: DataFrame, sets) -> DataFrame:
    """Counts over several column sets in one pass: the set, its values joined by ', ', and the rows."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    labelled = df.select(*[F.coalesce(blank_to_null(c), F.lit("<BLANK>")).alias(c) for c in columns])
    counted = labelled.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id(*columns).alias("_gid"), F.count("*").alias("row_count")
    )
    name = F.lit(None).cast("string")
    for s in sets:
        gid = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        name = F.when(F.col("_gid") == gid, F.lit("+".join(s))).otherwise(name)
    return counted.select(name.alias("distribution"), F.concat_ws(", ", *columns).alias("value"), "row_count")


def backlog(relationships: DataFrame, validations: DataFrame, resolved=("VALID",)) -> DataFrame:
    """Relationships with their last status, domain and weight, and whether they count as resolved."""
    order = ["validation_seq"] if "validation_seq" in validations.columns else ["validation_status"]
    last = (
        validations.where(clean("relationship_id") != "").groupBy("relationship_id")
        .agg(F.max_by(token("validation_status"), F.struct(*order)).alias("status"))
    )
    kind = F.coalesce(F.nullif(F.lower(clean("target_type")), F.lit("")), F.lit("unknown"))
    return relationships.join(last, "relationship_id", "left").withColumns({
        "status": F.coalesce("status", F.lit("NOT_CROSS_CHECKED")),
        "target_type": kind,
        "resolution_domain": F.coalesce(vocab.lookup(vocab.DOMAIN_BY_TARGET_TYPE, kind), F.concat(F.lit("OTHER_"), F.upper(kind))),
        "reference_count": positive_int("reference_count"),
    }).withColumn("is_resolved", F.col("status").isin(*resolved))


def resolution_metrics(rated: DataFrame) -> DataFrame:
    total, resolved = F.count("*"), F.count_if(F.col("is_resolved"))
    literal = F.count_if(~F.col("is_resolved") & (F.col("status") == "NOT_YET_CATALOGED"))
    return rated.agg(
        total.alias("total_relationships"), resolved.alias("resolved_relationships"),
        (total - resolved).alias("backlog_relationships"),
        percent(resolved, total).alias("resolution_rate_percent"),
        percent(resolved + literal, total).alias("potential_rate_percent"),
        F.count_if(F.col("status") == "UNRESOLVED_DYNAMIC_REFERENCE").alias("dynamic_relationships"),
        literal.alias("literal_not_yet_cataloged"),
    )


def resolution_profile(rated: DataFrame, target: str = "target_qualified_name") -> DataFrame:
    """Per domain of the backlog: count, distinct targets, weighted count, share and possible uplift."""
    totals = rated.agg(F.count("*").alias("_all"), F.count_if(~F.col("is_resolved")).alias("_open"))
    per_target = (
        rated.where(~F.col("is_resolved")).groupBy("resolution_domain", F.lower(clean(target)).alias("_t"))
        .agg(F.count("*").alias("_n"), F.sum("reference_count").alias("_w"))
    )
    per_domain = per_target.groupBy("resolution_domain").agg(
        F.sum("_n").alias("relationship_count"), F.count("*").alias("distinct_target_count"), F.sum("_w").alias("reference_weighted_count")
    )
    return per_domain.crossJoin(F.broadcast(totals)).select(
        F.col("resolution_domain").alias("domain"), "relationship_count", "distinct_target_count", "reference_weighted_count",
        percent(F.col("relationship_count"), F.col("_open")).alias("share_of_backlog_percent"),
        percent(F.col("relationship_count"), F.col("_all"), 0.0).alias("maximum_resolution_uplift_points"),
    )


def chunked_lists(df: DataFrame, keys, value: str, name: str, chunk_rows: int = ADJACENCY_CHUNK, repeats: bool = False) -> DataFrame:
    """Sorted distinct values of each key, or with ``repeats`` all its values, in numbered chunks so that no row holds an unbounded list.

    Most keys have the single chunk 0; a key with more than ``chunk_rows`` values has as many as it needs.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = df.select(*keys, value).dropna(subset=keys)
    listed = F.array_sort(F.collect_list(value) if repeats else F.collect_set(value)).alias(name)
    # only keys with more rows than a chunk can have more values than a chunk, and there are few of them
    large = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > chunk_rows).select(*keys))
    if large.isEmpty():
        return rows.groupBy(*keys, F.lit(0).cast("bigint").alias("chunk")).agg(listed)
    pairs = rows.join(large, keys, "left_semi")
    pairs = cut(pairs if repeats else pairs.distinct())
    # chunks follow the order of the values, which no task sees whole
    valued = pairs.where(F.col(value).isNotNull())
    placed = ordinals(valued, keys, value, "_at").withColumn("chunk", F.floor((F.col("_at") - 1) / chunk_rows).cast("bigint"))
    without = large.join(valued.select(*keys).distinct(), keys, "left_anti").withColumn(value, F.lit(None).cast(df.schema[value].dataType))
    small = rows.join(large, keys, "left_anti").unionByName(without).groupBy(*keys, F.lit(0).cast("bigint").alias("chunk")).agg(listed)
    return small.unionByName(placed.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(value)).alias(name)))


PROVENANCE_FIELDS = (
    "source_graph_relationship_ids", "source_artifacts", "source_record_ids", "source_snapshot_ids", "source_validation_ids", "semantic_validation_ids",
)


def merge_provenance(edges: DataFrame, key: str = "object_relationship_id", fields=PROVENANCE_FIELDS, chunk_rows: int = ADJACENCY_CHUNK) -> DataFrame:
    """One row per consolidated edge: the distinct values of each field over all contributing edges, and the evidence count, which is the
    number of values of the first field. Only an edge with more values of a field than a chunk has more rows, numbered by ``chunk``.
    Fields that ``edges`` does not have are empty."""
    fields, none = list(fields), F.array().cast("array<string>")
    held = lambda f: F.filter(F.coalesce(F.col(f).cast("array<string>"), none), lambda x: clean(x) != "") if f in edges.columns else none
    rows = edges.where(F.col(key).isNotNull()).select(key, *[held(f).alias(f) for f in fields])
    values = sum([F.size(f) for f in fields], F.lit(0))
    large = cut(rows.groupBy(key).agg(F.sum(values).alias("_n")).where(F.col("_n") > chunk_rows).select(key))
    some = not large.isEmpty()
    # each edge meets its contributions once, where they are dealt
    small = (rows.join(large, key, "left_anti") if some else rows).repartition(dealt_parts(edges), key)
    merged = small.groupBy(key, F.lit(0).cast("bigint").alias("chunk")).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(f)))).alias(f) for f in fields])
    merged = merged.withColumn("evidence_count", F.size(fields[0]).cast("bigint"))
    if not some:
        return merged
    item = lambda f: F.transform(f, lambda x: F.struct(F.lit(f).alias("field"), x.alias("value")))
    flat = rows.join(large, key, "left_semi").select(key, F.explode(F.concat(*[item(f) for f in fields])).alias("i")).select(key, "i.*")
    lists = cut(chunked_lists(flat, [key, "field"], "value", "values", chunk_rows))
    counts = lists.groupBy(key).agg(F.sum(F.when(F.col("field") == fields[0], F.size("values")).otherwise(0)).cast("bigint").alias("evidence_count"))
    chunks = lists.groupBy(key, "chunk").agg(*[F.coalesce(F.first(F.when(F.col("field") == f, F.col("values")), ignorenulls=True), none).alias(f) for f in fields])
    return merged.unionByName(chunks.join(counts, key))


def evidence_counts(edges: DataFrame, key: str = "object_relationship_id", edge_id: str = "graph_relationship_id") -> DataFrame:
    return edges.select(key, edge_id).distinct().groupBy(key).agg(F.count(edge_id).alias("evidence_count"))


def adjacency(edges: DataFrame, edge_id: str = "graph_relationship_id", chunk_rows: int = ADJACENCY_CHUNK) -> tuple[DataFrame, DataFrame]:
    """(outbound, inbound) lists of edge ids per node, in chunks."""
    present = edges.where((clean("source_id") != "") & (clean("target_id") != "") & (clean(edge_id) != ""))
    side = lambda end: chunked_lists(present.select(F.col(end).alias("node_id"), edge_id), "node_id", edge_id, "edge_ids", chunk_rows)
    return side("source_id"), side("target_id")


def ranked_values(df: DataFrame, column: str, ranks: dict[str, Column], levels: int = 3, width: int = 2048) -> DataFrame:
    """Exact values at given 0-based ranks of one numeric column, one row per rank.

    Each level counts the rows in ``width`` equal parts of the range still open around a rank and keeps the part that
    holds it, so nothing is sorted or collected whole; the last level counts distinct values inside that part.
    """
    spark = df.sparkSession
    values = df.select(col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    stats = values.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    wanted = F.array(*[F.struct(F.lit(k).alias("rank_name"), r.cast("bigint").alias("rank")) for k, r in ranks.items()])
    open_parts = stats.select("lo", "hi", F.explode(wanted).alias("r")).select("r.*", "lo", "hi", F.lit(0).cast("bigint").alias("below"))
    for _ in range(levels):
        step = F.greatest((F.col("hi") - F.col("lo")) / width, F.lit(0.0))
        part = F.when(step > 0, F.least(F.floor((F.col("x") - F.col("lo")) / step), F.lit(width - 1))).otherwise(F.lit(0))
        inside = values.join(F.broadcast(open_parts), (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        counts = inside.groupBy("rank_name", "rank", "below", part.alias("part")).agg(
            F.count("*").alias("rows_in"), F.min("x").alias("lo"), F.max("x").alias("hi")
        )
        upto = F.sum("rows_in").over(W.partitionBy("rank_name").orderBy("part"))
        open_parts = (
            counts.withColumn("upto", F.col("below") + upto)
            .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("rows_in")))
            .select("rank_name", "rank", "lo", "hi", (F.col("upto") - F.col("rows_in")).alias("below"))
        )
    inside = values.join(F.broadcast(open_parts), (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
    counts = inside.groupBy("rank_name", "rank", "below", "x").agg(F.count("*").alias("rows_in"))
    upto = F.sum("rows_in").over(W.partitionBy("rank_name").orderBy("x"))
    return (
        counts.withColumn("upto", F.col("below") + upto)
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("rows_in")))
        .select("rank_name", F.col("x").alias("value"))
    )


def duration_metrics(df: DataFrame, column: str, slow: float) -> DataFrame:
    """Mean, median, nearest-rank p95 (half to even), maximum and the number of slow requests."""
    x = col(column).cast("double")
    basic = df.agg(
        F.count(x).alias("request_count"), F.coalesce(F.round(F.avg(x), 6), F.lit(0.0)).alias("mean_seconds"),
        F.coalesce(F.round(F.max(x), 6), F.lit(0.0)).alias("maximum_seconds"), F.count_if(x > slow).alias("slow_request_count"),
    )
    n = F.col("n")
    ranks = ranked_values(df, column, {
        "lower": F.floor((n - 1) / 2), "upper": F.floor(n / 2), "p95": F.rint((n - 1) * F.lit(0.95)),
    })
    pick = lambda name: F.max(F.when(F.col("rank_name") == name, F.col("value")))
    located = ranks.agg(
        F.coalesce(F.round((pick("lower") + pick("upper")) / 2, 6), F.lit(0.0)).alias("median_seconds"),
        F.coalesce(F.round(pick("p95"), 6), F.lit(0.0)).alias("p95_seconds"),
    )
    return basic.crossJoin(F.broadcast(located))


def dynamic_profile(validations: DataFrame, statuses=("UNRESOLVED_DYNAMIC_REFERENCE",), source: str = "source_name") -> DataFrame:
    """Unresolved references by shape of expression: count, sources, five example sources, example, action."""
    text = F.coalesce(blank_to_null("target_expression"), F.lit("<missing expression>"))
    rows = validations.where(F.upper(clean("validation_status")).isin(*statuses)).select(
        expression_pattern(text).alias("expression_pattern"), norm_key(text).alias("_key"), text.alias("_text"),
        F.coalesce(blank_to_null("relationship_type"), F.lit("<missing relationship type>")).alias("relationship_type"),
        F.coalesce(blank_to_null(source), F.lit("<missing source>")).alias("_source"),
    )
    keys = ["expression_pattern", "_key", "relationship_type"]
    per_source = rows.groupBy(*keys, "_source").agg(F.count("*").alias("_n"), F.min("_text").alias("_text"))
    totals = per_source.groupBy(*keys).agg(
        F.sum("_n").alias("row_count"), F.count("*").alias("distinct_sources"), F.min("_text").alias("example_expression"),
    )
    from .window import sample_per_group
    examples = sample_per_group(per_source, keys, "_source", 5).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list("_source")), "; ").alias("example_sources")
    )
    return totals.join(examples, keys).select(
        "row_count", "expression_pattern", "relationship_type", "example_expression", "distinct_sources", "example_sources",
        vocab.lookup(vocab.SUGGESTED_ACTIONS, F.col("expression_pattern")).alias("candidate_action"),
    )


def signature_conflicts(df: DataFrame, key: str, signature) -> DataFrame:
    """Ids that stand for more than one signature."""
    return df.select(key, *signature).distinct().groupBy(key).agg(F.count("*").alias("signature_count")).where("signature_count > 1")


def manifest(tables: dict[str, tuple[DataFrame, str | None]], errors: DataFrame, snapshot_id: str, promote: bool = True) -> DataFrame:
    """One row: counts of each table, counts per type, status and whether it may become current."""
    row = errors.agg(F.count("*").alias("error_count")).withColumn("snapshot_id", F.lit(snapshot_id))
    for name, (df, type_col) in tables.items():
        row = row.crossJoin(F.broadcast(df.agg(F.count("*").alias(f"{name}_count"))))
        if type_col:
            types = df.groupBy(F.coalesce(blank_to_null(type_col), F.lit("UNKNOWN")).alias("t")).agg(F.count("*").alias("n"))
            row = row.crossJoin(F.broadcast(types.agg(
                F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "n")))).alias(f"{name}_{type_col}_counts")
            )))
    complete = F.col("error_count") == 0
    return row.withColumns({
        "status": F.when(complete, "COMPLETE").otherwise("PARTIAL"),
        "published_current": complete & F.lit(promote),
    })
