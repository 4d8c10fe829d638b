import random

from pyspark.sql import functions as F

from catalog_lineage.operators import summarize, window


def test_ordinals_of_hot_keys_equal_plain_ordinals(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    plain = {r["i"]: r["ordinal"] for r in window.ordinals(df, "k", ["v", "i"]).collect()}
    split = {r["i"]: r["ordinal"] for r in window.ordinals(df, "k", ["v", "i"], hot_rows=100).collect()}
    assert plain == split and len(plain) == 3000


def test_asof_in_buckets_equals_asof_in_one_window(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.random() < 0.2, rng.choice(["x", "y", None])) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, seq int, sets boolean, v string")
    run = lambda **how: {r["seq"]: r["value_at_use"] for r in window.asof_last(df, "k", "seq", F.col("sets"), F.col("v"), **how).collect()}
    assert run() == run(bucket_width=7) == run(bucket_width=10_000) == run(hot_rows=300) == run(hot_rows=10)


def test_asof_splits_a_key_of_a_million_rows(spark):
    n = window.HOT_KEY_ROWS + 200_000
    # nine tenths of the rows stand in one hundredth of the order's span
    rows = spark.range(n).select(F.lit("hot").alias("k"), F.when(F.col("id") < 0.9 * n, F.col("id")).otherwise(F.col("id") * 900).alias("seq"), (F.col("id") % 1000 == 0).alias("sets"), F.col("id"))
    ranged, cold = window._in_ranges(rows, ["k"], ["seq"], window.HOT_KEY_ROWS)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert sum(sizes) == n and max(sizes) < n / 8 and cold.isEmpty()
    found = window.asof_last(rows, "k", "seq", F.col("sets"), F.col("id"))
    assert found.count() == n and found.where(F.col("value_at_use") != F.col("id") - F.col("id") % 1000).isEmpty()


def test_adjacency_in_chunks_is_whole(spark):
    edges = spark.range(1000).select(F.lit("hub").alias("source_id"), F.concat(F.lit("t"), "id").alias("target_id"), F.concat(F.lit("e"), "id").alias("graph_relationship_id"))
    out, inn = summarize.adjacency(edges, chunk_rows=100)
    chunks = out.collect()
    assert len(chunks) == 10 and sorted(e for c in chunks for e in c["edge_ids"]) == sorted(f"e{i}" for i in range(1000))
    assert inn.count() == 1000


def test_ranked_values_are_exact(spark):
    rng = random.Random(3)
    values = [rng.choice([1.0, 2.5, rng.random() * 1000]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["rank_name"]: r["value"] for r in summarize.ranked_values(df, "x", {"a": F.lit(0), "b": F.lit(2499), "c": F.lit(4999)}, width=4).collect()}
    ordered = sorted(values)
    assert got == {"a": ordered[0], "b": ordered[2499], "c": ordered[4999]}


def test_first_wins_does_not_depend_on_row_order(spark):
    rows = [("a", i, f"v{i}") for i in range(20)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, seq int, v string").repartition(3)
        assert [tuple(r) for r in window.first_wins(df, "k", "seq").collect()] == [("a", 0, "v0")]


def test_numbers_are_padded_and_never_cut(spark):
    from catalog_lineage.functions.text import padded

    df = spark.createDataFrame([(1,), (9999,), (10000,), (10007,), (None,)], "n int")
    assert [r[0] for r in df.select(padded("n")).collect()] == ["0001", "9999", "10000", "10007", None]


def test_a_group_of_more_than_9999_references_has_as_many_ids(spark):
    from pyspark.sql import functions as F

    from catalog_lineage.plans import profile

    rows = spark.range(10_050).select(
        F.format_string("%08d", "id").alias("row_key"), F.lit("p").alias("process_name"), F.lit("READS_ATTRIBUTE").alias("relationship_type"), F.lit("attribute").alias("target_type"),
        F.lit("sAttr").alias("target_name"), F.lit("ATTRIBUTE_CATALOG_DEFERRED").alias("validation_status"),
    )
    candidates = spark.createDataFrame([], "domain string, parent_key string, hierarchy_key string, own_key string, node_id string, is_default boolean")
    profiled, _ = profile.match_profile(rows, rows, candidates, "TI")
    assert profiled.select("relationship_id").distinct().count() == 10_050


def test_hot_key_is_joined_back_in_parts(spark):
    """One key holds a third of the rows; no task of the join gets more than twice the median."""
    rows = spark.range(300_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 4999)) as k", "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = window.join_counted(rows, groups, "k", "n", "id", hot_rows=100)
        assert joined.columns == ["k", "id", "n", "first"]
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
        plain = rows.join(groups, "k")
        assert joined.exceptAll(plain.select(*joined.columns)).isEmpty() and joined.count() == 300_000
    finally:
        for key, value in (("spark.sql.adaptive.enabled", "true"), ("spark.sql.autoBroadcastJoinThreshold", "10485760"), ("spark.sql.shuffle.partitions", "4")):
            spark.conf.set(key, value)
