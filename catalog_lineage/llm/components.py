"""Connected components of an edge table by alternating large and small stars; every step is an aggregate and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_lineage.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node of it) for all nodes of edges(a long, b long). Each round is written out, so that a lost
    executor costs one round; their number grows with the logarithm of the longest chain."""
    stars = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("m", "u").alias("m"))
        large = both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        joined = large.join(least, F.col("u") == F.col("n"))
        small = joined.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        stars = cut(small)
        seen = stars.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if seen == state:
            break
        state = seen
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
