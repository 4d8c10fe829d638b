"""Times the headline queries on the driver tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "summarize_evidence", "consolidate_edges", "catalog_lookup", "pair_by_ordinal", "candidate_match", "reference_resolution",
    "extract_calls", "feeder_flag", "symbol_asof", "process_evidence", "match_profile", "unified_graph", "adjacency_index",
    "reconcile_ids", "impact", "redact_secrets", "duration_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    import checks
    checks.load()
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in wanted:
        begin = time.perf_counter()
        checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
