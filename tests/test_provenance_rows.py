from pyspark.sql import functions as F

from catalog_lineage.operators import summarize


def test_one_row_of_provenance_per_edge_with_its_evidence_count(spark):
    rows = [("a", ["g1"], ["f"], ["r1", None]), ("a", ["g2"], ["f", " "], []), ("a", ["g1"], None, ["r2"]), ("b", [], [], []), (None, ["g9"], [], []),
            *[("h", [f"g{i:03d}"], ["f"], [f"r{i % 3}"]) for i in range(25)]]
    edges = spark.createDataFrame(rows, "object_relationship_id string, source_graph_relationship_ids array<string>, source_artifacts array<string>, source_record_ids array<string>")
    merged = summarize.merge_provenance(edges)
    lists = list(summarize.PROVENANCE_FIELDS)
    assert {r[0]: (r.evidence_count, *[list(r[f]) for f in lists[:4]]) for r in merged.where("object_relationship_id <> 'h'").collect()} == {
        "a": (2, ["g1", "g2"], ["f"], ["r1", "r2"], []), "b": (0, [], [], [], [])}
    assert merged.count() == 3
    cut_up = summarize.merge_provenance(edges, chunk_rows=10).orderBy("object_relationship_id", "chunk").collect()
    hot = [r for r in cut_up if r.object_relationship_id == "h"]
    assert [(r.chunk, r.evidence_count, len(r[lists[0]]), r.source_artifacts, r.source_record_ids) for r in hot] == [
        (0, 25, 10, ["f"], ["r0", "r1", "r2"]), (1, 25, 10, [], []), (2, 25, 5, [], [])]
    assert [x for r in hot for x in r[lists[0]]] == [f"g{i:03d}" for i in range(25)]
    assert len(cut_up) == 5


def test_chunks_follow_the_order_of_the_values(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.lpad(F.col("id").cast("string"), 3, "0").alias("v")).unionByName(
        spark.createDataFrame([("k", None), ("n", None), *[("n", None)] * 40], "k string, v string"))
    got = summarize.chunked_lists(df, "k", "v", "vs", chunk_rows=30).orderBy("k", "chunk").collect()
    assert [(r.k, r.chunk, len(r.vs)) for r in got] == [("k", 0, 30), ("k", 1, 30), ("k", 2, 30), ("k", 3, 10), ("n", 0, 0)]
    assert [v for r in got for v in r.vs] == [f"{i:03d}" for i in range(100)]
