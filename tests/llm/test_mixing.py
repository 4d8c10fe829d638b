import re
from collections import defaultdict

from catalog_lineage.llm.mixing import mix, op2_mix_sources, repeated


def waterfill(sizes, weights, cap=3):
    left, out = dict(sizes), {}
    total = sum(sizes.values())
    while True:
        share = total - sum(out.values())
        base = sum(weights[s] for s in left)
        above = [s for s in left if share * weights[s] / base > cap * sizes[s]] if base else []
        if not above:
            return out | {s: share * weights[s] / base for s in left}
        for s in above:
            out[s] = cap * sizes[s]
            del left[s]


def check(rows, docs):
    """rows have doc_id, size, source_size, target, taken; docs (doc_id, source, text)."""
    count = {d: len(re.findall(r"[^ \t-\r]+", t or "")) for d, s, t in docs}
    sizes = defaultdict(int)
    for d, s, t in docs:
        sizes[s] += count[d]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = waterfill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    source = {d: s for d, s, t in docs}
    taken = defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == count[r["doc_id"]] and r["source_size"] == sizes[s]
        assert abs(r["target"] - targets[s]) < 1e-6 * max(1, targets[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)


def test_query(spark):
    for sf in ("/root/testdata/sf0.001",):
        docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()]
        rows = [r.asDict() for r in op2_mix_sources(spark, sf).collect()]
        assert len(rows) == len(docs)
        check(rows, docs)
        assert sorted(map(str, rows)) == sorted(str(r.asDict()) for r in op2_mix_sources(spark, sf).collect())


def test_nulls_hot_source_and_clashing_columns(spark):
    docs = [(i, [None, "a", "b", "c"][i % 4 if i % 3 else 1], None if i % 7 == 0 else "w " * (i % 11)) for i in range(120)]
    df = spark.createDataFrame([(*d, i, "x") for i, d in enumerate(docs)], "doc_id int, source string, text string, digest int, stop string")
    mixed = mix(df)
    assert mixed.columns == ["doc_id", "source", "text", "digest", "stop", "size", "source_size", "target", "whole", "extra"]
    rows = [r.asDict() | {"taken": r.whole * r.size + r.extra} for r in mixed.collect()]
    check(rows, docs)
    words = sum(len((r.text or "").split()) for r in repeated(mixed).collect())
    assert words == sum(r["taken"] for r in rows)


def test_texts_of_a_hot_id_have_places_of_their_own(spark):
    rows = [(7, "a", f"text {i} of the hot id") for i in range(900)] + [(i, "ab"[i % 2], "other words") for i in range(100, 1000)]
    mixed = mix(spark.createDataFrame(rows, "doc_id int, source string, text string"))
    hot = [r.extra for r in mixed.where("doc_id = 7").collect()]
    assert len(hot) == 900 and 0 < sum(x > 0 for x in hot) < 900
    taken = mixed.selectExpr("source", "target", "whole * size + extra as taken").groupBy("source", "target").sum("taken").collect()
    assert all(abs(r[2] - r[1]) <= 1 for r in taken)


def test_first_words_of_the_last_document_keep_their_spaces(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "s", " a\tb  c\n", 9)], "doc_id int, source string, text string, n_chars int")
    df = df.select("*", *(F.lit(v).cast("long").alias(n) for n, v in (("size", 3), ("source_size", 3), ("whole", 1), ("extra", 2)))).withColumn("target", F.lit(5.0))
    assert sorted((r.text, r.n_chars) for r in repeated(df).collect()) == [(" a\tb", 4), (" a\tb  c\n", 9)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id int, source string, text string")
    assert mix(empty).collect() == []
    silent = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id int, source string, text string")
    assert [(r.target, r.whole, r.extra) for r in mix(silent).collect()] == [(0.0, 0, 0)] * 2
    assert repeated(mix(silent)).collect() == []
