from collections import Counter
import zlib

import numpy as np

from catalog_lineage.llm.sharding import op5_sharding, permute, place, row_at, shard_rows


def test_permutation_is_complete_and_reversible():
    for rows in (1, 2, 3, 40, 1000, 4097):
        p = permute(np.arange(rows), rows)
        assert sorted(p.tolist()) == list(range(rows))
        shard, slot = place(np.arange(rows), rows, 7)
        assert (row_at(shard, slot, rows, 7) == np.arange(rows)).all()
    assert (permute(np.arange(1000), 1000, 1) != permute(np.arange(1000), 1000, 2)).any()


def check(rows, count, shards):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == count and max(sizes.values()) - min([sizes.get(s, 0) for s in range(shards)]) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_nulls_repeats_and_clashing_columns(spark):
    data = [(None, None, 1, "a"), (5, "x", 2, "b"), (5, "x", 2, "b"), (5, "y", 2, "b")] * 30
    df = spark.createDataFrame(data, "doc_id int, text string, _number int, _row string")
    rows = shard_rows(df, shards=7).collect()
    check(rows, 120, 7)
    assert sorted(map(str, (tuple(r)[:4] for r in rows))) == sorted(map(str, data))
    again = shard_rows(df.repartition(3), shards=7).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_small_tables(spark):
    assert shard_rows(spark.createDataFrame([], "doc_id int, text string")).collect() == []
    one = shard_rows(spark.createDataFrame([(1, "a")], "doc_id int, text string")).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_sharding(spark, sf).collect()
    check(rows, len(texts), 40)
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    numbers = {d: i for i, d in enumerate(sorted(texts))}
    shard, slot = place(np.array([numbers[r.doc_id] for r in rows]), len(rows))
    assert [(r.shard, r.slot) for r in rows] == list(zip(shard.tolist(), slot.tolist()))
