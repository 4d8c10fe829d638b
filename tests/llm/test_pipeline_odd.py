"""Odd tables through the whole pipeline: nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from catalog_lineage.llm.common import table

SF = "/root/testdata/sf0.001"
CLASHING = ("_row", "node", "target", "whole", "shard", "slot", "size")


def written(spark, path, extra_docs, docs=True, labels=True, benchmark=True):
    for name, whole in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df = table(spark, SF, name)
        df = df if whole else df.limit(0)
        if name == "documents":
            df = df.unionByName(spark.createDataFrame(extra_docs, df.schema))
            df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def passed(spark, sf_dir):
    """Each stage's output, as run() hands it on."""
    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, sf_dir))
        out[name] = docs
    return out


def test_odd_rows(spark, tmp_path):
    long_text = "plain words of a long text " * 40_000 + "end"
    item = table(spark, SF, "benchmark").orderBy("item_id").first().text
    odd = [
        (None, "a text without an id, of a few words", "en", "odd", None), (None, None, None, None, None), (1_000_001, None, None, None, None),
        (1_000_002, "", "en", "odd", 0), (1_000_003, "...", None, "odd", 3), (1_000_004, long_text, "en", "odd", 9), (1_000_005, long_text, "en", "odd", 9),
        (1_000_006, "the same short text twice over", "en", "odd", 30), (1_000_006, "the same short text twice over", "en", "odd", 30),
        (1_000_007, f"before {item} after", "en", None, None),
    ]
    sf_dir = written(spark, tmp_path, odd)
    columns = table(spark, sf_dir, "documents").columns
    out = passed(spark, sf_dir)
    for name in list(out)[:-1]:
        assert sorted(out[name].columns) == sorted(columns)
    ids = {name: Counter(r.doc_id for r in df.where("doc_id is null or doc_id > 1000000").select("doc_id").collect()) for name, df in out.items()}
    assert ids["toxicity"] == Counter(r[0] for r in odd)
    kept = {None: 2, **dict.fromkeys((1_000_001, 1_000_002, 1_000_003, 1_000_004, 1_000_006, 1_000_007), 1)}
    assert ids["near_duplicates"] == kept
    kept.pop(1_000_007)
    assert ids["decontamination"] == kept
    clash = [f"own {c}" for c in CLASHING]
    assert all([r[c] for c in CLASHING] == clash for r in out["mix"].select(*CLASHING).distinct().collect())
    last = out["shard"]
    assert set(last.columns) == set(columns) and last.count() == out["mix"].count()
    places = [(r.shard, r.slot) for r in last.select("shard", "slot").collect()]
    sizes = Counter(s for s, _ in places)
    assert len(set(places)) == len(places) and set(places) == {(s, i) for s, n in sizes.items() for i in range(n)}


@pytest.mark.parametrize("missing", ["docs", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, missing):
    sf_dir = written(spark, tmp_path, [], **{missing: False})
    out = corpus_pipeline.run(spark, sf_dir)
    assert (out.count() == 0) == (missing == "docs")
