"""References are counted before they meet the catalog, and only objects that are asked for are sorted by key."""

from pyspark.sql import functions as F

from catalog_lineage.operators import resolve


def test_names_are_looked_up_once(spark, monkeypatch):
    refs = spark.createDataFrame([("cube", " Sales", "CONFIRMED"), ("cube", "sales", "CONFIRMED"), (None, None, None), ("cube", "gone", "HIGH"), ("view", "v", "HIGH"), ("cube", "Sales", "UNRESOLVED")] * 40, "target_type string, target_name string, confidence string")
    objects = spark.createDataFrame([("cube", "SALES", 2), ("Cube", "Sales", 1)] + [("dimension", f"d{i}", i) for i in range(50)], "object_type string, object_name string, seq int")
    keys = ["target_type", "target_name", "confidence", "validation_status", "catalog_match_name", "catalog_match_scope"]
    plain = resolve.classify_targets(refs, objects).groupBy(*keys).agg(F.count("*").alias("row_count"))
    seen, real = [], resolve.catalog_index
    monkeypatch.setattr(resolve, "catalog_index", lambda df, order: seen.append(df.count()) or real(df, order))
    looked, of = [], resolve.classify_targets
    monkeypatch.setattr(resolve, "classify_targets", lambda df, *a: looked.append(df.count()) or of(df, *a))
    got = resolve.classified_counts(refs, objects)
    assert sorted(map(str, got.select(*keys, "row_count").collect())) == sorted(map(str, plain.collect()))
    assert looked == [6] and seen == [2]
