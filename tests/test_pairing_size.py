"""Pairing of large tables: what may be broadcast, what is served in a stream."""

from catalog_lineage.operators import pairing
from test_pairing import REL, SEM, VAL, run, serve_fast, served


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_relationships_are_not_broadcast_by_estimate(spark, monkeypatch):
    """However small their written table looks."""
    monkeypatch.setattr(pairing, "cut", lambda df: df)
    rows = [(str(i), f"id{i}", "C", "R", "CUBE", "D", i) for i in range(20)]
    pairs, errors = pairing.pair(spark.createDataFrame(rows, VAL), spark.createDataFrame(rows, VAL))
    for line in plan_of(pairs).splitlines() + plan_of(errors).splitlines():
        assert not ("BroadcastHashJoin" in line and "explicit_id" in line)
    assert {(r.validation_key, r.relationship_key) for r in pairs.collect()} == {(str(i), str(i)) for i in range(20)} and errors.count() == 0


def test_small_components_are_streamed(spark, monkeypatch):
    """Many disputed sources, and rows that nothing answers, take no rounds."""
    monkeypatch.setattr(pairing, "_claims", lambda *a: 1 / 0)
    make = lambda kind, i: (f"{kind}{i}", -i if kind == "s" else i, "TI", f"p{i // 16}", "R", ("CUBE", "VIEW")[i % 2], "ab"[i % 3 % 2], ("", "e1", "e2")[i % 7 % 3])
    rows, rels = [make("s", i) for i in range(800)], [make("r", i) for i in range(640) if i % 5]
    expected = {}
    for p in {r[3] for r in rows}:
        expected |= serve_fast(sorted((r for r in rows if r[3] == p), key=lambda r: r[1]), [r for r in rels if r[3] == p])
    assert run(spark, rows, rels) == expected
    everyone = pairing.pair_best(spark.createDataFrame(rows, SEM), spark.createDataFrame(rels, REL)).collect()
    assert sorted(r.row_id for r in everyone) == sorted(r[0] for r in rows) and sum(r.source_pairing_method == "UNMATCHED" for r in everyone) == 800 - len(expected)


def test_large_and_small_components_together(spark, monkeypatch):
    monkeypatch.setattr(pairing, "SLICE_ROWS", 20)
    make = lambda kind, i: (f"{kind}{i}", i, "TI", "hot" if i % 2 else f"p{i // 10}", "R", ("CUBE", "VIEW")[i % 3 % 2], "abc"[i % 5 % 3], ("", "e1")[i % 2])
    rows, rels = [make("s", i) for i in range(120)], [make("r", i) for i in range(110)]
    expected = {}
    for p in {r[3] for r in rows}:
        expected |= serve_fast([r for r in rows if r[3] == p], [r for r in rels if r[3] == p])
    assert run(spark, rows, rels) == expected


def test_rows_alone_in_their_bucket_are_not_streamed(spark, monkeypatch):
    """One row and one relationship, or none: the count of the bucket decides, and no row goes to Python."""
    monkeypatch.setattr(pairing, "_serve_stream", lambda batches: 1 / 0)
    make = lambda kind, i: (f"{kind}{i}", i, "TI", f"p{i}", "R", ("CUBE", "VIEW")[i % 2 if kind == "s" else i % 3 % 2], "ab"[i % 5 % 2] if kind == "s" else "a", ("", "e1")[i % 2])
    rows, rels = [make("s", i) for i in range(60)], [make("r", i) for i in range(90) if i % 7]
    rows += [(f"u{i}", i, "TI", "nobody", "R", "CUBE", "a", "") for i in range(3)]
    assert run(spark, rows, rels) == served(rows, rels)
    got = pairing.pair_best(spark.createDataFrame(rows, SEM), spark.createDataFrame(rels, REL)).collect()
    assert sorted(r.row_id for r in got) == sorted(r[0] for r in rows)
