import numpy as np

from catalog_lineage.llm import neighbours
from catalog_lineage.llm.neighbours import nearest


def frame(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "id long, vector array<double>")


def test_every_vector_is_written_once(spark, monkeypatch):
    written = []

    def cut(df, make=neighbours.cut):
        written.append(make(df))
        return written[-1]

    monkeypatch.setattr(neighbours, "cut", cut)
    df = frame(spark, range(500), np.random.default_rng(2).normal(size=(500, 8)))
    assert nearest(df, df.where("id % 100 = 0")).count() == 50
    assert [w.count() for w in written] == [500, 5]


def test_ids_that_repeat_leave_room_for_others(spark):
    ids = [0, *[7] * 40, *range(100, 115)]
    vectors = [[1.0, 1.0], *[[1.0, 1.0 + i / 1000] for i in range(40)], *[[2.0 + i, 1.0] for i in range(15)]]
    df = frame(spark, ids, vectors)
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(df, df.where("id = 0"), visits=neighbours.TREES).collect())
    assert got == [(1, 7, 0.0), *[(i + 2, 100 + i, 1.0 + i) for i in range(9)]]


def test_squares_that_overflow_are_compared_one_by_one(spark):
    vectors = [[1e200 * (1 + i * 1e-50), float(i)] for i in range(20)]
    df = frame(spark, range(20), vectors)
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(df, df.where("id = 0"), visits=neighbours.TREES).collect())
    assert got == [(i, i, float(i)) for i in range(1, 11)]
