import numpy as np

from catalog_lineage.llm import neighbours
from catalog_lineage.llm.neighbours import nearest, op8_nearest_neighbours


def plain(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def frame(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "id long, vector array<double>")


def recall(got, true):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in true[q]}) for q in true) / sum(map(len, true.values()))


def test_searched_whole_it_is_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 50)
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 8))
    vectors[100:330] = vectors[100]  # a third of the rows are one vector
    ids = np.arange(700)
    df = frame(spark, ids, vectors)
    assert found(nearest(df, df.where("id % 50 = 0"), visits=neighbours.TREES)) == plain(ids, vectors, range(0, 700, 50))


def test_tables_with_few_rows_give_all_or_k(spark):
    rng = np.random.default_rng(6)
    for n in (2, 9, 11, 12, 40):
        ids, vectors = np.arange(n), rng.normal(size=(n, 16))
        got = found(nearest(*[frame(spark, ids, vectors)] * 2))
        assert {q: len(v) for q, v in got.items()} == {q: min(10, n - 1) for q in range(n)}
        if n <= 11:
            assert got == plain(ids, vectors, range(n))


def test_recall(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(6000, 32)).astype(np.float32)
    ids = np.arange(6000)
    df = frame(spark, ids, vectors).selectExpr("id", "cast(vector as array<float>) as vector")
    got, true = found(nearest(df, df.where("id % 200 = 0"))), plain(ids, vectors.astype(float), range(0, 6000, 200))
    assert recall(got, true) >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 0.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 3.0]), (8, [1.0, -1.0]), (0, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = found(nearest(df, df.where("id % 100 = 0")))
    assert set(got) == {0} and {i for i, _ in got[0]} == {7, 8}
    assert nearest(df.limit(0), df.limit(0)).collect() == []
    assert nearest(df.where("id = 0").limit(1), df.where("id = 0").limit(1)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    got, true = found(op8_nearest_neighbours(spark, sf)), plain(ids, vectors, [i for i in ids if i % 100 == 0])
    assert set(got) == set(true) and recall(got, true) >= 0.9
    place = {int(i): v for i, v in zip(ids, vectors)}
    assert all(s == np.sqrt(((place[q] - place[i]) ** 2).sum()) for q, v in got.items() for i, s in v)
