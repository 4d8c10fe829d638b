import hashlib
import random
import re

from catalog_lineage.llm import passages
from catalog_lineage.llm.passages import op9_substring_dedup, remove_repeats


def plain(docs, window):
    """(n_words, n_removed, kept text) of each (doc_id, text), by looking every window up."""
    least = {}
    words = [re.findall(r"[^ \t-\r]+", t or "") for _, t in docs]
    for (d, _), w in zip(docs, words):
        for s in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[s : s + window])
                least[k] = min(d, least.get(k, d))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if d is not None and least[tuple(w[s : s + window])] < d:
                gone |= set(range(s, s + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(pick):
    vocabulary = ["Aa", "b.", "ç", "dd", "e"] + [f"w{i}" for i in range(400)]
    text = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    shared, base, tiny = text(130), text(400), ["x", "y"]
    docs = []
    for i in range(60):
        kind = i % 6
        if kind == 0:
            words = text(pick.randint(0, 90)) + shared[: pick.randint(40, 130)] + text(pick.randint(0, 60))
        elif kind == 1:
            words = list(base)
            for k in pick.sample(range(400), pick.randint(0, 6)):
                words[k] = pick.choice(vocabulary)
        elif kind == 2:
            words = [pick.choice(tiny) for _ in range(pick.randint(45, 140))]
        elif kind == 3:
            words = ["same"] * pick.randint(45, 120)
        elif kind == 4:
            words = shared[pick.randint(0, 60) :] + shared
        else:
            words = text(pick.randint(0, 200))
        docs.append((pick.randint(0, 50) if i % 9 else None, pick.choice([" ", "\n", "\t  "]).join(words)))
    return docs + [(7, None), (8, ""), (9, " \n")]


def test_against_every_window(spark):
    docs = corpus(random.Random(3))
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, version string").repartition(5)
    got = remove_repeats(df)
    assert got.columns == ["doc_id", "text", "version", "n_words", "n_removed", "kept_text"]
    rows = sorted(map(str, ((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect())))
    expected = plain(docs, passages.WINDOW)
    assert rows == sorted(map(str, expected))
    assert sum(e[2] for e in expected) > 3000


def test_long_text_and_empty_table(spark):
    long_text = " ".join(f"k{i}" for i in range(120_000))
    df = spark.createDataFrame([(2, long_text), (1, "head " + long_text)], "doc_id int, text string")
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(df).collect()) == [(1, 120_001, 0), (2, 120_000, 120_000)]
    assert remove_repeats(df.limit(0)).collect() == []


def test_many_texts_of_one_id(spark):
    pick = random.Random(9)
    shared = [f"s{i}" for i in range(70)]
    docs = [(4, " ".join([f"a{pick.randint(0, 9)}" for _ in range(pick.randint(0, 9))] + shared[pick.randint(0, 15) :])) for _ in range(300)] + [(3, " ".join(shared[5:60])), (9, " ".join(shared))]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    got = sorted(map(str, ((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df).collect())))
    assert got == sorted(map(str, plain(docs, passages.WINDOW)))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in plain(docs, 50)}
    assert {tuple(r) for r in op9_substring_dedup(spark, sf).collect()} == expected
