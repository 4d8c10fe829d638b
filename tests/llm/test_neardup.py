import random

import numpy as np

from catalog_lineage.llm import neardup
from catalog_lineage.llm.components import components
from catalog_lineage.llm.neardup import document_counts, near_duplicates, slot_weights, unique_documents

PICK = random.Random(9)
WORDS = ["".join(PICK.choice("abcdefghij") for _ in range(PICK.randint(2, 6))) for _ in range(3000)]


def text(n):
    return [PICK.choice(WORDS) for _ in range(n)]


def edited(words, changes):
    words = list(words)
    for i in PICK.sample(range(len(words)), changes):
        words[i] = PICK.choice(WORDS)
    return words


def corpus():
    """Copies, near copies of several strengths around shared bases, a passage that many share, and unrelated texts."""
    docs, base, passage = [], text(300), text(120)
    docs += [" ".join(base)] * 12 + [" ".join(base).upper() + "!"]
    docs += [" ".join(edited(base, k)) for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10) for _ in range(6)]
    docs += [" ".join(text(60) + passage + text(60)) for _ in range(40)]
    other = text(90)
    docs += [" ".join(other), " ".join(other + ["tail"]), " ".join(other[:-1])]
    docs += [" ".join(text(PICK.randint(1, 80))) for _ in range(30)] + ["two words", "two  Words.", "word", ""]
    return docs


def links(texts, weights):
    """All pairs by plain Jaccard on weighted shingles, with the weights that the corpus gives."""
    sets = {}
    for i, t in texts.items():
        s = neardup.Shingled(neardup.pa.array([t]))
        sets[i] = dict(zip(s.shingle.tolist(), (s.count * weights[(s.shingle % np.uint64(neardup.SLOTS)).astype(int)]).tolist()))
    out = {}
    for i in texts:
        for k in texts:
            if i < k and sets[i] and sets[k]:
                both = sum(min(w, sets[k].get(x, 0)) for x, w in sets[i].items())
                j = both / (sum(sets[i].values()) + sum(sets[k].values()) - both)
                if j >= neardup.THRESHOLD:
                    out[i, k] = j
    return out


def classes(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 20)
    monkeypatch.setattr(neardup, "MEMBERS", 7)
    texts = dict(enumerate(corpus()))
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id int, text string, node string").repartition(3)
    weights = slot_weights(document_counts(df), len(texts))
    expected = classes(texts, links(texts, weights))
    got = {r.doc_id: r.class_id for r in near_duplicates(df).collect()}
    assert got == expected
    assert len(set(expected.values())) < len(texts) - 20
    kept = unique_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_samples_agree_as_often_as_weighted_jaccard():
    shingle = np.sort(np.random.default_rng(1).integers(0, 1 << 44, 900).astype(np.uint64))
    weight = np.random.default_rng(2).uniform(0.5, 3, 900).astype(np.float32)
    a, b = slice(0, 700), slice(200, 900)
    both = weight[200:700].sum()
    expected = both / (weight[a].sum() + weight[b].sum() - both)
    hits = 0
    for _ in range(30):
        shuffled = neardup.mix(shingle + np.uint64(_)) & np.uint64((1 << 44) - 1)
        x = neardup.Sampler()(np.concatenate([shuffled[a], shuffled[b]]), np.concatenate([weight[a], weight[b]]), np.array([0, 700, 1400]))
        hits += (x[0] == x[1]).mean()
    assert abs(hits / 30 - expected) < 0.04


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, None), (2, ""), (3, "..."), (None, "some words that repeat here now"), (None, None), (5, "some words that repeat here now"), (5, "some words that repeat here now"), (4, "SOME words, that repeat here now"), (9, "w " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 2), (3, 3), (None, None), (None, None), (5, 4), (5, 4), (4, 4), (9, 9)], key=str)
    assert sorted(str(r.doc_id) for r in unique_documents(df).collect()) == ["1", "2", "3", "4", "9", "None", "None"]
    assert near_duplicates(df.limit(0)).collect() == []


def test_texts_of_one_id_are_kept_by_class(spark):
    hot, a, b, c = [" ".join(text(60)) for _ in range(30)], text(200), text(200), " ".join(text(50))
    rows = [(7, t) for t in hot] + [(7, hot[0]), (7, "..."), (7, ""), (7, ""), (7, None), (None, c), (None, c)]
    # The first text of 1 heads a class; its second is a near copy of a text of 0, which has a class of its own too.
    rows += [(1, " ".join(a)), (2, " ".join(edited(a, 2))), (0, " ".join(b)), (1, " ".join(edited(b, 2))), (0, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (str(r[0]), str(r[1]))
    expected = [(7, t) for t in hot] + [(7, "..."), (7, ""), (7, ""), (7, None), (None, c), (None, c), rows[-5], rows[-3], (0, c)]
    assert sorted((tuple(r) for r in unique_documents(df).collect()), key=key) == sorted(expected, key=key)


def test_two_texts_of_one_id_in_one_class(spark):
    base = text(200)
    same_id = [" ".join(base), " ".join(edited(base, 1)), " ".join(edited(base, 1))]
    df = spark.createDataFrame([(3, t) for t in same_id] + [(4, same_id[0])], "doc_id long, text string")
    assert [r.doc_id for r in unique_documents(df).collect()] == [3]


def test_rows_without_words_as_shingled(spark):
    texts = [None, "", " .-_\n", "é", "\u212a", "😀", "\u2003", "\x7f", "\x80", "...\n...x", *(chr(i) for i in range(1, 128))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r.id: r.words for r in df.select("id", neardup._has_words().alias("words")).collect()}
    words = neardup.Shingled(neardup.pa.array(texts, neardup.pa.string())).words
    assert got == {i: bool(n) for i, n in enumerate(words)}


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 5), (200, 201), (202, 201), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
