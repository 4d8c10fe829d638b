import math
import random
import re
import zlib

import pyarrow as pa

from catalog_lineage.llm import toxicity
from catalog_lineage.llm.common import Words, separators
from catalog_lineage.llm.toxicity import gentle_documents, op7_toxicity, score_texts, train

PICK = random.Random(6)
VOCABULARY = [f"word{i}" for i in range(500)]
BAD = ["vileone", "viletwo", "vilethree"]


def document(toxic):
    sentences = [" ".join(PICK.choice(VOCABULARY) for _ in range(PICK.randint(3, 12))) for _ in range(PICK.randint(2, 30))]
    at = PICK.randrange(len(sentences))
    if toxic:
        sentences[at] += " " + PICK.choice(BAD)
    return ". ".join(sentences) + ".", at


def tables(spark, n=900):
    rows = [(i, *document(i % 4 == 0), i % 4 == 0) for i in range(n)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _, _ in rows], "doc_id int, text string, toxicity string")
    labels = spark.createDataFrame([(i, 1, int(y)) for i, _, _, y in rows] + [(None, 1, 1), (1, 1, None), (10**6, 0, 1)], "doc_id int, quality int, toxic int")
    return docs, labels, rows


def test_held_out_documents_and_offending_sentences(spark):
    docs, labels, rows = tables(spark)
    got = {r.doc_id: r.toxicity for r in score_texts(docs, train(docs, labels)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    right = sum((got[i].score >= toxicity.REJECT) == y for i, _, _, y in held)
    assert len(held) > 200 and right / len(held) > 0.97
    placed = 0
    for i, text, at, y in held:
        if y and got[i].sentences:
            placed += any(b in text[s.start : s.end] for s in got[i].sentences for b in BAD)
            assert all(0 <= s.start < s.end <= len(text) for s in got[i].sentences)
    assert placed > 0.9 * sum(y for *_, y in held)
    kept = gentle_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in got.items() if t.score < toxicity.REJECT}


def test_score_is_the_noisy_or_of_its_sentences(spark):
    docs, labels, _ = tables(spark, 200)
    model = train(docs, labels)
    slot = {}

    def plain(text):
        clean = 1.0
        for sentence in re.split(r"[.!?\n]", (text or "").lower()):
            words = set(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", sentence))
            for w in words - set(slot):
                slot[w] = int(Words(pa.array([w], pa.large_string()), separators("plain")).hash[0] >> 46)
            if words:
                z = sum(float(model.weights[k]) for k in {slot[w] for w in words}) + model.offset
                clean *= 1 - 1 / (1 + math.exp(-z))
        return 1 - clean

    more = spark.createDataFrame([(1000, None, "x"), (1001, "", "x"), (1002, " .!? \n", "x"), (1003, "VILEONE vileone! Été? vileone\nword1", "x")], docs.schema)
    for r in score_texts(docs.unionByName(more), model).collect():
        assert math.isclose(r.toxicity.score, plain(r.text), rel_tol=1e-6, abs_tol=1e-9)


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = tables(spark, 200)
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) as toxic")
    a, b = train(docs, labels), train(docs, flipped)
    assert a.offset == b.offset and (a.weights == b.weights).all()


def test_hot_label_leaves_a_bounded_sample(spark, monkeypatch):
    docs, labels, _ = tables(spark, 60)
    hot = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)
    many = docs.unionByName(spark.range(3000).selectExpr(f"{hot} as doc_id", "concat('word1 text ', id, '. vileone.') as text", "'x' as toxicity"))
    sizes = []
    monkeypatch.setattr(toxicity, "TRAIN_DOCS", 100)
    monkeypatch.setattr(toxicity, "fit", lambda text, first, slot, label: sizes.append(len(label)))
    train(many, labels)
    train(many.unionByName(many), labels)
    assert sizes == [100, 100]


def test_score_is_the_noisy_or_of_the_sentences(spark):
    docs, labels, _ = tables(spark, 300)
    model = train(docs, labels)
    slot = lambda word: int(toxicity.Sentences(pa.array([word])).slot[0])
    weight = {w: float(model.weights[slot(w)]) for w in VOCABULARY + BAD}
    for r in score_texts(docs, model).collect():
        clean = 1.0
        for sentence in re.split(r"[.!?\n]", r.text):
            words = set(sentence.lower().split())
            if words:
                clean *= 1 - 1 / (1 + math.exp(-(sum(weight[w] for w in words) + model.offset)))
        assert abs(r.toxicity.score - (1 - clean)) < 1e-9


def test_nulls_long_texts_and_missing_labels(spark):
    docs, labels, _ = tables(spark, 200)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..!"), (4, "word1 " * 50_000), (4, "word1 " * 50_000), (None, "é. vileone vileone.")], "doc_id int, text string")
    scores = [r.toxicity for r in score_texts(odd, train(docs, labels)).collect()]
    assert [s.score for s in scores[:3]] == [0, 0, 0] and scores[3] == scores[4] and all(0 <= s.score <= 1 for s in scores)
    none = train(docs, labels.limit(0))
    assert [r.toxicity.score for r in score_texts(odd, none).collect()] == [0] * 6
    assert score_texts(odd.limit(0), none).collect() == []


def test_query(spark):
    rows = op7_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
