import hashlib
import random

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from catalog_lineage.llm.phrases import Phrases, edited, fingerprints, likeness, likeness_of, op13_document_fingerprints, signature

SF = "/root/testdata/sf0.001"


def plain_phrases(text):
    seen, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen


def expected(docs):
    """By the definition; documents in the order of the library for equal ids are not part of it."""
    out = {}
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        sign = [signature(t) for t in (text, new, following)]
        out[doc_id] = (len(text), hashlib.sha256(new.encode()).hexdigest(), *(s.tobytes().hex() for s in sign[:2]), likeness_of(sign[0], sign[1]), likeness_of(sign[0], sign[2]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.text("abü😀", max_size=60), st.integers(0, 60))
def test_phrases_are_those_of_the_parse(text, cut_at):
    half = Phrases().read(text[:cut_at])
    both = Phrases(half).read(text[cut_at:])
    starts = [0, *both.ends[:-1]] if both.ends else []
    assert {text[a:b] for a, b in zip(starts, both.ends)} == plain_phrases(text) and len(both.ends) == len(plain_phrases(text))
    assert (both.signature(text) == signature(text)).all()


def test_likeness_follows_the_phrase_sets():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    errors = []
    for share in (0, 0.1, 0.3, 0.5, 0.8, 1):
        for _ in range(10):
            a = " ".join(rng.choice(words) for _ in range(600))
            b = a[: int(len(a) * share)] + " ".join(rng.choice(words) for _ in range(600))[int(len(a) * share) :]
            one, two = plain_phrases(a), plain_phrases(b)
            errors.append(likeness_of(signature(a), signature(b)) - len(one & two) / len(one | two))
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.15


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "ab"), (-4, "x"), (None, "the one without an id"), (7, "äöü😀" * 300), (9, "word " * 9000), (12, "ab")]
    df = spark.createDataFrame([(d, t, "old", 1) for d, t in docs], "doc_id long, text string, fingerprint string, n int")
    for parts in (1, 3, 200):
        rows = edited(df.repartition(parts)).collect()
        assert {r.doc_id: tuple(r)[1:] for r in rows} == expected(docs) and len(rows) == len(docs)
    own = {r.doc_id: r for r in fingerprints(df).collect()}
    assert own[3].fingerprint == own[12].fingerprint == signature("ab").tobytes().hex() and own[7].n == 1
    assert own[1].fingerprint == own[2].fingerprint and own[1].fingerprint != own[3].fingerprint
    f = F.col("fingerprint")
    assert fingerprints(df).where(likeness(f, f) < 1).count() == 0
    assert fingerprints(df).select(likeness(f, F.lit(None).cast("string")).alias("l")).where("l is not null").count() == 0


def test_repeated_rows_and_ids(spark):
    docs = [(5, "a text of one id")] * 400 + [(5, "another text of the id"), (4, "last")]
    rows = edited(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()
    assert len(rows) == 402
    five = [r for r in rows if r.doc_id == 5]
    assert len(set(five)) == 2 and sorted(five.count(r) for r in set(five)) == [1, 400]
    # The texts of an id follow each other in a fixed order, so one of them is followed by the last document.
    half = lambda t, f: hashlib.sha256((t[: len(t) - len(t) // 2] + f[: len(t) // 2]).encode()).hexdigest()
    a, b = "a text of one id", "another text of the id"
    assert {r.edited_sha256 for r in five} in ({half(a, b), half(b, "last")}, {half(b, a), half(a, "last")})
    again = edited(spark.createDataFrame(docs[::-1], "doc_id long, text string")).collect()
    assert sorted(again) == sorted(rows)


def test_small_tables(spark):
    assert edited(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert {r.doc_id: tuple(r)[1:] for r in edited(spark.createDataFrame([(3, "only one")], "doc_id long, text string")).collect()} == expected([(3, "only one")])


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op13_document_fingerprints(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected(docs) and len(rows) == len(docs)
    # Half of the text is still there, so the edited text is nearer than another document.
    unlike = [r for r in rows if r.n_chars > 200 and r.near_next < 1]
    assert sum(r.near_edited > r.near_next for r in unlike) > 0.95 * len(unlike) > 50
