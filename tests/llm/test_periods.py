import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from catalog_lineage.llm.periods import id_plan, op12_periodic_runs, periodic_runs, run_lines, runs_of
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every stretch by its definition: for each period the maximal stretches, less those with a smaller period."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    best = (None,) * 4
    for s, length, q in runs:
        if best[0] is None or length * best[2] > best[1] * q:
            best = (s, length, q, 1000 * length // q)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def got(df):
    return df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(run_lines(F.col("runs")), 256), F.sha2("collapsed", 256)).collect()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 12)), max_size=6), st.lists(st.integers(0, 2), max_size=40))
def test_runs_are_those_of_the_definition(pieces, other):
    one = [w for unit, times in pieces for w in unit * times]
    words, first = np.array(one + other, np.int64), np.array([0, len(one), len(one) + len(other)])
    split = [(s, length, q) for s, length, q in runs_of(words, first)]
    want = plain_runs(one) + [(s + len(one), length, q) for s, length, q in plain_runs(other)]
    assert sorted(split) == sorted(want)


def test_long_texts():
    rng = random.Random(1)
    for period in (1, 2, 700, 4999):
        unit = [rng.randrange(50) for _ in range(period)]
        words = ([60] + unit * (20000 // period + 1))[:20000] + [61]
        assert (1, 19999, period) in runs_of(np.array(words), np.array([0, len(words)]))
    word = np.zeros(300_000, np.int64)
    assert runs_of(word, np.array([0, len(word)])) == [(0, 300_000, 1)]


def test_odd_rows_and_clashing_columns(spark):
    rng = random.Random(7)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "x ö ö ö ö ö ö y", "a b a b a b a b", "a b a b a b a", "b " * 3000]
    texts += [" ".join(rng.choice("ab c") for _ in range(rng.randrange(200))) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "k k k k k k"), (5, "a a a a a a"), (5, "a a a a a a")]
    df = spark.createDataFrame([(d, t, "old", 4) for d, t in docs], "doc_id long, text string, _row string, runs int")
    made = periodic_runs(df, id_plan(F.col("doc_id")))
    assert made.where("_row = 'old'").count() == len(docs)
    assert sorted(map(str, map(tuple, got(made)))) == sorted(str((d, *expected(d, t))) for d, t in docs)
    assert any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs)
    unplanted = {r.doc_id: r.n_runs for r in periodic_runs(df).collect()}
    assert unplanted[9] == 1 and unplanted[7] == 1 and unplanted[8] == 0


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    rows = op12_periodic_runs(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:] == expected(r.doc_id, docs[r.doc_id])
