import re
import zlib
from collections import Counter

import duckdb
from hypothesis import given, settings, strategies as st

from catalog_lineage.llm import spelling
from catalog_lineage.llm.spelling import ORACLES, op11_spelling_variants, variants

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out = {}
    for w, n in words.items():
        nears = sorted((-words[o], o) for o in words if near(w, o))
        best = nears[0] if nears and -nears[0][0] >= 10 * n else None
        out[w] = [best and best[1], None, n, len(nears), best and -best[0]]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def got(df):
    rows = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def test_chains_ties_accents_and_odd_rows(spark):
    docs = [
        (8, "Marathon " * 1200 + "marathén " * 110 + "marathéne " * 9 + "maratheen maratheen"),
        (2, None), (3, ""), (None, "Straßenbahn straßenbahn STRAßENBAHN strassenbahn strassenbahn"), (4, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa"),
        (5, ("abcdefh " * 60 + "abcdefg " * 60 + "abcdefi abcdefi ")), (5, "abcdefi"), (5, "abcdefi"), (6, "short runs only, ÀÖÿ×÷ÀÖÿ ÀÖÿ×÷ÀÖÿ"),
        (7, ("x" * 5000 + " ") * 3 + ("x" * 4999 + "y ") * 2),
    ]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    result = got(variants(df))
    assert result == expected(docs)
    assert result["abcdefi"][0] == "abcdefg"  # the smaller of two equally frequent forms
    assert result["marathéne"][:2] == ("marathén", "marathon")  # a chain of forms


def test_empty_table(spark):
    assert variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", min_size=1, max_size=9), st.text("abcé", min_size=1, max_size=9))
def test_near_words_meet_once(a, b):
    """The reduced key of one of two near words is in what the other hands out, in exactly one of the two directions."""
    if not near(a, b):
        return
    reduced = spelling._Reduced([a, b])
    handed = [set(), set()]
    for word, keys in reduced.half_neighbourhood():
        for w, k in zip(word.tolist(), keys.tolist()):
            assert k not in handed[w]
            handed[w].add(k)
    own = reduced.keys().tolist()
    assert (own[0] == own[1]) + (own[1] in handed[0]) + (own[0] in handed[1]) == 1


def test_query_and_sql(spark):
    rows = got(op11_spelling_variants(spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert rows == expected([(r.doc_id, r.text) for r in docs])
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert {r[0]: r[1:] for r in con.sql(ORACLES["op11_spelling_variants"]).fetchall()} == rows
