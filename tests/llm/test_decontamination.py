import random

from catalog_lineage.llm import decontamination
from catalog_lineage.llm.decontamination import Matcher, clean_documents, match_items, normal, op10_benchmark_decontamination, scores, _masks


def table(pattern, text, anchored=False):
    """Smallest edit distance to any part of the text that ends at each place, by the full table."""
    row, out = list(range(len(pattern) + 1)), []
    for i, c in enumerate(text, 1):
        new = [i if anchored else 0]
        for j, p in enumerate(pattern):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
        out.append(row[-1])
    return out


def all_places(item, pattern, text):
    """(item, distance, start, end) of every stretch of ends within the budget, by the full table."""
    ends, out, stretch = table(pattern, text), [], []
    for end, d in enumerate([*ends, len(pattern) + 1], 1):
        if d <= int(0.08 * len(pattern)):
            stretch.append((d, end))
        elif stretch:
            d, at = min(stretch)
            back = table(pattern[::-1], text[:at][::-1], True)
            out.append((item, d, at - 1 - back.index(d), at))
            stretch = []
    return out


def test_bit_parallel_distance():
    pick = random.Random(1)
    for i in range(300):
        p = "".join(pick.choice("ab c") for _ in range(pick.randint(1, 90)))
        t = "".join(pick.choice("ab c") for _ in range(pick.randint(0, 120)))
        assert list(scores(p, _masks(p), t, bool(i % 2))) == table(p, t, bool(i % 2))


def test_against_brute_force():
    pick = random.Random(2)
    word = lambda: "".join(pick.choice("abcdefg") for _ in range(pick.randint(1, 7)))
    items = [(i, normal(" ".join(word() for _ in range(pick.randint(1, 30))))) for i in range(12)]
    matcher = Matcher(items, 0.08)
    found = 0
    for _ in range(60):
        _, p = pick.choice(items)
        chars = list(p)
        for _ in range(pick.randint(0, int(0.12 * len(p)) + 1)):
            k = pick.randrange(len(chars))
            chars[k : k + 1] = pick.choice([[], ["q"], [chars[k], "x"]])
        text = " ".join(word() for _ in range(20)) + "".join(chars) + " ".join(word() for _ in range(20))
        text += "".join(pick.choices([" and ", text, p * 3], k=1))
        expected = sorted(m for i, q in items for m in all_places(i, q, normal(text)))
        assert matcher.matches(text) == expected
        found += len(expected)
    assert found > 100


def test_every_place_of_a_repeated_item(spark):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(7, item)], "item_id int, text string")
    docs = spark.createDataFrame([(1, f"{item}, and again: {item.replace('six', 'sx')}"), (2, " - ".join([item] * 3))], "doc_id int, text string")
    got = {r.doc_id: [(m.distance, m.end - m.start) for m in r.matches] for r in match_items(docs, items).collect()}
    n = len(normal(item))
    assert got == {1: [(0, n), (1, n - 1)], 2: [(0, n)] * 3}


def test_blocks_nulls_and_clashing_columns(spark, monkeypatch):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog today"), (2, None), (3, "..."), (None, "any words"), (4, "the QUICK brown fox, jumps over the lazy dog today!"), (5, "unseen words are not in any text here")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "so the quick brown fox jumps ovr the lazy dog today ok", "m"), (2, None, "m"), (3, "", "m"), (4, "clean " * 30_000, "m"), (4, "clean " * 30_000, "m")], "doc_id int, text string, matches string")
    for size in (1_000_000, 10):
        monkeypatch.setattr(decontamination, "BLOCK_CHARS", size)
        got = sorted(match_items(docs, items).collect(), key=lambda r: r.doc_id)
        assert [[(m.item_id, m.distance) for m in r.matches] for r in got] == [[(1, 1), (4, 1)], [], [], [], []]
        kept = clean_documents(docs.withColumnRenamed("matches", "_matches"), items)
        assert kept.columns == ["doc_id", "text", "_matches"] and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 4]
    assert clean_documents(docs, items.limit(0)).count() == 5
    assert match_items(docs.limit(0), items).collect() == []


def test_query_finds_all_whole_passages(spark):
    sf = "/root/testdata/sf0.001"
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    whole = {(d.doc_id, b.item_id) for d in docs for b in items if normal(b.text) in normal(d.text)}
    got = op10_benchmark_decontamination(spark, sf).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.distance == 0} == whole
    texts, items = {d.doc_id: normal(d.text) for d in docs}, {b.item_id: normal(b.text) for b in items}
    assert all(table(items[r.item_id], texts[r.doc_id][r.start : r.end], True)[-1] == r.distance for r in got)
