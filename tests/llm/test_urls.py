import itertools
import random
from collections import Counter

import duckdb
import pytest

from catalog_lineage.llm.urls import BAD, MIN_CONFIDENCE, ORACLES, RULES, judge, mine, op3_url_filter, url_tokens, host_and_path
from pyspark.sql import functions as F


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, rest[: min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))]


def given(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def test_parsing_and_given_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://A.ORG", "http://a.org/", "x://y://org/z", "https://Example.ORG/es/1?q#f", "http://m.example.org/en/12", "http://notexample.org/es/", "https://a.com/fr/", "https://a.com/de/x", "https://com/de/", "http://É.com/FR/", "http://a.com?x=/de/", "http://a.com#/de/", "http://org/\nfoo"]
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls)], "page_id int, url string, given string")
    rows = {r.page_id: r for r in judge(df, spark.createDataFrame([], "doc_id int, quality int, toxic int")).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        host, path = parsed(u)
        rule, verdict = given(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict, rows[i].given) == (host, path, rule, verdict or "allow", "c")


def rules_by_counting(transactions, support, confidence):
    """Minimal token sets that imply a bad page, by counting every set."""
    seen, bad = Counter(), Counter()
    for tokens, is_bad in transactions:
        for n in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), n):
                seen[c] += 1
                bad[c] += is_bad
    good = {c for c in seen if bad[c] / len(transactions) >= support and bad[c] / seen[c] >= confidence}
    return {c for c in good if not any(set(o) < set(c) for o in good)}


def test_mined_rules_and_matching(spark):
    pick = random.Random(8)
    pages, labels = [], []
    for i in range(600):
        section, shop = pick.choice(["spam", "news", "docs"]), pick.choice(["cheap", "fair"])
        pages.append((i, f"https://{shop}.site{pick.randint(1, 3)}.net/{section}/{pick.randint(1, 999)}" + pick.choice(["", "?ref=1"])))
        bad = section == "spam" and shop == "cheap"
        if i % 2 == 0:
            labels.append((i, int(not bad), 0))
    labels += [(None, 0, 0), (4, None, None)]
    df = spark.createDataFrame(pages + [(1, pages[1][1]), (None, None)], "page_id int, url string")
    marks = spark.createDataFrame(labels, "doc_id int, quality int, toxic int")
    host, path = host_and_path(F.col("url"))
    tokens = df.select("page_id", "url", url_tokens(F.col("url"), host, path).alias("tokens"))
    mined = {tuple(r.tokens) for r in mine(tokens, marks).collect()}
    bad = {d: q == 0 for d, q, t in labels if d is not None}
    transactions = [(r.tokens, bad[r.page_id]) for r in tokens.where("page_id is not null").collect() if bad.get(r.page_id) is not None]
    assert mined == rules_by_counting(transactions, 0.005, MIN_CONFIDENCE) == {("h:cheap", "p:spam")}
    for r in judge(df, marks).collect():
        assert r.verdict == ("block" if r.url and "cheap" in r.url and "/spam/" in r.url else "allow")
        assert BAD not in (r.mined_rule or "")


def test_rules_of_more_than_four_tokens(spark):
    pick, pages, labels = random.Random(4), [], []
    for i in range(640):
        # Six choices of two; the first five together are bad, and so is one pair of others.
        bits = [i >> k & 1 for k in range(6)]
        pages.append((i, "https://" + ".".join("ab"[b] + str("vwx"[k]) for k, b in enumerate(bits[:3])) + "/" + "/".join("ab"[b] + "yzt"[k] for k, b in enumerate(bits[3:]))))
        labels.append((i, int(not (all(bits[:5]) or (not bits[0] and not bits[5] and pick.random() < 0.9))), 0))
    df = spark.createDataFrame(pages, "page_id int, url string")
    marks = spark.createDataFrame(labels, "doc_id int, quality int, toxic int")
    host, path = host_and_path(F.col("url"))
    tokens = df.select("page_id", "url", url_tokens(F.col("url"), host, path).alias("tokens"))
    seen, bad = Counter(), Counter()
    for r in tokens.collect():
        for n in range(1, len(r.tokens) + 1):
            for c in itertools.combinations(sorted(r.tokens), n):
                seen[c] += 1
                bad[c] += not labels[r.page_id][1]
    good = {c for c in seen if bad[c] / len(pages) >= 0.005 and bad[c] / seen[c] >= MIN_CONFIDENCE}
    expected = {c for c in good if not any(set(o) < set(c) for o in good)}
    assert max(map(len, expected)) == 5 and min(map(len, expected)) == 2
    assert {tuple(r.tokens) for r in mine(tokens, marks).collect()} == expected
    verdicts = {r.page_id: r.verdict for r in judge(df, marks).collect()}
    assert all(verdicts[i] == "block" for i in range(640) if i & 31 == 31)


@pytest.mark.parametrize("length", [5, 7])
def test_sql_finds_long_rules(spark, length):
    pages, labels = [], []
    for i in range(512):
        bits = [i >> k & 1 for k in range(length + 1)]
        pages.append((i, "https://x.net/" + "/".join("ab"[b] + "rstuvwyz"[k] for k, b in enumerate(bits))))
        labels.append((i, 1, int(all(bits[:length]))))
    df, marks = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    con, parts = duckdb.connect(), {"pages": df.toPandas(), "labels": marks.toPandas()}
    for name, part in parts.items():
        con.register(name, part)
    sql = con.sql(ORACLES["op3_url_filter"])
    at = [sql.columns.index(c) for c in ("page_id", "verdict", "mined_rule")]
    got = {(r.page_id, r.verdict, r.mined_rule) for r in judge(df, marks).collect()}
    assert got == {tuple(r[i] for i in at) for r in sql.fetchall()}
    assert {len(rule.split()) for _, _, rule in got if rule} == {length}


def test_empty_tables(spark):
    pages, labels = spark.createDataFrame([], "page_id int, url string"), spark.createDataFrame([(1, 0, 1)], "doc_id int, quality int, toxic int")
    assert judge(pages, labels).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op3_url_filter(spark, sf).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == parsed(urls[r.page_id])
        rule, verdict = given(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or ("block" if r.mined_rule else "allow"))
