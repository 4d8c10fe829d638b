import random
import re

import pytest

from catalog_lineage.llm.secrets import RULES, Rule, Scanner, compile_pattern, op1_secret_scan, scan_secrets

KEY = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SCANNER = Scanner(RULES)


def plain(text):
    out = [(m.start(), 0, m.end()) for m in KEY.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])


def test_base_kinds_agree_with_regular_expressions():
    pick = random.Random(4)
    parts = ["password", "Passwd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdefgh", "AKIA", "AKIAAB12CD34", "a1", "0123456789abcdef", "é", "ſ", "\n", "x", "/", "0" * 16, "ABCD", "secretoken"]
    found = 0
    for _ in range(5000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        expected = plain(text)
        found += len(expected)
        assert [s for s in SCANNER.scan(text) if s[1] < 3] == expected, text
    assert found > 500


def test_a_failing_match_still_consumes():
    assert SCANNER.scan("password: secret: abcdefghij") == []
    assert SCANNER.scan("password: 'secret:' token=abcdefghij") == [(20, 0, 36)]


def test_added_kinds_and_code_points():
    text = "é " + "ghp_" + "A1b2" * 9 + " -----BEGIN RSA PRIVATE KEY----- eyJabc.eyJdef.x-y"
    kinds = [(RULES[r].kind, text[s:e]) for s, r, e in SCANNER.scan(text)]
    assert kinds == [("forge", "ghp_" + "A1b2" * 9), ("private_key", "-----BEGIN RSA PRIVATE KEY-----"), ("web_token", "eyJabc.eyJdef.x-y")]


def test_rules_whose_end_is_not_seen_at_once_are_refused():
    with pytest.raises(ValueError):
        compile_pattern("ab(cd)*", search=True)
    with pytest.raises(ValueError):
        compile_pattern("a*")


def test_custom_rules_with_counts_and_classes():
    s = Scanner((Rule("a", r"x[^y]{2,3}"), Rule("b", r"q(1|22)")))
    assert s.scan("xaabxy q22q1") == [(0, 0, 4), (7, 1, 10), (10, 1, 12)]


def test_nulls_empty_long_and_clashing_columns(spark):
    long_text = "word " * 60_000 + "token=abcdefgh"
    rows = [(1, None, "x"), (2, "", "y"), (3, long_text, None), (3, long_text, None)]
    out = scan_secrets(spark.createDataFrame(rows, "doc_id int, text string, secret_spans string")).collect()
    assert [len(r.secret_spans) for r in out] == [0, 0, 1, 1]
    assert out[2].secret_spans[0].start == 300_000
    assert scan_secrets(spark.createDataFrame([], "doc_id int, text string")).collect() == []


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    names = ["assign", "access", "hex"]
    for r in op1_secret_scan(spark, sf).collect():
        expected = plain(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in expected) for i in range(3)]
        base = [s for s in r.spans.split(",") if s.split(":")[0] in names]
        assert base == [f"{names[k]}:{a}:{b}" for a, k, b in expected]
