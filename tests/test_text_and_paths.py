from pyspark.sql import functions as F

from catalog_lineage.functions import classify, text
from catalog_lineage.operators import extract


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_keys_fold_case_and_whitespace(spark):
    assert column(spark, ["  A \t b ", None, ""], text.norm_key) == ["a b", "", ""]
    assert column(spark, ["'A  b'", '"x"', "'a\"", "'"], text.match_value) == ["a b", "x", "'a\"", "'"]


def test_unquote_needs_one_literal(spark):
    assert column(spark, ["'it''s'", '"a"', "'a' | 'b'", "x", "''"], text.unquote) == ["it's", "a", None, None, ""]


def test_quoted_credentials_are_redacted(spark):
    got = column(spark, ["password = 'a b'; x", "Token: abc", "nothing"], lambda c: text.redact(c)["text"])
    assert got == ["password=<redacted>; x", "Token=<redacted>", "nothing"]


def test_paths(spark):
    paths = ["C:/a/../b/./c.TXT", "//srv/share/x/../y.ps1", "a/../../b", "..", "https://h/p.js", "", "'in/f.csv'", "C:\\..\\x"]
    got = column(spark, paths, lambda c: F.concat_ws("|", classify.path_struct(c)["path"], classify.path_struct(c)["location_class"]))
    assert got == ["C:\\b\\c.TXT|LOCAL_ABSOLUTE", "\\\\srv\\share\\y.ps1|UNC", "..\\b|RELATIVE", "..|RELATIVE", "https://h/p.js|URL", "|UNKNOWN", "in\\f.csv|RELATIVE", "C:\\x|LOCAL_ABSOLUTE"]
    assert column(spark, ["a.b", ".bashrc", "x\\y.Tar.GZ", "noext", "a."], classify.extension) == [".b", "", ".gz", "", ""]


def test_command_words(spark):
    got = column(spark, ['cmd /c "a b.bat" x', "one 'two", "  "], lambda c: F.array_join(extract.F.filter(classify.command_tokens(c), lambda w: w != ""), "/"))
    assert got == ['cmd//c/"a b.bat"/x', "one/'two", ""]


def test_comments_leave_quotes_alone(spark):
    got = column(spark, ["x = 'a # b'; # c", "y /* z\n */ w // t", "'open # x"], lambda c: extract.strip_comments(c, ("#", "//", "/*")))
    assert got == ["x = 'a # b';", "y  w", "'open # x"]
    masked = column(spark, ["a /* b\n c */ d # e"], lambda c: extract.mask_comments(c, ("#", "/*")))
    assert masked == ["a     \n      d    "]


def test_arguments(spark):
    got = column(spark, ["F(a, 'x, (y', G(1, 2),, b)", "F()", "F( a ,)"], lambda c: F.array_join(extract.call_arguments(c), "~"))
    assert got == ["a~'x, (y'~G(1, 2)~~b", "", "a~"]


def test_nested_and_quoted_calls(spark):
    df = spark.createDataFrame([(1, "CELLPUTN(CELLGETN('A, (x)', DB('it''s', v1)), sTgt, 'm'); x = 'DB(1)'; CELLGETN('bad', (1")], "line_number int, line_text string")
    got = [(r["function_name"], len(r["arguments"])) for r in extract.extract_calls(df, ["CELLPUTN", "CELLGETN", "DB"]).collect()]
    assert sorted(got) == [("CELLGETN", 2), ("CELLPUTN", 3), ("DB", 2)]


def test_parenthesised_text_in_quotes_is_no_call(spark):
    df = spark.createDataFrame([("c", "['x'] = DB('Count (System)');\n# FOO(1)\nBAR(1;")], "cube_name string, rule_text string")
    got = [(r["function_name"], r["line_number"], r["is_complete"]) for r in extract.discovered_calls(df).collect()]
    assert sorted(got) == [("BAR", 3, False), ("DB", 1, True)]


def test_symbols_follow_the_order_of_lines(spark):
    code = "s = 'A';\nCELLGETN(s, 1);\ns = s | 'B';\nCELLGETN(s, 1);\ns = STR(1);\nCELLGETN(s, 1);\nCELLGETN('}ElementAttributes_D', e, 'Cap');"
    df = spark.createDataFrame([("p", "Prolog", code)], "process_name string, procedure string, code string")
    from catalog_lineage import vocab
    rows = extract.process_evidence(df, vocab.code_registry(spark)).collect()
    got = sorted((r["line_number"], r["target_type"], r["target_name"], r["confidence"]) for r in rows)
    assert got == [(2, "cube", "A", "RESOLVED"), (4, "cube", "AB", "RESOLVED"), (6, "cube", "s", "UNRESOLVED"), (7, "attribute", "D.Cap", "CONFIRMED")]
