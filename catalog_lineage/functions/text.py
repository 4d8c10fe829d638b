"""Text columns: cleaning, keys, expression patterns, secrets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..vocab import PREVIEW_SECRET_PATTERN, SECRET_PATTERN

WHITESPACE = " \t\n\r\x0b\x0c"
QUOTED = r"'(?:[^']++|'')*+'" + "|" + r'"(?:[^"]++|"")*+"'


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Text without outer whitespace; null becomes the empty string."""
    return F.coalesce(F.btrim(col(c).cast("string"), F.lit(WHITESPACE)), F.lit(""))


def token(c: Column | str) -> Column:
    return F.replace(F.upper(clean(c)), F.lit(" "), F.lit("_"))


def norm_key(c: Column | str) -> Column:
    """Key that ignores case and the amount of whitespace."""
    return F.lower(F.regexp_replace(clean(c), r"\s+", " "))


def match_value(c: Column | str) -> Column:
    """norm_key after one pair of surrounding quotes is taken off."""
    return norm_key(F.regexp_replace(clean(c), r"(?s)^(['\"])(.*)\1$", "$2"))


def is_blank(c: Column | str) -> Column:
    return clean(c) == ""


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(clean(c), F.lit(""))


def first_nonblank(*cols: Column | str) -> Column:
    return F.coalesce(*[F.when(~is_blank(c), col(c)) for c in cols])


def string_array(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def trim_all(c: Column) -> Column:
    return F.transform(c, lambda x: F.btrim(x, F.lit(WHITESPACE)))


def split_qualified(c: Column | str) -> Column:
    """Non-empty parts of a::b::c."""
    return F.filter(trim_all(F.split(clean(c), "::")), lambda x: x != "")


def split_parent_leaf(c: Column | str) -> tuple[Column, Column]:
    """Parent and leaf around the last dot; no dot means no parent."""
    text = clean(c)
    dot = F.contains(text, F.lit("."))
    parent = F.when(dot, clean(F.regexp_extract(text, r"(?s)^(.*)\.[^.]*$", 1))).otherwise(F.lit(""))
    leaf = F.when(dot, clean(F.substring_index(text, ".", -1))).otherwise(text)
    return parent, leaf


def _any_marker(text: Column, markers) -> Column:
    found = F.lit(False)
    for marker in markers:
        found = found | F.contains(text, F.lit(marker))
    return found


def is_dynamic(c: Column | str) -> Column:
    """Run-time expression or conventional variable name rather than a catalog name."""
    text = clean(c)
    return _any_marker(text, ("|", "${", "@{", "%", "&", "[", "]", "??")) | F.rlike(
        text, F.lit(r"^[snpv][A-Z_][A-Za-z0-9_]*$")
    )


def is_dynamic_expression(c: Column | str) -> Column:
    """The wider test used for paths and commands."""
    text = F.coalesce(col(c), F.lit(""))
    return _any_marker(text, ("|", "#", "${", "%", "&", "@{", "[", "]")) | F.rlike(
        text, F.lit(r"(?i)\b[vp][A-Za-z0-9_]+\b")
    )


def expression_pattern(c: Column | str) -> Column:
    """Shape of an expression, for profiling unresolved references."""
    text = clean(c)
    return (
        F.when(text == "<missing expression>", "MISSING_EXPRESSION")
        .when(F.rlike(text, F.lit(r"(?s)^(['\"]).*\1$")), "QUOTED_LITERAL")
        .when(F.rlike(text, F.lit(r"^[A-Za-z_][A-Za-z0-9_]*$")), "SIMPLE_VARIABLE")
        .when(F.contains(text, F.lit("|")), "CONCATENATION")
        .when(F.rlike(text, F.lit(r"^[A-Za-z_][A-Za-z0-9_]*\s*\(")), "FUNCTION_RESULT")
        .when(F.contains(text, F.lit("%")), "PARAMETER_OR_EXPAND_TOKEN")
        .when(F.rlike(text, F.lit(r"[\[\]{}]")), "STRUCTURED_EXPRESSION")
        .otherwise("COMPLEX_EXPRESSION")
    )


def redact(c: Column | str) -> Column:
    """struct(text, redacted): credential values replaced, and whether there was one."""
    text = clean(c)
    return F.struct(
        F.regexp_replace(text, SECRET_PATTERN, "$1=<redacted>").alias("text"),
        F.rlike(text, F.lit(SECRET_PATTERN)).alias("redacted"),
    )


def safe_preview(c: Column | str, limit: int = 160) -> Column:
    text = F.regexp_replace(clean(c), PREVIEW_SECRET_PATTERN, "$1=<redacted>")
    return F.nullif(F.left(text, F.lit(limit)), F.lit(""))


def unquote(c: Column | str) -> Column:
    """Value of one quoted literal with doubled quotes undone, null for anything else."""
    text = clean(c)
    inner = F.substr(text, F.lit(2), F.length(text) - 2)
    return (
        F.when(F.rlike(text, F.lit(r"^'(?:[^']++|'')*+'$")), F.replace(inner, F.lit("''"), F.lit("'")))
        .when(F.rlike(text, F.lit(r'^"(?:[^"]++|"")*+"$')), F.replace(inner, F.lit('""'), F.lit('"')))
    )


def is_identifier(c: Column | str) -> Column:
    return F.rlike(col(c), F.lit(r"^[A-Za-z_][A-Za-z0-9_]*$"))


def lenient_bool(c: Column | str) -> Column:
    value = F.lower(clean(c))
    return F.when(value.isin("true", "1", "yes"), True).when(value.isin("false", "0", "no"), False)


def lenient_int(c: Column | str, default: int | None = None) -> Column:
    number = clean(c).try_cast("int")
    return number if default is None else F.coalesce(number, F.lit(default))


def positive_int(c: Column | str, default: int = 1) -> Column:
    number = lenient_int(c)
    return F.when(number > 0, number).otherwise(F.lit(default))


def padded(c: Column | str, width: int = 4) -> Column:
    """Number as text with leading zeros; longer numbers stay whole."""
    number = col(c).cast("string")
    return F.when(F.char_length(number) < width, F.lpad(number, width, "0")).otherwise(number)


def only_item(array: Column | str) -> Column:
    values = col(array)
    return F.when(F.size(values) == 1, values[0])
