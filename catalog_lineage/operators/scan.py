"""Small text scanners for code: one flat regular expression finds the tokens, a running stack pairs the parentheses.

However deep a text nests, a scan is one pass over it. The functions at the end wrap them as Arrow-batched column functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, functions as F

from ..functions.text import QUOTED, WHITESPACE

_OPEN = r"['\"][\s\S]*"
_ENDS = re.compile(rf"{QUOTED}|{_OPEN}|[();]")
_PARTS = re.compile(rf"{QUOTED}|[()|'\"]")
_ARGUMENTS = re.compile(rf"{QUOTED}|[(),]")


def pairs(text: str, tokens: re.Pattern) -> dict[int, int]:
    """Place of each '(' that closes, with the place of its ')'."""
    found, stack = {}, []
    for m in tokens.finditer(text):
        if m[0] == "(":
            stack.append(m.start())
        elif m[0] == ")" and stack:
            found[stack.pop()] = m.start()
    return found


def split_top(text: str, tokens: re.Pattern, mark: str) -> list[str]:
    """The text cut at each mark outside quotes and closed parentheses."""
    closed, at, skip, out = pairs(text, tokens), 0, -1, []
    for m in tokens.finditer(text):
        if m.start() <= skip:
            continue
        if m[0] == "(":
            skip = closed.get(m.start(), skip)
        elif m[0] == mark:
            out.append(text[at : m.start()])
            at = m.end()
    return [*out, text[at:]]


def statements(text: str, rest_in_open: bool) -> list[tuple[str, int]]:
    """Statements with their ';' and the line breaks before each. After a '(' that never closes, the rest is one statement with
    rest_in_open; without, it is read as any other sign."""
    ends, opened = [], []
    for m in _ENDS.finditer(text):
        sign = m[0]
        if sign == "(":
            opened.append(len(ends))
        elif sign == ")":
            if opened:
                # what lies in a closed parenthesis ends no statement
                del ends[opened.pop():]
        elif sign == ";":
            ends.append(m.end())
    if opened and rest_in_open:
        del ends[opened[0]:]
    at, lines, out = 0, 0, []
    for end in ends:
        out.append((text[at:end], lines))
        lines += text.count("\n", at, end)
        at = end
    return [*out, (text[at:], lines)]


def arguments(inside: str) -> list[str]:
    """Trimmed arguments between the parentheses of a call."""
    return [a.strip(WHITESPACE) for a in split_top(inside, _ARGUMENTS, ",")] if inside.strip(WHITESPACE) else []


def concat_parts(text: str) -> list[str]:
    return [p.strip(WHITESPACE) for p in split_top(text, _PARTS, "|")]


def name_pattern(names: str) -> re.Pattern:
    """Tokens of a text with calls; the look ahead keeps the alternatives to words that a '(' follows."""
    return re.compile(rf"{QUOTED}|{_OPEN}|[(),\n]|\b(?=\w++\s*\()(?P<name>{names})(?=\s*\()", re.I | re.A)


def calls(text: str, names: re.Pattern, complete: bool = True) -> list[tuple[str, str | None, int, list[str]]]:
    """(name, call or null if it never closes, line, arguments) of each named call, in order; quoted text holds none."""
    line, named, stack, found = 1, None, [], []
    for m in names.finditer(text):
        sign = m[0]
        if sign == "(":
            # the call it opens, where its argument begins, and the arguments before
            stack.append((named, m.end(), []))
            named = None
        elif sign == ")":
            if stack:
                call, at, before = stack.pop()
                if call is not None:
                    last = text[at : m.start()].strip(WHITESPACE)
                    call[1], call[3] = text[call[4] : m.end()], [*before, last] if before or last else []
        elif sign == ",":
            if stack:
                call, at, before = stack[-1]
                before.append(text[at : m.start()].strip(WHITESPACE))
                stack[-1] = call, m.end(), before
        elif m["name"]:
            named = [sign, None, line, [], m.start()]
            found.append(named)
        else:
            line += sign.count("\n")
    return [(name, call, at, args) for name, call, at, args, _ in found if call is not None or not complete]


# Symbols -----------------------------------------------------------------------------------------------------------

_SINGLE, _DOUBLE = re.compile(r"'(?:[^']++|'')*+'"), re.compile(r'"(?:[^"]++|"")*+"')
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def read_parts(expression: str) -> list[tuple[bool, str]] | None:
    """(is a literal, its text or the variable's key) of each part joined by '|', or null where a part is neither."""
    out = []
    for part in concat_parts(expression):
        if _SINGLE.fullmatch(part):
            out.append((True, part[1:-1].replace("''", "'")))
        elif _DOUBLE.fullmatch(part):
            out.append((True, part[1:-1].replace('""', '"')))
        elif _IDENTIFIER.fullmatch(part):
            out.append((False, part.lower()))
        else:
            return None
    return out


_read_short = lru_cache(maxsize=10_000)(read_parts)


def value_of(expression: str | None, known: dict[str, str | None]) -> str | None:
    """The text an expression stands for, or null: literals and variables, joined by '|'."""
    if expression is None:
        return None
    # short expressions come again and again
    parts = _read_short(expression) if len(expression) <= 200 else read_parts(expression)
    if parts is None:
        return None
    if len(parts) == 1:
        literal, text = parts[0]
        return text if literal else known.get(text)
    values = [text if literal else known.get(text) for literal, text in parts]
    return None if None in values else "".join(values)


def resolve_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by scope and seq, assignments (kind 0) before uses (kind 1): the uses with the values of their expressions."""
    scope, known, waiting, waits_at = object(), {}, {}, None
    for batch in batches:
        uses, values = [], []
        for i, (of, seq, kind, variable, expressions) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)))):
            if of != scope:
                scope, known, waiting = of, {}, {}
            if waiting and (kind or seq != waits_at):
                known |= waiting
                waiting = {}
            found = [None if e is None else value_of(e, known) for e in expressions or []]
            if kind:
                uses.append(i)
                values.append(found)
            else:
                waiting[variable], waits_at = found[0], seq
        if uses:
            yield pa.RecordBatch.from_arrays([batch.column(5).take(pa.array(uses)), pa.array(values, pa.list_(pa.string()))], ["payload", "resolved_values"])


# Column functions --------------------------------------------------------------------------------------------------
#
# Code repeats itself, so each batch is scanned by its distinct texts, and results are built as flat columns.


def _lists(rows: list[list], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, rows))], pa.int32()), values)


def _by_distinct(c: Column, kind: str, scan) -> Column:
    """``scan`` maps a list of texts, none of them null, to an array of as many lists; null texts give null."""

    @F.arrow_udf(kind)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            coded = part.dictionary_encode()
            yield scan(coded.dictionary.to_pylist()).take(coded.indices)

    return run(c)


def statement_rows(c: Column, rest_in_open: bool) -> Column:
    """array<struct<text, lines_before>>."""

    def scan(texts: list[str]) -> pa.Array:
        rows = [statements(t, rest_in_open) if t else [] for t in texts]
        parts = [s for row in rows for s in row]
        return _lists(rows, pa.StructArray.from_arrays([pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.int32())], ["text", "lines_before"]))

    return _by_distinct(c, "array<struct<text string, lines_before int>>", scan)


def call_rows(c: Column, names: str, complete: bool = True) -> Column:
    """array<struct<name, call, line, arguments>>."""

    def scan(texts: list[str]) -> pa.Array:
        pattern = name_pattern(names)
        rows = [calls(t, pattern, complete) for t in texts]
        found = [call for row in rows for call in row]
        given = [call[3] for call in found]
        columns = [pa.array([call[i] for call in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32()))]
        listed = _lists(given, pa.array([a for args in given for a in args], pa.string()))
        return _lists(rows, pa.StructArray.from_arrays([*columns, listed], ["name", "call", "line", "arguments"]))

    return _by_distinct(c, "array<struct<name string, call string, line int, arguments array<string>>>", scan)


def argument_rows(c: Column) -> Column:
    """Arguments of a whole call."""

    def scan(texts: list[str]) -> pa.Array:
        rows = [arguments(t[t.index("(") + 1 : -1]) if "(" in t else [] for t in texts]
        return _lists(rows, pa.array([a for row in rows for a in row], pa.string()))

    return _by_distinct(c, "array<string>", scan)


def nested_parts(c: Column) -> Column:
    """concat_parts of texts with parentheses; null stays null."""

    def scan(texts: list[str]) -> pa.Array:
        rows = [concat_parts(t) for t in texts]
        return _lists(rows, pa.array([p for row in rows for p in row], pa.string()))

    return _by_distinct(c, "array<string>", scan)
