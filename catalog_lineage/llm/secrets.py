"""Secret scan (operator 1): all rules in one combined deterministic automaton over bytes.

Every rule is compiled to positions, then to a deterministic automaton by subset construction; the rules' automata run side
by side in one product, which is minimised and laid out as a flat transition array over byte classes. One pass over the bytes
of a text finds the end of every leftmost, non-overlapping match of every rule; the start comes from the same rule compiled
backwards, walked only over matches. There is no backtracking and no second pass over a text.

Defined results: null and empty texts have no spans; spans are code points, end exclusive; each kind is matched alone, so kinds
may overlap; rows are never dropped, repeated rows stay, other columns of the input are carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_lineage.llm.common import table

DEAD = -1


@dataclass(frozen=True)
class Rule:
    """A kind, what it matches, and what a match must be as a whole to count (same pattern where None).

    The dialect: literals, \\xHH, escaped characters, [classes] with ranges and ^, groups, |, ?, *, +, {m}, {m,}, {m,n}; (?i) at
    the start for ASCII letters in either case. A rule must end in a repeat of one class or in a fixed character, so that a
    match grows byte by byte; compiling checks this.
    """

    kind: str
    pattern: str
    keep: str | None = None


_KEY = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: The first three kinds are given; the others are additions of this library.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", _KEY + r"[A-Za-z0-9+/_.=-]+", _KEY + r"[A-Za-z0-9+/_.=-]{8,}"),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----"),
)


# From a pattern to a nondeterministic automaton: fragments with one entry and one exit ------------------------------


class _Net:
    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.step.append(None)
        return len(self.free) - 1


def _parse(pattern: str) -> tuple:
    """A tree of ("set", bytes), ("cat", parts), ("or", parts) and ("rep", part, least, most)."""
    fold = pattern.startswith("(?i)")
    text, at = (pattern[4:] if fold else pattern), 0

    def either(values: set[int]) -> frozenset[int]:
        if fold:
            values = values | {ord(chr(v).swapcase()) for v in values if chr(v).isalpha() and v < 128}
        return frozenset(values)

    def one() -> int:
        nonlocal at
        c = text[at]
        at += 1
        if c != "\\":
            return ord(c)
        c = text[at]
        at += 1
        if c == "x":
            at += 2
            return int(text[at - 2 : at], 16)
        if c.isalnum():
            raise ValueError(f"not in the dialect: \\{c}")
        return ord(c)

    def bracket() -> frozenset[int]:
        nonlocal at
        negated = text[at] == "^"
        at += negated
        values: set[int] = set()
        while text[at] != "]":
            low = one()
            if text[at] == "-" and text[at + 1] != "]":
                at += 1
                values |= set(range(low, one() + 1))
            else:
                values.add(low)
        at += 1
        values = set(either(values))
        return frozenset(set(range(256)) - values if negated else values)

    def repeats() -> tuple[int, int | None] | None:
        nonlocal at
        c = text[at : at + 1]
        if c and c in "?*+":
            at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if m := re.match(r"\{(\d+)(,(\d*))?\}", text[at:]):
            at += m.end()
            return int(m[1]), (int(m[1]) if m[2] is None else int(m[3]) if m[3] else None)
        return None

    def branch() -> tuple:
        nonlocal at
        parts = []
        while at < len(text) and text[at] not in "|)":
            if text[at] == "(":
                at += 1
                part = choice()
                at += 1
            elif text[at] == "[":
                at += 1
                part = ("set", bracket())
            elif (v := one()) < 128:
                part = ("set", either({v}))
            else:
                part = ("cat", [("set", frozenset({b})) for b in chr(v).encode()])
            while (r := repeats()) is not None:
                part = ("rep", part, *r)
            parts.append(part)
        return ("cat", parts)

    def choice() -> tuple:
        nonlocal at
        parts = [branch()]
        while at < len(text) and text[at] == "|":
            at += 1
            parts.append(branch())
        return ("or", parts) if len(parts) > 1 else parts[0]

    tree = choice()
    if at != len(text):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return tree


def _build(net: _Net, tree: tuple, backwards: bool) -> tuple[int, int]:
    kind = tree[0]
    if kind == "set":
        a, b = net.state(), net.state()
        net.step[a] = (tree[1], b)
        return a, b
    if kind == "cat":
        a = b = net.state()
        for part in reversed(tree[1]) if backwards else tree[1]:
            x, y = _build(net, part, backwards)
            net.free[b].append(x)
            b = y
        return a, b
    a, b = net.state(), net.state()
    if kind == "or":
        for part in tree[1]:
            x, y = _build(net, part, backwards)
            net.free[a].append(x)
            net.free[y].append(b)
        return a, b
    _, part, least, most = tree
    at = a
    for _ in range(least):
        x, y = _build(net, part, backwards)
        net.free[at].append(x)
        at = y
    if most is None:
        x, y = _build(net, part, backwards)
        net.free[at].append(x)
        net.free[y].append(x)
        net.free[y].append(b)
    for _ in range((most or least) - least):
        net.free[at].append(b)
        x, y = _build(net, part, backwards)
        net.free[at].append(x)
        at = y
    net.free[at].append(b)
    return a, b


def _closure(net: _Net, states: list[int]) -> tuple[int, ...]:
    seen, stack = set(states), list(states)
    while stack:
        for t in net.free[stack.pop()]:
            if t not in seen:
                seen.add(t)
                stack.append(t)
    return tuple(sorted(s for s in seen))


@dataclass
class Automaton:
    """next[state][byte] is a state or DEAD; state 0 is the start."""

    next: list[list[int]]
    accepting: list[bool]


def _minimise(a: Automaton) -> Automaton:
    """Merges states that no text tells apart, by refining classes until they stay."""
    n = len(a.next)
    group = [int(x) for x in a.accepting]
    count = len(set(group))
    while True:
        keys: dict[tuple, int] = {}
        fresh = [keys.setdefault((group[s], *(DEAD if t == DEAD else group[t] for t in a.next[s])), len(keys)) for s in range(n)]
        if len(keys) == count:
            break
        group, count = fresh, len(keys)
    order = {group[0]: 0}
    for s in range(n):
        order.setdefault(group[s], len(order))
    rows: list[list[int]] = [[]] * count
    accepting = [False] * count
    for s in range(n):
        k = order[group[s]]
        if not rows[k]:
            rows[k] = [DEAD if t == DEAD else order[group[t]] for t in a.next[s]]
            accepting[k] = a.accepting[s]
    return Automaton(rows, accepting)


def compile_pattern(pattern: str, backwards: bool = False, search: bool = False) -> Automaton:
    """Subset construction. With search, the match may begin at any byte until one has been found: a state then is a list of
    sets by start, earliest first, and whatever began later than the first accepting start is cut, so the accepting run that
    follows belongs to the leftmost match. State 0 is also where a search goes on after a match."""
    net = _Net()
    begin, end = _build(net, _parse(pattern), backwards)
    first = _closure(net, [begin])

    def shift(states: tuple[int, ...], byte: int) -> tuple[int, ...]:
        return _closure(net, [net.step[s][1] for s in states if net.step[s] and byte in net.step[s][0]])

    known: dict[tuple, int] = {}
    todo: list[tuple] = []

    def number(key: tuple) -> int:
        if key not in known:
            known[key] = len(known)
            todo.append(key)
        return known[key]

    # Bytes that no set of the pattern tells apart share a transition.
    sets = list({s[0] for s in net.step if s})
    kinds: dict[tuple, int] = {}
    kind_of = [kinds.setdefault(tuple(b in s for s in sets), b) for b in range(256)]
    number((first,))
    rows, accepting, at = [], [], 0
    while at < len(todo):
        threads = todo[at]
        at += 1
        found = any(end in t for t in threads)
        accepting.append(found)
        by_kind: dict[int, int] = {}
        for byte in set(kind_of):
            seen: set[int] = set()
            after = []
            for t in threads:
                moved = tuple(s for s in shift(t, byte) if s not in seen)
                seen.update(moved)
                if moved:
                    after.append(moved)
                if end in moved:
                    break
            else:
                if search and not found:
                    after.append(first)
            by_kind[byte] = number(tuple(after)) if after else DEAD
        rows.append([by_kind[kind_of[b]] for b in range(256)])
    if accepting[0]:
        raise ValueError(f"matches the empty text: {pattern}")
    made = Automaton(rows, accepting)
    if search and any(t != DEAD and not accepting[t] for s, row in enumerate(rows) if accepting[s] for t in row):
        raise ValueError(f"a match of {pattern} may end before its last byte read; give it a tail that grows byte by byte")
    return _minimise(made)


class Scanner:
    """The combined automaton of some rules. After each byte the product holds one state of every rule's search automaton. A
    rule that leaves its accepting run has ended a match before this byte and starts anew with it."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.search = [compile_pattern(r.pattern, search=True) for r in rules]
        self.back = [compile_pattern(r.pattern, backwards=True) for r in rules]
        self.keep = [compile_pattern(r.keep) if r.keep else None for r in rules]
        self._combine()

    def _combine(self) -> None:
        classes: dict[tuple, int] = {}
        kind = [classes.setdefault(tuple(row[b] for a in self.search for row in a.next), len(classes)) for b in range(256)]
        sample = [kind.index(k) for k in range(len(classes))]
        width = len(classes)
        self.byte_class = bytes(kind)
        start = (0,) * len(self.search)
        known, todo, rows = {start: 0}, [start], []
        for key in todo:
            row = []
            for b in sample:
                # A dead end is only left by an accepting run: its rule searches on from the start with this byte.
                after = tuple(t if (t := a.next[s][b]) != DEAD else a.next[0][b] for a, s in zip(self.search, key))
                if after not in known:
                    known[after] = len(known)
                    todo.append(after)
                row.append(known[after])
            rows.append(row)
        inside = [sum(1 << i for i, (a, s) in enumerate(zip(self.search, key)) if a.accepting[s]) for key in todo]
        ends = [[sum(1 << i for i, (a, s) in enumerate(zip(self.search, key)) if a.accepting[s] and a.next[s][b] == DEAD) for b in sample] for key in todo]
        group, rows, inside, ends = self._merge(rows, inside, ends)
        # Quiet states first, so that one comparison per byte tells whether anything is matched.
        order = sorted(range(len(rows)), key=lambda s: bool(inside[s]))
        place = {s: i for i, s in enumerate(order)}
        self.start = place[group[0]] * width
        self.loud = sum(1 for s in order if not inside[s]) * width
        self.next = [place[t] * width for s in order for t in rows[s]]
        self.ends = [e for s in order for e in ends[s]]
        self.inside = [inside[s] for s in order]
        self.width = width

    @staticmethod
    def _merge(rows: list[list[int]], inside: list[int], ends: list[list[int]]) -> tuple:
        """Minimises the product by what it reports: rules inside a match, rules whose match a byte ends."""
        first: dict[tuple, int] = {}
        group = [first.setdefault((inside[s], *ends[s]), len(first)) for s in range(len(rows))]
        count = len(first)
        while True:
            keys: dict[tuple, int] = {}
            group2 = [keys.setdefault((group[s], *(group[t] for t in rows[s])), len(keys)) for s in range(len(rows))]
            if len(keys) == count:
                break
            group, count = group2, len(keys)
        head = {}
        for s, g in enumerate(group):
            head.setdefault(g, s)
        numbers = {g: i for i, g in enumerate(head)}
        return [numbers[g] for g in group], [[numbers[group[t]] for t in rows[s]] for s in head.values()], [inside[s] for s in head.values()], [ends[s] for s in head.values()]

    def match_ends(self, data: bytes) -> list[tuple[int, int]]:
        """(rule, end byte) of every match, by one pass over the bytes."""
        step, state, loud, ends = self.next, self.start, self.loud, self.ends
        found = []
        for i, c in enumerate(data.translate(self.byte_class)):
            if state >= loud and (bits := ends[state + c]):
                found += [(r, i) for r in range(len(self.rules)) if bits >> r & 1]
            state = step[state + c]
        bits = self.inside[state // self.width]
        return found + [(r, len(data)) for r in range(len(self.rules)) if bits >> r & 1]

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, by start, then rule."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        floor, spans = [0] * len(self.rules), []
        for r, end in self.match_ends(data):
            rows, accepting, state, begin = self.back[r].next, self.back[r].accepting, 0, end
            for i in range(end - 1, floor[r] - 1, -1):
                state = rows[state][data[i]]
                if state == DEAD:
                    break
                if accepting[state]:
                    begin = i
            floor[r] = end
            if self._counts(r, data[begin:end]):
                spans.append((begin, r, end))
        if len(data) != len(text) and spans:
            at, points, code = 0, 0, {}
            for b in sorted({x for s in spans for x in (s[0], s[2])}):
                points += len(data[at:b].decode("utf-8", "surrogatepass"))
                at = b
                code[b] = points
            spans = [(code[s], r, code[e]) for s, r, e in spans]
        return sorted(spans)

    def _counts(self, r: int, match: bytes) -> bool:
        keep = self.keep[r]
        if keep is None:
            return True
        state = 0
        for b in match:
            state = keep.next[state][b]
            if state == DEAD:
                return False
        return keep.accepting[state]


def scan_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", output: str = "secret_spans") -> DataFrame:
    """Adds array<struct<kind, start, end>> with all spans of all rules in each text; everything else of the input stays."""
    scanner = Scanner(rules)
    kinds = [r.kind for r in rules]

    @F.pandas_udf("array<struct<kind string, start int, end int>>")
    def spans(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([[(kinds[r], s, e) for s, r, e in scanner.scan(t)] for t in part], dtype=object)

    return df.withColumn(output, spans(F.col(text)))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("secret_spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(of(*BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
    )


def _matches_sql(rule: Rule, order: int) -> str:
    """Matches of one rule with the text before each; lengths add up to the places. Letters outside ASCII fold nowhere in the tables compared."""
    pattern = rule.pattern.replace("'", "''")
    keep = f"regexp_full_match(m, '{rule.keep.replace(chr(39), chr(39) * 2)}')" if rule.keep else "true"
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {order} AS ord, start, start + length(m) AS stop FROM (
    SELECT doc_id, m, sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m) AS start FROM (
      SELECT doc_id, unnest(range(len(f))) AS i, unnest(f) AS m, unnest(g[1:len(f)]) AS gap FROM (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS f, string_split_regex(coalesce(text, ''), '{pattern}') AS g FROM documents))
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE {keep}"""


def _oracle() -> str:
    found = " UNION ALL ".join(_matches_sql(r, i) for i, r in enumerate(RULES))
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    joined = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, ord)"
    return f"""
WITH found AS ({found})
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)},
  sha256(coalesce({joined} FILTER (kind IN ({base})), '')) AS base_sha256, coalesce({joined} FILTER (kind IS NOT NULL), '') AS spans
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""


ORACLES = {"op1_secret_scan": _oracle()}
