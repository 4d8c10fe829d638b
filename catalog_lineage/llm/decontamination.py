"""Benchmark decontamination (operator 10): pigeonhole edit matching.

Texts and items are lower-cased runs of letters and digits joined by one space, with a space at either end. An item of n characters
may differ by EDIT_RATE * n edits. It is split into one piece more than that: whatever the edits, one piece stays whole. All pieces
of all items are found in one pass by a keyword automaton; around each hit the item is verified by Myers' bit-parallel distance.

The items are a stated set that is matched against all rows in blocks of at most BLOCK_CHARS characters (or one item). The driver
streams them and holds one block; blocks are matched one after the other, with the rows and what was found so far written in between,
so neither a task nor the driver holds more as the benchmark grows. A benchmark of one block is matched in one pass without a write.

Defined results: null texts and texts without words match nothing; items without words are left out; equal items are reported each
under its own id; repeated rows are reported each; an empty benchmark matches nothing. An item that stands in a text several times is
reported for every place. Ends within the budget that are next to each other are one place: its nearest end counts, of equal ones the
first, and of the parts that end there the shortest of the smallest distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_lineage.llm.common import cut, free_name, table

EDIT_RATE, BLOCK_CHARS = 0.08, 1_000_000
_OTHER = re.compile(r"[\W_]+")
_MATCHES = "array<struct<item_id long, distance int, start int, end int>>"


def normal(text: str | None) -> str:
    words = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if words else ""


def scores(pattern: str, masks: dict[str, int], text: str, anchored: bool = False) -> Iterator[int]:
    """For each place in the text, the smallest edit distance between the pattern and a part that ends there (and, if anchored,
    starts where the text does)."""
    m = len(pattern)
    top, full, carry = 1 << (m - 1), (1 << m) - 1, int(anchored)
    plus, minus, score = full, 0, m
    for c in text:
        equal = masks.get(c, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full | carry, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        yield score


def _masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def places(pattern: str, masks: dict[str, int], text: str, budget: int) -> list[tuple[int, int]]:
    """(distance, end) of every place: of each stretch of adjacent ends within the budget the nearest, of equal ones the first."""
    out, best = [], None
    for i, score in enumerate(scores(pattern, masks, text), 1):
        if score > budget:
            if best:
                out.append(best)
            best = None
        elif best is None or score < best[0]:
            best = (score, i)
    return [*out, best] if best else out


class Matcher:
    """The pieces of one block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, p, int(rate * len(p))) for i, p in items]
        self.masks: dict[int, tuple] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, p, budget) in enumerate(self.items):
            cuts = [len(p) * j // (budget + 1) for j in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                found.setdefault(p[a:b], []).append((k, b))
        self.pieces = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.pieces.add_word(piece, owners)
        self.pieces.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) in the normal text, of every place of every item, by item id."""
        t = normal(text)
        if not t:
            return []
        starts: dict[int, list[int]] = {}
        for end, owners in self.pieces.iter(t):
            for k, b in owners:
                starts.setdefault(k, []).append(end + 1 - b)
        out = []
        for k, begins in starts.items():
            item, p, budget = self.items[k]
            if k not in self.masks:
                self.masks[k] = (_masks(p), p[::-1], _masks(p[::-1]))
            forward, back, masks = self.masks[k]
            low, high = None, 0
            for s in [*sorted(set(begins)), None]:
                if low is not None and (s is None or s - budget > high):
                    for distance, end in places(p, forward, t[low:high], budget):
                        at = low + end
                        before = list(scores(back, masks, t[max(0, at - len(p) - budget) : at][::-1], True))
                        out.append((item, distance, at - 1 - before.index(min(before)), at))
                    low = None
                if s is not None:
                    low = max(0, s - budget) if low is None else low
                    high = min(len(t), s + len(p) + budget)
        return sorted(out)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one at a time on the driver."""
    block, size = [], 0
    for row in items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        p = normal(row["text"])
        if not p:
            continue
        if block and size + len(p) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], p))
        size += len(p)
    if block:
        yield block


def match_items(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE, output: str = "matches") -> DataFrame:
    """Adds array<struct<item_id, distance, start, end>> of the items found in each text; start and end are places in the normal text."""

    def found_in(block: list[tuple[int, str]]):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        @F.pandas_udf(_MATCHES)
        def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = Matcher(shared.value, rate)
            for texts in parts:
                yield pd.Series([matcher.matches(t) for t in texts], dtype=object)

        return found(F.col(text))

    # The text is read under a name of its own, as the output may replace the column.
    text = free_name(docs, "_text")
    out = docs.withColumn(text, F.col("text")).withColumn(output, F.array().cast(_MATCHES))
    for i, block in enumerate(item_blocks(items)):
        out = (cut(out) if i else out).withColumn(output, F.concat(output, found_in(block)))
    return out.drop(text)


def clean_documents(docs: DataFrame, items: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of docs in whose text no item is found."""
    name = free_name(docs, "_matches")
    return match_items(docs, items, rate, name).where(F.size(name) == 0).drop(name)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match_items(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
