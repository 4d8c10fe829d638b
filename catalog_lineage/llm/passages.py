"""Repeated passages across documents (operator 9): seed on winnowed anchors, extend both ways, remove what is covered.

A window is WINDOW consecutive words. Of the SEED-word runs inside a window, the one with the smallest hash is its anchor, so
equal windows have equal anchors at the same place, and every window belongs to exactly one occurrence of an anchor.

1. Seeds: anchors that occur in more than one document join their documents. All others are left at once.
2. Extension: an occurrence reaches as far both ways as its windows do. Occurrences of an anchor that agree over their whole
   reach need no comparison: all but the one in the smallest document are covered.
3. The first ones of differing reach are extended window by window: each window of theirs is looked up by its content, and the
   smallest document that has it decides. Runs of covered windows make the maximal repeats.

Documents meet in aggregates by content only, never in pairs, so a passage that a third of all documents share costs one row for
each of them. Content is compared by hashes of 128 bits (anchor and reach, or two hashes of the window).

Words are unchanged runs of other than white space. Defined results: null texts have no words; documents of fewer than WINDOW words
keep all; a null id is smaller than nothing and nothing is smaller than it; rows with equal ids do not cover each other; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from catalog_lineage.llm.common import Words, cut, likely_in, mix, packed, powers, rolling, separators, steps, table, within

WINDOW, SEED = 50, 10
_SPACE = separators("space")


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest value of each run of `width`; minima of doubling runs are put together."""
    n = len(values) - width + 1
    at = np.arange(len(values))
    span = 1
    while span * 2 <= width:
        left, right = at[:-span], at[span:]
        at = np.where(values[right] < values[left], right, left)
        span *= 2
    left, right = at[:n], at[width - span : width - span + n]
    return np.where(values[right] < values[left], right, left)


def _anchors(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Occurrences of anchors: text, anchor, hash of the reach, first and last window (by first word, within the text)."""
    w = Words(texts, _SPACE)
    start, doc = within(w.first, WINDOW)
    if not len(start):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    seeds = rolling(w.hash, SEED)
    at = _first_least(seeds, WINDOW - SEED + 1)[start]
    edge = np.ones(len(start), bool)
    edge[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(edge)
    last = np.append(begin[1:], len(start)) - 1
    low, high, anchor, owner = start[begin], start[last], at[begin], doc[begin]
    # Hash of all words of the reach: each times the power of its place, divided by the power of the anchor's place.
    sums = np.zeros(len(w.hash) + 1, np.uint64)
    power, inverse = powers(len(w.hash))
    np.cumsum(mix(w.hash) * power[: len(w.hash)], out=sums[1:])
    reach = mix((sums[high + WINDOW] - sums[low]) * inverse[anchor]) ^ mix((anchor - low).astype(np.uint64) << np.uint64(32) | (high - anchor + WINDOW).astype(np.uint64))
    first = w.first[owner]
    return owner, seeds[anchor].view(np.int64), reach.view(np.int64), low - first, high - first


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        owner, anchor, reach, low, high = _anchors(batch.column(2))
        if len(owner):
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(reach), batch.column(0).take(take), batch.column(1).take(take), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                ["anchor", "reach", "doc_id", "version", "low", "high"],
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content hashes of the wanted windows of each text (doc_id, version, text, spans)."""
    for batch in steps(batches):
        w = Words(batch.column(2), _SPACE)
        one, two = rolling(w.hash, WINDOW), rolling(mix(w.hash + np.uint64(1)), WINDOW)
        owners, starts = [], []
        for i, spans in enumerate(batch.column(3).to_pylist()):
            marks = np.zeros(w.first[i + 1] - w.first[i] + 1, np.int32)
            for s in spans:
                marks[s["low"]] += 1
                marks[s["high"] + 1] -= 1
            at = np.flatnonzero(np.cumsum(marks) > 0)
            starts.append(at)
            owners.append(np.full(len(at), i))
        owner, start = np.concatenate(owners), np.concatenate(starts)
        at, take = w.first[owner] + start, pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int32))],
            ["one", "two", "doc_id", "version", "low"],
        )


def _version() -> Column:
    """Digest of the text, which tells the texts of one id apart."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _spans(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id", "version").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, version (digest of the text) and spans: the first words of windows that a document with a smaller id has as well, as
    runs low to high. A row's list is bounded by its document."""
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), _version().alias("version"), "text")
    schema = "anchor long, reach long, doc_id long, version binary, low int, high int"
    occurrences = texts.mapInArrow(_occurrences, schema)
    seeds = occurrences.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("anchor")
    joined = cut(occurrences.join(seeds, "anchor"))
    reaches = cut(joined.groupBy("anchor", "reach").agg(F.min("doc_id").alias("least")))
    labelled = joined.join(reaches, ["anchor", "reach"])
    covered = labelled.where("doc_id > least").select("doc_id", "version", "low", "high")
    forked = reaches.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    firsts = labelled.where("doc_id = least").join(forked, "anchor").select("doc_id", "version", "low", "high")

    wanted = cut(_spans(firsts))
    asked = likely_in(texts, "doc_id", wanted.select("doc_id")).join(wanted, ["doc_id", "version"]).select("doc_id", "version", "text", "spans").dropDuplicates(["doc_id", "version"])
    windows = cut(asked.mapInArrow(_windows, "one long, two long, doc_id long, version binary, low int"))
    least = windows.groupBy("one", "two").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("one", "two", "x")
    extended = windows.join(least, ["one", "two"]).where("doc_id > x").select("doc_id", "version", "low", F.col("low").alias("high"))
    return _spans(covered.unionByName(extended))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Adds n_words, n_removed and kept_text (the kept words joined by one space) to every row."""
    own = docs.drop("n_words", "n_removed", "kept_text")
    spans = cut(repeated_windows(docs))

    keys = packed(own, version=_version(), doc_id=F.col("doc_id").cast("long"))
    marked = likely_in(keys.where("doc_id is not null"), "doc_id", spans.select("doc_id"), keep="may")
    nothing = F.lit(None).cast(spans.schema["spans"].dataType)
    # Rows that surely have no spans need no join.
    joined = marked.where("may").join(spans, ["doc_id", "version"], "left").select("_row", "spans")
    plain = marked.where("not may").unionByName(keys.where("doc_id is null"), allowMissingColumns=True).select("_row", nothing.alias("spans"))
    rows = joined.unionByName(plain)
    added = "n_words long, n_removed long, kept_text string"
    return rows.mapInArrow(_cleaned, T.StructType([rows.schema["_row"], *T.StructType.fromDDL(added).fields])).select("_row.*", "n_words", "n_removed", "kept_text")


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).field("text").cast(pa.string()).fill_null("")
        yield from _kept(pa.RecordBatch.from_arrays([batch.column(0), texts, batch.column(1)], ["_row", "text", "spans"]))


def _kept(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for batch in steps(iter([whole]), limit=1 << 21):
        totals, removed, texts = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            words = text.as_buffer().to_pybytes().split()
            totals.append(len(words))
            if spans.is_valid and len(spans.values):
                marks = np.zeros(len(words) + 1, np.int32)
                np.add.at(marks, spans.values.field("low").to_numpy(), 1)
                np.add.at(marks, spans.values.field("high").to_numpy() + WINDOW, -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(marks)[:-1] == 0)]
            removed.append(totals[-1] - len(words))
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], ["_row", "n_words", "n_removed", "kept_text"])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Every window by its digest, and the least document that has it.
ORACLES = {
    "op9_substring_dedup": rf"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + {WINDOW - 1} <= len(w) THEN md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) END AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM listed)
),
judged AS (SELECT doc_id, i, word, (k IS NOT NULL AND min(doc_id) OVER (PARTITION BY k) < doc_id)::INT AS again FROM words),
covered AS (SELECT doc_id, i, word, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM judged)
SELECT l.doc_id, count(i) AS n_words, count(i) FILTER (gone = 1) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
FROM listed l LEFT JOIN covered c ON c.doc_id = l.doc_id GROUP BY l.doc_id
""",
}
