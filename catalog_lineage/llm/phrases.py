"""Document fingerprints (operator 13): the set of Lempel-Ziv phrases of a text, as a minimum-hash signature.

A text is parsed into phrases, each the longest one met before and one more character, so the set of phrases is what a dictionary
compressor learns from the text, and texts that would help to compress each other share phrases. The phrases are hashed from sums over
the text; a hash falls into one of BUCKETS buckets, each of which keeps its smallest, by 16 bits. The share of equal buckets among those
that are not empty in both estimates the Jaccard likeness of the two phrase sets.

Neighbours: `edited` compares each document with an edited text whose end is the beginning of the next document, by descending id.
Keys (id and two hashes of the text) are numbered and cut into ranges of equal counts; the first key of each range, one for each
shuffle partition, is all that the driver gets. Then every text crosses one shuffle, to its range, the first of a range also to the end
of the range before it, and each task streams its sorted range with two texts in hand. The first half of a text is parsed once for
both itself and its edited text.

Defined results: a null text is empty; an empty text has an empty fingerprint, like to another empty one by 1 and to others by 0; a null
id comes after all others; rows equal in id and text are one document for the order and each gets its result; rows of one id and
different texts are ordered by hashes of the text; the last document is followed by the first, a single one by itself; an empty table
gives no rows; `fingerprints` keeps other columns, replacing one named fingerprint, `edited` does not read them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from catalog_lineage.llm.common import mix, numbered, powers, table, text_or_empty

BUCKETS = 256
_BITS = np.uint64(BUCKETS.bit_length() - 1)
_EMPTY = 0xFFFF
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Phrases:
    """The parse of a text so far. Nodes of the dictionary are numbers, 0 is the empty phrase."""

    __slots__ = ("children", "node", "size", "ends")

    def __init__(self, before: Phrases | None = None):
        self.children: dict[tuple[int, str], int] = dict(before.children) if before else {}
        self.node, self.size, self.ends = (before.node, before.size, before.ends.copy()) if before else (0, 0, [])

    def read(self, text: str) -> Phrases:
        children, node, found, ended = self.children, self.node, self.children.get, self.ends.append
        for at, letter in enumerate(text, self.size + 1):
            step = node, letter
            node = found(step)
            if node is None:
                children[step] = len(children) + 1
                ended(at)
                node = 0
        self.node = node
        self.size += len(text)
        return self

    def signature(self, text: str) -> np.ndarray:
        """Smallest hash of each bucket, given the whole text read. What is left after the last phrase is a phrase already."""
        out = np.full(BUCKETS, _EMPTY, ">u2")
        if not self.ends:
            return out
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        power, inverse = powers(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mix(points + _ODD) * power[: len(points)], out=sums[1:])
        end = np.array(self.ends)
        start = np.concatenate([[0], end[:-1]])
        hashes = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _ODD)
        hashes.sort()
        bucket = (hashes >> (np.uint64(64) - _BITS)).astype(np.int64)
        least = np.flatnonzero(np.diff(bucket, prepend=-1))
        out[bucket[least]] = hashes[least] % np.uint64(_EMPTY)
        return out


def signature(text: str) -> np.ndarray:
    return Phrases().read(text).signature(text)


def likeness_of(a: np.ndarray, b: np.ndarray) -> float:
    filled = (a != _EMPTY) | (b != _EMPTY)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


@F.pandas_udf(T.StringType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: signature(t).tobytes().hex())


@F.pandas_udf(T.DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    read = lambda s: None if s is None else np.frombuffer(bytes.fromhex(s), ">u2")
    return pd.Series([None if x is None or y is None else likeness_of(read(x), read(y)) for x, y in zip(a, b)], dtype="float64")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Adds the fingerprint of its text to every row."""
    return docs.withColumn("fingerprint", _fingerprint(text_or_empty()))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1; null where one is."""
    return _likeness(a, b)


# Each document and the next -------------------------------------------------------------------------------------------

_KEY = ["no_id", "down", "one", "two"]
_DEALT = "range int, ahead boolean, no_id boolean, down long, one long, two long, n long, text string"
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with keys whose ascending order is the order of documents."""
    text = text_or_empty()
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.isnull(doc_id).alias("no_id"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).cast("long").alias("down"),
        F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two"), text.alias("text"),
    )


def _dealer(heads: list[tuple]):
    """Gives texts their ranges; equal rows of a batch become one with their number."""
    known = {h: i for i, h in enumerate(heads)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[tuple, int] = {}
            times: dict[tuple, int] = {}
            for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                first.setdefault(key, i)
                times[key] = times.get(key, 0) + 1
            rows = [(bisect_right(heads, key) - 1, False, i, times[key]) for key, i in first.items()]
            rows += [((known[key] - 1) % len(heads), True, i, 0) for key, i in first.items() if key in known]
            if rows:
                to, ahead, at, n = zip(*rows)
                taken = batch.take(pa.array(at))
                columns = [pa.array(to, pa.int32()), pa.array(ahead), *taken.columns[:4], pa.array(n, pa.int64()), taken.column(4)]
                yield pa.RecordBatch.from_arrays(columns, ["range", "ahead", *_KEY, "n", "text"])

    return deal


class _Document:
    """A text in hand: its parse up to the place where the edited text leaves it, and its signature."""

    def __init__(self, key: tuple, text: str):
        self.key, self.text, self.n = key, text, 0
        self.kept = len(text) - len(text) // 2
        half = Phrases().read(text[: self.kept])
        self.half = Phrases(half)
        self.signature = half.read(text[self.kept :]).signature(text)

    def beside(self, following: _Document) -> tuple:
        end = following.text[: len(self.text) - self.kept]
        edited = self.text[: self.kept] + end
        signature = self.half.read(end).signature(edited)
        return (
            None if self.key[0] else ~self.key[1], len(self.text), hashlib.sha256(edited.encode()).hexdigest(), self.signature.tobytes().hex(),
            signature.tobytes().hex(), likeness_of(self.signature, signature), likeness_of(self.signature, following.signature),
        )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted ranges; each document is finished when the next one comes. Every range ends with the first of the next range."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held: _Document | None = None
    for batch in batches:
        rows: list[tuple] = []
        for i in range(batch.num_rows):
            to, ahead, *key, n, text = (column[i] for column in batch.columns)
            place = (to.as_py(), *(k.as_py() for k in key))
            last = ahead.as_py()
            if held is None and last:
                continue  # a further copy of it
            if held and not last and (held_range, *held.key) == place:
                held.n += n.as_py()
                continue
            now = _Document(place[1:], text.as_py())
            if held:
                rows += [held.beside(now)] * held.n
            held, held_range = None if last else now, place[0]
            now.n = n.as_py()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def edited(docs: DataFrame) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, n_chars, digest of the edited text, both fingerprints, and the likeness of its own to
    that of the edited text and that of the next document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs)
    places, total = numbered(keyed.select(*_KEY).distinct(), *(F.col(k) for k in _KEY), name="place")
    # One key for each range.
    heads = [tuple(r) for r in places.where(F.col("place") % max(1, -(-total // parts)) == 0).select(*_KEY).collect()]
    dealt = keyed.mapInArrow(_dealer(sorted(heads)), _DEALT)
    sent = dealt.repartitionById(max(1, len(heads)), F.col("range"))
    return sent.sortWithinPartitions("range", "ahead", *_KEY).mapInArrow(_chained, _RESULT)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
