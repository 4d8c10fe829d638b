"""Spelling variant grouping (operator 11): one-edit neighbourhoods over a reduced alphabet, verified on the words themselves.

1. Words: letter runs are counted for each batch of documents, then added up, so a frequent word is one small row for each batch.
2. Every letter is hashed to one of SYMBOLS symbols. Words that differ by one code point have reduced words that are equal or differ by
   one symbol. A word hands out the keys of its reduced word, of all its one-symbol deletions and of all its replacements by a smaller
   symbol. Insertions and replacements by a larger symbol are the same links seen from the other word, which hands those out, so
   both halves together are the full neighbourhood and each pair is met once.
3. Keys meet the keys of the reduced vocabulary in a join, and the pairs are verified by edit distance on the words. A key is a 64-bit
   polynomial hash, so a very long word costs a few numbers for each letter, never a copy of itself.
4. A word's form is its near word of largest count, if that is FACTOR times its own. Forms are followed to the last by pointer doubling.

Defined results: null texts have no words; a null id is written as nothing before the colon; repeated rows count again; ties between
forms go to the smallest in code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_lineage.llm.common import cut, mix, table

LEAST_LENGTH, LEAST_COUNT, FACTOR, DELETED_EVERY = 7, 2, 10, 31
SYMBOLS = 6
#: Distinct words that a task holds before it hands out their counts, and letters of one step of key generation.
_HELD, _LETTERS = 200_000, 1 << 16
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts in some documents (doc_id, text). A run of a document always loses the same letter, or none."""
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not text.is_valid:
                continue
            # Bytes lower only A-Z.
            runs = Counter(_RUN.findall(text.as_buffer().to_pybytes().lower().decode()))
            begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), begun)
                if h % DELETED_EVERY == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LEAST_LENGTH:
                        continue
                held[run] += n
            if len(held) >= _HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of all documents with their counts."""
    parts = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_counts, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class _Reduced:
    """Reduced words of a batch: symbol of each letter (1 to SYMBOLS), word of each letter, and the sums of symbol times power of its place."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.symbol = (mix(points.astype(np.uint64)) % np.uint64(SYMBOLS)).astype(np.uint64) + np.uint64(1)
        self.word = np.repeat(np.arange(len(words)), self.length)
        longest = int(self.length.max()) + 2
        self.power = np.full(longest, _BASE, np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power, dtype=np.uint64)
        self.place = np.arange(len(points)) - self.first[self.word]
        terms = self.symbol * self.power[self.place]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        #: Sum before and after each letter within its word, and of each word.
        self.whole = sums[self.first[1:]] - sums[self.first[:-1]]
        self.before = sums[:-1] - sums[self.first[self.word]]
        self.after = self.whole[self.word] - self.before - terms

    def keys(self) -> np.ndarray:
        return mix(self.whole).view(np.int64)

    def half_neighbourhood(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word and key of each deletion (once in a stretch of equal symbols) and of each replacement by a smaller symbol."""
        again = np.zeros(len(self.symbol), bool)
        again[1:] = (self.symbol[1:] == self.symbol[:-1]) & (self.word[1:] == self.word[:-1])
        at = np.flatnonzero(~again)
        yield self.word[at], mix(self.before[at] + self.after[at] * _INVERSE).view(np.int64)
        for symbol in range(1, SYMBOLS):
            at = np.flatnonzero(self.symbol > symbol)
            lower = (self.symbol[at] - np.uint64(symbol)) * self.power[self.place[at]]
            yield self.word[at], mix(self.whole[self.word[at]] - lower).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about _LETTERS letters, or one word."""
    for batch in batches:
        size = np.cumsum([len(w) for w in batch.column(0).to_pylist()])
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + _LETTERS, "right")))
            yield batch.slice(at, upto - at)
            at = upto


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        keys = _Reduced(batch.column(0).to_pylist()).keys()
        yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns], ["key", "other", "other_n"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "same", "word", "n"]
    for batch in _slices(batches):
        reduced = _Reduced(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(reduced.keys()), pa.array(np.ones(batch.num_rows, bool)), *batch.columns], names)
        for word, keys in reduced.half_neighbourhood():
            take = pa.array(word)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.zeros(len(keys), bool)), batch.column(0).take(take), batch.column(1).take(take)], names)


def near_words(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every pair of words(word, n) one code point apart, once."""
    own = words.select("word", "n").mapInArrow(_own, "key long, other string, other_n long")
    asked = words.select("word", "n").mapInArrow(_neighbours, "key long, same boolean, word string, n long")
    met = asked.join(own, "key").where("not same or word < other")
    near = met.where(F.levenshtein("word", "other", 1) == 1)
    ordered = F.col("word") < F.col("other")
    return near.select(
        F.when(ordered, F.col("word")).otherwise(F.col("other")).alias("a"), F.when(ordered, F.col("n")).otherwise(F.col("other_n")).alias("a_n"),
        F.when(ordered, F.col("other")).otherwise(F.col("word")).alias("b"), F.when(ordered, F.col("other_n")).otherwise(F.col("n")).alias("b_n"),
    ).distinct()  # keys are hashes, and two of them may meet by chance


def roots(forms: DataFrame) -> DataFrame:
    """word, root of forms(word, root): each is followed to the last. Counts grow tenfold at each step, so chains are short and
    doubling ends after a few rounds; each round is written, so that a lost executor costs one."""
    at = cut(forms)
    while True:
        further = at.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = cut(at.join(further, F.col("root") == F.col("_word"), "left"))
        at = moved.select("word", F.coalesce("_root", "root").alias("root"))
        if moved.where("_root is not null").isEmpty():
            return at


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of docs(doc_id, text)."""
    words = cut(vocabulary(docs))
    pairs = near_words(words)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    links = pairs.select(F.explode(sides).alias("s")).select("s.*")
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("best.less") >= FACTOR * F.col("n")
    formed = cut(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ))
    last = roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Two words are near if they are equal without the letter of one place (replaced), or one without a letter is the other.
ORACLES = {
    "op11_spelling_variants": f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
found AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
bytes AS (SELECT run, n, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h FROM bytes, crc),
typed AS (SELECT CASE WHEN h % {DELETED_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
less AS MATERIALIZED (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.rest = w.word
),
best AS (SELECT near.word, count(*) AS n_near, min(ROW(-o.n, o.word)) AS b FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= {FACTOR} * w.n THEN b[2] END AS form, CASE WHEN -b[1] >= {FACTOR} * w.n THEN -b[1] END AS form_n FROM words w LEFT JOIN best USING (word)),
followed AS (SELECT word, word AS root FROM formed UNION ALL SELECT f.word, n.form FROM followed f JOIN formed n ON n.word = f.root WHERE n.form IS NOT NULL),
ends AS (SELECT f.word, f.root FROM followed f JOIN formed n ON n.word = f.root WHERE n.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
""",
}
