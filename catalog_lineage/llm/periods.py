"""Periodic runs of words (operator 12): repeated grams as seeds, extended along the diagonal of their lag.

A run of smallest period q is at least 4 * q words long, so the words agree with those q places on for at least 3 * q places. Periods
are searched by levels: level j has those from 2**j to 2**(j+1) - 1, and 3 * 2**j is the overlap that every run of the level is sure to
have.

1. Grams of that length are indexed within each text. Names of grams come exactly from pairs of names of half the length, and only
   grams that stand twice in their text go on to the next level, so ordinary prose leaves after the first.
2. A gram's occurrences are paired with the next one in the same text only. That is enough: a gram is at least one and a half periods
   long. If inside the run it came again after d < q places, the words from the first to the end of the second would have the periods
   q and d over at least q + d words, so gcd(d, q) as well, and with them the whole run, against q being its smallest. So a word
   repeated a million times gives a million pairs, not their square.
3. Pairs are taken by lag and place. A table of the furthest place covered at each lag leaves out pairs inside a stretch that was extended
   already; the others are extended both ways by comparing words, in steps of doubling length. Stretches of one lag do not overlap.

Defined results: a null text has no words; a null id changes no words and is kept; repeated rows each give a row; texts without a run
have four nulls and the digest of nothing; an empty table gives no rows; other columns go on unchanged and come before the results, those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from catalog_lineage.llm.common import packed, steps, table

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
_STEP = 1 << 20
RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _names(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Numbers for pairs of numbers: equal pairs get equal ones."""
    return np.unique(one * (int(two.max()) + 1) + two, return_inverse=True)[1]


def _agreement(words: np.ndarray, at: int, lag: int, least: int, most: int) -> tuple[int, int]:
    """The longest stretch around `at` in which words[i] == words[i + lag], for i from `least` to below `most`."""
    low, high, step = at, at, 16
    while high < most:
        upto = min(high + step, most)
        differ = np.flatnonzero(words[high:upto] != words[high + lag : upto + lag])
        if len(differ):
            high += int(differ[0])
            break
        high, step = upto, step * 2
    step = 16
    while low > least:
        frm = max(low - step, least)
        differ = np.flatnonzero(words[frm:low] != words[frm + lag : low + lag])
        if len(differ):
            low = frm + int(differ[-1]) + 1
            break
        low, step = frm, step * 2
    return low, high


def runs_of(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in texts laid end to end: words holds numbers of words, first the place where each text
    begins and the end of the last."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:]
    at = np.arange(len(words))
    at = at[at + 3 <= end[doc]] if len(at) else at
    if not len(at):
        return []
    names = _names(_names(words[at], words[at + 1]), words[at + 2])
    found, half = [], 1
    while len(at):
        order = np.lexsort((at, doc[at], names))
        place, name = at[order], names[order]
        next_same = (name[1:] == name[:-1]) & (doc[place[1:]] == doc[place[:-1]])
        lags = (place[1:] - place[:-1])[next_same]
        seeds = place[:-1][next_same]
        fits = (lags >= half) & (lags < 2 * half)
        found += _extended(words, first, doc, seeds[fits], lags[fits])
        # Only grams that stand twice in their text can be halves of such grams.
        twice = np.zeros(len(place), bool)
        twice[1:] |= next_same
        twice[:-1] |= next_same
        name_at = np.full(len(words), -1, np.int64)
        name_at[place[twice]] = name[twice]
        width = 3 * half
        at = np.sort(place[twice])
        at = at[at + 2 * width <= end[doc[at]]]
        at = at[name_at[at + width] >= 0]
        names = _names(name_at[at], name_at[at + width]) if len(at) else at
        half *= 2
    return found


def _extended(words: np.ndarray, first: np.ndarray, doc: np.ndarray, seeds: np.ndarray, lags: np.ndarray) -> list[tuple[int, int, int]]:
    order = np.lexsort((seeds, lags))
    seeds, lags = seeds[order], lags[order]
    out, covered, i = [], {}, 0
    while i < len(seeds):
        at, lag = int(seeds[i]), int(lags[i])
        if at < covered.get(lag, 0):
            # On to the first seed of this lag that is not covered.
            i += int(np.searchsorted(seeds[i : np.searchsorted(lags, lag, "right")], covered[lag]))
            continue
        least, upto = int(first[doc[at]]), int(first[doc[at] + 1])
        low, high = _agreement(words, at, lag, least, upto - lag)
        covered[lag] = max(high, at + 1)
        length = high - low + lag
        if length >= max(LEAST_LENGTH, LEAST_EXPONENT * lag):
            out.append((low, length, lag))
        i += 1
    return out


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int | None, ...]:
    """Start, length, period and thousandths of the exponent of the run of greatest exponent; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs and kept words of texts (row, words)."""
    for whole in batches:
        renamed = pa.RecordBatch.from_arrays([whole.column(0), *whole.column(1).flatten()], ["_row", "text", "plan"])
        for batch in steps(iter([renamed]), limit=_STEP):
            lists = [_words(text, plan) for text, plan in zip(batch.column(1), batch.column(2))]
            first = np.concatenate([[0], np.cumsum([len(w) for w in lists])]).astype(np.int64)
            flat = pa.array([w for words in lists for w in words], pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            by_doc: dict[int, list] = {}
            for start, length, period in runs_of(flat, first):
                doc = int(np.searchsorted(first, start, "right")) - 1
                by_doc.setdefault(doc, []).append((start - int(first[doc]), length, period))
            columns: list[list] = [[] for _ in NAMES]
            for i, words in enumerate(lists):
                runs = sorted(by_doc.get(i, ()), key=lambda r: (r[0], r[2]))
                if runs:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in runs:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
                for column, value in zip(columns, (len(runs), *_strongest(runs), runs, b" ".join(words))):
                    column.append(value)
            listed = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in v] for v in columns[5]], listed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), runs, pa.array(columns[6], pa.binary()).cast(pa.string())],
                ["_row", *NAMES],
            )


def _words(text: pa.Scalar, plan: pa.Scalar) -> list[bytes]:
    """Words of a text; with a plan (from, period), those from there on repeat their first `period`."""
    words = text.as_buffer().to_pybytes().split() if text.is_valid else []
    if plan.is_valid and words:
        h = plan.as_py()
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words[a:] = (words[a : a + p] * ((n - a) // p + 1))[: n - a]
    return words


def periodic_runs(docs: DataFrame, planted: Column | None = None) -> DataFrame:
    """Adds n_runs, the strongest run (start, length, period, exponent_milli), all runs and the collapsed text to every row of docs(text).
    A word is collapsed if a run contains it after its first period. `planted` is a number by which a text's words are first made
    periodic from a place on (null: left alone)."""
    schema = T.StructType.fromDDL(RESULT)
    own = docs.drop(*NAMES)
    plan = F.lit(None).cast("long") if planted is None else planted.cast("long")
    rows = packed(own, asked=F.struct(F.col("text").cast("string").alias("text"), plan.alias("plan")))
    made = rows.mapInArrow(_searched, T.StructType([rows.schema["_row"], *schema.fields]))
    return made.select("_row.*", *NAMES)


def id_plan(doc_id: Column) -> Column:
    """The checksum of an id in decimal, for one id in ten; else null."""
    h = F.crc32(F.encode(doc_id.cast("string"), "utf-8"))
    return F.when(h % 10 == 0, h)


def run_lines(runs: Column) -> Column:
    """Every run as start,length,period and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    searched = periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), id_plan(F.col("doc_id")))
    return searched.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _levels_sql(levels: int = 20) -> str:
    """Named grams g and their pairs s of each level; periods below 2**20 cover texts of four million words."""
    parts = ["g0 AS MATERIALIZED (SELECT d, i, dense_rank() OVER (ORDER BY word, second, third) AS name FROM (SELECT d, i, word, lead(word) OVER w AS second, lead(word, 2) OVER w AS third FROM words WINDOW w AS (PARTITION BY d ORDER BY i)) WHERE third IS NOT NULL)"]
    for j in range(levels):
        parts.append(f"s{j} AS MATERIALIZED (SELECT d, i, name, lead(i) OVER (PARTITION BY d, name ORDER BY i) - i AS q, count(*) OVER (PARTITION BY d, name) AS c FROM g{j})")
        parts.append(f"g{j + 1} AS MATERIALIZED (SELECT x.d, x.i, dense_rank() OVER (ORDER BY x.name, y.name) AS name FROM s{j} x JOIN s{j} y ON x.d = y.d AND y.i = x.i + {3 << j} WHERE x.c > 1 AND y.c > 1)")
    seeds = " UNION ALL ".join(f"SELECT d, i, q, {3 << j} AS k FROM s{j} WHERE q BETWEEN {1 << j} AND {(2 << j) - 1}" for j in range(levels))
    return ",\n".join([*parts, f"seeds AS ({seeds})"])


#: In a run every gram of its level is paired at the lag of its period, so runs are stretches of consecutive pairs of one lag.
ORACLES = {
    "op12_periodic_runs": rf"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
listed AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
hashed AS MATERIALIZED (SELECT d, doc_id, w, len(w) AS n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h FROM listed, crc),
planned AS (SELECT d, n, (h // 10) % n AS a, h // 10 % 8 AS r FROM hashed WHERE h % 10 = 0 AND n > 0),
given AS MATERIALIZED (SELECT d, unnest(w) AS word, unnest(range(n)) AS i FROM hashed),
moved AS (SELECT g.d, g.i, CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + r)) ELSE i END AS j FROM given g LEFT JOIN planned USING (d)),
words AS MATERIALIZED (SELECT m.d, m.i, g.word FROM moved m JOIN given g ON g.d = m.d AND g.i = m.j),
{_levels_sql()},
islands AS (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM seeds),
runs AS MATERIALIZED (SELECT d, min(i) AS start, max(i) - min(i) + k + q AS length, q AS period FROM islands GROUP BY d, q, k, island HAVING max(i) - min(i) + k + q >= greatest({LEAST_LENGTH}, {LEAST_EXPONENT} * q)),
summed AS (SELECT d, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines, min(ROW(-(length / period), start, period, length)) AS best FROM runs GROUP BY d),
gone AS (SELECT DISTINCT d, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT d, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (d, i) GROUP BY d)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, best[4] AS length, best[3] AS period, 1000 * best[4] // best[3] AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM hashed LEFT JOIN summed USING (d) LEFT JOIN kept USING (d)
""",
}
