"""Sharding (operator 5): a Feistel permutation with cycle walking over global row numbers.

Rows are numbered from 0 in a stated order, the number is permuted, and the permuted number gives shard and slot by division:
the law is `rows`, so shard sizes differ by one row at most and slots have no gaps. The same input, seed and shard count always
give the same places, and `place` and `row_at` compute them in both directions without reading data.

Defined results: rows equal in every column may swap places; nulls sort first; an empty table stays empty; one row goes to slot 0
of shard 0. Columns of the input that are named like an output are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog_lineage.llm.common import free_name, numbered, table

SHARDS, SEED, ROUNDS = 40, 20250, 6
_LOW = np.uint64((1 << 31) - 1)


def half_bits(rows: int) -> int:
    """Bits of each half of the smallest even-sized domain that holds all rows; at most 30, so rows may reach 2**60."""
    return max(1, (max(rows - 1, 1).bit_length() + 1) // 2)


def round_keys(seed: int) -> list[tuple[int, int]]:
    """An odd multiplier and an addend for each round."""
    keys = []
    for i in range(ROUNDS):
        d = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        keys.append((int.from_bytes(d[:4], "big") >> 1 | 1, int.from_bytes(d[4:8], "big") >> 1))
    return keys


def _round(x: np.ndarray, key: tuple[int, int], half: int) -> np.ndarray:
    a, c = np.uint64(key[0]), np.uint64(key[1])
    y = (x * a + c) & _LOW
    y ^= y >> np.uint64(13)
    y = (y * a) & _LOW
    return y >> np.uint64(31 - half)


def _walk(x: np.ndarray, rows: int, seed: int, back: bool) -> np.ndarray:
    half = half_bits(rows)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = round_keys(seed)
    out, todo = np.asarray(x, np.uint64).copy(), np.arange(len(x))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for key in reversed(keys) if back else keys:
            if back:
                left, right = right ^ _round(left, key, half), left
            else:
                left, right = right, left ^ _round(right, key, half)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= np.uint64(rows)]  # outside the rows: walk on along the cycle
    return out


def permute(numbers: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number in the shuffled order."""
    return _walk(numbers, rows, seed, back=False)


def place(numbers: np.ndarray, rows: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    p = permute(numbers, rows, seed)
    return p % np.uint64(shards), p // np.uint64(shards)


def row_at(shard: np.ndarray, slot: np.ndarray, rows: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """The row number that sits in a shard's slot."""
    return _walk(np.asarray(slot, np.uint64) * np.uint64(shards) + np.asarray(shard, np.uint64), rows, seed, back=True)


def content_order(df: DataFrame, first: str) -> list[Column]:
    """An order of the rows that depends on their content alone."""
    rest = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return [F.col(first), F.xxhash64(*(F.col(f"`{c}`") for c in rest))]


def shard_rows(df: DataFrame, order: list[Column] | None = None, shards: int = SHARDS, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """Adds `shard` and `slot` to every row."""
    df = df.drop("shard", "slot")
    name = free_name(df, "_number")
    rows, count = numbered(df, *(order or content_order(df, key)), name=name)

    @F.pandas_udf("long")
    def permuted(n: pd.Series) -> pd.Series:
        return pd.Series(permute(n.to_numpy(np.uint64), count, seed).astype(np.int64))

    placed = rows.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), permuted(name).alias("_at"))
    return placed.select("_row.*", (F.col("_at") % shards).cast("int").alias("shard"), F.expr(f"_at div {int(shards)}").alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    placed = shard_rows(docs, order=[F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _walk_sql(source: str, value: str) -> str:
    """One pass through the rounds over the rows of `source`, in layers; half and rows are columns of it."""
    layer = f"SELECT *, {value} >> half AS l, {value} & ((1::BIGINT << half) - 1) AS r FROM {source}"
    for a, c in round_keys(SEED):
        mixed = f"SELECT *, (r * {a} + {c}) & {int(_LOW)} AS a FROM ({layer})"
        mixed = f"SELECT * EXCLUDE (a), ((xor(a, a >> 13) * {a}) & {int(_LOW)}) >> (31 - half) AS f FROM ({mixed})"
        layer = f"SELECT * EXCLUDE (l, r, f), r AS l, xor(l, f) AS r FROM ({mixed})"
    return f"SELECT n, half, rows, (l << half) | r AS y FROM ({layer})"


#: Rows by id, which is unique in the tables that are compared; the checksum of a text is folded over its bytes with the usual table.
ORACLES = {
    "op5_sharding": f"""
WITH RECURSIVE size AS (SELECT count(*) AS rows, (length(bin(greatest(count(*) - 1, 1))) + 1) // 2 AS half FROM documents),
numbered AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS n FROM documents),
begun AS (SELECT n, half, rows FROM numbered, size),
walk AS (
  {_walk_sql("begun", "n")}
  UNION ALL
  {_walk_sql("(SELECT * FROM walk WHERE y >= rows)", "y")}
), placed AS (SELECT n, y FROM walk WHERE y < rows),
crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
bytes AS (SELECT doc_id, n, octet_length(encode(coalesce(text, ''))) + 16 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM numbered)
SELECT doc_id, size::BIGINT AS size, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32,
  'rows' AS law, (y % {SHARDS})::INT AS shard, y // {SHARDS} AS slot, NULL::INT AS grown_shard
FROM bytes JOIN placed USING (n), crc
""",
}
