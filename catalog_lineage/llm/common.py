"""Shared helpers of the training-data operators: tables cut in the shared folder, word hashing, fixed-size count tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: White space of the word pattern [^\x20\x09-\x0D]+.
SPACE = " \t-\r"
WORD_PATTERN = r"[^ \t-\r]+"
#: Bytes of text that one vectorised step handles; a longer text is a step of its own.
STEP_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only local mode, where all tasks run in one process, may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Writes a table that several later steps read and reads it back: lineage ends here, sizes are known, and the files
    are whole when an executor is lost. They go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    made = jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(made)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def packed(df: DataFrame, **needed: Column) -> DataFrame:
    """The rows of df as one column `_row` beside the columns an operator works with, so that no name of the input can clash."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), *(c.alias(n) for n, c in needed.items()))


def free_name(df: DataFrame, wanted: str) -> str:
    while wanted in df.columns:
        wanted = f"_{wanted}"
    return wanted


def numbered(df: DataFrame, *order: Column, name: str = "row_number") -> tuple[DataFrame, int]:
    """Numbers all rows from 0 in the given order, and their count. The rows are dealt by ranges of the order, written, and
    each range is numbered from its offset, so no task sees more than its range. Rows equal in all order columns are told
    apart by their place in the input, which can only swap equal rows."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(f"_o{i}" for i in range(len(order))), "_place"]
    keyed = packed(df, **dict(zip(keys, [*order, F.monotonically_increasing_id()])))
    dealt = cut(keyed.repartitionByRange(parts, *keys).select("*", F.spark_partition_id().alias("_range")))
    # One row for each range, at most as many as there are shuffle partitions.
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    offsets = counts.select("_range", "_n", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_offset"))
    total = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)).cast("long") - 1
    rows = dealt.select("*", inside.alias("_inside")).join(F.broadcast(offsets.drop("_n")), "_range")
    return rows.select("_row.*", (F.col("_offset") + F.col("_inside")).alias(name)), int(total)


# Vectorised word hashing ---------------------------------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, n at least; kept for texts of the usual size."""
    if "kept" not in _POWERS or len(_POWERS["kept"][0]) < n:
        size = 1 << max(16, int(n).bit_length())
        made = []
        for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if size > 1 << 23:
            return tuple(made)
        _POWERS["kept"] = tuple(made)
    return _POWERS["kept"]


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive values; shorter input gives none."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * inverse[: n + 1 - width] + np.uint64(width * int(_ODD) % (1 << 64)))


def separators(of: str) -> np.ndarray:
    """Which bytes part words: `space` is the white space of WORD_PATTERN, `plain` every ASCII character but letters and digits."""
    out = np.zeros(256, bool)
    if of == "space":
        out[[32, *range(9, 14)]] = True
    else:
        out[[b for b in range(128) if not chr(b).isalnum()]] = True
    return out


class Words:
    """The words of some texts: text index, first byte, end byte (both within all bytes of the batch) and hash of each."""

    def __init__(self, texts: pa.Array, parts: np.ndarray):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data, self.offsets, n = data, offsets, len(data)
        inside = ~parts[data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = offsets[1:-1]
        before[edge[edge < n]] = False
        after[edge[(edge > 0) & (edge <= n)] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        #: First word of each text, and the count after the last.
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        power, inverse = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64) * _ODD)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices Arrow batches so that the texts of each slice have about `limit` bytes, or one text."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right"))
            upto = max(at + 1, upto)
            yield batch.slice(at, upto - at)
            at = upto


def within(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words of all runs of `width` words that stay in one text, and the text of each, given Words.first."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    return start, doc


# Streams of groups ---------------------------------------------------------------------------------------------------


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a partition that is sorted by integer `keys` without nulls, each as one table. Only for groups of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows, bool)
        for v in values:
            changes[1:] |= v[1:] != v[:-1]
        if held:
            last = held[-1]
            changes[0] = any(last.column(last.schema.get_field_index(k))[-1].as_py() != v[0] for k, v in zip(keys, values))
        edges = [*np.flatnonzero(changes), batch.num_rows]
        if edges[0]:
            held.append(batch.slice(0, edges[0]))
        for at, upto in zip(edges, edges[1:]):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(at, upto - at)]
    if held:
        yield pa.Table.from_batches(held)


# Counts in a table of fixed size -------------------------------------------------------------------------------------

_BLOCK = 4096


def slot_counts(df: DataFrame, slots_of, slots: int) -> np.ndarray:
    """Sums over all rows how often each of a fixed number of slots occurs. `slots_of(batch)` gives the slots of an Arrow batch.
    Each task sends one table, summed by blocks; the driver gets 8 bytes for each slot, however large the input."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(slots, np.int64)
        for batch in batches:
            sums += np.bincount(slots_of(batch), minlength=slots)
        for at in range(0, slots, _BLOCK):
            part = sums[at : at + _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at // _BLOCK], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "sums"])

    def add_block(key, pdf):
        total = np.zeros(len(np.frombuffer(pdf["sums"].iloc[0], np.int64)), np.int64)
        for raw in pdf["sums"]:
            total += np.frombuffer(raw, np.int64)
        return pd.DataFrame({"block": [key[0]], "sums": [total.tobytes()]})

    schema = "block int, sums binary"
    # Two rounds, so that a block's group stays small however many tasks there are.
    made = df.mapInArrow(tally, schema)
    some = made.groupBy("block", F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")).applyInPandas(add_block, schema)
    out = np.zeros(slots, np.int64)
    for row in some.groupBy("block").applyInPandas(add_block, schema).collect():
        part = np.frombuffer(bytes(row["sums"]), np.int64)
        out[row["block"] * _BLOCK : row["block"] * _BLOCK + len(part)] = part
    return out


_FILTER_SLOTS = 1 << 20


def likely_in(df: DataFrame, key: str, keys: DataFrame, keep: str | None = None) -> DataFrame:
    """Rows of df whose key may be among keys(key): the hashed slots of the keys, at most a million rows and so safe to broadcast,
    leave most others out before a join. It never drops a row that the join would keep; where all slots are taken it keeps all, and
    the join decides as before. With `keep`, all rows stay and a column of that name says whether the join is needed."""
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(_FILTER_SLOTS)).cast("int")
    slots = F.broadcast(keys.select(slot.alias("_slot")).distinct())
    rows = df.withColumn("_mine", slot)
    if keep:
        marked = rows.join(slots, F.col("_mine") == F.col("_slot"), "left")
        return marked.withColumn(keep, F.col("_slot").isNotNull()).drop("_mine", "_slot")
    return rows.join(slots, F.col("_mine") == F.col("_slot"), "left_semi").drop("_mine")
