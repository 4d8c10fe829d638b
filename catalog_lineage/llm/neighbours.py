"""Approximate nearest neighbours (operator 8): a forest of random-projection trees, one shared priority queue, exact reranking.

The trees are fitted on a bounded sample (SAMPLE rows in seeded order): each node splits along the difference of two sample vectors at
the median. Every row of the table is indexed in every tree. A query walks down all trees through one queue ordered by the smallest
margin by which it had to cross a split, and takes leaves until they hold VISITS times the number of rows, repeats between trees
counted. It never stops before they hold k + 1 rows of every tree, counted alike: among these are k rows besides its own, or all rows
there are. Every vector is written once, with its leaf in each tree, and every query once, with one bit for each leaf it visits. Both are
dealt into blocks of about ROWS rows and QUERIES queries, whatever their leaves, so a leaf full of copies fills no task. A block compares
a query with the rows in its leaves: rough distances by a matrix product find the rows that can be among the k nearest, their Euclidean
distances in double precision decide.

The vectors given are close to random directions, where trees must look at about half of the rows for a recall of 0.9; VISITS is set
for that. Clustered vectors need much less.

Defined results: vectors that are null, zero, of another length than most of the sample, or hold null or non-finite components take no
part, as query or candidate; rows without an id neither; of rows with equal ids the nearest counts, and none with the query's id is a
candidate; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from catalog_lineage.llm.common import cut, runs, slot_counts, table

TREES, DEPTH, SAMPLE, SEED = 12, 8, 20_000, 5
VISITS, K = 1.1, 10
ROWS, QUERIES, AT_ONCE = 32_768, 16_384, 64
#: Long vectors come in smaller blocks, of about so many bytes in double precision.
BLOCK_BYTES = 64_000_000
LEAF = np.min_scalar_type(2**DEPTH - 1)
#: Blocks are dealt to at most so many tasks; a task takes one after the other.
MOST_TASKS = 4096


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the batch whose vectors take part, by length checked against the first of them later, and the vectors as lists."""
    keep, vectors = [], []
    for i, v in enumerate(column):
        if v.is_valid and len(v.values) and v.values.null_count == 0:
            x = v.values.to_numpy(zero_copy_only=False)
            if np.isfinite(x).all() and x.any():
                keep.append(i)
                vectors.append(x)
    return np.array(keep, np.int64), vectors


class Forest:
    """Complete binary trees of DEPTH levels; node n has the children 2n + 1 and 2n + 2. A node that cannot be split sends all left."""

    def __init__(self, sample: np.ndarray, seed: int = SEED, trees: int = TREES):
        rng, n = np.random.default_rng(seed), 2**DEPTH - 1
        self.dim, self.trees = sample.shape[1], trees
        self.normal, self.at = np.zeros((trees, n, self.dim)), np.full((trees, n), np.inf)
        for t in range(trees):
            place = np.zeros(len(sample), np.int64)
            for node in range(n):
                mine = np.flatnonzero(place == node)
                if len(mine) < 2:
                    continue
                a, b = sample[rng.choice(mine, 2, replace=False)]
                w = a - b if (a != b).any() else rng.normal(size=self.dim)
                w = w / np.linalg.norm(w)
                along = sample[mine] @ w
                middle = np.median(along)
                if not (along < middle).any():
                    larger = along[along > middle]
                    middle = larger.min() if len(larger) else np.inf
                self.normal[t, node], self.at[t, node] = w, middle
                place[mine] = 2 * node + 1 + (along >= middle)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.empty((self.trees, len(x)), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, self.normal[t, node]) >= self.at[t, node])
            out[t] = node - (2**DEPTH - 1)
        return out

    def visits(self, x: np.ndarray, counts: np.ndarray, budget: float) -> list[tuple[int, int]]:
        """(tree, leaf) that a query visits, nearest margins first over all trees, until they hold the budget of rows."""
        margins = np.einsum("tnd,d->tn", self.normal, x) - np.where(np.isinf(self.at), 0, self.at)
        open_ended = np.isinf(self.at)
        queue = [(0.0, t, 0) for t in range(self.trees)]
        found, held, inner = [], 0, 2**DEPTH - 1
        while queue and held < budget:
            margin, t, node = heapq.heappop(queue)
            while node < inner:
                right = not open_ended[t, node] and margins[t, node] >= 0
                if not open_ended[t, node]:
                    heapq.heappush(queue, (max(margin, abs(margins[t, node])), t, 2 * node + 2 - right))
                node = 2 * node + 1 + right
            if counts[t, node - inner]:
                found.append((t, node - inner))
                held += counts[t, node - inner]
        return found


def fit(rows: DataFrame) -> Forest | None:
    """rows(id, vector). The driver gets SAMPLE vectors."""
    sample = rows.where("id is not null and vector is not null").orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SAMPLE).select("vector").toArrow()
    _, vectors = _matrix(sample.column("vector").combine_chunks()) if sample.num_rows else (None, [])
    if not vectors:
        return None
    length = min(Counter(map(len, vectors)).items(), key=lambda x: (-x[1], x[0]))[0]
    return Forest(np.stack([v for v in vectors if len(v) == length]).astype(np.float64))


_PLACED = "id long, at int, leaves binary, vector binary"


def _placed(rows: DataFrame, forest, what) -> DataFrame:
    """Rows as (id, at, leaves, vector): `what(forest, vectors)` gives the bytes that name the leaves of each vector; `at` tells rows with
    equal ids and vectors from each other."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = forest.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keep, vectors = _matrix(part.column(1))
                fits = [i for i, v in enumerate(vectors) if len(v) == f.dim]
                if not fits:
                    continue
                keep, vectors = keep[fits], [vectors[i] for i in fits]
                ids = part.column(0).to_numpy(zero_copy_only=False)[keep]
                leaves = what(f, np.stack(vectors).astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keep + at, pa.int32()), pa.array(leaves, pa.binary()), pa.array([v.tobytes() for v in vectors], pa.binary())], ["id", "at", "leaves", "vector"])

    return rows.where("id is not null and vector is not null").select("id", "vector").mapInArrow(place, _PLACED)


def _numbers(column: pa.ChunkedArray, kind, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1)


def _nearest_of(own: np.ndarray, points: np.ndarray, v: np.ndarray, rough: np.ndarray, slack: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest of the rows with finite rough distances, which are exact to `slack`; ties to the smaller id."""
    take, there = k, int(np.isfinite(rough).sum())
    while True:
        # Equal ids may repeat, so the cut is by distance, with all that tie with the last, and is made anew if ids are short.
        least = np.partition(rough, take - 1)[take - 1] if take < there else np.inf
        near = np.flatnonzero((rough <= least + slack) & np.isfinite(rough))
        d = np.sqrt(((points[near] - v) ** 2).sum(axis=1))
        best = np.flatnonzero(d <= np.partition(d, take - 1)[take - 1]) if len(d) > take else np.arange(len(d))
        best = best[np.isfinite(d[best])]
        best = best[np.lexsort((own[near[best]], d[best]))]
        _, first = np.unique(own[near[best]], return_index=True)
        best = best[np.sort(first)][:k]
        if len(best) == k or take >= there:
            return own[near[best]], d[best]
        take *= 8


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, visits: float = VISITS) -> DataFrame:
    """query_id, rank, vec_id, score for queries(id, vector) against rows(id, vector)."""
    spark = rows.sparkSession
    kind = np.float32 if rows.schema["vector"].dataType.elementType.typeName() == "float" else np.float64
    fitted = fit(rows)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = spark.sparkContext.broadcast(fitted)

    def every_tree(f: Forest, x: np.ndarray) -> list[bytes]:
        return [v.tobytes() for v in np.ascontiguousarray(f.leaves(x).T.astype(LEAF))]

    index = cut(_placed(rows, forest, every_tree))
    trees, width = fitted.trees, 2**DEPTH

    def slots(batch: pa.RecordBatch) -> np.ndarray:
        leaves = _numbers(batch.column(0), LEAF, batch.num_rows).astype(np.int64)
        return (leaves + np.arange(trees) * width).reshape(-1)

    counts = slot_counts(index.select("leaves"), slots, trees * width).reshape(trees, width)
    total = int(counts[0].sum())
    budget = max(visits * total, (k + 1) * trees)

    def by_queue(f: Forest, x: np.ndarray) -> list[bytes]:
        found = []
        for q in x:
            visited = np.zeros((trees, width), bool)
            for t, leaf in f.visits(q, counts, budget):
                visited[t, leaf] = True
            found.append(np.packbits(visited).tobytes())
        return found

    asked = cut(_placed(queries, forest, by_queue))
    fits = max(BLOCK_BYTES // (8 * fitted.dim), 1)
    row_parts, query_parts = -(-total // min(ROWS, fits)), -(-asked.count() // min(QUERIES, fits))
    if not total or not query_parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    part = lambda parts: F.pmod(F.xxhash64("id", "at", "vector"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = index.withColumn("row_part", part(row_parts)).withColumn("query_part", every(query_parts)).withColumn("asks", F.lit(0))
    right = asked.withColumn("query_part", part(query_parts)).withColumn("row_part", every(row_parts)).withColumn("asks", F.lit(1))
    keys = ["row_part", "query_part"]
    blocks = left.select(*keys, "asks", "id", "leaves", "vector").unionByName(right.select(*keys, "asks", "id", "leaves", "vector"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, keys):
            asks, ids = block.column("asks").to_numpy() == 1, block.column("id").to_numpy()
            if asks.all() or not asks.any():
                continue
            of = [block.filter(pa.array(m)) for m in (~asks, asks)]
            own, asking = ids[~asks], ids[asks]
            points, wanted = (_numbers(b.column("vector"), kind, b.num_rows).astype(np.float64) for b in of)
            leaves = _numbers(of[0].column("leaves"), LEAF, len(own))
            visited = _numbers(of[1].column("leaves"), np.uint8, len(asking))
            with np.errstate(over="ignore"):
                squares = (points**2).sum(axis=1)
            found = []
            for at in range(0, len(asking), AT_ONCE):
                q, v = asking[at : at + AT_ONCE], wanted[at : at + AT_ONCE]
                opened = np.unpackbits(visited[at : at + AT_ONCE], axis=1).astype(bool).reshape(len(q), trees, width)
                opened = np.ascontiguousarray(opened.transpose(1, 2, 0))
                met = np.zeros((len(own), len(q)), bool)
                for t in range(trees):
                    met |= opened[t][leaves[:, t]]
                met &= own[:, None] != q
                with np.errstate(over="ignore", invalid="ignore"):
                    own_square = (v**2).sum(axis=1)
                    rough = squares - 2 * (v @ points.T) + own_square[:, None]
                    slack = 16 * (points.shape[1] + 8) * np.finfo(float).eps * (squares.max() + own_square) + np.finfo(float).tiny
                if not np.isfinite(rough).all():  # squares that overflow tell nothing: all are compared
                    rough, slack = np.zeros_like(rough), np.zeros(len(q))
                np.copyto(rough, np.inf, where=~met.T)
                for i in range(len(q)):
                    near, d = _nearest_of(own, points, v[i], rough[i], slack[i], k)
                    found.append((np.full(len(near), q[i]), near, d))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in range(3)], ["query_id", "vec_id", "score"])

    # blocks are few, so they get several times as many places, lest two meet in one task
    dealt = blocks.repartition(min(4 * row_parts * query_parts, MOST_TASKS), *keys).sortWithinPartitions(*keys)
    best = dealt.mapInArrow(search, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    wanted: Column = F.col("id") % 100 == 0
    return nearest(rows, rows.where(wanted))
