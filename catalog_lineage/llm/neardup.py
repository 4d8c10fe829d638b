"""Near-duplicate documents (operator 6): improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A text's words are its lower-cased runs of letters and digits. Shingles are five consecutive words; a text of one to four words
has one shingle of all of them. The weight of a shingle is its count in the text times 1 + IDF_SHARE * idf, idf between 0 and 1: the
logarithm of the inverse share of documents, over that of a single document. Documents are counted in a table of fixed size by
hashed shingle, less the share that other shingles of the slot are expected to have.

Each text gets SAMPLES consistent weighted samples; two texts agree in one with a probability equal to their weighted Jaccard
similarity. Samples are banded, and texts that share a band are candidates:

1. Equal word sequences are one text from the start, so copies cost one row each.
2. Each text is verified against one other, the smallest among the leaders of its bands. Verified links give components.
3. Where a band still joins texts of different components, its texts are compared in blocks: first by their samples, then, for the texts
   that have a partner across components whose samples agree often enough for a similarity of THRESHOLD, by their whole texts. A
   block hands on the links that join its components, at most one fewer than it has texts; pairs never leave it.

So every pair that the bands find is either linked through verified links or compared itself, in the first band that it shares. A link means weighted Jaccard
similarity of at least THRESHOLD between whole texts. At 0.8 a pair is missed by all bands with probability 0.004, at 0.9 with 1e-5.

Defined results: texts without words (null, empty, punctuation) and rows without an id are in no link; their class is their own
id. Rows with the same id and different texts are different texts, each in a class of its own links. Ties go to the smaller id, then
to the smaller hash of the text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from catalog_lineage.llm.common import Words, cut, likely_in, mix, packed, rolling, runs, separators, slot_counts, steps, table, within
from catalog_lineage.llm.components import components

SHINGLE, THRESHOLD, IDF_SHARE = 5, 0.8, 0.25
BANDS, ROWS = 14, 5
SAMPLES = BANDS * ROWS
SLOTS = 1 << 20
#: Share of equal samples from which a pair is verified: four standard deviations below the threshold.
LIKELY = THRESHOLD - 4 * (THRESHOLD * (1 - THRESHOLD) / SAMPLES) ** 0.5
#: Texts of a band that are compared in one block, and members of a leader that are verified in one task.
BLOCK, MEMBERS = 1000, 500
_PLAIN = separators("plain")
#: Any character but those of _PLAIN.
_WORD_CHARACTER = r"[0-9A-Za-z[^\x00-\x7F]]"
_ID_BITS = 44


class Shingled:
    """Distinct shingles of each text of a slice: owner (text index), shingle, count, first shingle of each text, and a key of
    the word sequence."""

    def __init__(self, texts: pa.Array):
        w = Words(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), _PLAIN)
        n = len(texts)
        start, owner = within(w.first, SHINGLE)
        self.words = np.diff(w.first)
        short = np.flatnonzero((self.words > 0) & (self.words < SHINGLE))
        five = rolling(w.hash, SHINGLE)
        key = five[start] if len(start) else np.empty(0, np.uint64)
        whole = np.array([mix(np.add.reduce(w.hash[a:b] * np.arange(1, b - a + 1, dtype=np.uint64)).reshape(1))[0] for a, b in zip(w.first[short], w.first[short + 1])], np.uint64)
        key, owner = np.concatenate([key, whole]), np.concatenate([owner, short])
        packed = np.sort(owner.astype(np.uint64) << np.uint64(_ID_BITS) | key >> np.uint64(64 - _ID_BITS))
        fresh = np.ones(len(packed), bool)
        fresh[1:] = packed[1:] != packed[:-1]
        at = np.flatnonzero(fresh)
        self.count = np.diff(np.append(at, len(packed)))
        self.shingle = packed[at] & np.uint64((1 << _ID_BITS) - 1)
        self.owner = (packed[at] >> np.uint64(_ID_BITS)).astype(np.int64)
        self.first = np.searchsorted(self.owner, np.arange(n + 1))
        # Key of the word sequence: each word hashed with its place, summed over the text.
        place = np.arange(len(w.hash), dtype=np.uint64) - np.repeat(w.first[:-1], self.words).astype(np.uint64)
        sums = np.zeros(len(w.hash) + 1, np.uint64)
        np.cumsum(mix(w.hash + place * np.uint64(0xA24BAED4963EE407)), out=sums[1:])
        self.key = mix(sums[w.first[1:]] - sums[w.first[:-1]] + self.words.astype(np.uint64)).view(np.int64)


def document_counts(docs: DataFrame) -> np.ndarray:
    """How many documents have a shingle of each slot."""
    return slot_counts(docs.select("text"), _slots, SLOTS)


def _slots(batch: pa.RecordBatch) -> np.ndarray:
    parts = [(Shingled(b.column(0)).shingle % np.uint64(SLOTS)).astype(np.int64) for b in steps(iter([batch]))]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def slot_weights(counts: np.ndarray, documents: int) -> np.ndarray:
    """1 + IDF_SHARE * idf of each slot. What the other shingles of a slot add on average is taken off its count."""
    others = (counts.sum() - counts) / max(len(counts) - 1, 1)
    df = np.clip(counts - others, 1, max(documents, 1))
    idf = np.log((documents + 1) / df) / np.log(documents + 1) if documents else np.zeros(len(counts))
    return (1 + IDF_SHARE * np.clip(idf, 0, 1)).astype(np.float32)


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 and scale 1, by Newton steps on 1 - (1 + x) exp(-x)."""
    p = (np.arange(n) + 0.5) / n
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 4)
    return x


class Sampler:
    """Consistent weighted samples: the draws of a shingle depend on the shingle and the sample number alone."""

    def __init__(self) -> None:
        gamma = _gamma_quantiles(1 << 16)
        self.rate, self.per_rate = gamma.astype(np.float32), (1 / gamma).astype(np.float32)
        self.log_c = (np.log(gamma) + 64).astype(np.float32)  # kept positive, so that its bits sort like the number
        self.salts = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, shingle: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """SAMPLES 32-bit samples for each text; all texts here have shingles."""
        out = np.empty((len(first) - 1, SAMPLES), np.uint32)
        log_w, base = np.log(weight).astype(np.float32), mix(shingle)
        low = base.astype(np.uint32)
        for j, salt in enumerate(self.salts):
            x = base * salt
            x ^= x >> np.uint64(29)
            x *= np.uint64(0x9E3779B97F4A7C15)
            a, c = (x >> np.uint64(48)).astype(np.intp), (x >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.intp)
            beta = (x & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(1 / (1 << 24))
            t = np.floor(log_w * self.per_rate[a] + beta)
            value = np.maximum(self.log_c[c] - self.rate[a] * (t - beta + np.float32(1)), np.float32(0))
            packed = value.view(np.uint32).astype(np.uint64) << np.uint64(32) | (low + t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
            out[:, j] = np.minimum.reduceat(packed, first[:-1]).astype(np.uint32)
        return out


def signatures(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, hash of the text, node (key of the word sequence), total weight and samples of all texts with words."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in steps(batches, limit=1 << 19):
            s = Shingled(batch.column(1))
            full = np.flatnonzero(np.diff(s.first) > 0)
            node, total, samples = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), [None] * batch.num_rows
            empty = np.ones(batch.num_rows, bool)
            if len(full):
                weight = s.count * shared.value[(s.shingle % np.uint64(SLOTS)).astype(np.intp)]
                first = np.append(s.first[full], len(s.shingle))
                node[full], total[full], empty[full] = s.key[full], np.add.reduceat(weight, first[:-1]), False
                for i, x in zip(full, sampler(s.shingle, weight, first)):
                    samples[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(node, mask=empty), pa.array(total), pa.array(samples, pa.binary())], ["doc_id", "text_hash", "node", "total", "samples"])

    return docs.select(F.col("doc_id").cast("long"), "text", _text_hash().alias("text_hash")).mapInArrow(sign, "doc_id long, text_hash long, node long, total double, samples binary")


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted shingles, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    hit = b[0][at] == a[0]
    both = np.minimum(a[1][hit], b[1][at[hit]]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def verify(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The pairs(a, b) of nodes whose texts have weighted Jaccard similarity of at least THRESHOLD. Each text is sent once for
    each `a` it is compared with; the members of an `a` are dealt over as many tasks as they need, each with a copy of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    pairs = cut(pairs.select("a", "b").distinct())
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("node"), F.lit(1).alias("role"))
    leaders = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"), F.lit(0).alias("role"))
    wanted = cut(members.unionByName(leaders).join(nodes.select("node", F.col("rep").alias("doc_id"), "text_hash"), "node"))
    texts = likely_in(_texts(docs), "doc_id", wanted.select("doc_id"))
    rows = texts.join(wanted, ["doc_id", "text_hash"]).select("a", "part", "role", "node", "text").repartition("a", "part").sortWithinPartitions("a", "part", "role", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, of = None, None
        for batch in steps(batches, limit=1 << 19):
            s = Shingled(batch.column(4))
            weight = (s.count * shared.value[(s.shingle % np.uint64(SLOTS)).astype(np.intp)]).astype(np.float64)
            a, part, role, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            hits = []
            for i in range(batch.num_rows):
                if s.key[i] != node[i]:
                    continue  # another text under the same id and hash
                own = (s.shingle[s.first[i] : s.first[i + 1]], weight[s.first[i] : s.first[i + 1]])
                if role[i] == 0:
                    leader, of = own, (a[i], part[i])
                elif of == (a[i], part[i]) and _similarity(leader, own) >= THRESHOLD:
                    hits.append(i)
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(a[hits]), pa.array(node[hits])], ["a", "b"])

    return cut(rows.mapInArrow(compare, "a long, b long").distinct())


class _Block:
    """The texts of a band (or of two parts of a large one) with their samples; `partners` are the later texts worth comparing."""

    def __init__(self, group: pa.Table):
        self.node, self.component, self.chunk = (group.column(c).to_numpy() for c in ("node", "component", "chunk"))
        self.total, self.turn = group.column("total").to_numpy(), group.column("turn")[0].as_py()
        self.samples = np.frombuffer(b"".join(group.column("samples").to_pylist()), np.uint32).reshape(-1, SAMPLES)
        self.low, self.high = group.column("low")[0].as_py(), group.column("high")[0].as_py()

    def partners(self, i: int, component: np.ndarray) -> np.ndarray:
        if self.low == self.high:
            k = np.arange(i + 1, len(self.node))
        else:
            k = np.flatnonzero(self.chunk == self.high) if self.chunk[i] == self.low else np.empty(0, np.int64)
        k = k[(component[k] != component[i]) & (np.minimum(self.total[k], self.total[i]) >= 0.999 * THRESHOLD * np.maximum(self.total[k], self.total[i]))]
        if not len(k):
            return k
        equal = self.samples[k] == self.samples[i]
        first = equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
        return k[(equal.mean(axis=1) >= LIKELY) & (first == self.turn)]


_BLOCK_KEYS = ["band", "low", "high"]


def _worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a block that have a partner in another component."""
    for group in runs(batches, _BLOCK_KEYS):
        block = _Block(group)
        marked = np.zeros(len(block.node), bool)
        for i in range(len(block.node)):
            k = block.partners(i, block.component)
            marked[k] = True
            marked[i] |= len(k) > 0
        if marked.any():
            yield from group.filter(pa.array(marked)).combine_chunks().to_batches()


def _links(weights, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the components of a block, by the whole texts."""
    for group in runs(batches, _BLOCK_KEYS):
        block, own = _Block(group), {}
        of = block.component.copy()
        for piece in group.combine_chunks().to_batches():
            for batch in steps(iter([piece.append_column("place", pa.array(np.arange(piece.num_rows)))]), limit=1 << 19):
                s = Shingled(batch.column(batch.schema.get_field_index("text")))
                weight = (s.count * weights[(s.shingle % np.uint64(SLOTS)).astype(np.intp)]).astype(np.float64)
                for i, place in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                    if s.key[i] == block.node[place]:
                        own[place] = (s.shingle[s.first[i] : s.first[i + 1]], weight[s.first[i] : s.first[i + 1]])
        found = []
        for i in own:
            for k in block.partners(i, of):
                if k in own and of[k] != of[i] and _similarity(own[i], own[k]) >= THRESHOLD:
                    found.append((block.node[i], block.node[k]))
                    of[of == of[k]] = of[i]
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The signed rows (doc_id, node), the texts with words (node and the smallest rep, text_hash that has it) and the components of
    those that links connect."""
    documents = docs.select("doc_id", "text")
    weights = slot_weights(document_counts(documents), documents.count())
    signed = cut(signatures(documents, weights))
    with_words = signed.where("doc_id is not null and node is not null")
    # Copies meet here before anything else; the samples of equal texts are equal.
    first_row = F.min(F.struct(F.col("doc_id").alias("rep"), "text_hash")).alias("first_row")
    nodes = with_words.groupBy("node").agg(first_row, F.first("total").alias("total"), F.first("samples").alias("samples"))
    nodes = cut(nodes.select("node", "first_row.*", "total", "samples"))
    width = ROWS * 4
    keys = F.array(*(F.xxhash64(F.lit(j), F.substring("samples", j * width + 1, width)) for j in range(BANDS)))
    bands = nodes.select("node", F.posexplode(keys).alias("turn", "band"))
    leaders = bands.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    shared = cut(bands.join(leaders, "band").select("band", "turn", "node", "leader"))
    first = shared.where("node > leader").groupBy("node").agg(F.min("leader").alias("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    links = verify(documents, nodes, first, weights)
    links = links.unionByName(_links_across(documents, nodes, shared, cut(components(links)), weights))

    return signed.select("doc_id", "node"), nodes.select("node", "rep", "text_hash"), components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id (the smallest id among the documents that links connect) for every row."""
    signed, nodes, linked = _linked(docs)
    of_text = nodes.join(linked, "node")
    heads = of_text.groupBy("component").agg(F.min("rep").alias("class_id"))
    classed = of_text.join(heads, "component").select("node", "class_id")
    texts = nodes.join(classed, "node", "left").select("node", F.coalesce("class_id", "rep").alias("class_id"))
    with_words = signed.where("doc_id is not null and node is not null")
    rest = signed.where("doc_id is null or node is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return with_words.join(texts, "node").select("doc_id", "class_id").unionByName(rest)


def _links_across(docs: DataFrame, nodes: DataFrame, shared: DataFrame, known: DataFrame, weights: np.ndarray) -> DataFrame:
    """Links between texts of different components that share a band."""
    marked = shared.select("band", "turn", "node").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = marked.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).where("x < y")
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = marked.join(mixed.select("band", chunks.alias("chunks")), "band").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).join(nodes.select("node", "rep", "text_hash", "total", "samples"), "node")
    blocks = rows.select("band", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "turn", "node", "component", "rep", "text_hash", "total", "samples")
    worth = cut(blocks.repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS).mapInArrow(_worth, blocks.schema))
    texts = likely_in(_texts(docs), "doc_id", worth.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
    whole = worth.join(texts, ["rep", "text_hash"]).repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS)
    shared_weights = docs.sparkSession.sparkContext.broadcast(weights)
    return cut(whole.mapInArrow(lambda batches: _links(shared_weights.value, batches), "a long, b long").distinct())


def _text_hash() -> Column:
    return F.xxhash64("text")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash().alias("text_hash"))


def unique_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: one of each class of texts, that of the smallest id, and all without words or id as they are."""
    _, nodes, linked = _linked(docs)
    texts = nodes.join(linked, "node", "left")
    heads = texts.groupBy(F.coalesce("component", "node")).agg(F.min(F.struct("rep", "text_hash")).alias("head")).select("head.*")
    content = F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))))
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), text_hash=_text_hash(), content=content)
    kept = rows.join(heads.withColumnRenamed("rep", "doc_id"), ["doc_id", "text_hash"], "left_semi")
    # Rows with equal id and text.
    kept = kept.withColumn("turn", F.row_number().over(W.partitionBy("doc_id", "text_hash").orderBy("content"))).where("turn = 1")
    return kept.select("_row.*").unionByName(docs.where(F.col("doc_id").isNull() | ~_has_words()))


def _has_words() -> Column:
    return F.coalesce(F.col("text").rlike(_WORD_CHARACTER), F.lit(False))


def op6_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
