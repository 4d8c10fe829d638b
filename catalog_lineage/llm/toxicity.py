"""Toxicity (operator 7): multiple-instance learning. Sentences are scored, a document is toxic if any sentence is (noisy-or), and
the sentence model is learned from document labels alone.

A sentence ends at . ! ? or a line break. Its features are its distinct lower-cased words, hashed to SLOTS weights; its score is the
logistic function of their sum and an offset. A document's score is 1 - product(1 - sentence score) over all of its sentences. Words
get a weight if they tell toxic documents apart beyond chance, counted by distinct sentences, so that copied text counts once; the
weights minimise the log loss of the documents plus a penalty on their squares, by Adam over the whole sample.

The model is fitted on a bounded sample: at most TRAIN_DOCS labelled documents of the training fold, in seeded order, each of at most
TRAIN_CHARS characters. Everything else, scores and offending sentences, covers every sentence of every text.

The training fold are rows whose crc32(doc_id as text) modulo 3 is not 1. Labels, language, source and id are no features. Several
labels of one document count as toxic if one is; null labels are left out. Without both kinds of labels all scores are 0.
Defined results: texts without words (null, empty) score 0; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog_lineage.llm.common import Words, cut, free_name, separators, steps, table

SLOTS = 1 << 18
TRAIN_DOCS, TRAIN_CHARS, SEED = 6000, 20_000, 77
EPOCHS, RATE, PENALTY, OFFSET = 200, 0.15, 2e-5, -7.0
#: A word is used if it is in so many distinct sentences and its share of toxic ones is so many standard deviations from chance.
LEAST_SENTENCES, DEVIATIONS = 4, 4.0
REJECT, OFFENDING = 0.7, 0.5
_PLAIN = separators("plain")
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


class Sentences:
    """Distinct words of each sentence of some texts: text, sentence (within the text) and slot of each."""

    def __init__(self, texts: pa.Array):
        w = Words(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), _PLAIN)
        stops = np.concatenate([[0], np.cumsum(_STOPS[w.data])])
        sentence = stops[w.start] - stops[w.offsets[w.doc]]
        slot = (w.hash >> np.uint64(64 - 18)).astype(np.int64)
        order = np.lexsort((slot, sentence, w.doc))
        text, sentence, slot = w.doc[order], sentence[order], slot[order]
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (sentence[1:] != sentence[:-1]) | (slot[1:] != slot[:-1])
        self.text, self.sentence, self.slot = text[fresh], sentence[fresh], slot[fresh]
        head = np.ones(len(self.text), bool)
        head[1:] = (self.text[1:] != self.text[:-1]) | (self.sentence[1:] != self.sentence[:-1])
        #: First word of each sentence, and the text of each sentence.
        self.first = np.flatnonzero(head)
        self.of = self.text[self.first]
        self.number = self.sentence[self.first]


class Model:
    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights.astype(np.float32), float(offset)

    def sentence_logits(self, s: Sentences) -> np.ndarray:
        return np.add.reduceat(self.weights[s.slot].astype(np.float64), s.first) + self.offset if len(s.first) else np.empty(0)


def telling(slot: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Slots of words whose share of toxic sentences differs from that of all sentences beyond chance."""
    salted = (slot.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    content = np.add.reduceat(salted ^ salted >> np.uint64(29), first) * np.uint64(2) + toxic.astype(np.uint64)
    _, once = np.unique(content, return_index=True)
    keep = np.zeros(len(first), bool)
    keep[once] = True
    sizes = np.diff(np.append(first, len(slot)))
    word, bad = slot[np.repeat(keep, sizes)], np.repeat(toxic & keep, sizes)[np.repeat(keep, sizes)]
    seen, found = np.bincount(word, minlength=SLOTS), np.bincount(word, bad, minlength=SLOTS)
    expected = seen * (toxic & keep).sum() / keep.sum()
    return np.flatnonzero((seen >= LEAST_SENTENCES) & (np.abs(found - expected) >= DEVIATIONS * np.sqrt(np.maximum(expected, 1e-9))))


def fit(text: np.ndarray, first: np.ndarray, slot: np.ndarray, label: np.ndarray) -> Model:
    """text: document of each sentence; first: first word of each sentence; slot: of each word; label: of each document."""
    if not len(label) or label.min() == label.max() or not len(slot):
        return Model(np.zeros(SLOTS), -np.inf)
    used = telling(slot, first, label[text] == 1)
    column = np.full(SLOTS, len(used))
    column[used] = np.arange(len(used))
    at = column[slot]
    sentence = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(slot))))
    known = at < len(used)
    at, sentence = at[known], sentence[known]
    w, b = np.zeros(len(used)), OFFSET
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    toxic = label.astype(bool)
    for step in range(1, EPOCHS + 1):
        z = np.clip(np.bincount(sentence, w[at], minlength=len(first)) + b, -40, 40)
        total = np.maximum(np.bincount(text, np.logaddexp(0, z), minlength=len(label)), 1e-12)
        slope = np.where(toxic, -1 / np.expm1(np.minimum(total, 50)), 1.0) / len(label)
        gz = slope[text] / (1 + np.exp(-z))
        g, gb = np.bincount(at, gz[sentence], minlength=len(used)) + PENALTY * w, gz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= RATE * scale * m / (np.sqrt(v) + 1e-8)
        b -= RATE * scale * mb / (np.sqrt(vb) + 1e-8)
    weights = np.zeros(SLOTS)
    weights[used] = w
    return Model(weights, b)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from the training fold's sample. The driver gets the hashed words of at most TRAIN_DOCS texts: of at most so many ids,
    and of theirs, equal ones once, again at most so many, both in seeded order."""
    marked = labels.where("toxic is not null and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    chosen = marked.orderBy(F.xxhash64(F.col("doc_id"), F.lit(SEED)), "doc_id").limit(TRAIN_DOCS).withColumnRenamed("doc_id", "_labelled")
    texts = docs.where(F.length("text") <= TRAIN_CHARS).select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            s = Sentences(batch.column(0))
            edges = np.searchsorted(s.text, np.arange(batch.num_rows + 1))
            words = [s.slot[a:b].astype(np.int32).tobytes() for a, b in zip(edges, edges[1:])]
            numbers = [s.sentence[a:b].astype(np.int32).tobytes() for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(words, pa.binary()), pa.array(numbers, pa.binary())], ["doc_id", "toxic", "words", "numbers"])

    schema = "doc_id long, toxic int, words binary, numbers binary"
    known = cut(texts.select("text", F.col("doc_id").cast("long"), "_toxic").mapInArrow(hashed, schema).withColumn("place", F.xxhash64("words", "numbers")))
    kept = known.select("doc_id", "place").distinct().orderBy(F.xxhash64("doc_id", "place", F.lit(SEED)), "doc_id", "place").limit(TRAIN_DOCS)
    once = known.join(F.broadcast(kept), ["doc_id", "place"]).groupBy("doc_id", "place").agg(*(F.min(c).alias(c) for c in ("toxic", "words", "numbers")))
    rows = once.toPandas()
    rows = rows.assign(_place=[bytes(x) for x in rows["words"]]).sort_values(["doc_id", "_place"], ignore_index=True)
    label = rows["toxic"].to_numpy(np.int64)
    slots = [np.frombuffer(x, np.int32) for x in rows["_place"]]
    numbers = [np.frombuffer(bytes(x), np.int32) for x in rows["numbers"]]
    slot = np.concatenate(slots) if slots else np.empty(0, np.int32)
    number = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
    text = np.repeat(np.arange(len(slots)), [len(x) for x in slots])
    head = np.ones(len(slot), bool)
    head[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(head)
    return fit(text[first], first, slot, label)


def score_texts(docs: DataFrame, model: Model, text: str = "text", output: str = "toxicity") -> DataFrame:
    """Adds struct<score, sentences>: the document's score and its offending sentences (start, end in code points, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<score double, sentences array<struct<start int, end int, score double>>>")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            column = pa.array(part, pa.large_string())
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            scores, found = [], []
            for piece in steps(iter([batch])):
                s = Sentences(piece.column(0))
                z = np.minimum(shared.value.sentence_logits(s), 700)
                scores.append(0.0 - np.expm1(-np.bincount(s.of, np.logaddexp(0, z), minlength=piece.num_rows)))
                lists: list[list] = [[] for _ in range(piece.num_rows)]
                chance = np.exp(np.minimum(z, 0) - np.logaddexp(0, -np.abs(z)))
                for k in np.flatnonzero(chance >= OFFENDING):
                    lists[s.of[k]].append((int(s.number[k]), float(chance[k])))
                for i, marks in enumerate(lists):
                    found.append(_placed(piece.column(0)[i].as_py(), marks) if marks else [])
            yield pd.DataFrame({"score": np.concatenate(scores) if scores else np.empty(0), "sentences": pd.Series(found, dtype=object)})

    return docs.withColumn(output, scored(F.col(text)))


def _placed(text: str, marks: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """Start and end of the sentences with these numbers; a sentence begins after the stop before it."""
    ends = [i + 1 for i, c in enumerate(text) if c in ".!?\n"]
    edges = [0, *ends, len(text)]
    return [(edges[n], edges[n + 1], p) for n, p in marks]


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")))
    score = F.col("toxicity.score")
    return scored.select(
        "doc_id", held_out().alias("held_out"), score.alias("score"), F.when(score >= REJECT, 1).otherwise(0).alias("predicted"),
        F.array_join(F.transform("toxicity.sentences", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("sentences"),
    )


def gentle_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the model learned from their labels does not reject."""
    name = free_name(docs, "_toxicity")
    return score_texts(docs, train(docs, labels), output=name).where(F.col(f"{name}.score") < REJECT).drop(name)
