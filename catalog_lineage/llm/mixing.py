"""Mixing sources to target weights (operator 2, native): capped water-filling, then seeded whole and fractional repetitions.

The targets share the total by weight; a source that would exceed `max_epochs` times its own size stops there and the excess is
shared again by weight until no source is above. A source whose target is 2.4 times its size is taken twice whole; of the third
repetition, documents are taken in seeded order until the missing words are reached, the last one for its first words only. So
the taken words of a source equal its target up to rounding, and no document exceeds ceil(target / size) repetitions.

The seeded order is the digest of seed and document. The place where it stops is found by sums over digest prefixes, so no task
sorts a whole source. All of it is DataFrame work on built-in functions.

Defined results: null texts have no words; a null source is a source, last in order; sources without words have target 0; rows
that share a document id are ordered by their content; equal rows may swap; an empty table stays empty. Columns of the input
named like an output are replaced.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from catalog_lineage.llm.common import WORD_PATTERN, cut, free_name, numbered, packed, table, text_or_empty

SEED, MAX_EPOCHS = 1729, 3
RESULTS = ("size", "source_size", "target", "whole", "extra")
#: Hex digits of each prefix: a level has at most 256 sums per source, and two levels leave 1/65,536 of a source to sort.
DIGITS, LEVELS = 2, 2


def words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights in turn by code point of the source, null last."""
    ranked, _ = numbered(sources.select("source"), F.col("source").isNull(), F.col("source"), name="_rank")
    turn = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    return ranked.select("source", turn.cast("decimal(18,6)").alias("weight"))


def fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets for sources(source, source_size, weight). Every round shares what is left among the sources not yet stopped; it
    ends when a round stops no more. Sums are of integers and decimals, so reruns agree to the last bit."""
    sources = cut(sources)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap, stopped, share, base = F.col("source_size") * max_epochs, -1, 0, Decimal(1)
    level = F.lit(0.0)
    while True:
        above = cap < level if stopped >= 0 else F.lit(False)
        row = sources.agg(
            F.count(F.when(above, 1)).alias("n"), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("size"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == stopped:
            break
        stopped, share, base = row["n"], total - max_epochs * row["size"], row["weight"] or Decimal(1)
        level = F.col("weight").cast("double") * F.lit(float(share)) / F.lit(float(base))
    return sources.withColumn("target", F.least(cap.cast("double"), level))


def stops(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source: whole repetitions, the digest prefix at which the fractional one stops and the words still missing there."""
    found = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).withColumn("missing", F.greatest(F.round("target").cast("long") - F.col("whole") * F.col("source_size"), F.lit(0).cast("long"))).withColumn("stop", F.lit(""))
    for level in range(LEVELS):
        digits = level * DIGITS
        right = found.select(F.col("source").alias("_s"), "stop", "missing")
        inside = docs.join(right, F.col("source").eqNullSafe(F.col("_s")) & (F.substring("digest", 1, digits) == F.col("stop")) & (F.col("missing") > 0))
        sums = inside.groupBy("_s", "missing", F.substring("digest", digits + 1, DIGITS).alias("next")).agg(F.sum("size").alias("size"))
        before = F.sum("size").over(W.partitionBy("_s").orderBy("next")) - F.col("size")
        reached = sums.withColumn("before", before).where((F.col("before") < F.col("missing")) & (F.col("before") + F.col("size") >= F.col("missing")))
        reached = reached.select("_s", "next", "before")
        found = found.join(reached, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "source_size", "target", "whole",
            (F.col("missing") - F.coalesce("before", F.lit(0))).alias("missing"), F.concat("stop", F.coalesce("next", F.lit(""))).alias("stop"),
        )
    return cut(found)


def mix(df: DataFrame, weights: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Adds size, source_size, target, whole and extra: each document is taken `whole` times, and its first `extra` words once more.
    `weights` has source and weight; without it the weights are 1, 2, 3 in turn."""
    df = df.drop(*RESULTS)
    # With the text, so that an id that many rows share has no place of its own in the order.
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_or_empty().cast("binary")))
    digest = F.md5(told.cast("binary"))
    keyed = packed(df, source=F.col("source"), size=words(), digest=digest)
    docs = cut(keyed.select("source", "size", "digest"))
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = (weights if weights is not None else cycled_weights(sizes)).select(F.col("source").alias("_s"), F.col("weight").cast("decimal(18,6)").alias("weight"))
    sources = sizes.join(weights, F.col("source").eqNullSafe(F.col("_s"))).select("source", "source_size", "weight")
    found = stops(docs, fill(sources, max_epochs))
    right = found.select(F.col("source").alias("_s"), "source_size", "target", "whole", "missing", "stop")
    rows = keyed.join(right, F.col("source").eqNullSafe(F.col("_s")))
    prefix = F.substring("digest", 1, DIGITS * LEVELS)
    at_stop = (F.col("missing") > 0) & (prefix == F.col("stop"))
    clear = rows.where(~at_stop).withColumn("extra", F.when((F.col("missing") > 0) & (prefix < F.col("stop")), F.col("size")).otherwise(0).cast("long"))
    tied = W.partitionBy("_s").orderBy("digest", "_row.doc_id", "size", F.xxhash64("_row.text"))
    before = F.sum("size").over(tied.rowsBetween(W.unboundedPreceding, -1))
    last = rows.where(at_stop).withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("missing") - F.coalesce(before, F.lit(0)))))
    return clear.unionByName(last).select("_row.*", "size", "source_size", "target", "whole", "extra")


def repeated(mixed: DataFrame) -> DataFrame:
    """One row for each repetition: `whole` times the document, once more its first `extra` words with the spaces before them
    (the document as it is where that is all of them). Documents not taken give none; n_chars, where there, follows the text."""
    own = mixed.drop(*RESULTS)
    copies = (F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).cast("int")
    rows = packed(mixed, whole=F.col("whole"), extra=F.col("extra"), size=F.col("size"), copies=copies).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    cut_short = (F.col("copy") > F.col("whole")) & (F.col("extra") < F.col("size"))
    pieces = F.regexp_extract_all("_row.text", F.lit(r"[ \t-\r]*[^ \t-\r]+"), F.lit(0))
    first = F.array_join(F.slice(pieces, 1, F.greatest(F.col("extra"), F.lit(1)).cast("int")), "")
    text = F.when(cut_short, first).otherwise(F.col("_row.text"))
    made = {"text": text, "n_chars": F.when(cut_short, F.char_length(first)).otherwise(F.col("_row.n_chars")) if "n_chars" in own.columns else None}
    return rows.select(*(made[c].cast(own.schema[c].dataType).alias(c) if c in made else F.col(f"_row.`{c}`") for c in own.columns))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows that the mix takes of docs, each repetition one, with all columns of docs, also those named like a result."""
    aside = {c: free_name(docs, f"_{c}") for c in docs.columns if c.lower() in RESULTS}
    made = repeated(mix(docs.withColumnsRenamed(aside)))
    return made.withColumnsRenamed({new: own for own, new in aside.items()})


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"))


ORACLES = {
    "op2_mix_sources": f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5('{SEED}:' || doc_id::VARCHAR || ':' || md5(coalesce(text, ''))) AS digest FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM docs GROUP BY source
), stepped AS (
  SELECT *, coalesce(sum(source_size) OVER w, 0) AS size_before, (SELECT sum(weight) FROM sizes) - coalesce(sum(weight) OVER w, 0) AS weight_left,
    (SELECT sum(source_size) FROM sizes) AS total
  FROM sizes WINDOW w AS (ORDER BY source_size / weight, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT (total - {MAX_EPOCHS} * size_before)::DOUBLE AS share, weight_left::DOUBLE AS base FROM stepped
  WHERE {MAX_EPOCHS} * source_size >= weight * ((total - {MAX_EPOCHS} * size_before)::DOUBLE / weight_left::DOUBLE) ORDER BY size_before LIMIT 1
), targets AS (
  SELECT source, source_size, least(({MAX_EPOCHS} * source_size)::DOUBLE, weight::DOUBLE * share / base) AS target FROM sizes, filled
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), missing AS (
  SELECT *, greatest(round(target)::BIGINT - whole * source_size, 0) AS missing FROM parts
)
SELECT doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, missing - (sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id) - size))))::BIGINT AS taken
FROM docs d JOIN missing m ON d.source IS NOT DISTINCT FROM m.source
""",
}
