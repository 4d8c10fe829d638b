"""Pairing of validations and semantic rows with the relationships they came from."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.ids import opt
from ..functions.text import clean, first_nonblank, match_value, norm_key, token
from .window import HOT_KEY_ROWS, cut, first_wins, ordinals

SOURCE_FIELDS = ("process_name", "cube_name", "source_name", "source_cube", "source_object_name", "source")
TIEBREAK = (
    ("procedure", "procedure_name", "rule_section", "section"),
    ("source_expression", "expression", "raw_expression", "statement"),
    ("dimension_name", "target_dimension", "dimension"),
    ("hierarchy_name", "target_hierarchy", "hierarchy"),
    ("attribute_name", "attribute"),
    ("subset_name", "subset"),
    ("view_name", "view"),
    ("line_number", "source_line", "line"),
    ("column_number", "column"),
    ("evidence_index", "sequence", "position"),
)


def _first(df: DataFrame, names) -> Column:
    return first_nonblank(*[opt(df, n) for n in names])


def semantic_key(df: DataFrame) -> Column:
    """Source, relationship type, target type and target of a row, under whichever names it carries them."""
    return F.array(
        norm_key(_first(df, SOURCE_FIELDS)),
        token(_first(df, ("relationship_type", "type"))),
        norm_key(_first(df, ("target_type", "target_object_type"))),
        norm_key(_first(df, ("target_name", "resolved_target_name", "target_expression", "target"))),
    )


def _ordered(df: DataFrame, row_key: str, extra=()) -> DataFrame:
    ties = [norm_key(_first(df, names)) if i < 7 else clean(_first(df, names)) for i, names in enumerate(TIEBREAK)]
    return df.select(
        F.col(row_key).cast("string").alias("row_key"), clean(opt(df, "relationship_id")).alias("explicit_id"),
        F.array_join(semantic_key(df), "\u001f").alias("semantic_key"),
        *[t.alias(f"tie{i}") for i, t in enumerate(ties)], *extra,
    )


ORDER = [f"tie{i}" for i in range(len(TIEBREAK))] + ["row_key"]


def _numbered(df: DataFrame, largest: int) -> DataFrame:
    """Positions in the order of each key; ``largest`` is the size of the largest key, counted before."""
    if largest > HOT_KEY_ROWS:
        return ordinals(df, "semantic_key", ORDER, "position")
    return df.withColumn("position", F.row_number().over(W.partitionBy("semantic_key").orderBy(*ORDER)))


def pair(validations: DataFrame, relationships: DataFrame, row_key: str = "row_key") -> tuple[DataFrame, DataFrame]:
    """(pairs, errors). Explicit ids pair first, where an id is repeated with its first relationship; the rest pair by semantic key and
    ordinal where both sides have the same number of rows, and become errors with both counts where they do not.

    Keys are counted once. Keys with one row on either side meet in a join; only rows of larger keys are sorted.
    """
    # both sides are read several times below, so their keys are computed once
    val, rel = cut(_ordered(validations, row_key)), cut(_ordered(relationships, row_key))
    by_id = first_wins(rel.where(F.col("explicit_id") != "").select("explicit_id", "row_key"), "explicit_id", "row_key")
    has_id = F.coalesce("explicit_id", F.lit("")) != ""
    # Columns that are mostly empty make a written table look smaller than the ids in it, so relationships are never left to be
    # broadcast by their estimated size; ids are looked up once, for hits and misses alike.
    looked_up = cut(val.where(has_id).join(by_id.withColumnRenamed("row_key", "_hit").hint("merge"), "explicit_id", "left"))
    explicit = looked_up.where("_hit is not null").select(
        F.col("row_key").alias("validation_key"), F.col("_hit").alias("relationship_key"), F.lit("RELATIONSHIP_ID").alias("join_method"),
        F.lit(1).cast("bigint").alias("position"), F.lit(1).cast("bigint").alias("group_size"), "semantic_key",
    )
    rest = val.where(~has_id).unionByName(looked_up.where("_hit is null").drop("_hit"))
    sides = rest.select("semantic_key", F.lit(1).alias("_v"), F.lit(0).alias("_r")).unionByName(rel.select("semantic_key", F.lit(0).alias("_v"), F.lit(1).alias("_r")))
    counts = sides.groupBy("semantic_key").agg(F.sum("_v").alias("validation_count"), F.sum("_r").alias("relationship_count"))
    counts = cut(counts.where("validation_count > 0"))
    equal = counts.where(F.col("validation_count") == F.col("relationship_count")).select("semantic_key", F.col("relationship_count").alias("group_size"))
    single = equal.where("group_size = 1")
    pairs = (
        rest.select("semantic_key", F.col("row_key").alias("validation_key")).join(single, "semantic_key")
        .join(rel.select("semantic_key", F.col("row_key").alias("relationship_key")).hint("merge"), "semantic_key")
        .select("validation_key", "relationship_key", F.lit("SEMANTIC_KEY").alias("join_method"), F.lit(1).cast("bigint").alias("position"), "group_size", "semantic_key")
    )
    largest = equal.agg(F.max("group_size")).first()[0] or 0
    if largest > 1:
        larger = equal.where("group_size > 1")
        left, right = (_numbered(side.join(larger, "semantic_key"), largest) for side in (rest, rel))
        pairs = pairs.unionByName(
            left.select("semantic_key", "position", "group_size", F.col("row_key").alias("validation_key"))
            .join(right.select("semantic_key", "position", F.col("row_key").alias("relationship_key")), ["semantic_key", "position"])
            .select(
                "validation_key", "relationship_key", F.lit("SEMANTIC_GROUP_ORDINAL").alias("join_method"),
                F.col("position").cast("bigint").alias("position"), "group_size", "semantic_key",
            )
        )
    bad = counts.where(F.col("validation_count") != F.col("relationship_count"))
    message = F.when(
        F.col("relationship_count") == 0, "No relationship has this key; semantic_candidate_count=0"
    ).otherwise(F.format_string(
        "Validations and relationships of this key differ in number; validation_count=%d; relationship_count=%d",
        F.col("validation_count"), F.col("relationship_count"),
    ))
    errors = rest.join(bad, "semantic_key").select(
        F.col("row_key").alias("validation_key"), "semantic_key", F.lit("JOIN_VALIDATION_TO_RELATIONSHIP").alias("stage"), message.alias("error")
    )
    return explicit.unionByName(pairs), errors


# ---- best-score pairing ----------------------------------------------------------------
#
# Rows are served in order; each takes, among the relationships of its source and type that are still free, the one
# with the best score (100, +20 same target type, +40 same target name, +10 same expression), the earliest on ties.
# A score is a set of equal fields, so "the best free one" is the earliest free member of the first non-empty tier.

TIERS = ("tne", "tn", "ne", "n", "te", "t", "e", "")
TIER_SCORE = {tier: 100 + 20 * ("t" in tier) + 40 * ("n" in tier) + 10 * ("e" in tier) for tier in TIERS}
#: Most rows of a component that are served in one task, and most entries of tiers that they are served from.
SLICE_ROWS, SLICE_ENTRIES = 50_000, 1_500_000
PAIR_SCHEMA = "row_id string, rel_id string, score int"


def _tier_keys(fields: dict[str, Column], wanted: bool) -> Column:
    """Tier number and key for every tier; a row leaves out the tiers that need a field it lacks."""
    entries = []
    for number, tier in enumerate(TIERS):
        key = F.concat_ws("\u001f", F.col("bucket"), *[F.concat(F.lit(f"{f}="), fields[f]) for f in tier])
        entry = F.struct(F.lit(number).alias("tier"), key.alias("tier_key"))
        for f in tier if wanted else "":
            entry = F.when(fields[f] != "", entry)
        entries.append(entry)
    return F.array_compact(F.array(*entries))


def _serve_in_order(key, rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The rule itself, for one slice of a component; entries are the members of its tiers."""
    taken, queues, out = set(), defaultdict(deque), []
    for entry in entries.sort_values(["position", "rel_id"]).itertuples():
        queues[entry.tier, entry.tier_key].append(entry.rel_id)
    for row in rows.sort_values(["row_order", "row_id"]).itertuples():
        for entry in sorted(row.tiers, key=lambda e: e["tier"]):
            queue = queues.get((entry["tier"], entry["tier_key"]))
            while queue and queue[0] in taken:
                queue.popleft()
            if queue:
                rel_id = queue.popleft()
                taken.add(rel_id)
                out.append((row.row_id, rel_id, TIER_SCORE[TIERS[entry["tier"]]]))
                break
    return pd.DataFrame(out, columns=["row_id", "rel_id", "score"])


def _serve_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rule itself, for whole components one after the other: relationships by their position, then the rows by their order. The
    state is the relationships of the present component."""
    wanted = [tuple("tne".index(f) for f in tier) for tier in TIERS]
    component, members, queues, taken = object(), [], None, set()
    for batch in batches:
        row_ids, rel_ids, scores = [], [], []
        for of, is_row, ident, *fields in zip(*(batch.column(c).to_pylist() for c in range(6))):
            if of != component:
                component, members, queues, taken = of, [], None, set()
            if not is_row:
                members.append((ident, fields))
                continue
            found = score = None
            if len(members) == 1:
                if not taken:
                    found, theirs = members[0]
                    t, n, e = (bool(mine) and mine == other for mine, other in zip(fields, theirs))
                    score = 100 + 20 * t + 40 * n + 10 * e
                    taken.add(found)
            elif len(taken) < len(members):
                if queues is None:
                    queues = {}
                    for rel_id, theirs in members:
                        for tier, places in enumerate(wanted):
                            queues.setdefault((tier, *[theirs[i] for i in places]), [1]).append(rel_id)
                for tier, places in enumerate(wanted):
                    own = [fields[i] for i in places]
                    queue = queues.get((tier, *own)) if all(own) else None
                    if queue is None:
                        continue
                    # the first entry of a queue is the place of its next member
                    at, size = queue[0], len(queue)
                    while at < size and queue[at] in taken:
                        at += 1
                    queue[0] = at + 1
                    if at < size:
                        found, score = queue[at], TIER_SCORE[TIERS[tier]]
                        taken.add(found)
                        break
                    queue[0] = size
            row_ids.append(ident)
            rel_ids.append(found)
            scores.append(score)
        if row_ids:
            yield pa.RecordBatch.from_arrays([pa.array(row_ids, pa.string()), pa.array(rel_ids, pa.string()), pa.array(scores, pa.int32())], ["row_id", "rel_id", "score"])


def _buckets(rows: DataFrame, rels: DataFrame) -> DataFrame:
    """bucket, closed, large: of the buckets with rows and relationships, whether their targets are components of their own (see
    _components), and whether their largest component has more than SLICE_ROWS rows or relationships."""
    per_row = rows.groupBy("bucket", "target").agg(F.count("*").alias("_rows"), F.bool_and("named").alias("_named"))
    per_rel = rels.groupBy("bucket", "target").agg(F.count("*").alias("_rels"))
    sides = per_row.withColumn("_rels", F.lit(0).cast("bigint")).unionByName(per_rel.withColumns({"_rows": F.lit(0).cast("bigint"), "_named": F.lit(True)}))
    per_target = sides.groupBy("bucket", "target").agg(F.sum("_rows").alias("_rows"), F.sum("_rels").alias("_rels"), F.bool_and("_named").alias("_named"))
    most = lambda of: F.greatest(of("_rows"), of("_rels"))
    closed = F.bool_and(F.col("_named") & (F.col("_rows") <= F.col("_rels")))
    counted = per_target.groupBy("bucket").agg(closed.alias("closed"), most(F.max).alias("_target"), most(F.sum).alias("_all"), F.sum("_rows").alias("_n"), F.sum("_rels").alias("_m"))
    return counted.where("_n > 0 and _m > 0").select("bucket", "closed", (F.when(F.col("closed"), F.col("_target")).otherwise(F.col("_all")) > SLICE_ROWS).alias("large"))


def _components(rows: DataFrame, rels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label rows and relationships with the part of their bucket in which they can meet.

    When every row of a bucket names a target and no target has more rows than relationships, rows never leave their
    target, so each target is its own component; otherwise the bucket is one.
    """
    per_row = rows.groupBy("bucket", "target").agg(F.count("*").alias("_rows"), F.bool_and("named").alias("_named"))
    per_rel = rels.groupBy("bucket", "target").agg(F.count("*").alias("_rels"))
    closed = (
        per_row.join(per_rel, ["bucket", "target"], "left")
        .groupBy("bucket").agg(F.bool_and(F.col("_named") & (F.col("_rows") <= F.coalesce("_rels", F.lit(0)))).alias("closed"))
    )
    label = F.when(F.coalesce("closed", F.lit(False)), F.concat_ws("\u001e", "bucket", "target")).otherwise(F.col("bucket"))
    mark = lambda df: df.drop("component").join(closed, "bucket", "left").withColumn("component", label).drop("closed")
    return mark(rows), mark(rels)


def _claims(rows: DataFrame, rels: DataFrame) -> DataFrame:
    """row_id, row_order, tier, rel_id, ok: every row claims by ordinal in its first non-empty tier, ok where no earlier row does."""
    rel_tiers = rels.select("rel_id", "position", F.explode("tiers").alias("t")).select("rel_id", "position", "t.*")
    sizes = rel_tiers.groupBy("tier", "tier_key").agg(F.lit(1).alias("_any"))
    first = (
        rows.select("row_id", "row_order", F.explode("tiers").alias("t")).select("row_id", "row_order", "t.*")
        .join(sizes, ["tier", "tier_key"])
        .groupBy("row_id", "row_order").agg(F.min(F.struct("tier", "tier_key")).alias("t"))
        .select("row_id", "row_order", "t.*")
    )
    first = cut(first)
    ranked_rows = ordinals(first, ["tier", "tier_key"], ["row_order", "row_id"], "k")
    used = rel_tiers.join(first.select("tier", "tier_key").distinct(), ["tier", "tier_key"], "left_semi")
    ranked_rels = ordinals(used, ["tier", "tier_key"], ["position", "rel_id"], "k")
    claims = ranked_rows.join(ranked_rels.select("tier", "tier_key", "k", "rel_id"), ["tier", "tier_key", "k"], "left")
    # claims of nothing get keys of their own, so that they do not meet in one task
    claims = claims.withColumn("_claimed", F.coalesce("rel_id", F.concat(F.lit("\u0001"), "row_id")))
    owners = claims.groupBy("_claimed").agg(F.min(F.struct("row_order", "row_id")).alias("_owner"))
    mine = F.col("rel_id").isNotNull() & (F.struct("row_order", "row_id") == F.col("_owner"))
    return cut(claims.join(owners, "_claimed").select("row_id", "row_order", "tier", "rel_id", mine.alias("ok")))


def _won(claims: DataFrame) -> DataFrame:
    score = F.element_at(F.array(*[F.lit(TIER_SCORE[t]) for t in TIERS]), F.col("tier") + 1)
    return claims.select("row_id", "rel_id", score.cast("int").alias("score"))


def _certain(claims: DataFrame, rows: DataFrame) -> DataFrame:
    """Claims of the rows before the first disputed or unserved one of their component."""
    placed = claims.join(rows.select("row_id", "component"), "row_id")
    disputed = placed.where("not ok").groupBy("component").agg(F.min(F.struct("row_order", "row_id")).alias("_stop"))
    return placed.join(disputed, "component", "left").where(F.col("_stop").isNull() | (F.struct("row_order", "row_id") < F.col("_stop")))


def _slices(rows: DataFrame, rels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first rows of every component, and the members of the tiers that they can be served from.

    So many rows take at most so many relationships, so the first free members of each tier they reach, as many as there are rows, are
    enough. A slice has SLICE_ROWS rows, or half as often as it takes for the entries to stay below SLICE_ENTRIES.
    """
    pool = ["component", "tier", "tier_key"]
    in_pools = lambda df, *own: df.select(*own, "component", F.explode("tiers").alias("t")).select(*own, "component", "t.*")
    rank = F.row_number().over(W.partitionBy("component").orderBy("row_order", "row_id"))
    first = cut(rows.withColumn("_rank", rank).where(F.col("_rank") <= SLICE_ROWS))
    place = F.row_number().over(W.partitionBy(*pool).orderBy("position", "rel_id"))
    touched = in_pools(first, "_rank").groupBy(*pool).agg(F.min("_rank").alias("_rank"))
    near = in_pools(rels, "rel_id", "position").withColumn("_place", place).where(F.col("_place") <= SLICE_ROWS)
    near = cut(near.join(touched, pool))
    sizes = near.groupBy(*pool, "_rank").agg(F.count("*").alias("_size"))
    ladder = [SLICE_ROWS >> j for j in range(SLICE_ROWS.bit_length())]
    held = [F.sum(F.when(F.col("_rank") <= r, F.least("_size", F.lit(r)))) for r in ladder]
    fits = F.coalesce(*[F.when(h <= SLICE_ENTRIES, F.lit(r)) for h, r in zip(held, ladder)], F.lit(1))
    size = sizes.groupBy("component").agg(fits.alias("_rows"))
    head = first.join(size, "component").where(F.col("_rank") <= F.col("_rows")).drop("_rank", "_rows")
    entries = near.join(size, "component").where((F.col("_rank") <= F.col("_rows")) & (F.col("_place") <= F.col("_rows")))
    return head, entries.select(*pool, "rel_id", "position")


def pair_best(semantic: DataFrame, relationships: DataFrame, row_id: str = "row_id", row_order: str = "row_order",
              rel_id: str = "rel_id", position: str = "position") -> DataFrame:
    """The relationship each semantic row is served, with score and method; unmatched rows have none.

    A row that is alone in its bucket, with one relationship or none, is decided by the count of its bucket. Of the others,
    components of at most SLICE_ROWS rows and relationships are sorted and streamed through the rule, many in one task. Larger ones
    are paired at once by joins where nobody disputes; where rows dispute a relationship, who is served what depends on everyone
    before, so each component is served by slices of its order, in tasks of bounded size and in as many rounds as it has slices.
    """
    def shape(df: DataFrame, ident: str, order: str, names: tuple[str, str]) -> DataFrame:
        fields = {
            "t": token(_first(df, ("target_type", "target_object_type", "domain"))),
            "n": match_value(_first(df, ("target_name", "catalog_match_name", "target_expression"))),
            "e": match_value(opt(df, "target_expression")),
        }
        staged = df.select(
            F.col(ident).cast("string").alias(names[0]), F.col(order).alias(names[1]),
            F.concat_ws("\u001f", token(opt(df, "origin")), match_value(_first(df, SOURCE_FIELDS)), token("relationship_type")).alias("bucket"),
            *[v.alias(k) for k, v in fields.items()],
        )
        return cut(staged.withColumns({"target": F.concat_ws("\u001f", "t", "n"), "named": (F.col("t") != "") & (F.col("n") != "")}))

    everyone = shape(semantic, row_id, row_order, ("row_id", "row_order"))
    rels = shape(relationships, rel_id, position, ("rel_id", "position"))
    counted = cut(_bucket_heads(everyone, rels))
    decided = _decided(counted)
    disputed = counted.where("_n > 1 and _m > 0 or _n = 1 and _m > 1").select("bucket")
    unanswered = counted.where("_n > 1 and _m = 0").select("bucket")
    decided = decided.unionByName(everyone.join(unanswered, "bucket", "left_semi").select("row_id", F.lit(None).cast("string").alias("rel_id"), F.lit(None).cast("int").alias("score")))
    if not disputed.isEmpty():
        held = lambda df: cut(df.join(disputed, "bucket", "left_semi").select(*df.columns))
        decided = decided.unionByName(_served(held(everyone), held(rels)))
    return cut(decided).withColumn(
        "source_pairing_method",
        F.when(F.col("rel_id").isNull(), "UNMATCHED").when(F.col("score") >= 160, "EXACT_SEMANTIC_SIGNATURE").otherwise("RELAXED_SEMANTIC_SIGNATURE"),
    )


def _bucket_heads(rows: DataFrame, rels: DataFrame) -> DataFrame:
    """bucket, _n, _m, _row, _rel: rows and relationships of each bucket, and the least of either side."""
    side = lambda df, ident, is_row: df.select("bucket", F.lit(is_row).alias("is_row"), F.struct(F.col(ident).alias("ident"), "t", "n", "e").alias("it"))
    least = lambda own: F.min(F.when(own, F.col("it")))
    is_row = F.col("is_row")
    return side(rows, "row_id", True).unionByName(side(rels, "rel_id", False)).groupBy("bucket").agg(
        F.count_if(is_row).alias("_n"), F.count_if(~is_row).alias("_m"), least(is_row).alias("_row"), least(~is_row).alias("_rel"))


def _decided(counted: DataFrame) -> DataFrame:
    """row_id, rel_id, score of the rows that are alone in their bucket, with one relationship, which they are served, or none."""
    same = lambda f, points: F.when((F.col(f"_row.{f}") != "") & (F.col(f"_row.{f}") == F.col(f"_rel.{f}")), points).otherwise(0)
    score = F.when(F.col("_m") == 1, F.lit(100) + same("t", 20) + same("n", 40) + same("e", 10)).cast("int")
    return counted.where("_n = 1 and _m <= 1").select(F.col("_row.ident").alias("row_id"), F.col("_rel.ident").alias("rel_id"), score.alias("score"))


def _served(everyone: DataFrame, rels: DataFrame) -> DataFrame:
    """row_id, rel_id, score of the rows of buckets in which somebody has a choice or a rival."""
    buckets = cut(_buckets(everyone, rels))
    # a row that no relationship can answer is a component of its own, so that such rows do not meet in one task
    inside = F.when(F.col("closed"), F.concat_ws("\u001e", "bucket", "target")).otherwise(F.col("bucket"))
    label = F.when(F.col("closed").isNull(), F.concat(F.lit("\u0001"), F.col("ident"))).otherwise(inside)
    side = lambda df, is_row, ident, how: df.withColumnRenamed(ident, "ident").join(buckets, "bucket", how).where("not coalesce(large, false)").select(
        label.alias("component"), F.lit(is_row).alias("is_row"), "ident", "t", "n", "e",
        *[(F.col(o) if o == own else F.lit(None).cast(kind)).alias(o) for own in [df.columns[1]] for o, kind in (("position", rels.schema["position"].dataType), ("row_order", everyone.schema["row_order"].dataType))],
    )
    streamed = side(everyone, True, "row_id", "left").unionByName(side(rels, False, "rel_id", "inner"))
    ordered = streamed.repartition("component").sortWithinPartitions("component", "is_row", "position", "row_order", "ident")
    served = ordered.select("component", "is_row", "ident", "t", "n", "e").mapInArrow(_serve_stream, PAIR_SCHEMA)
    large = buckets.where("large").select("bucket")
    if not large.isEmpty():
        tiers = lambda df, wanted: df.join(large, "bucket", "left_semi").withColumns({
            "tiers": _tier_keys({f: F.col(f) for f in "tne"}, wanted), "component": F.lit("")}).drop("t", "n", "e")
        rows = cut(tiers(everyone, True))
        pairs = _pair_large(rows, cut(tiers(rels, False)))
        served = served.unionByName(rows.select("row_id").join(pairs, "row_id", "left"))
    return served


def _pair_large(rows: DataFrame, rels: DataFrame) -> DataFrame:
    """row_id, rel_id, score of the rows that are served, for buckets that all have relationships."""
    found = []
    while True:
        claims = _claims(rows, rels)
        if claims.where("not ok").isEmpty():
            # every row of a bucket with relationships left can be served by its last tier, so all are
            found.append(_won(claims))
            break
        rows, rels = (cut(side) for side in _components(rows, rels))
        won = cut(_won(_certain(claims, rows)))
        found.append(won)
        rows = rows.join(won.select("row_id"), "row_id", "left_anti")
        rels = rels.join(won.select("rel_id"), "rel_id", "left_anti")
        rows = cut(rows.join(rels.select("bucket").distinct(), "bucket", "left_semi"))
        if rows.isEmpty():
            break
        rels = cut(rels.join(rows.select("bucket").distinct(), "bucket", "left_semi"))
        rows, rels = (cut(side) for side in _components(rows, rels))
        head, near = _slices(rows, rels)
        head = cut(head)
        served = cut(head.groupBy("component").cogroup(near.groupBy("component")).applyInPandas(_serve_in_order, PAIR_SCHEMA))
        found.append(served)
        rows = rows.join(head.select("row_id"), "row_id", "left_anti")
        rels = cut(rels.join(served.select("rel_id"), "rel_id", "left_anti"))
        rows = cut(rows.join(rels.select("bucket").distinct(), "bucket", "left_semi"))
        if rows.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs
