import functools
import random
from collections import deque

import pytest

from catalog_lineage.operators import pairing, window

SEM = "row_id string, row_order int, origin string, process_name string, relationship_type string, target_type string, target_name string, target_expression string"
REL = SEM.replace("row_id", "rel_id").replace("row_order", "position")


def served(rows, rels):
    """The rule, written out row by row."""
    free, out = dict(enumerate(rels)), {}
    for row in sorted(rows, key=lambda r: r[1]):
        best = None
        for i, rel in sorted(free.items(), key=lambda x: x[1][1]):
            if rel[2:5] != row[2:5]:
                continue
            score = 100 + 20 * bool(row[5] and row[5] == rel[5]) + 40 * bool(row[6] and row[6] == rel[6]) + 10 * bool(row[7] and row[7] == rel[7])
            if best is None or score > best[0]:
                best = (score, i)
        if best:
            out[row[0]] = (free.pop(best[1])[0], best[0])
    return out


def cases(seed, n):
    rng = random.Random(seed)
    make = lambda kind, i: (f"{kind}{i}", i, "TI", rng.choice("pq"), rng.choice(["R", "W"]), rng.choice(["CUBE", "VIEW", ""]) if kind == "s" else rng.choice(["CUBE", "VIEW"]), rng.choice(["a", "b", "c"]), rng.choice(["", "e1", "e2"]))
    return [make("s", i) for i in range(n)], [make("r", i) for i in range(n)]


def run(spark, rows, rels):
    got = pairing.pair_best(spark.createDataFrame(rows, SEM), spark.createDataFrame(rels, REL)).collect()
    return {r["row_id"]: (r["rel_id"], r["score"]) for r in got if r["rel_id"]}


def test_best_pairing_equals_the_rule(spark):
    rows, rels = cases(1, 60)
    assert run(spark, rows, rels) == served(rows, rels)


def test_slices_serve_as_one(spark, monkeypatch):
    rows, rels = cases(2, 60)
    rows, rels = [r if i % 5 else (*r[:6], "", r[7]) for i, r in enumerate(rows)], rels[: 45]
    for size, bound in ((25, 10**6), (60, 220)):
        monkeypatch.setattr(pairing, "SLICE_ROWS", size)
        monkeypatch.setattr(pairing, "SLICE_ENTRIES", bound)
        assert run(spark, rows, rels) == served(rows, rels)


def serve_fast(rows, rels):
    """The rule with a queue for each set of equal fields, for many rows of one source."""
    free, queues, out = set(), {}, {}
    for i, rel in enumerate(rels):
        free.add(i)
        for fields in ("tne", "tn", "ne", "n", "te", "t", "e", ""):
            queues.setdefault((fields, *(rel["tne".index(f) + 5] for f in fields)), deque()).append(i)
    for row in rows:
        for fields in ("tne", "tn", "ne", "n", "te", "t", "e", ""):
            wanted = [row["tne".index(f) + 5] for f in fields]
            queue = queues.get((fields, *wanted)) if all(wanted) else None
            while queue and queue[0] not in free:
                queue.popleft()
            if queue:
                free.discard(queue[0])
                out[row[0]] = (rels[queue.popleft()][0], 100 + 20 * ("t" in fields) + 40 * ("n" in fields) + 10 * ("e" in fields))
                break
    return out


def test_one_disputed_component_of_many_rows(spark, monkeypatch):
    """200,000 rows of one source that all dispute each other end in a few rounds."""
    rng = random.Random(5)
    make = lambda kind, i: (f"{kind}{i}", i, "TI", "p", "R", rng.choice(["CUBE", "VIEW"]), rng.choice("abcdefgh"), rng.choice(["", "e1", "e2"]))
    rows, rels = [make("s", i) for i in range(200_000)], [make("r", i) for i in range(190_000)]
    rounds, real = [], pairing._slices
    monkeypatch.setattr(pairing, "_slices", lambda *a: rounds.append(1) or real(*a))
    got = run(spark, rows, rels)
    assert 1 < len(rounds) < 20
    assert got == serve_fast(rows, rels)


VAL = "row_key string, relationship_id string, source_cube string, relationship_type string, target_type string, target_name string, line_number int"


def test_equal_references_pair_by_ordinal(spark):
    rows = [("a", None, "C", "REFERENCES_HIERARCHY", "HIERARCHY", "D", 20), ("b", None, "C", "REFERENCES_HIERARCHY", "HIERARCHY", "D", 10)]
    pairs, errors = pairing.pair(spark.createDataFrame(rows, VAL), spark.createDataFrame(rows, VAL))
    assert sorted((r["validation_key"], r["relationship_key"], r["join_method"], r["position"]) for r in pairs.collect()) == [
        ("a", "a", "SEMANTIC_GROUP_ORDINAL", 2), ("b", "b", "SEMANTIC_GROUP_ORDINAL", 1)]
    assert errors.count() == 0


def test_unequal_groups_are_errors(spark):
    one = [("a", None, "C", "R", "CUBE", "D", 1)]
    two = one + [("b", None, "C", "R", "CUBE", "D", 2)]
    pairs, errors = pairing.pair(spark.createDataFrame(one, VAL), spark.createDataFrame(two, VAL))
    assert pairs.count() == 0 and "validation_count=1; relationship_count=2" in errors.collect()[0]["error"]
    _, errors = pairing.pair(spark.createDataFrame(one, VAL), spark.createDataFrame([], VAL))
    assert "semantic_candidate_count=0" in errors.collect()[0]["error"]


def pairs_of(validations, relationships):
    """The rule of ``pair``, written out: ids first, then equal keys of equal size by order."""
    by_id, out, lost = {}, {}, {}
    for key, ident, *_ in sorted(relationships):
        if ident:
            by_id.setdefault(ident, key)
    groups = [{}, {}]
    for rows, side in ((validations, groups[0]), (relationships, groups[1])):
        for key, ident, name, line in rows:
            if side is groups[0] and ident in by_id:
                out[key] = (by_id[ident], "RELATIONSHIP_ID", 1, 1)
            else:
                side.setdefault(name, []).append((line, key))
    for name, left in groups[0].items():
        right = groups[1].get(name, [])
        if len(left) != len(right):
            lost.update({key: (len(left), len(right)) for _, key in left})
            continue
        method = "SEMANTIC_KEY" if len(left) == 1 else "SEMANTIC_GROUP_ORDINAL"
        for i, ((_, v), (_, r)) in enumerate(zip(sorted(left), sorted(right)), 1):
            out[v] = (r, method, i, len(left))
    return out, lost


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_pairs_equal_the_rule(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(pairing, "HOT_KEY_ROWS", hot_rows)
    monkeypatch.setattr(pairing, "ordinals", functools.partial(window.ordinals, hot_rows=hot_rows))
    rng = random.Random(8)
    names = ["hot"] * 40 + [f"one{i}" for i in range(30)] + ["two"] * 2 + [f"three{i % 4}" for i in range(12)]
    make = lambda kind, name, i: (f"{kind}{i:03d}", rng.choice(["id1", "id2", "id9", None]) if i % 11 == 0 else rng.choice(["", None]), name, str(rng.randint(1, 9)))
    validations = [make("v", n, i) for i, n in enumerate([*names, "only", "three0"])]
    relationships = [make("r", n, i) for i, n in enumerate([*names, "other"])]
    schema = "row_key string, relationship_id string, target_name string, line string"
    pairs, errors = pairing.pair(spark.createDataFrame(validations, schema), spark.createDataFrame(relationships, schema))
    expected, lost = pairs_of(validations, relationships)
    got = pairs.collect()
    assert {r.validation_key: (r.relationship_key, r.join_method, r.position, r.group_size) for r in got} == expected and len(got) == len(expected)
    assert {r.validation_key for r in errors.collect()} == set(lost) and {m for _, m, *_ in expected.values()} == {"RELATIONSHIP_ID", "SEMANTIC_KEY", "SEMANTIC_GROUP_ORDINAL"}
