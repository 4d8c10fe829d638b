"""Targets resolved through parameters, against a row-by-row version, and a process with many references and many callers."""

import random
from collections import defaultdict

from catalog_lineage.operators import parameters, resolve

REFS = "row_key string, process_name string, target_type string, target_name string, target_expression string, confidence string"
PARAMS = "process_name string, parameter_name string, default_value string"
BINDINGS = "calling_process string, called_process string, parameter_name string, resolved_value string, line_number int"
ALIASES = "process_name string, variable string, expression string, dependencies array<string>"
OBJECTS = "object_type string, object_name string, seq int"


def tables(spark, refs, params, bindings, aliases, objects):
    return [spark.createDataFrame(rows, schema) for rows, schema in ((refs, REFS), (params, PARAMS), (bindings, BINDINGS), (aliases, ALIASES), (objects, OBJECTS))]


def row_by_row(refs, params, bindings, aliases, objects):
    """Summary rows, provenance and rejections, one reference at a time."""
    low = lambda s: (s or "").strip().lower()
    catalog = {}
    for kind, name, seq in sorted(objects, key=lambda o: o[2]):
        catalog.setdefault((low(kind), low(name)), name)
    summary, provenance, rejections = [], [], []
    for ref in refs:
        row, process, kind, _, expression, confidence = ref
        if confidence != "UNRESOLVED":
            summary.append((row, ref[3], confidence))
            continue
        ways = []
        given = {low(p) for _, c, p, _, _ in bindings if low(c) == low(process)}
        default = defaultdict(list)
        for p, name, value in params:
            if low(p) == low(process) and low(value):
                default[low(name)].append(value)
        if low(expression) in given | set(default):
            ways.append((low(expression), None))
        ways += [(low(d[0]), e) for p, v, e, d in aliases if low(p) == low(process) and low(v) == low(expression) and len(d) == 1]
        contexts, covered = set(), bool(ways)
        for name, alias in set(ways):
            calls = [b for b in bindings if low(b[1]) == low(process) and low(b[2]) == name]
            said = [b for b in calls if b[3] is not None]
            compose = lambda value: value if alias is None else "".join(p.strip()[1:-1] if p.strip().startswith("'") else value for p in alias.split("|"))
            if said:
                found = [(compose(b[3]), "EXECUTE_PROCESS_ARGUMENT", b[0], b[4]) for b in said]
            elif default[name]:
                found = [(compose(max(default[name])), "PARAMETER_DEFAULT" if alias is None else "PARAMETER_ALIAS", None, None)]
            else:
                found = []
            covered &= bool(said or default[name]) and len(said) == len(calls)
            contexts |= {(*f, name) for f in found if f[0].strip()}
        hit = lambda value: catalog.get((low(kind), low(value)))
        whole = covered and contexts and all(hit(c[0]) for c in contexts)
        if not whole:
            summary.append((row, ref[3], confidence))
        summary += [(row, n, "RESOLVED") for n in {hit(c[0]) for c in contexts} if n]
        for value, source, caller, line in {c[:4] for c in contexts}:
            (provenance if hit(value) else rejections).append((row, value, source) if not hit(value) else (row, value, source, caller, line))
    return [sorted(map(str, part)) for part in (summary, provenance, rejections)]


def test_against_row_by_row(spark):
    pick = random.Random(11)
    objects = [("cube", n, i) for i, n in enumerate(["A", "B", "xA", "xB", "D"])] + [("dimension", "A", 9)]
    for _ in range(3):
        refs = [(f"r{i}", pick.choice(["P1", "p1", "P2", "P3", None]), pick.choice(["cube", "dimension"]), None, pick.choice(["pOne", "pone", "pTwo", "sAlias", "other", "", None]), pick.choice(["UNRESOLVED", "UNRESOLVED", "CONFIRMED"])) for i in range(60)]
        params = [("P1", "pOne", "D"), ("P2", "pTwo", pick.choice(["A", "Z", ""])), ("P2", "pOne", None), ("P3", "pOne", "A")]
        bindings = list({(f"c{pick.randint(0, 5)}", pick.choice(["P1", "P2"]), pick.choice(["pOne", "pTwo"]), pick.choice(["A", "B", "Z", "", None]), pick.randint(1, 9)) for _ in range(pick.choice([0, 3, 30]))})
        aliases = [("P1", "sAlias", "'x' | pOne", ["pOne"]), ("P2", "sAlias", "pTwo", ["pTwo"]), ("P3", "sAlias", "pOne | pTwo", ["pOne", "pTwo"])]
        given = (refs, params, bindings, aliases, objects)
        result, provenance, rejections = parameters.resolve_parameters(*tables(spark, *given))
        got = [
            [(r.row_key, r.target_name, r.confidence) for r in result.collect()],
            [(r.row_key, r.value, r.source_kind, r.calling_process, r.calling_line_number) for r in provenance.collect()],
            [(r.row_key, r.candidate_value, r.source_kind) for r in rejections.collect()],
        ]
        expected = row_by_row(*given)
        assert [sorted(map(str, part)) for part in got] == expected
        assert expected[0]
    assert all(df.count() == 0 for df in parameters.resolve_parameters(*tables(spark, [], [], [], [], [])))


def test_many_references_and_callers_of_one_process_do_not_meet(spark):
    n = 10_000
    refs = spark.range(n).selectExpr("concat('r', id) as row_key", "'Busy' as process_name", "'cube' as target_type", "cast(null as string) as target_name", "'pCube' as target_expression", "'UNRESOLVED' as confidence")
    bindings = spark.range(n).selectExpr("concat('c', id) as calling_process", "'busy' as called_process", "'pcube' as parameter_name", "concat('Cube', id % 5) as resolved_value", "cast(id % 7 as int) as line_number")
    _, params, _, aliases, objects = tables(spark, [], [], [], [], [("cube", f"Cube{i}", i) for i in range(5)])
    links = parameters.link_parameters(refs, params, bindings, aliases, objects)
    assert (links.references.count(), links.answers.count(), links.callers.count()) == (n, 5, n)
    result, provenance, _ = parameters.resolve_parameters(refs, params, bindings, aliases, objects)
    assert result.groupBy("confidence").count().collect() == [("RESOLVED", 5 * n)]
    assert provenance.where("row_key = 'r17'").count() == n


def test_callers_come_in_chunks(spark):
    rows = [("p", "R", "CUBE", "a", "LITERAL", f"caller{i % 250}") for i in range(600)] + [("q", "R", "CUBE", "a", "DEFAULT", " "), ("q", "R", "CUBE", "a", None, None)]
    provenance = spark.createDataFrame(rows, "process_name string, relationship_type string, target_type string, target_name string, source_kind string, calling_process string")
    refs = spark.createDataFrame([(1, "P", "R", "CUBE", " A "), (2, "q", "R", "CUBE", "a"), (3, "q", "R", "CUBE", "b"), (4, None, None, None, None)], "id int, process_name string, relationship_type string, target_type string, target_name string")
    enriched = resolve.provenance_enrich(refs, provenance)
    assert {r.id: (r.parameter_resolution_applied, r.resolution_source, r.provenance_count) for r in enriched.collect()} == {
        1: (True, ["LITERAL"], 600), 2: (True, ["DEFAULT"], 2), 3: (False, None, None), 4: (False, None, None)}
    listed = enriched.join(resolve.provenance_callers(provenance, chunk_rows=20), "provenance_key").collect()
    assert {r.id for r in listed} == {1} and len({r.chunk for r in listed}) == len(listed) > 5
    assert sorted(c for r in listed for c in r.calling_processes) == sorted(f"caller{i}" for i in range(250))
