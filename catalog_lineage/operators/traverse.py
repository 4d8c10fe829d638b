"""Graph queries as bounded rounds of joins over the edge table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import clean
from .resolve import edge_view, node_view
from .window import cut

MAX_DEPTH = 5


@dataclass
class Traversal:
    nodes: DataFrame
    edges: DataFrame
    paths: DataFrame
    truncated: bool


def _hops(edges: DataFrame, direction: str, types) -> DataFrame:
    if direction not in ("inbound", "outbound", "both"):
        raise ValueError("direction must be inbound, outbound, or both")
    if types:
        edges = edges.where(F.upper(clean("relationship_type")).isin(*[t.upper() for t in types]))
    way = lambda number, a, b: edges.select(
        F.col(a).alias("from_id"), F.concat(F.lit(number), F.col("graph_relationship_id")).alias("step"),
        F.col("graph_relationship_id").alias("edge_id"), F.col(b).alias("to_id"),
    )
    ways = {"outbound": [("0", "source_id", "target_id")], "inbound": [("1", "target_id", "source_id")]}
    chosen = ways.get(direction) or ways["outbound"] + ways["inbound"]
    return reduce(lambda x, y: x.unionByName(y), [way(*w) for w in chosen])


STATE = "node_ids array<string>, relationship_ids array<string>, steps array<string>, cycle boolean, ended boolean"


def _start(edges: DataFrame, start: str) -> DataFrame:
    return edges.sparkSession.range(1).select(
        F.array(F.lit(start)).alias("node_ids"), F.array().cast("array<string>").alias("relationship_ids"),
        F.array().cast("array<string>").alias("steps"), F.lit(False).alias("cycle"), F.lit(False).alias("ended"),
    )


def _extend(state: DataFrame, hops: DataFrame) -> DataFrame:
    """One more hop for every open path; paths that end or close a cycle are carried along unchanged."""
    # ended paths get a key of their own, so they spread over the partitions and meet no edge
    key = F.when(F.col("ended"), F.concat(F.lit("\u0001"), F.array_join("steps", "\u0001"))).otherwise(F.element_at("node_ids", -1))
    joined = state.withColumn("_key", key).join(hops, F.col("_key") == F.col("from_id"), "left")
    moved = F.col("edge_id").isNotNull()
    closes = moved & F.array_contains("node_ids", F.col("to_id"))
    grown = lambda c, x: F.when(moved, F.array_append(c, F.col(x))).otherwise(F.col(c))
    return joined.select(
        grown("node_ids", "to_id").alias("node_ids"), grown("relationship_ids", "edge_id").alias("relationship_ids"),
        grown("steps", "step").alias("steps"), (F.col("cycle") | closes).alias("cycle"), (F.col("ended") | ~moved | closes).alias("ended"),
    )


def _capped(state: DataFrame, grown: DataFrame, max_nodes: int, max_edges: int) -> tuple[DataFrame, bool]:
    """Paths of the next level within the caps, admitted in the order of their steps; dropped extensions leave their
    path behind as ended."""
    grown = cut(grown)
    level = F.size("steps")
    seen_nodes = state.select(F.explode("node_ids").alias("id")).distinct()
    seen_edges = state.select(F.explode("relationship_ids").alias("id")).distinct()
    counts = seen_nodes.agg(F.count("*").alias("n")).crossJoin(seen_edges.agg(F.count("*").alias("e"))).head()
    depth = state.where(~F.col("ended")).agg(F.max(level)).head()[0] or 0
    fresh = grown.where(level == depth + 1)
    ends = fresh.select(F.element_at("node_ids", -1).alias("id"), F.element_at("relationship_ids", -1).alias("edge"), "steps")
    first = lambda df, c, seen: df.groupBy(F.col(c).alias("id")).agg(F.min("steps").alias("at")).join(seen, "id", "left_anti")
    admitted = first(ends, "id", seen_nodes).orderBy("at").limit(max(max_nodes - counts["n"], 0))
    reachable = seen_nodes.unionByName(admitted.select("id"))
    inside = fresh.withColumn("id", F.element_at("node_ids", -1)).join(reachable, "id", "left_semi").drop("id")
    room = max(max_edges - counts["e"], 0)
    new_edges = first(inside.select(F.element_at("relationship_ids", -1).alias("edge"), "steps"), "edge", seen_edges)
    last = new_edges.orderBy("at").limit(room).agg(F.max("at").alias("last"), F.count("*").alias("n")).head()
    total = new_edges.count()
    kept = inside if total < room else inside.where(F.col("steps") <= F.array(*[F.lit(s) for s in last["last"]])) if room else inside.limit(0)
    kept = cut(kept)
    finished = grown.where(level <= depth)
    parents = kept.select(F.slice("steps", F.lit(1), F.greatest(level - 1, F.lit(0))).alias("steps")).distinct()
    stopped = state.where(~F.col("ended")).join(parents, "steps", "left_anti").select(*[F.col(c) for c in state.columns[:-1]], F.lit(True).alias("ended"))
    stopped = stopped.join(finished.select("steps"), "steps", "left_anti").select(*state.columns)
    return cut(finished.select(*state.columns).unionByName(stopped).unionByName(kept.select(*state.columns))), kept.count() < fresh.count()


def neighborhood(edges: DataFrame, start: str, direction: str = "both", depth: int = 1, types=None,
                 max_nodes: int | None = 500, max_edges: int | None = 5000) -> Traversal:
    """All simple paths from a node, cycles flagged and stopped.

    With caps, nodes and edges are admitted level by level in the order of their steps, and ``truncated`` says whether
    something was left out. Without caps (None) every hop but the last is written once.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be between 0 and {MAX_DEPTH}")
    hops = _hops(edges, direction, types)
    state, finished, truncated = _start(edges, start), [], False
    for level in range(1, depth + 1):
        if max_nodes is None or max_edges is None:
            state = _extend(state, hops)
            if level < depth:
                # Only the frontier meets the edges again; what has ended is set aside where it was written.
                state = cut(state)
                finished.append(state.where("ended"))
                state = state.where("not ended")
        else:
            state = cut(state)
            ends = state.where(~F.col("ended")).select(F.element_at("node_ids", -1).alias("from_id")).distinct()
            near = hops.join(F.broadcast(ends), "from_id", "left_semi")  # never more rows than max_nodes
            state, cut_off = _capped(state, _extend(state, near), max_nodes, max_edges)
            truncated = truncated or cut_off
    state = reduce(DataFrame.unionByName, finished, state)
    paths = state.where(F.size("relationship_ids") > 0).select(
        F.concat_ws("::", F.lit("path"), F.size("relationship_ids").cast("string"), F.element_at("relationship_ids", -1)).alias("path_id"),
        F.size("relationship_ids").alias("depth"), "node_ids", "relationship_ids", "cycle",
    )
    return Traversal(
        state.select(F.explode("node_ids").alias("node_id")).distinct(),
        state.select(F.explode("relationship_ids").alias("graph_relationship_id")).distinct(),
        paths, truncated,
    )


def impact(edges: DataFrame, start: str, direction: str = "inbound", depth: int = 3, max_nodes: int | None = 1000, max_edges: int | None = 5000) -> Traversal:
    """What depends on a node, with the paths to it; ``reachable`` gives the nodes alone, however many paths there are."""
    return neighborhood(edges, start, direction, depth, None, max_nodes, max_edges)


def reachable(edges: DataFrame, start: str, direction: str = "inbound", depth: int = 3, types=None) -> DataFrame:
    """Nodes within ``depth`` hops and their distance. Only nodes travel, so the number of paths does not matter."""
    hops = _hops(edges, direction, types).select("from_id", "to_id")
    seen = edges.sparkSession.range(1).select(F.lit(start).alias("node_id"), F.lit(0).alias("distance"))
    for level in range(1, depth + 1):
        step = seen.where(F.col("distance") == level - 1).join(hops, F.col("node_id") == F.col("from_id")).select(
            F.col("to_id").alias("node_id"), F.lit(level).alias("distance")
        )
        seen = seen.unionByName(step).groupBy("node_id").agg(F.min("distance").alias("distance"))
    return seen


def facets(traversal: Traversal, nodes: DataFrame, edges: DataFrame, semantics: DataFrame) -> DataFrame:
    """Counts of node types, relationship types and categories of a traversal."""
    kinds = nodes.join(traversal.nodes, "node_id", "left_semi").groupBy(F.col("node_type").alias("value")).agg(F.count("*").alias("row_count"))
    within = edges.join(traversal.edges, "graph_relationship_id", "left_semi").join(semantics.select("relationship_type", "category"), "relationship_type", "left")
    by = lambda c, default: within.groupBy(F.coalesce(c, F.lit(default)).alias("value")).agg(F.count("*").alias("row_count"))
    named = lambda df, facet: df.select(F.lit(facet).alias("facet"), "value", "row_count")
    return (
        named(kinds, "node_types").unionByName(named(by("relationship_type", "UNKNOWN"), "relationship_types"))
        .unionByName(named(by("category", "OTHER"), "relationship_categories"))
    )


def _touching(edges: DataFrame, node: str) -> DataFrame:
    return edges.where((F.col("source_id") == node) | (F.col("target_id") == node))


def node_summary(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """The node with its degrees and one row per direct edge; without edges one row whose edge columns are null."""
    direct = _touching(edges, node)
    row = node_view(nodes.where(F.col("node_id") == node), direct)
    alone = row.where("inbound_count = 0 and outbound_count = 0")
    # the node is one row, its edges may be many
    return direct.crossJoin(F.broadcast(row)).select(*row.columns, *[
        "graph_relationship_id", "relationship_type", F.when(F.col("source_id") == node, F.col("target_id")).otherwise(F.col("source_id")).alias("other_id"),
        F.when(F.col("source_id") == node, "outbound").otherwise("inbound").alias("direction"),
    ]).unionByName(alone, allowMissingColumns=True)


def process_story(edges: DataFrame, semantics: DataFrame, name_or_id: str) -> DataFrame:
    """Direct edges of a process counted by category."""
    node = name_or_id if name_or_id.startswith("process::") else f"process::{name_or_id}"
    joined = _touching(edges, node).join(semantics.select("relationship_type", "category"), "relationship_type", "left")
    return joined.groupBy(F.coalesce("category", F.lit("OTHER")).alias("category")).agg(F.count("*").alias("edge_count"))


def explain(nodes: DataFrame, edges: DataFrame, semantics: DataFrame, validations: DataFrame, provenance: DataFrame, edge_id: str) -> DataFrame:
    """One edge with both nodes, validation and what it was derived from, in one row."""
    only = lambda df: df.where(F.col("graph_relationship_id") == edge_id)
    edge = edge_view(only(edges), semantics, only(validations), only(provenance))
    end = lambda side: nodes.select(F.col("node_id").alias(side), F.struct(*nodes.columns).alias(f"{side}_node"))
    origins = only(provenance).groupBy(F.col("graph_relationship_id").alias("id")).agg(
        F.count("*").alias("provenance_count"), F.array_sort(F.collect_set("source_artifact")).alias("source_artifacts")
    )
    return edge.join(end("source"), "source", "left").join(end("target"), "target", "left").join(origins, "id", "left")


def path_text(paths: DataFrame, labels: DataFrame, node_id: str = "node_id", label: str = "label") -> DataFrame:
    """Readable form of each path, A -> B -> C, with its depth, last edge and cycle flag."""
    keyed = paths.withColumn("_path", F.array_join("relationship_ids", "\u001f"))
    steps = keyed.select("_path", F.col("node_ids")[0].alias("_root"), F.posexplode("node_ids").alias("pos", "node"))
    named = steps.join(labels.select(F.col(node_id).alias("node"), F.col(label).alias("text")), "node", "left")
    texts = named.groupBy("_path", "_root").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("text", "node").alias("text")))), lambda s: s["text"]), " -> ").alias("interpretation")
    )
    return keyed.withColumn("_root", F.col("node_ids")[0]).join(texts, ["_path", "_root"]).select(
        "path_id", "depth", F.element_at("relationship_ids", -1).alias("last_relationship_id"), "cycle", "interpretation"
    )
