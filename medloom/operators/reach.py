"""Reachability over the verbs of a triple table: a forest with jump tables, and the edges beside it.

Each node keeps one of its edges (the smallest object); where these edges run in a circle, the circle's smallest node gives its edge
up.  What is left is a forest.  Jump table k leads 2^k edges up, so ancestors, roots and depths take as many joins as the
logarithm of the forest's depth.  All other edges are links: a round follows links once and takes whole ways up the forest.
A taxonomy is nearly a forest, so rounds are few; work is bounded by the pairs found, in any graph.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Forest(NamedTuple):
    jumps: list[DataFrame]
    """(node, to) for 1, 2, 4 ... edges up"""
    links: DataFrame
    """(s, o): edges that are not in the forest"""


def settled(df: DataFrame) -> DataFrame:
    """A round's rows, computed once: written to the checkpoint folder, which ends their lineage, or kept in memory where
    the session has none."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() or df.sparkSession.conf.get("spark.checkpoint.dir", None) else df.persist()


def edges_of(triples: DataFrame, verbs: list[str]) -> DataFrame:
    """(s, o) once; triples without a subject or with a literal are no edges, nor are loops, as every node reaches itself."""
    return triples.where(F.col("p").isin(verbs) & (F.col("s") != F.col("o"))).select("s", "o").distinct()


def _doubled(jump: DataFrame) -> DataFrame:
    further = jump.select(F.col("node").alias("to"), F.col("to").alias("then"), F.col("low").alias("lower"))
    return settled(jump.join(further, "to").select("node", F.col("then").alias("to"), F.least("low", "lower").alias("low")))


def _jumps(first: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Jump tables, or the nodes that end all circles.  ``low`` is the smallest node of those passed, so a node that is its
    own is the smallest of a circle.  All nodes of a circle are left in each table, so a jump of as many edges as there are
    rows has gone round every circle."""
    tables, looked = [first], False
    while True:
        last = _doubled(tables[-1])
        n = last.count()
        if n == 0:
            return tables, None
        tables.append(last)
        if not looked and n <= 1 << (len(tables) - 1):
            looked = True
            cut = last.where(F.col("node") == F.col("low")).select("node")
            if not cut.isEmpty():
                return tables, cut


def forest(edges: DataFrame) -> Forest:
    """``edges`` (s, o) without repeats, loops and nulls."""
    edges = settled(edges)
    first = settled(edges.groupBy(F.col("s").alias("node")).agg(F.min("o").alias("to")).withColumn("low", F.col("to")))
    jumps, cut = _jumps(first)
    if cut is not None:
        first = settled(first.join(cut, "node", "left_anti"))
        jumps, _ = _jumps(first)
    links = settled(edges.join(first.select(F.col("node").alias("s"), F.col("to").alias("o")), ["s", "o"], "left_anti"))
    return Forest([j.select("node", "to") for j in jumps], links)


def _upwards(pairs: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(start, node) and all ancestors of the nodes: with table k, those less than 2^k edges away give those less than
    2^(k+1) away, so each pair is found once from each node it starts at."""
    for jump in jumps:
        pairs = pairs.join(jump, "node", "left").select("start", F.explode(F.array_compact(F.array("node", "to"))).alias("node"))
    return pairs


def _grown(graph: Forest, starts: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(start, node) reached from the starts; with ``wanted`` pairs (start, node), starts that have reached all of theirs
    are not followed further."""
    found = frontier = settled(_upwards(starts.select("start", F.col("start").alias("node")).where("start is not null").distinct(), graph.jumps))
    if graph.links.isEmpty():
        return found
    while True:
        if wanted is not None:
            wanted = settled(wanted.join(frontier, ["start", "node"], "left_anti"))
            frontier = frontier.join(wanted.select("start").distinct(), "start", "left_semi")
        beside = frontier.join(graph.links, F.col("node") == F.col("s")).select("start", F.col("o").alias("node")).distinct()
        heads = beside.join(found, ["start", "node"], "left_anti")
        frontier = settled(_upwards(heads, graph.jumps).distinct().join(found, ["start", "node"], "left_anti"))
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier)


def closure(triples: DataFrame, verbs: list[str], starts: DataFrame) -> DataFrame:
    """(start, node) once for all nodes reachable from each start over the verbs, the start included; circles end it, null
    starts reach nothing."""
    return _grown(forest(edges_of(triples, verbs)), starts)


def labels(graph: Forest, nodes: DataFrame) -> DataFrame:
    """(node, root, depth) of nodes in the forest; a node without edges is its own root."""
    out = nodes.select("node", F.col("node").alias("root"), F.lit(0).cast("bigint").alias("depth"))
    for k, jump in reversed(list(enumerate(graph.jumps))):
        up = jump.select(F.col("node").alias("root"), "to")
        out = out.join(up, "root", "left").select("node", F.coalesce("to", "root").alias("root"), (F.col("depth") + F.when(F.col("to").isNotNull(), 1 << k).otherwise(0)).alias("depth"))
    return out


def is_related(triples: DataFrame, verbs: list[str], pairs: DataFrame) -> DataFrame:
    """Pairs (source, target), repeats kept: whether the target is reached; every node reaches itself, and a pair with a null
    has null.

    In the forest, the target is an ancestor if the roots are equal and the source, lifted by the difference of depths, is
    the target.  Only pairs that are not are looked for beside it, as far as their sources lead.
    """
    graph = forest(edges_of(triples, verbs))
    once = pairs.select("source", "target").where("source is not null and target is not null").distinct()
    places = settled(labels(graph, once.select(F.explode(F.array("source", "target")).alias("node")).distinct()))
    of = lambda c, to: places.select(F.col("node").alias(c), F.col("root").alias(f"{to}_root"), F.col("depth").alias(f"{to}_depth"))
    placed = once.join(of("source", "a"), "source").join(of("target", "b"), "target")
    lifted = placed.select("source", "target", F.col("source").alias("at"), F.when(F.col("a_root") == F.col("b_root"), F.col("a_depth") - F.col("b_depth")).otherwise(-1).alias("far"))
    for k, jump in enumerate(graph.jumps):
        step = (F.col("at") == F.col("node")) & (F.col("far") >= 0) & (F.shiftright("far", k).bitwiseAND(1) == 1)
        lifted = lifted.join(jump, step, "left").select("source", "target", F.coalesce("to", "at").alias("at"), "far")
    related = settled(lifted.select("source", "target", ((F.col("far") >= 0) & (F.col("at") == F.col("target"))).alias("related")))
    if not graph.links.isEmpty():
        left = related.where(~F.col("related")).select(F.col("source").alias("start"), F.col("target").alias("node"))
        reached = _grown(graph, left.select("start"), left).select(F.col("start").alias("source"), F.col("node").alias("target"), F.lit(True).alias("beside"))
        related = related.join(reached, ["source", "target"], "left").select("source", "target", (F.col("related") | F.coalesce("beside", F.lit(False))).alias("related"))
    return pairs.select("source", "target").join(related, ["source", "target"], "left")
