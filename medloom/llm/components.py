"""Connected components of a link table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, store


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` has long columns u and v; returns (node, root) for every node of a link, one root per component.

    In each round every node moves to the node of least rank in its closed neighbourhood and links are mapped along.
    Ranks are hashes that change with the round, so a long chain shrinks by a constant factor a round whatever its
    numbering.  Neighbourhood minima are aggregated before the shuffle, and the joins are plain equi-joins whose large
    side adaptive execution may split, so a node with very many links is no single task's work; no side, all of which grow with
    the links, is broadcast, which would pass through the driver.  Every round is written
    to the shared folder; nothing but one count of remaining links reaches the driver.  Null ends and self-links are
    ignored.  The root is an arbitrary member: aggregate over it for the smallest one.
    """
    edges = store(links.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    moves = []
    for turn in range(max_rounds):
        if edges.isEmpty():
            break
        both = edges.union(edges.select("v", "u"))
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c).alias("r"), c.alias("n"))
        near = both.groupBy("u").agg(F.min(rank(F.col("v"))).alias("m"))
        move = store(near.select(F.col("u").alias("node"), F.least("m", rank(F.col("u")))["n"].alias("to")), "move")
        moves.append(move)
        left = edges.join(move.withColumnRenamed("node", "u").hint("merge"), "u").select(F.col("to").alias("a"), "v")
        mapped = left.join(move.withColumnRenamed("node", "v").hint("merge"), "v").select("a", F.col("to").alias("b")).where("a <> b")
        after = store(mapped.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
        drop_stored(edges)
        edges = after
    else:
        raise RuntimeError("links did not contract")
    if not moves:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    label = moves[-1].select("node", F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        later = label.select(F.col("node").alias("to"), F.col("root").alias("then"))
        label = move.join(later.hint("merge"), "to", "left").select("node", F.coalesce("then", "to").alias("root"))
    out = store(label, "roots")
    drop_stored(edges, *moves)
    return out
