"""Connected components of a graph that lives in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakework.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is a node of its component.

    Contraction: every node moves to its smallest neighbour (or stays), and the
    edges with it, until none is left; the moves are then followed from the
    first to the last.  Each round at least halves the nodes that still have
    edges.  Minima are summed up before the shuffle, and both sides of every
    join come from written tables, so a node with very many edges is split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    moves: list[DataFrame] = []
    left = materialize(both.distinct(), "edges")
    while not left.isEmpty():
        move = materialize(left.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "moves")
        moves.append(move)
        first, second = move.toDF("a", "a2"), move.toDF("b", "b2")
        # Edges of stars around their smallest node are gone after this filter.
        left = materialize(left.join(first, "a").join(second, "b").filter("a2 <> b2").select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "edges")
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = moves[0].toDF("node", "label")
    for move in moves[1:]:
        out = out.join(move.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return materialize(out, "components")
