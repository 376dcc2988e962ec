"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.llm.common import settle
from modspark.operators.joins import BROADCAST_LIMIT, sized_join


def components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``links`` (longs ``x``, ``y``); ``comp`` is one of its nodes.

    Contraction: in each round every node moves to its neighbour (or itself) of smallest hash, with a
    new hash each round, and links between what has moved together vanish.  The number of nodes
    left falls by a constant factor in expectation, also on long chains, and each round is a
    grouping that is combined inside tasks, so a node with very many links is no hot key.

    The first round takes the node itself in place of a hash: callers mostly link many nodes to a
    smallest one, and all of those move together at once.
    """
    edges = settle(links.filter("x <> y").select("x", "y").distinct())
    n = edges.count()
    nodes = edges.select(F.col("x").alias("node")).union(edges.select("y")).distinct()
    moves = []
    while n:
        turn, parts = len(moves), 1 + n // 20_000
        both = edges.union(edges.select("y", "x"))
        order = (lambda c: F.xxhash64(c, F.lit(turn))) if turn else F.col
        near = both.groupBy("x").agg(F.min(F.struct(order("y").alias("h"), "y")).alias("near"))
        own = order("x")
        moved = settle(near.select(
            F.col("x").alias("comp"), F.when(F.col("near.h") < own, F.col("near.y")).otherwise(F.col("x")).alias("to"),
        ), parts)
        small = 2 * n <= BROADCAST_LIMIT  # a link has two nodes
        moves.append((moved, small))
        first = moved.select(F.col("comp").alias("x"), F.col("to").alias("a"))
        second = moved.select(F.col("comp").alias("y"), F.col("to").alias("b"))
        edges = settle(
            sized_join(sized_join(edges, first, "x", small=small), second, "y", small=small).filter("a <> b")
            .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), parts
        )
        n = edges.count()
    at = nodes.withColumn("comp", F.col("node"))
    for moved, small in moves:
        at = sized_join(at, moved, "comp", "left", small).select("node", F.coalesce("to", "comp").alias("comp"))
    return settle(at)
