"""Connected components by contraction, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.store import kept


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) of every node with an edge.

    In each round every node moves to the neighbour, or itself, whose hash is least, and
    edges are drawn between where their ends moved.  Ends of an edge stay connected, so
    that components survive while nodes get fewer by a constant factor; hubs are minima of
    partial minima, and no node's neighbours are gathered.  Null ends are no edges.
    """
    moves = []
    live = kept(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges"
    )
    while not live.isEmpty():
        ends = live.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            live.select(F.col("b"), F.col("a"))
        )
        best = ends.groupBy("node").agg(
            F.min(F.struct(F.xxhash64("other").alias("rank"), F.col("other").alias("to"))).alias("best")
        )
        own = F.struct(F.xxhash64("node").alias("rank"), F.col("node").alias("to"))
        move = kept(best.select("node", F.least("best", own)["to"].alias("to")), "moves")
        moves.append(move)
        live = kept(
            live.join(move.withColumnsRenamed({"node": "a", "to": "to_a"}), "a")
            .join(move.withColumnsRenamed({"node": "b", "to": "to_b"}), "b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .filter("a <> b")
            .distinct(),
            "edges",
        )
    if not moves:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    label = moves[-1]
    for move in reversed(moves[:-1]):
        later = label.select(F.col("node").alias("to"), F.col("to").alias("then"))
        label = move.join(later, "to", "left").select(
            "node", F.coalesce("then", "to").alias("to")
        )
    label = kept(label, "labels")
    least = label.groupBy("to").agg(F.min("node").alias("component"))
    return label.join(least, "to").select("node", "component")
