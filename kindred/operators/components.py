"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.sources.staging import cut

# Rounds whose maps are applied to the nodes before the result is written.
ROUNDS_PER_CUT = 4


def components(nodes: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``(pid, component)``: the least node of each node's component.

    Without ``nodes``, of the nodes that an edge links with another one.

    Each round gives the nodes a fresh hashed priority, maps every node that
    still has edges to its first neighbour in that order, or to itself where it
    comes first, follows the map once more, and replaces the edges by edges
    between mapped nodes.  A constant share of the nodes with edges vanishes per
    round whatever the order of the ids.  Edges are made distinct each round,
    which also dissolves hubs.  The round is a column, not a literal, so that all
    rounds share their compiled code.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = cut(both.where(F.col("a") != F.col("b")).distinct().withColumn("turn", F.lit(1)))
    if nodes is None:
        nodes = live.select(F.col("a").alias("pid")).distinct()
    labels = nodes.select("pid", F.col("pid").alias("component"))
    turn = 0
    while not live.isEmpty():
        turn += 1
        ranked = live.select("a", "b", F.xxhash64("a", "turn").alias("own"), F.xxhash64("b", "turn").alias("p"))
        first = ranked.groupBy("a", "own").agg(F.min("p").alias("p"), F.min_by("b", "p").alias("b"))
        hop = first.select("a", F.when(F.col("p") < F.col("own"), F.col("b")).otherwise(F.col("a")).alias("to"))
        onward = hop.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = cut(hop.join(onward, "to").select("a", F.col("further").alias("to")))
        labels = labels.join(step.withColumnRenamed("a", "component"), "component", "left").select(
            "pid", F.coalesce("to", "component").alias("component")
        )
        if turn % ROUNDS_PER_CUT == 0:
            labels = cut(labels)
        live = cut(
            live.join(step, "a")
            .join(step.select(F.col("a").alias("b"), F.col("to").alias("to_b")), "b")
            .select(F.col("to").alias("a"), F.col("to_b").alias("b"), (F.col("turn") + 1).alias("turn"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
    if turn == 0:
        return labels
    labels = cut(labels)
    least = labels.groupBy("component").agg(F.min("pid").alias("_least"))
    return labels.join(least, "component").select("pid", F.col("_least").alias("component"))
