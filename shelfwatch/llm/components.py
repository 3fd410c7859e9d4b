"""Connected components by contraction: rounds of grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; all nodes of a component share one root.

    Each round maps every node to the neighbour, or itself, that comes first in a random order,
    and rewrites the edges; nodes that lose all edges are settled. Rounds grow with the logarithm
    of the longest chain. A node with very many edges is only met by a combining minimum and as
    the repeated side of a join whose other side has it once. Tables are written between rounds.
    """
    links = materialise(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    members = materialise(nodes.withColumn("root", F.col("node")))
    turn = 0
    while not links.isEmpty():

        def rank(node: str, turn: int = turn) -> Column:
            # the order holds for two rounds: a star needs them to settle on one centre
            return F.struct(F.xxhash64(node, F.lit(turn // 2)).alias("rank"), F.col(node).alias("node"))

        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(rank("b")).alias("other"))
        step = first.select(F.col("a").alias("from"), F.least(rank("a"), F.col("other"))["node"].alias("to"))
        step = materialise(step)
        moved = (
            links.join(step, F.col("a") == F.col("from")).select(F.col("to").alias("a"), "b")
            .join(step, F.col("b") == F.col("from")).select("a", F.col("to").alias("b"))
        )
        links = materialise(moved.where("a <> b").distinct())
        members = materialise(
            members.join(step, F.col("root") == F.col("from"), "left")
            .select("node", F.coalesce("to", "root").alias("root"))
        )
        turn += 1
    return members
