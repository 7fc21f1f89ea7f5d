"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store


#: Edges that one task of a step handles (a few MB), and the fewest tasks.
EDGES_PER_TASK, SMALLEST_WIDTH = 500_000, 12


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is the smallest node of its component.

    Every round turns the edges into stars around smaller nodes.  The rows per
    round stay about the number of edges, nothing is collected, and each round
    is a stored table.  Self-loops, repeated edges and rows with a null end are
    allowed; a node that has only such edges is left out.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = store(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    width = max(SMALLEST_WIDTH, -(-e.count() // EDGES_PER_TASK))  # edges never grow from here on
    for _ in range(max_rounds):
        # Large star: every larger neighbour of a node goes to the node's smallest neighbour.  The minima are
        # stored, so that the join meets them as a plain table and can split the edges of a hub over tasks.
        low = store(e.groupBy("u").agg(F.min("v").alias("m")).coalesce(width), "cc-low")
        hop = e.join(low.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moves"))
        state = hop.agg(F.count("*").alias("edges"), F.count_if("moves").alias("moves")).first()
        if not state["moves"] and state["edges"] == low.count():
            break  # every node has one smaller neighbour, and that has none
        # Small star: the smaller neighbours of a node and the node go to the smallest of them.
        large = hop.select("u", "v").where("u <> v").distinct().coalesce(width)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = store(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().coalesce(width), "cc")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
