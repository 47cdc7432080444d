"""Connected components of an edge table, by contraction.

In each round every node picks, of itself and its neighbours, the one with the
least hash of that round; nodes that pick the same one become it. The expected
number of nodes falls by a constant factor a round. Only minima are kept of a
node's neighbours, so a hub is aggregated before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terrafold.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for nodes on edges (a, b); the component is its least node.

    Edges in either direction, repeated ones and loops are fine.
    """
    edges = checkpointed(edges.select("a", "b").where("a != b").distinct())
    names = checkpointed(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("now"))
    )
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c, t=turn: F.xxhash64(F.lit(t), F.col(c))
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pick = both.groupBy(F.col("a").alias("old")).agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("n"))).alias("near"))
        own = F.struct(rank("old").alias("r"), F.col("old").alias("n"))
        pick = checkpointed(pick.select("old", F.least("near", own)["n"].alias("new")))
        names = checkpointed(
            names.join(pick, F.col("now") == F.col("old"), "left").select("node", F.coalesce("new", "now").alias("now"))
        )
        left = edges.join(pick, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
        edges = left.join(pick, F.col("b") == F.col("old")).select("a", F.col("new").alias("b"))
        edges = checkpointed(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    least = names.groupBy(F.col("now").alias("of")).agg(F.min("node").alias("component"))
    return names.join(least, F.col("now") == F.col("of")).select("node", "component")
