"""Connected components of an edge table, by contraction.

Each round maps every node to the least of itself and its neighbours and
contracts the edges.  Even rounds order nodes by id, which collapses stars
around their least node at once; odd rounds order them by a hash, which
shrinks long chains by a constant share whatever their ids.  Neighbour minima
are pre-aggregated, so a hub's edges never meet in one task.  Every round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of long ids -> ``node, component`` (least id) for every
    node with an edge to another node.  Null ids and loops are ignored."""
    edges = stage(edges.select("a", "b").where("a <> b").distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    label = nodes.withColumn("now", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        order = [F.col("b")] if turn % 2 == 0 else [F.xxhash64("b", F.lit(turn)), F.col("b")]
        own = [F.col("a")] if turn % 2 == 0 else [F.xxhash64("a", F.lit(turn)), F.col("a")]
        least = both.groupBy("a").agg(F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
                                      .alias("m"))
        last = f"o{len(order) - 1}"
        step = stage(least.select("a", F.least(
            F.col("m"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(own)]))[last].alias("to")))
        ends = edges
        for end in ("a", "b"):
            ends = (ends.join(step.withColumnRenamed("a", end).withColumnRenamed("to", f"{end}_to"), end)
                    .drop(end).withColumnRenamed(f"{end}_to", end))
        edges = stage(ends.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        label = stage(label.join(step.withColumnRenamed("a", "now"), "now", "left")
                      .select("node", F.coalesce("to", "now").alias("now")))
        turn += 1
    least = label.groupBy("now").agg(F.min("node").alias("component"))
    return label.join(least, "now").select("node", "component")
