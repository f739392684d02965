"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.tables import Stages


def components(edges: DataFrame, stages: Stages, name: str) -> DataFrame:
    """(node, root) for every node of the edges (a, b); equal roots mean connected.

    Each round points every node to its smallest neighbour and contracts the
    graph along these pointers.  Nodes are hashes, so the count of nodes falls
    by a factor in each round whatever the graph's shape.  Every round is a
    written table; only the count of remaining edges comes to the driver.
    Minima are pre-aggregated, so a node of huge degree is no hot key there.
    """
    graph = stages.write(edges.select("a", "b").where("a <> b").distinct(), f"{name}-edges-0")
    found = None
    k = 0
    while not graph.isEmpty():
        both = graph.select("a", "b").union(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stages.write(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("to")),
            f"{name}-point-{k}",
        )
        if found is None:
            mapped = point.select("node", F.col("to").alias("root"))
        else:
            mapped = (
                found.join(point.withColumnRenamed("node", "root"), "root", "left")
                .select("node", F.coalesce("to", "root").alias("root"))
            )
        at = point.select(F.col("node").alias("a"), F.col("to").alias("x"))
        bt = point.select(F.col("node").alias("b"), F.col("to").alias("y"))
        less = graph.join(at, "a").join(bt, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        found = stages.write(mapped, f"{name}-found-{k}")
        graph = stages.write(less.distinct(), f"{name}-edges-{k + 1}")
        k += 1
    if found is None:
        return graph.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
