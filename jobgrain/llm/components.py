"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of (a, b) edges; the component is named by its
    smallest node.

    Each round every node takes the smallest name next to it, or its own, and the edges are
    drawn again between the names, without loops and repeats. What is left shrinks from
    round to round (a star is done in one, and of a chain few names stay), and ends when no
    edge is left. The rounds' names are then put together, last to first. A round is joins
    and a grouped minimum over written tables; only the number of edges left, or whether
    any is, reaches the driver. A node with very many edges is one row of a grouped minimum
    before the joins, whose right sides have a row per node.
    """
    left = edges.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    left = written(left.distinct(), "edges")
    rounds = []
    while True:
        both = left.union(left.select("b", "a"))
        names = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("name")
        )
        names = written(names, "names")
        rounds.append(names)
        of_a = names.select(F.col("node").alias("a"), F.col("name").alias("x"))
        of_b = names.select(F.col("node").alias("b"), F.col("name").alias("y"))
        left = left.join(of_a, "a").join(of_b, "b").filter("x <> y")
        left = left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        left = written(left.distinct(), "edges")
        if not left.limit(1).count():
            break
    found = rounds.pop()
    while rounds:
        later = found.select(F.col("node").alias("name"), F.col("name").alias("last"))
        found = rounds.pop().join(later, "name", "left").select(
            "node", F.coalesce("last", "name").alias("name")
        )
        found = written(found, "names")
    return found.withColumnRenamed("name", "component")
