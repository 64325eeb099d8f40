"""Connected components of an edge table, by contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorspark.session import cut


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges(a, b)``; ``root`` is a node of the component.

    Each round sends every node to its smallest neighbour or itself and links what they
    were sent to.  At least half of the nodes of a component with links vanish per round,
    so rounds are logarithmic.  A node with very many links is combined in the map tasks.
    """
    edges = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        step = cut(step)
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        moved = edges.join(left, "a").join(right, "b").filter("x <> y")
        edges = cut(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not steps:
        kind = edges.schema["a"].dataType
        return edges.select(F.col("a").cast(kind).alias("node"), F.col("b").alias("root"))
    result = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        result = result.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return result
