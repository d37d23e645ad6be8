"""Connected components by contraction: every step halves what is left, or more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predial.llm.support import keep


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component's smallest node.

    A step sends each node to its smallest neighbour, if that is smaller, and then joins
    the ends of the edges to where they went; edges inside one node vanish. The steps are
    stored, and composed once at the end. Sums and joins only: a node with very many edges
    is summed up in every task before the shuffle, and its join can be split at run time.
    """
    left = keep(edges.filter("a <> b").selectExpr("a", "b").distinct(), "edges")
    nodes = left.select("a").union(left.select("b")).distinct()
    nodes = nodes.select(F.col("a").alias("node"), F.col("a").alias("component"))
    steps = []
    while not left.isEmpty():
        both = left.union(left.selectExpr("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("to")).filter("to < a")
        step = keep(step.withColumnRenamed("a", "at"), "step")
        steps.append(step)
        for end in ("a", "b"):
            left = left.join(step, left[end] == step["at"], "left").withColumn(
                end, F.coalesce("to", end)
            ).select("a", "b")
        left = keep(left.filter("a <> b").distinct(), "edges")
    for step in steps:
        nodes = nodes.join(step, nodes["component"] == step["at"], "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return keep(nodes, "components")
