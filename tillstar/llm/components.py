"""Connected components by repeated contraction, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.storage import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b: long); comp is the smallest node of the component.

    Each round maps a node to the smallest of itself and its neighbours and contracts the
    edges by that mapping, until none is left. Nodes are compared by ``xxhash64``, which
    is one-to-one on longs: a random order, in which also long chains shrink by a constant
    factor a round. Only grouped minima and equi-joins are used, so a node with very many
    links is pre-aggregated, or split by the skew join. Empty input: empty result.
    """
    left = edges.select(F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v")).filter("u <> v")
    nodes = (edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
             .select("node", F.xxhash64("node").alias("at")))
    while True:
        both = left.union(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = materialise(both.groupBy("u").agg(F.min("v").alias("v"))
                           .select(F.col("u").alias("at"), F.least("u", "v").alias("to")), "cc-step", narrow=True)
        nodes = (nodes.join(step, "at", "left")
                 .select("node", F.coalesce("to", "at").alias("at")))
        to_u = step.select(F.col("at").alias("u"), F.col("to").alias("pu"))
        to_v = step.select(F.col("at").alias("v"), F.col("to").alias("pv"))
        left = materialise(left.join(to_u, "u").join(to_v, "v").filter("pu <> pv")
                           .select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "cc-edges", narrow=True)
        if left.isEmpty():
            break
    nodes = materialise(nodes, "cc-nodes", narrow=True)
    smallest = nodes.groupBy("at").agg(F.min("node").alias("comp"))
    return nodes.join(smallest, "at").select("node", "comp")
