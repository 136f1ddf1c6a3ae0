"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def smallest_labels(edges: DataFrame) -> DataFrame:
    """id, label: for every end of an edge (a, b), the smallest id of its component.

    Alternating star contraction.  A large-star step hangs the larger neighbours of
    each node on its smallest neighbour; a small-star step does so with the node
    itself and its smaller neighbours.  Both keep the components, and the number of
    edges never grows; after O(log^2 n) rounds, in practice a handful, every node
    hangs on the smallest of its component.  Minima are partial aggregates, so a hub
    is no hot group; a round is written out, which cuts the lineage.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc_edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "cc_large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("x"), "m").where("x <> m")
                 .unionByName(down.select(F.col("a").alias("x"), "m"))).select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()
        small = stored(small, "cc_small")
        # done when every node hangs on one root that hangs on nothing
        nodes = small.groupBy("a").agg(F.count("*").alias("n"))
        many = nodes.where("n > 1")
        chained = small.join(nodes.select(F.col("a").alias("b")), "b", "left_semi")
        edges = small
        if many.isEmpty() and chained.isEmpty():
            break
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("label", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(roots)
