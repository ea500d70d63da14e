"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.storage import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (equal for all nodes of a component) of edges ``a``, ``b`` of longs.

    Every round maps each node to the least of itself and its neighbours and moves the edges
    along; what is left has a fraction of the nodes.  Nodes go through a 64-bit bijection
    (xxhash64 of a long) first, so that chains in order of their names contract as fast.
    Each round's tables are written out; joins on a node of very many edges are left
    to adaptive skew splitting, since both sides come straight from a table.
    """
    edges = materialize(edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"), F.col("a").alias("x"), F.col("b").alias("y")), "edges")
    names = edges.select(F.col("a").alias("name"), F.col("x").alias("node")).union(edges.select("b", "y")).distinct()
    names = materialize(names, "nodes")
    left = edges.select("a", "b").where("a <> b").distinct()
    labels = names.withColumn("root", F.col("name"))
    while True:
        left = materialize(left, "edges")
        if left.isEmpty():
            return labels.select("node", "root")
        both = left.union(left.select("b", "a"))
        parent = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("u"), F.least("a", "least").alias("p")), "parents")
        labels = labels.join(parent, labels["root"] == parent["u"], "left").select("name", "node", F.coalesce("p", "root").alias("root"))
        labels = materialize(labels, "labels")
        left = left.join(parent, F.col("a") == F.col("u")).select(F.col("p").alias("a"), "b")
        left = left.join(parent, F.col("b") == F.col("u")).select("a", F.col("p").alias("b")).where("a <> b").distinct()
