"""Connected components of an edge table by alternating large and small stars, each round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.session import materialise


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Null ends are ignored. Large stars hang every larger neighbour on the smallest one, small
    stars every smaller one; both are one aggregate and one join, so a node with a third of all edges is
    split like any skewed join key. Ends when a pair of rounds changes nothing (few, for star-like groups).
    """
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi is not null and lo is not null and hi <> lo").distinct()
    e = materialise(e, "edges")
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        # Every node keeps its own smallest neighbour too, so that no node is lost.
        large = large.unionByName(least.where("m < u").select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct()
        large = materialise(large, "edges")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        small = small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
        small = materialise(small, "edges")
        # Done when all edges are stars: no smaller end is itself hung on something smaller.
        deep = small.select(F.col("lo").alias("hi")).distinct().join(small.select("hi").distinct(), "hi", "left_semi").limit(1).count()
        many = small.groupBy("hi").count().where("count > 1").limit(1).count()
        e = small
        if not deep and not many:
            break
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
