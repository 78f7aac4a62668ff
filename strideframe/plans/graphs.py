"""Cycles of large directed graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.session import materialise


def _dealt(df: DataFrame) -> DataFrame:
    """A side of a join in a loop, both sides dealt by key: a broadcast would pass it through the driver in every round."""
    return df.hint("merge")


def _trimmed(e: DataFrame) -> DataFrame:
    """Edges whose start is entered and whose end is left, again and again: what is peeled off lies on no cycle."""
    before = e.count()
    while before:
        inner = (e.join(_dealt(e.select(F.col("b").alias("a")).distinct()), "a", "left_semi")
                  .join(_dealt(e.select(F.col("a").alias("b")).distinct()), "b", "left_semi").select("a", "b"))
        e = materialise(inner, "trimmed")
        after = e.count()
        if after == before:
            break
        before = after
    return e


def _coloured(e: DataFrame) -> DataFrame:
    """(v, c): the largest node from which each node of the graph can be reached, itself included."""
    nodes = e.select(F.col("a").alias("v")).union(e.select(F.col("b").alias("v"))).distinct()
    state = materialise(nodes.select("v", F.col("v").alias("c"), F.lit(True).alias("moved")), "colours")
    while not state.where("moved").isEmpty():
        # Only nodes whose colour has changed pass it on.
        sent = e.join(_dealt(state.where("moved").select(F.col("v").alias("a"), "c")), "a").groupBy(F.col("b").alias("v")).agg(F.max("c").alias("n"))
        moved = F.coalesce(F.col("n") > F.col("c"), F.lit(False))
        state = materialise(state.drop("moved").join(_dealt(sent), "v", "left").select("v", F.when(moved, F.col("n")).otherwise(F.col("c")).alias("c"), moved.alias("moved")), "colours")
    return state.select("v", "c")


def cycle_groups(edges: DataFrame, *, source: str, target: str) -> DataFrame:
    """(node, component, size) of the nodes that lie on a cycle; the component is its smallest node.

    Edges that lie on no cycle are peeled from the ends first. On the rest, the largest node that reaches a node is its
    colour; who reaches the node that gave a colour, inside that colour, is one strongly connected component. Components are
    taken out and the rest is coloured again. No pair of nodes is ever listed: every table holds at most a row per
    edge or node, and each step is written out. Null ends are ignored; repeated edges count once; a node with an edge to itself is
    a cycle of its own.
    """
    e = edges.select(F.col(source).alias("a"), F.col(target).alias("b")).where("a is not null and b is not null").distinct()
    loops = materialise(e.where("a = b").select(F.col("a").alias("node")), "loops")
    rest, parts = materialise(e.where("a <> b"), "edges"), []
    while True:
        rest = _trimmed(rest)
        if rest.isEmpty():
            break
        colours = _coloured(rest)
        own = rest.join(_dealt(colours.withColumnsRenamed({"v": "a", "c": "ca"})), "a").join(_dealt(colours.withColumnsRenamed({"v": "b", "c": "cb"})), "b").where("ca = cb").select("a", "b")
        own = materialise(own, "own")
        reach = materialise(colours.where("v = c").select("v", "c", F.lit(True).alias("new")), "reach")
        while not reach.where("new").isEmpty():
            met = own.join(_dealt(reach.where("new").select(F.col("v").alias("b"), "c")), "b").select(F.col("a").alias("v"), "c").distinct()
            more = met.join(_dealt(reach.select("v", "c")), ["v", "c"], "left_anti").withColumn("new", F.lit(True))
            reach = materialise(reach.withColumn("new", F.lit(False)).unionByName(more), "reach")
        reach = reach.select("v", "c")
        parts.append(reach)
        gone = reach.select("v").distinct()
        rest = materialise(rest.join(_dealt(gone.withColumnRenamed("v", "a")), "a", "left_anti").join(_dealt(gone.withColumnRenamed("v", "b")), "b", "left_anti").select("a", "b"), "edges")
    found = loops.select(F.col("node").alias("v"), F.col("node").alias("c")).limit(0)
    for p in parts:
        found = found.unionByName(p)
    named = found.groupBy("c").agg(F.min("v").alias("component"), F.count("*").alias("size")).where("size > 1")
    large = materialise(found.join(named, "c").select(F.col("v").alias("node"), "component", "size"), "cycles")
    alone = loops.join(large, "node", "left_anti").select("node", F.col("node").alias("component"), F.lit(1).cast("long").alias("size"))
    return large.unionByName(alone)
