"""Mixing sources to target weights through a tree of levels, by whole-number budgets.

The budget of the root goes down the levels. A node gives its children shares by weight, but no child
more than its subtree can supply (its tokens times `epochs`); what a child can not take goes to its siblings
by their weights, and only what all of them can not take is left to the node's own siblings,
because a node's supply is the sum of its children's. Shares are exact: they are cut from running sums of
whole numbers, so the children of a node add up to its budget.

A leaf reads its documents in epochs. Whole epochs take every document; the last one takes a prefix of the
tokens in the order of md5(seed:epoch:key), where the last document may be taken in part. Running sums are
taken in hash ranges of a leaf and then over the ranges, so no task holds a leaf.

Results for special inputs: null level values are the child named ''; null or wordless texts have no tokens and are never taken; children
without a listed weight weigh 1; children of weight 0 take only what is left when all others are full; repeated rows and null
keys are documents of their own; an empty table gives no row; a budget above the supply takes everything; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.session import materialise

WORD = r"[^ \t\n\x0B\f\r]+"
RANGE_DIGITS = 4            # hex digits of the hash that name a range: 65,536 ranges a leaf


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _whole(x) -> Column:
    return F.col(x).cast("decimal(38,0)") if isinstance(x, str) else x.cast("decimal(38,0)")


def shares(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """`budget` of every child from `total` (the parent's budget), its `weight` and `supply`.

    Children are filled from the smallest supply a weight on. A child is full when its fair part of what is left is
    at least its supply; the first that is not full sets the level for the rest.
    """
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy(ratio, F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    c = children.withColumn("left", F.col("total") - F.coalesce(F.sum("supply").over(before), F.lit(0)))
    c = c.withColumn("mass", F.sum("weight").over(rest))
    c = c.withColumn("full", (F.col("left") >= F.col("supply")) & ((_whole("supply") * _whole("mass") <= _whole("weight") * _whole("left"))))
    # From the first child that is not full on, the level stays that child's.
    c = c.withColumn("at", F.min(F.when(~F.col("full"), F.struct(ratio.alias("r"), F.col(name).alias("n"), "left", "mass"))).over(Window.partitionBy(*parent)))
    c = c.withColumn("open", F.col("at").isNotNull() & (F.struct(ratio.alias("r"), F.col(name).alias("n")) >= F.struct(F.col("at.r"), F.col("at.n"))))
    upto = F.sum(F.when(F.col("open"), F.col("weight")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    part = F.when(F.col("at.mass") > 0, F.expr("cast((cast(at.left as decimal(38,0)) * cast(upto as decimal(38,0))) div cast(at.mass as decimal(38,0)) as bigint)"
                                               " - cast((cast(at.left as decimal(38,0)) * cast(upto - weight as decimal(38,0))) div cast(at.mass as decimal(38,0)) as bigint)"))
    idle = F.greatest(F.least("left", "supply"), F.lit(0).cast("long"))
    return c.withColumn("upto", upto).withColumn("budget", F.when(~F.col("open"), F.col("supply")).otherwise(F.coalesce(part, idle))).drop(
        "left", "mass", "full", "at", "open", "upto")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[dict], share: tuple[int, int], epochs: int) -> DataFrame:
    """(levels, tokens, budget) of every leaf from its `tokens`; the root's budget is share[0]/share[1] of all tokens."""
    known = None
    for k, level in enumerate(levels):
        path = levels[:k + 1]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * epochs).alias("supply"))
        weight = F.lit(1)
        for value, w in sorted(weights[k].items()):
            weight = F.when(F.col(level) == value, w).otherwise(weight)
        nodes = nodes.withColumn("weight", weight.cast("long"))
        if k == 0:
            supply = F.sum("supply").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("most", supply).withColumn("total", F.least(F.expr(f"most div {epochs} * {share[0]} div {share[1]}"), F.col("most"))).drop("most")
        else:
            nodes = nodes.join(known.select(*levels[:k], F.col("budget").alias("total")), levels[:k])
        known = shares(nodes, levels[:k] or [F.lit(0)], level)
    return leaves.join(known.select(*levels, "budget"), levels)


def choose(docs: DataFrame, key: str, levels: list[str], weights: list[dict], share: tuple[int, int], epochs: int, seed: int, tokens: str = "n_tokens") -> DataFrame:
    """(key, levels, epoch, n_tokens, n_taken): what is taken of each document in each epoch; `tokens` is a column of counts."""
    rows = docs.select(key, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels], F.col(tokens).alias("n_tokens")).where("n_tokens > 0")
    rows = materialise(rows, "counted")                 # texts are read once
    leaves = materialise(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = leaf_budgets(leaves, levels, weights, share, epochs).select(
        *levels, F.expr("budget div tokens").alias("whole"), (F.col("budget") % F.col("tokens")).alias("rest"))
    joined = rows.join(plan, levels)
    whole = joined.where("whole > 0").select(key, *levels, F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch"), "n_tokens", F.col("n_tokens").alias("n_taken"))
    hash_ = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    part = joined.where("rest > 0").withColumn("h", hash_).withColumn("range", F.substring("h", 1, RANGE_DIGITS))
    # Dealt by range too; the join with the plan would leave a whole leaf in one task.
    part = part.repartition(*levels, "range")
    sums = part.groupBy(*levels, "range").agg(F.sum("n_tokens").alias("m"))
    base = sums.select(*levels, "range", F.coalesce(F.sum("m").over(Window.partitionBy(*levels).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = Window.partitionBy(*levels, "range").orderBy("h", key, "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = part.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(base, [*levels, "range"])
    taken = F.least(F.col("n_tokens"), F.col("rest") - F.col("base") - F.col("inner"))
    last = placed.where(taken > 0).select(key, *levels, F.col("whole").alias("epoch"), "n_tokens", taken.alias("n_taken"))
    return whole.unionByName(last)
