"""Point-in-interval work without pairing every row of a key with every other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.plans.ordered import Ordered


FAN = 64


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], *,
                        point: str, start: str, stop: str, width: int, how: str = "inner") -> DataFrame:
    """Pairs with ``start < point < stop``; both sides meet on (keys, level, bin). A left join keeps points in no interval.

    An interval lies in the bins of one level, whose width grows by FAN a level, so it is in FAN + 1 bins at most however long it
    is; a point is in one bin of each level that has intervals.
    """
    size = F.greatest(F.col(stop) - F.col(start), F.lit(0)).cast("double") / width
    level = F.greatest(F.lit(0), F.ceil(F.log(float(FAN), F.greatest(size, F.lit(1.0)))) - 1).cast("int")
    leveled = intervals.withColumn("_level", level).where("_level is not null")
    # A level is a power of FAN, so one short array says which there are.
    levels = leveled.agg(F.collect_set("_level").alias("_levels")).withColumn("_one", F.lit(1))
    wide = F.lit(width) * F.pow(F.lit(FAN), F.col("_level")).cast("bigint")
    lo, hi = F.floor(F.col(start) / wide), F.floor(F.col(stop) / wide)
    cut = leveled.withColumn("_bin", F.explode(F.sequence(lo, F.greatest(lo, hi))))
    marked = points.withColumn("_one", F.lit(1)).join(F.broadcast(levels), "_one").withColumn("_level", F.explode("_levels")).drop("_one", "_levels")
    marked = marked.withColumn("_bin", F.floor(F.col(point) / wide))
    names = [*keys, "_level", "_bin"]
    other = cut.withColumnsRenamed({k: f"_r_{k}" for k in names})
    on = [marked[k] == F.col(f"_r_{k}") for k in names] + [F.col(point) > F.col(start), F.col(point) < F.col(stop)]
    pairs = marked.join(other, on).drop("_level", "_bin", *[f"_r_{k}" for k in names])
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError("inner or left")
    met = pairs.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(points.columns)]).distinct()
    alone = points.join(met, [F.col(c).eqNullSafe(F.col(f"_m{i}")) for i, c in enumerate(points.columns)], "left_anti")
    return pairs.unionByName(alone.select(*points.columns, *[F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in pairs.columns if c not in points.columns]))


def containing_counts(points: DataFrame, intervals: DataFrame, keys: list[str], *,
                      point: str, start: str, stop: str) -> DataFrame:
    """Number of intervals with ``start < point < stop`` for each point, by one sweep.

    An interval opens just after `start` and closes at `stop`, so a running sum over
    closes, points, opens (in that order at equal positions) counts the open ones.
    """
    intervals = intervals.where(F.col(start) < F.col(stop))          # an empty one holds nothing
    cols = points.columns
    blank = [F.lit(None).cast(points.schema[c].dataType).alias(c) for c in cols if c not in keys]
    keyc = [F.col(k) for k in keys]
    probe = points.select(*cols, F.col(point).alias("_at"), F.lit(1).alias("_step"), F.lit(0).alias("_d"))
    opens = intervals.select(*keyc, *blank, F.col(start).alias("_at"), F.lit(2).alias("_step"), F.lit(1).alias("_d"))
    closes = intervals.select(*keyc, *blank, F.col(stop).alias("_at"), F.lit(0).alias("_step"), F.lit(-1).alias("_d"))
    marks = probe.unionByName(opens).unionByName(closes)
    swept = Ordered(marks, keys, ["_at", "_step"]).running({"n_containing": F.col("_d")}).done()
    return swept.where(F.col("_step") == 1).drop("_at", "_step", "_d")
