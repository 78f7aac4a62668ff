"""Ordered per-key computation that does not depend on one task holding one key.

A plain ``Window.partitionBy(key)`` puts a whole recording into one task.  Here the rows of a key
are cut into ordered segments at some of its own rows: those whose hash of key and order is 0 modulo a
quarter of ``strideframe.segment.rows``.  The cuts are values of the whole order, of any type, so outliers, infinities and
equal first columns do not matter, and segments hold about that many rows at every size of a key (few keys far
below it have a cut at all).  Windows run inside ``(key, segment)`` and a table with one row per segment of
the keys that are cut carries the values that cross a cut.  Cuts and that table have a few rows per `limit` rows of the
input, so they are broadcast, and no join deals rows by their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strideframe.session import materialise, segment_rows

OVERSPLIT = 4          # segments per `limit` rows, to soften their random lengths
RANGE_ROWS = 50_000    # a table of fewer rows a core is not dealt to all cores
LEAST_ROWS = 500       # of a range, as each is a task and a file
ID_BITS = 33           # of an id of Spark that count rows inside a partition
SEG, CUT, ALL = "_seg", "_cut", "_all"


def _count_up_to(cuts: Column, rank: Column) -> Column:
    """How many of the sorted cuts are at most `rank`, by binary search."""
    def halve(acc, _):
        mid = ((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.get(cuts, mid) <= rank
        return (F.when(acc["lo"] >= acc["hi"], acc)
                 .when(below, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi")))
                 .otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi"))))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi")), halve, lambda acc: acc["lo"])


class Ordered:
    """Rows of each key in a total order."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], limit: int | None = None):
        every = max(1, (limit or segment_rows(df.sparkSession)) // OVERSPLIT)
        self.drop = []
        if not keys:
            # Zero, but not a constant that the optimiser folds: joins on it stay joins on a key.
            df, keys = df.withColumn(ALL, F.pmod(F.hash(*order), F.lit(1))), [ALL]
            self.drop.append(ALL)
        self.keys, self.order = keys, [F.col(c) for c in order]
        self.rank = F.struct(*order)
        cuts = (df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0)
                  .groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
                  .agg(F.sort_array(F.collect_set(self.rank)).alias("_cuts")))
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        seg = F.when(F.col("_cuts").isNull(), 0).otherwise(_count_up_to(F.col("_cuts"), self.rank))
        # Broadcast, as a table of one cut per quarter of the limit is small at any size: a shuffled join would leave the
        # rows dealt by the key alone, which serves the windows below as well and puts a whole key into one task.
        self.df = (df.join(F.broadcast(cuts), on, "left").withColumn(SEG, seg.cast("bigint"))
                     .withColumn(CUT, F.col("_cuts").isNotNull()).drop("_cuts", *[f"_k{i}" for i in range(len(keys))]))
        self.drop += [SEG, CUT]
        # CUT depends on the key alone; naming it here lets a filter on it pass below the window.
        self.part = W.partitionBy(*keys, CUT, SEG)
        self.win = self.part.orderBy(*self.order)
        self.edge_win = W.partitionBy(*keys).orderBy(SEG)

    def _edges(self, aggs, finish) -> DataFrame:
        """One row per segment of the keys that are cut."""
        cut = self.df.where(F.col(CUT)).groupBy(*self.keys, SEG).agg(*aggs)
        return cut.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.col(SEG).alias("_kseg"), *finish)

    def _join(self, side: DataFrame, seg: bool = True) -> DataFrame:
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        on += [F.col(SEG) == F.col("_kseg")] if seg else []
        return self.df.join(F.broadcast(side), on, "left").drop(*[f"_k{i}" for i in range(len(self.keys))], "_kseg")

    def neighbours(self, prev: dict | None = None, following: dict | None = None) -> "Ordered":
        """Values of the row before / after each row: ``{new_name: column}``."""
        prev, following = prev or {}, following or {}
        pick_p = F.struct(*[F.col(c).alias(n) for n, c in prev.items()]) if prev else None
        pick_f = F.struct(*[F.col(c).alias(n) for n, c in following.items()]) if following else None
        aggs, finish = [], []
        if prev:
            aggs.append(F.max_by(pick_p, self.rank).alias("_seg_last"))
            finish.append(F.lag("_seg_last").over(self.edge_win).alias("_edge_prev"))
        if following:
            aggs.append(F.min_by(pick_f, self.rank).alias("_seg_first"))
            finish.append(F.lead("_seg_first").over(self.edge_win).alias("_edge_next"))
        df = self._join(self._edges(aggs, finish))
        if prev:
            df = df.withColumn("_row_prev", F.coalesce(F.lag(pick_p).over(self.win), F.col("_edge_prev")))
        if following:
            df = df.withColumn("_row_next", F.coalesce(F.lead(pick_f).over(self.win), F.col("_edge_next")))
        self.df = df.select("*", *[F.col("_row_prev")[n].alias(n) for n in prev],
                            *[F.col("_row_next")[n].alias(n) for n in following]
                            ).drop("_row_prev", "_row_next", "_edge_prev", "_edge_next")
        return self

    def running(self, sums: dict[str, Column]) -> "Ordered":
        """Inclusive running sums: ``{new_name: expression}``."""
        names = list(sums)
        frame = self.edge_win.rowsBetween(W.unboundedPreceding, -1)
        edges = self._edges([F.sum(e).alias(n) for n, e in sums.items()],
                            [F.sum(n).over(frame).alias(f"_b_{n}") for n in names])
        df = self._join(edges)
        local = self.win.rowsBetween(W.unboundedPreceding, 0)
        self.df = df.select("*", *[
            (F.coalesce(F.sum(e).over(local), F.lit(0)) + F.coalesce(F.col(f"_b_{n}"), F.lit(0))).alias(n)
            for n, e in sums.items()]).drop(*[f"_b_{n}" for n in names])
        return self

    def fill(self, forward: dict | None = None, backward: dict | None = None) -> "Ordered":
        """Last non-null value up to a row, first non-null value from a row on."""
        forward, backward = forward or {}, backward or {}
        aggs, finish = [], []
        for n, e in forward.items():
            aggs.append(F.max_by(e, F.when(e.isNotNull(), self.rank)).alias(f"_v_{n}"))
            finish.append(F.last(f"_v_{n}", ignorenulls=True).over(
                self.edge_win.rowsBetween(W.unboundedPreceding, -1)).alias(f"_b_{n}"))
        for n, e in backward.items():
            aggs.append(F.min_by(e, F.when(e.isNotNull(), self.rank)).alias(f"_v_{n}"))
            finish.append(F.first(f"_v_{n}", ignorenulls=True).over(
                self.edge_win.rowsBetween(1, W.unboundedFollowing)).alias(f"_b_{n}"))
        df = self._join(self._edges(aggs, finish))
        back = self.win.rowsBetween(W.unboundedPreceding, 0)
        ahead = self.win.rowsBetween(0, W.unboundedFollowing)
        cols = [F.coalesce(F.last(e, ignorenulls=True).over(back), F.col(f"_b_{n}")).alias(n)
                for n, e in forward.items()]
        cols += [F.coalesce(F.first(e, ignorenulls=True).over(ahead), F.col(f"_b_{n}")).alias(n)
                 for n, e in backward.items()]
        self.df = df.select("*", *cols).drop(*[f"_b_{n}" for n in [*forward, *backward]])
        return self

    def totals(self, aggs: dict[str, Column]) -> "Ordered":
        """Whole-key aggregates on every row: ``{new_name: aggregate expression}``."""
        cut = self.df.where(F.col(CUT)).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).agg(
            *[e.alias(f"_t_{n}") for n, e in aggs.items()])
        df = self._join(cut, seg=False)
        self.df = df.select("*", *[
            F.when(F.col(CUT), F.col(f"_t_{n}")).otherwise(e.over(self.part)).alias(n)
            for n, e in aggs.items()]).drop(*[f"_t_{n}" for n in aggs])
        return self

    def position(self, pos: str = "pos", count: str | None = None) -> "Ordered":
        """Zero-based position in the key and, if asked, the number of rows of the key."""
        self.running({pos: F.lit(1).cast("bigint")})
        self.df = self.df.withColumn(pos, F.col(pos) - 1)
        return self.totals({count: F.count(F.lit(1))}) if count else self

    def with_columns(self, cols: dict[str, Column]) -> "Ordered":
        self.df = self.df.withColumns(cols)
        return self

    def done(self) -> DataFrame:
        return self.df.drop(*self.drop)


def numbered(df: DataFrame, order: list[str], pos: str) -> DataFrame:
    """Rows with their zero-based position `pos` in one order of the whole table.

    Rows are dealt to ranges of the order that Spark samples, so tasks are even whatever the values are, sorted there and stored with
    ids that hold the range and the place in it; one row per range carries the rows before it.  Every use reads the stored
    rows, as ranges sampled twice may differ.  Rows that are equal in `order` share a range, and take their positions in any order.
    """
    count, parallel = df.count(), df.sparkSession.sparkContext.defaultParallelism
    ranges = max(1, -(-count // max(LEAST_ROWS, segment_rows(df.sparkSession) // OVERSPLIT)), min(parallel, count // RANGE_ROWS))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    stored = materialise(dealt.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    at = F.shiftright("_id", ID_BITS)
    edges = stored.groupBy(at.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.orderBy("_range")) - F.col("_rows")
    rows = stored.join(F.broadcast(edges.select("_range", before.alias("_before"))), at == F.col("_range"))
    return rows.withColumn(pos, F.col("_before") + F.col("_id").bitwiseAND((1 << ID_BITS) - 1)).drop("_id", "_range", "_before")


def halo(df: DataFrame, keys: list[str], pos: str, reach: int, chunk: int = 65_536):
    """Rows plus the `reach` rows on each side of every chunk of `chunk` positions, however many chunks that spans.

    Returns the frame, with `_chunk` and `_own` (false on copied rows), and the window to
    use for lag/lead up to `reach` steps; filter on `_own` afterwards.
    """
    p, home = F.col(pos), F.floor(F.col(pos) / F.lit(chunk)).cast("bigint")
    first = F.greatest(F.lit(0).cast("bigint"), F.floor((p - reach) / F.lit(chunk)).cast("bigint"))
    targets = F.sequence(first, F.floor((p + reach) / F.lit(chunk)).cast("bigint"))
    out = (df.withColumn("_chunk", F.explode(targets))
             .withColumn("_own", F.col("_chunk") == home))
    return out, W.partitionBy(*keys, "_chunk").orderBy(pos)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation percentiles without holding a key's values in one task.

    Equal values collapse to one weighted row before the ordered pass.
    """
    work = df.where(F.col(value).isNotNull())
    weights = work.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_w"))
    frame = (Ordered(weights, keys, [value])
             .running({"_hi": F.col("_w")}).totals({"_n": F.sum("_w")}).done())
    keys = keys or []
    cum, n = F.col("_hi"), F.col("_n")
    outs = []
    for name, p in probs.items():
        at = (n - 1) * F.lit(float(p))
        low = F.floor(at)
        high = F.least(low + 1, n - 1)
        first, last = cum - F.col("_w"), cum - 1
        outs.append(F.max(F.when((low >= first) & (low <= last), F.col(value))).alias(f"_l_{name}"))
        outs.append(F.max(F.when((high >= first) & (high <= last), F.col(value))).alias(f"_h_{name}"))
        outs.append(F.max(at - low).alias(f"_f_{name}"))
    agg = frame.groupBy(*keys).agg(*outs) if keys else frame.agg(*outs)
    return agg.select(*keys, *[
        (F.col(f"_l_{n}") + (F.col(f"_h_{n}") - F.col(f"_l_{n}")) * F.col(f"_f_{n}")).alias(n)
        for n in probs])
