"""Greedy size-bounded packing in a fixed order, without one task per dataset.

The greedy rule is sequential: a shard closes when the next record would exceed the
target.  But where a shard that starts at record i ends is a local question, because it
only looks at the next `target` bytes.  So:

1. running body bytes place every record in a byte bucket of one target length;
2. groups of buckets find the end of a shard for every possible start, and follow the
   starts to the first one after the group;
3. only the possible entries of each group are chained in order to find the real ones;
4. each group walks from its real entry and marks the shard starts.

The result equals the sequential fold exactly; a blob shared inside a shard counts once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.plans.ordered import Ordered
from strideframe.session import materialise

ROWS_PER_TASK = 200_000


def shard_ends(body, blobs, target, own):
    """For each of the first `own` records: index after the last record of a shard starting there."""
    end = np.empty(own, dtype=np.int64)
    held: dict[str, int] = {}
    total, stop, count = 0, 0, len(body)

    def new_bytes(i):
        return int(body[i]) + sum(size for sha, size in blobs[i].items() if sha not in held)

    def add(i):
        nonlocal total, stop
        total += new_bytes(i)
        for sha in blobs[i]:
            held[sha] = held.get(sha, 0) + 1
        stop = i + 1

    for i in range(own):
        if stop <= i:
            add(i)
        while stop < count and total + new_bytes(stop) <= target:
            add(stop)
        end[i] = stop
        total -= int(body[i])
        for sha, size in blobs[i].items():
            held[sha] -= 1
            if not held[sha]:
                del held[sha]
                total -= size
    return end


def greedy_shards(df: DataFrame, *, keys: list[str], order: list[str], body: str, blobs: str | None = None,
                  max_bytes: int, fill: float = 0.85, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add `shard`, the 1-based ordinal of the shard of each record in its dataset."""
    target = int(max_bytes * fill)
    spark = df.sparkSession
    placed = (Ordered(df, keys, order).running({"_end": F.col(body)}).position("_pos").done())
    before = F.col("_end") - F.col(body)
    blob_col = F.col(blobs) if blobs else F.expr("cast(array() as array<struct<sha256:string,size:bigint>>)")
    narrow = materialise(placed.select(
        *keys, *order, "_pos", F.col(body).cast("bigint").alias("_body"), blob_col.alias("_blobs"),
        F.floor(before / target).alias("_bucket")), "packing")
    # The fullest bucket, not the mean record, bounds a group; a bucket holds no more records than a shard does.
    fullest = narrow.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    per_group = max(1, rows_per_task // fullest)
    key_schema = ", ".join(f"`{k}` {narrow.schema[k].dataType.simpleString()}" for k in keys)

    group = F.floor(F.col("_bucket") / per_group)
    homes = F.array_compact(F.array(group, F.when((F.col("_bucket") % per_group == 0) & (group > 0), group - 1)))
    spread = narrow.withColumn("_group", F.explode(homes)).withColumn("_own", F.col("_group") == group)

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        own = int(pdf["_own"].sum())
        if not own:
            return pdf[[*keys]].head(0).assign(_group=0, _pos=0, _next=0, _exit=0, _run=-1)
        held = [{b["sha256"]: int(b["size"]) for b in row} for row in pdf["_blobs"]]
        first = int(pdf["_pos"].iloc[0])
        nxt = shard_ends(pdf["_body"].to_numpy(), held, target, own)
        leave = nxt.copy()
        for i in range(own - 1, -1, -1):
            if nxt[i] < own:
                leave[i] = leave[nxt[i]]
        mine = pdf.head(own)
        entry = (mine["_bucket"] == mine["_bucket"].iloc[0]).to_numpy()
        run = np.cumsum(np.concatenate(([0], leave[1:] != leave[:-1])))
        return mine[[*keys, "_group", "_pos"]].assign(
            _next=nxt + first, _exit=leave + first, _run=np.where(entry, run, -1))

    jumps = materialise(spread.groupBy(*keys, "_group").applyInPandas(
        ends, f"{key_schema}, _group bigint, _pos bigint, _next bigint, _exit bigint, _run bigint"), "packing")

    # Possible entries, neighbours with the same exit merged to one interval.
    runs = jumps.where("_run >= 0").groupBy(*keys, "_group", "_run").agg(
        F.min("_pos").alias("_lo"), F.max("_pos").alias("_hi"), F.max("_exit").alias("_exit"))

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_group", "_lo"])
        at, out = 0, []
        for g, rows in pdf.groupby("_group", sort=True):
            hit = rows[(rows["_lo"] <= at) & (at <= rows["_hi"])]
            if hit.empty and g == pdf["_group"].iloc[-1]:
                break       # the last shard began in the group before and holds all of this one
            out.append((g, at))
            at = int(hit["_exit"].iloc[0])
        res = pd.DataFrame(out, columns=["_group", "_at"])
        for k in keys:
            res[k] = pdf[k].iloc[0]
        return res[[*keys, "_group", "_at"]]

    entries = runs.groupBy(*keys).applyInPandas(chain, f"{key_schema}, _group bigint, _at bigint")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        first, nxt = int(pdf["_pos"].iloc[0]), pdf["_next"].to_numpy()
        at, starts = int(pdf["_at"].iloc[0]) - first, []
        while at < len(nxt):
            starts.append(at)
            at = int(nxt[at]) - first
        return pdf.iloc[starts][[*keys, "_pos"]]

    starts = (jumps.join(entries, [*keys, "_group"]).groupBy(*keys, "_group")
              .applyInPandas(walk, f"{key_schema}, _pos bigint"))
    # Starts are rows of their own, ahead of the records that they mark: a join would send them all through the driver while they are few.
    marks = materialise(starts, "packing").select(
        *keys, *[F.lit(None).cast(narrow.schema[c].dataType).alias(c) for c in order], "_pos", F.lit(0).alias("_record"))
    marked = narrow.select(*keys, *order, "_pos", F.lit(1).alias("_record")).unionByName(marks)
    numbered = Ordered(marked, keys, ["_pos", "_record"]).running({"shard": 1 - F.col("_record")}).done().where("_record = 1")
    return df.join(numbered.select(*keys, *order, "shard"), [*keys, *order])
