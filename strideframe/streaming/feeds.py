"""Append-only feeds and event logs as Structured Streaming jobs.

Every job reads new files since its checkpoint, so the checkpoint plays the part of a
reader's cursor.  Sinks write one folder per batch id and overwrite it on replay, which
makes a batch that is run again after a lost executor harmless.

Aggregates keep no state in the stream and have no watermark: each batch writes its partial rows as a run, runs are folded
into larger ones (streaming/runs.py), and readers merge the few runs there are. So no late row is lost, no state
grows, and the newest window is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.operators import ledger
from strideframe.session import configure, make_folder
from strideframe.streaming.runs import Runs

FILES_PER_TRIGGER = 1000


def tail(spark: SparkSession, path: str, schema: str, *, fmt: str = "parquet", pattern: str | None = None,
         files: int = FILES_PER_TRIGGER) -> DataFrame:
    """Files that appear below a path."""
    reader = configure(spark).readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def _batch_sink(path: str, change: Callable[[DataFrame], DataFrame] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch if change is None else change(batch)
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def run(stream: DataFrame, path: str, *, change: Callable[[DataFrame], DataFrame] | None = None, sink=None, schema: str | None = None) -> DataFrame:
    """Process everything available, then stop; the table of all batches comes back.

    `schema` declares the table (by default the stream's columns, or those that `change` makes of an empty
    batch), so a stream that had no rows yet is an empty table.
    """
    spark = stream.sparkSession
    make_folder(spark, f"{path}/rows")
    query = (stream.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint")
             .foreachBatch(sink or _batch_sink(f"{path}/rows", change)).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return table(spark, path, schema or _declared(stream, change))


def _declared(stream: DataFrame, change) -> str:
    """Columns of the stored rows."""
    kept = stream.schema if change is None else change(stream.sparkSession.createDataFrame([], stream.schema)).schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)


def table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that the batches of a job stored."""
    return spark.read.schema(f"{schema}, batch bigint").parquet(f"{path}/rows")


def _merging(stream: DataFrame, out: str, change, merge, schema: str) -> DataFrame:
    """Process everything available into mergeable runs, then stop; the merged table comes back."""
    runs = Runs(stream.sparkSession, f"{out}/table", schema, merge)
    query = (stream.writeStream.outputMode("append").option("checkpointLocation", f"{out}/checkpoint")
             .foreachBatch(lambda batch, batch_id: runs.add(change(batch), batch_id)).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return merge(runs.rows())


def partials(stream: DataFrame, keys: list, parts: dict[str, Column], merged: dict[str, Column], *, out: str) -> DataFrame:
    """Aggregates by `keys`: every batch stores `parts`, and the result is `merged` over the parts of all batches.

    `merged` makes columns of the same names as `parts`, so parts can be merged again and again.
    """
    def change(batch):
        return batch.groupBy(*keys).agg(*[e.alias(n) for n, e in parts.items()])

    schema = _declared(stream, change)
    names = [f.name for f in change(stream.sparkSession.createDataFrame([], stream.schema)).schema.fields if f.name not in parts]

    def merge(rows):
        return rows.groupBy(*names).agg(*[e.alias(n) for n, e in merged.items()])

    return _merging(stream, out, change, merge, schema)


def discover_feed(spark: SparkSession, path: str, schema: str, *, out: str, files: int = FILES_PER_TRIGGER) -> DataFrame:
    """Feed rows of a growing JSON folder."""
    return run(tail(spark, path, schema, fmt="json", files=files), out).drop("batch")


def tail_events(stream: DataFrame, *, out: str, keep: Column) -> DataFrame:
    """The log from the last checkpoint on."""
    return run(stream.where(keep), out).drop("batch")


def deduplicated_feed(stream: DataFrame, *, time: str, keys: list[str], out: str) -> DataFrame:
    """First row per (candidate, version) by time, however late a row comes.

    A batch stores its own first rows and reads nothing of the table but the runs that it folds.
    """
    rest = [c for c in stream.columns if c not in keys]

    def firsts(df):
        return df.groupBy(*keys).agg(F.min(F.struct(time, *[c for c in rest if c != time])).alias("_r")).select(*keys, "_r.*").select(*stream.columns)

    return _merging(stream, out, firsts, firsts, _declared(stream, None))


def rolling_counts(stream: DataFrame, *, time: str, out: str, size_s: int = 600, slide_s: int = 60) -> DataFrame:
    """Rows in every sliding window that holds one, the newest too; batches store counts per slide."""
    slot = F.floor(F.unix_micros(time) / (slide_s * 1_000_000)).alias("slot")
    slots = partials(stream, [slot], {"n": F.count(F.lit(1))}, {"n": F.sum("n")}, out=out)
    starts = F.explode(F.sequence(F.col("slot") - size_s // slide_s + 1, F.col("slot")))
    return slots.select(starts.alias("first"), "n").groupBy("first").agg(F.sum("n").alias("published")).select(
        F.timestamp_seconds(F.col("first") * slide_s).alias("window_start"), "published")


def standing_status(stream: DataFrame, *, key: str, order: list[str], status: str, error: str, out: str) -> DataFrame:
    """Standing status of each key.

    The fold keeps the first terminal record and the last record, both order-free, so batches store
    two records of each of their keys.
    """
    record = F.struct(*order, F.col(status).alias("_status"), F.col(error).alias("_error"))
    parts = {"_t": F.min(F.when(F.col(status).isin(ledger.TERMINAL), record)), "_l": F.max(record)}
    best = partials(stream, [key], parts, {"_t": F.min("_t"), "_l": F.max("_l")}, out=out).withColumn("_b", F.coalesce("_t", "_l"))
    return best.select(key, F.col("_b._status").alias("status"), F.col("_b._error").alias("error"))


def folded_metrics(stream: DataFrame, *, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Last value, total and count per key."""
    parts = {"_last": F.max(F.struct(*order, F.col(value).alias("_value"))), "total": F.sum(value), "count": F.count(F.lit(1))}
    rows = partials(stream, keys, parts, {"_last": F.max("_last"), "total": F.sum("total"), "count": F.sum("count")}, out=out)
    return rows.select(*keys, F.col("_last._value").alias("last_value"), "total", "count")


def pending_requests(stream: DataFrame, completed: Callable[[], DataFrame], failed: Callable[[], DataFrame],
                     *, key: str, out: str) -> DataFrame:
    """Requests of each batch that have no result and no failure when the batch runs."""
    from strideframe.operators.joins import pending
    return run(stream, out, change=lambda batch: pending(batch, completed(), failed(), key=key)).drop("batch")


def queue_windows(stream: DataFrame, *, time: str, delta: str, size: str, every: str, out: str) -> DataFrame:
    """Net entries and bytes per sampling period; `queue_depth` runs over the result."""
    start = F.unix_micros(F.window(F.col(time), every)["start"]).alias("start_us")
    parts = {"entries": F.sum(delta), "bytes": F.sum(F.col(delta) * F.col(size))}
    return partials(stream, [start], parts, {"entries": F.sum("entries"), "bytes": F.sum("bytes")}, out=out)


def depth_series(windows: DataFrame) -> DataFrame:
    """Queue depth and bytes at the end of each period."""
    from strideframe.plans.ordered import Ordered
    return Ordered(windows, [], ["start_us"]).running(
        {"depth": F.col("entries"), "queued_bytes": F.col("bytes")}).done()


def commit_last(stream: DataFrame, *, key: str, digest: Column, out: str) -> DataFrame:
    """Objects of a batch first, its commit rows after them, both keyed by the batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("sha256", digest)
        rows.write.mode("overwrite").parquet(f"{out}/objects/batch={batch_id}")
        stored = batch.sparkSession.read.schema(rows.schema).parquet(f"{out}/objects/batch={batch_id}")
        stored.select(key, "sha256").write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    kind = stream.schema[key].dataType.simpleString()
    return run(stream, out, sink=write, schema=f"`{key}` {kind}, sha256 string").drop("batch")


def emit_feed(stream: DataFrame, *, time: str, out: str) -> DataFrame:
    """Feed rows appended in hour folders per batch; a repost is a later row of the same pair."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("hour", F.date_format(time, "yyyyMMddHH")).hint("rebalance", "hour").write.mode("overwrite")
         .partitionBy("hour").parquet(f"{out}/rows/batch={batch_id}"))

    return run(stream, out, sink=write, schema=_declared(stream, None) + ", hour string").drop("batch")


def reposts(feed: DataFrame, commits: DataFrame, *, keys: list[str], feed_key: str, stored: DataFrame | None = None) -> DataFrame:
    """Commits whose feed row is absent, with the key of a new feed row.

    A commit is reposted when no feed row names it, or when the row it has is not among the `stored` keys any more. The new
    key counts the posts of the pair, so it differs from every key that was used before.
    """
    rows = feed.select(*keys, feed_key)
    held = rows if stored is None else rows.join(stored.select(feed_key).distinct(), feed_key, "left_semi")
    posts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("posts"))
    lost = commits.join(held.select(*keys).distinct(), keys, "left_anti").join(posts, keys, "left")
    number = F.coalesce("posts", F.lit(0))
    return lost.select(*commits.columns, F.concat_ws("-", *[F.col(k).cast("string") for k in keys], (number + 1).cast("string")).alias(feed_key))


def progress_changes(stream: DataFrame, *, status: str, out: str) -> DataFrame:
    """Counts per status; a batch writes only the statuses it changed."""
    return partials(stream, [status], {"clips": F.count(F.lit(1))}, {"clips": F.sum("clips")}, out=out)
