"""Job ledger analytics over event-log and state tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.plans.ordered import Ordered, exact_percentiles

STATUSES = ["published", "ready-local", "pending-publish", "excluded", "failed"]
TERMINAL = ["published", "ready-local", "excluded"]

# Fixed error vocabulary.
BLOCKING_CODES, BLOCKING_NAMES = [401, 403], ["unauthorized", "forbidden", "permissiondenied"]
BLOCKING_TEXT = ["401 unauthorized", "403 forbidden", "permission denied",
                 "remote object could not be verified", "remote commit could not be verified"]
TRANSIENT_NAMES = ["timeout", "connection", "retryerror", "serviceunavailable", "toomanyrequests",
                   "internalservererror", "gatewaytimeout", "transporterror"]
TRANSIENT_TEXT = ["nameresolutionerror", "temporary failure in name resolution", "connection reset",
                  "connection refused", "deadline exceeded", "503 service unavailable", "502 bad gateway",
                  "429 too many requests"]


def _has(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def error_class(code: Column, name: Column, message: Column) -> Column:
    """blocking, transient or permanent."""
    n, m = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    code = F.coalesce(code.cast("int"), F.lit(0))
    blocking = code.isin(BLOCKING_CODES) | n.isin(BLOCKING_NAMES) | _has(m, BLOCKING_TEXT)
    transient = (code == 429) | code.between(500, 599) | _has(n, TRANSIENT_NAMES) | _has(m, TRANSIENT_TEXT)
    return F.when(blocking, "blocking").when(transient, "transient").otherwise("permanent")


def transient_failures(df: DataFrame, *, keys: list[str], transient: Column) -> DataFrame:
    """Number of failures of a group when every one is transient, else 0."""
    return df.groupBy(*keys).agg(F.when(F.bool_and(transient), F.count(F.lit(1))).otherwise(0).alias("transient_failures"))


def status_counts(df: DataFrame, *, status: str, size: str) -> DataFrame:
    """Rows and bytes by status."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("clips"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


def source_status(df: DataFrame, planned: DataFrame, *, source: str, status: str) -> DataFrame:
    """Status counts per source as columns, processed count and completeness."""
    wide = df.groupBy(source).pivot(status, STATUSES).count()
    rows = planned.join(wide, source, "left").na.fill(0, STATUSES)
    names = [s.replace("-", "_") for s in STATUSES]
    rows = rows.withColumnsRenamed(dict(zip(STATUSES, names)))
    processed = sum((F.col(n) for n in names), F.lit(0))
    return rows.withColumn("processed", processed.cast("bigint")).withColumn(
        "status", F.when(F.col("processed") == F.col("planned"), "complete").otherwise("incomplete"))


def phase_summary(df: DataFrame, *, phase: str, value: str) -> DataFrame:
    """Count, total, mean, exact p50 and p95, max per phase."""
    p = exact_percentiles(df, [phase], value, {"p50": 0.5, "p95": 0.95})
    return phase_totals(df, phase=phase, value=value).join(p, phase)


def phase_totals(df: DataFrame, *, phase: str, value: str) -> DataFrame:
    """A10: the same without percentiles."""
    return df.groupBy(phase).agg(F.count(F.lit(1)).alias("count"), F.sum(value).alias("total"),
                                 F.avg(value).alias("mean"), F.max(value).alias("max"))


def queue_summary(df: DataFrame, *, size: str, attempts: str, created: str, state: str) -> DataFrame:
    """One row, zeros for an empty queue."""
    return df.agg(F.count(F.lit(1)).alias("count"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
                  F.coalesce(F.sum(attempts), F.lit(0)).alias("attempts"), F.min(created).alias("oldest"),
                  F.count_if(F.col(state) == "blocked").alias("blocked"))


def merge_metric_maps(df: DataFrame, *, payload: str) -> DataFrame:
    """Sums by key over per-worker JSON maps."""
    rows = df.select(F.explode(F.from_json(payload, "map<string,double>")).alias("metric", "value"))
    return rows.groupBy("metric").agg(F.sum("value").alias("value"))


def catalog_totals(df: DataFrame, *, status: str, clips: str, seconds: Column, matched: Column) -> DataFrame:
    """One-row totals of a catalog."""
    ready = F.col(status) == "ready"
    return df.agg(F.count(F.lit(1)).alias("members"), F.count_if(ready).alias("ready"),
                  F.count_if(F.col(status) == "adapter-required").alias("adapter_required"),
                  F.coalesce(F.sum(F.when(ready, F.col(clips))), F.lit(0)).alias("clips"),
                  F.coalesce(F.sum(F.when(ready, seconds)) / 3600.0, F.lit(0.0)).alias("hours"),
                  F.count_if(matched).alias("matches"))


def batch_status(df: DataFrame, *, status: str) -> DataFrame:
    """Sources per status with the sorted error texts as digest-free counts per error."""
    return df.groupBy(status, "error").agg(F.count(F.lit(1)).alias("rows")).orderBy(status, "error")


def throughput(df: DataFrame, *, elapsed_s: float) -> DataFrame:
    """Planned, settled, passed and settled per minute, one row."""
    settled = F.count_if(F.col("status").isin(TERMINAL))
    return df.agg(F.count(F.lit(1)).alias("planned"), settled.alias("settled"),
                  F.count_if(F.col("status") == "published").alias("passed"),
                  (settled / F.lit(elapsed_s / 60.0)).alias("per_minute"))


# --- T02-T04, T06, T07 -----------------------------------------------------------------------

def recent(df: DataFrame, *, updated: str, key: str, limit: int) -> DataFrame:
    """The newest `limit` rows."""
    return df.orderBy(F.desc(updated), key).limit(limit)


def page_after(df: DataFrame, *, seq: str, cursor: int, limit: int) -> DataFrame:
    """Keyset page; the cursor filter reaches the scan."""
    return df.where(F.col(seq) > cursor).orderBy(seq).limit(limit)


def worst(df: DataFrame, *, by: str, ties: list[str], limit: int = 5) -> DataFrame:
    """Rows with an error and the most attempts."""
    return df.orderBy(F.desc(by), *ties).limit(limit)


def next_due(df: DataFrame, *, due: str, created: str, key: str) -> DataFrame:
    """The row that is due first."""
    return df.orderBy(due, created, key).limit(1)


def canonical_order(df: DataFrame, *, order: list[str]) -> DataFrame:
    """Deterministic output order."""
    return df.orderBy(*order)


# --- R05, R06, R08, R09, R11 batch twins ---------------------------------------------------------

def status_transitions(df: DataFrame, *, key: str, order: list[str], status: str) -> DataFrame:
    """Each record of the log as `accepted`, `repeat` or `illegal` under the terminal rule.

    Once a key has reached a terminal status, that status stands: repeating it is a no-op
    and any other record is illegal.  So only the first terminal record matters.
    """
    terminal = F.when(F.col(status).isin(TERMINAL), F.struct(*order, F.col(status).alias("s")))
    o = Ordered(df, [key], order).totals({"_first": F.min(terminal)}).done()
    here = F.struct(*order, F.col(status).alias("s"))
    after = here > F.col("_first")
    return o.withColumn("outcome", F.when(~F.coalesce(after, F.lit(False)), "accepted").when(
        F.col(status) == F.col("_first.s"), "repeat").otherwise("illegal")).drop("_first")


def current_status(df: DataFrame, *, key: str, order: list[str], status: str, error: str) -> DataFrame:
    """Standing status of each key: the first terminal one, else the last seen."""
    rank = F.struct(*order)
    terminal = F.col(status).isin(TERMINAL)
    s = F.struct(F.col(status).alias("status"), F.col(error).alias("error"))
    agg = df.groupBy(key).agg(F.min_by(s, F.when(terminal, rank)).alias("_t"), F.max_by(s, rank).alias("_l"))
    best = F.coalesce("_t", "_l")
    return agg.select(key, best["status"].alias("status"), best["error"].alias("error"))


def fold_metrics(df: DataFrame, *, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Last value, accumulated value and count per key."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("last_value"),
                                 F.sum(value).alias("total"), F.count(F.lit(1)).alias("count"))


def queue_depth(df: DataFrame, *, time_us: str, order: list[str], delta: str, size: str, every_us: int) -> DataFrame:
    """Depth and bytes at the end of each sampling period that has events."""
    slot = F.floor(F.col(time_us) / F.lit(every_us))
    per = df.groupBy(slot.alias("slot")).agg(F.sum(delta).alias("_d"), F.sum(F.col(delta) * F.col(size)).alias("_b"))
    return Ordered(per, [], ["slot"]).running({"depth": F.col("_d"), "bytes": F.col("_b")}).done().drop("_d", "_b")


def pressure_edges(df: DataFrame, *, time_us: str, order: list[str], delta: str, limit: float) -> DataFrame:
    """Rows where the running total crosses the limit, up or down."""
    o = Ordered(df, [], order).running({"total": F.col(delta)})
    o.with_columns({"_over": F.col("total") >= limit}).neighbours(prev={"_was": "_over"})
    return o.done().where(F.col("_over") != F.coalesce("_was", F.lit(False))).withColumn(
        "edge", F.when(F.col("_over"), "upload-backpressure").otherwise("upload-capacity-restored")).drop("_over", "_was")


def changed_only(df: DataFrame, *, keys: list[str], order: list[str], summary: list[str]) -> DataFrame:
    """Rows whose summary differs from the row before it."""
    rows = df.withColumn("_s", F.struct(*summary))
    o = Ordered(rows, keys, order).neighbours(prev={"_before": "_s"}).done()
    return o.where(~F.col("_s").eqNullSafe(F.col("_before"))).drop("_s", "_before")
