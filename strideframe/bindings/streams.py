"""Streaming queries; the SQL is the batch meaning of the final table."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings.common import CLIP, E, ORDER, signal
from strideframe.bindings.ledger import STATUS_SQL, status_of
from strideframe.bindings.registry import query
from strideframe.operators import ledger as L
from strideframe.operators.delivery import is_directory
from strideframe.session import work_dir
from strideframe.sources.tables import DRIVER, micros, read
from strideframe.streaming import feeds as S


def stream(spark, d, name="events"):
    path = f"{d}/{name}.parquet"
    if is_directory(spark, path):
        s = S.tail(spark, path, DRIVER[name])
    else:                                    # a table that is one file: watch its folder
        s = S.tail(spark, d, DRIVER[name], pattern=f"{name}.parquet")
    return s.withColumn("us", micros(F.col("ts"))).withColumn("at", F.col("ts").cast("timestamp")) if name == "events" else s


def out(spark, name):
    return work_dir(spark, name)


@query("r01_discover_feed", "SELECT event_id AS candidate_id, event_type AS version_id FROM events")
def r01(spark, d):
    folder = out(spark, "feed")
    read(spark, d, "events").select(
        F.col("event_id").alias("candidate_id"), F.col("event_type").alias("version_id")).write.json(folder)
    return S.discover_feed(spark, folder, "candidate_id bigint, version_id string", out=out(spark, "r01"))


@query("r02_tail_events", "SELECT event_id, user_id, value FROM events WHERE event_type IN ('error', 'signup')")
def r02(spark, d):
    keep = F.col("event_type").isin("error", "signup")
    return S.tail_events(stream(spark, d), out=out(spark, "r02"), keep=keep).select("event_id", "user_id", "value")


@query("r03_deduplicated_feed", "SELECT user_id, event_type, min(epoch_us(ts)) AS us FROM events GROUP BY user_id, event_type")
def r03(spark, d):
    s = stream(spark, d).select("user_id", "event_type", "at", "us")
    return S.deduplicated_feed(s, time="at", keys=["user_id", "event_type"], out=out(spark, "r03")).select("user_id", "event_type", "us")


@query("r04_rolling_counts", """
WITH m AS (SELECT epoch_us(ts) // 60000000 AS m FROM events), w AS (SELECT m - unnest(range(0, 10)) AS s FROM m)
SELECT s * 60 AS window_start, count(*) AS published FROM w GROUP BY s""")
def r04(spark, d):
    return S.rolling_counts(stream(spark, d), time="at", out=out(spark, "r04")).select(
        F.unix_seconds("window_start").alias("window_start"), "published")


_STAND = E + f""", s AS (SELECT *, {STATUS_SQL} AS status FROM e),
t AS (SELECT user_id, min((us, event_id, status)) FILTER (WHERE status IN ('published', 'ready-local', 'excluded')) AS f, max((us, event_id, status)) AS l FROM s GROUP BY user_id)"""


@query("r05_standing_status", _STAND + " SELECT user_id, coalesce(f[3], l[3]) AS status FROM t")
def r05(spark, d):
    s = stream(spark, d).withColumn("status", status_of("event_type"))
    return S.standing_status(s, key="user_id", order=ORDER, status="status", error="props", out=out(spark, "r05")).select("user_id", "status")


@query("r05_status_transitions", _STAND + """
SELECT event_id, CASE WHEN f IS NULL OR (us, event_id, status) <= f THEN 'accepted' WHEN status = f[3] THEN 'repeat' ELSE 'illegal' END AS outcome FROM s JOIN t USING (user_id)""")
def r05_batch(spark, d):
    ev = signal(spark, d).withColumn("status", status_of("event_type"))
    return L.status_transitions(ev, key="user_id", order=ORDER, status="status").select("event_id", "outcome")


@query("r06_folded_metrics", E + """
SELECT user_id, event_type, arg_max(value, (us, event_id)) AS last_value, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS count FROM e GROUP BY ALL""")
def r06(spark, d):
    s = stream(spark, d).withColumn("value", F.col("value").cast("decimal(18,2)"))
    o = S.folded_metrics(s, keys=["user_id", "event_type"], order=ORDER, value="value", out=out(spark, "r06"))
    return o.select("user_id", "event_type", F.col("last_value").cast("double").alias("last_value"), F.col("total").cast("double").alias("total"), "count")


@query("r07_pending_requests", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND NOT (o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0)")
def r07(spark, d):
    s = stream(spark, d, "orders").select("o_orderkey")
    done = lambda: read(spark, d, "orders").where("o_orderstatus = 'F'")
    lost = lambda: read(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_custkey % 2 = 0")
    return S.pending_requests(s, done, lost, key="o_orderkey", out=out(spark, "r07"))


_QUEUE = E + """, q AS (SELECT us, event_id, CASE WHEN event_type IN ('view', 'click', 'error') THEN 1 ELSE -1 END AS delta, CAST(floor(value) AS BIGINT) AS size FROM e)"""


def _deltas(df):
    return df.withColumns({"delta": F.when(F.col("event_type").isin("view", "click", "error"), 1).otherwise(-1), "size": F.floor("value")})


@query("r08_queue_depth", _QUEUE + """
, p AS (SELECT us // 3600000000 * 3600000000 AS start_us, sum(delta) AS d, sum(delta * size) AS b FROM q GROUP BY 1)
SELECT start_us, CAST(sum(d) OVER w AS BIGINT) AS depth, CAST(sum(b) OVER w AS BIGINT) AS queued_bytes FROM p WINDOW w AS (ORDER BY start_us)""")
def r08(spark, d):
    w = S.queue_windows(_deltas(stream(spark, d)), time="at", delta="delta", size="size", every="1 hour", out=out(spark, "r08"))
    return S.depth_series(w).select("start_us", "depth", "queued_bytes")


@query("r09_pressure_edges", _QUEUE + """
, t AS (SELECT event_id, sum(delta * size) OVER (ORDER BY us, event_id) AS total, us FROM q),
f AS (SELECT *, total >= 20000 AS o, lag(total >= 20000, 1, false) OVER (ORDER BY us, event_id) AS p FROM t)
SELECT event_id, CAST(total AS BIGINT) AS total, CASE WHEN o THEN 'upload-backpressure' ELSE 'upload-capacity-restored' END AS edge FROM f WHERE o <> p""")
def r09(spark, d):
    ev = _deltas(signal(spark, d)).withColumn("step", F.col("delta") * F.col("size"))
    return L.pressure_edges(ev, time_us="us", order=ORDER, delta="step", limit=20000).select("event_id", "total", "edge")


@query("r10_commit_last", "SELECT event_id, sha256(props) AS sha256 FROM events")
def r10(spark, d):
    return S.commit_last(stream(spark, d).select("event_id", "props"), key="event_id", digest=F.sha2("props", 256), out=out(spark, "r10"))


@query("r11_progress_changes", f"SELECT {STATUS_SQL} AS status, count(*) AS clips FROM events GROUP BY 1")
def r11(spark, d):
    s = stream(spark, d).select(status_of("event_type").alias("status"))
    return S.progress_changes(s, status="status", out=out(spark, "r11"))


@query("r11_changed_only", E + """
, s AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY us, event_id) AS p FROM e)
SELECT event_id, event_type FROM s WHERE p IS NULL OR p <> event_type""")
def r11_batch(spark, d):
    return L.changed_only(signal(spark, d), keys=CLIP, order=ORDER, summary=["event_type"]).select("event_id", "event_type")


@query("k09_emit_feed", "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS VARCHAR) AS hour FROM events")
def k09(spark, d):
    s = stream(spark, d).select("event_id", "user_id", "at")
    return S.emit_feed(s, time="at", out=out(spark, "k09")).select("event_id", F.col("hour").cast("string").alias("hour"))
