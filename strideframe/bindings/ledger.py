"""Ledger, metric, review and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings.common import CLIP, E, ORDER, Q, QUAT, QUAT2, SERIES, poses, rounded, signal
from strideframe.bindings.registry import query
from strideframe.functions import rotations as R
from strideframe.operators import ledger as L
from strideframe.operators import metrics as M
from strideframe.operators import review as V
from strideframe.plans import pages
from strideframe.session import work_dir
from strideframe.sources.tables import micros, read

STATUS_SQL = "CASE event_type WHEN 'view' THEN 'published' WHEN 'click' THEN 'pending-publish' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'ready-local' ELSE 'excluded' END"


def status_of(kind):
    c = F.col(kind)
    return (F.when(c == "view", "published").when(c == "click", "pending-publish").when(c == "error", "failed")
            .when(c == "signup", "ready-local").otherwise("excluded"))


@query("a06_status_counts", "SELECT o_orderstatus, count(*) AS clips, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes FROM orders GROUP BY o_orderstatus")
def a06(spark, d):
    o = read(spark, d, "orders").select("o_orderstatus", F.floor("o_totalprice").alias("b"))
    return L.status_counts(o, status="o_orderstatus", size="b")


@query("a07_source_status", """
WITH o AS (SELECT c_nationkey AS source, CASE WHEN o_orderpriority = '5-LOW' THEN 'failed' WHEN o_orderstatus = 'F' THEN 'published' WHEN o_orderstatus = 'O' THEN 'excluded' ELSE 'pending-publish' END AS s,
 o_custkey FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT source, count(*) + source % 2 AS planned FROM o GROUP BY source)
SELECT p.source, p.planned, count(*) FILTER (WHERE s = 'published') AS published, CAST(0 AS BIGINT) AS ready_local, count(*) FILTER (WHERE s = 'pending-publish') AS pending_publish,
 count(*) FILTER (WHERE s = 'excluded') AS excluded, count(*) FILTER (WHERE s = 'failed') AS failed, count(*) AS processed,
 CASE WHEN count(*) = p.planned THEN 'complete' ELSE 'incomplete' END AS status FROM p JOIN o USING (source) GROUP BY p.source, p.planned""")
def a07(spark, d):
    cust = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("source"))
    o = read(spark, d, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        "source", F.when(F.col("o_orderpriority") == "5-LOW", "failed").when(F.col("o_orderstatus") == "F", "published")
        .when(F.col("o_orderstatus") == "O", "excluded").otherwise("pending-publish").alias("s"))
    planned = o.groupBy("source").agg((F.count(F.lit(1)) + F.first("source") % 2).alias("planned"))
    return L.source_status(o, planned, source="source", status="s")


@query("a08_phase_summary", """
SELECT l_returnflag, count(*) AS count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total, round(avg(l_quantity), 6) AS mean, max(l_quantity) AS max,
 round(quantile_cont(l_extendedprice, 0.5), 6) AS p50_price, round(quantile_cont(l_quantity, 0.5), 6) AS p50, round(quantile_cont(l_quantity, 0.95), 6) AS p95 FROM lineitem GROUP BY l_returnflag""")
def a08(spark, d):
    from strideframe.plans.ordered import exact_percentiles
    li = read(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    price = exact_percentiles(li, ["l_returnflag"], "l_extendedprice", {"p50_price": 0.5})
    return rounded(L.phase_summary(li, phase="l_returnflag", value="l_quantity").join(price, "l_returnflag"), "mean", "p50", "p95", "p50_price")


@query("a09_queue_summary", """
SELECT count(*) AS count, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes, CAST(sum(o_custkey % 4) AS BIGINT) AS attempts, min(epoch_us(o_orderdate)) AS oldest,
 count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS blocked FROM orders WHERE o_orderstatus = 'P'""")
def a09(spark, d):
    q = read(spark, d, "orders").where("o_orderstatus = 'P'").select(
        F.floor("o_totalprice").alias("b"), (F.col("o_custkey") % 4).alias("a"), micros(F.col("o_orderdate")).alias("t"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "blocked").otherwise("queued").alias("s"))
    return L.queue_summary(q, size="b", attempts="a", created="t", state="s")


@query("a10_phase_totals", """
SELECT l_shipmode AS phase, count(*) AS count, CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS total, round(CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS mean, max(l_tax) AS max
FROM (SELECT l_linestatus || l_linenumber AS l_shipmode, l_tax FROM lineitem) GROUP BY 1""")
def a10(spark, d):
    li = read(spark, d, "lineitem").select(F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("phase"),
                                           F.col("l_tax").cast("decimal(18,2)").alias("v"))
    return L.phase_totals(li, phase="phase", value="v").select("phase", "count", F.col("total").cast("double").alias("total"),
                                                              F.round(F.col("total").cast("double") / F.col("count"), 6).alias("mean"), F.col("max").cast("double").alias("max"))


@query("a11_merge_metric_maps", """
SELECT k AS metric, CAST(sum(CAST(v AS DOUBLE)) AS DOUBLE) AS value FROM (SELECT unnest(json_keys(props)) AS k, json_extract_string(props, '$.k') AS v FROM events) GROUP BY k""")
def a11(spark, d):
    return L.merge_metric_maps(read(spark, d, "events"), payload="props")


@query("a04_catalog_totals", """
SELECT count(*) AS members, count(*) FILTER (WHERE l_linenumber < 6) AS ready, count(*) FILTER (WHERE l_linenumber = 6) AS adapter_required,
 CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linenumber < 6) AS BIGINT) AS clips, round(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linenumber < 6) / 25.0 / 3600.0, 6) AS hours,
 count(*) FILTER (WHERE l_returnflag = 'A') AS matches FROM lineitem""")
def a04(spark, d):
    n = F.col("l_linenumber")
    li = read(spark, d, "lineitem").select(F.when(n < 6, "ready").when(n == 6, "adapter-required").otherwise("not-motion").alias("s"),
                                           F.col("l_quantity").cast("bigint").alias("q"), "l_returnflag")
    return rounded(L.catalog_totals(li, status="s", clips="q", seconds=F.col("q") / 25.0, matched=F.col("l_returnflag") == "A"), "hours")


@query("a22_corpus_audit", """
SELECT l_suppkey, count(*) AS members, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS frames, round(sum(CAST(l_quantity AS BIGINT) / 25.0), 6) AS seconds
FROM lineitem GROUP BY GROUPING SETS ((l_suppkey), ())""")
def a22(spark, d):
    return rounded(M.corpus_audit(read(spark, d, "lineitem"), source="l_suppkey", frames="l_quantity", rate=F.lit(25.0)), "seconds")


@query("a29_transient_failures", E + """
SELECT user_id, CASE WHEN bool_and(CAST(json_extract_string(props, '$.k') AS INTEGER) >= 10) THEN count(*) ELSE 0 END AS transient_failures FROM e WHERE event_type = 'error' GROUP BY user_id""")
def a29(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    ev = read(spark, d, "events").where("event_type = 'error'").select("user_id", L.error_class(
        F.lit(0), F.lit("error"), F.when(k >= 10, "Connection reset by peer").otherwise("bad shape")).alias("c"))
    return L.transient_failures(ev, keys=["user_id"], transient=F.col("c") == "transient")


@query("f14_error_class", """
WITH k AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, CASE WHEN k IN (1, 3) OR event_type = 'click' AND k % 7 = 0 OR k % 10 = 9 THEN 'blocking'
 WHEN k = 29 OR k BETWEEN 80 AND 95 OR event_type = 'view' AND k % 7 = 0 OR k % 10 = 8 THEN 'transient' ELSE 'permanent' END AS class FROM k""")
def f14(spark, d):
    k, t = F.get_json_object("props", "$.k").cast("int"), F.col("event_type")
    code = F.when(k.isin(1, 3), k + 400).when(k == 29, 429).when(k.between(80, 95), k + 420).otherwise(k)
    name = F.when((t == "click") & (k % 7 == 0), "Forbidden").when((t == "view") & (k % 7 == 0), "ReadTimeoutError").otherwise("ValueError")
    text = F.when(k % 10 == 9, "Remote object could not be verified").when(k % 10 == 8, "503 Service Unavailable").otherwise("bad shape")
    return read(spark, d, "events").select("event_id", L.error_class(
        F.when(k == 3, 403).when(k == 1, 401).otherwise(code), name, text).alias("class"))


@query("a31_batch_status", """
SELECT o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE '' END AS error, count(*) AS rows FROM orders GROUP BY ALL""")
def a31(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise("").alias("error"))
    return L.batch_status(o, status="status")


@query("a33_throughput", """
SELECT count(*) AS planned, count(*) FILTER (WHERE o_orderstatus <> 'P') AS settled, count(*) FILTER (WHERE o_orderstatus = 'F') AS passed,
 round(count(*) FILTER (WHERE o_orderstatus <> 'P') / 60.0, 6) AS per_minute FROM orders""")
def a33(spark, d):
    s = F.col("o_orderstatus")
    o = read(spark, d, "orders").select(F.when(s == "F", "published").when(s == "O", "excluded").otherwise("failed").alias("status"))
    return rounded(L.throughput(o, elapsed_s=3600.0), "per_minute")


@query("t02_recent_errors", "SELECT event_id, user_id, value FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 500")
def t02(spark, d):
    return L.recent(signal(spark, d).where("event_type = 'error'"), updated="us", key="event_id", limit=500).select("event_id", "user_id", "value")


@query("t03_page_after", "SELECT event_id, event_type FROM events WHERE event_id > 1234 ORDER BY event_id LIMIT 100")
def t03(spark, d):
    return L.page_after(read(spark, d, "events").select("event_id", "event_type"), seq="event_id", cursor=1234, limit=100)


@query("t03_clustered_page", "SELECT user_id, event_id, event_type FROM events WHERE (user_id, event_id) > (5, 0) ORDER BY user_id, event_id LIMIT 100")
def t03_clustered(spark, d):
    """The same through a layout clustered by the cursor, of which a page opens one or two files."""
    path = work_dir(spark, "pages")
    pages.write_clustered(read(spark, d, "events").select("user_id", "event_id", "event_type"), path, order=["user_id", "event_id"], rows_per_file=2000)
    return pages.clustered_page(spark, path, order=["user_id", "event_id"], after=(5, 0), limit=100)


@query("t04_worst", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey LIMIT 5")
def t04(spark, d):
    li = read(spark, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return L.worst(li, by="l_quantity", ties=["l_orderkey", "l_linenumber", "l_partkey"])


@query("t05_top_weights", """
WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS n FROM x),
t AS (SELECT *, sum(CAST(v AS DOUBLE)) OVER (PARTITION BY vec_id) AS s FROM r WHERE n <= 4)
SELECT vec_id, CAST(n AS INTEGER) AS rank, CAST(i AS INTEGER) AS index, round(v / s, 6) AS weight FROM t""")
def t05(spark, d):
    e = read(spark, d, "embeddings").select("vec_id", F.posexplode(M.top_weights(F.col("embedding"), 4)).alias("rank", "w"))
    return e.select("vec_id", (F.col("rank") + 1).alias("rank"), "w.index", F.round("w.weight", 6).alias("weight"))


@query("t06_next_due", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_custkey % 100, o_orderdate, o_orderkey LIMIT 1")
def t06(spark, d):
    o = read(spark, d, "orders").where("o_orderstatus = 'P'").withColumn("due", F.col("o_custkey") % 100)
    return L.next_due(o, due="due", created="o_orderdate", key="o_orderkey").select("o_orderkey")


@query("t07_canonical_order", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY 1, 2, 3, 4")
def t07(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return L.canonical_order(read(spark, d, "lineitem").select(*cols), order=cols)


# --- metrics ------------------------------------------------------------------------------

@query("a17_vector_metrics", """
WITH v AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c,
 CAST(embedding[4] AS DOUBLE) AS x, CAST(embedding[5] AS DOUBLE) AS y, CAST(embedding[6] AS DOUBLE) AS z FROM embeddings),
n AS (SELECT *, sqrt((x-a)**2+(y-b)**2+(z-c)**2) AS n FROM v),
s AS (SELECT label, unnest([a, b, c]) AS r, unnest([x, y, z]) AS e FROM v), k AS (SELECT label, corr(r, e) AS k FROM s GROUP BY label)
SELECT label, round(avg(n), 6) AS mae_vector_norm, round(sqrt(avg(n*n)/3), 6) AS rmse_per_component, round(any_value(k), 6) AS pearson_correlation,
 round(quantile_cont(n, 0.95), 6) AS p95_vector_norm, count(*) AS samples FROM n JOIN k USING (label) GROUP BY label""")
def a17(spark, d):
    v = read(spark, d, "embeddings").select("label", *[c.alias(n) for c, n in zip(R.parts(F.col("embedding"), 0, 6), "abcxyz")])
    out = M.vector_metrics(v, keys=["label"], reference=list("abc"), estimate=list("xyz"))
    return rounded(out, "mae_vector_norm", "rmse_per_component", "pearson_correlation", "p95_vector_norm")


_ERR = Q + ", r AS (SELECT label, vec_id, 2*acos(least(1.0, abs(qw*pw+qx*px+qy*py+qz*pz))) AS e FROM q)"


@query("a18_angle_metrics", _ERR + """
SELECT label, round(degrees(avg(e)), 6) AS mean_geodesic_deg, round(degrees(sqrt(avg(e*e))), 6) AS rmse_geodesic_deg, count(*) AS samples,
 round(degrees(quantile_cont(e, 0.95)), 6) AS p95_geodesic_deg FROM r GROUP BY label""")
def a18(spark, d):
    rows = poses(spark, d).withColumn("e", R.geodesic([F.col(c) for c in QUAT], [F.col(c) for c in QUAT2]))
    return rounded(M.angle_metrics(rows, keys=["label"], error="e"), "mean_geodesic_deg", "rmse_geodesic_deg", "p95_geodesic_deg")


@query("a19_grouped_metrics", """
WITH r AS (SELECT c_nationkey, c_mktsegment, o_orderstatus, o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS e FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_nationkey, c_mktsegment, o_orderstatus, o_orderpriority, round(avg(e), 4) AS mean_error, round(sqrt(avg(e*e)), 4) AS rmse_error, count(*) AS samples FROM r
GROUP BY GROUPING SETS ((c_nationkey), (c_mktsegment), (o_orderstatus), (o_orderpriority), ())""")
def a19(spark, d):
    rows = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey", "c_mktsegment", "o_orderstatus", "o_orderpriority", F.floor("o_totalprice").alias("e"))
    out = M.grouped_metrics(rows, dimensions=["c_nationkey", "c_mktsegment", "o_orderstatus", "o_orderpriority"], error="e")
    return rounded(out, "mean_error", "rmse_error", places=4)


# --- review -------------------------------------------------------------------------------

@query("w01_latest_revision", "SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def w01(spark, d):
    return V.latest_revision(read(spark, d, "conversations"), keys=["conv_id"], revision="turn")


@query("w02_revision_numbering", """
WITH t AS (SELECT conv_id, turn FROM conversations WHERE (conv_id * 31 + turn) % 17 <> 0)
SELECT 'revision-numbering' AS rule, CAST(conv_id AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS detail FROM t GROUP BY conv_id HAVING min(turn) <> 0 OR max(turn) <> count(*) - 1""")
def w02(spark, d):
    t = read(spark, d, "conversations").where((F.col("conv_id") * 31 + F.col("turn")) % 17 != 0)
    return V.revision_numbering(t, key="conv_id", revision="turn", first=0)


@query("w03_hash_chain", """
WITH t AS (SELECT conv_id, turn, (conv_id + turn) % 13 = 5 AS bad FROM conversations)
SELECT 'hash-chain' AS rule, conv_id || '/' || turn AS key, CAST(turn AS VARCHAR) AS detail FROM t WHERE bad""")
def w03(spark, d):
    from strideframe.plans.ordered import Ordered
    t = read(spark, d, "conversations").withColumn("sha", F.sha2(F.concat_ws("|", "role", "text"), 256))
    chained = Ordered(t, ["conv_id"], ["turn"]).neighbours(prev={"prev": "sha"}).done()
    chained = chained.withColumn("prev", F.when((F.col("conv_id") + F.col("turn")) % 13 == 5, "x").otherwise(F.col("prev"))).drop("sha")
    return V.hash_chain(chained, key="conv_id", revision="turn", body=F.concat_ws("|", "role", "text"), previous_sha="prev")


_REV = """WITH x AS (SELECT d.doc_id AS clip_id, source AS source_dataset, lang AS subject, l.quality, l.toxic, n_chars,
 CASE WHEN d.doc_id % 6 = 0 THEN 0 WHEN d.doc_id % 10 = 3 THEN 2 ELSE 1 END AS n_codes, CASE d.doc_id % 3 WHEN 0 THEN 'walk' WHEN 1 THEN 'run' ELSE 'sit' END AS code,
 CASE WHEN quality IS NOT NULL THEN n_chars % 1000 / 1000.0 END AS risk_score, CASE WHEN d.doc_id % 9 = 0 THEN 'accepted' END AS decision FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
q AS (SELECT *, list_filter([CASE WHEN quality = 0 THEN 'automatic-qa-failed' END, CASE WHEN toxic = 1 THEN 'automatic-warning' END,
 CASE WHEN n_codes = 0 THEN 'label-unresolved' WHEN n_codes > 1 THEN 'label-ambiguous' END], lambda r: r IS NOT NULL) AS reasons, coalesce(risk_score, 1.0) AS risk FROM x)"""


def review_rows(spark, d):
    i = F.col("doc_id")
    code = F.when(i % 3 == 0, "walk").when(i % 3 == 1, "run").otherwise("sit")
    none = F.array().cast("array<string>")
    return read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").select(
        i.alias("clip_id"), F.col("source").alias("source_dataset"), F.col("lang").alias("subject"), "n_chars",
        F.when(i % 6 == 0, none).when(i % 10 == 3, F.array(code, F.lit("zoom"))).otherwise(F.array(code)).alias("codes"),
        F.when(F.col("quality").isNotNull(), F.col("quality") == 1).alias("qa_passed"),
        F.when(F.col("toxic") == 1, F.array(F.lit("root-speed-outlier"))).when(F.col("toxic") == 0, none).alias("warnings"),
        F.when(F.col("quality").isNotNull(), F.col("n_chars") % 1000 / 1000.0).alias("risk_score"),
        F.when(i % 9 == 0, "accepted").alias("decision"))


@query("f18_queue_reasons", _REV + " SELECT clip_id, array_to_string(reasons, ',') AS reasons, round(risk, 6) AS risk FROM q")
def f18(spark, d):
    return rounded(V.queue_reasons(review_rows(spark, d)).select("clip_id", F.array_join("reasons", ",").alias("reasons"), "risk"), "risk")


_PICK = """, p AS (SELECT * FROM q WHERE decision IS NULL AND len(reasons) = 0),
s AS (SELECT *, row_number() OVER (PARTITION BY source_dataset, subject, code ORDER BY risk DESC, clip_id DESC) AS n FROM p)"""


@query("w13_stratified_pick", _REV + _PICK + " SELECT source_dataset, subject, code, clip_id FROM s WHERE n = 1")
def w13(spark, d):
    q = V.queue_reasons(review_rows(spark, d)).where("decision is null and size(reasons) = 0").withColumn("code", F.get("codes", F.lit(0)))
    return V.stratified_pick(q, strata=["source_dataset", "subject", "code"], risk="risk", key="clip_id").select("source_dataset", "subject", "code", "clip_id")


@query("t01_review_queue", _REV + _PICK + """
SELECT clip_id, round(risk, 6) AS risk, array_to_string(reasons, ',') AS reasons FROM q WHERE decision IS NULL AND len(reasons) > 0
UNION ALL SELECT clip_id, round(risk, 6), 'stratified-sample' FROM s WHERE n = 1""")
def t01(spark, d):
    return V.review_queue(review_rows(spark, d), key="clip_id").select("clip_id", F.round("risk", 6).alias("risk"), F.array_join("reasons", ",").alias("reasons"))


_SAMP = _REV + """, r AS (SELECT *, n_chars % 500 / 10.0 + CASE WHEN source_dataset = 'src6' THEN 40 ELSE 0 END AS dur, coalesce(toxic, 0) = 1 AS warned FROM x),
pool AS (SELECT * FROM (SELECT *, min((dur, clip_id)) OVER (PARTITION BY source_dataset) AS m FROM r) WHERE dur <= 30 OR (m[1] > 30 AND clip_id = m[2])),
c1 AS (SELECT source_dataset, 'ordinary' AS category, arg_min(clip_id, (abs(dur-5.0), -coalesce(risk_score, 0), clip_id)) AS clip_id FROM pool WHERE NOT warned AND n_codes = 1 GROUP BY 1),
c2 AS (SELECT source_dataset, 'warning' AS category, arg_min(clip_id, (abs(dur-5.0), -coalesce(risk_score, 0), clip_id)) AS clip_id FROM pool WHERE warned AND clip_id NOT IN (SELECT clip_id FROM c1) GROUP BY 1),
c3 AS (SELECT source_dataset, 'label-ambiguous' AS category, arg_min(clip_id, (abs(dur-5.0), -coalesce(risk_score, 0), clip_id)) AS clip_id FROM pool WHERE n_codes <> 1 AND clip_id NOT IN (SELECT clip_id FROM c1 UNION SELECT clip_id FROM c2) GROUP BY 1),
c4 AS (SELECT source_dataset, 'high-risk' AS category, arg_min(clip_id, (-coalesce(risk_score, 0), dur, clip_id)) AS clip_id FROM pool WHERE clip_id NOT IN (SELECT clip_id FROM c1 UNION SELECT clip_id FROM c2 UNION SELECT clip_id FROM c3) GROUP BY 1)"""


def sampled(spark, d):
    rows = review_rows(spark, d).withColumns({
        "duration_s": F.col("n_chars") % 500 / 10.0 + F.when(F.col("source_dataset") == "src6", 40.0).otherwise(0.0),
        "warnings": F.coalesce("warnings", F.array().cast("array<string>")), "risk_score": F.coalesce("risk_score", F.lit(0.0))})
    return V.choose_samples(rows, source="source_dataset", key="clip_id")


@query("w14_choose_samples", _SAMP + " FROM c1 UNION ALL FROM c2 UNION ALL FROM c3 UNION ALL FROM c4")
def w14(spark, d):
    return sampled(spark, d)


_CAT = """CASE doc_id % 4 WHEN 0 THEN 'ordinary' WHEN 1 THEN 'warning' WHEN 2 THEN 'label-ambiguous' ELSE 'high-risk' END"""


def categorised(spark, d):
    i = F.col("doc_id") % 4
    cat = F.when(i == 0, "ordinary").when(i == 1, "warning").when(i == 2, "label-ambiguous").otherwise("high-risk")
    return read(spark, d, "documents").select("doc_id", cat.alias("category"), "source")


@query("w15_choose_pilot", f"""
WITH r AS (SELECT doc_id, {_CAT} AS category, source, row_number() OVER (PARTITION BY {_CAT} ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS n FROM documents),
c AS (SELECT * FROM r WHERE n <= 3), ok AS (SELECT bool_or(source IN ('src19')) AS ok FROM c),
s AS (SELECT * FROM r WHERE source = 'src19' ORDER BY category <> 'high-risk', doc_id LIMIT 1)
SELECT doc_id, category, source FROM c, ok WHERE ok OR NOT (category = (SELECT category FROM s) AND n = 3)
UNION ALL SELECT doc_id, category, source FROM s, ok WHERE NOT ok""")
def w15(spark, d):
    return V.choose_pilot(categorised(spark, d), key="doc_id", category="category", source="source", per_category=3, required=["src19"])


@query("w15_pilot_violations", f"""
WITH r AS (SELECT doc_id, {_CAT} AS category, source, row_number() OVER (PARTITION BY {_CAT} ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS n FROM documents WHERE doc_id % 4 < 3),
c AS (SELECT category, count(*) AS n FROM r WHERE n <= 3 GROUP BY 1)
SELECT 'too-few-rows' AS rule, x AS key, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM (SELECT unnest(['ordinary', 'warning', 'label-ambiguous', 'high-risk']) AS x) LEFT JOIN c ON category = x WHERE coalesce(n, 0) < 3
UNION ALL SELECT 'required-source-missing', 'src77', '0'""")
def w15_violations(spark, d):
    """An index without one category and without the required source is refused."""
    rows = categorised(spark, d).where("category <> 'high-risk'")
    chosen = V.choose_pilot(rows, key="doc_id", category="category", source="source", per_category=3, required=["src77"])
    return V.pilot_violations(chosen, category="category", source="source", per_category=3, required=["src77"])


@query("t08_category_order", f"SELECT doc_id, category, CAST(list_position(['ordinary', 'warning', 'label-ambiguous', 'high-risk'], category) AS BIGINT) AS category_rank FROM (SELECT doc_id, {_CAT} AS category FROM documents)")
def t08(spark, d):
    return V.category_order(categorised(spark, d), category="category", key="doc_id").select("doc_id", "category", F.col("category_rank").cast("bigint").alias("category_rank"))
