"""Machine gate queries, the flagship among them."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings.common import CLIP, E, ORDER, SERIES, rounded, signal
from strideframe.bindings.registry import query
from strideframe.bindings.signals import PEAKS_SQL
from strideframe.operators import qa as Q
from strideframe.operators import signals as S
from strideframe.session import work_dir
from strideframe.sources import config
from strideframe.sources.tables import read

GATE_LIMITS = {**Q.LIMITS, "root_speed": 0.05, "force": 200.0}
GATE_POLICY = {**Q.POLICY, "acceleration_rms_m_s2": 330.0, "angular_velocity_rms_rad_s": 1e9, "paused_sources": [3]}


@query("a01_machine_gate", E + PEAKS_SQL + """
, w AS (SELECT *, (CASE WHEN peak_speed > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN peak_value > 200 THEN 1 ELSE 0 END) AS n FROM pk),
r AS (SELECT user_id % 10 AS stratum, all_valid AND samples >= 60 AND NOT peak_value > 330 AS passed, least(1.0, (peak_value/200.0 + 0.5*n)/2) AS risk, n FROM w)
SELECT stratum, count(*) AS clips, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
 round(count(*) FILTER (WHERE passed) / count(*), 6) AS pass_rate, stratum = 3 AS quarantined FROM r GROUP BY stratum""")
def a01(spark, d):
    """Signal peaks per clip -> warnings and risk -> hard gate -> pass rate per stratum."""
    return rounded(Q.source_rates(gated(spark, d), source="stratum", policy=GATE_POLICY), "pass_rate")


def gated(spark, d):
    clips = S.clip_peaks(signal(spark, d), clip=CLIP, series=SERIES, order=ORDER, value="value", time_us="us")
    risky = Q.warnings_and_risk(clips, peaks={"root_speed": "peak_speed", "force": "peak_value"}, limits=GATE_LIMITS)
    ok = F.col("all_valid")
    checks = F.create_map(F.lit("structure"), ok & (F.col("samples") >= 60), F.lit("trajectory"), F.col("peak_speed").isNotNull(),
                          F.lit("sensor"), F.col("peak_value").isNotNull(), F.lit("work_grid_convergence"), F.lit(True))
    rows = risky.withColumns({"stratum": F.col("user_id") % 10, "checks": checks, "guard_complete": F.lit(True),
                              "acceleration_rms_m_s2": F.col("peak_value"), "angular_velocity_rms_rad_s": F.col("peak_speed")})
    return Q.gate(rows, policy=GATE_POLICY)


@query("a03_warning_histogram", E + PEAKS_SQL + """
, f AS (SELECT user_id % 10 AS stratum, unnest(list_filter([CASE WHEN peak_speed > 0.05 THEN 'root-speed-outlier' END,
 CASE WHEN peak_value > 200 THEN 'specific-force-outlier' END], lambda x: x IS NOT NULL)) AS flag FROM pk)
SELECT stratum, coalesce(flag, '*') AS flag, count(*) AS rows FROM f GROUP BY GROUPING SETS ((stratum, flag), (flag), ())""")
def a03(spark, d):
    out = Q.warning_histogram(gated(spark, d), source="stratum", flags="warnings")
    return out.withColumn("flag", F.coalesce("flag", F.lit("*")))


# Line items as clips: quantity and price stand for peaks and convergence values.
_LI = """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag AS src,
 CASE WHEN l_tax = 0.08 THEN NULL ELSE l_discount END AS acc, l_tax AS gyro, l_quantity <> 13 AS structure, l_linenumber <> 6 AS has_sensor, l_linenumber = 7 AS no_qa, l_quantity > 3 AS guard FROM lineitem),
r AS (SELECT *, list_sort(list_distinct(CASE WHEN no_qa THEN ['qa-missing'] ELSE list_filter([
 CASE WHEN NOT structure THEN 'hard-check-failed:structure' END, CASE WHEN NOT has_sensor THEN 'hard-check-missing:sensor' END,
 CASE WHEN NOT guard THEN 'boundary-guard-incomplete' END, CASE WHEN acc IS NULL OR acc > 0.08 THEN 'convergence-limit:acceleration_rms_m_s2' END,
 CASE WHEN gyro > 0.06 THEN 'convergence-limit:angular_velocity_rms_rad_s' END], lambda x: x IS NOT NULL) END)) AS reasons FROM c),
g AS (SELECT *, len(reasons) = 0 AS passed, list_sort(CASE WHEN src = 'N' THEN list_append(reasons, 'source-quarantined') ELSE reasons END) AS why FROM r)"""
LI_POLICY = {**Q.POLICY, "acceleration_rms_m_s2": 0.08, "angular_velocity_rms_rad_s": 0.06, "paused_sources": ["N"]}


def line_clips(spark, d, policy=None):
    yes = F.lit(True)
    checks = F.map_from_arrays(
        F.array_compact(F.array(F.lit("structure"), F.lit("trajectory"), F.when(F.col("l_linenumber") != 6, "sensor"), F.lit("work_grid_convergence"))),
        F.array_compact(F.array(F.col("l_quantity") != 13, yes, F.when(F.col("l_linenumber") != 6, yes), yes)))
    c = read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_returnflag").alias("src"),
        F.when(F.col("l_linenumber") != 7, checks).alias("checks"), (F.col("l_quantity") > 3).alias("guard_complete"),
        F.when(F.col("l_tax") != 0.08, F.col("l_discount")).alias("acceleration_rms_m_s2"), F.col("l_tax").alias("angular_velocity_rms_rad_s"))
    return Q.gate(c, policy=policy or LI_POLICY)


@query("f15_gate", _LI + " SELECT l_orderkey, l_linenumber, l_partkey, passed, array_to_string(reasons, ',') AS reasons FROM g")
def f15(spark, d):
    return line_clips(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "passed", F.array_join("reasons", ",").alias("reasons"))


@query("x05_policy_from_file", _LI + " SELECT l_orderkey, l_linenumber, l_partkey, passed, array_to_string(reasons, ',') AS reasons FROM g")
def x05(spark, d):
    """The same gate under a policy that was written to and loaded from a file."""
    p, folder = LI_POLICY, work_dir(spark, "policy")
    row = {"schema": "policy.v1", "policy_id": "lines", "minimum_corpus_pass_rate": p["minimum_corpus_pass_rate"], "minimum_source_pass_rate": p["minimum_source_pass_rate"],
           "paused_sources": p["paused_sources"], "required_checks": p["required_checks"], "convergence": {
               "require_boundary_guard_complete": p["require_boundary_guard_complete"], "acceleration_rms_max_m_s2": p["acceleration_rms_m_s2"],
               "angular_velocity_rms_max_rad_s": p["angular_velocity_rms_rad_s"]}}
    spark.createDataFrame([row], config.POLICY).coalesce(1).write.json(folder)
    clips = line_clips(spark, d, config.load_policy(spark, folder))
    return clips.select("l_orderkey", "l_linenumber", "l_partkey", "passed", F.array_join("reasons", ",").alias("reasons"))


@query("a02_reason_histogram", _LI + " SELECT reason, count(*) AS rows FROM (SELECT unnest(why) AS reason FROM g) GROUP BY reason")
def a02(spark, d):
    return Q.reason_histogram(Q.exclusion(line_clips(spark, d), source="src", policy=LI_POLICY))


@query("k10_corpus_rows", _LI + """
SELECT l_orderkey, l_linenumber, l_partkey, src, len(why) > 0 AS excluded, array_to_string(why, ',') AS reasons FROM g""")
def k10(spark, d):
    """Candidate and excluded rows of the corpus document."""
    out = Q.exclusion(line_clips(spark, d), source="src", policy=LI_POLICY)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "src", "excluded", F.array_join("reasons", ",").alias("reasons"))


@query("a05_corpus_statistics", """
WITH c AS (SELECT d.doc_id, d.source, coalesce(quality = 1, false) AS passed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT count(*) AS total_clips, count(*) FILTER (WHERE passed) AS machine_passed_before_quarantine,
 count(*) FILTER (WHERE passed AND source <> 'src2') AS published_candidates, round(count(*) FILTER (WHERE passed AND source <> 'src2') / count(*), 6) AS candidate_rate,
 true AS publishable, 0.8::DOUBLE AS minimum_corpus_pass_rate FROM c""")
def a05(spark, d):
    clips = Q.exclusion(document_clips(spark, d), source="source", policy={**Q.POLICY, "paused_sources": ["src2"]})
    return rounded(Q.corpus_statistics(clips), "candidate_rate")


def document_clips(spark, d):
    """Documents as clips; an unlabelled document has no report."""
    passed = F.coalesce(F.col("quality") == 1, F.lit(False))
    reason = F.when(F.col("quality").isNull(), F.array(F.lit("clip-report-missing"))).when(
        ~passed, F.array(F.lit("hard-check-failed:structure"))).otherwise(F.expr(Q.NO_TEXT))
    return read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", "source", "lang", "toxic", passed.alias("passed"), reason.alias("reasons"))


@query("a01_source_rates", """
WITH c AS (SELECT d.source, coalesce(quality = 1, false) AS passed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT source, count(*) AS clips, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
 round(count(*) FILTER (WHERE passed) / count(*), 6) AS pass_rate, source = 'src2' AS quarantined FROM c GROUP BY source""")
def a01_sources(spark, d):
    return rounded(Q.source_rates(document_clips(spark, d), source="source", policy={**Q.POLICY, "paused_sources": ["src2"]}), "pass_rate")


@query("a28_rate_alerts", """
WITH c AS (SELECT o_orderpriority AS source, o_orderstatus <> 'P' OR o_orderpriority <> '2-HIGH' AS settled, o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority < '4') AS passed FROM orders),
s AS (SELECT source AS scope, count(*) AS clips, count(*) FILTER (WHERE passed) AS passed, bool_and(settled) AS done FROM c GROUP BY source
 UNION ALL SELECT '*corpus*', count(*), count(*) FILTER (WHERE passed), bool_and(settled) FROM c)
SELECT scope, clips, passed, round(passed / clips, 6) AS pass_rate FROM s WHERE done AND passed / clips < CASE WHEN scope = '*corpus*' THEN 0.9 ELSE 0.8 END""")
def a28(spark, d):
    """Orders as clips; one priority has clips that are still pending, so neither it nor the corpus is judged."""
    o, s, p = read(spark, d, "orders"), F.col("o_orderstatus"), F.col("o_orderpriority")
    status = F.when((s == "P") & (p == "2-HIGH"), "pending-publish").when(s == "F", "published").when((s == "O") & (p < "4"), "ready-local").otherwise("excluded")
    planned = o.select(p.alias("source"))
    clips = o.select(p.alias("source"), status.alias("status"))
    return rounded(Q.rate_alerts(planned, clips, source="source", policy={**Q.POLICY, "minimum_corpus_pass_rate": 0.9}), "pass_rate")


@query("a28_settled_corpus", """
WITH c AS (SELECT o_orderstatus AS source, o_custkey % 10 < 5 AS passed FROM orders),
s AS (SELECT source AS scope, count(*) AS clips, count(*) FILTER (WHERE passed) AS passed FROM c GROUP BY source UNION ALL SELECT '*corpus*', count(*), count(*) FILTER (WHERE passed) FROM c)
SELECT scope, clips, passed, round(passed / clips, 6) AS pass_rate FROM s WHERE passed / clips < CASE WHEN scope = '*corpus*' THEN 0.9 ELSE 0.8 END""")
def a28_settled(spark, d):
    """Every clip settled: the corpus is judged as well."""
    o = read(spark, d, "orders")
    clips = o.select(F.col("o_orderstatus").alias("source"), F.when(F.col("o_custkey") % 10 < 5, "published").otherwise("excluded").alias("status"))
    return rounded(Q.rate_alerts(clips.select("source"), clips, source="source", policy={**Q.POLICY, "minimum_corpus_pass_rate": 0.9}), "pass_rate")


@query("a32_study_report", """
SELECT bool_and(toxic IS NOT NULL) AS all_complete, bool_and(quality = 1) AS all_passed, count(*) AS clips, count(*) FILTER (WHERE doc_id % 4 IN (1, 2)) AS reviewed,
 count(*) FILTER (WHERE doc_id % 4 = 2) AS accepted, CASE WHEN count(*) FILTER (WHERE doc_id % 4 IN (1, 2)) = 0 THEN 'unreviewed' WHEN count(*) FILTER (WHERE doc_id % 4 = 2) = count(*) THEN 'accepted' ELSE 'partial' END AS review_status FROM labels""")
def a32(spark, d):
    i = F.col("doc_id") % 4
    rows = read(spark, d, "labels").select(F.col("toxic").isNotNull().alias("complete"), (F.col("quality") == 1).alias("passed"),
                                           F.when(i == 3, "unreviewed").when(i == 2, "accepted").when(i == 1, "rejected").alias("decision"))
    return Q.study_report(rows)


@query("f16_warnings_and_risk", """
WITH w AS (SELECT *, list_filter([CASE WHEN l_discount > 0.08 THEN 'root-speed-outlier' END, CASE WHEN l_tax > 0.07 THEN 'joint-speed-outlier' END,
 CASE WHEN l_extendedprice > 90001 THEN 'specific-force-outlier' END, CASE WHEN l_quantity > 47 THEN 'angular-velocity-outlier' END], lambda x: x IS NOT NULL) AS w FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(w, ',') AS warnings, round(least(1.0, (l_extendedprice/90001.0 + l_quantity/47.0 + 0.5*len(w))/2), 6) AS risk_score FROM w""")
def f16(spark, d):
    out = Q.warnings_and_risk(read(spark, d, "lineitem"), limits={"root_speed": 0.08, "joint_speed": 0.07, "force": 90001.0, "gyro": 47.0},
                              peaks={"root_speed": "l_discount", "joint_speed": "l_tax", "force": "l_extendedprice", "gyro": "l_quantity"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("warnings", ",").alias("warnings"), F.round("risk_score", 6).alias("risk_score"))


@query("f17_risk_tier", """
WITH r AS (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 45.0 END AS risk FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN risk IS NULL THEN 'unknown' WHEN risk > 1 THEN NULL WHEN risk >= 0.7 THEN 'high' ELSE 'ordinary' END AS tier FROM r""")
def f17(spark, d):
    risk = F.when(F.col("l_linenumber") != 7, F.col("l_quantity") / 45.0)
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", Q.risk_tier(risk).alias("tier"))
