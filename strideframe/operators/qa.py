"""Machine QA: warnings, risk, hard gates, pass rates, corpus rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.arrays import present
from strideframe.plans.barrier import evaluate_once

# Fixed policy and warning limits.
POLICY = {"minimum_corpus_pass_rate": 0.8, "minimum_source_pass_rate": 0.8, "paused_sources": [],
          "required_checks": ["structure", "trajectory", "sensor", "work_grid_convergence"],
          "require_boundary_guard_complete": True, "acceleration_rms_m_s2": 0.1, "angular_velocity_rms_rad_s": 0.02}
LIMITS = {"root_speed": 12.0, "joint_speed": 35.0, "force": 100.0, "gyro": 25.0}
HIGH_RISK = 0.7
NO_TEXT = "cast(array() as array<string>)"


def warnings_and_risk(df: DataFrame, *, peaks: dict[str, str], limits: dict[str, float] = LIMITS) -> DataFrame:
    """F16: advisory warnings in fixed order and the risk in [0, 1].

    `peaks` maps root_speed / joint_speed / force / gyro to a column; absent ones are skipped.
    """
    names = {"root_speed": "root-speed-outlier", "joint_speed": "joint-speed-outlier",
             "force": "specific-force-outlier", "gyro": "angular-velocity-outlier"}
    flags = [F.when(F.col(peaks[k]) > limits[k], n) for k, n in names.items() if k in peaks]
    warn = present(*flags)
    load = sum((F.col(peaks[k]) / limits[k] for k in ("force", "gyro") if k in peaks), F.lit(0.0))
    return df.withColumn("warnings", warn).withColumn(
        "risk_score", F.least(F.lit(1.0), (load + 0.5 * F.size("warnings")) / 2))


def gate(df: DataFrame, *, policy: dict = POLICY, lineage: Column | None = None) -> DataFrame:
    """hard gates only.

    Needs a map column `checks` (check name -> pass, null map = no QA), `guard_complete`,
    `acceleration_rms_m_s2`, `angular_velocity_rms_rad_s`.  Limits are compared with the raw
    values; the stored convergence flag is ignored. Checks and reasons are worked out once a row.
    """
    df = _once(df, "checks")
    checks = F.col("checks")
    found = []
    known = F.map_keys(checks)
    for name in policy["required_checks"]:
        there = F.coalesce(F.array_contains(known, name), F.lit(False))
        failed = F.lit(name != "work_grid_convergence") & ~F.coalesce(F.try_element_at(checks, F.lit(name)), F.lit(False))
        found.append(F.when(~there, f"hard-check-missing:{name}").when(failed, f"hard-check-failed:{name}"))
    if policy["require_boundary_guard_complete"]:
        found.append(F.when(~F.coalesce("guard_complete", F.lit(False)), "boundary-guard-incomplete"))
    for name in ("acceleration_rms_m_s2", "angular_velocity_rms_rad_s"):
        value = F.col(name)
        found.append(F.when(value.isNull() | F.isnan(value) | (value > policy[name]), f"convergence-limit:{name}"))
    missing, listed = F.array(F.lit("qa-missing")), present(*found)
    if lineage is not None:
        missing, listed = (F.array_distinct(F.concat(lineage, x)) for x in (missing, listed))
    out = _once(df.withColumn("reasons", F.sort_array(F.when(checks.isNull(), missing).otherwise(listed))), "reasons")
    return out.withColumn("passed", F.size("reasons") == 0)


def _once(df: DataFrame, name: str) -> DataFrame:
    """A costly column that many expressions read, computed once a row; all others stay visible to pushdown."""
    return evaluate_once(df, *[c for c in df.columns if c != name])


def risk_tier(risk: Column) -> Column:
    """unknown for null, and null outside [0, 1]."""
    return (F.when(risk.isNull(), "unknown").when((risk < 0) | (risk > 1) | F.isnan(risk), None)
            .when(risk >= HIGH_RISK, "high").otherwise("ordinary"))


def source_rates(clips: DataFrame, *, source: str, policy: dict = POLICY) -> DataFrame:
    """Pass counts and rate per source; quarantine only comes from the pause list."""
    return clips.groupBy(source).agg(
        F.count(F.lit(1)).alias("clips"), F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed")).withColumns({
            "pass_rate": F.col("passed") / F.col("clips"),
            "quarantined": F.col(source).isin(policy["paused_sources"]) if policy["paused_sources"] else F.lit(False)})


def exclusion(clips: DataFrame, *, source: str, policy: dict = POLICY) -> DataFrame:
    """Add the quarantine reason and whether the clip is excluded."""
    paused = F.col(source).isin(policy["paused_sources"]) if policy["paused_sources"] else F.lit(False)
    reasons = F.sort_array(F.array_distinct(F.concat("reasons", F.when(
        paused, F.array(F.lit("source-quarantined"))).otherwise(F.expr(NO_TEXT)))))
    return _once(clips.withColumn("reasons", reasons), "reasons").withColumn("excluded", F.size("reasons") > 0)


def reason_histogram(rows: DataFrame, *, reasons: str = "reasons") -> DataFrame:
    """Rows per distinct reason."""
    return rows.select(F.explode(F.array_distinct(reasons)).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows"))


def warning_histogram(rows: DataFrame, *, source: str, flags: str) -> DataFrame:
    """Flag counts per source and overall in one pass."""
    long = rows.select(source, F.explode(F.array_distinct(flags)).alias("flag"))
    return long.groupingSets([[source, "flag"], ["flag"], []], source, "flag").agg(F.count(F.lit(1)).alias("rows"))


def corpus_statistics(clips: DataFrame, *, policy: dict = POLICY) -> DataFrame:
    """One row of corpus counts; a low rate never blocks publication."""
    published = F.count_if(~F.col("excluded"))
    total = F.count(F.lit(1))
    return clips.agg(
        total.alias("total_clips"), F.count_if("passed").alias("machine_passed_before_quarantine"),
        published.alias("published_candidates"),
        F.coalesce(published / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("candidate_rate"),
        F.lit(True).alias("publishable"),
        F.lit(policy["minimum_corpus_pass_rate"]).alias("minimum_corpus_pass_rate"))


def rate_alerts(planned: DataFrame, clips: DataFrame, *, source: str, status: str = "status", policy: dict = POLICY) -> DataFrame:
    """Complete sources whose passed part of the plan is below the minimum, and the corpus once every source is complete.

    `planned` has a row per planned clip. A source is complete when each of them is settled in `clips` (published, ready-local or excluded);
    published and ready-local ones have passed.
    """
    done = clips.groupBy(source).agg(F.count_if(F.col(status).isin("published", "ready-local", "excluded")).alias("settled"),
                                     F.count_if(F.col(status).isin("published", "ready-local")).alias("passed"))
    per = planned.groupBy(source).agg(F.count(F.lit(1)).alias("clips")).join(done, source, "left").na.fill(0, ["settled", "passed"])
    rate = F.col("passed") / F.col("clips")
    rows = per.where("settled >= clips").select(F.col(source).alias("scope"), "clips", "passed", rate.alias("pass_rate")).where(
        F.col("pass_rate") < policy["minimum_source_pass_rate"])
    corpus = per.agg(F.sum("clips").alias("clips"), F.sum("passed").alias("passed"), F.bool_and(F.col("settled") >= F.col("clips")).alias("_all")).where("_all").select(
        F.lit("*corpus*").alias("scope"), "clips", "passed", rate.alias("pass_rate")).where(
        F.col("pass_rate") < policy["minimum_corpus_pass_rate"])
    return rows.unionByName(corpus)


def study_report(rows: DataFrame) -> DataFrame:
    """Completeness, pass and review state of a study, one row."""
    reviewed = F.count_if(F.col("decision").isin("accepted", "rejected"))
    accepted = F.count_if(F.col("decision") == "accepted")
    total = F.count(F.lit(1))
    return rows.agg(
        F.bool_and(F.coalesce("complete", F.lit(False))).alias("all_complete"), F.bool_and(F.coalesce("passed", F.lit(False))).alias("all_passed"),
        total.alias("clips"), reviewed.alias("reviewed"), accepted.alias("accepted"),
        F.when(reviewed == 0, "unreviewed").when(accepted == total, "accepted").otherwise("partial").alias("review_status"))
