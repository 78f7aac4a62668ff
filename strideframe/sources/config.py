"""Extension points as data: policies, rules, presets and skeleton mappings in JSON files.

They are small versioned documents; each loader returns a table (or the one policy row)
that the operators join or read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.operators.checks import CODE, duplicates, record_rules, violation

POLICY = ("schema string, policy_id string, minimum_corpus_pass_rate double, minimum_source_pass_rate double, "
          "paused_sources array<string>, required_checks array<string>, convergence struct<"
          "require_boundary_guard_complete:boolean,acceleration_rms_max_m_s2:double,angular_velocity_rms_max_rad_s:double>")
RULES = ("schema string, revision int, rules array<struct<rule_id:string,origin:string,source_value:string,"
         "source_dataset:string,target_code:string,is_fall:boolean>>")
PRESETS = ("schema string, revision int, babel_families array<struct<code:string,aliases:array<string>,modifiers:array<string>>>, "
           "babel_codes map<string,string>, stageii_codes map<string,map<string,string>>, member_tokens map<string,array<string>>")
MAPPING = ("schema string, adapter_id string, description string, position_scale_m double, "
           "world_from_source_matrix array<array<double>>, joint_map map<string,string>")
KNOWN_CHECKS = ["structure", "trajectory", "sensor", "work_grid_convergence"]


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def policy_rules(doc: DataFrame) -> DataFrame:
    """Policy checks: rates in (0, 1], known distinct checks, limits not negative."""
    rate = lambda c: (F.col(c) > 0) & (F.col(c) <= 1)
    paused = F.coalesce("paused_sources", F.array().cast("array<string>"))
    return record_rules(doc, F.col("policy_id"), {
        "corpus-rate": (rate("minimum_corpus_pass_rate"), F.col("minimum_corpus_pass_rate")),
        "source-rate": (rate("minimum_source_pass_rate"), F.col("minimum_source_pass_rate")),
        "paused-sources": (F.size(F.array_distinct(paused)) == F.size(paused), F.lit("")),
        "required-checks": ((F.size("required_checks") > 0) & (F.size(F.array_distinct("required_checks")) == F.size("required_checks"))
                            & (F.size(F.array_except("required_checks", F.array(*map(F.lit, KNOWN_CHECKS)))) == 0), F.lit("")),
        "limits": ((F.col("convergence.acceleration_rms_max_m_s2") >= 0) & (F.col("convergence.angular_velocity_rms_max_rad_s") >= 0), F.lit(""))})


def load_policy(spark: SparkSession, path: str) -> dict:
    """The policy of `qa.gate` from a file."""
    row = _document(spark, path, POLICY).first()
    c = row["convergence"]
    return {"policy_id": row["policy_id"], "minimum_corpus_pass_rate": row["minimum_corpus_pass_rate"],
            "minimum_source_pass_rate": row["minimum_source_pass_rate"], "paused_sources": list(row["paused_sources"] or []),
            "required_checks": list(row["required_checks"]), "require_boundary_guard_complete": c["require_boundary_guard_complete"],
            "acceleration_rms_m_s2": c["acceleration_rms_max_m_s2"], "angular_velocity_rms_rad_s": c["angular_velocity_rms_max_rad_s"]}


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Weak-label rules with the revision of their document."""
    doc = _document(spark, path, RULES)
    return doc.select("revision", F.explode("rules").alias("r")).select("r.*", "revision")


def load_presets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four preset tables that `labels.compile_rules` takes."""
    doc = _document(spark, path, PRESETS)
    nested = doc.select(F.explode("stageii_codes").alias("dataset", "m"))
    return {
        "families": doc.select(F.explode("babel_families").alias("f")).select("f.*"),
        "codes": doc.select(F.explode("babel_codes").alias("source", "target")),
        "stageii": nested.select("dataset", F.explode("m").alias("source", "target")),
        "tokens": doc.select(F.explode("member_tokens").alias("target", "t")).select("target", F.explode("t").alias("token")),
    }


def token_rules(tokens: DataFrame) -> DataFrame:
    """Tokens are letters and belong to one target; targets are safe codes."""
    return record_rules(tokens, F.col("token"), {
        "token": (F.col("token").rlike("^[a-z]+$"), F.col("token")), "target": (F.col("target").rlike(CODE), F.col("target"))}).unionByName(
        duplicates(tokens, ["token"], "duplicate-token"))


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Source joint names and their target joints."""
    return _document(spark, path, MAPPING).select(
        "adapter_id", "position_scale_m", F.explode("joint_map").alias("source_joint", "target_joint"))


def mapping_rules(mapping: DataFrame, joints: list[str]) -> DataFrame:
    """Targets are known and used once."""
    unknown = mapping.where(~F.col("target_joint").isin(joints)).select(
        *violation("unknown-joint", F.col("source_joint"), F.col("target_joint")))
    return unknown.unionByName(duplicates(mapping, ["target_joint"], "joint-mapped-twice"))
