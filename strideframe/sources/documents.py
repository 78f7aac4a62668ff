"""Text, JSON and CSV sources."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.operators.checks import duplicates, finite, violation


# --- S04 ------------------------------------------------------------------------------

def motion_text(df: DataFrame, *, key: str, text: str) -> DataFrame:
    """Motion section of a hierarchical motion file as (key, frame, column, value) rows."""
    body = F.split_part(F.col(text), F.lit("\nMOTION\n"), F.lit(2))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.trim(x)) > 0)
    frames = df.select(key, lines.alias("_l")).select(key, F.posexplode(F.slice("_l", F.lit(3), F.greatest(F.size("_l") - 2, F.lit(0)))).alias("frame", "_t"))
    cells = frames.select(key, "frame", F.posexplode(F.split(F.trim("_t"), r"\s+")).alias("column", "_v"))
    return cells.select(key, "frame", "column", F.expr("try_cast(_v as double)").alias("value"))


def motion_text_rules(df: DataFrame, long: DataFrame, *, key: str, text: str) -> DataFrame:
    """Declared frame count, one width for all frames, finite values."""
    declared = df.select(key, F.expr(f"try_cast(regexp_extract({text}, 'Frames:\\\\s*(\\\\d+)', 1) as bigint)").alias("_n"))
    per = long.groupBy(key, "frame").agg(F.count(F.lit(1)).alias("_w"), F.count_if(~finite(F.col("value"))).alias("_bad"))
    agg = per.groupBy(key).agg(F.count(F.lit(1)).alias("_f"), F.min("_w").alias("_lo"), F.max("_w").alias("_hi"), F.sum("_bad").alias("_bad"))
    rows = declared.join(agg, key, "left")
    rule = F.explode(F.array_compact(F.array(
        F.when(~(F.coalesce("_f", F.lit(0)) == F.coalesce("_n", F.lit(-1))), "frame-count"),
        F.when(F.col("_lo") != F.col("_hi"), "frame-width"), F.when(F.col("_bad") > 0, "nonfinite"))))
    return rows.select(rule.alias("rule"), F.col(key).cast("string").alias("key"), F.coalesce("_f", F.lit(0)).cast("string").alias("detail"))


def hierarchy(df: DataFrame, *, key: str, text: str) -> DataFrame:
    """Joints of the hierarchy section in file order: name, offset and channels.

    Files are small and independent; a joint's parent is the nearest joint above it that
    is one brace level higher.
    """
    head = F.split_part(F.col(text), F.lit("\nMOTION\n"), F.lit(1))
    block = F.regexp_extract_all(head, F.lit(r"(?:ROOT|JOINT)\s+\S+\s*\{\s*OFFSET\s+\S+\s+\S+\s+\S+\s+CHANNELS\s+\d+[^\n]*"), F.lit(0))
    rows = df.select(key, F.posexplode(block).alias("joint", "_b"))
    nums = F.regexp_extract_all("_b", F.lit(r"OFFSET\s+(\S+\s+\S+\s+\S+)"), F.lit(1))
    return rows.select(key, "joint", F.regexp_extract("_b", r"(?:ROOT|JOINT)\s+(\S+)", 1).alias("name"),
                       F.transform(F.split(F.get(nums, F.lit(0)), r"\s+"), lambda x: x.cast("double")).alias("offset"),
                       F.split(F.trim(F.regexp_extract("_b", r"CHANNELS\s+\d+([^\n]*)", 1)), r"\s+").alias("channels"))


# --- S05 -----------------------------------------------------------------------------------

class _Repeated(ValueError):
    pass


def _pairs(pairs):
    if len({k for k, _ in pairs}) != len(pairs):
        raise _Repeated
    return dict(pairs)


@F.pandas_udf(T.BooleanType())
def repeated_keys(texts: pd.Series) -> pd.Series:
    """True where an object of the document names a key twice."""
    def check(t):
        try:
            json.loads(t, object_pairs_hook=_pairs)
        except _Repeated:
            return True
        except (TypeError, ValueError):
            return False
        return False
    return texts.map(check)


def strict_json(df: DataFrame, *, text: str, schema: str, numbers: list[str]) -> DataFrame:
    """Decoded record and `ok`, `malformed`, `duplicate-key` or `nonfinite`."""
    full = f"{schema}, _corrupt string"
    rec = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"})
    rows = df.withColumn("record", rec).withColumn("_dup", repeated_keys(F.col(text)))
    wild = F.lit(False)
    for n in numbers:
        v = F.col("record")[n]
        wild = wild | F.coalesce(v.isNotNull() & ~finite(v), F.lit(False))
    wild = wild | F.col(text).rlike(r":\s*-?(NaN|Infinity)\b")
    state = (F.when(F.col("_dup"), "duplicate-key").when(wild, "nonfinite")
             .when(F.col("record").isNull() | F.col("record._corrupt").isNotNull(), "malformed").otherwise("ok"))
    return rows.withColumn("state", state).drop("_dup")


# --- S06, S07, S08, S09, S12 ------------------------------------------------------------------

def document_directory(spark: SparkSession, path: str, schema: str, *, tag: str, keep: str) -> DataFrame:
    """JSON documents of a folder: feed files are skipped, one schema tag is kept."""
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    return df.where(~F.col("_metadata.file_path").rlike(r"\.feed\.json(/|$)")).where(F.col(tag) == keep)


def unique_documents(docs: DataFrame, *, key: str) -> DataFrame:
    """The documents, or an error if an identity is there twice."""
    from strideframe.operators.checks import duplicates
    return validated(docs, duplicates(docs, [key], "duplicate-identity"))


def participant_csv(spark: SparkSession, path: str, *, key: str, domain_column: str, domain: list[str]) -> DataFrame:
    """CSV with a header: trimmed lower-case key columns and a domain check column."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip().lower() for c in df.columns])
    value = F.lower(F.trim(domain_column))
    return df.withColumns({key: F.trim(key), domain_column: value, "in_domain": F.coalesce(value.isin(domain), F.lit(False))})


def resumable_append(existing: DataFrame, incoming: DataFrame, *, key: str, inputs: str) -> DataFrame:
    """`append`, `skip` (already present, same inputs) or `conflict` for each incoming row."""
    old = existing.select(key, F.col(inputs).alias("_old"))
    return incoming.join(old, key, "left").withColumn("action", F.when(F.col("_old").isNull(), "append").when(
        F.col("_old") == F.col(inputs), "skip").otherwise("conflict")).drop("_old")


def validated(df: DataFrame, violations: DataFrame) -> DataFrame:
    """The frame, once its checks return no rows."""
    first = violations.limit(1).collect()
    if first:
        raise ValueError(f"contract violation: {first[0]['rule']} {first[0]['key']}")
    return df


def published_clips(ledger: DataFrame, *, config_sha256: str) -> DataFrame:
    """Published rows of the ledger whose frozen configuration is the expected one."""
    return ledger.where((F.col("config_sha256") == config_sha256) & (F.col("status") == "published"))


def duplicate_identities(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicates(df, keys, "duplicate-identity")


# --- S15 ---------------------------------------------------------------------------------------

LAYOUT = ("schema string, layout_id string, description string, status string, mounts array<struct<id:string,"
          "joint:string,position_joint_m:array<double>,quaternion_joint_from_sensor_wxyz:array<double>>>")
PROFILE = ("schema string, profile_id string, description string, output_hz int, work_hz int, lowpass_hz double, "
           "gravity_m_s2 double, boundary_guard_s double, work_grid_policy string")


def layout_mounts(spark: SparkSession, path: str) -> DataFrame:
    """Mounts of a layout file, one row each."""
    doc = spark.read.schema(LAYOUT).option("multiLine", True).json(path)
    return doc.select("layout_id", F.explode("mounts").alias("m")).select(
        "layout_id", F.col("m.id").alias("mount"), F.col("m.joint").alias("joint"), F.col("m.position_joint_m").alias("offset"),
        F.col("m.quaternion_joint_from_sensor_wxyz").alias("q"))


def layout_rules(mounts: DataFrame, joints: list[str]) -> DataFrame:
    """Mount ids are unique, joints known, transforms sound."""
    from strideframe.operators.checks import record_rules
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda a, x: a + x * x))
    return record_rules(mounts, F.col("mount"), {
        "mount-joint": (F.col("joint").isin(joints), F.col("joint")),
        "mount-offset": (F.size("offset") == 3, F.size("offset")),
        "mount-rotation": ((F.size("q") == 4) & (F.abs(norm - 1) <= 1e-8), norm)}).unionByName(
        duplicates(mounts, ["layout_id", "mount"], "duplicate-mount"))


def profile_rules(profiles: DataFrame) -> DataFrame:
    """Rates, filter limit, gravity and guard of an ideal profile."""
    from strideframe.operators.checks import record_rules
    samples = F.col("boundary_guard_s") * F.col("output_hz")
    return record_rules(profiles, F.col("profile_id"), {
        "profile-rates": ((F.col("output_hz") > 0) & (F.col("work_hz") >= 4 * F.col("output_hz")), F.col("work_hz")),
        "profile-lowpass": ((F.col("lowpass_hz") > 0) & (F.col("lowpass_hz") < F.col("output_hz") / 2), F.col("lowpass_hz")),
        "profile-gravity": (F.col("gravity_m_s2").between(9, 10), F.col("gravity_m_s2")),
        "profile-guard": (F.col("boundary_guard_s").between(0, 1) & (F.abs(samples - F.round(samples)) <= 1e-9), F.col("boundary_guard_s"))})
