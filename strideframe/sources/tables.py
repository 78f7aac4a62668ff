"""Declared schemas and readers; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.session import configure

# Driver tables.
DRIVER = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Engine tables (the motion data model).
LABEL = ("struct<kind:string,code:string,raw_label:string,categories:array<string>,"
         "start_time_s:double,stop_time_s:double,origin:string,release_set:string,annotation_set:int>")
ENGINE = {
    "clips": "clip_id string, motion_id string, source_dataset string, source_member string, "
             "source_gender string, source_fps_hz double, clock_num bigint, clock_den bigint, "
             "betas array<double>",
    "frames": "clip_id string, frame bigint, time_ns bigint, root array<double>, "
              "joints array<array<double>>, dmpls array<double>, valid boolean",
    "signals": "clip_id string, mount string, sample bigint, time_ns bigint, ax double, ay double, "
               "az double, gx double, gy double, gz double, valid boolean",
    "samples": "sequence_index int, sample bigint, acceleration_x_mps2 float, acceleration_y_mps2 float, "
               "acceleration_z_mps2 float, angular_velocity_x_rad_s float, "
               "angular_velocity_y_rad_s float, angular_velocity_z_rad_s float",
    "sequences": "sequence_index int, sample_start bigint, sample_stop bigint, source_file string, "
                 "participant_id string, recording_id string, body_location string, "
                 "activity_code string, is_fall boolean, supervision_kind string, "
                 "source_sampling_rate_hz double",
    "annotations": "sequence_index int, kind string, start_sample bigint, stop_sample bigint, code string",
    "catalog": "taxonomy_id string, taxonomy_version string, code string, name string, "
               "is_fall boolean, active boolean",
    "sequence_versions": "sequence_index int, taxonomy_id string, taxonomy_version string",
    "weak_index": "sequence_index int, state string, code string, rule_id string",
    "candidate_index": "sequence_index int, candidate_id string, version_id string, "
                       "commit_sha256 string, source_dataset string",
    "rules": "rule_id string, origin string, source_value string, source_dataset string, "
             "target_code string, is_fall boolean, revision int",
    "plan_clips": "clip_id string, source_dataset string, source_member string, expected_gender string, "
                  f"expected_frames int, frame_start int, frame_stop int, label_candidates array<{LABEL}>",
}


def read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One driver table with its declared schema."""
    configure(spark)
    return spark.read.schema(DRIVER[name]).parquet(f"{directory}/{name}.parquet")


def read_artifact(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One engine table with its declared schema."""
    configure(spark)
    return spark.read.schema(ENGINE[kind]).parquet(path)


def micros(ts):
    """Microseconds since the epoch of a zone-less UTC timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def events(spark: SparkSession, directory: str) -> DataFrame:
    """Events with an integer time axis `us`."""
    df = read(spark, directory, "events")
    return df.withColumn("us", micros(F.col("ts")))
