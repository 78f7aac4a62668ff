"""Corpus building: unions, deduplication, offsets, digests, publication sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strideframe.operators.checks import violation
from strideframe.plans.digests import ordered_digest
from strideframe.plans.ordered import Ordered


# --- U01, U02, U07 ------------------------------------------------------------------

def deduplicate(df: DataFrame, *, key: str, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row per key, and the keys whose fields disagree.

    Plain aggregates: copies of a hot key collapse on the map side.
    """
    s = F.struct(*fields)
    agg = df.groupBy(key).agg(F.min(s).alias("lo"), F.max(s).alias("hi"), F.count(F.lit(1)).alias("copies"))
    conflict = agg.where(~F.col("lo").eqNullSafe(F.col("hi"))).select(
        *violation("identity-conflict", F.col(key), F.col("copies")))
    return agg.select(key, "lo.*"), conflict


def merge_corpora(objects: list[DataFrame], candidates: list[DataFrame], excluded: list[DataFrame]):
    """Merged objects, candidates, excluded rows, and every conflict between the parts."""
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    merged, clash = deduplicate(union(objects), key="sha256", fields=["role", "byte_length", "object_key"])
    cand, exc = union(candidates), union(excluded)
    ids = cand.select("candidate_id").unionByName(exc.select("candidate_id"))
    twice = ids.groupBy("candidate_id").count().where("count > 1").select(
        *violation("candidate-conflict", F.col("candidate_id"), F.col("count")))
    return merged, cand, exc, clash.unionByName(twice)


def merged_statistics(candidates: DataFrame, excluded: DataFrame) -> DataFrame:
    n = candidates.select(F.lit(1).alias("c")).unionByName(excluded.select(F.lit(0).alias("c")))
    total = F.count(F.lit(1))
    return n.agg(total.alias("total_clips"), F.coalesce(F.sum("c"), F.lit(0)).alias("published_candidates"),
                 F.coalesce(F.sum("c") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("candidate_rate"))


def union_jobs(jobs: DataFrame, *, job: str, config: list[str], key: str, source: str) -> DataFrame:
    """Conflicts of a union of jobs: unequal config, ids or sources in two jobs."""
    configs = jobs.select(F.struct(*config).alias("c")).agg(
        (F.min("c") != F.max("c")).alias("differs")).where("differs").select(
        *violation("config-differs", F.lit("jobs"), F.array_join(F.array(*map(F.lit, config)), ",")))
    ids = jobs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        *violation("shared-id", F.col(key), F.col("n")))
    src = jobs.groupBy(source).agg(F.min(job).alias("a"), F.max(job).alias("b")).where("a <> b").select(
        *violation("shared-source", F.col(source), F.col("b")))
    return configs.unionByName(ids).unionByName(src)


# --- U03, U04, U05, U09 ------------------------------------------------------------------

def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows on one side only."""
    return (a.exceptAll(b).distinct().withColumn("side", F.lit("missing"))
            .unionByName(b.exceptAll(a).distinct().withColumn("side", F.lit("extra"))))


def partition_decisions(candidates: DataFrame, decisions: DataFrame, *, key: str) -> DataFrame:
    """Included, or excluded with `unreviewed` / `human-reject`."""
    rows = candidates.join(decisions.select(key, "decision"), key, "left")
    reason = F.when(F.col("decision").isNull(), "unreviewed").when(F.col("decision") == "reject", "human-reject")
    return rows.withColumn("reason", reason).withColumn("included", F.col("decision").eqNullSafe("pass"))


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys in both sets."""
    return a.intersect(b)


def expected_takes(participants: DataFrame, absent: DataFrame, *, focuses: list[str], activities: list[str]) -> DataFrame:
    """Participant x focus x activity minus known absences (two explodes of fixed lists)."""
    rows = participants.select("participant", F.explode(F.array(*map(F.lit, focuses))).alias("focus")).select(
        "participant", "focus", F.explode(F.array(*map(F.lit, activities))).alias("activity"))
    return rows.join(absent, ["participant", "focus", "activity"], "left_anti")


def take_availability(expected: DataFrame, files: DataFrame, *, suffixes: int) -> DataFrame:
    """Takes with all of their files, and the missing ones."""
    have = files.groupBy("participant", "focus", "activity").agg(F.count_distinct("suffix").alias("_n"))
    return expected.join(have, ["participant", "focus", "activity"], "left").select(
        "participant", "focus", "activity", (F.coalesce("_n", F.lit(0)) == suffixes).alias("available"))


# --- W16, W21, A30, F23, A35, F34 ------------------------------------------------------------

def running_offsets(df: DataFrame, *, order: list[str], length: str) -> DataFrame:
    """Global half-open ranges and ordinals from lengths, in a fixed order."""
    o = Ordered(df, [], order).running({"stop": F.col(length)}).position("ordinal").done()
    return o.withColumn("start", F.col("stop") - F.col(length))


def first_per_source(df: DataFrame, *, source: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each source.  Spark keeps n rows per map task before the shuffle."""
    w = W.partitionBy(source).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def packed_size(records: DataFrame, blobs: DataFrame, *, shard: list[str]) -> DataFrame:
    """Body bytes plus each distinct blob of the shard once."""
    body = records.groupBy(*shard).agg(F.sum("body").alias("_b"))
    once = blobs.groupBy(*shard, "sha256").agg(F.max("size").alias("_s")).groupBy(*shard).agg(F.sum("_s").alias("_s"))
    return body.join(once, shard, "left").select(*shard, (F.col("_b") + F.coalesce("_s", F.lit(0))).alias("bytes"))


def logical_content(samples: DataFrame, metadata: DataFrame, *, sequence: str, pos: str, payload: Column, annotations: DataFrame | None = None) -> DataFrame:
    """per-sequence digest of samples, metadata and annotations; offsets and file layout do not enter.

    Annotations (rows by `sequence`, positions relative to it) enter as a sum of row digests in two parts of 60 bits, so their
    order does not matter, but each label, kind and position does; a sequence without any keeps the digest without them.
    """
    first = samples.groupBy(sequence).agg(F.min(pos).alias("_first"))
    placed = samples.join(first, sequence).withColumn("_inner", F.col(pos) - F.col("_first"))
    body = ordered_digest(placed, [sequence], "_inner", payload, out="_body")
    rows = body.join(metadata, sequence)
    names = sorted(c for c in metadata.columns if c != sequence)
    parts = [F.to_json(F.struct(*names)), F.col("rows").cast("string"), F.col("_body")]
    if annotations is not None:
        inner = F.sha2(F.to_json(F.struct(*sorted(c for c in annotations.columns if c != sequence)), {"ignoreNullFields": "false"}), 256)
        part = lambda i: F.sum(F.conv(F.substring(inner, i, 15), 16, 10).cast("decimal(38,0)")).cast("string")
        marks = annotations.groupBy(sequence).agg(F.concat_ws(",", F.count(F.lit(1)).cast("string"), part(1), part(16)).alias("_marks"))
        rows = rows.join(marks, sequence, "left")
        parts.append(F.col("_marks"))
    return rows.select(sequence, F.sha2(F.concat_ws("|", *parts), 256).alias("digest"))


def dataset_digest(sequences: DataFrame, *, sequence: str) -> DataFrame:
    """Digest of the ordered sequence digests of a dataset, one row."""
    return ordered_digest(sequences, [], sequence, F.col("digest"), out="dataset_sha256")


def id_list_digest(df: DataFrame, manifest: DataFrame, *, group: str, order: list[str], key: str) -> DataFrame:
    """Count and ordered digest of the ids of each group, against a frozen manifest."""
    placed = Ordered(df, [group], order).position("_p").done()
    d = ordered_digest(placed, [group], "_p", F.col(key).cast("string"))
    return d.join(manifest, group, "left").withColumn(
        "frozen", F.coalesce((F.col("digest") == F.col("expected_digest")) & (F.col("rows") == F.col("expected_rows")), F.lit(False)))


def plan_identity(plan: DataFrame, *, source: str, order: list[str], fields: list[str] | dict[str, list[str]]) -> DataFrame:
    """digest of the execution fields of each source's plan.

    Plans that are columns of the same clips are placed and digested together: `fields` then has those of each, by the name of
    its identity.
    """
    placed = Ordered(plan, [source], order).position("_p").done()
    plans = fields if isinstance(fields, dict) else {"identity": fields}
    return ordered_digest(placed, [source], "_p", {name: F.sha2(F.to_json(F.struct(*f)), 256) for name, f in plans.items()})


def reusable_plans(one: DataFrame, two: DataFrame, *, source: str) -> DataFrame:
    """Sources whose plans have the same identity."""
    t = two.select(source, F.col("identity").alias("_i"))
    return one.join(t, source).select(source, "identity", (F.col("identity") == F.col("_i")).alias("reusable"))


def coverage(jobs: DataFrame, clips: DataFrame, *, job: str, frozen: str) -> DataFrame:
    """F32: complete when the job is complete and its published clips equal the frozen count."""
    n = clips.groupBy(job).agg(F.count_if(F.col("status") == "published").alias("published"))
    rows = jobs.join(n, job, "left").withColumn("published", F.coalesce("published", F.lit(0)))
    return rows.withColumn("coverage", F.when(
        (F.col("job_status") == "complete") & (F.col("published") == F.col(frozen)), "complete").otherwise("partial"))


# --- K08 -----------------------------------------------------------------------------------------

def publication_plan(rows: DataFrame, published: DataFrame, *, key: str) -> DataFrame:
    """`new`, `same` (no-op) or `conflict` for every content-addressed key."""
    p = published.select(key, F.col("sha256").alias("_sha"))
    return rows.join(p, key, "left").withColumn("action", F.when(F.col("_sha").isNull(), "new").when(
        F.col("_sha") == F.col("sha256"), "same").otherwise("conflict")).drop("_sha")
