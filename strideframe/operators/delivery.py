"""Sinks: create-only tables, training exports, shards, catalogs, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.operators.checks import violation
from strideframe.operators.corpus import dataset_digest, logical_content, partition_decisions, running_offsets
from strideframe.plans.ordered import Ordered
from strideframe.session import materialise, qualified
from strideframe.sources import shards


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def create_only_write(df: DataFrame, path: str, *, check=None, partition_by: list[str] | None = None) -> DataFrame:
    """Refuse an existing target, write beside it, check what was written, then rename.

    Every try stages under a name of its own, so what a crash left behind is in nobody's way.
    """
    spark = df.sparkSession
    if exists(spark, path):
        raise FileExistsError(path)
    staging = staging_name(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        # Tasks move their own folders, not the driver all of them one by one; nobody reads the staging folder before the job is done.
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*partition_by)
    writer.parquet(staging)
    if check is not None:
        bad = check(spark.read.schema(df.schema).parquet(staging)).limit(1).collect()
        if bad:
            fs, p = _fs(spark, staging)
            fs.delete(p, True)
            raise ValueError(f"contract violation: {bad[0]['rule']} {bad[0]['key']}")
    publish_folder(spark, staging, path)
    return spark.read.schema(df.schema).parquet(path)


def staging_name(path: str) -> str:
    """A new hidden sibling of a target."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}-{uuid.uuid4().hex}"


def publish_folder(spark: SparkSession, staging: str, path: str) -> None:
    """Rename a staged folder to its target; a target that appeared meanwhile stays."""
    fs, p = _fs(spark, staging)
    if exists(spark, path) or not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise FileExistsError(f"cannot publish {path}")


def export_counts(rows: DataFrame, *, samples: str, rate_hz: float, mounts: int) -> DataFrame:
    """Counts, seconds and label states of an export, one row."""
    weak = F.count_if(F.col("state") == "weak")
    return rows.agg(
        F.count(F.lit(1)).alias("candidates"), (F.count(F.lit(1)) * mounts).alias("sequences"),
        F.sum(samples).alias("samples"), F.round(F.sum(samples) / F.lit(rate_hz * mounts), 6).alias("seconds"),
        weak.alias("weak"), F.count_if(F.col("state") == "unresolved").alias("unresolved"))


def export_mounts(signals: DataFrame, *, clip: str, mount: str, order: list[str], values: list[str]):
    """One sequence per (clip, mount) and its samples as floats with global offsets."""
    lengths = signals.groupBy(clip, mount).agg(F.count(F.lit(1)).alias("length"))
    # Offsets in (clip, mount) order: number the sequences, then run over their lengths.
    seq = running_offsets(lengths.withColumn("_k", F.col(clip)), order=["_k", mount], length="length").select(
        clip, mount, F.col("ordinal").cast("int").alias("sequence_index"), F.col("start").alias("sample_start"), F.col("stop").alias("sample_stop"))
    placed = Ordered(signals, [clip, mount], order).position("_p").done()
    samples = placed.join(seq, [clip, mount]).select(
        "sequence_index", (F.col("sample_start") + F.col("_p")).alias("sample"), *[F.col(v).cast("float").alias(v) for v in values],
        *[c for c in order if c not in values])
    return seq, samples


def write_delivery(tables: dict[str, DataFrame], path: str, *, dataset_id: str, sequences: DataFrame, samples: DataFrame,
                   payload: Column, annotations: DataFrame | None = None) -> DataFrame:
    """One folder per table and the manifest (counts and logical hash), staged together and published at once."""
    spark = sequences.sparkSession
    if exists(spark, path):
        raise FileExistsError(path)
    staging = staging_name(path)
    stored = {name: create_only_write(df, f"{staging}/{name}") for name, df in tables.items()}
    digest = dataset_digest(logical_content(samples, sequences, sequence="sequence_index", pos="sample", payload=payload, annotations=annotations),
                            sequence="sequence_index")
    counts = None
    for name, df in stored.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        counts = row if counts is None else counts.unionByName(row)
    manifest = counts.withColumn("_one", F.lit(1)).join(digest.withColumn("_one", F.lit(1)), "_one").select(
        F.lit(dataset_id).alias("dataset_id"), "table", "rows", "dataset_sha256")
    create_only_write(manifest, f"{staging}/manifest")
    publish_folder(spark, staging, path)
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def weak_core(labelled: DataFrame, qa: DataFrame, *, key: str, samples: str, mounts: list[str]) -> DataFrame:
    """Published QA-passed candidates with weak labels as sequence rows, one per mount."""
    rows = labelled.join(qa.where("passed").select(key), key, "left_semi")
    long = rows.select(key, "state", "code", "rule_id", samples, F.explode(F.array(*map(F.lit, mounts))).alias("body_location"))
    out = running_offsets(long, order=[key, "body_location"], length=samples)
    return out.select(F.col("ordinal").cast("int").alias("sequence_index"), F.col("start").alias("sample_start"), F.col("stop").alias("sample_stop"),
                      key, "body_location", F.lit("unverified").alias("activity_code"), F.lit(False).alias("is_fall"), "state", "code", "rule_id")


def relabel(core: DataFrame, labelled: DataFrame, *, key: str) -> tuple[DataFrame, DataFrame]:
    """Only the weak index changes.  Also returns carried rows that differ (must be empty)."""
    new = labelled.select(key, F.col("state").alias("_s"), F.col("code").alias("_c"), F.col("rule_id").alias("_r"))
    out = core.join(new, key, "left").select(
        *[c for c in core.columns if c not in ("state", "code", "rule_id")],
        F.coalesce("_s", F.lit("unresolved")).alias("state"), F.coalesce("_c", F.lit("")).alias("code"), F.coalesce("_r", F.lit("")).alias("rule_id"))
    carried = [c for c in core.columns if c not in ("state", "code", "rule_id")]
    moved = core.select(*carried).exceptAll(out.select(*carried)).select(
        *violation("carried-row", F.col("sequence_index"), F.col(key)))
    return out, moved


def migrate(sequences: DataFrame, renames: dict[str, str], added: dict[str, Column]) -> DataFrame:
    """The same rows under a newer schema; the core hash must not change."""
    return sequences.withColumnsRenamed(renames).withColumns(added)


def migrated(old: DataFrame, new: DataFrame, *, key: str, digest: str = "digest", required: list[str] = ()) -> DataFrame:
    """Violations of a migration: rows that came, went or changed their content hash, and required columns left null."""
    both = old.select(key, F.col(digest).alias("_a"), F.lit(True).alias("_o")).join(
        new.select(key, F.col(digest).alias("_b"), F.lit(True).alias("_n")), key, "full_outer")
    rule = (F.when(F.col("_n").isNull(), "row-lost").when(F.col("_o").isNull(), "row-added").when(~F.col("_a").eqNullSafe(F.col("_b")), "hash-changed"))
    rows = both.withColumn("_rule", rule).where("_rule is not null").select(*violation(F.col("_rule"), F.col(key), F.coalesce("_b", "_a")))
    for name in required:
        missing = new if name in new.columns else new.withColumn(name, F.lit(None).cast("string"))
        rows = rows.unionByName(missing.where(F.col(name).isNull()).select(*violation(f"missing-{name}", F.col(key), F.lit(name))))
    return rows


def write_shards(packed: DataFrame, path: str, *, shard: list[str], order: list[str]) -> DataFrame:
    """One folder per shard; rows of a shard meet in one task, its size bound limits the task.

    The number of tasks is given, as the work is in the files: AQE would join tasks by their bytes and leave thousands of files to one.
    Tasks write the files and a list of them, and read them by that list (`sources/shards.py`), so the driver holds nothing of a shard. Stores
    that only Spark's file systems reach are written and listed by Spark, with the driver.
    """
    spark = packed.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = packed.repartition(tasks, *shard).sortWithinPartitions(*shard, *order)
    if not shards.reachable(qualified(spark, path)):
        return create_only_write(out, path, partition_by=shard)
    if exists(spark, path):
        raise FileExistsError(path)
    staging = staging_name(path)
    shards.store(out, staging, shard)
    publish_folder(spark, staging, path)
    return shards.load(spark, path, packed.schema, shard)


def packed_records(packed: DataFrame, *, shard: list[str], order: list[str], body: str) -> DataFrame:
    """Every record with its `start` and `stop` inside its shard (offsets begin at 0 in each shard)."""
    placed = Ordered(packed, shard, order).running({"stop": F.col(body)}).done()
    return placed.withColumn("start", F.col("stop") - F.col(body))


def shared_rows(rows: DataFrame, *, shard: list[str], identity: str) -> tuple[DataFrame, DataFrame]:
    """Blobs or catalog rows of each shard once per identity, and the identities that come with two contents."""
    rest = [c for c in rows.columns if c not in (*shard, identity)]
    body = F.struct(*rest)
    once = rows.groupBy(*shard, identity).agg(F.min(body).alias("_lo"), F.max(body).alias("_hi"))
    clash = once.where(~F.col("_lo").eqNullSafe(F.col("_hi"))).select(
        *violation("content-conflict", F.concat_ws("/", *[F.col(c).cast("string") for c in (*shard, identity)]), F.to_json("_hi")))
    return once.select(*shard, identity, "_lo.*"), clash


def write_corpus(clips: DataFrame, path: str, *, source: str, key: list[str], policy: dict) -> dict[str, DataFrame]:
    """The corpus and its audit as four tables, staged together and published at once.

    `candidates` and `excluded` (with reasons) split the clips after quarantine; `sources` has the pass rates and `statistics` one row.
    Clips are judged once and stored for the four tables.
    """
    from strideframe.operators import qa
    spark = clips.sparkSession
    if exists(spark, path):
        raise FileExistsError(path)
    out = materialise(qa.exclusion(clips, source=source, policy=policy).select(*key, source, "passed", "reasons", "excluded"), "judged")
    tables = {"candidates": out.where("not excluded").select(*key, source), "excluded": out.where("excluded").select(*key, source, "reasons"),
              "sources": qa.source_rates(out, source=source, policy=policy), "statistics": qa.corpus_statistics(out, policy=policy)}
    staging = staging_name(path)
    for name, table in tables.items():
        create_only_write(table, f"{staging}/{name}")
    publish_folder(spark, staging, path)
    return {name: spark.read.schema(table.schema).parquet(f"{path}/{name}") for name, table in tables.items()}


def export_identity(core: DataFrame, rules: DataFrame, audit: DataFrame, *, order: list[str]) -> DataFrame:
    """Identity of an export, one row: digest of its rows in order, of the rules and of the audit it was made from."""
    from strideframe.plans.digests import ordered_digest
    placed = Ordered(core, [], order).position("_p").done()
    names = sorted(c for c in core.columns)
    body = ordered_digest(placed, [], "_p", F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256), out="_core")
    total = lambda df, name: df.agg(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *[F.sum(F.conv(F.substring(
        F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256), i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in (1, 16)]).alias(name))
    one = lambda df: df.withColumn("_one", F.lit(1))
    row = one(body).join(one(total(rules, "_rules")), "_one").join(one(total(audit, "_audit")), "_one")
    return row.select(F.sha2(F.concat_ws("|", "_core", "_rules", "_audit"), 256).alias("export_id"))


def publish(rows: DataFrame, path: str, *, key: str) -> DataFrame:
    """Append new objects, refuse changed ones, append the commit rows last.

    A key that a batch repeats is stored once; two digests of a key, in the batch or against the store, are refused.
    """
    from strideframe.operators.corpus import publication_plan
    spark = rows.sparkSession
    rows = rows.groupBy(key).agg(F.min("sha256").alias("sha256"), (F.count_if(F.col("sha256").isNull()) + F.count_distinct("sha256")).alias("_digests"))
    twice = rows.where("_digests <> 1").limit(1).collect()
    if twice:
        raise ValueError(f"two contents of one object: {twice[0][key]}")
    objects, commits = f"{path}/objects", f"{path}/commits"
    schema = rows.select(key, "sha256").schema
    old = spark.read.schema(schema).parquet(objects) if exists(spark, objects) else spark.createDataFrame([], schema)
    plan = publication_plan(rows, old, key=key)
    clash = plan.where("action = 'conflict'").limit(1).collect()
    if clash:
        raise ValueError(f"published object changed: {clash[0][key]}")
    fresh = plan.where("action = 'new'").select(key, "sha256")
    fresh.write.mode("append").parquet(objects)
    # Commits follow the stored objects, so a lost run is completed by the next one.
    stored = spark.read.schema(schema).parquet(objects)
    done = spark.read.schema(schema).parquet(commits) if exists(spark, commits) else spark.createDataFrame([], schema)
    stored.join(done.select(key), key, "left_anti").write.mode("append").parquet(commits)
    return spark.read.schema(schema).parquet(commits)


def write_catalog(plans: DataFrame, path: str, *, source: str) -> DataFrame:
    """One folder per source; sources already present are left alone if their plans are the same, else refused.

    New sources are staged together and published by one rename each, so a source is there whole or not at all. The list of
    stored sources is a table of its own, so that its size, not that of the stored plans, says whether plans are dealt by source.
    """
    spark = plans.sparkSession
    if exists(spark, path):
        stored = spark.read.schema(plans.schema).parquet(path)
        done = materialise(stored.select(source).distinct(), "sources")
        rest = [c for c in plans.columns if c != source]
        mark = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*rest).cast("decimal(38,0)")).alias("h1"), F.sum(F.hash(*rest).cast("decimal(38,0)")).alias("h2")]
        old, new = stored.groupBy(source).agg(*mark), plans.join(done, source, "left_semi").groupBy(source).agg(*mark)
        changed = new.exceptAll(old).limit(1).collect()
        if changed:
            raise ValueError(f"plans of {changed[0][source]} changed")
        plans = plans.join(done, source, "left_anti")
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    plans.write.partitionBy(source).parquet(staged)
    fs, top = _fs(spark, staged)
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{source}="):
            _, target = _fs(spark, f"{path}/{name}")
            if fs.exists(target) or not fs.rename(status.getPath(), target):
                fs.delete(top, True)
                raise ValueError(f"{name} was published by someone else")
    fs.delete(top, True)
    return spark.read.schema(plans.schema).parquet(path)


def snapshot_manifest(candidates: DataFrame, decisions: DataFrame, shards: DataFrame, *, key: str) -> DataFrame:
    """Every candidate with its reason or its shard, and the latest revision."""
    rows = partition_decisions(candidates, decisions, key=key)
    rev = decisions.select(key, "revision")
    return rows.join(rev, key, "left").join(shards, key, "left").select(
        key, "included", "reason", "revision", F.when(F.col("included"), F.col("shard")).alias("shard"))


def source_report(inventory: DataFrame, audit: DataFrame, labels: DataFrame, *, source: str) -> DataFrame:
    """Archive, frame and label totals of each source on one row."""
    return inventory.join(audit, source, "left").join(labels, source, "left")
