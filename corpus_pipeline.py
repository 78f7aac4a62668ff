"""The corpus pipeline: quality, near duplicates, benchmark leaks, mixing, token ids.

STAGES are (name, function of (spark, docs, sf_dir)); each result is written and read again as the next
stage's documents. All but the last return the columns of documents. SQL can not express the first stage's
fitted model, so ORACLE_SQL is None and the stages are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strideframe.llm import decontaminate, fm, grammar, mixing, ngram_join
from strideframe.llm import queries as Q
from strideframe.session import materialise, small_batches, work_dir

LEAST_SCORE = 0.7
SHINGLE, SIMILAR = 5, (80, 100)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at 0.7 or more; it is fitted on the labelled rows among `docs`."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = fm.fit(docs, labels, metadata=("n_chars",))
    name = _free("score", docs)
    return fm.score(docs, model, metadata=("n_chars",), keep=tuple(docs.columns), name=name).where(F.col(name) >= LEAST_SCORE).select(*docs.columns)


def _free(name: str, docs: DataFrame) -> str:
    """A column name that the documents do not use."""
    while name in docs.columns:
        name += "_"
    return name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of five-word shingle sets linked at 0.8, the row with the smallest id (a null id last, then by content).

    Rows are told apart by their ids where these are unique, and else by a 128-bit hash of all their columns, so different
    texts that share an id, or have none, are rows of their own; rows equal in every column are one row.
    """
    small_batches(spark)
    repeated = docs.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count()
    if not repeated:
        groups = ngram_join.components(docs, size=SHINGLE, num=SIMILAR[0], den=SIMILAR[1])
        gone = materialise(groups.where("doc_id <> component_id").select("doc_id"), "gone")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    row, nth, verdict = (_free(name, docs) for name in ("row", "nth", "verdict"))
    rows = docs.withColumn(row, F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), *docs.columns)), 16, "0") for k in (0, 1)])))
    groups = materialise(ngram_join.components(rows, key=row, size=SHINGLE, num=SIMILAR[0], den=SIMILAR[1]).toDF("row", "n", "group"), "groups")
    linked = groups.where("row <> `group`").select("row", "group").distinct()
    members = materialise(linked.unionByName(linked.select(F.col("group").alias("row"), "group").distinct()), "members")
    ids = members.join(rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id")).distinct(), "row")
    # The smallest of a group combines before the shuffle, however large the group.
    best = ids.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("best")).select(F.col("best.row").alias("row"))
    gone = members.select("row").join(best, "row", "left_anti").select("row", F.lit("gone").alias("verdict"))
    again = groups.groupBy("row").count().where("count > 1").select("row").join(gone.select("row"), "row", "left_anti").select("row", F.lit("once").alias("verdict"))
    # One join of the texts, with what is decided of a row.
    decided = materialise(gone.unionByName(again), "decided").toDF(row, verdict)
    kept = rows.join(decided, row, "left").where(F.col(verdict).isNull() | (F.col(verdict) != "gone"))
    order = Window.partitionBy(row).orderBy(F.lit(1))
    once = kept.where(F.col(verdict).isNotNull()).withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return kept.where(F.col(verdict).isNull()).select(*docs.columns).unionByName(once.select(*docs.columns))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    small_batches(spark)
    path = work_dir(spark, "index")
    decontaminate.write_index(docs, path, "doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.report(decontaminate.search(decontaminate.read_index(spark, path), benchmark, "doc_id"), "doc_id")
    return docs.join(found.where("contaminated").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tree of domains, languages and sources takes in one epoch, whole where it takes a part."""
    rows = Q.with_domain(docs)
    taken = mixing.choose(rows, "doc_id", Q.MIX_LEVELS, Q.MIX_WEIGHTS, Q.MIX_SHARE, 1, Q.MIX_SEED, tokens="n_words")
    return docs.join(taken.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, written as Re-Pair shards; what is read back from them."""
    small_batches(spark)
    path = work_dir(spark, "tokens")
    grammar.write(docs, path, "doc_id", "text", Q.tokenizer_path(), end_id=1)
    return grammar.documents(grammar.read(spark, path), "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing to target weights", mixed),
    ("token-ID output", token_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return materialise(STAGES[-1][1](spark, docs, sf_dir), "stage")
