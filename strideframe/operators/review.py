"""Review history, review queue and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strideframe.functions.arrays import present
from strideframe.operators.checks import violation
from strideframe.plans.ordered import Ordered

# Fixed review strata, in rank order.
CATEGORIES = ["ordinary", "warning", "label-ambiguous", "high-risk"]


def latest_revision(df: DataFrame, *, keys: list[str], revision: str) -> DataFrame:
    """The row with the numerically largest revision of each key.

    An aggregate rather than a window, so a hot key is reduced before it is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(revision).cast("bigint")).alias("_r"))
    return best.select(*keys, "_r.*")


def revision_numbering(df: DataFrame, *, key: str, revision: str, first: int = 1) -> DataFrame:
    """Keys whose revisions are not first, first+1, ... without gap or repeat."""
    r = F.col(revision).cast("bigint")
    once = df.groupBy(key, r.alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    agg = once.groupBy(key).agg(F.min("_r").alias("lo"), F.max("_r").alias("hi"), F.count(F.lit(1)).alias("n"),
                                F.max("_n").alias("times"))
    return agg.where((F.col("lo") != first) | (F.col("hi") != F.col("n") + first - 1) | (F.col("times") > 1)).select(
        *violation("revision-numbering", F.col(key), F.col("n")))


def hash_chain(df: DataFrame, *, key: str, revision: str, body: Column, previous_sha: str) -> DataFrame:
    """Every revision carries the digest of the row before it, the first carries none."""
    rows = df.withColumn("_sha", F.sha2(body, 256))
    o = Ordered(rows, [key], [revision]).neighbours(prev={"_above": "_sha"}).done()
    return o.where(~F.col(previous_sha).eqNullSafe(F.col("_above"))).select(
        *violation("hash-chain", F.concat_ws("/", key, revision), F.col(revision)))


def queue_reasons(rows: DataFrame) -> DataFrame:
    """why a clip needs review; missing QA counts as risk 1.0."""
    n = F.size("codes")
    reasons = present(
        F.when(F.col("qa_passed") == F.lit(False), "automatic-qa-failed"),
        F.when(F.coalesce(F.size("warnings"), F.lit(0)) > 0, "automatic-warning"),
        F.when(n == 0, "label-unresolved").when(n > 1, "label-ambiguous"))
    return rows.withColumns({"reasons": reasons, "risk": F.coalesce(F.col("risk_score"), F.lit(1.0))})


def stratified_pick(rows: DataFrame, *, strata: list[str], risk: str, key: str) -> DataFrame:
    """The row with the highest (risk, id) of each stratum, as an aggregate."""
    rest = [c for c in rows.columns if c not in strata]
    best = rows.groupBy(*strata).agg(F.max_by(F.struct(*rest), F.struct(risk, key)).alias("_r"))
    return best.select(*strata, "_r.*")


def review_queue(rows: DataFrame, *, key: str) -> DataFrame:
    """Undecided clips; exceptions first, then one sample per (dataset, subject, code)."""
    q = queue_reasons(rows.where(~F.coalesce(F.col("decision").isin("accepted", "rejected"), F.lit(False))))
    exceptions = q.where(F.size("reasons") > 0)
    plain = q.where(F.size("reasons") == 0).withColumn("_code", F.get("codes", F.lit(0)))
    sample = stratified_pick(plain, strata=["source_dataset", "subject", "_code"], risk="risk", key=key).drop(
        "_code").withColumn("reasons", F.array(F.lit("stratified-sample")))
    both = exceptions.unionByName(sample).withColumn(
        "sampled", F.col("reasons") == F.array(F.lit("stratified-sample")))
    return both.orderBy("sampled", F.desc("risk"), key)


def choose_samples(rows: DataFrame, *, source: str, key: str, max_duration_s: float = 30.0) -> DataFrame:
    """Per source at most one row of each category, none used twice.

    Rows over the cap only count when the source has none under it (then the shortest).
    A later category can lose at most the picks of the earlier ones, so each category keeps
    its four best rows and the choice is made on that bounded list.
    """
    code_n, warned = F.size("codes"), F.size("warnings") > 0
    shortest = rows.groupBy(source).agg(
        F.min(F.struct(F.col("duration_s").alias("d"), F.col(key).alias("k"))).alias("_s"))
    pool = rows.join(shortest, source).where(
        (F.col("duration_s") <= max_duration_s)
        | ((F.col("_s.d") > max_duration_s) & (F.col(key) == F.col("_s.k")))).drop("_s")
    member = {"ordinary": ~warned & (code_n == 1), "warning": warned,
              "label-ambiguous": code_n != 1, "high-risk": F.lit(True)}
    near, risk, dur = F.abs(F.col("duration_s") - 5.0), -F.col("risk_score"), F.col("duration_s")
    flagged = F.array_compact(F.array(*[
        F.when(member[c], F.struct(
            F.lit(i).alias("rank"), F.lit(c).alias("category"),
            (risk if c == "high-risk" else near).alias("o1"), (dur if c == "high-risk" else risk).alias("o2")))
        for i, c in enumerate(CATEGORIES)]))
    long = pool.select(source, key, F.explode(flagged).alias("f")).select(source, key, "f.*")
    w = W.partitionBy(source, "rank").orderBy("o1", "o2", key)
    best = long.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= len(CATEGORIES))
    lists = best.groupBy(source).agg(F.sort_array(F.collect_list(
        F.struct("rank", F.col("_n").alias("n"), "category", F.col(key).alias("k")))).alias("_l"))
    # At most 16 rows per source: walk the categories and skip ids already used.
    empty = F.array().cast(best.select(F.array(F.struct("category", F.col(key).alias("k")))).schema[0].dataType)
    picked = F.aggregate("_l", empty, lambda acc, x: F.when(
        F.exists(acc, lambda y: (y["k"] == x["k"]) | (y["category"] == x["category"])), acc).otherwise(
        F.concat(acc, F.array(F.struct(x["category"].alias("category"), x["k"].alias("k"))))))
    return lists.select(source, F.explode(picked).alias("p")).select(
        source, F.col("p.category").alias("category"), F.col("p.k").alias(key))


def choose_pilot(index: DataFrame, *, key: str, category: str, source: str, per_category: int,
                 required: list[str]) -> DataFrame:
    """K rows per category by digest order, with the required source group present.

    Only the k best rows per category and the single best replacement leave the executors'
    partitions, so the result is bounded by 4k + 1 rows.
    """
    digest = F.sha2(F.col(key).cast("string"), 256)
    rows = index.where(F.col(category).isin(CATEGORIES)).withColumn("_d", digest)
    w = W.partitionBy(category).orderBy("_d", key)
    chosen = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_category)
    group = F.col(source).isin(required)
    swap = rows.where(group).agg(F.min_by(F.struct(key, category, source), F.struct(
        (F.col(category) != "high-risk").alias("a"), F.col(key).alias("b"))).alias("_s"))
    covered = chosen.agg(F.coalesce(F.bool_or(group), F.lit(False)).alias("_ok")).withColumn("_one", F.lit(1))
    flag = chosen.withColumn("_one", F.lit(1)).join(F.broadcast(covered), "_one")
    flag = flag.join(F.broadcast(swap.withColumn("_one", F.lit(1))), "_one")
    keep = flag.where(F.col("_ok") | F.col("_s").isNull() | ~((F.col(category) == F.col(f"_s.{category}"))
                                                              & (F.col("_n") == per_category)))
    extra = swap.withColumn("_one", F.lit(1)).join(covered, "_one").where(
        ~F.col("_ok") & F.col("_s").isNotNull()).select("_s.*")
    out = keep.select(key, category, source).unionByName(extra.select(key, category, source))
    return out.orderBy(category, key)


def pilot_violations(chosen: DataFrame, *, category: str, source: str, per_category: int, required: list[str]) -> DataFrame:
    """Categories with too few chosen rows, and a choice without the required source group."""
    wanted = chosen.sparkSession.createDataFrame([(c,) for c in CATEGORIES], f"{category} string")
    n = chosen.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    few = wanted.join(n, category, "left").withColumn("_n", F.coalesce("_n", F.lit(0))).where(F.col("_n") < per_category).select(
        *violation("too-few-rows", F.col(category), F.col("_n")))
    none = chosen.agg(F.count_if(F.col(source).isin(required)).alias("_n")).where("_n = 0").select(
        *violation("required-source-missing", F.lit(",".join(required)), F.col("_n")))
    return few.unionByName(none)


def category_order(df: DataFrame, *, category: str, key: str) -> DataFrame:
    """Rows in stratum rank order."""
    rank = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col(category))
    return df.withColumn("category_rank", rank).orderBy("category_rank", key)
