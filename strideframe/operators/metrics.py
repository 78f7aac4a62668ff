"""Error metrics and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.plans.ordered import exact_percentiles


def label_audit(commits: DataFrame, *, split: str, key: str, category: str, durations: tuple[str, str] | None = None) -> DataFrame:
    """Per split, label rows with a category, sequences that have one and the largest difference of two durations."""
    has = lambda x: F.exists(F.coalesce(x["categories"], F.array().cast("array<string>")), lambda c: F.lower(c) == category)
    coded = F.filter("label_candidates", lambda x: (F.coalesce(F.length(x["code"]), F.lit(0)) > 0) & has(x))
    apart = F.abs(F.col(durations[0]) - F.col(durations[1])) if durations else F.lit(None).cast("double")
    rows = commits.select(F.col(split).alias("split"), F.col(key), F.size(coded).cast("bigint").alias("_n"), apart.alias("_apart"))
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("_n").alias("category_rows"),
        F.count_if(F.col("_n") > 0).alias("category_sequences"), F.max("_apart").alias("max_duration_difference_s"))


def vector_metrics(df: DataFrame, *, keys: list[str], reference: list[str], estimate: list[str]) -> DataFrame:
    """Mean norm, RMSE per component, Pearson over stacked components, exact p95 norm."""
    diff = [F.col(e) - F.col(r) for r, e in zip(reference, estimate)]
    rows = df.withColumn("_norm", F.sqrt(sum((x * x for x in diff), F.lit(0.0))))
    n = len(reference)
    x = [F.col(c) for c in reference]
    y = [F.col(c) for c in estimate]
    total = lambda cols: sum((F.sum(c) for c in cols), F.lit(0.0))
    agg = rows.groupBy(*keys).agg(
        F.avg("_norm").alias("mae_vector_norm"), F.sqrt(F.avg(F.col("_norm") ** 2) / n).alias("rmse_per_component"),
        F.count(F.lit(1)).alias("samples"), total(x).alias("_sx"), total(y).alias("_sy"),
        total([a * a for a in x]).alias("_sxx"), total([b * b for b in y]).alias("_syy"),
        total([a * b for a, b in zip(x, y)]).alias("_sxy"))
    m = F.col("samples") * n
    vx, vy = F.col("_sxx") - F.col("_sx") ** 2 / m, F.col("_syy") - F.col("_sy") ** 2 / m
    corr = F.when((vx > 1e-12) & (vy > 1e-12), (F.col("_sxy") - F.col("_sx") * F.col("_sy") / m) / F.sqrt(vx * vy))
    p95 = exact_percentiles(rows, keys, "_norm", {"p95_vector_norm": 0.95})
    return agg.withColumn("pearson_correlation", corr).join(p95, keys).select(
        *keys, "mae_vector_norm", "rmse_per_component", "pearson_correlation", "p95_vector_norm", "samples")


def angle_metrics(df: DataFrame, *, keys: list[str], error: str) -> DataFrame:
    """Mean, RMSE and exact p95 of angle errors, in degrees."""
    agg = df.groupBy(*keys).agg(
        F.degrees(F.avg(error)).alias("mean_geodesic_deg"), F.degrees(F.sqrt(F.avg(F.col(error) ** 2))).alias("rmse_geodesic_deg"),
        F.count(F.lit(1)).alias("samples"))
    p95 = exact_percentiles(df, keys, error, {"_p95": 0.95})
    return agg.join(p95, keys).withColumn("p95_geodesic_deg", F.degrees("_p95")).drop("_p95")


def grouped_metrics(df: DataFrame, *, dimensions: list[str], error: str) -> DataFrame:
    """The same metrics for every dimension and overall in one pass over the rows."""
    sets = [[c] for c in dimensions] + [[]]
    return df.groupingSets(sets, *dimensions).agg(
        F.avg(error).alias("mean_error"), F.sqrt(F.avg(F.col(error) ** 2)).alias("rmse_error"), F.count(F.lit(1)).alias("samples"))


def corpus_audit(df: DataFrame, *, source: str, frames: str, rate: Column) -> DataFrame:
    """Members, frames and seconds per source and overall."""
    rows = df.select(source, F.col(frames).cast("bigint").alias("_f"), (F.col(frames) / rate).alias("_s"))
    return rows.groupingSets([[source], []], source).agg(
        F.count(F.lit(1)).alias("members"), F.sum("_f").alias("frames"), F.sum("_s").alias("seconds"))


def top_weights(weights: Column, k: int) -> Column:
    """The k largest weights with their index, ties to the lower index, scaled to sum 1."""
    ranked = F.sort_array(F.transform(weights, lambda x, i: F.struct((-x.cast("double")).alias("n"), i.alias("index"))))
    head = F.slice(ranked, 1, k)
    total = F.aggregate(head, F.lit(0.0), lambda a, x: a - x["n"])
    return F.transform(head, lambda x: F.struct(x["index"].alias("index"), (-x["n"] / total).alias("weight")))
