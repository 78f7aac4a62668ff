"""Keyset pages of large tables: a layout clustered by the cursor, and a small table of each file's bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000


def write_clustered(df: DataFrame, path: str, *, order: list[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Store rows in files that follow each other in the order, then one row of bounds a file.

    The order's columns are not null and tell rows apart, as a cursor needs.
    """
    files = max(1, -(-df.count() // rows_per_file))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(f"{path}/rows")
    key = F.struct(*order)
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    bounds = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("rows"))
    bounds.coalesce(1).write.parquet(f"{path}/bounds")


def page_files(spark: SparkSession, path: str, *, order: list[str], after: tuple | None, limit: int) -> list[str]:
    """Files that hold the `limit` rows after the cursor: the first that reaches beyond it, and as many more as the page needs."""
    bounds = spark.read.parquet(f"{path}/bounds")
    if after is not None:
        bounds = bounds.where(F.col("hi") > F.struct(*[F.lit(v).cast(bounds.schema["hi"].dataType[c].dataType).alias(c) for c, v in zip(order, after)]))
    want = 2
    while True:
        rows = bounds.orderBy("lo").limit(want).select("file", "rows").collect()
        # Of the first file any part may lie before the cursor.
        if len(rows) < want or sum(r["rows"] for r in rows[1:]) >= limit:
            break
        want *= 2
    kept, have = [], 0
    for i, r in enumerate(rows):
        kept.append(r["file"])
        have += r["rows"] if i or after is None else 0
        if have >= limit:
            break
    return kept


def clustered_page(spark: SparkSession, path: str, *, order: list[str], after: tuple | None, limit: int) -> DataFrame:
    """The `limit` rows after the cursor in order; without a cursor the first ones. One or two files are opened for a small page."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = page_files(spark, path, order=order, after=after, limit=limit)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    if after is not None:
        rows = rows.where(F.struct(*order) > F.struct(*[F.lit(v).cast(schema[c].dataType).alias(c) for c, v in zip(order, after)]))
    return rows.orderBy(*order).limit(limit)
