"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key with more rows than this is split into ordered segments (plans/ordered.py).
SEGMENT_ROWS = "strideframe.segment.rows"
DEFAULT_SEGMENT_ROWS = 4_000_000
# Most bytes of a batch of texts on its way to Python; Spark's own bound is 64 MB.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

_made: list[str] = []       # work folders of this process


def configure(spark: SparkSession) -> SparkSession:
    """Settings that results depend on: every audit time is UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as the JVM and each Python worker hold whole ones; a smaller bound stays."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING)) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def segment_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(SEGMENT_ROWS, str(DEFAULT_SEGMENT_ROWS)))


def work_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a fresh local one only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "checkpoints"))
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared work folder."""
    path = os.path.join(work_root(spark), f"{name}-{uuid.uuid4().hex}")
    _made.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the work folders that this process has made; call it when a job's results are stored."""
    while _made:
        p = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, for readers and writers outside the JVM."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, on any file system, unless it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a written table that survives executor loss."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A fixed configuration table written in the code, small by construction."""
    return F.broadcast(spark.createDataFrame(rows, schema))
