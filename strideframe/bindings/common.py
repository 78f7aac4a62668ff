"""Views of the driver tables as motion data, shared by the query modules."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.functions import rotations as R
from strideframe.plans.barrier import evaluate_once
from strideframe.sources.tables import events, read

CLIP, SERIES, ORDER = ["user_id"], ["event_type"], ["us", "event_id"]

# SQL prefixes that give DuckDB the same views.
E = "WITH e AS (SELECT *, epoch_us(ts) AS us FROM events)"
_N = "sqrt(CAST(embedding[{0}] AS DOUBLE)**2+CAST(embedding[{1}] AS DOUBLE)**2+CAST(embedding[{2}] AS DOUBLE)**2+CAST(embedding[{3}] AS DOUBLE)**2)"


def _q(prefix, first):
    idx = [first + i for i in range(4)]
    n = _N.format(*idx)
    return ", ".join(f"CAST(embedding[{i}] AS DOUBLE)/{n} AS {prefix}{c}" for i, c in zip(idx, "wxyz"))


Q = (f"WITH q AS (SELECT vec_id, label, {_q('q', 1)}, {_q('p', 8)}, "
     "CAST(embedding[5] AS DOUBLE) AS vx, CAST(embedding[6] AS DOUBLE) AS vy, "
     "CAST(embedding[7] AS DOUBLE) AS vz FROM embeddings)")
QUAT, QUAT2, VEC = [f"q{c}" for c in "wxyz"], [f"p{c}" for c in "wxyz"], ["vx", "vy", "vz"]


def poses(spark, d):
    """Embeddings as frames of `label`: two unit quaternions q*, p* and a vector v*."""
    e = F.col("embedding")
    q, p, v = R.unit(R.parts(e, 0, 4)), R.unit(R.parts(e, 7, 4)), R.parts(e, 4, 3)
    rows = read(spark, d, "embeddings").select(
        "vec_id", "label", *[c.alias(n) for c, n in zip(q, QUAT)],
        *[c.alias(n) for c, n in zip(p, QUAT2)], *[c.alias(n) for c, n in zip(v, VEC)])
    return evaluate_once(rows, "vec_id", "label")


def signal(spark, d):
    return events(spark, d)


def rounded(df, *cols, places=6):
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})
