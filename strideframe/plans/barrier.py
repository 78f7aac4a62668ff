"""Keep wide derived columns from being inlined into every later expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, *keep: str) -> DataFrame:
    """Compute the columns of `df` once per row; `keep` columns stay visible to pushdown.

    Projections on top of a projection are merged, and a derived column that is read ten
    times is then written out ten times in the generated code.  A generator in between
    stops the merge and costs no shuffle.
    """
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.explode(F.array(F.struct(*rest))).alias("_once")).select(*keep, "_once.*").select(*df.columns)
