"""Array helpers that stay inside generated code (no lambda)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(*texts: Column) -> Column:
    """The texts that are not null, in order."""
    return F.array_remove(F.array(*[F.coalesce(t, F.lit("")) for t in texts]), F.lit(""))
