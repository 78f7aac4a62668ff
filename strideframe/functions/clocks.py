"""Integer-exact clocks and time arithmetic."""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_MAX = 9223372036854775807


def _div(a: Column, b: Column) -> Column:
    """Exact integer quotient of two whole non-negative decimals."""
    a, b = a.cast("decimal(38,0)"), b.cast("decimal(38,0)")
    return ((a - a % b) / b).cast("decimal(38,0)")


def step_ns(step: Column, numerator: Column, denominator: Column) -> Column:
    """Nanoseconds of `step` at period numerator/denominator, half away from zero.

    Null when the period is not positive or the result leaves the 64-bit range.
    """
    scaled = (F.abs(step).cast("decimal(19,0)") * numerator.cast("decimal(9,0)")).cast("decimal(28,0)")
    twice = (scaled * F.lit(2_000_000_000).cast("decimal(10,0)")).cast("decimal(38,0)")
    den = denominator.cast("decimal(18,0)")
    down = _div(twice + den, F.nullif(den * 2, F.lit(0).cast("decimal(18,0)")))
    signed = F.when(step < 0, -down).otherwise(down)
    return F.when((numerator > 0) & (denominator > 0) & (down <= F.lit(LONG_MAX)), signed.cast("bigint"))


PERIOD = T.StructType([T.StructField("numerator", T.LongType()), T.StructField("denominator", T.LongType())])


@F.pandas_udf(PERIOD)
def _period(rates: pd.Series) -> pd.DataFrame:
    out = [Fraction(str(float(r))).limit_denominator(1_000_000) for r in rates]
    return pd.DataFrame({"numerator": [f.denominator for f in out],
                         "denominator": [f.numerator for f in out]})


def clock_period(rate: Column) -> Column:
    """Period of a decimal rate as a fraction with bounded denominator."""
    return _period(rate.cast("double"))


def aligned_work_rate(minimum: Column, source: Column) -> Column:
    """Smallest integer multiple of the source rate that reaches `minimum`."""
    return F.greatest(F.lit(1.0), F.ceil(minimum / source - 1e-12).cast("double")) * source


def elapsed_s(start_us: Column, stop_us: Column) -> Column:
    """Seconds between two microsecond times, never negative."""
    return F.greatest(F.lit(0.0), (stop_us - start_us) / F.lit(1e6))
