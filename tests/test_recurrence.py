"""Recurrences across segments against plain loops and dense solves, at any cut."""

import math
import random

import numpy as np
import pytest

from strideframe.operators import signals as S
from strideframe.plans import recurrence as R


def two_way(values, poles, cutoff, rate, hold):
    """A loop over rows, section by section, forward and then back."""
    k = math.tan(math.pi * cutoff / rate)

    def one_way(x):
        for i in range(poles // 2):
            damp = 2 * math.sin(math.pi * (2 * i + 1) / (2 * poles))
            norm = 1 / (1 + k * damp + k * k)
            b0, b1, b2, a1, a2 = k * k * norm, 2 * k * k * norm, k * k * norm, 2 * (k * k - 1) * norm, (1 - k * damp + k * k) * norm
            x1 = x2 = y1 = y2 = x[0]                 # as if the first value had always been there
            out = []
            for v in x:
                y = b0 * v + b1 * x1 + b2 * x2 - a1 * y1 - a2 * y2
                x1, x2, y1, y2 = v, x1, y, y1
                out.append(y)
            x = out
        return x

    ahead = one_way(list(values) + [values[-1]] * hold)
    return one_way(ahead[::-1])[::-1][:len(values)]


@pytest.mark.parametrize("limit", [8, 60, 100_000])
def test_recursive_filter_equals_a_two_way_loop(spark, limit):
    rnd = random.Random(3)
    series = {"a": [rnd.gauss(0, 1) for _ in range(700)], "b": [rnd.random() for _ in range(150)], "c": [2.5], "d": [1.0, None, 3.0], None: [float(i % 7) for i in range(90)], "e": [None, None]}
    rows = [(k, i, v, "x") for k, vs in series.items() for i, v in enumerate(vs)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "clip string, frame int, v double, _g0 string").repartition(4)
    spark.conf.set("strideframe.segment.rows", str(limit))
    try:
        out = S.recursive_filter(df, keys=["clip"], order=["frame"], value="v", rate_hz=100.0, cutoff_hz=12.0)
        got = {(r.clip, r.frame): r.filtered for r in out.collect()}
    finally:
        spark.conf.unset("strideframe.segment.rows")
    assert out.columns == [*df.columns, "filtered"] and len(got) == len(rows)
    for k, vs in series.items():
        known = [i for i, v in enumerate(vs) if v is not None]
        want = two_way([vs[i] for i in known], 6, 12.0, 100.0, 121) if known else []
        assert np.allclose([got[k, i] for i in known], want, rtol=0, atol=1e-9)
        assert all(got[k, i] is None for i in range(len(vs)) if i not in known)
    assert S.recursive_filter(df.limit(0), keys=["clip"], order=["frame"], value="v", rate_hz=100.0, cutoff_hz=12.0).count() == 0


def test_recursive_filter_keeps_a_constant_and_stops_a_fast_wave(spark):
    rows = [("c", i, 3.0) for i in range(200)] + [("w", i, math.sin(2 * math.pi * 40 * i / 100)) for i in range(400)]
    got = S.recursive_filter(spark.createDataFrame(rows, "k string, i int, v double"), keys=["k"], order=["i"], value="v", rate_hz=100.0, cutoff_hz=5.0).collect()
    assert all(abs(r.filtered - 3.0) < 1e-9 for r in got if r.k == "c")
    assert max(abs(r.filtered) for r in got if r.k == "w" and 100 < r.i < 300) < 1e-4


def test_filter_settings_are_checked():
    for poles, cutoff in ((5, 10.0), (6, 50.0), (6, 0.0)):
        with pytest.raises(ValueError):
            R.butterworth(poles, cutoff, 100.0)


def dense_spline(t, y):
    n = len(t)
    a, d = np.zeros((n, n)), np.zeros(n)
    a[0, 0] = a[-1, -1] = 1
    for i in range(1, n - 1):
        h0, h1 = t[i] - t[i - 1], t[i + 1] - t[i]
        a[i, i - 1:i + 2] = h0, 2 * (h0 + h1), h1
        d[i] = 6 * ((y[i + 1] - y[i]) / h1 - (y[i] - y[i - 1]) / h0)
    return np.linalg.solve(a, d)


@pytest.mark.parametrize("limit", [4, 50, 100_000])
def test_spline_acceleration_equals_a_dense_solve(spark, limit):
    rnd = random.Random(8)
    rows = []
    for k, n in (("a", 300), ("b", 2), ("c", 1), (None, 64), ("d", 3)):
        t = 0.0
        for i in range(n):
            t += rnd.uniform(0.01, 0.1)
            rows.append((k, i, t, rnd.gauss(0, 1), rnd.gauss(0, 1), math.sin(t)))
    still = [("s", i, i / 10, 1.0, 2.0, 3.0) for i in range(40)]
    bad = [("bad", i, 1.0 if i == 5 else i / 10, 0.0, 1.0, 2.0) for i in range(20)] + [("hole", i, i / 10, None if i == 3 else 1.0, 1.0, 1.0) for i in range(9)]
    df = spark.createDataFrame(rows + still + bad, "k string, i int, t double, x double, y double, z double").repartition(3)
    spark.conf.set("strideframe.segment.rows", str(limit))
    try:
        got = {(r.k, r.i): (r.ax, r.ay, r.az) for r in S.spline_acceleration(df, keys=["k"], order=["i"], time_s="t", position=["x", "y", "z"]).collect()}
    finally:
        spark.conf.unset("strideframe.segment.rows")
    assert len(got) == len(rows) + len(still) + len(bad)
    for k in {r[0] for r in rows + still}:
        own = [r for r in rows + still if r[0] == k]
        for axis in range(3):
            want = dense_spline([r[2] for r in own], [r[3 + axis] for r in own])
            assert np.allclose([got[k, r[1]][axis] for r in own], want, rtol=1e-9, atol=1e-9)
    assert all(got[r[0], r[1]] == (None, None, None) for r in bad)
