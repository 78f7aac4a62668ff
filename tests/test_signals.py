import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.functions import clocks
from strideframe.functions import rotations as R
from strideframe.operators import joins as J
from strideframe.operators import ledger as L
from strideframe.operators import metrics as M
from strideframe.operators import signals as S
from strideframe.plans.ordered import Ordered, exact_percentiles


def series(spark, n=60, hot=200):
    rnd = random.Random(3)
    rows = [("hot", t, rnd.uniform(-5, 5)) for t in range(hot)] + [(f"c{i % 4}", i, rnd.uniform(-5, 5)) for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t bigint, v double")


@pytest.mark.parametrize("limit", [5, 17, 10 ** 9])
def test_segments_do_not_change_results(spark, limit):
    df = series(spark)
    o = (Ordered(df, ["k"], ["t"], limit=limit).neighbours(prev={"p": "v"}, following={"n": "v"})
         .running({"s": F.col("v")}).position("pos", "cnt").totals({"top": F.max("v")})
         .fill(forward={"f": F.when(F.col("v") > 0, F.col("v"))}, backward={"b": F.when(F.col("v") > 0, F.col("v"))}))
    got = {(r.k, r.t): r for r in o.done().collect()}
    by = {}
    for r in df.collect():
        by.setdefault(r.k, []).append((r.t, r.v))
    for k, rows in by.items():
        rows.sort()
        total, last = 0.0, None
        for i, (t, v) in enumerate(rows):
            r = got[k, t]
            total += v
            last = v if v > 0 else last
            ahead = next((x for _, x in rows[i:] if x > 0), None)
            assert (r.p, r.n) == (rows[i - 1][1] if i else None, rows[i + 1][1] if i + 1 < len(rows) else None)
            assert r.s == pytest.approx(total) and (r.pos, r.cnt) == (i, len(rows))
            assert r.top == max(x for _, x in rows) and (r.f, r.b) == (last, ahead)


@pytest.mark.parametrize("kind", ["outlier", "infinity", "equal", "text"])
def test_no_segment_holds_a_key(spark, kind):
    """Outliers, infinities, equal first columns and text ids are cut into pieces alike."""
    n = 4000
    first = {"outlier": lambda i: 1e300 if i == 0 else float(i), "infinity": lambda i: math.inf if i % 2 else float(i), "equal": lambda i: 7.0, "text": lambda i: f"id-{i:05d}"}[kind]
    rows = [("k", first(i), i) for i in range(n)] + [("none", first(1), 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, f"k string, t {'string' if kind == 'text' else 'double'}, i long")
    o = Ordered(df, ["k"], ["t", "i"], limit=200)
    sizes = [r["count"] for r in o.df.groupBy("k", "_seg").count().collect()]
    assert max(sizes) <= 600 and len(sizes) > 40
    got = {r.i: r.s for r in o.running({"s": F.lit(1)}).done().where("k = 'k'").collect()}
    want = sorted((t, i) for k, t, i in rows if k == "k")
    assert got == {i: p + 1 for p, (_, i) in enumerate(want)}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_no_task_holds_a_key(spark, keys):
    """Rows are not dealt by their key when they meet its cuts, also where joins are not turned into broadcasts by size."""
    was = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        df = spark.range(0, 4000, 1, 8).select(F.floor(F.col("id") / 4000).alias("k"), F.col("id").alias("t"))
        o = Ordered(df, keys, ["t"], limit=200)
        tasks = [r.task for r in o.df.select(F.spark_partition_id().alias("task")).collect()]
        got = o.position("p").totals({"n": F.count("*")}).done().collect()
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    assert max(map(tasks.count, set(tasks))) <= 1600
    assert len(got) == 4000 and all(r.t == r.p and r.n == 4000 for r in got)


@pytest.mark.parametrize("reach,chunk", [(10, 4), (3, 100), (25, 7)])
def test_halo_of_any_reach(spark, reach, chunk):
    from strideframe.plans.ordered import halo
    df = spark.range(60).withColumnRenamed("id", "pos").withColumn("k", F.lit(1))
    out, win = halo(df, ["k"], "pos", reach, chunk)
    got = {r.pos: (r.a, r.b) for r in out.select("pos", "_own", F.lag("pos", reach).over(win).alias("a"), F.lead("pos", reach).over(win).alias("b")).where("_own").collect()}
    assert got == {p: (p - reach if p >= reach else None, p + reach if p + reach < 60 else None) for p in range(60)}


def test_percentiles_of_one_to_four(spark, split_keys):
    df = spark.createDataFrame([("extract", float(x)) for x in (4, 2, 1, 3)], "phase string, s double")
    r = L.phase_summary(df, phase="phase", value="s").first()
    assert (r["count"], r["total"], r["p50"]) == (4, 10.0, 2.5) and r["p95"] == pytest.approx(3.85)


def test_percentiles_match_numpy_with_ties_and_a_hot_key(spark, split_keys):
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 40))) for _ in range(500)] + [("cold", 7.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", {"a": 0.05, "b": 0.5, "c": 0.95}).collect()}
    hot = [v for k, v in rows if k == "hot"]
    for name, p in (("a", 0.05), ("b", 0.5), ("c", 0.95)):
        assert got["hot"][name] == pytest.approx(float(np.quantile(hot, p)))
        assert got["cold"][name] == 7.0


def still(spark, n=121):
    return spark.createDataFrame([("c", i, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0) for i in range(n)],
                                 "k string, t bigint, x double, y double, z double, qw double, qx double, qy double, qz double")


def test_stationary_body_feels_gravity_only(spark, split_keys):
    q = ["qw", "qx", "qy", "qz"]
    force = S.specific_force(still(spark), keys=["k"], order=["t"], position=["x", "y", "z"], q=q, dt_s=1 / 120).collect()
    assert all(abs(r.fx) < 1e-12 and abs(r.fy) < 1e-12 and abs(r.fz - 9.81) < 1e-9 for r in force)
    gyro = S.angular_velocity(still(spark), keys=["k"], order=["t"], q=q, rate_hz=120.0).collect()
    assert all(abs(v) < 1e-12 for r in gyro for v in (r.wx, r.wy, r.wz))


def test_rotation_about_gravity_axis_keeps_rate(spark, split_keys):
    rate, omega = 100.0, 1.5
    rows = [("c", i, math.cos(omega * i / rate / 2), 0.0, 0.0, math.sin(omega * i / rate / 2)) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, t bigint, qw double, qx double, qy double, qz double")
    out = S.angular_velocity(df, keys=["k"], order=["t"], q=["qw", "qx", "qy", "qz"], rate_hz=rate).collect()
    assert all(abs(r.wz - omega) < 1e-9 and abs(r.wx) < 1e-9 for r in out)


def test_resample_121_frames_at_120_hz_gives_26_samples(spark, split_keys):
    rows = [("c", round(i * 1e6 / 120), float(i)) for i in range(121)]
    df = spark.createDataFrame(rows, "k string, us bigint, v double")
    out = S.resample(df, keys=["k"], order=["us"], time_us="us", value="v", period_us=40_000).orderBy("grid").collect()
    assert len(out) == 26 and out[-1].resampled == pytest.approx(120.0)
    assert out[3].resampled == pytest.approx(14.4, abs=1e-3)


def test_step_angle_ignores_sign_and_sees_a_half_turn(spark):
    rows = [("c", 0, 1.0, 0.0, 0.0, 0.0), ("c", 1, -1.0, 0.0, 0.0, 0.0), ("c", 2, 0.0, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, t bigint, qw double, qx double, qy double, qz double")
    out = [r.step_rad for r in S.step_angle(df, keys=["k"], order=["t"], q=["qw", "qx", "qy", "qz"]).orderBy("t").collect()]
    assert out[0] is None and out[1] == pytest.approx(0.0) and math.degrees(out[2]) == pytest.approx(180.0)


def test_boundary_peaks(spark):
    force = [60.0, 10.0, 10.0, 10.0, 10.0, 120.0]
    df = spark.createDataFrame([("c", i, 0, f) for i, f in enumerate(force)], "k string, t bigint, mount bigint, f double")
    seg = S.boundary_segments(df, keys=["k"], order=["t"], guard_s=0.2, rate_hz=25)
    assert seg.select("edge").distinct().collect()[0].edge == 2
    r = S.segment_peaks(seg, keys=["k"], magnitude="f", mount="mount").first()
    assert (r.first_peak, r.interior_peak, r.last_peak, r.last_sample) == (60.0, 10.0, 120.0, 5)
    assert (r.first_ratio, r.last_ratio) == (6.0, 12.0)


def test_short_recording_keeps_all_rows_under_the_guard(spark):
    df = spark.createDataFrame([("c", i, 1.0) for i in range(10)], "k string, t bigint, d double")
    r = S.convergence(df, keys=["k"], order=["t"], difference="d", guard_s=0.2, rate_hz=25).first()
    assert (r.evaluated, r.guard_complete) == (10, False)


@pytest.mark.parametrize("chunk", [7, 65536])
def test_filter_holds_the_ends(spark, chunk):
    rnd = random.Random(2)
    vals = [rnd.uniform(-1, 1) for _ in range(40)]
    df = spark.createDataFrame([("c", i, v) for i, v in enumerate(vals)], "k string, t bigint, v double")
    out = S.symmetric_filter(df, keys=["k"], order=["t"], value="v", taps=[0.4, 0.2, 0.1], chunk=chunk).orderBy("t").collect()
    pad = [vals[0]] * 2 + vals + [vals[-1]] * 2
    want = [0.4 * pad[i + 2] + 0.2 * (pad[i + 1] + pad[i + 3]) + 0.1 * (pad[i] + pad[i + 4]) for i in range(40)]
    assert [r.filtered for r in out] == pytest.approx(want)


def test_timing_lookup_marks_what_is_outside(spark):
    t = spark.createDataFrame([(1, 0, 0), (1, 10, 100)], "k int, t bigint, m bigint")
    p = spark.createDataFrame([(1, 1, 0), (1, 2, 4), (1, 3, 10), (1, 4, 11)], "k int, id bigint, t bigint")
    out = {r.id: r for r in S.timing_lookup(p, t, keys=["k"], probe_time="t", probe_id="id", time="t", value="m").collect()}
    assert [out[i].mapped for i in (1, 2, 3)] == [0.0, 40.0, 100.0] and out[4].out_of_range


def test_window_rows_keep_one_guard_row(spark):
    df = spark.createDataFrame([(1, t) for t in (0, 10, 20, 30, 40)], "k int, t bigint")
    out = S.window_rows(df, keys=["k"], order=["t"], time="t", start=15, stop=25).collect()
    assert sorted(r.t for r in out) == [10, 20, 30] and not out[0].out_of_range


def test_step_ns_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 1, 2_000_000_000), (-1, 1, 2_000_000_000), (7, 1, 120), (3, 0, 1), (2 ** 62, 4, 1)],
                               "s bigint, n bigint, d bigint")
    got = [r.x for r in df.select(clocks.step_ns(F.col("s"), F.col("n"), F.col("d")).alias("x")).collect()]
    assert got == [1, -1, 58333333, None, None]


def test_aligned_work_rate(spark):
    df = spark.createDataFrame([(100.0,), (240.0,), (60.0,), (29.97,)], "hz double")
    got = [r.x for r in df.select(clocks.aligned_work_rate(F.lit(240.0), F.col("hz")).alias("x")).collect()]
    assert got[:3] == [300.0, 240.0, 240.0] and got[3] == pytest.approx(29.97 * 9)


def test_clock_period(spark):
    df = spark.createDataFrame([(120.0,), (59.94,)], "hz double")
    got = [tuple(r.p) for r in df.select(clocks.clock_period(F.col("hz")).alias("p")).collect()]
    assert got == [(1, 120), (50, 2997)]


def test_noise_depends_on_the_row_only(spark):
    df = spark.range(20000).select(F.col("id").alias("i"), F.lit(0.0).alias("x"))
    cal = spark.createDataFrame([("x", 1.0, 2.0, 0.5)], "axis string, bias double, scale double, noise_std double")
    run = lambda d: {r.i: r.x for r in S.apply_calibration(d, cal, identity=["i"], axes=["x"], seed=9).collect()}
    one, two = run(df), run(df.repartition(13))
    assert one == two
    assert np.mean(list(one.values())) == pytest.approx(1.0, abs=0.02) and np.std(list(one.values())) == pytest.approx(0.5, abs=0.02)


def test_an_axis_without_calibration_keeps_its_values(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, None, 6.0)], "i int, x double, y double")
    cal = spark.createDataFrame([("x", 1.0, None, None)], "axis string, bias double, scale double, noise_std double")
    run = lambda c: sorted(tuple(r) for r in S.apply_calibration(df, c, identity=["i"], axes=["x", "y"], seed=1).collect())
    assert run(cal) == [(1, 3.0, 5.0), (2, None, 6.0)] and run(cal.limit(0)) == [(1, 2.0, 5.0), (2, None, 6.0)]


def test_world_transforms_match_numpy(spark):
    rnd = np.random.default_rng(1)
    parents = [-1, 0, 1, 0, 3, 4]
    q = rnd.normal(size=(6, 4))
    q /= np.linalg.norm(q, axis=1)[:, None]
    off = rnd.normal(size=(6, 3))
    df = spark.createDataFrame([(q.tolist(), off.tolist())], "rot array<array<double>>, off array<array<double>>")
    world = J.world_transforms(df, parents, rotations="rot", offsets="off").first().world

    def mat(a):
        w, x, y, z = a
        return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
                         [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
                         [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    rot, pos = [], []
    for j, p in enumerate(parents):
        rot.append(mat(q[j]) if p < 0 else rot[p] @ mat(q[j]))
        pos.append(off[j] if p < 0 else pos[p] + rot[p] @ off[j])
        t = world[j]
        assert np.allclose(mat([t.qw, t.qx, t.qy, t.qz]), rot[j]) and np.allclose([t.px, t.py, t.pz], pos[j])
    with pytest.raises(ValueError):
        J.world_transforms(df, [-1, 2, 0], rotations="rot", offsets="off")


def test_euler_order_matters(spark):
    df = spark.createDataFrame([(90.0,)], "a double")
    q = R.euler_quaternion([("Z", F.col("a")), ("X", F.col("a"))])
    r = df.select(*[c.alias(n) for c, n in zip(q, "wxyz")]).first()
    assert [r.w, r.x, r.y, r.z] == pytest.approx([0.5, 0.5, 0.5, 0.5])


def test_identical_orientations_have_no_error(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0)], "k int, e double")
    r = M.angle_metrics(df, keys=["k"], error="e").first()
    assert (r.mean_geodesic_deg, r.rmse_geodesic_deg, r.p95_geodesic_deg) == (0.0, 0.0, 0.0)
    v = spark.createDataFrame([(1, 1.0, 1.0), (1, 1.0, 2.0)], "k int, a double, b double")
    assert M.vector_metrics(v, keys=["k"], reference=["a"], estimate=["b"]).first().pearson_correlation is None
