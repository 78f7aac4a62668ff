"""Time-series and rotation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings.common import (CLIP, E, ORDER, Q, QUAT, QUAT2, SERIES, VEC, poses, rounded, signal)
from strideframe.bindings.registry import query
from strideframe.functions import clocks
from strideframe.functions import rotations as R
from strideframe.operators import signals as S
from strideframe.plans.recurrence import butterworth
from strideframe.session import literal_rows
from strideframe.sources.tables import read

FRAME = ["vec_id"]
NUM, DEN = 25920, 100           # nominal period of one event row, seconds as a fraction


def _violation(df, rule, key, detail):
    return df.select(F.lit(rule).alias("rule") if isinstance(rule, str) else rule.alias("rule"),
                     key.cast("string").alias("key"), detail.cast("string").alias("detail"))


@query("w04_monotonicity", E + """
SELECT 'not-increasing' AS rule, CAST(event_id AS VARCHAR) AS key,
       event_type AS detail
FROM (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY us, event_id) AS p FROM e)
WHERE value <= p""")
def w04(spark, d):
    out = S.monotonicity(signal(spark, d), keys=CLIP + SERIES, order=ORDER, value="value")
    return _violation(out, "not-increasing", F.col("event_id"), F.col("event_type"))


@query("w05_first_difference", E + """
SELECT event_id, round((us - pt) / 1e6, 6) AS dt_s, round(abs(value - pv), 6) AS difference,
       round(abs(value - pv) / nullif((us - pt) / 1e6, 0), 6) AS speed
FROM (SELECT *, lag(us) OVER w AS pt, lag(value) OVER w AS pv FROM e
      WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id))""")
def w05(spark, d):
    out = S.first_difference(signal(spark, d), keys=CLIP + SERIES, order=ORDER, value="value", time_us="us")
    return rounded(out.select("event_id", "dt_s", "difference", "speed"), "dt_s", "difference", "speed")


@query("w06_step_angle", Q + """
SELECT vec_id, CASE WHEN a IS NOT NULL THEN round(degrees(2*acos(least(1.0, abs(qw*a + qx*b + qy*c + qz*d)))), 6) END AS step_deg
FROM (SELECT *, lag(qw) OVER w AS a, lag(qx) OVER w AS b, lag(qy) OVER w AS c, lag(qz) OVER w AS d FROM q
      WINDOW w AS (PARTITION BY label ORDER BY vec_id))""")
def w06(spark, d):
    out = S.step_angle(poses(spark, d), keys=["label"], order=FRAME, q=QUAT)
    return out.select("vec_id", F.round(F.degrees("step_rad"), 6).alias("step_deg"))


@query("w07_angular_velocity", Q + """
, n AS (SELECT *, lag(qw) OVER w AS aw, lag(qx) OVER w AS ax, lag(qy) OVER w AS ay, lag(qz) OVER w AS az,
       lead(qw) OVER w AS bw, lead(qx) OVER w AS bx, lead(qy) OVER w AS by_, lead(qz) OVER w AS bz FROM q
       WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
s AS (SELECT vec_id, CASE WHEN aw IS NULL OR bw IS NULL THEN 25.0 ELSE 12.5 END AS rate,
       coalesce(aw,qw) AS aw, coalesce(ax,qx) AS ax, coalesce(ay,qy) AS ay, coalesce(az,qz) AS az,
       coalesce(bw,qw) AS bw, coalesce(bx,qx) AS bx, coalesce(by_,qy) AS by_, coalesce(bz,qz) AS bz FROM n),
r AS (SELECT vec_id, rate, bw*aw+bx*ax+by_*ay+bz*az AS w, -bw*ax+bx*aw-by_*az+bz*ay AS x,
       -bw*ay+bx*az+by_*aw-bz*ax AS y, -bw*az-bx*ay+by_*ax+bz*aw AS z FROM s),
v AS (SELECT *, sqrt(x*x+y*y+z*z) AS n FROM r),
f AS (SELECT *, rate * (CASE WHEN w < 0 THEN -1 ELSE 1 END)
       * (CASE WHEN n < 1e-12 THEN 2.0 ELSE 2*atan2(n, abs(w))/n END) AS k FROM v)
SELECT vec_id, round(k*x, 6) AS wx, round(k*y, 6) AS wy, round(k*z, 6) AS wz FROM f""")
def w07(spark, d):
    out = S.angular_velocity(poses(spark, d), keys=["label"], order=FRAME, q=QUAT, rate_hz=25.0)
    return rounded(out.select("vec_id", "wx", "wy", "wz"), "wx", "wy", "wz")


_MAT = """(1-2*(qy*qy+qz*qz)) AS m00, 2*(qx*qy-qz*qw) AS m01, 2*(qx*qz+qy*qw) AS m02,
 2*(qx*qy+qz*qw) AS m10, (1-2*(qx*qx+qz*qz)) AS m11, 2*(qy*qz-qx*qw) AS m12,
 2*(qx*qz-qy*qw) AS m20, 2*(qy*qz+qx*qw) AS m21, (1-2*(qx*qx+qy*qy)) AS m22"""


@query("w08_specific_force", Q + f"""
, a AS (SELECT *, (lead(vx) OVER w - 2*vx + lag(vx) OVER w)/0.0016 AS ax,
 (lead(vy) OVER w - 2*vy + lag(vy) OVER w)/0.0016 AS ay, (lead(vz) OVER w - 2*vz + lag(vz) OVER w)/0.0016 AS az
 FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
c AS (SELECT vec_id, {_MAT}, coalesce(ax, lag(ax) OVER w, lead(ax) OVER w) AS ax,
 coalesce(ay, lag(ay) OVER w, lead(ay) OVER w) AS ay, coalesce(az, lag(az) OVER w, lead(az) OVER w)+9.81 AS az
 FROM a WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT vec_id, round(m00*ax+m10*ay+m20*az, 4) AS fx, round(m01*ax+m11*ay+m21*az, 4) AS fy,
 round(m02*ax+m12*ay+m22*az, 4) AS fz FROM c""")
def w08(spark, d):
    out = S.specific_force(poses(spark, d), keys=["label"], order=FRAME, position=VEC, q=QUAT, dt_s=0.04)
    return rounded(out.select("vec_id", "fx", "fy", "fz"), "fx", "fy", "fz", places=4)


_POS = E + """, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS pos,
 count(*) OVER (PARTITION BY user_id) AS n FROM e)"""


@query("w09_guard_trim", _POS + """
SELECT event_id, pos, n > 10 AS guard_complete FROM p WHERE n <= 10 OR (pos >= 5 AND pos < n - 5)""")
def w09(spark, d):
    out = S.guard_trim(signal(spark, d), keys=CLIP, order=ORDER, guard_s=0.2, rate_hz=25)
    return out.select("event_id", "pos", "guard_complete")


TAPS = [6 / 16, 4 / 16, 1 / 16]          # half kernel, centre first


@query("w10_symmetric_filter", _POS + """
, w AS (SELECT *, first_value(value) OVER o AS f, last_value(value) OVER o AS l,
 lag(value,1) OVER s AS p1, lag(value,2) OVER s AS p2, lead(value,1) OVER s AS n1, lead(value,2) OVER s AS n2
 FROM p WINDOW s AS (PARTITION BY user_id ORDER BY pos),
 o AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT event_id, round(value*0.375 + (coalesce(p1,f)+coalesce(n1,l))*0.25
 + (coalesce(p2,f)+coalesce(n2,l))*0.0625, 6) AS filtered FROM w""")
def w10(spark, d):
    out = S.symmetric_filter(signal(spark, d), keys=CLIP, order=ORDER, value="value", taps=TAPS)
    return rounded(out.select("event_id", "filtered"), "filtered")


RATE, CUTOFF, HOLD_S = 25.0, 5.0, 1.0
_SECTIONS = butterworth(6, CUTOFF, RATE)
HELD = 46                       # rows that the ends are held for: one second and three times the filter's reach


def _two_way_sql() -> str:
    """Both runs row by row, as three direct-form sections one after the other."""
    def run(name, source):
        """A recursion over rows (k, i, x) of `source`; sections are worked out one below the other by lateral joins."""
        zero = ", ".join(f"x * {(1 - b0)!r} AS s{2 * j}, x * {(b2 - a2)!r} AS s{2 * j + 1}" for j, (b0, _, b2, _, a2) in enumerate(_SECTIONS))
        outs, chain, x = [], [], "s.x"
        for j, (b0, b1, b2, a1, a2) in enumerate(_SECTIONS):
            chain.append(f"(SELECT {b0!r}*{x} + r.s{2 * j} AS y{j}) l{j}")
            outs.append(f"{b1!r}*{x} - ({a1!r})*l{j}.y{j} + r.s{2 * j + 1}, {b2!r}*{x} - ({a2!r})*l{j}.y{j}")
            x = f"l{j}.y{j}"
        return (f"{name} AS (SELECT k, CAST(-1 AS BIGINT) AS i, x AS y, {zero} FROM {source} WHERE i = 0 UNION ALL "
                f"SELECT s.k, s.i, {x}, {', '.join(outs)} FROM {name} r JOIN {source} s ON s.k = r.k AND s.i = r.i + 1, {', '.join(chain)})")

    return f"""
WITH RECURSIVE e AS (SELECT *, epoch_us(ts) AS us FROM events),
p AS (SELECT event_id, user_id AS k, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n, CAST(value AS DOUBLE) AS x FROM e),
f0 AS (SELECT k, i, x FROM p UNION ALL SELECT k, n + h, x FROM p, (SELECT unnest(range({HELD})) AS h) WHERE i = n - 1),
{run('f1', 'f0')},
b0 AS (SELECT k, max(i) OVER (PARTITION BY k) - i AS i, y AS x FROM f1 WHERE i >= 0),
{run('b1', 'b0')}
SELECT event_id, round(y, 6) AS filtered FROM p JOIN b1 ON b1.k = p.k AND b1.i = p.n + {HELD} - 1 - p.i"""


@query("w10_recursive_filter", _two_way_sql())
def w10_recursive(spark, d):
    out = S.recursive_filter(signal(spark, d), keys=CLIP, order=ORDER, value="value", rate_hz=RATE, cutoff_hz=CUTOFF, hold_s=HOLD_S)
    return rounded(out.select("event_id", "filtered"), "filtered")


# Natural cubic splines by elimination down the rows and substitution back, row by row.
@query("w08_spline_acceleration", Q.replace("WITH q", "WITH RECURSIVE q") + """
, t AS (SELECT vec_id, label, vec_id * 0.04 AS t, vx, vy, vz, row_number() OVER w AS i, count(*) OVER (PARTITION BY label) AS n FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
h AS (SELECT *, t - lag(t) OVER w AS h0, lead(t) OVER w - t AS h1, lag(vx) OVER w AS px, lead(vx) OVER w AS nx, lag(vy) OVER w AS py, lead(vy) OVER w AS ny,
 lag(vz) OVER w AS pz, lead(vz) OVER w AS nz FROM t WINDOW w AS (PARTITION BY label ORDER BY i)),
r AS (SELECT vec_id, label, i, n, CASE WHEN i IN (1, n) THEN 0 ELSE h0 END AS a, CASE WHEN i IN (1, n) THEN 1 ELSE 2*(h0+h1) END AS b, CASE WHEN i IN (1, n) THEN 0 ELSE h1 END AS c,
 CASE WHEN i IN (1, n) THEN 0 ELSE 6*((nx-vx)/h1-(vx-px)/h0) END AS dx, CASE WHEN i IN (1, n) THEN 0 ELSE 6*((ny-vy)/h1-(vy-py)/h0) END AS dy,
 CASE WHEN i IN (1, n) THEN 0 ELSE 6*((nz-vz)/h1-(vz-pz)/h0) END AS dz FROM h),
f AS (SELECT label, i, n, vec_id, c/b AS g, dx/b AS ex, dy/b AS ey, dz/b AS ez FROM r WHERE i = 1 UNION ALL
 SELECT r.label, r.i, r.n, r.vec_id, r.c/(r.b-r.a*f.g), (r.dx-r.a*f.ex)/(r.b-r.a*f.g), (r.dy-r.a*f.ey)/(r.b-r.a*f.g), (r.dz-r.a*f.ez)/(r.b-r.a*f.g)
 FROM f JOIN r ON r.label = f.label AND r.i = f.i + 1),
s AS (SELECT label, i, vec_id, ex AS x, ey AS y, ez AS z FROM f WHERE i = n UNION ALL
 SELECT f.label, f.i, f.vec_id, f.ex-f.g*s.x, f.ey-f.g*s.y, f.ez-f.g*s.z FROM s JOIN f ON f.label = s.label AND f.i = s.i - 1)
SELECT vec_id, round(x, 4) AS ax, round(y, 4) AS ay, round(z, 4) AS az FROM s""")
def w08_spline(spark, d):
    rows = poses(spark, d).withColumn("t", F.col("vec_id") * 0.04)
    out = S.spline_acceleration(rows, keys=["label"], order=FRAME, time_s="t", position=VEC)
    return rounded(out.select("vec_id", "ax", "ay", "az"), "ax", "ay", "az", places=4)


HOUR = 3_600_000_000


@query("w11_resample", E + """
, n AS (SELECT user_id, event_id, us, value, lead(us) OVER w AS us1, lead(value) OVER w AS v1,
 min(us) OVER (PARTITION BY user_id) AS t0 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
g AS (SELECT user_id, unnest(range(CAST(0 AS BIGINT), (max(us)-min(us))//3600000000 + 1)) AS grid, min(us) AS t0
 FROM e GROUP BY user_id)
SELECT g.user_id, grid, grid*3600000000 AS grid_us,
 round(CASE WHEN us1 IS NULL OR g.t0+grid*3600000000 = us THEN value
   ELSE value + (v1-value)*(g.t0+grid*3600000000-us)/(us1-us) END, 6) AS resampled
FROM g JOIN n ON g.user_id = n.user_id AND n.us <= g.t0 + grid*3600000000
 AND (n.us1 IS NULL OR n.us1 > g.t0 + grid*3600000000)""")
def w11(spark, d):
    out = S.resample(signal(spark, d), keys=CLIP, order=ORDER, time_us="us", value="value", period_us=HOUR)
    return rounded(out, "resampled")


@query("w12_sign_continuity", Q + """
, f AS (SELECT *, CASE WHEN qw*lag(qw) OVER w + qx*lag(qx) OVER w + qy*lag(qy) OVER w + qz*lag(qz) OVER w < 0
 THEN 1 ELSE 0 END AS flip FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
s AS (SELECT *, CASE WHEN sum(flip) OVER (PARTITION BY label ORDER BY vec_id) % 2 = 1 THEN -1 ELSE 1 END AS s FROM f)
SELECT vec_id, round(qw*s, 6) AS qw, round(qx*s, 6) AS qx, round(qy*s, 6) AS qy, round(qz*s, 6) AS qz FROM s""")
def w12(spark, d):
    out = S.sign_continuity(poses(spark, d), keys=["label"], order=FRAME, q=QUAT)
    return rounded(out.select("vec_id", *QUAT), *QUAT)


@query("w18_first_last", E + """
, f AS (SELECT user_id, event_type, arg_min(value, (us, event_id)) AS first_value,
 arg_max(value, (us, event_id)) AS last_value FROM e GROUP BY ALL)
SELECT *, round(abs(last_value - first_value), 6) AS seam FROM f""")
def w18(spark, d):
    return rounded(S.first_last(signal(spark, d), keys=CLIP + SERIES, order=ORDER, value="value"), "seam")


@query("w19_declared_windows", _POS + """
, s AS (SELECT DISTINCT event_id, pos, n, x AS window_start FROM p,
 (SELECT unnest([0, 1, 2]) AS k) CROSS JOIN LATERAL (SELECT CASE k WHEN 0 THEN 0 WHEN 1 THEN (n-30)//2 ELSE n-30 END AS x)
 WHERE n >= 30)
SELECT event_id, pos, window_start FROM s WHERE pos >= window_start AND pos < window_start+30
 AND ((pos-window_start) % 5 = 0 OR pos = window_start+29)""")
def w19(spark, d):
    out = S.declared_windows(signal(spark, d), keys=CLIP, order=ORDER, width=30, stride=5)
    return out.select("event_id", "pos", "window_start")


@query("w20_decimate", _POS + """
, k AS (SELECT DISTINCT user_id, CAST(round_even(k*2.4, 0) AS BIGINT) AS pos FROM (SELECT DISTINCT user_id, n FROM p),
 LATERAL (SELECT unnest(range(CAST(0 AS BIGINT), n)) AS k) WHERE k/25.0 < (n-1)/60.0)
SELECT event_id, p.pos FROM p JOIN k ON p.user_id = k.user_id AND p.pos = k.pos""")
def w20(spark, d):
    out = S.decimate(signal(spark, d), keys=CLIP, order=ORDER, source_hz=60.0, target_hz=25.0)
    return out.select("event_id", "pos")


_SEG = _POS + """, g AS (SELECT *, least(5, (n-1)//2) AS edge,
 CASE WHEN pos < least(5,(n-1)//2) THEN 'first' WHEN pos >= n - least(5,(n-1)//2) THEN 'last' ELSE 'interior' END AS segment FROM p)"""


@query("w22_boundary_segments", _SEG + " SELECT event_id, edge, segment FROM g")
def w22(spark, d):
    out = S.boundary_segments(signal(spark, d), keys=CLIP, order=ORDER, guard_s=0.2, rate_hz=25)
    return out.select("event_id", "edge", "segment")


DAY10, DAY12 = 1_704_844_800_000_000, 1_705_017_600_000_000       # 2024-01-10 and 2024-01-12 UTC


@query("s11_window_rows", E + f"""
SELECT event_id, {DAY10} < lo OR {DAY12} > hi AS out_of_range FROM (
 SELECT *, lag(us) OVER w AS b, lead(us) OVER w AS a, min(us) OVER p AS lo, max(us) OVER p AS hi FROM e
 WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id), p AS (PARTITION BY user_id))
WHERE (a IS NULL OR a >= {DAY10}) AND (b IS NULL OR b <= {DAY12})""")
def s11(spark, d):
    out = S.window_rows(signal(spark, d), keys=CLIP, order=ORDER, time="us", start=DAY10, stop=DAY12)
    return out.select("event_id", "out_of_range")


@query("c13_regular_clock", E + """
, p AS (SELECT *, us*1000 AS t, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS step FROM e)
SELECT 'regular-clock' AS rule, CAST(event_id AS VARCHAR) AS key,
 CAST(CAST((2*CAST(step AS HUGEINT)*25920*1000000000+100)//200 AS BIGINT) AS VARCHAR) AS detail
FROM p WHERE t <> (2*CAST(step AS HUGEINT)*25920*1000000000+100)//200""")
def c13(spark, d):
    ev = signal(spark, d).withColumn("t", F.col("us") * 1000)
    out = S.regular_clock(ev, keys=CLIP, order=ORDER, time_ns="t", numerator=NUM, denominator=DEN)
    return _violation(out, "regular-clock", F.col("event_id"), F.col("expected_ns"))


@query("c14_replay_clock", E + """
, p AS (SELECT event_id, us*1000 AS t, us*1000 - lag(us*1000) OVER w AS gap, us*1000 - first_value(us*1000) OVER w
 - (2*CAST(row_number() OVER w - 1 AS HUGEINT)*25920*1000000000+100)//200 AS drift
 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT rule, CAST(event_id AS VARCHAR) AS key, CAST(t AS VARCHAR) AS detail FROM (
 SELECT 'clock-order' AS rule, * FROM p WHERE gap <= 0 UNION ALL
 SELECT 'clock-gap', * FROM p WHERE gap <> 259200000000 UNION ALL
 SELECT 'clock-drift', * FROM p WHERE abs(drift) > 1)""")
def c14(spark, d):
    ev = signal(spark, d).withColumn("t", F.col("us") * 1000)
    out = S.replay_clock(ev, keys=CLIP, order=ORDER, time_ns="t", numerator=NUM, denominator=DEN)
    return _violation(out, F.col("rule"), F.col("event_id"), F.col("t"))


@query("j08_timing_lookup", E + """
, t AS (SELECT user_id, us, value AS m FROM e WHERE event_type <> 'error'),
p AS (SELECT user_id, event_id, us FROM e WHERE event_type = 'error'),
b AS (SELECT p.*, t.us AS a_t, t.m AS a_m FROM p ASOF LEFT JOIN t ON p.user_id = t.user_id AND p.us >= t.us),
c AS (SELECT b.*, t.us AS b_t, t.m AS b_m FROM b ASOF LEFT JOIN t ON b.user_id = t.user_id AND b.us <= t.us),
m AS (SELECT user_id, event_id, us, CASE WHEN a_t = us THEN a_m
 ELSE a_m + (us-a_t)/nullif(b_t-a_t, 0)*(b_m-a_m) END AS x FROM c)
SELECT user_id, event_id, us, round(x, 6) AS mapped, x IS NULL AS out_of_range FROM m""")
def j08(spark, d):
    ev = signal(spark, d)
    out = S.timing_lookup(ev.where("event_type = 'error'"), ev.where("event_type <> 'error'"), keys=CLIP,
                          probe_time="us", probe_id="event_id", time="us", value="value")
    return rounded(out, "mapped")


_LAG = Q + """, n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM q),
j AS (SELECT a.label, a.pos, k.lag, 2*acos(least(1.0, abs(a.qw*b.pw+a.qx*b.px+a.qy*b.py+a.qz*b.pz))) AS err
 FROM n a CROSS JOIN (SELECT unnest([-2,-1,0,1,2]) AS lag) k JOIN n b ON a.label = b.label AND b.pos = a.pos + k.lag)"""


@query("j19_lagged_errors", _LAG + " SELECT label, pos, lag, round(err, 6) AS error_rad FROM j")
def j19(spark, d):
    out = S.lagged_errors(poses(spark, d), keys=["label"], order=FRAME, reference=QUAT, estimate=QUAT2)
    return rounded(out, "error_rad")


@query("a20_mean_error_by_lag", _LAG + " SELECT lag, round(avg(err), 6) AS mean_error_rad, count(*) AS pairs FROM j GROUP BY lag")
def a20(spark, d):
    out = S.lagged_errors(poses(spark, d), keys=["label"], order=FRAME, reference=QUAT, estimate=QUAT2)
    return rounded(S.mean_error_by_lag(out), "mean_error_rad")


_RUNS = """, w AS (SELECT *, first_value(value) OVER o AS f, last_value(value) OVER o AS l,
 lag(value,1) OVER s AS p1, lead(value,1) OVER s AS n1
 FROM p WINDOW s AS (PARTITION BY user_id ORDER BY pos),
 o AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
r AS (SELECT user_id, event_id, us, pos, n, abs(value - (value*0.5 + (coalesce(p1,f)+coalesce(n1,l))*0.25)) AS difference FROM w)"""


def _runs(spark, d):
    """Two derivations of the same series: as given, and filtered."""
    ev = signal(spark, d).select("user_id", "event_id", "us", "value")
    two = S.symmetric_filter(ev, keys=CLIP, order=ORDER, value="value", taps=[0.5, 0.25]).select(
        "user_id", "event_id", F.col("filtered").alias("value"))
    return S.compare_runs(ev, two, on=["user_id", "event_id"], values=["value"])


@query("j20_compare_runs", _POS + _RUNS + " SELECT event_id, round(difference, 6) AS difference FROM r")
def j20(spark, d):
    return rounded(_runs(spark, d).select("event_id", "difference"), "difference")


@query("a13_convergence", _POS + _RUNS + """
SELECT user_id, round(sqrt(avg(difference*difference)), 6) AS rms, round(max(difference), 6) AS peak,
 count(*) AS evaluated, n > 10 AS guard_complete
FROM r WHERE n <= 10 OR (pos >= 5 AND pos < n-5) GROUP BY user_id, n""")
def a13(spark, d):
    out = S.convergence(_runs(spark, d), keys=CLIP, order=ORDER, difference="difference", guard_s=0.2, rate_hz=25)
    return rounded(out, "rms", "peak")


@query("a14_segment_peaks", _SEG + """
, m AS (SELECT *, length(event_type) AS mount, abs(value) AS v FROM g),
x AS (SELECT user_id, max((v, -pos, -mount)) FILTER (segment='first') AS f, max((v, -pos, -mount)) FILTER (segment='interior') AS i,
 max((v, -pos, -mount)) FILTER (segment='last') AS l, max((v, -pos, -mount)) AS w FROM m GROUP BY user_id)
SELECT user_id, f[1] AS first_peak, -f[2] AS first_sample, -f[3] AS first_mount,
 i[1] AS interior_peak, -i[2] AS interior_sample, -i[3] AS interior_mount,
 l[1] AS last_peak, -l[2] AS last_sample, -l[3] AS last_mount, w[1] AS whole_peak, -w[2] AS whole_sample, -w[3] AS whole_mount,
 CASE WHEN i IS NOT NULL THEN round(f[1]/greatest(i[1], 1e-12), 6) END AS first_ratio,
 CASE WHEN i IS NOT NULL THEN round(l[1]/greatest(i[1], 1e-12), 6) END AS last_ratio FROM x""")
def a14(spark, d):
    seg = S.boundary_segments(signal(spark, d), keys=CLIP, order=ORDER, guard_s=0.2, rate_hz=25)
    seg = seg.withColumns({"mount": F.length("event_type").cast("bigint"), "v": F.abs("value")})
    return rounded(S.segment_peaks(seg, keys=CLIP, magnitude="v", mount="mount"), "first_ratio", "last_ratio")


@query("a15_path_features", Q + """
, s AS (SELECT *, lag(vec_id) OVER w AS f, sqrt((vx-lag(vx) OVER w)**2+(vy-lag(vy) OVER w)**2+(vz-lag(vz) OVER w)**2) AS st
 FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT label, round(coalesce(sum(st), 0), 6) AS path_length,
 round(sqrt((arg_max(vx,vec_id)-arg_min(vx,vec_id))**2+(arg_max(vy,vec_id)-arg_min(vy,vec_id))**2+(arg_max(vz,vec_id)-arg_min(vz,vec_id))**2), 6) AS net_displacement,
 round(max(st), 6) AS largest_step, arg_max(f, st) AS largest_step_frame FROM s GROUP BY label""")
def a15(spark, d):
    out = S.path_features(poses(spark, d), keys=["label"], order=FRAME, position=VEC, frame="vec_id")
    return rounded(out, "path_length", "net_displacement", "largest_step")


PEAKS_SQL = """, s AS (SELECT *, abs(value - lag(value) OVER w) / nullif((us - lag(us) OVER w)/1e6, 0) AS sp FROM e
 WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id)),
pk AS (SELECT user_id, bool_and(value IS NOT NULL) AS all_valid, coalesce(max(abs(value)), 0) AS peak_value,
 coalesce(max(sp), 0) AS peak_speed, count(*) AS samples FROM s GROUP BY user_id)"""


@query("a16_clip_peaks", E + PEAKS_SQL + """
SELECT user_id, all_valid, peak_value, round(peak_speed, 6) AS peak_speed, samples FROM pk""")
def a16(spark, d):
    out = S.clip_peaks(signal(spark, d), clip=CLIP, series=SERIES, order=ORDER, value="value", time_us="us")
    return rounded(out, "peak_speed")


@query("a25_robust_floor", """
WITH f AS (SELECT l_suppkey, l_orderkey, min(l_extendedprice) AS s, min(l_quantity) AS j FROM lineitem GROUP BY ALL)
SELECT l_suppkey, round(quantile_cont(s-j, 0.5), 6) AS sole_offset, round(quantile_cont(j, 0.01), 6) AS support_q01,
 round(quantile_cont(j, 0.01) + quantile_cont(s-j, 0.5), 6) AS ground FROM f GROUP BY l_suppkey""")
def a25(spark, d):
    out = S.robust_floor(read(spark, d, "lineitem"), clip="l_suppkey", frame="l_orderkey",
                         surface="l_extendedprice", support="l_quantity")
    return rounded(out, "sole_offset", "support_q01", "ground")


@query("a26_calibration_direction", _POS + """
, m AS (SELECT user_id, avg(value) AS x, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS y
 FROM p WHERE pos < 30 GROUP BY user_id)
SELECT user_id, round(x/sqrt(x*x+y*y), 6) AS left_x, round(y/sqrt(x*x+y*y), 6) AS left_y,
 round(y/sqrt(x*x+y*y), 6) AS forward_x, round(-x/sqrt(x*x+y*y), 6) AS forward_y FROM m""")
def a26(spark, d):
    ev = signal(spark, d).withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    out = S.calibration_direction(ev, keys=CLIP, order=ORDER, x="value", y="k")
    return rounded(out, "left_x", "left_y", "forward_x", "forward_y")


@query("a34_trace_comparison", Q + """
, s AS (SELECT label, vec_id, lag(vec_id) OVER w AS f,
 2*acos(least(1.0, abs(qw*lag(qw) OVER w+qx*lag(qx) OVER w+qy*lag(qy) OVER w+qz*lag(qz) OVER w))) AS a,
 2*acos(least(1.0, abs(pw*lag(pw) OVER w+px*lag(px) OVER w+py*lag(py) OVER w+pz*lag(pz) OVER w))) AS b
 FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id))
, r AS (SELECT label, vec_id, sqrt((vx-lag(vx) OVER w)**2 + (vy-lag(vy) OVER w)**2 + (vz-lag(vz) OVER w)**2) AS ra, sqrt((px-lag(px) OVER w)**2 + (py-lag(py) OVER w)**2 + (pz-lag(pz) OVER w)**2) AS rb,
 vx, vy, vz FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
g AS (SELECT label, round(max(abs(ra - rb)), 6) AS max_root_step_difference, round(sqrt((arg_max(vx, vec_id)-arg_min(vx, vec_id))**2 + (arg_max(vy, vec_id)-arg_min(vy, vec_id))**2 + (arg_max(vz, vec_id)-arg_min(vz, vec_id))**2), 6) AS root_displacement FROM r GROUP BY label)
SELECT s.label, any_value(max_root_step_difference) AS max_root_step_difference, any_value(root_displacement) AS root_displacement, round(degrees(max(abs(a-b))), 6) AS max_step_difference_deg,
 round(degrees(arg_min(a, vec_id)), 6) AS first_step_deg, round(degrees(arg_max(a, vec_id)), 6) AS last_step_deg,
 round(degrees(max(a)), 6) AS largest_step_deg, arg_max(vec_id, a) AS largest_step_frame
FROM s JOIN g ON g.label = s.label WHERE f IS NOT NULL GROUP BY s.label""")
def a34(spark, d):
    out = S.trace_comparison(poses(spark, d), keys=["label"], order=FRAME, frame="vec_id",
                             source=QUAT, canonical=QUAT2, roots=(VEC, QUAT2[1:]))
    return rounded(out, "max_root_step_difference", "root_displacement", "max_step_difference_deg", "first_step_deg", "last_step_deg", "largest_step_deg")


@query("f02_step_ns", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN s < 0 THEN -r ELSE r END AS BIGINT) AS ns FROM (
 SELECT *, (2*CAST(abs(s) AS HUGEINT)*l_linenumber*1000000000 + den)//(2*den) AS r FROM (
 SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey - 7000 AS s, CAST(l_suppkey + 1 AS HUGEINT) AS den FROM lineitem))""")
def f02(spark, d):
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        clocks.step_ns(F.col("l_orderkey") - 7000, F.col("l_linenumber"), F.col("l_suppkey") + 1).alias("ns"))


@query("f03_clock_period", """
WITH r AS (SELECT DISTINCT l_quantity + l_discount AS rate FROM lineitem),
c AS (SELECT rate, CAST(round(rate*100) AS BIGINT) AS n FROM r)
SELECT round(rate, 2) AS rate, 100 // gcd(n, 100) AS numerator, n // gcd(n, 100) AS denominator FROM c
GROUP BY ALL""")
def f03(spark, d):
    rates = read(spark, d, "lineitem").select(
        F.round(F.col("l_quantity") + F.col("l_discount"), 2).alias("rate")).distinct()
    return rates.select("rate", clocks.clock_period(F.col("rate")).alias("p")).select("rate", "p.*")


@query("f20_apply_calibration", """
WITH h AS (SELECT event_id, user_id, event_type, value, md5('7:' || event_id || ':value') AS m FROM events),
u AS (SELECT *, CAST(CAST('0x' || left(m, 12) AS BIGINT) AS DOUBLE) AS a, CAST(CAST('0x' || m[13:24] AS BIGINT) AS DOUBLE) AS b FROM h)
SELECT event_id, user_id, event_type, round(value * 1.002 + 0.03 + 0.02 * sqrt(-2 * ln((a + 1.0) / 281474976710656.0)) * cos(2 * pi() * b / 281474976710656.0), 6) AS value FROM u""")
def f20(spark, d):
    # Fixed example calibration values.
    profile = literal_rows(spark, [("value", 0.03, 1.002, 0.02)],
                           "axis string, bias double, scale double, noise_std double")
    out = S.apply_calibration(signal(spark, d).select("event_id", "user_id", "event_type", "value"), profile,
                              identity=["event_id"], axes=["value"], seed=7)
    return rounded(out, "value")


@query("f21_aligned_work_rate", """
SELECT DISTINCT l_quantity AS source_hz, greatest(1, ceil(240.0/l_quantity - 1e-12))*l_quantity AS work_hz FROM lineitem""")
def f21(spark, d):
    return read(spark, d, "lineitem").select(
        F.col("l_quantity").alias("source_hz"),
        clocks.aligned_work_rate(F.lit(240.0), F.col("l_quantity")).alias("work_hz")).distinct()


# --- rotations --------------------------------------------------------------------------

def _cols(names):
    return [F.col(c) for c in names]


@query("f08_quaternion_product", Q + """
SELECT vec_id, round(qw*pw-qx*px-qy*py-qz*pz, 6) AS w, round(qw*px+qx*pw+qy*pz-qz*py, 6) AS x,
 round(qw*py-qx*pz+qy*pw+qz*px, 6) AS y, round(qw*pz+qx*py-qy*px+qz*pw, 6) AS z FROM q""")
def f08(spark, d):
    out = R.multiply(_cols(QUAT), _cols(QUAT2))
    return poses(spark, d).select("vec_id", *[F.round(c, 6).alias(n) for c, n in zip(out, "wxyz")])


@query("f09_geodesic_angle", Q + """
SELECT vec_id, round(degrees(2*acos(least(1.0, abs(qw*pw+qx*px+qy*py+qz*pz)))), 6) AS degrees FROM q""")
def f09(spark, d):
    return poses(spark, d).select("vec_id", F.round(F.degrees(R.geodesic(_cols(QUAT), _cols(QUAT2))), 6).alias("degrees"))


@query("f10_rotation_vector", Q + """
, k AS (SELECT *, sqrt(qx*qx+qy*qy+qz*qz) AS n FROM q),
s AS (SELECT *, (CASE WHEN qw < 0 THEN -1 ELSE 1 END)*(CASE WHEN n < 1e-12 THEN 2.0 ELSE 2*atan2(n, abs(qw))/n END) AS k FROM k)
SELECT vec_id, round(k*qx, 6) AS rx, round(k*qy, 6) AS ry, round(k*qz, 6) AS rz FROM s""")
def f10(spark, d):
    vec = R.rotation_vector(_cols(QUAT))
    return poses(spark, d).select("vec_id", *[F.round(c, 6).alias(n) for c, n in zip(vec, ("rx", "ry", "rz"))])


@query("f11_rotate_vector", Q + f"""
, m AS (SELECT *, {_MAT} FROM q)
SELECT vec_id, round(m00*vx+m01*vy+m02*vz, 6) AS ax, round(m10*vx+m11*vy+m12*vz, 6) AS ay, round(m20*vx+m21*vy+m22*vz, 6) AS az,
 round(m00*vx+m10*vy+m20*vz, 6) AS ix, round(m01*vx+m11*vy+m21*vz, 6) AS iy, round(m02*vx+m12*vy+m22*vz, 6) AS iz FROM m""")
def f11(spark, d):
    fwd, inv = R.rotate(_cols(QUAT), _cols(VEC)), R.rotate_inverse(_cols(QUAT), _cols(VEC))
    return poses(spark, d).select("vec_id", *[F.round(c, 6).alias(n) for c, n in zip(
        fwd + inv, ("ax", "ay", "az", "ix", "iy", "iz"))])


# Fixed value: source axes (Y up) to canonical axes (Z up), and the position scale.
WORLD_FROM_SOURCE = [[1.0, 0.0, 0.0], [0.0, 0.0, -1.0], [0.0, 1.0, 0.0]]
POSITION_SCALE_M = 0.01


@query("f28_change_basis", Q + """
, o AS (SELECT label, arg_min(vx, vec_id) AS ox, arg_min(vy, vec_id) AS oy, arg_min(vz, vec_id) AS oz FROM q GROUP BY label)
SELECT vec_id, round((vx-ox)*0.01, 6) AS x, round(-(vz-oz)*0.01, 6)+0.0 AS y, round((vy-oy)*0.01, 6) AS z FROM q JOIN o USING (label)""")
def f28(spark, d):
    frames = poses(spark, d)
    o = S.Ordered(frames, ["label"], FRAME).totals({f"o{c}": F.min_by(c, "vec_id") for c in VEC}).done()
    moved = [(F.col(c) - F.col(f"o{c}")) * F.lit(POSITION_SCALE_M) for c in VEC]
    out = R.change_basis([[F.lit(x) for x in row] for row in WORLD_FROM_SOURCE], moved)
    return o.select("vec_id", *[(F.round(c, 6) + F.lit(0.0)).alias(n) for c, n in zip(out, "xyz")])


@query("f33_euler_quaternion", E + """
, a AS (SELECT event_id, radians(value)/2 AS z, radians(value/2)/2 AS x, radians(-value/3)/2 AS y FROM e),
b AS (SELECT event_id, cos(z)*cos(x) AS w, cos(z)*sin(x) AS i, sin(z)*sin(x) AS j, sin(z)*cos(x) AS k, y FROM a)
SELECT event_id, round(w*cos(y)-j*sin(y), 6) AS w, round(i*cos(y)-k*sin(y), 6) AS x,
 round(w*sin(y)+j*cos(y), 6) AS y, round(i*sin(y)+k*cos(y), 6) AS z FROM b""")
def f33(spark, d):
    v = F.col("value")
    q = R.euler_quaternion([("Z", v), ("X", v / 2), ("Y", -v / 3)])
    return signal(spark, d).select("event_id", *[F.round(c, 6).alias(n) for c, n in zip(q, "wxyz")])


@query("f35_calibrated_frame", Q + """
, n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM q),
a AS (SELECT a.label, a.pos, a.qw AS w, a.qx AS x, a.qy AS y, a.qz AS z FROM n a JOIN n b ON b.label = a.label + 1 AND a.pos = b.pos)
SELECT label, pos, round(0.5*w-0.5*x-0.5*y-0.5*z, 6) AS w0, round(0.5*x+0.5*w+0.5*z-0.5*y, 6) AS x0,
 round(0.5*y-0.5*z+0.5*w+0.5*x, 6) AS y0, round(0.5*z+0.5*y-0.5*x+0.5*w, 6) AS z0 FROM a""")
def f35(spark, d):
    """Measured series of a label against the series of the next label, cut to common length."""
    placed = S.Ordered(poses(spark, d), ["label"], FRAME).position("pos").done()
    other = placed.select((F.col("label") - 1).alias("label"), "pos")
    half, one, zero = F.lit(0.5), F.lit(1.0), F.lit(0.0)
    q = R.calibrated([half] * 4, _cols(QUAT), [one, zero, zero, zero])
    return placed.join(other, ["label", "pos"]).select(
        "label", "pos", *[F.round(c, 6).alias(f"{n}0") for c, n in zip(q, "wxyz")])


# Fixed mounts: name, joint offset in metres, rotation wxyz.
MOUNTS = [("left-lower-leg", 0.0, 0.0, 0.12, 1.0, 0.0, 0.0, 0.0), ("head", 0.0, 0.0, 0.08, 1.0, 0.0, 0.0, 0.0),
          ("back", -0.08, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0)]


@query("f36_mounted_sensor", Q + f"""
, m AS (SELECT *, {_MAT} FROM q),
t(mount, ox, oy, oz) AS (VALUES ('left-lower-leg', 0.0, 0.0, 0.12), ('head', 0.0, 0.0, 0.08), ('back', -0.08, 0.0, 0.0))
SELECT vec_id, mount, round(vx+m00*ox+m01*oy+m02*oz, 6) AS px, round(vy+m10*ox+m11*oy+m12*oz, 6) AS py,
 round(vz+m20*ox+m21*oy+m22*oz, 6) AS pz, round(qw, 6) AS w, round(qx, 6) AS x, round(qy, 6) AS y, round(qz, 6) AS z FROM m, t""")
def f36(spark, d):
    mounts = F.array(*[F.struct(F.lit(m[0]).alias("mount"), *[F.lit(v).alias(f"m{i}") for i, v in enumerate(m[1:])])
                       for m in MOUNTS])
    rows = poses(spark, d).withColumn("_m", F.explode(mounts)).select("*", "_m.*").drop("_m")
    pos, rot = R.mounted(_cols(VEC), _cols(QUAT), _cols(["m0", "m1", "m2"]), _cols(["m3", "m4", "m5", "m6"]))
    return rows.select("vec_id", "mount", *[F.round(c, 6).alias(n) for c, n in zip(pos + rot, (
        "px", "py", "pz", "w", "x", "y", "z"))])
