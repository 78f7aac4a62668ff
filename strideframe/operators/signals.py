"""Time-series work: differences, filters, resampling, boundary windows, comparisons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strideframe.functions import rotations as R
from strideframe.functions.arrays import present
from strideframe.functions.clocks import step_ns
from strideframe.plans import recurrence
from strideframe.plans.ordered import Ordered, exact_percentiles, halo


def _ordered(df, keys, order):
    return Ordered(df, keys, order)


# --- W04, W05 -----------------------------------------------------------------

def monotonicity(df: DataFrame, *, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value does not strictly exceed the value before it."""
    o = _ordered(df, keys, order).neighbours(prev={"previous": value})
    return o.done().where(F.col(value) <= F.col("previous"))


def first_difference(df: DataFrame, *, keys: list[str], order: list[str], value: str,
                     time_us: str) -> DataFrame:
    """Step in seconds, absolute difference and speed against the row before."""
    o = _ordered(df, keys, order).neighbours(prev={"_t": time_us, "_v": value})
    dt = (F.col(time_us) - F.col("_t")) / F.lit(1e6)
    delta = F.abs(F.col(value) - F.col("_v"))
    return o.done().withColumns({"dt_s": dt, "difference": delta,
                                 "speed": delta / F.nullif(dt, F.lit(0.0))}).drop("_t", "_v")


# --- W06, W07, W12, W08 ---------------------------------------------------------

def _quat_names(prefix):
    return [f"{prefix}{c}" for c in "wxyz"]


def step_angle(df: DataFrame, *, keys: list[str], order: list[str], q: list[str],
               out: str = "step_rad") -> DataFrame:
    """Sign-invariant rotation angle from the previous frame to this one."""
    old = _quat_names("_p")
    o = _ordered(df, keys, order).neighbours(prev=dict(zip(old, q)))
    angle = R.geodesic([F.col(c) for c in q], [F.col(c) for c in old])
    return o.done().withColumn(out, angle).drop(*old)


def angular_velocity(df: DataFrame, *, keys: list[str], order: list[str], q: list[str],
                     rate_hz: float) -> DataFrame:
    """Centred angular velocity; the two ends use the one-step rotation."""
    old, new = _quat_names("_p"), _quat_names("_n")
    o = _ordered(df, keys, order).neighbours(prev=dict(zip(old, q)), following=dict(zip(new, q)))
    here, before, after = ([F.col(c) for c in names] for names in (q, old, new))
    first = F.col(old[0]).isNull()
    last = F.col(new[0]).isNull()
    start = [F.when(first, h).otherwise(b) for h, b in zip(here, before)]
    stop = [F.when(last, h).otherwise(a) for h, a in zip(here, after)]
    scale = F.when(first | last, F.lit(float(rate_hz))).otherwise(F.lit(rate_hz / 2.0))
    vec = R.rotation_vector(R.multiply(stop, R.conjugate(start)))
    return o.done().withColumns({f"w{a}": v * scale for a, v in zip("xyz", vec)}).drop(*old, *new)


def sign_continuity(df: DataFrame, *, keys: list[str], order: list[str], q: list[str]) -> DataFrame:
    """Flip quaternions so that consecutive frames have non-negative dot products."""
    old = _quat_names("_p")
    o = _ordered(df, keys, order).neighbours(prev=dict(zip(old, q)))
    flip = F.coalesce((R.dot([F.col(c) for c in q], [F.col(c) for c in old]) < 0).cast("bigint"), F.lit(0))
    o.with_columns({"_flip": flip}).running({"_flips": F.col("_flip")})
    sign = F.when(F.col("_flips") % 2 == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    return o.done().withColumns({c: F.col(c) * sign for c in q}).drop(*old, "_flip", "_flips")


def specific_force(df: DataFrame, *, keys: list[str], order: list[str], position: list[str],
                   q: list[str], dt_s: float, gravity: float = 9.81) -> DataFrame:
    """Second difference of position, ends copied, then R^T (a - g)."""
    old = [f"_p{c}" for c in position]
    new = [f"_n{c}" for c in position]
    o = _ordered(df, keys, order).neighbours(prev=dict(zip(old, position)), following=dict(zip(new, position)))
    raw = {f"_a{i}": (F.col(n) - 2 * F.col(c) + F.col(p)) / F.lit(dt_s * dt_s)
           for i, (c, p, n) in enumerate(zip(position, old, new))}
    o.with_columns(raw).fill(forward={f"_f{i}": F.col(f"_a{i}") for i in range(3)},
                             backward={f"_b{i}": F.col(f"_a{i}") for i in range(3)})
    acc = [F.coalesce(F.col(f"_a{i}"), F.col(f"_f{i}"), F.col(f"_b{i}")) for i in range(3)]
    force = R.rotate_inverse([F.col(c) for c in q], [acc[0], acc[1], acc[2] + F.lit(gravity)])
    return o.done().withColumns({f"f{a}": v for a, v in zip("xyz", force)}).drop(
        *old, *new, *raw, *[f"_{k}{i}" for k in "fb" for i in range(3)])


# --- W09, W10, W11, W18, W19, W20, W22 -------------------------------------------

def guard_trim(df: DataFrame, *, keys: list[str], order: list[str], guard_s: float,
               rate_hz: float) -> DataFrame:
    """Drop the guard at both ends; a recording too short for it is kept whole."""
    g = F.bround(F.lit(guard_s * rate_hz)).cast("bigint")
    out = _ordered(df, keys, order).position("pos", "n").done()
    complete = F.col("n") > 2 * g
    inside = (F.col("pos") >= g) & (F.col("pos") < F.col("n") - g)
    return out.withColumn("guard_complete", complete).where(~complete | inside)


def symmetric_filter(df: DataFrame, *, keys: list[str], order: list[str], value: str,
                     taps: list[float], out: str = "filtered", chunk: int = 65_536) -> DataFrame:
    """Zero-phase FIR with the end values held; `taps` is the half kernel from the centre."""
    placed = _ordered(df, keys, order).position("_pos").done()
    wide, w = halo(placed, keys, "_pos", len(taps) - 1, chunk)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.col(value) * F.lit(float(taps[0]))
    for k, tap in enumerate(taps[1:], 1):
        before = F.coalesce(F.lag(value, k).over(w), F.first(value).over(whole))
        after = F.coalesce(F.lead(value, k).over(w), F.last(value).over(whole))
        total = total + (before + after) * F.lit(float(tap))
    return wide.withColumn(out, total).where("_own").drop("_own", "_chunk", "_pos")


def recursive_filter(df: DataFrame, *, keys: list[str], order: list[str], value: str, rate_hz: float, cutoff_hz: float,
                     poles: int = 6, hold_s: float = 1.0, out: str = "filtered") -> DataFrame:
    """Zero-phase Butterworth low-pass: a recursive filter run forward and back over each key.

    The ends are held (`hold_s` seconds at the last value) and both runs start in their steady state; null values stay null and
    are left out. Runs cross segment cuts as affine maps of the filter's state.
    """
    cascade = recurrence.Cascade(recurrence.butterworth(poles, cutoff_hz, rate_hz))
    hold = math.ceil(hold_s * rate_hz) + 3 * (poles + 1)
    return recurrence.over_segments(_ordered(df, keys, order), [value], [out], *cascade.both_ways(hold))


def spline_acceleration(df: DataFrame, *, keys: list[str], order: list[str], time_s: str, position: list[str], prefix: str = "a") -> DataFrame:
    """Second derivatives at the rows of each key of natural cubic splines through the positions; zero at both ends.

    Between rows the second derivative is linear. Times must increase within a key; a key where they do not, or with a
    null time or position, gives nulls.
    """
    prev = {f"_p{i}": c for i, c in enumerate([time_s, *position])}
    following = {f"_f{i}": c for i, c in enumerate([time_s, *position])}
    o = _ordered(df, keys, order).neighbours(prev=prev, following=following)
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in [time_s, *position]])
    bad = F.when((F.col(time_s) <= F.col("_p0")) | (missing == 1), 1).otherwise(0)
    o.with_columns({"_wrong": bad}).totals({"_any": F.max("_wrong")})
    columns = [c for i, name in enumerate([time_s, *position]) for c in (name, f"_p{i}", f"_f{i}")]
    outs = [f"{prefix}{axis}" for axis in "xyz"[:len(position)]]
    found = recurrence.over_segments(o, columns, outs, *recurrence.spline(len(position)))
    return found.withColumns({c: F.when(F.col("_any") == 0, F.col(c)) for c in outs}).drop(*prev, *following, "_wrong", "_any")


GRID = 65_536


def resample(df: DataFrame, *, keys: list[str], order: list[str], time_us: str, value: str,
             period_us: int) -> DataFrame:
    """Linear interpolation on the regular grid that starts at the first row of the key.

    Each row emits the grid points between itself and the next row, so the grid is never
    built or joined as a whole.
    """
    o = (_ordered(df, keys, order).neighbours(following={"_t1": time_us, "_v1": value})
         .totals({"_t0": F.min(time_us)}))
    t, p = F.col(time_us) - F.col("_t0"), F.lit(period_us)
    lo = F.ceil(t / p)
    hi = F.when(F.col("_t1").isNull(), lo * 0 + F.floor(t / p)).otherwise(
        F.ceil((F.col("_t1") - F.col("_t0")) / p) - 1)
    rows = o.done().withColumns({"_lo": lo, "_hi": hi, "_rel": t}).where("_lo <= _hi")
    # Long gaps go through pieces of GRID points, so no array is longer than that or than a gap's number of pieces.
    piece = F.explode(F.sequence(F.floor(F.col("_lo") / GRID), F.floor(F.col("_hi") / GRID)))
    rows = rows.withColumn("_piece", piece).withColumn("grid", F.explode(F.sequence(
        F.greatest(F.col("_lo"), F.col("_piece") * GRID), F.least(F.col("_hi"), F.col("_piece") * GRID + GRID - 1))))
    at = F.col("grid") * p - F.col("_rel")
    gap = F.nullif(F.col("_t1") - F.col(time_us), F.lit(0))
    v = F.when((at == 0) | F.col("_t1").isNull(), F.col(value)).otherwise(
        F.col(value) + (F.col("_v1") - F.col(value)) * at / gap)
    return rows.select(*keys, "grid", (F.col("grid") * p).alias("grid_us"), v.alias("resampled"))


def first_last(df: DataFrame, *, keys: list[str], order: list[str], value: str) -> DataFrame:
    """First and last value of each key and the seam between them (a plain aggregate)."""
    rank = F.struct(*order)
    return (df.groupBy(*keys)
            .agg(F.min_by(value, rank).alias("first_value"), F.max_by(value, rank).alias("last_value"))
            .withColumn("seam", F.abs(F.col("last_value") - F.col("first_value"))))


def declared_windows(df: DataFrame, *, keys: list[str], order: list[str], width: int = 150,
                     stride: int = 5) -> DataFrame:
    """Sample rows of the start, middle and end windows; shorter keys have none."""
    placed = _ordered(df, keys, order).position("pos", "n").done().where(F.col("n") >= width)
    spare = F.col("n") - width
    starts = F.array_distinct(F.array(F.lit(0).cast("bigint"), F.floor(spare / 2), spare))
    rows = placed.withColumn("window_start", F.explode(starts))
    rel = F.col("pos") - F.col("window_start")
    return rows.where(((rel >= 0) & (rel < width) & (rel % stride == 0)) | (rel == width - 1))


def decimate(df: DataFrame, *, keys: list[str], order: list[str], source_hz: float,
             target_hz: float) -> DataFrame:
    """Rows that are nearest (half to even) to a tick of the target rate."""
    placed = _ordered(df, keys, order).position("pos", "n").done()
    ratio = source_hz / target_hz
    lo = F.greatest(F.lit(0), F.floor((F.col("pos") - 0.5) / ratio))
    hi = F.ceil((F.col("pos") + 0.5) / ratio)
    hit = F.exists(F.sequence(lo.cast("bigint"), hi.cast("bigint")), lambda k: (
        (F.rint(k * F.lit(ratio)) == F.col("pos"))
        & (k / F.lit(float(target_hz)) < (F.col("n") - 1) / F.lit(float(source_hz)))))
    return placed.where(hit)


def boundary_segments(df: DataFrame, *, keys: list[str], order: list[str], guard_s: float,
                      rate_hz: float) -> DataFrame:
    """Label every row first / interior / last."""
    placed = _ordered(df, keys, order).position("pos", "n").done()
    edge = F.least(F.greatest(F.lit(1), F.bround(F.lit(guard_s * rate_hz)).cast("bigint")),
                   F.floor((F.col("n") - 1) / 2))
    return placed.withColumn("edge", edge).withColumn(
        "segment", F.when(F.col("pos") < edge, "first")
        .when(F.col("pos") >= F.col("n") - edge, "last").otherwise("interior"))


# --- S11, C13, C14 ------------------------------------------------------------------

def window_rows(df: DataFrame, *, keys: list[str], order: list[str], time: str, start: int,
                stop: int) -> DataFrame:
    """Rows of a closed time window and exactly one guard row on each side."""
    o = (_ordered(df, keys, order).neighbours(prev={"_before": time}, following={"_after": time})
         .totals({"_lo": F.min(time), "_hi": F.max(time)}))
    keep = ((F.col("_after").isNull() | (F.col("_after") >= start))
            & (F.col("_before").isNull() | (F.col("_before") <= stop)))
    outside = (F.lit(start) < F.col("_lo")) | (F.lit(stop) > F.col("_hi"))
    return o.done().where(keep).withColumn("out_of_range", outside).drop("_before", "_after", "_lo", "_hi")


def regular_clock(df: DataFrame, *, keys: list[str], order: list[str], time_ns: str,
                  numerator: int, denominator: int) -> DataFrame:
    """Rows whose time differs from the rational clock at their position."""
    placed = _ordered(df, keys, order).position("step").done()
    expected = step_ns(F.col("step"), F.lit(numerator), F.lit(denominator))
    return placed.withColumn("expected_ns", expected).where(~F.col(time_ns).eqNullSafe(F.col("expected_ns")))


def replay_clock(df: DataFrame, *, keys: list[str], order: list[str], time_ns: str,
                 numerator: int, denominator: int) -> DataFrame:
    """Three clock checks per row: order, gap is floor or ceil of the period, drift <= 1 ns."""
    o = (_ordered(df, keys, order).neighbours(prev={"_before": time_ns}).position("_step")
         .totals({"_t0": F.min_by(time_ns, F.struct(*order))}))
    gap = F.col(time_ns) - F.col("_before")
    low = numerator * 10 ** 9 // denominator
    high = -(-numerator * 10 ** 9 // denominator)
    drift = F.abs(F.col(time_ns) - F.col("_t0")
                  - step_ns(F.col("_step"), F.lit(numerator), F.lit(denominator)))
    rules = present(
        F.when(gap <= 0, "clock-order"), F.when((gap != low) & (gap != high), "clock-gap"),
        F.when(drift > 1, "clock-drift"))
    return o.done().withColumn("rule", F.explode(rules)).drop("_before", "_step", "_t0")


# --- J08 -------------------------------------------------------------------------------

def timing_lookup(probes: DataFrame, timing: DataFrame, *, keys: list[str], probe_time: str,
                  probe_id: str, time: str, value: str) -> DataFrame:
    """Map probe times through a timing table: exact hit, else linear between neighbours.

    Probes outside the table are marked instead of failing.
    """
    k = [F.col(c) for c in keys]
    marks = timing.select(*k, F.col(time).alias("_t"), F.lit(0).alias("_probe"),
                          F.col(value).cast("double").alias("_m"), F.lit(None).cast("bigint").alias(probe_id))
    asks = probes.select(*k, F.col(probe_time).alias("_t"), F.lit(1).alias("_probe"),
                         F.lit(None).cast("double").alias("_m"), F.col(probe_id).cast("bigint").alias(probe_id))
    mark = F.when(F.col("_probe") == 0, F.struct("_t", "_m"))
    o = Ordered(marks.unionByName(asks), keys, ["_t", "_probe", probe_id]).fill(
        forward={"_a": mark}, backward={"_b": mark})
    a, b = F.col("_a"), F.col("_b")
    span = F.nullif((b["_t"] - a["_t"]).cast("double"), F.lit(0.0))
    mapped = F.when(a["_t"] == F.col("_t"), a["_m"]).otherwise(
        a["_m"] + (F.col("_t") - a["_t"]) / span * (b["_m"] - a["_m"]))
    return o.done().where(F.col("_probe") == 1).select(
        *keys, probe_id, F.col("_t").alias(probe_time), mapped.alias("mapped"), mapped.isNull().alias("out_of_range"))


# --- J19, A20, J20, A13 -------------------------------------------------------------------

def lagged_errors(df: DataFrame, *, keys: list[str], order: list[str], reference: list[str],
                  estimate: list[str], lags: tuple[int, ...] = (-2, -1, 0, 1, 2),
                  chunk: int = 65_536) -> DataFrame:
    """Angle between the reference at t and the estimate at t + lag, one row per lag."""
    placed = _ordered(df, keys, order).position("pos").done()
    wide, w = halo(placed, keys, "pos", max(abs(k) for k in lags), chunk)
    here = [F.col(c) for c in reference]
    pairs = [F.struct(F.lit(k).alias("lag"),
                      R.geodesic(here, [F.lead(c, k).over(w) for c in estimate]).alias("error_rad"))
             for k in lags]
    return (wide.withColumn("_pairs", F.array(*pairs)).where("_own")
            .select(*keys, "pos", F.explode("_pairs").alias("_e"))
            .select(*keys, "pos", "_e.lag", "_e.error_rad").where(F.col("error_rad").isNotNull()))


def mean_error_by_lag(errors: DataFrame) -> DataFrame:
    return errors.groupBy("lag").agg(F.avg("error_rad").alias("mean_error_rad"),
                                     F.count(F.lit(1)).alias("pairs"))


def compare_runs(one: DataFrame, two: DataFrame, *, on: list[str], values: list[str]) -> DataFrame:
    """Norm of the difference of two derivations of the same samples."""
    right = two.select(*on, *[F.col(v).alias(f"_r_{v}") for v in values])
    diff = F.sqrt(sum(((F.col(v) - F.col(f"_r_{v}")) ** 2 for v in values), F.lit(0.0)))
    return one.join(right, on).withColumn("difference", diff).drop(*[f"_r_{v}" for v in values])


def convergence(df: DataFrame, *, keys: list[str], order: list[str], difference: str,
                guard_s: float, rate_hz: float) -> DataFrame:
    """RMS and peak of a difference series after the boundary guard."""
    kept = guard_trim(df, keys=keys, order=order, guard_s=guard_s, rate_hz=rate_hz)
    d = F.col(difference)
    return kept.groupBy(*keys).agg(
        F.sqrt(F.avg(d * d)).alias("rms"), F.max(d).alias("peak"),
        F.count(F.lit(1)).alias("evaluated"), F.min("guard_complete").alias("guard_complete"))


# --- A14, A15, A16, A25, A26, A34 -------------------------------------------------------------

def segment_peaks(df: DataFrame, *, keys: list[str], magnitude: str, mount: str) -> DataFrame:
    """Peak and its place per boundary segment (input of `boundary_segments`)."""
    m = F.struct(F.col(magnitude).alias("v"), (-F.col("pos")).alias("s"), (-F.col(mount)).alias("m"))
    picks = {"first": F.col("segment") == "first", "interior": F.col("segment") == "interior",
             "last": F.col("segment") == "last", "whole": F.lit(True)}
    agg = df.groupBy(*keys).agg(*[F.max(F.when(c, m)).alias(f"_{n}") for n, c in picks.items()])
    cols = []
    for n in picks:
        cols += [F.col(f"_{n}.v").alias(f"{n}_peak"), (-F.col(f"_{n}.s")).alias(f"{n}_sample"),
                 (-F.col(f"_{n}.m")).alias(f"{n}_mount")]
    floor = F.greatest(F.col("_interior.v"), F.lit(1e-12))
    cols += [(F.col("_first.v") / floor).alias("first_ratio"), (F.col("_last.v") / floor).alias("last_ratio")]
    ratio = F.col("_interior").isNotNull()
    return agg.select(*keys, *cols[:-2], F.when(ratio, cols[-2]).alias("first_ratio"),
                      F.when(ratio, cols[-1]).alias("last_ratio"))


def path_features(df: DataFrame, *, keys: list[str], order: list[str], position: list[str],
                  frame: str) -> DataFrame:
    """Path length, net displacement and the largest step with its frame."""
    old = [f"_p{c}" for c in position]
    o = _ordered(df, keys, order).neighbours(prev={**dict(zip(old, position)), "_frame": frame})
    step = R.norm([F.col(c) - F.col(p) for c, p in zip(position, old)])
    rows = o.done().withColumn("_step", step)
    rank = F.struct(*order)
    ends = [(F.max_by(c, rank) - F.min_by(c, rank)) for c in position]
    best = F.max(F.struct(F.col("_step").alias("v"), (-F.col("_frame")).alias("f")))
    return rows.groupBy(*keys).agg(
        F.coalesce(F.sum("_step"), F.lit(0.0)).alias("path_length"),
        F.sqrt(sum((e * e for e in ends), F.lit(0.0))).alias("net_displacement"),
        best["v"].alias("largest_step"), (-best["f"]).alias("largest_step_frame"))


def clip_peaks(df: DataFrame, *, clip: list[str], series: list[str], order: list[str],
               value: str, time_us: str) -> DataFrame:
    """QA aggregate per clip: validity, value peak and speed peak (0 when there is no pair)."""
    rows = first_difference(df, keys=[*clip, *series], order=order, value=value, time_us=time_us)
    return rows.groupBy(*clip).agg(
        F.bool_and(F.col(value).isNotNull()).alias("all_valid"),
        F.coalesce(F.max(F.abs(F.col(value))), F.lit(0.0)).alias("peak_value"),
        F.coalesce(F.max("speed"), F.lit(0.0)).alias("peak_speed"),
        F.count(F.lit(1)).alias("samples"))


def robust_floor(df: DataFrame, *, clip: str, frame: str, surface: str, support: str) -> DataFrame:
    """Ground height: median offset of per-frame minima, then the 1% quantile."""
    frames = df.groupBy(clip, frame).agg(F.min(surface).alias("_s"), F.min(support).alias("_j"))
    frames = frames.withColumn("_d", F.col("_s") - F.col("_j"))
    offset = exact_percentiles(frames, [clip], "_d", {"sole_offset": 0.5})
    low = exact_percentiles(frames, [clip], "_j", {"support_q01": 0.01})
    return (offset.join(low, clip)
            .withColumn("ground", F.col("support_q01") + F.col("sole_offset")))


def calibration_direction(df: DataFrame, *, keys: list[str], order: list[str], x: str, y: str,
                          frames: int = 30) -> DataFrame:
    """Left axis from the mean of the first frames, and the forward axis it implies."""
    head = _ordered(df, keys, order).position("_pos").done().where(F.col("_pos") < frames)
    m = head.groupBy(*keys).agg(F.avg(x).alias("_x"), F.avg(y).alias("_y"))
    length = F.sqrt(F.col("_x") ** 2 + F.col("_y") ** 2)
    ok = length >= 1e-8
    lx = F.when(ok, F.col("_x") / length)
    ly = F.when(ok, F.col("_y") / length)
    return m.select(*keys, lx.alias("left_x"), ly.alias("left_y"),
                    ly.alias("forward_x"), (-lx).alias("forward_y"))


def trace_comparison(df: DataFrame, *, keys: list[str], order: list[str], frame: str,
                     source: list[str], canonical: list[str], roots: tuple[list[str], list[str]]) -> DataFrame:
    """Largest disagreement of the step angles and root steps of two series, the root's way, and the ends of the source."""
    cols = [*roots[0], *roots[1]]
    rows = _ordered(df, keys, order).neighbours(prev={f"_r{i}": c for i, c in enumerate(cols)}).done()
    rows = step_angle(rows, keys=keys, order=order, q=source, out="_s")
    rows = step_angle(rows, keys=keys, order=order, q=canonical, out="_c")
    rank = F.struct(*order)
    stepped = F.when(F.col("_s").isNotNull(), rank)
    best = F.max(F.when(F.col("_s").isNotNull(), F.struct(F.col("_s").alias("v"), (-F.col(frame)).alias("f"))))
    far = lambda part, at: F.sqrt(sum(((F.col(c) - F.col(f"_r{at + i}")) ** 2 for i, c in enumerate(part)), F.lit(0.0)))
    apart = F.abs(far(roots[0], 0) - far(roots[1], len(roots[0])))
    way = F.sqrt(sum(((F.max_by(c, rank) - F.min_by(c, rank)) ** 2 for c in roots[0]), F.lit(0.0)))
    return rows.groupBy(*keys).agg(
        F.degrees(F.max(F.abs(F.col("_s") - F.col("_c")))).alias("max_step_difference_deg"),
        F.degrees(F.min_by("_s", stepped)).alias("first_step_deg"),
        F.degrees(F.max_by("_s", stepped)).alias("last_step_deg"),
        F.degrees(best["v"]).alias("largest_step_deg"), (-best["f"]).alias("largest_step_frame"),
        F.max(apart).alias("max_root_step_difference"), way.alias("root_displacement")).where("largest_step_deg is not null")


# --- F20 ------------------------------------------------------------------------------------------

def hash_normal(seed: int, *keys: Column) -> Column:
    """Standard normal from a row identity, so that it does not depend on partitioning.

    Two uniform numbers come from the first and the next 12 hex digits of an MD5 digest of seed and identity.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))
    scale = F.lit(float(1 << 48))
    bits = [F.conv(F.substring(digest, i, 12), 16, 10).cast("double") for i in (1, 13)]
    return F.sqrt(-2 * F.log((bits[0] + 1.0) / scale)) * F.cos(2 * F.pi() * bits[1] / scale)


def apply_calibration(signals: DataFrame, calibration: DataFrame, *, identity: list[str],
                      axes: list[str], seed: int) -> DataFrame:
    """x * scale + bias + N(0, noise_std) per axis; `calibration` has one row per axis.

    An axis without a row keeps its values; null settings of a row count as scale 1, bias 0 and no noise.
    """
    setting = F.struct(F.coalesce("scale", F.lit(1.0)).alias("scale"), F.coalesce("bias", F.lit(0.0)).alias("bias"), F.coalesce("noise_std", F.lit(0.0)).alias("noise"))
    # One row of a few numbers, whatever the input.
    known = calibration.agg(*[F.max(F.when(F.col("axis") == a, setting)).alias(f"_c_{a}") for a in axes]).withColumn("_one", F.lit(1))
    wide = signals.withColumn("_one", F.lit(1)).join(F.broadcast(known), "_one").drop("_one")
    for axis in axes:
        c = F.col(f"_c_{axis}")
        noise = hash_normal(seed, *[F.col(i) for i in identity], F.lit(axis))
        changed = F.col(axis) * c["scale"] + c["bias"] + noise * c["noise"]
        wide = wide.withColumn(axis, F.when(c.isNull(), F.col(axis)).otherwise(changed))
    return wide.drop(*[f"_c_{a}" for a in axes])
