"""Recurrences and tridiagonal systems over the rows of a key, exact across ordered segments.

A recurrence looks sequential, but what a segment does to the values that enter it is a small affine map. Each segment is
reduced to that map, the maps of a key are composed in order on one row a segment, and each segment is then worked
out with the values that enter it. No task holds a key, and cuts do not change results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.plans.ordered import CUT, SEG, Ordered

POS, CARRY = "_pos", "_carry"
BLOCK = 64                  # rows of one matrix product


def over_segments(o: Ordered, columns: list[str], outs: list[str], summarise, fold, apply) -> DataFrame:
    """Double columns `outs` of every row, by summarise(columns) -> floats for each segment, fold(list of them in order) -> what
    enters each segment, apply(columns, what enters) -> outs. `columns` are given as float arrays in row order, nulls as NaN."""
    o.position(POS)
    group = [*o.keys, CUT, SEG]
    names = [f"_g{i}" for i in range(len(group))]
    rows = o.df.select("*", *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    given = [f"_x{i}" for i in range(len(columns))]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    key_types = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, group))

    def arrays(table):
        table = table.sort_by(POS)
        return table, [table.column(c).to_numpy().astype(float) for c in given]

    def reduce(table: pa.Table) -> pa.Table:
        _, values = arrays(table)
        state = np.asarray(summarise(*values), float)
        first = table.slice(0, 1)
        return pa.table([*(first.column(c) for c in group), pa.array([state.tobytes()], pa.binary())], names=[*names, CARRY])

    def compose(table: pa.Table) -> pa.Table:
        table = table.sort_by(names[-1])
        got = fold([np.frombuffer(b.as_py()) for b in table.column(CARRY)])
        return table.set_column(table.num_columns - 1, CARRY, pa.array([np.asarray(x, float).tobytes() for x in got], pa.binary()))

    left = [c for c in rows.columns if c not in given and c != POS]

    def finish(table: pa.Table, carry: pa.Table) -> pa.Table:
        table, values = arrays(table)
        found = apply(np.frombuffer(carry.column(CARRY)[0].as_py()), *values)
        return pa.table([*(table.column(c) for c in left), *(pa.array(x, pa.float64(), mask=np.isnan(x)) for x in found)], names=[*left, *outs])

    maps = rows.groupBy(*group).applyInArrow(reduce, f"{key_types}, {CARRY} binary")
    entering = maps.groupBy(*names[:-1]).applyInArrow(compose, f"{key_types}, {CARRY} binary")
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in left), *(f"`{c}` double" for c in outs)])
    return rows.groupBy(*group).cogroup(entering.groupBy(*names)).applyInArrow(finish, schema).drop(*o.drop)


def butterworth(poles: int, cutoff_hz: float, rate_hz: float) -> list[tuple]:
    """Second-order sections (b0, b1, b2, a1, a2) of a low-pass of an even number of poles, by the bilinear transform."""
    if poles % 2 or not 0 < cutoff_hz < rate_hz / 2:
        raise ValueError("an even number of poles and a cutoff below half the rate are needed")
    k = math.tan(math.pi * cutoff_hz / rate_hz)
    out = []
    for i in range(poles // 2):
        damp = 2 * math.sin(math.pi * (2 * i + 1) / (2 * poles))
        norm = 1 / (1 + k * damp + k * k)
        out.append((k * k * norm, 2 * k * k * norm, k * k * norm, 2 * (k * k - 1) * norm, (1 - k * damp + k * k) * norm))
    return out


class Cascade:
    """Sections one after the other as state equations: state' = A state + B x, y = C state + D x."""

    def __init__(self, sections):
        self.k = 2 * len(sections)

        def step(x, s):
            s = s.copy()
            for j, (b0, b1, b2, a1, a2) in enumerate(sections):
                y = b0 * x + s[2 * j]
                s[2 * j], s[2 * j + 1] = b1 * x - a1 * y + s[2 * j + 1], b2 * x - a2 * y
                x = y
            return x, s

        units = np.eye(self.k)
        self.c, self.a = np.zeros(self.k), np.zeros((self.k, self.k))
        for j in range(self.k):
            self.c[j], self.a[:, j] = step(0.0, units[j])
        self.d, self.b = step(1.0, np.zeros(self.k))
        self.steady = np.linalg.solve(np.eye(self.k) - self.a, self.b)
        powers = [np.eye(self.k)]
        for _ in range(BLOCK):
            powers.append(self.a @ powers[-1])
        self.powers = powers
        self.seen = np.stack([self.c @ p for p in powers[:BLOCK]])                  # output j rows after a state
        answer = np.concatenate([[self.d], self.seen[:-1] @ self.b])
        at = np.subtract.outer(np.arange(BLOCK), np.arange(BLOCK))
        self.inner = np.where(at >= 0, answer[np.maximum(at, 0)], 0.0)              # output from the inputs of the block
        self.left = np.stack([powers[BLOCK - 1 - j] @ self.b for j in range(BLOCK)], axis=1)

    def run(self, x, state):
        """(outputs, state after them)."""
        m, r = divmod(len(x), BLOCK)
        whole = x[:m * BLOCK].reshape(m, BLOCK)
        add, states = whole @ self.left.T, np.empty((m, self.k))
        for i in range(m):
            states[i] = state
            state = self.powers[BLOCK] @ state + add[i]
        y = (whole @ self.inner.T + states @ self.seen.T).ravel()
        if r:
            rest = x[m * BLOCK:]
            y = np.concatenate([y, self.inner[:r, :r] @ rest + self.seen[:r] @ state])
            state = self.powers[r] @ state + self.left[:, BLOCK - r:] @ rest
        return y, state

    def both_ways(self, hold: int):
        """summarise, fold and apply of a forward run and a run back over its outputs.

        Each key starts in the steady state of its first value and is held at its last for `hold` rows, from whose last output the
        run back starts in the steady state. Null values have no output and are left out.
        """
        k, zero = self.k, np.zeros(self.k)

        def summarise(x):
            x = x[~np.isnan(x)]
            n = len(x)
            y, ahead = self.run(x, zero)
            back = self.run(y[::-1], zero)[1]
            # What an entering state does to the state that the run back leaves with.
            turned = np.stack([self.run(self.run(np.zeros(n), e)[0][::-1], zero)[1] for e in np.eye(k)], axis=1)
            ends = [x[0], x[-1]] if n else [0.0, 0.0]
            return np.concatenate([[n], ends, ahead, back, turned.ravel(), np.linalg.matrix_power(self.a, n).ravel()])

        def fold(maps):
            cut = np.cumsum([0, 1, 2, k, k, k * k, k * k])
            parts = [[m[a:b] for a, b in zip(cut, cut[1:])] for m in maps]
            some = [p for p in parts if p[0][0]]
            if not some:
                return [np.zeros(2 * k) for _ in maps]
            state, enter = self.steady * some[0][1][0], []
            for _, _, ahead, _, _, over in parts:
                enter.append(state)
                state = over.reshape(k, k) @ state + ahead
            held, _ = self.run(np.full(hold, some[-1][1][1]), state)
            state, leave = self.run(held[::-1], self.steady * held[-1])[1], []
            for (_, _, _, back, turned, over), s in zip(parts[::-1], enter[::-1]):
                leave.append(state)
                state = over.reshape(k, k) @ state + back + turned.reshape(k, k) @ s
            return [np.concatenate(x) for x in zip(enter, leave[::-1])]

        def apply(entering, x):
            known = ~np.isnan(x)
            y, _ = self.run(x[known], entering[:k])
            out = np.full(len(x), np.nan)
            out[known] = self.run(y[::-1], entering[k:])[0][::-1]
            return [out]

        return summarise, fold, apply


def tridiagonal(a, b, c, d):
    """Solution of a[i] x[i-1] + b[i] x[i] + c[i] x[i+1] = d[i] for several right sides, by parallel cyclic reduction."""
    n, step = len(b), 1
    a, c, b, d = a.copy(), c.copy(), b.copy(), d.copy()
    a[0] = c[-1] = 0.0
    while step < n:
        up, down = np.zeros(n), np.zeros(n)
        up[step:] = -a[step:] / b[:-step]
        down[:-step] = -c[:-step] / b[step:]
        nb, nd, na, nc = b.copy(), d.copy(), np.zeros(n), np.zeros(n)
        nb[step:] += up[step:] * c[:-step]
        nb[:-step] += down[:-step] * a[step:]
        nd[step:] += up[step:, None] * d[:-step]
        nd[:-step] += down[:-step, None] * d[step:]
        na[step:] = up[step:] * a[:-step]
        nc[:-step] = down[:-step] * c[step:]
        a, b, c, d, step = na, nb, nc, nd, 2 * step
    return d / b[:, None]


def spline(sides: int):
    """summarise, fold and apply of the second derivatives of natural cubic splines through `sides` values.

    Columns are the time and the times before and after (NaN at the ends of a key), then value, before, after for each side.
    """
    def solved(t, before, after, *values):
        """Second derivatives as u + v * (the one before the segment) + w * (the one after it)."""
        h0, h1 = t - before, after - t
        end = np.isnan(h0) | np.isnan(h1)
        slope = [6 * ((nxt - y) / h1 - (y - prev) / h0) for y, prev, nxt in zip(values[0::3], values[1::3], values[2::3])]
        a, c, b = (np.where(end, x, y) for x, y in ((0.0, h0), (0.0, h1), (1.0, 2 * (h0 + h1))))
        right = np.zeros((len(t), sides + 2))
        right[:, :sides] = np.where(end[:, None], 0.0, np.stack(slope, axis=1))
        right[0, sides], right[-1, sides + 1] = -a[0], -c[-1]
        return tridiagonal(a, b, c, right)

    def summarise(*columns):
        x = solved(*columns)
        return np.concatenate([x[0], x[-1]])

    def fold(maps):
        # Last of a segment as p + q * (first of the next), from the left; then firsts and lasts from the right.
        p, q, firsts = np.zeros(sides), 0.0, []
        known = []
        for m in maps:
            head, tail = m[:sides + 2], m[sides + 2:]
            known.append((p, q))
            scale = 1 - head[sides] * q
            base, rise = (head[:sides] + head[sides] * p) / scale, head[sides + 1] / scale
            firsts.append((base, rise))
            p, q = tail[:sides] + tail[sides] * (p + q * base), tail[sides] * q * rise + tail[sides + 1]
        following, out = np.zeros(sides), []
        for (base, rise), (p, q) in zip(firsts[::-1], known[::-1]):
            first = base + rise * following
            out.append(np.concatenate([p + q * first, following]))
            following = first
        return out[::-1]

    def apply(entering, *columns):
        x = solved(*columns)
        found = x[:, :sides] + x[:, sides, None] * entering[:sides] + x[:, sides + 1, None] * entering[sides:]
        return list(found.T)

    return summarise, fold, apply
