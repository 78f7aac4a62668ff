"""Rotation and vector algebra as column expressions (quaternions are wxyz, active)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = list[Column]


def parts(array: Column, start: int, count: int) -> Vec:
    """`count` elements of an array column from zero-based `start`, as doubles."""
    return [F.get(array, F.lit(start + i)).cast("double") for i in range(count)]


def dot(a: Vec, b: Vec) -> Column:
    return reduce(lambda x, y: x + y, [p * q for p, q in zip(a, b)])


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vec) -> Vec:
    n = F.nullif(norm(a), F.lit(0.0))
    return [p / n for p in a]


def conjugate(q: Vec) -> Vec:
    return [q[0], -q[1], -q[2], -q[3]]


def multiply(a: Vec, b: Vec) -> Vec:
    """Hamilton product."""
    aw, ax, ay, az = a
    bw, bx, by, bz = b
    return [aw * bw - ax * bx - ay * by - az * bz,
            aw * bx + ax * bw + ay * bz - az * by,
            aw * by - ax * bz + ay * bw + az * bx,
            aw * bz + ax * by - ay * bx + az * bw]


def geodesic(a: Vec, b: Vec) -> Column:
    """Sign-invariant angle in radians between two rotations."""
    cosine = F.abs(dot(a, b)) / F.nullif(norm(a) * norm(b), F.lit(0.0))
    return 2 * F.acos(F.when(cosine > 1.0, 1.0).otherwise(cosine))


def rotation_vector(q: Vec) -> Vec:
    """Axis times angle along the shortest arc."""
    v = norm(q[1:])
    angle = 2 * F.atan2(v, F.abs(q[0]))
    sign = F.when(q[0] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    scale = sign * F.when(v < 1e-12, F.lit(2.0)).otherwise(angle / F.nullif(v, F.lit(0.0)))
    return [scale * c for c in q[1:]]


def matrix(q: Vec) -> list[Vec]:
    w, x, y, z = unit(q)
    return [[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
            [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
            [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]


def change_basis(rows: list[Vec], v: Vec) -> Vec:
    """Matrix times vector."""
    return [dot(row, v) for row in rows]


def rotate(q: Vec, v: Vec) -> Vec:
    return change_basis(matrix(q), v)


def rotate_inverse(q: Vec, v: Vec) -> Vec:
    m = matrix(q)
    return change_basis([[m[r][c] for r in range(3)] for c in range(3)], v)


def cross(a: Vec, b: Vec) -> Vec:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def rotate_by_unit(q: Vec, v: Vec) -> Vec:
    """Rotation by a quaternion that is already a unit: v + 2w(u x v) + 2u x (u x v)."""
    once = cross(q[1:], v)
    twice = cross(q[1:], once)
    return [x + 2 * (q[0] * a + b) for x, a, b in zip(v, once, twice)]


def euler_quaternion(channels: list[tuple[str, Column]]) -> Vec:
    """Rotation channels in declared order, e.g. ``[("Z", deg), ("X", deg), ("Y", deg)]``."""
    q = [F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)]
    for axis, degrees in channels:
        half = F.radians(degrees) / 2
        one = [F.cos(half), F.lit(0.0), F.lit(0.0), F.lit(0.0)]
        one["XYZ".index(axis) + 1] = F.sin(half)
        q = multiply(q, one)
    return q


def mounted(joint_position: Vec, joint_rotation: Vec, offset: Vec, mount: Vec) -> tuple[Vec, Vec]:
    """World position and orientation of a sensor fixed to a joint."""
    turned = rotate(joint_rotation, offset)
    return [p + t for p, t in zip(joint_position, turned)], multiply(joint_rotation, mount)


def calibrated(nav_to_model: Vec, measured: Vec, bone_to_sensor: Vec) -> Vec:
    """Measured device orientation expressed in the model frame."""
    return multiply(multiply(nav_to_model, measured), bone_to_sensor)
