"""Rotations and poses as Column expressions: quaternions, 6-D rotations, matrices, slerp, rigid transforms.

A matrix is a list of rows of Columns; everything stays in whole-stage code generation. Angles are degrees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Matrix = list[list[Column]]
#: Least norm that a quaternion may have, and least divisor of a Gram-Schmidt step.
NORM_FLOOR = 1e-8


def norm(v: Sequence[Column]) -> Column:
    return F.sqrt(sum((c * c for c in v[1:]), v[0] * v[0]))


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0])


def clamp(c: Column, low: float, high: float) -> Column:
    """c within bounds; null and NaN stay what they are, for the finite check to find."""
    return F.when(c.isNull() | F.isnan(c), c).otherwise(F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def at_least(c: Column, low: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def unit_quaternion(q: Sequence[Column]) -> list[Column]:
    """q scaled to length 1; null where it is too short or not finite."""
    n = norm(q)
    return [F.when(n >= NORM_FLOOR, c / n) for c in q]


def quaternion_matrix(q: Sequence[Column], order: str = "xyzw") -> Matrix:
    """The rotation of a quaternion, which is normalised first."""
    if order not in ("xyzw", "wxyz"):
        raise ValueError(f"quaternion order {order!r}")
    x, y, z, w = unit_quaternion(q if order == "xyzw" else [*q[1:], q[0]])
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


def rot6d(m: Matrix) -> list[Column]:
    """The first two columns of a matrix."""
    return [m[0][0], m[1][0], m[2][0], m[0][1], m[1][1], m[2][1]]


def cross(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def rot6d_matrix(r: Sequence[Column], floor: float = NORM_FLOOR) -> Matrix:
    """The rotation that Gram-Schmidt makes of two columns."""
    n = at_least(norm(r[:3]), floor)
    a = [c / n for c in r[:3]]
    along = dot(a, r[3:])
    rest = [c - along * x for c, x in zip(r[3:], a, strict=True)]
    n = at_least(norm(rest), floor)
    b = [c / n for c in rest]
    c = cross(a, b)
    return [[a[i], b[i], c[i]] for i in range(3)]


def with_matrix(df: DataFrame, r: Sequence[str], prefix: str = "_m", floor: float = NORM_FLOOR) -> DataFrame:
    """df with the nine entries of `rot6d_matrix`, a projection for each step: as one expression, entries repeat one another's parts without bound."""
    t = lambda n: [F.col(f"{prefix}_{n}{i}") for i in range(3)]
    named = lambda n, cs: {f"{prefix}_{n}{i}": c for i, c in enumerate(cs)}
    n, along = F.col(f"{prefix}_n"), F.col(f"{prefix}_t")
    c = [F.col(x) for x in r]
    out = df.withColumns({f"{prefix}_n": norm(c[:3])}).withColumns({f"{prefix}_n": at_least(n, floor)}).withColumns(named("a", [x / n for x in c[:3]]))
    out = out.withColumns({f"{prefix}_t": dot(t("a"), c[3:])}).withColumns(named("b", [x - along * y for x, y in zip(c[3:], t("a"), strict=True)]))
    out = out.withColumns({f"{prefix}_n": norm(t("b"))}).withColumns({f"{prefix}_n": at_least(n, floor)}).withColumns(named("b", [x / n for x in t("b")]))
    out = out.withColumns({f"{prefix}{i}{j}": x for j, col in enumerate((t("a"), t("b"), cross(t("a"), t("b")))) for i, x in enumerate(col)})
    return out.drop(f"{prefix}_n", f"{prefix}_t", *[f"{prefix}_{k}{i}" for k in "ab" for i in range(3)])


def entries(prefix: str = "_m") -> Matrix:
    """The matrix of columns that `with_matrix` adds."""
    return [[F.col(f"{prefix}{i}{j}") for j in range(3)] for i in range(3)]


def multiply(a: Matrix, b: Matrix) -> Matrix:
    return [[a[i][0] * b[0][j] + a[i][1] * b[1][j] + a[i][2] * b[2][j] for j in range(3)] for i in range(3)]


def cosine(a: Matrix, b: Matrix) -> Column:
    """Cosine of the angle between two rotations, from the trace of a'b; rounding may take it beyond 1."""
    return (sum((a[i][j] * b[i][j] for i in range(3) for j in range(3) if i or j), a[0][0] * b[0][0]) - 1) / 2


def angle_of(cosine: Column) -> Column:
    """Degrees; best of a column of its own, since its bounds repeat it."""
    return F.degrees(F.acos(clamp(cosine, -1.0, 1.0)))


def relative_angle(a: Matrix, b: Matrix) -> Column:
    """Angle between two rotations, from the trace of a'b."""
    return angle_of(cosine(a, b))


def quaternion_angle(p: Sequence[Column], q: Sequence[Column]) -> Column:
    """Angle between two unit quaternions, the short way."""
    return F.degrees(2 * F.acos(clamp(F.abs(dot(p, q)), 0.0, 1.0)))


def matrix_quaternion(m: Matrix) -> list[Column]:
    """Unit quaternion x, y, z, w of a rotation, divided by its largest component's square root."""
    trace = m[0][0] + m[1][1] + m[2][2]
    first = (m[0][0] > m[1][1]) & (m[0][0] > m[2][2])
    second = m[1][1] > m[2][2]

    def pick(by_trace: Column, x: Column, y: Column, z: Column) -> Column:
        return F.when(trace > 0, by_trace).when(first, x).when(second, y).otherwise(z)

    s = pick(trace + 1, 1 + m[0][0] - m[1][1] - m[2][2], 1 + m[1][1] - m[0][0] - m[2][2], 1 + m[2][2] - m[0][0] - m[1][1])
    s = F.sqrt(at_least(F.when(trace.isNotNull(), s), 0.0)) * 2
    xy, xz, yz = m[0][1] + m[1][0], m[0][2] + m[2][0], m[1][2] + m[2][1]
    wx, wy, wz = m[2][1] - m[1][2], m[0][2] - m[2][0], m[1][0] - m[0][1]
    q = [pick(wx / s, s / 4, xy / s, xz / s), pick(wy / s, xy / s, s / 4, yz / s), pick(wz / s, xz / s, yz / s, s / 4), pick(s / 4, wx / s, wy / s, wz / s)]
    return unit_quaternion(q)


def slerp(p: Sequence[Column], q: Sequence[Column], t: Column | float) -> list[Column]:
    """Unit quaternions between two, the short way; nearly equal ones are mixed linearly."""
    t = F.lit(t) if not isinstance(t, Column) else t
    d = dot(p, q)
    sign = F.when(d < 0, -1.0).otherwise(1.0)
    theta = F.acos(clamp(F.abs(d), 0.0, 1.0))
    sine = F.sin(theta)
    flat = sine < NORM_FLOOR
    a = F.when(flat, 1 - t).otherwise(F.sin((1 - t) * theta) / sine)
    b = F.when(flat, t).otherwise(F.sin(t * theta) / sine) * sign
    return unit_quaternion([a * x + b * y for x, y in zip(p, q, strict=True)])


def axis_rotation(axis: str, degrees: float) -> list[list[float]]:
    """A constant rotation about one axis."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return {"x": [[1, 0, 0], [0, c, -s], [0, s, c]], "y": [[c, 0, s], [0, 1, 0], [-s, 0, c]], "z": [[c, -s, 0], [s, c, 0], [0, 0, 1]]}[axis]


def constant_product(*ms: list[list[float]]) -> list[list[float]]:
    out = ms[0]
    for m in ms[1:]:
        out = [[sum(out[i][k] * m[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    return out


def transform_pose(position: Sequence[Column], rotation: Matrix, translation: Sequence[float], degrees: Sequence[float], frame: str = "rotated_local") -> tuple[list[Column], Matrix]:
    """A pose times a constant offset: rotations about x, y and z in that order, and a translation.

    rotated_local: the translation is given in the offset's own axes; tracker: in the pose's.
    """
    if frame not in ("rotated_local", "tracker"):
        raise ValueError(f"translation frame {frame!r}")
    offset = constant_product(*(axis_rotation(a, d) for a, d in zip("xyz", degrees, strict=True)))
    t = list(translation)
    if frame == "rotated_local":
        t = [sum(offset[i][k] * t[k] for k in range(3)) for i in range(3)]
    moved = [p + rotation[i][0] * t[0] + rotation[i][1] * t[1] + rotation[i][2] * t[2] for i, p in enumerate(position)]
    return moved, multiply(rotation, [[F.lit(float(x)) for x in row] for row in offset])


def map_gripper(width: Column, observed: tuple[float, float], radians: tuple[float, float], clip: bool = True) -> Column:
    """Width to angle, linearly; the sentinel -1 (gripper off) passes, and so do null and NaN."""
    if not observed[1] > observed[0]:
        raise ValueError("the observed maximum must exceed the minimum")
    out = radians[0] + (width - observed[0]) / (observed[1] - observed[0]) * (radians[1] - radians[0])
    out = clamp(out, min(radians), max(radians)) if clip else out
    return F.when(width == -1.0, F.lit(-1.0)).otherwise(out)


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def rotation_error(m: Matrix) -> tuple[Column, Column]:
    """(largest deviation of m'm from the identity, deviation of the determinant from 1)."""
    orthogonal = F.greatest(*[F.abs(sum((m[k][i] * m[k][j] for k in (1, 2)), m[0][i] * m[0][j]) - float(i == j)) for i in range(3) for j in range(i, 3)])
    det = dot([m[0][0], m[1][0], m[2][0]], cross([m[0][1], m[1][1], m[2][1]], [m[0][2], m[1][2], m[2][2]]))
    return orthogonal, F.abs(det - 1)
