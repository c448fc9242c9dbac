"""Iterative and greedy work on one episode at a time: step limits, turn sparsification, smoothing of rotations.

An episode is one recording, so it fits a task; episodes are dealt by their key and each is sorted by frame_index.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame


def _unit(q: np.ndarray) -> np.ndarray:
    return q / np.linalg.norm(q, axis=-1, keepdims=True)


def angles(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Degrees between unit quaternions."""
    return np.degrees(2 * np.arccos(np.clip(np.abs((p * q).sum(axis=-1)), 0, 1)))


def _lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt(np.add.reduce(v * v, axis=-1))


def slerp(p: np.ndarray, q: np.ndarray, t: np.ndarray | float) -> np.ndarray:
    d = (p * q).sum(axis=-1, keepdims=True)
    t = np.broadcast_to(np.asarray(t, float).reshape(-1, 1) if np.ndim(t) else np.full((1, 1), t), d.shape)
    theta = np.arccos(np.clip(np.abs(d), 0, 1))
    sine = np.sin(theta)
    flat = sine < 1e-8
    safe = np.where(flat, 1, sine)
    a = np.where(flat, 1 - t, np.sin((1 - t) * theta) / safe)
    b = np.where(flat, t, np.sin(t * theta) / safe) * np.where(d < 0, -1, 1)
    return _unit(a * p + b * q)


def limit_steps(values: np.ndarray, limit: float, tolerance: float, preserve: int, max_sweeps: int, rotation: bool) -> tuple[np.ndarray, int]:
    """Move rows until no step to the next exceeds the limit; the first and last `preserve` rows stay.

    A sweep treats pairs (0,1), (2,3), ..., then (1,2), (3,4), ...; a pair that is too far apart is pulled together by
    its excess, half from each end, or all from the end that may move. (rows, sweeps); rows: points or unit quaternions.
    The tolerance only says when the sweeps are enough.
    """
    if not (math.isfinite(limit) and limit > 0) or preserve < 1 or tolerance < 0:
        raise ValueError("the limit must be positive and finite, the tolerance 0 or more, and one frame at least preserved")
    v, n = values.astype(float).copy(), len(values)
    if n < 2:
        return v, 0
    preserve = min(preserve, n // 2)
    free = np.ones(n, bool)
    free[:preserve] = free[n - preserve :] = False
    measure = (lambda a, b: angles(a, b)) if rotation else (lambda a, b: _lengths(b - a))
    enough = limit + max(tolerance, 1e-7 if rotation else 1e-9)
    for sweep in range(1, max_sweeps + 1):
        for parity in (0, 1):
            d = measure(v[parity : n - 1 : 2], v[parity + 1 :: 2])
            far = np.flatnonzero(d > limit)
            if not len(far):
                continue
            i, d = 2 * far + parity, d[far]
            left, right = free[i], free[i + 1]
            stuck = ~(left | right)
            if stuck.any():
                if (d[stuck] > enough).any():
                    raise ValueError("two fixed frames are further apart than the limit")
                i, d, left, right = i[~stuck], d[~stuck], left[~stuck], right[~stuck]
            share = np.where(left & right, 0.5, np.where(left, 1.0, 0.0))
            excess = (d - limit) / d
            a, b = v[i], v[i + 1]
            if rotation:
                v[i], v[i + 1] = slerp(a, b, excess * share), slerp(b, a, excess * (1 - share))
            else:
                move = (b - a) * excess[:, None]
                v[i], v[i + 1] = a + move * share[:, None], b - move * (1 - share)[:, None]
        if measure(v[:-1], v[1:]).max() <= enough:
            return v, sweep
    raise RuntimeError(f"steps still exceed the limit after {max_sweeps} sweeps")


def limit_episode_steps(frames: DataFrame, limit: float, columns: Sequence[str] = ("x", "y", "z"), rotation: bool = False, tolerance: float = 1e-5, preserve: int = 1, max_sweeps: int = 3000, by: Sequence[str] = ("episode_index",), strict: bool = True) -> DataFrame:
    """frames with `columns` moved and `sweeps`; an episode that can't be done is an error, or with strict=False has sweeps -1."""
    columns, schema = list(columns), _with(frames, "sweeps int")

    def run(part: pa.Table) -> pa.Table:
        at = part["frame_index"].to_numpy()
        if (at[1:] < at[:-1]).any():  # frames that a window has numbered come in order
            part = part.take(np.argsort(at, kind="stable"))
        values, sweeps = np.column_stack([part[c].to_numpy() for c in columns]), -1
        try:
            moved, sweeps = limit_steps(values, limit, tolerance, preserve, max_sweeps, rotation)
        except (ValueError, RuntimeError):
            if strict:
                raise
        if sweeps >= 0:
            for k, c in enumerate(columns):
                i = part.schema.get_field_index(c)
                part = part.set_column(i, part.schema.field(i), pa.array(moved[:, k]).cast(part.schema.field(i).type))
        return part.append_column("sweeps", pa.array(np.full(len(part), sweeps, np.int32)))

    return frames.groupBy(*by).applyInArrow(run, schema)


def project_rotations(m: np.ndarray) -> np.ndarray:
    """The nearest rotations, by singular values; reflections turn their last axis."""
    u, _, vt = np.linalg.svd(m)
    u[np.linalg.det(u @ vt) < 0, :, 2] *= -1
    return u @ vt


def smooth_rotations(m: np.ndarray, window: int, passes: int, preserve: int) -> np.ndarray:
    """Binomial means of neighbouring matrices (ends repeated), projected after each pass; preserved rows stay."""
    n, half = len(m), window // 2
    if n < window:
        return m
    weights = np.array([math.comb(window - 1, k) for k in range(window)]) / 2.0 ** (window - 1)
    out = m
    for _ in range(passes):
        padded = np.concatenate([np.repeat(out[:1], half, 0), out, np.repeat(out[-1:], half, 0)])
        out = project_rotations(sum(w * padded[k : k + n] for k, w in enumerate(weights)))
    keep = min(preserve, n)
    out[:keep], out[n - keep :] = m[:keep], m[n - keep :]
    return out


def rot6d_matrices(r: np.ndarray) -> np.ndarray:
    a = r[:, :3] / np.maximum(np.linalg.norm(r[:, :3], axis=1, keepdims=True), 1e-8)
    b = r[:, 3:] - (a * r[:, 3:]).sum(axis=1, keepdims=True) * a
    b = b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-8)
    return np.stack([a, b, np.cross(a, b)], axis=2)


def smooth_episode_rotations(frames: DataFrame, columns: Sequence[str], window: int = 5, passes: int = 1, preserve: int = 2, by: Sequence[str] = ("episode_index",)) -> DataFrame:
    """frames with their six rotation columns smoothed."""
    columns = list(columns)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("frame_index")
        m = smooth_rotations(rot6d_matrices(part[columns].to_numpy(float)), window, passes, preserve)
        part[columns] = np.concatenate([m[:, :, 0], m[:, :, 1]], axis=1)
        return part

    return frames.groupBy(*by).applyInPandas(run, frames.schema)


def sparsify(arms: Sequence[dict[str, np.ndarray]], turn_deg: float, context: int, context_distance: float, dense: float, kept_step: float, position_error: float, rotation_error_deg: float | None = None, gripper_change: float | None = None, consecutive: int = 1) -> np.ndarray:
    """Which frames stay when dense frames in turns are removed one by one.

    arms: p (n x 3), and q (n x 4 unit quaternions) and g (n) where given. A frame may go if any arm turns there and
    moves little; the sharpest frame of each turn, and both ends, stay. Candidates go in order of local step (ties: the
    first), each only if in every arm the neighbours that are then kept bridge the gap within the errors.
    """
    n = len(arms[0]["p"])
    keep = np.ones(n, bool)
    if n < 2 * context + 1:
        return keep
    candidates, order = np.zeros(n, bool), np.full(n, np.inf)
    joint = np.zeros(n)
    for arm in arms:
        p, angle = arm["p"], np.zeros(n)
        a, b = p[context : n - context] - p[: n - 2 * context], p[2 * context :] - p[context : n - context]
        na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
        ok = (na >= context_distance) & (nb >= context_distance) & (na > 0) & (nb > 0)
        cos = (a * b).sum(axis=1) / np.where(ok, na * nb, 1)
        angle[context : n - context] = np.where(ok, np.degrees(np.arccos(np.clip(cos, -1, 1))), 0)
        step = np.concatenate([[np.inf], np.linalg.norm(np.diff(p, axis=0), axis=1), [np.inf]])
        local = np.maximum(step[:-1], step[1:])
        candidates |= (angle >= turn_deg) & (local <= dense)
        order, joint = np.minimum(order, local), np.maximum(joint, angle)
    turning = np.flatnonzero(joint >= turn_deg)
    protected = {0, n - 1}
    for region in np.split(turning, np.flatnonzero(np.diff(turning) > 1) + 1) if len(turning) else []:
        protected.add(int(region[np.argmax(joint[region])]))
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)  # kept neighbours, as a linked list
    for i in sorted((k for k in np.flatnonzero(candidates).tolist() if k not in protected), key=lambda k: (order[k], k)):
        a, b = int(before[i]), int(after[i])
        if b - a - 1 > consecutive:
            continue
        t = np.arange(1, b - a) / (b - a)
        if all(_bridges(arm, a, b, t, kept_step, position_error, rotation_error_deg, gripper_change) for arm in arms):
            keep[i] = False
            after[a], before[b] = b, a
    return keep


def _bridges(arm: dict[str, np.ndarray], a: int, b: int, t: np.ndarray, kept_step: float, position_error: float, rotation_error: float | None, gripper_change: float | None) -> bool:
    p = arm["p"]
    if np.linalg.norm(p[b] - p[a]) > kept_step:
        return False
    if np.linalg.norm(p[a] + (p[b] - p[a]) * t[:, None] - p[a + 1 : b], axis=1).max() > position_error:
        return False
    if gripper_change is not None and "g" in arm:
        g = arm["g"][a : b + 1]
        g = g[g != -1.0]
        if len(g) and np.ptp(g) > gripper_change:
            return False
    if rotation_error is not None and "q" in arm:
        ends = np.repeat(arm["q"][[a]], len(t), 0), np.repeat(arm["q"][[b]], len(t), 0)
        if angles(slerp(*ends, t), arm["q"][a + 1 : b]).max() > rotation_error:
            return False
    return True


def sparsify_turns(frames: DataFrame, columns: Sequence[str] = ("x", "y", "z"), **thresholds) -> DataFrame:
    """episode_index, frame_index of the frames that stay, of episodes with one arm's positions."""
    columns = list(columns)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("frame_index")
        keep = sparsify([{"p": part[columns].to_numpy(float)}], **thresholds)
        return part.loc[keep, ["episode_index", "frame_index"]]

    return frames.groupBy("episode_index").applyInPandas(run, "episode_index long, frame_index long")


def _with(df: DataFrame, more: str):
    from pyspark.sql import types as T

    return T.StructType(df.schema.fields + T.StructType.fromDDL(more).fields)
