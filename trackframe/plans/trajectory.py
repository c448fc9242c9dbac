"""The trajectory pipeline as one plan: convert, smooth, limit steps, trim, sparsify, and statistics of the result.

Frames go in by arm (episode_index, frame_index, role, x..qw, width) and come out as poses (x, y, z, r0..r5, gripper) by
arm, with the selection of source frames that media outputs follow. Stages that are off aren't in the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackframe.functions import geometry as g
from trackframe.operators import kernels, stats, trim, validate, windows

from .config import Settings

XYZ, R6, Q = ("x", "y", "z"), ("r0", "r1", "r2", "r3", "r4", "r5"), ("qx", "qy", "qz", "qw")
POSE = (*XYZ, *R6, "gripper")
ARM = ("episode_index", "role")
#: Names of a pose's slots in a dataset; fixed values.
SLOT_NAMES = ("x", "y", "z", "rot6d_0", "rot6d_1", "rot6d_2", "rot6d_3", "rot6d_4", "rot6d_5", "gripper_angle_rad")


@dataclass
class Result:
    frames: DataFrame
    selection: DataFrame
    stats: DataFrame
    global_stats: DataFrame
    violations: DataFrame
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Free what the run keeps for its outputs and checks."""
        for df in self.held:
            df.unpersist()


def convert(arms: DataFrame, settings: Settings) -> DataFrame:
    """Poses of both arms with the rotation as six numbers and the gripper's angle."""
    t = settings.trajectory
    p, m = [F.col(c) for c in XYZ], g.quaternion_matrix([F.col(c) for c in Q])
    if t.translation is not None:
        p, m = g.transform_pose(p, m, t.translation, t.rotation_deg, t.translation_frame)
    grip = g.map_gripper(F.col("width"), tuple(t.observed_width), tuple(t.gripper_radians), t.clip)
    named = zip([*p, *g.rot6d(m), grip], POSE, strict=True)
    return arms.select("episode_index", "frame_index", "role", *[c.alias(n) for c, n in named])


def smooth(poses: DataFrame, settings: Settings) -> DataFrame:
    """Positions and rotations smoothed by arm, the gripper untouched; one grouped map, since rotations need it anyway."""
    s = settings.smoothing
    columns = [*XYZ, *R6]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("frame_index")
        m = kernels.smooth_rotations(kernels.rot6d_matrices(part[list(R6)].to_numpy(float)), s.window_size, s.passes, s.preserve_endpoint_frames)
        p = smooth_points(part[list(XYZ)].to_numpy(float), s.window_size, s.passes, s.preserve_endpoint_frames)
        part[columns] = np.concatenate([p, m[:, :, 0], m[:, :, 1]], axis=1)
        return part

    return poses.groupBy(*ARM).applyInPandas(run, poses.schema)


def smooth_points(p: np.ndarray, window: int, passes: int, preserve: int) -> np.ndarray:
    import math

    n, half, out = len(p), window // 2, p
    if n < window:
        return p
    weights = np.array([math.comb(window - 1, k) for k in range(window)]) / 2.0 ** (window - 1)
    for _ in range(passes):
        padded = np.concatenate([np.repeat(out[:1], half, 0), out, np.repeat(out[-1:], half, 0)])
        out = sum(w * padded[k : k + n] for k, w in enumerate(weights))
    keep = min(preserve, n)
    out[:keep], out[n - keep :] = p[:keep], p[n - keep :]
    return out


def steps(poses: DataFrame) -> DataFrame:
    """The larger of the arms' steps, by frame from the second on."""
    rotated = g.with_matrix(poses.select("episode_index", "frame_index", "role", *XYZ, *R6), R6)
    w = windows.ordered(ARM)
    now = g.entries()
    was = [[F.lag(f"_m{i}{j}").over(w) for j in range(3)] for i in range(3)]
    s = rotated.select("episode_index", "frame_index", windows.position_step(ARM).alias("p"), g.cosine(was, now).alias("r"))
    s = s.withColumn("r", g.angle_of(F.col("r")))
    return s.where("p is not null").groupBy("episode_index", "frame_index").agg(F.max("p").alias("position_step"), F.max("r").alias("rotation_step"))


def limit(poses: DataFrame, settings: Settings, position: float, rotation_deg: float) -> DataFrame:
    s = settings.step_limit
    out = kernels.limit_episode_steps(poses, position * s.storage_margin, XYZ, False, s.position_tolerance_mm / 1000, s.preserve_endpoint_frames, s.max_sweeps, ARM).drop("sweeps")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("frame_index")
        q = quaternions(kernels.rot6d_matrices(part[list(R6)].to_numpy(float)))
        q, _ = kernels.limit_steps(q, rotation_deg * s.storage_margin, s.rotation_tolerance_deg, s.preserve_endpoint_frames, s.max_sweeps, True)
        part[list(R6)] = first_columns(q)
        return part

    return out.groupBy(*ARM).applyInPandas(run, out.schema)


def quaternions(m: np.ndarray) -> np.ndarray:
    """Unit quaternions x, y, z, w of rotations: the eigenvector of the largest eigenvalue."""
    k = np.empty((len(m), 4, 4))
    t = np.trace(m, axis1=1, axis2=2)
    k[:, :3, :3] = m + m.transpose(0, 2, 1) - t[:, None, None] * np.eye(3)
    k[:, 3, :3] = k[:, :3, 3] = np.stack([m[:, 2, 1] - m[:, 1, 2], m[:, 0, 2] - m[:, 2, 0], m[:, 1, 0] - m[:, 0, 1]], axis=1)
    k[:, 3, 3] = t
    return np.linalg.eigh(k)[1][:, :, 3]


def first_columns(q: np.ndarray) -> np.ndarray:
    x, y, z, w = q.T
    return np.stack([1 - 2 * (y * y + z * z), 2 * (x * y + z * w), 2 * (x * z - y * w), 2 * (x * y - z * w), 1 - 2 * (x * x + z * z), 2 * (y * z + x * w)], axis=1)


def bounds(poses: DataFrame, settings: Settings) -> DataFrame:
    """Trim bounds of whole episodes: a frame is active if any arm moved, turned or gripped away from the end's pose."""
    s = settings.trim
    rotated = g.with_matrix(poses.select(*ARM, "frame_index", *XYZ, *R6, "gripper"), R6)
    whole = windows.whole(ARM)

    def active(pick) -> Column:
        there = lambda c: pick(c).over(whole)
        now = g.entries()
        ref = [[there(f"_m{i}{j}") for j in range(3)] for i in range(3)]
        far = g.norm([F.col(c) - there(c) for c in XYZ]) > s.position_threshold
        turned = g.relative_angle(ref, now) > s.rotation_threshold_deg
        gripped = (F.col("gripper") != -1.0) & (there("gripper") != -1.0) & (F.abs(F.col("gripper") - there("gripper")) > s.gripper_threshold)
        return far | turned | gripped

    a = rotated.select("episode_index", "frame_index", active(F.first).alias("a"), active(F.last).alias("b"))
    a = a.groupBy("episode_index", "frame_index").agg(F.bool_or("a").alias("a"), F.bool_or("b").alias("b"))
    return trim.trim_bounds(a, 0.0, pre=s.pre_roll_frames, post=s.post_roll_frames, least=s.min_episode_frames, run=s.min_active_frames, active_first=F.col("a"), active_last=F.col("b"))


def restored(arms: list[dict[str, np.ndarray]], kept: np.ndarray, limits: tuple[float, float] | None) -> np.ndarray:
    """kept, and all frames between two kept ones whose step in any arm is over the limits (position, degrees)."""
    if limits is None or len(kept) < 2:
        return kept
    far = np.zeros(len(kept) - 1, bool)
    for a in arms:
        p, q = a["p"][kept], a["q"][kept]
        far |= np.linalg.norm(np.diff(p, axis=0), axis=1) > limits[0]
        far |= kernels.angles(q[:-1], q[1:]) > limits[1]
    back = [np.arange(kept[i] + 1, kept[i + 1]) for i in np.flatnonzero(far)]
    return np.unique(np.concatenate([kept, *back]))


def kept_frames(poses: DataFrame, settings: Settings, limits: tuple[float, float] | None = None) -> DataFrame:
    """episode_index, kept (source frames): a sampled prefix, then turns thinned in what the prefix left.

    limits: steps that the kept frames may make; stretches whose removal makes longer ones are put back.
    """
    s = settings.turn_sparsification

    def run(part: pd.DataFrame) -> pd.DataFrame:
        arms = []
        for _, arm in part.sort_values("frame_index").groupby("role"):
            m = kernels.rot6d_matrices(arm[list(R6)].to_numpy(float))
            arms.append({"p": arm[list(XYZ)].to_numpy(float), "q": quaternions(m), "g": arm["gripper"].to_numpy(float)})
        kept = prefix(arms, s.prefix_frames, s.prefix_min_spacing)
        inner = [{k: v[kept] for k, v in arm.items()} for arm in arms]
        stay = kernels.sparsify(
            inner, s.turn_angle_threshold_deg, s.turn_context_frames, s.min_turn_context_distance, s.dense_step_threshold, s.max_kept_step,
            s.max_position_error, s.max_rotation_error_deg, s.gripper_change_threshold, s.max_consecutive_removed,
        )
        return pd.DataFrame({"episode_index": [part["episode_index"].iloc[0]], "kept": [restored(arms, kept[stay], limits).tolist()]})

    return poses.groupBy("episode_index").applyInPandas(run, "episode_index long, kept array<int>")


def prefix(arms: list[dict[str, np.ndarray]], frames: int, spacing: float) -> np.ndarray:
    """Frames that stay when those before a boundary must be `spacing` apart; movement is the larger of the arms'."""
    n = len(arms[0]["p"])
    b = min(frames, n - 1)
    if b <= 0:
        return np.arange(n)
    move = lambda i, j: max(float(np.linalg.norm(a["p"][i] - a["p"][j])) for a in arms)
    kept = [0]
    for i in range(1, b):
        if move(i, kept[-1]) >= spacing:
            kept.append(i)
    while kept and move(kept[-1], b) < spacing:
        kept.pop()
    if not kept:
        raise ValueError("the prefix never moves as far as the spacing")
    return np.array([*kept, *range(b, n)])


CHANGES = ("position_change_rms", "position_change_max", "rotation_change_rms", "rotation_change_max", "gripper_change_max", "jerk_before", "jerk_after")


def changes(before: DataFrame, after: DataFrame, by: tuple[str, ...] = ARM) -> DataFrame:
    """by, and CHANGES: how far poses of the same frames lie apart (degrees for rotations), and their third differences.

    Jerk is 0 for an arm of under four frames. A frame that one side lacks is not compared.
    """
    names = (*XYZ, *R6, "gripper")
    was = g.with_matrix(before.select(*by, "frame_index", *names), R6, "_m")
    now = g.with_matrix(after.select(*by, "frame_index", *[F.col(c).alias("n_" + c) for c in names]), ["n_" + c for c in R6], "_n")
    j = was.join(now, [*by, "frame_index"])
    far = g.norm([F.col("n_" + c) - F.col(c) for c in XYZ])
    j = j.select(
        *by, far.alias("p"), g.cosine(g.entries("_m"), g.entries("_n")).alias("r"), F.abs(F.col("n_gripper") - F.col("gripper")).alias("w"),
        windows.third_difference(XYZ, by).alias("a"), windows.third_difference(["n_" + c for c in XYZ], by).alias("b"),
    ).withColumn("r", g.angle_of(F.col("r")))
    rms = lambda c: F.sqrt(F.avg(F.col(c) * F.col(c)))
    values = (rms("p"), F.max("p"), rms("r"), F.max("r"), F.max("w"), *[F.coalesce(F.sqrt(F.avg(c)), F.lit(0.0)) for c in "ab"])
    return j.groupBy(*by).agg(*[v.alias(n) for v, n in zip(values, CHANGES, strict=True)])


def worst_arm(changed: DataFrame) -> DataFrame:
    """episode_index and CHANGES: the largest of an episode's arms."""
    return changed.groupBy("episode_index").agg(*[F.max(c).alias(c) for c in CHANGES])


def changes_of_all(episodes: DataFrame) -> DataFrame:
    """One row: means of what is a root mean square, the largest of what is a maximum."""
    return episodes.agg(F.count(F.lit(1)).alias("episodes"), *[(F.max if c.endswith("_max") else F.avg)(c).alias(c) for c in CHANGES])


def rotation_check(poses: DataFrame, name: str, most: float = 1e-4) -> DataFrame:
    """Episodes in which a rotation is not orthogonal, or its determinant not 1, by more than `most`."""
    q = validate.rotation_quality(poses, R6, ("episode_index",))
    return validate.violations(q, name, F.greatest("orthogonality", "determinant"), most)


def source_violations(arms: DataFrame) -> DataFrame:
    """What no stage can mend: values that are not finite would spread, and a quaternion without length has no rotation."""
    source = [F.col(c) for c in (*XYZ, *Q, "width")]
    infinite = validate.violations(arms, "finite source", F.greatest(*[(~g.finite(c)).cast("double") for c in source]), 0.0)
    return infinite.unionByName(validate.violations(arms, "quaternion", (g.norm(source[3:7]) < g.NORM_FLOOR).cast("double"), 0.0))


def run(arms: DataFrame, settings: Settings) -> Result:
    """The plan's outputs and violations. With step limits it reads the source's steps while it is built, so a source that
    `source_violations` finds fault with is an error there; else the faults are among the result's violations."""
    source, poses = source_violations(arms), convert(arms, settings)
    if settings.step_limit.enabled:
        validate.require(source)
    checks = [source]
    checks += [validate.violations(poses, "finite", F.greatest(*[(~g.finite(F.col(c))).cast("double") for c in POSE]), 0.0)]
    limits = None
    if settings.smoothing.enabled:
        poses = smooth(poses, settings)
    if settings.step_limit.enabled:
        s = steps(convert(arms, settings))
        ref = windows.step_reference(s, ["position_step", "rotation_step"], settings.step_limit.percentile).first()  # the one global barrier: one row
        if ref["position_step_limit"] is not None:  # else no episode has two frames
            poses = limit(poses, settings, ref["position_step_limit"], ref["rotation_step_limit"])
            limits = (ref["position_step_limit"] + settings.step_limit.position_tolerance_mm / 1000 + 5e-7, ref["rotation_step_limit"] + settings.step_limit.rotation_tolerance_deg + 1e-5)
    poses = poses.persist(StorageLevel.MEMORY_AND_DISK)  # the outputs and checks below would each run the kernels again
    held = [poses]
    if settings.smoothing.enabled or settings.step_limit.enabled:
        checks.append(rotation_check(poses, "rotation"))
    lengths = poses.groupBy("episode_index").agg(F.count_distinct("frame_index").alias("n"))
    b = lengths.select("episode_index", F.lit(0).cast("long").alias("start_frame"), F.col("n").alias("end_frame"), F.lit("ok").alias("status"))
    if settings.trim.enabled:
        b = bounds(poses, settings)
        checks.append(b.where("status <> 'ok'").select(F.concat(F.lit("trim "), "status").alias("check"), "episode_index", F.lit(1.0).alias("value"), F.lit(0.0).alias("limit")))
        poses = trim.apply_trim(poses, b).drop("source_frame")
    b = b.where("status = 'ok'")
    if settings.turn_sparsification.enabled:
        kept = kept_frames(poses, settings, limits)
    else:
        kept = poses.select("episode_index", "frame_index").distinct().groupBy("episode_index").agg(F.array_sort(F.collect_list(F.col("frame_index").cast("int"))).alias("kept"))
    selection = trim.compose(kept, b)
    chosen = selection.join(b.select("episode_index", "start_frame"), "episode_index").select("episode_index", "out_frame", (F.col("source_frame") - F.col("start_frame")).alias("frame_index"))
    frames = poses.join(chosen, ["episode_index", "frame_index"]).withColumn("frame_index", F.col("out_frame")).drop("out_frame")
    frames = frames.persist(StorageLevel.MEMORY_AND_DISK)
    held.append(frames)
    if limits is not None:  # of the frames that are written
        after = steps(frames)
        checks.append(validate.violations(after, "position step", F.col("position_step"), limits[0]))
        checks.append(validate.violations(after, "rotation step", F.col("rotation_step"), limits[1]))
    offset = settings.trajectory.action_offset_frames
    frames = windows.action_shift(frames, POSE, offset, by=ARM).withColumn("timestamp", F.col("frame_index") / settings.fps)
    first = windows.episode_offsets(frames.groupBy("episode_index").agg(F.count_distinct("frame_index").alias("length"))).select("episode_index", "first_index", "length")
    short = first.where(F.col("length") <= offset)
    checks.append(short.select(F.lit("action offset").alias("check"), "episode_index", F.col("length").cast("double").alias("value"), F.lit(float(offset)).alias("limit")))
    frames = frames.join(first.drop("length"), "episode_index").withColumn("index", F.col("first_index") + F.col("frame_index")).drop("first_index")
    values = stats.long_values(frames, [*POSE, *["action_" + c for c in POSE]], ("episode_index", "role"))
    parts = stats.value_stats(values, ("episode_index", "role", "feature"))
    found = checks[0]
    for c in checks[1:]:
        found = found.unionByName(c)
    return Result(frames, selection, parts, stats.merge_stats(parts, ["role", "feature"]), found, tuple(held))


def wide(frames: DataFrame, roles: tuple[str, ...] = ("right", "left")) -> DataFrame:
    """One row a frame: state and action arrays, right arm first, as the export writes them."""
    by = ("episode_index", "frame_index", "index", "timestamp")
    arm = F.struct("role", F.array(*POSE).alias("s"), F.array(*["action_" + c for c in POSE]).alias("a"))
    rows = frames.groupBy(*by).agg(F.collect_list(arm).alias("arms"))
    pick = lambda role, part: F.filter("arms", lambda x: x["role"] == role)[0][part]
    return rows.select(*by, F.concat(*[pick(x, "s") for x in roles]).alias("state"), F.concat(*[pick(x, "a") for x in roles]).alias("action"))


__all__ = ["CHANGES", "Result", "bounds", "changes", "changes_of_all", "worst_arm", "convert", "kept_frames", "limit", "run", "smooth", "steps", "wide"]
