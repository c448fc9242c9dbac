"""Queries over the plain tables, one or more for each operator, with thresholds that suit these tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.functions import encode
from trackframe.functions import geometry as g
from trackframe.operators import datasets, kernels, media, merge, stats, trim, validate, windows
from trackframe.plans import trajectory
from trackframe.sources import files, store
from trackframe.sources.adapters import by_role, embedding_frames, event_frames, line_frames, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
Q = ("qx", "qy", "qz", "qw")
R6 = ("r0", "r1", "r2", "r3", "r4", "r5")
XYZ = ("x", "y", "z")
#: Thresholds: event values differ by hundreds, supplier's lines by tens.
TRIM = {"threshold": 60.0, "columns": ("x",), "pre": 2, "post": 3, "least": 20, "run": 2}
TURN, CONTEXT, LEAST = 120.0, 2, 5.0
DENSE, PREFIX, SPACING, STEP_LIMIT = 40.0, 40, 80.0, 60.0
DEPTH = (-1.0, 1.5)
THIN = {"turn_deg": 90.0, "context": 2, "context_distance": 1.0, "dense": 60.0, "kept_step": 60.0, "position_error": 40.0, "consecutive": 2}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + 0.0


def poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both arms' poses with the rotation as six numbers."""
    arms = by_role(embedding_frames(spark, sf_dir))
    six = g.rot6d(g.quaternion_matrix([F.col(c) for c in Q]))
    return arms.select("*", *[c.alias(n) for c, n in zip(six, R6, strict=True)])


@query
def quat_to_rot6d(spark, sf_dir):
    return poses(spark, sf_dir).select("episode_index", "frame_index", "role", *[r(c).alias(c) for c in R6])


@query
def gripper_map(spark, sf_dir):
    arms = by_role(embedding_frames(spark, sf_dir))
    width = F.when(F.col("frame_index") % 7 == 0, -1.0).otherwise(F.col("width"))
    return arms.select("episode_index", "frame_index", "role", r(g.map_gripper(width, (-0.3, 0.3), (0.0, 1.2))).alias("gripper"))


@query
def pose_transform(spark, sf_dir):
    arms = by_role(embedding_frames(spark, sf_dir))
    m = g.quaternion_matrix([F.col(c) for c in Q])
    p, m = g.transform_pose([F.col(c) for c in XYZ], m, (0.1, -0.2, 0.3), (30.0, 45.0, 60.0))
    named = [*zip(p, ("px", "py", "pz"), strict=True), *zip(g.rot6d(m), R6, strict=True)]
    return arms.select("episode_index", "frame_index", "role", *[r(c).alias(n) for c, n in named])


@query
def action_shift(spark, sf_dir):
    f = windows.action_shift(embedding_frames(spark, sf_dir), ["right_x", "left_width"], 3)
    return f.select("episode_index", "frame_index", r("action_right_x").alias("action_right_x"), r("action_left_width").alias("action_left_width"))


@query
def step_metrics(spark, sf_dir):
    s = windows.step_metrics(by_role(embedding_frames(spark, sf_dir)))
    return s.select("episode_index", "frame_index", r("position_step").alias("position_step"), r("rotation_step", 4).alias("rotation_step"))


def line_steps(spark, sf_dir):
    f = line_frames(spark, sf_dir)
    return f.select("episode_index", "frame_index", windows.position_step().alias("position_step"))


@query
def step_limit_reference(spark, sf_dir):
    ref = windows.step_reference(line_steps(spark, sf_dir).where("position_step is not null"), ["position_step"], 95)
    return ref.select(*[r(c).alias(c) if "step" in c else c for c in ref.columns])


@query
def smooth_position(spark, sf_dir):
    s = windows.smooth_positions(event_frames(spark, sf_dir))
    return s.select("episode_index", "frame_index", *[r(c).alias(c) for c in XYZ])


@query
def trim_bounds(spark, sf_dir):
    return trim.trim_bounds(event_frames(spark, sf_dir), **TRIM)


@query
def trim_apply_reindex(spark, sf_dir):
    f = event_frames(spark, sf_dir)
    t = windows.renumber(trim.apply_trim(f, trim.trim_bounds(f, **TRIM)), fps=30)
    return t.select("episode_index", "frame_index", "index", "source_frame", r("timestamp").alias("timestamp"), "x")


def turns(spark, sf_dir):
    f = line_frames(spark, sf_dir)
    return f.select("*", windows.turn_angle(CONTEXT, LEAST).alias("angle"), windows.position_step().alias("_step"))


@query
def turn_angles(spark, sf_dir):
    return turns(spark, sf_dir).select("episode_index", "frame_index", r("angle", 4).alias("angle"))


@query
def turn_regions_peaks(spark, sf_dir):
    t = turns(spark, sf_dir).withColumn("angle", r("angle", 6))
    return windows.regions(t, F.col("angle") >= TURN, "angle")


@query
def dense_candidates(spark, sf_dir):
    t = turns(spark, sf_dir).withColumn("local_step", windows.local_step(F.col("_step")))
    on = t.where((r("angle", 6) >= TURN) & (r("local_step", 6) <= DENSE))
    return on.select("episode_index", "frame_index", r("local_step").alias("local_step"))


@query
def prefix_sampling(spark, sf_dir):
    kept = trim.sample_prefix(event_frames(spark, sf_dir), PREFIX, SPACING, ("x",))
    return kept.where("kept is not null").select("episode_index", F.size("kept").cast("long").alias("n_kept"), F.array_join("kept", ",").alias("kept"))


def selection(spark, sf_dir):
    f = event_frames(spark, sf_dir)
    bounds = trim.trim_bounds(f, **TRIM)
    kept = trim.apply_trim(f, bounds).where("frame_index % 3 <> 1").groupBy("episode_index").agg(F.array_sort(F.collect_list(F.col("frame_index").cast("int"))).alias("kept"))
    return trim.compose(kept, bounds.where("status = 'ok'"))


@query
def select_compose(spark, sf_dir):
    return selection(spark, sf_dir)


@query
def select_ranges_text(spark, sf_dir):
    text = trim.select_text(selection(spark, sf_dir))
    filters = encode.video_filter(F.col("select_text"), 30, encode.crop_mode(F.lit("auto"), F.lit(640), F.lit(480)), 224, 224)
    return text.select("episode_index", "select_text", filters.alias("filters"))


@query
def restore_intervals(spark, sf_dir):
    f = line_frames(spark, sf_dir)
    return trim.restore_intervals(f, f.where("frame_index % 2 = 0").select("episode_index", "frame_index"), STEP_LIMIT)


def rounded_stats(df, digits=6):
    return df.select(*[r(c, digits).alias(c) if c in ("min", "max", "mean", "std") else c for c in df.columns])


@query
def episode_stats(spark, sf_dir):
    return rounded_stats(stats.episode_stats(embedding_frames(spark, sf_dir), ["right_x", "right_width", "left_y"]))


@query
def global_stats_merge(spark, sf_dir):
    parts = stats.episode_stats(embedding_frames(spark, sf_dir), ["right_x", "right_width", "left_y"])
    return rounded_stats(stats.merge_stats(parts, ["feature"]))


@query
def merge_reindex(spark, sf_dir):
    e = event_frames(spark, sf_dir).withColumn("dataset_id", F.col("episode_index") % 2)
    m = merge.merge(e)
    return m.select("dataset_id", "source_episode", "episode_index", "frame_index", "index", "x")


@query
def width_interpolate(spark, sf_dir):
    f = event_frames(spark, sf_dir).withColumn("x", F.when(~F.col("missing"), F.col("x")))
    return windows.fill_gaps(f, "x").select("episode_index", "frame_index", r("x").alias("x"), "filled")


@query
def detection_summary(spark, sf_dir):
    f = event_frames(spark, sf_dir).groupBy("episode_index").agg(F.count_if(~F.col("missing")).alias("detected"), F.count_if("missing").alias("interpolated"), F.count(F.lit(1)).alias("frames"))
    return f.withColumn("percent", r(100 * F.col("detected") / F.col("frames")))


@query
def width_add_layout(spark, sf_dir):
    """State of right pose and width, left pose and width; and one with a width overwritten in place."""
    f = embedding_frames(spark, sf_dir)
    pose = lambda role: F.array(*[F.col(f"{role}_{c}") for c in (*XYZ, *Q)])
    state = F.concat(pose("right"), F.array("right_width"), pose("left"), F.array("left_width"))
    over = F.transform(state, lambda v, i: F.when(i == 7, F.lit(-1.0)).otherwise(v))
    text = lambda a: F.array_join(F.transform(a, lambda v: F.rint(v * 1000).cast("long").cast("string")), ",")
    return f.select("episode_index", "frame_index", text(state).alias("added"), text(over).alias("overwritten"))


def embedding_values(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").cast("long").alias("label"), F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.col("value").cast("double"))


@query
def depth_unorm8(spark, sf_dir):
    v = embedding_values(spark, sf_dir)
    return v.select("vec_id", "dim", encode.depth_code(F.col("value") * 4, *DEPTH).alias("code"))


@query
def depth_range_report(spark, sf_dir):
    below, above = encode.outside(F.col("value") * 4, *DEPTH)
    return embedding_values(spark, sf_dir).groupBy("label").agg(below.alias("below"), above.alias("above"), F.count(F.lit(1)).alias("values"))


@query
def force_minmax_uint8(spark, sf_dir):
    v = embedding_values(spark, sf_dir).withColumn("channel", F.col("dim") % 3)
    ranges = stats.channel_range(v, ["label", "channel"])
    step, error = encode.quantisation(F.col("low"), F.col("high"))
    out = v.join(ranges, ["label", "channel"])
    return out.select("vec_id", "dim", encode.force_code(F.col("value"), F.col("low"), F.col("high")).alias("code"), r(step).alias("step"), r(error).alias("error"))


@query
def tensor_stats(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("episode_index"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i * 16 + 1, 16)).alias("t"))
    return rounded_stats(stats.tensor_stats(e, "t", 2))


@query
def video_sample_positions(spark, sf_dir):
    n = event_frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))
    return n.select("episode_index", "length", F.array_join(encode.sample_places(F.col("length"), 10), ",").alias("places"))


@query
def channel_stats(spark, sf_dir):
    v = embedding_values(spark, sf_dir).select("label", "vec_id", (F.col("dim") % 3).alias("channel"), F.floor(F.abs(F.col("value")) * 255).alias("value"))
    return rounded_stats(stats.image_stats(v, ["label", "channel"], "vec_id"))


@query
def alignment_validation(spark, sf_dir):
    f = windows.action_shift(embedding_frames(spark, sf_dir), ["right_x", "left_x"], 2)
    wrong = F.when((F.col("episode_index") == 3) & (F.col("frame_index") == 5), 0.5).otherwise(0.0)
    e = validate.alignment_error(f.withColumn("action_left_x", F.col("action_left_x") + wrong), ["right_x", "left_x"], 2)
    return e.select("episode_index", "length", r("error").alias("error"), (F.col("error") <= 1e-6).alias("ok"))


@query
def rotation_quality(spark, sf_dir):
    p = poses(spark, sf_dir)
    raw = [F.col(c) * 1.01 for c in R6]
    m = [[raw[i], raw[3 + i], g.cross(raw[:3], raw[3:])[i]] for i in range(3)]
    orthogonal, det = g.rotation_error(m)
    good = validate.rotation_quality(p, R6)
    bad = p.groupBy("episode_index").agg(F.max(orthogonal).alias("raw_orthogonality"), F.max(det).alias("raw_determinant"))
    return good.join(bad, "episode_index").select("episode_index", *[r(c).alias(c) for c in ("orthogonality", "determinant", "raw_orthogonality", "raw_determinant")])


@query
def smoothing_metrics(spark, sf_dir):
    f = event_frames(spark, sf_dir)
    # the smoothed positions beside the first ones, in one plan: all windows share the episodes' exchange and order
    s = windows.smooth_positions(f.select("*", *[F.col(c).alias("s" + c) for c in XYZ]), ["s" + c for c in XYZ])
    d = g.norm([F.col("s" + c) - F.col(c) for c in XYZ])
    sq = s.select("episode_index", d.alias("d"), windows.third_difference(XYZ).alias("before"), windows.third_difference(["s" + c for c in XYZ]).alias("after"))
    m = sq.groupBy("episode_index").agg(F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("change_rms"), F.max("d").alias("change_max"), F.sqrt(F.avg("before")).alias("jerk_before"), F.sqrt(F.avg("after")).alias("jerk_after"))
    return m.select("episode_index", *[r(c, 4).alias(c) for c in ("change_rms", "change_max", "jerk_before", "jerk_after")])


def changed_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of each arm from its poses to those one frame later."""
    by, names = ("episode_index", "role"), (*XYZ, *R6, "gripper")
    before = poses(spark, sf_dir).withColumn("gripper", F.col("width"))
    after = before.select(*by, "frame_index", *[windows.shifted(c, 1, by).alias(c) for c in names])
    return trajectory.changes(before, after)


@query
def pose_changes(spark, sf_dir):
    w = trajectory.worst_arm(changed_poses(spark, sf_dir))
    return w.select("episode_index", *[r(c, 4).alias(c) for c in trajectory.CHANGES])


@query
def pose_changes_rollup(spark, sf_dir):
    a = trajectory.changes_of_all(trajectory.worst_arm(changed_poses(spark, sf_dir)))
    return a.select("episodes", *[r(c, 4).alias(c) for c in trajectory.CHANGES])


@query
def bounds_and_colors(spark, sf_dir):
    f = event_frames(spark, sf_dir)
    b = f.groupBy("episode_index").agg(*[x(c).alias(f"{n}_{c}") for c in XYZ for x, n in ((F.min, "min"), (F.max, "max"))], F.count(F.lit(1)).alias("points"))
    return b.select("*", *[c.alias(n) for c, n in zip(encode.episode_colour(F.col("episode_index")), ("red", "green", "blue"), strict=True)])


@query
def plot_points(spark, sf_dir):
    """Points of a recording: every third frame, with the first and last marked."""
    f = line_frames(spark, sf_dir)
    n = F.count(F.lit(1)).over(windows.whole())
    kind = F.when(F.col("frame_index") == 0, "start").when(F.col("frame_index") == n - 1, "end").otherwise("point")
    return f.select("episode_index", "frame_index", kind.alias("kind"), *XYZ).where("kind <> 'point' or frame_index % 3 = 0")


@query
def chunk_paths(spark, sf_dir):
    e = event_frames(spark, sf_dir).select("episode_index").distinct()
    data = encode.episode_path("data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", F.col("episode_index"), 100)
    video = encode.episode_path("videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4", F.col("episode_index"), 100, video_key="observation.images.right")
    return e.select("episode_index", data.alias("data_path"), video.alias("video_path"))


@query
def missing_episodes(spark, sf_dir):
    present = event_frames(spark, sf_dir).select("episode_index").distinct()
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("episode_index"))
    there, missing = merge.requested(present, wanted)
    return there.select("episode_index", F.lit("present").alias("state")).union(missing.select("episode_index", F.lit("missing").alias("state")))


@query
def duplicate_keys(spark, sf_dir):
    return validate.duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def contiguity(spark, sf_dir):
    n = event_frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))
    return validate.contiguity(n)


@query
def frame_numbering(spark, sf_dir):
    f = event_frames(spark, sf_dir).where("episode_index % 5 <> 0 or frame_index <> 4")
    return validate.bad_numbering(f)


@query
def over_limit_counts(spark, sf_dir):
    s = validate.over_limit(line_steps(spark, sf_dir), "position_step", STEP_LIMIT)
    return s.select("episode_index", "over", r("largest").alias("largest"), "pairs")


@query
def asset_manifest_compare(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    files = merge.manifest(d, F.concat("source", F.lit("/"), "lang"), F.col("text"))
    same = files.groupBy("path").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("sha256").alias("contents"), F.min("sha256").alias("first_sha"))
    return same.withColumn("conflict", F.col("contents") > 1)


@query
def action_chunk(spark, sf_dir):
    c = windows.action_chunk(event_frames(spark, sf_dir), "x", 8)
    return c.select("episode_index", "frame_index", F.array_join(F.transform("chunk", lambda v: F.rint(v * 100).cast("long").cast("string")), ",").alias("chunk"))


@query
def episode_limit(spark, sf_dir):
    f = event_frames(spark, sf_dir)
    first = f.select("episode_index").distinct().orderBy("episode_index").limit(5)
    return f.join(F.broadcast(first), "episode_index", "left_semi").groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), r(F.sum("x"), 4).alias("sum_x"))


@query
def dataset_discovery(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    stamp = F.lpad((F.col("event_id") % 240000).cast("string"), 6, "0")
    tail = F.element_at(F.array(F.lit(""), F.lit("_width"), F.lit("_merged")), (F.col("event_id") % 3 + 1).cast("int"))
    names = e.select("event_id", F.concat(F.lit("task_20261019_"), stamp, tail).alias("name"))
    return merge.discover(names, "name", "task", "20261019").withColumn("runtime_like", F.concat(F.lit("xrs_"), F.md5("name")).rlike("^xrs_[0-9a-f]{32}$"))


@query
def slerp_midpoint(spark, sf_dir):
    f = embedding_frames(spark, sf_dir)
    p, q = [g.unit_quaternion([F.col(f"{a}_{c}") for c in Q]) for a in ("right", "left")]
    units = f.select("episode_index", "frame_index", *[c.alias("p" + n) for c, n in zip(p, Q, strict=True)], *[c.alias("q" + n) for c, n in zip(q, Q, strict=True)])
    mid = g.slerp([F.col("p" + n) for n in Q], [F.col("q" + n) for n in Q], 0.5)
    return units.select("episode_index", "frame_index", *[r(c).alias(n) for c, n in zip(mid, Q, strict=True)])


@query
def matrix_to_quaternion(spark, sf_dir):
    by = ("episode_index", "frame_index", "role")
    u = windows.unit_quaternions(by_role(embedding_frames(spark, sf_dir)), by)
    # q and -q are one rotation: the sign is that of which the largest component is positive
    largest = F.greatest(*[F.abs("u" + c) for c in "xyzw"])
    sign = F.coalesce(*[F.when(F.abs("u" + c) == largest, F.signum("u" + c)) for c in "xyzw"])
    return u.select(*by, *[r(F.col("u" + n[1]) * sign).alias(n) for n in Q])


@query
def finite_report(spark, sf_dir):
    f = event_frames(spark, sf_dir).withColumn("x", F.when(F.col("missing"), F.lit(float("nan"))).otherwise(F.col("x")))
    return validate.not_finite(f, ["x", "y"])


@query
def report_rollup(spark, sf_dir):
    b = trim.trim_bounds(event_frames(spark, sf_dir), **TRIM)
    ok = F.col("status") == "ok"
    n = F.col("end_frame") - F.col("start_frame")
    return b.agg(F.count(F.lit(1)).alias("episodes"), F.count_if(ok).alias("trimmed"), F.sum("length").alias("frames_before"), F.sum(n).alias("frames_after"), F.max(F.col("length") - n).alias("most_removed"), F.ceil(F.count(F.lit(1)) / 100).alias("total_chunks"), (F.count(F.lit(1)) * 2).alias("total_videos"))


@query
def gripper_missing(spark, sf_dir):
    """Widths that are null or NaN have no angle: they are not taken for an open gripper."""
    arms = by_role(embedding_frames(spark, sf_dir))
    width = F.when(F.col("frame_index") % 5 == 1, F.lit(float("nan"))).when(F.col("frame_index") % 5 != 2, F.col("width"))
    out = arms.select("episode_index", "frame_index", "role", g.map_gripper(width, (-0.3, 0.3), (0.0, 1.2)).alias("v"))
    return out.select("episode_index", "frame_index", "role", r(F.when(g.finite(F.col("v")), F.col("v"))).alias("gripper"), g.finite(F.col("v")).alias("ok"))


@query
def depth_missing(spark, sf_dir):
    depth = F.when(F.col("dim") % 5 == 1, F.lit(float("nan"))).when(F.col("dim") % 5 != 2, F.col("value") * 4)
    return embedding_values(spark, sf_dir).select("vec_id", "dim", encode.depth_code(depth, *DEPTH).alias("code"))


@query
def step_missing(spark, sf_dir):
    """Steps to and from a pose whose quaternion has no length have no angle."""
    arms = by_role(embedding_frames(spark, sf_dir))
    gone = F.col("frame_index") % 4 == 2
    arms = arms.select("episode_index", "frame_index", "role", *XYZ, *[F.when(gone, 0.0).otherwise(F.col(c)).alias(c) for c in Q])
    s = windows.step_metrics(arms)
    return s.select("episode_index", "frame_index", r("position_step").alias("position_step"), r("rotation_step", 4).alias("rotation_step"))


@query
def so3_smooth(spark, sf_dir):
    """Rotations about one axis, by an event's value in degrees, smoothed as rotations."""
    f = event_frames(spark, sf_dir)
    c, s = F.cos(F.radians("x")), F.sin(F.radians("x"))
    six = dict(zip(R6, (c, s, F.lit(0.0), -s, c, F.lit(0.0)), strict=True))
    out = kernels.smooth_episode_rotations(f.select("episode_index", "frame_index", *[v.alias(k) for k, v in six.items()]), R6)
    return out.select("episode_index", "frame_index", *[r(k).alias(k) for k in R6])


@query
def step_limit_project(spark, sf_dir):
    """Positions whose steps are cut to the middle one; episodes that cannot be have sweeps -1 and stay."""
    f = line_frames(spark, sf_dir)
    half = windows.step_reference(line_steps(spark, sf_dir).where("position_step is not null"), ["position_step"], 50).first()["position_step_limit"]  # one number
    moved = kernels.limit_episode_steps(f, half, strict=False)
    return moved.select("episode_index", "frame_index", *[r(k, 4).alias(k) for k in XYZ], "sweeps")


@query
def turn_sparsify(spark, sf_dir):
    """The frames that stay when turns are thinned."""
    return kernels.sparsify_turns(line_frames(spark, sf_dir), **THIN)


class RunningMean:
    """A stand-in for a sensor's solver: its state needs every frame in order."""

    def __init__(self):
        self.n, self.sum = 0, 0.0

    def solve(self, frame) -> float:
        self.n, self.sum = self.n + 1, self.sum + float(frame)
        return self.sum / self.n

    def release(self) -> None:
        self.n = 0


@query
def sensor_select_fake_solver(spark, sf_dir):
    f = event_frames(spark, sf_dir).select("episode_index", "frame_index", "x", (F.col("frame_index") % 4 == 1).alias("selected"))
    s = media.solve_selected(f, "x", RunningMean)
    return s.select("episode_index", "frame_index", r("solved", 4).alias("solved"))


class RunningExtremes:
    """A stand-in for a sensor kit: the frame, the mean and the greatest value so far, as three channels."""

    def __init__(self):
        self.n, self.total, self.lost, self.most = 0, 0.0, 0.0, -float("inf")

    def solve(self, frame):
        """The sum keeps what its additions round off: a mean that lies halfway between two codes must not slip to a side."""
        total = self.total + frame
        self.lost += (self.total - total) + frame if abs(self.total) >= abs(frame) else (frame - total) + self.total
        self.n, self.total, self.most = self.n + 1, total, max(self.most, frame)
        return {"force": [[frame, (total + self.lost) / self.n, self.most]]}

    def release(self):
        pass


@query
def solver_two_passes(spark, sf_dir):
    """Solved once into a table; the bounds of each channel, and the codes between them, come from the table."""
    f = event_frames(spark, sf_dir).select("episode_index", "frame_index", "x", (F.col("frame_index") % 3 == 1).alias("selected"))
    spill = store.scratch(spark)
    media.solve_ordered(f, "x", RunningExtremes, {"force": (1, 3)}).write.parquet(spill)
    solved = spark.read.parquet(spill)
    out = media.encoded(solved, "force", 3, media.channel_ranges(solved, "force", 3))
    return out.select("episode_index", "frame_index", F.array_join(F.transform("codes", lambda c: c.cast("string")), ",").alias("codes"))


@query
def file_misfits(spark, sf_dir):
    """Orders as episodes whose rows are lines; an order's lines as a file. Some files are dropped, cut, renamed or mixed."""
    path = lambda k: encode.episode_path(files.DATA_PATH, k, 1000)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    episodes = li.groupBy("k").agg(F.count(F.lit(1)).alias("length")).select(F.col("k").alias("episode_index"), "length", path(F.col("k")).alias("path"))
    found = li.where("k % 50 <> 1 and not (k % 50 = 2 and l_linenumber = 1)")
    found = found.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"))
    there = F.when(F.col("k") % 50 == 3, -F.col("k")).otherwise(F.col("k"))
    found = found.select(
        F.when(F.col("k") % 50 == 4, F.concat(F.lit("data/other_"), F.col("k").cast("string"))).otherwise(path(F.col("k"))).alias("path"), "rows",
        there.alias("episode_index_low"), F.col("k").alias("episode_index_high"), (F.col("lo") - 1).cast("long").alias("frame_index_low"), (F.col("hi") - 1).cast("long").alias("frame_index_high"),
        F.lit(None).cast("long").alias("index_low"), F.lit(None).cast("long").alias("index_high"), F.when(F.col("k") % 50 == 5, F.lit("no Parquet")).alias("error"),
    )
    return files.misfits(episodes, found)


@query
def session_episodes(spark, sf_dir):
    from trackframe.streaming.sessions import session_episodes as sessions

    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    s = sessions(e, "6 hours")
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("frames").alias("frames"), F.max("frames").alias("longest"))


@query
def footer_row_counts(spark, sf_dir):
    """Rows of tables. Nothing is in the ReadSchema, so the reader adds up the row groups' counts of the footers, and reads no page."""
    names = ("lineitem", "events", "embeddings")
    out = None
    for n in names:
        one = table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "n_rows")
        out = one if out is None else out.union(one)
    return out


@query
def json_lines_scan(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.from_json("props", "k int").alias("p"))
    return e.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query
def append_tensor_columns(spark, sf_dir):
    tensors = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("episode_index"), "vec_id", F.element_at("embedding", 1).cast("double").alias("force"))
    tensors = tensors.withColumn("frame_index", (F.row_number().over(windows.ordered(order="vec_id")) - 1).cast("long"))
    out = datasets.append_columns(event_frames(spark, sf_dir), tensors, ["force"])
    return out.select("episode_index", "frame_index", r("force").alias("force"))


@query
def layout_lookup(spark, sf_dir):
    """Two lookups in a row, each of which must find its key."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_name", F.col("n_regionkey").alias("region"))
    g_ = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("region"), "r_name")
    return merge.lookup(merge.lookup(s, n, "nation"), g_, "region").select("s_suppkey", "n_name", "r_name")


@query
def sensor_match(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    sensors = c.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("serial"))
    features = table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).otherwise(-F.col("o_custkey")).alias("serial"), F.format_string("order_%09d", "o_orderkey").alias("key"))
    return datasets.match_sensors(sensors, features)


@query
def arm_commands(spark, sf_dir):
    e = event_frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"))
    c = datasets.for_each_arm(e, ("right", "left"))
    path = encode.episode_path("videos/{episode_chunk:03d}/{episode_index:06d}", F.col("episode_index"), 50)
    return c.select("episode_index", "role", F.concat(path, F.lit("_"), "role", F.lit(".mp4")).alias("target"), "frames")


@query
def runtime_set_validation(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("xrs_"), F.md5("source")).alias("set_id"), F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha256"), "doc_id")
    manifest = d.where("doc_id % 50 <> 1").withColumn("sha256", F.when(F.col("doc_id") % 50 == 2, "0").otherwise(F.col("sha256")))
    manifest = manifest.withColumn("set_id", F.when(F.col("doc_id") % 50 == 3, "xrs_short").otherwise(F.col("set_id")))
    return datasets.invalid_runtime_sets(manifest, d.where("doc_id % 50 <> 4"))


@query
def dataset_compatibility(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.format_string("c%08d", "o_custkey").alias("dataset"), F.col("o_orderpriority").alias("task"))
    return datasets.differing_sets(o, "dataset", "task")


@query
def compatible_info(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    info = F.create_map(F.lit("fps"), F.lit("30"), F.lit("total_frames"), F.col("s_suppkey").cast("string"), F.lit("robot"), F.col("s_name"), F.lit("splits"), F.lit("x"))
    kept = datasets.compatible_info(info)
    return s.select("s_suppkey", F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("keys"), F.element_at(kept, "robot").alias("robot"))


@query
def video_mismatches(spark, sf_dir):
    n = event_frames(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"))
    size = [F.lit("cam").alias("key"), F.lit(640).alias("width"), F.lit(480).alias("height")]
    expected = n.select("episode_index", "frames", *size)
    probed = n.where("episode_index % 11 <> 0").select("episode_index", (F.col("frames") - (F.col("episode_index") % 7 == 0).cast("int")).alias("frames"), *size)
    return datasets.video_mismatches(expected, probed).select("episode_index", "frames", "got_frames")


@query
def marker_distance(spark, sf_dir):
    f = line_frames(spark, sf_dir)
    m = f.select("episode_index", F.floor(F.col("frame_index") / 3).alias("frame_index"), (F.col("y").cast("long") % 4).alias("marker_id"), *XYZ)
    return datasets.one_left_one_right(m, 0, 1).select("episode_index", "frame_index", r("distance").alias("distance"))


@query
def nearest_marker(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_extendedprice").alias("cost"))
    return validate.nearest_by(li, "l_orderkey", "cost").select("l_orderkey", "cost")


@query
def roi_bounds(spark, sf_dir):
    f = event_frames(spark, sf_dir)
    ok = datasets.inside(F.col("x"), F.col("y"), F.lit(100.0), F.lit(20.0), 480, 100)
    return f.groupBy("episode_index").agg(F.count_if(ok).alias("inside"), F.count_if(~ok).alias("outside"))


@query
def replaced_column(spark, sf_dir):
    """A column replaced in place keeps its type: whole numbers stay whole."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return datasets.replace_column(e, "label", F.col("label") * 1.5)


@query
def set_differences(spark, sf_dir):
    """Orders' customers, known customers (odd keys changed): in both, and in one only."""
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct()
    b = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("k"))
    kinds = (("both", a.intersect(b)), ("first", a.exceptAll(b)), ("second", b.exceptAll(a)))
    out = None
    for name, df in kinds:
        df = df.select(F.lit(name).alias("kind"), "k")
        out = df if out is None else out.union(df)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"))
