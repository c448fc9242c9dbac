import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from trackframe.functions import encode
from trackframe.functions import geometry as g
from trackframe.operators import kernels, media, merge, stats, trim, validate, windows
from trackframe.plans import catalogue, config, merging, trajectory
from trackframe.plans import oracle as sql
from trackframe.sources import dataset

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_against_sql(spark, name):
    assert oracle.same(spark, SF, catalogue.QUERIES[name], sql.SQL[name]) > 0 or name in ("missing_episodes",)


def one(df):
    return df.first()[0]


def test_identity_quaternion(spark):
    q = [F.lit(float(v)) for v in (0, 0, 0, 1)]
    assert one(spark.range(1).select(F.array(*g.rot6d(g.quaternion_matrix(q))))) == [1, 0, 0, 0, 1, 0]
    assert one(spark.range(1).select(g.unit_quaternion([F.lit(0.0)] * 4)[0])) is None


def frames(spark, values, column="x"):
    rows = [(0, i, float(v), 0.0, 0.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, x double, y double, z double")


def test_action_shift(spark):
    f = windows.action_shift(frames(spark, [0, 1, 2]), ["x"], 1).orderBy("frame_index")
    assert [r["action_x"] for r in f.collect()] == [1, 2, 2]
    with pytest.raises(ValueError):
        windows.shifted("x", -1)


def test_static_head_and_tail(spark):
    x = [0.0] * 20 + list(np.linspace(0, 0.1, 60)) + [0.1] * 20
    b = trim.trim_bounds(frames(spark, x), 0.005, pre=0, post=0, least=1).first()
    assert (b["start_frame"], b["end_frame"], b["status"]) == (23, 77, "ok")
    b = trim.trim_bounds(frames(spark, x), 0.005, pre=3, post=3, least=1).first()
    assert (b["start_frame"], b["end_frame"]) == (20, 80)
    assert trim.trim_bounds(frames(spark, [0.0] * 40), 0.005).first()["status"] == "never_leaves"


def test_jitter_needs_a_run(spark):
    x = np.zeros(100)
    x[10], x[90] = 0.006, 0.006
    x[30:70] = 0.05
    x[70:] = 0.1
    x[90] = 0.106
    b = trim.trim_bounds(frames(spark, x), 0.005, run=5).first()
    assert (b["start_frame"], b["end_frame"]) == (30, 70)


def test_selection_composes_and_rejects(spark):
    bounds = spark.createDataFrame([(0, 2, 8)], "episode_index long, start_frame long, end_frame long")
    kept = lambda k: spark.createDataFrame([(0, k)], "episode_index long, kept array<int>")
    assert [r["source_frame"] for r in trim.compose(kept([0, 2, 5]), bounds).orderBy("out_frame").collect()] == [2, 4, 7]
    for bad in ([0, 6], [2, 1], [1, 1]):
        with pytest.raises(Exception, match="selection of episode"):
            trim.compose(kept(bad), bounds).collect()


def test_gap_fill(spark):
    f = frames(spark, range(6)).withColumn("x", F.when(F.col("frame_index").isin(1, 4), F.col("x") * 10))
    assert [r["x"] for r in windows.fill_gaps(f, "x").orderBy("frame_index").collect()] == [10, 10, 20, 30, 40, 40]


def quaternion(deg):
    a = math.radians(deg) / 2
    return [0, 0, math.sin(a), math.cos(a)]


def test_step_limit():
    x = np.array([0, 0.05, 0.10, 0.60, 0.20, 0.25, 0.20, 0.10, 0])
    p = np.stack([x, 0 * x, 0 * x], axis=1)
    out, _ = kernels.limit_steps(p, 0.1, 0, 1, 3000, False)
    assert np.abs(np.diff(out[:, 0])).max() <= 0.1 + 1e-8 and (out[[0, -1]] == p[[0, -1]]).all()
    q = np.array([quaternion(d) for d in (0, 5, 10, 70, 20, 15, 10, 5, 0)])
    out, _ = kernels.limit_steps(q, 12, 0, 1, 3000, True)
    assert kernels.angles(out[:-1], out[1:]).max() <= 12 + 1e-6
    with pytest.raises(ValueError, match="fixed frames"):
        kernels.limit_steps(np.array([[0.0, 0, 0], [1, 0, 0]]), 0.1, 0, 1, 10, False)


def limited(p, limit, tolerance, preserve, max_sweeps):
    """Step limits as they are stated, pair by pair; None: not possible."""
    p, n, enough = [list(map(float, x)) for x in p], len(p), limit + max(tolerance, 1e-9)
    preserve = min(preserve, n // 2)
    free = lambda i: preserve <= i < n - preserve
    for sweep in range(1, max_sweeps + 1):
        for i in [*range(0, n - 1, 2), *range(1, n - 1, 2)]:
            d = math.dist(p[i], p[i + 1])
            if d <= limit:
                continue
            if not free(i) and not free(i + 1):
                if d > enough:
                    return None
                continue
            share = 0.5 if free(i) and free(i + 1) else float(free(i))
            move = [(b - a) * (d - limit) / d for a, b in zip(p[i], p[i + 1])]
            p[i] = [a + m * share for a, m in zip(p[i], move)]
            p[i + 1] = [b - m * (1 - share) for b, m in zip(p[i + 1], move)]
        if max(math.dist(a, b) for a, b in zip(p, p[1:])) <= enough:
            return p, sweep
    return None


def by_episode(df, columns):
    out = {}
    for r in df.orderBy("episode_index", "frame_index").collect():
        out.setdefault(r["episode_index"], []).append([r[c] for c in columns])
    return out


def test_step_limit_query_by_brute_force(spark):
    source = by_episode(catalogue.line_frames(spark, SF), ("x", "y", "z"))
    half = windows.step_reference(catalogue.line_steps(spark, SF).where("position_step is not null"), ["position_step"], 50).first()[0]
    got, done = by_episode(catalogue.QUERIES["step_limit_project"](spark, SF), ("x", "y", "z", "sweeps")), 0
    for e, p in list(source.items())[:4]:
        want = limited(p, half, 1e-5, 1, 3000)
        assert {r[3] for r in got[e]} == {want[1] if want else -1}
        assert np.allclose(np.array(got[e])[:, :3], np.array(want[0] if want else p), atol=1e-3)
        done += want is not None
    assert done
    for bad in ({"limit": 0.0}, {"limit": math.inf}, {"preserve": 0}):
        with pytest.raises(ValueError):
            kernels.limit_steps(np.zeros((3, 3)), **({"limit": 1.0, "tolerance": 0.0, "preserve": 1, "max_sweeps": 5, "rotation": False} | bad))


def test_step_limit_passes_other_columns_through(spark):
    """Frames come in order; an episode that cannot be done keeps its NaN, and whole numbers beside nulls stay whole."""
    rows = [(e, f, 10.0 * (f % 2), None if f == 1 else 2**53 + f) for e in (0, 1) for f in (3, 0, 4, 1, 2)]
    rows = [(e, f, math.nan if (e, f) == (1, 2) else x, n) for e, f, x, n in rows]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, x double, n long").coalesce(1)
    got = kernels.limit_episode_steps(frames, 6.0, columns=("x",), strict=False, max_sweeps=50).collect()
    for e in (0, 1):
        own = [r for r in got if r["episode_index"] == e]
        assert [r["frame_index"] for r in own] == [0, 1, 2, 3, 4]
        assert [r["n"] for r in own] == [2**53, None, *[2**53 + f for f in (2, 3, 4)]]
        assert all((r["sweeps"] == -1) == bool(e) for r in own)
    x = [r["x"] for r in got if r["episode_index"] == 0]
    assert max(abs(a - b) for a, b in zip(x, x[1:])) <= 6.0 + 1e-5 and x[0] == x[4] == 0.0
    assert [str(r["x"]) for r in got if r["episode_index"] == 1] == ["0.0", "10.0", "nan", "10.0", "0.0"]


def test_running_mean_does_not_drift():
    solver = catalogue.RunningExtremes()
    got = [solver.solve(0.1)["force"][0][1] for _ in range(1000)]
    assert got == [math.fsum([0.1] * n) / n for n in range(1, 1001)]


def thinned(p, turn_deg, context, context_distance, dense, kept_step, position_error, consecutive):
    """Frames that stay, by trying each candidate against the list of those that are kept."""
    n, kept = len(p), list(range(len(p)))
    if n < 2 * context + 1:
        return kept
    step = [math.inf, *[math.dist(a, b) for a, b in zip(p, p[1:])], math.inf]
    local, angle = [max(step[i], step[i + 1]) for i in range(n)], [0.0] * n
    for i in range(context, n - context):
        a, b = p[i] - p[i - context], p[i + context] - p[i]
        na, nb = np.linalg.norm(a), np.linalg.norm(b)
        if min(na, nb) >= context_distance and min(na, nb) > 0:
            angle[i] = math.degrees(math.acos(np.clip(a @ b / (na * nb), -1, 1)))
    protected, i = {0, n - 1}, 0
    while i < n:
        j = i
        while j < n and angle[j] >= turn_deg:
            j += 1
        if j > i:
            protected.add(max(range(i, j), key=lambda k: (angle[k], -k)))
        i = max(j, i + 1)
    for i in sorted((k for k in range(n) if angle[k] >= turn_deg and local[k] <= dense and k not in protected), key=lambda k: (local[k], k)):
        a, b = max(k for k in kept if k < i), min(k for k in kept if k > i)
        if b - a - 1 > consecutive or math.dist(p[a], p[b]) > kept_step:
            continue
        if all(math.dist(p[a] + (p[b] - p[a]) * (k - a) / (b - a), p[k]) <= position_error for k in range(a + 1, b)):
            kept.remove(i)
    return kept


def test_turn_query_by_brute_force(spark):
    source = by_episode(catalogue.line_frames(spark, SF), ("x", "y", "z"))
    got, gone = by_episode(catalogue.QUERIES["turn_sparsify"](spark, SF), ("frame_index",)), 0
    for e, p in list(source.items())[:6]:
        want = thinned(np.array(p, float), **catalogue.THIN)
        assert [r[0] for r in got[e]] == want
        gone += len(p) - len(want)
    assert gone


@pytest.mark.parametrize("few", [1, 50, 10_000])
def test_percentiles_are_exact(spark, monkeypatch, few):
    monkeypatch.setattr(windows, "FEW", few)
    monkeypatch.setattr(windows, "BINS", 8)
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=501), np.round(rng.exponential(size=400), 1), np.full(30, 2.5), np.array([1.0]), np.array([1.0, 9.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "s double")
        for p in (0, 37.5, 95, 100):
            got = windows.step_reference(df, ["s"], p).first()
            assert abs(got["s_limit"] - np.percentile(values, p)) < 1e-9 and got["s_max"] == values.max() and got["adjacent_pairs"] == len(values) + 2
    assert windows.step_reference(df.limit(0), ["s"], 95).first()["s_limit"] is None


def test_stretches_with_long_steps_are_put_back():
    p = np.stack([np.arange(10.0), np.zeros(10), np.zeros(10)], axis=1)
    arms = [{"p": p, "q": np.tile([0.0, 0, 0, 1], (10, 1))}]
    assert trajectory.restored(arms, np.array([0, 1, 4, 6, 9]), (2.5, 1.0)).tolist() == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    assert trajectory.restored(arms, np.array([0, 9]), None).tolist() == [0, 9]


def test_null_and_nan_are_violations(spark):
    a = arms_of(spark)
    for change in ({"width": F.lit(float("nan"))}, {"x": F.lit(None).cast("double")}, {c: F.lit(0.0) for c in ("qx", "qy", "qz", "qw")}):
        first = (F.col("episode_index") == 1) & (F.col("frame_index") == 4)
        bad = a.withColumns({c: F.when(first, v).otherwise(F.col(c)) for c, v in change.items()})
        found = {r["check"] for r in trajectory.run(bad, config.Settings.of({})).violations.collect()}
        assert "finite source" in found or "quaternion" in found


def test_step_limit_sweeps():
    p = np.random.default_rng(1).normal(size=(20, 3)).cumsum(axis=0) * 0.015
    tight = kernels.limit_steps(p, 0.02, 1e-9, 1, 3000, False)[1]
    assert kernels.limit_steps(p, 0.02, 1e-5, 1, 3000, False)[1] <= tight


def test_rotation_smoothing():
    a = np.radians(np.linspace(-17, 17, 21))
    a[10] += 0.02
    m = np.stack([np.stack([np.cos(a), -np.sin(a), 0 * a], 1), np.stack([np.sin(a), np.cos(a), 0 * a], 1), np.stack([0 * a, 0 * a, 1 + 0 * a], 1)], 1)
    s = kernels.smooth_rotations(m, 5, 1, 2)
    assert np.abs(s.transpose(0, 2, 1) @ s - np.eye(3)).max() < 1e-9 and np.abs(np.linalg.det(s) - 1).max() < 1e-9
    assert (s[:2] == m[:2]).all() and np.abs(np.diff(np.arctan2(s[:, 1, 0], s[:, 0, 0]), 2)).max() < np.abs(np.diff(a, 2)).max()


TURN = dict(turn_deg=3, context=2, context_distance=0.0005, dense=0.0015, kept_step=0.003, position_error=0.0005, rotation_error_deg=0.3, gripper_change=0.02, consecutive=1)


def test_turns_are_thinned_and_lines_are_not():
    a = np.radians(np.linspace(0, 90, 21))
    arc = np.stack([0.01 * np.cos(a), 0.01 * np.sin(a), 0 * a], axis=1)
    q = np.tile([0.0, 0, 0, 1], (21, 1))
    keep = kernels.sparsify([{"p": arc, "q": q, "g": np.zeros(21)}], **TURN)
    assert 0 < (~keep).sum() and keep[[0, -1]].all()
    assert np.linalg.norm(np.diff(arc[keep], axis=0), axis=1).max() <= 0.003
    assert kernels.sparsify([{"p": arc, "q": q, "g": np.linspace(0, 1, 21)}], **TURN).all()
    line = np.stack([np.arange(30) * 0.0005, np.zeros(30), np.zeros(30)], axis=1)
    assert kernels.sparsify([{"p": line, "q": np.tile([0.0, 0, 0, 1], (30, 1)), "g": np.zeros(30)}], **TURN).all()


def test_slow_prefix():
    p = np.stack([np.arange(80) * 0.00025, np.zeros(80), np.zeros(80)], axis=1)
    kept = trajectory.prefix([{"p": p}], 50, 0.001)
    assert np.diff(p[kept[kept <= 50], 0]).min() >= 0.001 - 1e-12 and kept[kept >= 50].tolist() == list(range(50, 80))


def test_merged_stats_are_those_of_the_whole(spark):
    f = spark.createDataFrame([(i % 3, i, float(i * i % 17)) for i in range(50)], "episode_index long, frame_index long, v double")
    merged = stats.merge_stats(stats.episode_stats(f, ["v"]), ["feature"]).first()
    v = np.array([r["v"] for r in f.collect()])
    assert np.allclose([merged[k] for k in stats.STATS], [v.min(), v.max(), v.mean(), v.std(), 50])


def test_codes(spark):
    d = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "d double")
    assert [r[0] for r in d.select(encode.strict_depth_code(F.col("d"), 0.0, 1.0)).collect()] == [0, 128, 255]
    d = spark.createDataFrame([(-0.1,), (0.5,), (1.2,)], "d double")
    assert [r[0] for r in d.select(encode.depth_code(F.col("d"), 0.0, 1.0)).collect()] == [0, 128, 255]
    assert tuple(d.agg(*encode.outside(F.col("d"), 0.0, 1.0)).first()) == (1, 1)
    with pytest.raises(Exception, match="not in the range"):
        d.select(encode.strict_depth_code(F.col("d"), 0.0, 1.0)).collect()
    f = spark.createDataFrame([(-2.0, -2.0, 2.0), (2.0, -2.0, 2.0), (7.0, 7.0, 7.0)], "v double, lo double, hi double")
    assert [r[0] for r in f.select(encode.force_code(F.col("v"), F.col("lo"), F.col("hi"))).collect()] == [0, 255, 0]
    assert len(one(spark.range(1).select(encode.pad_last(F.array(*[F.array(F.lit(i)) for i in range(35)]), 36)))) == 36


def test_crop_origin(spark):
    at = lambda w, h: list(spark.range(1).select(*encode.crop_origin((1440, 1080), F.lit(w), F.lit(h), F.lit(700.6), F.lit(530.4), (1080, 1000))).first())
    assert at(1440, 1080) == [0, 0] and at(1080, 1000) == [161, 30] and at(1280, 720) == [None, None]


def test_gripper(spark):
    w = spark.createDataFrame([(0.05,), (-1.0,), (0.3,)], "w double")
    assert [r[0] for r in w.select(g.map_gripper(F.col("w"), (0.0, 0.1), (0.0, 1.0))).collect()] == [0.5, -1.0, 1.0]
    with pytest.raises(ValueError):
        g.map_gripper(F.lit(0.0), (1.0, 1.0), (0.0, 1.0))


def test_discovery_and_lookup(spark):
    names = ["task_20261019_130050", "task_20261019_123819", "task_20261019_merged", "task_20261019_123819_width", "other_20261019_141617"]
    found = merge.discover(spark.createDataFrame([(n,) for n in names], "name string"), "name", "task", "20261019").orderBy("time")
    assert [r["name"] for r in found.collect()] == ["task_20261019_123819", "task_20261019_130050"]
    a, b = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(1, "x")], "k long, v string")
    with pytest.raises(Exception, match="no k 2"):
        merge.lookup(a, b, "k").collect()


def test_violations_raise(spark):
    f = frames(spark, [0, 5])
    with pytest.raises(ValueError, match="far: episode 0"):
        validate.require(validate.violations(f, "far", F.col("x"), 1.0))
    validate.require(validate.violations(f, "far", F.col("x"), 10.0))


def test_solver_sees_all_frames(spark):
    f = spark.createDataFrame([(0, i, float(i), i in (1, 4)) for i in range(5)], "episode_index long, frame_index long, x double, selected boolean")
    got = media.solve_selected(f, "x", catalogue.RunningMean).orderBy("frame_index").collect()
    assert [(r["frame_index"], r["solved"]) for r in got] == [(1, 0.5), (4, 2.0)]


def test_settings():
    s = config.Settings.of({"smoothing": {"enabled": True, "window_size": 7}})
    assert s.smoothing.window_size == 7
    for bad in ({"smoothing": {"window": 3}}, {"other": {}}, {"smoothing": {"window_size": 4}}):
        with pytest.raises(ValueError):
            config.Settings.of(bad)
    with pytest.raises(ValueError):
        config.safe_output("/a/b/c/d", "/a/b/c")


SAMPLE = """
preprocessing: {merge: {enabled: true, output: /x/merged}}
source: {root: /x/in/set}
output: {root: /x/out/set, chunks_size: 500, overwrite: true}
task: {prompt: null}
trajectory:
  pose_transform: {enabled: true, rotation_order: intrinsic_xyz, rotation_deg: {x: 30.0, y: 0.0, z: -90.0}, translation_frame: rotated_local, translation_m: [-0.1, 0.0, 0.2]}
  action_offset_frames: 2
  tail_policy: repeat_last
  gripper: {mapping: linear, distance_section: distance, radians_section: width_to_rad, clip: false}
trim: {enabled: true, position_threshold_m: 0.03, rotation_threshold_deg: 4.0, gripper_threshold_rad: 0.1, min_episode_frames: 16}
smoothing: {enabled: true, window_size: 7, visualization_episode_index: 0, visualization_axis_length_m: 0.005}
step_limit: {enabled: false, percentile: 95.0, visualization_episode_index: 0}
turn_sparsification: {enabled: true, prefix_min_spacing_m: 0.002, min_turn_context_distance_m: 0.003, dense_step_threshold_m: 0.004, max_kept_step_m: 0.005, max_position_error_m: 0.006, gripper_change_threshold_rad: 0.03}
video: {width: 240}
validation: {action_horizon: 32}
"""


def test_settings_of_dataset_pipelines(tmp_path):
    (tmp_path / "c.yaml").write_text(SAMPLE)
    s = config.load(str(tmp_path / "c.yaml"))
    assert s.unused == ("preprocessing", "validation", "video") and s.source == "/x/in/set" and s.output == config.Place("/x/out/set", 500, True) and s.prompt is None
    t = s.trajectory
    assert (t.translation, t.rotation_deg, t.translation_frame, t.action_offset_frames, t.clip) == ((-0.1, 0.0, 0.2), (30.0, 0.0, -90.0), "rotated_local", 2, False)
    assert (s.trim.position_threshold, s.trim.gripper_threshold, s.smoothing.window_size) == (0.03, 0.1, 7)
    p = s.turn_sparsification
    assert (p.prefix_min_spacing, p.min_turn_context_distance, p.dense_step_threshold, p.max_kept_step, p.max_position_error, p.gripper_change_threshold) == (0.002, 0.003, 0.004, 0.005, 0.006, 0.03)
    with pytest.raises(ValueError, match="unknown sections preprocessing, validation, video"):
        config.load(str(tmp_path / "c.yaml"), strict=True)
    for bad in ({"trajectory": {"tail_policy": "drop"}}, {"trajectory": {"gripper": {"mapping": "cubic"}}}, {"trajectory": {"pose_transform": {"enabled": True, "tilt": 1}}}, {"trim": {"position_threshold_m": 1, "position_threshold": 1}}, {"output": {"folder": 1}}):
        with pytest.raises((ValueError, TypeError)):
            config.Settings.of(bad)
    assert config.Settings.of({"trajectory": {"pose_transform": {"enabled": False, "rotation_deg": {"x": 1}}}}).trajectory.translation is None


def arms_of(spark, n=90, episodes=2):
    rows = []
    for e in range(episodes):
        for i in range(n):
            t = min(max(i - 20, 0), 50) / 50
            for role, sign in (("right", 1), ("left", -1)):
                rows.append((e, i, role, sign * (0.1 * t + 0.001 * (i % 2)), 0.0, 0.01 * math.sin(6 * t), *map(float, quaternion(40 * t)), 0.05 if role == "right" else -1.0))
    return spark.createDataFrame(rows, "episode_index long, frame_index long, role string, x double, y double, z double, qx double, qy double, qz double, qw double, width double")


def test_whole_trajectory_pipeline(spark):
    s = config.Settings.of({
        "smoothing": {"enabled": True}, "step_limit": {"enabled": True, "percentile": 99}, "trim": {"enabled": True, "min_episode_frames": 10, "pre_roll_frames": 2, "post_roll_frames": 2},
        "turn_sparsification": {"enabled": True, "prefix_frames": 5, "prefix_min_spacing": 0.0001},
    })
    out = trajectory.run(arms_of(spark), s)
    validate.require(out.violations)
    f = out.frames.cache()
    n = f.count()
    assert 0 < n < 2 * 2 * 90 and n == 2 * out.selection.count()
    assert validate.alignment_error(f.where("role = 'right'"), trajectory.POSE, 1).agg(F.max("error")).first()[0] <= 1e-6
    assert validate.rotation_quality(f, trajectory.R6).agg(F.max("orthogonality")).first()[0] < 1e-4
    assert sorted(r[0] for r in f.select("index").distinct().collect()) == list(range(n // 2))
    assert {r["gripper"] for r in f.where("role = 'left'").select("gripper").distinct().collect()} == {-1.0}
    w = trajectory.wide(f)
    assert w.count() == n // 2 and len(w.first()["state"]) == 20


def test_all_static_is_a_violation(spark):
    still = arms_of(spark).withColumn("x", F.lit(0.0)).withColumn("z", F.lit(0.0)).withColumn("qz", F.lit(0.0)).withColumn("qw", F.lit(1.0))
    out = trajectory.run(still, config.Settings.of({"trim": {"enabled": True, "min_episode_frames": 10}}))
    with pytest.raises(ValueError, match="trim never_leaves"):
        validate.require(out.violations)


def test_dataset_round_trip(spark, tmp_path):
    root = str(tmp_path / "set")
    features = {"observation.state": {"dtype": "float32", "shape": [7]}, "timestamp": {"dtype": "float32", "shape": [1]}, "frame_index": {"dtype": "int64", "shape": [1]}, "episode_index": {"dtype": "int64", "shape": [1]}}
    rows = [(e, i, [float(i)] * 7, i / 30) for e in range(2) for i in range(3)]
    df = spark.createDataFrame(rows, "episode_index long, frame_index long, `observation.state` array<double>, timestamp double")
    wrote = dataset.write(df, root, features).collect()
    assert sorted(r["length"] for r in wrote) == [3, 3]
    (tmp_path / "set/meta").mkdir()
    info = dataset.info_of({"features": features}, 2, 6, 0, 1, 1000, features)
    (tmp_path / "set/meta/info.json").write_text(json.dumps(info, indent=2))
    (tmp_path / "set/meta/episodes.jsonl").write_text("".join(json.dumps({"episode_index": e, "tasks": ["t"], "length": 3}) + "\n\n" for e in range(2)))
    (tmp_path / "set/meta/tasks.jsonl").write_text(json.dumps({"task_index": 0, "task": "t"}) + "\n")
    import pyarrow.parquet as pq

    s = pq.read_schema(f"{root}/data/chunk-000/episode_000001.parquet")
    assert str(s.field("observation.state").type) == "fixed_size_list<element: float>[7]" and b"huggingface" in s.metadata
    d = dataset.read(spark, root)
    assert d.frames.count() == 6 and len(d.frames.first()["state"]) == 7 and dataset.inspect(d).count() == 0
    assert dataset.slot_index(["tcp_right_S.x", "tcp_left_S.x"], "tcp_right", "x") == 0
    assert {r["path"][-22:] for r in merge.file_manifest(spark, f"{root}/data").collect()} == {"episode_000000.parquet", "episode_000001.parquet"}


def test_command_line(spark, tmp_path):
    from trackframe.__main__ import main

    root, out = tmp_path / "in" / "set", tmp_path / "out" / "set"
    names = [f"tcp_right_S.{c}" for c in ("x", "y", "z", "qx", "qy", "qz", "qw")] + ["grip.width_m"]
    features = {"observation.state": {"dtype": "float32", "shape": [8], "names": names}, "timestamp": {"dtype": "float32", "shape": [1]}, "frame_index": {"dtype": "int64", "shape": [1]}, "episode_index": {"dtype": "int64", "shape": [1]}}
    rows = [(e, i, [0.01 * i, 0.0, 0.0, *map(float, quaternion(i)), 0.05], i / 30) for e in range(2) for i in range(12)]
    dataset.write(spark.createDataFrame(rows, "episode_index long, frame_index long, `observation.state` array<double>, timestamp double"), str(root), features, 1).collect()
    (root / "meta").mkdir()
    (root / "meta/info.json").write_text(json.dumps(dataset.info_of({}, 2, 24, 0, 1, 1, features)))
    (root / "meta/episodes.jsonl").write_text("".join(json.dumps({"episode_index": e, "tasks": ["t"], "length": 12}) + "\n" for e in range(2)))
    (root / "meta/tasks.jsonl").write_text(json.dumps({"task_index": 0, "task": "t"}) + "\n")
    (tmp_path / "c.yaml").write_text("smoothing: {enabled: true}\n")
    arms = json.dumps({"right": {"pose": "tcp_right", "gripper": "grip.width_m"}})
    args = ["--config", str(tmp_path / "c.yaml"), "--input", str(root), "--output", str(out), "--arms", arms]
    assert main([*args, "--check"]) == 0 and not out.exists()
    assert main(args) == 0
    w = spark.read.parquet(str(out / "data/chunk-001/episode_000001.parquet"))
    assert w.count() == 12 and len(w.orderBy("frame_index").first()["action"]) == 10
    back = dataset.read(spark, str(out))  # what is written reads back
    assert dataset.inspect(back).count() == 0 and back.info["total_frames"] == 24 and back.info["chunks_size"] == 1
    assert back.info["features"]["action"]["names"] == list(trajectory.SLOT_NAMES)
    assert [tuple(r) for r in back.tasks.collect()] == [(0, "t")] and {tuple(r["tasks"]) for r in back.episodes.collect()} == {("t",)}
    assert [json.loads(x)["episode_index"] for x in (out / "meta/episodes.jsonl").read_text().splitlines()] == [0, 1]
    assert {r["task_index"] for r in back.frames.select("task_index").distinct().collect()} == {0}
    assert sorted(x.name for x in (out / "meta").iterdir() if not x.name.startswith(".")) == ["episodes.jsonl", "episodes_stats.jsonl", "info.json", "selection", "stats.json", "tasks.jsonl"]
    other = tmp_path / "other" / "set"
    assert main([*args[:4], "--output", str(other), *args[6:], "--task", "lift it"]) == 0
    assert [tuple(r) for r in dataset.read(spark, str(other)).tasks.collect()] == [(0, "lift it")]
    assert main(["validate", "--input", str(out), "--offset", "1"]) == 0 and main(["validate", "--input", str(out), "--offset", "3"]) == 1
    both = tmp_path / "both" / "set"
    with pytest.raises(ValueError, match="tasks differ"):
        main(["merge", "--input", str(out), "--input", str(other), "--output", str(both)])
    again = tmp_path / "again" / "set"
    assert main([*args[:4], "--output", str(again), *args[6:]]) == 0
    assert main(["merge", "--input", str(out), "--input", str(again), "--output", str(both)]) == 0
    merged = dataset.read(spark, str(both))
    assert dataset.inspect(merged).count() == 0 and merged.info["total_episodes"] == 4 and merged.info["total_frames"] == 48
    assert sorted(r[0] for r in merged.frames.select("index").collect()) == list(range(48))
    assert main(["validate", "--input", str(both), "--offset", "1"]) == 0
    for bad in ([str(out)], [str(out), str(out) + "/"]):
        with pytest.raises(ValueError):
            merging.checked_inputs(bad)
    a, b = (merge.file_manifest(spark, str(x) + "/meta") for x in (out, again))
    names = [{r["path"] for r in x.collect() if not r["path"].startswith("selection/")} for x in (a, b)]
    assert names[0] == names[1] >= {"info.json", "tasks.jsonl"}
    (root / "meta/episodes.jsonl").write_text(json.dumps({"episode_index": 0, "tasks": ["t"], "length": 99}) + "\n")
    assert main([*args, "--check"]) == 1


@pytest.mark.parametrize("few", [5, 10_000])
def test_infinite_steps_have_no_rank(spark, monkeypatch, few):
    """They are left out of the percentile, however many bins it takes, and the plan refuses their source."""
    monkeypatch.setattr(windows, "FEW", few)
    steps = [float(i) for i in range(2000)] + [math.inf] * 50 + [-math.inf, math.nan, None, 1.7e308]
    df = spark.createDataFrame([(v,) for v in steps], "p double")
    got = windows.step_reference(df, ["p"], 95).first()
    want = sorted(v for v in steps if v is not None and math.isfinite(v))
    assert got["p_limit"] == pytest.approx(np.percentile(want, 95)) and got["p_max"] == 1.7e308 and got["adjacent_pairs"] == len(steps)
    arms = arms_of(spark, 12, 1).withColumn("x", F.when(F.col("frame_index") == 5, math.inf).otherwise(F.col("x")))
    with pytest.raises(ValueError, match="finite source"):
        trajectory.run(arms, config.Settings.of({"step_limit": {"enabled": True}}))


def test_rotations_are_checked_after_step_limits(spark, monkeypatch):
    s = config.Settings.of({"step_limit": {"enabled": True, "percentile": 99}})
    limit = trajectory.limit
    monkeypatch.setattr(trajectory, "limit", lambda *a: limit(*a).withColumns({c: F.lit(0.0) for c in ("r0", "r1", "r2")}))
    out = trajectory.run(arms_of(spark, 40, 1), s)
    assert "rotation" in {r["check"] for r in out.violations.collect()}
    out.release()
    assert all(not d.is_cached for d in out.held)


def test_episodes_of_one_frame_have_no_steps(spark):
    out = trajectory.run(arms_of(spark, 1, 2), config.Settings.of({"trajectory": {"action_offset_frames": 0}, "step_limit": {"enabled": True}}))
    assert out.frames.count() == 4 and out.violations.count() == 0


def test_sessions_of_a_stream(spark, tmp_path):
    from trackframe.streaming.sessions import session_episodes

    e = spark.sql("SELECT id % 2 AS user_id, timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id * 7 + IF(id > 5, 90, 0) AS INT), 0) AS ts, CAST(id AS DOUBLE) AS value FROM range(10)")
    e.write.parquet(str(tmp_path / "in"))
    want = sorted(map(tuple, session_episodes(e).collect()))
    s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = session_episodes(s).writeStream.format("memory").queryName("sessions").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("sessions").collect())) == want and len(want) == 4
