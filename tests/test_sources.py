import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trackframe.__main__ import main
from trackframe.plans import inspection, merging
from trackframe.sources import dataset, files, runtime, statistics, store

VIDEO, SENSOR = "observation.images.hand", "observation.images.touch_S1"
RUNTIME = merging.Runtime("touch_runtime", "runtime_set_id", "observation.images.touch_")
NAMES = [f"tcp_right_S.{c}" for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]


def numbers(values):
    v = np.asarray(values, float).reshape(len(values), -1)
    return {"min": v.min(0).tolist(), "max": v.max(0).tolist(), "mean": v.mean(0).tolist(), "std": v.std(0).tolist(), "count": [len(v)]}


def make(root, lengths, fixed=True, task="t", sensor=False, chunk=1000, extra=None):
    """A dataset on disk, an episode of each length."""
    root.mkdir(parents=True)
    features = {"observation.state": {"dtype": "float32", "shape": [7], "names": NAMES}, VIDEO: {"dtype": "video", "shape": [1, 1, 3]}, "timestamp": {"dtype": "float32", "shape": [1]}}
    features |= {SENSOR: {"dtype": "video", "shape": [1, 1, 3]}} if sensor else {}
    features |= {"force": {"dtype": "float32", "shape": [2, 3]}} if extra else {}
    features |= {n: {"dtype": "int64", "shape": [1]} for n in ("frame_index", "episode_index", "index", "task_index")}
    videos = [k for k, f in features.items() if f["dtype"] == "video"]
    lines, stats, first = [], [], 0
    for e, n in enumerate(lengths):
        state = np.zeros((n, 7), np.float32)
        state[:, 0], state[:, 6] = np.arange(n) * 0.01 + e, 1
        columns = {
            "observation.state": pa.FixedSizeListArray.from_arrays(pa.array(state.ravel()), 7) if fixed else pa.array(state.tolist(), pa.list_(pa.float32())),
            "timestamp": pa.array(np.arange(n) / 30, pa.float32()), "frame_index": pa.array(np.arange(n)), "episode_index": pa.array(np.full(n, e)), "index": pa.array(np.arange(first, first + n)), "task_index": pa.array(np.zeros(n, int)),
        }
        if extra:
            columns["force"] = pa.array([[[float(e), i, j] for j in range(2)] for i in range(n)], pa.list_(pa.list_(pa.float32())))
        path = root / f"data/chunk-{e // chunk:03d}/episode_{e:06d}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(columns), path)
        for k in videos:
            v = root / f"videos/chunk-{e // chunk:03d}/{k}/episode_{e:06d}.mp4"
            v.parent.mkdir(parents=True, exist_ok=True)
            v.write_bytes(f"{root.name} {k} {e}".encode())
        lines.append({"episode_index": e, "tasks": [task], "length": n, "note": f"of {root.name}"})
        image = {k: {m: [[[0.5 * (m == "mean")]]] for m in ("min", "max", "mean", "std")} | {"count": [n]} for k in videos}
        stats.append({"episode_index": e, "stats": {"observation.state": numbers(state), "index": numbers(np.arange(first, first + n)), "episode_index": numbers(np.full(n, e))} | image})
        first += n
    info = dataset.info_of({"robot_type": "r", "fps": 30, "data_path": dataset.DATA_PATH, "video_path": files.VIDEO_PATH}, len(lengths), sum(lengths), len(videos), 1, chunk, features)
    for name, value in (("info.json", [info]), ("tasks.jsonl", [{"task_index": 0, "task": task}]), ("episodes.jsonl", lines), ("episodes_stats.jsonl", stats)):
        (root / "meta").mkdir(exist_ok=True)
        (root / "meta" / name).write_text("".join(json.dumps(v) + "\n" for v in value))
    (root / "assets").mkdir()
    (root / "assets/task.yaml").write_text("robot: {}\n")
    (root / "assets/view.rrd").write_text(root.name)
    return root


def add_set(root, set_id, payload, **over):
    folder = root / "touch_runtime" / set_id
    folder.mkdir(parents=True)
    (folder / "runtime_S1").write_bytes(payload)
    sensor = {"serial": "S1", "runtime": "runtime_S1", "runtime_sha256": hashlib.sha256(payload).hexdigest()} | over.pop("sensor", {})
    (folder / "manifest.json").write_text(json.dumps({"schema_version": 2, "runtime_set_id": set_id, "sensors": {"finger": sensor}} | over))
    lines = [json.loads(x) for x in (root / "meta/episodes.jsonl").read_text().splitlines()]
    (root / "meta/episodes.jsonl").write_text("".join(json.dumps(x | {"runtime_set_id": set_id}) + "\n" for x in lines))


def whole(spark, root, d):
    return merging.file_faults(spark, str(root)) + merging.faults(spark, str(root), d) == []


def tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file() and not p.name.endswith(".crc")}


# publication


def put(path, text):
    path = path.removeprefix("file:")
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/a", "w") as f:
        f.write(text)


def test_publish_new_overwrite_and_refuse(spark, tmp_path):
    out = tmp_path / "d" / "set"
    with store.published(spark, str(out)) as stage:
        put(stage, "one")
        assert not out.exists()
    assert tree(out) == {"a": b"one"}
    with pytest.raises(FileExistsError), store.published(spark, str(out)):
        raise AssertionError("the block must not run")
    with store.published(spark, str(out), overwrite=True) as stage:
        put(stage, "two")
        assert tree(out) == {"a": b"one"}
    assert tree(out) == {"a": b"two"}
    with pytest.raises(ValueError, match="nothing was written"), store.published(spark, str(out), overwrite=True):
        pass
    assert [p.name for p in out.parent.iterdir()] == ["set"]


def test_publish_fails_at_each_step(spark, tmp_path, monkeypatch):
    """An error in the block, and one at each rename: the old folder is there, and nothing else is left."""
    out, rename = tmp_path / "d" / "set", store.rename
    put(str(out), "old")
    with pytest.raises(RuntimeError), store.published(spark, str(out), overwrite=True) as stage:
        put(stage, "half")
        raise RuntimeError
    assert tree(out) == {"a": b"old"} and [p.name for p in out.parent.iterdir()] == ["set"]
    for step in (1, 2):
        calls = []

        def failing(*a, step=step, calls=calls):
            calls.append(a)
            if len(calls) == step:
                raise OSError("store")
            return rename(*a)

        monkeypatch.setattr(store, "rename", failing)
        with pytest.raises(OSError, match="store"), store.published(spark, str(out), overwrite=True) as stage:
            put(stage, "new")
        assert tree(out) == {"a": b"old"} and [p.name for p in out.parent.iterdir()] == ["set"]


def test_publish_killed_at_each_step(spark, tmp_path, monkeypatch):
    """A driver that dies can undo nothing: all calls after the step fail. The next publication brings the old folder back."""
    out, real = tmp_path / "d" / "set", {n: getattr(store, n) for n in ("rename", "delete")}
    put(str(out), "old")
    for step in (1, 2, 3):
        calls = []

        def dead(name, step=step, calls=calls):
            def call(*a):
                calls.append(name)
                if len(calls) >= step:
                    raise KeyboardInterrupt
                return real[name](*a)

            return call

        for n in real:
            monkeypatch.setattr(store, n, dead(n))
        with pytest.raises(KeyboardInterrupt), store.published(spark, str(out), overwrite=True) as stage:
            put(stage, "new")
        for n, f in real.items():
            monkeypatch.setattr(store, n, f)
        store.recover(spark, str(out))
        assert tree(out) == {"a": b"new" if step == 3 else b"old"}
        assert not [p for p in out.parent.iterdir() if "backup" in p.name]
        with store.published(spark, str(out), overwrite=True) as stage:
            put(stage, "old")


def test_copies_are_verified_and_whole(spark, tmp_path):
    for n, content in (("a", b"x" * 3_000_000), ("b", b""), ("c", b"c")):
        (tmp_path / n).write_bytes(content)
    (tmp_path / "to").mkdir()
    (tmp_path / "to/c").write_bytes(b"c")
    jobs = spark.createDataFrame([(f"{tmp_path}/{n}", f"file:{tmp_path}/to/{n}") for n in "abc"], "source string, target string")
    got = {r["source"][-1]: (r["bytes"], r["state"], r["sha256"]) for r in store.copied(jobs).collect()}
    assert {k: v[:2] for k, v in got.items()} == {"a": (3_000_000, "copied"), "b": (0, "copied"), "c": (1, "there")}
    assert got["a"][2] == hashlib.sha256(b"x" * 3_000_000).hexdigest()
    assert tree(tmp_path / "to").keys() == {"a", "b", "c"}
    (tmp_path / "to/c").write_bytes(b"other")
    with pytest.raises(Exception, match="another content"):
        store.copied(jobs).collect()
    with pytest.raises(Exception, match="nowhere"):
        store.copied(spark.createDataFrame([(f"{tmp_path}/nowhere", f"{tmp_path}/to/d")], "source string, target string")).collect()
    assert tree(tmp_path / "to").keys() == {"a", "b", "c"}


def test_file_that_fails_leaves_nothing(tmp_path):
    with pytest.raises(RuntimeError), store.whole_file(f"{tmp_path}/x/f") as out:
        out.write(b"half")
        raise RuntimeError
    assert tree(tmp_path) == {}


# files against episodes


def checks(spark, root):
    info, episodes = dataset.described(spark, str(root))
    return sorted((r["path"], r["check"]) for r in files.inspect_files(spark, str(root), episodes, info).collect())


def test_files_of_a_dataset(spark, tmp_path):
    root = make(tmp_path / "set", [3, 5, 2, 4], chunk=2)
    assert checks(spark, root) == []
    path = lambda e: root / f"data/chunk-{e // 2:03d}/episode_{e:06d}.parquet"
    one, zero = path(1).read_bytes(), path(0).read_bytes()
    path(1).write_bytes(pq_short(path(1)))  # a row less
    path(0).write_bytes(b"no parquet")
    path(2).rename(root / "data/chunk-001/episode_000009.parquet")
    (root / f"videos/chunk-000/{VIDEO}/episode_000001.mp4").unlink()
    (root / f"videos/chunk-001/{VIDEO}/episode_000003.mp4").write_bytes(b"")
    assert checks(spark, root) == [
        ("data/chunk-000/episode_000000.parquet", "unreadable"), ("data/chunk-000/episode_000001.parquet", "rows"), ("data/chunk-001/episode_000002.parquet", "missing file"),
        ("data/chunk-001/episode_000009.parquet", "no episode"), (f"videos/chunk-000/{VIDEO}/episode_000001.mp4", "missing video"), (f"videos/chunk-001/{VIDEO}/episode_000003.mp4", "missing video"),
    ]
    path(0).write_bytes(one)
    path(1).write_bytes(zero)
    assert {c for p, c in checks(spark, root) if p.endswith(("0.parquet", "1.parquet"))} == {"rows", "misplaced"}
    t = pq.read_table(path(3))
    pq.write_table(t.drop_columns("timestamp").append_column("more", pa.array([1.0] * 4)), path(3))
    assert ("data/chunk-001/episode_000003.parquet", "columns") in checks(spark, root)
    pq.write_table(t.set_column(1, "timestamp", pa.array([1] * 4)), path(3))
    assert ("data/chunk-001/episode_000003.parquet", "columns") in checks(spark, root)


def pq_short(path):
    sink = pa.BufferOutputStream()
    pq.write_table(pq.read_table(path)[:-1], sink)
    return sink.getvalue().to_pybytes()


def test_footers_read_no_page(spark, tmp_path):
    """Pages are overwritten, and the footers tell the same."""
    root = make(tmp_path / "set", [50])
    path = root / "data/chunk-000/episode_000000.parquet"
    before = files.footers(spark, f"{root}/data").collect()
    raw = path.read_bytes()
    size = int.from_bytes(raw[-8:-4], "little")
    path.write_bytes(raw[:4] + b"\xff" * (len(raw) - size - 12) + raw[-size - 8 :])
    assert files.footers(spark, f"{root}/data").collect() == before
    assert before[0]["rows"] == 50 and before[0]["columns"]["observation.state"] == "float[]" and (before[0]["index_low"], before[0]["index_high"]) == (0, 49)


# merging


def test_merge_holds_all_of_its_inputs(spark, tmp_path):
    a, b, out = make(tmp_path / "in/a", [2, 3], fixed=False, chunk=2, extra=True), make(tmp_path / "in/b", [1, 4], chunk=2, extra=True), tmp_path / "out/ab"
    info = merging.merge_datasets(spark, [str(a), str(b)], str(out))
    assert (info["total_episodes"], info["total_frames"], info["total_videos"], info["total_chunks"]) == (4, 10, 4, 2)
    d = dataset.read(spark, str(out))
    assert whole(spark, out, d)
    t = pq.read_table(out / "data/chunk-001/episode_000002.parquet")
    assert t["episode_index"].to_pylist() == [2] and t["index"].to_pylist() == [5] and str(t.schema.field("observation.state").type).startswith("fixed_size_list")
    assert t["force"].to_pylist() == [[[0.0, 0.0, 0.0], [0.0, 0.0, 1.0]]]
    assert (out / f"videos/chunk-001/{VIDEO}/episode_000003.mp4").read_bytes() == f"b {VIDEO} 1".encode()
    assert tree(out / "assets") == {"task.yaml": b"robot: {}\n"}
    lines = [json.loads(x) for x in (out / "meta/episodes.jsonl").read_text().splitlines()]
    assert [(x["episode_index"], x["note"], x["length"]) for x in lines] == [(0, "of a", 2), (1, "of a", 3), (2, "of b", 1), (3, "of b", 4)]
    stats = [json.loads(x) for x in (out / "meta/episodes_stats.jsonl").read_text().splitlines()]
    for x, first, n in zip(stats, (0, 2, 5, 6), (2, 3, 1, 4), strict=True):
        want = numbers(np.arange(first, first + n))
        assert all(np.allclose(x["stats"]["index"][k], want[k]) for k in want) and x["stats"]["index"]["count"] == [n]
        assert x["stats"]["episode_index"]["mean"] == [x["episode_index"]] and x["stats"][VIDEO]["mean"] == [[[0.5]]]
    total = json.loads((out / "meta/stats.json").read_text())
    assert np.allclose([total["index"][k][0] for k in ("min", "max", "mean", "std")], [0, 9, 4.5, np.arange(10).std()]) and total["index"]["count"] == [10]
    assert total["observation.state"]["count"] == [10] and len(total["observation.state"]["std"]) == 7


def test_merge_refuses_and_keeps_what_was_there(spark, tmp_path):
    a, b, out = make(tmp_path / "in/a", [2]), make(tmp_path / "in/b", [3]), tmp_path / "out/ab"
    args = ["merge", "--input", str(a), "--input", str(b), "--output", str(out)]
    assert main(args) == 0
    before = tree(out)
    with pytest.raises(FileExistsError):
        main(args)
    (b / "assets/task.yaml").write_text("robot: {x: 1}\n")
    with pytest.raises(ValueError, match="assets differ from .*task.yaml"):
        main([*args, "--overwrite"])
    (b / "assets/task.yaml").write_text("robot: {}\n")
    video = b / f"videos/chunk-000/{VIDEO}/episode_000000.mp4"
    video.rename(video.with_suffix(".gone"))
    with pytest.raises(ValueError, match="missing video"):
        main([*args, "--overwrite"])
    video.with_suffix(".gone").rename(video)
    assert tree(out) == before and [p.name for p in out.parent.iterdir()] == ["ab"]
    (b / "meta/tasks.jsonl").write_text(json.dumps({"task_index": 0, "task": "other"}) + "\n")
    with pytest.raises(ValueError, match="tasks differ"):
        main([*args, "--overwrite"])
    (b / "meta/tasks.jsonl").write_text(json.dumps({"task_index": 0, "task": "t"}) + "\n")
    stats = (b / "meta/episodes_stats.jsonl").read_text()
    (b / "meta/episodes_stats.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="statistics of episode 0"):
        main([*args, "--overwrite"])
    (b / "meta/episodes_stats.jsonl").write_text(stats)
    assert main([*args, "--overwrite"]) == 0
    assert tree(out).keys() == before.keys()


ONE, TWO = "xrs_" + "1" * 32, "xrs_" + "2" * 32


def test_runtime_sets_go_along(spark, tmp_path):
    a, b, c = (make(tmp_path / f"in/{n}", [2], sensor=True) for n in "abc")
    add_set(a, ONE, b"p")
    add_set(b, TWO, b"q")
    add_set(c, ONE, b"p")
    out = tmp_path / "out/abc"
    merging.merge_datasets(spark, [str(a), str(b), str(c)], str(out), sets=RUNTIME)
    assert tree(out / "touch_runtime") == tree(a / "touch_runtime") | tree(b / "touch_runtime")
    (c / f"touch_runtime/{ONE}/more").write_bytes(b"!")
    with pytest.raises(ValueError, match=f"{ONE} has different contents"):
        merging.merge_datasets(spark, [str(a), str(c)], str(tmp_path / "out/ac"), sets=RUNTIME)


@pytest.mark.parametrize(
    ("over", "why"),
    [({"schema_version": 1}, "version"), ({"runtime_set_id": TWO}, "other id"), ({"sensors": {}}, "no sensor"), ({"sensor": {"runtime": "../x"}}, "path"), ({"sensor": {"runtime": "/x"}}, "path"), ({"sensor": {"runtime": "y"}}, "no file"), ({"sensor": {"runtime_sha256": "0"}}, "content"), ({"sensor": {"serial": "S2"}}, "serials")],
)
def test_broken_runtime_sets(spark, tmp_path, over, why):
    root = make(tmp_path / "a", [2], sensor=True)
    add_set(root, ONE, b"p", **json.loads(json.dumps(over)))
    used = spark.createDataFrame([(ONE,)], "set_id string")
    found = runtime.faults(used, runtime.sensors(spark, str(root), "touch_runtime"), runtime.files_of(spark, str(root), "touch_runtime", used), ["S1"])
    assert why in {r["why"] for r in found.collect()}


def test_episode_without_runtime_set(spark, tmp_path):
    a, b = (make(tmp_path / f"in/{n}", [2], sensor=True) for n in "ab")
    add_set(a, ONE, b"p")
    with pytest.raises(ValueError, match="runtime set None, None: id"):
        merging.merge_datasets(spark, [str(a), str(b)], str(tmp_path / "out/ab"), sets=RUNTIME)


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1, "more": [2]}\n\n  \n{"k": "x"}\n{"k": 2\n[3]\n{}\n')
    rows, bad = dataset.json_lines(spark, str(tmp_path / "a.jsonl"), "k long, s string")
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, None), (None, None)]
    assert sorted(r["line"] for r in bad.collect()) == ['[3]', '{"k": "x"}', '{"k": 2'] and bad.first()["file"].endswith("/a.jsonl")
    root = make(tmp_path / "set", [2])
    with (root / "meta/episodes.jsonl").open("a") as f:
        f.write('{"episode_index": \n')
    assert any("no such line" in x for x in merging.file_faults(spark, str(root)))


# statistics


def test_nested_statistics_round_trip(spark, tmp_path):
    rows = [{"episode_index": e, "stats": {"v": {"min": [0.0, e], "max": [2.0, 3.0], "mean": [1.0, 1.5], "std": [0.5, 0.25], "count": [4 + e]}, "im": {k: [[[0.1 * e]], [[0.2]]] for k in ("min", "max", "mean", "std")} | {"count": [2]}}} for e in range(3)]
    (tmp_path / "s.jsonl").write_text("\n\n".join(map(json.dumps, rows)) + "\n")
    flat = statistics.read(spark, str(tmp_path / "s.jsonl"))
    assert flat.count() == 3 * 4
    dataset.write_lines(statistics.episode_lines(flat), str(tmp_path / "t.jsonl"))
    assert [json.loads(x) for x in (tmp_path / "t.jsonl").read_text().splitlines()] == rows
    later = flat.where("feature = 'v' and episode_index = 1").withColumn("min", F.lit(-9.0))
    united = {(r["episode_index"], r["feature"], tuple(r["place"])): r["min"] for r in statistics.unite(flat, later).collect()}
    assert len(united) == 12 and united[1, "v", (0,)] == -9.0 and united[2, "v", (1,)] == 2.0 and united[1, "im", (0, 0, 0)] == 0.1
    (tmp_path / "bad.jsonl").write_text(json.dumps({"episode_index": 0, "stats": {"v": {"min": [0], "max": [0, 1], "mean": [0], "std": [0], "count": [1]}}}) + "\n")
    with pytest.raises(Exception, match="differ in shape"):
        statistics.read(spark, str(tmp_path / "bad.jsonl")).collect()
    assert json.loads(statistics.whole_line(flat).first()["value"])["v"]["count"] == [4 + 5 + 6]
    assert statistics.episode_lines(flat.limit(0)).count() == 0


def test_statistics_of_columns(spark):
    f = spark.createDataFrame([(0, 1.0, [1, 2]), (0, 3.0, [5, 2]), (1, None, [0, 0])], "episode_index long, x double, `a.b` array<int>")
    got = {(r["episode_index"], r["feature"], r["place"][0]): (r["min"], r["max"], r["mean"], r["std"], r["count"]) for r in statistics.of_columns(f, ["x", "a.b"]).collect()}
    assert got[0, "x", 0] == (1, 3, 2, 1, 2) and got[0, "a.b", 0] == (1, 5, 3, 2, 2) and got[1, "x", 0] == (None, None, None, None, 0)


# commands


def test_inspection_report(spark, tmp_path, capsys):
    root = make(tmp_path / "set", [3, 2])
    arms = {"right": {"pose": "tcp_right", "video": VIDEO}}
    found = inspection.report(spark, str(root), arms)
    assert found["errors"] == [] and found["warnings"] == [] and found["frames"] == 5 and "observation.state" in found["columns"] and found["state_names"] == NAMES
    info = json.loads((root / "meta/info.json").read_text())
    info |= {"fps": 20, "total_frames": 6, "codebase_version": "v3"}
    (root / "meta/info.json").write_text(json.dumps(info))
    (root / "data/chunk-000/episode_000001.parquet").unlink()
    found = inspection.report(spark, str(root), {"right": {"pose": "tcp_left", "gripper": "w", "video": "none"}})
    text = "; ".join(found["errors"])
    assert all(x in text for x in ("codebase_version", "tcp_left.qw: 0 slots", "no slot w", "no video feature none", "total_frames is 6", "episode_000001.parquet: missing file")) and found["warnings"]
    assert main(["inspect", "--input", str(root)]) == 1
    assert "missing file" in capsys.readouterr().out


def test_trajectory_keeps_other_columns_and_videos(spark, tmp_path):
    root, out = make(tmp_path / "in/set", [40, 50], extra=True), tmp_path / "out/set"
    (tmp_path / "c.yaml").write_text("smoothing: {enabled: true}\n")
    args = ["--config", str(tmp_path / "c.yaml"), "--input", str(root), "--output", str(out)]
    assert main(args) == 0
    d = dataset.read(spark, str(out))
    assert whole(spark, out, d) and d.info["total_videos"] == 2 and d.info["features"]["force"]["shape"] == [2, 3]
    assert pq.read_table(out / "data/chunk-000/episode_000001.parquet")["force"].to_pylist()[7] == [[1.0, 7.0, 0.0], [1.0, 7.0, 1.0]]
    stats = [json.loads(x) for x in (out / "meta/episodes_stats.jsonl").read_text().splitlines()]
    assert stats[1]["stats"]["action"]["count"] == [50] and len(stats[1]["stats"]["observation.state"]["mean"]) == 10 and stats[1]["stats"][VIDEO]["max"] == [[[0.0]]]
    with pytest.raises(FileExistsError):
        main(args)
    (tmp_path / "c.yaml").write_text("trim: {enabled: true, min_episode_frames: 5, position_threshold: 0.05}\n")
    assert main([*args, "--overwrite"]) == 0
    d = dataset.read(spark, str(out))
    n = {r["episode_index"]: r["length"] for r in d.episodes.collect()}
    assert n[0] < 40 and d.info["total_videos"] == 0 and VIDEO not in d.info["features"] and whole(spark, out, d)
    force = pq.read_table(out / "data/chunk-000/episode_000001.parquet")["force"].to_pylist()
    kept = [r["source_frame"] for r in spark.read.parquet(str(out / "meta/selection")).where("episode_index = 1").orderBy("out_frame").collect()]
    assert [x[0][1] for x in force] == kept
    assert not [p for p in out.parent.iterdir() if p.name != "set"]
