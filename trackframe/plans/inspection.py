"""What a source dataset holds, and what keeps it from being converted: one report, before anything is read in full."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trackframe.sources import dataset, files, store

SLOTS = ("x", "y", "z", "qx", "qy", "qz", "qw")


def report(spark: SparkSession, root: str, arms: dict[str, dict[str, str]], fps: int = 30, state: str = "observation.state", most: int = 10) -> dict:
    """episodes, frames, fps, state's shape and names, columns of the files, errors and warnings (of each kind `most` at most).

    arms: role to pose prefix, gripper slot or none, and video (a key, or none). Files are judged by their footers.
    """
    errors, warnings = [], []
    info = dataset.read_json(spark, f"{root}/meta/info.json")
    features = info.get("features", {})
    if info.get("codebase_version") != dataset.VERSION:
        errors.append(f"codebase_version is {info.get('codebase_version')!r}, not {dataset.VERSION}")
    if info.get("fps") != fps:
        warnings.append(f"fps is {info.get('fps')}, not {fps}")
    shape, names = features.get(state, {}).get("shape"), features.get(state, {}).get("names") or []
    if state not in features:
        errors.append(f"no feature {state}")
    elif not isinstance(shape, list) or len(shape) != 1:
        errors.append(f"{state} has the shape {shape}, not one dimension")
    elif len(names) != shape[0] or len(set(names)) != len(names):
        errors.append(f"{state} has {len(names)} names, {len(set(names))} of them different, for {shape[0]} slots")
    for role, of in arms.items():
        for c in SLOTS:
            try:
                dataset.slot_index(names, of["pose"], c)
            except ValueError as x:
                errors.append(f"{role}: {x}")
        if of.get("gripper") and of["gripper"] not in names:
            errors.append(f"{role}: no slot {of['gripper']}")
        if of.get("video") and features.get(of["video"], {}).get("dtype") != "video":
            errors.append(f"{role}: no video feature {of['video']}")
    shared = [p for p in {of["pose"] for of in arms.values()} if sum(of["pose"] == p for of in arms.values()) > 1]
    errors += [f"several arms share the pose {p}" for p in sorted(shared)]

    episodes, bad = dataset.json_lines(spark, f"{root}/meta/episodes.jsonl", dataset.EPISODES)
    errors += [f"episodes.jsonl: no such line: {r['line'][:100]}" for r in bad.limit(most).collect()]
    told = episodes.agg(F.count(F.lit(1)).alias("episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames")).first()
    for name, key in (("episodes", "total_episodes"), ("frames", "total_frames")):
        if info.get(key) != told[name]:
            errors.append(f"{key} is {info.get(key)}, but episodes.jsonl has {told[name]}")
    wrong = files.inspect_files(spark, root, episodes, info)
    errors += [f"{r['path']}: {r['check']}" for r in wrong.orderBy("path", "check").limit(most).collect()]
    columns = files.footers(spark, f"{root}/data").where("columns is not null").select("columns").limit(1).collect()
    return {
        "source": store.qualified(spark, root), "episodes": told["episodes"], "frames": told["frames"], "fps": info.get("fps"), "state_shape": shape, "state_names": names,
        "columns": sorted(columns[0]["columns"]) if columns else [], "arms": arms, "errors": errors, "warnings": warnings,
    }
