"""python -m trackframe --config FILE --input DIR --output DIR [--check] [--overwrite]: run the trajectory plan over a dataset on disk.

python -m trackframe merge --input DIR --input DIR ... --output DIR [--overwrite]: datasets that fit as one.
python -m trackframe validate --input DIR [--offset N]: numbering, totals, files, finite values and alignment of a dataset.
python -m trackframe inspect --input DIR --arms JSON: what a source holds, and what keeps it from being converted.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from trackframe.functions import geometry
from trackframe.operators import validate
from trackframe.plans import config, inspection, merging, trajectory
from trackframe.sources import dataset, files, statistics, store

SLOTS = ("x", "y", "z", "qx", "qy", "qz", "qw")
ARMS = '{"right": {"pose": "tcp_right"}}'


def arms(d: dataset.Dataset, roles: dict[str, dict[str, str]], state: str = "observation.state"):
    """Frames by arm, with slots found by name. roles: role to {pose: prefix, gripper: name of the width's slot, or none}."""
    names = d.info["features"][state]["names"]
    rows = []
    for role, of in roles.items():
        pose = [F.element_at("state", dataset.slot_index(names, of["pose"], c) + 1).alias(c) for c in SLOTS]
        width = F.element_at("state", names.index(of["gripper"]) + 1) if of.get("gripper") else F.lit(-1.0)
        rows.append(F.struct(F.lit(role).alias("role"), *pose, width.alias("width")))
    return d.frames.select("episode_index", "frame_index", F.inline(F.array(*rows)))


def tasks_of(d: dataset.Dataset, override: str | None):
    """tasks (task_index, task), and episode_index, task_index; a prompt given takes the place of all."""
    if override is not None:
        one = d.frames.sparkSession.createDataFrame([(0, override)], "task_index long, task string")
        return one, d.episodes.select("episode_index", F.lit(0).cast("long").alias("task_index"))
    if "task_index" in d.frames.columns:
        return d.tasks, d.frames.groupBy("episode_index").agg(F.min_by("task_index", "frame_index").cast("long").alias("task_index"))
    first = d.episodes.select("episode_index", F.try_element_at("tasks", F.lit(1)).alias("task"))
    return d.tasks, first.join(d.tasks, "task", "left").select("episode_index", "task_index")


def merge_command(argv: list[str]) -> int:
    p = argparse.ArgumentParser(prog="trackframe merge")
    p.add_argument("--input", action="append", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--overwrite", action="store_true", help="an output that is there gives way when the new one is whole")
    p.add_argument("--runtime", help="FOLDER:FIELD:PREFIX of runtime sets: their folder, the episodes' field, the prefix of videos' keys before a serial")
    a = p.parse_args(argv)
    output = config.safe_output(a.output, *a.input)
    spark = SparkSession.builder.appName("trackframe").getOrCreate()
    sets = merging.Runtime(*a.runtime.split(":", 2)) if a.runtime else None
    print(json.dumps(merging.merge_datasets(spark, a.input, output, overwrite=a.overwrite, sets=sets), indent=2))
    return 0


def inspect_command(argv: list[str]) -> int:
    p = argparse.ArgumentParser(prog="trackframe inspect")
    p.add_argument("--input", required=True)
    p.add_argument("--arms", default=ARMS, help="JSON: role to pose prefix, gripper slot and video key")
    p.add_argument("--fps", type=int, default=30, help="the rate that another one is warned about")
    a = p.parse_args(argv)
    found = inspection.report(SparkSession.builder.appName("trackframe").getOrCreate(), a.input, json.loads(a.arms), a.fps)
    print(json.dumps(found, indent=2, ensure_ascii=False))
    return int(bool(found["errors"]))


def validate_command(argv: list[str]) -> int:
    """Rows that break a rule are printed, ten at most of each; none: 0."""
    p = argparse.ArgumentParser(prog="trackframe validate")
    p.add_argument("--input", required=True)
    p.add_argument("--offset", type=int, help="frames by which the action runs ahead of the state")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("trackframe").getOrCreate()
    info, episodes = dataset.described(spark, a.input)
    if found := files.inspect_files(spark, a.input, episodes, info).orderBy("path").limit(10).collect():
        print(merging.report(found))  # frames may not be read before their files are right
        return 1
    d = dataset.read(spark, a.input)
    found = dataset.inspect(d).limit(10).collect()
    width = d.info["features"]["observation.state"]["shape"][0]
    slots = d.frames.select("episode_index", "frame_index", *[F.element_at("state", i + 1).alias(f"s{i}") for i in range(width)], *([F.element_at(F.col("action").cast("array<double>"), i + 1).alias(f"action_s{i}") for i in range(width)] if "action" in d.frames.columns else []))
    bad = F.greatest(*[(~geometry.finite(F.col(c))).cast("double") for c in slots.columns if c not in ("episode_index", "frame_index")])
    found += validate.violations(slots, "finite", bad, 0.0).limit(10).collect()
    if a.offset is not None:
        error = validate.alignment_error(slots, [f"s{i}" for i in range(width)], a.offset)
        found += validate.violations(error, "alignment", F.col("error"), 1e-6).limit(10).collect()
    print(merging.report(found))
    return int(bool(found))


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    commands = {"merge": merge_command, "validate": validate_command, "inspect": inspect_command}
    if argv and argv[0] in commands:
        return commands[argv[0]](argv[1:])
    p = argparse.ArgumentParser(prog="trackframe", description=__doc__)
    p.add_argument("--config", required=True)
    p.add_argument("--input", help="the dataset; else the settings' source.root")
    p.add_argument("--output", help="else the settings' output.root")
    p.add_argument("--arms", default=ARMS, help="JSON: role to pose prefix and gripper slot")
    p.add_argument("--task", help="one prompt for all episodes, instead of the dataset's own")
    p.add_argument("--check", action="store_true", help="report violations, write nothing")
    p.add_argument("--overwrite", action="store_true", help="an output that is there gives way when the new one is whole")
    a = p.parse_args(argv)
    settings = config.load(a.config)
    source, output = a.input or settings.source, a.output or settings.output.root
    if not source or not output:
        p.error("--input and --output, or source.root and output.root in the settings")
    output, task, overwrite = config.safe_output(output, source), a.task if a.task is not None else settings.prompt, a.overwrite or settings.output.overwrite
    if settings.unused:
        print(f"without effect here: {', '.join(settings.unused)}", file=sys.stderr)
    spark = SparkSession.builder.appName("trackframe").getOrCreate()
    d, roles = dataset.read(spark, source), json.loads(a.arms)
    bad = dataset.inspect(d).limit(10).collect()
    poses = arms(d, roles)
    bad += trajectory.source_violations(poses).limit(10).collect()  # before any kernel runs on them
    if bad:
        print(json.dumps([r.asDict() for r in bad], indent=2))
        return 1
    out = trajectory.run(poses, settings)
    try:
        bad = out.violations.limit(10).collect()
        if bad or a.check:
            print(json.dumps([r.asDict() for r in bad], indent=2))
            return int(bool(bad))
        with store.published(spark, output, overwrite) as stage:
            write(d, out, roles, task, stage)
    finally:
        out.release()
    return 0


def write(d: dataset.Dataset, out: trajectory.Result, roles: dict, task: str | None, stage: str) -> None:
    """The dataset of a plan's result, with the source's other columns at the frames that were kept.

    Videos are kept, as they are, only if all frames are: to cut them is an encoder's work (`operators/media.transcode`),
    which gets the frames from meta/selection. Else their features go, so that the output names no file that it lacks.
    """
    spark, chunk = d.frames.sparkSession, d.info.get("chunks_size", 1000)
    size = len(trajectory.POSE) * len(roles)
    names = [f"{role}.{n}" if len(roles) > 1 else n for role in roles for n in trajectory.SLOT_NAMES]
    made = {n: {"dtype": "float32", "shape": [size], "names": names} for n in ("observation.state", "action")}
    made |= {"timestamp": {"dtype": "float32", "shape": [1], "names": None}} | {n: {"dtype": "int64", "shape": [1], "names": None} for n in ("frame_index", "episode_index", "index", "task_index")}
    others = {n: f for n, f in d.info["features"].items() if n not in made and f.get("dtype") != "video" and n in d.frames.columns}
    tasks, of_episode = tasks_of(d, task)
    w = trajectory.wide(out.frames, tuple(roles)).withColumnRenamed("state", "observation.state")
    w = w.join(of_episode.select("episode_index", "task_index"), "episode_index", "left").withColumn("task_index", F.coalesce("task_index", F.lit(0).cast("long")))
    if others:
        source = d.frames.select("episode_index", F.col("frame_index").alias("source_frame"), *[F.col(f"`{n}`") for n in others])
        w = w.join(out.selection.withColumnRenamed("out_frame", "frame_index").join(source, ["episode_index", "source_frame"]).drop("source_frame"), ["episode_index", "frame_index"])
    stored = made | others
    w = w.persist(StorageLevel.MEMORY_AND_DISK)  # read for the files and for statistics
    written = dataset.write(w, stage, stored, chunk).select("episode_index", "length").persist()
    try:
        episodes, frames = written.count(), written.agg(F.sum("length")).first()[0]
        videos = {n: f for n, f in d.info["features"].items() if f.get("dtype") == "video"}
        if videos and d.episodes.join(written.withColumnRenamed("length", "now"), "episode_index", "full").where("not (length <=> now)").isEmpty():
            jobs = files.expected_videos(d.episodes, d.info)
            store.copied(jobs.select(F.concat(F.lit(f"{store.qualified(spark, d.root)}/"), "path").alias("source"), F.concat(F.lit(f"{stage}/"), "path").alias("target"))).agg(F.count("state")).first()
        else:
            videos = {}
        info = dataset.info_of(d.info, episodes, frames, len(videos), tasks.count(), chunk, stored | videos) | {"data_path": dataset.DATA_PATH}
        tasks_text = F.col("tasks") if task is None else F.array(F.lit(task))
        listed = written.join(d.episodes.select("episode_index", "tasks"), "episode_index", "left").select("episode_index", tasks_text.alias("tasks"), "length")
        dataset.write_jsonl(listed, f"{stage}/meta/episodes.jsonl", "episode_index")
        dataset.write_jsonl(tasks, f"{stage}/meta/tasks.jsonl", "task_index")
        stats = statistics.of_columns(w, [n for n, f in stored.items() if len(f["shape"]) == 1])
        if videos and store.exists(spark, merging.stats_path(d.root)):
            stats = stats.unionByName(statistics.read(spark, merging.stats_path(d.root)).where(F.col("feature").isin(*videos)))
        stats = stats.persist()
        dataset.write_lines(statistics.episode_lines(stats), merging.stats_path(stage))
        dataset.write_lines(statistics.whole_line(stats), f"{stage}/meta/stats.json")
        stats.unpersist()
        out.selection.write.parquet(f"{stage}/meta/selection")  # a row a frame: no file of one task
        dataset.write_json(spark, info, f"{stage}/meta/info.json")
    finally:
        written.unpersist()
        w.unpersist()


if __name__ == "__main__":
    sys.exit(main())
