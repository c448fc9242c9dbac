"""Datasets on disk made into one: checks that they fit and are whole, new numbers, one publication."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackframe.operators import merge
from trackframe.operators.datasets import TOTALS
from trackframe.operators.windows import episode_offsets
from trackframe.sources import dataset, files, runtime, statistics, store

#: Files of these names are no part of a dataset's assets.
SKIPPED = ".rrd"


@dataclass(frozen=True)
class Runtime:
    """How datasets name runtime sets: their folder, the field of an episode, and the prefix of videos' keys before a serial."""

    folder: str
    field: str
    prefix: str


def checked_inputs(inputs: Sequence[str] | None, discovered: Sequence[str] | None = None) -> list[str]:
    """The datasets to merge: given or discovered, not both, two at least, none twice."""
    if bool(inputs) == bool(discovered):
        raise ValueError("name the inputs, or have them discovered")
    found = [p.rstrip("/") for p in inputs or discovered]
    if twice := sorted({p for p in found if found.count(p) > 1}):
        raise ValueError(f"named twice: {', '.join(twice)}")
    if len(found) < 2:
        raise ValueError("a merge takes two datasets or more")
    return found


def plain_info(info: dict) -> dict:
    """A description without what only counts: datasets that are merged agree on the rest."""
    return {k: v for k, v in info.items() if k not in TOTALS and k != "total_tasks"}


def asset_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, source, sha256 of a dataset's assets, but for recordings of a viewer."""
    return store.hashed(store.listed(spark, f"{root}/assets").where(~F.lower("path").endswith(SKIPPED))).drop("bytes")


def differences(datasets: dict[str, dataset.Dataset], assets: dict[str, DataFrame] | None = None) -> list[str]:
    """What keeps datasets (path to dataset, path to manifest of its assets) from being merged; each against the first."""
    (first, head), *rest = datasets.items()
    out, tasks = [], head.tasks.select("task_index", "task")
    for path, d in rest:
        keys = plain_info(head.info).keys() | plain_info(d.info).keys()
        if differing := sorted(k for k in keys if head.info.get(k) != d.info.get(k)):
            out.append(f"{path}: {', '.join(differing)} differ from {first}")
        other = d.tasks.select("task_index", "task")
        if not tasks.exceptAll(other).isEmpty() or not other.exceptAll(tasks).isEmpty():
            out.append(f"{path}: tasks differ from {first}")
        if assets:
            here, there = (assets[p].select("path", F.col("sha256").alias(n)) for p, n in ((first, "a"), (path, "b")))
            if bad := here.join(there, "path", "full").where("not (a <=> b)").orderBy("path").limit(10).collect():
                out.append(f"{path}: assets differ from {first}: {', '.join(r['path'] for r in bad)}")
    return out


def file_faults(spark: SparkSession, root: str) -> list[str]:
    """What is wrong with a dataset's files, ten at most: judged by footers, before anything reads frames."""
    info, episodes = dataset.described(spark, root)
    bad = dataset.json_lines(spark, f"{root}/meta/episodes.jsonl", dataset.EPISODES)[1].union(dataset.json_lines(spark, f"{root}/meta/tasks.jsonl", dataset.TASKS)[1])
    found = [f"{r['file']}: no such line: {r['line'][:100]}" for r in bad.limit(10).collect()]
    return found + [f"{root}: {r['check']}: {r['path']}" for r in files.inspect_files(spark, root, episodes, info).orderBy("path").limit(10).collect()]


def faults(spark: SparkSession, root: str, d: dataset.Dataset) -> list[str]:
    """What is wrong with one dataset's numbers and statistics, ten of each kind at most."""
    found = [f"{root}: {r['check']} of episode {r['episode_index']}" for r in dataset.inspect(d).limit(10).collect()]
    if store.exists(spark, stats_path(root)):
        told = statistics.read(spark, stats_path(root)).select("episode_index").distinct().withColumn("told", F.lit(True))
        j = d.episodes.select("episode_index", F.lit(True).alias("there")).join(told, "episode_index", "full").where("told is null or there is null")
        found += [f"{root}: statistics of episode {r['episode_index']}" for r in j.orderBy("episode_index").limit(10).collect()]
    return found


def stats_path(root: str) -> str:
    return f"{root}/meta/episodes_stats.jsonl"


def episode_lines(spark: SparkSession, root: str) -> DataFrame:
    """episode_index, line: an episode's description as it stands in the file, whatever fields it has."""
    text = spark.read.text(f"{root}/meta/episodes.jsonl").where("trim(value) <> ''")
    return text.select(F.get_json_object("value", "$.episode_index").cast("long").alias("episode_index"), F.col("value").alias("line"))


def renumbered_stats(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Statistics (dataset_id, and as `statistics.read` gives them) under new numbers (dataset_id, source_episode, episode_index, length, first_index).

    Those of episode_index and index are made anew from the numbers: one value throughout, and a run of whole numbers.
    """
    j = rows.withColumnRenamed("episode_index", "source_episode").join(numbers, ["dataset_id", "source_episode"])
    first, n = F.col("first_index").cast("double"), F.col("length").cast("double")
    own, run = F.col("feature") == "episode_index", F.col("feature") == "index"
    e = F.col("episode_index").cast("double")
    at = {"min": (e, first), "max": (e, first + n - 1), "mean": (e, first + (n - 1) / 2), "std": (F.lit(0.0), F.sqrt((n * n - 1) / 12))}
    new = [F.when(own, a).when(run, b).otherwise(F.col(k)).alias(k) for k, (a, b) in at.items()]
    return j.select("episode_index", "feature", "place", *new, F.when(own | run, F.col("length")).otherwise(F.col("count")).alias("count"))


def merge_datasets(spark: SparkSession, inputs: Sequence[str], output: str, state: str = "observation.state", overwrite: bool = False, sets: Runtime | None = None) -> dict:
    """Publish the inputs as one dataset, in the order given, and return its description; anything that does not fit is an error.

    Frames, videos, the first input's assets, runtime sets (if `sets` says how they are named), descriptions of episodes
    with all their fields, and statistics go along. Nothing appears under `output` before all of it is there.
    """
    paths = [store.qualified(spark, p) for p in checked_inputs(inputs)]
    if wrong := [x for p in paths for x in file_faults(spark, p)]:
        raise ValueError("; ".join(wrong))
    read = {p: dataset.read(spark, p, state) for p in paths}
    assets = {p: asset_manifest(spark, p) for p in paths}
    if wrong := [x for p, d in read.items() for x in faults(spark, p, d)] + differences(read, assets):
        raise ValueError("; ".join(wrong))
    order = {p: f"{i:06d}" for i, p in enumerate(paths)}
    tag = lambda df, p: df.withColumn("dataset_id", F.lit(order[p]))
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    first = read[paths[0]]
    info, features, chunk = first.info, first.info["features"], first.info.get("chunks_size", 1000)
    stored = {n: f for n, f in features.items() if f.get("dtype") != "video"}

    # episodes are numbered through all inputs: a window over the table of episodes, not of frames
    episodes = union([tag(d.episodes.select(F.col("episode_index").alias("source_episode"), "length"), p) for p, d in read.items()])
    numbers = episodes.withColumn("episode_index", (F.row_number().over(Window.orderBy("dataset_id", "source_episode")) - 1).cast("long"))
    numbers = episode_offsets(numbers).persist()
    try:
        runtimes = _runtime_files(spark, read, order, sets) if sets else None
        with store.published(spark, output, overwrite) as stage:
            merged = merge.merge(union([tag(d.frames, p) for p, d in read.items()]))
            written = dataset.write(merged.withColumnRenamed("state", state), stage, stored, chunk, info.get("data_path", files.DATA_PATH)).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames")).first()
            _copy(union([_video_copies(d, p, order[p], numbers, stage, info) for p, d in read.items()]))
            _copy(assets[paths[0]].select("source", F.concat(F.lit(f"{stage}/assets/"), "path").alias("target")))
            if runtimes is not None:
                _copy(runtime.copies(runtimes, stage, sets.folder))
            new = F.regexp_replace("line", '"episode_index"\\s*:\\s*-?\\d+', F.concat(F.lit('"episode_index": '), F.col("episode_index").cast("string")))
            lines = union([tag(episode_lines(spark, p).withColumnRenamed("episode_index", "source_episode"), p) for p in paths]).join(numbers, ["dataset_id", "source_episode"])
            dataset.write_lines(lines.select(F.col("episode_index").alias("order"), new.alias("value")), f"{stage}/meta/episodes.jsonl")
            dataset.write_jsonl(first.tasks, f"{stage}/meta/tasks.jsonl", "task_index")
            told = [p for p in paths if store.exists(spark, stats_path(p))]
            if told:
                rows = renumbered_stats(union([tag(statistics.read(spark, stats_path(p)), p) for p in told]), numbers)
                dataset.write_lines(statistics.episode_lines(rows), stats_path(stage))
                dataset.write_lines(statistics.whole_line(rows), f"{stage}/meta/stats.json")
            videos = sum(f.get("dtype") == "video" for f in features.values())
            out = dataset.info_of(info, written["n"], written["frames"], videos, first.tasks.count(), chunk, features)
            dataset.write_json(spark, out, f"{stage}/meta/info.json")
    finally:
        numbers.unpersist()
    return out


def _copy(jobs: DataFrame) -> int:
    """Files copied by tasks when this is called; how many."""
    return store.copied(jobs).agg(F.count("state").alias("n")).first()["n"]


def _video_copies(d: dataset.Dataset, root: str, number: str, numbers: DataFrame, stage: str, info: dict) -> DataFrame:
    """source, target of a dataset's videos under their new numbers."""
    old = files.expected_videos(d.episodes, d.info).select(F.col("episode_index").alias("source_episode"), "key", F.concat(F.lit(root + "/"), "path").alias("source"))
    here = numbers.where(F.col("dataset_id") == number)
    new = files.expected_videos(here.select("episode_index", "length"), info).select("episode_index", "key", F.concat(F.lit(stage + "/"), "path").alias("target"))
    return old.join(here.select("source_episode", "episode_index"), "source_episode").join(new, ["episode_index", "key"]).select("source", "target")


def _runtime_files(spark: SparkSession, read: dict[str, dataset.Dataset], order: dict[str, str], sets: Runtime) -> DataFrame:
    """owner, set_id, path, source, sha256 of the runtime sets that episodes name; a set that isn't whole is an error."""
    out, wrong = [], []
    for p, d in read.items():
        serials = [k.removeprefix(sets.prefix) for k, f in d.info["features"].items() if k.startswith(sets.prefix) and f.get("dtype") == "video"]
        used = episode_lines(spark, p).select("episode_index", F.get_json_object("line", f"$.{sets.field}").alias("set_id"))
        used = used if serials else used.where("set_id is not null")
        found = runtime.files_of(spark, p, sets.folder, used)
        wrong += [f"{p}: runtime set {r['set_id']}, {r['sensor']}: {r['why']}" for r in runtime.faults(used, runtime.sensors(spark, p, sets.folder), found, serials).limit(10).collect()]
        out.append(found.withColumn("owner", F.lit(order[p])))
    together = reduce(DataFrame.unionByName, out)
    wrong += [f"runtime set {r['set_id']} has different contents" for r in runtime.collisions(together).limit(10).collect()]
    if wrong:
        raise ValueError("; ".join(wrong))
    return together


def report(found: Sequence) -> str:
    return json.dumps([r.asDict() for r in found], indent=2)
