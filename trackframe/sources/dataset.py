"""Datasets on disk: meta/*.json(l), a Parquet file for each episode under data/, videos beside them.

Reading goes through Spark, so any of its stores will do; the export writes an episode a file with fixed-size lists and
the feature catalogue in the schema's metadata, which Spark's own writer drops.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store

EPISODES = "episode_index long, tasks array<string>, length long"
TASKS = "task_index long, task string"
VERSION = "v2.1"
DATA_PATH = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet"


@dataclass
class Dataset:
    info: dict
    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    root: str = ""


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines: file, line) of files with a JSON object a line; blank lines are none. A line that is no such object is
    bad, and so is one with a value of another type; fields that the schema lacks are left out. Tasks read the files by splits.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where("trim(line) <> ''")
    kind = T.StructType.fromDDL(schema).add("_bad", "string")
    parsed = text.withColumn("row", F.from_json("line", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.where("row._bad is null").select("row.*").drop("_bad"), parsed.where("row._bad is not null").select("file", "line")


def described(spark: SparkSession, root: str) -> tuple[dict, DataFrame]:
    """A dataset's description and its episodes; no frame is looked at."""
    info = read_json(spark, f"{root}/meta/info.json")
    if info.get("codebase_version") != VERSION:
        raise ValueError(f"{root}: codebase_version {info.get('codebase_version')!r}, not {VERSION}")
    return info, json_lines(spark, f"{root}/meta/episodes.jsonl", EPISODES)[0]


def read(spark: SparkSession, root: str, state: str = "observation.state") -> Dataset:
    """A dataset of one version; the state as doubles of its declared width, whether its lists are fixed or not."""
    info, episodes = described(spark, root)
    width = info["features"][state]["shape"][0]
    frames = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data")
    v = F.col(f"`{state}`").cast("array<double>")
    right = F.when(F.size(v) == width, v).otherwise(F.raise_error(F.lit(f"{state}: a row isn't {width} wide")).cast("array<double>"))
    frames = frames.select(*[right.alias("state") if c == state else F.col(f"`{c}`") for c in frames.columns])
    tasks = json_lines(spark, f"{root}/meta/tasks.jsonl", TASKS)[0]
    return Dataset(info, frames, episodes, tasks, root)


def slot_index(names: list[str], prefix: str, component: str) -> int:
    """The place of the one slot prefix_*.component."""
    found = [i for i, n in enumerate(names) if n.startswith(prefix + "_") and n.endswith("." + component)]
    if len(found) != 1:
        raise ValueError(f"{prefix}.{component}: {len(found)} slots")
    return found[0]


def inspect(dataset: Dataset) -> DataFrame:
    """Violations of what a dataset must hold: numbering, lengths, and totals (without an episode)."""
    counted = dataset.frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("rows"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"), F.count_distinct("frame_index").alias("distinct"))
    j = dataset.episodes.select("episode_index", "length").join(counted, "episode_index", "full")
    kinds = [
        ("length", ~F.col("rows").eqNullSafe(F.col("length"))),
        ("frame_index", (F.col("lo") != 0) | (F.col("hi") != F.col("rows") - 1) | (F.col("distinct") != F.col("rows"))),
        ("episode_index", (F.col("episode_index") < 0) | (F.col("episode_index") >= dataset.info["total_episodes"])),
    ]
    rows = j.select("episode_index", F.explode(F.array(*[F.when(bad, F.lit(name)) for name, bad in kinds])).alias("check")).where("`check` is not null")
    info, videos = dataset.info, sum(f.get("dtype") == "video" for f in dataset.info.get("features", {}).values())
    n, frames = F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))
    totals = [
        ("total_episodes", n != info["total_episodes"]), ("total_frames", frames != info.get("total_frames", -1)),
        ("total_videos", n * videos != info.get("total_videos", 0)), ("total_chunks", F.ceil(n / info.get("chunks_size", 1000)) != info.get("total_chunks", -1)),
    ]
    whole = dataset.episodes.agg(F.array(*[F.when(bad, F.lit(name)) for name, bad in totals]).alias("bad"))
    return rows.union(whole.select(F.lit(None).cast("long").alias("episode_index"), F.explode("bad").alias("check")).where("`check` is not null"))


def write(frames: DataFrame, root: str, features: dict, chunk_size: int = 1000, template: str = DATA_PATH) -> DataFrame:
    """An episode a file under root, which all executors must share; episode_index, length, path of those written.

    frames: episode_index, frame_index, and the columns of `features` ({name: {dtype, shape}}), lists as arrays. A file
    appears under its name only when it is whole, so a task that runs again does no harm.
    """
    def kind(f: dict) -> pa.DataType:
        t = pa.from_numpy_dtype(f["dtype"])
        for n in reversed(f["shape"] if f["shape"] != [1] else []):
            t = pa.list_(t, n)
        return t

    meta = {b"huggingface": json.dumps({"info": {"features": features}}).encode()}
    schema = pa.schema([(n, kind(f)) for n, f in features.items()], metadata=meta)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        import pyarrow.parquet as pq

        part = part.sort_values("frame_index")
        e = int(part["episode_index"].iloc[0])
        path = f"{root}/{template.format(episode_chunk=e // chunk_size, episode_index=e)}"
        cols = [pa.array(part[f"c{i}"].tolist(), f.type) for i, f in enumerate(schema)]
        with store.whole_file(path) as out:
            pq.write_table(pa.Table.from_arrays(cols, schema=schema), out, compression="zstd")
        return pd.DataFrame({"episode_index": [e], "length": [len(part)], "path": [path]})

    # names with dots go through the grouped map as numbers
    plain = frames.select("episode_index", "frame_index", *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(schema.names)])
    return plain.groupBy("episode_index").applyInPandas(run, "episode_index long, length long, path string")


def write_lines(lines: DataFrame, path: str) -> None:
    """lines (order, value) as one text file: parts are written in order by tasks, and then joined byte by byte."""
    spark, parts = lines.sparkSession, f"{path}.parts-{uuid.uuid4().hex}"
    lines.repartitionByRange("order").sortWithinPartitions("order").select("value").write.text(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, whole = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    own = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(own, True)
    for name in sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")):
        part = fs.open(jvm.org.apache.hadoop.fs.Path(f"{parts}/{name}"))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
        part.close()
    out.close()
    fs.delete(whole, False)
    if not fs.rename(own, whole):
        raise OSError(f"{path} could not be written")
    fs.delete(folder, True)


def write_jsonl(df: DataFrame, path: str, *order: str) -> None:
    """df as one file with a JSON object a line, in the order of some columns."""
    write_lines(df.select(F.struct(*order).alias("order"), F.to_json(F.struct("*")).alias("value")), path)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    write_lines(spark.createDataFrame([(0, json.dumps(value, indent=2, ensure_ascii=False))], "order int, value string"), path)


def info_of(old: dict, episodes: int, frames: int, video_keys: int, tasks: int, chunk_size: int, features: dict) -> dict:
    """The totals of a finished dataset."""
    return old | {
        "codebase_version": VERSION, "total_episodes": episodes, "total_frames": frames, "total_tasks": tasks, "total_videos": episodes * video_keys,
        "total_chunks": -(-episodes // chunk_size), "chunks_size": chunk_size, "splits": {"train": f"0:{episodes}"}, "features": features,
    }


__all__ = ["DATA_PATH", "Dataset", "described", "info_of", "inspect", "json_lines", "read", "read_json", "slot_index", "write", "write_json", "write_jsonl", "write_lines"]
