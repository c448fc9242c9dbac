"""Merging datasets: unions with new episode numbers, lookups that must not miss, compatibility, discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import episode_offsets


def merge(frames: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Frames of several datasets (dataset, episode_index, frame_index) as one: new episode_index, and index through all.

    Episodes are numbered in order of dataset and episode; only the table of episodes is ordered as a whole.
    """
    from pyspark.sql import Window

    episodes = frames.groupBy(dataset, "episode_index").agg(F.count(F.lit(1)).alias("length"))
    episodes = episodes.withColumn("new", (F.row_number().over(Window.orderBy(dataset, "episode_index")) - 1).cast("long"))
    offsets = episode_offsets(episodes.select(F.col(dataset), F.col("episode_index").alias("old"), F.col("new").alias("episode_index"), "length"))
    o = offsets.select(F.col(dataset).alias("_d"), F.col("old").alias("_e"), F.col("episode_index").alias("_new"), "first_index")
    out = frames.join(o, (F.col(dataset) == F.col("_d")) & (F.col("episode_index") == F.col("_e")))
    out = out.withColumn("source_episode", F.col("episode_index")).withColumn("episode_index", F.col("_new"))
    return out.withColumn("index", F.col("first_index") + F.col("frame_index")).drop("_d", "_e", "_new", "first_index")


def lookup(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """An inner join; a key of left that right lacks is an error when the rows are read."""
    joined = left.join(right.withColumn("_there", F.lit(True)), on, "left")
    there = F.coalesce(F.col("_there"), F.raise_error(F.concat(F.lit(f"no {on} "), F.col(on).cast("string"))).cast("boolean"))
    return joined.where(there).drop("_there")


def requested(episodes: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(episodes that are wanted, wanted ones that are missing), by episode_index."""
    return episodes.join(wanted, "episode_index", "left_semi"), wanted.join(episodes, "episode_index", "left_anti")


def discover(names: DataFrame, column: str, dataset: str, date: str) -> DataFrame:
    """Names dataset_date_HHMMSS in full, in order of time."""
    pattern = f"^{dataset}_{date}_([0-9]{{6}})$"
    return names.where(F.col(column).rlike(pattern)).withColumn("time", F.regexp_extract(column, pattern, 1))


def manifest(files: DataFrame, path: Column, content: Column) -> DataFrame:
    """path, sha256 of each file."""
    return files.select(path.alias("path"), F.sha2(content, 256).alias("sha256"))


def file_manifest(spark, root: str, skip_suffix: str = ".rrd") -> DataFrame:
    """The manifest of a folder, by paths below it, but for a suffix; read by Spark, so any of its stores will do."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = root.rstrip("/").split("://")[-1]
    path = F.element_at(F.split("path", f"\\Q{below}/\\E", 2), -1)
    return manifest(files.where(~F.lower("path").endswith(skip_suffix)), path, F.col("content"))
