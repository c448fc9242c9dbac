"""A dataset's files, each against the episode that it should hold, from footers: no page is read."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackframe.functions import encode

from . import store
from .dataset import DATA_PATH

#: Columns of numbers whose least and greatest values a footer may tell.
PLACES = ("episode_index", "frame_index", "index")
_SCHEMA = "path string, source string, bytes long, rows long, columns map<string, string>, " + ", ".join(f"{c}_{k} long" for c in PLACES for k in ("low", "high")) + ", error string"
VIDEO_PATH = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"


def kind_text(t: pa.DataType) -> str:
    """A type without whether its lists are fixed: float[7] and float[] are read alike, so they are alike here."""
    if pa.types.is_list(t) or pa.types.is_large_list(t) or pa.types.is_fixed_size_list(t):
        return kind_text(t.value_type) + "[]"
    return str(t)


def declared_kind(feature: dict) -> str:
    """The type of a feature's column."""
    rank = 0 if feature["shape"] == [1] else len(feature["shape"])
    return str(pa.from_numpy_dtype(feature["dtype"])) + "[]" * rank


def footers(spark: SparkSession, root: str) -> DataFrame:
    """path below root, source, bytes, rows, columns (name to type), least and greatest episode_index, frame_index, index.

    A map over the files of a folder, spread over tasks, that reads the end of each. What a footer does not tell is null; a file
    that is no Parquet has its error and nothing else.
    """
    import pyarrow.parquet as pq

    def told(source: str) -> tuple:
        try:
            with store.opened(source) as f:
                meta = pq.read_metadata(f)
            schema = meta.schema.to_arrow_schema()
            columns = [(f.name, kind_text(f.type)) for f in schema]
            leaves = {meta.schema.column(i).path: i for i in range(len(meta.schema))}
            ends = []
            for name in PLACES:
                known = [meta.row_group(g).column(leaves[name]).statistics for g in range(meta.num_row_groups)] if name in leaves else [None]
                whole = known and all(s is not None and s.has_min_max and isinstance(s.min, int) for s in known)
                ends += [min(s.min for s in known), max(s.max for s in known)] if whole else [None, None]
            return (meta.num_rows, columns, *ends, None)
        except (pa.ArrowInvalid, OSError) as x:
            return (None, None, *[None] * (2 * len(PLACES)), str(x)[:500])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.map_(pa.string(), pa.string()), *[pa.int64()] * (2 * len(PLACES)), pa.string()]
        names = ["rows", "columns", *[f"{c}_{k}" for c in PLACES for k in ("low", "high")], "error"]
        for b in batches:
            rows = [told(s) for s in b.column("source").to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["path", "source", "bytes", *names])

    return store._spread(store.listed(spark, root).where(F.col("path").endswith(".parquet")), "source").mapInArrow(run, _SCHEMA)


def expected_files(episodes: DataFrame, info: dict) -> DataFrame:
    """episode_index, length, path (below the dataset) of each episode's data."""
    path = encode.episode_path(info.get("data_path", DATA_PATH), F.col("episode_index"), info.get("chunks_size", 1000))
    return episodes.select("episode_index", "length", path.alias("path"))


def expected_videos(episodes: DataFrame, info: dict) -> DataFrame:
    """episode_index, key, length, path of each episode's videos."""
    keys = sorted(n for n, f in info["features"].items() if isinstance(f, dict) and f.get("dtype") == "video")
    size = info.get("chunks_size", 1000)
    paths = [F.struct(F.lit(k).alias("key"), encode.episode_path(info.get("video_path", VIDEO_PATH), F.col("episode_index"), size, video_key=k).alias("path")) for k in keys]
    if not paths:
        return episodes.select("episode_index", F.lit("").alias("key"), "length", F.lit("").alias("path")).limit(0)
    return episodes.select("episode_index", "length", F.inline(F.array(*paths))).select("episode_index", "key", "length", "path")


def misfits(expected: DataFrame, found: DataFrame, columns: Column | None = None) -> DataFrame:
    """path, episode_index, check: files (path, rows, low and high of PLACES, columns, error) that are not what is expected (episode_index, length, path).

    columns: a map of names to types that each file must have. Places that a footer does not tell are not checked.
    """
    j = expected.withColumn("wanted", F.lit(True)).join(found.withColumn("there", F.lit(True)), "path", "full")
    tells = F.col("wanted") & F.col("there") & F.col("error").isNull()
    e = F.col("episode_index")
    kinds = [
        ("missing file", F.col("there").isNull()),
        ("no episode", F.col("wanted").isNull()),
        ("unreadable", F.col("error").isNotNull()),
        ("rows", tells & (F.col("rows") != F.col("length"))),
        ("misplaced", tells & ((F.col("episode_index_low") != e) | (F.col("episode_index_high") != e))),
        ("frame_index", tells & ((F.col("frame_index_low") != 0) | (F.col("frame_index_high") != F.col("rows") - 1))),
        ("index", tells & (F.col("index_high") - F.col("index_low") != F.col("rows") - 1)),
    ]
    if columns is not None:
        other = lambda a, b: F.size(F.filter(F.map_entries(a), lambda x: ~F.coalesce(F.try_element_at(b, x["key"]) == x["value"], F.lit(False)))) > 0
        kinds.append(("columns", tells & (other(F.col("columns"), columns) | other(columns, F.col("columns")))))
    checks = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in kinds]))
    return j.select("path", "episode_index", F.explode(checks).alias("check"))


def inspect_files(spark: SparkSession, root: str, episodes: DataFrame, info: dict) -> DataFrame:
    """path, episode_index, check: what is wrong with a dataset's files, data and videos alike; none: all are in place. A file without bytes is a missing one."""
    stored = {n: declared_kind(f) for n, f in info["features"].items() if isinstance(f, dict) and f.get("dtype") != "video"}
    columns = F.from_json(F.lit(json.dumps(stored)), "map<string, string>")
    data = misfits(expected_files(episodes, info), _below(footers(spark, f"{root}/data"), "data"), columns)
    videos = expected_videos(episodes, info)
    there = _below(store.listed(spark, f"{root}/videos"), "videos").select("path", "bytes")
    j = videos.withColumn("wanted", F.lit(True)).join(there, "path", "full")
    check = F.when(F.col("bytes").isNull(), "missing video").when(F.col("wanted").isNull(), "no episode")
    return data.union(j.select("path", "episode_index", check.alias("check")).where("`check` is not null"))


def _below(files: DataFrame, folder: str) -> DataFrame:
    return files.withColumn("path", F.concat(F.lit(folder + "/"), "path"))


__all__ = ["DATA_PATH", "VIDEO_PATH", "declared_kind", "expected_files", "expected_videos", "footers", "inspect_files", "misfits"]
