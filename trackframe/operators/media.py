"""Video and sensor back-ends behind small protocols: decoders, solvers and encoders are the caller's.

A recording's frames arrive in order in one task; a solver sees all of them and the caller gets the selected ones. Tasks
stream: a recording is never held whole (but by `solve_selected`, for short recordings of one number a frame).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trackframe.functions import encode
from trackframe.sources import store

from .stats import channel_range


class FrameDecoder(Protocol):
    def frames(self, path: str) -> Iterator[np.ndarray]: ...


class FrameSolver(Protocol):
    def solve(self, frame: np.ndarray) -> float: ...

    def release(self) -> None: ...


class FrameEncoder(Protocol):
    def encode(self, source: str, target: str, filters: str) -> None: ...


def solve_selected(frames: DataFrame, value: str, make_solver: Callable[[], FrameSolver]) -> DataFrame:
    """frames (episode_index, frame_index, value, selected) -> episode_index, frame_index, solved, for the selected ones."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("frame_index")
        solver = make_solver()
        try:
            solved = [solver.solve(v) for v in part[value].to_numpy()]
        finally:
            solver.release()
        return part[["episode_index", "frame_index"]].assign(solved=np.array(solved, float))[part["selected"].to_numpy(bool)]

    return frames.groupBy("episode_index").applyInPandas(run, "episode_index long, frame_index long, solved double")


def measure_videos(videos: DataFrame, make_decoder: Callable[[], FrameDecoder], measure: Callable[[np.ndarray], float | None]) -> DataFrame:
    """videos (episode_index, path, length) -> episode_index, frame_index, value (null: nothing found).

    A video with another number of frames than `length` is an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = make_decoder()
        for b in batches:
            for v in b.itertuples():
                got = [measure(f) for f in decoder.frames(v.path)]
                if len(got) != v.length:
                    raise ValueError(f"{v.path}: {len(got)} frames, expected {v.length}")
                yield pd.DataFrame({"episode_index": v.episode_index, "frame_index": range(len(got)), "value": pd.array(got, "Float64")})

    return videos.select("episode_index", "path", "length").mapInPandas(run, "episode_index long, frame_index long, value double")


def transcode(jobs: DataFrame, make_encoder: Callable[[], FrameEncoder]) -> DataFrame:
    """jobs (source, target, filters) -> target, error; one row a job, spread over tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = make_encoder()
        for b in batches:
            errors = []
            for j in b.itertuples():
                try:
                    encoder.encode(j.source, j.target, j.filters)
                    errors.append(None)
                except Exception as x:  # a job's failure is a row; the caller decides
                    errors.append(str(x)[-4000:])
            yield pd.DataFrame({"target": b["target"], "error": errors})

    return jobs.select("source", "target", "filters").repartition("target").mapInPandas(run, "target string, error string")


class OrderedSolver(Protocol):
    """A solver with state: it sees a recording's frames one by one, in order, and gives named arrays for each."""

    def solve(self, frame) -> dict[str, np.ndarray]: ...

    def release(self) -> None: ...


def in_order(frames: DataFrame, by: Sequence[str], order: str = "frame_index") -> DataFrame:
    """Recordings whole in a partition and in order, one after the other: what a map over batches can stream through."""
    return frames.repartition(*by).sortWithinPartitions(*by, order)


def _recordings(batches: Iterator[pa.RecordBatch], by: Sequence[str], order: str = "frame_index") -> Iterator[tuple[tuple, int, dict]]:
    """(key, frame, row) of rows in order; a recording whose frames are not 0, 1, 2, ... is an error."""
    key, frame = None, 0
    for b in batches:
        for row in b.to_pylist():
            here = tuple(row[c] for c in by)
            key, frame = (here, 0) if here != key else (key, frame + 1)
            if row[order] != frame:
                raise ValueError(f"recording {', '.join(map(str, here))}: frame {row[order]} where {frame} is expected")
            yield here, frame, row


def solve_ordered(
    frames: DataFrame, value: str, make_solver: Callable[[], OrderedSolver], outputs: dict[str, tuple[int, ...]], by: Sequence[str] = ("episode_index",), rows: int = 256,
) -> DataFrame:
    """frames (by, frame_index, value, selected) -> by, frame_index, and each output as a flat array, for the selected frames.

    A recording streams through a solver of its own in one task, since each frame's result may hang on all before it; the
    task holds one Arrow batch of frames (of the session's rows and bytes) and `rows` results, however long the recording
    is. The result is lazy: who reads it twice solves twice, so it is to be written once (`two_passes`). An output that is
    missing, of another shape, or not finite is an error that names the frame, for frames that are not selected, too. The
    solver is released when its recording ends, and when it fails.
    """
    kept = [*by, "frame_index"]
    schema = T.StructType([frames.schema[c] for c in kept] + [T.StructField(n, T.ArrayType(T.DoubleType())) for n in outputs])

    def checked(got: dict[str, np.ndarray], where: str) -> list[np.ndarray]:
        out = []
        for name, shape in outputs.items():
            if name not in got:
                raise ValueError(f"{where}: no output {name}")
            a = np.asarray(got[name], np.float64)
            if a.shape != shape:
                raise ValueError(f"{where}: {name} has the shape {a.shape}, not {shape}")
            if not np.isfinite(a).all():
                raise ValueError(f"{where}: {name} is not finite")
            out.append(a.ravel())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, key, held = None, None, []

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        types = to_arrow_schema(schema).types
        try:
            for here, frame, row in _recordings(batches, by):
                if here != key:
                    if solver is not None:
                        solver, old = None, solver
                        old.release()
                    solver, key = make_solver(), here
                got = checked(solver.solve(row[value]), f"recording {', '.join(map(str, here))}, frame {frame}")
                if row["selected"]:
                    held.append((*here, frame, *got))
                    if len(held) >= rows:
                        yield flushed()
            if held:
                yield flushed()
        finally:
            if solver is not None:
                solver.release()

    return in_order(frames.select(*kept, value, "selected"), by).mapInArrow(run, schema)


def channel_ranges(solved: DataFrame, output: str, channels: int, by: Sequence[str] = ()) -> DataFrame:
    """by, channel, low, high: of an output whose last axis has so many channels, over all frames. Two numbers a channel and task meet."""
    values = solved.select(*by, F.posexplode(output).alias("p", "value"))
    return channel_range(values.select(*by, F.pmod("p", F.lit(channels)).cast("int").alias("channel"), "value"), (*by, "channel"))


def encoded(solved: DataFrame, output: str, channels: int, ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """solved with `codes`: the output in whole numbers from 0 to 255 between its channels' bounds (a channel of one value: 0)."""
    flat = ranges.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("channel", "low", "high"))).alias("_ranges"))
    j = solved.join(flat, list(by)) if by else solved.withColumn("_ranges", flat.select("_ranges").scalar())  # a row for each sensor, or one
    at = lambda i: F.element_at("_ranges", F.pmod(i, F.lit(channels)) + 1)
    code = F.transform(output, lambda v, i: encode.force_code(v, at(i)["low"], at(i)["high"]))
    return j.withColumn("codes", code).drop("_ranges")


@contextmanager
def two_passes(
    frames: DataFrame, value: str, make_solver: Callable[[], OrderedSolver], output: str, shape: tuple[int, ...], folder: str, by: Sequence[str] = ("episode_index",), sensor: Sequence[str] = (),
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(ranges by channel, frames with codes), to be written inside the block.

    The first pass solves each frame once and writes what it gave under `folder`; the bounds of all of it come from
    there, and so do the codes, which need the bounds. The folder goes when the block ends, however it ends.
    """
    spark, spill = frames.sparkSession, f"{folder}/solved-{uuid.uuid4().hex}"
    try:
        solve_ordered(frames, value, make_solver, {output: shape}, by).write.parquet(spill)
        solved = spark.read.parquet(spill)
        ranges = channel_ranges(solved, output, shape[-1], sensor)
        yield ranges, encoded(solved, output, shape[-1], ranges, sensor)
    finally:
        store.delete(spark, spill)


def write_frames(frames: DataFrame, value: str, path: Column, by: Sequence[str] = ("episode_index",)) -> DataFrame:
    """Frames' bytes in order as one raw file for each recording: by, path, frames, bytes, when the rows are read.

    frames: by, frame_index, value (binary, all of one size in a recording). A file has its name when its recording ends
    well; a frame of another size, a gap, a failure or the task's end before that leaves no file, and an attempt that
    runs again writes beside the other. What a codec makes of raw frames is a back-end's work.
    """
    schema = T.StructType([frames.schema[c] for c in by] + [T.StructField("path", T.StringType()), T.StructField("frames", T.LongType()), T.StructField("bytes", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(schema).types
        rows = _recordings(batches, by)
        now = next(rows, None)
        while now is not None:
            key, target, size, n = now[0], now[2]["_path"], len(now[2][value]), 0
            with store.whole_file(target) as out:
                while now is not None and now[0] == key:
                    frame = now[2][value]
                    if len(frame) != size:
                        raise ValueError(f"{target}: frame {now[1]} has {len(frame)} bytes, not {size}")
                    out.write(frame)
                    n += 1
                    now = next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, target, n, n * size), types, strict=True)], names=schema.names)

    return in_order(frames.select(*by, "frame_index", value, path.alias("_path")), by).mapInArrow(run, schema)
