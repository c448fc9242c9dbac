"""Statistics in the dataset format: for each episode a map of features, each with min, max, mean, std and count.

A feature's numbers are nested lists of any rank (a slot's [v], an image's [[[v]]]). As rows they are flat: one for each
episode, feature and place, where a place is the path through the lists ("0", "2,0,0"). Rows of several stages unite, merge
over episodes by counts, and are nested again as text; no document passes through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackframe.operators import stats

NUMBERS = ("min", "max", "mean", "std")
ROWS = "episode_index long, feature string, place array<int>, min double, max double, mean double, std double, count long"


def flat(value, at: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], float]]:
    """(place, number) of nested lists."""
    if isinstance(value, list):
        for i, v in enumerate(value):
            yield from flat(v, (*at, i))
    else:
        yield at, float(value)


def nested(places: list[tuple[int, ...]], values: list) -> list:
    """The nested lists that hold each value at its place."""
    out: list = []
    for place, v in sorted(zip(places, values, strict=True), key=lambda x: x[0]):
        here = out
        for i in place[:-1]:
            while len(here) <= i:
                here.append([])
            here = here[i]
        here.append(v)
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """Flat rows of a file with a line for each episode; a line that isn't such is an error when rows are read."""
    lines = spark.read.text(path).where("trim(value) <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for line in b.column("value").to_pylist():
                d = json.loads(line)
                for feature, s in d["stats"].items():
                    numbers = {k: dict(flat(s[k])) for k in NUMBERS}
                    if any(numbers[k].keys() != numbers["min"].keys() for k in NUMBERS):
                        raise ValueError(f"episode {d['episode_index']}, {feature}: min, max, mean and std differ in shape")
                    rows += [(d["episode_index"], feature, list(at), *[numbers[k][at] for k in NUMBERS], int(s["count"][0])) for at in numbers["min"]]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), *[pa.float64()] * 4, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["episode_index", "feature", "place", *NUMBERS, "count"])

    return lines.mapInArrow(run, ROWS)


def unite(*parts: DataFrame) -> DataFrame:
    """Flat rows of several stages as one: where two have a feature of an episode, the later stage's counts, whole."""
    rows = parts[0].withColumn("_stage", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        rows = rows.unionByName(p.withColumn("_stage", F.lit(i)))
    last = F.max("_stage").over(Window.partitionBy("episode_index", "feature"))
    return rows.withColumn("_last", last).where("_stage = _last").drop("_stage", "_last")


def of_columns(frames: DataFrame, columns: list[str]) -> DataFrame:
    """Flat rows of a frame's columns, numbers and arrays of numbers (one place each), in one pass; null and NaN count for none."""
    numbers = []
    for c in columns:
        v = F.col(f"`{c}`")
        array = frames.select(v).schema[0].dataType.simpleString().startswith("array")
        name = F.lit(c)
        numbers.append(F.transform(v if array else F.array(v), lambda x, i: F.struct(name.alias("feature"), i.alias("p"), x.cast("double").alias("value"))))  # noqa: B023
    rows = frames.select("episode_index", F.inline(F.flatten(F.array(*numbers)))).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    rows = stats.value_stats(rows, ("episode_index", "feature", "p"))
    return rows.select("episode_index", "feature", F.array("p").alias("place"), *NUMBERS, "count")


def whole(rows: DataFrame) -> DataFrame:
    """feature, place and numbers over all episodes."""
    return stats.merge_stats(rows, ["feature", "place"])


def _feature_text(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """by, feature, text: a feature's object, its lists nested again. A group holds the places of one feature."""
    held = rows.groupBy(*by, "feature").agg(F.collect_list(F.struct("place", *NUMBERS)).alias("at"), F.max("count").alias("count"))

    @F.arrow_udf("string")
    def text(at: pa.Array, count: pa.Array) -> pa.Array:
        out = []
        for places, n in zip(at.to_pylist(), count.to_pylist(), strict=True):
            where = [tuple(x["place"]) for x in places]
            out.append(json.dumps({k: nested(where, [x[k] for x in places]) for k in NUMBERS} | {"count": [n]}))
        return pa.array(out, pa.string())

    return held.select(*by, "feature", text("at", "count").alias("text"))


def _object(pairs: F.Column) -> F.Column:
    """A JSON object of (feature, text), sorted by name."""
    one = F.transform(F.array_sort(pairs), lambda x: F.concat(F.regexp_replace(F.to_json(F.struct(x["feature"].alias("k"))), '^\\{"k":|\\}$', ""), F.lit(": "), x["text"]))
    return F.concat(F.lit("{"), F.array_join(one, ", "), F.lit("}"))


def episode_lines(rows: DataFrame) -> DataFrame:
    """order, value: a line of text for each episode, for `dataset.write_lines`."""
    f = _feature_text(rows, ("episode_index",)).groupBy("episode_index").agg(F.collect_list(F.struct("feature", "text")).alias("of"))
    line = F.concat(F.lit('{"episode_index": '), F.col("episode_index").cast("string"), F.lit(', "stats": '), _object(F.col("of")), F.lit("}"))
    return f.select(F.col("episode_index").alias("order"), line.alias("value"))


def whole_line(rows: DataFrame) -> DataFrame:
    """order, value: one object of all features, over all episodes."""
    f = _feature_text(whole(rows), ()).agg(F.collect_list(F.struct("feature", "text")).alias("of"))
    return f.select(F.lit(0).alias("order"), _object(F.col("of")).alias("value"))


__all__ = ["ROWS", "episode_lines", "flat", "nested", "of_columns", "read", "unite", "whole", "whole_line"]
