"""Statistics that merge: minimum, maximum, mean, population deviation and count, by episode and over all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS = ("min", "max", "mean", "std", "count")


def long_values(frames: DataFrame, columns: Sequence[str], by: Sequence[str] = ("episode_index",)) -> DataFrame:
    return frames.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])))


def value_stats(values: DataFrame, by: Sequence[str]) -> DataFrame:
    return values.groupBy(*by).agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("count"))


def episode_stats(frames: DataFrame, columns: Sequence[str]) -> DataFrame:
    return value_stats(long_values(frames, columns), ("episode_index", "feature"))


def array_stats(frames: DataFrame, column: str, by: Sequence[str] = ("episode_index",)) -> DataFrame:
    """By place of an array."""
    return value_stats(frames.select(*by, F.posexplode(column).alias("dim", "value")).withColumn("value", F.col("value").cast("double")), (*by, "dim"))


def tensor_stats(frames: DataFrame, column: str, rank: int, by: Sequence[str] = ("episode_index",)) -> DataFrame:
    """By place of a nested array of some rank."""
    out, dims = frames.select(*by, F.col(column).alias("value")), []
    for k in range(rank):
        out = out.select(*by, *dims, F.posexplode("value").alias(f"dim{k}", "value"))
        dims.append(f"dim{k}")
    return value_stats(out.withColumn("value", F.col("value").cast("double")), (*by, *dims))


def merge_stats(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Statistics of parts (weights: their counts) as those of the whole."""
    n = F.col("count")
    mean = F.sum(n * F.col("mean")) / F.sum(n)
    square = F.sum(n * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / F.sum(n)
    return parts.groupBy(*by).agg(F.min("min").alias("min"), F.max("max").alias("max"), mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("std"), F.sum(n).alias("count"))


def channel_range(values: DataFrame, by: Sequence[str], column: str = "value") -> DataFrame:
    return values.groupBy(*by).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def image_stats(pixels: DataFrame, by: Sequence[str], frame: str) -> DataFrame:
    """Colour statistics of pixels in 0..1; the count is of frames."""
    v = F.col("value") / 255
    return pixels.groupBy(*by).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count_distinct(frame).alias("count"))
