"""Checks as tables of violations: (check, episode_index, value, limit). Evaluate them before a write; raise if any."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackframe.functions import geometry as g

from .windows import ordered, shifted


def violations(df: DataFrame, check: str, value: Column, limit: float) -> DataFrame:
    """A row for each episode whose largest value exceeds the limit, or isn't a number."""
    worst = df.groupBy("episode_index").agg(F.max(value).alias("value"))
    return worst.where((F.col("value") > limit) | F.isnan("value")).select(F.lit(check).alias("check"), "episode_index", "value", F.lit(limit).alias("limit"))


def require(*tables: DataFrame) -> None:
    """Raise if a table of violations has rows; names the first ten."""
    found = reduce(DataFrame.unionByName, tables).orderBy("check", "episode_index").limit(10).collect()
    if found:
        raise ValueError("; ".join(f"{r['check']}: episode {r['episode_index']}, {r['value']} > {r['limit']}" for r in found))


def alignment_error(frames: DataFrame, columns: Sequence[str], offset: int, prefix: str = "action_") -> DataFrame:
    """episode_index, length, error: the largest difference of an action from the state it should be."""
    f = frames.select("episode_index", F.greatest(*[F.abs(F.col(prefix + c) - shifted(c, offset)) for c in columns]).alias("e"))
    return f.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), F.max("e").alias("error"))


def rotation_quality(frames: DataFrame, r: Sequence[str], by: Sequence[str] = ("episode_index",)) -> DataFrame:
    orthogonal, det = g.rotation_error(g.entries())
    return g.with_matrix(frames.select(*by, *r), r, floor=1e-12).groupBy(*by).agg(F.max(orthogonal).alias("orthogonality"), F.max(det).alias("determinant"))


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def bad_numbering(frames: DataFrame) -> DataFrame:
    """Episodes whose frame_index isn't 0..n-1."""
    off = frames.withColumn("_i", F.row_number().over(ordered()) - 1).where(F.col("_i") != F.col("frame_index"))
    return off.groupBy("episode_index").agg(F.count(F.lit(1)).alias("bad_frames"))


def contiguity(episodes: DataFrame) -> DataFrame:
    """One row: whether episode_index runs from 0 without a gap, with totals."""
    e = F.col("episode_index")
    return episodes.agg((F.min(e) == 0).alias("from_zero"), (F.max(e) - F.min(e) + 1 == F.count_distinct(e)).alias("contiguous"), F.count(F.lit(1)).alias("episodes"), F.sum("length").alias("frames"))


def not_finite(frames: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frames.groupBy("episode_index").agg(*[F.count_if(~g.finite(F.col(c))).alias(c) for c in columns])


def over_limit(steps: DataFrame, column: str, limit: float) -> DataFrame:
    return steps.groupBy("episode_index").agg(F.count_if(F.col(column) > limit).alias("over"), F.max(column).alias("largest"), F.count(column).alias("pairs"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def conflicting(df: DataFrame, key: str, content: str) -> DataFrame:
    """Keys with more than one content."""
    return df.groupBy(key).agg(F.count_distinct(content).alias("contents")).where("contents > 1")


def offending(df: DataFrame, bad: Column, order: str, n: int = 10) -> DataFrame:
    """The first n rows that fail, for an error's text."""
    return df.where(bad).orderBy(order).limit(n)


def nearest_by(df: DataFrame, by: str, cost: str) -> DataFrame:
    """The row of least cost for each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(cost))).where("_r = 1").drop("_r")
