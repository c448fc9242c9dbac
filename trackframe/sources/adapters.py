"""Plain tables as frames of episodes: episode_index, frame_index, and slots in double precision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSE = ("x", "y", "z", "qx", "qy", "qz", "qw", "width")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """frame_index from an order; the partition key has its final name already, so later windows reuse the exchange."""
    return df.withColumn("frame_index", (F.row_number().over(Window.partitionBy("episode_index").orderBy(*order)) - 1).cast("long"))


def embedding_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arms of a pose and a width each; an episode is a label."""
    slots = [F.element_at("embedding", 8 * arm + i + 1).cast("double").alias(f"{role}_{c}") for arm, role in enumerate(("right", "left")) for i, c in enumerate(POSE)]
    df = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("episode_index"), "vec_id", *slots)
    return _numbered(df, "vec_id").drop("vec_id")


def by_role(frames: DataFrame) -> DataFrame:
    """One row for each arm: role and the pose's slots."""
    arms = [F.struct(F.lit(r).alias("role"), *[F.col(f"{r}_{c}").alias(c) for c in POSE]) for r in ("right", "left")]
    return frames.select("episode_index", "frame_index", F.inline(F.array(*arms)))


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, y, z of a user's events, in time; missing: the event was an error."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    df = e.select(F.col("user_id").alias("episode_index"), "ts", "event_id", F.col("value").alias("x"), k.alias("y"), F.lit(0.0).alias("z"), (F.col("event_type") == "error").alias("missing"))
    return _numbered(df, "ts", "event_id").drop("ts", "event_id")


def line_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, y, z of a supplier's lines."""
    li = table(spark, sf_dir, "lineitem")
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    df = li.select(F.col("l_suppkey").alias("episode_index"), *order, F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"))
    return _numbered(df, *order).select("episode_index", "frame_index", "x", "y", "z")
