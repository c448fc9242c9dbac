"""Extension: events as they arrive, cut into episodes by gaps, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_episodes(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """events (user_id, ts timestamp, value), a stream or a table -> user_id, start, end, frames, mean of each session."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    s = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("frames"), F.avg("value").alias("mean"))
    return s.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "frames", "mean")
