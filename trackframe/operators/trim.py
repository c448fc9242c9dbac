"""Trimming static ends, sampling a slow prefix, and selections of frames that carry through every output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackframe.functions import geometry as g

from .windows import ordered, sustained, whole


def differs(reference: str, columns: Sequence[str], threshold: float) -> Column:
    """Whether the position is further than a threshold from the episode's first (or last) one."""
    pick = F.first if reference == "first" else F.last
    return g.norm([F.col(c) - pick(c).over(whole()) for c in columns]) > threshold


def trim_bounds(frames: DataFrame, threshold: float, columns: Sequence[str] = ("x", "y", "z"), pre: int = 0, post: int = 0, least: int = 1, run: int = 1, active_first: Column | None = None, active_last: Column | None = None) -> DataFrame:
    """episode_index, length, start_frame, end_frame, status of each episode.

    The start is `pre` frames before the first run of `run` frames that differ from the first one, the end `post` after
    the last run that differs from the last one; a stretch shorter than `least` grows, first half of what is missing in
    front. status: ok, never_leaves (no run), too_short (fewer frames than `least`); bounds are null but for ok.
    """
    a = differs("first", columns, threshold) if active_first is None else active_first
    b = differs("last", columns, threshold) if active_last is None else active_last
    f = frames.select("episode_index", "frame_index", a.alias("_a"), b.alias("_b"))
    f = f.select("episode_index", "frame_index", sustained(F.col("_a"), run)[0].alias("_a"), sustained(F.col("_b"), run)[1].alias("_b"))
    e = f.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), F.min(F.when(F.col("_a"), F.col("frame_index"))).alias("first"), F.max(F.when(F.col("_b"), F.col("frame_index"))).alias("last"))
    e = e.withColumn("s", F.greatest(F.lit(0), F.col("first") - pre)).withColumn("e", F.least(F.col("length"), F.col("last") + 1 + post))
    e = e.withColumn("missing", F.greatest(least - (F.col("e") - F.col("s")), F.lit(0)))
    e = e.withColumn("front", F.least(F.col("s"), F.floor((F.col("missing") + 1) / 2)))
    e = e.withColumn("end2", F.least(F.col("length"), F.col("e") + F.col("missing") - F.col("front"))).withColumn("start1", F.col("s") - F.col("front"))
    grown = F.greatest(F.lit(0), F.least(F.col("start1"), F.col("end2") - least))
    e = e.withColumn("start2", F.when(F.col("missing") > 0, grown).otherwise(F.col("s")))
    status = F.when(F.col("length") < least, "too_short").when(F.col("first").isNull() | F.col("last").isNull(), "never_leaves").otherwise("ok")
    e = e.withColumn("status", status)
    ok = F.col("status") == "ok"
    return e.select("episode_index", "length", F.when(ok, F.col("start2")).cast("long").alias("start_frame"), F.when(ok, F.col("end2")).cast("long").alias("end_frame"), "status")


def apply_trim(frames: DataFrame, bounds: DataFrame) -> DataFrame:
    """Frames inside the bounds of their episode, renumbered, with the frame they come from."""
    inside = frames.join(bounds.where("status = 'ok'").select("episode_index", "start_frame", "end_frame"), "episode_index")
    inside = inside.where((F.col("frame_index") >= F.col("start_frame")) & (F.col("frame_index") < F.col("end_frame")))
    return inside.withColumn("source_frame", F.col("frame_index")).withColumn("frame_index", F.col("frame_index") - F.col("start_frame")).drop("start_frame", "end_frame")


def sample_prefix(frames: DataFrame, prefix: int, spacing: float, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """episode_index, kept: frames of the first `prefix` that are `spacing` from the one kept before, then all others.

    At the boundary, kept frames that are too close to it go. An episode's own array is folded; kept is null where even
    the first frame is too close to the boundary.
    """
    p = frames.where(F.col("frame_index") <= prefix).groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("frame_index", *columns))).alias("p"))
    n = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))
    e = p.join(n, "episode_index").withColumn("b", F.least(F.lit(prefix), F.col("n") - 1).cast("int"))

    def far(i: Column, j: Column) -> Column:
        return g.norm([F.element_at("p", i + 1)[c] - F.element_at("p", j + 1)[c] for c in columns]) >= spacing

    inner = F.when(F.col("b") > 1, F.sequence(F.lit(1), F.col("b") - 1)).otherwise(F.array().cast("array<int>"))
    kept = F.aggregate(inner, F.array(F.lit(0)), lambda k, i: F.when(far(i, F.element_at(k, -1)), F.array_append(k, i)).otherwise(k))
    e = e.withColumn("k", kept)
    # popping from the end stops at the last kept frame that is far enough
    last = F.array_max(F.filter("k", lambda i: far(i, F.col("b"))))
    head = F.filter("k", lambda i: i <= last)
    rest = F.sequence(F.col("b"), (F.col("n") - 1).cast("int"))
    return e.select("episode_index", F.when(F.col("b") == 0, rest).when(last.isNotNull(), F.concat(head, rest)).alias("kept"))


def compose(kept: DataFrame, bounds: DataFrame) -> DataFrame:
    """kept (frames of the trimmed episode) and trim bounds -> episode_index, out_frame, source_frame.

    This selection is what every later output joins. Frames outside the bounds or not in rising order are an error.
    """
    k = kept.join(bounds.select("episode_index", "start_frame", "end_frame"), "episode_index")
    rising = F.array_sort(F.array_distinct("kept")) == F.col("kept")
    fits = (F.array_min("kept") >= 0) & (F.array_max("kept") < F.col("end_frame") - F.col("start_frame"))
    checked = F.when(rising & fits, F.col("kept")).otherwise(F.raise_error(F.concat(F.lit("selection of episode "), F.col("episode_index").cast("string"))).cast("array<int>"))
    return k.select("episode_index", "start_frame", F.posexplode(checked).alias("out_frame", "k")).select("episode_index", F.col("out_frame").cast("long").alias("out_frame"), (F.col("start_frame") + F.col("k")).alias("source_frame"))


def select_text(selection: DataFrame, frame: str = "source_frame") -> DataFrame:
    """The frames of each episode as a filter text: eq(n\\,a) and between(n\\,a\\,b), joined by +."""
    island = selection.withColumn("_i", F.col(frame) - F.row_number().over(ordered(order=frame)))
    runs = island.groupBy("episode_index", "_i").agg(F.min(frame).alias("a"), F.max(frame).alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.format_string("eq(n\\,%d)", "a")).otherwise(F.format_string("between(n\\,%d\\,%d)", "a", "b"))
    runs = runs.select("episode_index", F.struct("a", text.alias("t")).alias("s"))
    return runs.groupBy("episode_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["t"]), "+").alias("select_text"))


def restore_intervals(frames: DataFrame, kept: DataFrame, limit: float, columns: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """kept (episode_index, frame_index), and all frames between two kept ones whose distance exceeds the limit."""
    k = kept.join(frames, ["episode_index", "frame_index"])
    w = ordered()
    gap = g.norm([F.lead(c).over(w) - F.col(c) for c in columns])
    k = k.select("episode_index", "frame_index", F.lead("frame_index").over(w).alias("next"), gap.alias("gap"))
    between = k.where((F.col("gap") > limit) & (F.col("next") > F.col("frame_index") + 1))
    back = between.select("episode_index", F.explode(F.sequence(F.col("frame_index") + 1, F.col("next") - 1)).alias("frame_index"))
    return kept.select("episode_index", "frame_index").union(back).distinct()
