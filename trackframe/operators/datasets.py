"""Whole datasets against each other: runtime sets, compatibility, layouts, sensors, outputs for each episode and arm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNTIME_ID = "^xrs_[0-9a-f]{32}$"
#: Keys of a dataset's description that may differ between datasets that are merged.
TOTALS = ("total_episodes", "total_frames", "total_videos", "total_chunks", "splits")


def compatible_info(info: Column) -> Column:
    """A map without the keys that count things."""
    return F.map_filter(info, lambda k, v: ~k.isin(*TOTALS))


def differing_sets(df: DataFrame, owner: str, member: str) -> DataFrame:
    """owner, members, missing, extra: where its set of members isn't that of the first owner by name.

    Members meet by name, one row for each owner and member, and are counted; no set is gathered, and none is sent to the driver.
    """
    pairs = df.select(F.col(owner).alias("_o"), F.col(member).alias("_m")).distinct()
    reference = pairs.where(F.col("_o") == pairs.agg(F.min("_o")).scalar()).select("_m", F.lit(True).alias("_known"))
    total = reference.agg(F.count(F.lit(1))).scalar()
    counted = pairs.join(reference, "_m", "left").groupBy("_o").agg(F.count(F.lit(1)).alias("n"), F.count("_known").alias("shared"))
    out = counted.select(F.col("_o").alias(owner), *[c.cast("int").alias(n) for n, c in (("members", F.col("n")), ("missing", total - F.col("shared")), ("extra", F.col("n") - F.col("shared")))])
    return out.where("missing > 0 or extra > 0")


def invalid_runtime_sets(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """manifest (set_id, path, sha256) against files (set_id, path, sha256): set_id, path and what is wrong with them.

    Both sides are kept, so a file without an entry and an entry without a file show; so does an id of another form.
    """
    m = manifest.select("set_id", "path", F.col("sha256").alias("wanted"))
    j = m.join(files.select("set_id", "path", F.col("sha256").alias("found")), ["set_id", "path"], "full")
    why = F.when(~F.col("set_id").rlike(RUNTIME_ID), "id").when(F.col("found").isNull(), "no file").when(F.col("wanted").isNull(), "no entry").when(F.col("wanted") != F.col("found"), "content")
    return j.select("set_id", "path", why.alias("why")).where("why is not null")


def match_sensors(sensors: DataFrame, features: DataFrame) -> DataFrame:
    """sensors (name, serial) and features (serial, key): name, serial, key, state: ok, missing, or ambiguous."""
    f = features.groupBy("serial").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").otherwise("ok")
    return sensors.join(f, "serial", "left").select("name", "serial", "key", state.alias("state"))


def for_each_arm(episodes: DataFrame, roles: Sequence[str]) -> DataFrame:
    """A row for each episode and arm, as commands for media are made; an explode, since arms are few and given."""
    return episodes.withColumn("role", F.explode(F.array(*map(F.lit, roles))))


def append_columns(frames: DataFrame, values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """frames with columns of values, joined by episode and frame; a frame without values has nulls."""
    return frames.join(values.select("episode_index", "frame_index", *columns), ["episode_index", "frame_index"], "left")


def replace_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column's value replaced, its place and type kept."""
    kind = df.schema[name].dataType
    return df.select(*[value.cast(kind).alias(name) if c == name else F.col(f"`{c}`") for c in df.columns])


def video_mismatches(expected: DataFrame, probed: DataFrame) -> DataFrame:
    """expected and probed (episode_index, key, frames, width, height): rows that differ, or that one side lacks."""
    names = ("frames", "width", "height")
    p = probed.select("episode_index", "key", *[F.col(n).alias("got_" + n) for n in names])
    j = expected.join(p, ["episode_index", "key"], "full")
    differs = [~F.col(n).eqNullSafe(F.col("got_" + n)) for n in names]
    return j.where(differs[0] | differs[1] | differs[2])


def one_left_one_right(markers: DataFrame, left: int, right: int) -> DataFrame:
    """Frames (episode_index, frame_index, marker_id, x, y, z) with exactly one of each marker: the distance between them."""
    is_left, is_right = F.col("marker_id") == left, F.col("marker_id") == right
    at = lambda c, which: F.max(F.when(which, F.col(c)))
    d = sum(((at(c, is_left) - at(c, is_right)) * (at(c, is_left) - at(c, is_right)) for c in ("y", "z")), (at("x", is_left) - at("x", is_right)) * (at("x", is_left) - at("x", is_right)))
    g = markers.groupBy("episode_index", "frame_index").agg(F.count_if(is_left).alias("l"), F.count_if(is_right).alias("r"), F.sqrt(d).alias("distance"))
    return g.where("l = 1 and r = 1").select("episode_index", "frame_index", "distance")


def inside(x: Column, y: Column, w: Column, h: Column, width: int, height: int) -> Column:
    """Whether a region of interest lies in a frame."""
    return (x >= 0) & (y >= 0) & (w > 0) & (h > 0) & (x + w <= width) & (y + h <= height)
