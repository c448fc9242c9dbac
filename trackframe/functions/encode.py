"""Codes of depth and force values, colours, sample places, paths and filter texts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def depth_code(depth: Column, low: float, high: float) -> Column:
    """0 to 255, rounding half to even; values outside are clipped (count them with outside()), null and NaN have no code."""
    code = F.rint((F.greatest(F.least(depth, F.lit(high)), F.lit(low)) - low) / (high - low) * 255)
    return F.when(depth.isNotNull() & ~F.isnan(depth), code).cast("int")


def outside(depth: Column, low: float, high: float) -> tuple[Column, Column]:
    """Aggregates: values below, values above."""
    return F.count_if(depth < low), F.count_if(depth > high)


def strict_depth_code(depth: Column, low: float, high: float) -> Column:
    """depth_code, but a value outside, null or NaN is an error."""
    bad = depth.isNull() | F.isnan(depth) | (depth < low) | (depth > high)
    return F.when(bad, F.raise_error(F.format_string("depth %s is not in the range", F.coalesce(depth.cast("string"), F.lit("null")))).cast("int")).otherwise(depth_code(depth, low, high))


def force_code(value: Column, low: Column, high: Column) -> Column:
    """0 to 255 between a channel's extremes; a channel without span is 0; null and NaN have no code."""
    code = F.when(high > low, F.rint((value - low) / (high - low) * 255)).otherwise(0.0)
    return F.when(value.isNotNull() & ~F.isnan(value), code).cast("int")


def quantisation(low: Column, high: Column) -> tuple[Column, Column]:
    """(step, largest error) of 8-bit codes."""
    return (high - low) / 255, (high - low) / 510


def pad_last(rows: Column, to: int) -> Column:
    """An array of rows with its last one repeated up to a length."""
    return F.concat(rows, F.array_repeat(F.element_at(rows, -1), F.greatest(F.lit(to) - F.size(rows), F.lit(0))))


def episode_colour(episode: Column) -> list[Column]:
    """Red, green, blue of an episode: hues step by the golden ratio; saturation 0.72, full value."""
    h = F.pmod(episode * 0.618033988749895, F.lit(1.0)) * 6
    k, f = F.floor(h), h - F.floor(h)
    p, q, t = F.lit(1 - 0.72), 1 - 0.72 * f, 1 - 0.72 * (1 - f)
    one = F.lit(1.0)
    table = [[one, q, p, p, t, one], [t, one, one, q, p, p], [p, p, t, one, one, q]]
    return [F.rint(F.element_at(F.array(*row), (k % 6 + 1).cast("int")) * 255).cast("int") for row in table]


def sample_places(n: Column, wanted: int) -> Column:
    """Array of at most `wanted` evenly spaced places in 0..n-1, both ends among them."""
    k = F.least(F.greatest(F.lit(wanted), F.lit(1)), n)
    step = (n - 1).cast("double") / F.when(k > 1, k - 1)
    return F.transform(F.sequence(F.lit(0).cast("long"), (k - 1).cast("long")), lambda i: F.when(k == 1, F.lit(0).cast("long")).when(i == k - 1, (n - 1).cast("long")).otherwise(F.floor(i * step)))


def episode_path(template: str, episode: Column, chunk_size: int, **more: str) -> Column:
    """A path from a template with {episode_chunk:03d} and {episode_index:06d}."""
    text = template
    for k, v in more.items():
        text = text.replace("{" + k + "}", v)
    text = text.replace("{episode_chunk:03d}", "%1$03d").replace("{episode_index:06d}", "%2$06d")
    return F.format_string(text, F.floor(episode / chunk_size).cast("long"), episode.cast("long"))


def crop_origin(native: tuple[int, int], width: Column, height: Column, cx: Column, cy: Column, crop: tuple[int, int]) -> list[Column]:
    """Where a camera's frame begins in its sensor: (0, 0) for the native size, about the centre for a crop, else null."""
    whole = (width == native[0]) & (height == native[1])
    cut = (width == crop[0]) & (height == crop[1])
    return [F.when(whole, 0).when(cut, (F.rint(c) - size // 2).cast("int")) for c, size in ((cx, crop[0]), (cy, crop[1]))]


def crop_mode(mode: Column, width: Column, height: Column) -> Column:
    """auto: stretch what is square already, else cut the centre square."""
    return F.when(mode != "auto", mode).when(width == height, F.lit("stretch")).otherwise(F.lit("center_square"))


def video_filter(select: Column, fps: int, mode: Column, width: int, height: int) -> Column:
    """The text of a filter graph: chosen frames at an even rate, cut, scaled."""
    chosen = F.when(select.isNotNull(), F.concat(F.lit("select='"), select, F.lit(f"',setpts=N/{fps}/TB,"))).otherwise(F.lit(""))
    cut = F.when(mode == "center_square", F.lit("crop='min(iw,ih)':'min(iw,ih)',")).otherwise(F.lit(""))
    return F.concat(chosen, cut, F.lit(f"scale={width}:{height},setsar=1"))
