"""Sequence operators over the frames of an episode, ordered by frame_index.

All windows share one partition key, so a chain of them needs one exchange; extra keys (a role) come after it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trackframe.functions import geometry as g


def keys(by: Sequence[str] = ("episode_index",)) -> WindowSpec:
    return Window.partitionBy(*by)


def ordered(by: Sequence[str] = ("episode_index",), order: str = "frame_index") -> WindowSpec:
    return keys(by).orderBy(order)


def whole(by: Sequence[str] = ("episode_index",), order: str = "frame_index") -> WindowSpec:
    return ordered(by, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def shifted(c: str, offset: int, by: Sequence[str] = ("episode_index",)) -> Column:
    """The value `offset` frames later; at the end, the last one's."""
    if offset < 0:
        raise ValueError("the offset must not be negative")
    return F.coalesce(F.lead(c, offset).over(ordered(by)), F.last(c).over(whole(by)))


def action_shift(frames: DataFrame, columns: Sequence[str], offset: int = 1, prefix: str = "action_", by: Sequence[str] = ("episode_index",)) -> DataFrame:
    return frames.select("*", *[shifted(c, offset, by).alias(prefix + c) for c in columns])


def short_episodes(frames: DataFrame, offset: int) -> DataFrame:
    """Episodes that an action offset doesn't fit: they have no row further than the offset."""
    return frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length")).where(F.col("length") <= offset)


def position_step(by: Sequence[str] = ("episode_index",), columns: Sequence[str] = ("x", "y", "z")) -> Column:
    """Distance from the frame before; null for the first."""
    return g.norm([F.col(c) - F.lag(c).over(ordered(by)) for c in columns])


def rotation_step(by: Sequence[str], q: Sequence[str] = ("qx", "qy", "qz", "qw")) -> Column:
    """Angle from the frame before, of unit quaternions; null for the first."""
    return g.quaternion_angle([F.col(c) for c in q], [F.lag(c).over(ordered(by)) for c in q])


def unit_quaternions(arms: DataFrame, by: Sequence[str], q: Sequence[str] = ("qx", "qy", "qz", "qw")) -> DataFrame:
    """by, and the unit quaternion ux, uy, uz, uw of the stored six-number rotation.

    Each step is a projection of its own, so that no expression repeats the ones below it.
    """
    six = g.rot6d(g.quaternion_matrix([F.col(c) for c in q]))
    out = arms.select(*by, *[c.alias(f"_r{i}") for i, c in enumerate(six)])
    out = g.with_matrix(out, [f"_r{i}" for i in range(6)])
    unit = g.matrix_quaternion(g.entries())
    return out.select(*by, *[c.alias(n) for c, n in zip(unit, ("ux", "uy", "uz", "uw"), strict=True)])


def step_metrics(arms: DataFrame) -> DataFrame:
    """episode_index, frame_index, position_step, rotation_step: the larger of the arms, from the second frame on."""
    by = ("episode_index", "role")
    units = unit_quaternions(arms, by=("episode_index", "role", "frame_index", "x", "y", "z"))
    steps = units.select("episode_index", "frame_index", position_step(by).alias("p"), rotation_step(by, ("ux", "uy", "uz", "uw")).alias("r"))
    return steps.where("p is not null").groupBy("episode_index", "frame_index").agg(F.max("p").alias("position_step"), F.max("r").alias("rotation_step"))


#: Bins of a pass over the values, and values of a bin that the driver takes to rank them.
BINS, FEW = 4096, 10_000


def values_at(values: DataFrame, column: str, k: int, low: float, high: float) -> tuple[float, float | None]:
    """The values of ranks k and k + 1 (from 0; None: there is none), exactly, of a column of finite numbers between bounds.

    Each pass counts the values of the bracket by bins and narrows it to one bin, so that neither a task nor the driver
    holds more than BINS rows, or FEW values at the end.
    """
    before, after = 0, None
    while low < high:
        inside = values.where((F.col(column) >= low) & (F.col(column) <= high))
        # by halves, since the bracket's width may be no finite number; the least value is in the first bin and the greatest in the last
        number = F.least(F.floor((F.col(column) / 2 - low / 2) / (high / 2 - low / 2) * BINS), F.lit(BINS - 1))
        bins = inside.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        found = sorted(bins.collect(), key=lambda r: r["bin"])
        i = 0
        while before + found[i]["n"] <= k:
            before, i = before + found[i]["n"], i + 1
        after = found[i + 1]["low"] if i + 1 < len(found) else after
        low, high, n = found[i]["low"], found[i]["high"], found[i]["n"]
        if n <= FEW:
            last = sorted(r[0] for r in values.where((F.col(column) >= low) & (F.col(column) <= high)).select(column).collect())
            return last[k - before], last[k - before + 1] if k - before + 1 < n else after
    n = values.where(F.col(column) == low).count()
    return low, low if k - before + 1 < n else after


def step_reference(steps: DataFrame, columns: Sequence[str], percentile: float) -> DataFrame:
    """Exact percentile of finite steps, pooled over all episodes: one row. A global barrier of a few passes over the steps."""
    held = steps.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    known = [F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in columns]  # an infinite step has no bin
    aggs = [f(c).alias(f"{n}_{name}") for n, c in zip(columns, known, strict=True) for f, name in ((F.min, "least"), (F.max, "max"), (F.count, "n"))]
    found = held.agg(*aggs, F.count(F.lit(1)).alias("adjacent_pairs")).first()
    row: dict[str, float | int | None] = {}
    for c in columns:
        n, limit = found[f"{c}_n"], None
        if n:
            place = percentile / 100 * (n - 1)
            k = min(math.floor(place), n - 1)
            low, high = values_at(held.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), c, k, found[f"{c}_least"], found[f"{c}_max"])
            limit = low if place == k or high is None else (k + 1 - place) * low + (place - k) * high
        row |= {f"{c}_limit": limit}
    row |= {f"{c}_max": found[f"{c}_max"] for c in columns} | {"adjacent_pairs": found["adjacent_pairs"]}
    held.unpersist()
    schema = ", ".join(f"{k} {'long' if k == 'adjacent_pairs' else 'double'}" for k in row)
    return steps.sparkSession.createDataFrame([tuple(row.values())], schema)


def smooth_positions(frames: DataFrame, columns: Sequence[str] = ("x", "y", "z"), window: int = 5, passes: int = 1, preserve: int = 2) -> DataFrame:
    """Binomial weights, ends repeated; episodes shorter than the window and the first and last `preserve` frames stay."""
    if window < 3 or window % 2 == 0:
        raise ValueError("the window must be odd and 3 at least")
    w, half, every = ordered(), window // 2, whole()
    out = frames.withColumn("_n", F.count(F.lit(1)).over(every)).withColumn("_i", F.row_number().over(w) - 1)
    for _ in range(passes):
        def neighbour(c: str, k: int) -> Column:
            if not k:
                return F.col(c)
            return F.coalesce(F.lag(c, -k).over(w), F.first(c).over(every)) if k < 0 else F.coalesce(F.lead(c, k).over(w), F.last(c).over(every))

        new = {c: sum(math.comb(window - 1, k + half) / 2 ** (window - 1) * neighbour(c, k) for k in range(-half, half + 1)) for c in columns}
        out = out.select(*[F.when(F.col("_n") >= window, new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in out.columns], *[F.col(c).alias(f"_was_{c}") for c in columns if f"_was_{c}" not in out.columns])
    inner = (F.col("_i") >= preserve) & (F.col("_i") < F.col("_n") - preserve)
    return out.select(*[F.when(inner, F.col(c)).otherwise(F.col(f"_was_{c}")).alias(c) if c in columns else c for c in frames.columns])


def sustained(active: Column, k: int, by: Sequence[str] = ("episode_index",)) -> tuple[Column, Column]:
    """Whether a run of k active frames begins here; whether one ends here."""
    ahead, behind = ordered(by).rowsBetween(0, k - 1), ordered(by).rowsBetween(1 - k, 0)
    n = active.cast("int")
    return F.sum(n).over(ahead) == k, F.sum(n).over(behind) == k


def fill_gaps(frames: DataFrame, column: str, by: Sequence[str] = ("episode_index",)) -> DataFrame:
    """Nulls filled linearly by frame_index, clamped at the ends; `filled` says where. Episodes without a value stay null."""
    before, after = ordered(by).rowsBetween(Window.unboundedPreceding, 0), ordered(by).rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(column).isNotNull(), F.col("frame_index"))
    a, b = F.last(column, True).over(before), F.first(column, True).over(after)
    i, j = F.last(at, True).over(before), F.first(at, True).over(after)
    line = a + (b - a) * ((F.col("frame_index") - i) / F.when(j > i, j - i))
    return frames.withColumn("_new", F.coalesce(F.col(column), line, a, b)).withColumn("filled", F.col(column).isNull()).drop(column).withColumnRenamed("_new", column)


def turn_angle(context: int, least: float, columns: Sequence[str] = ("x", "y", "z"), by: Sequence[str] = ("episode_index",)) -> Column:
    """Angle between the ways to here and from here over `context` frames; 0 where one is shorter than `least`."""
    w = ordered(by)
    a = [F.col(c) - F.lag(c, context).over(w) for c in columns]
    b = [F.lead(c, context).over(w) - F.col(c) for c in columns]
    na, nb = g.norm(a), g.norm(b)
    angle = F.degrees(F.acos(g.clamp(g.dot(a, b) / (na * nb), -1.0, 1.0)))
    return F.coalesce(F.when((na >= least) & (nb >= least) & (na > 0) & (nb > 0), angle), F.lit(0.0))


def regions(frames: DataFrame, active: Column, angle: str) -> DataFrame:
    """Maximal runs of active frames: episode_index, first_frame, last_frame, peak_frame (first of the largest angle)."""
    on = frames.where(active)
    island = on.withColumn("_island", F.col("frame_index") - F.row_number().over(ordered()))
    peak = F.max_by("frame_index", F.struct(F.col(angle), -F.col("frame_index")))
    out = island.groupBy("episode_index", "_island").agg(F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame"), peak.alias("peak_frame"))
    return out.drop("_island")


def local_step(step: Column, by: Sequence[str] = ("episode_index",)) -> Column:
    """The larger of the steps to here and from here; infinite at the ends."""
    w = ordered(by)
    infinite = F.lit(float("inf"))
    return F.greatest(F.coalesce(step, infinite), F.coalesce(F.lead("_step").over(w), infinite))


def renumber(frames: DataFrame, fps: int | None = None) -> DataFrame:
    """frame_index from 0 in each episode, and index through all of them in order of episode.

    Offsets come from the table of episodes, so no window runs over all frames. fps: timestamps anew.
    """
    numbered = frames.withColumn("frame_index", (F.row_number().over(ordered()) - 1).cast("long"))
    offsets = episode_offsets(frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length")))
    out = numbered.join(offsets.select("episode_index", "first_index"), "episode_index")
    out = out.withColumn("index", F.col("first_index") + F.col("frame_index")).drop("first_index")
    return out if fps is None else out.withColumn("timestamp", F.col("frame_index") / fps)


def episode_offsets(episodes: DataFrame) -> DataFrame:
    """episodes (episode_index, length) with first_index: frames of all episodes before. One row an episode."""
    w = Window.orderBy("episode_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return episodes.withColumn("first_index", F.sum("length").over(w) - F.col("length"))


def third_difference(columns: Sequence[str], by: Sequence[str] = ("episode_index",)) -> Column:
    """The squared third difference of positions that ends at a frame; null at the first three."""
    w = ordered(by)
    third = [F.col(c) - 3 * F.lag(c, 1).over(w) + 3 * F.lag(c, 2).over(w) - F.lag(c, 3).over(w) for c in columns]
    return sum((t * t for t in third[1:]), third[0] * third[0])


def jerk_metrics(frames: DataFrame, columns: Sequence[str] = ("x", "y", "z"), alias: str = "jerk_rms") -> DataFrame:
    """Root mean square of the third difference of positions, for each episode of four frames or more."""
    return frames.select("episode_index", third_difference(columns).alias("sq")).groupBy("episode_index").agg(F.sqrt(F.avg("sq")).alias(alias))


def action_chunk(frames: DataFrame, column: str, horizon: int) -> DataFrame:
    """An array of the next `horizon` values from each frame on, the last one repeated at the end."""
    ahead = ordered().rowsBetween(0, horizon - 1)
    got = F.transform(F.array_sort(F.collect_list(F.struct("frame_index", column)).over(ahead)), lambda s: s[column])
    return frames.withColumn("chunk", F.concat(got, F.array_repeat(F.element_at(got, -1), F.lit(horizon) - F.size(got))))
