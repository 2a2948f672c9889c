"""Joins of points and intervals that Spark runs as equi-joins.

An inequality join would be a nested loop.  Intervals are put in bins of a width that fits their length: level k has
bins of bin * FAN**k, and an interval goes to the first level where it touches at most FAN + 1 bins.  A point looks in
one bin of every level.  So long intervals do not explode, and the join is on (keys, level, bin).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 64


def _widths(bin_: int, levels: int) -> list[int]:
    return [bin_ * FAN**k for k in range(levels)]


def _bins(df: DataFrame, start: Column, stop: Column, widths: list[int]) -> DataFrame:
    """df with _level and _bin: a row for each bin that the interval touches on its level; the last level takes all."""
    level = F.lit(len(widths) - 1)
    for k in reversed(range(len(widths) - 1)):
        level = F.when(stop - start <= FAN * widths[k], k).otherwise(level)
    width = F.element_at(F.array(*(F.lit(w).cast("long") for w in widths)), level + 1)
    return df.withColumn("_level", level).withColumn("_bin", F.explode(F.sequence(F.floor(start / width), F.floor(F.greatest(start, stop) / width))))


def _dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """df dealt over all shuffle partitions.  Bins are small next to the pairs they give, and adaptive execution, which
    sees the bins' bytes only, would else leave the pairs of millions of rows to one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def range_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], position: str = "position", start: str = "start", stop: str = "stop", how: str = "inner", closed: bool = True, pad: int = 0, bin_: int = 16, levels: int = 4) -> DataFrame:
    """points with the intervals that hold their position: start <= position <= stop (< stop if not closed).

    An inner join looks up every point's bins at once.  For the other kinds ("left", "left_semi", "left_anti") the
    intervals, padded on both sides, are matched with the distinct (keys, position), then joined back to all points, so
    rows that repeat keep their number.
    """
    keys = list(keys)
    widths = _widths(bin_, levels)
    low, high = F.col(start) - pad, F.col(stop) + pad
    on_bin = [*keys, "_level", "_bin"]
    held = _dealt(_bins(intervals.where(low <= high), low, high, widths), on_bin)
    look = F.explode(F.array(*(F.struct(F.lit(k).alias("_level"), F.floor(F.col("_p") / w).alias("_bin")) for k, w in enumerate(widths))))
    if how == "inner":
        asked = points.withColumn("_p", F.col(position)).withColumn("_look", look).select(*points.columns, "_p", "_look.*")
        inside = (F.col("_p") >= low) & ((F.col("_p") <= high) if closed else (F.col("_p") < high))
        return _dealt(asked, on_bin).join(held, on_bin).where(inside).drop("_level", "_bin", "_p")
    asked = points.select(*keys, F.col(position).alias("_p")).distinct().withColumn("_look", look).select(*keys, "_p", "_look.*")
    inside = (F.col("_p") >= low) & ((F.col("_p") <= high) if closed else (F.col("_p") < high))
    match = _dealt(asked, on_bin).join(held, on_bin).where(inside).drop("_level", "_bin")
    if how in ("left_semi", "left_anti"):
        match = match.select(*keys, "_p").distinct()
    match = match.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in match.columns if c not in keys))
    on = F.col(position) == F.col("_p")
    for k in keys:
        on &= points[k] == match[f"_{k}"]
    out = points.join(match, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop("_p", *(f"_{k}" for k in keys))


def _cover(df: DataFrame, start: str, stop: str, widths: list[int], own_roles: Sequence[int], wide_role: int) -> DataFrame:
    """df with _level, _bin and _role: the bins it touches on its own level, for each of own_roles, and on each wider one,
    as wide_role."""
    own = F.lit(len(widths) - 1)
    for k in reversed(range(len(widths) - 1)):
        own = F.when(F.col(stop) - F.col(start) <= FAN * widths[k], k).otherwise(own)
    df = df.withColumn("_own", own)

    def bins(k: int, width: int) -> Column:
        every = F.sequence(F.floor(F.col(start) / width), F.floor(F.col(stop) / width))
        at = lambda role: F.transform(every, lambda b: F.struct(F.lit(k).alias("level"), b.alias("bin"), F.lit(role).alias("role")))
        none = F.array().cast("array<struct<level:int,bin:bigint,role:int>>")
        return F.when(F.col("_own") == k, F.concat(*map(at, own_roles))).when(F.col("_own") < k, at(wide_role)).otherwise(none)

    return df.withColumn("_at", F.explode(F.concat(*(bins(k, w) for k, w in enumerate(widths))))).withColumns({"_level": F.col("_at.level"), "_bin": F.col("_at.bin"), "_role": F.col("_at.role")}).drop("_at", "_own")


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], start: str = "start", stop: str = "stop", bin_: int = 1024, levels: int = 4) -> DataFrame:
    """Pairs of overlapping closed intervals; right's columns but the keys get the prefix "r_".

    Both sides are put in bins of the first level that fits their length and of all wider ones, so an interval has a
    bounded number of rows whatever its length.  A pair meets on the wider of its levels only: the join is also on a role,
    0 for a left interval on its own level, 1 for a left one on a wider level, which meets right ones on their own.  So short
    intervals never meet in wide bins.  A pair counts in the first bin that it shares.
    """
    keys = list(keys)
    widths = _widths(bin_, levels)
    right = right.select(*keys, *(F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys))
    left, right = left.where(F.col(start) <= F.col(stop)), right.where(F.col(f"r_{start}") <= F.col(f"r_{stop}"))
    on = [*keys, "_level", "_bin", "_role"]
    pairs = _dealt(_cover(left, start, stop, widths, (0,), 1), on).join(_dealt(_cover(right, f"r_{start}", f"r_{stop}", widths, (0, 1), 0), on), on)
    width = F.element_at(F.array(*(F.lit(w).cast("long") for w in widths)), F.col("_level") + 1)
    first = F.floor(F.greatest(F.col(start), F.col(f"r_{start}")) / width)
    overlap = (F.col(start) <= F.col(f"r_{stop}")) & (F.col(f"r_{start}") <= F.col(stop))
    return pairs.where(overlap & (F.col("_bin") == first)).drop("_level", "_bin", "_role")


def nearest_interval(points: DataFrame, intervals: DataFrame, keys: Sequence[str], max_distance: int, position: str = "position", block: int = 1 << 20) -> DataFrame:
    """points with start, stop of the nearest interval and the distance to it, where that is max_distance or less.

    The interval before is the last one that starts at the position or earlier, the one after the first that starts
    there or later; the one after is taken only if it is nearer.  No pairs are made: both tables are sorted in blocks of
    positions, so a contig is many tasks; what a block lacks comes from a table of the first and last interval of each.
    """
    keys = list(keys)
    in_block = lambda c: F.floor(F.col(c) / block)
    points = points.withColumns({"_is_point": F.lit(True), "_block": in_block(position)})
    marks = intervals.select(*keys, F.col("start").alias(position), F.struct("start", "stop").alias("_interval"), F.lit(False).alias("_is_point"), in_block("start").alias("_block"))
    both = points.unionByName(marks, allowMissingColumns=True)
    up = Window.partitionBy(*keys, "_block").orderBy(position).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*keys, "_block").orderBy(F.col(position).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # RANGE frames take in all rows of an equal position
    both = both.withColumns({"_pre": F.max("_interval").over(up), "_post": F.min("_interval").over(down)}).where("_is_point")
    ends = marks.groupBy(*keys, "_block").agg(F.min("_interval").alias("_first"), F.max("_interval").alias("_last"))
    asked = points.select(*keys, "_block").distinct().join(ends, [*keys, "_block"], "full")
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.select(*keys, "_block", F.max("_last").over(before).alias("_earlier"), F.min("_first").over(after).alias("_later"))
    both = both.join(carried, [*keys, "_block"]).withColumns({"_pre": F.coalesce("_pre", "_earlier"), "_post": F.coalesce("_post", "_later")})
    p = F.col(position)
    both = both.withColumns({"_to_pre": F.when(F.col("_pre").isNotNull(), F.greatest(p - F.col("_pre.stop"), F.lit(0))), "_to_post": F.col("_post.start") - p})
    use_post = F.col("_to_pre").isNull() | (F.col("_to_post") < F.col("_to_pre"))
    chosen = F.when(F.coalesce(use_post, F.lit(False)), F.struct(F.col("_post").alias("i"), F.col("_to_post").alias("d"))).otherwise(F.struct(F.col("_pre").alias("i"), F.col("_to_pre").alias("d")))
    both = both.withColumn("_chosen", chosen).where(F.col("_chosen.d") <= max_distance)
    return both.select(*(c for c in points.columns if c not in ("_is_point", "_block")), F.col("_chosen.i.start").alias("start"), F.col("_chosen.i.stop").alias("stop"), F.col("_chosen.d").alias("distance"))
