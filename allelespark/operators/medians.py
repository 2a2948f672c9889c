"""Exact medians of groups with very many rows, by histograms that are refined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

_END = 1.7976931348623157e308


def group_medians(df: DataFrame, by: Sequence[str], value: str, name: str = "median", buckets: int = 4096) -> DataFrame:
    """by, name: each group's exact median (the mean of the two middle values), as doubles; nulls and NaN do not count.

    A built-in median gathers a group's distinct values in one task.  Here each pass counts a group's values in `buckets`
    equal parts of the range in which a middle value lies, added up before they are shuffled, and goes on with the
    bucket that holds it, from its smallest value to its largest, until these are the same.  So a group sends
    as many rows as buckets from each task, whatever its size; a pass narrows the range `buckets`-fold at least.
    For groups that fit a task F.median is cheaper.
    """
    by, v = list(by), F.col("_v")
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    rows = rows.withColumn("_v", F.greatest(F.least("_v", F.lit(_END)), F.lit(-_END)))
    ends = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    middle = F.explode(F.array(*(F.struct(F.lit(t).alias("_t"), F.expr(f"(_n - {1 - t}) DIV 2").alias("_rank")) for t in (0, 1))))
    found = kept(ends.select(*by, "_low", "_high", middle.alias("_m")).select(*by, "_m.*", "_low", "_high"))
    done = found.where("_low = _high")
    while not (todo := found.where("_low < _high")).isEmpty():
        asked = todo.select(*(F.col(c).alias(f"_{c}") for c in by), "_t", "_rank", "_low", "_high")
        same = F.lit(True)
        for c in by:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        inside = rows.join(asked, same & (v >= F.col("_low")) & (v <= F.col("_high"))).drop(*(f"_{c}" for c in by))
        part = (v / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)  # halves: the difference may be too large
        inside = inside.withColumn("_b", F.least(F.floor(part * buckets), F.lit(buckets - 1)))
        counts = inside.groupBy(*by, "_t", "_rank", "_b").agg(F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        upto = F.sum("_c").over(Window.partitionBy(*by, "_t").orderBy("_b"))
        counts = counts.withColumn("_rank", F.col("_rank") - upto + F.col("_c"))
        found = kept(counts.where((F.col("_rank") >= 0) & (F.col("_rank") < F.col("_c"))).select(*by, "_t", "_rank", "_low", "_high"))
        done = done.union(found.where("_low = _high"))
    plain = F.when(F.abs("_low") >= _END, F.signum("_low") * float("inf")).otherwise(F.col("_low"))
    return done.groupBy(*by).agg((F.min(plain) / 2 + F.max(plain) / 2).alias(name))
