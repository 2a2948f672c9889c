"""Reads tables, read counts and copy-ratio calls."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .intervals import count_in_intervals
from .medians import group_medians
from .rangejoin import range_join

#: Bits of the alignment flags.
PAIRED, PROPER, UNMAPPED, FIRST, SECONDARY, FAILED, DUPLICATE = 0x1, 0x2, 0x4, 0x40, 0x100, 0x200, 0x400


def good_reads(reads: DataFrame, min_mapq: int = 1, max_clipped: int | None = None, paired_end: bool = False, more: str | None = None) -> DataFrame:
    """Mapped primary reads that are no duplicates and did not fail, of some length and mapping quality.

    With paired_end only the first of a properly mapped pair, so that a fragment counts once.
    """
    bad = UNMAPPED | SECONDARY | FAILED | DUPLICATE
    reads = reads.where((F.col("flags").bitwiseAND(bad) == 0) & (F.col("stop") >= F.col("start")) & (F.col("mapq") >= min_mapq) & (F.col("mapq") != 255))
    if paired_end:
        reads = reads.where(F.col("flags").bitwiseAND(PROPER | FIRST) == (PROPER | FIRST))
    if max_clipped is not None:
        reads = reads.where(F.col("clip") <= max_clipped)
    return reads.where(F.expr(more)) if more else reads


def count_reads(intervals: DataFrame, reads: DataFrame, keys: Sequence[str] = ("contig",)) -> DataFrame:
    """intervals with `count`: reads that start in them."""
    return count_in_intervals(intervals, reads.select(*keys, F.col("start").alias("position")), keys)


def count_reads_of(targets: DataFrame, reads: DataFrame, by: Sequence[str], keys: Sequence[str] = ("contig",)) -> DataFrame:
    """by, keys, start, stop, count: the reads of each `by` (a sample) that start in each target, where there are any.

    Targets hold for all; equal ones count once.  Reads are counted first, so no row is made for a sample without reads
    in a target; with_zeros() adds those where a table for export needs them.
    """
    at = reads.groupBy(*by, *keys, F.col("start").alias("_position")).agg(F.count("*").alias("_n"))
    inside = range_join(at, targets.select(*keys, "start", "stop").distinct(), keys, position="_position")
    return inside.groupBy(*by, *keys, "start", "stop").agg(F.sum("_n").alias("count"))


def with_zeros(counts: DataFrame, targets: DataFrame, samples: Sequence[str], keys: Sequence[str] = ("contig",)) -> DataFrame:
    """keys, start, stop, sample, count for all targets and the named samples: an array a target, then a row a cell."""
    by = [*keys, "start", "stop"]
    cells = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("sample", "count"))).alias("_m"))
    rows = targets.select(*by).distinct().join(cells, by, "left")
    each = rows.select(*by, "_m", F.explode(F.array(*map(F.lit, samples))).alias("sample"))
    return each.select(*by, "sample", F.coalesce(F.try_element_at("_m", "sample"), F.lit(0)).alias("count"))


def call_copy_ratio(segments: DataFrame, low: float = 0.9, high: float = 1.1, z: float = 2.0, trim: float = 2.0, by: Sequence[str] = ("sample",)) -> DataFrame:
    """segments (log2_cr, length) with call + - 0, by the published neutral-interval rule.

    Neutral segments have a copy ratio within [low, high]; their mean and deviation are weighted by length, once more
    without those further than `trim` deviations away.  Outside the neutral range, a segment is called if it is more
    than z deviations from the mean.
    """
    by = list(by)
    rows = segments.withColumn("_cr", F.pow(F.lit(2.0), F.col("log2_cr")))

    def moments(df: DataFrame, name: str) -> DataFrame:
        w = F.sum("length")
        mean = F.sum(F.col("_cr") * F.col("length")) / w
        square = F.sum(F.col("_cr") * F.col("_cr") * F.col("length")) / w
        return df.groupBy(*by).agg(mean.alias(f"{name}_mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias(f"{name}_sd"))

    neutral = rows.where(F.col("_cr").between(low, high))
    first = moments(neutral, "_a")
    second = moments(neutral.join(first, by).where(F.abs(F.col("_cr") - F.col("_a_mean")) <= trim * F.col("_a_sd")), "_b")
    rows = rows.join(second, by, "left")
    far = (F.abs(F.col("_cr") - F.col("_b_mean")) > z * F.col("_b_sd")) & ~F.col("_cr").between(low, high)
    return rows.withColumn("call", F.when(F.coalesce(far, F.lit(False)), F.when(F.col("_cr") > F.col("_b_mean"), "+").otherwise("-")).otherwise("0")).drop("_cr", "_b_mean", "_b_sd")


def standardize(counts: DataFrame, keys: Sequence[str] = ("contig", "start", "stop")) -> DataFrame:
    """log2_cr per sample and interval: counts over the sample's median, over the interval's median of those.

    counts are read by every pass of the samples' medians, so they go into a table first; an interval's rows (one a sample)
    are sorted together once, by a hash first, and get their median there.
    """
    counts = kept(counts)
    per_sample = group_medians(counts, ["sample"], "count", "_m").where("_m > 0")  # a sample has as many rows as intervals
    scaled = counts.join(F.broadcast(per_sample), "sample").withColumn("_s", F.col("count") / F.col("_m"))  # a row a sample
    rows = scaled.withColumn("_mi", F.median("_s").over(Window.partitionBy(F.xxhash64(*keys), *keys))).where("_mi > 0")
    return rows.withColumn("log2_cr", F.log2(F.greatest(F.col("_s") / F.col("_mi"), F.lit(1e-3)))).select("sample", *keys, "log2_cr")


def _dense(places: pa.ListArray, values: pa.ListArray, width: int) -> np.ndarray:
    """Rows with values at places, 0 elsewhere; equal places add up."""
    out = np.zeros((len(places), width))
    row = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
    np.add.at(out, (row, places.flatten().to_numpy()), values.flatten().to_numpy())
    return out


def gram_tiles(rows: DataFrame, width: int, tile: int = 256) -> DataFrame:
    """i, j, data: the tiles of N'N with i <= j, for the matrix N of rows (places array<int>, values array<double>).

    A task adds up the products of its rows and gives each tile once; a tile's parts, one a task, meet and are added up.
    """
    cuts = [(a, min(a + tile, width)) for a in range(0, width, tile)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                x = _dense(some.column("places"), some.column("values"), width)
                total += x.T @ x
        pairs = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]
        for i, j in pairs:
            data = total[slice(*cuts[i]), slice(*cuts[j])].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([data], pa.binary())], names=["i", "j", "data"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in parts.column("data").to_pylist())
        return pa.table({"i": parts.column("i").slice(0, 1), "j": parts.column("j").slice(0, 1), "data": pa.array([total.tobytes()], pa.binary())})

    schema = "i int, j int, data binary"
    return rows.select("places", "values").mapInArrow(multiply, schema).groupBy("i", "j").applyInArrow(add, schema)


def tangent_directions(normals: DataFrame, k: int, keys: Sequence[str] = ("contig", "start", "stop"), max_normals: int = 5000, tile: int = 256) -> DataFrame | None:
    """keys, u (array): each interval's part of the k strongest left singular vectors of the intervals-by-normals matrix.

    With N that matrix, they are N V / s, where V and s come from N'N, a matrix of the normals' size that the driver
    decomposes (200 MB for the 5,000 normals that are allowed by default).  Null without normals.
    """
    keys = list(keys)
    names = [r["sample"] for r in normals.select("sample").distinct().orderBy("sample").limit(max_normals + 1).collect()]
    if len(names) > max_normals:
        raise ValueError(f"more than {max_normals} normals")
    if not names:
        return None
    places = F.broadcast(normals.sparkSession.createDataFrame(list(zip(names, range(len(names)), strict=True)), "sample string, place int"))  # max_normals rows
    cells = normals.where("log2_cr IS NOT NULL").join(places, "sample").groupBy(*keys).agg(F.collect_list(F.struct("place", "log2_cr")).alias("c"))
    rows = kept(cells.select(*keys, F.col("c.place").alias("places"), F.col("c.log2_cr").alias("values")))
    width = len(names)
    gram = np.zeros((width, width))
    for r in gram_tiles(rows, width, tile).toLocalIterator():
        (a, b), (c, d) = ((x * tile, min(x * tile + tile, width)) for x in (r["i"], r["j"]))
        gram[a:b, c:d] = np.frombuffer(r["data"], np.float64).reshape(b - a, d - c)
        gram[c:d, a:b] = gram[a:b, c:d].T
    square, v = np.linalg.eigh(gram)
    strong = np.argsort(-square)[:k]
    strong = strong[square[strong] > 1e-12 * max(square.max(), 1e-300)]
    turn = v[:, strong] / np.sqrt(square[strong])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                u = _dense(some.column("places"), some.column("values"), width) @ turn
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in keys), pa.array(list(u), pa.list_(pa.float64()))], names=[*keys, "u"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    return kept(rows.mapInArrow(project, f"{schema}, u array<double>"))


def tangent_normalize(samples: DataFrame, normals: DataFrame, k: int = 20, keys: Sequence[str] = ("contig", "start", "stop"), max_normals: int = 5000, tile: int = 256) -> DataFrame:
    """samples (sample, keys, log2_cr) less their projection on the k strongest directions of a cohort of normals.

    Both have a row for a sample and interval.  No pair of columns is ever joined: tangent_directions() gives each interval k
    numbers, a sample's k dot products with them are sums, and the projection is again k products a row.  An
    interval that a column lacks counts as 0 there; one that no normal has stays as it is.
    """
    keys = list(keys)
    u = tangent_directions(normals, k, keys, max_normals, tile)
    if u is None:
        return samples
    size = u.agg(F.coalesce(F.max(F.size("u")), F.lit(0))).first()[0]
    rows = kept(samples.join(u, keys, "left"))
    dots = rows.where("u IS NOT NULL").groupBy("sample").agg(F.array(*(F.coalesce(F.sum(F.col("log2_cr") * F.col("u")[j]), F.lit(0.0)) for j in range(size))).alias("_w"))
    part = F.aggregate(F.zip_with("u", "_w", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    return rows.join(dots, "sample", "left").withColumn("log2_cr", F.col("log2_cr") - F.coalesce(part, F.lit(0.0))).select(*samples.columns)


def minor_af_from_segments(maf50, log2_cr):
    """The median minor allele fraction; without hets what one lost copy would leave, folded at 0.5, within [0, 0.5]."""
    f = F.coalesce(maf50, 1 / (2 * F.pow(F.lit(2.0), log2_cr)))
    return F.greatest(F.when(f > 0.5, 1 - f).otherwise(f), F.lit(0.0))


def segmentation_penalty(n):
    """n - ln(n) / n for n samples."""
    return n - F.log(n) / n


def cohort_median(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """df with <value>_median, the median of each `by` (of some samples each), added up before it is shuffled."""
    return df.join(df.groupBy(*by).agg(F.median(value).alias(f"{value}_median")), list(by))
