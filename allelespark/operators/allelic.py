"""Allelic counts for segmentation: heterozygous sites, mapped to nearby intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pileups import first_of_locus, min_ref_alt_depth
from .rangejoin import nearest_interval


def is_het(genotype: Column) -> Column:
    return genotype.rlike(r"0[/|]1|1[/|]0")


def relocate_to_free_slots(mapped: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sites mapped from outside their interval moved to its free positions, last first; without room they go.

    Positions from stop - 1 down to start + 1 that no site inside holds are free; outside sites take them in the
    given order.  mapped has start, stop, distance (nearest_interval()).

    The r-th free position is stop - r, less one for each position held above it; the j-th held one from the top, with f
    free ones above it, counts from r = f + 1 on.  So held positions and outside sites are sorted by that number
    together, and no row is made for a position.
    """
    group = [*keys, "start", "stop"]
    inside = mapped.where("distance = 0")
    outside = mapped.where("distance > 0").withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))
    held = inside.where("position > start AND position < stop").select(*group, "position").distinct()
    above = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("position").desc()))
    held = held.select(*group, (F.col("stop") - F.col("position") - above + 1).cast("long").alias("_r"), F.lit(1).alias("_held"))
    both = outside.withColumn("_held", F.lit(0)).unionByName(held, allowMissingColumns=True)
    passed = F.sum("_held").over(Window.partitionBy(*group).orderBy("_r", F.col("_held").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    moved = both.withColumn("_passed", passed).where("_held = 0").withColumn("position", F.col("stop") - F.col("_r") - F.col("_passed"))
    return inside.unionByName(moved.where("position > start").select(*mapped.columns))


def aggregate_hets(mapped: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per interval, at its middle: counts added up (1|0 sites with ref and alt swapped), the first alleles."""
    flip = F.col("genotype") == "1|0"
    where = F.struct(*order)
    ref, alt = F.when(flip, F.col("alt_count")).otherwise(F.col("ref_count")), F.when(flip, F.col("ref_count")).otherwise(F.col("alt_count"))
    out = mapped.groupBy(*keys, "start", "stop").agg(F.sum(ref).alias("ref_count"), F.sum(alt).alias("alt_count"), F.min_by("ref", where).alias("ref"), F.min_by("alt", where).alias("alt"))
    return out.withColumn("position", F.floor((F.col("start") + F.col("stop")) / 2))


def map_to_intervals(sites: DataFrame, intervals: DataFrame, max_distance: int, keys: Sequence[str] = ("contig",), order: Sequence[str] = ("position", "ref_count", "alt_count"), aggregate: bool = False) -> DataFrame:
    """Sites at the nearest interval: moved into it, or added up per interval.

    Intervals may lack some of the keys (sample), and then hold for all of them.
    """
    shared = [k for k in keys if k in intervals.columns]
    moved = relocate_to_free_slots(nearest_interval(sites, intervals, shared, max_distance), keys, order)
    return aggregate_hets(moved, keys, order) if aggregate else moved


def deepest_per_locus(sites: DataFrame, keys: Sequence[str] = ("contig",)) -> DataFrame:
    ties = [F.col(c) for c in ("ref_count", "alt_count", "ref", "alt")]
    return first_of_locus(sites, [*keys, "position"], [(F.col("ref_count") + F.col("alt_count")).desc(), *ties])


def allelic_counts(pileup: DataFrame, gvcf: DataFrame, intervals: DataFrame | None = None, min_depth: int = 0, select_hets: bool = True, max_distance: int = 0, aggregate: bool = False, keys: Sequence[str] = ("contig",)) -> DataFrame:
    """keys, position, ref_count, alt_count, ref, alt: a pileup's counts at genotyped sites.

    gvcf has position, ref, alt, all of the keys or those that it does not hold for altogether, and, to select
    heterozygous sites, genotype.
    """
    keys = list(keys)
    sites = min_ref_alt_depth(pileup.join(gvcf, [*(k for k in keys if k in gvcf.columns), "position"]), min_depth)
    sites = first_of_locus(sites, [*keys, "position"], [F.col(c) for c in ("ref_count", "alt_count", "ref", "alt")])
    if select_hets and "genotype" in gvcf.columns:
        sites = sites.where(is_het(F.col("genotype")))
    if "genotype" not in sites.columns:
        sites = sites.withColumn("genotype", F.lit(None).cast("string"))
    if intervals is not None:
        sites = map_to_intervals(sites, intervals, max_distance, keys, aggregate=aggregate)
    return deepest_per_locus(sites, keys).select(*keys, "position", "ref_count", "alt_count", "ref", "alt")
