"""Allelic counts at SNP sites: filters, merging of runs, error rates, contamination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maths import clip

COUNTS = ("ref_count", "alt_count", "other_alt_count")


def depth(*columns: str) -> Column:
    return sum((F.col(c) for c in columns[1:]), F.col(columns[0]))


def min_read_depth(pileup: DataFrame, n: int) -> DataFrame:
    return pileup.where(depth(*COUNTS) >= n)


def min_ref_alt_depth(pileup: DataFrame, n: int) -> DataFrame:
    return pileup.where(depth("ref_count", "alt_count") >= n)


def select_pileups(pileup: DataFrame, min_af: float = 0.01, max_af: float = 0.2, min_depth: int = 0) -> DataFrame:
    return pileup.where(F.col("allele_frequency").between(min_af, max_af) & (depth(*COUNTS) >= min_depth))


def first_of_locus(pileup: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each `by` in the given order; not dropDuplicates, which keeps any.

    Rows are sorted by a hash of `by` first: most comparisons end with that number, where names of few samples would tie.
    """
    own = Window.partitionBy(F.xxhash64(*by), *by).orderBy(*order)
    return pileup.withColumn("_r", F.row_number().over(own)).where("_r = 1").drop("_r")


def merge_pileups(runs: DataFrame, order: Sequence[str] = COUNTS, min_depth: int = 0, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """Runs of a sample added up per locus: counts summed, the largest allele frequency; a run counts a locus once.

    Rows are dealt by locus, which serves the choice within runs and the sums: one shuffle, one sort.
    """
    locus = [*keys, "contig", "position"]
    once = first_of_locus(runs.repartition(*locus), [*locus, "run"], [F.col(c) for c in order])
    merged = once.groupBy(*locus).agg(*(F.sum(c).alias(c) for c in COUNTS), F.max("allele_frequency").alias("allele_frequency"))
    return min_read_depth(merged, min_depth)


def error_rate(pileup: DataFrame, by: Sequence[str] = ("sample",), low: float = 1e-3, high: float = 1e-2) -> DataFrame:
    """by, error: one and a half times the share of other alleles, cut to [low, high]."""
    share = 1.5 * F.sum("other_alt_count") / F.greatest(F.sum(depth(*COUNTS)), F.lit(1))
    return pileup.groupBy(*by).agg(clip(share, low, high).alias("error"))


def error_probability(pileup: DataFrame, default: float = 0.05) -> DataFrame:
    """One row, also without pileups: then the default."""
    share = clip(1.5 * F.sum("other_alt_count") / F.greatest(F.sum(depth(*COUNTS)), F.lit(1)), 1e-3, 0.05)
    return pileup.agg(F.when(F.count("*") == 0, default).otherwise(share).alias("error_probability"))


def join_contaminations(contaminations: DataFrame, by: Sequence[str] = ("sample",), floor: float = 1e-6) -> DataFrame:
    """Means weighted by inverse variance; weight_sum, and contamination_error = 1 / sqrt(weight_sum)."""
    e = F.greatest(F.col("error"), F.lit(floor))
    w = F.sum(1 / (e * e))
    return contaminations.groupBy(*by).agg((F.sum(F.col("contamination") / (e * e)) / w).alias("contamination"), w.alias("weight_sum"), (1 / F.sqrt(w)).alias("contamination_error"))


def locus_union(pileups: DataFrame) -> DataFrame:
    return pileups.select("contig", "position").distinct()


def locus_intersection(pileups: DataFrame, n_samples: int) -> DataFrame:
    """Loci that n_samples samples have."""
    return pileups.groupBy("contig", "position").agg(F.count_distinct("sample").alias("_n")).where(F.col("_n") == n_samples).drop("_n")


def subset_loci(pileups: DataFrame, variants: DataFrame) -> DataFrame:
    """Rows at variant loci; all of them if there is no variant, which a table of one row tells."""
    loci = variants.select("contig", "position", F.lit(True).alias("_at_variant")).distinct()
    none = variants.select(F.lit(1)).limit(1).agg((F.count("*") == 0).alias("_no_variant"))
    marked = pileups.join(loci, ["contig", "position"], "left").crossJoin(F.broadcast(none))
    return marked.where("_no_variant OR _at_variant").select(*pileups.columns)


def allele_frequency_conflicts(pileups: DataFrame) -> DataFrame:
    """Loci whose samples disagree on the population allele frequency."""
    return pileups.groupBy("contig", "position").agg(F.count_distinct("allele_frequency").alias("frequencies")).where("frequencies <> 1")


def count_matrix(pileups: DataFrame, count: str, samples: Sequence[str]) -> DataFrame:
    """Loci by samples, 0 where a sample lacks the locus."""
    return pileups.groupBy("contig", "position").pivot("sample", list(samples)).agg(F.sum(count)).na.fill(0, list(samples))


def pileup_at_sites(observations: DataFrame, panel: DataFrame, by: Sequence[str] = (), min_af: float = 0.0, max_af: float = 1.0) -> DataFrame:
    """Counts of ref, alt and other bases at panel sites (contig, position, ref, alt, allele_frequency), 0 included."""
    sites = panel.where(F.col("allele_frequency").between(min_af, max_af))
    seen = observations.join(sites, ["contig", "position"])
    kinds = {"ref_count": F.col("base") == F.col("ref"), "alt_count": (F.col("base") == F.col("alt")) & (F.col("base") != F.col("ref"))}
    kinds["other_alt_count"] = ~(kinds["ref_count"] | kinds["alt_count"])
    counts = seen.groupBy(*by, "contig", "position").agg(*(F.count_if(c).alias(n) for n, c in kinds.items()))
    if by:
        return counts.join(sites.select("contig", "position", "allele_frequency"), ["contig", "position"])
    return sites.select("contig", "position", "allele_frequency").join(counts, ["contig", "position"], "left").na.fill(0, list(COUNTS))
