"""Absolute copy numbers: allelic copy ratios rescaled by purity and ploidy, missing segments rescued."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .acs import genome_weight
from .contigs import sex_ploidy_scale

KEYS = ("sample", "contig", "start", "stop")


def try_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast where their text allows; null elsewhere."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def join_segments(absolute: DataFrame, acs: DataFrame) -> DataFrame:
    return absolute.join(acs, list(KEYS), "full_outer")


def rescale(df: DataFrame, purity: float | Column, ploidy: float | Column, sex: str | Column) -> DataFrame:
    """df (tau, sigma_tau, rescaled_total_cn) with cn and cn_sigma on the scale of rescaled_total_cn.

    tau less the normal cells' part, over the tumour's, halved, X and Y by the sex; then shifted so that medians per
    sample agree, and not below 0.
    """
    d = purity * ploidy + 2 * (1 - purity)
    b, delta = 2 * (1 - purity) / d, purity / d
    s = F.lit(sex)
    rows = df.withColumns({"cn": sex_ploidy_scale(F.greatest(F.col("tau") - b, F.lit(0.0)) / delta / 2, F.col("contig"), s), "cn_sigma": sex_ploidy_scale(F.col("sigma_tau") / delta / 2, F.col("contig"), s)})
    offsets = rows.groupBy("sample").agg((F.median("cn") - F.median("rescaled_total_cn")).alias("_offset"))
    return rows.join(offsets, "sample").withColumn("cn", F.greatest(F.col("cn") - F.col("_offset"), F.lit(0.0))).drop("_offset")


def nearest_cluster(cn: Column, sigma: Column, clusters: Column, z: float = 1.6448536269514722, log_odds: float = -1.0) -> Column:
    """The likeliest of the cluster levels whose tails both exceed 5 % (within z sigmas); cn itself without any.

    If whole and fractional levels qualify, the best whole one wins unless its log density is lower by more than
    -log_odds.  Of equal levels the smaller wins.
    """
    fit = F.filter(clusters, lambda c: F.abs(c - cn) / sigma < z)
    best = lambda a: F.array_min(F.transform(a, lambda c: F.struct(F.abs(c - cn).alias("d"), c.alias("c"))))
    whole, part = best(F.filter(fit, lambda c: c == F.floor(c))), best(F.filter(fit, lambda c: c != F.floor(c)))
    gain = (part["d"] * part["d"] - whole["d"] * whole["d"]) / (2 * sigma * sigma)
    return F.coalesce(F.when(whole.isNotNull() & part.isNotNull(), F.when(gain > log_odds, whole["c"]).otherwise(part["c"])), whole["c"], part["c"], cn)


def map_to_clusters(df: DataFrame) -> DataFrame:
    """df with corrected_cn: cn at the nearest of its sample's levels of corrected_total_cn, rounded to tenths.

    A sample has as many levels as distinct tenths of copy numbers, so an array per sample joins back.
    """
    tenths = F.floor(F.col("corrected_total_cn") * 10 + 0.5) / 10
    levels = df.groupBy("sample").agg(F.sort_array(F.collect_set(tenths)).alias("_levels"))
    return df.join(levels, "sample").withColumn("corrected_cn", nearest_cluster(F.col("cn"), F.col("cn_sigma"), F.col("_levels"))).drop("_levels")


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.groupBy("sample").agg(*(F.corr(a, b).alias(f"corr_{a}") for a, b in pairs))


def rescue(df: DataFrame, ploidy: float | Column, sex: str | Column, amplified: float = 7.0) -> DataFrame:
    """df with absolute columns filled where they are missing, is_rescued, flags, w and segment_mean.

    A rescued segment has no allelic split: its first allele has 0 copies, so it counts as lost (loh); hz tells
    whether the second has none either.
    """
    new = F.col("corrected_total_cn").isNull() | F.col("rescaled_total_cn").isNull()
    ratio = sex_ploidy_scale(F.col("tau") / 2, F.col("contig"), F.lit(sex))
    rows = df.withColumn("is_rescued", new)
    fill = lambda c, v: F.when(F.col("is_rescued"), v).otherwise(F.col(c))
    rows = rows.withColumns({"total_copy_ratio": F.when(F.col("is_rescued"), ratio).otherwise(F.col("tau") / 2), "rescaled_total_cn": fill("rescaled_total_cn", F.col("cn")), "corrected_total_cn": fill("corrected_total_cn", F.col("corrected_cn"))})
    rows = rows.withColumns({"modal_total_cn": F.rint("corrected_total_cn"), "total_hz": (F.col("rescaled_total_cn") == 0).cast("int"), "total_amp": (F.col("rescaled_total_cn") >= amplified).cast("int"), "cn_a1": F.when(F.col("is_rescued"), 0.0), "cn_a2": F.when(F.col("is_rescued"), F.col("cn"))})
    rows = rows.withColumns({"loh": ((F.col("cn_a1") == 0) | (F.col("cn_a2") == 0)).cast("int"), "hz": ((F.col("cn_a1") == 0) & (F.col("cn_a2") == 0)).cast("int")})
    mean = F.log2(F.greatest(F.col("rescaled_total_cn"), F.lit(1e-2))) - F.log2(F.lit(ploidy).cast("double"))
    return genome_weight(rows).withColumn("segment_mean", sex_ploidy_scale(mean, F.col("contig"), F.lit(sex), log=True))


def map_to_absolute(absolute: DataFrame, acs: DataFrame, purity: float, ploidy: float, sex: str) -> DataFrame:
    """Segments of both tables with absolute copy numbers for all of them.

    absolute: KEYS, rescaled_total_cn, corrected_total_cn; acs: KEYS, length, tau, sigma_tau.
    """
    return rescue(map_to_clusters(rescale(join_segments(absolute, acs), purity, ploidy, sex)), ploidy, sex)


def map_cohort_to_absolute(absolute: DataFrame, acs: DataFrame, solutions: DataFrame) -> DataFrame:
    """map_to_absolute() with each sample's own parameters: solutions has a row (sample, purity, ploidy, sex) each."""
    rows = join_segments(absolute, acs).join(solutions.select("sample", "purity", "ploidy", "sex"), "sample")
    own = [F.col(c) for c in ("purity", "ploidy", "sex")]
    return rescue(map_to_clusters(rescale(rows, *own)), *own[1:]).drop("purity", "ploidy", "sex")


def solution_status(solutions: DataFrame) -> DataFrame:
    """sample, status, purity, ploidy by called_solution: -1 failed, 0 forced low purity, else the solution's own."""
    called = F.col("called_solution")
    return solutions.select("sample", F.when(called == -1, "failed").when(called == 0, "low purity").otherwise("called").alias("status"), F.when(called == -1, -1.0).when(called == 0, 1.0).otherwise(F.col("purity")).alias("purity"), F.when(called == -1, -1.0).when(called == 0, 2.0).otherwise(F.col("ploidy")).alias("ploidy"))
