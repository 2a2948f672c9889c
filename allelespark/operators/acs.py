"""Allelic copy ratios of modeled segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contigs import copies_in_sex


def acs_segments(segments: DataFrame, sex: str | Column, maf90_threshold: float = 0.485) -> DataFrame:
    """sample, contig, start, stop, n_probes, length, n_hets, tau, f, sigma_tau, mu_minor, sigma_minor, mu_major, sigma_major.

    segments: sample, contig, start, stop, n_probes, n_hets, quantiles cr10/50/90 (log2) and maf10/50/90.  tau is the
    total copy ratio (2 for diploid; X and Y by the sex's copies); f the minor allele's fraction, null on Y and on a
    single X, 0.5 above the threshold.
    """
    contig, s = F.col("contig"), F.lit(sex)
    on_x, on_y = contig.isin("X", "chrX"), contig.isin("Y", "chrY")
    x, y = copies_in_sex(s, "X"), copies_in_sex(s, "Y")
    tau = 2 * F.pow(F.lit(2.0), F.col("cr50")) * F.when(on_x, x / 2).when(on_y, y / 2).otherwise(1.0)
    f = F.when(on_y | (on_x & (x < 2)), None).when(F.col("maf50") > maf90_threshold, 0.5).otherwise(F.col("maf50"))
    sigma_tau = F.pow(F.lit(2.0), F.col("cr90")) - F.pow(F.lit(2.0), F.col("cr10"))
    sigma_f = F.coalesce((F.col("maf90") - F.col("maf10")) / 2, F.lit(1e-3))
    out = segments.select("sample", "contig", "start", "stop", "n_probes", (F.col("stop") - F.col("start")).alias("length"), "n_hets", tau.alias("tau"), f.alias("f"), sigma_tau.alias("sigma_tau"), F.sqrt(sigma_f * sigma_f + sigma_tau * sigma_tau).alias("sigma_minor"))
    return out.withColumns({"mu_minor": F.col("f") * F.col("tau"), "mu_major": (1 - F.col("f")) * F.col("tau"), "sigma_major": F.col("sigma_minor")})


def label_cnloh(acs: DataFrame, t: float = 0.08, pair_f: float = 0.01, triplet_f: float = 0.1) -> DataFrame:
    """acs with seg_label_cnloh: 0 if flanked on both sides by segments of like tau and higher f, 1 on one side, else 2.

    Neighbours are compared per sample and contig in the order of start; a segment without f takes no part.
    """
    order = Window.partitionBy("sample", "contig").orderBy("start", "stop")
    at = lambda c, k: F.col(c) if not k else F.lead(c, k).over(order) if k > 0 else F.lag(c, -k).over(order)

    def alike(i: int, j: int) -> Column:
        d = at("tau", i) - at("tau", j)
        return d * d / (at("sigma_tau", i) * at("sigma_tau", i) + at("sigma_tau", j) * at("sigma_tau", j)) < t

    def apart(i: int, j: int, least: float) -> Column:
        return F.abs(at("f", i) - at("f", j)) >= least

    yes = lambda c: F.coalesce(c, F.lit(False))
    lower_than_previous = yes(alike(-1, 0) & apart(-1, 0, pair_f) & (at("f", -1) > at("f", 0)))
    not_above_next = yes(alike(0, 1) & apart(0, 1, pair_f) & (at("f", 0) <= at("f", 1)))
    middle = yes(alike(-1, 1) & alike(-1, 0) & alike(0, 1) & apart(-1, 0, triplet_f) & apart(0, 1, triplet_f) & (at("f", 0) < at("f", -1)) & (at("f", 0) < at("f", 1)))
    return acs.withColumn("seg_label_cnloh", F.when(middle, 0).when(lower_than_previous | not_above_next, 1).otherwise(2))


def skew(parameters: DataFrame) -> DataFrame:
    """sample, skew = 2 / (1 + MEAN_BIAS) from the wide parameter table (sample, MEAN_BIAS)."""
    return parameters.select("sample", (2 / (1 + F.col("MEAN_BIAS"))).alias("skew"))


def genome_weight(df: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    """df with w: each row's share of its group's length."""
    return df.withColumn("w", F.col("length") / F.sum("length").over(Window.partitionBy(*by)))


def min_markers(acs: DataFrame, min_hets: int = 0, min_probes: int = 2) -> DataFrame:
    return acs.where((F.col("n_hets") >= min_hets) & (F.col("n_probes") >= min_probes))


def dropped_genome(acs: DataFrame, min_hets: int = 0, min_probes: int = 2) -> DataFrame:
    """sample, n_dropped, share of the length that min_markers() drops."""
    bad = (F.col("n_hets") < min_hets) | (F.col("n_probes") < min_probes)
    return acs.groupBy("sample").agg(F.count_if(bad).alias("n_dropped"), (F.coalesce(F.sum(F.when(bad, F.col("length"))), F.lit(0)) / F.sum("length")).alias("dropped"))


def model_segments_to_acs(segments: DataFrame, sex: str | Column, min_hets: int = 0, min_probes: int = 2, maf90_threshold: float = 0.485) -> DataFrame:
    return min_markers(label_cnloh(acs_segments(segments, sex, maf90_threshold)), min_hets, min_probes)
