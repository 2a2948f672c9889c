"""Genotype likelihoods of allelic counts, per sample and jointly, and the concordance of samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maths import clip, kendall_tau_b, lgammas, ln, logaddexp, logsumexp, minus_infinity, with_settled
from .contigs import ploidy
from .pairs import pair_tables
from .pileups import COUNTS, error_rate
from .rangejoin import range_join
from ..sources.scratch import kept

#: The likelihood columns and the genotypes they stand for, in the order in which ties are won.
GENOTYPES = {"gl_ref": "0/0", "gl_het": "0/1", "gl_alt": "1/1", "gl_out": "./."}
DEFAULT_MINOR_AF = 0.47


def with_minor_af(pileups: DataFrame, segments: DataFrame | None, keys: Sequence[str] = ("sample", "contig"), default: float = DEFAULT_MINOR_AF) -> DataFrame:
    """minor_af of the segment that holds the locus, else the default.  Segments of a sample must not overlap."""
    if segments is None:
        return pileups.withColumn("minor_af", F.lit(default))
    held = segments.select(*keys, "start", "stop", F.col("minor_allele_fraction").alias("minor_af"))
    return range_join(pileups, held, keys, how="left").drop("start", "stop").withColumn("minor_af", F.coalesce("minor_af", F.lit(default)))


def log_likelihoods(rows: DataFrame, outlier_prior: float = 1e-4, overdispersion: float = 10.0) -> DataFrame:
    """rows (counts, allele_frequency, minor_af, error, contamination, copies, bias) with the logs of the four genotypes'
    likelihoods times their priors.

    Homozygous counts are binomial around the error rate, heterozygous ones beta-binomial around the minor allele's
    fraction on either haplotype, outliers uniform; contamination brings in the population's allele frequency, and
    priors are Hardy-Weinberg's.  Without copies only an outlier can be; with one copy no heterozygote.

    Every step's results are columns, so that expressions name columns only and stay small in generated code.  The log-gammas
    are one array (lgammas() says why).
    """
    c, e, q, m, bias = (F.col(x) for x in ("contamination", "error", "allele_frequency", "minor_af", "bias"))

    def seen(name: str) -> Column:
        f = F.col(name)
        f = f / (f + (1 - f) * bias)
        return (f * (1 - e) + (1 - f) * e) * overdispersion

    rows = rows.withColumns({"_k": F.col("alt_count").cast("double"), "_n": (F.col("ref_count") + F.col("alt_count")).cast("double"), "_faa": c * q + (1 - c) * e / 3, "_fbb": c * q + (1 - c) * (1 - e), "_fab": c * q + (1 - c) * m, "_fba": c * q + (1 - c) * (1 - m)})
    rows = rows.withColumns({"_r": F.col("_n") - F.col("_k"), "_ab": seen("_fab"), "_ba": seen("_fba"), "_o": F.when(F.col("_n") == 0, 1 - outlier_prior).otherwise(outlier_prior), "_lq": ln(q), "_lp": ln(1 - q)})
    k, n, r = F.col("_k"), F.col("_n"), F.col("_r")
    terms = {"_n1": n + 1, "_k1": k + 1, "_r1": r + 1, "_ns": n + overdispersion}
    for x in ("_ab", "_ba"):
        a, b = F.col(x), overdispersion - F.col(x)
        terms |= {f"{x}k": k + a, f"{x}r": r + b, f"{x}a": a, f"{x}b": b}
    rows = rows.withColumns(terms)
    rows = rows.withColumn("_g", lgammas(F.array(*terms)))
    g = lambda t: F.col("_g")[list(terms).index(t)]
    total = math.lgamma(overdispersion)
    rows = rows.withColumn("_choose", g("_n1") - g("_k1") - g("_r1")).withColumn("_keep", F.log(1 - F.col("_o")))
    het = {f"_het{x}": F.col("_keep") + F.col("_lp") + F.col("_lq") + F.col("_choose") + g(f"{x}k") + g(f"{x}r") - g("_ns") - g(f"{x}a") - g(f"{x}b") + total for x in ("_ab", "_ba")}
    power = lambda count, p: F.when(count == 0, 0.0).otherwise(count * ln(p))
    hom = {f"_hom{x}": F.col("_keep") + 2 * F.col(prior) + F.col("_choose") + power(k, F.col(x)) + power(r, 1 - F.col(x)) for x, prior in (("_faa", "_lp"), ("_fbb", "_lq"))}
    rows = rows.withColumns(het | hom)
    none = minus_infinity()
    logs = {
        "gl_ref": F.when(F.col("copies") < 1, none).otherwise(F.col("_hom_faa")),
        "gl_het": F.when(F.col("copies") < 2, none).otherwise(logaddexp(F.col("_het_ab"), F.col("_het_ba"))),
        "gl_alt": F.when(F.col("copies") < 1, none).otherwise(F.col("_hom_fbb")),
        "gl_out": F.log("_o") + 2 * F.col("_lp") - F.log(n + 1),
    }
    out = rows.withColumns(logs)
    return out.drop(*(x for x in out.columns if x.startswith("_")))


def genotype_likelihoods(pileups: DataFrame, segments: DataFrame | None = None, contaminations: DataFrame | None = None, sex: str | Column = "Female", outlier_prior: float = 1e-4, overdispersion: float = 10.0, ref_bias: float = 1.05, min_error: float = 1e-3, max_error: float = 1e-2, per_sample_bias: DataFrame | None = None) -> DataFrame:
    """pileups (sample, contig, position, counts, allele_frequency) with the four likelihoods of each sample's locus.

    contaminations has a row (sample, contamination) per sample, per_sample_bias a row (sample, ref_bias); sex may be a
    column of pileups, of which other columns stay too.  pileups are read three times, so they go into a table first.
    """
    pileups = kept(pileups)
    rows = with_minor_af(pileups, segments).join(F.broadcast(error_rate(pileups, low=min_error, high=max_error)), "sample")  # a row a sample
    rows = rows.join(contaminations.select("sample", "contamination"), "sample", "left") if contaminations is not None else rows.withColumn("contamination", F.lit(None).cast("double"))
    rows = rows.withColumn("bias", F.lit(ref_bias))
    if per_sample_bias is not None:
        rows = rows.join(per_sample_bias.select("sample", F.col("ref_bias").alias("own_bias")), "sample", "left").withColumn("bias", F.coalesce("own_bias", "bias")).drop("own_bias")
    rows = rows.withColumns({"contamination": F.coalesce("contamination", F.lit(0.0)), "copies": ploidy(F.col("contig"), F.lit(sex))})
    rows = log_likelihoods(rows, outlier_prior, overdispersion)
    return with_settled(rows.drop("error", "contamination", "minor_af", "copies", "bias"), {g: F.exp(g) for g in GENOTYPES})


def confident_calls(df: DataFrame, model: float = 0.9, genotypes: Sequence[str] = tuple(GENOTYPES), among: Sequence[str] | None = None) -> DataFrame:
    """Rows whose likeliest of `genotypes` has a share of `model` or more of the sum over `among` (by default them)."""
    total = sum((F.col(g) for g in (among or genotypes)[1:]), F.col((among or genotypes)[0]))
    return df.where((F.greatest(*genotypes) if len(genotypes) > 1 else F.col(genotypes[0])) >= model * total)


def confidence_cascade(df: DataFrame, model: float = 0.9, select_hets: bool = False, strict: bool = True) -> DataFrame:
    """Confident among all four genotypes, then among the three that are no outlier, then heterozygous if asked for.

    The second step compares the three only, so an outlier can stay.  strict=False compares a heterozygote with
    itself, which lets every row pass.
    """
    calls = [g for g in GENOTYPES if g != "gl_out"]
    df = confident_calls(confident_calls(df, model), model, calls)
    return confident_calls(df, model, ["gl_het"], list(GENOTYPES) if strict else None) if select_hets else df


def called_genotype(columns: Sequence[str] = tuple(GENOTYPES)) -> Column:
    """The likeliest genotype; the first of equals."""
    return F.array_max(F.array(*(F.struct(F.col(g).alias("p"), F.lit(-i).alias("i"), F.lit(GENOTYPES[g]).alias("g")) for i, g in enumerate(columns)))).getField("g")


def genotype_code(genotype: Column) -> Column:
    """Alternate alleles: 0, 1, 2; null for no call."""
    return F.when(genotype == "0/0", 0).when(genotype.isin("0/1", "1/0"), 1).when(genotype == "1/1", 2)


def joint_genotypes(likelihoods: DataFrame, normals: Sequence[str] | Column = (), normal_weight: float = 10.0, keys: Sequence[str] = ()) -> DataFrame:
    """keys, contig, position, the four joint likelihoods (summing to 1), summed counts, mean allele frequency.

    A genotype's joint log is the weighted mean of the samples' logs over those that have reads at the locus; without
    any it is minus infinity, and then all four are 0.  A sample that gives 0 rules a genotype out.
    normals are the names of samples, or a condition that their rows fulfil.
    """
    covered = F.col("ref_count") + F.col("alt_count") > 0
    named = normals if isinstance(normals, Column) else F.col("sample").isin(*normals)
    w = F.when(named, normal_weight).otherwise(1.0)
    means = [F.when(F.count_if(covered & (F.col(g) == 0)) > 0, minus_infinity()).otherwise(F.sum(F.when(covered & (F.col(g) > 0), w * F.log(g))) / F.sum(F.when(covered, w))).alias(f"_{g}") for g in GENOTYPES]
    loci = likelihoods.groupBy(*keys, "contig", "position").agg(*means, *(F.sum(c).alias(c) for c in COUNTS), F.avg("allele_frequency").alias("allele_frequency"))
    loci = loci.withColumns({f"_{g}": F.coalesce(f"_{g}", minus_infinity()) for g in GENOTYPES})
    loci = loci.withColumn("_top", F.greatest(*(F.col(f"_{g}") for g in GENOTYPES)))
    loci = loci.withColumn("_all", logsumexp([F.col(f"_{g}") for g in GENOTYPES], F.col("_top")))
    share = lambda g: F.when(F.col("_all") == float("-inf"), 0.0).otherwise(F.exp(F.col(f"_{g}") - F.col("_all")))
    return with_settled(loci, {g: share(g) for g in GENOTYPES}).drop("_all", "_top", *(f"_{g}" for g in GENOTYPES))


def concordance(likelihoods: DataFrame, model: float = 0.9, keys: Sequence[str] = ()) -> DataFrame:
    """keys, sample_a, sample_b, n_loci, tau, z for every pair of samples: Kendall's tau-b of their confident calls.

    Loci count if both samples are called and one has an alternate allele.
    """
    keys = list(keys)
    calls = confident_calls(likelihoods, model).select(*keys, "sample", "contig", "position", genotype_code(called_genotype()).alias("code")).where("code IS NOT NULL")
    counts = [f"c{i}{j}" for i in range(3) for j in range(3)]
    table = pair_tables(calls, keys).withColumn("c00", F.lit(0).cast("long"))
    table = table.withColumn("n_loci", sum((F.col(c) for c in counts[1:]), F.col("c00"))).where("n_loci > 0")
    out = kendall_tau_b(table, [[f"c{i}{j}" for j in range(3)] for i in range(3)])
    return out.withColumn("tau", clip(F.col("tau"), -1.0, 1.0)).select(*keys, "sample_a", "sample_b", "n_loci", "tau", "z")


def discordant(pairs: DataFrame, least: float = 0.9, z: float = 1.959964) -> DataFrame:
    """Pairs of samples that are surely (|z| beyond 5 %) less alike than one patient's samples are."""
    return pairs.where((F.col("tau") < least) & (F.abs(F.col("z")) > z))


def minimum_correlation(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.coalesce(F.min("tau"), F.lit(1.0)).alias("min_tau"))
