"""Compositions of operators that answer one question end to end."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import absolute_cn, acs, allelic, cohort, coverage, genotype, harmonize, intervals, pileups, variants
from ..sources.scratch import kept

#: Between a patient's and a sample's name: no printable character.
_JOINT = "\x1f"
_WHO = ("patient", "sample")


def filter_variants(calls: DataFrame, rules: Mapping[str, tuple] = variants.HARD_FILTERS, more: Mapping[str, str] | None = None) -> DataFrame:
    """calls with hard filters applied and `somatic` and `germline`: which product a row belongs to."""
    # filters cost far more than reading: a few MB of calls must not be one task
    out = variants.hard_filter(calls.repartition(*variants.LOCUS), rules, more)
    return out.withColumns({"somatic": variants.somatic(F.col("filter")), "germline": variants.germline(F.col("filter"))})


def genotype_panel(runs: DataFrame, panel: DataFrame, segments: DataFrame | None = None, contaminations: DataFrame | None = None, normals: Sequence[str] = (), sex: str = "Female", select_hets: bool = False, **model: float) -> DataFrame:
    """Joint genotypes of all samples at a panel's sites: runs merged, sites taken first, then likelihoods."""
    merged = pileups.subset_loci(pileups.merge_pileups(runs), panel)
    likelihoods = genotype.genotype_likelihoods(merged, segments, contaminations, sex, **model)
    calls = genotype.confidence_cascade(genotype.joint_genotypes(likelihoods, normals), select_hets=select_hets)
    return calls.withColumn("genotype", genotype.called_genotype())


def coverage_of(reads: DataFrame, targets: DataFrame, keys: Sequence[str] = ("contig",), min_depth: int = 10, max_depth: int = 1000, paired_end: bool = False, max_clipped: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(targets with read counts, callable loci) of the reads that pass the quality filters."""
    good = coverage.good_reads(reads, paired_end=paired_end, max_clipped=max_clipped)
    return coverage.count_reads(targets, good, keys), intervals.callable_loci(good, keys, min_depth, max_depth)


def rare_germline_pileups(calls: DataFrame, common: DataFrame, panel_pileups: DataFrame) -> DataFrame:
    """Panel pileups together with those of germline SNPs that the panel lacks, added up per sample and locus."""
    rare = variants.rare_germline(calls, common)
    both = panel_pileups.withColumn("run", F.lit(1)).unionByName(rare.withColumn("run", F.lit(2)))
    return pileups.merge_pileups(both)


def harmonize_cohort(ratios: DataFrame, how: Mapping[str, str], n_samples: DataFrame, order: str = "ord") -> DataFrame:
    """Common loci of every patient at once: n_samples has (patient, n)."""
    loci = harmonize.harmonize_loci(ratios, how, ["patient", "contig"], order)
    full = loci.groupBy("patient", "contig", "start", "stop").agg(F.count_distinct("sample").alias("n")).join(n_samples, ["patient", "n"])
    return loci.join(full.drop("n"), ["patient", "contig", "start", "stop"], "left_semi")


def with_alleles(sites: DataFrame, panel: DataFrame, rare: DataFrame) -> DataFrame:
    """sites (patient, contig, position) with ref and alt: the panel's, else those of a rare germline SNP of the same patient;
    sites of neither go.  panel and rare have a row for a locus."""
    named = lambda df, prefix: df.withColumnsRenamed({"ref": f"_{prefix}_ref", "alt": f"_{prefix}_alt"})
    rows = sites.join(named(panel, "panel"), ["contig", "position"], "left").join(named(rare, "rare"), ["patient", "contig", "position"], "left")
    rows = rows.withColumns({c: F.coalesce(f"_panel_{c}", f"_rare_{c}") for c in ("ref", "alt")})
    return rows.where("ref IS NOT NULL").select(*sites.columns, "ref", "alt")


def _one(df: DataFrame) -> DataFrame:
    """Samples of different patients may share a name, so inside the chain a sample is patient and sample in one."""
    return df.withColumn("sample", F.concat_ws(_JOINT, "patient", "sample"))


def _alone(df: DataFrame) -> DataFrame:
    return _one(df).drop("patient")


def _split(df: DataFrame) -> DataFrame:
    return df.withColumns({"patient": F.split("sample", _JOINT)[0], "sample": F.split("sample", _JOINT)[1]})


@dataclass(frozen=True)
class Cohort:
    """The whole chain for all patients at once, every table keyed (patient, sample); each result is a property.

    members has a row for each sample: patient, sample, input_ord, is_tumor, sex, purity, ploidy.  A patient's first normal is
    its matched normal; all its normals weigh more in its genotypes.  targets and panel (contig, position, ref, alt) hold
    for all patients.

    1. Reads are counted in the targets, callable loci found.
    2. Calls are filtered; pileups of a patient's germline SNPs that the panel lacks join its panel pileups.
    3. A patient's samples are genotyped together where the panel or such a SNP of its own is; heterozygous sites give allelic counts.
    4. Copy ratios come on each patient's common loci; so do modeled segments, without those that the matched normal calls,
       and each segment's probes and hets are counted anew.
    5. Segments become allelic copy ratios by the patient's sex, and absolute copy numbers by the sample's purity and ploidy.

    Results are made when they are asked for; what several need goes once through `keep`, by default into a table in the
    shared folder.
    """

    members: DataFrame
    reads: DataFrame
    targets: DataFrame
    calls: DataFrame
    panel: DataFrame
    runs: DataFrame
    segments: DataFrame
    contaminations: DataFrame
    ratios: DataFrame
    modeled: DataFrame
    solutions: DataFrame
    min_target: int = 1
    min_segment: int = 100
    min_hets: int = 0
    min_probes: int = 2
    min_depth: int = 10
    max_depth: int = 1000
    model: float = 0.9
    normal_weight: float = 10.0
    keep: Callable[[DataFrame], DataFrame] = kept

    @cached_property
    def with_matched_normals(self) -> DataFrame:
        matched = cohort.matched_normal(self.members.select(*_WHO, "input_ord", "is_tumor"))
        return self.keep(self.members.join(matched, "patient", "left"))

    @cached_property
    def good_reads(self) -> DataFrame:
        return self.keep(coverage.good_reads(self.reads))

    @cached_property
    def read_counts(self) -> DataFrame:
        return coverage.count_reads_of(self.targets, self.good_reads, _WHO)

    @cached_property
    def callable_loci(self) -> DataFrame:
        return intervals.callable_loci(self.good_reads, [*_WHO, "contig"], self.min_depth, self.max_depth)

    @cached_property
    def variants(self) -> DataFrame:
        return self.keep(filter_variants(self.calls))

    @cached_property
    def panel_alleles(self) -> DataFrame:
        return pileups.first_of_locus(self.panel.select(*variants.ALLELE), variants.LOCUS, [F.col("ref"), F.col("alt")])

    @cached_property
    def rare_alleles(self) -> DataFrame:
        """Each patient's germline SNPs that the panel lacks, one a locus."""
        rows = self.variants.where(F.col("germline") & (F.length("ref") == 1) & (F.length("alt") == 1)).select("patient", *variants.ALLELE)
        rows = rows.join(self.panel.select(*variants.LOCUS).distinct(), list(variants.LOCUS), "left_anti")
        return self.keep(pileups.first_of_locus(rows, ["patient", *variants.LOCUS], [F.col("ref"), F.col("alt")]))

    @cached_property
    def _merged(self) -> DataFrame:
        merged = rare_germline_pileups(_alone(self.variants), self.panel, pileups.merge_pileups(_alone(self.runs)))
        merged = merged.withColumn("patient", F.split("sample", _JOINT)[0])
        return self.keep(with_alleles(merged, self.panel_alleles, self.rare_alleles).drop("patient", "ref", "alt"))

    @cached_property
    def pileups(self) -> DataFrame:
        return _split(self._merged)

    @cached_property
    def genotypes(self) -> DataFrame:
        minor = _alone(self.segments).groupBy("sample", "contig", "start", "stop").agg(F.min("minor_allele_fraction").alias("minor_allele_fraction"))
        own = _one(self.members).select("patient", "sample", "sex", (~F.col("is_tumor")).alias("is_normal"))
        known = self._merged.join(own, "sample")
        likelihoods = genotype.genotype_likelihoods(known, minor, pileups.join_contaminations(_alone(self.contaminations)), F.col("sex"))
        joint = genotype.joint_genotypes(likelihoods, F.col("is_normal"), self.normal_weight, ["patient"])
        return self.keep(genotype.confidence_cascade(joint, self.model).withColumn("genotype", genotype.called_genotype()))

    @cached_property
    def allelic_counts(self) -> DataFrame:
        sites = with_alleles(self.genotypes.select("patient", "contig", "position", "genotype"), self.panel_alleles, self.rare_alleles)
        counts = self.pileups.select(*_WHO, "contig", "position", "ref_count", "alt_count")
        return self.keep(allelic.allelic_counts(counts, sites, keys=[*_WHO, "contig"]))

    @cached_property
    def harmonized(self) -> DataFrame:
        return harmonize.harmonize_groups(self.ratios, {"log2_cr": "strongest_signal"}, self.with_matched_normals, minimum=self.min_target)

    @cached_property
    def filtered_segments(self) -> DataFrame:
        how = dict.fromkeys(("cr10", "cr50", "cr90", "maf10", "maf50", "maf90"), "mean") | {"call": "first"}
        out = harmonize.harmonize_groups(self.modeled, how, self.with_matched_normals, germline=True, minimum=self.min_segment)
        probes = self.ratios.select(*_WHO, "contig", F.col("start").alias("position"))
        out = intervals.count_in_intervals(out, probes, [*_WHO, "contig"], name="n_probes")
        return self.keep(intervals.count_in_intervals(out, self.allelic_counts, [*_WHO, "contig"], name="n_hets"))

    @cached_property
    def acs(self) -> DataFrame:
        rows = _alone(self.filtered_segments).join(_one(self.members).select("sample", "sex"), "sample")
        return self.keep(_split(acs.model_segments_to_acs(rows, F.col("sex"), self.min_hets, self.min_probes)))

    @cached_property
    def absolute(self) -> DataFrame:
        own = _one(self.members).select("sample", "purity", "ploidy", "sex")
        ratios = _alone(self.acs).select(*absolute_cn.KEYS, "length", "tau", "sigma_tau")
        return _split(absolute_cn.map_cohort_to_absolute(_alone(self.solutions), ratios, own))

    def results(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in RESULTS}


RESULTS = ("read_counts", "callable_loci", "variants", "pileups", "genotypes", "allelic_counts", "harmonized", "filtered_segments", "acs", "absolute")
