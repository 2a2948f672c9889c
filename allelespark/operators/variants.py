"""Variant tables: filters, selection by FILTER tags, merging, annotation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vcf import common_prefix, depths, filter_tags, info_map, info_number, number_of, popaf_to_af, total_alt_count
from .pileups import first_of_locus
from .rangejoin import range_join

LOCUS = ("contig", "position")
ALLELE = (*LOCUS, "ref", "alt")
SOMATIC = ("PASS", "normal_artifact")
GERMLINE = ("normal_artifact", "panel_of_normals")
#: Filter name -> (INFO key, index in its list, flagged below).
HARD_FILTERS = {"lowDP": ("DP", None, 10), "lowTAC": ("TAC", None, 3), "lowMBQ.0": ("MBQ", 0, 20), "lowMBQ.1": ("MBQ", 1, 20), "lowMMQ.0": ("MMQ", 0, 20), "lowMMQ.1": ("MMQ", 1, 20), "lowMFRL.0": ("MFRL", 0, 18), "lowMFRL.1": ("MFRL", 1, 18), "lowMPOS": ("MPOS", 0, 6), "lowROQ": ("ROQ", None, 10), "germline": ("POPAF", None, 3)}


def biallelic_snvs(variants: DataFrame) -> DataFrame:
    """Rows with one base for another; loci with several such rows go altogether."""
    base = lambda c: (F.length(c) == 1) & ~F.col(c).isin("-", ".")
    snvs = variants.where(base("ref") & base("alt"))
    return snvs.withColumn("_n", F.count("*").over(Window.partitionBy(*LOCUS))).where("_n = 1").drop("_n")


def somatic(filter_: Column, allowed: Sequence[str] = SOMATIC) -> Column:
    """All tags are allowed."""
    return F.forall(filter_tags(filter_), lambda t: t.isin(*allowed))


def germline(filter_: Column, allowed: Sequence[str] = GERMLINE) -> Column:
    """A tag says germline and all others are allowed."""
    return F.array_contains(filter_tags(filter_), "germline") & F.forall(filter_tags(filter_), lambda t: t.isin("germline", *allowed))


def hard_filter(variants: DataFrame, rules: Mapping[str, tuple[str, int | None, float]] = HARD_FILTERS, more: Mapping[str, str] | None = None) -> DataFrame:
    """variants with the names of failed rules added to `filter`; PASS only if nothing else is there.

    A rule flags a number below its limit, never a missing one.  `more` has names and SQL conditions on columns.
    """
    failed = [F.when(number_of(F.col("_info"), key, i) < limit, name) for name, (key, i, limit) in rules.items()]
    failed += [F.when(F.expr(condition), name) for name, condition in (more or {}).items()]
    every = F.array_union(F.filter(filter_tags(F.col("filter")), lambda t: ~t.isin("PASS", ".", "")), F.filter(F.array(*failed), lambda x: x.isNotNull()))
    # each step a column: INFO is taken apart once a row, not once a rule and use
    rows = variants.withColumn("_info", info_map(F.col("info"))).withColumn("_every", every)
    return rows.withColumn("filter", F.when(F.size("_every") == 0, "PASS").otherwise(F.array_join("_every", ";"))).drop("_info", "_every")


def select_variants(variants: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None, kind: str | None = None, condition: str | None = None, pad: int = 0) -> DataFrame:
    """Rows inside `include` (padded), outside `exclude`, of a kind (SNP), for which an SQL condition holds."""
    if kind == "SNP":
        variants = variants.where((F.length("ref") == 1) & (F.length("alt") == 1))
    if condition:
        variants = variants.where(F.expr(condition))
    if include is not None:
        variants = range_join(variants, include, ["contig"], how="left_semi", pad=pad)
    return range_join(variants, exclude, ["contig"], how="left_anti") if exclude is not None else variants


def partition_variants(variants: DataFrame, condition: Column) -> DataFrame:
    """variants with `selected`, one pass for both sides; null counts as not selected."""
    return variants.withColumn("selected", F.coalesce(condition, F.lit(False)))


def count_selected(variants: DataFrame) -> DataFrame:
    return variants.agg(F.count_if("selected").alias("n_selected"), F.count_if(~F.col("selected")).alias("n_not_selected"))


def not_selected(variants: DataFrame, selected: DataFrame) -> DataFrame:
    return variants.join(selected.select(*ALLELE).distinct(), list(ALLELE), "left_anti")


def gather(*tables: DataFrame) -> DataFrame:
    """Shards put together; an allele that several have comes once."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.dropDuplicates(list(ALLELE))


def merge_resources(*tables: DataFrame) -> DataFrame:
    """Tables put together; of rows at one locus the earliest table's stays."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("_source", F.lit(i))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return first_of_locus(out, LOCUS, [F.col(c) for c in ("_source", "ref", "alt")]).drop("_source")


def panel_of_normals(calls: DataFrame, least: int = 2) -> DataFrame:
    """Alleles called in `least` samples or more, and in how many."""
    return calls.groupBy(*ALLELE).agg(F.count_distinct("sample").alias("n_samples")).where(F.col("n_samples") >= least)


def af_only(variants: DataFrame, least: float) -> DataFrame:
    """SNPs that pass, commoner than `least`, with their frequency only."""
    kept = variants.where(F.col("filter").isin("PASS", ".") & (F.length("ref") == 1) & (F.length("alt") == 1))
    return kept.withColumn("af", popaf_to_af(info_number(F.col("info"), "POPAF"))).where(F.col("af") > least).select(*ALLELE, "af")


def common_biallelic(variants: DataFrame, least: float) -> DataFrame:
    """af_only() rows, one for each locus: the first alternate allele where there are several."""
    return first_of_locus(af_only(variants, least), LOCUS, [F.col("ref"), F.col("alt")])


def common_resource(tables: Sequence[tuple[DataFrame, float]]) -> DataFrame:
    """Common biallelic SNPs of several tables, each with its own minimum frequency; of a locus the first table's stays."""
    return merge_resources(*(common_biallelic(t, least) for t, least in tables))


def split_multiallelic(variants: DataFrame) -> DataFrame:
    """A row per alternate allele, `ad` (ref, alt, alt, ...) cut to the reference and that one."""
    each = variants.select("*", F.posexplode(F.split("alt", ",")).alias("_i", "_alt"))
    cut = F.when(F.col("ad").isNotNull(), F.concat_ws(",", F.try_element_at(F.split("ad", ","), F.lit(1)), F.try_element_at(F.split("ad", ","), F.col("_i") + 2)))
    return each.withColumns({"alt": F.col("_alt"), "ad": cut}).drop("_i", "_alt")


def trim_alleles(variants: DataFrame) -> DataFrame:
    """Shared suffixes, then shared prefixes of ref and alt cut off, one base left; position moves by the prefix."""
    suffix = common_prefix(F.reverse("ref"), F.reverse("alt"))
    out = variants.withColumn("_n", suffix).withColumns({c: F.expr(f"substring({c}, 1, length({c}) - _n)") for c in ("ref", "alt")})
    out = out.withColumn("_n", common_prefix(F.col("ref"), F.col("alt")))
    return out.withColumns({"position": F.col("position") + F.col("_n"), **{c: F.expr(f"substring({c}, _n + 1)") for c in ("ref", "alt")}}).drop("_n")


def with_total_alt_count(variants: DataFrame, ads: Sequence[str]) -> DataFrame:
    """variants with `tac` over the samples' AD columns."""
    return variants.withColumn("tac", total_alt_count(F.array(*(depths(F.col(c)) for c in ads))))


def vcf_to_pileup(variants: DataFrame, default_af: float = 7e-8) -> DataFrame:
    """sample, contig, position, counts, allele_frequency from rows (sample, ad, dp, info)."""
    ad = depths(F.col("ad"))
    ref, alt = F.coalesce(F.try_element_at(ad, F.lit(1)), F.lit(0)), F.coalesce(F.try_element_at(ad, F.lit(2)), F.lit(0))
    other = F.greatest(F.col("dp") - ref - alt, F.lit(0))
    return variants.select("sample", *LOCUS, ref.cast("long").alias("ref_count"), alt.cast("long").alias("alt_count"), other.cast("long").alias("other_alt_count"), popaf_to_af(info_number(F.col("info"), "POPAF"), default_af).alias("allele_frequency"))


def rare_germline(variants: DataFrame, common: DataFrame) -> DataFrame:
    """Pileups of germline SNPs that the common panel lacks."""
    rare = variants.where(germline(F.col("filter")) & (F.length("ref") == 1) & (F.length("alt") == 1)).join(common.select(*LOCUS).distinct(), list(LOCUS), "left_anti")
    return vcf_to_pileup(rare)


def force_call_alleles(calls: DataFrame, forced: DataFrame, intervals: DataFrame) -> DataFrame:
    """Passing alleles of all samples and forced ones inside the intervals, each once."""
    inside = range_join(forced, intervals, ["contig"], how="left_semi")
    return calls.where("filter = 'PASS'").select(*ALLELE).union(inside.select(*ALLELE)).distinct()


def annotate_features(variants: DataFrame, features: DataFrame, priority: Sequence[Column]) -> DataFrame:
    """variants with the columns of the one overlapping feature that comes first by `priority`; null without any."""
    named = features.withColumnsRenamed({"start": "feature_start", "stop": "feature_stop"})
    pairs = range_join(variants, named, ["contig"], start="feature_start", stop="feature_stop", how="left")
    return first_of_locus(pairs, ALLELE, priority)


def rename_samples(df: DataFrame, names: DataFrame) -> DataFrame:
    """sample replaced by its name in (bam_name, sample_name); unknown ones stay."""
    return df.join(names, df["sample"] == names["bam_name"], "left").withColumn("sample", F.coalesce("sample_name", "sample")).drop("bam_name", "sample_name")


def reads_at_sites(reads: DataFrame, sites: DataFrame) -> DataFrame:
    """Reads that cover a site: the read is the interval, the site the point.  Equal intervals cover alike."""
    where = ["contig", "start", "stop"]
    hit = range_join(sites.select(*LOCUS).distinct(), reads.select(*where).distinct(), ["contig"]).select(*where).distinct()
    return reads.join(hit, where, "left_semi")
