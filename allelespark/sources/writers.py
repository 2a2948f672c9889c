"""Sinks: tab-separated text, a folder per sample; compression is an option everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.maths import phred_ln
from ..operators.contigs import contig_order
from ..operators.genotype import GENOTYPES, called_genotype
from ..operators.maf import with_class
from ..operators.pileups import COUNTS
from . import blocks


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), sort: Sequence[str] = ("contig", "position"), compression: str = "none", null: str = "") -> None:
    """df as text with a header, in genomic order inside each file; `by` columns become folders, and each of their contigs
    goes to one of a folder's files, so that a sample is several tasks."""
    order = [*by, *([contig_order(F.col("contig"))] if "contig" in sort else []), *sort]
    dealt = df.repartition(*by, *(c for c in sort if c == "contig")) if by else df
    writer = dealt.sortWithinPartitions(*order).write.option("sep", "\t").option("header", True).option("compression", compression).option("nullValue", null)
    (writer.partitionBy(*by) if by else writer).csv(path)


#: The header's descriptions of a sample's fields.
FORMAT_LINES = {
    "GT": '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    "AD": '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allelic depths for the ref and alt alleles in the order listed">',
    "DP": '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Approximate read depth; some reads may have been filtered">',
    "PL": '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Normalized, Phred-scaled likelihoods for genotypes as defined in the VCF specification">',
}
#: The columns of an annotation table without variants.
MAF_COLUMNS = """Hugo_Symbol Entrez_Gene_Id Center NCBI_Build Chromosome Start_Position End_Position Strand Variant_Classification Variant_Type
Reference_Allele Tumor_Seq_Allele1 Tumor_Seq_Allele2 dbSNP_RS dbSNP_Val_Status Tumor_Sample_Barcode Matched_Norm_Sample_Barcode
Match_Norm_Seq_Allele1 Match_Norm_Seq_Allele2 Tumor_Validation_Allele1 Tumor_Validation_Allele2 Match_Norm_Validation_Allele1
Match_Norm_Validation_Allele2 Verification_Status Validation_Status Mutation_Status Sequencing_Phase Sequence_Source Validation_Method Score
BAM_File Sequencer Tumor_Sample_UUID Matched_Norm_Sample_UUID HGVSc HGVSp HGVSp_Short Transcript_ID Exon_Number t_depth t_ref_count
t_alt_count n_depth n_ref_count n_alt_count Protein_Change UniProt_AApos""".split()


def _vcf_head(fields: Sequence[str], contigs: Sequence[str], names: Sequence[str]) -> list[str]:
    return ["##fileformat=VCFv4.2", '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">', *(FORMAT_LINES[f] for f in fields), *(f"##contig=<ID={c}>" for c in contigs), "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])]


def _vcf_fields(fields: Sequence[str]) -> list[Column | str]:
    """A row's first nine columns."""
    point = F.lit(".")
    return ["contig", "position", point, F.coalesce("ref", F.lit("N")), F.coalesce("alt", F.lit("N")), point, point, F.format_string("AF=%.6f", "allele_frequency"), F.lit(":".join(fields))]


def _cell_parts() -> dict[str, Column]:
    pl = phred_ln([F.col(g) for g in GENOTYPES if g != "gl_out"])
    return {"GT": called_genotype(), "AD": F.concat_ws(",", "ref_count", "alt_count"), "DP": (F.col("ref_count") + F.col("alt_count") + F.col("other_alt_count")).cast("string"), "PL": F.concat_ws(",", *(x.cast("string") for x in pl))}


def vcf_lines(calls: DataFrame, contigs: Sequence[str] = (), fields: Sequence[str] = ("GT", "AD", "DP", "PL"), name: str = "SAMPLE") -> DataFrame:
    """ord, value: the lines of a VCF of joint calls (contig, position, ref, alt, counts, allele_frequency, likelihoods).

    Header lines come first, variants in genomic order; fields picks the sample's columns, name heads its column
    (joint calls have one, the patient's).
    """
    head = _vcf_head(fields, contigs, [name])
    header = calls.sparkSession.createDataFrame([(-1, "", i, line) for i, line in enumerate(head)], "ord int, contig string, position long, value string")
    parts = _cell_parts()
    value = F.concat_ws("\t", *_vcf_fields(fields), F.concat_ws(":", *(parts[f] for f in fields)))
    rows = calls.select(contig_order(F.col("contig")).alias("ord"), "contig", "position", value.alias("value"))
    return header.union(rows)


def joint_vcf_lines(calls: DataFrame, genotypes: DataFrame, samples: Sequence[str], contigs: Sequence[str] = (), fields: Sequence[str] = ("GT", "AD", "DP", "PL")) -> DataFrame:
    """ord, contig, position, value: the lines of a VCF with a column for each of `samples`, in their order.

    calls has the loci (contig, position, ref, alt, allele_frequency), genotypes a row for a sample and locus (sample,
    contig, position, counts, likelihoods).  A locus's cells are one map, read out in the order of the columns, so the
    plan does not grow with the samples; without a row a cell is a point for each field.
    """
    head = _vcf_head(fields, contigs, samples)
    header = calls.sparkSession.createDataFrame([(-1, "", i, line) for i, line in enumerate(head)], "ord int, contig string, position long, value string")
    parts = _cell_parts()
    cells = genotypes.groupBy("contig", "position").agg(F.map_from_entries(F.collect_list(F.struct("sample", F.concat_ws(":", *(parts[f] for f in fields))))).alias("_m"))
    none = F.lit(":".join("./." if f == "GT" else "." for f in fields))
    row = F.transform(F.split(F.lit("\t".join(samples)), "\t"), lambda s: F.coalesce(F.try_element_at("_m", s), none))
    rows = calls.join(cells, ["contig", "position"], "left")
    value = F.concat_ws("\t", *_vcf_fields(fields), F.array_join(row, "\t"))
    return header.union(rows.select(contig_order(F.col("contig")).alias("ord"), "contig", "position", value.alias("value")))


def write_vcf(calls: DataFrame, path: str, genotypes: DataFrame | None = None, block_gzip: bool = False, **settings: object) -> None:
    """Joint calls with one column, or with genotypes and samples one for each; as text, or block-gzipped with indexes."""
    lines = vcf_lines(calls, **settings) if genotypes is None else joint_vcf_lines(calls, genotypes, **settings)
    lines = lines.orderBy("ord", "contig", "position").select("value")
    if block_gzip:
        blocks.write_lines(lines, path)
    else:
        lines.write.text(path)


def write_harmonized(loci: DataFrame, path: str, stacked: bool = False, compression: str = "none") -> None:
    """Loci of all samples: a folder for each, or one table with the column sample."""
    write_table(loci, path, () if stacked else ["sample"], ["contig", "start", "stop"], compression)


def write_allelic_counts(counts: DataFrame, path: str, by: Sequence[str] = (), compression: str = "none") -> None:
    columns = ("contig", "position", "ref_count", "alt_count", "ref", "alt")
    write_table(counts.select(*by, *columns), path, by, compression=compression)


def write_likelihoods(likelihoods: DataFrame, path: str, compression: str = "none") -> None:
    """Each sample's counts and four likelihoods in a folder of its own."""
    write_table(likelihoods.select("sample", "contig", "position", *COUNTS, "allele_frequency", *GENOTYPES).na.fill(0), path, ["sample"], compression=compression)


def correlation_matrix(pairs: DataFrame, samples: Sequence[str]) -> DataFrame:
    """sample and a column for each sample: the square matrix of pairs (sample_a, sample_b, tau), 1 with itself."""
    own = pairs.sparkSession.createDataFrame([(s, s, 1.0) for s in samples], "sample string, other string, tau double")
    both = pairs.select("sample_a", "sample_b", "tau").union(pairs.select("sample_b", "sample_a", "tau")).toDF("sample", "other", "tau").union(own)
    return both.groupBy("sample").pivot("other", list(samples)).agg(F.first("tau"))


def write_acs(acs: DataFrame, path: str, skew: DataFrame | None = None, skew_path: str | None = None) -> None:
    """Allelic copy ratios, a folder a sample, NaN where a value is missing; the samples' skews as a second table."""
    write_table(acs, path, ["sample"], ["contig", "start", "stop"], null="NaN")
    if skew is not None and skew_path:
        skew.write.option("sep", "\t").option("header", True).csv(skew_path)


def absolute_tables(absolute: DataFrame) -> dict[str, DataFrame]:
    """Three projections of map_to_absolute(): the completed table, the one for a genome browser, the rescued intervals."""
    where = ("sample", "contig", "start", "stop")
    return {"completed": absolute.drop("is_rescued", "tau", "sigma_tau", "cn", "cn_sigma", "corrected_cn"), "igv": absolute.select(*where, "segment_mean", "rescaled_total_cn"), "rescued": absolute.where("is_rescued").select(*where)}


def write_absolute(absolute: DataFrame, path: str) -> None:
    for name, df in absolute_tables(absolute).items():
        write_table(df, f"{path.rstrip('/')}/{name}", ["sample"], ["contig", "start", "stop"])


def write_split_maf(maf: DataFrame, path: str, kind: str = "variant_type") -> None:
    """SNVs and indels in a folder each, in one pass."""
    with_class(maf, kind).write.partitionBy("maf_class").option("sep", "\t").option("header", True).csv(path)


def empty_maf(spark: SparkSession) -> DataFrame:
    """The annotation table of a sample without variants."""
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in MAF_COLUMNS))


def minor_af_segments(modeled: DataFrame) -> DataFrame:
    """Segments whose lower bound of the minor allele's fraction is a number, as a table of minor allele fractions."""
    return modeled.where(F.col("maf10").try_cast("double").isNotNull() & ~F.isnan(F.col("maf10").try_cast("double"))).select(*(c for c in ("sample",) if c in modeled.columns), "contig", "start", "stop", F.col("maf10").cast("double").alias("minor_allele_fraction"))
