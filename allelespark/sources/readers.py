"""Readers of tab-separated genomic tables.  Names and types are positional, whatever a file's own header says."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vcf import sample_name
from ..operators.contigs import contig_table
from ..operators.coverage import minor_af_from_segments
from . import blocks

Paths = str | Sequence[str]
PILEUP = "contig string, position long, ref_count long, alt_count long, other_alt_count long, allele_frequency double"
CONTAMINATION = "sample string, contamination double, error double"
SEGMENTS = "contig string, start long, stop long, minor_allele_fraction double"
MODELED_SEGMENTS = "contig string, start long, stop long, n_probes long, n_hets long, cr10 double, cr50 double, cr90 double, maf10 double, maf50 double, maf90 double, call string"
PARAMETERS = "PARAMETER_NAME string, POSTERIOR_10 double, POSTERIOR_50 double, POSTERIOR_90 double"
COPY_RATIOS = "contig string, start long, stop long, log2_cr double"
INTERVALS = "contig string, start long, stop long"
VCF = "contig string, position long, id string, ref string, alt string, qual string, filter string, info string, format string"
GVCF = f"{VCF}, genotype string"
ALLELIC_COUNTS = "contig string, position long, ref_count long, alt_count long, ref string, alt string"


def _list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def in_file_order() -> Column:
    """Sorts a file's rows as its lines stand: by the range that a task read, then by the row's number in the task."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))


def numbered(rows: DataFrame, order: str = "ord") -> DataFrame:
    """rows (few, such as a header's) with in_file_order() in `order` replaced by 0, 1, 2, ..."""
    return rows.withColumn(order, (F.row_number().over(Window.orderBy(order)) - 1).cast("long"))


def _of_blocks(spark: SparkSession, paths: list[str], schema: str, comment: str, header: bool) -> DataFrame:
    """The rows of .bgz files and _at, which sorts a file's rows."""
    lines = blocks.read_lines(spark, paths).where((F.col("value") != "") & ~F.startswith("value", F.lit(comment)))
    lines = lines.select("path", F.struct("start", "line").alias("_at"), "value")
    if header:
        first = lines.groupBy(F.col("path").alias("_path")).agg(F.min("_at").alias("_first"))
        lines = lines.join(first, (F.col("path") == F.col("_path")) & (F.col("_at") == F.col("_first")), "left_anti")
    row = F.from_csv("value", F.lit(schema), {"sep": "\t", "mode": "PERMISSIVE", "nullValue": "NA", "nanValue": "NaN"})
    return lines.select(row.alias("r"), "path", "_at").select("r.*", "path", "_at")


def read_table(spark: SparkSession, paths: Paths, schema: str, comment: str = "#", header: bool = True, with_path: bool = False) -> DataFrame:
    """A tab-separated table; lines that begin with the comment character are passed over, and so is a header line.

    Missing files and empty ones give no rows, rows of other widths are filled or cut, what is no number is null;
    `.gz` is read as such, paths that end with `.bgz` block by block in many tasks.  with_path adds the file's path, to
    tell samples apart.
    """
    packed = [p for p in _list(paths) if p.endswith(".bgz")]
    if packed:
        rows = _of_blocks(spark, packed, schema, comment, header).drop("_at", *(() if with_path else ("path",)))
        plain = [p for p in _list(paths) if p not in packed]
        return rows.unionByName(read_table(spark, plain, schema, comment, header, with_path)) if plain else rows
    reader = spark.read.schema(schema).option("sep", "\t").option("header", header).option("mode", "PERMISSIVE").option("ignoreMissingFiles", True).option("nullValue", "NA").option("nanValue", "NaN").option("enforceSchema", True)
    rows = reader.option("comment", comment).csv([paths] if isinstance(paths, str) else list(paths))
    return rows.withColumn("path", F.col("_metadata.file_path")) if with_path else rows


def read_pileup(spark: SparkSession, paths: Paths) -> DataFrame:
    """Pileups with the sample named in each file's first line."""
    rows = read_table(spark, paths, PILEUP, with_path=True)
    return rows.join(header_sample_names(spark, paths), "path", "left").drop("path")


def header_sample_names(spark: SparkSession, paths: Paths) -> DataFrame:
    """path, sample from a line #<METADATA>SAMPLE=x or @RG with SM:x; the first of a file's."""
    lines = spark.read.text(_list(paths)).select(F.col("_metadata.file_path").alias("path"), in_file_order().alias("_at"), sample_name(F.col("value")).alias("sample"))
    return lines.where("sample IS NOT NULL").groupBy("path").agg(F.min_by("sample", "_at").alias("sample"))


def read_contamination(spark: SparkSession, paths: Paths, floor: float = 1e-6) -> DataFrame:
    """The first row of each file, its error not below the floor."""
    rows = read_table(spark, paths, CONTAMINATION, with_path=True).withColumn("_at", in_file_order())
    first = rows.groupBy("path").agg(F.min_by(F.struct("sample", "contamination", "error"), "_at").alias("r")).select("r.*")
    return first.withColumn("error", F.greatest("error", F.lit(floor)))


def read_modeled_segments(spark: SparkSession, paths: Paths) -> DataFrame:
    """Modeled segments with the sample of each file's header, and minor_allele_fraction: the median, folded at 0.5, or what one
    lost copy would leave where no heterozygous site tells."""
    rows = read_table(spark, paths, MODELED_SEGMENTS, comment="@", with_path=True)
    rows = rows.withColumn("minor_allele_fraction", minor_af_from_segments(F.col("maf50"), F.col("cr50")))
    return rows.join(header_sample_names(spark, paths), "path", "left").drop("path")


def read_model_parameters(spark: SparkSession, paths: Paths, names: Sequence[str]) -> DataFrame:
    """path and a column per parameter: its POSTERIOR_50."""
    rows = read_table(spark, paths, PARAMETERS, comment="@", with_path=True)
    return model_parameters(rows.withColumnRenamed("path", "sample"), names).withColumnRenamed("sample", "path")


def model_parameters(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """sample and a column per parameter from the long table (sample, PARAMETER_NAME, POSTERIOR_50)."""
    return long.groupBy("sample").pivot("PARAMETER_NAME", list(names)).agg(F.first("POSTERIOR_50"))


def read_copy_ratios(spark: SparkSession, paths: Paths, schema: str = COPY_RATIOS, comment: str = "@") -> DataFrame:
    return read_table(spark, paths, schema, comment)


def read_vcf(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_table(spark, paths, VCF, header=False)


def read_gvcf(spark: SparkSession, paths: Paths) -> DataFrame:
    """VCF rows with the first sample's genotype, of files of any widths: the columns of the widest, null where a file lacks
    them.  `.gz` and `.bgz` files are read too."""
    packed, plain = ([p for p in _list(paths) if p.endswith(".bgz") == bgz] for bgz in (True, False))
    lines = [blocks.read_lines(spark, packed).select("value")] if packed else []
    lines += [spark.read.text(plain).select("value")] if plain else []
    width = F.coalesce(F.max(F.size(F.split("value", "\t"))), F.lit(0))
    widest = max(x.where("value <> '' AND NOT startswith(value, '#')").agg(width).first()[0] for x in lines)
    rows = read_table(spark, paths, GVCF, header=False)
    return rows.select(*rows.columns[: widest or None])


def read_segments(spark: SparkSession, paths: Paths) -> DataFrame:
    """Segments (`.segments`) with the sample named in each file's header, if one is."""
    rows = read_table(spark, paths, SEGMENTS, with_path=True)
    return rows.join(header_sample_names(spark, paths), "path", "left").drop("path")


def read_maf(spark: SparkSession, paths: Paths, types: Mapping[str, str] | None = None) -> DataFrame:
    """An annotation table by its own header; positions are numbers, `types` casts others where their text allows."""
    return read_cast(spark, paths, {"Start_Position": "long", "End_Position": "long"} | dict(types or {}))


def read_tolerant(spark: SparkSession, paths: Paths, schema: str, **settings: object) -> DataFrame:
    """read_table() of the files that are there; each missing one is warned of, and without any the table is empty."""
    some = []
    for path in _list(paths):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        if found:
            some.append(path)
        else:
            warnings.warn(f"no file {path}", stacklevel=2)
    return read_table(spark, some, schema, **settings) if some else spark.createDataFrame([], schema)


def read_vcf_contigs(spark: SparkSession, path: str) -> DataFrame:
    """contig, ord: 0, 1, 2, ... in the header's order, also if many tasks read it."""
    lines = spark.read.text(path).select(F.regexp_extract("value", r"^##contig=<ID=([^,>]+)", 1).alias("contig"), in_file_order().alias("ord"))
    return numbered(lines.where("contig <> ''"))


def read_dictionary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """contig, length, ord from @SQ lines, in their order; without a file the default contigs and ord."""
    if path is None:
        return contig_table(spark)
    lines = spark.read.text(path).select(F.regexp_extract("value", r"^@SQ.*\tSN:([^\t]+)", 1).alias("contig"), F.regexp_extract("value", r"\tLN:(\d+)", 1).try_cast("long").alias("length"), in_file_order().alias("ord"))
    return numbered(lines.where("contig <> ''"))


def read_intervals(spark: SparkSession, paths: Paths, comment: str = "@", header: bool = True, bed: bool = False) -> DataFrame:
    """Closed 1-based intervals; a BED file's starts are one less."""
    rows = read_table(spark, paths, INTERVALS, comment, header)
    return rows.withColumn("start", F.col("start") + 1) if bed else rows


def read_cast(spark: SparkSession, paths: Paths, types: Mapping[str, str], comment: str = "#") -> DataFrame:
    """A table by its own header, all text, then each named column cast where its text allows."""
    rows = spark.read.option("sep", "\t").option("header", True).option("comment", comment).csv([paths] if isinstance(paths, str) else list(paths))
    return rows.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items() if c in rows.columns})


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """path: a file of paths, one a line."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> ''")


def existing_artifacts(spark: SparkSession, paths: Paths) -> DataFrame:
    """path, length of the files that are not empty; an empty file stands for a missing artifact."""
    return spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths)).select("path", "length").where("length > 0")
