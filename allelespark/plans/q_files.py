"""Queries that read and write named files, and small operators with an entry of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog
from ..catalog import query
from ..functions.maths import scaled
from ..operators import absolute_cn, acs, allelic, cohort, genotype, harmonize, maf, variants
from ..operators.contigs import contig_order, dense_order, genomic_sort, ploidy
from ..sources import blocks, readers, writers
from ..sources.scratch import kept
from . import q_intervals as qi
from . import q_pileups as qp
from .q_sources import scratch
from .views import view


def text_files(rows: DataFrame, columns: list[str], path: str, head: str | None = None, comment: str | None = None, parts: Column | None = None) -> None:
    """A folder for each sample with lines of tab-separated columns, in the order of these, after a comment and a header.

    By default a sample is one file, so one task.  `parts` deals it over a folder (part=...) for each value, all with the comment
    and the header.
    """
    line = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns))
    rows, own = (rows, ["file"]) if parts is None else (rows.withColumn("part", parts), ["file", "part"])
    rows = rows.withColumn("file", F.col("sample"))
    lines = rows.select(*own, F.lit(2).alias("k"), F.struct(*columns).alias("o"), line.alias("value"))
    for k, text in ((1, head), (0, comment)):
        if text is not None:
            first = rows.select(*own).distinct().select(*own, F.lit(k).alias("k"), F.lit(None).cast(lines.schema["o"].dataType).alias("o"), F.regexp_replace(F.lit(text), "%s", F.col("file")).alias("value"))
            lines = lines.union(first)
    lines.repartition(*own).sortWithinPartitions(*own, "k", "o").select(*own, "value").write.partitionBy(*own).text(path)


NAMED = "#<METADATA>SAMPLE=%s"


@query("s2_header_sample_names", "SELECT DISTINCT sample FROM segments")
def _(spark, d):
    path = scratch(spark)
    text_files(view(spark, d, "segments"), ["contig", "start", "stop", "minor_allele_fraction"], path, "contig\tstart\tend\tmaf", NAMED)
    return readers.header_sample_names(spark, path).select("sample")


@query("s4_read_segments", "SELECT sample, contig, start, stop, minor_allele_fraction FROM segments")
def _(spark, d):
    path = scratch(spark)
    text_files(view(spark, d, "segments"), ["contig", "start", "stop", "minor_allele_fraction"], path, "contig\tstart\tend\tmaf", NAMED)
    return readers.read_segments(spark, path).drop("file")


@query("s3_read_contamination_files", "SELECT sample, contamination, greatest(error, 1e-6) AS error FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY contamination, error) AS r FROM contaminations) WHERE r = 1")
def _(spark, d):
    path = scratch(spark)
    text_files(view(spark, d, "contaminations").withColumn("name", F.col("sample")), ["name", "contamination", "error"], path, "sample\tcontamination\terror")
    return readers.read_contamination(spark, path)


@query("s5_read_modeled_segments", f"SELECT sample, contig, start, stop, n_probes, n_hets, cr50, coalesce(maf50, -1) AS maf50, call, {qp.SCALED.format('greatest(CASE WHEN f > 0.5 THEN 1 - f ELSE f END, 0)')} AS minor_allele_fraction FROM (SELECT *, coalesce(maf50, 1 / (2 * pow(2.0::DOUBLE, cr50))) AS f FROM modeled_segments)")
def _(spark, d):
    path = scratch(spark)
    columns = ["contig", "start", "stop", "n_probes", "n_hets", "cr10", "cr50", "cr90", "maf10", "maf50", "maf90", "call"]
    text_files(view(spark, d, "modeled_segments"), columns, path, "\t".join(columns), "@RG\tID:1\tSM:%s", F.col("contig"))
    rows = readers.read_modeled_segments(spark, path)
    return rows.select("sample", "contig", "start", "stop", "n_probes", "n_hets", "cr50", F.coalesce("maf50", F.lit(-1.0)).alias("maf50"), "call", scaled(F.col("minor_allele_fraction")).alias("minor_allele_fraction"))


@query("s6_read_model_parameters", "SELECT sample, max(contamination) AS bias, max(error) AS noise FROM contaminations GROUP BY sample")
def _(spark, d):
    path = scratch(spark)
    wide = view(spark, d, "contaminations").groupBy("sample").agg(F.max("contamination").alias("MEAN_BIAS"), F.max("error").alias("NOISE"))
    long = wide.unpivot(["sample"], ["MEAN_BIAS", "NOISE"], "name", "middle").withColumns({"low": F.lit(0.0), "high": F.lit(1.0)})
    text_files(long, ["name", "low", "middle", "high"], path, "PARAMETER_NAME\tPOSTERIOR_10\tPOSTERIOR_50\tPOSTERIOR_90", "@RG\tID:1\tSM:%s")
    rows = readers.read_model_parameters(spark, path, ["MEAN_BIAS", "NOISE"]).join(readers.header_sample_names(spark, path), "path")
    return rows.select("sample", F.col("MEAN_BIAS").alias("bias"), F.col("NOISE").alias("noise"))


def _contigs(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "targets").groupBy("contig").agg(F.max("stop").alias("length"))


_CONTIGS = "SELECT contig, row_number() OVER (ORDER BY CASE contig WHEN 'X' THEN 22 ELSE contig::INT - 1 END) - 1 AS place, max(stop) AS length FROM targets GROUP BY contig"


def _header(spark: SparkSession, d: str, line) -> str:
    path = scratch(spark)
    _contigs(spark, d).coalesce(1).sortWithinPartitions(contig_order(F.col("contig"))).select(line.alias("value")).write.text(path)
    return path


@query("s8_read_vcf_contigs", f"SELECT contig, place FROM ({_CONTIGS})")
def _(spark, d):
    rows = readers.read_vcf_contigs(spark, _header(spark, d, F.concat(F.lit("##contig=<ID="), "contig", F.lit(",length="), "length", F.lit(">"))))
    return rows.select("contig", F.col("ord").alias("place"))


@query("s10_read_dictionary", _CONTIGS)
def _(spark, d):
    rows = readers.read_dictionary(spark, _header(spark, d, F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), "length")))
    return rows.select("contig", F.col("ord").alias("place"), "length")


def _vcf_file(spark: SparkSession, d: str, *more: str) -> str:
    path = scratch(spark)
    columns = ("contig", "position", F.lit(".").alias("id"), "ref", "alt", F.lit(".").alias("qual"), "filter", "info", *((F.lit("GT").alias("format"), *more) if more else ()))
    view(spark, d, "variants").select(*columns).write.option("sep", "\t").csv(path)
    return path


@query("s11_read_gvcf", "SELECT contig, position, ref, alt, genotype FROM variants")
def _(spark, d):
    return readers.read_gvcf(spark, _vcf_file(spark, d, "genotype")).select("contig", "position", "ref", "alt", "genotype")


@query("s11_read_gvcf_trimmed", "SELECT contig, position, '.' AS id, ref, alt, '.' AS qual, filter, info FROM variants")
def _(spark, d):
    return readers.read_gvcf(spark, _vcf_file(spark, d))


@query("s11_read_gvcf_widths", "SELECT contig, position, ref, alt, CASE WHEN ord % 3 = 0 THEN genotype ELSE '' END AS genotype FROM variants")
def _(spark, d):
    """Files of eight columns and of ten in one call."""
    rows, paths = view(spark, d, "variants"), [scratch(spark), scratch(spark)]
    columns = ("contig", "position", F.lit(".").alias("id"), "ref", "alt", F.lit(".").alias("qual"), "filter", "info")
    rows.where("ord % 3 <> 0").select(*columns).write.option("sep", "\t").csv(paths[0])
    rows.where("ord % 3 = 0").select(*columns, F.lit("GT").alias("format"), "genotype").write.option("sep", "\t").option("compression", "gzip").csv(paths[1])
    return readers.read_gvcf(spark, paths).select("contig", "position", "ref", "alt", F.coalesce("genotype", F.lit("")).alias("genotype"))


@query("s7_read_vcf_blocks", "SELECT contig, position, '.' AS id, ref, alt, '.' AS qual, filter, info, 'GT' AS format, genotype FROM variants")
def _(spark, d):
    """Block-gzipped files, written and read in ranges."""
    path = scratch(spark)
    columns = ("contig", "position", F.lit("."), "ref", "alt", F.lit("."), "filter", "info", F.lit("GT"), "genotype")
    lines = view(spark, d, "variants").select(F.concat_ws("\t", *columns).alias("value"))
    blocks.write_lines(lines, path)
    return readers.read_gvcf(spark, f"{path}/*.bgz")


@query("s12_read_intervals", "SELECT contig, start, stop FROM segments")
def _(spark, d):
    path = scratch(spark)
    text_files(view(spark, d, "segments"), ["contig", "start", "stop"], path, "CONTIG\tSTART\tEND", "@HD\tVN:1.6")
    return readers.read_intervals(spark, path).drop("file")


@query("s15_read_maf", "SELECT contig AS Chromosome, position AS Start_Position, position AS End_Position, sample AS Tumor_Sample_Barcode FROM variants")
def _(spark, d):
    path = scratch(spark)
    rows = view(spark, d, "variants").select(F.col("contig").alias("Chromosome"), F.col("position").alias("Start_Position"), F.col("position").alias("End_Position"), F.col("sample").alias("Tumor_Sample_Barcode"))
    rows.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    return readers.read_maf(spark, path)


@query("s16_read_tolerant", "SELECT contig, start, stop FROM targets")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(view(spark, d, "targets").select("contig", "start", "stop"), path, sort=["contig", "start"])
    return readers.read_tolerant(spark, [path, f"{path}-that-is-not-there"], readers.INTERVALS)


@query("s17_read_manifest", "SELECT DISTINCT concat('runs/', sample, '.pileup') AS path FROM pileup_runs")
def _(spark, d):
    path = scratch(spark)
    view(spark, d, "pileup_runs").select(F.concat(F.lit("runs/"), "sample", F.lit(".pileup")).alias("value")).distinct().write.text(path)
    return readers.read_manifest(spark, path)


@query("s18_existing_artifacts", "SELECT DISTINCT sample FROM segments WHERE sample <> 'S1'")
def _(spark, d):
    path = scratch(spark)
    rows = view(spark, d, "segments").withColumn("value", F.when(F.col("sample") != "S1", F.concat_ws(":", "contig", "start")))
    rows.groupBy("sample").agg(F.concat_ws(",", F.sort_array(F.collect_set("value"))).alias("value")).repartition("sample").select(F.col("sample").alias("file"), "value").write.option("lineSep", " ").partitionBy("file").text(path)
    found = readers.existing_artifacts(spark, f"{path}/*/*.txt").where("length > 1")
    return found.select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("sample"))


# --- sinks -----------------------------------------------------------------------------------------------------
@query("k2_write_harmonized", f"WITH {qi.LOCI} SELECT sample, contig, start, stop, log2_cr FROM loci")
def _(spark, d):
    path = scratch(spark)
    writers.write_harmonized(qi.loci(spark, d).select("sample", "contig", "start", "stop", "log2_cr"), path)
    return readers.read_table(spark, path, f"{readers.COPY_RATIOS}, sample string")


@query("k3_write_genotype_vcf", f"WITH {qp.GL}, {qp.JOINT}, {qp.GV} SELECT contig, position, coalesce(ref, 'N') AS ref, coalesce(alt, 'N') AS alt, 'GT:AD:DP' AS format, concat({qp.BEST}, ':', ref_count, ',', alt_count, ':', ref_count + alt_count + other_alt_count) AS genotype FROM joint LEFT JOIN gv USING (contig, position)")
def _(spark, d):
    path = scratch(spark)
    calls = qp.joint(spark, d).join(qp.gvcf(spark, d).select("contig", "position", "ref", "alt"), ["contig", "position"], "left")
    writers.write_vcf(calls, path, contigs=["1", "2"], fields=("GT", "AD", "DP"), name="P0")
    return readers.read_gvcf(spark, path).select("contig", "position", "ref", "alt", "format", "genotype")


@query("k3_write_joint_vcf", f"WITH {qp.GL}, {qp.JOINT}, {qp.GV}, cells AS (SELECT contig, position, {', '.join(f"max(cell) FILTER (sample = 'S{i}') AS S{i}" for i in range(4))} FROM (SELECT *, concat({qp.BEST}, ':', ref_count, ',', alt_count, ':', ref_count + alt_count + other_alt_count) AS cell FROM gl) GROUP BY contig, position) SELECT contig, position, coalesce(ref, 'N') AS ref, coalesce(alt, 'N') AS alt, {', '.join(f"coalesce(S{i}, './.:.:.') AS S{i}" for i in range(4))} FROM joint JOIN cells USING (contig, position) LEFT JOIN gv USING (contig, position)")
def _(spark, d):
    """A column for each sample, block-gzipped and read back."""
    path, samples = scratch(spark), ["S0", "S1", "S2", "S3"]
    each = kept(qp.likelihoods(spark, d))  # read for the joint calls and for the samples' columns
    calls = genotype.joint_genotypes(each, normals=["S0"]).join(qp.gvcf(spark, d).select("contig", "position", "ref", "alt"), ["contig", "position"], "left")
    writers.write_vcf(calls, path, genotypes=each, samples=samples, fields=("GT", "AD", "DP"), block_gzip=True)
    rows = readers.read_table(spark, f"{path}/*.bgz", f"{readers.VCF}, {', '.join(f'{s} string' for s in samples)}", header=False)
    return rows.select("contig", "position", "ref", "alt", *samples)


@query("k11_empty_annotation", "SELECT contig AS Chromosome, CAST(position AS VARCHAR) AS Start_Position, '' AS Hugo_Symbol, '' AS Protein_Change, ord FROM variants")
def _(spark, d):
    """A sample without annotated variants put together with one that has some: the columns are the empty table's."""
    some = view(spark, d, "variants").select(F.col("contig").alias("Chromosome"), F.col("position").cast("string").alias("Start_Position"), "ord")
    both = maf.merge(writers.empty_maf(spark), some)
    return both.select("Chromosome", "Start_Position", *(F.coalesce(c, F.lit("")).alias(c) for c in ("Hugo_Symbol", "Protein_Change")), "ord")


@query("k4_write_allelic_counts", f"WITH {qp.ONE}, {qp.GV} SELECT sample, contig, position, ref_count, alt_count, ref, alt FROM s0 JOIN gv USING (contig, position) WHERE ref_count + alt_count >= 20 AND regexp_matches(genotype, '0[/|]1|1[/|]0')")
def _(spark, d):
    path = scratch(spark)
    writers.write_allelic_counts(allelic.allelic_counts(qp.sites(spark, d), qp.gvcf(spark, d), min_depth=20, keys=qp.KEYS), path, ["sample"])
    return readers.read_table(spark, path, f"{readers.ALLELIC_COUNTS}, sample string")


_TAU = catalog.SQL["a14_genotype_concordance"]
_PAIR = ", ".join(f"coalesce(max(tau) FILTER (other = {s!r}), -1) AS {s}" for s in qi.SAMPLES)


@query("k6_sample_correlation", f"SELECT sample, {_PAIR} FROM (SELECT sample_a AS sample, sample_b AS other, tau FROM ({_TAU}) UNION ALL SELECT sample_b, sample_a, tau FROM ({_TAU}) UNION ALL SELECT s, s, 1000000 FROM (VALUES {', '.join(f'({s!r})' for s in qi.SAMPLES)}) AS t(s)) GROUP BY sample")
def _(spark, d):
    matrix = writers.correlation_matrix(genotype.concordance(qp.likelihoods(spark, d)), qi.SAMPLES)
    return matrix.select("sample", *(F.coalesce(scaled(F.col(s)), F.lit(-1)).alias(s) for s in qi.SAMPLES))


@query("k7_write_likelihoods", f"WITH {qp.GL} SELECT sample, contig, position, {qp.ALL_LN99} FROM gl")
def _(spark, d):
    path = scratch(spark)
    writers.write_likelihoods(qp.likelihoods(spark, d), path)
    rows = readers.read_table(spark, path, f"{readers.PILEUP}, {', '.join(f'{g} double' for g in genotype.GENOTYPES)}, sample string")
    return qp.ln99(rows.select("sample", "contig", "position", *genotype.GENOTYPES))


@query("k8_write_acs", f"WITH {qp.ACS} SELECT sample, contig, start, stop, coalesce({qp.SCALED.format('f')}, -1) AS f, {qp.SCALED.format('tau')} AS tau FROM acs")
def _(spark, d):
    path = scratch(spark)
    writers.write_acs(qp._acs(spark, d).select("sample", "contig", "start", "stop", "tau", "f"), path)
    rows = readers.read_table(spark, path, "contig string, start long, stop long, tau double, f double, sample string")
    return rows.select("sample", "contig", "start", "stop", F.when(F.isnan("f"), -1).otherwise(scaled(F.col("f"))).alias("f"), scaled(F.col("tau")).alias("tau"))


_E6 = catalog.SQL["e6_map_to_absolute"]


def _absolute_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    out = absolute_cn.map_to_absolute(qp._absolute(spark, d), qp._acs(spark, d).select(*absolute_cn.KEYS, "length", "tau", "sigma_tau"), 0.7, 3.1, "XY")
    return writers.absolute_tables(out)


@query("k9_rescued_intervals", f"SELECT sample, contig, start, stop FROM ({_E6}) WHERE is_rescued")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(_absolute_tables(spark, d)["rescued"], path, ["sample"], ["contig", "start"])
    return readers.read_table(spark, path, f"{readers.INTERVALS}, sample string")


@query("k9_igv_segments", f"SELECT sample, contig, start, stop, segment_mean, rescaled_total_cn FROM ({_E6})")
def _(spark, d):
    return _absolute_tables(spark, d)["igv"].withColumns({c: scaled(F.col(c)) for c in ("segment_mean", "rescaled_total_cn")})


@query("k9_completed_segtab", f"SELECT sample, contig, start, stop, corrected_total_cn, total_amp FROM ({_E6})")
def _(spark, d):
    return _absolute_tables(spark, d)["completed"].select("sample", "contig", "start", "stop", scaled(F.col("corrected_total_cn")).alias("corrected_total_cn"), "total_amp")


_TYPES = "CASE ord % 5 WHEN 0 THEN 'SNP' WHEN 1 THEN 'DNP' WHEN 2 THEN 'INS' WHEN 3 THEN 'DEL' ELSE 'OTHER' END"


@query("k10_write_split_maf", f"SELECT ord, CASE WHEN ord % 5 < 2 THEN 'snv' ELSE 'indel' END AS maf_class FROM variants WHERE ord % 5 < 4")
def _(spark, d):
    path = scratch(spark)
    writers.write_split_maf(view(spark, d, "variants").select("ord", F.expr(_TYPES).alias("variant_type")), path)
    return spark.read.schema("ord long, variant_type string, maf_class string").option("sep", "\t").option("header", True).csv(path).select("ord", "maf_class")


@query("v9_maf_prepare", "SELECT ord, CASE WHEN ord % 5 < 2 THEN 'snv' ELSE 'indel' END AS maf_class FROM variants WHERE ord % 5 < 4")
def _(spark, d):
    rows = view(spark, d, "variants").select("ord", F.expr(_TYPES).alias("variant_type"), F.repeat("info", 40).alias("wide"))
    return maf.with_class(maf.narrow_columns(rows, 1000)).drop("variant_type")  # the wide column goes


@query("k13_minor_af_segments", "SELECT sample, contig, start, stop, maf10 AS minor_allele_fraction FROM modeled_segments WHERE maf10 IS NOT NULL")
def _(spark, d):
    return writers.minor_af_segments(view(spark, d, "modeled_segments").withColumn("maf10", F.col("maf10").cast("string")))


# --- small operators -------------------------------------------------------------------------------------------
@query("p22_flag_shards", "SELECT ord, ord % 25 AS shard_id, ord % 25 IN (3, 7) AS skip FROM copy_ratios")
def _(spark, d):
    return cohort.flag_shards(view(spark, d, "copy_ratios").select("ord", (F.col("ord") % 25).alias("shard_id")), [3, 7])


@query("v3_total_alt_count", "SELECT ord, split_part(split_part(ad, '|', 1), ',', 2)::BIGINT + split_part(split_part(ad, '|', 2), ',', 2)::BIGINT AS tac FROM variants")
def _(spark, d):
    rows = view(spark, d, "variants").withColumns({"ad1": F.split("ad", r"\|")[0], "ad2": F.split("ad", r"\|")[1]})
    return variants.with_total_alt_count(rows, ["ad1", "ad2"]).select("ord", "tac")


@query("a4_strongest_signal", f"WITH {qi.LOCI} SELECT contig, start, stop, sample, log2_cr FROM loci")
def _(spark, d):
    return harmonize.harmonize_loci(qi.CR(spark, d), {"log2_cr": "strongest_signal"})


@query("d1_user_aggregate", f"WITH {qi.CUT} SELECT e.contig, e.start, e.stop, sample, max(ord) - min(ord) AS ord FROM el e JOIN copy_ratios c ON c.contig = e.contig AND c.start <= e.start AND c.stop > e.start GROUP BY ALL")
def _(spark, d):
    return harmonize.aggregate(qi.intervals.disjoin(qi.CR(spark, d).withColumn("at", F.col("ord")), ["contig"]), ["contig", "start", "stop", "sample"], {"ord": lambda v, o: F.max(v) - F.min(v)}, "at")


@query("d2_user_filters", "SELECT ord, CASE WHEN dp < 20 AND alt = 'A' THEN 'lowA;thin' WHEN dp < 20 THEN 'thin' WHEN alt = 'A' THEN 'lowA' ELSE 'PASS' END AS filter FROM variants")
def _(spark, d):
    rows = view(spark, d, "variants").withColumn("filter", F.lit("."))
    return variants.hard_filter(rows, {}, {"lowA": "alt = 'A'", "thin": "dp < 20"}).select("ord", "filter")


@query("d3_user_selection", "SELECT ord FROM variants WHERE dp > 20 AND ref <> alt")
def _(spark, d):
    return variants.select_variants(view(spark, d, "variants"), condition="dp > 20 AND ref <> alt").select("ord")


@query("w2_cnloh_triplets", f"WITH {qp.ACS}, {qp.LABEL.replace('< 0.08', '< 50')} SELECT sample, contig, start, stop FROM lab WHERE seg_label_cnloh = 0")
def _(spark, d):
    return acs.label_cnloh(qp._acs(spark, d), t=50.0).where("seg_label_cnloh = 0").select("sample", "contig", "start", "stop")


@query("o1_genomic_order", "SELECT contig, start, stop, row_number() OVER (ORDER BY CASE contig WHEN 'X' THEN 22 ELSE contig::INT - 1 END, start, stop) AS place FROM (SELECT DISTINCT contig, start, stop FROM targets)")
def _(spark, d):
    return dense_order(genomic_sort(view(spark, d, "targets").select("contig", "start", "stop").distinct(), "start", "stop"))


@query("o2_sorted_reads", "SELECT contig, start, ord, row_number() OVER (ORDER BY contig, start, ord) AS place FROM reads")
def _(spark, d):
    """Reads in coordinate order, with their places in the sorted table; contigs that no dictionary has come by name."""
    return dense_order(genomic_sort(view(spark, d, "reads").select("contig", "start", "ord"), "start", "ord"))


@query("o4_first_row_per_file", "SELECT sample, ord FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ord) AS r FROM copy_ratios) WHERE r = 1")
def _(spark, d):
    return cohort.first_row_per_file(view(spark, d, "copy_ratios"), "sample", "ord").select("sample", "ord")


@query("o5_in_input_order", "SELECT sample, contig, start FROM segments WHERE sample <> 'S3'")
def _(spark, d):
    asked = spark.createDataFrame([("S2", 0), ("S0", 1), ("S1", 2)], "sample string, input_ord int")
    return cohort.in_input_order(view(spark, d, "segments"), asked).select("sample", "contig", "start")


@query("u1_union_all", "SELECT contig, start, stop, score, NULL AS sample FROM targets UNION ALL SELECT contig, start, stop, NULL, sample FROM segments")
def _(spark, d):
    return maf.merge(view(spark, d, "targets"), view(spark, d, "segments").select("contig", "start", "stop", "sample"))


@query("t4_ploidy", "SELECT contig, CASE contig WHEN 'X' THEN 2 ELSE 2 END AS xx, CASE contig WHEN 'X' THEN 1 ELSE 2 END AS xy, CASE contig WHEN 'X' THEN 1 ELSE 2 END AS x, count(*) AS n FROM targets GROUP BY contig")
def _(spark, d):
    return view(spark, d, "targets").groupBy("contig").agg(F.count("*").alias("n")).withColumns({s.lower(): ploidy(F.col("contig"), F.lit(s)) for s in ("XX", "XY", "X")})


@query("t7_genotype_code", "SELECT ord, CASE genotype WHEN '0/0' THEN 0 WHEN '0/1' THEN 1 WHEN '1/1' THEN 2 ELSE -1 END AS code FROM variants")
def _(spark, d):
    return view(spark, d, "variants").select("ord", F.coalesce(genotype.genotype_code(F.col("genotype")), F.lit(-1)).alias("code"))


@query("t14_rescued", f"SELECT sample, contig, start, stop, rescaled_total_cn, total_amp, loh FROM ({_E6}) WHERE is_rescued")
def _(spark, d):
    out = absolute_cn.map_to_absolute(qp._absolute(spark, d), qp._acs(spark, d).select(*absolute_cn.KEYS, "length", "tau", "sigma_tau"), 0.7, 3.1, "XY")
    return out.where("is_rescued").select(*absolute_cn.KEYS, scaled(F.col("rescaled_total_cn")).alias("rescaled_total_cn"), "total_amp", "loh")


@query("h9_try_cast", "SELECT ord, coalesce(TRY_CAST(substr(info, 4, 2) AS BIGINT), -1) AS n FROM variants")
def _(spark, d):
    rows = view(spark, d, "variants").select("ord", F.substring("info", 4, 2).alias("n"))
    return absolute_cn.try_cast(rows, {"n": "long"}).na.fill(-1, ["n"])


@query("v5_partition_variants", "SELECT ord, coalesce(dp > 20, false) AS selected FROM variants")
def _(spark, d):
    return variants.partition_variants(view(spark, d, "variants"), F.col("dp") > 20).select("ord", "selected")


_AF = "SELECT contig, position, ref, alt, pow(10.0::DOUBLE, -TRY_CAST(nullif(regexp_extract(info, 'POPAF=([0-9]+)', 1), '') AS DOUBLE)) AS af, ord FROM variants WHERE filter IN ('PASS', '.')"


@query("v10_common_resource", f"SELECT contig, position, ref, alt, CAST(floor(af * 1e9 + 0.5) AS BIGINT) AS af FROM (SELECT *, row_number() OVER (PARTITION BY contig, position ORDER BY k, ref, alt) AS r FROM (SELECT *, ord % 2 AS k, ord % 37 AS pos FROM ({_AF})) WHERE af > CASE k WHEN 0 THEN 0.05 ELSE 0.0005 END) WHERE r = 1")
def _(spark, d):
    rows = view(spark, d, "variants")
    out = variants.common_resource([(rows.where("ord % 2 = 0"), 0.05), (rows.where("ord % 2 = 1"), 0.0005)])
    return out.select("contig", "position", "ref", "alt", scaled(F.col("af"), 10**9).alias("af"))


@query("a20_loci_progress", f"WITH RECURSIVE {qi.LOCI}, {qi.COMMON}, {qi.fold_sql(f'SELECT contig, start, stop, {qi._cells("log2_cr")} FROM loci SEMI JOIN common USING (contig, start, stop) GROUP BY contig, start, stop', 'contig', 4)} SELECT 'loci' AS step, count(*) AS loci FROM common UNION ALL SELECT 'merged', count(*) FROM fold_out UNION ALL SELECT 'long', count(*) FROM fold_out WHERE stop - start + 1 >= 2")
def _(spark, d):
    progress: dict = {}
    harmonize.harmonize(qi.CR(spark, d), {"log2_cr": "strongest_signal"}, qi.SAMPLES, minimum=2, progress=progress).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(step, progress[step].get["loci"]) for step in ("loci", "merged", "long")], "step string, loci long")
