"""Queries that write a table and read it back, in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..sources import readers, writers
from ..sources.scratch import shared_path
from .q_pileups import C3, MERGED, merged
from .views import view


def scratch(spark: SparkSession) -> str:
    return shared_path(spark, "text")


@query("k1_write_pileups", f"WITH {MERGED} SELECT sample, contig, position, {C3}, allele_frequency FROM merged")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(merged(spark, d).select("sample", "contig", "position", *C3.split(", "), "allele_frequency"), path, by=["sample"], compression="gzip")
    return spark.read.schema(f"{readers.PILEUP}, sample string").option("sep", "\t").option("header", True).csv(path)


@query("s1_read_pileup", f"WITH {MERGED} SELECT sample, contig, position, {C3}, allele_frequency FROM merged")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(merged(spark, d).select("contig", "position", *C3.split(", "), "allele_frequency", "sample"), path, by=["sample"])
    return readers.read_table(spark, path, f"{readers.PILEUP}, sample string")


@query("s9_read_copy_ratios", "SELECT contig, start, stop, log2_cr FROM copy_ratios")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(view(spark, d, "copy_ratios").select("contig", "start", "stop", "log2_cr"), path, sort=["contig", "start"])
    return readers.read_copy_ratios(spark, path)


@query("s13_read_bed", "SELECT contig, start, stop FROM targets")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(view(spark, d, "targets").select("contig", (F.col("start") - 1).alias("start"), "stop"), path, sort=["contig", "start"])
    return readers.read_intervals(spark, path, bed=True)


@query("s7_read_vcf", "SELECT contig, position, ref, alt, filter, info FROM variants")
def _(spark, d):
    path = scratch(spark)
    columns = ("contig", "position", F.lit(".").alias("id"), "ref", "alt", F.lit(".").alias("qual"), "filter", "info", F.lit("GT").alias("format"))
    view(spark, d, "variants").select(*columns).write.option("sep", "\t").csv(path)
    return readers.read_vcf(spark, path).select("contig", "position", "ref", "alt", "filter", "info")


@query("s14_read_segtab", "SELECT contig, start, stop FROM targets")
def _(spark, d):
    path = scratch(spark)
    writers.write_table(view(spark, d, "targets").select("contig", "start", "stop"), path, sort=["contig", "start"])
    return readers.read_cast(spark, path, {"start": "long", "stop": "long", "other": "double"})
