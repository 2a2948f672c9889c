"""Manifests of patients, samples and sequencing runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tumor_normal(samples: DataFrame, normals: DataFrame) -> DataFrame:
    """samples (patient, sample, ...) once each, with is_tumor: not among normals (patient, sample)."""
    named = normals.select("patient", "sample").distinct().withColumn("_normal", F.lit(True))
    return samples.dropDuplicates(["patient", "sample"]).join(named, ["patient", "sample"], "left").withColumn("is_tumor", F.col("_normal").isNull()).drop("_normal")


def matched_normal(samples: DataFrame, order: str = "input_ord") -> DataFrame:
    """patient, matched_normal: each patient's first normal sample."""
    return samples.where("NOT is_tumor").groupBy("patient").agg(F.min_by("sample", F.struct(order, "sample")).alias("matched_normal"))


def with_matched_normal(samples: DataFrame, artifacts: Sequence[str], order: str = "input_ord") -> DataFrame:
    """Tumour samples with their patient's matched normal's artifacts as normal_<name>; null without a normal."""
    normal = matched_normal(samples, order).join(samples.select("patient", F.col("sample").alias("matched_normal"), *(F.col(a).alias(f"normal_{a}") for a in artifacts)), ["patient", "matched_normal"])
    return samples.where("is_tumor").join(normal, "patient", "left")


def group_runs(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """patient, sample, runs: an ordered array of structs per sample (a sample has a handful of runs)."""
    return runs.groupBy("patient", "sample").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("runs"))


def coalesce_update(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with new's values where they are not null; columns that only one has stay."""
    keys = list(keys)
    both = [c for c in old.columns if c in new.columns and c not in keys]
    fresh = new.withColumnsRenamed({c: f"_{c}" for c in both})
    return old.join(fresh, keys, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in both}).drop(*(f"_{c}" for c in both))


def usable_runs(runs: DataFrame, gate: str, artifact: str) -> DataFrame:
    """Runs whose gate (use_for_tCR, use_for_aCR) is open and whose artifact exists."""
    return runs.where(F.col(gate) & F.coalesce(F.length(artifact) > 0, F.lit(False)))


def flag_shards(shards: DataFrame, skip: Sequence[int]) -> DataFrame:
    return shards.withColumn("skip", F.col("shard_id").isin(*skip) if skip else F.lit(False))


def name_conflicts(*named: DataFrame) -> DataFrame:
    """sample, bam_names, bam_name: samples whose files name different BAM samples; the first by name is meant."""
    out = named[0]
    for t in named[1:]:
        out = out.union(t)
    return out.groupBy("sample").agg(F.sort_array(F.collect_set("bam_name")).alias("bam_names"), F.min("bam_name").alias("bam_name")).where(F.size("bam_names") > 1)


def collect_artifacts(samples: DataFrame, artifacts: Sequence[str], order: str = "input_ord") -> DataFrame:
    """patient and an array per artifact, in input order, without missing ones; null if none is there."""
    each = lambda a: F.transform(F.sort_array(F.collect_list(F.when(F.col(a).isNotNull(), F.struct(order, F.col(a).alias("v"))))), lambda s: s["v"])
    rows = samples.groupBy("patient").agg(*(each(a).alias(a) for a in artifacts))
    return rows.withColumns({a: F.when(F.size(a) > 0, F.col(a)) for a in artifacts})


def in_input_order(df: DataFrame, samples: DataFrame, order: str = "input_ord") -> DataFrame:
    """df sorted as its samples were given."""
    return df.join(samples.select("sample", order), "sample").orderBy(order).drop(order)


def merge_statistics(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("statistic").agg(F.sum("value").alias("value"))


def first_row_per_file(rows: DataFrame, file: str, order: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(file).orderBy(order))).where("_r = 1").drop("_r")
