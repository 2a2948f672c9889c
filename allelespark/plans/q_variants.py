"""Queries on variant tables and manifests."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions.maths import scaled
from ..functions.vcf import depths, filter_tags, info_number, popaf_to_af, total_alt_count
from ..operators import cohort, maf, variants
from .views import view

V, TARGETS = (partial(view, name=n) for n in ("variants", "targets"))
INFO = "nullif(regexp_extract(info, '(^|;){}=([^;]*)', 2), '')"


def _num(key: str) -> str:
    return f"try_cast({INFO.format(key)} AS DOUBLE)"


def _part(key: str, i: int) -> str:
    return f"try_cast(split_part({INFO.format(key)}, ',', {i + 1}) AS DOUBLE)"


@query("p4_biallelic_snv", "SELECT contig, position, ref, alt, ord FROM (SELECT *, count(*) OVER (PARTITION BY contig, position) AS n FROM variants WHERE length(ref) = 1 AND length(alt) = 1) WHERE n = 1")
def _(spark, d):
    return variants.biallelic_snvs(V(spark, d)).select("contig", "position", "ref", "alt", "ord")


_TAGS = "string_split(filter, ';')"


@query("p10_select_somatic", f"SELECT ord FROM variants WHERE len(list_filter({_TAGS}, lambda t: t NOT IN ('PASS', 'normal_artifact'))) = 0")
def _(spark, d):
    return V(spark, d).where(variants.somatic(F.col("filter"))).select("ord")


@query("p11_select_germline", f"SELECT ord FROM variants WHERE list_contains({_TAGS}, 'germline') AND len(list_filter({_TAGS}, lambda t: t NOT IN ('germline', 'normal_artifact', 'panel_of_normals'))) = 0")
def _(spark, d):
    return V(spark, d).where(variants.germline(F.col("filter"))).select("ord")


_FLAGS = [("lowDP", _num("DP"), 10), ("lowTAC", _num("TAC"), 3), ("lowMBQ.0", _part("MBQ", 0), 20), ("lowMBQ.1", _part("MBQ", 1), 20), ("germline", _num("POPAF"), 3)]
_FAILED = " || ".join(f"CASE WHEN coalesce({x} < {n}, false) THEN ['{k}'] ELSE []::VARCHAR[] END" for k, x, n in _FLAGS)


@query("p12_hard_filter", f"SELECT ord, CASE WHEN len(f) = 0 THEN 'PASS' ELSE array_to_string(f, ';') END AS filter FROM (SELECT ord, a || list_filter(b, lambda t: NOT list_contains(a, t)) AS f FROM (SELECT ord, list_filter({_TAGS}, lambda t: t <> 'PASS') AS a, {_FAILED} || CASE WHEN position % 50 = 0 THEN ['edge'] ELSE []::VARCHAR[] END AS b FROM variants))")
def _(spark, d):
    return variants.hard_filter(V(spark, d), more={"edge": "position % 50 = 0"}).select("ord", "filter")


@query("p13_select_variants", f"SELECT ord FROM variants v SEMI JOIN targets t ON t.contig = v.contig AND v.position BETWEEN t.start AND t.stop WHERE {_num('GERMQ')} > 30")
def _(spark, d):
    rows = V(spark, d).withColumn("germq", info_number(F.col("info"), "GERMQ"))
    return variants.select_variants(rows, include=TARGETS(spark, d), kind="SNP", condition="germq > 30").select("ord")


@query("p15_split_snv_indel", "SELECT CASE WHEN p_partkey % 4 < 2 THEN 'snv' ELSE 'indel' END AS maf_class, count(*) AS n FROM part WHERE p_partkey % 5 <> 4 GROUP BY 1")
def _(spark, d):
    kinds = F.element_at(F.array(*map(F.lit, ("SNP", "ONP", "INS", "DEL"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = spark.read.parquet(f"{d}/part.parquet").select(F.when(F.col("p_partkey") % 5 == 4, "OTHER").otherwise(kinds).alias("variant_type"))
    return maf.with_class(rows).groupBy("maf_class").agg(F.count("*").alias("n"))


@query("p15_variant_classes", "SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN 'snv' ELSE 'indel' END AS maf_class FROM part WHERE p_partkey % 5 <> 4")
def _(spark, d):
    """Each row's class; types of neither go."""
    kinds = F.element_at(F.array(*map(F.lit, ("SNP", "ONP", "INS", "DEL"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.when(F.col("p_partkey") % 5 == 4, "OTHER").otherwise(kinds).alias("variant_type"))
    return maf.with_class(rows).select("p_partkey", "maf_class")


@query("p17_pass_only", "SELECT contig, position, ref, alt FROM variants WHERE filter = 'PASS'")
def _(spark, d):
    return V(spark, d).where("filter = 'PASS'").select(*variants.ALLELE)


@query("p18_af_only", f"SELECT contig, position, ref, alt, CAST(floor(coalesce(pow(10::DOUBLE, -{_num('POPAF')}), 7e-8) * 1e9 + 0.5) AS BIGINT) AS af FROM variants WHERE filter = 'PASS' AND coalesce(pow(10::DOUBLE, -{_num('POPAF')}), 7e-8) > 0.005")
def _(spark, d):
    return variants.af_only(V(spark, d), 0.005).withColumn("af", scaled(F.col("af"), 10**9))


@query("t15_popaf_to_af", f"SELECT ord, CAST(floor(coalesce(pow(10::DOUBLE, -{_num('POPAF')}), 7e-8) * 1e9 + 0.5) AS BIGINT) AS af FROM variants")
def _(spark, d):
    return V(spark, d).select("ord", scaled(popaf_to_af(info_number(F.col("info"), "POPAF")), 10**9).alias("af"))


_AD0 = "split_part(ad, '|', 1)"
_R, _A = f"split_part({_AD0}, ',', 1)::BIGINT", f"split_part({_AD0}, ',', 2)::BIGINT"


@query("t16_vcf_to_pileup", f"SELECT sample, contig, position, {_R} AS ref_count, {_A} AS alt_count, greatest(dp - {_R} - {_A}, 0) AS other_alt_count FROM variants")
def _(spark, d):
    rows = V(spark, d).withColumn("ad", F.split("ad", r"\|")[0])
    return variants.vcf_to_pileup(rows).drop("allele_frequency")


@query("h6_total_alt_count", f"SELECT ord, {_A} + split_part(split_part(ad, '|', 2), ',', 2)::BIGINT AS tac FROM variants")
def _(spark, d):
    return V(spark, d).select("ord", total_alt_count(F.transform(F.split("ad", r"\|"), depths)).alias("tac"))


@query("h7_filter_tags", f"SELECT t AS tag, count(*) AS n FROM (SELECT unnest({_TAGS}) AS t FROM variants) GROUP BY t")
def _(spark, d):
    return V(spark, d).select(F.explode(filter_tags(F.col("filter"))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("h8_info_map", f"SELECT ord, coalesce({_num('DP')}, -1) AS dp, coalesce({_num('POPAF')}, -1) AS popaf, coalesce({_part('MBQ', 1)}, -1) AS mbq FROM variants")
def _(spark, d):
    number = lambda *a: F.coalesce(info_number(F.col("info"), *a), F.lit(-1.0))
    return V(spark, d).select("ord", number("DP").alias("dp"), number("POPAF").alias("popaf"), number("MBQ", 1).alias("mbq"))


@query("a24_panel_of_normals", "SELECT contig, position, ref, alt, count(DISTINCT sample) AS n_samples FROM (SELECT contig, ord % 5 AS position, ref, alt, CAST(floor(ord / 7) AS BIGINT) % 4 AS sample FROM variants) GROUP BY ALL HAVING count(DISTINCT sample) >= 2")
def _(spark, d):
    return variants.panel_of_normals(V(spark, d).withColumns({"position": F.col("ord") % 5, "sample": F.floor(F.col("ord") / 7) % 4}))


@query("a19_count_variants", f"SELECT count(*) FILTER (g > 30) AS n_selected, count(*) FILTER (NOT coalesce(g > 30, false)) AS n_not_selected FROM (SELECT {_num('GERMQ')} AS g FROM variants)")
def _(spark, d):
    return variants.count_selected(variants.partition_variants(V(spark, d), info_number(F.col("info"), "GERMQ") > 30))


@query("j14_discordance", "SELECT ord FROM variants v WHERE NOT EXISTS (SELECT 1 FROM variants w WHERE w.filter = 'PASS' AND w.contig = v.contig AND w.position = v.position AND w.ref = v.ref AND w.alt = v.alt)")
def _(spark, d):
    return variants.not_selected(V(spark, d), V(spark, d).where("filter = 'PASS'")).select("ord")


@query("u2_gather_vcfs", "SELECT DISTINCT contig, position, ref, alt FROM variants")
def _(spark, d):
    shards = [V(spark, d).where(F.col("ord") % 3 == k) for k in range(3)]
    return variants.gather(*shards, shards[0]).select(*variants.ALLELE)


@query("u3_merge_force_call_alleles", "SELECT DISTINCT contig, position, ref, alt FROM variants v WHERE filter = 'PASS' OR (ord % 2 = 0 AND EXISTS (SELECT 1 FROM targets t WHERE t.contig = v.contig AND v.position BETWEEN t.start AND t.stop))")
def _(spark, d):
    return variants.force_call_alleles(V(spark, d), V(spark, d).where("ord % 2 = 0"), TARGETS(spark, d))


@query("u5_merge_variant_resources", "SELECT contig, position, ref, alt, ord FROM (SELECT *, row_number() OVER (PARTITION BY contig, position ORDER BY ord % 2, ref, alt, ord) AS r FROM variants) WHERE r = 1")
def _(spark, d):
    rows = V(spark, d)
    return variants.merge_resources(rows.where("ord % 2 = 0"), rows.where("ord % 2 = 1")).select(*variants.ALLELE, "ord")


@query("v1_split_multiallelic", "SELECT ord, unnest([alt, 'T']) AS alt, unnest([split_part(ad, ',', 1) || ',' || '7', split_part(ad, ',', 1) || ',' || '9']) AS ad FROM variants")
def _(spark, d):
    rows = V(spark, d).withColumns({"alt": F.concat("alt", F.lit(",T")), "ad": F.concat(F.split("ad", ",")[0], F.lit(",7,9"))})
    return variants.split_multiallelic(rows).select("ord", "alt", "ad")


@query("v2_trim_alleles", "SELECT ord, position + 2 AS position, CASE WHEN ref = alt THEN 'A' ELSE ref || 'A' END AS ref, CASE WHEN ref = alt THEN 'G' ELSE alt || 'G' END AS alt FROM (SELECT ord, position + CASE WHEN ref = alt THEN 1 ELSE 0 END AS position, ref, alt FROM variants)")
def _(spark, d):
    rows = V(spark, d).withColumns({"ref": F.concat(F.lit("CC"), "ref", F.lit("ATT")), "alt": F.concat(F.lit("CC"), "alt", F.lit("GTT"))})
    return variants.trim_alleles(rows).select("ord", "position", "ref", "alt")


@query("v7_rare_germline", f"SELECT sample, contig, position FROM variants v WHERE list_contains({_TAGS}, 'germline') AND len(list_filter({_TAGS}, lambda t: t NOT IN ('germline', 'normal_artifact', 'panel_of_normals'))) = 0 AND NOT EXISTS (SELECT 1 FROM targets t WHERE t.contig = v.contig AND t.start = v.position)")
def _(spark, d):
    common = TARGETS(spark, d).select("contig", F.col("start").alias("position"))
    return variants.rare_germline(V(spark, d), common).select("sample", "contig", "position")


@query("v8_rename_samples", "SELECT CASE sample WHEN 'S0' THEN 'normal' WHEN 'S1' THEN 'tumor' ELSE sample END AS sample, count(*) AS n FROM variants GROUP BY 1")
def _(spark, d):
    names = spark.createDataFrame([("S0", "normal"), ("S1", "tumor")], "bam_name string, sample_name string")
    return variants.rename_samples(V(spark, d).select("sample"), names).groupBy("sample").agg(F.count("*").alias("n"))


@query("v8_renamed_rows", "SELECT ord, CASE sample WHEN 'S0' THEN 'normal' WHEN 'S1' THEN 'tumor' ELSE sample END AS sample FROM variants")
def _(spark, d):
    names = spark.createDataFrame([("S0", "normal"), ("S1", "tumor")], "bam_name string, sample_name string")
    return variants.rename_samples(V(spark, d).select("ord", "sample"), names).select("ord", "sample")


@query("j21_annotate_features", "SELECT contig, position, ref, alt, coalesce(start, -1) AS feature_start FROM (SELECT v.contig, v.position, v.ref, v.alt, t.start, row_number() OVER (PARTITION BY v.contig, v.position, v.ref, v.alt ORDER BY t.score DESC NULLS LAST, t.start NULLS LAST) AS r FROM variants v LEFT JOIN targets t ON t.contig = v.contig AND v.position BETWEEN t.start AND t.stop) WHERE r = 1")
def _(spark, d):
    out = variants.annotate_features(V(spark, d).select(*variants.ALLELE), TARGETS(spark, d), [F.col("score").desc_nulls_last(), F.col("feature_start").asc_nulls_last()])
    return out.select(*variants.ALLELE, F.coalesce("feature_start", F.lit(-1)).alias("feature_start"))


_MANIFEST = "m AS (SELECT concat('P', CAST(c_custkey % 50 AS VARCHAR)) AS patient, concat('s', CAST(c_custkey AS VARCHAR)) AS sample, c_custkey AS input_ord, c_custkey % 3 = 0 AS normal, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS seg FROM customer)"


def manifest(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("P"), (key % 50).cast("string")).alias("patient"), F.concat(F.lit("s"), key.cast("string")).alias("sample"), key.alias("input_ord"), (key % 3 == 0).alias("normal"), F.when(key % 4 != 0, F.col("c_name")).alias("seg"))


def split(spark: SparkSession, d: str) -> DataFrame:
    rows = manifest(spark, d)
    return cohort.tumor_normal(rows.drop("normal"), rows.where("normal").select("patient", "sample"))


@query("p19_tumor_normal_split", f"WITH {_MANIFEST} SELECT patient, sample, NOT normal AS is_tumor FROM m")
def _(spark, d):
    return split(spark, d).select("patient", "sample", "is_tumor")


@query("p20_matched_normal", f"WITH {_MANIFEST} SELECT patient, arg_min(sample, input_ord) AS matched_normal FROM m WHERE normal GROUP BY patient")
def _(spark, d):
    return cohort.matched_normal(split(spark, d))


@query("j18_tumor_with_matched_normal", f"WITH {_MANIFEST}, n AS (SELECT patient, arg_min(sample, input_ord) AS matched_normal, arg_min(coalesce(seg, 'none'), input_ord) AS normal_seg FROM m WHERE normal GROUP BY patient) SELECT sample, coalesce(matched_normal, '') AS matched_normal, coalesce(normal_seg, '') AS normal_seg FROM m LEFT JOIN n USING (patient) WHERE NOT normal")
def _(spark, d):
    rows = split(spark, d).withColumn("seg", F.coalesce("seg", F.lit("none")))
    out = cohort.with_matched_normal(rows, ["seg"])
    return out.select("sample", *(F.coalesce(c, F.lit("")).alias(c) for c in ("matched_normal", "normal_seg")))


@query("p21_usable_runs", f"WITH {_MANIFEST} SELECT sample FROM m WHERE normal AND seg IS NOT NULL")
def _(spark, d):
    return cohort.usable_runs(manifest(spark, d), "normal", "seg").select("sample")


@query("p23_coalesce_update", f"WITH {_MANIFEST} SELECT sample, coalesce(CASE WHEN input_ord % 2 = 0 AND input_ord % 6 <> 0 THEN 'new' END, seg, '') AS seg FROM m")
def _(spark, d):
    old = manifest(spark, d).select("sample", "seg")
    new = manifest(spark, d).where("input_ord % 2 = 0").select("sample", F.when(F.col("input_ord") % 6 != 0, "new").alias("seg"))
    return cohort.coalesce_update(old, new, ["sample"]).select("sample", F.coalesce("seg", F.lit("")).alias("seg"))


@query("j20_group_runs", f"WITH {_MANIFEST} SELECT patient, count(*) AS n_runs, min(input_ord) AS first_ord FROM m GROUP BY patient")
def _(spark, d):
    rows = cohort.group_runs(manifest(spark, d).withColumn("sample", F.col("patient")), ["input_ord", "seg"])
    return rows.select("patient", F.size("runs").cast("long").alias("n_runs"), F.col("runs")[0]["input_ord"].alias("first_ord"))


@query("j19_name_conflicts", "SELECT sample, array_to_string(list_sort(list(DISTINCT bam)), ',') AS bam_names, min(bam) AS bam_name FROM (SELECT c_mktsegment AS sample, concat('b', CAST(c_custkey % 2 AS VARCHAR)) AS bam FROM customer) GROUP BY sample HAVING count(DISTINCT bam) > 1")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet").selectExpr("c_mktsegment AS sample", "concat('b', CAST(c_custkey % 2 AS STRING)) AS bam_name", "c_custkey")
    out = cohort.name_conflicts(rows.where("c_custkey % 3 = 0").drop("c_custkey"), rows.where("c_custkey % 3 <> 0").drop("c_custkey"))
    return out.withColumn("bam_names", F.array_join("bam_names", ","))


@query("k15_collect_artifacts", f"WITH {_MANIFEST} SELECT patient, count(seg) AS n, coalesce(arg_min(seg, input_ord) FILTER (seg IS NOT NULL), '') AS first_seg FROM m GROUP BY patient")
def _(spark, d):
    out = cohort.collect_artifacts(manifest(spark, d), ["seg"])
    return out.select("patient", F.coalesce(F.size("seg"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.col("seg")[0], F.lit("")).alias("first_seg")).withColumn("n", F.greatest("n", F.lit(0)))


@query("a25_merge_statistics", "SELECT l_returnflag AS statistic, sum(l_linenumber)::BIGINT AS value FROM lineitem GROUP BY 1")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_returnflag AS statistic", "CAST(l_linenumber AS BIGINT) AS value", "l_orderkey % 2 AS shard")
    return cohort.merge_statistics(rows.where("shard = 0").drop("shard"), rows.where("shard = 1").drop("shard"))


@query("p24_annotation_defaults", f"WITH {_MANIFEST} SELECT sample, coalesce(seg, 'unknown') AS seg, 'N1' AS normal_barcode FROM m")
def _(spark, d):
    return maf.with_annotations(manifest(spark, d), {"seg": "unknown"}, {"normal_barcode": "N1"}, ["patient", "input_ord", "normal"])


@query("p14_narrow_columns", "SELECT p_partkey, p_brand FROM part")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_brand", F.repeat("p_brand", 30).alias("wide"))
    return maf.narrow_columns(rows, 100)


@query("u4_merge_mafs", "SELECT ord, contig, position FROM variants")
def _(spark, d):
    rows = V(spark, d).select("ord", "contig", "position")
    return maf.merge(rows.where("ord % 2 = 0"), rows.where("ord % 2 = 1"))


_NEW = f"nf AS (SELECT ord, CASE WHEN len(f) = 0 THEN 'PASS' ELSE array_to_string(f, ';') END AS filter FROM (SELECT ord, a || list_filter(b, lambda t: NOT list_contains(a, t)) AS f FROM (SELECT ord, list_filter({_TAGS}, lambda t: t <> 'PASS') AS a, {_FAILED} AS b FROM variants)))"


@query("e8_filter_variants", f"WITH {_NEW} SELECT ord, filter, len(list_filter({_TAGS}, lambda t: t NOT IN ('PASS', 'normal_artifact'))) = 0 AS somatic, list_contains({_TAGS}, 'germline') AND len(list_filter({_TAGS}, lambda t: t NOT IN ('germline', 'normal_artifact', 'panel_of_normals'))) = 0 AS germline FROM nf")
def _(spark, d):
    from .pipelines import filter_variants

    return filter_variants(V(spark, d)).select("ord", "filter", "somatic", "germline")
