"""The cohort's chain: each of its results for two patients of two samples each, and what all of them hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions.maths import scaled
from ..operators import genotype
from . import q_intervals as qi
from . import q_pileups as qp
from . import q_variants as qv
from .pipelines import RESULTS, Cohort
from .views import view

#: patient, sample, input_ord, is_tumor, sex, purity, ploidy
MEMBERS = [("P0", "S0", 0, False, "XY", 1.0, 2.0), ("P0", "S1", 1, True, "XY", 0.7, 3.1), ("P1", "S2", 0, False, "XX", 0.95, 2.0), ("P1", "S3", 1, True, "XX", 0.55, 2.6)]
_PATIENT = "CASE WHEN sample IN ('S0', 'S1') THEN 'P0' ELSE 'P1' END"
_MEM = f"mem AS (SELECT * FROM (VALUES {', '.join(f'({s!r}, {purity}::DOUBLE, {ploidy}::DOUBLE)' for _, s, _, _, _, purity, ploidy in MEMBERS)}) AS t(sample, pu, pl))"


def of_patients(df: DataFrame) -> DataFrame:
    return df.withColumn("patient", F.when(F.col("sample").isin("S0", "S1"), "P0").otherwise("P1"))


def modeled(spark: SparkSession, d: str) -> DataFrame:
    """Segments where the copy ratios are, with values that add up without rounding."""
    k = F.col("ord")
    values = {"cr50": (k % 64 - 32) / 32, "cr10": (k % 64 - 34) / 32, "cr90": (k % 64 - 30) / 32, "maf50": k % 16 / 32, "maf10": k % 16 / 64, "maf90": k % 16 / 32 + 1 / 64}
    return view(spark, d, "copy_ratios").select("sample", "contig", "start", "stop", "call", "ord", *(v.alias(c) for c, v in values.items()))


def cohort_in(spark: SparkSession, d: str) -> Cohort:
    table = lambda name: of_patients(view(spark, d, name))
    segments = modeled(spark, d)
    solutions = segments.groupBy("sample", "contig", "start", "stop").agg(F.min("cr50").alias("c"))
    solutions = solutions.select("sample", "contig", "start", "stop", F.exp("c").alias("rescaled_total_cn"), (F.floor(F.exp("c") * 2) / 2).alias("corrected_total_cn"))
    return Cohort(
        members=spark.createDataFrame(MEMBERS, "patient string, sample string, input_ord int, is_tumor boolean, sex string, purity double, ploidy double"),
        reads=of_patients(view(spark, d, "reads").withColumn("sample", F.concat(F.lit("S"), (F.col("ord") % 4).cast("string")))),
        targets=qi.panel(spark, d), calls=table("variants").withColumn("ad", F.split("ad", r"\|")[0]),
        panel=view(spark, d, "targets").select("contig", F.col("start").alias("position"), F.lit("A").alias("ref"), F.lit("C").alias("alt")).distinct(),
        runs=table("pileup_runs"), segments=table("segments"), contaminations=table("contaminations"), ratios=table("copy_ratios"), modeled=of_patients(segments),
        solutions=of_patients(solutions), min_target=2, min_segment=2, min_probes=1, min_depth=4, max_depth=8,
    )


_READS = f"rg AS (SELECT *, {_PATIENT} AS patient FROM (SELECT *, concat('S', CAST(ord % 4 AS VARCHAR)) AS sample FROM good))"
_COUNTS = f"{qi.GOOD}, {_READS}, pn AS ({qi._PANEL}) SELECT patient, sample, r.contig, p.start, p.stop, count(*) AS count FROM rg r JOIN pn p ON r.contig = p.contig AND r.start BETWEEN p.start AND p.stop GROUP BY ALL"

_BY = "patient, sample, contig"
_CALLABLE = f"""{qi.GOOD}, {_READS}, ev AS (SELECT {_BY}, pt, sum(d) AS d FROM (SELECT {_BY}, start AS pt, 1 AS d FROM rg UNION ALL SELECT {_BY}, stop + 1, -1 FROM rg) GROUP BY ALL HAVING sum(d) <> 0),
dep AS (SELECT * FROM (SELECT {_BY}, pt AS start, lead(pt) OVER w - 1 AS stop, (sum(d) OVER (PARTITION BY {_BY} ORDER BY pt ROWS UNBOUNDED PRECEDING))::BIGINT AS depth FROM ev WINDOW w AS (PARTITION BY {_BY} ORDER BY pt)) WHERE depth > 0),
st AS (SELECT *, CASE WHEN depth < 4 THEN 'LOW_COVERAGE' WHEN depth > 8 THEN 'EXCESSIVE_COVERAGE' ELSE 'CALLABLE' END AS state FROM dep),
nw AS (SELECT *, CASE WHEN start = lag(stop) OVER w + 1 AND state = lag(state) OVER w THEN 0 ELSE 1 END AS nw FROM st WINDOW w AS (PARTITION BY {_BY} ORDER BY start)),
rn AS (SELECT *, sum(nw) OVER (PARTITION BY {_BY} ORDER BY start ROWS UNBOUNDED PRECEDING) AS k FROM nw) SELECT {_BY}, min(start) AS start, max(stop) AS stop, any_value(state) AS state FROM rn GROUP BY {_BY}, k"""

_GERMLINE = f"list_contains({qv._TAGS}, 'germline') AND len(list_filter({qv._TAGS}, lambda t: t NOT IN ('germline', 'normal_artifact', 'panel_of_normals'))) = 0"
_CALLS = f"{qv._NEW}, calls AS (SELECT * EXCLUDE (old), {_PATIENT} AS patient FROM (SELECT v.* RENAME (filter AS old), nf.filter FROM variants v JOIN nf USING (ord)))"
_VARIANTS = f"{_CALLS} SELECT patient, sample, ord, filter, len(list_filter({qv._TAGS}, lambda t: t NOT IN ('PASS', 'normal_artifact'))) = 0 AS somatic, {_GERMLINE} AS germline FROM calls"

_C3 = qp.C3.split(", ")
_SUMS = ", ".join(f"sum({c})::BIGINT AS {c}" for c in _C3)
_ALLELES = f"""{_CALLS}, gx AS (SELECT * FROM calls WHERE {_GERMLINE}), pan AS (SELECT DISTINCT contig, start AS position, 'A' AS ref, 'C' AS alt FROM targets),
rar AS (SELECT patient, contig, position, ref, alt FROM (SELECT *, row_number() OVER (PARTITION BY patient, contig, position ORDER BY ref, alt) AS r FROM gx ANTI JOIN pan USING (contig, position)) WHERE r = 1),
alle AS (SELECT p.patient, pan.* FROM pan, (VALUES ('P0'), ('P1')) AS p(patient) UNION ALL SELECT patient, contig, position, ref, alt FROM rar)"""
_MERGED = f"""{_ALLELES}, {qp.MERGED.replace("merged AS", "merged0 AS", 1)},
rare AS (SELECT sample, contig, position, {qv._R} AS ref_count, {qv._A} AS alt_count, greatest(dp - {qv._R} - {qv._A}, 0) AS other_alt_count, coalesce(pow(10::DOUBLE, -{qv._num('POPAF')}), 7e-8) AS allele_frequency FROM gx ANTI JOIN pan USING (contig, position)),
merged AS (SELECT sample, contig, position, {_SUMS}, max(allele_frequency) AS allele_frequency FROM (SELECT *, row_number() OVER (PARTITION BY k, sample, contig, position ORDER BY {qp.C3}) AS r, {_PATIENT} AS patient FROM (SELECT 1 AS k, * FROM merged0 UNION ALL SELECT 2, * FROM rare)) SEMI JOIN alle USING (patient, contig, position) WHERE r = 1 GROUP BY sample, contig, position)"""
_PILEUPS = f"{_MERGED} SELECT {_PATIENT} AS patient, sample, contig, position, {qp.C3}, CAST(floor(allele_frequency * 1e9 + 0.5) AS BIGINT) AS allele_frequency FROM merged"

_MALE_X = "contig = 'X' AND sample IN ('S0', 'S1')"
_GL = qp.GL.replace(qp.MERGED, _MERGED).replace("CASE WHEN m.contig = 'X' THEN 1 ELSE 2 END", "CASE WHEN m.contig = 'X' AND m.sample IN ('S0', 'S1') THEN 1 ELSE 2 END")
_JOINT = qp.JOINT.replace("SELECT contig, position, sum", "SELECT patient, contig, position, sum").replace("GROUP BY contig, position", "GROUP BY patient, contig, position").replace("CASE sample WHEN 'S0' THEN", f"{_PATIENT} AS patient, CASE WHEN sample IN ('S0', 'S2') THEN")
_GENOTYPED = f"{_GL}, {_JOINT}, gt AS (SELECT *, {qp.BEST} AS genotype FROM joint WHERE {qp.CONF} AND greatest(gl_ref, gl_het, gl_alt) >= 0.9 * (gl_ref + gl_het + gl_alt))"
_GENOTYPES = f"{_GENOTYPED} SELECT patient, contig, position, {qp.C3}, genotype, {qp.ALL_LN99} FROM gt"

_HETS = f"{_GENOTYPED}, hets AS (SELECT m.patient, m.sample, contig, position, m.ref_count, m.alt_count, ref, alt FROM (SELECT *, {_PATIENT} AS patient FROM merged) m JOIN gt USING (patient, contig, position) JOIN alle USING (patient, contig, position) WHERE genotype = '0/1')"
_ALLELIC = f"{_HETS} SELECT patient, sample, contig, position, ref_count, alt_count, ref, alt FROM hets"

# a patient's contig is a contig of its own
_OWN = "concat(patient, '/', contig)"
_PCR = f"pcr AS (SELECT * REPLACE ({_OWN} AS contig) FROM (SELECT *, {_PATIENT} AS patient FROM copy_ratios))"
_BOTH = "count(DISTINCT sample) = 2"
_PAIR = {0: "('S0', 'S2')", 1: "('S1', 'S3')"}
_LOCI = f"{_PCR}, {qi.LOCI.replace('copy_ratios', 'pcr')}, {qi.COMMON.replace('count(DISTINCT sample) = 4', _BOTH)}"


def _cells(value: str, first: int = 0) -> str:
    return ", ".join(f"max({value}) FILTER (sample IN {_PAIR[i]}) AS v{first + i}" for i in _PAIR)


def _long(values: dict[str, str]) -> str:
    name = lambda i: f"CASE split_part(contig, '/', 1) WHEN 'P0' THEN 'S{i}' ELSE 'S{i + 2}' END"
    return " UNION ALL ".join(f"SELECT split_part(contig, '/', 1) AS patient, {name(i)} AS sample, split_part(contig, '/', 2) AS contig, start, stop, {', '.join(f'{v[i]} AS {c}' for c, v in values.items())} FROM fold_out WHERE stop - start + 1 >= 2" for i in _PAIR)


_COMMON_ROWS = f"SELECT contig, start, stop, {_cells('log2_cr')} FROM loci SEMI JOIN common USING (contig, start, stop) GROUP BY contig, start, stop"
_HARMONIZED = f"RECURSIVE {_LOCI}, {qi.fold_sql(_COMMON_ROWS, 'contig', 2)} {_long({'log2_cr': ('v0', 'v1')})}"

_VALUES = {"cr10": "(ord % 64 - 34) / 32.0::DOUBLE", "cr50": "(ord % 64 - 32) / 32.0::DOUBLE", "cr90": "(ord % 64 - 30) / 32.0::DOUBLE", "maf10": "ord % 16 / 64.0::DOUBLE", "maf50": "ord % 16 / 32.0::DOUBLE", "maf90": "ord % 16 / 32.0::DOUBLE + 0.015625"}
_MLOCI = f"""{_PCR}, {qi.CUT.replace('copy_ratios', 'pcr')}, loci AS (SELECT e.contig, e.start, e.stop, sample, arg_min(call, ord) AS call, {', '.join(f'avg({v}) AS {c}' for c, v in _VALUES.items())} FROM el e JOIN pcr c ON c.contig = e.contig AND c.start <= e.start AND c.stop > e.start GROUP BY ALL),
{qi.COMMON.replace('count(DISTINCT sample) = 4', _BOTH)}, stays AS (SELECT * FROM common ANTI JOIN (SELECT contig, start, stop FROM loci WHERE sample IN {_PAIR[0]} AND call IN ('+', '-')) USING (contig, start, stop))"""
_M_ROWS = f"SELECT contig, start, stop, {', '.join(_cells(c, 2 * i) for i, c in enumerate(_VALUES))} FROM loci SEMI JOIN stays USING (contig, start, stop) GROUP BY contig, start, stop"
_SEG7 = f"""RECURSIVE {_HETS}, {_MLOCI}, {qi.fold_sql(_M_ROWS, 'contig', 12)}, mrg AS ({_long({c: (f'v{2 * i}', f'v{2 * i + 1}') for i, c in enumerate(_VALUES)})}),
seg7 AS (SELECT m.*, (SELECT count(*) FROM copy_ratios c WHERE c.sample = m.sample AND c.contig = m.contig AND c.start BETWEEN m.start AND m.stop) AS n_probes, (SELECT count(*) FROM hets p WHERE p.sample = m.sample AND p.contig = m.contig AND p.position BETWEEN m.start AND m.stop) AS n_hets FROM mrg m)"""
_SCALED_VALUES = ", ".join(f"{qp.SCALED.format(c)} AS {c}" for c in _VALUES)
_SEGMENTS = f"{_SEG7} SELECT patient, sample, contig, start, stop, n_probes, n_hets, {_SCALED_VALUES} FROM seg7"

_ACS7 = f"{_SEG7}, {qp.ACS.replace('modeled_segments', 'seg7').replace("contig = 'X'", _MALE_X)}, {qp.LABEL}, least1 AS (SELECT * FROM acs JOIN (SELECT sample, contig, start, stop, seg_label_cnloh FROM lab) USING (sample, contig, start, stop) WHERE n_probes >= 1)"
_ACS_OUT = ", ".join(f"coalesce({qp.SCALED.format(c)}, -1) AS {c}" for c in qp._ACS_OUT)
_ACS = f"{_ACS7} SELECT {_PATIENT} AS patient, sample, contig, start, stop, n_probes, n_hets, length, seg_label_cnloh, {_ACS_OUT} FROM least1"

_AB = f"ab AS (SELECT sample, contig, start, stop, exp(min({_VALUES['cr50']})) AS rescaled_total_cn, floor(exp(min({_VALUES['cr50']})) * 2) / 2 AS corrected_total_cn FROM copy_ratios GROUP BY sample, contig, start, stop)"
_ABS = (
    _AB + qp.ABS[qp.ABS.index(",\njs AS") :].replace("JOIN acs USING", "JOIN least1 USING").replace("pc AS (SELECT 0.7::DOUBLE * 3.1 + 2 * (1 - 0.7::DOUBLE) AS d0)", "pc AS (SELECT sample AS ps, pu, pl, pu * pl + 2 * (1 - pu) AS d0 FROM mem)")
).replace("FROM js, pc", "FROM js JOIN pc ON ps = sample").replace("SELECT js.*,", "SELECT js.*, pl,").replace("0.7::DOUBLE", "pu").replace("contig = 'X'", _MALE_X)
_ABSOLUTE = f"""{_ACS7}, {_MEM}, {_ABS}, {qp.CLUSTER}, r AS (SELECT *, corrected_total_cn IS NULL OR rescaled_total_cn IS NULL AS is_rescued FROM c3), s AS (SELECT *, CASE WHEN is_rescued THEN cn ELSE rescaled_total_cn END AS rt, CASE WHEN is_rescued THEN corrected_cn ELSE corrected_total_cn END AS ct FROM r)
SELECT {_PATIENT} AS patient, sample, contig, start, stop, is_rescued, {qp.SCALED.format('rt')} AS rescaled_total_cn, {qp.SCALED.format('ct')} AS corrected_total_cn, (rt >= 7)::INT AS total_amp, {qp.SCALED.format(f'log2(greatest(rt, 0.01)) - log2(pl) + CASE WHEN {_MALE_X} THEN 1 ELSE 0 END')} AS segment_mean FROM s"""


def shown(name: str, df: DataFrame) -> DataFrame:
    """A result's columns, doubles as whole numbers, as its SQL gives them."""
    key = ["patient", "sample", "contig", "start", "stop"]
    if name == "variants":
        return df.select("patient", "sample", "ord", "filter", "somatic", "germline")
    if name == "pileups":
        return df.select("patient", "sample", "contig", "position", *_C3, scaled(F.col("allele_frequency"), 10**9).alias("allele_frequency"))
    if name == "genotypes":
        return qp.ln99(df.select("patient", "contig", "position", *_C3, "genotype", *genotype.GENOTYPES))
    if name == "filtered_segments":
        return df.select(*key, "n_probes", "n_hets", *(scaled(F.col(c)).alias(c) for c in _VALUES))
    if name == "acs":
        return df.select(*key, "n_probes", "n_hets", "length", "seg_label_cnloh", *(F.coalesce(scaled(F.col(c)), F.lit(-1)).alias(c) for c in qp._ACS_OUT))
    if name == "absolute":
        return df.select(*key, "is_rescued", *(scaled(F.col(c)).alias(c) for c in ("rescaled_total_cn", "corrected_total_cn")), "total_amp", scaled(F.col("segment_mean")).alias("segment_mean"))
    return df


_SQL = {"read_counts": _COUNTS, "callable_loci": _CALLABLE, "variants": _VARIANTS, "pileups": _PILEUPS, "genotypes": _GENOTYPES, "allelic_counts": _ALLELIC, "harmonized": _HARMONIZED, "filtered_segments": _SEGMENTS, "acs": _ACS, "absolute": _ABSOLUTE}
for _name in RESULTS:
    query(f"e10_cohort_{_name}", f"WITH {_SQL[_name]}")(lambda spark, d, name=_name: shown(name, getattr(cohort_in(spark, d), name)))


@query("e10_cohort", " UNION ALL ".join(f"SELECT '{n}' AS step, patient, count(*) AS n FROM (WITH {_SQL[n]}) GROUP BY patient" for n in RESULTS))
def _(spark, d):
    rows = None
    for name, df in cohort_in(spark, d).results().items():
        one = df.groupBy("patient").agg(F.count("*").alias("n")).select(F.lit(name).alias("step"), "patient", "n")
        rows = one if rows is None else rows.union(one)
    return rows
