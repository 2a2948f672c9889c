"""Queries on intervals, coverage and harmonized copy ratios."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions.maths import scaled
from ..operators import coverage, harmonize, intervals
from ..operators.rangejoin import overlap_join, range_join
from ..sources.scratch import kept
from .views import view

CR, TARGETS, READS, SEGMENTS = (partial(view, name=n) for n in ("copy_ratios", "targets", "reads", "segments"))
SAMPLES = ["S0", "S1", "S2", "S3"]
CUT = """pts AS (SELECT DISTINCT contig, unnest([start, stop]) AS l FROM copy_ratios),
gaps AS (SELECT contig, l, lead(l) OVER (PARTITION BY contig ORDER BY l) AS r FROM pts),
cov AS (SELECT * FROM gaps g WHERE r IS NOT NULL AND EXISTS (SELECT 1 FROM copy_ratios c WHERE c.contig = g.contig AND c.start <= l AND c.stop > l)),
nb AS (SELECT *, lag(l) OVER o AS pl, lag(r) OVER o AS pr, lead(l) OVER o AS nl, lead(r) OVER o AS nr FROM cov WINDOW o AS (PARTITION BY contig ORDER BY l)),
el AS (SELECT contig, l AS start, r AS stop FROM nb WHERE NOT coalesce(r - l <= 1 AND pr = l AND nl = r AND pr - pl > 1 AND nr - nl > 1, false))"""
LOCI = f"""{CUT}, loci AS (SELECT e.contig, e.start, e.stop, sample, arg_max(log2_cr, abs(log2_cr) * 1e9 - ord) AS log2_cr, arg_min(call, ord) AS call, arg_min(log2_cr, ord) AS first_cr, arg_max(log2_cr, ord) AS last_cr, sqrt(avg(log2_cr * log2_cr)) AS rms, median(log2_cr) AS med
  FROM el e JOIN copy_ratios c ON c.contig = e.contig AND c.start <= e.start AND c.stop > e.start GROUP BY ALL)"""
COMMON = "common AS (SELECT contig, start, stop FROM loci GROUP BY ALL HAVING count(DISTINCT sample) = 4)"


def loci(spark: SparkSession, d: str) -> DataFrame:
    return harmonize.harmonize_loci(CR(spark, d), {"log2_cr": "strongest_signal", "call": "first"})


@query("w3_elementary_intervals", f"WITH {CUT} SELECT contig, l AS start, r AS stop FROM cov")
def _(spark, d):
    return intervals.elementary_intervals(CR(spark, d), ["contig"], drop_slivers=False)


@query("w4_drop_slivers", f"WITH {CUT} SELECT * FROM el")
def _(spark, d):
    return intervals.elementary_intervals(CR(spark, d), ["contig"])


@query("i1_disjoin", f"WITH {CUT} SELECT e.contig, e.start, e.stop, count(*) AS n, sum(ord)::BIGINT AS ord FROM el e JOIN copy_ratios c ON c.contig = e.contig AND c.start <= e.start AND c.stop > e.start GROUP BY ALL")
def _(spark, d):
    return intervals.disjoin(CR(spark, d), ["contig"]).groupBy("contig", "start", "stop").agg(F.count("*").alias("n"), F.sum("ord").alias("ord"))


@query("j8_containment_join", f"WITH {CUT} SELECT e.contig, e.start, e.stop, ord FROM el e JOIN copy_ratios c ON c.contig = e.contig AND c.start <= e.start AND c.stop > e.start")
def _(spark, d):
    return intervals.disjoin(CR(spark, d), ["contig"]).select("contig", "start", "stop", "ord")


@query("a3_harmonize_loci", f"WITH {LOCI} SELECT contig, start, stop, sample, log2_cr, call FROM loci")
def _(spark, d):
    return loci(spark, d)


for _name, _how, _sql in (("a5_error_mean", "error_mean", "rms"), ("a6_first", "first", "first_cr"), ("a6_last", "last", "last_cr"), ("a7_median", "median", "med")):
    query(_name, f"WITH {LOCI} SELECT contig, start, stop, sample, CAST(floor({_sql} * 1e6 + 0.5) AS BIGINT) AS log2_cr FROM loci")(lambda spark, d, how=_how: harmonize.harmonize_loci(CR(spark, d), {"log2_cr": how}).withColumn("log2_cr", scaled(F.col("log2_cr"))))


@query("a23_intersection_of_samples", f"WITH {LOCI}, {COMMON} SELECT contig, start, stop, sample, log2_cr FROM loci SEMI JOIN common USING (contig, start, stop)")
def _(spark, d):
    n = spark.createDataFrame([(4,)], "n long")
    return harmonize.in_all_samples(loci(spark, d), ["log2_cr"], n).select("contig", "start", "stop", "sample", "log2_cr")


@query("p9_drop_germline_cnv", f"WITH {LOCI} SELECT contig, start, stop, sample, log2_cr, call FROM loci ANTI JOIN (SELECT contig, start, stop FROM loci WHERE sample = 'S0' AND call IN ('+', '-')) USING (contig, start, stop)")
def _(spark, d):
    return harmonize.drop_germline(loci(spark, d), "S0")


@query("p8_min_length", f"SELECT * FROM copy_ratios WHERE stop - start + 1 >= 20")
def _(spark, d):
    return harmonize.min_length(CR(spark, d), 20)


@query("a21_pivot_samples", f"WITH {LOCI} SELECT contig, start, stop, {', '.join(f'coalesce(max(log2_cr) FILTER (sample = {s!r}), -99) AS log2_cr_{s}' for s in SAMPLES)} FROM loci GROUP BY contig, start, stop")
def _(spark, d):
    wide = harmonize.pivot_samples(loci(spark, d), ["log2_cr"], SAMPLES)
    return wide.na.fill(-99.0)


@query("a22_stack_samples", f"WITH {LOCI} SELECT contig, start, stop, sample, log2_cr FROM loci")
def _(spark, d):
    return harmonize.stack_samples(harmonize.pivot_samples(loci(spark, d), ["log2_cr"], SAMPLES), "log2_cr", SAMPLES)


W5 = """base AS ({rows}), n AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY start, stop) AS r FROM base),
fold AS (
  SELECT contig, r, start, start AS run_start, stop AS run_stop, v AS anchor, NULL::BIGINT AS out_start, NULL::BIGINT AS out_stop, NULL::DOUBLE AS out_v FROM n WHERE r = 1
  UNION ALL
  SELECT n.contig, n.r, n.start, CASE WHEN m THEN run_start ELSE n.start END, n.stop, CASE WHEN m THEN anchor ELSE n.v END, CASE WHEN m THEN NULL ELSE run_start END, CASE WHEN m THEN NULL WHEN run_stop = n.start THEN run_stop - 1 ELSE run_stop END, CASE WHEN m THEN NULL ELSE anchor END
  FROM (SELECT f.contig, f.run_start, f.run_stop, f.anchor, n.r, n.start, n.stop, n.v, abs(n.start - f.run_stop) <= 1 AND abs(f.anchor - n.v) < {tol} AS m FROM fold f JOIN n ON n.contig = f.contig AND n.r = f.r + 1) n)
SELECT contig, out_start AS start, out_stop AS stop, out_v AS v FROM fold WHERE out_start IS NOT NULL UNION ALL SELECT contig, run_start, run_stop, anchor FROM (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY r DESC) AS k FROM fold) WHERE k = 1"""


@query("w5_merge_abutting", "WITH RECURSIVE " + W5.format(rows="SELECT contig, start, stop, (min(ord) % 3)::DOUBLE / 10 AS v FROM copy_ratios GROUP BY contig, start, stop", tol=0.15))
def _(spark, d):
    rows = CR(spark, d).groupBy("contig", "start", "stop").agg(((F.min("ord") % 3).cast("double") / 10).alias("v"))
    return intervals.merge_abutting(rows, ["contig"], ["v"], tolerance=0.15)


@query("i3_merge_abutting_segments", "WITH RECURSIVE " + W5.format(rows="SELECT contig, start, stop, min(minor_allele_fraction) AS v FROM segments GROUP BY contig, start, stop", tol=0.05))
def _(spark, d):
    rows = SEGMENTS(spark, d).groupBy("contig", "start", "stop").agg(F.min("minor_allele_fraction").alias("v"))
    return intervals.merge_abutting(rows, ["contig"], ["v"], tolerance=0.05)


def fold_sql(rows: str, key: str, n: int, distance: int = 1, tol: float = 1e-3) -> str:
    """merge_abutting() row by row in SQL: rows (key, start, stop, v0, v1, ...), ends with fold_out AS (key, start, stop, v0, ...)."""
    v = range(n)
    near = " AND ".join([f"abs(n.start - f.run_stop) <= {distance}", *(f"coalesce(abs(f.a{i} - n.v{i}) < {tol}, false)" for i in v)])
    each = lambda text: ", ".join(text.format(i=i) for i in v)
    return f"""fold_in AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY start, stop) AS r FROM ({rows})),
fold AS (
  SELECT {key}, r, start AS run_start, stop AS run_stop, {each('v{i} AS a{i}')}, NULL::BIGINT AS out_start, NULL::BIGINT AS out_stop, {each('NULL::DOUBLE AS o{i}')} FROM fold_in WHERE r = 1
  UNION ALL
  SELECT {key}, r, CASE WHEN m THEN run_start ELSE start END, stop, {each('CASE WHEN m THEN a{i} ELSE v{i} END')}, CASE WHEN m THEN NULL ELSE run_start END, CASE WHEN m THEN NULL WHEN run_stop = start THEN run_stop - 1 ELSE run_stop END, {each('CASE WHEN m THEN NULL ELSE a{i} END')}
  FROM (SELECT n.*, f.run_start, f.run_stop, {each('f.a{i}')}, {near} AS m FROM fold f JOIN fold_in n ON n.{key} = f.{key} AND n.r = f.r + 1)),
fold_out AS (SELECT {key}, out_start AS start, out_stop AS stop, {each('o{i} AS v{i}')} FROM fold WHERE out_start IS NOT NULL UNION ALL SELECT {key}, run_start, run_stop, {each('a{i}')} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY r DESC) AS back FROM fold) WHERE back = 1)"""


def _cells(value: str) -> str:
    return ", ".join(f"max({value}) FILTER (sample = {s!r}) AS v{i}" for i, s in enumerate(SAMPLES))


_LONG = " UNION ALL ".join(f"SELECT contig, start, stop, {s!r} AS sample, v{i} AS log2_cr FROM fold_out WHERE stop - start + 1 >= 2 AND v{i} IS NOT NULL" for i, s in enumerate(SAMPLES))
_KEPT = "SELECT contig, start, stop FROM common ANTI JOIN (SELECT contig, start, stop FROM loci WHERE sample = 'S0' AND call IN ('+', '-')) USING (contig, start, stop)"


@query("e2_harmonize_copy_ratios", f"WITH RECURSIVE {LOCI}, {COMMON}, {fold_sql(f'SELECT contig, start, stop, {_cells("log2_cr")} FROM loci SEMI JOIN common USING (contig, start, stop) GROUP BY contig, start, stop', 'contig', 4)} {_LONG}")
def _(spark, d):
    return harmonize.harmonize(CR(spark, d), {"log2_cr": "strongest_signal"}, SAMPLES, minimum=2)


@query("i2_harmonize_union", f"WITH RECURSIVE {LOCI}, {fold_sql(f'SELECT contig, start, stop, {_cells("last_cr")} FROM loci GROUP BY contig, start, stop', 'contig', 4, tol=0.5)} {_LONG}")
def _(spark, d):
    return harmonize.harmonize(CR(spark, d), {"log2_cr": "last"}, SAMPLES, rule="UNION", minimum=2, tolerance=0.5)


_COUNTS = "SELECT h.sample, h.contig, h.start, h.stop, log2_cr, (SELECT count(*) FROM copy_ratios c WHERE c.sample = h.sample AND c.contig = h.contig AND c.start BETWEEN h.start AND h.stop) AS n_probes, (SELECT count(*) FROM pileup_runs p WHERE alt_count > 0 AND p.sample = h.sample AND p.contig = h.contig AND p.position BETWEEN h.start AND h.stop) AS n_hets FROM h"


@query("e7_filter_segments", f"WITH RECURSIVE {LOCI}, {COMMON}, stays AS ({_KEPT}), {fold_sql(f'SELECT contig, start, stop, {_cells("med")} FROM loci SEMI JOIN stays USING (contig, start, stop) GROUP BY contig, start, stop', 'contig', 4)}, h AS ({_LONG}) {_COUNTS}")
def _(spark, d):
    probes = CR(spark, d).select("sample", "contig", F.col("start").alias("position"))
    hets = view(spark, d, "pileup_runs").where("alt_count > 0").select("sample", "contig", "position")
    return harmonize.filter_segments(CR(spark, d), probes, hets, {"log2_cr": "median", "call": "first"}, SAMPLES, "S0", 2)


_PIECES = """sg AS (SELECT concat(sample, '/', contig) AS k, start, stop, minor_allele_fraction AS v FROM segments), pt AS (SELECT DISTINCT k, unnest([start, stop]) AS l FROM sg), gp AS (SELECT k, l, lead(l) OVER (PARTITION BY k ORDER BY l) AS r FROM pt),
cv AS (SELECT * FROM gp g WHERE r IS NOT NULL AND EXISTS (SELECT 1 FROM sg c WHERE c.k = g.k AND c.start <= l AND c.stop > l)), nbs AS (SELECT *, lag(l) OVER o AS pl, lag(r) OVER o AS pr, lead(l) OVER o AS nl, lead(r) OVER o AS nr FROM cv WINDOW o AS (PARTITION BY k ORDER BY l)),
els AS (SELECT k, l AS start, r AS stop FROM nbs WHERE NOT coalesce(r - l <= 1 AND pr = l AND nl = r AND pr - pl > 1 AND nr - nl > 1, false))"""


@query("a8_harmonize_segments", f"WITH RECURSIVE {_PIECES}, {fold_sql('SELECT e.k, e.start, e.stop, min(v) AS v0 FROM els e JOIN sg c ON c.k = e.k AND c.start <= e.start AND c.stop > e.start GROUP BY ALL', 'k', 1, tol=0.05)} SELECT split_part(k, '/', 1) AS sample, split_part(k, '/', 2) AS contig, start, stop, v0 AS minor_allele_fraction FROM fold_out")
def _(spark, d):
    return harmonize.harmonize_segments(SEGMENTS(spark, d), tolerance=0.05)


UNION = """mo AS (SELECT *, max(stop) OVER (PARTITION BY contig ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT contig, start, stop FROM targets)),
mg AS (SELECT contig, min(start) AS start, max(stop) AS stop FROM (SELECT *, sum(CASE WHEN start <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS k FROM mo) GROUP BY contig, k)"""


@query("i4_merge_overlapping", f"WITH {UNION} SELECT * FROM mg")
def _(spark, d):
    return intervals.merge_overlapping(TARGETS(spark, d), ["contig"])


BASES = """tb AS (SELECT DISTINCT contig, unnest(generate_series(start, stop)) AS p FROM targets), kb AS (SELECT DISTINCT contig, unnest(generate_series(start, start + 3)) AS p FROM copy_ratios),
lb AS (SELECT * FROM tb EXCEPT SELECT * FROM kb), isl AS (SELECT contig, p, p - row_number() OVER (PARTITION BY contig ORDER BY p) AS k FROM lb)"""


@query("i5_subtract", f"WITH {BASES} SELECT contig, min(p) AS start, max(p) AS stop FROM isl GROUP BY contig, k")
def _(spark, d):
    return intervals.subtract(TARGETS(spark, d), CR(spark, d).withColumn("stop", F.col("start") + 3), ["contig"])


@query("u8_union_minus_blacklist", f"WITH {BASES} SELECT contig, count(*) AS bases FROM lb GROUP BY contig")
def _(spark, d):
    out = intervals.union_minus(TARGETS(spark, d), CR(spark, d).withColumn("stop", F.col("start") + 3), ["contig"])
    return out.groupBy("contig").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("bases"))


@query("i6_pad", "SELECT contig, greatest(1, start - 25) AS start, least(start - start % 500 + 400, stop + 25) AS stop, score FROM targets")
def _(spark, d):
    return intervals.pad(TARGETS(spark, d), 25, F.col("start") - F.col("start") % 500 + 400)


@query("i7_bin", "SELECT contig, s AS start, least(stop, s + 9) AS stop, score FROM (SELECT *, unnest(generate_series(start, stop, 10)) AS s FROM targets)")
def _(spark, d):
    return intervals.tile(TARGETS(spark, d), 10)


@query("i8_balanced_shards", "WITH u AS (SELECT DISTINCT contig, start, stop FROM targets), b AS (SELECT contig, p, row_number() OVER (ORDER BY contig, start, stop, p) - 1 AS k, count(*) OVER () AS total FROM (SELECT *, unnest(generate_series(start, stop)) AS p FROM u)) SELECT floor(k * 7 / total)::BIGINT AS shard, count(*) AS bases, min(contig) AS first_contig FROM b GROUP BY 1")
def _(spark, d):
    rows = intervals.balanced_shards(TARGETS(spark, d).select("contig", "start", "stop").distinct(), 7, ["contig", "start"])
    return rows.groupBy("shard").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("bases"), F.min("contig").alias("first_contig"))


@query("i9_annotate_intervals", "WITH u AS (SELECT DISTINCT contig, start, stop FROM targets), t AS (SELECT contig, start, stop, min(log2_cr) AS score FROM copy_ratios GROUP BY ALL) SELECT contig, u.start, u.stop, CAST(floor(coalesce(sum((least(u.stop, t.stop) - greatest(u.start, t.start) + 1) * score) / any_value(u.stop - u.start + 1), 0) * 1e3 + 0.501) AS BIGINT) AS score FROM u LEFT JOIN t USING (contig) WHERE t.start IS NULL OR (t.start <= u.stop AND u.start <= t.stop) GROUP BY ALL")
def _(spark, d):
    track = CR(spark, d).groupBy("contig", "start", "stop").agg(F.min("log2_cr").alias("score"))
    out = intervals.annotate(TARGETS(spark, d).select("contig", "start", "stop").distinct(), track, ["contig"])
    return out.withColumn("score", F.floor(F.col("score") * 1000 + 0.501).cast("long"))


@query("j_overlap_join", "SELECT t.contig, t.start, t.stop, s.start AS r_start, s.stop AS r_stop, count(*) AS n FROM targets t JOIN segments s ON s.contig = t.contig AND t.start <= s.stop AND s.start <= t.stop GROUP BY ALL")
def _(spark, d):
    # equal intervals meet once, with how often they occur
    targets, segments = (view(spark, d, name).groupBy("contig", "start", "stop").agg(F.count("*").alias("n")) for name in ("targets", "segments"))
    pairs = overlap_join(targets, segments, ["contig"], bin_=64)
    return pairs.withColumn("n", F.col("n") * F.col("r_n")).drop("r_n")


GOOD = "good AS (SELECT * FROM reads WHERE (flags & 1796) = 0 AND stop >= start AND mapq >= 1 AND mapq <> 255)"
DEPTH = """ev AS (SELECT contig, pt, sum(d) AS d FROM (SELECT contig, start AS pt, 1 AS d FROM good UNION ALL SELECT contig, stop + 1, -1 FROM good) GROUP BY ALL HAVING sum(d) <> 0),
dep AS (SELECT * FROM (SELECT contig, pt AS start, lead(pt) OVER w - 1 AS stop, (sum(d) OVER (PARTITION BY contig ORDER BY pt ROWS UNBOUNDED PRECEDING))::BIGINT AS depth FROM ev WINDOW w AS (PARTITION BY contig ORDER BY pt)) WHERE depth > 0)"""


def good(spark: SparkSession, d: str) -> DataFrame:
    return coverage.good_reads(READS(spark, d))


@query("p25_read_quality_filters", f"WITH {GOOD} SELECT ord FROM good")
def _(spark, d):
    return good(spark, d).select("ord")


@query("p26_paired_end_filter", f"WITH {GOOD} SELECT ord FROM good WHERE (flags & 66) = 66")
def _(spark, d):
    return coverage.good_reads(READS(spark, d), paired_end=True).select("ord")


@query("p27_max_soft_clipped", f"WITH {GOOD} SELECT ord FROM good WHERE clip <= 10")
def _(spark, d):
    return coverage.good_reads(READS(spark, d), max_clipped=10).select("ord")


@query("i10_depth_runs", f"WITH {GOOD}, {DEPTH} SELECT contig, start, stop, depth FROM dep")
def _(spark, d):
    return intervals.depth_runs(good(spark, d), ["contig"])


@query("i10_covered_regions", f"WITH {GOOD}, {DEPTH}, dd AS (SELECT *, CASE WHEN start - lag(stop) OVER (PARTITION BY contig ORDER BY start) <= 1 THEN 0 ELSE 1 END AS nw FROM dep WHERE depth >= 20) SELECT contig, min(start) AS start, max(stop) AS stop, min(depth) AS depth FROM (SELECT *, sum(nw) OVER (PARTITION BY contig ORDER BY start ROWS UNBOUNDED PRECEDING) AS k FROM dd) GROUP BY contig, k")
def _(spark, d):
    return intervals.covered_regions(good(spark, d), ["contig"], 20)


@query("i14_callable_loci", f"WITH {GOOD}, {DEPTH} SELECT contig, CASE WHEN depth < 20 THEN 'LOW_COVERAGE' WHEN depth > 30 THEN 'EXCESSIVE_COVERAGE' ELSE 'CALLABLE' END AS state, sum(stop - start + 1)::BIGINT AS bases FROM dep GROUP BY ALL")
def _(spark, d):
    runs = intervals.callable_loci(good(spark, d), ["contig"], 20, 30)
    return runs.groupBy("contig", "state").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("bases"))


_PANEL = "SELECT DISTINCT event_type AS contig, g * 10 AS start, g * 10 + 14 AS stop FROM events, generate_series(0, 20) AS t(g)"


def panel(spark: SparkSession, d: str) -> DataFrame:
    return READS(spark, d).select("contig").distinct().select("contig", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(20).cast("long"))).alias("g")).select("contig", (F.col("g") * 10).alias("start"), (F.col("g") * 10 + 14).alias("stop"))


@query("i13_count_reads_per_interval", f"WITH {GOOD}, pn AS ({_PANEL}) SELECT contig, p.start, p.stop, count(r.ord) AS count FROM pn p LEFT JOIN good r ON r.contig = p.contig AND r.start BETWEEN p.start AND p.stop GROUP BY ALL".replace("SELECT contig, p.start", "SELECT p.contig, p.start"))
def _(spark, d):
    return coverage.count_reads(panel(spark, d), good(spark, d))


@query("j4_marker_counts", "WITH sg AS (SELECT DISTINCT sample, contig, start, stop FROM segments) SELECT s.sample, s.contig, s.start, s.stop, count(p.run) AS n FROM sg s LEFT JOIN pileup_runs p ON p.sample = s.sample AND p.contig = s.contig AND p.position BETWEEN s.start AND s.stop GROUP BY ALL")
def _(spark, d):
    return intervals.count_in_intervals(SEGMENTS(spark, d).select("sample", "contig", "start", "stop").distinct(), view(spark, d, "pileup_runs"), ["sample", "contig"], name="n")


@query("i11_recount_markers", "WITH sg AS (SELECT DISTINCT contig, start, stop FROM targets), a AS (SELECT s.contig, s.start, s.stop, count(c.ord) AS n_probes FROM sg s LEFT JOIN copy_ratios c ON c.contig = s.contig AND c.start BETWEEN s.start AND s.stop GROUP BY ALL), b AS (SELECT s.contig, s.start, s.stop, count(v.ord) AS n_hets FROM sg s LEFT JOIN variants v ON v.contig = s.contig AND v.position BETWEEN s.start AND s.stop GROUP BY ALL) SELECT * FROM a JOIN b USING (contig, start, stop)")
def _(spark, d):
    rows = TARGETS(spark, d).select("contig", "start", "stop").distinct()
    rows = intervals.count_in_intervals(rows, CR(spark, d).select("contig", F.col("start").alias("position")), ["contig"], name="n_probes")
    return intervals.count_in_intervals(rows, view(spark, d, "variants"), ["contig"], name="n_hets")


for _k, _sql in (("left_semi", "SEMI"), ("left_anti", "ANTI")):
    query(f"{'j5_interval_include' if _k == 'left_semi' else 'j6_interval_exclude'}", f"SELECT * FROM variants v {_sql} JOIN targets t ON t.contig = v.contig AND v.position BETWEEN t.start - 5 AND t.stop + 5")(lambda spark, d, how=_k: range_join(view(spark, d, "variants"), TARGETS(spark, d), ["contig"], how=how, pad=5))


@query("t18_call_copy_ratio", "WITH x AS (SELECT *, stop - start + 1 AS len, pow(2.0::DOUBLE, log2_cr) AS cr FROM copy_ratios), a AS (SELECT sample, sum(cr * len) / sum(len) AS m, sqrt(greatest(sum(cr * cr * len) / sum(len) - pow(sum(cr * len) / sum(len), 2), 0)) AS s FROM x WHERE cr BETWEEN 0.9 AND 1.1 GROUP BY sample), b AS (SELECT sample, sum(cr * len) / sum(len) AS m, sqrt(greatest(sum(cr * cr * len) / sum(len) - pow(sum(cr * len) / sum(len), 2), 0)) AS s FROM x JOIN a USING (sample) WHERE cr BETWEEN 0.9 AND 1.1 AND abs(cr - m) <= 2 * s GROUP BY sample) SELECT sample, ord, CASE WHEN abs(cr - m) > 2 * s AND NOT cr BETWEEN 0.9 AND 1.1 THEN CASE WHEN cr > m THEN '+' ELSE '-' END ELSE '0' END AS call FROM x LEFT JOIN b USING (sample)")
def _(spark, d):
    rows = CR(spark, d).drop("call").withColumn("length", F.col("stop") - F.col("start") + 1)
    return coverage.call_copy_ratio(rows).select("sample", "ord", "call")


STANDARD = """ct AS (SELECT sample, contig, position AS start, position AS stop, sum(ref_count)::DOUBLE AS c FROM pileup_runs GROUP BY ALL), ms AS (SELECT sample, median(c) AS m FROM ct GROUP BY sample HAVING median(c) > 0),
sc AS (SELECT ct.*, c / m AS s FROM ct JOIN ms USING (sample)), mi AS (SELECT contig, start, stop, median(s) AS m FROM sc GROUP BY ALL HAVING median(s) > 0), sd AS (SELECT sample, contig, start, stop, log2(greatest(s / m, 0.001)) AS log2_cr FROM sc JOIN mi USING (contig, start, stop))"""


def standard(spark: SparkSession, d: str) -> DataFrame:
    counts = view(spark, d, "pileup_runs").groupBy("sample", "contig", F.col("position").alias("start"), F.col("position").alias("stop")).agg(F.sum("ref_count").alias("count"))
    return coverage.standardize(counts)


@query("t20_standardize", f"WITH {STANDARD} SELECT sample, contig, start, stop, CAST(floor(log2_cr * 1e6 + 0.5) AS BIGINT) AS log2_cr FROM sd")
def _(spark, d):
    return standard(spark, d).withColumn("log2_cr", scaled(F.col("log2_cr")))


@query("t20_tangent_normalize", f"WITH {STANDARD}, nn AS (SELECT contig, start, stop, log2_cr AS v FROM sd WHERE sample = 'S0'), w AS (SELECT sample, sum(log2_cr * v) / (SELECT sum(v * v) FROM nn) AS w FROM sd JOIN nn USING (contig, start, stop) WHERE sample <> 'S0' GROUP BY sample) SELECT sample, contig, start, stop, CAST(floor((log2_cr - coalesce(w * v, 0)) * 1e5 + 0.5) AS BIGINT) AS log2_cr FROM sd JOIN w USING (sample) LEFT JOIN nn USING (contig, start, stop)")
def _(spark, d):
    rows = kept(standard(spark, d))
    out = coverage.tangent_normalize(rows.where("sample <> 'S0'"), rows.where("sample = 'S0'"))
    return out.withColumn("log2_cr", scaled(F.col("log2_cr"), 10**5))


@query("t20_tangent_cohort")
def _(spark, d):
    """Four samples against twenty normals; singular vectors have no SQL, a test holds it against NumPy."""
    key = F.col("l_suppkey")
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select((key % 24).alias("k"), F.concat(F.lit("N"), (key % 24).cast("string")).alias("sample"), F.expr("CAST(l_partkey % 23 AS STRING)").alias("contig"), F.expr("l_orderkey DIV 64 * 64").alias("start"), F.col("l_quantity").alias("q"))
    rows = rows.repartition("sample", "contig", "start")  # nearly all rows are bins of their own: adding up before the shuffle only fills memory
    counts = rows.groupBy("sample", "contig", "start", (F.col("start") + 63).alias("stop")).agg(F.sum("q").alias("count"))
    ratios = kept(coverage.standardize(counts))  # read by normals and samples
    tumours = F.col("sample").isin("N20", "N21", "N22", "N23")
    return coverage.tangent_normalize(ratios.where(tumours), ratios.where(~tumours), 10)


@query("i15_pileup_at_sites", "WITH pn AS (SELECT contig, position, min(ref) AS ref, min(alt) AS alt, 0.1::DOUBLE AS allele_frequency FROM variants GROUP BY ALL), ob AS (SELECT contig, position, substr('ACGT', (alt_count % 4)::INT + 1, 1) AS base FROM pileup_runs) SELECT p.contig, p.position, allele_frequency, count(*) FILTER (base = ref) AS ref_count, count(*) FILTER (base = alt AND base <> ref) AS alt_count, count(*) FILTER (base <> ref AND base <> alt) AS other_alt_count FROM pn p LEFT JOIN ob USING (contig, position) GROUP BY ALL")
def _(spark, d):
    from ..operators.pileups import pileup_at_sites

    sites = view(spark, d, "variants").groupBy("contig", "position").agg(F.min("ref").alias("ref"), F.min("alt").alias("alt"), F.lit(0.1).alias("allele_frequency"))
    seen = view(spark, d, "pileup_runs").select("contig", "position", F.expr("substr('ACGT', CAST(alt_count % 4 AS INT) + 1, 1)").alias("base"))
    return pileup_at_sites(seen, sites)


@query("v11_reads_at_sites", "WITH st AS (SELECT DISTINCT event_type AS contig, event_id % 100 * 3 AS position FROM events) SELECT r.ord FROM reads r SEMI JOIN st s ON s.contig = r.contig AND s.position BETWEEN r.start AND r.stop")
def _(spark, d):
    from ..operators.variants import reads_at_sites

    events = spark.read.parquet(f"{d}/events.parquet")
    st = events.selectExpr("event_type AS contig", "event_id % 100 * 3 AS position")
    return reads_at_sites(READS(spark, d), st).select("ord")


@query("e9_coverage", f"WITH {GOOD}, pn AS ({_PANEL}) SELECT p.contig, p.start, p.stop, count(r.ord) AS count FROM pn p LEFT JOIN (SELECT * FROM good WHERE clip <= 15) r ON r.contig = p.contig AND r.start BETWEEN p.start AND p.stop GROUP BY ALL")
def _(spark, d):
    from .pipelines import coverage_of

    return coverage_of(READS(spark, d), panel(spark, d), max_clipped=15)[0]


@query("e10_harmonize_cohort", f"WITH pc AS (SELECT *, concat('P', CAST(ord % 2 AS VARCHAR)) AS patient FROM copy_ratios), pts AS (SELECT DISTINCT patient, contig, unnest([start, stop]) AS l FROM pc), gaps AS (SELECT patient, contig, l, lead(l) OVER (PARTITION BY patient, contig ORDER BY l) AS r FROM pts), nb AS (SELECT *, lag(l) OVER o AS pl, lag(r) OVER o AS pr, lead(l) OVER o AS nl, lead(r) OVER o AS nr FROM (SELECT * FROM gaps g WHERE r IS NOT NULL AND EXISTS (SELECT 1 FROM pc c WHERE c.patient = g.patient AND c.contig = g.contig AND c.start <= l AND c.stop > l)) WINDOW o AS (PARTITION BY patient, contig ORDER BY l)), el AS (SELECT * FROM nb WHERE NOT coalesce(r - l <= 1 AND pr = l AND nl = r AND pr - pl > 1 AND nr - nl > 1, false)), lo AS (SELECT e.patient, e.contig, e.l AS start, e.r AS stop, sample, min(log2_cr) AS log2_cr FROM el e JOIN pc c ON c.patient = e.patient AND c.contig = e.contig AND c.start <= e.l AND c.stop > e.l GROUP BY ALL) SELECT * FROM lo SEMI JOIN (SELECT patient, contig, start, stop FROM lo GROUP BY ALL HAVING count(DISTINCT sample) = 4) USING (patient, contig, start, stop)")
def _(spark, d):
    from .pipelines import harmonize_cohort

    rows = CR(spark, d).withColumn("patient", F.concat(F.lit("P"), (F.col("ord") % 2).cast("string")))
    return harmonize_cohort(rows, {"log2_cr": "min"}, spark.createDataFrame([("P0", 4), ("P1", 4)], "patient string, n long"))
