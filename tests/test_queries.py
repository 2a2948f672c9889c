"""Registered queries against their SQL in DuckDB, and hand-made cases of the operators."""

import gzip
import math
import os
import random
import struct
import time
from collections import Counter
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from allelespark import catalog
from allelespark.functions.maths import lgamma, lgammas
from allelespark.operators import allelic, coverage, genotype, harmonize, intervals, medians, pairs, pileups, rangejoin, variants
from allelespark.operators.contigs import dense_order, genomic_sort, ploidy
from allelespark.operators.rangejoin import nearest_interval, overlap_join, range_join
from allelespark.plans import pipelines, q_cohort, q_files, q_pileups
from allelespark.plans.views import view
from allelespark.sources import blocks, readers, writers

catalog.load()
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
CHECKED = ["a1_merge_pileups", "e1_genotype_patient", "a14_genotype_concordance", "i1_disjoin", "w5_merge_abutting", "j7_nearest_interval", "w6_free_slots", "w1_cnloh_label", "t13_map_to_cluster", "i5_subtract", "i8_balanced_shards", "i14_callable_loci", "p12_hard_filter", "p19_tumor_normal_split", "j21_annotate_features", "e2_harmonize_copy_ratios", "i2_harmonize_union", "e7_filter_segments", "a8_harmonize_segments", "e11_genotype_snp_panel", "t20_tangent_normalize", "s4_read_segments", "s11_read_gvcf_trimmed", "k3_write_genotype_vcf", "k6_sample_correlation", "k8_write_acs", "o1_genomic_order", "v10_common_resource", "a20_loci_progress", "w2_cnloh_triplets"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select(*columns).collect()), key=str)
    want = sorted(duck.execute(f"SELECT {', '.join(columns)} FROM ({catalog.SQL[name]})").fetchall(), key=str)
    assert got == want


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)


def test_lgamma(spark):
    xs = [0.001, 0.5, 1.0, 2.0, 3.7, 40.0, 740.0, 1e5]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", lgamma(F.col("x")).alias("y")).collect()
    assert all(r.y == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-11) for r in rows)


def test_runs_of_one_sample_add_up(spark):
    rows = [("T", 1, "1", 1, 10, 10, 0, 0.1), ("T", 2, "1", 1, 10, 10, 0, 0.2), ("T", 2, "1", 1, 99, 99, 0, 0.3), ("N", 1, "1", 1, 1, 0, 0, 0.1)]
    df = spark.createDataFrame(rows, "sample string, run int, contig string, position long, ref_count long, alt_count long, other_alt_count long, allele_frequency double")
    got = {r.sample: (r.ref_count, r.alt_count, r.allele_frequency) for r in pileups.merge_pileups(df).collect()}
    assert got == {"T": (20, 20, 0.2), "N": (1, 0, 0.1)}
    assert pileups.merge_pileups(df, min_depth=10).count() == 1


def test_nearest_of_the_literal_case(spark):
    iv = spark.createDataFrame([("1", 10, 20), ("1", 30, 40), ("1", 50, 60)], "contig string, start long, stop long")
    points = spark.createDataFrame([("1", p) for p in (2, 15, 27, 45, 100)], "contig string, position long")
    got = {r.position: (r.start, r.distance) for r in nearest_interval(points, iv, ["contig"], 10).collect()}
    assert got == {2: (10, 8), 15: (10, 0), 27: (30, 3), 45: (30, 5)}


def test_range_join_equals_nested_loop(spark):
    iv = [(0, 10), (5, 5), (9, 4000), (3, 2), (100, 5_000_000)]
    points = [0, 5, 5, 9, 10, 11, 4000, 4001, 99999]
    a = spark.createDataFrame([("1", p) for p in points], "contig string, position long")
    b = spark.createDataFrame([("1", x, y) for x, y in iv], "contig string, start long, stop long")
    for bin_ in (1, 16):
        got = sorted((r.position, r.start, r.stop) for r in range_join(a, b, ["contig"], bin_=bin_).collect())
        assert got == sorted((p, x, y) for p in points for x, y in iv if x <= p <= y)
        assert range_join(a, b, ["contig"], how="left_anti", bin_=bin_).count() == 0


def test_unequal_starts_and_ends_lose_nothing(spark):
    df = spark.createDataFrame([("1", 1, 20), ("1", 20, 30), ("1", 20, 40)], "contig string, start long, stop long")
    got = [(r.start, r.stop) for r in intervals.elementary_intervals(df, ["contig"]).orderBy("start").collect()]
    assert got == [(1, 20), (20, 30), (30, 40)]


def test_merge_abutting_compares_with_the_first_and_rests(spark):
    df = spark.createDataFrame([("1", 1, 10, 0.0), ("1", 11, 20, 0.06), ("1", 21, 30, 0.12), ("1", 30, 40, 0.5)], "contig string, start long, stop long, v double")
    once = intervals.merge_abutting(df, ["contig"], ["v"], tolerance=0.1)
    assert [tuple(r) for r in once.orderBy("start").collect()] == [("1", 1, 20, 0.0), ("1", 21, 29, 0.12), ("1", 30, 40, 0.5)]
    again = intervals.merge_abutting(once, ["contig"], ["v"], tolerance=0.1)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_contigs(spark):
    df = spark.createDataFrame([(c,) for c in ("chrGL", "X", "10", "2", "MT", "Y")], "contig string")
    assert [r.contig for r in genomic_sort(df).collect()] == ["2", "10", "X", "Y", "MT", "chrGL"]
    got = {r.contig: r.p for r in df.select("contig", ploidy(F.col("contig"), F.lit("XY")).alias("p")).collect()}
    assert got == {"chrGL": 2, "X": 1, "10": 2, "2": 2, "MT": 1, "Y": 1}


def test_trimmed_alleles(spark):
    rows = spark.createDataFrame([(5, "CTT", "CT"), (5, "A", "G"), (7, "CA", "CG"), (9, "AAA", "A")], "position long, ref string, alt string")
    assert [(r.position, r.ref, r.alt) for r in variants.trim_alleles(rows).collect()] == [(5, "CT", "C"), (5, "A", "G"), (8, "A", "G"), (9, "AAA", "A")]


def _nearest(position, iv, most):
    before = max(((a, b) for a, b in iv if a <= position), default=None)
    after = min(((a, b) for a, b in iv if a >= position), default=None)
    one = max(position - before[1], 0) if before else None
    two = after[0] - position if after else None
    got = (after, two) if one is None or (two is not None and two < one) else (before, one)
    return (*got[0], got[1]) if got[0] and got[1] <= most else None


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_nearest_across_blocks(spark, block):
    rng = random.Random(block)
    iv = [(a, a + rng.randint(0, 30)) for a in (rng.randint(1, 900) for _ in range(40))]
    points = [rng.randint(1, 1000) for _ in range(200)]
    got = nearest_interval(spark.createDataFrame([("1", p) for p in points], "contig string, position long"), spark.createDataFrame([("1", a, b) for a, b in iv], "contig string, start long, stop long"), ["contig"], 25, block=block)
    want = [(p, *r) for p in points if (r := _nearest(p, iv, 25))]
    assert sorted((r.position, r.start, r.stop, r.distance) for r in got.collect()) == sorted(want)


def test_nearest_of_many_points_on_one_contig(spark):
    points = spark.range(400_000).select(F.lit("1").alias("contig"), (F.col("id") * 600 + 1).alias("position"))
    iv = spark.range(50_000).select(F.lit("1").alias("contig"), (F.col("id") * 5000 + 1).alias("start"), (F.col("id") * 5000 + 100).alias("stop"))
    began = time.time()
    assert nearest_interval(points, iv, ["contig"], 10**6).count() == 400_000
    assert time.time() - began < 60  # a frame that is read anew for each row takes hours


def test_overlaps_of_long_intervals(spark):
    rng = random.Random(4)
    make = lambda n: [(a, a + rng.choice([0, 5, 900, 70_000, 5_000_000, 250_000_000])) for a in (rng.randint(1, 10**6) for _ in range(n))]
    one, two = make(60), make(60)
    df = lambda rows: spark.createDataFrame([("1", i, a, b) for i, (a, b) in enumerate(rows)], "contig string, id int, start long, stop long")
    for bin_ in (16, 1024):
        got = overlap_join(df(one), df(two), ["contig"], bin_=bin_).select("id", "r_id").collect()
        assert sorted(map(tuple, got)) == sorted((i, j) for i, (a, b) in enumerate(one) for j, (c, d) in enumerate(two) if a <= d and c <= b)


def _merged(rows, distance, tolerance):
    out, run = [], None
    for a, b, *v in sorted(rows, key=lambda r: r[:2]):
        if run and abs(a - run[1]) <= distance and all(x is not None and y is not None and abs(x - y) < tolerance for x, y in zip(run[2], v)):
            run[1] = b
            continue
        if run:
            out.append((run[0], run[1] - (run[1] == a), *run[2]))
        run = [a, b, v]
    return out + [(run[0], run[1], *run[2])]


@pytest.mark.parametrize(("as_array", "block"), [(False, 1 << 20), (False, 7), (True, 50)])
def test_merge_abutting_against_a_row_loop(spark, as_array, block):
    rng = random.Random(11)
    rows, at, v = [], 1, 0.0
    for _ in range(1500):
        stop = at + rng.randint(1, 9)
        v = rng.choice([v, v + rng.choice([0.02, -0.03, 0.06]), rng.random()])
        rows.append((at, stop, v, rng.choice([0.5, 0.52, 0.5, 0.5, None]) if rng.random() < 0.2 else 0.5))
        at = stop + rng.choice([0, 1, 1, 1, 4])
    df = spark.createDataFrame([("1", *r) for r in rows], "contig string, start long, stop long, u double, v double").repartition(5)
    want = sorted(_merged(rows, 1, 0.1))
    if as_array:
        got = intervals.merge_abutting(df.select("contig", "start", "stop", F.array("u", "v").alias("w")), ["contig"], "w", tolerance=0.1, block=block)
        assert sorted((r.start, r.stop, *r.w) for r in got.collect()) == want
    else:
        got = intervals.merge_abutting(df, ["contig"], ["u", "v"], tolerance=0.1, block=block)
        assert sorted((r.start, r.stop, r.u, r.v) for r in got.collect()) == want
    assert intervals.merge_abutting(df.where("false"), ["contig"], ["u", "v"]).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 9])
def test_balanced_shards_against_single_bases(spark, block):
    rng = random.Random(5)
    rows = [(c, a, a + rng.randint(0, 30)) for c in ("1", "2", "X") for a in (rng.randint(1, 300) for _ in range(12))]
    bases = [(c, p) for c, a, b in sorted(rows) for p in range(a, b + 1)]
    want = sorted((k * 7 // len(bases), *base) for k, base in enumerate(bases))
    df = spark.createDataFrame(rows, "contig string, start long, stop long").repartition(3)
    got = intervals.balanced_shards(df, 7, ["contig", "start"], block=block).collect()
    assert sorted((r.shard, r.contig, p) for r in got for p in range(r.start, r.stop + 1)) == want


def test_views_have_more_loci_with_more_keys(spark, tmp_path):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    later = orders.withColumn("o_orderkey", F.col("o_orderkey") + 150_000).select(orders.columns)
    orders.unionByName(later).write.parquet(f"{tmp_path}/orders.parquet")
    first, both = (view(spark, d, "copy_ratios").agg(F.max("start"), F.countDistinct("contig", "start")).first() for d in (DATA, str(tmp_path)))
    assert both[0] == first[0] + 500 and both[1] == 2 * first[1]


def test_free_slots_of_a_long_interval(spark):
    rows = [("1", p, 100, 100_000_000, 0) for p in (99_999_999, 99_999_997, 99_999_996, 100, 150)] + [("1", 100_000_000 + i, 100, 100_000_000, i) for i in (1, 2, 3)]
    rows += [("1", p, 5, 8, 0) for p in (6,)] + [("1", 9 + i, 5, 8, 1 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "contig string, position long, start long, stop long, distance int")
    got = allelic.relocate_to_free_slots(df, ["contig"], ["position"])
    assert sorted((r.position, r.start) for r in got.collect()) == sorted([(p, 100) for p in (99_999_999, 99_999_997, 99_999_996, 100, 150, 99_999_998, 99_999_995, 99_999_994)] + [(6, 5), (7, 5)])


def test_tangent_against_least_squares(spark):
    rng = np.random.default_rng(0)
    n, x = rng.normal(size=(50, 4)), rng.normal(size=(50, 3))
    table = lambda m, name: spark.createDataFrame([(f"{name}{j}", "1", i, i, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], "sample string, contig string, start long, stop long, log2_cr double")
    for k in (4, 2):
        u = np.linalg.svd(n, full_matrices=False)[0][:, :k]
        want = x - u @ (u.T @ x)
        got = {(r.sample, r.start): r.log2_cr for r in coverage.tangent_normalize(table(x, "t"), table(n, "n"), k).collect()}
        assert all(got[f"t{j}", i] == pytest.approx(want[i, j], abs=1e-9) for i in range(50) for j in range(3))


def test_tangent_of_a_cohort(spark):
    """More normals than a tile, columns that lack intervals, an interval that no normal has, against NumPy."""
    rng = np.random.default_rng(1)
    n, x = rng.normal(size=(40, 30)) @ rng.normal(size=(30, 30)) ** 3, rng.normal(size=(43, 5))
    n[rng.random(n.shape) < 0.2] = 0.0
    x[rng.random(x.shape) < 0.2] = 0.0
    table = lambda m, name: spark.createDataFrame([(f"{name}{j}", "1", i, i, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1]) if m[i, j]], "sample string, contig string, start long, stop long, log2_cr double")
    for k in (30, 7):
        u = np.linalg.svd(n, full_matrices=False)[0][:, :k]
        want = x.copy()
        want[:40] -= u @ (u.T @ x[:40])
        got = {(r.sample, r.start): r.log2_cr for r in coverage.tangent_normalize(table(x, "t"), table(n, "n"), k, tile=8).collect()}
        assert len(got) == np.count_nonzero(x)
        assert all(v == pytest.approx(want[i, int(s[1:])], abs=1e-8) for (s, i), v in got.items())
    with pytest.raises(ValueError, match="normals"):
        coverage.tangent_normalize(table(x, "t"), table(n, "n"), max_normals=29)


def test_long_islands_are_cut(spark):
    """Unbroken islands in parts of a few rows each: constant, noisy, drifting and jumping values, gaps, nulls, null keys."""
    draw = random.Random(13)
    rows = []
    for key, step in (("constant", lambda v: 1.0), ("noise", lambda v: draw.uniform(0, 0.09)), ("noise over", lambda v: draw.uniform(0, 0.14)), ("drift", lambda v: v + draw.uniform(-0.02, 0.05)), ("walk", lambda v: v + draw.uniform(-0.08, 0.08)), ("steps", lambda v: v + draw.choice([0, 0, 0, 0, 0.1, -0.1])), (None, lambda v: draw.uniform(0, 0.12))):
        v = 0.0
        for i in range(600):
            v = step(v)
            rows.append((key, "1", 10 * i, 10 * i + draw.choice([9, 10, 10]), v, None if key == "walk" and i % 97 == 5 else v / 2))
    df = spark.createDataFrame(rows, "sample string, contig string, start long, stop long, u double, v double").repartition(3)
    short = sorted(map(str, intervals.merge_abutting(df, ["sample", "contig"], ["u", "v"], tolerance=0.1).collect()))
    cut = intervals.merge_abutting(df, ["sample", "contig"], ["u", "v"], tolerance=0.1, long=250)
    assert sorted(map(str, cut.collect())) == short
    as_array = df.select("sample", "contig", "start", "stop", F.array("u", "v").alias("w"))
    got = intervals.merge_abutting(as_array, ["sample", "contig"], "w", tolerance=0.1, long=500).select("sample", "contig", "start", "stop", F.col("w")[0].alias("u"), F.col("w")[1].alias("v"))
    assert sorted(map(str, got.collect())) == short
    assert 0 < len(short) < len(rows)


@pytest.mark.parametrize("tiles", [1, 64])
def test_pairs_of_samples_by_products(spark, tiles):
    """Patients of several numbers of samples, more samples than a tile, loci that some lack, against counting."""
    draw = random.Random(9)
    rows = [(p, f"s{s}", c, i, draw.randrange(3)) for p, n in (("A", 7), ("B", 2), ("C", 1), (None, 3)) for s in range(n) for c in "12" for i in range(40) if draw.random() < 0.6]
    df = spark.createDataFrame(rows, "patient string, sample string, contig string, position int, code int").where("patient IS NOT NULL").repartition(5)
    got = {(r.patient, r.sample_a, r.sample_b, i, j): r[f"c{i}{j}"] for r in pairs.pair_tables(df, ["patient"], tile=3, tiles=tiles).collect() for i in range(3) for j in range(3) if r[f"c{i}{j}"]}
    at = {}
    for p, s, c, i, code in rows:
        if p:
            at.setdefault((p, c, i), {})[s] = code
    assert got == Counter((p, a, b, x[a], x[b]) for (p, _, _), x in at.items() for a in x for b in x if a < b)
    assert pairs.pair_tables(df.limit(0).drop("patient")).count() == 0


def test_dense_order_over_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("contig")).repartition(7)
    assert [(r.v, r.place) for r in dense_order(df.orderBy("v")).orderBy("place").collect()] == [(i, i + 1) for i in range(1000)]


def test_medians_of_large_groups(spark):
    draw = random.Random(5)
    groups = {"a": [draw.gauss(0, 1) for _ in range(501)], "b": [draw.choice([1.0, 2.0]) for _ in range(400)], "c": [7.5], "d": [1e-300, 1e300, -1e300, 3.0], "e": [float("-inf"), float("inf"), 2.0, 3.0], "f": [10.0**draw.randrange(-40, 40) for _ in range(300)], "g": [5.0] * 99, None: [1.0, 4.0]}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("h", None), ("a", float("nan"))]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.m for r in medians.group_medians(df, ["g"], "v", "m", buckets=64).collect()}
    assert got == {g: float(np.median(v)) for g, v in groups.items()}
    assert medians.group_medians(df.limit(0), ["g"], "v", "m").count() == 0


def test_a_cohort_is_its_patients(spark):
    whole = q_cohort.cohort_in(spark, DATA)
    tables = ("members", "reads", "calls", "runs", "segments", "contaminations", "ratios", "modeled", "solutions")
    names = ("read_counts", "variants", "genotypes", "allelic_counts", "filtered_segments", "absolute")

    def run(patients):
        part = replace(whole, **{t: getattr(whole, t).where(F.col("patient").isin(*patients)) for t in tables})
        rows = lambda df: df.select(*sorted(df.columns)).collect()
        return {n: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows(getattr(part, n))), key=str) for n in names}

    every, one, two = run(["P0", "P1"]), run(["P0"]), run(["P1"])
    assert all(every[name] == sorted(one[name] + two[name], key=str) and one[name] and two[name] for name in names)


def test_groups_of_samples_are_harmonized_alone(spark):
    """Patients of one, two and three samples in one job, against harmonize() for each; a null normal takes nothing away."""
    draw = random.Random(3)
    members = [("A", "x", "x"), ("B", "x", "y"), ("B", "y", "y"), ("C", "x", None), ("C", "y", None), ("C", "z", None)]
    rows = [(p, s, c, a, a + draw.randrange(4, 30), draw.randrange(3) / 4, draw.choice("+00"), i) for i, (p, s, c, a) in enumerate((p, s, c, draw.randrange(200)) for p, s, _ in members for c in "12" for _ in range(25))]
    df = spark.createDataFrame(rows, "patient string, sample string, contig string, start long, stop long, log2_cr double, call string, ord int")
    how = {"log2_cr": "max", "call": "first"}
    got = harmonize.harmonize_groups(df, how, spark.createDataFrame(members, "patient string, sample string, matched_normal string"), germline=True, minimum=3)
    got = {p: sorted(map(tuple, got.where(F.col("patient") == p).drop("patient").collect())) for p in "ABC"}
    for p in "ABC":
        samples = sorted(s for q, s, _ in members if q == p)
        normal = next(n for q, _, n in members if q == p)
        assert got[p] == sorted(map(tuple, harmonize.harmonize(df.where(F.col("patient") == p), how, samples, normal=normal, minimum=3).collect())) and got[p]


def test_counts_with_zeros_and_numbers_by_group(spark):
    targets = spark.createDataFrame([("1", 1, 10), ("1", 5, 20), ("2", 1, 5)], "contig string, start long, stop long")
    reads = spark.createDataFrame([("a", "1", 6), ("a", "1", 6), ("b", "1", 20), ("b", "3", 1)], "sample string, contig string, start long")
    counts = coverage.count_reads_of(targets.union(targets), reads, ["sample"])
    assert sorted(map(tuple, counts.collect())) == [("a", "1", 1, 10, 2), ("a", "1", 5, 20, 2), ("b", "1", 5, 20, 1)]
    full = sorted((r.contig, r.start, r.sample, r["count"]) for r in coverage.with_zeros(counts, targets, ["a", "b", "c"]).collect())
    assert full == [("1", 1, "a", 2), ("1", 1, "b", 0), ("1", 1, "c", 0), ("1", 5, "a", 2), ("1", 5, "b", 1), ("1", 5, "c", 0), ("2", 1, "a", 0), ("2", 1, "b", 0), ("2", 1, "c", 0)]
    # a group's number of samples is no other group's
    loci = spark.createDataFrame([("P", "1", 1, 2, "a", 1.0), ("Q", "1", 1, 2, "a", 1.0), ("Q", "1", 1, 2, "b", 1.0)], "patient string, contig string, start long, stop long, sample string, v double")
    n = spark.createDataFrame([("P", 2), ("Q", 2), ("R", 1)], "patient string, n int")
    assert sorted(r.patient for r in harmonize.in_all_samples(loci, ["v"], n, ["patient", "contig"]).collect()) == ["Q", "Q"]


def test_missing_files_and_empty_annotations(spark, tmp_path):
    with pytest.warns(UserWarning, match="no file"):
        rows = readers.read_tolerant(spark, f"{tmp_path}/nothing.seg", readers.SEGMENTS)
    assert rows.count() == 0 and rows.columns == ["contig", "start", "stop", "minor_allele_fraction"]
    maf = writers.empty_maf(spark)
    assert maf.count() == 0 and maf.columns[:2] == ["Hugo_Symbol", "Entrez_Gene_Id"] and len(set(maf.columns)) == len(maf.columns)


@pytest.mark.parametrize("range_bytes", [700, 70_000, 1 << 30])
def test_block_gzipped_lines(spark, tmp_path, range_bytes):
    """Ranges shorter than a block, some blocks long, and whole files; lines longer than blocks and ranges."""
    draw = random.Random(7)
    noise = lambda n: "".join(draw.choice("ACGTacgt01 é\t") for _ in range(n))
    files = {"a": [noise(draw.randrange(60)) for _ in range(9000)], "b": ["", "x" * 300_000, "", noise(150_000), "end"], "c": ["one"], "d": []}
    want = {}
    for name, lines in files.items():
        df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) if lines else spark.createDataFrame([], "value string")
        made = blocks.write_lines(df, f"{tmp_path}/{name}").collect()
        for r in made:
            raw = open(r.file, "rb").read()
            assert gzip.decompress(raw).decode() == "".join(f"{x}\n" for x in lines) and len(raw) == r.bytes
            n, *index = struct.unpack(f"<{(os.path.getsize(r.file + '.gzi')) // 8}Q", open(r.file + ".gzi", "rb").read())
            assert n == len(index) / 2 == max(r.blocks - 1, 0)
            assert all(raw[at : at + 4] == blocks.MAGIC and gzip.decompress(raw[at:]).decode() == "".join(f"{x}\n" for x in lines).encode()[plain:].decode(errors="strict") for at, plain in zip(index[:6:2], index[1:6:2], strict=True) if name == "b")
            want[r.file] = lines
    with open(tmp_path / "plain.bgz", "wb") as out:  # members that do not tell their size, and no line end at last
        out.write(gzip.compress(b"p\r\nq\n") + gzip.compress(b"r" * 200_000))
    want[str(tmp_path / "plain.bgz")] = ["p", "q", "r" * 200_000]
    rows = blocks.read_lines(spark, sorted(want), range_bytes).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.path, r.start, r.line)):
        got.setdefault(r.path.removeprefix("file:").replace("//", "/"), []).append(r.value)
    assert got == {f: x for f, x in want.items() if x}
    tasks = {r.start for r in rows if "/a/" in r.path}
    assert len(tasks) > (1 if range_bytes < 1 << 30 else 0)


def test_block_gzipped_tables(spark, tmp_path):
    lines = ["#<METADATA>SAMPLE=s", "contig\tstart\tend\tmaf", *(f"{i % 3}\t{i}\t{i + 5}\tNA" for i in range(500)), "# later", ""]
    blocks.write_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), f"{tmp_path}/t")
    with open(tmp_path / "u.seg", "w") as out:
        out.write("\n".join(lines[:4]) + "\n")
    rows = readers.read_table(spark, [f"{tmp_path}/t/*.bgz", f"{tmp_path}/u.seg"], readers.SEGMENTS)
    assert sorted(map(tuple, rows.collect())) == sorted([*((str(i % 3), i, i + 5, None) for i in range(500)), ("0", 0, 5, None), ("1", 1, 6, None)])


def test_a_header_over_many_splits_stays_in_order(spark, tmp_path):
    names = [f"c{(i * 7919) % 3000}" for i in range(3000)]
    with open(tmp_path / "h.vcf", "w") as out:
        out.write("".join(f"##contig=<ID={c},length=1>\n" for c in names))
    with open(tmp_path / "h.dict", "w") as out:
        out.write("@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:{c}\tLN:{i}\n" for i, c in enumerate(names)))
    for k in (1, 2):
        with open(tmp_path / f"{k}.contamination", "w") as out:
            out.write("sample\tcontamination\terror\n" + "".join(f"s{k}\t0.{i}\t0\n" for i in range(k, 3000)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        assert spark.read.text(f"{tmp_path}/h.vcf").rdd.getNumPartitions() > 5
        for rows in (readers.read_vcf_contigs(spark, f"{tmp_path}/h.vcf"), readers.read_dictionary(spark, f"{tmp_path}/h.dict")):
            assert [(r.contig, r.ord) for r in rows.orderBy("ord").collect()] == [(c, i) for i, c in enumerate(names)]
        first = readers.read_contamination(spark, f"{tmp_path}/*.contamination").collect()
        assert sorted((r.sample, r.contamination, r.error) for r in first) == [("s1", 0.1, 1e-6), ("s2", 0.2, 1e-6)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_blocks_give_what_loops_over_positions_give(spark):
    """Blocks far smaller than the intervals: running values are carried over many borders, and null keys stay."""
    draw = random.Random(11)
    some = lambda n, longest: [(draw.choice(["1", "2", None]), at, at + draw.randrange(longest)) for at in (draw.randrange(-40, 400) for _ in range(n))]
    rows, banned = some(90, 60), some(25, 9)
    df, drop = (spark.createDataFrame(r, "contig string, start long, stop long") for r in (rows, banned))
    keys = ["contig"]
    depth = Counter((c, p) for c, a, z in rows for p in range(a, z + 1))
    out = {(c, p) for c, a, z in banned for p in range(a, z + 1)}
    spread = lambda got: Counter((r.contig, p) for r in got for p in range(r.start, r.stop + 1))

    runs = intervals.depth_runs(df, keys, block=16).collect()
    assert {(r.contig, p): r.depth for r in runs for p in range(r.start, r.stop + 1)} == dict(depth)
    merged = intervals.merge_overlapping(df, keys, gap=1, block=16).collect()
    assert spread(merged) == Counter(set(depth)) and not any((r.contig, r.start - 1) in depth or (r.contig, r.stop + 1) in depth for r in merged)
    left = intervals.subtract(df, drop, keys, block=16).collect()
    stays = set(depth) - out
    assert spread(left) == Counter(stays) and not any((r.contig, r.start - 1) in stays or (r.contig, r.stop + 1) in stays for r in left)
    state = lambda n: "LOW_COVERAGE" if n < 3 else "EXCESSIVE_COVERAGE" if n > 5 else "CALLABLE"
    loci = intervals.callable_loci(df, keys, 3, 5, block=16).collect()
    assert {(r.contig, p): r.state for r in loci for p in range(r.start, r.stop + 1)} == {k: state(n) for k, n in depth.items()}
    assert len(loci) == sum((c, p - 1) not in depth or state(depth[c, p - 1]) != state(n) for (c, p), n in depth.items())
    for one, other in ((intervals.elementary_intervals(df, keys, block=b) for b in (16, 1 << 20)), (intervals.covered_regions(df, keys, 3, 4, block=b) for b in (16, 1 << 20))):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_short_intervals_do_not_meet_in_wide_bins(spark):
    n = 500
    left = spark.range(n).selectExpr("'1' AS contig", "id * 1000 AS start", "id * 1000 + 5 AS stop")
    right = spark.range(n).selectExpr("'1' AS contig", "id * 1000 + 5 AS r_start", "id * 1000 + 7 AS r_stop").union(spark.createDataFrame([("1", 0, 10_000_000)], "contig string, r_start long, r_stop long"))
    widths = [64 * rangejoin.FAN**k for k in range(4)]
    one = rangejoin._cover(left, "start", "stop", widths, (0,), 1)
    two = rangejoin._cover(right, "r_start", "r_stop", widths, (0, 1), 0)
    assert one.join(two, ["contig", "_level", "_bin", "_role"]).count() <= 4 * n  # over 500,000 without roles
    assert overlap_join(left, right.withColumnsRenamed({"r_start": "start", "r_stop": "stop"}), ["contig"], bin_=64).count() == 2 * n


def test_sql_of_merged_overlaps_leaves_no_ties(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i AS p_partkey, (hash(i) % 50)::INT + 1 AS p_size FROM range(240000) AS t(i)) TO '{tmp_path}/part.parquet'")
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    df = intervals.merge_overlapping(view(spark, str(tmp_path), "targets"), ["contig"])
    want = sorted(map(tuple, df.select("contig", "start", "stop").collect()))
    assert all(sorted(con.execute(f"SELECT contig, start, stop FROM ({catalog.SQL['i4_merge_overlapping']})").fetchall()) == want for _ in range(3))


def test_large_log_gammas_round_as_in_sql(spark, tmp_path):
    con = duckdb.connect()
    keys = "(8225012, 1099408), (3309205, 452533), (8331536, 1112279)"
    con.execute(f"COPY (SELECT l.* REPLACE (k.o AS l_orderkey, k.p AS l_partkey) FROM (SELECT * FROM '{DATA}/lineitem.parquet' LIMIT 1) AS l, (VALUES {keys}) AS k(o, p)) TO '{tmp_path}/lineitem.parquet'")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    got = catalog.QUERIES["t2_lgamma"](spark, str(tmp_path)).select("y", "n").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT y, n FROM ({catalog.SQL['t2_lgamma']})").fetchall())


def test_bins_are_dealt_over_all_partitions(spark):
    ratios = spark.range(200).selectExpr("'1' AS contig", "id * 3 AS start", "id * 3 + 40 AS stop", "id AS ord")
    pairs = intervals.disjoin(ratios, ["contig"])
    tasks = pairs.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))  # adaptive execution made one of them


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_merging_runs_takes_one_shuffle_and_sorts_by_a_hash(spark):
    optimized, executed = _plan(pileups.merge_pileups(view(spark, DATA, "pileup_runs")))
    assert executed.count("Exchange ") == 1 and "xxhash64" in optimized


def test_lgammas(spark):
    xs = [0.001, 0.5, 1.0, 2.0, 3.7, 40.0, 740.0, 1e5]
    rows = spark.createDataFrame([(xs,), ([0.0, None, -1.0, 2.0],), ([],)], "xs array<double>").select(lgammas(F.col("xs")).alias("y")).collect()
    assert rows[0].y == pytest.approx([math.lgamma(x) for x in xs], rel=1e-12, abs=1e-11)
    assert rows[1].y[:3] == [None] * 3 and rows[1].y[3] == pytest.approx(0, abs=1e-11) and rows[2].y == []


def test_likelihoods_read_their_pileups_from_a_table(spark):
    optimized, _ = _plan(q_pileups.likelihoods(spark, DATA))
    assert "row_number" not in optimized  # runs were merged anew for the loci, for their segments and for the error rates


def test_joint_vcf_makes_likelihoods_once(spark, monkeypatch):
    calls, real = [], genotype.genotype_likelihoods
    monkeypatch.setattr(genotype, "genotype_likelihoods", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert catalog.QUERIES["k3_write_joint_vcf"](spark, DATA).count() > 0 and len(calls) == 1


def test_standardizing_makes_its_counts_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"S{s}", "1", i, i, float(1 + (i * 7 + s * 3) % 11)) for s in range(3) for i in range(50)]
    counts = spark.createDataFrame(rows, "sample string, contig string, start long, stop long, count double")
    got = {(r.sample, r.start): r.log2_cr for r in coverage.standardize(counts.mapInArrow(watched, counts.schema)).collect()}
    assert seen.value == 150
    c = np.array([x[4] for x in rows]).reshape(3, 50)
    c /= np.median(c, axis=1, keepdims=True)
    want = np.log2(np.maximum(c / np.median(c, axis=0), 1e-3))
    assert all(got[(f"S{s}", i)] == pytest.approx(want[s, i]) for s in range(3) for i in range(50))


def test_filters_take_info_apart_once(spark):
    optimized, executed = _plan(pipelines.filter_variants(view(spark, DATA, "variants")))
    assert optimized.count("str_to_map") == 1 and "Exchange hashpartitioning(contig" in executed


def test_a_sample_is_written_by_several_tasks(spark, tmp_path):
    rows = view(spark, DATA, "modeled_segments")
    columns = ["contig", "start", "stop", "n_probes", "n_hets", "cr10", "cr50", "cr90", "maf10", "maf50", "maf90", "call"]
    q_files.text_files(rows, columns, f"{tmp_path}/a", "\t".join(columns), "@RG\tID:1\tSM:%s", F.col("contig"))
    files = list((tmp_path / "a" / "file=S0").glob("*/part-*"))
    assert len(files) > 1 and all(f.read_text().startswith("@RG\tID:1\tSM:S0\ncontig\tstart") for f in files)
    back = readers.read_modeled_segments(spark, f"{tmp_path}/a")
    assert sorted((r.sample, r.start) for r in back.collect()) == sorted((r.sample, r.start) for r in rows.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_table(rows.select("sample", "contig", "start"), f"{tmp_path}/b", ["sample"], ["contig", "start"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "b" / "sample=S0").glob("part-*"))) > 1


def test_biases_do_not_merge_runs_again(spark):
    assert "row_number" not in _plan(catalog.QUERIES["t5_reference_bias"](spark, DATA))[0]
