"""Copy ratios of several samples on one set of loci."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .intervals import count_in_intervals, disjoin, merge_abutting

#: Aggregates by name; each takes the value and the column that orders the input.
AGGREGATES: dict[str, Callable[[Column, Column], Column]] = {
    "strongest_signal": lambda v, o: F.max_by(v, F.struct(F.abs(v), -o)),
    "error_mean": lambda v, o: F.sqrt(F.avg(v * v)),
    "first": lambda v, o: F.min_by(v, o),
    "last": lambda v, o: F.max_by(v, o),
    "mean": lambda v, o: F.avg(v),
    "min": lambda v, o: F.min(v),
    "max": lambda v, o: F.max(v),
    "sum": lambda v, o: F.sum(v),
    "median": lambda v, o: F.median(v),
    "std": lambda v, o: F.stddev(v),
    "count": lambda v, o: F.count(v),
}


def aggregate(df: DataFrame, by: Sequence[str], how: Mapping[str, str | Callable[[Column, Column], Column]], order: str = "ord") -> DataFrame:
    """One row per `by`, each column by its aggregate: a name of AGGREGATES or a function of (value, order)."""
    return df.groupBy(*by).agg(*((f if callable(f) else AGGREGATES[f])(F.col(c), F.col(order)).alias(c) for c, f in how.items()))


def harmonize_loci(ratios: DataFrame, how: Mapping[str, str], keys: Sequence[str] = ("contig",), order: str = "ord") -> DataFrame:
    """Samples' intervals split where any sample's starts or ends, one row per elementary interval and sample."""
    return aggregate(disjoin(ratios, keys), [*keys, "start", "stop", "sample"], how, order)


def in_all_samples(loci: DataFrame, values: Sequence[str], n_samples: DataFrame, keys: Sequence[str] = ("contig",)) -> DataFrame:
    """Loci for which every sample has all values; n_samples has one row with column n, or one for each value of some of
    the keys."""
    by = [*keys, "start", "stop"]
    of = [k for k in keys if k in n_samples.columns]
    ok = F.lit(True)
    for v in values:
        ok &= F.col(v).isNotNull()
    full = loci.where(ok).groupBy(*by).agg(F.count_distinct("sample").alias("_n"))
    full = full.join(n_samples.select(*of, F.col("n").cast("long").alias("_n")), [*of, "_n"]).select(*by)
    return loci.join(full, by, "left_semi")


def drop_germline(loci: DataFrame, normal: str, call: str = "call", keys: Sequence[str] = ("contig",)) -> DataFrame:
    """Loci that the normal sample does not call as gained (+) or lost (-)."""
    by = [*keys, "start", "stop"]
    called = loci.where((F.col("sample") == normal) & F.col(call).isin("+", "-")).select(*by).distinct()
    return loci.join(called, by, "left_anti")


def min_length(intervals: DataFrame, n: int) -> DataFrame:
    return intervals.where(F.col("stop") - F.col("start") + 1 >= n)


def pivot_samples(loci: DataFrame, values: Sequence[str], samples: Sequence[str], keys: Sequence[str] = ("contig",)) -> DataFrame:
    """A row per locus with a column <value>_<sample> each; for export, everything else stays long."""
    cells = [F.max(F.when(F.col("sample") == s, F.col(v))).alias(f"{v}_{s}") for v in values for s in samples]
    return loci.groupBy(*keys, "start", "stop").agg(*cells)


def stack_samples(wide: DataFrame, value: str, samples: Sequence[str], keys: Sequence[str] = ("contig",)) -> DataFrame:
    """The long form of one value of pivot_samples(); cells without a value go."""
    long = wide.unpivot([*keys, "start", "stop"], [f"{value}_{s}" for s in samples], "sample", value)
    return long.withColumn("sample", F.substring("sample", len(value) + 2, 1 << 20)).where(F.col(value).isNotNull())


def observed(df: DataFrame, name: str, into: dict[str, Observation] | None) -> DataFrame:
    """df, its rows counted as they pass by: into[name].get["loci"] after an action."""
    if into is None:
        return df
    into[name] = Observation(name)
    return df.observe(into[name], F.count(F.lit(1)).alias("loci"))


def harmonize(ratios: DataFrame, how: Mapping[str, str], samples: Sequence[str], rule: str = "INTERSECTION", normal: str | None = None, minimum: int = 1, distance: int = 1, tolerance: float = 1e-3, keys: Sequence[str] = ("contig",), order: str = "ord", progress: dict[str, Observation] | None = None) -> DataFrame:
    """keys, start, stop, sample, values on common loci.

    Split and aggregate; keep loci that all samples have (rule INTERSECTION, else UNION); drop what the normal calls
    (values must hold `call` then); merge abutting loci whose values are alike in all samples; drop short loci.
    progress is filled with counts of rows after each step: input, harmonized, common, germline (a row a sample and
    locus), loci, merged, long (a row a locus).
    """
    keys = list(keys)
    loci = observed(harmonize_loci(observed(ratios, "input", progress), how, keys, order), "harmonized", progress)
    spark = ratios.sparkSession
    if rule == "INTERSECTION":
        loci = in_all_samples(loci, list(how), spark.createDataFrame([(len(samples),)], "n long"), keys)
        loci = observed(loci, "common", progress)
    values = [v for v in how if v != "call"]
    if normal is not None:
        loci = observed(drop_germline(loci, normal, keys=keys), "germline", progress)
    # a locus has one array of numbers, sample by sample, so the plan does not grow with the samples
    per_locus = loci.groupBy(*keys, "start", "stop").agg(F.map_from_entries(F.collect_list(F.struct("sample", F.array(*(F.col(v).cast("double") for v in values))))).alias("_m"))
    nothing = F.array(*(F.lit(None).cast("double") for _ in values))
    cells = F.flatten(F.transform(F.array(*map(F.lit, samples)), lambda s: F.coalesce(F.try_element_at("_m", s), nothing)))
    rows = observed(per_locus.select(*keys, "start", "stop", cells.alias("_cells")), "loci", progress)
    merged = observed(merge_abutting(rows, keys, "_cells", distance, tolerance), "merged", progress)
    merged = observed(min_length(merged, minimum), "long", progress)
    one = lambda i: F.struct(F.element_at(F.array(*map(F.lit, samples)), i + 1).alias("sample"), *(F.element_at("_cells", i * len(values) + (k + 1)).alias(v) for k, v in enumerate(values)))
    long = merged.select(*keys, "start", "stop", F.explode(F.transform(F.sequence(F.lit(0), F.lit(len(samples) - 1)), one)).alias("c")).select(*keys, "start", "stop", "c.*")
    some = F.lit(False)
    for v in values:
        some |= F.col(v).isNotNull()
    return long.where(some)


def harmonize_groups(ratios: DataFrame, how: Mapping[str, str], members: DataFrame, group: str = "patient", rule: str = "INTERSECTION", germline: bool = False, minimum: int = 1, distance: int = 1, tolerance: float = 1e-3, keys: Sequence[str] = ("contig",), order: str = "ord") -> DataFrame:
    """group, keys, start, stop, sample, values: harmonize() of every group's samples on the group's own loci, in one job.

    members has a row (group, sample, matched_normal) for each sample; a group's arrays hold its own samples only, sorted
    by name.  With germline, loci that a group's matched normal calls as gained or lost go (values must hold `call`).
    """
    by = [group, *keys]
    groups = members.groupBy(group).agg(F.sort_array(F.collect_set("sample")).alias("_samples"), F.max("matched_normal").alias("_normal"))
    loci = harmonize_loci(ratios.join(members.select(group, "sample").distinct(), [group, "sample"]), how, by, order)
    if rule == "INTERSECTION":
        loci = in_all_samples(loci, list(how), groups.select(group, F.size("_samples").alias("n")), by)
    values = [v for v in how if v != "call"]
    if germline:
        normals = groups.where("_normal IS NOT NULL").select(group, F.col("_normal").alias("sample"))
        called = loci.where(F.col("call").isin("+", "-")).join(normals, [group, "sample"]).select(*by, "start", "stop").distinct()
        loci = loci.join(called, [*by, "start", "stop"], "left_anti")
    per_locus = loci.groupBy(*by, "start", "stop").agg(F.map_from_entries(F.collect_list(F.struct("sample", F.array(*(F.col(v).cast("double") for v in values))))).alias("_m"))
    nothing = F.array(*(F.lit(None).cast("double") for _ in values))
    cells = F.flatten(F.transform("_samples", lambda s: F.coalesce(F.try_element_at("_m", s), nothing)))
    rows = per_locus.join(groups.select(group, "_samples"), group).select(*by, "start", "stop", cells.alias("_cells"))
    merged = min_length(merge_abutting(rows, by, "_cells", distance, tolerance), minimum).join(groups.select(group, "_samples"), group)
    long = merged.select(*by, "start", "stop", "_cells", F.posexplode("_samples").alias("_i", "sample"))
    long = long.select(*by, "start", "stop", "sample", *(F.element_at("_cells", F.col("_i") * len(values) + (k + 1)).alias(v) for k, v in enumerate(values)))
    return long.where(F.coalesce(*values).isNotNull())


def harmonize_segments(segments: DataFrame, keys: Sequence[str] = ("sample", "contig"), value: str = "minor_allele_fraction", tolerance: float = 1e-3) -> DataFrame:
    """One set of segments per group: split, the smallest value of each piece, alike neighbours merged."""
    pieces = disjoin(segments, keys).groupBy(*keys, "start", "stop").agg(F.min(value).alias(value))
    return merge_abutting(pieces, keys, [value], tolerance=tolerance)


def filter_segments(segments: DataFrame, probes: DataFrame, hets: DataFrame, how: Mapping[str, str], samples: Sequence[str], normal: str | None, minimum: int = 1, keys: Sequence[str] = ("contig",)) -> DataFrame:
    """Harmonized segments without germline events, with the numbers of probes and hets that each holds now.

    probes and hets have sample, the keys and position.
    """
    out = harmonize(segments, how, samples, normal=normal, minimum=minimum, keys=keys)
    out = count_in_intervals(out, probes, ["sample", *keys], name="n_probes")
    return count_in_intervals(out, hets, ["sample", *keys], name="n_hets")
