"""Operators on genomic intervals, closed and 1-based, within groups of key columns (contig, or patient and contig)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.scratch import kept

from .blocks import BLOCK, in_blocks, running
from .rangejoin import overlap_join, range_join


def elementary_intervals(intervals: DataFrame, keys: Sequence[str], drop_slivers: bool = True, block: int = BLOCK) -> DataFrame:
    """keys, start, stop: the covered stretches between neighbouring starts and ends of any interval.

    Stretches of length 0 do not arise; with drop_slivers one of length 1 between two longer ones that touch it goes.
    """
    keys = list(keys)
    ends = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("stop").alias("at"), F.lit(-1).alias("d"))))
    points = intervals.select(*keys, ends.alias("e")).groupBy(*keys, F.col("e.at").alias("start")).agg(F.sum("e.d").alias("_d"))
    cut = running(in_blocks(points, keys, "start", block), keys, ["start"], sums={"_open": "_d"}, leads={"stop": "start"})
    cut = cut.where("stop IS NOT NULL AND _open > 0").drop("_d", "_open")
    if drop_slivers:
        cut = running(cut, keys, ["start"], lags={"_start0": "start", "_stop0": "stop"}, leads={"_start2": "start", "_stop2": "stop"})
        sliver = F.expr("stop - start <= 1 AND _stop0 = start AND _start2 = stop AND _stop0 - _start0 > 1 AND _stop2 - _start2 > 1")
        cut = cut.where(~F.coalesce(sliver, F.lit(False)))
    return cut.select(*keys, "start", "stop")


def disjoin(intervals: DataFrame, keys: Sequence[str], drop_slivers: bool = True) -> DataFrame:
    """Every interval's row once for each elementary interval in it, with that one's start and stop."""
    pieces = elementary_intervals(intervals, keys, drop_slivers).withColumn("_at", F.col("start"))
    named = intervals.withColumnsRenamed({"start": "_start", "stop": "_stop"})
    return range_join(pieces, named, keys, position="_at", start="_start", stop="_stop", closed=False).drop("_at", "_start", "_stop")


#: An island of more rows is cut into parts of about an eighth of that.
LONG = 1 << 21


def _run_ends(values: np.ndarray, island: np.ndarray, tolerance: float) -> np.ndarray:
    """The last rows of runs: within an island (a slice of equal numbers) a run goes on while all values are within
    tolerance of its first row's."""
    n = len(island)
    borders = np.flatnonzero(np.diff(island)) + 1
    starts, stops = np.concatenate([[0], borders]), np.concatenate([borders, [n]])
    last = np.zeros(n, bool)
    last[stops - 1] = True
    for low, high in zip(starts[stops - starts > 1].tolist(), stops[stops - starts > 1].tolist(), strict=True):
        while low < high - 1:
            step, at = 32, low + 1
            while at < high:  # look ahead in growing steps for the first row that is too far away
                far = ~(np.abs(values[at : min(at + step, high)] - values[low]) < tolerance).all(1)
                if far.any():
                    at += int(far.argmax())
                    break
                at, step = at + step, 2 * step
            if at >= high:
                break
            last[at - 1] = True
            low = at
    return last


def merge_abutting(intervals: DataFrame, keys: Sequence[str], values: Sequence[str] | str, distance: int = 1, tolerance: float = 1e-3, block: int = BLOCK, long: int = LONG) -> DataFrame:
    """Sequential merge, per group in the order of (start, stop, values): an interval joins the run before it if it starts
    within `distance` of its end and all values are within `tolerance` of the run's first interval; the run keeps
    those values.  Otherwise, if the run ends where the interval starts, it ends one earlier.  Nulls differ from all.
    `values` are names of columns, or the name of one column of arrays, of equal lengths within a group.

    A run surely breaks at a gap, and where neighbours differ by 2 * tolerance or more, since both would have to be within
    tolerance of one value.  Windows in blocks of positions find these islands; only inside an island must rows be compared
    with their run's first one, by NumPy on sorted batches.  Blocks and islands, not contigs, are dealt over tasks; an
    island of more than `long` rows is cut and many tasks' work, see _long_islands().  Cutting needs sizes, so the
    rows are kept as a table first.
    """
    keys = list(keys)
    as_array = isinstance(values, str)
    names = [values] if as_array else list(values)
    order = ["start", "stop", "_v"]
    rows = intervals.select(*keys, "start", "stop", *names).withColumn("_v", F.col(values) if as_array else F.array(*names).cast("array<double>") if names else F.array(F.lit(None).cast("double")))

    def breaks(start: str, end: str, value: str, before: str) -> Column:
        differ = F.exists(F.zip_with(value, before, lambda a, b: F.coalesce(F.abs(a - b) >= 2 * tolerance, F.lit(True))), lambda x: x)
        return (~F.coalesce((F.abs(F.col(start) - F.col(end)) <= distance) & ~differ, F.lit(False))).cast("long")

    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    rows = in_blocks(rows, keys, "start", block).withColumns({"_before": F.lag("_v").over(inside), "_end": F.lag("stop").over(inside), "_next": F.lead("start").over(inside)})
    rows = rows.withColumn("_new", breaks("start", "_end", "_v", "_before"))
    rows = rows.withColumn("_island", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # each block begins an island of its own so far: one row a block tells whether it goes on with the one before
    along, place = Window.partitionBy(*keys).orderBy("_block"), F.struct(*order)
    blocks = rows.groupBy(*keys, "_block").agg(F.max("_island").alias("_n"), F.min("start").alias("_start"), F.min_by("_v", place).alias("_first"), F.max_by("stop", place).alias("_stop"), F.max_by("_v", place).alias("_last"))
    blocks = blocks.withColumns({"_stop0": F.lag("_stop").over(along), "_last0": F.lag("_last").over(along), "_after": F.lead("_start").over(along)})
    blocks = blocks.withColumn("_sum", F.sum(F.col("_n") - 1 + breaks("_start", "_stop0", "_first", "_last0")).over(along))
    rows = rows.join(blocks.select(*keys, "_block", (F.col("_sum") - F.col("_n")).alias("_carry"), "_after"), [*keys, "_block"], "left")
    rows = rows.withColumns({"_island": F.col("_island") + F.coalesce("_carry", F.lit(0)), "_next": F.coalesce("_next", "_after")}).select(*keys, "start", "stop", *names, "_v", "_next", "_island")
    out_schema = rows.select(*keys, "start", "stop", *names).schema
    n = len(keys)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _ending(batches):
            if batch is not None:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
                island = _numbers(held, n)
                done = int(np.searchsorted(island, island[-1]))  # the last island may go on
            else:
                if held is None or not held.num_rows:
                    return
                island, done = _numbers(held, n), held.num_rows
            if done:
                yield from _merged(held.slice(0, done), island[:done], n, len(names), tolerance)
                held = held.slice(done)

    def folded(some: DataFrame) -> DataFrame:
        return some.repartition(*keys, "_island").sortWithinPartitions(*keys, "_island", *order).mapInArrow(fold, out_schema)

    counted = Observation()
    rows = kept(rows.observe(counted, F.count(F.lit(1)).alias("n")))
    if counted.get["n"] <= long:
        return folded(rows)
    by = [*keys, "_island"]
    large = kept(rows.groupBy(*by).agg(F.count("*").alias("_c")).where(F.col("_c") > long))
    total = large.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
    if not total:
        return folded(rows)
    named = F.broadcast(large.select(*(F.col(c).alias(f"_of{i}") for i, c in enumerate(by)), "_c"))  # one row for more than `long` of rows
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_of{i}")) for i, c in enumerate(by)))
    rows = rows.join(named, same, "left").drop(*(f"_of{i}" for i in range(len(by))))
    cut = _long_islands(rows.where("_c IS NOT NULL").drop("_c"), by, order, len(names), tolerance, -(-8 * total // long), out_schema)
    return folded(rows.where("_c IS NULL").drop("_c")).union(cut)


def _long_islands(rows: DataFrame, by: Sequence[str], order: Sequence[str], n_values: int, tolerance: float, parts: int, schema: StructType) -> DataFrame:
    """merge_abutting() of islands that are cut into range partitions.

    A segment is what a partition has of an island.  What it makes of its rows depends on the values of the run that comes
    in from the segment before: rows join that run up to the first that is too far from it, and there a run begins whatever came
    in before.  At first every segment is taken as if a run began with it; then the values that leave each segment are
    handed on in turn (a few numbers a segment, on the driver), over segments whose smallest and largest values keep
    them inside, and segments that get other values than they were tried with are tried again, all at once.  Runs soon begin at
    the same rows wherever one starts, so that two or three rounds do; a segment is tried once for each value it
    really gets, and each round settles one more segment at least.
    """
    n = len(by) - 1
    cut = kept(rows.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order).withColumn("_part", F.spark_partition_id()))
    dealt = lambda: cut.repartition(parts, "_part").sortWithinPartitions("_part", *by, *order)

    def first_far(v: np.ndarray, entry: Sequence[float] | None) -> int:
        if entry is None:
            return 0
        far = ~(np.abs(v - np.array(entry)) < tolerance).all(1)
        return int(far.argmax()) if far.any() else len(v)

    def tried(asked: dict[tuple[int, int], list[tuple[float, ...] | None]]) -> list[dict]:
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, k, some in _segments(batches, n):
                v, stop, after = _rectangle(some.column("_v").combine_chunks()), some.column(n + 1), some.column("_next")
                for entry in asked.get((part, k), ()):
                    at = first_far(v, entry)
                    out = entry
                    if at < len(v):
                        last = _run_ends(v[at:], np.zeros(len(v) - at, np.int64), tolerance)
                        heads = np.flatnonzero(np.append(True, last[:-1])) + at
                        out = v[heads[-1]].tolist()
                    row = {"part": part, "k": k, "entry": entry, "at": at, "rows": len(v), "low": v.min(0), "high": v.max(0), "out": out, "stop": stop[at - 1].as_py() if at else None, "next": after[at - 1].as_py() if at else None, "last_stop": stop[-1].as_py(), "last_next": after[-1].as_py()}
                    columns = [pa.array([x], pa.list_(pa.float64()) if name in ("entry", "low", "high", "out") else pa.int64()) for name, x in row.items()]
                    yield pa.RecordBatch.from_arrays([*columns, *(some.column(c).slice(0, 1).combine_chunks() for c in range(n)), some.column("_island").slice(0, 1).combine_chunks()], names=[*row, *(f"key{i}" for i in range(n + 1))])

        numbers = "part long, k long, entry array<double>, at long, rows long, low array<double>, high array<double>, out array<double>, stop long, next long, last_stop long, last_next long"
        keys_ = ", ".join(f"key{i} {cut.schema[c].dataType.simpleString()}" for i, c in enumerate(by))
        return [r.asDict() for r in dealt().mapInArrow(measure, f"{numbers}, {keys_}").collect()]

    key_of = lambda r: [r[f"key{i}"] for i in range(n + 1)]
    none_of: tuple[float, ...] | None = None
    found = tried(_Every([none_of]))
    segments = sorted(((r["part"], r["k"]) for r in found))
    fresh = {(r["part"], r["k"]): r for r in found}
    known = {(s, none_of): fresh[s] for s in segments}
    while True:
        asked: dict[tuple[int, int], list] = {}
        true: dict[tuple[int, int], dict] = {}
        previous = None
        for s in segments:
            r, entry = fresh[s], none_of
            if previous is not None and key_of(previous) == key_of(r):
                entry = tuple(previous["out"])
                entry = none_of if any(map(math.isnan, entry)) else entry  # nothing joins a run with a null
            if (s, entry) in known:
                r = known[s, entry]
            elif all(h - e < tolerance and e - low < tolerance for e, low, h in zip(entry, r["low"], r["high"], strict=True)):
                r = r | {"entry": list(entry), "at": r["rows"], "out": list(entry), "stop": r["last_stop"], "next": r["last_next"]}
            else:
                asked.setdefault(s, []).append(entry)
            true[s] = previous = r | {"given": entry}
        if not asked:
            break
        for r in tried(asked):
            known[(r["part"], r["k"]), tuple(r["entry"])] = r
    # where the last run of each segment really ends
    ends: dict[tuple[int, int], tuple[int, int | None]] = {}
    owner = None
    for s in segments:
        r = true[s]
        if r["given"] is not None and r["at"]:
            ends[owner] = (r["stop"], r["next"])
        if r["at"] < r["rows"]:
            owner = s
    starts = {s: true[s]["at"] for s in segments}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, k, some in _segments(batches, n):
            some = some.slice(starts[part, k])
            if not some.num_rows:
                continue
            if (part, k) in ends:
                for name, x in zip((some.column_names[n + 1], "_next"), ends[part, k], strict=True):
                    i = some.schema.get_field_index(name)
                    some = some.set_column(i, some.schema.field(i), pa.chunked_array([some.column(i).slice(0, some.num_rows - 1).combine_chunks(), pa.array([x], some.schema.field(i).type)]))
            yield from _merged(some, np.zeros(some.num_rows, np.int64), n, n_values, tolerance)

    return dealt().mapInArrow(emit, schema)


class _Every(dict):
    """The same for every segment."""

    def __init__(self, value: list) -> None:
        super().__init__()
        self.value = value

    def get(self, key: object, default: object = None) -> list:
        return self.value


def _segments(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, int, pa.Table]]:
    """(part, k, rows): the k-th island of each partition, whole."""
    held: pa.Table | None = None
    part, k = None, 0
    for batch in _ending(batches):
        if batch is not None:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if held is None or not held.num_rows:
            continue
        number = _numbers(held, n, "_part")
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), held.num_rows]
        whole = cuts if batch is None else cuts[:-1]  # the last one may go on
        for a, b in zip(whole, whole[1:], strict=False):
            some = held.slice(a, b - a)
            own = some.column("_part")[0].as_py()
            part, k = own, k + 1 if own == part else 0
            yield part, k, some
        held = held.slice(whole[-1])


def _ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches that have rows, then None."""
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _numbers(rows: pa.Table, n: int, *more: str) -> np.ndarray:
    """A rising number for each island: rows with the same n keys and the same _island (and the same of `more`)."""
    change = np.zeros(rows.num_rows, np.int64)
    for column in (*(rows.column(i) for i in range(n)), rows.column("_island"), *map(rows.column, more)):
        code = column.combine_chunks().dictionary_encode()
        code = code.indices.fill_null(-1).to_numpy() if isinstance(code, pa.Array) else code.combine_chunks().indices.fill_null(-1).to_numpy()
        change[1:] |= code[1:] != code[:-1]
    return np.cumsum(change)


def _merged(rows: pa.Table, island: np.ndarray, n: int, n_values: int, tolerance: float) -> Iterator[pa.RecordBatch]:
    v = rows.column("_v").combine_chunks()
    flat = _rectangle(v)
    last = _run_ends(flat, island, tolerance)
    first = np.concatenate([[True], last[:-1]])
    stop, after = rows.column(n + 1).to_numpy().copy(), rows.column("_next").fill_null(np.iinfo(np.int64).min).to_numpy()
    stop -= stop == after  # the interval after starts a run of its own
    heads = rows.filter(pa.array(first))
    columns = [heads.column(i) for i in range(n + 1)] + [pa.chunked_array([pa.array(stop[last])])] + [heads.column(n + 2 + k) for k in range(n_values)]
    yield from pa.table(dict(zip(rows.column_names[: n + 2 + n_values], columns, strict=True))).to_batches()


def _rectangle(lists: pa.Array) -> np.ndarray:
    """Lists as rows of a matrix, nulls as NaN; lists of other groups may be shorter and end with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(sizes.max(initial=0), 1)))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    return out


def merge_overlapping(intervals: DataFrame, keys: Sequence[str], gap: int = 0, block: int = BLOCK) -> DataFrame:
    """Unions of overlapping intervals; with gap=0 those that only abut stay apart, with gap=1 they merge too.

    Of intervals with one start only the longest counts, so a block holds at most a row for each of its positions.
    """
    keys = list(keys)
    rows = in_blocks(intervals.select(*keys, "start", "stop"), keys, "start", block).groupBy(*keys, "_block", "start").agg(F.max("stop").alias("stop"))
    runs = running(rows, keys, ["start"], peaks={"_reach": "stop"})
    return _runs(runs, keys, F.col("start") <= F.col("_reach") + gap).agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_run")


def _runs(rows: DataFrame, keys: Sequence[str], goes_on: Column, *by: str) -> GroupedData:
    """rows of running() grouped by keys and _run: a row for which goes_on is not true begins a run."""
    rows = rows.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("long"))
    return running(rows, keys, ["start"], sums={"_run": "_new"}).groupBy(*keys, "_run", *by)


def subtract(intervals: DataFrame, blacklist: DataFrame, keys: Sequence[str], block: int = BLOCK) -> DataFrame:
    """What of the intervals' union no blacklisted interval covers; both closed."""
    keys = list(keys)
    events = None
    for df, kind in ((intervals, "keep"), (blacklist, "drop")):
        other = "drop" if kind == "keep" else "keep"
        both = df.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias(kind), F.lit(0).alias(other)), F.struct((F.col("stop") + 1).alias("at"), F.lit(-1).alias(kind), F.lit(0).alias(other)))).alias("e")).select(*keys, "e.at", "e.keep", "e.drop")
        events = both if events is None else events.union(both)
    steps = events.groupBy(*keys, F.col("at").alias("start")).agg(F.sum("keep").alias("keep"), F.sum("drop").alias("drop"))
    steps = running(in_blocks(steps, keys, "start", block), keys, ["start"], sums={"_in": "keep", "_out": "drop"}, leads={"_next": "start"})
    # steps leave no gaps, so those with the same number of steps outside before them are one stretch
    steps = steps.withColumns({"stop": F.col("_next") - 1, "_outside": F.when(F.expr("_in > 0 AND _out = 0"), 0).otherwise(1)})
    steps = running(steps.select(*keys, "_block", "start", "stop", "_outside"), keys, ["start"], sums={"_run": "_outside"})
    return steps.where("_outside = 0").groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_run")


def union_minus(intervals: DataFrame, blacklist: DataFrame, keys: Sequence[str], pad_by: int = 0) -> DataFrame:
    """Include lists merged where they overlap, less the blacklist."""
    return subtract(merge_overlapping(pad(intervals, pad_by), keys), blacklist, keys)


def pad(intervals: DataFrame, n: int, length: Column | None = None) -> DataFrame:
    """n more on both sides, but not below 1 nor beyond the contig's length."""
    stop = F.col("stop") + n
    return intervals.withColumns({"start": F.greatest(F.lit(1).cast("long"), F.col("start") - n), "stop": F.least(length, stop) if length is not None else stop})


def tile(intervals: DataFrame, width: int) -> DataFrame:
    """Intervals cut into tiles of `width`, the last one shorter; 0 leaves them as they are."""
    if not width:
        return intervals
    tiles = intervals.withColumn("_at", F.explode(F.sequence(F.col("start"), F.col("stop"), F.lit(width).cast("long"))))
    return tiles.withColumns({"start": F.col("_at"), "stop": F.least(F.col("stop"), F.col("_at") + width - 1)}).drop("_at")


def shard_count(depth: float, base: int, per_shard: float) -> int:
    """Shards for a sequencing depth: the base number, more with depth."""
    return -int(-(base * (depth + 1)) // (per_shard + 1))


def balanced_shards(intervals: DataFrame, shards: int, order: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Intervals cut so that each of `shards` holds nearly the same number of bases, in the given order: contig, then
    start or another whole number.

    The bases before each interval are sums per leading order column (contig) and running sums in blocks inside it, so
    only the one-row-a-contig table is summed in one task.
    """
    first, *rest = order
    size = F.col("stop") - F.col("start") + 1
    inside = list(dict.fromkeys([*rest, "start", "stop"]))
    contigs = intervals.groupBy(first).agg(F.sum(size).alias("_size"))
    contigs = contigs.select(F.col(first).alias("_first"), F.coalesce(F.sum("_size").over(Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy()).alias("_total"))
    rows = running(in_blocks(intervals.withColumn("_size", size), [first], inside[0], block), [first], inside, sums={"_upto": "_size"})
    rows = rows.withColumn("_in", F.col("_upto") - F.col("_size")).drop("_size", "_upto", "_block")
    rows = rows.join(contigs, F.col(first) == F.col("_first")).withColumn("_at", F.col("_before") + F.col("_in"))
    border = lambda k: F.ceil(k * F.col("_total") / shards)  # noqa: E731  the first base of shard k
    shard = lambda at: F.floor(at * shards / F.col("_total"))
    rows = rows.withColumn("shard", F.explode(F.sequence(shard(F.col("_at")), shard(F.col("_at") + size - 1))))
    rows = rows.withColumns({"_low": F.greatest(border(F.col("shard")), F.col("_at")) - F.col("_at"), "_high": F.least(border(F.col("shard") + 1) - 1, F.col("_at") + size - 1) - F.col("_at")})
    return rows.where("_low <= _high").withColumns({"stop": F.col("start") + F.col("_high"), "start": F.col("start") + F.col("_low")}).drop("_first", "_before", "_total", "_in", "_at", "_low", "_high")


def annotate(intervals: DataFrame, track: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """intervals with `score`: the track's scores weighted by how much of the interval they overlap; 0 without any."""
    keys = list(keys)
    pairs = overlap_join(intervals.select(*keys, "start", "stop").distinct(), track, keys, bin_=64)
    shared = F.least("stop", "r_stop") - F.greatest("start", "r_start") + 1
    sums = pairs.groupBy(*keys, "start", "stop").agg((F.sum(shared * F.col(f"r_{score}")) / F.first(F.col("stop") - F.col("start") + 1)).alias(score))
    return intervals.join(sums, [*keys, "start", "stop"], "left").na.fill(0.0, [score])


def depth_runs(reads: DataFrame, keys: Sequence[str], block: int = BLOCK) -> DataFrame:
    """keys, start, stop, depth: stretches of constant coverage by closed intervals, without those of depth 0."""
    return _depths(reads, keys, block).drop("_block")


def _depths(reads: DataFrame, keys: Sequence[str], block: int) -> DataFrame:
    """depth_runs() with _block, still in blocks."""
    keys = list(keys)
    ends = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("stop") + 1).alias("at"), F.lit(-1).alias("d"))))
    steps = reads.select(*keys, ends.alias("e")).groupBy(*keys, F.col("e.at").alias("start")).agg(F.sum("e.d").alias("d")).where("d != 0")
    steps = running(in_blocks(steps, keys, "start", block), keys, ["start"], sums={"depth": "d"}, leads={"_next": "start"})
    return steps.where("depth > 0").select(*keys, "_block", "start", (F.col("_next") - 1).alias("stop"), "depth")


def covered_regions(reads: DataFrame, keys: Sequence[str], min_depth: int, gap: int = 1, block: int = BLOCK) -> DataFrame:
    """keys, start, stop, depth: regions covered min_depth times or more, merged up to `gap` apart, and their least depth."""
    keys = list(keys)
    deep = running(_depths(reads, keys, block).where(F.col("depth") >= min_depth), keys, ["start"], lags={"_end": "stop"})
    runs = _runs(deep, keys, F.col("start") - F.col("_end") <= gap)
    return runs.agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("depth").alias("depth")).drop("_run")


def callable_loci(reads: DataFrame, keys: Sequence[str], min_depth: int, max_depth: int, block: int = BLOCK) -> DataFrame:
    """keys, start, stop, state: covered stretches as LOW_COVERAGE, CALLABLE or EXCESSIVE_COVERAGE."""
    keys = list(keys)
    state = F.when(F.col("depth") < min_depth, "LOW_COVERAGE").when(F.col("depth") > max_depth, "EXCESSIVE_COVERAGE").otherwise("CALLABLE")
    runs = running(_depths(reads, keys, block).withColumn("state", state), keys, ["start"], lags={"_state": "state", "_end": "stop"})
    same = (F.col("_state") == F.col("state")) & (F.col("_end") + 1 == F.col("start"))
    return _runs(runs, keys, same, "state").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_run")


def count_in_intervals(intervals: DataFrame, points: DataFrame, keys: Sequence[str], position: str = "position", name: str = "count") -> DataFrame:
    """intervals with the number of points in each, 0 included; equal intervals count alike."""
    keys = list(keys)
    at = points.groupBy(*keys, F.col(position).alias("_position")).agg(F.count("*").alias("_n"))
    inside = range_join(at, intervals.select(*keys, "start", "stop").distinct(), keys, position="_position")
    counts = inside.groupBy(*keys, "start", "stop").agg(F.sum("_n").alias(name))
    return intervals.join(counts, [*keys, "start", "stop"], "left").na.fill(0, [name])
