"""Hard negatives from Hilbert-ordered blocks of vectors with zone maps.

The rows are sorted by label and by their place on a Hilbert curve through the dimensions of largest variance, and cut
into Parquet blocks of at most BLOCK rows of one label, each with the smallest and largest value of every dimension (its
zone map).  Anchors are taken from the blocks in the same order, in groups of one label.  For a box of values the
inner product with an anchor lies between two sums over the dimensions (interval arithmetic), so an anchor's window of
scores tells which blocks must be read:

- positives: blocks of the same label whose upper bound reaches the score that the anchor's own block already offers;
- negatives: blocks of other labels whose bounds meet the span of the windows of the anchor's positives.

Groups of anchors meet zone maps in bundles, and chosen blocks in bundles, never rows pair by pair; from a bundle only
each window's first few rows leave.  Within a bundle blocks are read in the order of their bounds, and one that can't add
to what its anchors have found is passed over.

Scores are exact: products are sums of doubles as long as they stay below 2**53, and of Python's integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, kept, partitions, pick, table

#: Rows of a block, anchors of a group; blocks of a bundle (2**n).
BLOCK, GROUP, BUNDLE_BITS = 512, 256, 4
#: Zone maps, and groups of anchors, that a task holds at once, about.
ZONES, PART = 1024, 16
#: The curve's dimensions and bits for each.
DIMENSIONS, BITS = 15, 4
#: Below and above all scores.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class Shape(NamedTuple):
    dim: int
    kind: str  # of the stored components
    exact: bool  # whether doubles hold all scores
    axes: tuple[int, ...]  # the curve's dimensions
    low: tuple[int, ...]
    high: tuple[int, ...]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix of longs; shorter vectors end with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """The places on the Hilbert curve of points with coordinates of `bits` bits, by Skilling's transform: undo the curve's
    turns from the highest bit down, then take the Gray code and interleave the bits."""
    x = x.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in x:
            on = (axis >> bit & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(on, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | axis >> bit & 1
    return place


def shape_of(rows: DataFrame) -> Shape:
    """From the number, sums and ends of every dimension over all rows (q: array<long>)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("q")
            if len(column):
                x = _matrix(column, int(np.diff(column.offsets.to_numpy()).max()))
                y = x.astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.arange(x.shape[1]), np.full(x.shape[1], len(x)), y.sum(0), (y * y).sum(0), x.min(0), x.max(0))], names=["d", "n", "s", "ss", "low", "high"])

    found = rows.select("q").mapInArrow(gather, "d long, n long, s double, ss double, low long, high long")
    per = found.groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    most = max((max(-r.low, r.high, 1) for r in per), default=1)
    spread = sorted(per, key=lambda r: (-(r.ss / r.n - (r.s / r.n) ** 2), r.d))[:DIMENSIONS]
    kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "int64"
    return Shape(len(per), kind, len(per) * most * most < 1 << 53, tuple(r.d for r in spread), tuple(r.low for r in spread), tuple(r.high for r in spread))


_LONGS = pa.list_(pa.int64())


def _batch(rows: list[dict], **kinds: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(kinds.items())))


def _runs(labels: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, end): stretches of one label, of at most so many rows."""
    cuts = np.append(np.flatnonzero(np.append(True, labels[1:] != labels[:-1])), len(labels)).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        for at in range(a, b, most):
            yield at, min(at + most, b)


def _numbers() -> Iterator[int]:
    """Numbers that no other task gives; those of a task follow each other."""
    return iter(range(TaskContext.get().partitionId() << 32, 1 << 62))


def in_blocks(rows: DataFrame, shape: Shape, block: int) -> DataFrame:
    """A kept() table: block, label, ids, data, low, high; the rows (vec_id, label, q) in the curve's order."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = list(shape.axes)
        low, high = (np.array(x, float) for x in (shape.low, shape.high))
        for batch in batches:
            x = _matrix(batch.column("q"), shape.dim)[:, axes].astype(float)
            cell = np.minimum((x - low) / (high - low + 1) * (1 << BITS), (1 << BITS) - 1)
            at = hilbert(cell, BITS) if axes else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("q"), pa.array(at, pa.int64())], names=["vec_id", "label", "q", "h"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _numbers()

        def made(some: pa.Table) -> pa.RecordBatch:
            out, labels, ids = [], some.column("label").to_numpy(), some.column("vec_id").to_numpy()
            x = _matrix(some.column("q").combine_chunks(), shape.dim)
            for a, b in _runs(labels, block):
                out.append({"block": next(number), "label": int(labels[a]), "ids": ids[a:b], "data": x[a:b].astype(shape.kind).tobytes(), "low": x[a:b].min(0), "high": x[a:b].max(0)})
            return _batch(out, block=pa.int64(), label=pa.int64(), ids=_LONGS, data=pa.binary(), low=_LONGS, high=_LONGS)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 16 * block:
                rows_ = pa.Table.from_batches(held)
                labels = rows_.column("label").to_numpy()
                first = list(_runs(labels, block))[-1][0]  # the last stretch may go on
                if first:
                    yield made(rows_.slice(0, first))
                held = rows_.slice(first).to_batches()
        if held and sum(b.num_rows for b in held):
            yield made(pa.Table.from_batches(held))

    placed = rows.mapInArrow(place, "vec_id long, label long, q array<long>, h long")
    n = partitions(rows.sparkSession)
    ordered = placed.repartitionByRange(n, "label", "h", "vec_id").sortWithinPartitions("label", "h", "vec_id")
    return kept(ordered.mapInArrow(cut, "block long, label long, ids array<long>, data binary, low array<long>, high array<long>"))


def _data(raw: bytes, shape: Shape) -> np.ndarray:
    return np.frombuffer(raw, shape.kind).reshape(-1, shape.dim)


def _scores(a: np.ndarray, x: np.ndarray, shape: Shape) -> np.ndarray:
    if shape.exact:
        return (a.astype(float) @ x.T.astype(float)).astype(np.int64)
    return np.clip(a.astype(object) @ x.T.astype(object), LEAST + 1, MOST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, boxes): the least and the greatest inner product that each anchor can have with a row in each box."""
    if not shape.exact:  # beyond doubles, all boxes are open
        return np.full((len(a), len(low)), -np.inf), np.full((len(a), len(low)), np.inf)
    a, low, high = (v.astype(float) for v in (a, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


#: A group of anchors: where each is, its vector, and its windows of scores (`least` and `most` hold those of the first
#: anchor, of the second, ...; all anchors have equally many).
GROUPS = {"grp": "long", "label": "long", "block": "array<long>", "place": "array<long>", "ids": "array<long>", "data": "binary", "least": "array<long>", "most": "array<long>"}
_GROUPS = ", ".join(f"{k} {v}" for k, v in GROUPS.items())


def anchor_groups(blocks: DataFrame, shape: Shape, every: int, k: int) -> DataFrame:
    """A kept() table of GROUPS: anchors of one label, in the curve's order, each with one window: what its positives
    score, which is at least the k-th best of the anchor's own block."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, x = np.array(r["ids"]), _data(r["data"], shape)
                mine = np.flatnonzero(ids % every == 0)
                for at, row in zip(mine.tolist(), _scores(x[mine], x, shape), strict=True):
                    others = np.delete(row, at)
                    least = int(np.partition(others, -k)[-k]) if len(others) >= k else LEAST + 1
                    out.append({"label": r["label"], "block": r["block"], "place": at, "id": int(ids[at]), "q": x[at].tobytes(), "least": least})
            yield _batch(out, label=pa.int64(), block=pa.int64(), place=pa.int64(), id=pa.int64(), q=pa.binary(), least=pa.int64())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _numbers()
        for batch in batches:
            out, column = [], lambda some, name: some.column(name).to_numpy()
            for a, b in _runs(batch.column("label").to_numpy(), GROUP) if batch.num_rows else ():
                some = batch.slice(a, b - a)
                out.append({"grp": next(number), "label": some.column("label")[0].as_py(), "block": column(some, "block"), "place": column(some, "place"), "ids": column(some, "id"), "data": b"".join(some.column("q").to_pylist()), "least": column(some, "least"), "most": np.full(b - a, MOST)})
            yield _batch(out, grp=pa.int64(), label=pa.int64(), block=_LONGS, place=_LONGS, ids=_LONGS, data=pa.binary(), least=_LONGS, most=_LONGS)

    anchors = kept(blocks.mapInArrow(take, "label long, block long, place long, id long, q binary, least long"))
    n = partitions(blocks.sparkSession)
    out = kept(anchors.repartitionByRange(n, "label", "block", "place").sortWithinPartitions("label", "block", "place").mapInArrow(gather, _GROUPS))
    forget(anchors)
    return out


def _windows(r: dict, anchors: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array(r[c], np.int64).reshape(anchors, -1) for c in ("least", "most"))


def chosen(groups: DataFrame, blocks: DataFrame, shape: Shape, alike: bool) -> DataFrame:
    """bundle, grp: for each group the bundles to read, those with a block of the same or of other labels whose bounds
    meet a window of one of the group's anchors.  Zone maps and groups meet in blocks of about ZONES and PART."""
    zones = blocks.select("block", "label", "low", "high").withColumn("bundle", F.shiftright("block", BUNDLE_BITS))
    chunks, parts = max(1, -(-blocks.count() // ZONES)), max(1, -(-groups.count() // PART))
    left = zones.withColumn("chunk", F.pmod(F.xxhash64("bundle"), F.lit(chunks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = groups.withColumn("part", F.pmod(F.xxhash64("grp"), F.lit(parts)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def choose(maps: pa.Table, asking: pa.Table) -> pa.Table:
        bundle, grp = [], []
        if maps.num_rows and asking.num_rows:
            low, high = (_matrix(maps.column(c).combine_chunks(), shape.dim) for c in ("low", "high"))
            label, of = maps.column("label").to_numpy(), maps.column("bundle").to_numpy()
            for r in asking.to_pylist():
                some = np.flatnonzero((label == r["label"]) == alike)
                a = _data(r["data"], shape)
                under, over = bounds(a, low[some], high[some], shape)
                least, most = _windows(r, len(a))
                meet = np.zeros(len(some), bool)
                for w in range(least.shape[1]):
                    valid = (least[:, w] <= most[:, w])[:, None]
                    meet |= (valid & (over >= least[:, w, None]) & (under <= most[:, w, None])).any(0)
                need = np.unique(of[some[meet]])
                bundle.append(need)
                grp.append(np.full(len(need), r["grp"]))
        return pa.table({name: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for name, x in (("bundle", bundle), ("grp", grp))})

    return left.groupBy("chunk", "part").cogroup(right.groupBy("chunk", "part")).applyInArrow(choose, "bundle long, grp long")


class _Best:
    """The first k rows of each window of each anchor, by falling score, then by id and place."""

    def __init__(self, anchors: int, windows: int, k: int) -> None:
        self.rows = [np.full((anchors, windows, k), LEAST)] + [np.zeros((anchors, windows, k), np.int64) for _ in range(3)]

    def worst(self) -> np.ndarray:
        return self.rows[0][:, :, -1]

    def add(self, at: np.ndarray, *more: np.ndarray) -> None:
        both = [np.concatenate([own[at], new], axis=2) for own, new in zip(self.rows, more, strict=True)]
        score, id_, block, place = both
        order = np.lexsort((place, block, id_, ~score), axis=2)[:, :, : self.rows[0].shape[2]]
        for own, x in zip(self.rows, both, strict=True):
            own[at] = np.take_along_axis(x, order, axis=2)


def _read_block(best: _Best, r: dict, a: np.ndarray, least: np.ndarray, most: np.ndarray, b: dict, x: np.ndarray, bound: tuple[np.ndarray, np.ndarray], k: int, shape: Shape) -> None:
    """Add a block's rows to what a group's anchors have; bound: each anchor's least and greatest score there."""
    under, over = (v[:, None] for v in bound)
    open_ = (least <= most) & (over >= np.maximum(least, best.worst())) & (under <= most)
    at = np.flatnonzero(open_.any(1))
    if not len(at):
        return
    score = _scores(a[at], x, shape)
    itself = np.flatnonzero(np.array(r["block"])[at] == b["block"])
    score[itself, np.array(r["place"])[at][itself]] = LEAST
    ids = np.array(b["ids"])
    by_id = np.argsort(ids, kind="stable")
    score, ids = score[:, by_id], ids[by_id]
    order = np.argsort(~score, axis=1, kind="stable")
    ranked = np.take_along_axis(score, order, axis=1)
    first = (score[:, None, :] > most[at][:, :, None]).sum(2)
    take = first[:, :, None] + np.arange(k)
    inside = take < score.shape[1]
    rows = np.arange(len(at))[:, None, None]
    take = np.minimum(take, score.shape[1] - 1)
    value = ranked[rows, take]
    inside &= (value >= least[at][:, :, None]) & (value > LEAST)
    column = order[rows, take]
    best.add(at, np.where(inside, value, LEAST), ids[column], np.full_like(column, b["block"]), by_id[column])


def read_windows(groups: DataFrame, blocks: DataFrame, pairs: DataFrame, shape: Shape, alike: bool, k: int) -> DataFrame:
    """grp, row, w, rank, score, id: the first k rows of each window of each anchor, out of the chosen bundles."""
    parts = max(1, -(-groups.count() // PART))
    deal = F.pmod(F.xxhash64("grp"), F.lit(parts)).cast("int")
    pairs = pairs.withColumn("part", deal)
    left = blocks.withColumn("bundle", F.shiftright("block", BUNDLE_BITS)).join(pairs.select("bundle", "part").distinct(), "bundle")
    right = groups.join(pairs.toDF(*pairs.columns), "grp").toDF(*groups.columns, *(c for c in pairs.columns if c != "grp"))

    def read(held: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[np.ndarray] = []
        some = held.drop_columns(["low", "high"]).to_pylist()
        if some:
            low, high = (_matrix(held.column(c).combine_chunks(), shape.dim) for c in ("low", "high"))
            data = [_data(b["data"], shape) for b in some]
        for r in asking.to_pylist() if some else ():
            a = _data(r["data"], shape)
            least, most = _windows(r, len(a))
            best = _Best(len(a), least.shape[1], k)
            under, over = bounds(a, low, high, shape)
            for i in np.argsort(-over.max(0), kind="stable").tolist():
                if (some[i]["label"] == r["label"]) == alike:
                    _read_block(best, r, a, least, most, some[i], data[i], (under[:, i], over[:, i]), k, shape)
            row, w, j = np.nonzero(best.rows[0] > LEAST)
            found.append(np.stack([np.full(len(row), r["grp"]), row, w, *(x[row, w, j] for x in best.rows)]))
        columns = np.concatenate(found, axis=1) if found else np.zeros((7, 0), np.int64)
        return pa.table(dict(zip(("grp", "row", "w", "score", "id", "block", "place"), map(pa.array, columns), strict=True)))

    keys = ["bundle", "part"]
    out = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(read, "grp long, row long, w long, score long, id long, block long, place long")
    rank = F.row_number().over(Window.partitionBy("grp", "row", "w").orderBy(F.desc("score"), "id", "block", "place"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).drop("block", "place")


def _with_windows(groups: DataFrame, positives: DataFrame, k: int, share: int) -> DataFrame:
    """groups with a window for each of the anchors' positives: scores from share percent of the positive's to its own."""
    of = positives.groupBy("grp").agg(F.collect_list(F.struct("row", "rank", "score")).alias("of"))  # k for each anchor at most

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, most = [], []
            for ids, of in zip(batch.column("ids").to_pylist(), batch.column("of").to_pylist(), strict=True):
                low, high = np.full((len(ids), k), MOST), np.full((len(ids), k), LEAST)  # empty
                for x in of:
                    low[x["row"], x["rank"] - 1] = max(-(-share * x["score"] // 100), LEAST + 1)
                    high[x["row"], x["rank"] - 1] = x["score"]
                least.append(low.reshape(-1))
                most.append(high.reshape(-1))
            columns = {c: batch.column(c) for c in GROUPS if c not in ("least", "most")} | {"least": pa.array(least, _LONGS), "most": pa.array(most, _LONGS)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return groups.join(of, "grp").mapInArrow(windows, _GROUPS)


def hard_negatives(vectors: DataFrame, every: int = 100, k: int = 5, share: int = 80, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a row of vectors (vec_id,
    label, embedding) whose vec_id `every` divides) and each of its positives the first k rows of other labels that score
    from `share` percent of the positive's score up to it.

    A component x counts as floor(256 * x), kept inside a long; where 7 divides vec_id, the label is first (label + 1) % 10.  A
    row's score is its inner product with the anchor; higher scores come first, ties by smaller vec_id.  An anchor's
    positives are its first k other rows of its label.  Fewer than k are returned where there are fewer.

    Rows with a null vec_id, label or vector, or with a null, NaN or infinite component, take no part.  A shorter vector,
    or an empty one, counts as if zeros followed.  Rows that repeat are rows of their own, also an anchor's copies; an
    empty table gives no rows; other columns are ignored.  A positive of a negative score has no negatives.  Scores
    beyond a long count as its ends.
    """
    rows = pick(vectors, vec_id="long", label="long", embedding="array<double>").where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    rows = rows.where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x * 256)).alias("q"))
    shape = shape_of(rows)
    blocks = in_blocks(rows, shape, block)
    groups = anchor_groups(blocks, shape, every, k)
    positives = read_windows(groups, blocks, kept(chosen(groups, blocks, shape, True)), shape, True, k)
    positives = kept(positives.select("grp", "row", "rank", "score", "id"))
    windows = kept(_with_windows(groups, positives, k, share))
    found = read_windows(windows, blocks, kept(chosen(windows, blocks, shape, False)), shape, False, k)
    found = found.withColumn("w", F.col("w") + 1).withColumnsRenamed({"score": "negative_score", "id": "negative_id"})
    pair = positives.select("grp", "row", F.col("rank").cast("long").alias("w"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    anchors = groups.select("grp", F.posexplode("ids").alias("row", "anchor_id")).withColumn("row", F.col("row").cast("long"))
    return found.join(pair, ["grp", "row", "w"]).join(anchors, ["grp", "row"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""
