"""All pairs of samples: how often codes meet at the same locus, by products of matrices."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

#: Samples of a tile, and tiles that a task adds up at once.
TILE, TILES = 256, 64


def _tables(codes: np.ndarray, levels: int, tiles: Sequence[tuple[slice, slice]], into: dict[int, np.ndarray]) -> None:
    """Add for each tile the levels x levels tables of its pairs of columns; codes (loci, samples), -1 without a call."""
    for at in range(0, len(codes), 1024):
        hot = [(codes[at : at + 1024] == level).astype(np.float32) for level in range(levels)]
        for t, (a, b) in enumerate(tiles):
            if a.start < codes.shape[1] and b.start < codes.shape[1]:
                both = np.array([[x[:, a].T @ y[:, b] for y in hot] for x in hot]).astype(np.int64)
                into[t] = into[t] + both if t in into else both


def pair_tables(calls: DataFrame, keys: Sequence[str] = (), levels: int = 3, tile: int = TILE, tiles: int = TILES) -> DataFrame:
    """keys, sample_a, sample_b, c00, c01, ...: for each pair of samples that meet, at how many loci their codes are i and j.

    calls has keys, sample, contig, position and code, from 0 to levels - 1; a sample has one row a locus.  A locus is
    one row with an array of its samples' codes; a task multiplies the loci-by-samples matrices of its rows, tile by tile, and
    gives each pair once, so no row is ever made for a pair at a locus.  Of very many samples some tiles are taken in
    each pass over the loci.
    """
    keys = list(keys)
    calls = kept(calls.select(*keys, "sample", "contig", "position", F.col("code").cast("int").alias("code")))  # dear to make, read twice
    own = Window.partitionBy(*keys).orderBy("sample")  # a row a sample
    samples = kept(calls.select(*keys, "sample").distinct().withColumn("_place", F.row_number().over(own) - 1))
    most = samples.agg(F.coalesce(F.max("_place"), F.lit(-1)) + 1).first()[0]
    rows = calls.join(samples, [*keys, "sample"]).groupBy(*keys, "contig", "position").agg(F.collect_list(F.struct("_place", "code")).alias("c"))
    rows = rows.where(F.size("c") > 1).select(*keys, F.col("c._place").alias("places"), F.col("c.code").alias("codes"))
    rows = kept(rows.sortWithinPartitions(*keys) if keys else rows)
    cuts = [slice(a, a + tile) for a in range(0, most, tile)]
    every = [(a, b) for i, a in enumerate(cuts) for b in cuts[i:]]
    names = [f"c{i}{j}" for i in range(levels) for j in range(levels)]
    head = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema]
    schema = ", ".join([*head, "a int", "b int", *(f"{c} long" for c in names)])

    def over(some: list[tuple[slice, slice]]) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, np.ndarray] = {}
            key: pa.RecordBatch | None = None

            def given() -> pa.RecordBatch:
                parts = []
                for t, table in found.items():
                    (a, b), total = some[t], table.sum((0, 1))
                    if a.start == b.start:
                        total = np.triu(total, 1)
                    i, j = np.nonzero(total)
                    parts.append(np.stack([i + a.start, j + b.start, *(table[x, y, i, j] for x in range(levels) for y in range(levels))]))
                columns = np.concatenate(parts, axis=1) if parts else np.zeros((2 + len(names), 0), np.int64)
                first = pa.array(np.zeros(columns.shape[1], np.int64))
                values = [key.column(k).take(first) for k in keys] + [pa.array(columns[i], pa.int32()) for i in (0, 1)] + [pa.array(x, pa.int64()) for x in columns[2:]]
                return pa.RecordBatch.from_arrays(values, names=[*keys, "a", "b", *names])

            for batch in batches:
                change = np.zeros(batch.num_rows, bool)
                for k in keys:
                    code = batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy()
                    change[1:] |= code[1:] != code[:-1]
                for a, b in zip((cuts_ := [0, *np.flatnonzero(change).tolist(), batch.num_rows]), cuts_[1:], strict=False):
                    if a == b:
                        continue
                    part = batch.slice(a, b - a)
                    if key is not None and any(key.column(k)[0] != part.column(k)[0] for k in keys):
                        yield given()
                        found.clear()
                    key = part.slice(0, 1)
                    places, codes = part.column("places"), part.column("codes")
                    flat = places.flatten().to_numpy()
                    matrix = np.full((len(part), flat.max() + 1), -1, np.int8)
                    matrix[np.repeat(np.arange(len(part)), np.diff(places.offsets.to_numpy())), flat] = codes.flatten().to_numpy()
                    _tables(matrix, levels, some, found)
            if key is not None:
                yield given()

        return rows.mapInArrow(count, schema)

    out = over(every[:tiles])
    for at in range(tiles, len(every), tiles):
        out = out.union(over(every[at : at + tiles]))
    out = out.groupBy(*keys, "a", "b").agg(*(F.sum(c).alias(c) for c in names))
    for x in "ab":
        out = out.join(samples.select(*keys, F.col("_place").alias(x), F.col("sample").alias(f"sample_{x}")), [*keys, x])
    return out.select(*keys, "sample_a", "sample_b", *names)
