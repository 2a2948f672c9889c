"""Walking over sorted partitions in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def changes(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before; the first does."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, starts of the groups in them) of a partition sorted by long keys; no group is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        ends = [rows.column(k)[-1].as_py() for k in keys]
        if [rows.column(k)[0].as_py() for k in keys] == ends:
            continue
        starts = np.flatnonzero(changes([rows.column(k).to_numpy() for k in keys]))
        yield rows.slice(0, starts[-1]), starts[:-1]
        held = rows.slice(starts[-1]).combine_chunks().to_batches()
    if held:
        rows = pa.Table.from_batches(held)
        yield rows, np.flatnonzero(changes([rows.column(k).to_numpy() for k in keys]))
