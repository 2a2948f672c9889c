"""Running values along positions, in blocks of positions, so that a contig is many tasks.

Inside a block they come from windows.  What the blocks before and after it add comes from a table of one row a block,
which alone is read group by group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20


def in_blocks(rows: DataFrame, keys: Sequence[str], at: str, block: int = BLOCK) -> DataFrame:
    """rows with _block, dealt by (keys, _block); rows with a null key are one block, since no join would find others."""
    place = F.floor(F.col(at) / block)
    no_key = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys), F.lit(False))
    return rows.withColumn("_block", F.when(no_key, F.lit(0)).otherwise(place).cast("long")).repartition(*keys, "_block")


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, str] | None = None, peaks: Mapping[str, str] | None = None, lags: Mapping[str, str] | None = None, leads: Mapping[str, str] | None = None) -> DataFrame:
    """rows, as in_blocks() gives them, with columns that depend on all rows of the same keys in `order`.

    The mappings give a new column's name and the column it is made of: its sum over the rows up to this one, its largest
    value in the rows before, its value in the row before, in the row after.  All but sums are null if there is no
    such row.  `order` begins with the position; rows that tie in it must be equal in the columns of lags and leads.
    The result is still in blocks, so calls can follow each other without a shuffle of the rows.
    """
    sums, peaks, lags, leads = (dict(m or {}) for m in (sums, peaks, lags, leads))
    keys = list(keys)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    blocks = Window.partitionBy(*keys).orderBy("_block")
    upto, earlier = (inside.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    past = blocks.rowsBetween(Window.unboundedPreceding, -1)
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    made = {n: F.sum(c).over(upto) for n, c in sums.items()} | {n: F.max(c).over(earlier) for n, c in peaks.items()}
    made |= {n: F.lag(c).over(inside) for n, c in lags.items()} | {n: F.lead(c).over(inside) for n, c in leads.items()}
    made |= ({"_is_first": F.row_number().over(inside) == 1} if lags else {}) | ({"_is_last": F.lead(F.lit(1)).over(inside).isNull()} if leads else {})

    whole = [F.sum(c).alias(n) for n, c in sums.items()] + [F.max(c).alias(n) for n, c in peaks.items()]
    whole += [F.max_by(c, place).alias(n) for n, c in lags.items()] + [F.min_by(c, place).alias(n) for n, c in leads.items()]
    carried = [F.sum(n).over(past) for n in sums] + [F.max(n).over(past) for n in peaks] + [F.lag(n).over(blocks) for n in lags] + [F.lead(n).over(blocks) for n in leads]
    names = [*sums, *peaks, *lags, *leads]
    ends = rows.groupBy(*keys, "_block").agg(*whole).select(*keys, "_block", *(c.alias(f"_carry_{n}") for n, c in zip(names, carried, strict=True)))

    both = {n: F.col(n) + F.coalesce(f"_carry_{n}", F.lit(0)) for n in sums} | {n: F.greatest(n, f"_carry_{n}") for n in peaks}
    both |= {n: F.when(F.col("_is_first"), F.col(f"_carry_{n}")).otherwise(F.col(n)) for n in lags}
    both |= {n: F.when(F.col("_is_last"), F.col(f"_carry_{n}")).otherwise(F.col(n)) for n in leads}
    return rows.withColumns(made).join(ends, [*keys, "_block"], "left").select(*(c for c in rows.columns if c not in names), *(c.alias(n) for n, c in both.items()))
