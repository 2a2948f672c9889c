"""Connected components by smallest label, with pointer jumping; tables only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, forget, kept

#: Nodes of so many neighbours at least are hubs; the largest HUBS of them are spread.
LEAST, HUBS = 1024, 1000
#: Edges that a task joins up by itself, about.
TOGETHER = 250_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each node of these edges, and the smallest node that they connect it with."""
    rows = pa.Table.from_batches([*batches] or [pa.RecordBatch.from_pydict({"a": [], "b": []})])
    if not rows.num_rows:
        return
    ends = pa.concat_arrays([rows.column(c).combine_chunks() for c in ("a", "b")])
    labels = ends.unique()
    labels = labels.take(pc.array_sort_indices(labels))
    code = pc.index_in(ends, value_set=labels).to_pylist()
    parent = list(range(len(labels)))
    for x, y in zip(code[: rows.num_rows], code[rows.num_rows :], strict=True):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        parent[max(x, y)] = min(x, y)
    for x in range(len(parent)):  # a parent is never larger, so it is settled before
        parent[x] = parent[parent[x]]
    yield pa.RecordBatch.from_arrays([labels, labels.take(pa.array(parent))], names=["a", "b"])


def _hubs(both: DataFrame) -> DataFrame | None:
    """The nodes of very many neighbours, HUBS at most; None without any."""
    rows = both.groupBy(F.col("b").alias("hot")).count().where(F.col("count") >= LEAST).orderBy(F.col("count").desc(), "hot").limit(HUBS).select("hot")
    found = rows.collect()
    return both.sparkSession.createDataFrame(found, rows.schema) if found else None


def _spread(rows: DataFrame, key: str, one: DataFrame, its: str, hot: DataFrame | None, by: Column) -> DataFrame:
    """rows joined with one (a row for each key) on key == its; a hot key's rows are dealt over salts by `by`."""
    if hot is None:
        return rows.join(one, rows[key] == one[its])
    salt = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(0)
    rows = rows.join(F.broadcast(hot), F.col(key) == F.col("hot"), "left").withColumn("salt", salt).drop("hot")
    copies = F.explode(F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    one = one.join(F.broadcast(hot), F.col(its) == F.col("hot"), "left").withColumn("salt_", copies).drop("hot")
    return rows.join(one, (F.col(key) == F.col(its)) & (F.col("salt") == F.col("salt_"))).drop("salt", "salt_")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then that label's own label, so a path of n
    edges takes about log n rounds.  Before, tasks turn TOGETHER edges each, whichever they have, into stars; that leaves
    short paths, and none if a task has all.  Each round's labels are a table in the shared folder.  The rows of hubs are dealt
    over salts; a label that very many nodes have makes a skewed join, which Spark splits.
    """
    edges = kept(edges.select("a", "b"))
    stars = edges.coalesce(max(1, -(-edges.count() // TOGETHER))).mapInArrow(_stars, edges.schema)
    both = kept(stars.union(stars.select("b", "a")).distinct())
    forget(edges)
    hubs = _hubs(both)
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = _spread(both, "b", labels, "node", hubs, F.col("a")).groupBy("a").agg(F.min("component").alias("near"))
        better = labels.join(near, labels["node"] == near["a"]).select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("_node"), F.col("component").alias("_next"))
        better = better.join(jump, better["component"] == jump["_node"]).select("node", F.least("component", "_next").alias("component"), "was")
        better = kept(better)
        changed = better.where(F.col("component") != F.col("was")).limit(1).count()
        forget(labels)
        labels = better.select("node", "component")
        labels.kept_path = better.kept_path
        if not changed:
            forget(both)
            return labels
