"""Approximate nearest neighbours by multi-probe p-stable hashing.

Every distinct vector has one bucket in each of TABLES tables: HASHES random projections, cut into steps of a width.
A query visits its own bucket of a table and then perturbed ones, in the order of their estimated success (the squared
distances to the steps' borders that they cross, smallest first), PROBES of them in each table.  Rows and probes meet in
a join on (table, bucket); a bucket's rows are ranked by their exact distance to the queries that visit it and only
each query's nearest leave it, then the tables' candidates are merged.  So distances are only computed to rows of
visited buckets, and no pair of a query and a row is ever a row of a table unless it may be an answer.

Equal vectors are one node, of which only the ids that can be answers are looked at, so a vector that very many rows
have is no large bucket.  Large buckets are cut into blocks of CHUNK rows, and the queries that visit one into blocks of
BLOCK; a task holds one block of each.  A query that finds too few nodes is searched again without buckets.

The step's width is fitted on a sample of SAMPLE nodes, the index holds all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, kept, pick, spread_join, table
from .words import mix

CHUNK, BLOCK, SAMPLE = 4096, 1024, 4096
TABLES, HASHES, PROBES = 8, 12, 80
#: The step's width, as a multiple of the usual distance to the k-th nearest node.
WIDTH = 3.0


def _perturbations(n: int) -> np.ndarray:
    """All steps of -1, 0, 1 in n places, with up to three that are not 0."""
    rows = [np.zeros(n, np.int64)]
    for some in (c for r in (1, 2, 3) for c in combinations(range(2 * n), r)):
        if len({x // 2 for x in some}) == len(some):
            row = np.zeros(n, np.int64)
            row[[x // 2 for x in some]] = [1 if x % 2 else -1 for x in some]
            rows.append(row)
    return np.array(rows)


def _bucket(h: np.ndarray) -> np.ndarray:
    key = np.zeros(h.shape[:-1], np.uint64)
    for j in range(h.shape[-1]):
        key = mix(key ^ (h[..., j].astype(np.int64).view(np.uint64) + np.uint64(j + 1)))
    return key.view(np.int64)


def _vectors(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten()
    return np.asarray(flat, np.float64).reshape(len(column), -1)


def _projections(dim: int, seed: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim, t])
    return rng.normal(size=(dim, HASHES)), rng.uniform(size=HASHES)


def _of_one_dimension(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, batch.filter(pa.array(dims == dim))


def row_buckets(nodes: DataFrame, widths: dict[int, float], seed: int) -> DataFrame:
    """dim, t, bucket, node, embedding: each node's bucket in each table."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, some in _of_one_dimension(batches):
            x = _vectors(some.column("embedding"))
            for t in range(TABLES):
                lines, shift = _projections(dim, seed, t)
                bucket = _bucket(np.floor(x @ lines / widths[dim] + shift))
                yield pa.RecordBatch.from_arrays([some.column("dim"), pa.array(np.full(len(x), t, np.int32)), pa.array(bucket), some.column("node"), some.column("embedding")], names=["dim", "t", "bucket", "node", "embedding"])

    return nodes.mapInArrow(make, "dim int, t int, bucket long, node long, embedding array<double>")


def query_probes(queries: DataFrame, widths: dict[int, float], seed: int) -> DataFrame:
    """dim, t, bucket, node, embedding: the buckets that each query visits in each table."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = _perturbations(HASHES)
        up, down = steps == 1, steps == -1
        for dim, every in _of_one_dimension(batches):
            for at in range(0, every.num_rows, 256):
                some = every.slice(at, 256)
                x = _vectors(some.column("embedding"))
                for t in range(TABLES):
                    lines, shift = _projections(dim, seed, t)
                    where = x @ lines / widths[dim] + shift
                    own = np.floor(where)
                    over = where - own  # the distance to the lower border; to the upper one it is 1 - over
                    success = (over**2) @ down.T + ((1 - over) ** 2) @ up.T
                    visit = np.argsort(success, axis=1, kind="stable")[:, :PROBES]
                    bucket = _bucket(own.astype(np.int64)[:, None, :] + steps[visit])
                    of = pa.array(np.repeat(np.arange(len(x)), bucket.shape[1]))
                    one = some.take(of)
                    yield pa.RecordBatch.from_arrays([one.column("dim"), pa.array(np.full(len(of), t, np.int32)), pa.array(bucket.reshape(-1)), one.column("node"), one.column("embedding")], names=["dim", "t", "bucket", "node", "embedding"])

    return queries.mapInArrow(make, "dim int, t int, bucket long, node long, embedding array<double>")


def _best(ids: np.ndarray, rows: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, node, score) of each query's k nearest rows, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    rough = np.maximum((queries**2).sum(1)[:, None] + (rows**2).sum(1) - 2 * queries @ rows.T, 0)
    slack = 1e-9 * ((queries**2).sum(1) + (rows**2).sum(1).max())
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(queries), np.inf)
    q, r = np.nonzero(rough <= (limit + slack)[:, None])
    score = np.sqrt(((rows[r] - queries[q]) ** 2).sum(1))
    order = np.lexsort((ids[r], score, q))
    q, r, score = q[order], r[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return own[q[rank < k]], ids[r[rank < k]], score[rank < k]


def _compared(rows: DataFrame, probes: DataFrame, keys: list[str], k: int) -> DataFrame:
    """query, node, score: the k nearest rows of each group for its probes, in blocks, then of all groups.

    rows and probes have the keys, node, embedding; groups without a probe are left out.
    """
    asked = probes.groupBy(*keys).agg(F.count("*").alias("q"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    held = rows.groupBy(*keys).agg(F.count("*").alias("c"), F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    sizes = kept(held.join(asked, keys))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = [*keys, "chunk", "block"]
    left = spread_join(rows, sizes, keys, "c", "node").withColumn("chunk", deal("chunks")).withColumn("block", every("blocks")).select(*names, "node", "embedding")
    right = spread_join(probes, sizes, keys, "q", "node").withColumn("block", deal("blocks")).withColumn("chunk", every("chunks")).select(*names, "node", "embedding")

    def search(group: pa.Table, asking: pa.Table) -> pa.Table:
        out = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if group.num_rows and asking.num_rows:
            (ids, x), (own, q) = ((t["node"].to_numpy(), _vectors(t["embedding"].combine_chunks())) for t in (group, asking))
            out = _best(ids, x, own, q, k)
        return pa.table({"query": pa.array(out[0], pa.int64()), "node": pa.array(out[1], pa.int64()), "score": pa.array(out[2])})

    found = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(search, "query long, node long, score double")
    # a node found in several tables has one score
    found = found.groupBy("query", "node").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "node"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).drop("rank")


def _widths(nodes: DataFrame, n: dict[int, int], k: int) -> dict[int, float]:
    """For each dimension the step: WIDTH times the usual distance to the k-th nearest of n nodes.

    It is the median over 256 nodes of the distance to their m-th nearest of the SAMPLE nodes with the smallest hashes
    (those 256 among them), where m is k times the sample's share of all nodes, 1 at least; so beyond k * SAMPLE nodes
    steps are wider than they need be.  The median keeps close copies from standing for all.
    """
    out = {}
    for dim, count in n.items():
        rows = nodes.where(F.col("dim") == dim).orderBy(F.xxhash64(F.col("ids")[0]), "node").limit(SAMPLE).select("embedding").collect()
        x = np.array([r[0] for r in rows], np.float64)
        some = x[:256]
        d = np.maximum((some**2).sum(1)[:, None] + (x**2).sum(1) - 2 * some @ x.T, 0)
        d[np.arange(len(some)), np.arange(len(some))] = np.inf
        d = np.sqrt(np.sort(d, axis=1)[:, : max(1, len(x) - 1)])
        m = min(max(1, -(-k * len(x) // count)), d.shape[1])
        near, usual = (float(np.median(v[np.isfinite(v)])) if np.isfinite(v).any() else 1.0 for v in (d[:, m - 1], d))
        out[dim] = WIDTH * max(near, 1e-3 * usual, 1e-12)
    return out


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row of vectors (vec_id, embedding) whose
    vec_id `every` divides, by Euclidean distance in double precision; nearest first, ties to the smaller vec_id.

    Rows take part if vec_id is not null and the embedding is neither null, empty nor zero and holds no null, NaN or
    infinite component; vectors of different dimensions never meet.  A query does not find rows of its own vec_id.
    Rows that repeat wholly are one candidate and one query; a vec_id with several vectors is several candidates, and
    as a query it is the smallest of them.  A query with k candidates or more always gets k, with fewer
    all; an empty table gives no rows; other columns are ignored.
    """
    rows = pick(vectors, vec_id="long", embedding="array<double>").where("vec_id IS NOT NULL AND size(embedding) > 0")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("embedding", lambda x: x != 0)).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    # at most k + 1 ids of a vector can be answers to one query, whose own id may be among them
    order = F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("r", order).where(F.col("r") <= k + 1).groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    # a vec_id with several vectors is in several nodes, so a node has a number of its own; numbers rise with the first id
    nodes = kept(few.orderBy(F.col("ids")[0], "embedding").select(F.monotonically_increasing_id().alias("node"), F.size("embedding").alias("dim"), "embedding", "ids"))
    counts = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    wanted = kept(queries.groupBy("embedding").agg(F.count("*").alias("c")).join(nodes.select("node", "embedding"), "embedding"))
    queries = spread_join(queries, wanted, "embedding", "c", "vec_id").select("vec_id", "node")
    asked = kept(nodes.join(wanted.select("node"), "node", "left_semi").select("node", "dim", "embedding"))
    widths = _widths(nodes, counts, k)
    placed = kept(row_buckets(nodes.select("node", "dim", "embedding"), widths, seed))
    probes = kept(query_probes(asked, widths, seed))
    found = kept(_compared(placed, probes, ["dim", "t", "bucket"], k + 1))
    forget(placed, probes)
    # k + 1 nodes have k ids besides a query's own; a query may also have seen all nodes there are
    seen = found.groupBy(F.col("query").alias("node")).agg(F.count("*").alias("c"))
    most = F.lit(0)
    for dim, n in counts.items():
        most = F.when(F.col("dim") == dim, min(n, k + 1)).otherwise(most)
    short = kept(asked.join(seen, "node", "left").where(F.coalesce("c", F.lit(0)) < most).select("dim", "node", "embedding"))
    if short.limit(1).count():
        full = found.join(short.select(F.col("node").alias("query")), "query", "left_anti")
        found = full.unionByName(_compared(nodes.select("dim", "node", "embedding"), short, ["dim"], k + 1))
    answers = found.join(nodes.select("node", F.explode("ids").alias("vec_id")), "node")
    lists = answers.groupBy(F.col("query").alias("node")).agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    mine = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    lists = kept(lists.join(wanted.select("node", "c"), "node"))
    out = spread_join(queries.withColumnRenamed("vec_id", "query_id"), lists, "node", "c", "query_id").select("query_id", F.posexplode(mine).alias("i", "x"))
    return out.select("query_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
