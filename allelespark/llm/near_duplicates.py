"""MinHash near-dedup: signatures joined by a multi-index Hamming join, links confirmed on whole sets.

A document's set holds the hashes of its distinct shingles.  Its signature has `signs` MinHash values of 32 bits;
two documents of similarity s agree in each with probability s.  The signature is split into chunks of three
values.  If two signatures differ in at most 2 * chunks - 1 values, then by the pigeonhole principle some chunk
differs in one at most, so the index enumerates each chunk's one-error variants (three keys a chunk, each leaving
out one value): every pair within that distance shares a key.  With 24 values in 8 chunks that distance is 15; at
similarity 0.8 a pair differs in 4.8 values on average and in more than 15 with probability 8e-7.

No bucket emits all its pairs.  Copies of a text are one node.  Nodes within the signatures' distance of a bucket's
pivot are put together first, then, in buckets that this leaves apart, whatever else is within it; the signatures
alone thus make families.  Inside a family whole sets are compared, in blocks that a task holds: the first block
with all others, then what this leaves unlinked with all.  Each step emits only what connects components, at most a
row for each.  No partner or candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, pick, spread_join, table
from .components import components
from .stream import whole_groups
from .words import mix, ngrams, parts, signed, words

_NO_ID = -(1 << 63)
#: Rows, and items of their sets, in a block; a task holds two blocks at a time.
_BLOCK, _ITEMS = 512, 1 << 18


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _sets(batch: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Node ids (digests of the words) as (n, 16) bytes, whether a text has words, and each text's set in order."""
    w = words(batch.column(1), lower=True)
    one, two = w.hashes()
    start, grams = ngrams(one, shingle, w.first)
    low = np.searchsorted(start, w.first)
    whole = w.whole(one, two)
    some = w.first[1:] > w.first[:-1]
    sets = [np.unique(grams[low[i] : low[i + 1]]) if low[i + 1] > low[i] else whole[i, :1] if some[i] else grams[:0] for i in range(batch.num_rows)]
    return whole.astype(">u8").view(np.uint8).reshape(-1, 16), some, sets


def _binary(node: np.ndarray, some: np.ndarray) -> pa.Array:
    return pa.array([bytes(x) if ok else None for x, ok in zip(node, some, strict=True)], pa.binary())


def signatures(docs: DataFrame, shingle: int, signs: int) -> DataFrame:
    """doc_id, n (size of the set), node (a digest of 128 bits of the words; null without words), signature."""
    seeds = _seeds(2 * signs)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            node, some, sets = _sets(batch, shingle)
            sizes = np.array([len(s) for s in sets])
            starts = np.concatenate([[0], np.cumsum(sizes)])
            every = np.concatenate(sets)
            out = np.zeros((batch.num_rows, signs), np.uint32)
            filled = np.flatnonzero(sizes)
            for k in range(signs if len(filled) else 0):
                value = (every ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
                out[filled, k] = mix(np.minimum.reduceat(value, starts[filled])) >> np.uint64(32)
            values = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * signs), pa.array(out.reshape(-1).view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), _binary(node, some), values], names=["doc_id", "n", "node", "signature"])

    return docs.mapInArrow(make, "doc_id long, n long, node binary, signature array<int>")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """node, items (hashes of the distinct shingles) of texts with words."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            node, some, sets = _sets(batch, shingle)
            starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            items = pa.ListArray.from_arrays(pa.array(starts), pa.array(signed(np.concatenate(sets))))
            yield pa.RecordBatch.from_arrays([_binary(node, some), items], names=["node", "items"])

    return docs.mapInArrow(make, "node binary, items array<long>").where("node IS NOT NULL")


def index_keys(nodes: DataFrame, signs: int) -> DataFrame:
    """(key, node): each chunk's variants, every one without one of its three values."""
    at = lambda i: F.element_at("signature", i + 1)
    keys = [F.xxhash64(F.lit(3 * c + w), *(at(3 * c + j) for j in range(3) if j != w)) for c in range(signs // 3) for w in range(3)]
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "node")


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of pairs (a, b) of small whole numbers that connect all that the pairs connect, without a circle."""
    parent = list(range(int(max(a.max(), b.max())) + 1)) if len(a) else []
    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[x] = y
            out.append(k)
    return np.array(out, np.int64)


def _compared(rows: DataFrame, keys: list[str], near) -> DataFrame:
    """(a, b): components that near(group, x, y), a mask of pairs of rows, connects; a forest for each group.

    rows has the keys (longs), left, right, node, component.  Pairs are of a left and a right row of one group, of
    different components.  A task holds one group at a time and emits at most a pair for each of its components.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, starts in whole_groups(batches, keys):
            found: list[tuple[bytes, bytes]] = []
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(groups)], strict=True):
                group = groups.slice(low, high - low)
                labels, of = np.unique(np.array(group.column("component").to_pylist(), object), return_inverse=True)
                if len(labels) < 2:
                    continue
                left, right = (np.flatnonzero(group.column(c).to_numpy()) for c in ("left", "right"))
                x, y = near(group, left, right, of)
                if len(x):
                    one, two = np.minimum(of[x], of[y]), np.maximum(of[x], of[y])
                    code = np.unique(one * len(labels) + two)
                    one, two = code // len(labels), code % len(labels)
                    some = _forest(one, two)
                    found += zip(labels[one[some]], labels[two[some]], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.binary()), pa.array([p[1] for p in found], pa.binary())], names=["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a binary, b binary").distinct()


def _families(open_: DataFrame, distance: int, percent: int) -> DataFrame:
    """(component, family): components with members in one bucket within the signatures' distance, put together.

    open_: key, node, component, n, signature, and c, the key's number of rows.  Large buckets are cut into blocks,
    compared two at a time.
    """
    rows = open_.withColumn("blocks", F.ceil(F.col("c") / _BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    # a node of block x goes to the block pairs (x, y) and (y, x), smaller first
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").cast("long").alias("i"), F.greatest("block", "other").cast("long").alias("j"), (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"), "node", "component", "n", "signature")

    def near(group: pa.Table, left: np.ndarray, right: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = group.column("n").to_numpy()
        signature = group.column("signature").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
        ok = (of[left][:, None] != of[right]) & (100 * np.minimum(n[left][:, None], n[right]) >= percent * np.maximum(n[left][:, None], n[right]))
        x, y = np.nonzero(ok)
        x, y = left[x], right[y]
        close = np.zeros(len(x), bool)
        for at in range(0, len(x), 1 << 18):
            part = slice(at, at + (1 << 18))
            close[part] = (signature[x[part]] != signature[y[part]]).sum(1) <= distance
        return x[close], y[close]

    return components(_compared(rows, ["key", "i", "j"], near)).select(F.col("component").alias("family"), F.col("node").alias("component"))


def _star(members: DataFrame, nodes: DataFrame, distance: int, percent: int) -> DataFrame:
    """(a, b): nodes and a bucket's pivot within the signatures' distance; two pivots a node at most.

    These are the pivot that most of a node's buckets have and the smallest one.  Others are no loss: they only save
    work, since _families() looks at all buckets that are not in one component.
    """
    often = members.where("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("c"))
    two = often.groupBy("node").agg(F.max(F.struct("c", "pivot")).alias("most"), F.min("pivot").alias("least"))
    pairs = two.select(F.col("node").alias("a"), F.explode(F.array_distinct(F.array("most.pivot", "least"))).alias("b"))
    one, other = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")) for x in ("a", "b"))
    both = pairs.join(one, "a").join(other, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    apart = F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x != y), lambda x: x))
    return both.where(apart <= distance).select("a", "b")


def _similar(percent: int):
    """Which pairs of left and right rows have similar sets, by products of membership tables."""

    def near(group: pa.Table, left: np.ndarray, right: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        items = group.column("items").combine_chunks()
        size = items.value_lengths().to_numpy().astype(np.int64)
        values, code = np.unique(items.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(size)), size)
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        shared = np.zeros((len(left), len(right)), np.float32)
        for low in range(0, len(values), 4096):  # some items at a time
            some = slice(*np.searchsorted(code, (low, low + 4096)))
            member = np.zeros((len(size), min(4096, len(values) - low)), np.float32)
            member[owner[some], code[some] - low] = 1
            shared += member[left] @ member[right].T
        union = size[left][:, None] + size[right] - shared
        x, y = np.nonzero((100 * shared.astype(np.float64) >= percent * union) & (of[left][:, None] != of[right]))
        return left[x], right[y]

    return near


def _blocks(rows: Column, items: Column) -> Column:
    return F.greatest(F.ceil(rows / _BLOCK), F.ceil(items / _ITEMS), F.lit(1)).cast("int")


def _with_blocks(members: DataFrame) -> DataFrame:
    """family, node, blocks (of the family), block (the node's), for families of two or more; members: family, node, n."""
    sizes = members.groupBy("family").agg(F.count("*").alias("c"), _blocks(F.count("*"), F.sum("n")).alias("blocks"))
    members = spread_join(members, kept(sizes.where("c > 1")), "family", "c", "node")
    return members.select("family", "node", "blocks", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int").alias("block"))


def _first_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): nodes that similar sets connect, each family's first block against all of it; members: family, node, items, blocks, block.

    A family of one block is compared whole by this.
    """
    first = F.col("block") == 0
    to = F.when(first, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    rows = members.withColumn("to", F.explode(to)).select(F.xxhash64("family").alias("key"), F.col("to").cast("long").alias("j"), first.alias("left"), (F.col("to") == F.col("block")).alias("right"), "node", F.col("node").alias("component"), "items")
    return _compared(rows, ["key", "j"], _similar(percent))


def _rest_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): components of one family with similar sets; members: family, component, node, items.

    Pairs within the family's largest component need no look, so its nodes only meet those of the others: both are
    cut into blocks, and a task compares one block of the others with another, or with one of the largest.
    """
    small = kept(members.select("family", "component", "node", F.size("items").alias("s")))
    sizes = small.groupBy("family", "component").agg(F.count("*").alias("c"), F.sum("s").alias("s"))
    largest = sizes.groupBy("family").agg(F.max(F.struct("c", "s", "component")).alias("top"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    plan = largest.select("family", "c", F.col("top.component").alias("largest"), _blocks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("others"), _blocks(F.col("top.c"), F.col("top.s")).alias("tops"))
    placed = spread_join(small, kept(plan), "family", "c", "node").drop("s", "c")
    rows = placed.join(members.select("node", "items"), "node").withColumn("is_top", F.col("component") == F.col("largest"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("others"))).cast("int"))
    pair = lambda i, j, left, right: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), left.alias("left"), right.alias("right"))
    b, yes, no = F.col("block"), F.lit(True), F.lit(False)
    with_others = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: pair(F.least(b, o), F.greatest(b, o), b <= o, b >= o))
    with_tops = F.transform(F.sequence(F.lit(0), F.col("tops") - 1), lambda t: pair(b, F.lit(-1) - t, yes, no))
    of_top = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda o: pair(o, F.lit(-1) - b, no, yes))
    rows = rows.withColumn("p", F.explode(F.when(F.col("is_top"), of_top).otherwise(F.concat(with_others, with_tops))))
    return _compared(rows.select(F.xxhash64("family").alias("key"), "p.*", "node", "component", "items"), ["key", "i", "j"], _similar(percent))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, signs: int = 24) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text).

    Words are runs without ASCII white space, A-Z in lower case; a text with fewer words than a shingle has all of
    them as its one shingle.  Documents are linked if 100 * intersection >= percent * union of their sets;
    component_id is the smallest doc_id that links lead to, and kept says that it is the document's own.

    Null and empty texts have no shingles and no links and are kept under their own doc_id.  Rows that repeat share
    their component and, having one doc_id, are all kept or all not; a null doc_id is never a component's smallest
    unless all are null, and is not kept then; an empty table gives no rows; other columns are ignored.
    """
    docs = pick(docs, doc_id="long", text="string")
    distance = 2 * (signs // 3) - 1
    signed_docs = kept(signatures(docs, shingle, signs))
    nodes = kept(signed_docs.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("signature").alias("signature")))
    keys = index_keys(nodes, signs)
    buckets = kept(keys.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).where("c > 1"))
    members = kept(spread_join(keys, buckets, "key", "c", "node").drop("c"))
    families = components(_star(members, nodes, distance, percent))
    placed = members.join(families, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = placed.groupBy("key").agg(F.count("*").alias("c"), F.min("component").alias("least"), F.max("component").alias("most"))
    split = kept(split.where("least != most").select("key", "c"))
    families = families.select("node", "component")
    if split.limit(1).count():
        open_ = spread_join(placed.select("key", "node", "component"), split, "key", "c", "node")
        open_ = kept(open_.join(nodes.select("node", "n", "signature"), "node"))
        wider = _families(open_, distance, percent)
        # a component that no open bucket connects is a family, and a node that only they connect had none
        families = families.union(open_.select("node", "component")).distinct().join(wider, "component", "left")
        families = families.select("node", F.coalesce("family", "component").alias("component"))
    families = families.join(nodes.select("node", "n"), "node").select("node", F.col("component").alias("family"), "n")
    families = kept(_with_blocks(kept(families)))
    wanted = kept(families.join(nodes, "node").select(F.coalesce("doc", F.lit(_NO_ID)).alias("wanted")).distinct())
    texts = docs.join(wanted, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("wanted"), "left_semi")
    blocked = kept(shingle_sets(texts, shingle).join(families, "node").dropDuplicates(["node"]).select("family", "node", "items", "blocks", "block"))
    links = kept(_first_links(blocked, percent))
    labels = components(links)
    large = blocked.where("blocks > 1")
    if large.limit(1).count():
        rest = large.join(labels, "node", "left").select("family", F.coalesce("component", "node").alias("component"), "node", "items")
        labels = components(links.union(_rest_links(rest, percent)))
    smallest = labels.join(nodes, "node").groupBy("component").agg(F.min("doc").alias("component_id"))
    linked = labels.join(smallest, "component").select("node", "component_id")
    of_node = nodes.join(linked, "node", "left").select("node", F.coalesce("component_id", "doc").alias("component_id"))
    out = signed_docs.join(of_node, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = doc_id
"""
