"""Benchmark decontamination: one Aho-Corasick automaton over windows of the test items, one scan of the texts."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, pick, positional, table
from .phrases import automaton, matches, normal
from .words import NOT_ALNUM, parts, words

SPANS = "array<struct<item_id:string,first_word:int,end_word:int,first_char:int,end_char:int>>"
RESULT = f"doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>, spans {SPANS}"


def windows_of(text: str | None, n: int) -> list[bytes]:
    """Its runs of n words; all its words, if fewer."""
    w = normal((text or "").encode("utf-8", "surrogatepass")).split()
    return [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def _merged(spans: list[tuple[int, int]]) -> int:
    """The number of words that the spans cover."""
    covered, reach = 0, 0
    for a, b in sorted(spans):
        covered += max(0, b - max(a, reach))
        reach = max(reach, b)
    return covered


def _char(data: bytes, byte: int) -> int:
    return len(data[:byte].decode("utf-8", "replace"))


def _runs(batch: pa.RecordBatch, phrases: list[bytes], owner: list[list[str]], n: int) -> list[dict[str, list[tuple[int, int]]]]:
    """For each text, the merged stretches of words that each item hits."""
    found = automaton(("windows", n, hash(tuple(phrases))), phrases)
    w = words(batch.column(1), NOT_ALNUM, lower=True)
    out: list[dict[str, list[tuple[int, int]]]] = [defaultdict(list) for _ in range(batch.num_rows)]
    for text, a, b, phrase in matches(found, [w.bytes_of(i) for i in range(batch.num_rows)]):
        for item in owner[phrase]:
            _add(out[text][item], a, b)
    return out


def _in_order(items: Iterable[str | None]) -> list[str | None]:
    """Sorted, an item without an id last."""
    return sorted(items, key=lambda x: (x is None, x or ""))


def _add(runs: list[tuple[int, int]], a: int, b: int) -> None:
    """One more stretch, none of which starts before the last; stretches that touch are one."""
    if runs and a <= runs[-1][1]:
        runs[-1] = (min(runs[-1][0], a), max(b, runs[-1][1]))
    else:
        runs.append((a, b))


def _verdicts(batch: pa.RecordBatch, by_text: list[dict[str, list[tuple[int, int]]]], share: float) -> pa.RecordBatch:
    """RESULT for the texts, from the stretches of their items."""
    w = words(batch.column(1), NOT_ALNUM, lower=True)
    total = np.diff(w.first)
    out = []
    for i, by_item in enumerate(by_text):
        raw = w.bytes_of(i)
        n_hit = _merged([run for runs in by_item.values() for run in runs])
        names, at = _in_order(by_item), int(w.first[i])
        ids = [x for x in names if x is not None]
        place = lambda k, to, i=i, at=at, raw=raw: _char(raw, int((w.end if to else w.start)[at + k] - w.offsets[i]))
        spans = [{"item_id": x, "first_word": a, "end_word": b, "first_char": place(a, False), "end_char": place(b - 1, True)} for x in names for a, b in by_item[x]]
        out.append((int(total[i]), n_hit, len(names), hashlib.sha256(",".join(ids).encode()).hexdigest(), n_hit > 0 and n_hit >= share * total[i] - 1e-9, ids, spans))
    columns = list(zip(*out, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.struct([("item_id", pa.string()), *((x, pa.int32()) for x in ("first_word", "end_word", "first_char", "end_char"))]))]
    return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[f.split()[0] for f in RESULT.split(", ")])


def _owned(rows: Iterable[tuple[str, bytes]]) -> tuple[list[bytes], list[list[str]]]:
    """The distinct windows of rows (item, window), and the items of each."""
    owners: dict[bytes, set[str | None]] = defaultdict(set)
    for item, window in rows:
        owners[bytes(window)].add(item)
    return list(owners), [_in_order(x) for x in owners.values()]


def _of_groups(docs: DataFrame, items: DataFrame, n: int, share: float, max_windows: int, max_bytes: int) -> DataFrame:
    """contamination() with an automaton and a scan for each group of windows, one after the other.

    A scan gives the stretches of the texts that its group hits, under the text's SHA-256; a text's stretches come
    together before they are counted.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = windows_of(text, n)
                for i in range(0, len(made), 10_000):
                    some = made[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(some), pa.string()), pa.array(some, pa.binary())], names=["item_id", "window"])

    pairs = kept(items.mapInArrow(cut, "item_id string, window binary").distinct())
    count, size = pairs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window") + 2), F.lit(0))).first()
    groups = max(1, -(-count // max_windows), -(-size // max_bytes))
    of = F.pmod(F.xxhash64("item_id", "window"), F.lit(groups))
    keyed = docs.select(F.sha2("text", 256).alias("_key"), "text")
    hits = None
    for g in range(groups):
        shared = docs.sparkSession.sparkContext.broadcast(_owned(pairs.where(of == g).collect()))

        def scan(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            for batch in parts(batches):
                keys = batch.column(0).to_pylist()
                rows = [(keys[i], x, *run) for i, by_item in enumerate(_runs(batch, *shared.value, n)) for x, runs in by_item.items() for run in runs]
                if rows:
                    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["_key", "item_id", "first_word", "end_word"])

        found = kept(keyed.mapInArrow(scan, "_key string, item_id string, first_word int, end_word int").distinct())
        hits = hits.union(found) if hits else found
        shared.unpersist()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            by_text: list[dict[str, list[tuple[int, int]]]] = []
            for runs in batch.column(2).to_pylist():
                by_text.append(defaultdict(list))
                for run in sorted(runs or (), key=lambda r: (r["first_word"], r["end_word"])):
                    _add(by_text[-1][run["item_id"]], run["first_word"], run["end_word"])
            yield _verdicts(batch, by_text, share)

    spans = hits.groupBy("_key").agg(F.collect_list(F.struct("item_id", "first_word", "end_word")).alias("_runs"))
    joined = docs.withColumn("_key", F.sha2("text", 256)).join(spans, "_key", "left")
    return joined.select("doc_id", "text", "_runs").mapInArrow(judge, RESULT)


def contamination(docs: DataFrame, items: DataFrame, n: int = 13, share: float = 0.05, max_windows: int = 2_000_000, max_bytes: int = 4_000_000) -> DataFrame:
    """A row per row of docs (doc_id, text) with what it shares with items (item_id, text): see RESULT.

    A window is n consecutive words of an item (all words of a shorter one).  A document's word inside any
    occurrence of a window is hit; a document is contaminated if a share of its words or more is hit.  spans holds
    each item's merged stretches as word numbers and as character offsets into the original text.

    Items whose windows surely fit are broadcast as one automaton.  Else the windows are dealt by hash over groups of
    about max_windows windows and max_bytes bytes (about 200 MB of automaton) at most; each group takes one more scan
    of docs, and the rows are the same.

    Null and empty texts have no words and are clean; items without words never match; items with equal windows
    each count.  Windows of items whose item_id is null hit like all others; such items count as one item together,
    item_ids and their digest leave it out, and spans has it with a null item_id.  Repeated rows give a row each;
    empty tables work; other columns are ignored.
    """
    docs = pick(docs, doc_id="long", text="string")
    items = pick(items, item_id="string", text="string")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    # a window starts at a word, and a word and a space take two bytes or more
    if size // 2 + count > max_windows or n * (size + count) > max_bytes:
        return _of_groups(docs, items, n, share, max_windows, max_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(_owned((r["item_id"], x) for r in items.collect() for x in windows_of(r["text"], n)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield _verdicts(batch, _runs(batch, *shared.value, n), share)

    return docs.mapInArrow(scan, RESULT)


def decontaminate(docs: DataFrame, items: DataFrame, **settings: object) -> DataFrame:
    """The rows of docs, all their columns, whose text is not contaminated; the same settings and rules.

    A document is judged by its text, so rows meet their verdict by a hash of the text, not by doc_id.  Null and empty
    texts stay; rows that repeat stay or go together; an empty table gives no rows; columns may have any names.
    """
    docs, names = positional(docs)
    keyed = docs.withColumn("key", F.sha2(F.coalesce(F.col(f"c{names.index('text')}").cast("string"), F.lit("")), 256))
    number = F.xxhash64("key")
    bad = contamination(keyed.select(number.alias("doc_id"), F.col(f"c{names.index('text')}").alias("text")), items, **settings)
    bad = kept(bad.where("contaminated").select(F.col("doc_id").alias("bad")).distinct())
    return keyed.join(bad, number == F.col("bad"), "left_anti").select(*docs.columns).toDF(*names)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT r, i, p.n, item_id FROM places p JOIN win USING (s, n)),
hit_words AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(generate_series(0, n - 1)) AS k FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""
