"""Substring dedup: suffix trees, partitioned by variable-length prefixes of words.

The suffixes of all texts are split by their first words: a prefix of 1 word is a group of its own unless it is
heavy (over 1 / GROUPS of all suffixes), then its continuations of 2, 4, 8, 16 words are, each only while heavy.
Groups thus have about equal, bounded sizes, and a group's suffixes form one subtree.  Only nodes at depth n (the
window) and deeper matter, so a subtree is built truncated there and path-compressed: the path from the prefix to
depth n is its 128-bit fingerprint over the words' digests, suffixes sorted by it stand in tree order, and equal neighbours hang below one
deep internal node.  Each deep node's earliest suffix stays; all others are repeats.  Runs of repeated windows are
the maximal repeats.

Before suffixes are dealt out, three steps keep them few, none of which drops a repeat:
- a text equal to an earlier one is all repeats and sends no suffix;
- a repeated window must hold a repeated anchor: of the ANCHOR-word runs inside a window the one with the smallest
  hash, the same in every copy.  Anchors are a seventh of the suffixes; only windows around repeated ones are sent;
- each piece of text merges its own subtree first: a suffix that the piece itself has earlier is a repeat already,
  so a very common window costs a row per piece instead of one per place.
All exchanges are sorted and read in a stream, so no group has to fit in memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, kept, partitions, pick, spread_join, table
from .stream import changes
from .words import Words, mix, ngrams, parts, ranged, signed, words

ANCHOR = 8
DEPTHS = (1, 2, 4, 8, 16)
GROUPS = 2048
#: What known texts have: whether doc_id is null, doc_id (or a hash of the text), text, copied, many.
_LAST, _DOC, _TEXT, _COPIED, _MANY, _MORE = range(6)


def _anchors(w: Words, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of n words, the index of each window's anchor, and the hashes that anchors have."""
    size = min(ANCHOR, n)
    start, _ = ngrams(h, n, w.first)
    grams = np.zeros(len(h), np.uint64)
    at, values = ngrams(h, size, w.first)
    grams[at] = values
    span, reach = n - size + 1, 1
    place = np.arange(len(h), dtype=np.uint64)
    low = (grams & ~np.uint64(0xFFFFFF)) | (place & np.uint64(0xFFFFFF))
    while 2 * reach <= span:  # low[i] is the smallest among reach places from i on
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[start], low[start + span - reach]) if len(start) else low[:0]
    offset = (low - start.astype(np.uint64)) & np.uint64(0xFFFFFF)
    return start, start + offset.astype(np.int64), grams


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(_LAST).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(_DOC).to_numpy()


def _surveys(n: int, groups: int):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Depth 0: hashes of each text that has a window.  Else: prefixes that are heavy in this piece.  -1: suffixes."""
        for batch in parts(batches, "text"):
            w = words(batch.column(_TEXT))
            h, h2 = w.hashes()
            one, two = w.whole(h, h2).T
            long = np.flatnonzero(np.diff(w.first) >= n)
            last, ids = _keys(batch)
            rows = [(np.zeros(len(long), np.int64), signed(one[long]), signed(two[long]), last[long], ids[long])]
            for depth in DEPTHS:
                _, grams = ngrams(h, depth, w.first)
                some, count = np.unique(grams, return_counts=True)
                heavy = count * groups > len(h)
                none = np.zeros(heavy.sum(), np.int64)
                rows.append((np.full(heavy.sum(), depth), signed(some[heavy]), count[heavy], none, none))
            rows.append((np.array([-1]), np.array([0]), np.array([len(h)]), np.array([0]), np.array([0])))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*rows, strict=True)], names=["depth", "one", "two", "last", "doc"])

    return survey


def _sent_anchors(n: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(route, last, doc, anchor): an anchor found once in the piece goes by its hash; one found again is known to repeat: it goes by its hash once, and by chance for each of its documents."""
        for batch in parts(batches, "text"):
            w = words(batch.column(_TEXT))
            h, h2 = w.hashes()
            skip = _copies(batch, w, h, h2)
            _, place, grams = _anchors(w, h, n)
            place = np.unique(place)
            text = np.searchsorted(w.first, place, "right") - 1
            place, text = place[~skip[text]], text[~skip[text]]
            last, doc = _keys(batch)
            anchor, last, doc = grams[place], last[text], doc[text]
            some, at, index, count = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
            again = count[index] > 1
            known, late, of = anchor[again], last[again], doc[again]
            order = np.lexsort((of, late, known))
            order = order[changes([known[order], late[order], of[order]])]
            known, late, of = known[order], late[order], of[order]
            route = np.concatenate([some, mix(mix(known) ^ of.view(np.uint64))])
            columns = (signed(route), np.concatenate([last[at], late]), np.concatenate([doc[at], of]), signed(np.concatenate([some, known])))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["route", "last", "doc", "anchor"])

    return send


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(last, doc, anchor) of the anchors that are known to repeat or have a neighbour with the same route; sorted by route."""
    names = ["last", "doc", "anchor"]
    held = None  # the last row, whose next neighbour is not known yet
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns]
        if held is not None:
            columns = [np.append(x, c) for x, c in zip(held, columns, strict=True)]
        route, *rest = columns
        same = ~changes([route])
        if before is not None and len(same):
            same[0] = route[0] == before
        keep = same.copy()
        keep[:-1] |= same[1:]
        keep |= route != rest[-1]
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1][keep[:-1]]) for c in rest], names=names)
        if len(route) > 1:
            before = route[-2]
        held = [c[-1:] for c in columns]
    if held is not None and (held[0][0] != held[-1][0] or held[0][0] == before):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[1:]], names=names)


def _copies(batch: pa.RecordBatch, w: Words, h: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether a text equals one with a smaller doc_id; `copied` has the digests of the copies among a doc_id's texts."""
    out = np.zeros(batch.num_rows, bool)
    some = np.flatnonzero(batch.column(_COPIED).is_valid().to_numpy(zero_copy_only=False))
    if len(some):
        one = signed(w.whole(h, h2)[:, 0].copy())
        for i in some.tolist():
            out[i] = int(one[i]) in set(batch.column(_COPIED)[i].as_py())
    return out


def _which(batch: pa.RecordBatch, w: Words, h: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """0, or bits of the text's digest if its doc_id stands for several texts; the order's second key."""
    many = batch.column(_MANY).fill_null(False).to_numpy(zero_copy_only=False)
    if not many.any():
        return np.zeros(batch.num_rows, np.int64)
    return np.where(many, (w.whole(h, h2)[:, 0] >> np.uint64(33)).astype(np.int64), 0)


def _sent_suffixes(n: int, heavy: dict[int, np.ndarray]):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(prefix, one, two, last, doc, place, done): the suffixes around repeated anchors; done holds places that repeat within the piece."""
        for batch in parts(batches, "text"):
            w = words(batch.column(_TEXT))
            h, h2 = w.hashes()
            skip = _copies(batch, w, h, h2)
            (last, doc), which = _keys(batch), _which(batch, w, h, h2)
            start, place, grams = _anchors(w, h, n)
            text = np.searchsorted(w.first, start, "right") - 1
            lists = batch.column(_MORE)
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            owner = np.repeat(np.arange(batch.num_rows, dtype=np.uint64), sizes)
            wanted = mix(lists.flatten().to_numpy().view(np.uint64) ^ mix(owner))
            ok = np.isin(mix(grams[place] ^ mix(text.astype(np.uint64))), wanted) & ~skip[text]
            start, text = start[ok], text[ok]
            one, two = ranged(h, start, start + n), ranged(h2, start, start + n)
            at = (which[text] << 32) | (start - w.first[text])
            last, doc = last[text], doc[text]
            order = np.lexsort((at, doc, last, two, one))
            fresh = changes([one[order], two[order]])
            top = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]  # the earliest of the same node
            later = order[(last[order] != last[top]) | (doc[order] != doc[top]) | (at[order] != at[top])]
            sent = order[fresh]
            prefix = np.zeros(len(sent), np.uint64)
            open_ = np.ones(len(sent), bool)
            for depth in DEPTHS:  # the shortest prefix that is not heavy
                if depth < n and open_.any():
                    prefix[open_] = ranged(h, start[sent[open_]], start[sent[open_]] + depth)
                    open_[open_] = np.isin(prefix[open_], heavy.get(depth, np.zeros(0, np.uint64)))
            prefix[open_] = one[sent[open_]]
            later = later[np.lexsort((at[later], text[later]))]
            borders = np.flatnonzero(changes([text[later]])) if len(later) else np.zeros(0, np.int64)
            of, none = later[borders], np.zeros(len(borders), np.int64)
            docs, lasts = np.concatenate([doc[sent], doc[of]]), np.concatenate([last[sent], last[of]])
            route = np.concatenate([signed(prefix), signed(mix(doc[of].view(np.uint64)))])
            done = pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(len(sent), np.int32), borders, [len(later)]]).astype(np.int32)), pa.array(at[later]))
            done = pc.if_else(pa.array(np.arange(len(docs)) < len(sent)), pa.scalar(None, done.type), done)
            columns = (route, np.concatenate([signed(one[sent]), none]), np.concatenate([signed(two[sent]), none]), lasts, docs, np.concatenate([at[sent], none]))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), done], names=["prefix", "one", "two", "last", "doc", "place", "done"])

    return send


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(last, doc, places): what hangs below a deep node, but for its earliest suffix; sorted by prefix, path, last, doc, place."""
    names = ["last", "doc", "places"]
    node = first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        done = batch.filter(batch.column("done").is_valid())
        if done.num_rows:
            yield pa.RecordBatch.from_arrays([done.column("last"), done.column("doc"), done.column("done")], names=names)
        batch = batch.filter(batch.column("done").is_null())
        if not batch.num_rows:
            continue
        prefix, one, two, *own = (batch.column(i).to_numpy() for i in range(6))
        fresh = changes([prefix, one, two])
        fresh[0] = node != (prefix[0], one[0], two[0])
        top = np.maximum.accumulate(np.where(fresh, np.arange(len(one)), -1))
        old = top < 0  # the node began in an earlier batch
        tops = [np.where(old, first[k] if first else 0, c[np.maximum(top, 0)]) for k, c in enumerate(own)]
        node, first = (prefix[-1], one[-1], two[-1]), [c[-1] for c in tops]
        last, doc, place = own
        later = np.flatnonzero((last != tops[0]) | (doc != tops[1]) | (place != tops[2]))
        if len(later):
            later = later[np.lexsort((place[later], doc[later], last[later]))]
            borders = np.flatnonzero(changes([last[later], doc[later]]))
            places = pa.ListArray.from_arrays(pa.array(np.append(borders, len(later)).astype(np.int32)), pa.array(place[later]))
            yield pa.RecordBatch.from_arrays([pa.array(last[later[borders]]), pa.array(doc[later[borders]]), places], names=names)


def _finish(n: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            w = words(batch.column(_TEXT))
            skip, which = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, np.int64)
            known = np.flatnonzero(batch.column(_COPIED).is_valid().to_numpy(zero_copy_only=False) | batch.column(_MANY).is_valid().to_numpy(zero_copy_only=False))
            if len(known):  # only these texts need their digests
                few = batch.take(pa.array(known))
                v = words(few.column(_TEXT))
                h, h2 = v.hashes()
                skip[known], which[known] = _copies(few, v, h, h2), _which(few, v, h, h2)
            total = np.diff(w.first)
            places = batch.column(_MORE)
            some = places.is_valid().to_numpy(zero_copy_only=False)
            removed, texts, spans = [], [], []
            for i in range(batch.num_rows):
                mine = w.bytes_of(i)
                if skip[i]:
                    out, runs = b"", [(0, int(total[i]))]
                elif not some[i]:
                    out, runs = b" ".join(mine.split()), []
                else:
                    at = np.concatenate([np.asarray(x, np.int64) for x in places[i].as_py()])
                    at = at[(at >> 32) == which[i]] & 0xFFFFFFFF
                    steps = np.zeros(total[i] + 1, np.int64)
                    at = np.unique(at)
                    steps[at] += 1
                    steps[at + n] -= 1
                    gone = np.cumsum(steps[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    runs = list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
                    every = mine.split()
                    stays = [0, *(x for run in runs for x in run), len(every)]
                    out = b" ".join(x for a, b in list(pairwise(stays))[::2] for x in every[a:b])
                removed.append(sum(b - a for a, b in runs))
                texts.append(out.decode("utf-8", "surrogatepass"))
                spans.append([{"first_word": a, "end_word": b} for a, b in runs])
            ids = pc.if_else(batch.column(_LAST), pa.scalar(None, pa.int64()), batch.column(_DOC))
            kind = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, kind)], names=["doc_id", "n_words", "n_removed", "kept_text", "repeats"])

    return finish


def remove_repeats(docs: DataFrame, n: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, repeats for each row of docs (doc_id, text).

    Words are runs without ASCII white space, unchanged.  A window is n consecutive words of one document; a word is
    removed if a window covers it whose words also start earlier: at a smaller doc_id, or earlier in the same
    document.  kept_text has the other words with single spaces between; repeats has the maximal removed runs as
    word numbers, end excluded.

    Null and empty texts have no words; a text of fewer than n words loses none; a null doc_id comes after all
    others; several texts under one doc_id are several documents in the order of a hash; rows that repeat wholly
    are one document and each have its result; an empty table gives no rows; other columns are ignored.
    """
    docs = pick(docs, doc_id="long", text="string")
    docs = docs.select(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.xxhash64("text")).alias("doc"), "text")
    survey = kept(docs.mapInArrow(_surveys(n, GROUPS), "depth long, one long, two long, last long, doc long"))
    total = survey.where("depth = -1").agg(F.coalesce(F.sum("two"), F.lit(0)).alias("n")).first()["n"]
    # at most 2 * GROUPS prefixes of a depth have more than 1 / (2 * GROUPS) of all suffixes
    common = survey.where("depth > 0").groupBy("depth", "one").agg(F.sum("two").alias("count")).where(F.col("count") * 2 * GROUPS > total).collect()
    heavy = {d: np.array([r["one"] for r in common if r["depth"] == d], np.int64).view(np.uint64) for d in DEPTHS}
    texts = survey.where("depth = 0").select("one", "two", F.struct("last", "doc").alias("key")).distinct()
    firsts = kept(texts.groupBy("one", "two").agg(F.min("key").alias("first"), F.count("*").alias("c")).where("c > 1"))
    copies = spread_join(texts, firsts, ["one", "two"], "c", "key").where("key > first").groupBy("key").agg(F.collect_set("one").alias("copied"))
    many = texts.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key", F.lit(True).alias("many"))
    facts = kept(copies.join(many, "key", "full").select((F.col("key.last") == 1).alias("_last"), F.col("key.doc").alias("_doc"), "copied", "many"))
    forget(survey, firsts)

    spark = docs.sparkSession
    of = (F.col("last") == F.col("_last")) & (F.col("doc") == F.col("_doc"))
    columns = ["last", "doc", "text", "copied", "many"]
    known = docs.repartition(partitions(spark), "last", "doc").join(facts, of, "left").select(*columns)
    dealt = known.mapInArrow(_sent_anchors(n), "route long, last long, doc long, anchor long").repartition(partitions(spark), "route").sortWithinPartitions("route")
    by_doc = [(F.col("last") == 1).alias("_last"), F.col("doc").alias("_doc")]
    anchors = dealt.mapInArrow(_repeated, "last long, doc long, anchor long").groupBy(*by_doc).agg(F.collect_list("anchor").alias("anchors"))
    near = known.join(anchors, of).select(*columns, "anchors")
    suffixes = near.mapInArrow(_sent_suffixes(n, heavy), "prefix long, one long, two long, last long, doc long, place long, done array<long>")
    trees = suffixes.repartition(partitions(spark), "prefix").sortWithinPartitions("prefix", "one", "two", "last", "doc", "place")
    later = trees.mapInArrow(_later, "last long, doc long, places array<long>").groupBy(*by_doc).agg(F.collect_list("places").alias("places"))
    out = known.join(later, of, "left").select(*columns, "places")
    return out.mapInArrow(_finish(n), "doc_id long, n_words long, n_removed long, kept_text string, repeats array<struct<first_word:int,end_word:int>>")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), n=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(generate_series(0, 19)) AS k FROM ranked WHERE r > 1)),
each_word AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM d),
stay AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each_word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN stay USING (doc_id)
"""
