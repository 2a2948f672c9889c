"""Spelling variants: words one edit apart, found by scanning sorted words with banded edit matrices.

Two words one edit apart agree before the edit and after it.  Of words of n and n + 1 letters (a class) those that share
the first half or the last half of n letters form groups, so each near pair meets in the group of the half without the
edit.  A group is a sorted list (of words spelt backwards, if they share their ends).  Every word of n letters is held
against the list: an edit-matrix row, cut to a band of three cells since one edit leaves the diagonal by one at most,
belongs to a prefix and so to the range of the list that shares it.  Ranges are divided by their next letter at the
places where neighbours' longest common prefix ends; each part's row is made once from its parent's, and a range of
which the row is beyond one edit everywhere is left.  All words of many groups take each step together.

A group of too many words is divided further: its window of places for the edit is halved, and the words are grouped by
all that lies before the window and all that lies behind it.  A window of one place holds words that differ in two
letters at most, so groups are bounded by the alphabet, and only words of large groups are copied further.

A word's count may be large but its rows are few: counts are summed in each task before they are shuffled.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, pick, table
from .stream import whole_groups
from .words import LOWER, parts

#: Groups of more words, or of more bytes, are divided.
LIMIT, LIMIT_BYTES = 4096, 16 << 20
#: Counts that a task holds before it hands them on.
HELD = 1 << 18
#: So many letters of words are held against their lists at once.
SLICE = 1 << 13


def noisy_counts(docs: DataFrame, min_length: int, every: int) -> DataFrame:
    """word, n: runs of letters, of which each (document, run) whose hash `every` divides has lost one letter."""
    wanted = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")  # a shorter run has no such part

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in parts(batches):
            for id_, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = Counter(wanted.findall(text.encode().translate(LOWER).decode())) if text else {}
                seed = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for run, n in own.items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < min_length:
                            continue
                    held[run] += n
            if len(held) > HELD:
                yield hand_on()
        yield hand_on()

    return docs.mapInArrow(count, "word string, n long")


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (word, n, size, lo, hi) with the key of what words share: the letters before lo and those from hi on, counted
    for words of `size` letters."""
    return rows.withColumn("key", F.expr("xxhash64(size, lo, hi, left(word, lo), right(word, size - hi))"))


def _groups(vocabulary: DataFrame, min_length: int, limit: int) -> DataFrame:
    """word, n, size, lo, hi, key: each word in its groups; none of them too large unless its window is one place."""
    one = lambda size, lo, hi: F.struct(size.cast("int").alias("size"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))
    own, less, zero = F.length("word"), F.length("word") - 1, F.lit(0)
    half = lambda size: F.floor(size / 2)
    windows = F.array(one(own, half(own), own), one(own, zero, half(own)), one(less, half(less), less), one(less, zero, half(less)))
    rows = vocabulary.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*").where(F.col("size") >= min_length)
    rows = _keyed(rows)
    while True:
        sizes = rows.groupBy("key", "size", "lo", "hi").agg(F.count("*").alias("c"))
        large = sizes.where((F.col("hi") - F.col("lo") > 1) & ((F.col("c") > limit) | (F.col("c") * F.col("size") > LIMIT_BYTES)))
        large = kept(large.select("key", F.lit(True).alias("large")))
        if large.isEmpty():
            return rows
        # few keys have so many rows; a plain join, of which Spark splits what is skewed
        rows = rows.join(large.dropDuplicates(["key"]), "key", "left").drop("key")
        lo, hi, middle = F.col("lo"), F.col("hi"), F.floor((F.col("lo") + F.col("hi")) / 2)
        cut = F.when(F.col("large") & (hi - lo > 1), F.array(one(F.col("size"), lo, middle), one(F.col("size"), middle, hi))).otherwise(F.array(one(F.col("size"), lo, hi)))
        rows = _keyed(rows.select("word", "n", F.explode(cut).alias("w")).select("word", "n", "w.*"))


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, member): the numbers first[i] ... first[i] + count[i] - 1 of each i."""
    which = np.repeat(np.arange(len(first)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


def scan(letters: np.ndarray, starts: np.ndarray, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row): rows one edit from a query, in each query's own group.

    letters: the words as rows of n + 1 bytes, those of n letters end with 0; sorted and distinct inside the groups,
    which begin at `starts` and share their first `depth` letters.  queries: some rows of n letters.
    """
    rows, n = letters.shape[0], letters.shape[1] - 1
    common = np.full(rows + 1, -1, np.int64)
    common[1:rows] = (letters[1:] != letters[:-1]).argmax(1)
    common[starts] = -1
    bounds = np.append(starts, rows)
    group = np.searchsorted(starts, queries, "right") - 1
    who, low, high = queries, bounds[group], bounds[group + 1]
    # the row's cells for the query's first depth - 1, depth and depth + 1 letters; 2 stands for all that is more than 1
    back, same, on = np.full(len(who), 1 if depth else 2, np.int8), np.zeros(len(who), np.int8), np.full(len(who), 1 if depth < n else 2, np.int8)
    padded = np.zeros(rows, np.uint8)
    found = []
    for d in range(depth, n + 1):
        breaks = np.append(np.flatnonzero(common[:rows] <= d), rows)
        a, b = np.searchsorted(breaks, low), np.searchsorted(breaks, high)
        parent, part = _expand(a, b - a)
        who, low, high = who[parent], breaks[part], breaks[part + 1]
        back, same, on = back[parent], same[parent], on[parent]
        letter = letters[low, d]
        before = letters[who, d - 1] if d else padded[who]
        new_back = np.minimum(back + (letter != before), same + 1)
        if d == n:
            # words of n letters have ended, of the others this was the last letter
            edits = np.where(letter == 0, same, new_back)
            found.append((who[edits == 1], low[edits == 1]))
            break
        new_same = np.minimum(np.minimum(same + (letter != letters[who, d]), on + 1), new_back + 1)
        new_on = np.minimum(on + (letter != letters[who, d + 1]), new_same + 1) if d + 2 <= n else np.full(len(who), 2, np.int8)
        go = np.minimum(np.minimum(new_back, new_same), new_on) <= 1
        who, low, high, back, same, on = who[go], low[go], high[go], new_back[go].astype(np.int8), new_same[go].astype(np.int8), new_on[go].astype(np.int8)
    who, low = (np.concatenate(x) for x in zip(*found, strict=True))
    # words may share a key alone
    share = np.concatenate([(letters[who[i : i + rows]] != letters[low[i : i + rows]]).argmax(1) >= depth for i in range(0, len(who), rows)] or [np.zeros(0, bool)])
    return who[share], low[share]


def _near(rows: pa.Table, starts: np.ndarray, size: int, lo: int, hi: int) -> pa.RecordBatch:
    """word, near, best, best_n: for each word with near ones in these groups their number and the likeliest of them."""
    text = rows.column("text").to_pylist()
    longer = rows.column("longer").to_numpy()
    letters = np.frombuffer(b"".join(x.encode("latin-1").ljust(size + 1, b"\0") for x in text), np.uint8).reshape(len(text), size + 1)
    backwards = lo == 0
    forward = letters
    if backwards:
        forward = np.zeros_like(letters)
        forward[longer] = letters[longer][:, ::-1]
        forward[~longer, :size] = letters[~longer, :size][:, ::-1]
    queries = np.flatnonzero(~longer)
    a, b = [], []
    step = max(1, SLICE // (size + 1))
    for at in range(0, len(queries), step):
        q, r = scan(letters, starts, queries[at : at + step], size - hi if backwards else lo)
        # a pair belongs to the window in which the words first differ; this also leaves out pairs that share a key only
        differ = np.concatenate([(forward[q[i : i + step]] != forward[r[i : i + step]]).argmax(1) for i in range(0, len(q), step)] or [np.zeros(0, np.int64)])
        differ = np.minimum(differ, size - 1)
        own = (differ >= lo) & (differ < hi)
        q, r = q[own], r[own]
        # words of one length are queries of each other, a longer one is none
        a += [q, r[longer[r]]]
        b += [r, q[longer[r]]]
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    n, word = rows.column("n").to_numpy(), rows.column("word")
    place = np.empty(len(text), np.int64)
    place[pc.sort_indices(word).to_numpy()] = np.arange(len(text))
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(a)))
    return pa.RecordBatch.from_arrays([word.take(pa.array(a[first])).combine_chunks(), pa.array(many, pa.int64()), word.take(pa.array(b[first])).combine_chunks(), pa.array(n[b[first]], pa.int64())], names=["word", "near", "best", "best_n"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole_groups(batches, ["size", "lo", "hi", "key"]):
        alike = [rows.column(c).to_numpy() for c in ("size", "lo", "hi")]
        cuts = np.flatnonzero(np.append(True, np.any([x[starts[1:]] != x[starts[:-1]] for x in alike], axis=0))) if len(starts) > 1 else np.zeros(1, np.int64)
        ends = np.append(starts[cuts[1:]], rows.num_rows)
        for k, (first, end) in enumerate(zip(starts[cuts].tolist(), ends.tolist(), strict=True)):
            of = starts[cuts[k] : cuts[k + 1] if k + 1 < len(cuts) else None] - first
            if end - first > 1:
                yield _near(rows.slice(first, end - first), of, *(int(x[first]) for x in alike))


def near_words(vocabulary: DataFrame, min_length: int, limit: int = LIMIT) -> DataFrame:
    """word, n_near, best, best_n: for each word with near words their number, and the one with the largest n.

    vocabulary (a kept() table): distinct words of letters up to U+00FF, and their n.
    """
    rows = _groups(vocabulary, min_length, limit)
    text = F.when(F.col("lo") == 0, F.reverse("word")).otherwise(F.col("word"))
    rows = rows.select("size", "lo", "hi", "key", text.alias("text"), "word", "n", (F.length("word") > F.col("size")).alias("longer"))
    rows = rows.repartition("size", "lo", "hi", "key").sortWithinPartitions("size", "lo", "hi", "key", "text")
    some = rows.mapInArrow(_searched, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return some.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, every: int = 31, limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n: words of docs (doc_id, text) and the spelling that each is a variant of.

    Words are maximal runs of [A-Za-zÀ-ÿ] with A-Z lower-cased; where `every` divides the CRC-32 h of the UTF-8
    text "<doc_id>:<run>", the run's code point h % length is deleted.  Results of at least min_length code points and
    min_count occurrences count.  Words are near if one inserted, deleted or replaced code point makes one the
    other; a word's form is its near word of largest n (ties: the smallest in code-point order) if that is at least
    ratio times its own n; root is the last form of forms.

    Null and empty texts have no words; a null doc_id reads as empty before the colon; rows that repeat count again; a
    text of any length is read whole, a run of any length is one word; an empty table gives no rows; other columns
    are ignored.
    """
    if ratio <= 1:
        raise ValueError("a form must be likelier than its variants")
    counts = noisy_counts(pick(docs, doc_id="long", text="string"), min_length, every)
    words = kept(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    near = near_words(words, min_length, limit)
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = words.join(near, "word", "left")
    found = kept(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    edges = kept(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    # n rises ratio-fold at each form, so chains are short; each round doubles what a word looks ahead
    most = words.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    longest = math.log(max(most / min_count, 1), ratio) + 1 if ratio > 1 else 1 << 20
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        ahead = edges.select(F.col("word").alias("root"), F.col("root").alias("next"))
        edges = kept(edges.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return found.join(edges, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
