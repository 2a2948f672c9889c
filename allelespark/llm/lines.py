"""Line dedup: repeated runs of lines by a suffix array over line ids; later copies are deleted.

A line's id is its digest of 128 bits.  A suffix is a place in a document's sequence of lines.  The suffix array is made
by prefix doubling: ids are ranked by a distributed sort; then a suffix's rank by its first 2k lines is that of the
pair of the rank-k numbers at its place and k lines on, pairs again ranked by a sort over all of them.  Suffixes that
have their rank to themselves are settled and leave; a suffix whose second half is settled or beyond the text's end is
settled too, so doubling ends after log2 of the longest repeat's lines.  Suffixes of one rank at level k are an interval
of the suffix array whose longest common prefix has k lines or more.  The smallest place of an interval stays; the
others are later copies of those k lines.  The longest k of each place, joined up along the document, gives the maximal
runs of lines that later copies cover.

Ranks are dealt to distinct pairs, not to suffixes, so a very common pair is one row of the sort; suffixes meet their
pair's rank in a join that spreads common pairs over salts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, kept, pick, positional, schema_of, spread_join, table
from .words import NEWLINE, Words, parts, signed, tidy, words

_PLACE = ("last", "doc", "text", "place")


def _lines(texts: pa.Array) -> tuple[Words, np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Lines that are not blank, their numbers of words, their digests' halves, and a digest of each text by its lines."""
    w, lines = words(texts), words(texts, NEWLINE)
    n = np.searchsorted(w.start, lines.end) - np.searchsorted(w.start, lines.start)
    ok = n > 0
    lines = Words(lines.data, lines.offsets, lines.start[ok], lines.end[ok], np.concatenate([[0], np.cumsum(ok)])[lines.first])
    one, two = lines.hashes()
    return lines, n[ok], (one, two), lines.whole(one, two)[:, 0].copy()


def line_table(docs: DataFrame) -> DataFrame:
    """last, doc, text (a digest of it), place, one and two (the line's digest), n (its words) for each line that is not blank.

    docs has last (whether doc_id is null), doc (doc_id, or a hash of the text), text.
    """

    @tidy
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            lines, n, (one, two), whole = _lines(batch.column(2))
            of = np.repeat(np.arange(batch.num_rows), np.diff(lines.first))
            of_ = pa.array(of)
            columns = (signed(whole)[of], np.arange(len(one)) - lines.first[of], signed(one), signed(two), n)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of_), batch.column(1).take(of_), *map(pa.array, columns)], names=[*_PLACE, "one", "two", "n"])

    return docs.mapInArrow(make, "last boolean, doc long, text long, place long, one long, two long, n long")


def _ranked(suffixes: DataFrame, *by: str) -> DataFrame | None:
    """The suffixes that share `by` with others, with its rank in sorted order and the first place that has it."""
    shared = suffixes.groupBy(*by).agg(F.count("*").alias("c"), F.min(F.struct(*_PLACE)).alias("first")).where("c > 1")
    # numbers by partition and row rise along a sort
    ranks = kept(shared.orderBy(*by).withColumn("rank_", F.monotonically_increasing_id()))
    if not ranks.limit(1).count():
        forget(ranks)
        return None
    out = kept(spread_join(suffixes, ranks, by, "c", *_PLACE).drop("c", *by).withColumnRenamed("rank_", "rank"))
    forget(ranks)
    return out


def repeated_runs(docs: DataFrame, min_lines: int = 2, min_words: int = 8) -> DataFrame:
    """last, doc, text, place, lines: the longest runs of lines that later copies cover, for docs as in line_table().

    A copy counts from min_lines consecutive lines of a document on, or as one line of min_words words or more; blank
    lines are passed over.  Of the levels at which a place is a later copy the longest stands for it, and copies that
    overlap or touch are one run, so runs of a document are apart and fewer than its lines.
    """
    later = F.struct(*_PLACE) > F.col("first")
    active = _ranked(line_table(docs), "one", "two")
    found, level = [], 1
    while active is not None:
        of = active.where(later) if level >= min_lines else active.where(later & (F.col("n") >= min_words)) if level == 1 else None
        if of is not None:
            found.append(of.select(*_PLACE, F.lit(level).alias("lines")))
        ahead = min(level, min_lines - level) if level < min_lines else level
        step = Window.partitionBy("last", "doc", "text").orderBy("place").rangeBetween(ahead, ahead)
        pairs = active.withColumn("next", F.first("rank").over(step)).where("next IS NOT NULL").drop("first")
        active, level = _ranked(pairs, "rank", "next"), level + ahead
    if not found:
        return docs.sparkSession.createDataFrame([], "last boolean, doc long, text long, place long, lines int")
    # one shuffle by document serves all that follows
    longest = reduce(DataFrame.union, found).repartition("last", "doc").groupBy(*_PLACE).agg(F.max("lines").alias("lines"))
    along = Window.partitionBy("last", "doc", "text").orderBy("place")
    reach = F.max(F.col("place") + F.col("lines")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = longest.withColumn("new", (F.col("place") > F.coalesce(reach, F.lit(-1))).cast("int")).withColumn("run", F.sum("new").over(along))
    merged = runs.groupBy("last", "doc", "text", "run").agg(F.min("place").alias("place"), F.max(F.col("place") + F.col("lines")).alias("end"))
    return merged.select(*_PLACE, (F.col("end") - F.col("place")).cast("int").alias("lines"))


def remove_repeated_lines(docs: DataFrame, min_lines: int = 2, min_words: int = 8) -> DataFrame:
    """All columns of docs (doc_id, text, ...) with the later copies' lines deleted from text, and n_lines, n_removed.

    A line is deleted if a run covers it (see repeated_runs) whose lines also start earlier: at a smaller doc_id,
    or earlier in the same document.  A deleted line takes its line end with it.  Lines are equal if their digests of
    128 bits are; n_lines counts those that are not blank.

    Null texts stay null and have no lines; a text that loses all its lines is empty or blank; a null doc_id comes
    after all others, in the order of a hash of the text; several texts under one doc_id are several documents in the
    order of a hash; rows that repeat wholly are one document and share its result; an empty table gives no rows.
    Columns named n_lines or n_removed are replaced; other columns may have any names.
    """
    docs, names = positional(docs, "n_lines", "n_removed")
    at = names.index("text")
    text, id_ = F.col(f"c{at}").cast("string"), F.col(f"c{names.index('doc_id')}").cast("long")
    key = [id_.isNull().alias("last"), F.coalesce(id_, F.xxhash64(text)).alias("doc")]
    runs = repeated_runs(docs.select(*key, text.alias("text")), min_lines, min_words)
    gone = runs.groupBy(F.col("last").alias("last_"), F.col("doc").alias("doc_")).agg(F.collect_list(F.struct("text", "place", "lines")).alias("runs"))
    keyed = docs.select(*docs.columns, *key)
    rows = keyed.join(gone, (F.col("last") == F.col("last_")) & (F.col("doc") == F.col("doc_")), "left").select(*docs.columns, "runs")

    @tidy
    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, f"c{at}"):
            texts, runs = batch.column(at), batch.column(len(names))
            lines, _, _, whole = _lines(texts)
            whole, total = signed(whole), np.diff(lines.first)
            removed = np.zeros(batch.num_rows, np.int64)
            new: dict[int, str] = {}
            for i in np.flatnonzero(runs.is_valid().to_numpy(zero_copy_only=False)).tolist():
                mine = runs[i].values
                of, place, n = (mine.field(j).to_numpy().astype(np.int64) for j in range(3))
                steps = np.zeros(total[i] + 1, np.int64)
                np.add.at(steps, place[of == whole[i]], 1)
                np.add.at(steps, (place + n)[of == whole[i]], -1)
                dropped = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
                removed[i] = len(dropped)
                if not len(dropped):
                    continue
                data = lines.bytes_of(i)
                pieces, last = [], 0
                for k in (dropped + lines.first[i]).tolist():
                    a, b = int(lines.start[k] - lines.offsets[i]), int(lines.end[k] - lines.offsets[i])
                    pieces.append(data[last:a])
                    last = b + 1
                new[i] = b"".join([*pieces, data[last:]]).decode()
            if new:
                texts = pa.array([new.get(i, x) for i, x in enumerate(texts.to_pylist())], pa.string())
            columns = [texts if j == at else batch.column(j) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(removed)], names=[*batch.schema.names[: len(names)], "n_lines", "n_removed"])

    return rows.mapInArrow(rebuild, f"{schema_of(docs)}, n_lines long, n_removed long").toDF(*names, "n_lines", "n_removed")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    return remove_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH pieces AS (
  SELECT doc_id, j, line, j < total AS ends, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, len(l) AS total, unnest(generate_series(1, len(l))) AS j, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
lines AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS p, lead(line) OVER (PARTITION BY doc_id ORDER BY j) AS nxt FROM pieces WHERE n > 0),
one AS (SELECT doc_id, p, row_number() OVER (PARTITION BY line ORDER BY doc_id, p) AS r, n FROM lines),
two AS (SELECT doc_id, p, row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, p) AS r FROM lines WHERE nxt IS NOT NULL),
gone AS (SELECT doc_id, p FROM one WHERE r > 1 AND n >= 8 UNION SELECT doc_id, p + k FROM two, (VALUES (0), (1)) AS t(k) WHERE r > 1),
judged AS (SELECT l.doc_id, l.j, g.p IS NOT NULL AS gone FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.p = l.p)
SELECT p.doc_id, count(*) FILTER (p.n > 0)::BIGINT AS n_lines, count(*) FILTER (coalesce(q.gone, false))::BIGINT AS n_removed,
       sha256(coalesce(string_agg(p.line || CASE WHEN ends THEN chr(10) ELSE '' END, '' ORDER BY p.j) FILTER (NOT coalesce(q.gone, false)), '')) AS kept_sha256
FROM pieces p LEFT JOIN judged q ON q.doc_id = p.doc_id AND q.j = p.j GROUP BY p.doc_id
"""
