"""Spelling variants, archives and hard negatives against brute force, with nulls, ties, repeats and large groups."""

import glob
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from allelespark.llm import negatives, spelling, warc

DOCS = "doc_id long, text string, WORD string, n long, form string"


def brute_spelling(rows, min_length=7, min_count=2, ratio=10, every=31):
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    cut = {}
    for w in words:
        for i in range(len(w)):
            cut.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: {x for i in range(len(w)) for x in cut[w[:i] + w[i + 1 :]] if x != w and len(x) == len(w) and sum(a != b for a, b in zip(x, w, strict=True)) == 1} | {x for x in {w[:i] + w[i + 1 :] for i in range(len(w))} if x in words} | cut.get(w, set()) for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def spelling_rows(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcéÿ") for _ in range(rng.randint(6, 10))) for _ in range(40)]
    rows = [(None, "Ärgerlichkeit ärgerlichkeit"), (1, None), (2, ""), (3, " \n 12 abc"), (6, ("x" * 2000 + " ") * 2 + ("x" * 1999 + "y ") * 2)]
    rows += [(20 + i, "commonword " * 300 + "CommonWord commonwor commonwords " * 2 + "commonwond " * 25 + "commonwon commonwon") for i in range(12)]
    for i in range(60):
        some = []
        for _ in range(200):
            w = rng.choice(base) if rng.random() < 0.7 else base[0]
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", rng.choice("abcéÿÉ×"), w[at] + rng.choice("abc")]) + w[at + 1 :]
            some.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((100 + i, rng.choice([" ", "-", "1"]).join(some)))
    return rows + [rows[7], rows[7], (None, None)]


@pytest.mark.parametrize("limit", [4096, 6])
def test_spelling_against_brute_force(spark, limit):
    rows = spelling_rows()
    got = spelling.spelling_variants(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS), limit=limit)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got, want = sorted((tuple(r) for r in got.collect()), key=str), brute_spelling(rows)
    assert got == want
    assert len(want) > 200 and any(r[2] not in (r[0], r[1]) for r in want)


def test_spelling_scan_of_random_words():
    rng = random.Random(1)
    for n in (1, 2, 5, 8):
        words = sorted({"".join(rng.choice("ab") for _ in range(n + rng.randint(0, 1))) for _ in range(300)})
        letters = np.array([list(w.encode().ljust(n + 1, b"\0")) for w in words], np.uint8)
        queries = np.array([i for i, w in enumerate(words) if len(w) == n])
        q, r = spelling.scan(letters, np.array([0]), queries, 0)
        got = {(words[a], words[b]) for a, b in zip(q.tolist(), r.tolist(), strict=True)}
        is_near = lambda a, b: a != b and (sum(x != y for x, y in zip(a, b, strict=True)) == 1 if len(a) == len(b) else any(b[:i] + b[i + 1 :] == a for i in range(len(b))))
        assert got == {(a, b) for a in words if len(a) == n for b in words if is_near(a, b)}
        assert len(q) == len(got)


def test_new_operators_on_empty_tables(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


PAGES = "page_id long, url string, html string, URL string, payload_bytes string"


def pages():
    long, odd = "<p>" + "ü€ text " * 30, "z" * 100
    rows = [(5, "http://a/5", long), (3, "http://a/3 x\r\nInjected: 1", long), (9, None, long), (7, "http://é/", None), (8, "http://b", ""), (10, "u", "short"), (11, "u", "short"), (12, "v", "y" * 99), (13, "v", "y" * 99), (14, "v", odd), (15, "v", odd), (None, "w", odd), (None, None, "n" * 200), (None, "q", "n" * 200), (20, "big", "big " * 400000), (20, "big", "big " * 400000), (21, "r\n\r\nWARC/1.1", "a\r\n\r\nWARC/1.1\r\n" * 20)]
    return rows + [(100 + i, f"http://c/{i}", f"page {i % 7} " * 40) for i in range(300)]


def test_warc_round_trip(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)
    index = warc.write_archives(df, str(tmp_path / "out"), file_bytes=20_000)
    first = {}
    for id_, _, html in rows:
        if id_ is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, id_), id_)
    records = warc.read_records(index)
    got = sorted([(r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in records.collect()], key=str)
    want = []
    for id_, url, html in rows:
        data = (html or "").encode()
        again = first.get(html, id_) if len(data) >= 100 else id_
        revisit = again is not None and again != id_
        want.append((id_, url, "revisit" if revisit else "response", again if revisit else None, len(data), hashlib.sha256(data).hexdigest(), None if revisit else data))
    assert got == sorted(want, key=str)
    # revisits get the payload that they stand for
    full = warc.resolved(records)
    assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest for r in full.collect()) and full.count() == len(rows)
    # the archives are whole gzip members, which add up to WARC records in the order of the index
    files = glob.glob(str(tmp_path / "out" / "*.warc.gz"))
    assert len(files) > 3
    assert sum(gzip.open(f).read().count(b"WARC-Record-ID: ") for f in files) == len(rows)
    assert not any(b"\r\nInjected: 1" in gzip.open(f).read() for f in files)
    # some records, by the index
    some = warc.read_records(index.where("page_id % 50 = 0"))
    assert sorted(r.page_id for r in some.collect()) == [100, 150, 200, 250, 300, 350]


def test_warc_empty_table_and_coalesced_ranges(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert index.count() == 0 and warc.read_records(index).count() == 0
    assert warc.coalesced([0, 10, 30, 100], [10, 10, 10, 5], gap=10, most=1000) == [(0, 3), (3, 4)]
    assert warc.coalesced([0, 10, 20], [10, 10, 500], gap=0, most=20) == [(0, 2), (2, 3)]


def test_warc_damage_is_noticed(spark, tmp_path):
    raw = warc.record(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None, None, False)
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(raw)


VECTORS = "vec_id long, embedding array<double>, label int, LABEL string, rank int"


def brute_negatives(rows, every=100, k=5):
    import math

    some = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, label, v) in enumerate(some):
        if anchor % every:
            continue
        score = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for b, (i, other, w) in enumerate(some) if b != a]
        for ps, positive, _ in sorted(x for x in score if x[2] == label)[:k]:
            for rank, (ns, negative, _) in enumerate(sorted(x for x in score if x[2] != label and 80 * -ps <= 100 * -x[0] <= 100 * -ps)[:k]):
                out.append((anchor, positive, rank + 1, negative, -ps, -ns))
    return sorted(out)


@pytest.mark.parametrize("scale", [1, 1e6])
def test_hard_negatives_against_brute_force(spark, scale):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    rows = [(int(i), (scale * (centres[i % 12] + 0.3 * rng.normal(size=8))).tolist(), int(rng.integers(0, 4)) if i % 3 else 1) for i in range(1200)]
    rows += [(100, None, 1), (200, [1.0] * 8, None), (None, [1.0] * 8, 1), (300, [1.0, None] * 4, 1), (400, [float("nan")] * 8, 1), (500, [float("inf")] * 8, 1), (2000, [], 2), (2100, [0.5, 1.5], 3), (2200, [0.0] * 8, 1)]
    rows += [rows[100], rows[100], rows[9]] + [(5000 + i, rows[200][1], 2) for i in range(150)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    got = negatives.hard_negatives(df, block=32)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100


def test_hard_negatives_beyond_doubles(spark):
    rows = [(100, [2.0**20, 1.0], 1), (101, [2.0**24, 3.0], 1), (102, [2.0**24, 2.0], 2), (103, [2.0**24, 3.0], 3), (104, [-1.0, 0.0], 2)]
    got = negatives.hard_negatives(spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS))
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_zone_maps_leave_blocks_unread(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (np.eye(6)[i % 6] * 4 + 0.05 * rng.normal(size=6)).tolist(), i % 6) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("vec_id", F.col("label").cast("long").alias("label"), F.transform("embedding", lambda x: F.floor(x * 256)).alias("q"))
    shape = negatives.shape_of(df)
    blocks = negatives.in_blocks(df.repartition(3), shape, 8)
    groups = negatives.anchor_groups(blocks, shape, 100, 5)
    bundles = blocks.select(F.shiftright("block", negatives.BUNDLE_BITS)).distinct().count()
    read = negatives.chosen(groups, blocks, shape, True).count()
    assert 0 < read < groups.count() * bundles / 2


def test_hilbert_curve_is_one():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = negatives.hilbert(points, bits)
        assert sorted(place.tolist()) == list(range(len(points)))
        path = points[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_sql_of_archives_and_negatives(spark):
    con = duckdb.connect()
    for sql, table, columns in ((warc.OP12_SQL, "pages", ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]), (negatives.OP13_SQL, "embeddings", ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
        got = {"pages": warc.op12_warc, "embeddings": negatives.op13_hard_negatives}[table](spark, "/root/testdata/sf0.001")
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str) and want
