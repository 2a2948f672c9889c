"""The pipeline against the operators' brute-force rules at small scale."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from allelespark.llm import language, trie
from tests.llm.test_operators import CLASHES, _deleted, _plain, alnum, words

D = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def _readable(rows):
    """doc_ids whose likeliest language has more than half and fits, word by word over all segmentations."""
    known, encoder = trie.vocabulary()
    ids = {s: i for i in range(encoder.get_piece_size()) if not (encoder.is_byte(i) or encoder.is_control(i) or encoder.is_unknown(i)) and (s := encoder.id_to_piece(i).replace("\u2581", " ").encode())}
    learn = [(r.lang, r.text) for r in rows if r.lang is not None and zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 != 1]
    logp = {}
    for lang in {x for x, _ in learn}:
        counts = np.full(known.size, 0.1)
        for p in encoder.encode([w for x, text in learn if x == lang for w in words(text)]):
            np.add.at(counts, p, 1)
        logp[lang] = np.log(counts / counts.sum())
    cache = {}

    def score(word, lang):
        if (word, lang) not in cache:
            cache[word, lang] = _plain(b" " + word.encode(), known, ids, logp[lang])[0]
        return cache[word, lang]

    out = set()
    for r in rows:
        if r.text and any(map(str.isalpha, r.text)) and logp:
            totals = [math.fsum(score(w, lang) for w in words(r.text)) for lang in sorted(logp)]
            best = sorted(logp)[totals.index(max(totals))]
            plain = [w for w in words(r.text) if not re.search("[0-9]", w)]
            fit = sum(score(w, best) for w in plain) / sum(len(w.encode()) + 1 for w in plain) - language.usual(logp[best][:, None])[0] if plain else 0
            if 1 / sum(math.exp(min(t - max(totals), 0)) for t in totals) > 0.5 and fit >= corpus_pipeline.LEAST_FIT:
                out.add(r.doc_id)
    return out


def _classes(texts):
    """The smallest id of each id's group of near copies (five words, 80 %)."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, t in texts.items() if (w := words(t, True)) is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def _dirty(text, windows):
    w, hit = alnum(text), set()
    for n in {len(x) for x in windows}:
        for a in range(len(w) - n + 1):
            if tuple(w[a : a + n]) in windows:
                hit |= set(range(a, a + n))
    return bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def windows(spark):
    out = set()
    for r in spark.read.parquet(f"{D}/benchmark.parquet").collect():
        w = alnum(r.text)
        out |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12) if w else 0)}
    return out


def test_run_against_brute_force(spark, windows):
    rows = spark.read.parquet(f"{D}/documents.parquet").collect()
    readable = _readable(rows)
    texts = [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: r.doc_id) if r.doc_id in readable]
    left = {i: t for i, t, n, gone in _deleted(texts, 2, 8) if not n or gone < n}
    same = _classes(left)
    left = {i: t for i, t in left.items() if same[i] == i and not _dirty(t, windows)}
    got = corpus_pipeline.run(spark, D).collect()
    assert {r.doc_id: r["size"] for r in got} == {i: len(words(t)) for i, t in left.items()} and len(got) == len(left)
    source = {r.doc_id: r.source for r in rows}
    totals = {}
    for i, t in left.items():
        totals[source[i]] = totals.get(source[i], 0) + len(words(t))
    for r in got:
        assert r.source_size == totals[source[r.doc_id]] and 0 <= r.taken <= 3 * r["size"]
    for s in totals:
        mine = [r for r in got if source[r.doc_id] == s]
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, abs=1)
    assert sum({source[r.doc_id]: r.target for r in got}.values()) == pytest.approx(sum(totals.values()))


def test_language_stage_drops_junk_only(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    junk = ["αβγδ εζηθ ικλμ " * 9, "qzxvk wjqxz kvqzj xzqwv " * 30, "zqXvKjWq+/xZ" * 200]
    clean = ['Of the and token = "40d78a45c418324758e099eb7cb89bc0f5fa9f62" 4734663219866878', "The thing and the other " * 500]
    more = spark.createDataFrame([(10**9 + 3 * i, t, None, None, None) for i, t in enumerate(junk + clean)], docs.schema)
    out = {r.doc_id for r in STAGES["language_id"](spark, docs.union(more), D).collect()}
    assert out == {r.doc_id for r in docs.collect()} | {10**9 + 3 * i for i in range(len(junk), len(junk + clean))}


def test_stages_keep_columns_and_odd_rows(spark, windows):
    base = spark.read.parquet(f"{D}/documents.parquet").limit(40)
    some = base.collect()
    schema = base.schema
    odd = [(None, some[0].text, some[0].lang, some[0].source, 1), (None, some[0].text, None, None, None), (900, None, None, None, None), (901, "", "en", None, 0), (902, " \n ", None, "src0", 3), (903, "long " * 20000, "en", "src1", 1), (None, None, None, None, None), tuple(some[1]), (904, some[2].text, "en", "src9", 5)]
    docs = base.union(spark.createDataFrame(odd, schema)).select("*", *(F.lit(f"v{i}").alias(c) for i, c in enumerate(CLASHES) if c not in schema.names and c not in ("TEXT", "Doc_Id")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, D)
        if name != "mixing":
            assert out.columns == docs.columns, name
        rows = out.collect()
        ids = [r.doc_id for r in rows]
        if name == "language_id":
            assert None in ids and not {900, 901, 902} & set(ids)
        if name == "line_dedup":
            assert 904 not in ids and None in ids  # rows of nulls stay, a copied text without an id goes
            assert [r.text for r in rows if r.doc_id is None] == [None]
        if name == "near_dedup":
            assert 904 not in ids and len(ids) == len(set(ids)) and [r.text for r in rows if r.doc_id is None] == [None]
        if name == "decontamination":
            assert len(rows) == sum(not _dirty(r.text, windows) for r in docs.collect())
        if name == "mixing":
            assert len(rows) == docs.count()
        assert stage(spark, docs.where("false"), D).count() == 0, name


def test_near_copies_without_ids_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text, "en", "s", 1), (None, f"{text} more", "en", "s", 1), (None, "other words that stand alone here", "en", "s", 1)]
    out = STAGES["near_dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), D).collect()
    assert len(out) == 2 and re.match("other", min(r.text for r in out))
