"""Each operator on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from allelespark.llm import common, decontaminate, language, licenses, lines, mixing, near_duplicates, neighbours, substrings, tokens, trie, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, DOC_ID string, size string, score string"


def documents(spark, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    base = [word() for _ in range(120)]
    texts = [None, "", " \n\t", "one", "Two words", " ".join(base), " ".join(base), " ".join(base[:60] + ["x"] + base[60:]), " ".join([word() for _ in range(30)] + base[20:70]), "a b " * 40, "\n".join(["same line of eight words is here now", "short", "same line of eight words is here now", "", "short"]), "z" * 5000, " ".join(word() for _ in range(3000))]
    rows = [(i, t, [None, "de", "fr"][i % 3], [None, "s1", "s2", ""][i % 4], 1, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[5], rows[1], (None, texts[5], "de", "s1", 1, "x", "y", "z"), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def by_row(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(spark, docs):
    return [(r[0], r[1]) for r in docs.collect()]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_empty_tables(spark):
    e = empty(spark)
    assert mixing.mix(e).count() == 0
    assert decontaminate.contamination(e, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert substrings.remove_repeats(e).count() == 0
    assert near_duplicates.near_duplicates(e).count() == 0
    assert language.identify(e, ~language.held_out()).count() == 0
    assert licenses.scan_licenses(e).count() == 0
    assert lines.remove_repeated_lines(e).count() == 0
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert tokens.count_tokens(e).count() == 0
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_mixing_targets_and_takes(spark):
    docs = documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    per = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        per.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    names = sorted((s for s in per if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    cap = {s: 3 * sum(r.size for r in per[s]) for s in names}
    target, open_, left = {}, set(names), total
    while True:  # water-filling, step by step
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= cap[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = cap[s]
            left -= cap[s]
            open_.discard(s)
        if not open_:
            break
    for s in names:
        assert per[s][0].target == pytest.approx(target[s])
        assert sum(r.taken for r in per[s]) == pytest.approx(target[s], abs=1)
    assert by_row(mixing.mix(docs)) == by_row(mixing.mix(docs.repartition(5)))
    named = {r.source: r.target for r in mixing.mix(docs, {"s1": 1.0}).collect()}
    assert named["s2"] == 0 and named["s1"] > 0


def test_contamination_against_brute_force(spark):
    docs = documents(spark)
    texts = pairs(spark, docs)
    items = [(1, " ".join(texts[5][1].split()[10:40])), (2, "TWO words"), (3, None), (10, ""), (4, texts[5][1].upper().replace("É", "é")), (None, "one")]
    items = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for r in items.collect():
        w = alnum(r.text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(r.item_id)
    want = []
    for i, text in texts:
        w, hit, ids = alnum(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a : a + n])) in windows:
                    hit |= set(range(a, a + n))
                    ids |= windows[k]
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(str(x) for x in ids if x is not None)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    out = decontaminate.contamination(docs, items)
    assert by_row(out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == sorted(want, key=str)
    row = out.where("doc_id = 4").first()
    assert [(s.first_char, s.end_char) for s in row.spans] == [(0, 9)]
    clean = decontaminate.decontaminate(docs, items)
    assert clean.count() == sum(not x[-1] for x in want)


def test_contamination_by_groups_of_windows(spark):
    docs = documents(spark)
    text = documents(spark).collect()[5][1]
    items = [(1, " ".join(text.split()[10:40])), (2, "TWO words"), (3, None), (10, ""), (4, text), (5, text), (None, "one"), (6, "a b " * 40)]
    items = spark.createDataFrame(items, "item_id long, text string")
    want = by_row(decontaminate.contamination(docs, items))
    assert sum(r[2] > 0 for r in want) > 3
    assert by_row(decontaminate.contamination(docs, items, max_windows=40)) == want  # an error before: refused by its characters
    assert by_row(decontaminate.contamination(docs, items, max_bytes=3000)) == want
    assert sorted(r.text or "" for r in decontaminate.decontaminate(docs, items, max_windows=40).collect()) == sorted(r.text or "" for r in decontaminate.decontaminate(docs, items).collect())


def test_substrings_against_brute_force(spark):
    docs = documents(spark)
    rows = sorted(set(pairs(spark, docs)), key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    seen, want = set(), {}
    for i, text in rows:
        w = words(text)
        gone = set()
        for a in range(len(w) - 19):
            key = tuple(w[a : a + 20])
            if key in seen:
                gone |= set(range(a, a + 20))
            seen.add(key)
        want[i, text] = (i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    got = substrings.remove_repeats(docs, 20)
    assert by_row(got.select("doc_id", "n_words", "n_removed", "kept_text")) == sorted((want[r] for r in pairs(spark, docs)), key=str)
    assert all(sum(s.end_word - s.first_word for s in r.repeats) == r.n_removed for r in got.collect())


def test_repeats_of_frequent_prefixes(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 80)))) for i in range(300)]
    seen, want = set(), []
    for i, text in rows:
        w, gone = text.split(), set()
        for a in range(len(w) - 9):
            key = tuple(w[a : a + 10])
            gone |= set(range(a, a + 10)) if key in seen else set()
            seen.add(key)
        want.append((i, len(gone)))
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 10).select("doc_id", "n_removed")
    assert by_row(got) == sorted(want, key=str)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(2)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(80)] for _ in range(12)]
    rows = []
    for k, b in enumerate(base):
        for _ in range(25):
            c = list(b)
            for _ in range(rng.randint(0, 12)):
                c[rng.randrange(len(c))] = f"x{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(c)))
    rows += [(900, None), (901, ""), (902, "A b"), (903, "a B"), (904, "a b c"), (7, rows[7][1])]
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = {tuple(w[a : a + 4]) for a in range(len(w) - 3)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = [(i, len(sets[i]), find(i), i == find(i)) for i, _ in rows]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4)
    assert by_row(got) == sorted(want, key=str)


def test_small_blocks_give_the_same(spark, monkeypatch):
    docs = documents(spark)
    want = by_row(near_duplicates.near_duplicates(docs, shingle=2, percent=50))
    monkeypatch.setattr(near_duplicates, "_BLOCK", 1)
    assert by_row(near_duplicates.near_duplicates(docs, shingle=2, percent=50)) == want


def test_forward_sums_all_segmentations():
    known = trie.pieces([b" a", b"b", b"ab", b"bc", b"c", b" ab", b"abc"], np.arange(7, 263))
    logp = np.log(np.random.default_rng(0).uniform(0.01, 1, (263, 2)))
    text = pa.array(["abc ab é abc", None, "", "cab" * 40])
    made = trie.pretokens(text)
    scores, _ = trie.forward(made, known, logp)
    best, count = trie.forward(made, known, logp[:, :1], best=True)
    ids = {s: i for i, s in enumerate([b" a", b"b", b"ab", b"bc", b"c", b" ab", b"abc"])}

    def every(s):
        if not s:
            yield []
        for k in range(1, len(s) + 1):
            piece = ids.get(s[:k], 7 + s[0] if k == 1 else None)
            if piece is not None:
                for rest in every(s[k:]):
                    yield [piece, *rest]

    for i, s in enumerate(made.strings()):
        if len(s) < 12:
            ways = list(every(s))
            assert scores[i] == pytest.approx(np.log(sum(np.exp(logp[w].sum(0)) for w in ways)))
            assert best[i, 0] == pytest.approx(max(logp[w, 0].sum() for w in ways))
            assert count[i] == min(len(w) for w in ways if logp[w, 0].sum() > best[i, 0] - 1e-12)
    assert max(made.length) == 121  # no run is cut
    assert np.diff(made.first).tolist() == [4, 0, 0, 1]


def _plain(word, known, ids, logp):
    """(log of the sum, best score, fewest pieces) over all segmentations, place by place."""
    total, top, fewest = [0.0], [0.0], [0]
    for end in range(1, len(word) + 1):
        ways = [(end - k, ids[word[end - k : end]]) for k in range(1, min(end, known.longest) + 1) if word[end - k : end] in ids]
        if word[end - 1 : end] not in ids:
            ways.append((end - 1, known.single[word[end - 1]]))
        total.append(np.logaddexp.reduce([total[a] + logp[p] for a, p in ways]))
        top.append(max(top[a] + logp[p] for a, p in ways))
        fewest.append(min(fewest[a] + 1 for a, p in ways if top[a] + logp[p] == top[-1]))
    return total[-1], top[-1], fewest[-1]


def test_long_runs_are_scored_whole(monkeypatch):
    strings = [b" a", b"b", b"ab", b"bc", b"c", b" ab", b"abc", "漢字".encode(), "漢".encode(), "字漢".encode(), "漢字漢".encode()]
    known = trie.pieces(strings, np.arange(11, 267))
    logp = np.log(np.random.default_rng(0).uniform(0.01, 1, (267, 2)))
    ids = {s: i for i, s in enumerate(strings)}
    words_ = ["cab" * 40, "漢字" * 30 + "é", "abc" * 150 + "漢字漢", "ab" * 400, "b" * 63, "b" * 64, "b" * 65, "b" * 66, "ab"]
    made = trie.pretokens(pa.array([" ".join(words_), None, words_[0]]))
    assert np.diff(made.first).tolist() == [9, 0, 1] and sorted(made.strings()) == sorted(b" " + w.encode() for w in words_)
    for block in (trie._BLOCK, 7, 100):
        monkeypatch.setattr(trie, "_BLOCK", block)
        scores, _ = trie.forward(made, known, logp)
        best, count = trie.forward(made, known, logp[:, :1], best=True)
        for i, s in enumerate(made.strings()):
            want = [_plain(s, known, ids, logp[:, m]) for m in (0, 1)]
            assert scores[i] == pytest.approx([want[0][0], want[1][0]])
            assert best[i, 0] == pytest.approx(want[0][1]) and count[i] == want[0][2]


def test_token_counts_of_text_without_spaces(spark):
    _, encoder = trie.vocabulary()
    text = "我们今天在这里讨论一个没有空格的长句子" * 12 + "https://example.com/" + "path/" * 60
    docs = spark.createDataFrame([(1, text), (2, "words between spaces")], "doc_id long, text string")
    rows = {r.doc_id: r for r in tokens.count_tokens(docs).collect()}
    assert (rows[1].n_pretokens, rows[2].n_pretokens) == (1, 3)
    counts = {r.piece: r["count"] for r in language.piece_counts(docs.where("doc_id = 1").select(F.lit("all").alias("lang"), "text")).collect()}
    want = encoder.encode(text)
    assert counts == {p: want.count(p) for p in set(want)}  # the encoder's own pieces of the whole run


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.op5_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_texts(spark):
    got = {r.doc_id: r for r in language.identify(documents(spark), ~language.held_out()).toDF("doc_id", *"abcdef", "lang_pred", "score", "fit").collect() if r.doc_id is not None}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und"
    assert {r.lang_pred for r in got.values()} <= {"de", "fr", "und"}
    none = language.identify(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string"), ~language.held_out())
    assert none.first().lang_pred == "und" and none.first().fit is None


def test_fit_tells_junk_from_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(2)
    junk = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(n)) for n in (5, 50, 5000)] + ["αβγδ εζηθ ικλμ " * 9, "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") for _ in range(3000))]
    more = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate([*junk, "x1 y2", "5 a1"])], docs.schema)
    got = {r.doc_id: r for r in language.identify(docs.union(more), ~language.held_out() & (F.col("doc_id") < 10**9)).drop("text").collect()}
    assert all(got[10**9 + i].fit < -3 and got[10**9 + i].lang_pred != "und" for i in range(len(junk)))
    assert got[10**9 + 5].fit is got[10**9 + 6].fit is None and got[10**9 + 6].lang_pred != "und"  # every word has a digit
    assert min(r.fit for i, r in got.items() if i < 10**9 and r.fit is not None) > -3


def test_fit_is_the_mean_log_probability():
    """A word's score over its bytes, less that of the model's own bytes, for a vocabulary of a few pieces."""
    logp = np.log(np.full((language.vocabulary()[0].size, 1), 1 / language.vocabulary()[0].size))
    encoder = language.vocabulary()[1]
    sizes = [1 if encoder.is_byte(i) or encoder.is_unknown(i) else len(encoder.id_to_piece(i).replace("\u2581", " ").encode()) for i in range(len(logp))]
    assert language.usual(logp)[0] == pytest.approx(-len(logp) * math.log(len(logp)) / sum(sizes))


def test_licenses(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "gnu general  public\nLicense; Apache License, apache license", "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception\nrest", None, "", "submit license", "MIT License MIT license"]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [(1, 2, 2, "cc-by"), (3, 0, 6, "apache,gpl"), (0, None, None, ""), (0, None, None, ""), (0, None, None, ""), (0, None, None, ""), (2, 0, 2, "mit")]
    assert rows[0].labels == "cc-by,cc-by-nc" and rows[2].labels == "apache,apache-2.0,gpl,gpl-2.0-only,mit"
    assert texts[0][rows[0].notices[0].first_char : rows[0].notices[0].end_char] == "CC BY"
    assert licenses.postfix("a OR b AND c WITH d") == ["a", "b", "c", "d", "WITH", "AND", "OR"]
    assert licenses.postfix("(a OR b) AND c)") == ["a", "b", "OR", "c", "AND"]
    assert licenses.postfix("a AND") == ["a"] and licenses.evaluate("") is None and licenses.postfix("((a") == ["a"]
    assert licenses.evaluate("MIT OR GPL-2.0")[1] == 1.0 and licenses.evaluate("MIT AND GPL-2.0")[1] == 0.2


def test_expressions_that_end_in_a_bracket(spark):
    for cut in ("MIT OR (", "MIT AND ((", "MIT OR ()", "(MIT OR (", "MIT AND (OR GPL-2.0)"):
        assert licenses.postfix(cut) == ["MIT"] and licenses.evaluate(cut) == ({"mit"}, 1.0)
    assert licenses.postfix("(a) OR (b AND (") == ["a", "b", "OR"] and licenses.postfix("a OR b WITH (") == ["a", "b", "OR"]
    assert licenses.postfix("(") == licenses.postfix("((") == []
    row = licenses.scan_licenses(spark.createDataFrame([(1, "SPDX-License-Identifier: MIT OR (\n  GPL-2.0)")], "doc_id long, text string")).first()
    assert row.labels == "mit" and row.expressions == ["MIT OR ("]


def test_lines(spark):
    eight = "one two three four five six seven eight"
    rows = [(1, f"{eight}\nx\ny\n{eight}\nend"), (2, f"x\ny\nz\n\n{eight}"), (3, None), (4, ""), (5, "y\nx"), (None, f"q\n{eight}\r\n{eight}"), (1, f"{eight}\nx\ny\n{eight}\nend")]
    got = lines.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("N_Lines_", F.lit(1)))
    want = {1: (f"{eight}\nx\ny\nend", 5, 1), 2: ("z\n\n", 4, 3), 3: (None, 0, 0), 4: ("", 0, 0), 5: ("y\nx", 2, 0), None: (f"q\n{eight}\r\n", 3, 1)}
    assert [(r.text, r.n_lines, r.n_removed) for r in got.collect() if want[r.doc_id] != (r.text, r.n_lines, r.n_removed)] == []
    assert got.count() == 7


def test_nearest_finds_most(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(5000, None), (5100, [0.0] * 16), (5200, [math.nan] * 16), (5300, [1.0, None]), (5400, [1.0, 2.0]), (None, [1.0] * 16), (0, vectors[0].tolist())]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.query_id for r in got} == set(range(0, 3000, 100))
    hit = 0
    for q in range(0, 3000, 100):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11)) and all(r.vec_id != q for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        assert all(r.score == pytest.approx(d[r.vec_id], abs=1e-12) for r in mine)
        hit += len(set(np.argsort(d)[1:11]) & {r.vec_id for r in mine})
    assert hit >= 0.9 * 300


def test_nearest_of_few(spark):
    got = neighbours.nearest(spark.createDataFrame([(0, [1.0, 1.0]), (1, [2.0, 1.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 7, 1.0)]


def test_token_counts(spark):
    got = tokens.count_tokens(documents(spark)).collect()
    assert all(r.n_pretokens <= r.n_tokens for r in got)
    assert all(r.best_log_probability <= r.log_probability + 1e-9 for r in got)
    assert sorted(r.n_tokens for r in got)[:4] == [0, 0, 0, 0]


def test_url_rules(spark):
    rows = [(1, "http://WWW.Example.com/en/x?y"), (2, "https://example.com/en/"), (3, "https://a.net/es/1"), (4, "https://net/fr/"), (5, "https://x.com"), (6, None), (7, "nothing"), (8, "https://xexample.com/en/"), (9, "ftp://u.example.com:80/en/#z"), (10, "")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [got[i].rule for i in range(1, 11)] == ["www.example.com/en/", "example.com/en/", "net/es/", "net/fr/", None, None, None, "com/", None, None]
    assert got[1].verdict == "allow" and got[2].verdict == "block" and got[8].verdict == "allow"
    assert got[9].host == "u.example.com:80" and got[9].path == "/en/" and got[6].host == got[7].path == ""
    assert all(r.verdict in ("allow", "block") for r in got.values())


def test_spread_join_gives_the_join(spark, monkeypatch):
    monkeypatch.setattr(common, "_LEAST", 100)
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 400).alias("name"), F.col("id").alias("place"))
    groups = common.kept(rows.groupBy("name").agg(F.count("*").alias("c"), F.min("place").alias("first")).where("c > 5"))
    got = common.spread_join(rows, groups, "name", "c", "place")
    assert got.columns == ["name", "place", "c", "first"]
    assert sorted(got.collect()) == sorted(rows.join(groups, "name").collect())
    assert common.spread_join(rows, common.kept(groups.where("false")), "name", "c", "place").count() == 0


def test_hot_lines_and_families(spark, monkeypatch):
    rows = [(i, "a line that is found in each and every document\n" + f"only here {i} " * (i % 3)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [by_row(f(docs)) for f in (lines.remove_repeated_lines, near_duplicates.near_duplicates)]
    monkeypatch.setattr(common, "_LEAST", 1)
    assert [by_row(f(docs)) for f in (lines.remove_repeated_lines, near_duplicates.near_duplicates)] == want


def _swapped(n):
    """Two sequences of n symbols that swap a and b in Thue-Morse order: any polynomial modulo 2**64 gives both one value from n = 1024 on."""
    one = [bin(i).count("1") % 2 for i in range(n)]
    return one, [1 - x for x in one]


def test_texts_of_equal_polynomials_are_no_copies(spark):
    one, two = ([("alpha", "beta")[x] for x in s] for s in _swapped(2048))
    docs = spark.createDataFrame([(1, " ".join(f"{w}{i % 7}" for i, w in enumerate(one))), (2, " ".join(f"{w}{i % 7}" for i, w in enumerate(two)))], "doc_id long, text string")
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(docs, shingle=500).collect()}
    sets = [{tuple(w[i : i + 500]) for i in range(1549)} for w in (r.text.split() for r in docs.orderBy("doc_id").collect())]
    linked = 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])
    assert not linked and got[2].component_id == 2 and got[2].kept
    seen, want = set(), {}
    for r in docs.orderBy("doc_id").collect():
        w, gone = r.text.split(), set()
        for a in range(len(w) - 39):
            key = tuple(w[a : a + 40])
            gone |= set(range(a, a + 40)) if key in seen else set()
            seen.add(key)
        want[r.doc_id] = len(gone)
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs, 40).collect()} == want


def test_words_and_lines_of_equal_polynomials_differ(spark):
    one, two = ("".join("ab"[x] for x in s) for s in _swapped(2048))
    tail = " two three four five six seven eight"
    docs = spark.createDataFrame([(1, one + tail), (2, two + tail)], "doc_id long, text string")
    assert [r.n_removed for r in lines.remove_repeated_lines(docs).collect()] == [0, 0]
    assert [r.kept for r in near_duplicates.near_duplicates(docs, shingle=8).collect()] == [True, True]
    made = trie.pretokens(pa.array([one, two]))
    assert len(made.start) == 2 and set(made.strings()) == {b" " + one.encode(), b" " + two.encode()}


def _deleted(rows, min_lines, min_words):
    """doc_id, lines left, by windows of lines in the order of rows."""
    seen, out = set(), []
    for i, text in rows:
        every = text.split("\n")
        some = [k for k, x in enumerate(every) if x.split()]
        gone = set()
        for a in range(len(some)):
            for n in {1, min_lines}:
                at = some[a : a + n]
                if len(at) < n or (n < min_lines and len(every[at[0]].split()) < min_words):
                    continue
                key = tuple(every[k] for k in at)
                if key in seen:
                    gone |= set(at)
                seen.add(key)
        left = [x + ("\n" if k < len(every) - 1 else "") for k, x in enumerate(every) if k not in gone]
        out.append((i, "".join(left), len(some), len(gone)))
    return out


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_lines_against_brute_force(spark, min_lines):
    rng = random.Random(min_lines)
    pool = [" ".join(rng.choice("pqrst") for _ in range(rng.choice([1, 2, 9]))) for _ in range(14)]
    rows = []
    for i in range(60):
        text = [rng.choice([*pool, ""]) for _ in range(rng.randint(0, 25))]
        if rows and rng.random() < 0.4:  # a long run of an earlier document
            text += rng.choice(rows)[1].split("\n")
        rows.append((i, "\n".join(text)))
    rows.append((60, "\n".join(f"line {i % 40} of a long run" for i in range(400))))
    got = lines.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), min_lines)
    assert by_row(got.select("doc_id", "text", "n_lines", "n_removed")) == sorted(_deleted(rows, min_lines, 8), key=str)


def test_doubling_follows_the_longest_repeat(spark):
    run = "\n".join(f"line {i}" for i in range(37))
    docs = spark.createDataFrame([(False, 1, f"{run}\nx"), (False, 2, f"y\n{run}\nz")], "last boolean, doc long, text string")
    rows = lines.repeated_runs(docs).collect()
    assert [(r.doc, r.place, r.lines) for r in rows] == [(2, 1, 37)]
    equal = spark.createDataFrame([(False, 1, "same\n" * 1000), (False, 2, "other\nlines\n" * 300)], "last boolean, doc long, text string")
    assert sorted((r.doc, r.place, r.lines) for r in lines.repeated_runs(equal).collect()) == [(1, 1, 999), (2, 2, 598)]


CLASHES = ["_doc", "_id", "_text", "_place", "_lines", "_bad", "_kept", "_r", "key", "bad", "last", "doc", "runs", "c0", "node", "size", "score", "TEXT", "Doc_Id", "source", "lang"]


def test_clashing_names(spark):
    eight = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, f"{eight}\nx"), (2, eight), (3, None)], "doc_id long, text string")
    docs = docs.toDF("a", "b").select(F.col("a"), F.col("b"), *(F.lit(f"v{i}") for i in range(len(CLASHES)))).toDF("doc_id", "text", *CLASHES)
    items = spark.createDataFrame([("i", eight)], "item_id string, text string")
    plain = lambda df: sorted(tuple(r) for r in df.collect())
    left = lines.remove_repeated_lines(docs)
    assert left.columns == [*docs.columns, "n_lines", "n_removed"]
    values = tuple(f"v{i}" for i in range(len(CLASHES)))
    assert sorted((tuple(r) for r in left.collect()), key=lambda r: r[0]) == [(1, f"{eight}\nx", *values, 2, 0), (2, "", *values, 1, 1), (3, None, *values, 0, 0)]
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns and plain(clean) == [(3, None, *values)]
    for run in (mixing.mix, substrings.remove_repeats, near_duplicates.near_duplicates, licenses.scan_licenses, tokens.count_tokens):
        assert run(docs).count() == 3


def test_documents_without_ids(spark):
    rng = random.Random(5)
    texts = ["\n".join(" ".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(4)) for _ in range(12)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (7, texts[0]), (None, None), (None, None), (7, "other words under one id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.remove_repeated_lines(docs).collect()
    assert sorted(r.n_removed for r in got) == [0] * (len(rows) - 2) + [4, 4]  # both rows of the copied text without an id
    got = substrings.remove_repeats(docs).collect()
    assert sorted(r.n_removed for r in got)[-2:] == [36, 36] and sum(r.n_removed > 0 for r in got) == 2
    taken = mixing.mix(docs.withColumn("source", F.lit("s")), max_epochs=1).collect()
    assert sum(r.taken for r in taken) == sum(len(t.split()) for _, t in rows if t)


def test_mixing_of_many_sources(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), "id").alias("source"), F.lit("two words").alias("text"))
    rows = mixing.mix(docs).collect()
    assert abs(sum(r.taken for r in rows) - 10_000) <= len(rows) and all(r.taken <= 3 * r.size for r in rows)


def _licences(text):
    """The base columns by going through the words one by one."""
    w = alnum(text)
    places = [(k, label) for phrase, label in licenses.NOTICES.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def _free(tree):
    """(labels, freedom) of an expression tree."""
    if isinstance(tree, str):
        known = licenses.family(tree)
        return ({known[0], tree.lower()}, known[1]) if known else (set(), None)
    op, a, b = tree
    (x, y), (u, v) = _free(a), _free(b)
    if op == "WITH":
        return x, y
    known = [f for f in (y, v) if f is not None]
    return x | u, (min(known, default=None) if op == "AND" else max(known, default=None))


def _written(tree, rng):
    if isinstance(tree, str):
        return tree
    return f"({_written(tree[1], rng)} {rng.choice([tree[0], tree[0].lower()])} {_written(tree[2], rng)})"


def _tree(rng, depth):
    if not depth or rng.random() < 0.3:
        return rng.choice(["MIT", "GPL-2.0-only", "Apache-2.0", "BSD-3-Clause", "see", "LicenseRef-Own", "CC-BY-NC-4.0"])
    return (rng.choice(["AND", "OR", "WITH"]), _tree(rng, depth - 1), _tree(rng, depth - 1))


def test_expressions_against_their_trees():
    rng = random.Random(8)
    for _ in range(400):
        tree = _tree(rng, 4)
        want = _free(tree)
        assert licenses.evaluate(_written(tree, rng)) == (want if want[0] else None)
    for _ in range(3000):  # nothing crashes
        value = licenses.evaluate(" ".join(rng.choice(["(", ")", "AND", "or", "WITH", "MIT", "see", "()", "GPL-2.0"]) for _ in range(rng.randint(0, 9))))
        assert value is None or (value[0] and 0 <= value[1] <= 1)
    assert licenses.evaluate("MIT OR ()")[0] == licenses.evaluate("MIT WITH (")[0] == {"mit"}
    assert licenses.evaluate("see the readme") is None and licenses.family("mit-see-readme") is None and licenses.family("LicenseRef-") is None


def test_license_scan_of_long_lines(spark):
    """Megabytes on one line: many tags, one long expression, brackets, identifiers that hold the tag, many notices."""
    texts = ["SPDX-License-Identifier: MIT " * 70_000, "é SPDX-License-Identifier: " + "MIT OR " * 300_000 + "GPL-2.0", "SPDX-License-Identifier: " + "(" * 1_000_000 + "MIT" + ")" * 1_000_000, "spdx.license.identifier OR " * 80_000 + "MIT", "é mit license " * 150_000]
    began = time.time()
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert time.time() - began < 120
    assert [r.labels for r in rows] == ["mit", "gpl,gpl-2.0,mit", "mit", "", "mit"]
    assert len(rows[0].expressions) == 70_000 and set(rows[0].expressions) == {"MIT"}
    assert len(rows[1].expressions) == 1 and len(rows[1].expressions[0]) == 7 * 300_000 + 7
    assert rows[4].n_base == 150_000 and tuple(rows[4].notices[-1])[1:] == (3 * 149_999 + 1, 14 * 149_999 + 2, 14 * 149_999 + 13)


def test_license_scan_against_brute_force(spark):
    rng = random.Random(3)
    bits = ["GNU General Public License", "apache  license", "CC-BY", "cc by", "MIT\nLicense", "mit", "license", "word", "é", "gnu general", "SPDX-License-Identifier: see the readme\n", "SPDX-License-Identifier: MIT OR (\n", "SPDX-License-Identifier: BSD-3-Clause\n"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(200)] + [(200, None), (201, "MIT license " * 5000)]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _licences(text)
        free = [licenses.family(n.label)[1] for n in r.notices]
        labels = set(filter(None, r.base_labels.split(",")))
        for found in re.findall(r"(?i)spdx-license-identifier: ([^\n]*)", text or ""):
            if value := licenses.evaluate(found):
                labels |= value[0]
                free.append(value[1])
        assert r.labels == ",".join(sorted(labels)) and r.score == min(free, default=0.0)


def test_token_counts_against_brute_force(spark):
    rows = [(1, "the cat sat on the mat " * 3), (2, "我们今天在这里" * 12), (3, "x" * 70 + " " + "ab" * 700), (4, None), (5, ""), (1, "the cat sat on the mat " * 3), (None, "the mat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known, encoder = trie.vocabulary()
    counts = np.full(known.size, 0.1)
    for _, text in rows:
        for p in (q for word in words(text) for q in encoder.encode(word)):
            counts[p] += 1
    logp = np.log(counts / counts.sum())
    ids = {s: i for i in range(encoder.get_piece_size()) if not (encoder.is_byte(i) or encoder.is_control(i) or encoder.is_unknown(i)) and (s := encoder.id_to_piece(i).replace("▁", " ").encode())}
    want = []
    for i, text in rows:
        parts_ = [_plain(b" " + w.encode(), known, ids, logp) for w in words(text)]
        want.append((i, len(parts_), sum(p[2] for p in parts_), sum(p[0] for p in parts_), sum(p[1] for p in parts_)))
    got = [tuple(r) for r in tokens.count_tokens(docs).collect()]
    for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_url_model_on_held_out_labels(spark):
    rng = random.Random(1)
    good = lambda i: f"https://site{rng.randint(0, 50)}.org/{rng.choice(['news', 'blog', 'docs'])}/{rng.choice(['a', 'b'])}"
    bad = lambda i: f"http://{rng.randint(10**6, 10**8)}.info/x/y/z/{rng.randint(10**8, 10**9)}?a={i}&b={i}&c={i}&d=1"
    rows = [(i, (bad if i % 2 else good)(i), "block" if i % 2 else "allow") for i in range(400)]
    labels = spark.createDataFrame([(u, v) for _, u, v in rows[:200]], "url string, verdict string")
    pages = spark.createDataFrame(rows[200:] + [(900, None, ""), (901, rows[0][1], "")], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in urls.judge(pages, labels=labels).collect()}
    assert len(got) == 202 and sum(got[i].verdict == v for i, _, v in rows[200:]) >= 196
    assert all(0 <= r.block_probability <= 1 for r in got.values())
    one = urls.judge(pages, labels=labels.where("verdict = 'block'")).collect()  # one class
    assert {r.verdict for r in one} == {"block"}
    twice = labels.union(labels.withColumn("verdict", F.when(F.col("verdict") == "block", "allow").otherwise("block")))  # ties
    assert urls.judge(pages, labels=twice).count() == 202


def test_url_suffixes_beyond_a_broadcast(spark, monkeypatch):
    rows = [(i, f"http://h{i}.{'com' if i % 3 else f's{i % 7}'}/{'en/' * (i % 4)}{i}") for i in range(90)] + [(91, "https://a.net/es/1"), (92, "https://b.net/fr/2")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    want = by_row(urls.judge(pages))
    monkeypatch.setattr(urls, "MAX_BROADCAST", 0)
    monkeypatch.setattr(common, "_LEAST", 10)
    assert by_row(urls.judge(pages)) == want


def test_nearest_in_small_blocks_and_of_equal_vectors(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = np.round(rng.normal(size=(40, 6)), 3)
    rows = [(i, base[int(rng.integers(0, 40)) if i % 3 else 0].tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([v for _, v in rows])
    want = []
    for q in range(0, 900, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [int(i) for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        want += [(q, k + 1, i, pytest.approx(d[i], abs=1e-12)) for k, i in enumerate(order)]
    assert sorted(map(tuple, neighbours.nearest(df).collect())) == want
    monkeypatch.setattr(neighbours, "CHUNK", 3)
    monkeypatch.setattr(neighbours, "BLOCK", 1)
    monkeypatch.setattr(common, "_LEAST", 2)
    assert sorted(map(tuple, neighbours.nearest(df).collect())) == want


def test_signatures_before_empty_texts(spark):
    rows = [(1, "a b c d e f g h"), (2, None), (3, "")]
    one = near_duplicates.signatures(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 4, 24).where("doc_id = 1").first()
    alone = near_duplicates.signatures(spark.createDataFrame(rows[:1], "doc_id long, text string"), 4, 24).first()
    assert one.signature == alone.signature


@pytest.mark.parametrize("together", [5, 1000])
def test_components_of_hubs(spark, monkeypatch, together):
    from allelespark.llm import components

    monkeypatch.setattr(components, "LEAST", 3)
    monkeypatch.setattr(components, "TOGETHER", together)
    rng = random.Random(2)
    edges = [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(50, 70)] + [(rng.randint(80, 110), rng.randint(80, 110)) for _ in range(20)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(9))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert sorted(map(tuple, got.collect())) == sorted((i, find(i)) for i in root)


def test_encoded_counts_in_slices():
    tokens = trie.pretokens(pa.array([" ".join(f"wörd{i}x{i % 7}" for i in range(20_000)), None, "", "wörd1x1"]))
    weights = np.stack([np.arange(len(tokens.start)) % 3, np.ones(len(tokens.start))], 1).astype(float)
    expected = np.zeros((trie.vocabulary()[0].size, 2))
    for word, w in zip(tokens.strings(), weights, strict=True):
        for piece in trie.vocabulary()[1].encode(word.decode().lstrip(" ")):
            expected[piece] += w
    assert len(tokens.start) > 2 * trie._TOGETHER
    assert (trie.encoded_counts(tokens, weights, trie.VOCABULARY) == expected).all()


def test_tidy_tasks_pass_all_batches_on(spark):
    from allelespark.llm.words import tidy

    @tidy
    def twice(batches):
        for batch in batches:
            yield batch
            yield batch

    rows = spark.range(10).repartition(3).mapInArrow(twice, "id long")
    assert sorted(r["id"] for r in rows.collect()) == sorted([*range(10)] * 2)
    assert spark.range(0).mapInArrow(twice, "id long").count() == 0
