"""Language ID by unigram piece models over a fixed vocabulary, marginalised over all segmentations of a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, set_aside, table
from .trie import VOCABULARY, PreTokens, encoded_counts, forward, pretokens, vocabulary
from .words import buffer, parts, tidy

UNKNOWN = "und"
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


def piece_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(lang, piece, count): the pieces of the tokenizer's encoding of docs (lang, text); texts without lang are left out."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            langs = batch.column(0).dictionary_encode()
            tokens = pretokens(batch.column(1))
            names, of = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            place = np.repeat(of, np.diff(tokens.first)) * len(tokens.start) + tokens.index
            weights = np.bincount(place, minlength=len(names) * len(tokens.start)).reshape(len(names), -1).T
            found = encoded_counts(tokens, weights, path)
            piece, m = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in m], pa.string()), pa.array(piece, pa.int32()), pa.array(found[piece, m].astype(np.int64))], names=["lang", "piece", "count"])

    return docs.where("lang IS NOT NULL").select("lang", "text").mapInArrow(count, "lang string, piece int, count long").groupBy("lang", "piece").agg(F.sum("count").alias("count"))


def log_probabilities(counts: DataFrame, size: int, smoothing: float = 0.1) -> tuple[list[str], np.ndarray]:
    """(langs, (pieces, langs)) from piece_counts(): at most one number a piece and language goes to the driver."""
    rows = counts.toPandas()
    langs = sorted(rows["lang"].unique())
    made = np.full((size, len(langs)), smoothing)
    np.add.at(made, (rows["piece"].to_numpy(np.int64), np.searchsorted(langs, rows["lang"]) if len(rows) else np.zeros(0, np.int64)), rows["count"].to_numpy(np.float64))
    return langs, np.log(made / made.sum(0)) if langs else made


def usual(logp: np.ndarray, path: str = VOCABULARY) -> np.ndarray:
    """For each language the mean log-probability of a byte of text that its model writes."""
    _, encoder = vocabulary(path)
    of_bytes = [1 if encoder.is_byte(i) or encoder.is_unknown(i) else len(encoder.id_to_piece(i).replace("\u2581", " ").encode()) for i in range(len(logp))]
    p = np.exp(logp)
    return (p * logp).sum(0) / (np.array(of_bytes) @ p)


def with_digits(tokens: PreTokens) -> np.ndarray:
    """Whether each distinct pre-token has an ASCII digit."""
    digits = np.concatenate([[0], np.cumsum((tokens.data >= 48) & (tokens.data <= 57))])
    return digits[tokens.start + tokens.length] > digits[tokens.start]


def identify(docs: DataFrame, training: Column, path: str = VOCABULARY, smoothing: float = 0.1) -> DataFrame:
    """All columns of docs (doc_id, text, lang, ...) and lang_pred, score, fit for each row.

    The models learn from text and lang of the rows where `training` holds and lang is not null; a prediction sees
    the text only.  A word's probability in a language is the sum over all its segmentations into pieces; a text's
    is the product over its words.  lang_pred is the likeliest language and score its share among the languages.  fit is how much likelier a byte of
    the text's words without digits is in that language than a byte that its model writes (a mean of log-probabilities
    less usual()): near 0 for texts like those learned from, well below for other languages and for junk, whatever the
    score; null if all words have digits.

    A text that is null or has no letter gives "und", score 0 and a null fit, and so does every text if there is nothing
    to learn from.  Ties go to the smaller name; rows that repeat give a row each; an empty table gives no rows; words
    of any length are scored whole.  Columns named lang_pred, score or fit are replaced.
    """
    known, _ = vocabulary(path)
    docs, back = set_aside(docs, "doc_id", "text", "lang", "lang_pred", "score", "fit")
    learn = pick(docs.where(training), lang="string", text="string")
    langs, logp = log_probabilities(piece_counts(learn, path), known.size, smoothing)
    docs = docs.drop("lang_pred", "score", "fit")
    model = docs.sparkSession.sparkContext.broadcast((langs, logp, usual(logp, path) if langs else None))
    column = docs.columns.index("text")

    @tidy
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp, mean = model.value
        for batch in parts(batches):
            texts = batch.column(column)
            n = batch.num_rows
            letters = np.concatenate([[0], np.cumsum(_LETTER[buffer(texts)[0]])])
            offsets = buffer(texts)[1]
            some = letters[offsets[1:]] > letters[offsets[:-1]]
            for i in np.flatnonzero(~some & (np.diff(offsets) > 0)).tolist():
                some[i] = any(map(str.isalpha, texts[i].as_py()))
            names, score, fit = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan)
            if langs:
                tokens = pretokens(texts)
                value = np.zeros((len(tokens.index) + 1, len(langs)))
                scores = forward(tokens, vocabulary(path)[0], logp)[0]
                np.cumsum(scores[tokens.index], axis=0, out=value[1:])
                total = value[tokens.first[1:]] - value[tokens.first[:-1]]
                share = np.exp(total - total.max(1, keepdims=True))
                share /= share.sum(1, keepdims=True)
                pick_ = share.argmax(1)
                names[some] = np.array(langs, object)[pick_[some]]
                score[some] = share[np.arange(n), pick_][some]
                plain = ~with_digits(tokens)
                np.cumsum((scores * plain[:, None])[tokens.index], axis=0, out=value[1:])
                size = np.concatenate([[0], np.cumsum((tokens.length * plain)[tokens.index])])
                likely, size = ((x[tokens.first[1:]] - x[tokens.first[:-1]]) for x in (value, size))
                some &= size > 0
                fit[some] = likely[np.arange(n), pick_][some] / size[some] - mean[pick_[some]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(fit, from_pandas=True)], names=[*batch.schema.names, "lang_pred", "score", "fit"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return back(docs.mapInArrow(predict, f"{schema}, lang_pred string, score double, fit double"))


def held_out() -> Column:
    """Whether crc32(doc_id as text) mod 3 is 1; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="long", text="string", lang="string")
    return identify(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
