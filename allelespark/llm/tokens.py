"""Token counts of a unigram tokenizer: best segmentations by dynamic programming on a trie of pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, table
from .language import log_probabilities, piece_counts
from .trie import VOCABULARY, forward, pretokens, vocabulary
from .words import parts


def count_tokens(docs: DataFrame, path: str = VOCABULARY, smoothing: float = 0.1) -> DataFrame:
    """doc_id, n_pretokens, n_tokens, log_probability, best_log_probability for each row of docs (doc_id, text).

    Piece probabilities over the fixed vocabulary are counted over all of docs.  The distinct pre-tokens of each
    piece of text stand in a trie; n_tokens adds up the terminal counts of their best segmentations (the fewest
    pieces among equally likely ones), best_log_probability their scores, log_probability the scores summed over
    all segmentations.  A pre-token is a word of any length, scored whole.

    Null and empty texts have no tokens and score 0; rows that repeat give a row each; an empty table gives no rows;
    other columns are ignored.
    """
    docs = pick(docs, doc_id="long", text="string")
    known, _ = vocabulary(path)
    _, logp = log_probabilities(piece_counts(docs.select(F.lit("all").alias("lang"), "text"), path), known.size, smoothing)
    model = docs.sparkSession.sparkContext.broadcast(logp if logp.shape[1] else np.zeros((known.size, 1)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            tokens = pretokens(batch.column(1))
            best, number = forward(tokens, vocabulary(path)[0], model.value, best=True)
            every, _ = forward(tokens, vocabulary(path)[0], model.value)
            added = lambda x, tokens=tokens: np.diff(np.concatenate([np.zeros(1, x.dtype), np.cumsum(x[tokens.index])])[tokens.first])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(tokens.first), pa.int64()), pa.array(added(number), pa.int64()), pa.array(added(every[:, 0])), pa.array(added(best[:, 0]))], names=["doc_id", "n_pretokens", "n_tokens", "log_probability", "best_log_probability"])

    return docs.mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long, log_probability double, best_log_probability double")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
