"""A training corpus from raw documents, in five stages; each takes and gives documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespark.llm.common import positional, table
from allelespark.llm.decontaminate import decontaminate
from allelespark.llm.language import UNKNOWN, held_out, identify
from allelespark.llm.lines import remove_repeated_lines
from allelespark.llm.mixing import mix
from allelespark.llm.near_duplicates import near_duplicates

#: A byte of a text's words may be less likely than a byte of its language's texts by this (natural logarithm).
LEAST_FIT = -3.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, of no language that is likelier than all others together, or unlike any language, go.

    Unlike any language are texts whose fit (see identify()) is below LEAST_FIT: a byte of their words is that much
    less likely in their likeliest language than a byte that its model writes.  Words with digits do not count, so
    numbers, keys and addresses in a short text do not make it junk.

    Null and empty texts have no letters and go; long texts are judged whole; a document without lang is judged but not
    learned from; rows that repeat share their verdict; if no row has a lang, all go; an empty table gives no rows.
    Other columns, whatever their names, are handed on.
    """
    judged = identify(docs, ~held_out())
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0.5) & (F.coalesce("fit", F.lit(0.0)) >= LEAST_FIT)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines go; a document of which nothing is left goes too.

    Null and empty texts have no lines and stay; of ties the smallest doc_id's line stays, a null doc_id comes last;
    rows that repeat share their result; an empty table gives no rows.  n_chars, if there, is the new length; other
    columns, whatever their names, are handed on.
    """
    left, names = positional(remove_repeated_lines(docs))
    total, removed = (F.col(f"c{names.index(c)}") for c in ("n_lines", "n_removed"))
    left = left.where((total == 0) | (removed < total))
    columns = [F.col(f"c{names.index(c)}") for c in docs.columns]
    if "n_chars" in docs.columns:
        columns[docs.columns.index("n_chars")] = F.length(f"c{names.index('text')}").cast(docs.schema["n_chars"].dataType).alias("n")
    return left.select(*columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id; rows that repeat, once.

    A null doc_id counts as a number of 2**62 or more that its text decides, so it comes last; null and empty texts are
    nobody's copies and stay; several texts under one doc_id stay together if one of them does; an empty table gives
    no rows.  Of rows with equal doc_id and text any one stays; other columns, whatever their names, are handed on.
    """
    plain, names = positional(docs)
    id_, text = (f"c{names.index(c)}" for c in ("doc_id", "text"))
    key = F.coalesce(F.col(id_).cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2))
    rows = plain.withColumn("key", key)
    judged = near_duplicates(rows.select(F.col("key").alias("doc_id"), F.col(text).alias("text"))).where("kept")
    judged = judged.select(F.col("doc_id").alias("stays")).distinct()
    left = rows.join(judged, F.col("key") == F.col("stays"), "left_semi").dropDuplicates(["key", text])
    return left.select(*plain.columns).toDF(*names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words stands in the benchmark go.

    Null and empty texts stay; items without words or without item_id follow contamination(); rows that repeat stay or
    go together; an empty table, or an empty benchmark, changes nothing; all columns are handed on.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: the plan of repetitions, not the repeated texts.

    A row per row of docs; see mix() for nulls, ties, repeated rows, empty tables and other columns.
    """
    return mix(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing)]
ORACLE_SQL = None  # the language models' scores have no SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents, one after the other; each stage's docstring says what nulls and such do."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
