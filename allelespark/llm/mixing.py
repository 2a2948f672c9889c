"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, table

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[float] | Mapping[str, float] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """source, source_size, target for a table (source, source_size) with one row per source.

    The sources share the total of all sizes by weight.  A source stops at max_epochs times its size and what it
    leaves is shared by weight among the others, again until none is above: sources fill in the order of
    cap / weight, and one is clamped while its cap is below its share of what the clamped ones before it leave.
    A sequence of weights repeats over the sources in code point order, null last; a mapping names sources, one
    that it lacks weighs nothing.  The table has a row per source, so its windows need one task only.
    """
    every, order = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    if isinstance(weights, Mapping):
        named = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)) if weights else F.create_map().cast("map<string,double>")
        weight = F.coalesce(F.when(F.col("source").isNotNull(), F.try_element_at(named, F.col("source"))), F.lit(0))
    else:
        weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * max_epochs
    filling = Window.orderBy(F.try_divide("cap", "weight").asc_nulls_last(), F.col("source").asc_nulls_last())
    clamped = F.col("cap") * F.col("weight_left") <= F.col("weight") * (F.col("total") - F.col("cap_before"))
    share = F.try_divide(F.col("weight") * F.col("left"), F.col("left_weight"))
    return (
        sizes.withColumns({"weight": weight, "cap": cap, "total": F.sum("source_size").over(every)})
        .withColumns({"cap_before": F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
        .withColumn("clamped", clamped & (F.col("weight") > 0))
        .withColumns({"left": F.col("total") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(every), F.lit(0)), "left_weight": F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(every)})
        .select("source", "source_size", F.when(F.col("clamped"), F.col("cap").cast("double")).when(F.col("weight") > 0, share.cast("double")).otherwise(0.0).alias("target"))
    )


def mix(docs: DataFrame, weights: Sequence[float] | Mapping[str, float] = (1, 2, 3), max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Per row of docs (doc_id, source, text): doc_id, source, size, source_size, target, copies, taken, partial.

    A source repeats whole as often as its target allows; what is left goes to its documents in the order of a
    seeded hash of doc_id until it is used up, the last of them giving only its first words.  So copies is the
    number of whole repetitions of the document, partial the words of a last, cut one, and taken all words.
    The order is found in buckets of the hash: sums per bucket first, then inside each bucket, so that no task
    sorts a whole source.

    Null text has size 0 and is never taken, a null source is a source, a null doc_id hashes as the digest of
    its text; rows that repeat count each; an empty table gives no rows; other columns are ignored.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))))
    sized = pick(docs, doc_id="long", source="string", text="string").select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))
    sized = sized.withColumn("bucket", F.substring("key", 1, 3))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("long")
    plan = targets.withColumn("whole", whole).withColumn("rest", F.greatest(F.round("target").cast("long") - F.col("whole") * F.col("source_size"), F.lit(0)))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.withColumn("bucket_before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    buckets = buckets.join(plan, same(buckets, plan)).select(buckets["source"].alias("s"), F.col("bucket").alias("b"), "source_size", "target", "whole", (F.col("rest") - F.col("bucket_before")).alias("room"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(buckets, rows["source"].eqNullSafe(buckets["s"]) & (rows["bucket"] == buckets["b"]))
    more = F.greatest(F.least(F.col("room") - F.col("before"), F.col("size")), F.lit(0))
    rows = rows.withColumn("more", more)
    full = (F.col("more") == F.col("size")) & (F.col("size") > 0)
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") + full.cast("long")).alias("copies"), (F.col("whole") * F.col("size") + F.col("more")).alias("taken"), F.when(full, 0).otherwise(F.col("more")).cast("long").alias("partial"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, md5(text), '')) AS key FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap,
         (sum(source_size) OVER ())::BIGINT AS total FROM per_source),
filled AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cap_before,
         (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight_left FROM weighted),
flagged AS (SELECT *, cap * weight_left <= weight * (total - cap_before) AS clamped FROM filled),
targets AS (
  SELECT source, source_size,
         CASE WHEN clamped THEN cap::DOUBLE
              ELSE (weight * (total - coalesce(sum(CASE WHEN clamped THEN cap END) OVER (), 0)::BIGINT))::DOUBLE
                   / (sum(CASE WHEN NOT clamped THEN weight END) OVER ())::DOUBLE END AS target FROM flagged),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS whole FROM targets),
rest AS (SELECT *, greatest(floor(target + 0.5)::BIGINT - whole * source_size, 0) AS rest FROM plan),
running AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(least(rest - before, size), 0))::BIGINT AS taken FROM running
"""
