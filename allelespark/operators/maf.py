"""Mutation annotation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Variant_Type by class.
SNV_TYPES = ("SNP", "DNP", "TNP", "MNP", "ONP")
INDEL_TYPES = ("INS", "DEL")


def narrow_columns(df: DataFrame, max_chars: int = 1000, always: Sequence[str] = ()) -> DataFrame:
    """df without columns that hold a text of max_chars or more; one pass finds the longest of each."""
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string" and f.name not in always]
    longest = df.agg(*(F.coalesce(F.max(F.length(F.col(f"`{c}`"))), F.lit(0)).alias(str(i)) for i, c in enumerate(texts))).first() if texts else ()
    return df.drop(*(c for c, n in zip(texts, longest, strict=True) if n >= max_chars))


def split_classes(df: DataFrame, kind: str = "variant_type") -> tuple[DataFrame, DataFrame]:
    """(SNVs, indels)."""
    return df.where(F.col(kind).isin(*SNV_TYPES)), df.where(F.col(kind).isin(*INDEL_TYPES))


def with_class(df: DataFrame, kind: str = "variant_type") -> DataFrame:
    """df with maf_class, snv or indel, to write both by one partitioned write; other kinds go."""
    of = F.when(F.col(kind).isin(*SNV_TYPES), "snv").when(F.col(kind).isin(*INDEL_TYPES), "indel")
    return df.withColumn("maf_class", of).where("maf_class IS NOT NULL")


def with_annotations(df: DataFrame, defaults: Mapping[str, str], overrides: Mapping[str, str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Defaults fill missing columns and nulls, overrides replace, excluded columns go."""
    have = set(df.columns)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v) for c, v in defaults.items()}) if defaults else df
    df = df.withColumns({c: F.lit(v) for c, v in overrides.items()}) if overrides else df
    return df.drop(*exclude)


def merge(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
