"""Fields of variant tables as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filter_tags(filter_: Column) -> Column:
    return F.split(filter_, ";")


def info_map(info: Column) -> Column:
    return F.str_to_map(info, F.lit(";"), F.lit("="))


def info_number(info: Column, key: str, index: int | None = None) -> Column:
    """A number of INFO, or the index-th of a list; null if missing or no number."""
    return number_of(info_map(info), key, index)


def number_of(fields: Column, key: str, index: int | None = None) -> Column:
    """info_number() of info_map()'s result."""
    text = F.try_element_at(fields, F.lit(key))
    if index is not None:
        text = F.try_element_at(F.split(text, ","), F.lit(index + 1))
    return text.try_cast("double")


def depths(ad: Column) -> Column:
    """AD as numbers: reference first, then each alternate."""
    return F.transform(F.split(ad, ","), lambda x: x.try_cast("long"))


def total_alt_count(ads: Column) -> Column:
    """Alternate reads added up over alleles and samples; ads is an array of AD arrays."""
    return F.aggregate(F.flatten(F.transform(ads, lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))))), F.lit(0).cast("long"), lambda t, x: t + F.coalesce(x, F.lit(0).cast("long")))


def popaf_to_af(popaf: Column, default: float = 7e-8) -> Column:
    """10 ** -POPAF; the default where it is missing or no number."""
    return F.coalesce(F.pow(F.lit(10.0), -popaf), F.lit(default))


def common_prefix(a: Column, b: Column) -> Column:
    """The number of equal leading characters, but one less than the shorter has: an allele keeps one base."""
    most = F.least(F.length(a), F.length(b)) - 1
    equal = lambda i: F.substring(a, 1, i) == F.substring(b, 1, i)
    return F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), most), equal)), F.lit(0))


def sample_name(line: Column) -> Column:
    """The sample named by a header line: #<METADATA>SAMPLE=x, or @RG with SM:x."""
    return F.coalesce(F.nullif(F.regexp_extract(line, r"^#<METADATA>SAMPLE=(.*)$", 1), F.lit("")), F.nullif(F.regexp_extract(line, r"^@RG.*\tSM:([^\t]*)", 1), F.lit("")))
