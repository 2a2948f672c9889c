"""Contig order, sex chromosomes and ploidy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

_PLAIN = [*map(str, range(1, 23)), "X", "Y"]
#: Contigs in the order used without a sequence dictionary.
DEFAULT_CONTIGS = [*_PLAIN, "MT", *(f"chr{c}" for c in _PLAIN), "chrM"]


def contig_order(contig: Column, contigs: Sequence[str] = DEFAULT_CONTIGS) -> Column:
    """The contig's place in the dictionary; unknown ones come after all others."""
    places = F.create_map(*(F.lit(x) for pair in ((c, i) for i, c in enumerate(contigs)) for x in pair))
    return F.coalesce(F.try_element_at(places, contig), F.lit(len(contigs)))


def genomic_sort(df: DataFrame, *by: str, contig: str = "contig", contigs: Sequence[str] = DEFAULT_CONTIGS, before: Sequence[str] = ()) -> DataFrame:
    """df ordered by contig (dictionary order, then unknown ones by name) and the given columns."""
    return df.orderBy(*before, contig_order(F.col(contig), contigs), contig, *by)


def dense_order(ordered: DataFrame, name: str = "place") -> DataFrame:
    """The rows of a sorted DataFrame with their places 1, 2, 3, ... in its order.

    Its sort deals ranges over partitions; a row's place is its number in its partition after the rows of those before,
    of which one count each is enough.
    """
    inside = (1 << 33) - 1  # the lower bits of monotonically_increasing_id() count a partition's rows
    rows = kept(ordered.withColumn("_id", F.monotonically_increasing_id()))
    rows = rows.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND(inside)}).drop("_id")
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")  # a row a partition
    return rows.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")


def _is(contig: Column, name: str) -> Column:
    return contig.isin(name, f"chr{name}")


def copies_in_sex(sex: Column, name: str) -> Column:
    """How many X or Y a sex has; Female and Male stand for XX and XY."""
    spelled = F.when(F.lower(sex) == "female", "XX").when(F.lower(sex) == "male", "XY").otherwise(sex)
    return F.regexp_count(spelled, F.lit(name))


def ploidy(contig: Column, sex: Column) -> Column:
    """2 on autosomes, 1 on the mitochondrion; on X as many as the sex has, up to 2; on Y 1 if it has any, else 0.

    A sex without X and Y (null included) counts as two X.
    """
    x, y = copies_in_sex(sex, "X"), copies_in_sex(sex, "Y")
    unknown = F.coalesce(x + y, F.lit(0)) == 0
    return (
        F.when(_is(contig, "X"), F.when(unknown | (x != 1), 2).otherwise(1))
        .when(_is(contig, "Y"), F.when(unknown | (y == 0), 0).otherwise(1))
        .when(_is(contig, "MT") | _is(contig, "M"), 1)
        .otherwise(2)
    )


def sex_ploidy_scale(value: Column, contig: Column, sex: Column, log: bool = False) -> Column:
    """Undo the diploid assumption on X and Y: times 2 / copies, or plus its log2; without copies times 0, or plus 0."""
    for name in ("X", "Y"):
        n = copies_in_sex(sex, name)
        fixed = value + F.when(n > 0, F.log2(2 / n)).otherwise(0.0) if log else value * F.when(n > 0, 2 / n).otherwise(0.0)
        value = F.when(_is(contig, name), fixed).otherwise(value)
    return value


def contig_table(spark: SparkSession, contigs: Sequence[str] = DEFAULT_CONTIGS) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(contigs)], "contig string, ord int")
