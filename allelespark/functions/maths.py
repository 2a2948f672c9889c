"""Mathematical functions that Spark lacks, as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def minus_infinity() -> Column:
    return F.lit(float("-inf"))


def ln(x: Column) -> Column:
    """Natural logarithm with ln(0) = -infinity, where Spark's is null."""
    return F.when(x == 0, minus_infinity()).otherwise(F.log(x))


def lgamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: eight steps up by recurrence, then Stirling's series."""
    y = x + 8
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    i = 1 / y
    i2 = i * i
    series = i * (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 * (1 / 1188)))))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def lgammas(xs: Column) -> Column:
    """lgamma() of each number of an array, by the same formula: null at 0 and below.

    For expressions with many log-gammas: written out as columns they make one generated method, too long for the JVM to
    compile, so that it is interpreted.
    """

    @F.arrow_udf("array<double>")
    def of(arrays: pa.Array) -> pa.Array:
        given = arrays.flatten()
        x = given.to_numpy(zero_copy_only=False).astype(np.float64)
        y = x + 8
        steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
        none = (x <= 0) | given.is_null().to_numpy(zero_copy_only=False)
        i = 1 / np.where(none, 8.0, y)
        i2 = i * i
        series = i * (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 * (1 / 1680 - i2 * (1 / 1188)))))
        out = (y - 0.5) * np.log(np.where(none, 8.0, y)) - y + 0.5 * math.log(2 * math.pi) + series - np.log(np.where(none, 1.0, steps))
        ends = np.concatenate(([0], np.cumsum(arrays.value_lengths().fill_null(0).to_numpy()))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out, pa.float64(), mask=none))

    return of(xs)


def lbeta(a: Column, b: Column) -> Column:
    return lgamma(a) + lgamma(b) - lgamma(a + b)


def lchoose(n: Column, k: Column) -> Column:
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def binomial_logpmf(k: Column, n: Column, p: Column) -> Column:
    """ln P(k of n) for probability p; 0 * ln(0) counts as 0."""
    power = lambda count, log: F.when(count == 0, 0.0).otherwise(count * log)
    return lchoose(n, k) + power(k, ln(p)) + power(n - k, ln(1 - p))


def beta_binomial_logpmf(k: Column, n: Column, a: Column, b: Column) -> Column:
    return lchoose(n, k) + lbeta(k + a, n - k + b) - lbeta(a, b)


def logaddexp(a: Column, b: Column) -> Column:
    top = F.greatest(a, b)
    return F.when(top == float("-inf"), top).otherwise(top + F.log1p(F.exp(-F.abs(a - b))))


def logsumexp(columns: Sequence[Column], top: Column | None = None) -> Column:
    """top: a column that holds their greatest, if there is one."""
    top = F.greatest(*columns) if top is None else top
    total = sum((F.exp(c - top) for c in columns[1:]), F.exp(columns[0] - top))
    return F.when(top == float("-inf"), top).otherwise(top + F.log(total))


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        x = F.greatest(x, F.lit(low))
    return F.least(x, F.lit(high)) if high is not None else x


def scaled(x: Column, by: int = 1_000_000) -> Column:
    """A double as a whole number of 1 / by, for results that engines must agree on to the last digit."""
    return F.floor(x * by + 0.5).cast("long")


def kendall_tau_b(df: DataFrame, cells: Sequence[Sequence[str]]) -> DataFrame:
    """df with tau (Kendall's tau-b) and z for a 3 x 3 table of counts of two rankings, given by column names.

    Concordant and discordant pairs are sums over pairs of cells; z divides their difference by its standard
    deviation under independence, corrected for ties.  tau is null if either ranking ties all.
    """
    k = range(3)
    add = lambda xs: sum(xs[1:], xs[0])
    cell = [[F.col(c).cast("double") for c in row] for row in cells]
    agree = add([cell[i][j] * cell[p][q] for i in k for j in k for p in k for q in k if p > i and q > j])
    differ = add([cell[i][j] * cell[p][q] for i in k for j in k for p in k for q in k if p > i and q < j])
    sums = {f"_r{i}": add(cell[i]) for i in k} | {f"_c{j}": add([cell[i][j] for i in k]) for j in k} | {"_s": agree - differ}
    df = df.withColumns(sums).withColumn("_n", F.col("_r0") + F.col("_r1") + F.col("_r2"))
    n = F.col("_n")
    over = lambda side, f: add([f(F.col(f"_{side}{i}")) for i in k])
    moments = {}
    for side in ("r", "c"):
        moments |= {f"_{side}t": over(side, lambda t: t * (t - 1)), f"_{side}u": over(side, lambda t: t * (t - 1) * (t - 2)), f"_{side}v": over(side, lambda t: t * (t - 1) * (2 * t + 5))}
    df = df.withColumns(moments)
    m = lambda x: F.col(f"_{x}")
    pairs = n * (n - 1)
    df = df.withColumns({
        "_under": (pairs - m("rt")) * (pairs - m("ct")) / 4,
        "_var": (pairs * (2 * n + 5) - m("rv") - m("cv")) / 18 + F.when(n > 1, m("rt") * m("ct") / (2 * pairs)).otherwise(0.0) + F.when(n > 2, m("ru") * m("cu") / (9 * pairs * (n - 2))).otherwise(0.0),
    })
    out = df.withColumns({"tau": F.when(F.col("_under") > 0, F.col("_s") / F.sqrt("_under")), "z": F.when((F.col("_under") > 0) & (F.col("_var") > 0), F.col("_s") / F.sqrt("_var"))})
    return out.drop("_s", "_n", "_under", "_var", *sums, *moments)


def phred_ln(p: Sequence[Column], log10: bool = False) -> list[Column]:
    """Whole -10 * ln(p) (or log10) cut to 0 ... 99, less the row's smallest."""
    log = F.log10 if log10 else F.log
    each = [F.when(x <= 0, F.lit(99)).otherwise(clip(-10 * log(x), 0, 99).cast("int")) for x in p]
    return [x - F.least(*each) for x in each]


def with_settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that later filters see as values.

    Catalyst moves a filter below a projection by putting the projection's expressions into it, which for long ones
    multiplies the work and the generated code.  It does not do so with what a generator gives.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))))
