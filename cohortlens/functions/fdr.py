"""Benjamini-Hochberg adjustment and log factorials."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .ranks import value_ranks
from .tails import hypergeometric_upper


def bh_fdr(
    df: DataFrame, p: str = "p", by: Sequence[str] = (), out: str = "fdr", weight: str | None = None
) -> DataFrame:
    """BH within ``by``; null and NaN p-values stay null and do not count as tests.

    Ties share the largest rank, so the adjusted value of a p is the minimum over
    larger p of p·m/rank.  Ranks come from the bucketed ranking; the reverse running
    minimum is likewise taken inside buckets of p and combined over the bucket minima,
    so neither step sorts a whole family in one task.  With ``weight`` a test counts by
    its weight instead of one.
    """
    by = list(by)
    clean = df.withColumn("_p", F.when(~F.isnan(p), F.col(p)))
    ranked = value_ranks(clean, by, "_p", weight).withColumn(
        "_raw", F.col("_p") * F.col("total") / (F.col("below") + F.col("n"))
    )
    # p is a probability: linear bins above 0.001 and logarithmic bins below it are an
    # order-preserving bucket of fixed number; minima run down from the largest p, since a
    # frame that only grows is linear in its rows
    fine = F.floor(F.col("_p") * 1000)
    coarse = F.when(F.col("_p") > 0, F.greatest(F.lit(-400), F.floor(8 * F.log("_p")))).otherwise(F.lit(-401))
    binned = ranked.withColumn("_bin", F.when(F.col("_p") >= 0.001, fine).otherwise(coarse).cast("int"))
    larger = W.partitionBy(*by).orderBy(F.col("_bin").desc()).rowsBetween(W.unboundedPreceding, -1)
    bins = binned.groupBy(*by, "_bin").agg(F.min("_raw").alias("_m")).select(
        *by, "_bin", F.min("_m").over(larger).alias("_tail")
    )
    inside = W.partitionBy(*by, "_bin").orderBy(F.col("_p").desc()).rowsBetween(W.unboundedPreceding, 0)
    adjusted = (
        binned.withColumn("_in", F.min("_raw").over(inside))
        .join(bins, [*by, "_bin"])
        .select(*by, "_p", F.least(F.lit(1.0), F.col("_in"), F.col("_tail")).alias(out))
    )
    null_safe = clean.drop(out)
    joined = null_safe.join(adjusted, [*by, "_p"], "left")
    return joined.select(*[c for c in df.columns if c != out], out)


def ln_factorial(n: Column) -> Column:
    """ln n! for a whole-number column: an exact table below 32, Stirling's series above."""
    table = F.array(*[F.lit(math.lgamma(i + 1.0)) for i in range(32)])
    x = n.cast("double") + 1.0
    series = (
        (x - 0.5) * F.log(x)
        - x
        + F.lit(0.5 * math.log(2 * math.pi))
        + 1 / (12 * x)
        - 1 / (360 * x * x * x)
        + 1 / (1260 * x * x * x * x * x)
        - 1 / (1680 * F.pow(x, F.lit(7.0)))
    )
    return F.when(n < 32, F.element_at(table, F.greatest(n, F.lit(0)).cast("int") + 1)).otherwise(series)


def ln_choose(n: Column, k: Column) -> Column:
    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)


def hypergeometric_sf(shared: Column, universe: Column, a: Column, b: Column) -> Column:
    """P(X >= shared) for ``b`` draws from ``universe`` holding ``a`` marked members."""
    return hypergeometric_upper(*[c.cast("long") for c in (shared, universe, a, b)])


def binomial_upper_half(k: Column, n: Column) -> Column:
    """P(X >= k) for Binomial(n, 1/2)."""
    terms = F.transform(
        F.sequence(k.cast("long"), F.greatest(n, k).cast("long")),
        lambda i: F.when(i <= n, F.exp(ln_choose(n, i) - n * F.lit(math.log(2.0)))).otherwise(0.0),
    )
    return F.least(F.lit(1.0), F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))


def bh_small(df: DataFrame, p: str = "p", by: Sequence[str] = (), out: str = "fdr") -> DataFrame:
    """BH by windows, for families bounded by the study design (cell types, programs, strata)."""
    part = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    clean = F.when(~F.isnan(p), F.col(p))
    up = part.orderBy(F.col("_p").asc_nulls_last()).rangeBetween(W.unboundedPreceding, 0)
    down = part.orderBy(F.col("_p").desc_nulls_first()).rangeBetween(W.unboundedPreceding, 0)
    return (
        df.withColumn("_p", clean)
        .withColumn("_raw", F.col("_p") * F.count("_p").over(part) / F.count("_p").over(up))
        .withColumn(
            out, F.when(F.col("_p").isNotNull(), F.least(F.lit(1.0), F.min("_raw").over(down)))
        )
        .drop("_p", "_raw")
    )
