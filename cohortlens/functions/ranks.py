"""Exact ranks and quantiles of unbounded groups without a one-task group.

``percentile`` keeps every distinct value of a group in one buffer and a window keeps
a whole group in one task.  Here equal values are first folded by a partial aggregate,
each group is cut into buckets at split points, and only buckets are sorted.  The split
points are taken from values picked by their hash: ranks and bucket offsets are read from
two branches of the plan, and both must cut at the same places however tasks are run.
They decide the balance of the work, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise

COARSE = 7
SPLITS = COARSE * COARSE
# groups with fewer distinct values are sorted in one piece
SMALL_GROUP = 50_000
# split points of a larger group come from about this many of its values
SAMPLED = 2_000


def _bucket(value: str) -> Column:
    """Number of split points below a value, by a coarse and then a fine count."""
    below = lambda part: F.size(F.filter(part, lambda s: s < F.col(value)))
    coarse = below(F.transform(F.sequence(F.lit(1), F.lit(COARSE - 1)), lambda i: F.get("_splits", i * COARSE - 1)))
    fine = below(F.slice("_splits", coarse * COARSE + 1, COARSE))
    return F.when(F.col("_splits").isNotNull(), coarse * COARSE + fine).otherwise(F.lit(0))


def split_points(folded: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``_splits`` of each group with more than ``SMALL_GROUP`` rows; the same for the same rows in any order."""
    by = list(by)
    large = folded.groupBy(*by).agg(F.count(F.lit(1)).alias("_values")).filter(F.col("_values") > SMALL_GROUP)
    picked = _join(folded, large, by).filter(F.pmod(F.xxhash64(value), F.col("_values")) < SAMPLED)
    values = picked.groupBy(*by, "_values").agg(F.sort_array(F.collect_list(value)).alias("_picked"))
    at = F.transform(F.sequence(F.lit(1), F.lit(SPLITS - 1)), lambda i: F.get("_picked", F.floor(i * F.size("_picked") / SPLITS).cast("int")))
    return values.select(*by, at.alias("_splits"))


def value_ranks(
    df: DataFrame, by: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """One row per group and distinct value: ``n`` rows equal, ``below`` rows smaller, ``total``.

    With ``weight`` the counts are sums of that column.
    """
    by = list(by)
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    folded = (
        df.filter(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*by, value)
        .agg(size.alias("n"))
    )
    keyed = attach(folded, split_points(folded, by, value), by).withColumn("_bucket", _bucket(value)).drop("_splits")
    buckets = keyed.groupBy(*by, "_bucket").agg(F.sum("n").alias("_in_bucket"))
    before = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    offsets = buckets.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_offset"),
        F.sum("_in_bucket").over(whole).alias("total"),
    )
    inside = (
        W.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        keyed.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, [*by, "_bucket"])
        .select(
            *by, value, "n", (F.col("_inside") + F.col("_offset")).alias("below"), "total"
        )
    )


def _join(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Equi-join on ``by``; without keys ``right`` is a single aggregated row, and is broadcast."""
    if by:
        return left.join(right, by)
    return left.withColumn("_one", F.lit(1)).join(
        F.broadcast(right.withColumn("_one", F.lit(1))), "_one"
    ).drop("_one")


def average_rank() -> Column:
    """1-based rank with ties averaged, from the columns of :func:`value_ranks`."""
    return F.col("below") + (F.col("n") + 1) / 2.0


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, plus the group size ``n_values``."""
    by = list(by)
    ranked = value_ranks(df, by, value)
    aggs: list[Column] = [F.max("total").alias("n_values")]
    for name, p in probs.items():
        position = F.lit(p) * (F.col("total") - 1)
        low, high = F.floor(position), F.ceil(position)
        for side, at in (("lo", low), ("hi", high)):
            here = (F.col("below") <= at) & (at < F.col("below") + F.col("n"))
            aggs.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{side}"))
    wide = ranked.groupBy(*by).agg(*aggs)
    out = [F.col(c) for c in by] + [F.col("n_values").cast("long").alias("n_values")]
    for name, p in probs.items():
        position = F.lit(p) * (F.col("n_values") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return wide.select(*out)


def grouped_median(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    return grouped_quantiles(df, by, value, {name: 0.5}).drop("n_values")


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left-join group statistics back to rows; a keyless statistic is one row, and is broadcast."""
    by = list(by)
    if by:
        return df.join(stats, by, "left")
    return df.withColumn("_one", F.lit(1)).join(
        F.broadcast(stats.withColumn("_one", F.lit(1))), "_one", "left"
    ).drop("_one")


def positions(
    df: DataFrame, by: Sequence[str], value: str, key: str, name: str = "position", descending: bool = False
) -> DataFrame:
    """Exact 0-based position of every row by ``value``, ties by hashed ``key`` then ``key``.

    Distinct values are ranked in buckets; a tied value, however large, is ranked the
    same way over the hash of its keys.
    """
    by = list(by)
    signed = materialise(df.filter(F.col(value).isNotNull()), "ordered").withColumn(
        "_v", (-F.col(value) if descending else F.col(value)).cast("double")
    ).withColumn("_h", F.xxhash64(key))
    outer = value_ranks(signed, by, "_v").select(
        *by, "_v", F.col("below").alias("_below"), F.col("n").alias("_n"), F.col("total").alias(f"{name}_total")
    )
    ranked = signed.join(outer, [*by, "_v"])
    inner = value_ranks(ranked.filter(F.col("_n") > 1).withColumn("_hd", F.col("_h").cast("double")), [*by, "_v"], "_hd").select(
        *by, "_v", "_hd", F.col("below").alias("_inner")
    )
    tied = ranked.withColumn("_hd", F.col("_h").cast("double")).join(inner, [*by, "_v", "_hd"], "left")
    same = W.partitionBy(*by, "_v", "_hd").orderBy("_h", key)
    return tied.withColumn(
        name, F.col("_below") + F.coalesce("_inner", F.lit(0)) + F.row_number().over(same) - 1
    ).drop("_v", "_h", "_hd", "_below", "_n", "_inner")

