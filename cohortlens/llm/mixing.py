"""Mixing sources to target weights by exact word budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cohortlens.session import materialise

from .common import WORD, ordered_sums

#: Rows of a source that one task orders; a source is cut into as many key ranges as it needs.
RANGE_ROWS = 4096
_KEY_SPAN = 1 << 31


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``_source, _total, _target`` for a table of ``_source, _docs, _total``.

    Sources take the weights in turn by code point, null last. A target above ``most`` times its
    source stops there and the excess is shared anew by weight, until none is above.
    """
    ranked = ordered_sums(sources, [F.col("_source").isNull(), F.col("_source")], F.lit(0), "_rank", "_zero")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("_weight", F.element_at(cycle, (F.col("_rank") % len(weights)).cast("int") + 1))
    table = materialise(ranked.withColumn("_limit", F.col("_total") * most).drop("_zero"), "sources")
    whole = table.agg(F.coalesce(F.sum("_total"), F.lit(0)).alias("s")).first().s
    level, full = 0.0, -1
    while True:  # each round freezes at least one more source or ends
        stopped = F.col("_limit") <= F.col("_weight") * F.lit(level)
        row = table.agg(
            F.count_if(stopped).alias("full"),
            F.coalesce(F.sum(F.when(stopped, F.col("_limit"))), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~stopped, F.col("_weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row.full == full or not row.weight:
            break
        full, left, shares = row.full, whole - row.used, row.weight
        level = left / shares
    target = F.when(F.col("_limit") <= F.col("_weight") * F.lit(level), F.col("_limit").cast("double")).otherwise(
        F.col("_weight") * F.lit(level)
    )
    return table.select("_source", "_docs", "_total", target.alias("_target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    most: int = 3,
    seed: int = 7,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` with ``size, source_size, target, taken`` (of ``keep`` columns, or all).

    Each row gets a hash-random key from its id and text. Within a source, rows are sorted by
    key, word counts are summed along that order, and the order is walked in epochs until the
    source's budget (its target, rounded down) is used: whole epochs give every row its size
    again, and the last one is cut at the exact word.

    The order is never one task: keys are cut into ranges of about ``RANGE_ROWS`` rows, the
    ranges' sums are added up first, and a window runs inside a range only. A row of no words,
    or null text, takes nothing; null is a source of its own; repeated rows are rows like any
    other, and which of several identical ones is cut makes no difference.
    """
    columns = list(docs.columns if keep is None else keep)
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id), F.col(text)), 33)
    rows = docs.select(
        F.struct(*[F.col(c) for c in columns]).alias("_row"),
        F.col(source).alias("_source"),
        key.alias("_key"),
        F.col(id).alias("_id"),
        n_words(text).alias("size"),
    )
    if keep is not None:
        rows = materialise(rows, "sizes")
    totals = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_docs"), F.sum("size").alias("_total"))
    plan = materialise(source_targets(totals, weights, most), "targets")
    ranges = F.greatest(F.lit(1), F.ceil(F.col("_docs") / RANGE_ROWS)).cast("long")
    same = F.col("_source").eqNullSafe(F.col("_of"))
    joined = rows.join(plan.withColumnRenamed("_source", "_of"), same).withColumn(
        "_range", F.floor(F.col("_key") * ranges / F.lit(_KEY_SPAN))
    )
    sums = joined.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    before = W.Window.partitionBy("_source").orderBy("_range").rowsBetween(W.Window.unboundedPreceding, -1)
    heads = sums.select(
        F.col("_source").alias("_of2"), F.col("_range").alias("_r2"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_head")
    )
    inside = (
        W.Window.partitionBy("_source", "_range").orderBy("_key", "_id", "size").rowsBetween(W.Window.unboundedPreceding, -1)
    )
    budget = F.floor("_target")
    epochs = F.when(F.col("_total") > 0, F.expr("cast(floor(_target) as long) div _total")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("_total")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    return (
        joined.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(heads, F.col("_source").eqNullSafe(F.col("_of2")) & (F.col("_range") == F.col("_r2")))
        .withColumn("_start", F.col("_head") + F.col("_before"))
        .select(
            *[F.col("_row").getField(c).alias(c) for c in columns if c not in ("size", "source_size", "target", "taken")],
            "size",
            F.col("_total").cast("long").alias("source_size"),
            F.col("_target").alias("target"),
            (epochs * F.col("size") + part).cast("long").alias("taken"),
        )
    )


def repeat_taken(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a mix as often as it takes them; a row cut short counts if at least half is taken."""
    times = F.when(F.col("size") > 0, F.expr("cast((2 * taken + size) div (2 * size) as int)")).otherwise(F.lit(0))
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")
