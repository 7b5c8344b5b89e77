"""Small vocabularies and label canonicalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVELS = 10_000
# Spellings that mean a missing label.
MISSING_LABELS = ("nan", "None", "NA", "<NA>", "")


def bounded_levels(df: DataFrame, col: str, limit: int = MAX_LEVELS) -> list[str]:
    """Sorted distinct non-null values of a design column; refuses an unbounded column."""
    rows = (
        df.select(F.col(col).cast("string").alias("v"))
        .filter(F.col("v").isNotNull())
        .distinct()
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} levels; it is not a design column")
    return sorted(r.v for r in rows)


def with_levels(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    """Every row of ``df`` once per level: the zero-filled grid of a bounded vocabulary."""
    return df.withColumn(col, F.explode(F.array(*[F.lit(v) for v in levels])))


def level_grid(df: DataFrame, row: str, col: str) -> DataFrame:
    """All observed rows × all observed columns, from the bounded column vocabulary."""
    rows = df.select(row).filter(F.col(row).isNotNull()).distinct()
    return with_levels(rows, col, bounded_levels(df, col))


def canonical_label(col: Column, dtype: str = "string") -> Column:
    """Labels as text; whole floats lose their fraction, missing spellings become null."""
    if dtype in ("double", "float"):
        text = F.when(
            (col == F.floor(col)) & (F.abs(col) < 1e15), col.cast("long").cast("string")
        ).otherwise(col.cast("string"))
        return F.when(F.isnan(col), F.lit(None)).otherwise(text)
    text = col.cast("string")
    return F.when(F.trim(text).isin(*MISSING_LABELS), F.lit(None)).otherwise(text)


def canonicalise(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, canonical_label(F.col(col), dict(df.dtypes)[col]))


def require_levels(df: DataFrame, col: str, levels: Sequence[str]) -> None:
    present = df.filter(F.col(col).isin(*levels)).select(col).distinct().collect()
    missing = sorted(set(levels) - {r[0] for r in present})
    if missing:
        raise ValueError(f"{col} never takes {missing}")
