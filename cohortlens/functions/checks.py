"""Data contracts stated as aggregates; each check has a table form and a raising form."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .levels import bounded_levels, level_grid
from .ranks import attach

KINDS = ("counts", "lognorm", "scaled", "imputed")


def count_violations(counts: DataFrame, value: str = "value") -> DataFrame:
    v = F.col(value)
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad).alias("n_not_finite"),
        F.count_if(~bad & (v < 0)).alias("n_negative"),
        F.count_if(~bad & (v != F.floor(v))).alias("n_fractional"),
    ).withColumn("ok", (F.col("n_not_finite") + F.col("n_negative") + F.col("n_fractional")) == 0)


def assert_counts(counts: DataFrame, value: str = "value") -> None:
    row = count_violations(counts, value).first()
    if not row.ok:
        raise ValueError(f"not raw counts: {row.asDict()}")


def lognorm_report(layer: DataFrame, max_value: float, value: str = "value") -> DataFrame:
    """Log-normalised values are finite, not all whole, and stay under a ceiling."""
    v = F.col(value)
    return layer.agg(
        F.max(v).alias("max_value"),
        F.bool_and(v == F.floor(v)).alias("all_integer"),
        F.count_if(v.isNull() | F.isnan(v)).alias("n_not_finite"),
    ).withColumn(
        "ok",
        ~F.col("all_integer") & (F.col("max_value") <= max_value) & (F.col("n_not_finite") == 0),
    )


def assert_lognorm(layer: DataFrame, max_value: float, value: str = "value") -> None:
    row = lognorm_report(layer, max_value, value).first()
    if not row.ok:
        raise ValueError(f"not log-normalised: {row.asDict()}")


def tag_layer(layer: DataFrame, kind: str, recipe: str, value: str = "value") -> DataFrame:
    if kind not in KINDS:
        raise ValueError(f"unknown layer kind {kind}")
    return layer.withMetadata(value, {"kind": kind, "recipe": recipe})


def require_kind(layer: DataFrame, kinds: Sequence[str], value: str = "value") -> None:
    kind = layer.schema[value].metadata.get("kind")
    if kind not in kinds:
        raise ValueError(f"layer is {kind}, expected one of {list(kinds)}")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}")


def constant_metadata(cells: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per unit with each column's value, and whether it was constant and complete."""
    key = list(key)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_cells")]
    for c in columns:
        aggs += [F.min(c).alias(c), F.max(c).alias(f"_hi_{c}"), F.count(c).alias(f"_n_{c}")]
    fine = [
        (F.col(c) == F.col(f"_hi_{c}")) & (F.col(f"_n_{c}") == F.col("n_cells")) for c in columns
    ]
    constant = reduce(lambda a, b: a & b, [F.coalesce(f, F.lit(False)) for f in fine])
    return (
        cells.groupBy(*key)
        .agg(*aggs)
        .withColumn("constant", constant & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))
        .select(*key, *columns, "n_cells", "constant")
    )


def require_constant(cells: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    table = constant_metadata(cells, key, columns)
    bad = table.filter(~F.col("constant")).limit(10).collect()
    if bad:
        raise ValueError(f"unit metadata is not constant: {[tuple(r)[: len(key)] for r in bad]}")
    return table.drop("constant")


def donor_arms(cells: DataFrame, donor: str, condition: str, case: str, control: str) -> DataFrame:
    """One row per donor with a flag for each arm."""
    return (
        cells.filter(F.col(condition).isin(case, control) & F.col(donor).isNotNull())
        .groupBy(donor)
        .agg(
            F.bool_or(F.col(condition) == case).alias("has_case"),
            F.bool_or(F.col(condition) == control).alias("has_control"),
        )
    )


def design_summary(cells: DataFrame, donor: str, condition: str, case: str, control: str) -> DataFrame:
    return donor_arms(cells, donor, condition, case, control).agg(
        F.count_if("has_case").alias("n_case_donors"),
        F.count_if("has_control").alias("n_control_donors"),
        F.count_if(F.col("has_case") & F.col("has_control")).alias("n_complete_pairs"),
        F.count(F.lit(1)).alias("n_donors"),
    )


def validate_design(
    cells: DataFrame,
    donor: str,
    condition: str,
    case: str,
    control: str,
    paired: bool,
    min_donors_per_arm: int = 2,
    min_donors: int = 0,
) -> dict[str, int]:
    if not case or not control or case == control:
        raise ValueError("a comparison needs two different, nonblank levels")
    row = design_summary(cells, donor, condition, case, control).first()
    if row.n_case_donors == 0 or row.n_control_donors == 0:
        raise ValueError("a compared level does not occur")
    if min(row.n_case_donors, row.n_control_donors) < max(1, min_donors_per_arm):
        raise ValueError(f"too few donors per arm: {row.asDict()}")
    if min_donors and row.n_donors < min_donors:
        raise ValueError(f"fewer than {min_donors} donors")
    if paired and row.n_complete_pairs < row.n_donors:
        raise ValueError("paired comparison has incomplete donor pairs")
    return row.asDict()


def design_matrix(
    samples: DataFrame,
    key: str,
    factors: Sequence[str],
    interactions: Sequence[tuple[str, str]] = (),
    references: Mapping[str, str] | None = None,
) -> DataFrame:
    """Intercept, treatment-coded dummies and their products, one row per sample."""
    references = references or {}
    used = list(dict.fromkeys([*factors, *itertools.chain.from_iterable(interactions)]))
    coded: dict[str, list[tuple[str, Column]]] = {}
    for f in used:
        levels = bounded_levels(samples, f)
        ref = references.get(f, levels[0])
        if ref not in levels:
            raise ValueError(f"{f} has no level {ref}")
        coded[f] = [
            (f"{f}_{v}", (F.col(f).cast("string") == v).cast("double")) for v in levels if v != ref
        ]
    out = [F.col(key), F.lit(1.0).alias("Intercept")]
    for f in factors:
        out += [c.alias(n) for n, c in coded[f]]
    for a, b in interactions:
        out += [(ca * cb).alias(f"{na}:{nb}") for na, ca in coded[a] for nb, cb in coded[b]]
    return samples.select(*out)


def design_rank(matrix: DataFrame, key: str) -> tuple[int, int]:
    """Rank and number of columns from the p × p cross-product sums."""
    columns = [c for c in matrix.columns if c != key]
    pairs = list(itertools.combinations_with_replacement(range(len(columns)), 2))
    row = matrix.agg(
        *[
            F.sum(F.col(f"`{columns[i]}`") * F.col(f"`{columns[j]}`")).alias(f"p{i}_{j}")
            for i, j in pairs
        ]
    ).first()
    gram = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"p{i}_{j}"] or 0.0
    return int(np.linalg.matrix_rank(gram)), len(columns)


def confounded(samples: DataFrame, a: str, b: str) -> DataFrame:
    """Whether the levels of two factors determine each other."""
    pairs = samples.select(a, b).distinct()
    n_b = pairs.groupBy(a).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("per_a"))
    n_a = pairs.groupBy(b).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("per_b"))
    return attach(n_b, n_a, []).select(
        F.lit(a).alias("factor_a"),
        F.lit(b).alias("factor_b"),
        ((F.col("per_a") == 1) & (F.col("per_b") == 1)).alias("confounded"),
    )


def factor_cells(samples: DataFrame, a: str, b: str, subject: str | None = None) -> DataFrame:
    """Samples and subjects in each combination of two factors, empty ones included."""
    grid = level_grid(samples, a, b)
    aggs = [F.count(F.lit(1)).alias("n_samples")]
    if subject:
        aggs.append(F.count_distinct(subject).alias("n_subjects"))
    return grid.join(samples.groupBy(a, b).agg(*aggs), [a, b], "left").fillna(0)


def factor_support(samples: DataFrame, factors: Sequence[str], subject: str) -> DataFrame:
    """Per factor level: specimens, subjects, and subjects seen at more than one level."""
    rows = [F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level")) for f in factors]
    long = samples.select(F.col(subject).alias("_s"), F.explode(F.array(*rows)).alias("r")).select(
        "_s", "r.factor", "r.level"
    )
    varying = (
        long.groupBy("factor", "_s")
        .agg((F.count_distinct("level") > 1).alias("varies"))
    )
    return (
        long.join(varying, ["factor", "_s"])
        .groupBy("factor", "level")
        .agg(
            F.count(F.lit(1)).alias("n_samples"),
            F.count_distinct("_s").alias("n_subjects"),
            F.count_distinct(F.when(F.col("varies"), F.col("_s"))).alias("n_subjects_within"),
        )
    )


def random_effect_support(samples: DataFrame, column: str) -> DataFrame:
    sizes = samples.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("n").alias("min_specimens"),
        F.max("n").alias("max_specimens"),
        F.count_if(F.col("n") > 1).alias("n_groups_with_repeats"),
    ).withColumn("column", F.lit(column))
