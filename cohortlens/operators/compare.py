"""Comparisons between conditions with donors as replicates.

Cells are aggregated to donor or sample level first; everything after that works on
tables whose size is set by the study design (donors × groups), so per-donor arrays
are bounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import tails
from ..functions.checks import constant_metadata, donor_arms
from ..functions.fdr import bh_fdr, bh_small, binomial_upper_half, ln_factorial
from ..functions.levels import bounded_levels, canonical_label, with_levels
from ..functions.ranks import attach, average_rank, grouped_median, grouped_quantiles, value_ranks
from ..session import materialise

PSEUDOCOUNT = 0.5
SIGN_ALPHA = 0.05
MIN_PAIRED_BLOCKS = 6
MAX_EXACT_PAIRS = 18
MAX_EXACT_COMBINATIONS = 20_000
RANDOM_DRAWS = 50_000


# --- pseudobulk --------------------------------------------------------------------------


def pseudobulk(counts: DataFrame, cells: DataFrame, key: Sequence[str]) -> DataFrame:
    """Summed counts per unit and gene, as whole numbers."""
    return (
        counts.join(cells.select("cell", *key), "cell")
        .groupBy(*key, "gene")
        .agg(F.round(F.sum("value")).cast("long").alias("count"))
    )


def pseudobulk_units(cells: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return constant_metadata(cells, key, columns)


def pseudobulk_support(
    universe: DataFrame,
    observed: DataFrame,
    eligible: DataFrame,
    counts: DataFrame,
    sample: str,
    min_cells: int | None,
) -> DataFrame:
    """Every specimen of the experiment with its cells, library size and exclusion reason."""
    n_observed = observed.groupBy(sample).agg(F.count(F.lit(1)).alias("n_cells_observed"))
    n_eligible = eligible.groupBy(sample).agg(F.count(F.lit(1)).alias("n_cells"))
    library = (
        counts.join(eligible.select("cell", sample), "cell")
        .groupBy(sample)
        .agg(F.round(F.sum("value")).cast("long").alias("library_size"))
    )
    out = universe
    for part in (n_observed, n_eligible, library):
        out = out.join(part, sample, "left")
    out = out.fillna(0, ["n_cells_observed", "n_cells", "library_size"]).withColumn(
        "n_cells_qc_excluded", F.col("n_cells_observed") - F.col("n_cells")
    )
    below = F.lit(False) if min_cells is None else F.col("n_cells") < min_cells
    reason = (
        F.when(F.col("n_cells_observed") == 0, "population_absent")
        .when(F.col("n_cells") == 0, "population_present_but_no_de_eligible_cells")
        .when(below & (F.col("n_cells_qc_excluded") > 0), "below_min_cells_after_qc")
        .when(below, "below_min_cells")
        .when(F.col("library_size") == 0, "zero_library_size")
    )
    return out.withColumn("exclusion_reason", reason).withColumn(
        "included_for_expression", F.col("exclusion_reason").isNull()
    )


def resolve_pairing(
    units: DataFrame, donor: str, condition: str, case: str, control: str, paired: bool
) -> DataFrame:
    """Units kept for the contrast and whether it is paired.

    Promoted to paired when every donor has both arms; a paired contrast keeps complete pairs.
    """
    arms = donor_arms(units, donor, condition, case, control)
    both = F.col("has_case") & F.col("has_control")
    decision = arms.agg(
        (F.lit(paired) | ((F.count_if(~both) == 0) & (F.count(F.lit(1)) >= 2))).alias("paired"),
        F.count_if(both).alias("n_complete_pairs"),
        F.count_if(~both).alias("n_incomplete"),
    )
    kept = attach(units.join(arms, donor), decision, []).filter(
        F.col(condition).isin(case, control) & (~F.col("paired") | both)
    )
    return kept.drop("has_case", "has_control")


def support_gates(
    cells_table: DataFrame, level_table: DataFrame, min_samples: int = 2, min_subjects: int = 2,
    min_between: int = 2, between: Sequence[str] = (),
) -> DataFrame:
    """Failed gates: thin factor cells, and between-subject levels with too few subjects."""
    keys = [c for c in cells_table.columns if c not in ("n_samples", "n_subjects")]
    where = F.concat_ws(" × ", *keys)
    thin = cells_table.select(
        F.explode(
            F.array(
                F.struct(F.lit("samples_per_cell").alias("gate"), where.alias("unit"), F.col("n_samples").cast("long").alias("n"), F.lit(min_samples).alias("needed")),
                F.struct(F.lit("subjects_per_cell").alias("gate"), where.alias("unit"), F.col("n_subjects").cast("long").alias("n"), F.lit(min_subjects).alias("needed")),
            )
        ).alias("g")
    ).select("g.*")
    levels = level_table.filter(F.col("factor").isin(*between)).select(
        F.lit("subjects_per_between_level").alias("gate"),
        F.concat_ws("=", "factor", "level").alias("unit"),
        F.col("n_subjects").cast("long").alias("n"),
        F.lit(min_between).alias("needed"),
    )
    return thin.unionByName(levels).filter(F.col("n") < F.col("needed"))


def pseudobulk_de(
    pb: DataFrame,
    donor: str,
    condition: str,
    case: str,
    control: str,
    by: Sequence[str] = (),
    min_count: float = 10,
    min_total: float = 15,
    paired: bool = True,
) -> DataFrame:
    """Per-gene contrast of log2 counts per million: paired by donor, or Welch.

    Absent genes are zero counts.  A sample's value for a zero count is a constant of the
    sample, so sums over samples are the constants' sums plus corrections from present
    rows; no gene × sample grid is built.
    """
    by = list(by)
    unit = [*by, donor, condition]
    pb = materialise(pb.filter(F.col(condition).isin(case, control)), "pb")
    libs = materialise(
        pb.groupBy(*unit).agg(F.sum("count").cast("double").alias("lib")).filter(F.col("lib") > 0), "libs"
    )
    if paired:
        complete = libs.groupBy(*by, donor).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") == 2)
        libs = libs.join(complete.select(*by, donor), [*by, donor], "left_semi")
    is_case = F.col(condition) == case
    sizes = libs.groupBy(*by).agg(
        F.count_if(is_case).alias("n_case"),
        F.count_if(~is_case).alias("n_control"),
        F.expr("percentile(lib, 0.5)").alias("median_lib"),
    )
    group = F.least("n_case", "n_control")
    need = F.when(group > 10, 10 + (group - 10) * 0.7).otherwise(group.cast("double"))
    rows = materialise(attach(pb.join(libs, unit), sizes, by), "pb")
    kept = (
        rows.groupBy(*by, "gene")
        .agg(
            F.count_if(
                F.col("count") / F.col("lib") >= F.lit(min_count) / F.col("median_lib") - 1e-14
            ).alias("n_high"),
            F.sum("count").alias("total"),
            F.first(need).alias("need"),
        )
        .filter((F.col("n_high") >= F.col("need") - 1e-14) & (F.col("total") >= min_total - 1e-14))
        .select(*by, "gene")
    )

    def log_cpm(count: Column) -> Column:
        return F.log2((count + 0.5) / (F.col("lib") + 1.0) * 1e6)

    base = libs.withColumn("base", log_cpm(F.lit(0.0)))
    present = rows.join(kept, [*by, "gene"], "left_semi").withColumn("base", log_cpm(F.lit(0.0))).withColumn(
        "delta", log_cpm(F.col("count")) - F.col("base")
    )
    sign = F.when(is_case, 1.0).otherwise(-1.0)
    if paired:
        base_d = base.groupBy(*by, donor).agg(F.sum(sign * F.col("base")).alias("base"))
        b = base_d.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("base").alias("b1"),
            F.sum(F.col("base") * F.col("base")).alias("b2"),
        )
        d = present.groupBy(*by, "gene", donor).agg(F.sum(sign * F.col("delta")).alias("delta"))
        sums = d.join(base_d, [*by, donor]).groupBy(*by, "gene").agg(
            F.sum("delta").alias("d1"),
            F.sum(2 * F.col("base") * F.col("delta") + F.col("delta") * F.col("delta")).alias("d2"),
        )
        out = attach(sums, b, by)
        mean = (F.col("b1") + F.col("d1")) / F.col("n")
        var = (F.col("b2") + F.col("d2") - F.col("n") * mean * mean) / (F.col("n") - 1)
        out = out.withColumns({"logFC": mean, "df": (F.col("n") - 1).cast("double"), "_se2": var / F.col("n")})
    else:
        aggs_b, aggs_d = [], []
        for name, flag in (("case", is_case), ("control", ~is_case)):
            aggs_b += [
                F.count_if(flag).alias(f"n_{name}"),
                F.sum(F.when(flag, F.col("base")).otherwise(0.0)).alias(f"b1_{name}"),
                F.sum(F.when(flag, F.col("base") * F.col("base")).otherwise(0.0)).alias(f"b2_{name}"),
            ]
            aggs_d += [
                F.sum(F.when(flag, F.col("delta")).otherwise(0.0)).alias(f"d1_{name}"),
                F.sum(
                    F.when(flag, 2 * F.col("base") * F.col("delta") + F.col("delta") * F.col("delta")).otherwise(0.0)
                ).alias(f"d2_{name}"),
            ]
        out = attach(present.groupBy(*by, "gene").agg(*aggs_d), base.groupBy(*by).agg(*aggs_b), by)
        mean, part = {}, {}
        for name in ("case", "control"):
            n = F.col(f"n_{name}")
            mean[name] = (F.col(f"b1_{name}") + F.col(f"d1_{name}")) / n
            part[name] = (F.col(f"b2_{name}") + F.col(f"d2_{name}") - n * mean[name] * mean[name]) / (n - 1) / n
        se2 = part["case"] + part["control"]
        df = se2 * se2 / (
            part["case"] * part["case"] / (F.col("n_case") - 1)
            + part["control"] * part["control"] / (F.col("n_control") - 1)
        )
        out = out.withColumns({"logFC": mean["case"] - mean["control"], "df": df, "_se2": se2})
    out = out.withColumn("t", F.col("logFC") / F.sqrt(F.nullif(F.greatest(F.col("_se2"), F.lit(0.0)), F.lit(0.0))))
    out = out.select(*by, "gene", "logFC", "t", "df").withColumn("p", tails.t_two_sided("t", "df"))
    return bh_fdr(out, "p", by)


# --- composition -------------------------------------------------------------------------


def celltype_counts(cells: DataFrame, key: Sequence[str], cell_type: str) -> DataFrame:
    """Sample × type counts with zeros; unlabelled cells do not count."""
    counted = cells.filter(F.col(cell_type).isNotNull())
    types = bounded_levels(counted, cell_type)
    grid = with_levels(counted.select(*key).distinct(), cell_type, types)
    n = counted.groupBy(*key, cell_type).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, [*key, cell_type], "left").fillna(0, ["n"])


def composition(cells: DataFrame, cell_type: str, group: str) -> DataFrame:
    """Counts and fractions per type, overall and inside each group, from one cube."""
    cubed = (
        cells.cube(group, cell_type)
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
        .withColumn(group, F.coalesce(group, F.lit("ALL")))
    )
    small = materialise(cubed, "cube")
    totals = small.filter(F.col("_g").isin(1, 3)).select(group, F.col("n").alias("_total"))
    return (
        small.filter(F.col("_g").isin(0, 2))
        .join(totals, group)
        .select(group, cell_type, "n", (F.col("n") / F.col("_total")).alias("fraction"))
    )


def sample_shares(counts: DataFrame, sample: Sequence[str], n: str = "n") -> DataFrame:
    """Share of each type in its sample; samples without cells have none."""
    total = counts.groupBy(*sample).agg(F.sum(n).alias("total"))
    return counts.join(total, list(sample)).withColumn(
        "share", F.when(F.col("total") > 0, F.col(n) / F.col("total"))
    )


def arms(
    df: DataFrame, item: Sequence[str], donor: str, condition: str, value: str, case: str, control: str
) -> DataFrame:
    """Wide donor table: mean of ``value`` in each arm."""
    return (
        df.filter(F.col(condition).isin(case, control) & F.col(value).isNotNull())
        .groupBy(*item, donor)
        .agg(
            F.avg(F.when(F.col(condition) == case, F.col(value))).alias("case"),
            F.avg(F.when(F.col(condition) == control, F.col(value))).alias("control"),
        )
    )


def paired_statistics(wide: DataFrame, item: Sequence[str]) -> DataFrame:
    """Paired-difference statistics per item over donors with both arms."""
    d = F.col("case") - F.col("control")
    out = (
        wide.filter(F.col("case").isNotNull() & F.col("control").isNotNull())
        .withColumn("d", d)
        .groupBy(*item)
        .agg(
            F.count(F.lit(1)).alias("n_pairs"),
            F.avg("case").alias("mean_case"),
            F.avg("control").alias("mean_control"),
            F.avg("d").alias("delta"),
            F.stddev_samp("d").alias("sd"),
            F.expr("percentile(d, 0.5)").alias("median_delta"),
            F.sum("d").alias("_sum"),
            F.min("d").alias("_min"),
            F.max("d").alias("_max"),
            F.sort_array(F.collect_list("d")).alias("diffs"),
        )
    )
    scale = F.greatest(F.abs("_min"), F.abs("_max"), F.lit(1e-300))
    n = F.col("n_pairs")
    t = F.when((n >= 2) & (F.col("sd") > 1e-12 * scale), F.col("delta") / (F.col("sd") / F.sqrt(n)))
    return out.withColumns(
        {
            "t": t,
            "df": (n - 1).cast("double"),
            "n_donors_positive": F.size(F.filter("diffs", lambda x: x > 0)),
            "direction": F.signum("delta").cast("int"),
            "loo_min": F.when(n > 1, (F.col("_sum") - F.col("_max")) / (n - 1)).otherwise(F.col("delta")),
            "loo_max": F.when(n > 1, (F.col("_sum") - F.col("_min")) / (n - 1)).otherwise(F.col("delta")),
        }
    ).drop("_sum", "_min", "_max")


def with_paired_p(stats: DataFrame) -> DataFrame:
    return stats.withColumn("t_p", tails.t_two_sided("t", "df")).withColumn(
        "wilcoxon_p", tails.wilcoxon_p("diffs")
    )


def donor_medians(
    df: DataFrame, item: Sequence[str], donor: str, condition: str, value: str, case: str, control: str
) -> DataFrame:
    """Wide donor table of exact medians over cells."""
    source = df.filter(F.col(condition).isin(case, control) & F.col(donor).isNotNull())
    med = grouped_median(source, [*item, condition, donor], value, "m")
    return med.groupBy(*item, donor).agg(
        F.max(F.when(F.col(condition) == case, F.col("m"))).alias("case"),
        F.max(F.when(F.col(condition) == control, F.col("m"))).alias("control"),
    )


def donor_median_test(
    df: DataFrame,
    value: str,
    condition: str,
    donor: str,
    case: str,
    control: str,
    paired: bool,
    item: Sequence[str] = (),
    min_donors: int = 3,
    incomplete: str = "error",
) -> DataFrame:
    """Donor medians per arm: signed-rank on complete pairs or Mann–Whitney on separate donors.

    ``incomplete='error'`` refuses unmatched donors in a paired test; overlapping donors
    are refused in an unpaired one.
    """
    item = list(item)
    wide = materialise(donor_medians(df, item, donor, condition, value, case, control), "medians")
    both = F.col("case").isNotNull() & F.col("control").isNotNull()
    if paired and incomplete == "error" and wide.filter(~both).limit(1).count():
        raise ValueError("paired comparison has unmatched donors")
    if not paired and wide.filter(both).limit(1).count():
        raise ValueError("independent groups share donors")
    if paired:
        stats = paired_statistics(wide, item).filter(F.col("n_pairs") >= min_donors)
        return stats.select(
            *item,
            F.lit("wilcoxon_signed_rank").alias("test"),
            F.col("n_pairs").alias("n_case"),
            F.col("n_pairs").alias("n_control"),
            F.col("median_delta").alias("effect"),
            tails.wilcoxon_p("diffs").alias("p"),
        )
    stats = wide.groupBy(*item).agg(
        F.count("case").alias("n_case"),
        F.count("control").alias("n_control"),
        (F.expr("percentile(case, 0.5)") - F.expr("percentile(control, 0.5)")).alias("effect"),
        F.sort_array(F.collect_list("case")).alias("_x"),
        F.sort_array(F.collect_list("control")).alias("_y"),
    )
    return stats.filter(F.least("n_case", "n_control") >= min_donors).select(
        *item,
        F.lit("mann_whitney").alias("test"),
        "n_case",
        "n_control",
        "effect",
        tails.mann_whitney_p("_x", "_y").alias("p"),
    )


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns]
    return df.select(*ids, F.explode(F.array(*pairs)).alias("_p")).select(*ids, f"_p.{name}", f"_p.{value}")


def differential_state(
    cells: DataFrame,
    scores: Sequence[str],
    donor: str,
    condition: str,
    case: str,
    control: str,
    min_cells: int = 20,
    min_donors: int = 4,
) -> DataFrame:
    """Paired donor-median test of every score over donors with enough cells in each arm."""
    long = unpivot(cells, [donor, condition], scores, "score", "value").filter(
        F.col(condition).isin(case, control)
    )
    q = grouped_quantiles(long, ["score", condition, donor], "value", {"m": 0.5}).filter(
        F.col("n_values") >= min_cells
    )
    wide = q.groupBy("score", donor).agg(
        F.max(F.when(F.col(condition) == case, F.col("m"))).alias("case"),
        F.max(F.when(F.col(condition) == control, F.col("m"))).alias("control"),
    )
    stats = paired_statistics(wide, ["score"])
    tested = F.col("n_pairs") >= min_donors
    out = stats.select(
        "score",
        "n_pairs",
        F.when(tested, F.col("median_delta")).alias("effect"),
        F.when(tested, tails.wilcoxon_p("diffs")).alias("p"),
        F.when(tested, "tested").otherwise("insufficient_donors").alias("status"),
    )
    return bh_small(out, "p")


def composition_paired_test(
    shares: DataFrame, cell_type: str, donor: str, condition: str, case: str, control: str, min_pairs: int = 4
) -> DataFrame:
    pct = shares.withColumn("_pct", 100.0 * F.col("share"))
    stats = paired_statistics(arms(pct, [cell_type], donor, condition, "_pct", case, control), [cell_type])
    out = stats.filter(F.col("n_pairs") >= min_pairs).select(
        cell_type, "n_pairs", F.col("delta").alias("mean_difference"), tails.wilcoxon_p("diffs").alias("p")
    )
    return bh_small(out, "p")


def proportion_ttest(
    counts: DataFrame,
    cell_type: str,
    donor: str,
    condition: str,
    case: str,
    control: str,
    paired: bool = True,
) -> DataFrame:
    """t test of arcsine-root shares per sample; effect in percentage points."""
    shares = sample_shares(counts, [donor, condition]).withColumn("z", F.asin(F.sqrt("share")))
    if paired:
        z = paired_statistics(arms(shares, [cell_type], donor, condition, "z", case, control), [cell_type])
        pp = paired_statistics(arms(shares, [cell_type], donor, condition, "share", case, control), [cell_type])
        effect = pp.select(
            cell_type,
            (100.0 * F.col("delta")).alias("effect_pp"),
            F.size(F.filter("diffs", lambda x: F.signum(x) == F.signum(F.col("delta")))).alias("n_donors_with_mean"),
        )
        out = z.join(effect, cell_type).select(
            cell_type, "n_pairs", "mean_case", "mean_control", "t", "df", "effect_pp", "n_donors_with_mean"
        )
    else:
        out = welch(shares, [cell_type], condition, "z", case, control)
        pp = welch(shares, [cell_type], condition, "share", case, control).select(
            cell_type, (100.0 * F.col("effect")).alias("effect_pp")
        )
        out = out.join(pp, cell_type)
    return bh_small(out.withColumn("p", tails.t_two_sided("t", "df")), "p")


def welch(
    df: DataFrame, item: Sequence[str], condition: str, value: str, case: str, control: str
) -> DataFrame:
    """Welch contrast of per-unit values."""
    aggs = []
    for name, level in (("case", case), ("control", control)):
        v = F.when(F.col(condition) == level, F.col(value))
        aggs += [
            F.count(v).alias(f"n_{name}"),
            F.avg(v).alias(f"mean_{name}"),
            F.var_samp(v).alias(f"_v_{name}"),
        ]
    out = df.groupBy(*item).agg(*aggs)
    a, b = F.col("_v_case") / F.col("n_case"), F.col("_v_control") / F.col("n_control")
    se2 = a + b
    return out.withColumns(
        {
            "effect": F.col("mean_case") - F.col("mean_control"),
            "se": F.sqrt(se2),
            "df": se2 * se2
            / F.nullif(a * a / (F.col("n_case") - 1) + b * b / (F.col("n_control") - 1), F.lit(0.0)),
            "t": (F.col("mean_case") - F.col("mean_control")) / F.nullif(F.sqrt(se2), F.lit(0.0)),
        }
    ).drop("_v_case", "_v_control")


def bootstrap_interval(
    wide: DataFrame, item: Sequence[str], donor: str, n_boot: int = 1000, seed: int = 0, level: float = 0.95
) -> DataFrame:
    """Percentile interval of the mean paired difference over hashed donor resamples."""
    item = list(item)
    per = (
        wide.filter(F.col("case").isNotNull() & F.col("control").isNotNull())
        .withColumn("d", F.col("case") - F.col("control"))
        .groupBy(*item)
        .agg(F.sort_array(F.collect_list(F.struct(donor, "d"))).alias("rows"))
    )
    draws = per.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(n_boot)))).withColumn(
        "m",
        F.aggregate(
            F.sequence(F.lit(1), F.size("rows")),
            F.lit(0.0),
            lambda acc, i: acc
            + F.element_at(
                "rows", (F.pmod(F.xxhash64(F.lit(seed), F.col("b"), i, *item), F.size("rows")) + 1).cast("int")
            )["d"],
        )
        / F.size("rows"),
    )
    tail = (1 - level) / 2
    return draws.groupBy(*item).agg(
        F.expr(f"percentile(m, {tail})").alias("ci_low"), F.expr(f"percentile(m, {1 - tail})").alias("ci_high")
    )


# --- moderated proportions ---------------------------------------------------------------


def _polygamma(x: np.ndarray, order: int) -> np.ndarray:
    """Digamma (0) or trigamma (1) by recurrence and asymptotic series."""
    x = np.asarray(x, float).copy()
    total = np.zeros_like(x)
    for _ in range(12):
        small = x < 12
        total = np.where(small, total - (1 / x if order == 0 else -1 / x**2), total)
        x = np.where(small, x + 1, x)
    if order == 0:
        return total + np.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6)
    return total + 1 / x + 1 / (2 * x**2) + 1 / (6 * x**3) - 1 / (30 * x**5) + 1 / (42 * x**7)


def moderated_prior(variances: np.ndarray, df: float) -> tuple[float, float]:
    """Scaled-F prior (df0, s0²) of a set of variances with equal df."""
    v = np.maximum(np.asarray(variances, float), 1e-5 * max(np.median(variances), 1e-300))
    e = np.log(v) - float(_polygamma(df / 2, 0)) + math.log(df / 2)
    mean = e.mean()
    excess = e.var(ddof=1) - float(_polygamma(df / 2, 1)) if e.size > 1 else 0.0
    if excess <= 0:
        return math.inf, math.exp(mean)
    lo, hi = 1e-6, 1e8
    for _ in range(200):
        mid = math.sqrt(lo * hi)
        if float(_polygamma(mid, 1)) > excess:
            lo = mid
        else:
            hi = mid
    half = math.sqrt(lo * hi)
    return 2 * half, math.exp(mean + float(_polygamma(half, 0)) - math.log(half))


def propeller_test(
    counts: DataFrame,
    cell_type: str,
    donor: str,
    condition: str,
    case: str,
    control: str,
    transform: str = "asin",
    paired: bool = True,
) -> DataFrame:
    """Transformed-proportion contrast with variances moderated toward the pool of types."""
    shares = sample_shares(counts, [donor, condition])
    if transform == "logit":
        p = (F.col("n") + 0.5) / (F.col("total") + 0.5)
        shares = shares.withColumn("z", F.log(p / (1 - F.least(p, F.lit(1 - 1e-9)))))
    else:
        shares = shares.withColumn("z", F.asin(F.sqrt("share")))
    if paired:
        base = paired_statistics(arms(shares, [cell_type], donor, condition, "z", case, control), [cell_type])
        base = base.select(
            cell_type,
            F.col("delta").alias("effect"),
            (F.col("sd") * F.col("sd")).alias("variance"),
            F.col("df"),
            (1 / F.col("n_pairs")).alias("unscaled"),
        )
    else:
        w = welch(shares, [cell_type], condition, "z", case, control)
        spread = shares.filter(F.col(condition).isin(case, control)).groupBy(cell_type, condition).agg(
            F.var_samp("z").alias("v"), F.count("z").alias("k")
        ).groupBy(cell_type).agg(
            (F.sum(F.col("v") * (F.col("k") - 1)) / F.sum(F.col("k") - 1)).alias("variance"),
            F.sum(F.col("k") - 1).cast("double").alias("df"),
        )
        base = w.join(spread, cell_type, "inner").select(
            cell_type, "effect", "variance", spread["df"], (1 / F.col("n_case") + 1 / F.col("n_control")).alias("unscaled")
        )
    ratio = arms(shares, [cell_type], donor, condition, "share", case, control).groupBy(cell_type).agg(
        (F.avg("case") / F.nullif(F.avg("control"), F.lit(0.0))).alias("ratio")
    )
    schema = f"{cell_type} string, effect double, variance double, df double, unscaled double, t double, df_total double"

    def moderate(pdf: pd.DataFrame) -> pd.DataFrame:
        d = float(pdf["df"].max())
        df0, s0 = moderated_prior(pdf["variance"].to_numpy(), d)
        v = pdf["variance"].to_numpy()
        post = np.full_like(v, s0) if math.isinf(df0) else (df0 * s0 + d * v) / (df0 + d)
        pdf["t"] = pdf["effect"] / np.sqrt(post * pdf["unscaled"])
        pdf["df_total"] = min(df0 + d, d * len(pdf))
        return pdf

    # one row per cell type: the family is a few hundred rows at most
    moderated = base.groupBy(F.lit(1).alias("_all")).applyInPandas(
        lambda pdf: moderate(pdf.drop(columns="_all", errors="ignore")), schema
    )
    out = moderated.join(ratio, cell_type).withColumn("p", tails.t_two_sided("t", "df_total"))
    return bh_small(out, "p")


# --- reference choice, concordance -------------------------------------------------------


def clr_table(counts: DataFrame, sample: Sequence[str], cell_type: str) -> DataFrame:
    """Counts with share and centred log ratio inside each sample."""
    padded = F.log(F.col("n") + PSEUDOCOUNT)
    per = counts.groupBy(*sample).agg(F.sum("n").alias("total"), F.avg(padded).alias("_c"))
    return counts.join(per, list(sample)).filter(F.col("total") > 0).select(
        *sample,
        cell_type,
        "n",
        "total",
        (F.col("n") / F.col("total")).alias("share"),
        (padded - F.col("_c")).alias("clr"),
    )


def select_reference(
    counts: DataFrame,
    sample: Sequence[str],
    cell_type: str,
    min_presence: float = 0.95,
    min_abundance: float = 0.05,
) -> DataFrame:
    """Criteria per type and the chosen compositional reference: steadiest eligible share."""
    t = clr_table(counts, sample, cell_type).groupBy(cell_type).agg(
        F.avg((F.col("n") > 0).cast("double")).alias("presence"),
        F.avg("share").alias("mean_abundance"),
        F.var_pop("clr").alias("clr_variance"),
        (F.stddev_pop("share") / F.avg("share")).alias("abundance_cv"),
    )
    t = materialise(t, "criteria")
    strict = (F.col("presence") >= min_presence) & (F.col("mean_abundance") >= min_abundance)
    any_strict = t.agg(F.bool_or(strict).alias("_any"))
    out = attach(t, any_strict, []).withColumn(
        "eligible", F.when(F.col("_any"), strict).otherwise(F.col("presence") >= min_presence)
    )
    pick = out.filter("eligible").agg(F.min_by(cell_type, F.struct("clr_variance", cell_type)).alias("_pick"))
    return attach(out, pick, []).withColumn(
        "selected", F.coalesce(F.col(cell_type) == F.col("_pick"), F.lit(False))
    ).drop("_any", "_pick")


def _describe(stats: DataFrame, min_pairs: int) -> DataFrame:
    """Agreement, sign test, leave-one-out stability and the pattern ladder."""
    direction = F.col("direction")
    moved = F.size(F.filter("diffs", lambda x: x != 0))
    agree = F.when(
        direction != 0, F.size(F.filter("diffs", lambda x: F.signum(x) == F.col("direction")))
    ).otherwise(0)
    out = stats.withColumns({"n_agree": agree, "_moved": moved})
    sign_p = F.when((direction != 0) & (F.col("_moved") > 0), binomial_upper_half(F.col("n_agree"), F.col("_moved")))
    stable = (
        F.when(F.col("n_pairs") < 2, F.lit(False))
        .when(direction > 0, F.col("loo_min") > 0)
        .when(direction < 0, F.col("loo_max") < 0)
        .otherwise(F.lit(False))
    )
    out = out.withColumns(
        {
            "sign_test_p": sign_p,
            "loo_sign_stable": stable,
            "signs_agree": (direction != 0) & (F.signum("median_delta") == direction),
        }
    )
    corroborated = F.coalesce(F.col("sign_test_p") < SIGN_ALPHA, F.lit(False))
    return out.withColumn(
        "pattern",
        F.when(F.col("n_pairs") < min_pairs, "underpowered")
        .when(direction == 0, "heterogeneous")
        .when(corroborated & F.col("loo_sign_stable"), "consistent")
        .when(corroborated, "single_donor_driven")
        .when(~F.col("signs_agree"), "direction_inconsistent")
        .otherwise("heterogeneous"),
    ).drop("_moved")


def paired_concordance(
    counts: DataFrame, cell_type: str, donor: str, condition: str, case: str, control: str,
    min_pairs: int = MIN_PAIRED_BLOCKS,
) -> DataFrame:
    table = materialise(clr_table(counts, [donor, condition], cell_type), "clr")
    clr = paired_statistics(arms(table, [cell_type], donor, condition, "clr", case, control), [cell_type])
    pp = paired_statistics(arms(table, [cell_type], donor, condition, "share", case, control), [cell_type])
    pp = pp.select(
        cell_type,
        (100.0 * F.col("delta")).alias("mean_delta_pp"),
        (100.0 * F.col("median_delta")).alias("median_delta_pp"),
    )
    out = _describe(clr, min_pairs).join(pp, cell_type).withColumn("wilcoxon_p", tails.wilcoxon_p("diffs"))
    out = out.select(
        cell_type, "n_pairs", "n_agree", "direction", "mean_delta_pp", "median_delta_pp",
        F.col("delta").alias("mean_delta_clr"), F.col("median_delta").alias("median_delta_clr"),
        F.col("loo_min").alias("loo_mean_clr_min"), F.col("loo_max").alias("loo_mean_clr_max"),
        "loo_sign_stable", "signs_agree", "sign_test_p", "wilcoxon_p", "pattern",
    )
    return bh_small(bh_small(out, "sign_test_p", out="sign_test_fdr"), "wilcoxon_p", out="wilcoxon_fdr")


def paired_value_concordance(
    values: DataFrame, item: str, donor: str, condition: str, value: str, case: str, control: str,
    min_pairs: int = MIN_PAIRED_BLOCKS,
) -> DataFrame:
    """Concordance of any item's donor values on their common support.

    The conservative sign-test p doubles the one-sided tail, since the direction was
    read off the same data.
    """
    wide = materialise(arms(values, [item], donor, condition, value, case, control), "arms")
    one_arm = wide.groupBy(item).agg(
        F.count_if(F.col("case").isNull() | F.col("control").isNull()).alias("n_donors_one_arm"),
        F.count_if(F.col("control").isNull()).alias("_case_only"),
        F.count_if(F.col("case").isNull()).alias("_control_only"),
        F.count_if(F.col("case").isNotNull() & F.col("control").isNotNull()).alias("_pairs"),
    )
    floor = _floor_p(F.col("_pairs"), F.col("_case_only"), F.col("_control_only"))
    out = _describe(paired_statistics(wide, [item]), min_pairs).join(one_arm, item).withColumns(
        {
            "design_floor_p": floor,
            "sign_test_p_conservative": F.least(F.lit(1.0), 2 * F.col("sign_test_p")),
            "wilcoxon_p": tails.wilcoxon_p("diffs"),
        }
    )
    out = out.select(
        item, "n_pairs", "n_donors_one_arm", "n_agree", "direction", "mean_case", "mean_control",
        F.col("delta").alias("mean_delta"), "median_delta",
        F.col("loo_min").alias("loo_mean_min"), F.col("loo_max").alias("loo_mean_max"),
        "loo_sign_stable", "signs_agree", "sign_test_p", "sign_test_p_conservative", "wilcoxon_p",
        "design_floor_p", "pattern",
    )
    for p, name in (
        ("sign_test_p", "sign_test_fdr"),
        ("sign_test_p_conservative", "sign_test_fdr_conservative"),
        ("wilcoxon_p", "wilcoxon_fdr"),
    ):
        out = bh_small(out, p, out=name)
    return out


def qualify_calls(
    effects: DataFrame, concordance: DataFrame, item: str, significant: str, fdr: str, alpha: float = 0.05
) -> DataFrame:
    """Effects with their pattern, the concordance call, and a note where the two disagree."""
    right = concordance.select(
        canonical_label(F.col(item)).alias("_k"), "pattern", F.col(fdr).alias("_fdr"), "n_pairs", "n_agree"
    )
    joined = effects.withColumn("_k", canonical_label(F.col(item))).join(right, "_k", "left")
    consistent = F.coalesce(F.col("pattern") == "consistent", F.lit(False))
    return joined.withColumns(
        {
            "concordance_called": consistent & F.coalesce(F.col("_fdr") < alpha, F.lit(False)),
            "unanimous": F.coalesce(
                (F.col("n_pairs") >= MIN_PAIRED_BLOCKS) & (F.col("n_agree") >= F.col("n_pairs")), F.lit(False)
            ),
            "needs_note": F.col(significant) & ~consistent,
        }
    ).drop("_k", "_fdr", "n_pairs", "n_agree")


def group_resolution(
    counts: DataFrame, cell_type: str, condition: str, case: str, control: str, min_cells: int = 10
) -> DataFrame:
    med = "percentile({}, 0.5)"
    out = counts.groupBy(cell_type).agg(
        F.sum("n").alias("total_cells"),
        F.count(F.lit(1)).alias("n_samples"),
        F.expr(med.format("n")).alias("median_cells_per_sample"),
        F.min("n").alias("min_cells_per_sample"),
        F.count_if(F.col("n") == 0).alias("n_samples_zero"),
        F.expr(med.format(f"CASE WHEN {condition} = '{case}' THEN n END")).alias("median_cells_case"),
        F.expr(med.format(f"CASE WHEN {condition} = '{control}' THEN n END")).alias("median_cells_control"),
    )
    rankable = F.col("median_cells_per_sample") >= min_cells
    note = F.concat_ws(
        "; ",
        F.when(
            ~rankable,
            F.concat(
                F.lit("median "), F.format_number("median_cells_per_sample", 1),
                F.lit(f" cells/sample is below the {min_cells}-cell floor"),
            ),
        ),
        F.when(
            F.col("n_samples_zero") > 0,
            F.concat(F.col("n_samples_zero").cast("string"), F.lit(" of "), F.col("n_samples").cast("string"), F.lit(" samples have none")),
        ),
    )
    return out.withColumns({"ratio_rankable": rankable, "resolution_note": note})


# --- randomisation -----------------------------------------------------------------------


def _floor_p(pairs: Column, case_only: Column, control_only: Column) -> Column:
    n = case_only + control_only
    ln = pairs * F.lit(math.log(2.0)) + ln_factorial(n) - ln_factorial(case_only) - ln_factorial(control_only)
    return F.least(F.lit(1.0), F.exp(F.lit(math.log(2.0)) - ln))


def randomization_floor(samples: DataFrame, donor: str, condition: str, case: str, control: str, by: Sequence[str] = ()) -> DataFrame:
    """Smallest two-sided p the design's label assignments allow."""
    per = (
        samples.filter(F.col(condition).isin(case, control))
        .groupBy(*by, donor)
        .agg(
            F.bool_or(F.col(condition) == case).alias("a"),
            F.bool_or(F.col(condition) == control).alias("b"),
        )
    )
    out = per.groupBy(*by).agg(
        F.count_if(F.col("a") & F.col("b")).alias("n_pairs"),
        F.count_if(F.col("a") & ~F.col("b")).alias("n_case_only"),
        F.count_if(F.col("b") & ~F.col("a")).alias("n_control_only"),
    )
    return out.withColumn(
        "floor_p", _floor_p(F.col("n_pairs"), F.col("n_case_only"), F.col("n_control_only"))
    )


def annotate_reachability(table: DataFrame, floor: DataFrame, p: str, alpha: float = 0.05) -> DataFrame:
    """Whether the design could reach FDR ``alpha`` in this family, and by how many concordant tests."""
    family = table.agg(F.count(F.when(~F.isnan(p), F.col(p))).alias("family_size"))
    out = attach(attach(table, floor.select(F.col("floor_p").alias("design_floor_p")), []), family, [])
    need = F.greatest(F.lit(1), F.ceil(F.col("design_floor_p") * F.col("family_size") / alpha))
    return out.withColumns(
        {
            "p_below_design_floor": F.coalesce(F.col(p) < F.col("design_floor_p"), F.lit(False)),
            "family_min_concordant": need.cast("long"),
            "family_floor_reachable": need <= F.col("family_size"),
        }
    )


def donor_effect(wide: DataFrame, item: Sequence[str]) -> DataFrame:
    """Paired t where two donors span both arms, else Welch on donor means, with 95 % intervals."""
    item = list(item)
    paired = paired_statistics(wide, item)
    aggs = [
        F.count("case").alias("n_case"), F.count("control").alias("n_control"),
        F.avg("case").alias("_mc"), F.avg("control").alias("_mk"),
        F.var_samp("case").alias("_vc"), F.var_samp("control").alias("_vk"),
        F.max(F.abs(F.coalesce("case", F.lit(0.0)))).alias("_s1"),
        F.max(F.abs(F.coalesce("control", F.lit(0.0)))).alias("_s2"),
    ]
    both = wide.groupBy(*item).agg(*aggs)
    joined = attach(both, paired, item)
    a, b = F.col("_vc") / F.col("n_case"), F.col("_vk") / F.col("n_control")
    se_w = F.sqrt(a + b)
    use_pair = F.coalesce(F.col("n_pairs") >= 2, F.lit(False))
    use_welch = ~use_pair & (F.col("n_case") >= 2) & (F.col("n_control") >= 2)
    joined = joined.withColumns(
        {
            "test": F.when(use_pair, "paired_t").when(use_welch, "welch_t").otherwise("none"),
            "effect": F.when(use_pair, F.col("delta")).when(use_welch, F.col("_mc") - F.col("_mk")),
            "_se": F.when(use_pair, F.col("sd") / F.sqrt("n_pairs")).when(use_welch, se_w),
            "_df_t": F.when(use_pair, F.col("df")).when(
                use_welch,
                (a + b) * (a + b)
                / F.nullif(a * a / (F.col("n_case") - 1) + b * b / (F.col("n_control") - 1), F.lit(0.0)),
            ),
            "_df_ci": F.when(use_pair, F.col("df")).when(
                use_welch, F.greatest(F.col("n_case") + F.col("n_control") - 2, F.lit(1)).cast("double")
            ),
        }
    )
    defined = F.col("_se") > 1e-12 * F.greatest("_s1", "_s2", F.lit(1e-300))
    joined = joined.withColumn("t", F.when(defined, F.col("effect") / F.col("_se")))
    half = F.when(defined, tails.t_quantile_975("_df_ci") * F.col("_se"))
    return joined.withColumns(
        {
            "p": tails.t_two_sided("t", "_df_t"),
            "ci_low": F.col("effect") - half,
            "ci_high": F.col("effect") + half,
            "reason": F.when(F.col("test") == "none", "too few donors")
            .when(~defined, "no spread beyond floating-point error")
            .otherwise(""),
        }
    ).select(*item, "test", "n_pairs", "n_case", "n_control", "effect", "t", "p", "ci_low", "ci_high", "reason")


def sign_flip_test(wide: DataFrame, item: Sequence[str], seed: int = 0) -> DataFrame:
    """Sign-flip p of the summed paired difference: all 2ⁿ vectors up to 18 pairs, hashed draws above.

    Sign vectors are rows, so the enumeration is shared among tasks: each vector's sum is
    folded over the item's donor differences.
    """
    item = list(item)
    stats = paired_statistics(wide, item).select(*item, "n_pairs", "diffs").filter(F.col("n_pairs") >= 2)
    exact = F.col("n_pairs") <= MAX_EXACT_PAIRS
    last = F.when(exact, F.pow(F.lit(2.0), F.col("n_pairs")).cast("long") - 1).otherwise(
        F.lit(RANDOM_DRAWS - 1).cast("long")
    )

    chunks = stats.withColumn("_last", last).withColumn(
        "mask", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))
    )
    # position i of the vector: a bit of the mask, or a hashed bit; mask 0 is the observed vector
    signed = F.aggregate(
        F.zip_with(
            "diffs",
            F.sequence(F.lit(0), F.size("diffs") - 1),
            lambda d, i: d
            * (
                1
                - 2
                * F.when(exact, F.pmod(F.floor(F.col("mask") / F.pow(F.lit(2.0), i)), F.lit(2)))
                .when(F.col("mask") == 0, F.lit(0))
                .otherwise(F.pmod(F.xxhash64(F.lit(seed), F.col("mask"), i), F.lit(2)))
            ),
        ),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    total = F.aggregate("diffs", F.lit(0.0), lambda acc, x: acc + x)
    size = F.aggregate("diffs", F.lit(0.0), lambda acc, x: acc + F.abs(x))
    hit = F.abs(signed) >= F.abs(total) - 1e-12 * F.greatest(F.lit(1.0), size)
    return (
        chunks.withColumn("_hit", hit)
        .groupBy(*item, "n_pairs")
        .agg(F.avg(F.col("_hit").cast("double")).alias("p"))
        .withColumn("method", F.when(exact, "sign_flip_exact").otherwise("sign_flip_mc"))
    )


def label_permutation_test(wide: DataFrame, item: Sequence[str], seed: int = 0) -> DataFrame:
    """Two-sample label permutation p on donor means of one-arm donors, exact or hashed draws."""
    item = list(item)
    per = wide.groupBy(*item).agg(
        F.sort_array(F.collect_list("case")).alias("x"), F.sort_array(F.collect_list("control")).alias("y")
    )

    def run(it):
        import itertools

        for pdf in it:
            ps, how = [], []
            for x, y in zip(pdf["x"], pdf["y"]):
                x, y = np.asarray(x, float), np.asarray(y, float)
                k, n = len(x), len(x) + len(y)
                if k < 2 or n - k < 2:
                    ps.append(math.nan)
                    how.append("")
                    continue
                pool = np.concatenate([x, y])
                seen = abs(x.mean() - y.mean()) - 1e-12 * max(1.0, np.abs(pool).mean())
                if math.comb(n, k) <= MAX_EXACT_COMBINATIONS:
                    sums = np.array([pool[list(c)].sum() for c in itertools.combinations(range(n), k)])
                    how.append("label_perm_exact")
                else:
                    rng = np.random.default_rng(seed)
                    order = np.argsort(rng.random((RANDOM_DRAWS, n)), axis=1)[:, :k]
                    order[0] = np.arange(k)
                    sums = pool[order].sum(axis=1)
                    how.append("label_perm_mc")
                stat = np.abs(sums / k - (pool.sum() - sums) / (n - k))
                ps.append(float((stat >= seen).mean()))
            yield pdf[item].assign(p=ps, method=how)

    keys = ", ".join(f"`{c}` string" for c in item)
    return per.mapInPandas(run, f"{keys + ', ' if keys else ''}p double, method string")


def module_effects(
    cells: DataFrame, scores: Sequence[str], group: str, donor: str, condition: str, case: str, control: str
) -> DataFrame:
    """Per group × program: donor effect, interval, p, randomisation p, design floor and FDR."""
    long = unpivot(cells, [group, donor, condition], scores, "program", "value").filter(
        F.col(condition).isin(case, control)
    )
    means = long.groupBy(group, "program", donor, condition).agg(F.avg("value").alias("value"))
    wide = materialise(arms(means, [group, "program"], donor, condition, "value", case, control), "arms")
    effect = donor_effect(wide, [group, "program"])
    flip = sign_flip_test(wide, [group, "program"]).select(
        group, "program", F.col("p").alias("randomization_p"), F.col("method").alias("randomization_method")
    )
    floors = wide.groupBy(group, "program").agg(
        _floor_p(
            F.count_if(F.col("case").isNotNull() & F.col("control").isNotNull()),
            F.count_if(F.col("control").isNull()),
            F.count_if(F.col("case").isNull()),
        ).alias("floor_p")
    )
    out = effect.join(flip, [group, "program"], "left").join(floors, [group, "program"])
    return bh_small(out, "p")


def recorrect(table: DataFrame, p: str, by: Sequence[str], out: str = "fdr") -> DataFrame:
    """FDR recomputed inside restricted families."""
    return bh_small(table.drop(out), p, by, out)


def panel_membership(items: DataFrame, sets: DataFrame, item: str, sep: str = "->") -> DataFrame:
    """Sets that contain every member of a composite item."""
    parts = items.select(item).distinct().withColumn("_m", F.split(item, sep, -1))
    exploded = parts.select(item, F.size(F.array_distinct("_m")).alias("_k"), F.explode(F.array_distinct("_m")).alias("member"))
    hits = exploded.join(sets.select("source", F.col("target").alias("member")).distinct(), "member")
    return (
        hits.groupBy(item, "source", "_k").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == F.col("_k")).select(item, "source")
    )


def permanova(
    samples: DataFrame, group: str, unit: str, condition: str, case: str, dims: Sequence[str],
    n_perm: int = 199, seed: int = 0,
) -> DataFrame:
    """Pseudo-F and R² of the condition per group, with a permutation p.

    Sums of squared pairwise distances equal sums of squares around centroids, so no
    pair of samples is formed.  A permutation relabels samples by hashed order.
    """
    x = [F.col(d) for d in dims]
    base = samples.select(group, unit, (F.col(condition) == case).cast("int").alias("y"), F.array(*x).alias("v"))
    base = materialise(base, "samples")
    size = base.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n_case"))
    rows = base.withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm))))
    order = W.partitionBy(group, "perm").orderBy(F.xxhash64(F.lit(seed), F.col("perm"), F.col(unit)), unit)
    rows = rows.join(size, group).withColumn(
        "arm",
        F.when(F.col("perm") == 0, F.col("y")).otherwise((F.row_number().over(order) <= F.col("n_case")).cast("int")),
    )
    sums = rows.groupBy(group, "perm", "n", "n_case").agg(
        F.sum(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)).alias("ss"),
        *[F.sum(F.col("v")[i]).alias(f"t{i}") for i in range(len(dims))],
        *[F.sum(F.when(F.col("arm") == 1, F.col("v")[i]).otherwise(0.0)).alias(f"c{i}") for i in range(len(dims))],
    )
    n, k = F.col("n"), F.col("n_case")
    sq = lambda cols: sum((c * c for c in cols), F.lit(0.0))
    total = F.col("ss") - sq([F.col(f"t{i}") for i in range(len(dims))]) / n
    within = (
        F.col("ss")
        - sq([F.col(f"c{i}") for i in range(len(dims))]) / k
        - sq([F.col(f"t{i}") - F.col(f"c{i}") for i in range(len(dims))]) / (n - k)
    )
    scored = sums.filter((k >= 1) & (n - k >= 1) & (n >= 3)).select(
        group, "perm", "n", "n_case",
        ((total - within) / (within / (n - 2))).alias("f"),
        ((total - within) / total).alias("r2"),
    )
    seen = scored.filter(F.col("perm") == 0).select(group, F.col("f").alias("pseudo_F"), F.col("r2").alias("R2"), "n", "n_case")
    ge = (
        scored.filter(F.col("perm") > 0)
        .join(seen.select(group, "pseudo_F"), group)
        .groupBy(group)
        .agg(F.count_if(F.col("f") >= F.col("pseudo_F")).alias("_ge"))
    )
    out = seen.join(ge, group, "left").withColumn("p", (F.coalesce("_ge", F.lit(0)) + 1) / F.lit(float(n_perm + 1)))
    return bh_small(out.drop("_ge"), "p")


# --- depth and mediation -----------------------------------------------------------------


def depth_audit(
    cells: DataFrame, metrics: Sequence[str], depth: str, donor: str, condition: str, case: str, control: str,
    alpha: float = 0.05, collapse: float = 0.25, min_pairs: int = MIN_PAIRED_BLOCKS,
) -> DataFrame:
    """Does a metric's condition effect survive removal of its within-sample depth slope?"""
    base = cells.filter(F.col(condition).isin(case, control)).withColumn("_ld", F.log1p(F.col(depth).cast("double")))
    long = unpivot(base, [donor, condition, "_ld"], metrics, "metric", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value") & F.col("_ld").isNotNull()
    )
    # sums per sample give slopes, means and residual means without a pass per cell
    per = materialise(
        long.groupBy("metric", donor, condition).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("value").alias("sy"),
            F.sum("_ld").alias("sx"),
            (F.covar_pop("value", "_ld") * F.count(F.lit(1))).alias("sxy"),
            (F.var_pop("_ld") * F.count(F.lit(1))).alias("sxx"),
        ),
        "depth",
    )
    slope = per.groupBy("metric").agg(
        F.coalesce(F.sum("sxy") / F.nullif(F.sum("sxx"), F.lit(0.0)), F.lit(0.0)).alias("slope"),
        (F.sum("sx") / F.sum("n")).alias("ref"),
    )
    sample = per.join(slope, "metric").select(
        "metric", donor, condition,
        (F.col("sy") / F.col("n")).alias("raw"),
        (F.col("sy") / F.col("n") - F.col("slope") * (F.col("sx") / F.col("n") - F.col("ref"))).alias("adj"),
        (F.col("sx") / F.col("n")).alias("depth"), "slope",
    )
    sample = materialise(sample, "depth")

    def contrast(value: str, prefix: str) -> DataFrame:
        s = with_paired_p(paired_statistics(arms(sample, ["metric"], donor, condition, value, case, control), ["metric"]))
        return s.select(
            "metric", *( ["n_pairs"] if prefix == "raw" else []),
            F.col("delta").alias(f"{prefix}_delta"), F.col("t").alias(f"{prefix}_t"), F.col("t_p").alias(f"{prefix}_p"),
        )

    slopes = slope.select("metric", "slope")
    out = contrast("raw", "raw").join(contrast("adj", "adjusted"), "metric").join(contrast("depth", "depth"), "metric").join(slopes, "metric")
    gate = F.coalesce(F.col("depth_p") < alpha, F.lit(False))
    raw_ok = F.coalesce(F.col("raw_p") < alpha, F.lit(False))
    adj_ok = F.coalesce(F.col("adjusted_p") < alpha, F.lit(False))
    retained = F.abs("adjusted_delta") / F.abs(F.nullif(F.col("raw_delta"), F.lit(0.0)))
    out = out.withColumn(
        "verdict",
        F.when(F.col("n_pairs") < min_pairs, "insufficient_pairs")
        .when(~gate, "depth_balanced")
        .when(~raw_ok & adj_ok, "depth_masked")
        .when(~raw_ok, "no_raw_effect")
        .when(F.col("adjusted_p").isNull(), "depth_driven")
        .when(F.signum("adjusted_delta") != F.signum("raw_delta"), "depth_driven")
        .when(retained < collapse, "depth_driven")
        .when(~adj_ok, "attenuated")
        .otherwise("robust"),
    )
    return bh_small(bh_small(out, "raw_p", out="raw_fdr"), "adjusted_p", out="adjusted_fdr")


def within_sample_rho(
    cells: DataFrame, metric: str, depth: str, sample: Sequence[str], min_cells: int = 5
) -> DataFrame:
    """Mean over samples of the Spearman correlation of a metric with depth."""
    sample = list(sample)
    base = materialise(cells.select("cell", *sample, F.col(metric).cast("double").alias("v"), F.col(depth).cast("double").alias("d")).dropna(), "rho")
    out = base
    for c in ("v", "d"):
        ranks = value_ranks(base, sample, c).select(*sample, c, average_rank().alias(f"r_{c}"))
        out = out.join(ranks, [*sample, c])
    return (
        out.groupBy(*sample)
        .agg(F.count(F.lit(1)).alias("n"), F.corr("r_v", "r_d").alias("rho"))
        .filter((F.col("n") >= min_cells) & F.col("rho").isNotNull() & ~F.isnan("rho"))
        .agg(F.avg("rho").alias("mean_rho"), F.count(F.lit(1)).alias("n_samples"))
    )


def depth_stratified_abundance(
    cells: DataFrame, label: str, depth: str, donor: str, condition: str, case: str, control: str,
    n_bins: int = 3, min_pairs: int = MIN_PAIRED_BLOCKS, alpha: float = 0.05,
) -> DataFrame:
    """Paired abundance contrasts inside depth quantile bins and pooled, with agreement and verdict."""
    base = materialise(
        cells.filter(F.col(condition).isin(case, control)).select(
            donor, condition, F.col(label).alias("label"), F.col(depth).cast("double").alias("_d")
        ).dropna(),
        "strata",
    )
    probs = {f"e{i}": i / n_bins for i in range(1, n_bins)}
    edges = grouped_quantiles(base, [], "_d", probs).drop("n_values")
    # right-closed bins; equal edges collapse because no value lies strictly between them
    bin_of = sum(((F.col("_d") > F.col(e)).cast("int") for e in probs), F.lit(0))
    binned = attach(base, edges, []).withColumn("stratum", bin_of.cast("string"))
    counts = materialise(
        binned.groupBy("stratum", donor, condition, "label").agg(F.count(F.lit(1)).alias("n")), "strata"
    )
    both = counts.unionByName(
        counts.groupBy(donor, condition, "label").agg(F.sum("n").alias("n")).withColumn("stratum", F.lit("all"))
    )
    totals = both.groupBy("stratum", donor, condition).agg(F.sum("n").alias("total"))
    grid = with_levels(totals, "label", bounded_levels(counts, "label"))
    shares = grid.join(both, ["stratum", donor, condition, "label"], "left").withColumn(
        "share", F.coalesce("n", F.lit(0)) / F.col("total")
    )
    stats = with_paired_p(paired_statistics(arms(shares, ["label", "stratum"], donor, condition, "share", case, control), ["label", "stratum"]))
    stats = materialise(
        bh_small(
            stats.select("label", "stratum", "n_pairs", "mean_case", "mean_control", "delta", "n_donors_positive", "t", "t_p"),
            "t_p", ["stratum"],
        ),
        "strata",
    )
    pooled = stats.filter(F.col("stratum") == "all").select("label", F.col("delta").alias("_d0"))
    agreement = (
        stats.filter((F.col("stratum") != "all") & (F.col("n_pairs") >= min_pairs))
        .join(pooled, "label")
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n_strata"),
            F.count_if(F.signum("delta") == F.signum("_d0")).alias("n_strata_same_sign"),
            F.count_if(F.col("t_p") < alpha).alias("n_strata_significant"),
        )
        .withColumn("stratum", F.lit("all"))
    )
    out = stats.join(agreement, ["label", "stratum"], "left")
    is_all = F.col("stratum") == "all"
    n, same, sig = F.coalesce("n_strata", F.lit(0)), F.col("n_strata_same_sign"), F.col("n_strata_significant")
    return out.withColumn(
        "verdict",
        F.when(~is_all, F.lit(None))
        .when(F.col("n_pairs") < min_pairs, "insufficient_pairs")
        .when(~F.coalesce(F.col("t_p") < alpha, F.lit(False)), "no_raw_effect")
        .when(n == 0, "insufficient_pairs")
        .when((same == n) & (sig >= 1), "robust")
        .when(same == n, "attenuated")
        .when(same >= n - 1, "attenuated")
        .otherwise("depth_driven"),
    )


def _mediation_terms(n: Column, s: dict[str, Column]) -> dict[str, Column]:
    """OLS coefficients of m ~ t and y ~ t + m from centred cross products."""
    a = s["tm"] / s["tt"]
    det = s["tt"] * s["mm"] - s["tm"] * s["tm"]
    direct = (s["ty"] * s["mm"] - s["my"] * s["tm"]) / F.nullif(det, F.lit(0.0))
    b = (s["my"] * s["tt"] - s["ty"] * s["tm"]) / F.nullif(det, F.lit(0.0))
    acme = a * b
    total = direct + acme
    return {
        "path_a": a, "path_b": b, "direct": direct, "acme": acme, "total": total,
        "proportion_mediated": acme / F.nullif(total, F.lit(0.0)),
    }


def mediation(
    cells: DataFrame, sample: Sequence[str], treatment: Column, mediators: Sequence[str], outcome: str, donor: str,
    n_boot: int = 200, seed: int = 0,
) -> DataFrame:
    """Mediation of a sample-level effect for a grid of mediators, with a donor bootstrap interval."""
    means = cells.withColumn("t", treatment.cast("double")).groupBy(*sample).agg(
        F.first(F.col(donor), ignorenulls=True).alias("_donor"),
        F.avg("t").alias("t"),
        F.avg(outcome).alias("y"),
        *[F.avg(m).alias(m) for m in mediators],
    )
    long = unpivot(means, ["_donor", "t", "y"], mediators, "mediator", "m")
    cols = {"n": F.lit(1.0), "t": F.col("t"), "m": F.col("m"), "y": F.col("y")}
    for x, z in (("t", "t"), ("t", "m"), ("m", "m"), ("t", "y"), ("m", "y")):
        cols[x + z] = F.col(x) * F.col(z)
    per = materialise(long.groupBy("mediator", "_donor").agg(*[F.sum(c).alias(k) for k, c in cols.items()]), "donors")

    def solve(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        tot = df.groupBy(*keys).agg(*[F.sum(k).alias(k) for k in cols])
        n = F.col("n")
        s = {k: F.col(k) - F.col(k[0]) * F.col(k[1]) / n for k in cols if len(k) == 2}
        return tot.select(*keys, n.cast("long").alias("n_samples"), *[c.alias(k) for k, c in _mediation_terms(n, s).items()])

    point = solve(per, ["mediator"])
    donors = per.groupBy("mediator").agg(F.sort_array(F.collect_list(F.struct("_donor", *cols))).alias("rows"))
    drawn = donors.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(n_boot)))).withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.size("rows")))
    )
    pick = F.element_at("rows", (F.pmod(F.xxhash64(F.lit(seed), F.col("b"), F.col("i")), F.size("rows")) + 1).cast("int"))
    boots = solve(drawn.select("mediator", "b", pick.alias("r")).select("mediator", "b", "r.*"), ["mediator", "b"])
    interval = boots.groupBy("mediator").agg(
        F.expr("percentile(acme, 0.025)").alias("acme_low"),
        F.expr("percentile(acme, 0.975)").alias("acme_high"),
        F.least(
            F.lit(1.0),
            2 * F.least(F.avg((F.col("acme") <= 0).cast("double")), F.avg((F.col("acme") >= 0).cast("double"))),
        ).alias("acme_p"),
    )
    return point.join(interval, "mediator", "left")


def feature_overlap_grade(left: DataFrame, right: DataFrame) -> DataFrame:
    """How far a mediator's features are the outcome's: disjoint, overlapping or nested."""
    a, b = left.select("target").distinct(), right.select("target").distinct()
    sizes = attach(
        attach(a.agg(F.count(F.lit(1)).alias("a")), b.agg(F.count(F.lit(1)).alias("b")), []),
        a.join(b, "target", "left_semi").agg(F.count(F.lit(1)).alias("n_shared")),
        [],
    )
    return sizes.select(
        "n_shared",
        F.coalesce(F.col("n_shared") / F.nullif(F.col("a") + F.col("b") - F.col("n_shared"), F.lit(0)), F.lit(0.0)).alias("jaccard"),
        F.when(F.col("n_shared") == 0, "disjoint")
        .when(F.col("n_shared") / F.least("a", "b") >= 0.5, "nested")
        .otherwise("overlapping")
        .alias("grade"),
    )


def stratum_quotas(cells: DataFrame, strata: Sequence[str], cap: int) -> DataFrame:
    """Proportional quotas summing to ``cap`` with at least one cell per stratum."""
    sizes = cells.groupBy(F.concat_ws("|", *strata).alias("stratum")).agg(F.count(F.lit(1)).alias("available"))
    whole = W.partitionBy(F.lit(0))
    k = F.count(F.lit(1)).over(whole)
    extra = (F.lit(cap) - k) * (F.col("available") - 1) / F.nullif(F.sum(F.col("available") - 1).over(whole), F.lit(0))
    base = sizes.withColumn("_x", F.coalesce(extra, F.lit(0.0))).withColumn("_q", 1 + F.floor("_x"))
    base = base.withColumn("_left", F.lit(cap) - F.sum("_q").over(whole)).withColumn(
        "_r", F.row_number().over(whole.orderBy((F.col("_x") - F.floor("_x")).desc(), "stratum"))
    )
    quota = F.col("_q") + F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0)
    everything = F.sum("available").over(whole) <= cap
    return base.select(
        "stratum", "available", F.when(everything, F.col("available")).otherwise(quota).cast("long").alias("quota")
    )


def stratified_sample(cells: DataFrame, strata: Sequence[str], cap: int, seed: int = 0) -> DataFrame:
    """The cells drawn for each quota, by hashed order; the rank filter prunes before the shuffle."""
    quotas = stratum_quotas(cells, strata, cap).withColumnRenamed("stratum", "_s")
    order = W.partitionBy("_s").orderBy(F.xxhash64(F.lit(seed), F.col("cell")), "cell")
    ranked = cells.withColumn("_s", F.concat_ws("|", *strata)).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= cap)
    return ranked.join(quotas, "_s").filter(F.col("_r") <= F.col("quota")).drop("_s", "_r", "available", "quota")
