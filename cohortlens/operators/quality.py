"""Cell and gene quality: masks, metrics, robust severities, verdicts and their audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ranks import attach, grouped_median, grouped_quantiles
from ..session import materialise

# Fixed values of the severity scale and the verdict rules.
HALF_SEVERITY_Z = 3.0
MAD_TO_SIGMA = 1.4826
QUANTILE_SCALES = ((0.75, 0.6745), (0.90, 1.2816), (0.99, 2.3263))
MIN_CELLS_FOR_NULL = 25
FAMILIES = (
    "capture_complexity",
    "nuclear_integrity",
    "metabolic_stress",
    "ambient_background",
    "multiplet",
)
DAMAGE_FAMILIES = FAMILIES[:4]
SUPPORTING_FAMILIES = ("metabolic_stress",)
# Immediate-early and heat-shock genes.
STRESS_GENES = [
    "FOS",
    "FOSB",
    "JUN",
    "JUNB",
    "JUND",
    "EGR1",
    "ATF3",
    "IER2",
    "HSPA1A",
    "HSPA1B",
    "HSPB1",
    "HSPH1",
    "DNAJB1",
    "DNAJA1",
    "SOCS3",
    "ZFP36",
    "DUSP1",
    "KLF6",
    "NR4A1",
    "PPP1R15A",
]
NUCLEAR_GENES = ["MALAT1"]
STRESS_WEIGHT = 0.6


# --- masks and metrics -------------------------------------------------------------------


def feature_masks(
    genes: DataFrame,
    symbol: str = "symbol",
    mito: Sequence[str] = ("MT-", "mt-"),
    ribo: Sequence[str] = ("RPS", "RPL", "Rps", "Rpl"),
    hemoglobin: Sequence[str] = ("^HB[^(P)]",),
    custom: Sequence[str] = (),
) -> DataFrame:
    def any_of(conditions: Sequence[Column]) -> Column:
        return F.coalesce(reduce(lambda a, b: a | b, conditions, F.lit(False)), F.lit(False))

    name = F.col(symbol)
    return genes.withColumns(
        {
            "mito": any_of([name.startswith(p) for p in mito]),
            "ribo": any_of([name.startswith(p) for p in ribo]),
            "hemoglobin": any_of([name.rlike(p) for p in hemoglobin]),
            "custom_exclude": any_of([name.startswith(p) for p in custom]),
        }
    )


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, (part / whole) * 100.0).otherwise(F.lit(0.0))


def cell_qc_metrics(
    counts: DataFrame,
    genes: DataFrame,
    cells: DataFrame,
    families: Sequence[str] = ("mito", "ribo", "hemoglobin"),
) -> DataFrame:
    """Depth, detected genes and family shares of every cell, zero-depth cells included."""
    flagged = counts.join(genes.select("gene", *families), "gene", "left")
    per_cell = flagged.groupBy("cell").agg(
        F.sum("value").alias("total_counts"),
        F.count_if(F.col("value") > 0).alias("n_genes_by_counts"),
        *[
            F.sum(F.when(F.col(f), F.col("value"))).alias(f"total_counts_{f}")
            for f in families
        ],
    )
    out = cells.join(per_cell, "cell", "left").fillna(
        0, ["total_counts", "n_genes_by_counts", *[f"total_counts_{f}" for f in families]]
    )
    out = out.withColumns(
        {
            "log1p_total_counts": F.log1p("total_counts"),
            "log1p_n_genes_by_counts": F.log1p("n_genes_by_counts"),
        }
    )
    return out.withColumns(
        {
            **{f"log1p_total_counts_{f}": F.log1p(f"total_counts_{f}") for f in families},
            **{
                f"pct_counts_{f}": percent(F.col(f"total_counts_{f}"), F.col("total_counts"))
                for f in families
            },
        }
    )


def pct_top_n(counts: DataFrame, cells: DataFrame, ns: Sequence[int]) -> DataFrame:
    """Percent of counts in a cell's n largest genes.

    The rank filter lets Spark keep only the largest ``max(ns)`` rows per cell on each
    map task before the shuffle.
    """
    totals = counts.groupBy("cell").agg(F.sum("value").alias("total"))
    order = W.partitionBy("cell").orderBy(F.col("value").desc(), "gene")
    top = (
        counts.withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") <= max(ns))
        .groupBy("cell")
        .agg(*[F.sum(F.when(F.col("rn") <= n, F.col("value"))).alias(f"top_{n}") for n in ns])
    )
    joined = cells.select("cell").join(totals, "cell", "left").join(top, "cell", "left").fillna(0.0)
    return joined.select(
        "cell",
        *[percent(F.col(f"top_{n}"), F.col("total")).alias(f"pct_counts_in_top_{n}_genes") for n in ns],
    )


def gene_qc_metrics(counts: DataFrame, genes: DataFrame, cells: DataFrame) -> DataFrame:
    """Per gene detection and mean over all cells, undetected genes included."""
    per_gene = counts.groupBy("gene").agg(
        F.count_if(F.col("value") > 0).alias("n_cells_by_counts"),
        F.sum("value").alias("total_counts"),
    )
    n_cells = cells.agg(F.count(F.lit(1)).alias("n_cells"))
    joined = genes.select("gene").join(per_gene, "gene", "left").fillna(0)
    return attach(joined, n_cells, []).select(
        "gene",
        "n_cells_by_counts",
        (F.col("total_counts") / F.col("n_cells")).alias("mean_counts"),
        (100.0 * (1.0 - F.col("n_cells_by_counts") / F.col("n_cells"))).alias("pct_dropout_by_counts"),
        F.col("total_counts").cast("double").alias("total_counts"),
        F.log1p(F.col("total_counts") / F.col("n_cells")).alias("log1p_mean_counts"),
        F.log1p("total_counts").alias("log1p_total_counts"),
    )


def cell_floors(
    metrics: DataFrame, min_genes: int | None = 100, min_counts: int | None = None
) -> DataFrame:
    """Keep flag and the first floor each cell fails."""
    rules = []
    if min_genes is not None:
        rules.append((F.col("n_genes_by_counts") < min_genes, f"fewer_than_{min_genes}_genes"))
    if min_counts is not None:
        rules.append((F.col("total_counts") < min_counts, f"fewer_than_{min_counts}_counts"))
    reason = F.lit("")
    for failed, text in reversed(rules):
        reason = F.when(failed, text).otherwise(reason)
    return metrics.withColumn("floor_reason", reason).withColumn("keep", F.col("floor_reason") == "")


def gene_floor(gene_metrics: DataFrame, min_cells: int | None = 3) -> DataFrame:
    keep = F.lit(True) if min_cells is None else F.col("n_cells_by_counts") >= min_cells
    return gene_metrics.withColumn("keep", keep)


def apply_floors(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Counts of kept cells and kept genes."""
    return counts.join(cells.filter("keep").select("cell"), "cell", "left_semi").join(
        genes.filter("keep").select("gene"), "gene", "left_semi"
    )


# --- robust severities -------------------------------------------------------------------


def robust_params(
    df: DataFrame, values: Mapping[str, Column], by: Sequence[str]
) -> DataFrame:
    """Location and scale of each value inside each group: ``_loc_*`` and ``_scale_*``.

    All values go through two quantile passes together: medians and upper quantiles,
    then the median absolute deviation.  ``df`` is read several times; pass a
    materialised table.
    """
    by = list(by)
    names = list(values)

    def stacked(source: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("metric"), e.cast("double").alias("x")) for n, e in exprs.items()]
        return source.select(*by, F.explode(F.array(*pairs)).alias("p")).select(*by, "p.metric", "p.x")

    probs = {"q50": 0.5, **{f"q{int(q * 100)}": q for q, _ in QUANTILE_SCALES}}
    first = grouped_quantiles(stacked(df, values), [*by, "metric"], "x", probs)
    wide = first.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("metric") == n, F.col(q))).alias(f"_{q}_{n}")
            for n in names
            for q in probs
        ]
    )
    wide = materialise(wide, "nulls")
    located = attach(df, wide, by)
    deviations = {n: F.abs(e - F.col(f"_q50_{n}")) for n, e in values.items()}
    second = grouped_quantiles(stacked(located, deviations), [*by, "metric"], "x", {"mad": 0.5})
    spread = second.groupBy(*by).agg(
        *[F.max(F.when(F.col("metric") == n, F.col("mad"))).alias(f"_mad_{n}") for n in names]
    )
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    out = attach(attach(wide, sizes, by), spread, by)
    columns = [F.col(c) for c in by]
    for n in names:
        location = F.col(f"_q50_{n}")
        candidates = [F.col(f"_mad_{n}") * MAD_TO_SIGMA] + [
            (F.col(f"_q{int(q * 100)}_{n}") - location) / z for q, z in QUANTILE_SCALES
        ]
        scale = F.coalesce(*[F.when(c > 0, c) for c in candidates])
        columns += [
            location.alias(f"_loc_{n}"),
            F.when(F.col("_size") >= MIN_CELLS_FOR_NULL, scale).alias(f"_scale_{n}"),
        ]
    return materialise(out.select(*columns), "nulls")


def saturating(z: Column, half: float = HALF_SEVERITY_Z) -> Column:
    positive = F.when(z > 0, z).when(z.isNotNull(), F.lit(0.0))
    return positive / (positive + half)


@dataclass(frozen=True)
class Tail:
    """One metric scored in one tail of its group's robust null."""

    column: str
    upper: bool = True
    log: bool = False

    def value(self) -> Column:
        raw = F.col(self.column).cast("double")
        return F.log1p(F.when(raw < 0, 0.0).otherwise(raw)) if self.log else raw


def tail_severity(
    df: DataFrame, tails: Mapping[str, Tail], by: Sequence[str], half: float = HALF_SEVERITY_Z
) -> DataFrame:
    """Add one severity in [0, 1) per tail; null where the group gives no usable scale."""
    base = materialise(df, "cells")
    values = {n: t.value() for n, t in tails.items()}
    out = attach(base, robust_params(base, values, by), by)
    for n, t in tails.items():
        z = (values[n] - F.col(f"_loc_{n}")) / F.col(f"_scale_{n}")
        out = out.withColumn(n, saturating(z if t.upper else -z, half))
    return out.drop(*[f"_loc_{n}" for n in tails], *[f"_scale_{n}" for n in tails])


NULL_LEVELS = ("sample_x_lineage", "lineage", "sample", "pooled")
UNASSIGNED = "unassigned"


def resolve_null_groups(
    cells: DataFrame, sample: str, lineage: str, min_cells: int = MIN_CELLS_FOR_NULL
) -> DataFrame:
    """``null_level``: the finest grouping with enough cells, from aggregated sizes."""
    placed = F.when(F.col(lineage) != UNASSIGNED, F.col(lineage))
    keyed = cells.withColumns(
        {
            "_k_sample_x_lineage": F.when(placed.isNotNull(), F.concat_ws("|", sample, lineage)),
            "_k_lineage": placed,
            "_k_sample": F.col(sample).cast("string"),
        }
    )
    finest = keyed.groupBy("_k_sample_x_lineage", "_k_lineage", "_k_sample").agg(
        F.count(F.lit(1)).alias("_n")
    )
    out = keyed
    for level in NULL_LEVELS[:3]:
        sizes = (
            finest.filter(F.col(f"_k_{level}").isNotNull())
            .groupBy(f"_k_{level}")
            .agg(F.sum("_n").alias(f"_n_{level}"))
        )
        out = out.join(sizes, f"_k_{level}", "left")
    ladder = F.lit("pooled")
    for level in reversed(NULL_LEVELS[:3]):
        ladder = F.when(F.col(f"_n_{level}") >= min_cells, level).otherwise(ladder)
    return out.withColumn("null_level", ladder).drop(
        *[f"_n_{v}" for v in NULL_LEVELS[:3]], *[f"_k_{v}" for v in NULL_LEVELS[:3]]
    )


def nested_tail_severity(
    cells: DataFrame, tails: Mapping[str, Tail], sample: str, lineage: str
) -> DataFrame:
    """Severity of each cell against the null of its own level; nulls are fitted on all members."""
    keys = {
        "sample_x_lineage": [sample, lineage],
        "lineage": [lineage],
        "sample": [sample],
        "pooled": [],
    }
    base = materialise(cells, "cells")
    out = base
    for level, by in keys.items():
        values = {n: t.value() for n, t in tails.items()}
        out = attach(out, robust_params(base, values, by), by)
        for n, t in tails.items():
            z = (values[n] - F.col(f"_loc_{n}")) / F.col(f"_scale_{n}")
            out = out.withColumn(f"_{level}_{n}", saturating(z if t.upper else -z))
        out = out.drop(*[f"_loc_{n}" for n in tails], *[f"_scale_{n}" for n in tails])
    for n in tails:
        ladder = F.lit(None).cast("double")
        for level in keys:
            ladder = F.when(F.col("null_level") == level, F.col(f"_{level}_{n}")).otherwise(ladder)
        out = out.withColumn(n, ladder)
    return out.drop(*[f"_{level}_{n}" for level in keys for n in tails])


def gene_fraction(
    counts: DataFrame, genes: DataFrame, cells: DataFrame, name: str, total: str = "total_counts"
) -> DataFrame:
    """Share of each cell's counts in a gene list; null at depth 0 or when no gene is listed."""
    part = (
        counts.join(genes.select("gene"), "gene", "left_semi")
        .groupBy("cell")
        .agg(F.sum("value").alias("_part"))
    )
    listed = genes.agg((F.count(F.lit(1)) > 0).alias("_listed"))
    joined = attach(cells.join(part, "cell", "left"), listed, [])
    share = F.coalesce(F.col("_part"), F.lit(0.0)) / F.nullif(F.col(total), F.lit(0.0))
    return joined.withColumn(name, F.when(F.col("_listed"), share)).drop("_part", "_listed")


# --- evidence and verdict ----------------------------------------------------------------


@dataclass(frozen=True)
class Axis:
    """A severity column belonging to an evidence family."""

    column: str
    family: str
    weight: float = 1.0


def evidence_families(cells: DataFrame, axes: Sequence[Axis]) -> DataFrame:
    """Family severities (weighted maximum), usability and coverage from axis severities."""
    present = [f for f in FAMILIES if any(a.family == f for a in axes)]
    out = cells
    for f in present:
        members = [a for a in axes if a.family == f]
        weighted = [F.col(a.column) * a.weight for a in members]
        out = out.withColumn(
            f"family_{f}", F.greatest(*weighted) if len(weighted) > 1 else weighted[0]
        )
    usable = [F.col(f"family_{f}").isNotNull().cast("int") for f in present]
    return out.withColumn("evidence_coverage", reduce(lambda a, b: a + b, usable) / len(present))


def evidence_long(cells: DataFrame, axes: Sequence[Axis]) -> DataFrame:
    """One row per cell and axis with its availability."""
    entries = [
        F.struct(
            F.lit(a.column).alias("axis"),
            F.lit(a.family).alias("family"),
            F.col(a.column).alias("severity"),
            F.when(F.col(a.column).isNotNull(), "available_valid")
            .otherwise("computation_failed")
            .alias("availability"),
        )
        for a in axes
    ]
    return cells.select("cell", F.explode(F.array(*entries)).alias("e")).select("cell", "e.*")


def all_non_null_least(columns: Sequence[str]) -> Column:
    """Smallest value, null when any is null: detectors must agree."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    value = F.least(*columns) if len(columns) > 1 else F.col(columns[0])
    return F.when(known, value)


@dataclass(frozen=True)
class VerdictPolicy:
    concern: float = 0.5
    severe: float = 0.667
    min_concordant_families: int = 2
    uninformative_capture: float = 0.9
    min_coverage: float = 0.5
    multiplet: float = 0.6


def adjudicate_qc(
    cells: DataFrame, policy: VerdictPolicy = VerdictPolicy(), called_doublets: str | None = None
) -> DataFrame:
    """State, reason, driver, multiplet flag and confidence from family severities."""
    damage = [f for f in DAMAGE_FAMILIES if f"family_{f}" in cells.columns]
    sev = {f: F.col(f"family_{f}") for f in damage}

    def at_least(f: str, bar: float) -> Column:
        return F.coalesce(sev[f] >= bar, F.lit(False))

    def total(fs: Sequence[str], bar: float) -> Column:
        return reduce(lambda a, b: a + b, [at_least(f, bar).cast("int") for f in fs], F.lit(0))

    concerning = total(damage, policy.concern)
    severe = total(damage, policy.severe)
    establishing = total([f for f in damage if f not in SUPPORTING_FAMILIES], policy.severe)
    supporting = total([f for f in damage if f in SUPPORTING_FAMILIES], policy.concern)
    empty = (
        at_least("capture_complexity", policy.uninformative_capture)
        if "capture_complexity" in sev
        else F.lit(False)
    )
    multiplet = (
        F.coalesce(F.col("family_multiplet") >= policy.multiplet, F.lit(False))
        if "family_multiplet" in cells.columns
        else F.lit(False)
    )
    if called_doublets is not None:
        multiplet = multiplet | F.coalesce(F.col(called_doublets), F.lit(False))
    out = cells.withColumns(
        {
            "concerning_families": concerning,
            "severe_families": severe,
            "probable_multiplet": multiplet,
            "_concordant": (severe >= policy.min_concordant_families) & (establishing >= 1),
            "_empty": empty,
            "_covered": F.col("evidence_coverage") >= policy.min_coverage,
        }
    )
    route = F.col("_empty") | F.col("_concordant")
    concern = F.col("concerning_families") > 0
    driver = F.lit("")
    strongest = (
        F.greatest(*[F.when(at_least(f, policy.concern), sev[f]) for f in damage])
        if len(damage) > 1
        else sev[damage[0]]
    )
    for f in reversed(damage):
        driver = F.when(at_least(f, policy.concern) & (sev[f] == F.col("_top")), f).otherwise(driver)
    worst = F.greatest(*sev.values()) if len(damage) > 1 else sev[damage[0]]
    span = max(policy.concern, 1.0 - policy.concern) or 1.0
    distance = F.coalesce(F.abs(worst - policy.concern) / span, F.lit(0.0))
    quarantined = route & F.col("_covered")
    return (
        out.withColumn("_top", strongest)
        .withColumns(
            {
                "qc_state": F.when(quarantined, "quarantine")
                .when(route | concern, "borderline")
                .otherwise("core"),
                "qc_reason": F.when(
                    F.col("probable_multiplet") & ~concern & ~quarantined, "probable_multiplet"
                )
                .when(quarantined & F.col("_empty"), "uninformative_barcode")
                .when(quarantined, "concordant_severe_damage")
                .when(route, "withheld_low_coverage")
                .when(concern & (supporting == F.col("concerning_families")), "supporting_evidence_only")
                .when(concern, "single_family_concern")
                .otherwise("no_concern"),
                "primary_driver": F.when(concern, driver).otherwise(""),
                "qc_confidence": F.col("evidence_coverage") * F.least(distance, F.lit(1.0)),
            }
        )
        .drop("_concordant", "_empty", "_covered", "_top")
    )


# Permissions of each state, by analysis.
ANALYSES = ("manifold", "clustering", "annotation", "composition", "de", "trajectory", "ccc")
PERMISSIONS = ("fit", "transform", "inference")
BORDERLINE_GRANTS = {
    ("manifold", "transform"),
    ("clustering", "transform"),
    ("annotation", "transform"),
    ("annotation", "inference"),
    ("composition", "transform"),
}
QUARANTINE_GRANTS = {("manifold", "transform")}
MULTIPLET_KEEPS = ("annotation",)


def mask_columns() -> list[str]:
    return [f"qc_{p}_{a}" for a in ANALYSES for p in PERMISSIONS]


def eligibility_masks(cells: DataFrame, state: str = "qc_state", multiplet: str = "probable_multiplet") -> DataFrame:
    masks = {}
    for a in ANALYSES:
        for p in PERMISSIONS:
            states = ["core"]
            if (a, p) in BORDERLINE_GRANTS:
                states.append("borderline")
            if (a, p) in QUARANTINE_GRANTS:
                states.append("quarantine")
            granted = F.coalesce(F.col(state).isin(*states), F.lit(False))
            if a not in MULTIPLET_KEEPS:
                granted = granted & ~F.coalesce(F.col(multiplet), F.lit(False))
            masks[f"qc_{p}_{a}"] = granted
    return cells.withColumns(masks)


def exclusion_audit(cells: DataFrame) -> DataFrame:
    """Category and number of denied permissions; every cell keeps a row."""
    core = F.col("qc_state") == "core"
    quarantine = F.col("qc_state") == "quarantine"
    multiplet = F.coalesce(F.col("probable_multiplet"), F.lit(False))
    category = (
        F.when(multiplet & ~core, "multiplet_plus_damage")
        .when(multiplet & core, "probable_multiplet_only")
        .when(quarantine & (F.col("qc_reason") == "concordant_severe_damage"), "quarantine_multi_family_damage")
        .when(quarantine & (F.col("qc_reason") == "uninformative_barcode"), "quarantine_capture_complexity")
        .when(quarantine, "quarantine_other")
        .when(F.col("qc_state") == "borderline", "borderline_nonmultiplet")
        .otherwise("eligible")
    )
    denied = reduce(lambda a, b: a + b, [(~F.col(m)).cast("int") for m in mask_columns()])
    return cells.withColumns({"exclusion_category": category, "n_permissions_denied": denied})


def inference_excluded(cells: DataFrame) -> DataFrame:
    return exclusion_audit(cells).filter(F.col("n_permissions_denied") > 0)


def physically_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.join(after.select("cell"), "cell", "left_anti")


def doublet_consensus(
    cells: DataFrame,
    detectors: Mapping[str, tuple[str, str | None]],
    rule: str = "any",
    threshold: float | None = None,
) -> DataFrame:
    """Per-detector calls, their consensus and the largest score.

    A detector is ``name -> (score column, native call column or None)``; an explicit
    threshold replaces native calls, 0.5 is used where there is none.
    """
    bar = 0.5 if threshold is None else threshold
    out = cells
    calls = []
    for name, (score, native) in detectors.items():
        known = F.col(score).isNotNull() & ~F.isnan(score)
        by_score = F.col(score) >= bar
        call = by_score
        if native is not None and threshold is None:
            call = F.when(F.col(native).isNotNull(), F.col(native) > 0.5).otherwise(by_score)
        out = out.withColumn(f"call_{name}", F.when(known, call).otherwise(F.lit(False)))
        out = out.withColumn(f"measured_{name}", known)
        calls.append(F.col(f"call_{name}").cast("int"))
    hits = reduce(lambda a, b: a + b, calls)
    decided = {
        "any": hits > 0,
        "all": hits == len(calls),
        "majority": hits > len(calls) / 2,
    }[rule]
    scores = [F.col(s) for s, _ in detectors.values()]
    return out.withColumn("predicted_doublet", decided).withColumn(
        "doublet_score", F.greatest(*scores) if len(scores) > 1 else scores[0]
    )


# --- audits ------------------------------------------------------------------------------


def lineage_coherence(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, lineage: str, detection: float = 0.5
) -> DataFrame:
    """Share of all genes detected in at least ``detection`` of a lineage's cells."""
    sizes = cells.groupBy(lineage).agg(F.count(F.lit(1)).alias("n_cells"))
    detected = (
        counts.filter(F.col("value") > 0)
        .join(cells.select("cell", lineage), "cell")
        .groupBy(lineage, "gene")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    common = (
        detected.join(sizes, lineage)
        .groupBy(lineage)
        .agg(F.count_if(F.col("n") / F.col("n_cells") >= detection).alias("n_common"))
    )
    n_genes = genes.agg(F.count(F.lit(1)).alias("n_genes"))
    return attach(sizes.join(common, lineage, "left"), n_genes, []).select(
        lineage,
        (F.coalesce(F.col("n_common"), F.lit(0)) / F.col("n_genes")).alias("coherence"),
    )


def audit_lineages(
    cells: DataFrame,
    lineage: str,
    severities: Sequence[str],
    excluded: str,
    multiplet: str,
    suspect: float = 0.667,
    vulnerable: float = 0.5,
) -> DataFrame:
    worst = F.greatest(*severities) if len(severities) > 1 else F.col(severities[0])
    scored = cells.withColumn("_worst", worst)
    medians = grouped_median(scored, [lineage], "_worst", "median_severity")
    lost = F.col(excluded).cast("double")
    ok = ~F.coalesce(F.col(multiplet), F.lit(False))
    tallies = scored.groupBy(lineage).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.avg(lost).alias("excluded_fraction"),
        F.avg((~ok).cast("double")).alias("multiplet_fraction"),
        F.coalesce(F.avg(F.when(ok, lost)), F.lit(0.0)).alias("damage_excluded_fraction"),
    )
    return (
        tallies.join(medians, lineage, "left")
        .withColumn("suspect", F.coalesce(F.col("median_severity") >= suspect, F.lit(False)))
        .withColumn("vulnerable", F.col("damage_excluded_fraction") >= vulnerable)
    )


def intronic_fraction(layers: DataFrame, cells: DataFrame) -> DataFrame:
    sums = layers.groupBy("cell").agg(
        F.sum(F.when(F.col("layer") == "unspliced", F.col("value")).otherwise(0.0)).alias("u"),
        F.sum(F.when(F.col("layer").isin("spliced", "unspliced"), F.col("value"))).alias("t"),
    )
    return cells.join(
        sums.select("cell", F.when(F.col("t") > 0, F.col("u") / F.col("t")).alias("intronic_fraction")),
        "cell",
        "left",
    )


def finalize_qc(
    cells: DataFrame,
    support: str,
    ood: str,
    contradictions: Sequence[str],
    min_support: float = 0.5,
    max_ood: float = 0.95,
    severe: float = 0.9,
) -> DataFrame:
    """Rescue borderline cells that resemble the reference and carry no severe damage."""
    supported = F.col(support).between(min_support, 1.0) & F.col(ood).between(0.0, max_ood)
    against = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(c) >= severe, F.lit(False)) for c in contradictions],
        F.coalesce(F.col("probable_multiplet"), F.lit(False)),
    )
    borderline = F.col("qc_state") == "borderline"
    return cells.withColumn(
        "qc_state_final",
        F.when(borderline & F.coalesce(supported, F.lit(False)) & ~against, "rescued")
        .when(borderline, "unresolved_borderline")
        .otherwise(F.col("qc_state")),
    )


def qc_self_check(
    cells: DataFrame,
    audit: DataFrame,
    lineage: str,
    posterior: str,
    metabolic: str,
    null_keys: Mapping[str, str],
    minimum_core: float = 0.5,
    tolerance: float = 0.05,
    min_cells: int = 50,
    min_share: float = 0.02,
) -> DataFrame:
    """One row per rule over the QC outputs; ``null_keys`` maps null levels to key columns, finest first."""
    rescale = cells.agg(
        F.max(F.abs(F.col(metabolic) - F.col(posterior))).alias("worst")
    ).select(
        F.lit("posterior_not_rescaled").alias("name"),
        (F.coalesce(F.col("worst"), F.lit(0.0)) <= tolerance).alias("passed"),
    )
    partial = []
    for level, key in list(null_keys.items())[1:]:
        # a coarser null must hold more cells than the ones that fell back to it
        fell = F.col("null_level") == level
        per_key = cells.groupBy(F.col(key).alias("k")).agg(
            F.count(F.lit(1)).alias("members"), F.count_if(fell).alias("own")
        )
        partial.append(
            per_key.filter((F.col("own") > 0) & F.col("k").isNotNull()).agg(
                F.coalesce(F.bool_or(F.col("members") > F.col("own")), F.lit(True)).alias("ok")
            )
        )
    finest_used = cells.agg(F.count_distinct("null_level").alias("levels"))
    nested = reduce(lambda a, b: a.unionByName(b), partial).agg(F.bool_and("ok").alias("ok"))
    nested = attach(nested, finest_used, []).select(
        F.lit("fallback_nulls_are_nested").alias("name"),
        ((F.col("levels") <= 1) | F.col("ok")).alias("passed"),
    )
    cohort = audit.agg(F.sum("n_cells").alias("cohort"))
    lost = attach(audit, cohort, []).filter(
        F.col("vulnerable")
        & (F.col(lineage) != UNASSIGNED)
        & (F.col("n_cells") >= min_cells)
        & (F.col("n_cells") / F.col("cohort") >= min_share)
    )
    coherent = lost.agg((F.count(F.lit(1)) == 0).alias("passed")).select(
        F.lit("no_coherent_population_removed").alias("name"), "passed"
    )
    agreed = cells.agg(
        F.count_if(F.col("qc_fit_manifold") & (F.col("qc_state") != "core")).alias("bad"),
        F.avg((F.col("qc_state") == "core").cast("double")).alias("core"),
    )
    masks = agreed.select(F.lit("masks_agree_with_state").alias("name"), (F.col("bad") == 0).alias("passed"))
    core = agreed.select(
        F.lit("core_fraction_plausible").alias("name"), (F.col("core") >= minimum_core).alias("passed")
    )
    return reduce(lambda a, b: a.unionByName(b), [rescale, nested, coherent, masks, core]).withColumn(
        "verdict", F.when(F.col("name") == "core_fraction_plausible", "warn").otherwise("fail")
    )


# --- reports -----------------------------------------------------------------------------


def qc_report(cells: DataFrame, group: str, keep: str = "keep", total: str = "TOTAL") -> DataFrame:
    """Cells before, removed and after QC per group with a total row."""
    label = F.coalesce(F.col(group), F.lit("unassigned"))
    kept = F.coalesce(F.col(keep), F.lit(True))
    return (
        cells.select(label.alias("_g"), kept.alias("_k"))
        .rollup("_g")
        .agg(F.count(F.lit(1)).alias("cells_before_qc"), F.count_if(~F.col("_k")).alias("cells_removed"))
        .select(
            F.coalesce("_g", F.lit(total)).alias(group),
            "cells_before_qc",
            "cells_removed",
            (100.0 * F.col("cells_removed") / F.col("cells_before_qc")).alias("pct_removed"),
            (F.col("cells_before_qc") - F.col("cells_removed")).alias("cells_after_qc"),
        )
    )


def rule_attribution(cells: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Cells failing each rule, and cells failing that rule alone."""
    hits = reduce(lambda a, b: a + b, [F.col(r).cast("int") for r in rules])
    wide = cells.withColumn("_hits", hits)
    rows = [F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed"), F.col("_hits")) for r in rules]
    return (
        wide.select(F.explode(F.array(*rows)).alias("r"))
        .groupBy("r.rule")
        .agg(
            F.count_if("r.failed").alias("n_failed"),
            F.count_if(F.col("r.failed") & (F.col("r._hits") == 1)).alias("n_unique"),
        )
    )


def sample_summary(
    cells: DataFrame, sample: str, metrics: Sequence[str], carry: Sequence[str] = (), keep: str = "keep"
) -> DataFrame:
    """Per sample: kept and removed cells, metric medians, and metadata or ``mixed``."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics]
    long = cells.select(sample, F.explode(F.array(*pairs)).alias("p")).select(sample, "p.metric", "p.x")
    medians = (
        grouped_median(long, [sample, "metric"], "x", "m")
        .groupBy(sample)
        .agg(*[F.max(F.when(F.col("metric") == m, F.col("m"))).alias(f"median_{m}") for m in metrics])
    )
    tallies = cells.groupBy(sample).agg(
        F.count(F.lit(1)).alias("cells_in"),
        F.count_if(keep).alias("cells_kept"),
        *[
            F.when(F.min(c) == F.max(c), F.min(c)).otherwise("mixed").alias(c)
            for c in carry
        ],
    )
    return (
        tallies.join(medians, sample, "left")
        .withColumn("cells_removed", F.col("cells_in") - F.col("cells_kept"))
        .withColumn("pct_removed", 100.0 * F.col("cells_removed") / F.col("cells_in"))
    )


def state_reasons(cells: DataFrame) -> DataFrame:
    n = cells.agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy("qc_state", "qc_reason").agg(F.count(F.lit(1)).alias("cells"))
    return attach(rows, n, []).select(
        "qc_state", "qc_reason", "cells", (100.0 * F.col("cells") / F.col("n")).alias("pct")
    )


def eligibility_summary(cells: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(a).alias("analysis"), F.col(f"qc_fit_{a}").alias("ok")) for a in ANALYSES]
    return (
        cells.select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.analysis")
        .agg(F.count_if("p.ok").alias("may_fit"), (100.0 * F.avg(F.col("p.ok").cast("int"))).alias("pct"))
    )


def merge_metrics(cells: DataFrame, metrics: DataFrame, on: str = "cell", atol: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """Cells with computed metrics, and per column how far inherited values disagreed."""
    fresh = [c for c in metrics.columns if c != on]
    shared = [c for c in fresh if c in cells.columns]
    old = cells.withColumnsRenamed({c: f"_old_{c}" for c in shared})
    joined = old.join(metrics, on, "left")
    if shared:
        rows = [
            F.struct(
                F.lit(c).alias("column"),
                F.abs(F.col(c).cast("double") - F.col(f"_old_{c}").cast("double")).alias("gap"),
                F.col(f"_old_{c}").isNotNull().alias("had"),
            )
            for c in shared
        ]
        conflicts = (
            joined.select(F.explode(F.array(*rows)).alias("r"))
            .groupBy("r.column")
            .agg(
                F.max("r.gap").alias("max_difference"),
                F.count_if(F.col("r.gap") > atol).alias("n_different"),
                F.count_if("r.had").alias("n_inherited"),
            )
        )
    else:
        conflicts = joined.limit(0).select(
            F.lit("").alias("column"), F.lit(0.0).alias("max_difference"),
            F.lit(0).cast("long").alias("n_different"), F.lit(0).cast("long").alias("n_inherited"),
        )
    return joined.drop(*[f"_old_{c}" for c in shared]), conflicts


def ambient_correct(
    raw: DataFrame, cells: DataFrame, rho: float | DataFrame, max_droplet_counts: float | None = 100.0, to_int: bool = False
) -> DataFrame:
    """Subtract the expected ambient share of each count.

    The profile comes from raw droplets that are not called cells and stay under
    ``max_droplet_counts``; ``value - rho · depth · profile`` is floored at zero. ``rho`` is one
    number, or ``(cell, rho)`` as ``ambient.rho_of_cells`` gives it; cells without one keep their counts.
    """
    empty = raw.join(cells.select("cell"), "cell", "left_anti")
    if max_droplet_counts is not None:
        low = empty.groupBy("cell").agg(F.sum("value").alias("d")).filter(F.col("d") < max_droplet_counts)
        empty = empty.join(low.select("cell"), "cell", "left_semi")
    per_gene = empty.groupBy("gene").agg(F.sum("value").alias("g"))
    whole = per_gene.agg(F.sum("g").alias("all"))
    profile = attach(per_gene, whole, []).select("gene", (F.col("g") / F.col("all")).alias("share"))
    kept = raw.join(cells.select("cell"), "cell", "left_semi")
    depth = kept.groupBy("cell").agg(F.sum("value").alias("depth"))
    if isinstance(rho, DataFrame):
        depth = depth.join(rho.select("cell", "rho"), "cell", "left").select("cell", (F.col("depth") * F.coalesce("rho", F.lit(0.0))).alias("depth"))
        rho = 1.0
    left = F.greatest(
        F.lit(0.0),
        F.col("value") - rho * F.col("depth") * F.coalesce(F.col("share"), F.lit(0.0)),
    )
    return kept.join(depth, "cell").join(profile, "gene", "left").select(
        "cell", "gene", F.col("value").alias("observed"), (F.round(left) if to_int else left).alias("value")
    )
