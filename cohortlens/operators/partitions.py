"""Comparing and auditing partitions of the same cells."""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.levels import bounded_levels, canonicalise
from ..functions.ranks import attach, grouped_median
from ..session import materialise


def align_partitions(partitions: Mapping[str, DataFrame]) -> DataFrame:
    """Cells labelled by every partition: one column per partition.

    Inputs are ``(cell, label)``; missing labels do not count as membership.
    """
    out: DataFrame | None = None
    for name, df in partitions.items():
        clean = canonicalise(df.select("cell", "label"), "label").filter(F.col("label").isNotNull())
        part = clean.withColumnRenamed("label", name)
        out = part if out is None else out.join(part, "cell")
    if out is None:
        raise ValueError("no partitions")
    return out


def partition_coverage(partitions: Mapping[str, DataFrame]) -> DataFrame:
    """Labelled cells of each partition and how many of them every partition labels."""
    tagged = [
        canonicalise(df.select("cell", "label"), "label")
        .filter(F.col("label").isNotNull())
        .select("cell", F.lit(name).alias("partition"))
        for name, df in partitions.items()
    ]
    long = reduce(lambda a, b: a.unionByName(b), tagged).distinct()
    k = len(partitions)
    shared = long.groupBy("cell").agg(F.collect_set("partition").alias("p"))
    return (
        shared.select(F.explode("p").alias("partition"), (F.size("p") == k).alias("_all"))
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("n_cells"), F.count_if("_all").alias("n_shared"))
    )


def _expected_mi(a: np.ndarray, b: np.ndarray, n: float) -> float:
    """Expected mutual information of two label sets with fixed margins.

    The hypergeometric sum runs within 40 standard deviations of its mean, beyond which
    terms are below double precision.
    """
    lg = np.vectorize(math.lgamma, otypes=[float])
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    total = 0.0
    for x, kx in zip(ua, ca):
        for y, ky in zip(ub, cb):
            mean = x * y / n
            sd = math.sqrt(max(mean * (1 - x / n) * (n - y) / max(n - 1, 1), 1.0))
            lo = max(1.0, x + y - n, math.floor(mean - 40 * sd))
            hi = min(x, y, math.ceil(mean + 40 * sd))
            if hi < lo:
                continue
            k = np.arange(lo, hi + 1)
            ln = (
                math.lgamma(x + 1) + math.lgamma(y + 1) + math.lgamma(n - x + 1) + math.lgamma(n - y + 1)
                - math.lgamma(n + 1) - lg(k + 1) - lg(x - k + 1) - lg(y - k + 1) - lg(n - x - y + k + 1)
            )
            total += kx * ky * float((k / n * np.log(n * k / (x * y)) * np.exp(ln)).sum())
    return total


def partition_agreement(aligned: DataFrame, names: Sequence[str]) -> DataFrame:
    """ARI, AMI, mutual information and purities of every pair of partitions.

    Cells fold once into distinct label tuples; pairs of partitions are read off that
    table, whose size is the number of label combinations in use.
    """
    tuples = aligned.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    pairs = [
        F.struct(F.lit(x).alias("partition_a"), F.lit(y).alias("partition_b"), F.col(x).alias("a"), F.col(y).alias("b"))
        for x, y in itertools.combinations(names, 2)
    ]
    cross = materialise(
        tuples.select("n", F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.partition_a", "p.partition_b", "p.a", "p.b")
        .agg(F.sum("n").alias("n")),
        "crosstab",
    )
    key = ["partition_a", "partition_b"]

    def choose2(c: Column) -> Column:
        return c * (c - 1) / 2.0

    def entropy(c: Column) -> Column:
        return F.sum(c * F.log(c))

    cell = cross.groupBy(*key).agg(
        F.sum("n").cast("double").alias("n_cells"),
        F.sum(choose2(F.col("n"))).alias("s_ab"),
        entropy(F.col("n")).alias("e_ab"),
    )
    sides = []
    for side in ("a", "b"):
        m = cross.groupBy(*key, side).agg(F.sum("n").alias("n"), F.max("n").alias("top"))
        sides.append(
            m.groupBy(*key).agg(
                F.count(F.lit(1)).alias(f"n_{side}"),
                F.sum(choose2(F.col("n"))).alias(f"s_{side}"),
                entropy(F.col("n")).alias(f"e_{side}"),
                F.sum("top").alias(f"top_{side}"),
                F.collect_list(F.col("n").cast("double")).alias(f"m_{side}"),
            )
        )
    t = cell.join(sides[0], key).join(sides[1], key)
    n = F.col("n_cells")
    expected = F.col("s_a") * F.col("s_b") / choose2(n)
    top = (F.col("s_a") + F.col("s_b")) / 2
    h = {s: F.log(n) - F.col(f"e_{s}") / n for s in ("a", "b")}
    mi = (F.col("e_ab") - F.col("e_a") - F.col("e_b")) / n + F.log(n)
    t = t.withColumns(
        {
            "ari": F.when(top == expected, F.lit(1.0)).otherwise((F.col("s_ab") - expected) / (top - expected)),
            "mi": F.greatest(F.lit(0.0), mi),
            "_h": (h["a"] + h["b"]) / 2,
            "purity_a_in_b": F.col("top_a") / n,
            "purity_b_in_a": F.col("top_b") / n,
        }
    )

    def adjust(it):
        for pdf in it:
            out = []
            for a, b, size, got, mean_h in zip(pdf["m_a"], pdf["m_b"], pdf["n_cells"], pdf["mi"], pdf["_h"]):
                if len(a) == len(b) == 1:
                    out.append(1.0)
                    continue
                e = _expected_mi(np.asarray(a), np.asarray(b), float(size))
                d = mean_h - e
                out.append(float((got - e) / d) if abs(d) > 1e-15 else 1.0)
            yield pdf[cols].assign(ami=out)

    cols = [*key, "n_cells", "n_a", "n_b", "ari", "mi", "purity_a_in_b", "purity_b_in_a"]
    schema = (
        "partition_a string, partition_b string, n_cells double, n_a long, n_b long, ari double, mi double, "
        "purity_a_in_b double, purity_b_in_a double, ami double"
    )
    return t.mapInPandas(adjust, schema).withColumn("n_cells", F.col("n_cells").cast("long"))


def partition_crosstab(aligned: DataFrame, a: str, b: str) -> DataFrame:
    n = aligned.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        a,
        b,
        "n",
        (F.col("n") / F.sum("n").over(W.partitionBy(a))).alias("fraction_of_a"),
        (F.col("n") / F.sum("n").over(W.partitionBy(b))).alias("fraction_of_b"),
    )


def cluster_group_support(cells: DataFrame, cluster: str, group: str, min_cells: int) -> DataFrame:
    """Groups present in each cluster, those with enough cells, and the largest share."""
    n = cells.filter(F.col(cluster).isNotNull()).groupBy(cluster, group).agg(F.count(F.lit(1)).alias("n"))
    ok = F.col("n") >= min_cells
    return n.groupBy(cluster).agg(
        F.sum("n").alias("n_cells"),
        F.count(group).alias("n_groups"),
        F.count_if(ok & F.col(group).isNotNull()).alias("n_supporting"),
        (F.max("n") / F.sum("n")).alias("max_share"),
        F.array_join(F.sort_array(F.collect_list(F.when(ok, F.col(group)))), "; ").alias("supporting"),
    )


def label_composition(cells: DataFrame, cluster: str, condition: str) -> DataFrame:
    """Wide cluster × condition table with fractions both ways."""
    levels = bounded_levels(cells, condition)
    wide = cells.groupBy(cluster).pivot(condition, levels).count().fillna(0)
    totals = reduce(lambda x, y: x + y, [F.col(f"`{v}`") for v in levels])
    everything = W.partitionBy(F.lit(0))
    out = wide.select(
        cluster,
        totals.alias("n_cells"),
        *[F.col(f"`{v}`").alias(f"n_{v}") for v in levels],
        *[(F.col(f"`{v}`") / totals).alias(f"within_cluster_{v}") for v in levels],
    )
    return out.withColumns({f"of_{v}": F.col(f"n_{v}") / F.sum(f"n_{v}").over(everything) for v in levels})


def cluster_artifact_audit(
    cells: DataFrame,
    cluster: str,
    depth: str,
    confidence: str,
    lineage: str,
    library: str,
    condition: str,
    coords: Sequence[str] = (),
    collapse_ratio: float = 0.5,
    confidence_floor: float = 0.7,
    promiscuity: float = 0.25,
    dominance: float = 0.5,
    min_cells: int = 20,
) -> DataFrame:
    """Depth, confidence, lineage spread and library share of each cluster, with a verdict."""
    used = [cluster, depth, confidence, lineage, library, condition, *coords]
    base = materialise(cells.filter(F.col(cluster).isNotNull()).select(*used), "audit")
    atlas = grouped_median(base, [], depth, "_atlas")
    out = base.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_cells"))
    out = out.join(grouped_median(base, [cluster], depth, "median_complexity"), cluster, "left")
    out = out.join(grouped_median(base, [cluster], confidence, "median_confidence"), cluster, "left")
    out = attach(out, atlas, [])
    counts = base.filter(F.col(lineage).isNotNull()).groupBy(cluster, lineage).agg(F.count(F.lit(1)).alias("n"))
    n_lineages = counts.agg(F.count_distinct(lineage).alias("_all_lineages"))
    totals = counts.groupBy(cluster).agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    spread = counts.join(totals, cluster).groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_lineages"),
        (-F.sum(p * F.log(p))).alias("_h"),
        F.max_by(lineage, F.struct("n", F.col(lineage))).alias("modal_lineage"),
        F.max(p).alias("modal_lineage_frac"),
    )
    out = attach(out.join(spread, cluster, "left"), n_lineages, [])
    for col, name in ((library, "dominant_library"), (condition, "dominant_condition")):
        c = base.filter(F.col(col).isNotNull()).groupBy(cluster, col).agg(F.count(F.lit(1)).alias("n"))
        top = c.groupBy(cluster).agg(
            F.max_by(col, F.struct("n", F.col(col))).alias(name), (F.max("n") / F.sum("n")).alias(f"{name}_frac")
        )
        out = out.join(top, cluster, "left")
    entropy = F.when(F.col("_all_lineages") < 2, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.coalesce("_h", F.lit(0.0)) / F.log("_all_lineages"))
    )
    out = out.withColumns(
        {
            "complexity_ratio": F.col("median_complexity") / F.nullif(F.col("_atlas"), F.lit(0.0)),
            "lineage_entropy": entropy,
        }
    )
    flags = {
        "complexity_collapsed": F.col("complexity_ratio") < collapse_ratio,
        "confidence_collapsed": F.col("median_confidence") < confidence_floor,
        "lineage_promiscuous": F.col("lineage_entropy") > promiscuity,
        "library_dominated": F.col("dominant_library_frac") > dominance,
    }
    out = out.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    shallow, unsure, mixed, one = (F.col(k) for k in flags)
    verdict = (
        F.when(F.col("n_cells") < min_cells, "insufficient_cells")
        .when(shallow & unsure & mixed, "ambient_debris")
        .when(one & (shallow | unsure | mixed), "library_artifact")
        .when(unsure & mixed, "ambiguous_annotation")
        .when(shallow, "low_complexity")
        .when(mixed, "promiscuous")
        .when(unsure, "low_confidence")
        .when(one, "single_library")
        .otherwise("clean")
    )
    out = out.withColumns(
        {
            "n_marks": reduce(lambda a, b: a + b, [F.col(k).cast("int") for k in flags]),
            "verdict": verdict,
        }
    ).drop("_atlas", "_h", "_all_lineages")
    if coords:
        centre = None
        for i, c in enumerate(coords):
            m = grouped_median(base, [], c, f"_c{i}")
            centre = m if centre is None else attach(centre, m, [])
        dist = F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(c) - F.col(f"_c{i}"), F.lit(2.0)) for i, c in enumerate(coords)]))
        radius = materialise(
            grouped_median(attach(base, centre, []).withColumn("_r", dist), [cluster], "_r", "embedding_radius"), "radius"
        )
        w = W.partitionBy(F.lit(0))
        tied = W.partitionBy("embedding_radius")
        rank = (F.rank().over(w.orderBy("embedding_radius")) + (F.count(F.lit(1)).over(tied) - 1) / 2.0) / F.count(F.lit(1)).over(w)
        out = out.join(radius.withColumn("embedding_radius_rank_pct", rank), cluster, "left")
    return out


DEBRIS_VERDICTS = ("ambient_debris", "library_artifact")


def verify_debris(audit: DataFrame, declared: DataFrame, cluster: str, strict: bool = True) -> DataFrame:
    """Declared debris clusters against the audit, one row per declared or audited-debris cluster."""
    d = declared.select(F.col(cluster), F.lit(True).alias("declared"))
    if strict:
        unknown = d.join(audit.select(cluster), cluster, "left_anti").limit(5).collect()
        if unknown:
            raise ValueError(f"declared clusters absent from the partition: {[x[0] for x in unknown]}")
    a = audit.select(cluster, "n_cells", "verdict", F.col("verdict").isin(*DEBRIS_VERDICTS).alias("audited"))
    return (
        a.join(d, cluster, "full")
        .fillna(False, ["declared", "audited"])
        .filter(F.col("declared") | F.col("audited"))
        .withColumn("agrees", F.col("declared") == F.col("audited"))
    )


def triage_populations(
    cells: DataFrame, label: str, donor: str, condition: str, reference: str | None = None,
    min_cells: int = 20, min_donors: int = 3, donor_veto: float = 0.8,
) -> DataFrame:
    base = cells.filter(F.col(label).isNotNull())
    per_condition = cells.groupBy(condition).agg(F.count(F.lit(1)).alias("n"))
    if reference is None:
        ref = per_condition.agg(F.max_by(condition, F.struct("n", F.col(condition))).alias("_ref"))
    else:
        ref = per_condition.agg(F.lit(reference).alias("_ref"))
    share = attach(per_condition, ref, []).agg(
        (F.sum(F.when(F.col(condition) == F.col("_ref"), F.col("n")).otherwise(0)) / F.sum("n")).alias("_overall"),
        F.first("_ref").alias("_ref"),
    )
    n = base.groupBy(label, donor, condition).agg(F.count(F.lit(1)).alias("n"))
    donors = n.groupBy(label, donor).agg(F.sum("n").alias("n")).groupBy(label).agg(
        F.sum("n").alias("n_cells"),
        F.count(donor).alias("n_donors"),
        (F.max("n") / F.sum("n")).alias("dominant_donor_frac"),
    )
    enriched = attach(n, share, []).groupBy(label).agg(
        (F.sum(F.when(F.col(condition) == F.col("_ref"), F.col("n")).otherwise(0)) / F.sum("n") - F.first("_overall")).alias("condition_enrichment")
    )
    return donors.join(enriched, label).withColumn(
        "category",
        F.when((F.col("n_cells") < min_cells) | (F.col("n_donors") < min_donors), "noise")
        .when(F.col("dominant_donor_frac") >= donor_veto, "single_donor_artifact")
        .otherwise("candidate"),
    )


def cell_cycle_phase(s: Column, g2m: Column) -> Column:
    return F.when((s <= 0) & (g2m <= 0), "G1").when(s > g2m, "S").otherwise("G2M")
