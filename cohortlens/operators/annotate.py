"""Labels: votes, consensus, cluster and population verdicts, marker statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.levels import MISSING_LABELS, bounded_levels, level_grid, with_levels
from ..functions.ranks import attach
from ..session import materialise
from .programs import gene_bins

UNASSIGNED = "Unassigned"


def passthrough_label(cells: DataFrame, source: str, target: str, aliases: Mapping[str, str] | None = None) -> DataFrame:
    text = F.col(source).cast("string")
    if aliases:
        table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        text = F.coalesce(F.try_element_at(table, text), text)
    return cells.withColumn(target, text)


def cluster_gene_means(layer: DataFrame, cells: DataFrame, cluster: str) -> DataFrame:
    """Mean of each gene over all cells of each cluster; absent pairs are zero and have no row."""
    sizes = cells.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_cells"))
    sums = layer.join(cells.select("cell", cluster), "cell").groupBy(cluster, "gene").agg(F.sum("value").alias("s"))
    return sums.join(sizes, cluster).select(cluster, "gene", (F.col("s") / F.col("n_cells")).alias("mean"), "n_cells")


def marker_scores(layer: DataFrame, cells: DataFrame, cluster: str, panels: DataFrame, n_bins: int = 25, n_controls: int = 50, seed: int = 0) -> DataFrame:
    """Mean panel score of each cluster.

    A cell's score is a difference of gene means, so its cluster average is the same
    difference of cluster-mean expression; cells are folded once to cluster × gene.
    """
    from .programs import control_genes

    means = materialise(cluster_gene_means(layer, cells, cluster), "means")
    bins = gene_bins(layer, cells, n_bins)
    controls = control_genes(panels, bins, n_controls, seed)
    weights = signed_weights(panels, bins, controls)
    n_panel = weights.select("source").distinct()
    grid = with_levels(n_panel, cluster, bounded_levels(cells, cluster))
    part = weights.withColumnRenamed("target", "gene").join(means, "gene").groupBy("source", cluster).agg(
        F.sum(F.col("weight") * F.col("mean")).alias("score")
    )
    return grid.join(part, ["source", cluster], "left").fillna(0.0, ["score"])


def signed_weights(panels: DataFrame, bins: DataFrame, controls: DataFrame) -> DataFrame:
    """+1/size for panel genes and -1/size for control genes."""
    inside = panels.select("source", "target").distinct().join(
        bins.select(F.col("gene").alias("target")), "target", "left_semi"
    )
    sides = []
    for df, sign in ((inside, 1.0), (controls, -1.0)):
        size = df.groupBy("source").agg(F.count(F.lit(1)).alias("_k"))
        sides.append(df.join(size, "source").select("source", "target", (F.lit(sign) / F.col("_k")).alias("weight")))
    return sides[0].unionByName(sides[1])


def panel_support(panels: DataFrame, genes: DataFrame) -> DataFrame:
    """``source, n_targets, n_present, usable``: how many genes of each panel were measured; panels without any cannot be voted for."""
    own = panels.select("source", "target").distinct()
    have = own.join(genes.select(F.col("gene").alias("target"), F.lit(1).alias("_in")).distinct(), "target", "left")
    return have.groupBy("source").agg(F.count(F.lit(1)).alias("n_targets"), F.count("_in").alias("n_present")).withColumn("usable", F.col("n_present") > 0)


def marker_vote(
    layer: DataFrame, cells: DataFrame, cluster: str, panels: DataFrame,
    n_perm: int = 100, alpha: float = 0.05, seed: int = 0, n_bins: int = 25,
) -> DataFrame:
    """Best panel of each cluster among those beating random panels of the same size."""
    scores = materialise(marker_scores(layer, cells, cluster, panels, n_bins=n_bins, seed=seed), "scores")
    bins = materialise(gene_bins(layer, cells, n_bins), "bins")
    genes = bins.select("gene")
    present = panels.select("source", F.col("target").alias("gene")).distinct().join(genes, "gene", "left_semi")
    sizes = materialise(present.groupBy("source").agg(F.count(F.lit(1)).alias("k")), "sizes")
    ks = [x[0] for x in sizes.select("k").distinct().collect()]
    # one random order of the genome per permutation serves every panel size
    order = W.partitionBy("perm").orderBy(F.xxhash64(F.lit(seed), F.col("perm"), F.col("gene")), "gene")
    drawn = (
        genes.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(n_perm))))
        .withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") <= max(ks))
    )
    random_panels = reduce(
        lambda a, b: a.unionByName(b),
        [
            drawn.filter(F.col("rn") <= k).select(F.concat_ws(":", F.lit(k).cast("string"), "perm").alias("source"), F.col("gene").alias("target"))
            for k in ks
        ],
    )
    null = marker_scores(layer, cells, cluster, random_panels, n_bins=n_bins, seed=seed).select(
        cluster, F.split("source", ":")[0].cast("long").alias("k"), F.col("score").alias("null")
    )
    joined = scores.join(sizes, "source").join(null, [cluster, "k"], "left")
    tested = joined.groupBy(cluster, "source", "score").agg(
        ((F.count_if(F.col("null") >= F.col("score")) + 1) / (F.count("null") + 1)).alias("p")
    )
    best = tested.groupBy(cluster).agg(
        F.max_by("source", F.when(F.col("p") < alpha, F.struct("score", "source"))).alias("label"),
        F.max(F.when(F.col("p") < alpha, F.col("score"))).alias("score"),
    )
    return best.withColumn("label", F.when(F.col("score").isNotNull(), F.col("label")).otherwise(UNASSIGNED))


def consensus_labels(
    cells: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None,
    min_agree: float = 0.5, high_needs_all: bool = True, out: str = "cell_type",
) -> DataFrame:
    """Winner of per-cell votes with tier and review flag; ties go to the first column."""
    table = F.create_map(*[F.lit(x) for kv in (aliases or {"": ""}).items() for x in kv])
    votes = []
    for c in columns:
        text = F.col(c).cast("string")
        text = F.when(text.isin(*MISSING_LABELS, "NaN"), F.lit(None)).otherwise(text)
        votes.append(F.coalesce(F.try_element_at(table, text), text))
    df = cells.withColumn("_votes", F.array_compact(F.array(*votes)))
    ranked = F.transform(
        F.array_distinct("_votes"),
        lambda v: F.struct(
            F.size(F.filter("_votes", lambda x: x == v)).alias("n"),
            (-F.array_position("_votes", v)).alias("first"),
            v.alias("label"),
        ),
    )
    df = df.withColumn("_ranked", ranked).withColumn("_top", F.array_max("_ranked"))
    n = F.size("_votes")
    leaders = F.size(F.filter("_ranked", lambda x: x["n"] == F.col("_top.n")))
    enough = n >= 2
    high = enough & F.lit(high_needs_all) & (F.col("_top.n") == n)
    medium = enough & (F.col("_top.n") / n >= min_agree) & (leaders == 1)
    tier = F.when(high, "high").when(medium, "medium").otherwise("low")
    return (
        df.withColumn(out, F.col("_top.label"))
        .withColumn("annotation_confidence", F.coalesce(tier, F.lit("low")))
        .withColumn("needs_review", F.col("annotation_confidence") == "low")
        .drop("_votes", "_ranked", "_top")
    )


def _shares(cells: DataFrame, key: str, column: str) -> DataFrame:
    n = cells.groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(key).agg(
        F.count(column).alias(f"n_{column}s"),
        F.max_by(column, F.struct("n", F.col(column))).alias(f"dominant_{column}"),
        (F.max("n") / F.sum("n")).alias(f"dominant_{column}_fraction"),
    )


def cluster_evidence(
    cells: DataFrame, cluster: str, donor: str, condition: str,
    marker: str | None = None, qc_state: str | None = None,
) -> DataFrame:
    """Counts, dominant shares, marker support and technical fraction of each cluster.

    Value counts are maps over donors and conditions, whose vocabularies are bounded.
    """
    aggs = [F.count(F.lit(1)).alias("n_cells")]
    aggs.append((F.avg(marker) if marker else F.lit(None).cast("double")).alias("marker_support") if marker else F.first(F.lit(None).cast("double")).alias("marker_support"))
    if qc_state:
        aggs.append(F.avg(F.col(qc_state).isin("quarantine", "unresolved_borderline").cast("double")).alias("technical_score"))
    else:
        aggs.append(F.first(F.lit(None).cast("double")).alias("technical_score"))
    out = cells.groupBy(cluster).agg(*aggs)
    for col, name in ((donor, "donor"), (condition, "condition")):
        n = cells.groupBy(cluster, F.col(col).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        part = n.groupBy(cluster).agg(
            F.count("v").alias(f"n_{name}s"),
            (F.max("n") / F.sum("n")).alias(f"dominant_{name}_fraction"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("v", "n")))).alias(f"{name}_counts"),
        )
        out = out.join(part, cluster, "left")
    return out


# Thresholds of the cluster verdict.
RULES = dict(
    min_cells=30, min_replicated_donors=3, donor_dominance_veto=0.8, condition_restriction_fraction=0.9,
    technical_veto_score=0.75, continuity_score=0.7, split_support_min=0.6, marker_support_min=0.5, reproducibility_min=0.6,
)


def adjudicate_clusters(evidence: DataFrame, **overrides: float) -> DataFrame:
    """Taxonomy class and confidence by the first rule that applies, with evidence items."""
    k = {**RULES, **overrides}

    def col(name: str) -> Column:
        return F.col(name) if name in evidence.columns else F.lit(None).cast("double")

    def at_least(name: str, bar: str) -> Column:
        return F.coalesce(col(name) >= k[bar], F.lit(False))

    def unit(c: Column) -> Column:
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(c, F.lit(0.0))))

    replicated = F.col("n_donors") >= k["min_replicated_donors"]
    few = F.col("n_cells") < k["min_cells"]
    technical = at_least("technical_score", "technical_veto_score")
    one_donor = F.col("dominant_donor_fraction") >= k["donor_dominance_veto"]
    one_condition = (F.col("dominant_condition_fraction") >= k["condition_restriction_fraction"]) & replicated
    continuous = at_least("continuity_score", "continuity_score")
    reproducible = replicated & at_least("reproducibility_score", "reproducibility_min") & at_least("split_support", "split_support_min")
    rare = replicated & at_least("marker_support", "marker_support_min")
    strongest = F.greatest(F.coalesce(col("reproducibility_score"), F.lit(0.0)), F.coalesce(col("split_support"), F.lit(0.0)))
    ladder = [
        (few, "unsupported_split", F.lit(0.2)),
        (technical, "technical_population", unit(col("technical_score"))),
        (one_donor, "donor_restricted_population", F.col("dominant_donor_fraction")),
        (one_condition, "condition_restricted_state", F.col("dominant_condition_fraction")),
        (continuous, "continuous_program", unit(col("continuity_score"))),
        (reproducible, "reproducible_state", F.least(F.lit(1.0), strongest + unit(col("marker_support")) * 0.1)),
        (rare, "rare_replicated_population", F.greatest(F.lit(0.4), unit(col("marker_support")))),
    ]
    verdict, confidence = F.lit("ambiguous_population"), F.lit(0.3)
    for test, name, value in reversed(ladder):
        verdict = F.when(test, name).otherwise(verdict)
        confidence = F.when(test, value).otherwise(confidence)

    def item(name: str, value: Column, polarity: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), polarity.alias("polarity"))

    items = [
        item("n_cells", F.col("n_cells"), F.when(few, "vetoes").otherwise("supports")),
        item("n_donors", F.col("n_donors"), F.when(replicated, "supports").otherwise("weakens")),
        item("dominant_donor_fraction", F.col("dominant_donor_fraction"), F.when(one_donor, "vetoes").otherwise("context")),
        item(
            "dominant_condition_fraction", F.col("dominant_condition_fraction"),
            F.when(F.col("dominant_condition_fraction") >= k["condition_restriction_fraction"], "supports").otherwise("context"),
        ),
    ]
    for name, bar, veto in (
        ("marker_support", "marker_support_min", False),
        ("reproducibility_score", "reproducibility_min", False),
        ("technical_score", "technical_veto_score", True),
        ("continuity_score", "continuity_score", False),
        ("split_support", "split_support_min", False),
    ):
        if name in evidence.columns:
            reached = at_least(name, bar)
            polarity = F.when(reached, "vetoes" if veto else "supports").otherwise("context" if veto else "weakens")
            items.append(F.when(F.col(name).isNotNull(), item(name, F.col(name), polarity)))
    return evidence.withColumns(
        {"taxonomy_class": verdict, "confidence": confidence, "evidence_items": F.array_compact(F.array(*items))}
    ).withColumn("n_vetoes", F.size(F.filter("evidence_items", lambda x: x["polarity"] == "vetoes")))


def population_summary(
    cells: DataFrame, key: str, sample: str, donor: str, condition: str, qc_state: str, doublet: str,
    confidence: str | None = None, entropy: str | None = None, source: str = "annotation",
    min_cells: int = 20, min_samples: int = 2, min_donors: int = 2, max_donor: float = 0.8,
    max_qc_fail: float = 0.3, max_doublet: float = 0.2, min_confidence: float = 0.5, max_entropy: float | None = None,
) -> DataFrame:
    """Size, diversity, QC load and evidence status of each population."""
    failed = F.col(qc_state).isin("quarantine", "unresolved_borderline").cast("double")
    aggs = [
        F.count(F.lit(1)).alias("n_cells"),
        F.avg(failed).alias("qc_fail_fraction"),
        F.avg(F.coalesce(F.col(doublet), F.lit(False)).cast("double")).alias("doublet_fraction"),
        (F.avg(confidence) if confidence else F.first(F.lit(None).cast("double"))).alias("mean_confidence"),
        (F.avg(entropy) if entropy else F.first(F.lit(None).cast("double"))).alias("mean_entropy"),
    ]
    out = cells.groupBy(key).agg(*aggs)
    for col, name in ((sample, "sample"), (donor, "donor"), (condition, "condition")):
        n = cells.groupBy(key, F.col(col).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        part = n.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"n_{name}s"),
            F.max_by("v", F.struct("n", "v")).alias(f"dominant_{name}"),
            (F.max("n") / F.sum("n")).alias(f"dominant_{name}_fraction"),
        )
        out = out.join(part, key, "left")
    total = cells.agg(F.count(F.lit(1)).alias("_all"))
    supported = {
        "reference": "atlas_supported_state",
        "annotation": "annotation_supported_state",
        "configured": "configured_candidate",
    }.get(source, "cluster_native_candidate")
    vague = F.lit(False) if max_entropy is None else F.coalesce(F.col("mean_entropy") > max_entropy, F.lit(False))
    status = (
        F.when((F.col("qc_fail_fraction") > max_qc_fail) | (F.col("doublet_fraction") > max_doublet), "technical_or_qc_suspect")
        .when((F.col("n_cells") < min_cells) | (F.col("n_samples") < min_samples), "underpowered_rare_population")
        .when((F.col("n_donors") < min_donors) | (F.col("dominant_donor_fraction") > max_donor), "donor_restricted_candidate")
        .when(F.coalesce(F.col("mean_confidence") < min_confidence, F.lit(False)) | vague, "low_confidence_candidate")
        .otherwise(supported)
    )
    return attach(out, total, []).withColumns(
        {"fraction_cells": F.col("n_cells") / F.col("_all"), "evidence_status": status}
    ).drop("_all")


def crosstab_long(cells: DataFrame, row: str, col: str) -> DataFrame:
    """Row × column counts with empty cells, and the fraction within each row."""
    n = cells.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    out = level_grid(cells, row, col).join(n, [row, col], "left").fillna(0, ["n"])
    return out.withColumn("fraction", F.col("n") / F.sum("n").over(W.partitionBy(row)))


def top_two(probs: DataFrame) -> DataFrame:
    """Two most probable labels of each cell; ties by the larger label name."""
    order = W.partitionBy("cell").orderBy(F.col("prob").desc(), F.col("label").desc())
    ranked = probs.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= 2)
    pick = lambda k, c: F.max(F.when(F.col("_r") == k, F.col(c)))
    out = ranked.groupBy("cell").agg(
        pick(1, "label").alias("top_label"), pick(1, "prob").alias("top_prob"),
        pick(2, "label").alias("second_label"), pick(2, "prob").alias("second_prob"),
    )
    return out.withColumn("second_label", F.coalesce("second_label", "top_label")).withColumn(
        "second_prob", F.coalesce("second_prob", "top_prob")
    )


def ambiguous(top: DataFrame, floor: float = 0.5) -> DataFrame:
    return top.withColumn("ambiguous", F.col("top_prob") < floor)


def reassembly_candidates(probs: DataFrame, coarse: DataFrame, assigned: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Coarse groups whose summed probability exceeds the bar in cells assigned elsewhere."""
    summed = probs.join(coarse, "label").groupBy("cell", "coarse").agg(F.sum("prob").alias("candidate_prob"))
    return (
        summed.filter(F.col("candidate_prob") > threshold)
        .join(assigned, "cell", "left")
        .filter(F.coalesce(F.col("assigned") != F.col("coarse"), F.lit(True)))
        .select("cell", F.col("coarse").alias("candidate_group"), "candidate_prob", F.col("assigned").alias("assigned_group"))
    )


def blob_composition(cells: DataFrame, mask: str, label: str) -> DataFrame:
    n = cells.filter(F.col(mask) & F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("_t"))
    return attach(n, total, []).select(label, (F.col("n") / F.col("_t")).alias("fraction"))


def blob_metrics(cells: DataFrame, mask: str, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x"), F.col(mask).alias("m")) for c in columns]
    return (
        cells.select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.metric")
        .agg(
            F.avg(F.when(F.col("p.m"), F.col("p.x"))).alias("blob_mean"),
            F.avg(F.when(~F.col("p.m"), F.col("p.x"))).alias("rest_mean"),
        )
    )


def label_entropy(probs: DataFrame, n_labels: int) -> DataFrame:
    """Entropy of each cell's label probabilities, normalised to [0, 1]."""
    p = F.col("prob")
    return probs.filter(p > 0).groupBy("cell").agg(
        (-F.sum(p * F.log(p)) / F.log(F.lit(float(n_labels)))).alias("label_entropy")
    )


def marker_panel_stats(layer: DataFrame, panel: DataFrame, cells: DataFrame, group: str) -> DataFrame:
    """Mean and percent detected per group and marker, over all cells of the group."""
    sizes = cells.groupBy(group).agg(F.count(F.lit(1)).alias("n_cells"))
    sums = (
        layer.join(panel.select("gene").distinct(), "gene", "left_semi")
        .join(cells.select("cell", group), "cell")
        .groupBy(group, "gene")
        .agg(F.sum("value").alias("s"), F.count_if(F.col("value") > 0).alias("k"))
    )
    grid = with_levels(panel.select("gene").distinct(), group, bounded_levels(cells, group))
    return grid.join(sizes, group).join(sums, [group, "gene"], "left").select(
        group,
        "gene",
        (F.coalesce("s", F.lit(0.0)) / F.col("n_cells")).alias("mean"),
        (100.0 * F.coalesce("k", F.lit(0)) / F.col("n_cells")).alias("pct_detected"),
    )


def ambient_gene_mask(profile: DataFrame, group: str, target: str, ratio: float = 0.25, group_map: Mapping[str, str] | None = None) -> DataFrame:
    """Genes kept for a target group: dropped when the peak is foreign and the target holds under ``ratio`` of it."""

    def resolve(c: Column) -> Column:
        if not group_map:
            return c
        table = F.create_map(*[F.lit(x) for kv in group_map.items() for x in kv])
        return F.coalesce(F.try_element_at(table, c), c)

    per = profile.groupBy("gene").agg(
        F.max_by(group, F.struct("mean", F.col(group))).alias("peak_group"),
        F.max("mean").alias("peak"),
        F.coalesce(F.max(F.when(F.col(group) == target, F.col("mean"))), F.lit(0.0)).alias("own"),
    )
    foreign = resolve(F.col("peak_group")) != resolve(F.lit(target))
    drop = foreign & F.coalesce(F.col("own") / F.nullif(F.col("peak"), F.lit(0.0)) < ratio, F.lit(False))
    return per.select("gene", "peak_group", (~drop).alias("keep"))


def ambient_gene_masks(profile: DataFrame, group: str, ratio: float = 0.25) -> DataFrame:
    """The mask of every group at once: ``(group, gene, keep)`` for genes seen in the profile."""
    peaks = profile.groupBy("gene").agg(
        F.max_by(group, F.struct("mean", F.col(group))).alias("peak_group"), F.max("mean").alias("peak")
    )
    grid = with_levels(peaks, group, bounded_levels(profile, group))
    joined = grid.join(profile, [group, "gene"], "left")
    low = F.coalesce(F.coalesce("mean", F.lit(0.0)) / F.nullif(F.col("peak"), F.lit(0.0)) < ratio, F.lit(False))
    return joined.select(group, "gene", (~((F.col("peak_group") != F.col(group)) & low)).alias("keep"))


def panel_scores_before_after(
    layer: DataFrame, cells: DataFrame, group: str, profile: DataFrame, panel: DataFrame, home: Sequence[str], ratio: float = 0.25
) -> DataFrame:
    """Panel mean per cell before and after dropping ambient genes outside the home groups."""
    genes = panel.select("gene").distinct()
    masks = materialise(
        ambient_gene_masks(profile.join(genes, "gene", "left_semi"), group, ratio).withColumn(
            "keep", F.col("keep") | F.col(group).isin(*home)
        ),
        "masks",
    )
    size = genes.agg(F.count(F.lit(1)).alias("_all"))
    dropped = masks.groupBy(group).agg(F.count_if(~F.col("keep")).alias("_gone"))
    values = (
        layer.join(genes, "gene", "left_semi")
        .join(cells.select("cell", group), "cell")
        .join(masks, [group, "gene"], "left")
        .groupBy("cell")
        .agg(F.sum("value").alias("_b"), F.sum(F.when(F.coalesce("keep", F.lit(True)), F.col("value"))).alias("_a"))
    )
    out = attach(cells.select("cell", group).join(values, "cell", "left").join(dropped, group, "left"), size, [])
    left = F.col("_all") - F.coalesce("_gone", F.lit(0))
    return out.select(
        "cell",
        group,
        (F.coalesce("_b", F.lit(0.0)) / F.col("_all")).alias("before"),
        F.when(left > 0, F.coalesce("_a", F.lit(0.0)) / left).otherwise(0.0).alias("after"),
    )


def evaluate_labels(pred: DataFrame, truth: str, label: str, by: Sequence[str] = (), unassigned: str = UNASSIGNED) -> DataFrame:
    """Recall and precision per class; unassigned cells stay in the recall denominator."""
    by = list(by)
    n = pred.groupBy(*by, truth, label).agg(F.count(F.lit(1)).alias("n"))
    n = materialise(n, "confusion")
    rec = n.groupBy(*by, F.col(truth).alias("class")).agg(
        F.sum("n").alias("n_truth"),
        F.sum(F.when(F.col(label) == F.col(truth), F.col("n")).otherwise(0)).alias("n_correct"),
    )
    pre = n.filter(F.col(label) != unassigned).groupBy(*by, F.col(label).alias("class")).agg(F.sum("n").alias("n_predicted"))
    return rec.join(pre, [*by, "class"], "full").fillna(0, ["n_truth", "n_correct", "n_predicted"]).withColumns(
        {
            "recall": F.col("n_correct") / F.nullif(F.col("n_truth"), F.lit(0)),
            "precision": F.col("n_correct") / F.nullif(F.col("n_predicted"), F.lit(0)),
        }
    )


def confusion_table(pred: DataFrame, truth: str, label: str) -> DataFrame:
    n = pred.groupBy(truth, label).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("fraction_of_truth", F.col("n") / F.sum("n").over(W.partitionBy(truth)))
