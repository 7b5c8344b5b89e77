"""Communication between cell types: ligand–receptor tables and their networks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.levels import bounded_levels, with_levels
from ..functions.ranks import attach, average_rank, value_ranks
from ..session import cut_lineage, materialise

CANONICAL = ("source", "target", "ligand", "receptor", "weight", "sample")
DAMPING = 0.85


def type_gene_stats(layer: DataFrame, cells: DataFrame, sample: str, cell_type: str, genes: DataFrame, min_cells: int = 5) -> DataFrame:
    """Mean and fraction expressing per sample, type and gene of interest; thin types are left out."""
    sizes = cells.groupBy(sample, cell_type).agg(F.count(F.lit(1)).alias("n_cells")).filter(F.col("n_cells") >= min_cells)
    return (
        layer.join(genes.select("gene").distinct(), "gene", "left_semi")
        .join(cells.select("cell", sample, cell_type), "cell")
        .groupBy(sample, cell_type, "gene")
        .agg(F.sum("value").alias("s"), F.count_if(F.col("value") > 0).alias("k"))
        .join(sizes, [sample, cell_type])
        .select(sample, cell_type, "gene", (F.col("s") / F.col("n_cells")).alias("mean"), (F.col("k") / F.col("n_cells")).alias("fraction"), "n_cells")
    )


def lr_scores(
    layer: DataFrame, cells: DataFrame, resource: DataFrame, sample: str, cell_type: str,
    expr_prop: float = 0.1, min_cells: int = 5,
) -> DataFrame:
    """Ligand–receptor scores per sample and pair of types.

    ``resource`` has ``ligand`` and ``receptor``; subunits of a complex are joined by
    ``_`` and a complex takes its least expressed subunit.  Scores are the product of
    means, the mean log2 fold change against the other types, and their aggregated rank.
    """
    sides = resource.select(F.col("ligand").alias("complex")).unionByName(resource.select(F.col("receptor").alias("complex"))).distinct()
    parts = sides.select("complex", F.size(F.split("complex", "_")).alias("_k"), F.explode(F.split("complex", "_")).alias("gene"))
    stats = type_gene_stats(layer, cells, sample, cell_type, parts, min_cells)
    whole = stats.groupBy(sample, "gene").agg(
        F.sum(F.col("mean") * F.col("n_cells")).alias("_tot")
    )
    sizes = cells.groupBy(sample, cell_type).agg(F.count(F.lit(1)).alias("n_cells")).filter(F.col("n_cells") >= min_cells).groupBy(sample).agg(F.sum("n_cells").alias("_n"))
    other = (F.col("_tot") - F.col("mean") * F.col("n_cells")) / F.nullif(F.col("_n") - F.col("n_cells"), F.lit(0))
    fold = stats.join(whole, [sample, "gene"]).join(sizes, sample).withColumn(
        "log2fc", F.log2(F.col("mean") + 1e-9) - F.log2(F.coalesce(other, F.lit(0.0)) + 1e-9)
    )
    units = (
        fold.join(parts, "gene")
        .groupBy(sample, cell_type, "complex", "_k")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("mean").alias("mean"), F.min("fraction").alias("fraction"), F.min("log2fc").alias("log2fc"))
        .filter((F.col("_n") == F.col("_k")) & (F.col("fraction") >= expr_prop))
    )
    units = materialise(units.select(sample, cell_type, "complex", "mean", "fraction", "log2fc"), "complexes")

    def side(name: str, who: str) -> DataFrame:
        return units.select(
            F.col(sample), F.col(cell_type).alias(who), F.col("complex").alias(name),
            F.col("mean").alias(f"{name}_mean"), F.col("fraction").alias(f"{name}_fraction"), F.col("log2fc").alias(f"{name}_log2fc"),
        )

    out = (
        resource.select("ligand", "receptor").distinct()
        .join(side("ligand", "source"), "ligand")
        .join(side("receptor", "target"), [sample, "receptor"])
        .withColumn("magnitude", F.col("ligand_mean") * F.col("receptor_mean"))
        .withColumn("specificity", (F.col("ligand_log2fc") + F.col("receptor_log2fc")) / 2)
    )
    return out.select(sample, "source", "target", "ligand", "receptor", "ligand_mean", "receptor_mean", "ligand_fraction", "receptor_fraction", "magnitude", "specificity")


def rank_aggregate(scores: DataFrame, sample: str) -> DataFrame:
    """``magnitude_rank`` in (0, 1]: mean of the two scores' descending average ranks, small is strong."""
    base = materialise(scores, "lr")
    out = base
    for c in ("magnitude", "specificity"):
        r = value_ranks(base.withColumn("_neg", -F.col(c)), [sample], "_neg").select(
            sample, (-F.col("_neg")).alias(c), (average_rank() / F.col("total")).alias(f"_{c}_rank")
        )
        out = out.join(r, [sample, c])
    return out.withColumn("magnitude_rank", (F.col("_magnitude_rank") + F.col("_specificity_rank")) / 2).drop("_magnitude_rank", "_specificity_rank")


def lr_to_canonical(lr: DataFrame, sample: str = "sample") -> DataFrame:
    missing = {"source", "target", "ligand", "receptor", "magnitude_rank"} - set(lr.columns)
    if missing:
        raise ValueError(f"ligand–receptor table lacks {sorted(missing)}")
    return lr.select(
        "source", "target", "ligand", "receptor", (1.0 - F.col("magnitude_rank")).alias("weight"), F.col(sample).alias("sample")
    ).na.drop()


def receiver_genes(de: DataFrame, fdr: float = 0.05, top: int = 200, direction: str = "up") -> DataFrame:
    """Receiver gene set: significant genes of one direction, the strongest ``top``."""
    sign = F.col("logFC") > 0 if direction == "up" else F.col("logFC") < 0
    order = W.partitionBy(F.lit(0)).orderBy(F.abs("logFC").desc(), "gene")
    return de.filter((F.col("fdr") < fdr) & sign).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= top).select("gene")


def expressed_genes(counts: DataFrame, cells: DataFrame, group: str, prop: float = 0.1) -> DataFrame:
    """``group, gene, fraction``: genes that at least ``prop`` of a group's cells have a count of."""
    sizes = cells.groupBy(F.col(group).alias("group")).agg(F.count(F.lit(1)).alias("_n"))
    have = counts.filter("value > 0").join(cells.select("cell", F.col(group).alias("group")), "cell").groupBy("group", "gene").agg(F.count(F.lit(1)).alias("_m"))
    return have.join(sizes, "group").select("group", "gene", (F.col("_m") / F.col("_n")).alias("fraction")).filter(F.col("fraction") >= prop)


def potential_ligands(pairs: DataFrame, expressed: DataFrame, senders: Sequence[str], receiver: str) -> DataFrame:
    """``ligand``: ligands some sender expresses that have a receptor the receiver expresses.

    ``pairs`` is ``(ligand, receptor)``, ``expressed`` comes from ``expressed_genes``. The result is what
    ``ligand_activity`` takes as ``ligands``; with no ligand left it is empty.
    """
    sent = expressed.filter(F.col("group").isin(list(senders))).select(F.col("gene").alias("ligand")).distinct()
    met = expressed.filter(F.col("group") == receiver).select(F.col("gene").alias("receptor"))
    return pairs.join(sent, "ligand", "left_semi").join(met, "receptor", "left_semi").select("ligand").distinct()


def ligand_activity(targets: DataFrame, genes: DataFrame, background: DataFrame, ligands: DataFrame | None = None) -> DataFrame:
    """Pearson and AUPR of each ligand's target weights against membership in the receiver set.

    ``targets`` is ``(ligand, gene, weight)``; absent weights are zero.  Genes of equal
    weight enter the precision–recall curve together.
    """
    bg = background.select("gene").distinct()
    pos = genes.select("gene").distinct().join(bg, "gene", "left_semi")
    t = targets.join(bg, "gene", "left_semi").filter(F.col("weight") > 0)
    if ligands is not None:
        t = t.join(ligands.select("ligand").distinct(), "ligand", "left_semi")
    n = bg.agg(F.count(F.lit(1)).cast("double").alias("n"))
    k = pos.agg(F.count(F.lit(1)).cast("double").alias("k"))
    flagged = t.join(pos.withColumn("_y", F.lit(1)), "gene", "left").fillna(0, ["_y"])
    sums = attach(attach(flagged.groupBy("ligand").agg(
        F.sum("weight").alias("sx"), F.sum(F.col("weight") * F.col("weight")).alias("sxx"),
        F.sum(F.when(F.col("_y") == 1, F.col("weight")).otherwise(0.0)).alias("sxy"),
        F.sum("_y").alias("hit"),
    ), n, []), k, [])
    cov = F.col("sxy") - F.col("sx") * F.col("k") / F.col("n")
    var = (F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) * (F.col("k") - F.col("k") * F.col("k") / F.col("n"))
    pearson = sums.select("ligand", (cov / F.sqrt(F.nullif(var, F.lit(0.0)))).alias("pearson"), "hit", "n", "k")
    step = flagged.groupBy("ligand", "weight").agg(F.count(F.lit(1)).alias("m"), F.sum("_y").alias("p"))
    down = W.partitionBy("ligand").orderBy(F.col("weight").desc()).rowsBetween(W.unboundedPreceding, 0)
    curve = step.withColumn("tp", F.sum("p").over(down)).withColumn("all", F.sum("m").over(down))
    area = curve.groupBy("ligand").agg(F.sum(F.col("p") * F.col("tp") / F.col("all")).alias("_a"))
    # the remaining positives have weight zero and enter at the last step together
    rest = (F.col("k") - F.col("hit")) * F.col("k") / F.col("n")
    return pearson.join(area, "ligand").select("ligand", "pearson", ((F.col("_a") + rest) / F.col("k")).alias("aupr"))


def top_targets(targets: DataFrame, genes: DataFrame, n: int = 50) -> DataFrame:
    order = W.partitionBy("ligand").orderBy(F.col("weight").desc(), "gene")
    return targets.join(genes, "gene", "left_semi").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def attribute_senders(lr: DataFrame, expressing: DataFrame, pooled: str) -> DataFrame:
    """One row per sender expressing the ligand in place of a pooled sender label."""
    hit = lr.filter(F.col("source") == pooled).drop("source").join(expressing.select("ligand", F.col("sender").alias("source")).distinct(), "ligand")
    return lr.filter(F.col("source") != pooled).unionByName(hit.select(*lr.columns))


def communication_pairing(cells: DataFrame, sample: str, donor: str, condition: str, cell_type: str, types: Sequence[str], case: str, control: str, min_cells: int) -> DataFrame:
    """Samples with enough cells of every type, and donors complete in both arms."""
    n = cells.groupBy(sample, donor, condition).pivot(cell_type, list(types)).count().fillna(0)
    low = F.least(*[F.col(f"`{t}`") for t in types]) if len(types) > 1 else F.col(f"`{types[0]}`")
    out = n.select(sample, donor, condition, low.alias("min_cells"), (low >= min_cells).alias("enough_cells"))
    arms = out.filter("enough_cells").groupBy(donor).agg(
        (F.bool_or(F.col(condition) == case) & F.bool_or(F.col(condition) == control)).alias("complete")
    )
    return out.join(arms, donor, "left").withColumn(
        "included", F.col("enough_cells") & F.coalesce("complete", F.lit(False)) & F.col(condition).isin(case, control)
    ).drop("complete")


def communication_tensor(lr: DataFrame, how: str = "outer", context: str = "sample") -> DataFrame:
    """Context × channel × sender × receiver values: inner keeps elements seen in all contexts, outer fills zeros."""
    key = ["ligand", "receptor", "source", "target"]
    value = lr.groupBy(context, *key).agg(F.sum("weight").alias("value"))
    contexts = bounded_levels(lr, context)
    if how == "inner":
        full = value.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(contexts))
        return value.join(full.select(*key), key, "left_semi")
    return with_levels(value.select(*key).distinct(), context, contexts).join(value, [context, *key], "left").fillna(0.0, ["value"])


def cci_edges(lr: DataFrame) -> DataFrame:
    return lr.groupBy(F.col("source").alias("src"), F.col("target").alias("dst")).agg(F.sum("weight").alias("weight"))


def gci_edges(lr: DataFrame) -> DataFrame:
    """Gene-channel edges ``type/gene|L → type/gene|R``."""
    src = F.concat("source", F.lit("/"), "ligand", F.lit("|L"))
    dst = F.concat("target", F.lit("/"), "receptor", F.lit("|R"))
    return lr.groupBy(src.alias("src"), dst.alias("dst")).agg(F.sum("weight").alias("weight"))


CHANNEL = ["source", "target", "ligand", "receptor"]


def split_arms(lr: DataFrame, samples: DataFrame, condition: str, case: str, control: str) -> tuple[DataFrame, DataFrame]:
    tagged = lr.join(samples.select("sample", condition).distinct(), "sample")
    return tuple(tagged.filter(F.col(condition) == a).drop(condition) for a in (case, control))


def differential_network(case: DataFrame, control: DataFrame) -> DataFrame:
    """Case minus control weight per channel; unchanged channels go."""
    a = case.groupBy(*CHANNEL).agg(F.sum("weight").alias("_a"))
    b = control.groupBy(*CHANNEL).agg(F.sum("weight").alias("_b"))
    return a.join(b, CHANNEL, "full").withColumn(
        "weight", F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))
    ).filter(F.col("weight") != 0).select(*CHANNEL, "weight")


def pagerank(edges: DataFrame, by: Sequence[str] = (), max_iter: int = 1000, tol: float = 1e-9, nodes: DataFrame | None = None) -> DataFrame:
    """Weighted PageRank, per group when ``by`` is given.

    Dangling mass goes back uniformly, which only rescales the solution of
    ``r = (1-d)/n + d·P r``; so the iteration drops it and the result is normalised.
    Lineage is cut every few steps and the change is tested there, relative to a node's even share
    ``1/n``; if ``max_iter`` steps do not bring it below ``tol`` it raises.
    """
    by = list(by)
    out_w = edges.groupBy(*by, "src").agg(F.sum("weight").alias("_w"))
    p = materialise(
        edges.join(out_w, [*by, "src"]).filter(F.col("_w") > 0).groupBy(*by, "src", "dst").agg((F.sum("weight") / F.first("_w")).alias("p")), "links"
    )
    if nodes is None:
        nodes = edges.select(*by, F.col("src").alias("node")).unionByName(edges.select(*by, F.col("dst").alias("node"))).distinct()
    sizes = nodes.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n"))
    base = materialise(attach(nodes, sizes, by), "nodes")
    rank = base.withColumn("r", 1.0 / F.col("n"))
    step = 6
    previous = None
    for i in range(1, max_iter + 1):
        flow = p.join(rank.select(*by, F.col("node").alias("src"), "r"), [*by, "src"]).groupBy(*by, F.col("dst").alias("node")).agg(F.sum(F.col("p") * F.col("r")).alias("c"))
        rank = base.join(flow, [*by, "node"], "left").withColumn(
            "r", (1 - DAMPING) / F.col("n") + DAMPING * F.coalesce("c", F.lit(0.0))
        ).drop("c")
        if i % step == 0:
            rank = cut_lineage(rank)
            if previous is not None:
                gap = rank.join(previous.select(*by, "node", F.col("r").alias("_o")), [*by, "node"]).agg(F.max(F.abs(F.col("r") - F.col("_o")) * F.col("n"))).first()[0]
                if gap is None or gap < tol:
                    break
            previous = rank
    else:
        raise RuntimeError(f"ranks have not settled after {max_iter} steps")
    total = rank.groupBy(*by).agg(F.sum("r").alias("_t"))
    return attach(rank, total, by).select(*by, "node", (F.col("r") / F.col("_t")).alias("pagerank"))


def degrees(edges: DataFrame) -> DataFrame:
    """Weighted in-degree (Listener) and out-degree (Influencer)."""
    ends = edges.select(F.col("dst").alias("node"), F.col("weight").alias("i"), F.lit(0.0).alias("o")).unionByName(
        edges.select(F.col("src").alias("node"), F.lit(0.0).alias("i"), F.col("weight").alias("o"))
    )
    return ends.groupBy("node").agg(F.sum("i").alias("Listener"), F.sum("o").alias("Influencer"))


def _summed(edges: DataFrame) -> DataFrame:
    """One edge a pair of nodes, written once: ranks and degrees read the edges several times."""
    return materialise(edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "network")


def topology(edges: DataFrame) -> DataFrame:
    e = _summed(edges)
    return degrees(e).join(pagerank(e).withColumnRenamed("pagerank", "Pagerank"), "node")


def topology_difference(case: DataFrame, control: DataFrame, alpha: float = 0.01) -> DataFrame:
    """Degree differences of the differential network and the log ratio of smoothed PageRanks."""
    case, control = _summed(case), _summed(control)
    a, b = case.withColumnRenamed("weight", "_a"), control.withColumnRenamed("weight", "_b")
    diff = a.join(b, ["src", "dst"], "full").select("src", "dst", (F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))).alias("weight"))
    p = pagerank(case).withColumnRenamed("pagerank", "_p")
    q = pagerank(control).withColumnRenamed("pagerank", "_q")
    out = degrees(diff).join(p, "node", "full").join(q, "node", "full").fillna(0.0)
    return out.select("node", "Listener", "Influencer", F.log((F.col("_p") + alpha) / (F.col("_q") + alpha)).alias("Pagerank"))


def sparsify_top_k(edges: DataFrame, k: int) -> DataFrame:
    """Edges among the k strongest incident ones of either end."""
    stacked = reduce(
        lambda x, y: x.unionByName(y),
        [edges.select(F.col(end).alias("node"), "src", "dst", "weight") for end in ("src", "dst")],
    )
    order = W.partitionBy("node").orderBy(F.col("weight").desc(), "src", "dst")
    kept = stacked.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    return kept.select("src", "dst", "weight").distinct()
