"""Roots, graph pseudotime, fates, velocity and profiles along pseudotime."""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import tails
from ..functions.fdr import bh_fdr
from ..functions.ranks import attach, average_rank, grouped_median, positions, value_ranks
from ..session import cut_lineage, materialise


def root_by_score(cells: DataFrame, score: str) -> DataFrame:
    """The cell with the highest marker score; ties by name."""
    return cells.filter(F.col(score).isNotNull()).agg(F.min_by("cell", F.struct(-F.col(score), F.col("cell"))).alias("cell"))


def root_by_group(embedding: DataFrame, labels: DataFrame, group: str) -> DataFrame:
    """The cell nearest the centroid of a group, among its members."""
    inside = embedding.join(labels.filter(F.col("label") == group).select("cell"), "cell", "left_semi")
    dims = inside.select("cell", F.posexplode("vec").alias("dim", "x"))
    centre = dims.groupBy("dim").agg(F.avg(F.col("x").cast("double")).alias("c"))
    d = dims.join(centre, "dim").groupBy("cell").agg(F.round(F.sum(F.pow(F.col("x").cast("double") - F.col("c"), F.lit(2.0))), 12).alias("d"))
    return d.agg(F.min_by("cell", F.struct("d", "cell")).alias("cell"))


def embedding_outliers(embedding: DataFrame, mad: float = 5.0, n_dims: int = 10) -> DataFrame:
    """Cells with a robust z over ``mad`` in any of the first dimensions."""
    dims = materialise(embedding.select("cell", F.posexplode(F.slice("vec", 1, n_dims)).alias("dim", "x")).withColumn("x", F.col("x").cast("double")), "dims")
    centre = materialise(grouped_median(dims, ["dim"], "x", "m"), "centre")
    dev = dims.join(centre, "dim").withColumn("d", F.abs(F.col("x") - F.col("m")))
    spread = grouped_median(dev, ["dim"], "d", "s")
    z = F.col("d") / F.nullif(1.4826 * F.col("s"), F.lit(0.0))
    return dev.join(spread, "dim").groupBy("cell").agg(F.coalesce(F.bool_or(z > mad), F.lit(False)).alias("outlier"))


def graph_pseudotime(edges: DataFrame, root: DataFrame, max_iter: int | None = None) -> DataFrame:
    """Shortest distance from the root along the graph, scaled to [0, 1]; unreachable is null.

    Only cells whose distance fell in the last round send to their neighbours; rounds go on until
    none did. A given ``max_iter`` that is reached before that raises.
    """
    e = materialise(edges.select("src", "dst", "distance"), "edges")
    nodes = materialise(e.select(F.col("src").alias("cell")).unionByName(e.select(F.col("dst").alias("cell"))).distinct(), "nodes")
    state = cut_lineage(root.select("cell", F.lit(0.0).alias("d"), F.lit(True).alias("fresh")))
    for done in itertools.count(1):
        sent = state.filter("fresh").select(F.col("cell").alias("src"), "d").join(e, "src").groupBy(F.col("dst").alias("cell")).agg(F.min(F.col("d") + F.col("distance")).alias("_n"))
        merged = state.select("cell", "d").join(sent, "cell", "full")
        better = F.coalesce(F.col("_n") < F.col("d"), F.col("d").isNull())
        state = cut_lineage(merged.select("cell", F.least("d", "_n").alias("d"), better.alias("fresh")))
        if state.filter("fresh").isEmpty():
            break
        if max_iter is not None and done >= max_iter:
            raise RuntimeError(f"distances still fall after {max_iter} rounds")
    top = state.agg(F.max("d").alias("_m"))
    return attach(nodes.join(state.select("cell", "d"), "cell", "left"), top, []).select("cell", (F.col("d") / F.nullif(F.col("_m"), F.lit(0.0))).alias("pseudotime"))


def steady_state_velocity(layers: DataFrame, min_shared: float = 20.0) -> tuple[DataFrame, DataFrame]:
    """Per gene γ = Σus/Σss with R², and per cell velocity u − γ·s."""
    wide = layers.groupBy("cell", "gene").agg(
        F.coalesce(F.sum(F.when(F.col("layer") == "spliced", F.col("value"))), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(F.when(F.col("layer") == "unspliced", F.col("value"))), F.lit(0.0)).alias("u"),
    )
    wide = materialise(wide, "layers")
    both = (F.col("s") > 0) & (F.col("u") > 0)
    n = layers.select("cell").distinct().agg(F.count(F.lit(1)).cast("double").alias("n"))
    g = wide.groupBy("gene").agg(
        F.sum(F.when(both, F.col("s") + F.col("u")).otherwise(0.0)).alias("shared"),
        F.sum(F.col("u") * F.col("s")).alias("us"), F.sum(F.col("s") * F.col("s")).alias("ss"),
        F.sum(F.col("u") * F.col("u")).alias("uu"), F.sum("u").alias("su"),
    )
    gamma = F.col("us") / F.nullif(F.col("ss"), F.lit(0.0))
    genes = attach(g.filter(F.col("shared") >= min_shared), n, []).select(
        "gene", "shared", gamma.alias("gamma"),
        (1 - (F.col("uu") - F.col("us") * gamma) / F.nullif(F.col("uu") - F.col("su") * F.col("su") / F.col("n"), F.lit(0.0))).alias("r2"),
    )
    genes = materialise(genes, "gamma")
    return genes, wide.join(genes.select("gene", "gamma"), "gene").select("cell", "gene", (F.col("u") - F.col("gamma") * F.col("s")).alias("velocity"))


def fate_probabilities(edges: DataFrame, pseudotime: DataFrame, terminal: DataFrame, bias: float = 10.0, n_iter: int | None = None, tol: float = 1e-6) -> DataFrame:
    """Probability of absorption in each terminal group under forward-biased steps.

    Edges against pseudotime are damped by ``exp(-bias·Δ)``; terminal cells absorb.
    ``terminal`` is ``(cell, fate)``. Steps go on until no further cell is reached and every
    probability stands still relative to its size. A given ``n_iter`` stops earlier, with a warning.
    Cells without a path to a terminal have no row.
    """
    t = pseudotime.filter(F.col("pseudotime").isNotNull())
    e = edges.join(t.select(F.col("cell").alias("src"), F.col("pseudotime").alias("a")), "src").join(t.select(F.col("cell").alias("dst"), F.col("pseudotime").alias("b")), "dst")
    w = F.col("weight") * F.when(F.col("b") >= F.col("a"), 1.0).otherwise(F.exp(-bias * (F.col("a") - F.col("b"))))
    e = e.select("src", "dst", w.alias("w")).join(terminal.select(F.col("cell").alias("src")), "src", "left_anti")
    norm = e.groupBy("src").agg(F.sum("w").alias("_w"))
    p = materialise(e.join(norm, "src").select("src", "dst", (F.col("w") / F.col("_w")).alias("p")), "walk")
    fixed = materialise(terminal.select("cell", "fate", F.lit(1.0).alias("prob")), "fixed")
    state = fixed
    previous = None
    for i in itertools.count(1):
        moved = p.join(state.withColumnRenamed("cell", "dst"), "dst").groupBy(F.col("src").alias("cell"), "fate").agg(F.sum(F.col("p") * F.col("prob")).alias("prob"))
        state = fixed.unionByName(moved)
        if i % 5 == 0:
            state = cut_lineage(state)
            if previous is not None:
                # a pair that is new has a relative gap of one
                old = F.coalesce("_o", F.lit(0.0))
                gap = state.filter("prob > 0").join(previous.withColumnRenamed("prob", "_o"), ["cell", "fate"], "left").agg(F.max(F.abs(F.col("prob") - old) / F.col("prob"))).first()[0]
                if gap is None or gap < tol:
                    break
            previous = state
        if n_iter is not None and i >= n_iter:
            warnings.warn(f"fates have not settled after {n_iter} steps", stacklevel=2)
            break
    total = state.groupBy("cell").agg(F.sum("prob").alias("_t"))
    return state.join(total, "cell").filter(F.col("_t") > 0).select("cell", "fate", (F.col("prob") / F.col("_t")).alias("prob"))


def lineage_drivers(layer: DataFrame, fate: DataFrame, value: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """Correlation of each gene with a per-cell value over all its cells, zeros included, with FDR."""
    by = list(by)
    v = materialise(fate.select("cell", *by, F.col(value).cast("double").alias("y")).filter(F.col("y").isNotNull()), "fate")
    side = v.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))
    g = layer.join(v, "cell").groupBy(*by, "gene").agg(
        F.sum("value").alias("sx"), F.sum(F.col("value") * F.col("value")).alias("sxx"), F.sum(F.col("value") * F.col("y")).alias("sxy")
    )
    n = F.col("n")
    var = (F.col("sxx") - F.col("sx") * F.col("sx") / n) * (F.col("syy") - F.col("sy") * F.col("sy") / n)
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(F.nullif(F.greatest(var, F.lit(0.0)), F.lit(0.0)))
    out = attach(g, side, by).withColumn("r", r).withColumn("t", F.col("r") * F.sqrt((n - 2) / F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0))))
    out = out.withColumn("df", n - 2).withColumn("p", tails.t_two_sided("t", "df"))
    return bh_fdr(out.select(*by, "gene", "r", "t", "p"), "p", by)


def pseudotime_bins(cells: DataFrame, pt: str, n_bins: int) -> DataFrame:
    """Equal-count bins by position along pseudotime."""
    placed = positions(cells.filter(F.col(pt).isNotNull()), [], pt, "cell")
    return placed.withColumn(
        "bin", F.least(F.lit(n_bins - 1), F.floor(F.col("position") * n_bins / F.col("position_total"))).cast("int")
    ).drop("position", "position_total")


def _all_bins(df: DataFrame, n_bins: int) -> DataFrame:
    return df.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))


def pseudotime_profile(layer: DataFrame, cells: DataFrame, pt: str, n_bins: int) -> DataFrame:
    """Mean per gene and bin, empty bins repeated, then a five-bin sum over five."""
    binned = materialise(pseudotime_bins(cells, pt, n_bins).select("cell", "bin"), "bins")
    sizes = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    sums = layer.join(binned, "cell").groupBy("gene", "bin").agg(F.sum("value").alias("s"))
    grid = _all_bins(layer.select("gene").distinct(), n_bins).join(sizes, "bin", "left").join(sums, ["gene", "bin"], "left")
    mean = F.when(F.col("n") > 0, F.coalesce("s", F.lit(0.0)) / F.col("n"))
    order = W.partitionBy("gene").orderBy("bin")
    filled = grid.withColumn("m", F.coalesce(F.last(mean, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)), F.lit(0.0)))
    return filled.select("gene", "bin", (F.sum("m").over(order.rowsBetween(-2, 2)) / 5.0).alias("value"))


def score_track(cells: DataFrame, pt: str, score: str, n_bins: int) -> DataFrame:
    """Mean score per bin, forward filled."""
    binned = pseudotime_bins(cells, pt, n_bins)
    means = binned.groupBy("bin").agg(F.avg(score).alias("m"))
    grid = cells.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin")).join(means, "bin", "left")
    order = W.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    return grid.select("bin", F.last("m", ignorenulls=True).over(order).alias("value"))


def category_track(cells: DataFrame, pt: str, category: str, n_bins: int) -> DataFrame:
    """Most frequent category per bin (ties by name), forward filled."""
    n = pseudotime_bins(cells, pt, n_bins).groupBy("bin", category).agg(F.count(F.lit(1)).alias("n"))
    modal = n.groupBy("bin").agg(F.min_by(category, F.struct(-F.col("n"), F.col(category))).alias("m"))
    grid = cells.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin")).join(modal, "bin", "left")
    order = W.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    return grid.select("bin", F.last("m", ignorenulls=True).over(order).alias("value"))


def rank_by_pseudotime(activity: DataFrame, cells: DataFrame, pt: str) -> DataFrame:
    """Spearman correlation of each source's activity with pseudotime."""
    t = cells.select("cell", F.col(pt).alias("t")).filter(F.col("t").isNotNull())
    j = materialise(activity.join(t, "cell").select("cell", "source", F.col("score").cast("double").alias("x"), F.col("t").cast("double").alias("t")), "activity")
    rx = value_ranks(j, ["source"], "x").select("source", "x", average_rank().alias("rx"))
    rt = value_ranks(j, ["source"], "t").select("source", "t", average_rank().alias("rt"))
    return j.join(rx, ["source", "x"]).join(rt, ["source", "t"]).groupBy("source").agg(F.corr("rx", "rt").alias("rho"), F.count(F.lit(1)).alias("n_cells"))


def activity_by_bin(activity: DataFrame, cells: DataFrame, pt: str, n_bins: int) -> DataFrame:
    binned = pseudotime_bins(cells, pt, n_bins).select("cell", "bin")
    return activity.join(binned, "cell").groupBy("source", "bin").agg(F.avg("score").alias("mean_score"))
