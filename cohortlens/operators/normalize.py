"""Normalisation recipes and variable-gene selection on long counts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.checks import tag_layer
from ..functions.ranks import attach

TARGET_SUM = 10_000.0
DEPTH_CHUNKS = 32


def with_totals(counts: DataFrame, name: str = "total") -> DataFrame:
    """Counts joined to their cell depth.

    Depths come from a partial aggregate, so a cell holding a large share of the rows
    is summed on every map task and its join side can be split by the skew rule.
    """
    totals = counts.groupBy("cell").agg(F.sum("value").alias(name))
    return counts.join(totals, "cell")


def proportional_fit(counts: DataFrame) -> DataFrame:
    out = with_totals(counts).filter(F.col("total") > 0)
    return tag_layer(
        out.select("cell", "gene", (F.col("value") / F.col("total")).alias("value")), "lognorm", "pf"
    )


def log1p_cp10k(counts: DataFrame, target: float = TARGET_SUM) -> DataFrame:
    out = with_totals(counts).filter(F.col("total") > 0)
    return tag_layer(
        out.select("cell", "gene", F.log1p(F.col("value") * target / F.col("total")).alias("value")),
        "lognorm",
        "log1p_cp10k",
    )


def log1p_pf(counts: DataFrame) -> DataFrame:
    out = with_totals(counts).filter(F.col("total") > 0)
    return tag_layer(
        out.select("cell", "gene", F.log1p(F.col("value") / F.col("total")).alias("value")),
        "lognorm",
        "log1p_pf",
    )


def pflog(counts: DataFrame, n_genes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Proportional fit to mean depth, log1p, then a per-cell centre over all genes.

    Centring would make every zero explicit, so values stay sparse and the centre is a
    second table; an absent row stands for ``-row_center``.
    """
    totals = counts.groupBy("cell").agg(F.sum("value").alias("total"))
    scale = totals.filter(F.col("total") > 0).agg(F.avg("total").alias("k"))
    joined = attach(counts.join(totals, "cell").filter(F.col("total") > 0), scale, [])
    values = joined.select(
        "cell", "gene", F.log1p(F.col("value") * F.col("k") / F.col("total")).alias("value")
    )
    if n_genes is None:
        size = counts.agg(F.count_distinct("gene").alias("_n"))
    else:
        size = counts.limit(0).agg(F.lit(n_genes).alias("_n"))
    sums = values.groupBy("cell").agg(F.sum("value").alias("_s"))
    centers = attach(sums, size, []).select("cell", (F.col("_s") / F.col("_n")).alias("row_center"))
    return tag_layer(values, "scaled", "pflog"), centers


# --- variable genes ----------------------------------------------------------------------


def gene_moments(layer: DataFrame, cells: DataFrame, batch: str | None = None) -> DataFrame:
    """Mean and variance (n - 1) of each gene over all cells, zeros included."""
    keys = [batch] if batch else []
    source = layer.join(cells.select("cell", batch), "cell") if batch else layer
    sums = source.groupBy(*keys, "gene").agg(
        F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss")
    )
    n = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"))
    mean = F.col("s") / F.col("n_cells")
    return attach(sums, n, keys).select(
        *keys,
        "gene",
        "n_cells",
        mean.alias("mean"),
        F.greatest(
            F.lit(0.0),
            (F.col("ss") - F.col("s") * F.col("s") / F.col("n_cells")) / (F.col("n_cells") - 1),
        ).alias("variance"),
    )


def hvg_dispersion(
    layer: DataFrame, cells: DataFrame, n_bins: int = 20, batch: str | None = None
) -> DataFrame:
    """Normalised dispersion: log variance/mean, standardised inside equal-width mean bins.

    Moments are of expm1 values; a bin of one gene has no spread, so its dispersion
    is centred at zero and scored 1.
    """
    keys = [batch] if batch else []
    linear = layer.withColumn("value", F.expm1("value"))
    m = gene_moments(linear, cells, batch)
    mean = F.when(F.col("mean") == 0, F.lit(1e-12)).otherwise(F.col("mean"))
    m = m.withColumn("dispersion", F.log(F.nullif(F.col("variance") / mean, F.lit(0.0)))).withColumn(
        "mean", F.log1p("mean")
    )
    ends = m.groupBy(*keys).agg(F.min("mean").alias("_lo"), F.max("mean").alias("_hi"))
    binned = attach(m, ends, keys).withColumn(
        "mean_bin",
        F.least(
            F.lit(n_bins - 1),
            F.greatest(
                F.lit(0),
                F.ceil((F.col("mean") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * n_bins) - 1,
            ),
        ).cast("int"),
    )
    stats = binned.groupBy(*keys, "mean_bin").agg(
        F.avg("dispersion").alias("_mu"), F.stddev_samp("dispersion").alias("_sd")
    )
    single = F.col("_sd").isNull()
    return binned.join(stats, [*keys, "mean_bin"]).select(
        *keys,
        "gene",
        "mean",
        "dispersion",
        "mean_bin",
        (
            (F.col("dispersion") - F.when(single, F.lit(0.0)).otherwise(F.col("_mu")))
            / F.when(single, F.col("_mu")).otherwise(F.nullif(F.col("_sd"), F.lit(0.0)))
        ).alias("score"),
    )


def hvg_clipped_variance(
    counts: DataFrame, cells: DataFrame, batch: str | None = None, min_cells: int = 1
) -> DataFrame:
    """Variance after standardising by a mean–variance trend and clipping at √n.

    The trend is the quadratic in log10 mean that least squares fits to log10 variance,
    solved from five power sums per batch.
    """
    keys = [batch] if batch else []
    detected = None
    if min_cells > 1:
        detected = (
            counts.filter(F.col("value") > 0).groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_cells).select("gene")
        )
        counts = counts.join(detected, "gene", "left_semi")
    m = gene_moments(counts, cells, batch)
    fit = m.filter(F.col("variance") > 0).select(
        *keys, F.log10("mean").alias("x"), F.log10("variance").alias("y")
    )
    sums = fit.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("s0"),
        *[F.sum(F.pow("x", F.lit(float(p)))).alias(f"s{p}") for p in (1, 2, 3, 4)],
        *[F.sum(F.pow("x", F.lit(float(p))) * F.col("y")).alias(f"t{p}") for p in (0, 1, 2)],
    )

    def det(a, b, c, d, e, f, g, h, i) -> Column:
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    s = [F.col(f"s{p}") for p in range(5)]
    t = [F.col(f"t{p}") for p in range(3)]
    base = det(s[0], s[1], s[2], s[1], s[2], s[3], s[2], s[3], s[4])
    coeff = sums.select(
        *keys,
        (det(t[0], s[1], s[2], t[1], s[2], s[3], t[2], s[3], s[4]) / base).alias("c0"),
        (det(s[0], t[0], s[2], s[1], t[1], s[3], s[2], t[2], s[4]) / base).alias("c1"),
        (det(s[0], s[1], t[0], s[1], s[2], t[1], s[2], s[3], t[2]) / base).alias("c2"),
    )
    x = F.log10("mean")
    trend = attach(m, coeff, keys).select(
        *keys,
        "gene",
        "n_cells",
        "mean",
        "variance",
        F.when(
            F.col("variance") > 0,
            F.sqrt(F.pow(F.lit(10.0), F.col("c0") + F.col("c1") * x + F.col("c2") * x * x)),
        ).otherwise(F.lit(1.0)).alias("reg_std"),
    ).withColumn("clip", F.col("reg_std") * F.sqrt("n_cells") + F.col("mean"))
    source = counts.join(cells.select("cell", batch), "cell") if batch else counts
    clipped = (
        source.join(trend, [*keys, "gene"])
        .withColumn("_v", F.least("value", "clip"))
        .groupBy(*keys, "gene")
        .agg(F.sum("_v").alias("_s"), F.sum(F.col("_v") * F.col("_v")).alias("_ss"))
    )
    n, mu, sd = F.col("n_cells"), F.col("mean"), F.col("reg_std")
    return trend.join(clipped, [*keys, "gene"]).select(
        *keys,
        "gene",
        "mean",
        "variance",
        ((n * mu * mu + F.col("_ss") - 2 * F.col("_s") * mu) / ((n - 1) * sd * sd)).alias("score"),
    )


def hvg_pearson(counts: DataFrame, cells: DataFrame, theta: float = 100.0) -> DataFrame:
    """Variance of clipped negative-binomial Pearson residuals over all cells.

    Nonzero entries are summed directly.  A zero's residual depends only on the gene
    total and the cell depth, so zeros are summed over the histogram of depths: the
    all-cells sum of zero-residuals minus those of the cells that do have the gene.
    Every cell of equal depth is one histogram row.
    """
    depth = counts.groupBy("cell").agg(F.sum("value").alias("d"))
    per_gene = counts.groupBy("gene").agg(F.sum("value").alias("g"))
    size = cells.agg(F.count(F.lit(1)).cast("double").alias("n"))
    whole = attach(depth.agg(F.sum("d").alias("total")), size, [])
    # the depth histogram is cut into chunks so that no row holds all depths
    histogram = depth.groupBy("d").agg(F.count(F.lit(1)).alias("m"))
    packed = (
        histogram.withColumn("chunk", F.pmod(F.xxhash64("d"), F.lit(DEPTH_CHUNKS)).cast("int"))
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("d", "m")).alias("hist"))
    )
    limit = F.sqrt("n")

    def residual(value: Column, mu: Column) -> Column:
        r = (value - mu) / F.sqrt(mu + mu * mu / theta)
        return F.greatest(-limit, F.least(limit, r))

    totals = attach(per_gene, whole, [])
    zero = totals.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(DEPTH_CHUNKS - 1)))).join(
        packed, "chunk"
    )
    folded = F.aggregate(
        "hist",
        F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b")),
        lambda acc, h: F.struct(
            (acc["a"] + h["m"] * residual(F.lit(0.0), F.col("g") * h["d"] / F.col("total"))).alias("a"),
            (acc["b"] + h["m"] * F.pow(residual(F.lit(0.0), F.col("g") * h["d"] / F.col("total")), F.lit(2.0))).alias("b"),
        ),
    )
    zero = zero.withColumn("z", folded).groupBy("gene").agg(
        F.sum("z.a").alias("za"), F.sum("z.b").alias("zb")
    )
    mu = F.col("g") * F.col("d") / F.col("total")
    present = (
        counts.join(depth, "cell")
        .join(totals, "gene")
        .withColumn("r", residual(F.col("value"), mu))
        .withColumn("r0", residual(F.lit(0.0), mu))
        .groupBy("gene")
        .agg(
            F.sum(F.col("r") - F.col("r0")).alias("da"),
            F.sum(F.col("r") * F.col("r") - F.col("r0") * F.col("r0")).alias("db"),
        )
    )
    a, b = F.col("za") + F.col("da"), F.col("zb") + F.col("db")
    return attach(zero.join(present, "gene"), size, []).select(
        "gene", (b / F.col("n") - (a / F.col("n")) * (a / F.col("n"))).alias("score")
    )


def hvg_finalize(
    scores: DataFrame,
    genes: DataFrame,
    n_top: int,
    batch: str | None = None,
    exclude: Sequence[str] = (),
    symbol: str = "gene",
) -> DataFrame:
    """Per-batch rank, then number of batches and median rank; excluded names lose the flag."""
    keys = [batch] if batch else []
    order = W.partitionBy(*keys).orderBy(F.col("score").desc_nulls_last(), "gene")
    if not keys:
        order = W.partitionBy(F.lit(0)).orderBy(F.col("score").desc_nulls_last(), "gene")
    ranked = (
        scores.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n_top)
    )
    merged = ranked.groupBy("gene").agg(
        F.count(F.lit(1)).alias("n_batches"), F.expr("percentile(_r, 0.5)").alias("median_rank")
    )
    final = W.partitionBy(F.lit(0)).orderBy(F.col("n_batches").desc(), "median_rank", "gene")
    chosen = merged.withColumn("_k", F.row_number().over(final)).filter(F.col("_k") <= n_top)
    out = genes.join(chosen.select("gene", "n_batches", "median_rank"), "gene", "left")
    flag = F.col("n_batches").isNotNull()
    for pattern in exclude:
        flag = flag & ~F.col(symbol).rlike(pattern)
    return out.withColumn("highly_variable", flag).fillna(0, ["n_batches"])
