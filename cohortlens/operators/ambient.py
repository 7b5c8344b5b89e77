"""Contamination of cells by ambient counts: profile, pairs that should be silent, and its estimate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.ranks import attach
from ..session import materialise


def ambient_profile(raw: DataFrame, droplets: DataFrame, cells: DataFrame, max_droplet_counts: float | None = 100.0) -> DataFrame:
    """``library, gene, share`` of the counts of droplets that are no cells and stay under ``max_droplet_counts``."""
    empty = raw.join(cells.select("cell"), "cell", "left_anti")
    if max_droplet_counts is not None:
        low = empty.groupBy("cell").agg(F.sum("value").alias("_d")).filter(F.col("_d") < max_droplet_counts)
        empty = empty.join(low.select("cell"), "cell", "left_semi")
    per = empty.join(droplets.select("cell", "library"), "cell").groupBy("library", "gene").agg(F.sum("value").alias("g"))
    whole = per.groupBy("library").agg(F.sum("g").alias("_all"))
    return attach(per, whole, ["library"]).select("library", "gene", (F.col("g") / F.col("_all")).alias("share"))


def silent_pairs(
    raw: DataFrame, droplets: DataFrame, cells: DataFrame, profile: DataFrame, min_tfidf: float = 1.0, soup_quantile: float = 0.9,
    max_rho: float = 0.8, alpha: float = 0.05,
) -> DataFrame:
    """``library, cluster, gene, observed, expected, silent``: markers in all clusters of their library.

    A marker is frequent in some cluster and rare elsewhere (the share of the cluster's cells that have it,
    times the log of all cells over those that have it, is at least ``min_tfidf``) and among the genes of
    largest ambient share. ``expected`` is what a cell made of ambient counts alone would have. A pair is
    silent, taken not to express, unless its count is improbable (below ``alpha``) even at ``max_rho``.
    ``cells`` is ``(cell, cluster)``, ``droplets`` is ``(cell, library)``.
    """
    own = materialise(raw.filter("value > 0").join(cells.select("cell", "cluster"), "cell").join(droplets.select("cell", "library"), "cell"), "cells")
    key = ["library", "cluster"]
    n = cells.select("cell", "cluster").join(droplets.select("cell", "library"), "cell").groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    depth = own.groupBy(*key).agg(F.sum("value").alias("depth"))
    seen = materialise(own.groupBy(*key, "gene").agg(F.sum("value").alias("observed"), F.count(F.lit(1)).alias("m")), "seen")
    total = n.groupBy("library").agg(F.sum("n").alias("all"))
    spread = seen.groupBy("library", "gene").agg(F.sum("m").alias("have"))
    tfidf = F.col("m") / F.col("n") * F.log(F.col("all") / F.col("have"))
    specific = seen.join(n, key).join(total, "library").join(spread, ["library", "gene"]).filter(tfidf >= min_tfidf).select("library", "gene").distinct()
    # a library's profile has a row a gene
    bar = profile.groupBy("library").agg(F.expr(f"percentile(share, {soup_quantile})").alias("_bar"))
    markers = attach(profile, bar, ["library"]).filter(F.col("share") >= F.col("_bar")).drop("_bar").join(specific, ["library", "gene"], "left_semi")
    pairs = markers.join(depth, "library").join(seen.drop("m"), [*key, "gene"], "left")
    pairs = pairs.select(*key, "gene", F.coalesce("observed", F.lit(0.0)).alias("observed"), (F.col("depth") * F.col("share")).alias("expected"))
    # P(X >= o) of a Poisson count is a gamma distribution's lower part
    tail = 1 - tails.chi2_sf(2 * F.col("expected") * max_rho, 2 * F.ceil("observed").cast("double"))
    return pairs.filter("expected > 0").withColumn("silent", (F.col("observed") == 0) | (tail >= alpha))


def estimate_rho(pairs: DataFrame, prior_mean: float = 0.05, prior_sd: float = 0.1, step: float = 0.001, max_rho: float = 0.8) -> DataFrame:
    """``library, rho, pooled, n_pairs``: contamination of each library from its silent pairs.

    Each pair's count is Poisson in rho * expected under a gamma prior, so its posterior is a gamma
    density; ``rho`` is where the mean of the pairs' densities is highest on a grid, which single
    pairs that do express cannot shift much. ``pooled`` is the maximum of the joint likelihood.
    """
    silent = materialise(pairs.filter("silent").select("library", "observed", "expected"), "silent")
    shape, rate = F.col("observed") + (prior_mean / prior_sd) ** 2, F.col("expected") + prior_mean / prior_sd**2
    curves = silent.select("library", shape.alias("a"), rate.alias("b")).withColumn("c", F.col("a") * F.log("b") - tails.log_gamma("a"))
    places = F.transform(F.sequence(F.lit(1), F.lit(round(max_rho / step))), lambda i: i * step)
    at = curves.withColumn("rho", F.explode(places))
    density = at.groupBy("library", "rho").agg(F.avg(F.exp(F.col("c") + (F.col("a") - 1) * F.log("rho") - F.col("b") * F.col("rho"))).alias("_d"))
    mode = density.groupBy("library").agg(F.min_by("rho", F.struct(-F.round("_d", 9), F.col("rho"))).alias("rho"))
    pooled = silent.groupBy("library").agg((F.sum("observed") / F.sum("expected")).alias("pooled"), F.count(F.lit(1)).alias("n_pairs"))
    return mode.join(pooled, "library")


def rho_of_cells(rhos: DataFrame, droplets: DataFrame, cells: DataFrame) -> DataFrame:
    """``cell, rho``: the contamination of each cell's library."""
    return cells.select("cell").join(droplets.select("cell", "library"), "cell").join(rhos.select("library", "rho"), "library").select("cell", "rho")
