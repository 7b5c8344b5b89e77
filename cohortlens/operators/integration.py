"""How well an embedding keeps labels together and mixes batches: connectivity, silhouettes, cluster agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import attach
from ..session import materialise


def graph_connectivity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``label, n, largest, connectivity``: share of a label's cells in the largest connected piece among themselves.

    Cells without an edge to a cell of their label are pieces of their own.
    """
    from .neighbors import connected_components

    of = lambda side: labels.select(F.col("cell").alias(side), F.col("label").alias(f"l_{side}"))
    inside = edges.select("src", "dst").filter(F.col("src") != F.col("dst")).join(of("src"), "src").join(of("dst"), "dst").filter(F.col("l_src") == F.col("l_dst"))
    pieces = connected_components(inside.select("src", "dst")).select(F.col("node").alias("cell"), "c")
    placed = labels.select("cell", "label").join(pieces, "cell", "left").withColumn("c", F.coalesce("c", "cell"))
    sizes = placed.groupBy("label", "c").agg(F.count(F.lit(1)).alias("m"))
    return sizes.groupBy("label").agg(F.sum("m").alias("n"), F.max("m").alias("largest"), (F.max("m") / F.sum("m")).alias("connectivity"))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def batch_silhouette(embedding: DataFrame, labels: DataFrame, batches: DataFrame) -> DataFrame:
    """``label, n, score``: 1 - |silhouette| of the batches among a label's cells, averaged; 1 is well mixed.

    Distances are squared. The mean squared distance to a batch follows from its count, sum of vectors
    and sum of squares, so a cell meets each batch of its label once and never another cell. A cell alone
    in its batch has silhouette 0; labels with one batch only, or with a batch for each cell, have no row.
    """
    cells = embedding.select("cell", F.col("vec").cast("array<double>").alias("vec")).join(labels.select("cell", "label"), "cell")
    cells = materialise(cells.join(batches.select("cell", F.col("label").alias("batch")), "cell").withColumn("sq", _dot("vec", "vec")), "cells")
    sums = cells.select("label", "batch", F.posexplode("vec").alias("d", "x")).groupBy("label", "batch", "d").agg(F.sum("x").alias("s"))
    vectors = sums.groupBy("label", "batch").agg(F.transform(F.sort_array(F.collect_list(F.struct("d", "s"))), lambda p: p["s"]).alias("sum"))
    stats = cells.groupBy("label", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("sq").alias("ss")).join(vectors, ["label", "batch"])
    usable = stats.groupBy("label").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("all")).filter("k > 1 and k < all").select("label")
    stats = materialise(stats.join(usable, "label"), "stats").withColumnRenamed("batch", "other")
    met = cells.join(stats, "label")
    total = F.greatest(F.col("n") * F.col("sq") + F.col("ss") - 2 * _dot("vec", "sum"), F.lit(0.0))
    own = F.col("batch") == F.col("other")
    met = met.withColumn("d2", F.when(own, total / F.nullif(F.col("n") - 1, F.lit(0))).otherwise(total / F.col("n")))
    per = met.groupBy("label", "cell").agg(F.max(F.when(own, F.col("d2"))).alias("a"), F.min(F.when(~own, F.col("d2"))).alias("b"))
    s = F.when(F.col("a").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg(1 - F.abs(s)).alias("score"))


def cluster_agreement(clusters: DataFrame, labels: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``nmi, ari`` of clusters against labels over the cells of both, one row for each group of ``by``.

    NMI is normalised by the mean of both entropies; a single cluster against a single label is 1.
    """
    by = list(by)
    pairs = clusters.select(*by, "cell", "cluster").join(labels.select("cell", "label"), "cell")
    n = materialise(pairs.groupBy(*by, "cluster", "label").agg(F.count(F.lit(1)).alias("n")), "cross")
    choose = F.col("n") * (F.col("n") - 1) / 2
    sums = lambda s: [F.sum(F.col("n") * F.log("n")).alias(f"e_{s}"), F.sum(choose).alias(f"c_{s}")]
    side = lambda c, s: n.groupBy(*by, c).agg(F.sum("n").alias("n")).groupBy(*by).agg(*sums(s))
    whole = n.groupBy(*by).agg(*sums("ab"), F.sum("n").cast("double").alias("t"))
    joined = attach(attach(whole, side("cluster", "a"), by), side("label", "b"), by)
    t = F.col("t")
    h = lambda s: F.log(t) - F.col(f"e_{s}") / t
    both = (h("a") + h("b")) / 2
    nmi = F.when(both <= 1e-15, F.lit(1.0)).otherwise(F.greatest(h("a") + h("b") - h("ab"), F.lit(0.0)) / both)
    expected = F.col("c_a") * F.col("c_b") / F.nullif(t * (t - 1) / 2, F.lit(0.0))
    top = (F.col("c_a") + F.col("c_b")) / 2 - expected
    ari = F.when(F.coalesce(top, F.lit(0.0)) == 0, F.lit(1.0)).otherwise((F.col("c_ab") - expected) / top)
    return joined.select(*by, nmi.alias("nmi"), ari.alias("ari"))
