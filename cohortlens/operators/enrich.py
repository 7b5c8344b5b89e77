"""Rankings, gene-set enrichment and set overlaps."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.fdr import bh_small, hypergeometric_sf
from ..functions.levels import bounded_levels, with_levels
from ..functions.ranks import attach, positions
from ..session import materialise


def de_ranking(de: DataFrame, by: Sequence[str] = (), lfc: str = "logFC", p: str = "p") -> DataFrame:
    """Signed -log10 p per gene, the largest magnitude of each gene; non-finite values go."""
    metric = F.signum(lfc) * -F.log10(F.nullif(F.col(p), F.lit(0.0)))
    scored = de.withColumn("metric", metric).filter(
        F.col("metric").isNotNull() & ~F.isnan("metric") & (F.abs("metric") < float("inf"))
    )
    return scored.groupBy(*by, "gene").agg(F.max_by("metric", F.struct(F.abs("metric"), "metric")).alias("metric"))


def filter_net(net: DataFrame, universe: DataFrame, min_size: int = 0, max_size: int = 500) -> DataFrame:
    """Gene sets whose size inside the universe lies in the bounds."""
    sizes = (
        net.join(universe.select(F.col("gene").alias("target")).distinct(), "target", "left_semi")
        .groupBy("source")
        .agg(F.count_distinct("target").alias("_k"))
        .filter(F.col("_k").between(min_size, max_size))
    )
    return net.join(sizes.select("source"), "source", "left_semi")


def _walk(hits: DataFrame, key: Sequence[str]) -> DataFrame:
    """Running sums at the hits of each set: after each hit, and just before it.

    Needs ``position`` (0-based), ``weight`` and ``total``; misses before a hit are its
    position minus its index, so only hit rows exist.
    """
    order = W.partitionBy(*key).orderBy("position")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*key)
    out = (
        hits.withColumn("idx", F.row_number().over(order))
        .withColumn("n_hits", F.count(F.lit(1)).over(whole))
        .withColumn("_all", F.sum("weight").over(whole))
        .withColumn("_cum", F.sum("weight").over(upto))
        .filter((F.col("n_hits") < F.col("total")) & (F.col("_all") > 0))
    )
    miss = (F.col("position") - (F.col("idx") - 1)) / (F.col("total") - F.col("n_hits"))
    return out.withColumn("after", F.col("_cum") / F.col("_all") - miss).withColumn(
        "before", (F.col("_cum") - F.col("weight")) / F.col("_all") - miss
    )


def _extremes(walk: DataFrame, key: Sequence[str]) -> DataFrame:
    out = walk.groupBy(*key).agg(
        F.max("n_hits").alias("set_size"),
        F.greatest(F.max("after"), F.lit(0.0)).alias("high"),
        F.least(F.min("before"), F.lit(0.0)).alias("low"),
        (-F.max(F.struct("after", (-F.col("idx")).alias("neg")))["neg"]).alias("peak"),
        F.min(F.struct("before", "idx"))["idx"].alias("trough"),
    )
    return out.withColumn("es", F.when(F.col("high") >= -F.col("low"), F.col("high")).otherwise(F.col("low")))


def ranked_positions(ranking: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return positions(ranking, by, "metric", "gene", descending=True).withColumnRenamed("position_total", "total")


def gsea_es(ranking: DataFrame, net: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Enrichment score and leading edge of each set along the ranking."""
    placed = ranked_positions(ranking, by)
    members = net.select("source", F.col("target").alias("gene")).distinct()
    key = [*by, "source"]
    hits = placed.join(members, "gene").withColumn("weight", F.abs("metric"))
    walk = materialise(_walk(hits, key), "walk")
    ends = _extremes(walk, key)
    up = F.col("es") == F.col("high")
    edge = walk.join(ends.select(*key, "peak", "trough", "es", "high"), key).filter(
        F.when(up, F.col("idx") <= F.col("peak")).otherwise(F.col("idx") >= F.col("trough"))
    )
    genes = edge.groupBy(*key).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "gene"))), lambda s: s["gene"]), ";").alias("leading_edge"),
        F.count(F.lit(1)).alias("n_leading"),
    )
    return ends.select(*key, "set_size", "es").join(genes, key)


def gsea(
    ranking: DataFrame, net: DataFrame, n_perm: int = 1000, by: Sequence[str] = (), seed: int = 42,
    min_size: int = 10, max_size: int = 500,
) -> DataFrame:
    """Enrichment score against random gene sets of the same size, p floored at its resolution, FDR.

    One hashed order of the genes per permutation serves every set size: the first k
    genes of the order are the random set of size k.
    """
    by = list(by)
    placed = materialise(ranked_positions(ranking, by).withColumn("weight", F.abs("metric")), "ranking")
    sets = filter_net(net, ranking, min_size, max_size)
    members = sets.select("source", F.col("target").alias("gene")).distinct()
    key = [*by, "source"]
    es = materialise(_extremes(_walk(placed.join(members, "gene"), key), key).select(*key, "set_size", "es"), "es")
    sizes = es.select(*by, "set_size").distinct()
    largest = es.agg(F.max("set_size")).first()[0] or 0
    order = W.partitionBy(*by, "perm").orderBy(F.xxhash64(F.lit(seed), F.col("perm"), F.col("gene")), "gene")
    drawn = (
        placed.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(n_perm))))
        .withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= largest)
    )
    ladder = materialise(sizes, "sizes")
    sampled = (drawn.join(ladder, by) if by else drawn.withColumn("_one", F.lit(1)).join(ladder.withColumn("_one", F.lit(1)), "_one")).filter(
        F.col("_r") <= F.col("set_size")
    )
    null_key = [*by, "set_size", "perm"]
    null = _null(sampled, null_key)
    joined = es.join(null, [*by, "set_size"], "left")
    same = F.signum("null_es") == F.signum("es")
    tested = joined.groupBy(*key, "set_size", "es").agg(
        F.count_if(same).alias("_same"),
        F.count_if(same & (F.abs("null_es") >= F.abs("es"))).alias("_ge"),
        F.avg(F.when(same, F.abs("null_es"))).alias("_mean"),
    )
    floor = 1.0 / (n_perm + 1)
    raw = F.col("_ge") / F.nullif(F.col("_same"), F.lit(0))
    out = tested.select(
        *key, "set_size", "es", (F.col("es") / F.col("_mean")).alias("nes"),
        F.greatest(F.coalesce(raw, F.lit(1.0)), F.lit(floor)).alias("p"),
        F.coalesce(raw <= floor, F.lit(False)).alias("p_at_resolution_limit"),
    )
    return bh_small(out, "p", by)


def _null(sampled: DataFrame, key: Sequence[str]) -> DataFrame:
    walk = _walk(sampled.select(*key, "position", "weight", "total"), key)
    return walk.groupBy(*key).agg(
        F.greatest(F.max("after"), F.lit(0.0)).alias("_h"), F.least(F.min("before"), F.lit(0.0)).alias("_l")
    ).select(*key, F.when(F.col("_h") >= -F.col("_l"), F.col("_h")).otherwise(F.col("_l")).alias("null_es"))


def ora(
    de: DataFrame, net: DataFrame, fdr: str = "fdr", lfc: str = "logFC", fg_padj: float = 0.05, lfc_threshold: float = 0.0,
    min_size: int = 10, max_size: int = 500, min_foreground: int = 5,
) -> DataFrame:
    """Hypergeometric over-representation of up and down genes among all tested genes."""
    tested = de.select("gene", F.col(lfc).alias("_l"), F.col(fdr).alias("_q")).filter(F.col("gene").isNotNull())
    called = F.col("_q") < fg_padj
    label = F.when(called & (F.col("_l") > lfc_threshold), "up").when(called & (F.col("_l") < -lfc_threshold), "down")
    labelled = materialise(tested.select("gene", label.alias("direction")), "tested")
    universe = labelled.select("gene").distinct()
    members = filter_net(net, universe, min_size, max_size).select("source", F.col("target").alias("gene")).distinct().join(universe, "gene", "left_semi")
    sizes = members.groupBy("source").agg(F.count(F.lit(1)).alias("K"))
    n = universe.agg(F.count(F.lit(1)).alias("N"))
    fg = labelled.filter(F.col("direction").isNotNull()).groupBy("direction").agg(F.count_distinct("gene").alias("n_fg")).filter(F.col("n_fg") >= min_foreground)
    k = members.join(labelled.filter(F.col("direction").isNotNull()), "gene").groupBy("source", "direction").agg(F.count_distinct("gene").alias("count"))
    grid = attach(with_levels(sizes, "direction", ["up", "down"]).join(fg, "direction"), n, [])
    out = grid.join(k, ["source", "direction"], "left").fillna(0, ["count"])
    a, b = F.col("count"), F.col("n_fg") - F.col("count")
    c, d = F.col("K") - F.col("count"), F.col("N") - F.col("K") - (F.col("n_fg") - F.col("count"))
    out = out.select(
        "source", "direction",
        F.log2(((a + 0.5) * (d + 0.5)) / ((b + 0.5) * (c + 0.5))).alias("score"),
        hypergeometric_sf(F.col("count"), F.col("N"), F.col("K"), F.col("n_fg")).alias("p"),
        "count",
        (F.col("count") / F.col("n_fg")).alias("gene_ratio"),
    )
    return bh_small(out, "p")


def gsva(pb: DataFrame, sample: str, net: DataFrame, min_size: int = 10, max_size: int = 500) -> DataFrame:
    """Kernel-rank walk score of each gene set in each sample.

    A gene's values over samples form one array (samples are bounded by the design); its
    Gaussian kernel CDF is taken there.  Genes are then ranked inside samples and the
    walk visits hit rows only.
    """
    libs = pb.groupBy(sample).agg(F.sum("count").cast("double").alias("lib"))
    samples = libs.agg(F.sort_array(F.collect_list(F.struct(F.col(sample).alias("s"), "lib"))).alias("all"))
    per_gene = pb.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct(F.col(sample), F.col("count").cast("double")))).alias("m"))
    packed = attach(per_gene, samples, []).select(
        "gene",
        F.transform("all", lambda x: x["s"]).alias("s"),
        F.transform(
            "all", lambda x: F.log2((F.coalesce(F.try_element_at("m", x["s"]), F.lit(0.0)) + 0.5) / (x["lib"] + 1.0) * 1e6)
        ).alias("x"),
    )

    def kernel(it):
        erf = np.vectorize(math.erf, otypes=[float])  # built in the task: a used ufunc cannot be pickled
        for pdf in it:
            out = []
            for x in pdf["x"]:
                v = np.asarray(x, float)
                h = v.std(ddof=1) / 4 if v.size > 1 else 0.0
                out.append([0.5] * v.size if h <= 0 else (0.5 * (1 + erf((v[:, None] - v[None, :]) / h / math.sqrt(2)))).mean(axis=1).tolist())
            yield pd.DataFrame({"gene": pdf["gene"], "s": pdf["s"], "z": out})

    z = packed.mapInPandas(kernel, "gene string, s array<string>, z array<double>")
    long = z.select("gene", F.explode(F.arrays_zip("s", "z")).alias("p")).select(F.col("p.s").alias(sample), "gene", F.round("p.z", 12).alias("metric"))
    placed = ranked_positions(long, [sample]).withColumn("weight", F.abs(F.col("total") / 2.0 - F.col("position")))
    members = filter_net(net, pb.select("gene").distinct(), min_size, max_size).select("source", F.col("target").alias("gene")).distinct()
    key = [sample, "source"]
    ends = _extremes(_walk(placed.join(members, "gene"), key), key)
    return ends.select(*key, (F.col("high") + F.col("low")).alias("score"))


# --- overlaps ----------------------------------------------------------------------------


def _sizes(sets: DataFrame) -> DataFrame:
    return sets.groupBy("source").agg(F.count(F.lit(1)).alias("size"))


def set_overlap(left: DataFrame, universe_size: int, right: DataFrame | None = None) -> DataFrame:
    """Intersection, Jaccard, expectation, fold and hypergeometric p of pairs of sets.

    Without ``right`` every unordered pair of the family.  Shared counts come from an
    equi-join on the element; pairs without a shared element come from the set names.
    """
    a = left.select("source", "target").distinct()
    b = a if right is None else right.select("source", "target").distinct()
    sa = _sizes(a).select(F.col("source").alias("set_a"), F.col("size").alias("size_a"))
    sb = _sizes(b).select(F.col("source").alias("set_b"), F.col("size").alias("size_b"))
    grid = with_levels(sa, "set_b", bounded_levels(b, "source")).join(sb, "set_b")
    shared = a.select(F.col("source").alias("set_a"), "target").join(b.select(F.col("source").alias("set_b"), "target"), "target")
    if right is None:
        grid = grid.filter(F.col("set_a") < F.col("set_b"))
        shared = shared.filter(F.col("set_a") < F.col("set_b"))
    n = shared.groupBy("set_a", "set_b").agg(F.count(F.lit(1)).alias("intersection"))
    out = grid.join(n, ["set_a", "set_b"], "left").fillna(0, ["intersection"])
    k, x, y = F.col("intersection"), F.col("size_a"), F.col("size_b")
    expected = x * y / F.lit(float(universe_size))
    out = out.withColumns(
        {
            "jaccard": k / (x + y - k),
            "overlap_coefficient": k / F.least(x, y),
            "expected": expected,
            "fold_enrichment": k / expected,
            "p": hypergeometric_sf(k, F.lit(universe_size).cast("long"), x, y),
        }
    )
    return bh_small(out, "p")


def exclusive_combinations(sets: DataFrame, min_size: int = 1) -> DataFrame:
    """Elements grouped by the exact collection of sets that hold them."""
    combo = sets.groupBy("target").agg(F.sort_array(F.collect_set("source")).alias("_c"))
    return (
        combo.groupBy(F.array_join("_c", "&").alias("combination"), F.size("_c").alias("degree"))
        .agg(F.count(F.lit(1)).alias("size"))
        .filter(F.col("size") >= min_size)
    )


def membership_matrix(sets: DataFrame) -> DataFrame:
    levels = bounded_levels(sets, "source")
    wide = sets.select("target", "source").distinct().groupBy("target").pivot("source", levels).count()
    return wide.select("target", *[F.col(f"`{v}`").isNotNull().alias(v) for v in levels])


def set_sizes(sets: DataFrame, universe: DataFrame) -> DataFrame:
    """Size, elements no other set holds, and elements outside the universe."""
    s = sets.select("source", "target").distinct()
    held = s.groupBy("target").agg(F.count(F.lit(1)).alias("_h"))
    inside = universe.select(F.col("gene").alias("target")).distinct().withColumn("_in", F.lit(True))
    return s.join(held, "target").join(inside, "target", "left").groupBy("source").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(F.col("_h") == 1).alias("n_exclusive"),
        F.count_if(F.col("_in").isNull()).alias("n_outside_universe"),
    )


def cross_membership(left: DataFrame, right: DataFrame) -> DataFrame:
    """Members shared by sets of two families, with the fraction of each side."""
    a, b = left.select("source", "target").distinct(), right.select("source", "target").distinct()
    sa = _sizes(a).select(F.col("source").alias("left"), F.col("size").alias("_a"))
    sb = _sizes(b).select(F.col("source").alias("right"), F.col("size").alias("_b"))
    n = a.select(F.col("source").alias("left"), "target").join(b.select(F.col("source").alias("right"), "target"), "target").groupBy("left", "right").agg(F.count(F.lit(1)).alias("n_shared"))
    return n.join(sa, "left").join(sb, "right").select(
        "left", "right", "n_shared", (F.col("n_shared") / F.col("_a")).alias("fraction_of_left"), (F.col("n_shared") / F.col("_b")).alias("fraction_of_right")
    )


def selection_overlap(sel_a: DataFrame, sel_b: DataFrame, ref_a: DataFrame, ref_b: DataFrame) -> DataFrame:
    """How much of two references' intersection each selection captured, and the fold over chance."""
    sel = [d.select("target").distinct() for d in (sel_a, sel_b)]
    ref = [d.select("target").distinct() for d in (ref_a, ref_b)]
    for s, r in zip(sel, ref):
        if s.join(r, "target", "left_anti").limit(1).count():
            raise ValueError("a selection is not contained in its reference")
    shared = ref[0].join(ref[1], "target", "left_semi")
    count = lambda d, n: d.agg(F.count(F.lit(1)).alias(n))
    out = count(shared, "shared_reference")
    for d, n in (
        (shared.join(sel[0], "target", "left_semi"), "captured_a"),
        (shared.join(sel[1], "target", "left_semi"), "captured_b"),
        (sel[0].join(sel[1], "target", "left_semi"), "intersection"),
    ):
        out = attach(out, count(d, n), [])
    expected = F.col("captured_a") * F.col("captured_b") / F.nullif(F.col("shared_reference"), F.lit(0))
    return out.withColumn("expected", expected).withColumn("fold", F.col("intersection") / F.nullif(F.col("expected"), F.lit(0.0)))


def select_top_bottom(df: DataFrame, value: str, key: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The k largest and k smallest rows of each group, without duplicates."""
    part = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    low = df.withColumn("_r", F.row_number().over(part.orderBy(F.col(value), F.col(key)))).filter(F.col("_r") <= k)
    high = df.withColumn("_r", F.row_number().over(part.orderBy(F.col(value).desc(), F.col(key).desc()))).filter(F.col("_r") <= k)
    return low.drop("_r").unionByName(high.drop("_r")).distinct()


def top_genes(de: DataFrame, n: int, by: Sequence[str] = (), fdr: str = "fdr", lfc: str = "logFC", alpha: float = 0.05) -> DataFrame:
    """The n strongest significant up and down genes of each group."""
    called = de.filter((F.col(fdr) < alpha) & (F.col(lfc) != 0)).withColumn(
        "direction", F.when(F.col(lfc) > 0, "up").otherwise("down")
    )
    order = W.partitionBy(*by, "direction").orderBy(F.abs(lfc).desc(), "gene")
    return called.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
