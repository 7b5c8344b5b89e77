"""Gene networks: correlations with implicit zeros, modules and their audits."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.levels import bounded_levels, with_levels
from ..functions.ranks import attach
from ..session import materialise
from .communicate import pagerank
from .communities import communities, numbered_by_size

#: Left genes of one pass over the cells, and values of one panel of adjacency rows (64 MB).
LEFT_AT_ONCE, PANEL = 1_000, 8_000_000


def cross_products(layer: DataFrame, left: Sequence[str]) -> DataFrame:
    """Σ over cells of x(left)·x(gene), for a list of left genes and every gene.

    Rows meet by cell in a range of tasks; each task multiplies blocks of its cells and
    emits one partial sum per pair it saw, so pairs are combined before the shuffle. A long
    list is taken in slices, so that a task holds sums of ``LEFT_AT_ONCE`` genes only.
    """
    if len(left) > LEFT_AT_ONCE:
        slices = [left[i : i + LEFT_AT_ONCE] for i in range(0, len(left), LEFT_AT_ONCE)]
        return reduce(DataFrame.unionByName, [cross_products(layer, part) for part in slices])
    index = {g: k for k, g in enumerate(left)}

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: dict[str, int] = {}
        total = np.zeros((len(index), 0))
        carry = None

        def fold(block: pd.DataFrame) -> None:
            nonlocal total
            for g in block["gene"].unique():
                names.setdefault(g, len(names))
            if len(names) > total.shape[1]:
                total = np.hstack([total, np.zeros((len(index), len(names) - total.shape[1]))])
            row = pd.factorize(block["cell"])[0]
            col = block["gene"].map(names).to_numpy()
            value = block["value"].to_numpy(float)
            side = block["gene"].map(index)
            known = side.notna().to_numpy()
            n = row.max() + 1
            for start in range(0, n, 256):
                here = (row >= start) & (row < start + 256)
                x = np.zeros((min(256, n - start), total.shape[1]))
                np.add.at(x, (row[here] - start, col[here]), value[here])
                t = np.zeros((x.shape[0], len(index)))
                both = here & known
                np.add.at(t, (row[both] - start, side[both].to_numpy(int)), value[both])
                total += t.T @ x

        for pdf in it:
            if carry is not None:
                pdf = pd.concat([carry, pdf])
            last = pdf["cell"].iloc[-1] if len(pdf) else None
            carry = pdf[pdf["cell"] == last]
            done = pdf[pdf["cell"] != last]
            if len(done):
                fold(done)
        if carry is not None and len(carry):
            fold(carry)
        genes = np.array(list(names), dtype=object)
        for k, g in enumerate(index):
            hit = np.flatnonzero(total[k])
            if hit.size:
                yield pd.DataFrame({"left": g, "gene": genes[hit], "xy": total[k, hit]})

    by_cell = layer.select("cell", "gene", "value").repartition("cell").sortWithinPartitions("cell")
    return by_cell.mapInPandas(run, "left string, gene string, xy double").groupBy("left", "gene").agg(F.sum("xy").alias("xy"))


def gene_correlation(layer: DataFrame, n_cells: int, left: Sequence[str]) -> DataFrame:
    """Pearson correlation of each left gene with every gene over all cells."""
    m = layer.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    m = materialise(m, "moments")
    xy = cross_products(layer, left)
    a = m.filter(F.col("gene").isin(*left)) if len(left) <= 200 else m
    grid = with_levels(m.select("gene", F.col("s").alias("sy"), F.col("ss").alias("syy")), "left", list(left))
    joined = grid.join(a.select(F.col("gene").alias("left"), F.col("s").alias("sx"), F.col("ss").alias("sxx")), "left").join(xy, ["left", "gene"], "left")
    n = float(n_cells)
    cov = F.coalesce("xy", F.lit(0.0)) - F.col("sx") * F.col("sy") / n
    var = (F.col("sxx") - F.col("sx") * F.col("sx") / n) * (F.col("syy") - F.col("sy") * F.col("sy") / n)
    return joined.select("left", "gene", (cov / F.sqrt(F.nullif(F.greatest(var, F.lit(0.0)), F.lit(0.0)))).alias("r"))


def _panels(corr: DataFrame, nodes: DataFrame, power: float) -> DataFrame:
    """``panel, gene, at, k, js, vs``: each gene's adjacency row, the genes it meets by number, and its degree."""
    of = lambda side, gene: nodes.select(F.col("gene").alias(side), F.col("at").alias(gene))
    pairs = corr.filter(F.col("left") < F.col("gene")).select("left", "gene", F.coalesce(F.pow(F.abs("r"), F.lit(power)), F.lit(0.0)).alias("a"))
    numbered = pairs.join(of("left", "i"), "left").join(of("gene", "j"), "gene").select("i", "j", "a").filter("a > 0")
    both = numbered.unionByName(numbered.select(F.col("j").alias("i"), F.col("i").alias("j"), "a"))
    rows = both.groupBy(F.col("i").alias("at")).agg(F.collect_list("j").alias("js"), F.collect_list("a").alias("vs"), F.sum("a").alias("k"))
    none = lambda c, t: F.coalesce(F.col(c), F.array().cast(t)).alias(c)
    return nodes.join(rows, "at", "left").select("panel", "gene", "at", F.coalesce("k", F.lit(0.0)).alias("k"), none("js", "array<int>"), none("vs", "array<double>"))


def topological_overlap(corr: DataFrame, genes: Sequence[str], power: float = 6.0) -> DataFrame:
    """``gene1, gene2, adjacency, tom``: topological overlap of the |r|^power adjacency, gene1 before gene2.

    The product of the adjacency with itself is taken in blocks: genes are dealt to panels, the rows of
    two panels meet in one group, and the genes they share are multiplied there. A panel has as many rows
    as fit in ``PANEL`` values whatever the number of genes, so a task holds two panels and one block of
    results; nothing passes through the driver. Unknown correlations (constant genes) count as zero.
    """
    spark = corr.sparkSession
    names = sorted(set(genes))
    many = len(names)
    width = max(1, PANEL // max(1, many))
    # numbers follow the names, so that a panel's genes are neighbours in their order
    listed = [(g, i, i // width) for i, g in enumerate(names)]
    nodes = spark.createDataFrame(listed, "gene string, at int, panel int")
    rows = materialise(_panels(corr, nodes, power), "adjacency")
    last = (many - 1) // width
    # a panel meets itself once, as its own partner
    later, earlier = F.sequence(F.col("panel"), F.lit(last)), F.filter(F.sequence(F.lit(0), F.col("panel")), lambda q: q < F.col("panel"))
    own = ["gene", "at", "k", "js", "vs"]
    low = rows.select("panel", F.explode(later).alias("other"), F.lit(True).alias("first"), *own)
    high = rows.select(F.explode(earlier).alias("_p"), F.col("panel").alias("other"), F.lit(False).alias("first"), *own).withColumnRenamed("_p", "panel")

    def dense(pdf: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(pdf), many))
        for k, (js, vs) in enumerate(zip(pdf["js"], pdf["vs"])):
            out[k, js] = vs
        return out

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        same = pdf["panel"].iloc[0] == pdf["other"].iloc[0]
        left, right = pdf[pdf["first"]], pdf if same else pdf[~pdf["first"]]
        a = dense(left)
        b = a if same else dense(right)
        direct = a[:, right["at"].to_numpy(int)]
        shared = a @ b.T
        floor = np.minimum(left["k"].to_numpy()[:, None], right["k"].to_numpy()[None, :])
        tom = (shared + direct) / (floor + 1 - direct)
        x, y = np.nonzero(left["at"].to_numpy()[:, None] < right["at"].to_numpy()[None, :])
        return pd.DataFrame({
            "gene1": left["gene"].to_numpy()[x], "gene2": right["gene"].to_numpy()[y], "adjacency": direct[x, y], "tom": tom[x, y],
        })

    schema = "gene1 string, gene2 string, adjacency double, tom double"
    return low.unionByName(high).groupBy("panel", "other").applyInPandas(block, schema)


def coexpression_modules(tom: DataFrame, resolution: float = 1.0, min_size: int = 10, seed: int = 0) -> DataFrame:
    """``gene, module``: communities of the overlap graph, the largest first; those under ``min_size`` are grey.

    Genes without any overlap are grey too, so every gene of ``tom`` has a row.
    """
    graph = overlap_graph(tom)
    found = numbered_by_size(communities(graph, resolution, seed))
    sizes = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    named = found.join(sizes, "cluster").select(F.col("cell").alias("gene"), F.when(F.col("_n") >= min_size, F.col("cluster")).alias("module"))
    every = tom.select(F.col("gene1").alias("gene")).unionByName(tom.select(F.col("gene2").alias("gene"))).distinct()
    return every.join(named, "gene", "left").select("gene", F.coalesce("module", F.lit("grey")).alias("module"))


def overlap_graph(tom: DataFrame) -> DataFrame:
    """Both directions of the positive overlaps, as a graph ``src, dst, weight``."""
    one = tom.filter("tom > 0").select(F.col("gene1").alias("src"), F.col("gene2").alias("dst"), F.col("tom").alias("weight"))
    return one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


#: Names of the sums of products that a step of the search for a first component needs.
_SPAN = ("w", "r", "p")
_SUMS = [(x, y) for i, x in enumerate(_SPAN) for y in _SPAN[i:]]


def _ritz(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the plane through a module's vector, its residual and its last step, the direction of largest variance."""
    for pdf in it:
        out = []
        for row in pdf.itertuples(index=False):
            gram, form = np.zeros((3, 3)), np.zeros((3, 3))
            for x, y in _SUMS:
                i, j = _SPAN.index(x), _SPAN.index(y)
                gram[i, j] = gram[j, i] = getattr(row, f"g_{x}{y}")
                form[i, j] = form[j, i] = getattr(row, f"f_{x}{y}")
            unit = np.where(np.diag(gram) > 1e-30, 1 / np.sqrt(np.maximum(np.diag(gram), 1e-30)), 0.0)
            values, vectors = np.linalg.eigh(gram * np.outer(unit, unit))
            base = vectors[:, values > 1e-10] / np.sqrt(values[values > 1e-10])
            base = unit[:, None] * base
            top = base @ np.linalg.eigh(base.T @ form @ base)[1][:, -1]
            out.append((row.module, *(top if top[0] >= 0 else -top)))
        yield pd.DataFrame(out, columns=["module", "c_w", "c_r", "c_p"])


def first_components(corr: DataFrame, modules: DataFrame, tolerance: float = 1e-7, max_steps: int | None = None) -> DataFrame:
    """``module, gene, weight, eigenvalue, residual``: leading eigenvector of each module's correlation matrix.

    All modules advance together. A step multiplies the correlations of pairs within modules with the
    residuals (a join on the gene and a sum) and takes the best vector of the plane that vector, residual
    and last step span, so the share of variance only rises. It ends when no module's residual
    ‖Rw − λw‖ exceeds ``tolerance`` · λ. A limit that is given and reached warns; ``residual`` tells how far each came.
    Weights have length one and a sum of at least zero. Constant genes have no row.
    """
    side = lambda gene, module: modules.select(F.col("gene").alias(gene), F.col("module").alias(module))
    known = corr.filter(F.col("r").isNotNull()).join(side("left", "module"), "left").join(side("gene", "_m"), "gene")
    inside = materialise(known.filter(F.col("module") == F.col("_m")).select("module", "left", "gene", "r"), "inside")

    def times(state: DataFrame, vector: str) -> DataFrame:
        of = state.select("module", F.col("gene").alias("left"), F.col(vector).alias("_x"))
        return inside.join(of, ["module", "left"]).groupBy("module", "gene").agg(F.sum(F.col("r") * F.col("_x")).alias(f"a{vector}"))

    own = inside.filter(F.col("left") == F.col("gene")).select("module", "gene")
    # near the module's mean profile, with a hashed tilt so that no direction is missing from the start
    start = own.withColumn("w", 1 + F.xxhash64("gene") / 1e20)
    zero = F.lit(0.0)
    state = start.join(times(start, "w"), ["module", "gene"]).select("module", "gene", "w", "aw", zero.alias("p"), zero.alias("ap"))
    state, step = materialise(state, "components"), 0
    while True:
        sums = state.groupBy("module").agg(F.sum(F.col("w") * F.col("w")).alias("_ww"), F.sum(F.col("w") * F.col("aw")).alias("_wa"))
        size = F.sqrt("_ww")
        scaled = state.join(sums, "module").select("module", "gene", *((F.col(c) / size).alias(c) for c in ("w", "aw", "p", "ap")), (F.col("_wa") / F.col("_ww")).alias("value"))
        scaled = materialise(scaled.withColumn("r", F.col("aw") - F.col("value") * F.col("w")), "scaled")
        off = scaled.groupBy("module").agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("residual"), F.first("value").alias("v"), F.sum("w").alias("_s"))
        off = materialise(off, "residuals")
        open_ = off.filter(F.col("residual") > F.lit(tolerance) * F.abs("v")).count()
        if not open_ or max_steps is not None and step >= max_steps:
            if open_:
                warnings.warn(f"first components have not settled after {max_steps} steps: {open_} modules are open", stacklevel=2)
            sign = F.when(F.col("_s") < 0, -1.0).otherwise(1.0)
            return scaled.join(off, "module").select("module", "gene", (sign * F.col("w")).alias("weight"), F.col("value").alias("eigenvalue"), "residual")
        wide = materialise(scaled.join(times(scaled, "r"), ["module", "gene"]), "products")
        forms = wide.groupBy("module").agg(
            *(F.sum(F.col(x) * F.col(y)).alias(f"g_{x}{y}") for x, y in _SUMS), *(F.sum(F.col(x) * F.col(f"a{y}")).alias(f"f_{x}{y}") for x, y in _SUMS)
        )
        turn = forms.mapInPandas(_ritz, "module string, c_w double, c_r double, c_p double")
        step_of = lambda a: F.col("c_r") * F.col(f"{a}r") + F.col("c_p") * F.col(f"{a}p")
        moved = wide.join(turn, "module").select("module", "gene", (F.col("c_w") * F.col("w") + step_of("")).alias("w"), (F.col("c_w") * F.col("aw") + step_of("a")).alias("aw"), step_of("").alias("p"), step_of("a").alias("ap"))
        step += 1
        if step % 16 == 0:  # products carried along drift by rounding; they are taken anew
            moved = materialise(moved.drop("aw", "ap"), "moved")
            moved = moved.join(times(moved, "w"), ["module", "gene"]).join(times(moved, "p"), ["module", "gene"])
        state = materialise(moved, "components")


def eigengenes(layer: DataFrame, cells: DataFrame, weights: DataFrame) -> DataFrame:
    """``cell, module, e``: projection of the cells' standardised values on each module's weights, centred."""
    n = cells.agg(F.count(F.lit(1)).cast("double").alias("n"))
    m = layer.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    m = attach(m, n, []).select("gene", (F.col("s") / F.col("n")).alias("mean"), F.sqrt(F.greatest(F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), F.lit(2.0)), F.lit(0.0))).alias("sd"))
    scaled = weights.join(m.filter("sd > 0"), "gene").select("module", "gene", (F.col("weight") / F.col("sd")).alias("w"), (F.col("weight") * F.col("mean") / F.col("sd")).alias("off"))
    return materialise(_profile(layer, cells, materialise(scaled, "weights"), bounded_levels(weights, "module")), "eigengenes")


def _profile(layer: DataFrame, cells: DataFrame, weights: DataFrame, levels: list) -> DataFrame:
    """``cell, module, e``: Σ w·value of a module's genes less Σ off; ``weights`` is ``(module, gene, w, off)``."""
    offset = weights.groupBy("module").agg(F.sum("off").alias("_o"))
    raw = layer.join(weights, "gene").groupBy("cell", "module").agg(F.sum(F.col("w") * F.col("value")).alias("e"))
    grid = with_levels(cells.select("cell"), "module", levels)
    return grid.join(raw, ["cell", "module"], "left").join(offset, "module").select("cell", "module", (F.coalesce("e", F.lit(0.0)) - F.col("_o")).alias("e"))


def module_membership(layer: DataFrame, cells: DataFrame, modules: DataFrame) -> DataFrame:
    """kME: correlation of each gene with its module's mean standardised profile.

    The profile is a weighted sum of a module's genes, so its covariance with a gene is
    a sum over module genes; it is formed per cell once and correlated with all genes.
    """
    n = cells.agg(F.count(F.lit(1)).cast("double").alias("n"))
    m = attach(layer.groupBy("gene").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss")), n, []).withColumn(
        "sd", F.sqrt(F.greatest(F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), F.lit(2.0)), F.lit(0.0)))
    )
    m = materialise(m, "moments")
    sized = modules.join(modules.groupBy("module").agg(F.count(F.lit(1)).alias("_k")), "module").join(m.filter(F.col("sd") > 0), "gene")
    weights = sized.select("module", "gene", (1 / (F.col("sd") * F.col("_k"))).alias("w"), (F.col("s") / F.col("n") / (F.col("sd") * F.col("_k"))).alias("off"))
    eigen = _profile(layer, cells, materialise(weights, "weights"), bounded_levels(modules, "module"))
    return materialise(eigen, "eigengenes"), m, n


def kme(layer: DataFrame, cells: DataFrame, modules: DataFrame, eigen: DataFrame | None = None) -> DataFrame:
    """Each gene's correlation with its module's profile, or with that module's values in ``eigen``."""
    mean, m, _ = module_membership(layer, cells, modules)
    eigen = mean if eigen is None else eigen
    se = eigen.groupBy("module").agg(F.sum("e").alias("se"), F.sum(F.col("e") * F.col("e")).alias("see"))
    xe = layer.join(modules, "gene").join(eigen, ["cell", "module"]).groupBy("gene", "module").agg(F.sum(F.col("value") * F.col("e")).alias("xe"))
    j = xe.join(m, "gene").join(se, "module")
    cov = F.col("xe") - F.col("s") * F.col("se") / F.col("n")
    var = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) * (F.col("see") - F.col("se") * F.col("se") / F.col("n"))
    return j.select("gene", "module", (cov / F.sqrt(F.nullif(var, F.lit(0.0)))).alias("kme"))


def module_trait_correlation(layer: DataFrame, cells: DataFrame, modules: DataFrame, trait: str, eigen: DataFrame | None = None) -> DataFrame:
    """Correlation of each module's profile, or of its values in ``eigen``, with a column of the cells."""
    if eigen is None:
        eigen, _, _ = module_membership(layer, cells, modules)
    return eigen.join(cells.select("cell", F.col(trait).cast("double").alias("_t")), "cell").groupBy("module").agg(F.corr("e", "_t").alias("r"))


def module_graph(modules: DataFrame, k: int) -> DataFrame:
    """Pairs among each module's k best genes by kME, weighted by the smaller kME; grey is skipped."""
    order = W.partitionBy("module").orderBy(F.col("kme").desc(), "gene")
    hubs = modules.filter(F.col("module") != "grey").withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    a = hubs.select("module", F.col("gene").alias("gene1"), F.col("kme").alias("_a"), F.col("_r").alias("_i"))
    b = hubs.select("module", F.col("gene").alias("gene2"), F.col("kme").alias("_b"), F.col("_r").alias("_j"))
    return a.join(b, "module").filter(F.col("_i") < F.col("_j")).select("module", "gene1", "gene2", F.least("_a", "_b").alias("weight"))


def cap_edges(edges: DataFrame, modules: DataFrame, max_edges: int) -> DataFrame:
    """Strongest edges per module and across modules, then the strongest leftovers up to the cap."""
    m1 = modules.select(F.col("gene").alias("gene1"), F.col("module").alias("_m1"))
    m2 = modules.select(F.col("gene").alias("gene2"), F.col("module").alias("_m2"))
    e = edges.join(m1, "gene1").join(m2, "gene2").withColumn("_unit", F.when(F.col("_m1") == F.col("_m2"), F.col("_m1")))
    e = materialise(e.select("gene1", "gene2", "weight", "_m1", "_m2", "_unit"), "edges")
    k = max(1, e.select(F.explode(F.array("_m1", "_m2")).alias("m")).agg(F.count_distinct("m")).first()[0])
    strongest = [F.col("weight").desc(), F.col("gene1"), F.col("gene2")]
    own = ["gene1", "gene2", "weight"]
    # each selection keeps its n strongest edges on the map side; no unit is sorted whole
    order = W.partitionBy("_unit").orderBy(*strongest)
    inside = e.filter(F.col("_unit").isNotNull()).withColumn("_r", F.row_number().over(order)).filter(
        F.col("_r") <= max(1, max_edges // (3 * k))
    )
    across = e.filter(F.col("_unit").isNull()).orderBy(*strongest).limit(max(1, max_edges // 4))
    sure = materialise(inside.select(*own).unionByName(across.select(*own)).withColumn("_sure", F.lit(1)), "sure")
    rest = e.select(*own).join(sure.select("gene1", "gene2"), ["gene1", "gene2"], "left_anti").orderBy(*strongest).limit(max_edges)
    return sure.unionByName(rest.withColumn("_sure", F.lit(0))).orderBy(F.col("_sure").desc(), *strongest).limit(max_edges).select(*own)


def detection_log_dor(counts: DataFrame, cells: DataFrame, group: str) -> DataFrame:
    """Log diagnostic odds ratio of detection per gene and group, half added to each count."""
    sizes = cells.groupBy(group).agg(F.count(F.lit(1)).alias("n_g"))
    n = cells.agg(F.count(F.lit(1)).alias("n"))
    found = counts.filter(F.col("value") > 0)
    tp = found.join(cells.select("cell", group), "cell").groupBy("gene", group).agg(F.count(F.lit(1)).alias("tp"))
    total = tp.groupBy("gene").agg(F.sum("tp").alias("t"))
    grid = attach(with_levels(total, group, bounded_levels(cells, group)).join(sizes, group), n, []).join(tp, ["gene", group], "left").fillna(0, ["tp"])
    fn, fp = F.col("n_g") - F.col("tp"), F.col("t") - F.col("tp")
    tn = F.col("n") - F.col("n_g") - fp
    return grid.select("gene", F.col(group).alias("group"), F.log(((F.col("tp") + 0.5) / (fp + 0.5)) / ((fn + 0.5) / (tn + 0.5))).alias("log_dor"))


def community_relevance(edges: DataFrame, communities: DataFrame, dor: DataFrame) -> DataFrame:
    """z over groups of the PageRank-weighted log odds of each community's genes."""
    inside = (
        edges.join(communities.select(F.col("gene").alias("src"), "community"), "src")
        .join(communities.select(F.col("gene").alias("dst"), F.col("community").alias("_c")), "dst")
        .filter(F.col("community") == F.col("_c"))
        .select("community", "src", "dst", "weight")
    )
    both = inside.unionByName(inside.select("community", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    seen = edges.select(F.col("src").alias("gene")).unionByName(edges.select(F.col("dst").alias("gene"))).distinct()
    nodes = communities.join(seen, "gene", "left_semi").select("community", F.col("gene").alias("node"))
    pr = pagerank(materialise(both, "community"), ["community"], nodes=nodes)
    score = pr.join(dor, pr.node == dor.gene).groupBy("community", "group").agg(F.sum(F.col("pagerank") * F.col("log_dor")).alias("_s"))
    w = W.partitionBy("community")
    sd = F.stddev_pop("_s").over(w)
    return score.select("community", "group", F.when(sd > 0, (F.col("_s") - F.avg("_s").over(w)) / sd).otherwise(0.0).alias("z_score"))


def tf_target_links(layer: DataFrame, n_cells: int, tfs: Sequence[str], k: int) -> DataFrame:
    """The k most correlated targets of each TF, signed."""
    r = gene_correlation(layer, n_cells, tfs).filter((F.col("left") != F.col("gene")) & F.col("r").isNotNull())
    order = W.partitionBy("left").orderBy(F.abs("r").desc(), "gene")
    return r.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        F.col("left").alias("tf"), F.col("gene").alias("target"), F.abs("r").alias("importance"), F.signum("r").cast("int").alias("sign"), "rank"
    )


def regulons(links: DataFrame, motif_support: DataFrame | None = None) -> DataFrame:
    """Positive links as gene sets, optionally only those with motif support."""
    out = links.filter(F.col("sign") > 0).select(F.col("tf").alias("source"), "target", F.col("importance").alias("weight"))
    if motif_support is not None:
        out = out.join(motif_support.select("source", "target").distinct(), ["source", "target"], "left_semi")
    return out
