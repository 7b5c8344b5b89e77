"""Neighbours, communities, ranks and paths against brute force and planted structure."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import communicate, embed, fits, genenet, trajectory
from cohortlens.operators import neighbors as k


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(scale=10, size=(3, 4))
    x = np.vstack([c + rng.normal(size=(n, 4)) for c, n in zip(centres, (120, 40, 40))])
    x[10:40] = x[10]  # a run of copies: ties go to the smaller name
    names = [f"p{i:03d}" for i in range(len(x))]
    df = spark.createDataFrame([(n, v.tolist(), str(int(i >= 120) + int(i >= 160))) for i, (n, v) in enumerate(zip(names, x))], "cell string, vec array<double>, label string")
    return df, names, x


def brute(names, x, n):
    out = {}
    for i, a in enumerate(names):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[j], names[j]))[:n]
        out[a] = [names[j] for j in order]
    return out


@pytest.mark.parametrize("block,per_pivot", [(4000, 20_000), (16, 20_000), (16, 20)])
def test_knn_is_exact_with_blocks_and_pivots(points, monkeypatch, block, per_pivot):
    """One block; many blocks under one pivot; many pivots with pruning."""
    df, names, x = points
    monkeypatch.setattr(k, "BLOCK", block)
    monkeypatch.setattr(k, "ROWS_PER_PIVOT", per_pivot)
    got = k.knn(df, df, 6).toPandas().sort_values(["cell", "rank"]).groupby("cell")["neighbor"].apply(list).to_dict()
    assert got == brute(names, x, 6)


def test_clusters_recover_planted_groups(points):
    df, names, _ = points
    spread = df.filter(~F.col("cell").between("p011", "p039"))
    graph = k.knn_graph(k.knn(spread, spread, 8))
    got = k.graph_cluster(graph, 0.3).join(spread.select("cell", "label"), "cell")
    mixed = got.groupBy("cluster").agg(F.count_distinct("label").alias("n")).filter("n > 1").count()
    assert mixed == 0
    assert k.connected_components(graph).select("c").distinct().count() <= got.select("cluster").distinct().count()


def test_transfer_and_entropy(points):
    df, _, _ = points
    nb = k.knn(df, df, 5)
    assert k.transfer_labels(nb, df).join(df.select("cell", F.col("label").alias("t")), "cell").filter("label <> t").count() == 0
    assert k.neighborhood_entropy(nb, df).agg(F.max(F.abs("label_entropy"))).first()[0] < 1e-12


def test_pagerank_matches_dense_solution(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 0.5), ("d", "c", 3.0), ("b", "sink", 1.0)]
    names = ["a", "b", "c", "d", "sink"]
    p = np.zeros((5, 5))
    for s, t, w in edges:
        p[names.index(s), names.index(t)] = w
    total = p.sum(axis=1, keepdims=True)
    p = np.where(total > 0, p / np.where(total == 0, 1, total), 0.2)
    r = np.full(5, 0.2)
    for _ in range(500):
        r = 0.15 / 5 + 0.85 * r @ p
    got = {x.node: x.pagerank for x in communicate.pagerank(spark.createDataFrame(edges, "src string, dst string, weight double")).collect()}
    assert np.allclose([got[n] for n in names], r, atol=1e-7)


def test_pseudotime_and_fates_on_a_line(spark):
    n = 8
    e = [(f"n{i}", f"n{i + 1}", 1.0, 1.0) for i in range(n - 1)]
    e += [(b, a, w, d) for a, b, w, d in e] + [("x", "y", 1.0, 1.0), ("y", "x", 1.0, 1.0)]
    edges = spark.createDataFrame(e, "src string, dst string, weight double, distance double")
    pt = trajectory.graph_pseudotime(edges, spark.createDataFrame([("n0",)], "cell string"))
    got = {r.cell: r.pseudotime for r in pt.collect()}
    assert got["x"] is None and got["n0"] == 0.0 and got["n7"] == 1.0 and got["n3"] == pytest.approx(3 / 7)
    terminal = spark.createDataFrame([("n7", "end"), ("n0", "start")], "cell string, fate string")
    fates = trajectory.fate_probabilities(edges, pt, terminal, bias=5.0, n_iter=60)
    sums = fates.groupBy("cell").agg(F.sum("prob").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    end = {r.cell: r.prob for r in fates.filter("fate = 'end'").collect()}
    assert end["n7"] == 1.0 and end["n6"] > 0.9


def test_profile_repeats_empty_bins_and_divides_by_five(spark):
    cells = spark.createDataFrame([(f"c{i}", float(i)) for i in range(4)], "cell string, pt double")
    layer = spark.createDataFrame([(f"c{i}", "g", 5.0) for i in range(4)], "cell string, gene string, value double")
    got = [r.value for r in trajectory.pseudotime_profile(layer, cells, "pt", 8).orderBy("bin").collect()]
    assert got == [3.0, 4.0, 5.0, 5.0, 5.0, 5.0, 4.0, 3.0]


def test_rank_sum_markers_with_implicit_zeros(spark):
    rng = np.random.default_rng(2)
    v = rng.poisson(1.0, size=40).astype(float)
    c = np.where(np.arange(40) < 15, "a", "b")
    cells = spark.createDataFrame([(f"c{i}", str(c[i])) for i in range(40)], "cell string, k string")
    layer = spark.createDataFrame([(f"c{i}", "g", float(v[i])) for i in range(40) if v[i]], "cell string, gene string, value double")
    rank = pd.Series(v).rank().to_numpy()
    _, m = np.unique(v, return_counts=True)
    sd = np.sqrt(15 * 25 / 12 * (41 - (m**3 - m).sum() / (40 * 39)))
    want = (rank[:15].sum() - 15 * 41 / 2) / sd
    got = {r.k: r.score for r in k.cluster_markers(layer, cells, "k").collect()}
    assert got["a"] == pytest.approx(want) and got["b"] == pytest.approx(-want)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(7)
    x = rng.poisson(1.5, size=(60, 6)).astype(float)
    layer = spark.createDataFrame([(f"c{i}", f"g{j}", float(x[i, j])) for i in range(60) for j in range(6) if x[i, j]], "cell string, gene string, value double")
    cells = spark.createDataFrame([(f"c{i}",) for i in range(60)], "cell string")
    return x, layer, cells


def test_correlation_counts_zeros(matrix):
    x, layer, _ = matrix
    want = np.corrcoef(x.T)
    for n in (1, 9):
        got = genenet.gene_correlation(layer.repartition(n), 60, [f"g{j}" for j in range(6)]).collect()
        for r in got:
            assert r.r == pytest.approx(want[int(r.left[1]), int(r.gene[1])], abs=1e-12)


def test_pca_and_projection(matrix):
    x, layer, cells = matrix
    loadings, means, ratios = embed.fit_pca(layer, cells, [f"g{j}" for j in range(6)], 3)
    u, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(ratios, (s**2 / (s**2).sum())[:3])
    scores = embed.project_pca(layer, cells, loadings, means).toPandas().pivot(index="cell", columns="component", values="score")
    want = (u * s)[:, :3]
    got = scores.loc[[f"c{i}" for i in range(60)]].to_numpy()
    for c in range(3):
        assert np.allclose(np.abs(got[:, c]), np.abs(want[:, c]), atol=1e-8)
    assert embed.select_n_pcs([0.6, 0.2, 0.05, 0.04, 0.03], 10) in (2, 3)


def test_factorisation_finds_planted_programs(spark):
    rng = np.random.default_rng(3)
    h = np.array([[5, 5, 5, 0, 0, 0], [0, 0, 0, 5, 5, 5]], float)
    w = rng.random((80, 2))
    v = rng.poisson(w @ h).astype(float)
    layer = spark.createDataFrame([(f"c{i}", f"g{j}", float(v[i, j])) for i in range(80) for j in range(6) if v[i, j]], "cell string, gene string, value double")
    spectra, usages, stability = fits.consensus_nmf(layer, [f"g{j}" for j in range(6)], 2, runs=2, max_iter=15, n_top=3)
    tops = {frozenset(r.gene for r in spectra.filter((F.col("program") == p) & F.col("top")).collect()) for p in (0, 1)}
    assert tops == {frozenset(["g0", "g1", "g2"]), frozenset(["g3", "g4", "g5"])}
    assert usages.filter("usage < 0").count() == 0 and stability.filter("stability > 0.9").count() == 2


def test_simulated_doublets_stay_in_their_sample(spark):
    cells = spark.createDataFrame([(f"{s}{i}", s) for s in "ab" for i in range(7)], "cell string, s string")
    counts = cells.select("cell", F.lit("g").alias("gene"), F.lit(1.0).alias("value"))
    sim = fits.simulate_doublets(counts, cells, "s")
    assert sim.count() == 6 and sim.filter("value <> 2").count() == 0


def test_blocks_hold_neighbouring_pivots_and_stay_few():
    """Blocks grow with the table: 720,000 rows meet in 24 blocks, and a pivot with most rows is cut."""
    rng = np.random.default_rng(3)
    p = rng.normal(size=(144, 8))
    between = k._distances(p, p)
    first, parts = k._blocks(np.full(144, 5_000), between, 30_000)
    assert (parts == 1).all() and first.max() + 1 == 24 and np.bincount(first).max() == 6
    count = np.array([200_000, 10, 20, 30])
    first, parts = k._blocks(count, between[:4, :4], 30_000)
    assert parts.tolist() == [7, 1, 1, 1] and set(first[1:]) == {7}


def test_a_search_is_run_once(points):
    """Graphs and votes read its rows several times."""
    df, _, _ = points
    plan = k.knn_graph(k.knn(df, df, 3))._jdf.queryExecution().toString()
    assert "CoGroups" not in plan and plan.count("Relation") > 0


def test_components_read_their_edges_once(spark, points):
    df, names, x = points
    read = spark.sparkContext.accumulator(0)

    def counted(it):
        for pdf in it:
            read.add(len(pdf))
            yield pdf

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("f", "f")], "src string, dst string").mapInPandas(counted, "src string, dst string")
    got = {r.node: r.c for r in k.connected_components(edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f"}
    assert read.value == 4


def test_refined_labels_build_their_walk_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(it):
        for pdf in it:
            read.add(len(pdf))
            yield pdf

    schema = "src string, dst string, weight double"
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 3.0), ("c", "b", 3.0)], schema).mapInPandas(counted, schema)
    layer = spark.createDataFrame([("a", "g", 4.0), ("c", "h", 2.0)], "cell string, gene string, value double")
    groups = spark.createDataFrame([("X", "g"), ("Y", "h")], "source string, target string")
    cells = spark.createDataFrame([(c,) for c in "abc"], "cell string")
    got = {r.cell: (r.X, r.Y, r.call) for r in k.refine_labels(edges, layer, groups, cells, {"X": 0.1, "Y": 0.1}).collect()}
    # one step: a and c read b (0, 0), b reads a/4 + 3c/4; two steps: a and c read that of b, b reads zeros
    assert got == {"a": (0.5, 0.75, "Y"), "b": (0.5, 0.75, "Y"), "c": (0.5, 0.75, "Y")}
    assert read.value == 4


def test_network_difference_reads_its_arms_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(it):
        for pdf in it:
            read.add(len(pdf))
            yield pdf

    schema = "src string, dst string, weight double"
    arm = lambda *rows: spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    case, control = arm(("a", "b", 1.0), ("a", "b", 1.0), ("b", "a", 1.0)), arm(("a", "b", 0.5), ("b", "a", 1.0))
    got = {r.node: (r.Listener, r.Influencer, round(r.Pagerank, 9)) for r in communicate.topology_difference(case, control).collect()}
    assert got == {"a": (0.0, 1.5, 0.0), "b": (1.5, 0.0, 0.0)}
    assert read.value == 5


def test_components_broadcast_nothing(spark, monkeypatch):
    """What a round would broadcast is built in the driver and grows with the nodes."""
    plans, write = [], k.materialise

    def noted(df, name="step"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(k, "materialise", noted)
    edges = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(12)] + [("x", "y")], "src string, dst string")
    got = {r.node: r.c for r in k.connected_components(edges).collect()}
    assert got == {f"n{i:02d}": "n00" for i in range(13)} | {"x": "x", "y": "x"}
    assert len(plans) > 2 and not any("Broadcast" in p for p in plans)
