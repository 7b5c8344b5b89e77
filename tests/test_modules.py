"""Coexpression: blocked overlap, modules, first components and what follows from them."""

from __future__ import annotations

import numpy as np
import pytest

from cohortlens.operators import genenet as n


@pytest.fixture(scope="module")
def planted(spark):
    """300 cells, three modules of 8 genes that follow one factor each, four genes on their own and a constant one."""
    rng = np.random.default_rng(5)
    factors = rng.normal(size=(300, 3))
    x = np.hstack([factors[:, [k]] * rng.uniform(0.8, 1.5, 8) + rng.normal(size=(300, 8)) * 0.6 for k in range(3)] + [rng.normal(size=(300, 4))])
    x = np.exp(x * 0.5)
    names = [f"g{j:02d}" for j in range(x.shape[1])]
    rows = [(f"c{i}", g, float(x[i, j])) for i in range(300) for j, g in enumerate(names)]
    layer = spark.createDataFrame(rows + [(f"c{i}", "still", 2.0) for i in range(300)], "cell string, gene string, value double")
    cells = spark.createDataFrame([(f"c{i}", float(factors[i, 0])) for i in range(300)], "cell string, level double")
    return x, names, layer.cache(), cells


@pytest.fixture(scope="module")
def correlation(planted):
    _, names, layer, _ = planted
    return n.gene_correlation(layer, 300, names + ["still"]).cache()


def test_long_lists_are_taken_in_slices(planted, correlation, monkeypatch):
    _, names, layer, _ = planted
    monkeypatch.setattr(n, "LEFT_AT_ONCE", 10)
    got = n.gene_correlation(layer, 300, names + ["still"])
    key = lambda df: {(q.left, q.gene): q.r for q in df.collect()}
    one, many = key(correlation), key(got)
    assert one.keys() == many.keys() and len(one) == 29 * 29
    assert all(v is None and many[k] is None or v == pytest.approx(many[k], abs=1e-9) for k, v in one.items())


@pytest.mark.parametrize("panel", [8_000_000, 29 * 4, 1])
def test_overlap_is_the_same_for_panels_of_any_width(planted, correlation, monkeypatch, panel):
    x, names, _, _ = planted
    monkeypatch.setattr(n, "PANEL", panel)
    a = np.abs(np.corrcoef(x.T)) ** 6
    np.fill_diagonal(a, 0)
    k = a.sum(axis=1)
    want = (a @ a + a) / (np.minimum(k[:, None], k[None, :]) + 1 - a)
    every = names + ["still"] if panel > 1 else names[:5]
    got = n.topological_overlap(correlation, every + every[:2], 6.0).collect()
    assert len(got) == len(every) * (len(every) - 1) // 2
    if panel == 1:
        a = a[:5, :5]
        k = a.sum(axis=1)
        want = (a @ a + a) / (np.minimum(k[:, None], k[None, :]) + 1 - a)
    for q in got:
        assert q.gene1 < q.gene2
        if "still" in (q.gene1, q.gene2):
            assert q.adjacency == 0 and q.tom == 0
        else:
            i, j = int(q.gene1[1:]), int(q.gene2[1:])
            assert q.adjacency == pytest.approx(a[i, j], abs=1e-12) and q.tom == pytest.approx(want[i, j], abs=1e-12)


def test_planted_modules_and_grey_genes(planted, correlation):
    _, names, _, _ = planted
    tom = n.topological_overlap(correlation, names + ["still"], 6.0)
    got = {q.gene: q.module for q in n.coexpression_modules(tom, min_size=6).collect()}
    assert len(got) == 29 and got["still"] == "grey"
    blocks = [{got[g] for g in names[8 * k : 8 * k + 8]} for k in range(3)]
    assert all(len(found) == 1 for found in blocks) and len(set.union(*blocks)) == 3 and "grey" not in set.union(*blocks)


def test_first_components_equal_a_full_decomposition(spark, planted, correlation):
    x, names, layer, cells = planted
    of = {g: "abc"[j // 8] if j < 24 else "noise" for j, g in enumerate(names)} | {"still": "a"}
    modules = spark.createDataFrame([*of.items()], "gene string, module string")
    found = n.first_components(correlation, modules, 1e-9).cache()
    got = {(q.module, q.gene): q for q in found.collect()}
    assert ("a", "still") not in got and len(got) == 28
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    profile = {(q.cell, q.module): q.e for q in n.eigengenes(layer, cells, found).collect()}
    for m in ("a", "b", "c", "noise"):
        own = [j for j, g in enumerate(names) if of[g] == m]
        values, vectors = np.linalg.eigh(np.corrcoef(x[:, own].T))
        want = vectors[:, -1] * (1 if vectors[:, -1].sum() >= 0 else -1)
        assert np.allclose([got[m, names[j]].weight for j in own], want, atol=1e-6)
        assert got[m, names[own[0]]].eigenvalue == pytest.approx(values[-1], abs=1e-9)
        assert np.allclose([profile[f"c{i}", m] for i in range(300)], z[:, own] @ want, atol=1e-5)
    # squared correlations with the first component add up to its eigenvalue
    kme = {(q.module, q.gene): q.kme for q in n.kme(layer, cells, modules, n.eigengenes(layer, cells, found)).collect() if q.kme is not None}
    for m in "abc":
        assert sum(v * v for (w, _), v in kme.items() if w == m) == pytest.approx(got[m, names[8 * "abc".index(m)]].eigenvalue, abs=1e-6)
    trait = {q.module: q.r for q in n.module_trait_correlation(layer, cells, modules, "level", n.eigengenes(layer, cells, found)).collect()}
    level = [q.level for q in cells.collect()]
    for m in "abc":
        assert trait[m] == pytest.approx(np.corrcoef([profile[f"c{i}", m] for i in range(300)], level)[0, 1], abs=1e-9)


def test_large_module_with_close_eigenvalues_and_a_limit(spark):
    """120 genes without any common factor: neighbouring eigenvalues differ by a few hundredths."""
    rng = np.random.default_rng(8)
    matrix = np.corrcoef(rng.normal(size=(200, 120)).T)
    rows = [(f"g{i:03d}", f"g{j:03d}", float(matrix[i, j])) for i in range(120) for j in range(120)]
    corr = spark.createDataFrame(rows, "left string, gene string, r double")
    modules = spark.createDataFrame([(f"g{i:03d}", "m") for i in range(120)], "gene string, module string")
    values, vectors = np.linalg.eigh(matrix)
    got = n.first_components(corr, modules, 1e-6).toPandas().sort_values("gene")
    assert got.eigenvalue.iloc[0] == pytest.approx(values[-1], abs=1e-8)
    assert abs(got.weight.to_numpy() @ vectors[:, -1]) == pytest.approx(1.0, abs=1e-6)
    with pytest.warns(UserWarning, match="not settled"):
        short = n.first_components(corr, modules, 1e-6, max_steps=1)
    assert short.filter("residual > 1e-6").count() == 120
    assert n.first_components(corr, modules.limit(0)).count() == 0
