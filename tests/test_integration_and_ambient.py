"""Integration scores by hand and a planted contamination."""

from __future__ import annotations

import numpy as np
import pytest

from cohortlens.operators import ambient
from cohortlens.operators import integration as g
from cohortlens.operators import quality as q


def test_connectivity_counts_lonely_cells(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "x"), ("x", "c"), ("x", "y"), ("y", "x")], "src string, dst string")
    labels = spark.createDataFrame([(c, "one") for c in "abcd"] + [(c, "two") for c in "xy"], "cell string, label string")
    got = {r.label: (r.n, r.largest, r.connectivity) for r in g.graph_connectivity(edges, labels).collect()}
    assert got == {"one": (4, 2, 0.5), "two": (2, 2, 1.0)}


def test_batch_silhouette_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    label, batch = rng.integers(0, 2, 40), rng.integers(0, 3, 40)
    label[:3], batch[:3] = 7, 5  # one batch only: no row
    batch[3], label[3] = 9, 0  # alone in its batch: silhouette 0
    rows = [(f"c{i}", [float(v) for v in x[i]], str(label[i]), str(batch[i])) for i in range(40)]
    df = spark.createDataFrame(rows, "cell string, vec array<double>, label string, batch string")
    got = {r.label: r.score for r in g.batch_silhouette(df.select("cell", "vec"), df.select("cell", "label"), df.selectExpr("cell", "batch label")).collect()}
    want = {}
    for own in (0, 1):
        s = []
        for i in np.flatnonzero(label == own):
            d = lambda b: [((x[i] - x[j]) ** 2).sum() for j in np.flatnonzero((label == own) & (batch == b)) if j != i]  # noqa: E731,B023
            mine = d(batch[i])
            others = [np.mean(d(b)) for b in set(batch[label == own]) - {batch[i]}]
            s.append(1 - abs((min(others) - np.mean(mine)) / max(min(others), np.mean(mine))) if mine else 1.0)
        want[str(own)] = np.mean(s)
    assert got == pytest.approx(want)


def test_cluster_agreement_limits(spark):
    labels = spark.createDataFrame([(str(i), str(i % 3)) for i in range(30)], "cell string, label string")
    same = g.cluster_agreement(labels.selectExpr("cell", "concat('x', label) cluster"), labels).first()
    assert (same.nmi, same.ari) == pytest.approx((1.0, 1.0))
    one = labels.selectExpr("cell", "'all' cluster")
    assert tuple(g.cluster_agreement(one, labels).first()) == pytest.approx((0.0, 0.0), abs=1e-9)
    assert tuple(g.cluster_agreement(one, one.selectExpr("cell", "cluster label")).first()) == (1.0, 1.0)


def test_planted_contamination_is_recovered(spark):
    """Two libraries with 10 and 25 % ambient counts; three cell types with markers of their own."""
    rng = np.random.default_rng(4)
    genes = [f"g{i}" for i in range(60)]
    own = np.ones((3, 60)) * 0.2
    for t in range(3):
        own[:, t * 10 : t * 10 + 10] = 0.0  # markers of one type, silent in the others
        own[t, t * 10 : t * 10 + 10] = 8.0
    own /= own.sum(axis=1, keepdims=True)
    soup = own.mean(axis=0)
    counts, droplets, cells = [], [], []
    for lib, rho in (("low", 0.10), ("high", 0.25)):
        for i in range(240):
            name = f"{lib}{i}"
            droplets.append((name, lib))
            if i < 90:
                cells.append((name, str(i % 3)))
                n = rng.multinomial(120, (1 - rho) * own[i % 3] + rho * soup)
            else:
                n = rng.multinomial(30, soup)
            counts += [(name, genes[k], float(v)) for k, v in enumerate(n) if v]
    raw = spark.createDataFrame(counts, "cell string, gene string, value double").repartition(4)
    drops = spark.createDataFrame(droplets, "cell string, library string")
    called = spark.createDataFrame(cells, "cell string, cluster string")
    profile = ambient.ambient_profile(raw, drops, called)
    assert {r.library: r.s for r in profile.groupBy("library").sum("share").withColumnRenamed("sum(share)", "s").collect()} == pytest.approx({"low": 1, "high": 1})
    pairs = ambient.silent_pairs(raw, drops, called, profile, min_tfidf=0.2, soup_quantile=0.5, max_rho=0.5)
    rhos = ambient.estimate_rho(pairs)
    got = {r.library: r for r in rhos.collect()}
    for lib, rho in (("low", 0.10), ("high", 0.25)):
        assert got[lib].rho == pytest.approx(rho, abs=0.03)
        assert got[lib].pooled == pytest.approx(rho, abs=0.03)
    per_cell = ambient.rho_of_cells(rhos, drops, called)
    assert per_cell.count() == 180
    # corrected by cell: the same as by one number where all cells share it, and less is left where more was added
    removed = lambda rho, who: (lambda x: 1 - x[0] / x[1])(q.ambient_correct(raw, called, rho).filter(f"cell like '{who}%'").selectExpr("sum(value)", "sum(observed)").first())
    assert removed(called.selectExpr("cell", "0.1D rho"), "low") == pytest.approx(removed(0.1, "low"))
    assert 0.25 > removed(per_cell, "high") > 1.5 * removed(per_cell, "low") > 0.04
