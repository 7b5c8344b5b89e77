"""Enrichment walks, overlaps, agreement and exact tests against enumeration."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.operators import enrich, fits, partitions, programs


@pytest.fixture(scope="module")
def ranking(spark):
    rng = np.random.default_rng(4)
    m = np.sort(rng.normal(size=200))[::-1]
    return spark.createDataFrame([(f"g{i:03d}", float(v)) for i, v in enumerate(m)], "gene string, metric double"), m


def walk(m, members):
    hit = np.array([i in members for i in range(len(m))])
    up = np.where(hit, np.abs(m), 0).cumsum() / np.abs(m[hit]).sum()
    run = up - np.where(~hit, 1 / (~hit).sum(), 0).cumsum()
    return run.max() if run.max() >= -run.min() else run.min()


def test_es_and_gsea(spark, ranking):
    df, m = ranking
    sets = {"top": range(0, 20), "bottom": range(180, 200), "mixed": range(0, 200, 9)}
    net = spark.createDataFrame([(s, f"g{i:03d}") for s, r in sets.items() for i in r], "source string, target string")
    got = {r.source: r for r in enrich.gsea_es(df, net).collect()}
    for s, members in sets.items():
        assert got[s].es == pytest.approx(walk(m, set(members)), abs=1e-12)
    assert got["top"].leading_edge.split(";")[0] == "g000"
    a = enrich.gsea(df, net, n_perm=60)
    b = enrich.gsea(df.repartition(11), net.repartition(3), n_perm=60)
    key = ("source", "es", "nes", "p")
    assert [(x[0], pytest.approx(x[1]), pytest.approx(x[2]), x[3]) for x in rows(a, *key)] == rows(b, *key)
    p = {r.source: r.p for r in a.collect()}
    assert p["top"] == pytest.approx(1 / 61) and p["bottom"] == pytest.approx(1 / 61) and p["mixed"] > 0.05


def test_ranking_drops_non_finite_and_keeps_the_strongest(spark):
    de = spark.createDataFrame([("a", 1.0, 0.01), ("a", -2.0, 1e-5), ("b", 1.0, 0.0), ("c", None, 0.1), ("d", 1.0, None)], "gene string, logFC double, p double")
    assert rows(enrich.de_ranking(de), "gene", "metric") == [("a", pytest.approx(-5.0))]


def test_overlap_keeps_empty_intersections(spark):
    sets = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "y"), ("C", "z")], "source string, target string")
    got = {(r.set_a, r.set_b): r for r in enrich.set_overlap(sets, 10).collect()}
    assert got[("A", "C")].intersection == 0 and got[("A", "C")].p == 1.0
    assert got[("A", "B")].p == pytest.approx(2 / 10)
    assert dict(rows(enrich.exclusive_combinations(sets), "combination", "size")) == {"A": 1, "A&B": 1, "C": 1}
    with pytest.raises(ValueError):
        enrich.selection_overlap(sets, sets, sets.filter("source = 'A'"), sets)


def test_fisher_enumeration():
    def brute(a, b, c, d):
        n, r, k = a + b + c + d, a + b, a + c
        p = lambda x: math.comb(r, x) * math.comb(n - r, k - x) / math.comb(n, k)
        return sum(p(x) for x in range(max(0, k - (n - r)), min(r, k) + 1) if p(x) <= p(a) * (1 + 1e-7))

    for t in ((3, 7, 8, 2), (0, 5, 5, 0), (10, 10, 10, 10), (1, 30, 4, 25)):
        got = fits.fisher_two_sided.func(*[pd.Series([float(x)]) for x in t])[0]
        assert got == pytest.approx(brute(*t), abs=1e-12)


def test_expected_mutual_information_by_permutation():
    a, b = [0, 0, 0, 1, 1, 2], [0, 0, 1, 1, 1, 1]

    def mi(x, y):
        n = len(x)
        total = 0.0
        for i, k in itertools.product(set(x), set(y)):
            nij = sum(p == i and q == k for p, q in zip(x, y))
            if nij:
                total += nij / n * math.log(n * nij / (x.count(i) * y.count(k)))
        return total

    want = np.mean([mi(a, [b[i] for i in order]) for order in itertools.permutations(range(6))])
    got = partitions._expected_mi(np.array([3.0, 2.0, 1.0]), np.array([2.0, 4.0]), 6.0)
    assert got == pytest.approx(want, abs=1e-12)


def test_agreement_of_identical_and_refined_partitions(spark):
    cells = spark.createDataFrame([(f"c{i}", str(i % 3), str(i % 3), str(i % 6)) for i in range(60)], "cell string, a string, b string, c string")
    t = partitions.partition_agreement(cells.drop("cell"), ["a", "b", "c"])
    got = {(r.partition_a, r.partition_b): r for r in t.collect()}
    same, finer = got[("a", "b")], got[("a", "c")]
    assert same.ari == pytest.approx(1) and same.ami == pytest.approx(1)
    assert finer.purity_b_in_a == pytest.approx(1) and finer.purity_a_in_b == pytest.approx(0.5) and finer.ari < 1


def test_alignment_ignores_missing_labels(spark):
    a = spark.createDataFrame([("c1", "x"), ("c2", "nan"), ("c3", None)], "cell string, label string")
    b = spark.createDataFrame([("c1", "y"), ("c2", "y"), ("c4", "y")], "cell string, label string")
    assert rows(partitions.align_partitions({"a": a, "b": b}), "cell", "a", "b") == [("c1", "x", "y")]
    assert rows(partitions.partition_coverage({"a": a, "b": b}), "partition", "n_cells", "n_shared") == [("a", 1, 1), ("b", 3, 1)]
    assert partitions.cell_cycle_phase(F.lit(0.0), F.lit(0.0)) is not None


def test_expressed_fraction_limits_ligands(spark):
    from cohortlens.operators import communicate as m

    cells = spark.createDataFrame([(f"c{i}", "s" if i < 4 else "r") for i in range(8)], "cell string, kind string")
    counts = [("c0", "L1", 1.0), ("c1", "L1", 2.0), ("c0", "L2", 1.0), ("c2", "L2", 0.0), ("c4", "R1", 1.0), ("c5", "R1", 1.0), ("c6", "R2", 3.0), ("c4", "L3", 1.0), ("c5", "L3", 1.0)]
    found = m.expressed_genes(spark.createDataFrame(counts, "cell string, gene string, value double"), cells, "kind", 0.5)
    assert {(r.group, r.gene, r.fraction) for r in found.collect()} == {("s", "L1", 0.5), ("r", "R1", 0.5), ("r", "L3", 0.5)}
    pairs = spark.createDataFrame([("L1", "R1"), ("L1", "R2"), ("L2", "R1"), ("L3", "R1")], "ligand string, receptor string")
    assert [r.ligand for r in m.potential_ligands(pairs, found, ["s"], "r").collect()] == ["L1"]
    assert m.potential_ligands(pairs, found.limit(0), ["s"], "r").count() == 0


def test_activity_keeps_cells_without_counts(spark):
    layer = spark.createDataFrame([("a", "g1", 2.0), ("a", "g3", 1.0), ("b", "g1", 3.0), ("b", "g2", 3.0)], "cell string, gene string, value double")
    cells = spark.createDataFrame([("a",), ("b",), ("none",)], "cell string")
    net = spark.createDataFrame([("s", "g1"), ("s", "g2")], "source string, target string")
    got = {r.cell: r.score for r in programs.activity_ulm(layer, cells, net, 4).collect()}
    assert got["a"] == pytest.approx(np.sqrt(2) * 0.30151134 / np.sqrt(1 - 0.30151134**2)) and got["b"] == float("inf") and np.isnan(got["none"])
