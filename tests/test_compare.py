"""Donor-level comparisons: pairing rules, edge arms and p-values against enumeration."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from conftest import rows

from cohortlens.functions import checks, tails
from cohortlens.operators import compare as j


@pytest.fixture(scope="module")
def cells(spark):
    out = []
    for d in range(6):
        for arm in ("case", "ctl"):
            for i in range(5):
                shift = (1 + d) * 0.3 if arm == "case" else 0.0
                out.append((f"{d}{arm}{i}", f"d{d}", arm, float(d + i) + shift, "A" if i < 2 + (arm == "case") else "B"))
    return spark.createDataFrame(out, "cell string, donor string, condition string, v double, t string")


def test_design_errors(spark, cells):
    assert checks.validate_design(cells, "donor", "condition", "case", "ctl", True)["n_complete_pairs"] == 6
    one_arm = cells.filter("not (donor = 'd0' and condition = 'ctl')")
    with pytest.raises(ValueError):
        checks.validate_design(one_arm, "donor", "condition", "case", "ctl", True)
    with pytest.raises(ValueError):
        checks.validate_design(cells, "donor", "condition", "case", "case", True)
    with pytest.raises(ValueError):
        checks.validate_design(cells, "donor", "condition", "case", "nothing", True)
    with pytest.raises(ValueError):
        checks.require_constant(cells, ["donor"], ["condition"])


def test_pairing_promotes_and_drops(cells):
    units = cells.select("donor", "condition").distinct()
    kept = j.resolve_pairing(units, "donor", "condition", "case", "ctl", False)
    assert kept.count() == 12 and kept.first().paired
    partial = units.filter("not (donor = 'd0' and condition = 'ctl')")
    loose = j.resolve_pairing(partial, "donor", "condition", "case", "ctl", False)
    assert loose.count() == 11 and not loose.first().paired
    assert j.resolve_pairing(partial, "donor", "condition", "case", "ctl", True).count() == 10


def test_donor_median_test(cells):
    got = j.donor_median_test(cells, "v", "condition", "donor", "case", "ctl", True).first()
    d = np.array([(1 + k) * 0.3 for k in range(6)])
    assert got.effect == pytest.approx(np.median(d)) and got.p == pytest.approx(2 / 2**6)
    with pytest.raises(ValueError):
        j.donor_median_test(cells, "v", "condition", "donor", "case", "ctl", False)
    one_arm = cells.filter("not (donor = 'd0' and condition = 'ctl')")
    with pytest.raises(ValueError):
        j.donor_median_test(one_arm, "v", "condition", "donor", "case", "ctl", True)
    assert j.donor_median_test(one_arm, "v", "condition", "donor", "case", "ctl", True, incomplete="drop").first().n_case == 5


def test_flat_differences_have_no_t(spark):
    wide = spark.createDataFrame([("x", "d1", 2.0, 1.0), ("x", "d2", 3.0, 2.0), ("y", "d1", 1.0, None)], "item string, donor string, case double, control double")
    got = {r.item: r for r in j.donor_effect(wide, ["item"]).collect()}
    assert got["x"].effect == 1.0 and got["x"].t is None and got["x"].p is None and "spread" in got["x"].reason
    assert got["y"].test == "none" and got["y"].effect is None


def test_sign_flip_enumeration(spark):
    d = [0.5, -0.2, 1.1, 0.7]
    wide = spark.createDataFrame([("x", f"d{i}", v, 0.0) for i, v in enumerate(d)], "item string, donor string, case double, control double")
    want = np.mean([abs(np.dot(s, d)) >= abs(sum(d)) - 1e-12 for s in itertools.product([1, -1], repeat=4)])
    assert j.sign_flip_test(wide, ["item"]).first().p == pytest.approx(want)


def test_label_permutation(spark):
    x, y = [3.0, 4.0, 5.0], [1.0, 2.0, 2.5]
    rows_ = [("x", f"a{i}", v, None) for i, v in enumerate(x)] + [("x", f"b{i}", None, v) for i, v in enumerate(y)]
    wide = spark.createDataFrame(rows_, "item string, donor string, case double, control double")
    pool = np.array(x + y)
    seen = abs(np.mean(x) - np.mean(y))
    stats = [abs(pool[list(c)].mean() - np.delete(pool, list(c)).mean()) for c in itertools.combinations(range(6), 3)]
    assert j.label_permutation_test(wide, ["item"]).first().p == pytest.approx(np.mean([s >= seen - 1e-12 for s in stats]))


def test_pseudobulk_de_counts_absent_genes_as_zero(spark):
    pb, want = [], {}
    rng = np.random.default_rng(0)
    grid = {(g, d, c): int(rng.poisson(20)) for g in range(5) for d in range(4) for c in ("case", "ctl")}
    grid[(0, 1, "case")] = grid[(0, 2, "ctl")] = 0
    lib = {(d, c): sum(grid[(g, d, c)] for g in range(5)) for d in range(4) for c in ("case", "ctl")}
    for (g, d, c), n in grid.items():
        if n:
            pb.append((f"g{g}", f"d{d}", c, n))
    for g in range(5):
        x = {(d, c): np.log2((grid[(g, d, c)] + 0.5) / (lib[(d, c)] + 1) * 1e6) for d in range(4) for c in ("case", "ctl")}
        diff = np.array([x[(d, "case")] - x[(d, "ctl")] for d in range(4)])
        want[f"g{g}"] = (diff.mean(), diff.mean() / (diff.std(ddof=1) / 2))
    df = spark.createDataFrame(pb, "gene string, donor string, condition string, count long")
    got = {r.gene: r for r in j.pseudobulk_de(df, "donor", "condition", "case", "ctl", min_count=1, min_total=1).collect()}
    for g, (lfc, t) in want.items():
        assert got[g].logFC == pytest.approx(lfc) and got[g].t == pytest.approx(t)
        assert got[g].p == pytest.approx(tails.student_two_sided([t], [3.0])[0])


def test_concordance_patterns(spark):
    out = []
    for d in range(8):
        up = 60 + d
        out += [(f"d{d}", "ctl", "T", 50), (f"d{d}", "ctl", "U", 50), (f"d{d}", "case", "T", up), (f"d{d}", "case", "U", 100 - up)]
    counts = spark.createDataFrame(out, "donor string, condition string, kind string, n long")
    got = {r.kind: r for r in j.paired_concordance(counts, "kind", "donor", "condition", "case", "ctl").collect()}
    assert got["T"].pattern == "consistent" and got["T"].n_agree == 8 and got["T"].direction == 1
    assert got["T"].sign_test_p == pytest.approx(1 / 256)
    few = j.paired_concordance(counts.filter("donor < 'd3'"), "kind", "donor", "condition", "case", "ctl")
    assert {r.pattern for r in few.collect()} == {"underpowered"}


def test_zero_filled_counts_and_shares(spark):
    cells = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", None)], "s string, t string")
    got = rows(j.celltype_counts(cells, ["s"], "t"), "s", "t", "n")
    assert got == [("a", "x", 2), ("a", "y", 0), ("b", "x", 0), ("b", "y", 1)]


def test_quotas_sum_to_the_cap(spark):
    cells = spark.createDataFrame([(f"c{i}", "big" if i < 95 else f"s{i}") for i in range(100)], "cell string, g string")
    q = j.stratum_quotas(cells, ["g"], 20)
    assert q.agg({"quota": "sum"}).first()[0] == 20 and q.agg({"quota": "min"}).first()[0] == 1
    assert j.stratified_sample(cells, ["g"], 20).count() == 20
    assert j.stratified_sample(cells, ["g"], 1000).count() == 100
