"""Hand-checked quality fixtures: a zero cell, an undetected gene and verdict edges."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens.functions import checks
from cohortlens.operators import fits, normalize
from cohortlens.operators import quality as q

GENES = ["MT-ND1", "RPS3", "RPLP0", "HBA1", "HBB", "ACTB", "MALAT1"]
MATRIX = [[5, 1, 1, 0, 0, 3, 0], [0, 0, 0, 2, 1, 2, 0], [1, 0, 0, 0, 0, 0, 9], [0, 0, 0, 0, 0, 0, 0]]


@pytest.fixture(scope="module")
def study(spark):
    counts = [(f"c{i}", g, float(v)) for i, row in enumerate(MATRIX) for g, v in zip(GENES, row) if v]
    return (
        spark.createDataFrame(counts, "cell string, gene string, value double"),
        spark.createDataFrame([(g, g) for g in GENES + ["SILENT"]], "gene string, symbol string"),
        spark.createDataFrame([(f"c{i}",) for i in range(4)], "cell string"),
    )


def test_cell_metrics(study):
    counts, genes, cells = study
    m = q.cell_qc_metrics(counts, q.feature_masks(genes), cells)
    got = rows(m, "cell", "total_counts", "n_genes_by_counts", "total_counts_mito", "pct_counts_mito", "pct_counts_hemoglobin")
    assert got == [
        ("c0", 10.0, 4, 5.0, 50.0, 0.0),
        ("c1", 5.0, 3, 0.0, 0.0, 60.0),
        ("c2", 10.0, 2, 1.0, 10.0, 0.0),
        ("c3", 0.0, 0, 0.0, 0.0, 0.0),
    ]


def test_gene_metrics_divide_by_all_cells(study):
    counts, genes, cells = study
    got = {r.gene: r for r in q.gene_qc_metrics(counts, genes, cells).collect()}
    assert got["MT-ND1"].mean_counts == 1.5 and got["MT-ND1"].pct_dropout_by_counts == 50.0
    assert got["SILENT"].n_cells_by_counts == 0 and got["SILENT"].pct_dropout_by_counts == 100.0


def test_top_share_of_zero_cell_is_zero(study):
    counts, _, cells = study
    got = dict(rows(q.pct_top_n(counts, cells, [1]), "cell", "pct_counts_in_top_1_genes"))
    assert got == {"c0": 50.0, "c1": 40.0, "c2": 90.0, "c3": 0.0}


def test_floors_name_the_first_failure(study):
    counts, genes, cells = study
    m = q.cell_qc_metrics(counts, q.feature_masks(genes), cells)
    got = dict(rows(q.cell_floors(m, 3, 8), "cell", "floor_reason"))
    assert got == {"c0": "", "c1": "fewer_than_8_counts", "c2": "fewer_than_3_genes", "c3": "fewer_than_3_genes"}


def test_severity_needs_enough_cells(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(30)] + [("b", float(i)) for i in range(24)], "g string, v double")
    out = q.tail_severity(df, {"s": q.Tail("v")}, ["g"])
    assert out.filter("g = 'b' and s is not null").count() == 0
    top = out.filter("g = 'a' and v = 29").first().s
    z = (29 - 14.5) / (1.4826 * 7.5)
    assert top == pytest.approx(z / (z + 3))
    assert out.filter("g = 'a' and v = 0").first().s == 0.0


def test_severity_falls_back_to_upper_quantiles(spark):
    # more than half the values are equal, so the median deviation is zero
    df = spark.createDataFrame([(0.0,)] * 60 + [(10.0,)] * 40, "v double")
    out = q.tail_severity(df, {"s": q.Tail("v")}, [])
    z = 10 / (10 / 0.6745)
    assert out.filter("v = 10").first().s == pytest.approx(z / (z + 3))


def test_verdict_ladder(spark):
    cols = "cell string, family_capture_complexity double, family_nuclear_integrity double, family_metabolic_stress double, family_multiplet double, evidence_coverage double"
    cells = spark.createDataFrame(
        [
            ("core", 0.1, 0.1, 0.1, 0.1, 1.0),
            ("single", 0.6, 0.1, 0.1, 0.1, 1.0),
            ("support", 0.1, 0.1, 0.9, 0.1, 1.0),
            ("concordant", 0.7, 0.7, 0.1, 0.1, 1.0),
            ("empty", 0.95, 0.1, 0.1, 0.1, 1.0),
            ("withheld", 0.95, None, None, None, 0.25),
            ("multiplet", 0.1, 0.1, 0.1, 0.7, 1.0),
            ("two_support_only", 0.1, 0.1, 0.7, 0.7, 1.0),
        ],
        cols,
    )
    got = {r.cell: (r.qc_state, r.qc_reason, r.primary_driver) for r in q.adjudicate_qc(cells).collect()}
    assert got == {
        "core": ("core", "no_concern", ""),
        "single": ("borderline", "single_family_concern", "capture_complexity"),
        "support": ("borderline", "supporting_evidence_only", "metabolic_stress"),
        "concordant": ("quarantine", "concordant_severe_damage", "capture_complexity"),
        "empty": ("quarantine", "uninformative_barcode", "capture_complexity"),
        "withheld": ("borderline", "withheld_low_coverage", "capture_complexity"),
        "multiplet": ("core", "probable_multiplet", ""),
        "two_support_only": ("borderline", "supporting_evidence_only", "metabolic_stress"),
    }
    masks = q.eligibility_masks(q.adjudicate_qc(cells))
    one = {r.cell: r for r in masks.collect()}
    assert one["core"].qc_fit_de and not one["multiplet"].qc_fit_de and one["multiplet"].qc_fit_annotation
    assert one["empty"].qc_transform_manifold and not one["empty"].qc_transform_clustering


def test_mixture_recovers_two_lines(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows_ = []
    for g in ("a", "b"):
        for i in range(400):
            bad = i < 100
            x = float(rng.uniform(100, 1000))
            y = (40 - 0.02 * x if bad else 5 - 0.002 * x) + float(rng.normal(0, 1))
            rows_.append((f"{g}{i}", g, x, y, bad))
    df = spark.createDataFrame(rows_, "cell string, g string, x double, y double, bad boolean")
    post, models = fits.mito_mixture(df, "g", "y", "x")
    assert models.count() == 2
    m = models.first()
    assert m.compromised_intercept > m.intact_intercept and abs(m.compromised_weight - 0.25) < 0.05
    joined = post.join(df.select("cell", "bad"), "cell")
    assert joined.filter(F.col("compromised") != F.col("bad")).count() < 15
    ceilings = fits.mito_ceiling(post)
    assert ceilings.count() == 2


def test_normalisation_gates(spark, study):
    counts, _, _ = study
    layer = normalize.log1p_cp10k(counts)
    checks.require_kind(layer, ["lognorm"])
    with pytest.raises(ValueError):
        checks.require_kind(layer, ["counts"])
    checks.assert_counts(counts)
    with pytest.raises(ValueError):
        checks.assert_counts(counts.withColumn("value", F.col("value") + 0.5))
    with pytest.raises(ValueError):
        checks.assert_lognorm(counts, 12.0)
    with pytest.raises(ValueError):
        checks.require_columns(counts, ["cell", "missing"])
