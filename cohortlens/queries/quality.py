"""Quality control queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ambient
from ..operators import quality as q
from ..session import materialise
from . import bindings as b
from .bindings import with_sql
from .registry import query

MASKS = dict(
    mito=("ECONOMY-",), ribo=("PROMO-",), hemoglobin=("-(red|blue) ring$",), custom=("LARGE-green",)
)


def r(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Rounded columns, by the arithmetic of the SQL's ``round``: scaled, rounded half away from zero, scaled back."""
    types = dict(df.dtypes)

    def rounded(c):
        x = F.col(f"`{c}`")
        if types[c] != "double":
            return F.round(x, places)
        scaled = F.round(x * 10.0**places) / 10.0**places
        return F.when(F.isnan(scaled) | (F.abs(scaled) == float("inf")), x).otherwise(scaled)

    return df.withColumns({c: rounded(c) for c in cols})


def masked_genes(spark, sf):
    return q.feature_masks(b.genes(spark, sf), **MASKS)


def metrics(spark, sf):
    return q.cell_qc_metrics(b.counts(spark, sf), masked_genes(spark, sf), b.cells(spark, sf))


def scored_lines(spark, sf):
    """Per-cell detector scores and a native call, from the line table; cells without lines are unmeasured."""
    return (
        b.table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").cast("string").alias("cell"))
        .agg(
            (F.max("l_discount") * 10).alias("score_a"),
            (F.max("l_tax") / 0.08).alias("score_b"),
            (F.count_if(F.col("l_returnflag") == "R") >= 3).cast("double").alias("native_a"),
        )
    )


SCORES_SQL = """scores AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell, MAX(l_discount) * 10 AS score_a, MAX(l_tax) / 0.08 AS score_b,
    (COUNT(*) FILTER (l_returnflag = 'R') >= 3)::INT::DOUBLE AS native_a FROM lineitem GROUP BY 1)"""


@query(
    "c1_feature_masks",
    with_sql("genes")
    + """SELECT gene, starts_with(symbol, 'ECONOMY-') AS mito, starts_with(symbol, 'PROMO-') AS ribo,
    regexp_matches(symbol, '-(red|blue) ring$') AS hemoglobin, starts_with(symbol, 'LARGE-green') AS custom_exclude FROM genes""",
)
def c1(spark, sf):
    return masked_genes(spark, sf).select("gene", "mito", "ribo", "hemoglobin", "custom_exclude")


@query(
    "c2_cell_qc_metrics",
    with_sql("counts", "cells", "genes", "metrics")
    + """SELECT cell, total_counts, n_genes_by_counts, round(ln(1 + total_counts), 6) AS log1p_total_counts,
    round(ln(1 + n_genes_by_counts), 6) AS log1p_n_genes_by_counts,
    mito AS total_counts_mito, ribo AS total_counts_ribo, hb AS total_counts_hemoglobin,
    round(pct_mito, 6) AS pct_counts_mito,
    round(CASE WHEN total_counts = 0 THEN 0.0 ELSE 100.0 * (hb / total_counts) END, 6) AS pct_counts_hemoglobin FROM metrics""",
)
def c2(spark, sf):
    out = metrics(spark, sf).select(
        "cell",
        "total_counts",
        "n_genes_by_counts",
        "log1p_total_counts",
        "log1p_n_genes_by_counts",
        "total_counts_mito",
        "total_counts_ribo",
        "total_counts_hemoglobin",
        "pct_counts_mito",
        "pct_counts_hemoglobin",
    )
    return r(out, "log1p_total_counts", "log1p_n_genes_by_counts", "pct_counts_mito", "pct_counts_hemoglobin")


@query(
    "c3_pct_top_n",
    with_sql("counts", "cells")
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY value DESC, gene) AS rn FROM counts),
    t AS (SELECT cell, SUM(value) AS t, SUM(value) FILTER (rn <= 1) AS t1, SUM(value) FILTER (rn <= 3) AS t3 FROM k GROUP BY 1)
    SELECT c.cell, round(COALESCE(100 * (t1 / t), 0.0), 6) AS pct_counts_in_top_1_genes,
    round(COALESCE(100 * (t3 / t), 0.0), 6) AS pct_counts_in_top_3_genes FROM cells c LEFT JOIN t USING (cell)""",
)
def c3(spark, sf):
    out = q.pct_top_n(b.counts(spark, sf), b.cells(spark, sf), [1, 3])
    return r(out, "pct_counts_in_top_1_genes", "pct_counts_in_top_3_genes")


@query(
    "c4_gene_qc_metrics",
    with_sql("counts", "cells", "genes")
    + """, n AS (SELECT COUNT(*) AS n FROM cells), g AS (SELECT g.gene, COUNT(*) FILTER (value > 0) AS k, COALESCE(SUM(value), 0.0) AS t
      FROM genes g LEFT JOIN counts c ON g.gene = c.gene GROUP BY 1)
    SELECT gene, k AS n_cells_by_counts, round(t / n, 9) AS mean_counts, round(100.0 * (1 - k / n), 6) AS pct_dropout_by_counts,
    t AS total_counts, round(ln(1 + t / n), 9) AS log1p_mean_counts, round(ln(1 + t), 6) AS log1p_total_counts FROM g, n""",
)
def c4(spark, sf):
    out = q.gene_qc_metrics(b.counts(spark, sf), b.genes(spark, sf), b.cells(spark, sf))
    return r(r(out, "mean_counts", "log1p_mean_counts", places=9), "pct_dropout_by_counts", "log1p_total_counts")


FLOORS_SQL = """fc AS (SELECT cell, CASE WHEN n_genes_by_counts < 3 THEN 'fewer_than_3_genes' WHEN total_counts < 100 THEN 'fewer_than_100_counts'
      ELSE '' END AS floor_reason FROM metrics),
    fg AS (SELECT gene FROM counts GROUP BY 1 HAVING COUNT(*) FILTER (value > 0) >= 20)"""


@query(
    "c5_floor_reasons",
    with_sql("counts", "cells", "genes", "metrics", extra=FLOORS_SQL)
    + "SELECT cell, floor_reason, floor_reason = '' AS keep FROM fc",
)
def c5(spark, sf):
    return q.cell_floors(metrics(spark, sf), 3, 100).select("cell", "floor_reason", "keep")


@query(
    "c5_floored_counts",
    with_sql("counts", "cells", "genes", "metrics", extra=FLOORS_SQL)
    + """SELECT cell, gene, value FROM counts WHERE cell IN (SELECT cell FROM fc WHERE floor_reason = '') AND gene IN (SELECT gene FROM fg)""",
)
def c5_counts(spark, sf):
    counts, cells = b.counts(spark, sf), b.cells(spark, sf)
    kept = q.cell_floors(q.cell_qc_metrics(counts, masked_genes(spark, sf), cells), 3, 100)
    genes = q.gene_floor(q.gene_qc_metrics(counts, b.genes(spark, sf), cells), 20)
    return q.apply_floors(counts, kept, genes)


def severity_sql(name: str, source: str, expr: str, by: str, upper: bool) -> str:
    """CTEs ending in ``name(cell, sev)``: the robust one-sided severity of ``expr`` inside ``by``."""
    sign = "" if upper else "-"
    return f"""{name}_v AS (SELECT cell, {by} AS g, {expr} AS x FROM {source}),
    {name}_m AS (SELECT g, median(x) AS med, quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.9) AS q90, quantile_cont(x, 0.99) AS q99,
      COUNT(*) AS nc FROM {name}_v GROUP BY g),
    {name}_d AS (SELECT v.g, 1.4826 * median(abs(x - med)) AS s FROM {name}_v v JOIN {name}_m m ON v.g = m.g GROUP BY 1),
    {name}_s AS (SELECT m.g, med, CASE WHEN nc < 25 THEN NULL WHEN s > 0 THEN s WHEN q75 > med THEN (q75 - med) / 0.6745
      WHEN q90 > med THEN (q90 - med) / 1.2816 WHEN q99 > med THEN (q99 - med) / 2.3263 END AS scale
      FROM {name}_m m JOIN {name}_d d ON m.g = d.g),
    {name} AS (SELECT v.cell, CASE WHEN x IS NOT NULL AND scale IS NOT NULL THEN
      GREATEST({sign}(x - med) / scale, 0) / (GREATEST({sign}(x - med) / scale, 0) + 3.0) END AS sev
      FROM {name}_v v LEFT JOIN {name}_s s ON v.g = s.g)"""


@query(
    "c6_tail_severity",
    with_sql(
        "counts", "cells", "genes", "metrics",
        extra=severity_sql("sa", "metrics", "ln(1 + total_counts)", "donor", False)
        + ",\n" + severity_sql("sb", "metrics", "pct_mito", "donor", True),
    )
    + "SELECT sa.cell, round(sa.sev, 6) AS sev_counts, round(sb.sev, 6) AS sev_mito FROM sa JOIN sb ON sa.cell = sb.cell",
)
def c6(spark, sf):
    out = q.tail_severity(
        metrics(spark, sf),
        {"sev_counts": q.Tail("total_counts", False, True), "sev_mito": q.Tail("pct_counts_mito")},
        ["donor"],
    )
    return r(out.select("cell", "sev_counts", "sev_mito"), "sev_counts", "sev_mito")


def leveled(spark, sf):
    """Lineages with one label turned ``unassigned`` so that every level of the ladder occurs."""
    return metrics(spark, sf).withColumn(
        "lineage", F.when(F.col("cell_type") == "BUILDING", q.UNASSIGNED).otherwise(F.col("cell_type"))
    )


LEVELED_SQL = """lm AS (SELECT *, CASE WHEN cell_type = 'BUILDING' THEN 'unassigned' ELSE cell_type END AS lineage FROM metrics),
    lev AS (SELECT *, CASE WHEN lineage <> 'unassigned' AND COUNT(*) OVER (PARTITION BY sample, lineage) >= 45 THEN 'sample_x_lineage'
      WHEN lineage <> 'unassigned' AND COUNT(*) OVER (PARTITION BY lineage) >= 45 THEN 'lineage'
      WHEN COUNT(*) OVER (PARTITION BY sample) >= 45 THEN 'sample' ELSE 'pooled' END AS null_level FROM lm)"""


@query(
    "c7_nested_null_severity",
    with_sql(
        "counts", "cells", "genes", "metrics",
        extra=LEVELED_SQL
        + ",\n" + severity_sql("s1", "lev", "ln(1 + total_counts)", "concat(sample, '|', lineage)", False)
        + ",\n" + severity_sql("s2", "lev", "ln(1 + total_counts)", "lineage", False)
        + ",\n" + severity_sql("s3", "lev", "ln(1 + total_counts)", "sample", False)
        + ",\n" + severity_sql("s4", "lev", "ln(1 + total_counts)", "1", False),
    )
    + """SELECT cell, null_level, round(CASE null_level WHEN 'sample_x_lineage' THEN s1.sev WHEN 'lineage' THEN s2.sev
      WHEN 'sample' THEN s3.sev ELSE s4.sev END, 6) AS severity
    FROM lev JOIN s1 USING (cell) JOIN s2 USING (cell) JOIN s3 USING (cell) JOIN s4 USING (cell)""",
)
def c7(spark, sf):
    placed = q.resolve_null_groups(leveled(spark, sf), "sample", "lineage", 45)
    out = q.nested_tail_severity(placed, {"severity": q.Tail("total_counts", False, True)}, "sample", "lineage")
    return r(out.select("cell", "null_level", "severity"), "severity")


STRESS_SQL = """fr AS (SELECT c.cell, SUM(CASE WHEN g.brand = 'Brand#1' THEN value END) AS st, SUM(CASE WHEN g.brand = 'Brand#2' THEN value END) AS nu,
      SUM(value) AS t FROM cells c LEFT JOIN counts k ON c.cell = k.cell LEFT JOIN genes g ON k.gene = g.gene GROUP BY 1),
    frac AS (SELECT cell, CASE WHEN t > 0 THEN COALESCE(st, 0.0) / t END AS stress, CASE WHEN t > 0 THEN COALESCE(nu, 0.0) / t END AS nuclear FROM fr)"""


def with_fractions(spark, sf):
    counts, genes = b.counts(spark, sf), b.genes(spark, sf)
    out = q.gene_fraction(counts, genes.filter(F.col("brand") == "Brand#1"), metrics(spark, sf), "stress")
    return q.gene_fraction(counts, genes.filter(F.col("brand") == "Brand#2"), out, "nuclear")


@query(
    "c8_gene_fraction",
    with_sql("counts", "cells", "genes", extra=STRESS_SQL)
    + "SELECT cell, round(stress, 9) AS stress, round(nuclear, 9) AS nuclear FROM frac",
)
def c8(spark, sf):
    return r(with_fractions(spark, sf).select("cell", "stress", "nuclear"), "stress", "nuclear", places=9)


AXES = (
    q.Axis("ev_genes", "capture_complexity"),
    q.Axis("ev_counts", "capture_complexity"),
    q.Axis("ev_mito", "metabolic_stress"),
    q.Axis("ev_stress", "metabolic_stress", q.STRESS_WEIGHT),
    q.Axis("ev_nuclear", "nuclear_integrity"),
    q.Axis("ev_intronic", "nuclear_integrity"),
    q.Axis("ev_doublet", "multiplet"),
)


def evidence(spark, sf):
    base = with_fractions(spark, sf).join(scored_lines(spark, sf), "cell", "left")
    base = q.intronic_fraction(b.layers(spark, sf), base)
    tails = {
        "ev_genes": q.Tail("n_genes_by_counts", False, True),
        "ev_counts": q.Tail("total_counts", False, True),
        "ev_mito": q.Tail("pct_counts_mito"),
        "ev_stress": q.Tail("stress"),
        "ev_nuclear": q.Tail("nuclear"),
        "ev_intronic": q.Tail("intronic_fraction"),
        "_da": q.Tail("score_a"),
        "_db": q.Tail("score_b"),
    }
    out = q.tail_severity(base, tails, ["donor"])
    out = out.withColumn("ev_doublet", q.all_non_null_least(["_da", "_db"])).drop("_da", "_db")
    return q.evidence_families(out, AXES)


INTRONIC_SQL = """intr AS (SELECT c.cell, CASE WHEN SUM(value) > 0 THEN SUM(CASE WHEN layer = 'unspliced' THEN value ELSE 0 END) / SUM(value) END AS intronic_fraction
    FROM cells c LEFT JOIN layers l ON c.cell = l.cell GROUP BY 1)"""
EVIDENCE_SQL = with_sql(
    "counts", "cells", "genes", "metrics", "layers",
    extra=STRESS_SQL
    + ",\n" + SCORES_SQL
    + ",\n" + INTRONIC_SQL
    + """, base AS (SELECT m.*, stress, nuclear, score_a, score_b, native_a, intronic_fraction FROM metrics m JOIN frac USING (cell)
      LEFT JOIN scores USING (cell) JOIN intr USING (cell)),\n"""
    + ",\n".join(
        [
            severity_sql("e1", "base", "ln(1 + n_genes_by_counts)", "donor", False),
            severity_sql("e2", "base", "ln(1 + total_counts)", "donor", False),
            severity_sql("e3", "base", "pct_mito", "donor", True),
            severity_sql("e4", "base", "stress", "donor", True),
            severity_sql("e5", "base", "nuclear", "donor", True),
            severity_sql("e6", "base", "intronic_fraction", "donor", True),
            severity_sql("e7", "base", "score_a", "donor", True),
            severity_sql("e8", "base", "score_b", "donor", True),
        ]
    )
    + """, ev AS (SELECT base.*, e1.sev AS ev_genes, e2.sev AS ev_counts, e3.sev AS ev_mito, e4.sev AS ev_stress, e5.sev AS ev_nuclear,
      e6.sev AS ev_intronic, CASE WHEN e7.sev IS NOT NULL AND e8.sev IS NOT NULL THEN LEAST(e7.sev, e8.sev) END AS ev_doublet
      FROM base JOIN e1 USING (cell) JOIN e2 USING (cell) JOIN e3 USING (cell) JOIN e4 USING (cell) JOIN e5 USING (cell)
      JOIN e6 USING (cell) JOIN e7 USING (cell) JOIN e8 USING (cell)),
    fam AS (SELECT *, GREATEST(ev_genes, ev_counts) AS f_cap, GREATEST(ev_mito, ev_stress * 0.6) AS f_met,
      GREATEST(ev_nuclear, ev_intronic) AS f_nuc, ev_doublet AS f_mul FROM ev),
    cov AS (SELECT *, ((f_cap IS NOT NULL)::INT + (f_met IS NOT NULL)::INT + (f_nuc IS NOT NULL)::INT + (f_mul IS NOT NULL)::INT) / 4.0 AS coverage FROM fam),
    tally AS (SELECT *, COALESCE(f_cap >= 0.5, FALSE)::INT + COALESCE(f_met >= 0.5, FALSE)::INT + COALESCE(f_nuc >= 0.5, FALSE)::INT AS n_con,
      COALESCE(f_cap >= 0.667, FALSE)::INT + COALESCE(f_met >= 0.667, FALSE)::INT + COALESCE(f_nuc >= 0.667, FALSE)::INT AS n_sev,
      COALESCE(f_cap >= 0.667, FALSE)::INT + COALESCE(f_nuc >= 0.667, FALSE)::INT AS n_est,
      COALESCE(f_met >= 0.5, FALSE)::INT AS n_sup, COALESCE(f_cap >= 0.9, FALSE) AS empty_cell, COALESCE(f_mul >= 0.6, FALSE) AS multiplet FROM cov),
    ver0 AS (SELECT *, n_sev >= 2 AND n_est >= 1 AS concordant, coverage >= 0.5 AS covered FROM tally),
    ver AS (SELECT *, CASE WHEN (empty_cell OR concordant) AND covered THEN 'quarantine' WHEN empty_cell OR concordant OR n_con > 0 THEN 'borderline' ELSE 'core' END AS qc_state,
      CASE WHEN multiplet AND n_con = 0 AND NOT ((empty_cell OR concordant) AND covered) THEN 'probable_multiplet'
        WHEN empty_cell AND covered THEN 'uninformative_barcode' WHEN concordant AND covered THEN 'concordant_severe_damage'
        WHEN empty_cell OR concordant THEN 'withheld_low_coverage' WHEN n_con > 0 AND n_sup = n_con THEN 'supporting_evidence_only'
        WHEN n_con > 0 THEN 'single_family_concern' ELSE 'no_concern' END AS qc_reason,
      CASE WHEN n_con = 0 THEN '' WHEN COALESCE(f_cap, -1) >= COALESCE(f_nuc, -1) AND COALESCE(f_cap, -1) >= COALESCE(f_met, -1) THEN 'capture_complexity'
        WHEN COALESCE(f_nuc, -1) >= COALESCE(f_met, -1) THEN 'nuclear_integrity' ELSE 'metabolic_stress' END AS primary_driver,
      coverage * LEAST(COALESCE(abs(GREATEST(f_cap, f_met, f_nuc) - 0.5) / 0.5, 0), 1) AS qc_confidence FROM ver0)""",
)


@query(
    "c9_evidence_families",
    EVIDENCE_SQL
    + """SELECT cell, round(f_cap, 6) AS family_capture_complexity, round(f_nuc, 6) AS family_nuclear_integrity,
    round(f_met, 6) AS family_metabolic_stress, round(f_mul, 6) AS family_multiplet, coverage::DOUBLE AS evidence_coverage FROM cov""",
)
def c9(spark, sf):
    fams = [f"family_{f}" for f in ("capture_complexity", "nuclear_integrity", "metabolic_stress", "multiplet")]
    return r(evidence(spark, sf).select("cell", *fams, "evidence_coverage"), *fams)


@query(
    "c9_evidence_axes",
    EVIDENCE_SQL
    + " UNION ALL ".join(
        f"""SELECT cell, '{a.column}' AS axis, '{a.family}' AS family, round({a.column}, 6) AS severity,
        CASE WHEN {a.column} IS NULL THEN 'computation_failed' ELSE 'available_valid' END AS availability FROM ev"""
        for a in AXES
    ),
)
def c9_long(spark, sf):
    return r(q.evidence_long(evidence(spark, sf), AXES), "severity")


def verdicts(spark, sf):
    return q.eligibility_masks(materialise(q.adjudicate_qc(evidence(spark, sf))))


@query(
    "c10_qc_verdicts",
    EVIDENCE_SQL
    + """SELECT cell, qc_state, qc_reason, n_con AS concerning_families, n_sev AS severe_families, primary_driver,
    multiplet AS probable_multiplet, round(qc_confidence, 6) AS qc_confidence FROM ver""",
)
def c10(spark, sf):
    out = q.adjudicate_qc(evidence(spark, sf)).select(
        "cell", "qc_state", "qc_reason", "concerning_families", "severe_families", "primary_driver",
        "probable_multiplet", "qc_confidence",
    )
    return r(out, "qc_confidence")


def mask_sql() -> str:
    out = []
    for a in q.ANALYSES:
        for p in q.PERMISSIONS:
            states = "'core'"
            if (a, p) in (("manifold", "transform"), ("clustering", "transform"), ("annotation", "transform"),
                          ("annotation", "inference"), ("composition", "transform")):
                states += ", 'borderline'"
            if (a, p) == ("manifold", "transform"):
                states += ", 'quarantine'"
            keep = "" if a == "annotation" else " AND NOT multiplet"
            out.append(f"(qc_state IN ({states}){keep}) AS qc_{p}_{a}")
    return ", ".join(out)


@query("c11_eligibility_masks", EVIDENCE_SQL + f"SELECT cell, {mask_sql()} FROM ver")
def c11(spark, sf):
    return verdicts(spark, sf).select("cell", *q.mask_columns())


CATEGORY_SQL = """CASE WHEN multiplet AND qc_state <> 'core' THEN 'multiplet_plus_damage' WHEN multiplet THEN 'probable_multiplet_only'
    WHEN qc_state = 'quarantine' AND qc_reason = 'concordant_severe_damage' THEN 'quarantine_multi_family_damage'
    WHEN qc_state = 'quarantine' AND qc_reason = 'uninformative_barcode' THEN 'quarantine_capture_complexity'
    WHEN qc_state = 'quarantine' THEN 'quarantine_other' WHEN qc_state = 'borderline' THEN 'borderline_nonmultiplet' ELSE 'eligible' END"""


@query(
    "c12_exclusion_audit",
    EVIDENCE_SQL
    + f""", mk AS (SELECT *, {mask_sql()} FROM ver),
    au AS (SELECT cell, {CATEGORY_SQL} AS exclusion_category, """
    + " + ".join(f"(NOT {m})::INT" for m in q.mask_columns())
    + """ AS n_permissions_denied FROM mk)
    SELECT * FROM au WHERE n_permissions_denied > 0""",
)
def c12(spark, sf):
    return q.inference_excluded(verdicts(spark, sf)).select("cell", "exclusion_category", "n_permissions_denied")


@query(
    "c12_physically_removed",
    with_sql("counts", "cells", "genes", "metrics", extra=FLOORS_SQL)
    + "SELECT cell, floor_reason FROM fc WHERE floor_reason <> ''",
)
def c12_removed(spark, sf):
    decided = q.cell_floors(metrics(spark, sf), 3, 100)
    return q.physically_removed(decided, decided.filter("keep")).select("cell", "floor_reason")


@query(
    "c13_doublet_consensus",
    with_sql("cells", extra=SCORES_SQL)
    + """SELECT cell, score_a IS NOT NULL AND native_a > 0.5 AS call_a, COALESCE(score_b >= 0.5, FALSE) AS call_b,
    score_a IS NOT NULL AS measured_a, score_b IS NOT NULL AS measured_b,
    (score_a IS NOT NULL AND native_a > 0.5) AND COALESCE(score_b >= 0.5, FALSE) AS predicted_doublet,
    round(GREATEST(score_a, score_b), 6) AS doublet_score FROM cells LEFT JOIN scores USING (cell)""",
)
def c13(spark, sf):
    cells = b.cells(spark, sf).join(scored_lines(spark, sf), "cell", "left")
    out = q.doublet_consensus(cells, {"a": ("score_a", "native_a"), "b": ("score_b", None)}, "majority")
    out = out.select("cell", "call_a", "call_b", "measured_a", "measured_b", "predicted_doublet", "doublet_score")
    return r(out, "doublet_score")


@query(
    "c19_lineage_coherence",
    with_sql("dense", "dcells")
    + """, k AS (SELECT cell_type, gene, COUNT(*) AS n FROM dense JOIN dcells USING (cell) WHERE value > 0 GROUP BY 1, 2),
    s AS (SELECT cell_type, COUNT(*) AS nc FROM dcells GROUP BY 1)
    SELECT cell_type, round(COUNT(*) FILTER (n / nc >= 0.8) / (SELECT COUNT(DISTINCT p_brand) FROM part), 6) AS coherence
    FROM k JOIN s USING (cell_type) GROUP BY 1""",
)
def c19(spark, sf):
    brands = b.table(spark, sf, "part").select(F.col("p_brand").alias("gene")).distinct()
    out = q.lineage_coherence(b.dense_counts(spark, sf), b.dense_cells(spark, sf), brands, "cell_type", 0.8)
    return r(out, "coherence")


AUDIT_SQL = """aud AS (SELECT cell_type, COUNT(*) AS n_cells, median(GREATEST(f_cap, f_met, f_nuc)) AS median_severity,
      AVG((qc_state <> 'core')::INT) AS excluded_fraction, AVG(multiplet::INT) AS multiplet_fraction,
      COALESCE(AVG((qc_state <> 'core')::INT) FILTER (NOT multiplet), 0) AS damage_excluded_fraction FROM ver GROUP BY 1)"""


def lineage_audit(cells):
    fams = [f"family_{f}" for f in ("capture_complexity", "nuclear_integrity", "metabolic_stress")]
    return q.audit_lineages(
        cells.withColumn("excluded", F.col("qc_state") != "core"), "cell_type", fams, "excluded", "probable_multiplet"
    )


@query(
    "c19_lineage_audit",
    EVIDENCE_SQL
    + ", " + AUDIT_SQL
    + """SELECT cell_type, n_cells, round(median_severity, 6) AS median_severity, round(excluded_fraction, 6) AS excluded_fraction,
    round(multiplet_fraction, 6) AS multiplet_fraction, round(damage_excluded_fraction, 6) AS damage_excluded_fraction,
    median_severity >= 0.667 AS suspect, damage_excluded_fraction >= 0.5 AS vulnerable FROM aud""",
)
def c19_audit(spark, sf):
    out = lineage_audit(materialise(verdicts(spark, sf)))
    return r(out, "median_severity", "excluded_fraction", "multiplet_fraction", "damage_excluded_fraction")


@query(
    "c21_intronic_fraction",
    with_sql("cells", "layers", extra=INTRONIC_SQL) + "SELECT cell, round(intronic_fraction, 9) AS intronic_fraction FROM intr",
)
def c21(spark, sf):
    out = q.intronic_fraction(b.layers(spark, sf), b.cells(spark, sf).select("cell"))
    return r(out, "intronic_fraction", places=9)


@query(
    "c24_finalize_qc",
    EVIDENCE_SQL
    + """SELECT cell, qc_state, CASE WHEN qc_state = 'borderline' THEN
      CASE WHEN score_b BETWEEN 0.5 AND 1.0 AND score_a BETWEEN 0 AND 0.95 AND NOT COALESCE(f_cap >= 0.6, FALSE) AND NOT COALESCE(f_met >= 0.6, FALSE)
        AND NOT multiplet THEN 'rescued' ELSE 'unresolved_borderline' END ELSE qc_state END AS qc_state_final FROM ver""",
)
def c24(spark, sf):
    out = q.finalize_qc(
        verdicts(spark, sf), "score_b", "score_a",
        ["family_capture_complexity", "family_metabolic_stress"], severe=0.6,
    )
    return out.select("cell", "qc_state", "qc_state_final")


@query(
    "c25_self_check",
    EVIDENCE_SQL
    + ", " + AUDIT_SQL
    + """, keys AS (SELECT *, CASE WHEN COUNT(*) OVER (PARTITION BY donor, cell_type) >= 100 THEN 'sample_x_lineage'
        WHEN COUNT(*) OVER (PARTITION BY cell_type) >= 100 THEN 'lineage' ELSE 'pooled' END AS null_level FROM ver),
      nest AS (SELECT cell_type, COUNT(*) AS m, COUNT(*) FILTER (null_level = 'lineage') AS o FROM keys GROUP BY 1)
    SELECT 'posterior_not_rescaled' AS name, COALESCE(MAX(abs(ev_mito - pct_mito / 100)), 0) <= 0.05 AS passed, 'fail' AS verdict FROM ver
    UNION ALL SELECT 'fallback_nulls_are_nested', (SELECT COUNT(DISTINCT null_level) FROM keys) <= 1 OR COALESCE(bool_or(m > o), TRUE), 'fail' FROM nest WHERE o > 0
    UNION ALL SELECT 'no_coherent_population_removed', COUNT(*) FILTER (damage_excluded_fraction >= 0.5 AND n_cells >= 50 AND n_cells / (SELECT SUM(n_cells) FROM aud) >= 0.02) = 0, 'fail' FROM aud
    UNION ALL SELECT 'masks_agree_with_state', COUNT(*) FILTER ((qc_state = 'core' AND NOT multiplet) AND qc_state <> 'core') = 0, 'fail' FROM ver
    UNION ALL SELECT 'core_fraction_plausible', AVG((qc_state = 'core')::INT) >= 0.5, 'warn' FROM ver""",
)
def c25(spark, sf):
    cells = q.resolve_null_groups(materialise(verdicts(spark, sf)), "donor", "cell_type", 100)
    cells = materialise(cells.withColumn("share", F.col("pct_counts_mito") / 100))
    return q.qc_self_check(
        cells, lineage_audit(cells), "cell_type", "share", "ev_mito",
        {"sample_x_lineage": "cell", "lineage": "cell_type"},
    )


@query(
    "c26_qc_report",
    with_sql("counts", "cells", "genes", "metrics", extra=FLOORS_SQL)
    + """, k AS (SELECT cell_type, floor_reason <> '' AS gone FROM fc JOIN cells USING (cell))
    SELECT COALESCE(cell_type, 'TOTAL') AS cell_type, COUNT(*) AS cells_before_qc, COUNT(*) FILTER (gone) AS cells_removed,
    round(100.0 * COUNT(*) FILTER (gone) / COUNT(*), 6) AS pct_removed, COUNT(*) FILTER (NOT gone) AS cells_after_qc FROM k GROUP BY ROLLUP (cell_type)""",
)
def c26(spark, sf):
    return r(q.qc_report(q.cell_floors(metrics(spark, sf), 3, 100), "cell_type"), "pct_removed")


@query(
    "c26_rule_attribution",
    with_sql("counts", "cells", "genes", "metrics")
    + """, f AS (SELECT n_genes_by_counts < 3 AS few_genes, total_counts < 100 AS few_counts, pct_mito > 30 AS high_mito FROM metrics),
    h AS (SELECT *, few_genes::INT + few_counts::INT + high_mito::INT AS hits FROM f)
    SELECT 'few_genes' AS rule, COUNT(*) FILTER (few_genes) AS n_failed, COUNT(*) FILTER (few_genes AND hits = 1) AS n_unique FROM h
    UNION ALL SELECT 'few_counts', COUNT(*) FILTER (few_counts), COUNT(*) FILTER (few_counts AND hits = 1) FROM h
    UNION ALL SELECT 'high_mito', COUNT(*) FILTER (high_mito), COUNT(*) FILTER (high_mito AND hits = 1) FROM h""",
)
def c26_rules(spark, sf):
    m = metrics(spark, sf).withColumns(
        {
            "few_genes": F.col("n_genes_by_counts") < 3,
            "few_counts": F.col("total_counts") < 100,
            "high_mito": F.col("pct_counts_mito") > 30,
        }
    )
    return q.rule_attribution(m, ["few_genes", "few_counts", "high_mito"])


@query(
    "c26_sample_summary",
    with_sql("counts", "cells", "genes", "metrics")
    + """SELECT sample, COUNT(*) AS cells_in, COUNT(*) FILTER (n_genes_by_counts >= 3) AS cells_kept,
    COUNT(*) FILTER (n_genes_by_counts < 3) AS cells_removed, round(100.0 * COUNT(*) FILTER (n_genes_by_counts < 3) / COUNT(*), 6) AS pct_removed,
    CASE WHEN MIN(donor) = MAX(donor) THEN MIN(donor) ELSE 'mixed' END AS donor,
    CASE WHEN MIN(library) = MAX(library) THEN MIN(library) ELSE 'mixed' END AS library,
    round(median(total_counts), 6) AS median_total_counts, round(median(pct_mito), 6) AS median_pct_counts_mito FROM metrics GROUP BY sample""",
)
def c26_samples(spark, sf):
    m = q.cell_floors(metrics(spark, sf), 3, None)
    out = q.sample_summary(m, "sample", ["total_counts", "pct_counts_mito"], ["donor", "library"])
    return r(out, "pct_removed", "median_total_counts", "median_pct_counts_mito")


@query(
    "c26_state_reasons",
    EVIDENCE_SQL
    + """SELECT qc_state, qc_reason, COUNT(*) AS cells, round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM ver), 6) AS pct FROM ver GROUP BY 1, 2""",
)
def c26_states(spark, sf):
    return r(q.state_reasons(materialise(verdicts(spark, sf))), "pct")


@query(
    "c28_merge_metrics",
    with_sql("counts", "cells", "genes", "metrics")
    + """SELECT 'price' AS "column", round(MAX(abs(price - total_counts)), 6) AS max_difference, COUNT(*) FILTER (abs(price - total_counts) > 1e-9) AS n_different,
    COUNT(price) AS n_inherited FROM metrics""",
)
def c28(spark, sf):
    cells = b.cells(spark, sf)
    fresh = metrics(spark, sf).select("cell", F.col("total_counts").alias("price"), "n_genes_by_counts")
    return r(q.merge_metrics(cells, fresh)[1], "max_difference")


@query(
    "c29_ambient_correction",
    with_sql("counts", "cells", "genes", "metrics")
    + """, kept AS (SELECT cell FROM metrics WHERE n_genes_by_counts >= 3),
    e AS (SELECT gene, SUM(value) AS g FROM counts WHERE cell NOT IN (SELECT cell FROM kept)
      AND cell IN (SELECT cell FROM counts GROUP BY 1 HAVING SUM(value) < 100) GROUP BY 1),
    p AS (SELECT gene, g / (SELECT SUM(g) FROM e) AS share FROM e),
    d AS (SELECT cell, SUM(value) AS depth FROM counts GROUP BY 1)
    SELECT cell, gene, value AS observed, round(GREATEST(0.0, value - 0.1 * depth * COALESCE(share, 0)), 6) AS value
    FROM counts JOIN kept USING (cell) JOIN d USING (cell) LEFT JOIN p USING (gene)""",
)
def c29(spark, sf):
    kept = metrics(spark, sf).filter(F.col("n_genes_by_counts") >= 3).select("cell")
    return r(q.ambient_correct(b.counts(spark, sf), kept, 0.1), "value")


PAIRS_SQL = """, kept AS (SELECT cell, library, cell_type AS cluster FROM metrics WHERE n_genes_by_counts >= 4),
    em AS (SELECT library, gene, SUM(value) AS g FROM counts JOIN cells USING (cell) WHERE cell NOT IN (SELECT cell FROM kept) AND cell IN (SELECT cell FROM counts GROUP BY 1 HAVING SUM(value) < 100) GROUP BY 1, 2),
    pf AS (SELECT library, gene, g / SUM(g) OVER (PARTITION BY library) AS share FROM em), ow AS (SELECT library, cluster, gene, value FROM counts JOIN kept USING (cell) WHERE value > 0),
    nn AS (SELECT library, cluster, COUNT(*) AS n FROM kept GROUP BY 1, 2), dp AS (SELECT library, cluster, SUM(value) AS depth FROM ow GROUP BY 1, 2), se AS (SELECT library, cluster, gene, SUM(value) AS observed, COUNT(*) AS m FROM ow GROUP BY 1, 2, 3),
    tt AS (SELECT library, SUM(n) AS a FROM nn GROUP BY 1), sp AS (SELECT library, gene, SUM(m) AS h FROM se GROUP BY 1, 2),
    mk AS (SELECT DISTINCT library, gene FROM se JOIN nn USING (library, cluster) JOIN tt USING (library) JOIN sp USING (library, gene) WHERE m / n * ln(a / h) >= 0.03),
    br AS (SELECT library, quantile_cont(share, 0.6) AS bar FROM pf GROUP BY 1), mp AS (SELECT library, gene, share FROM pf JOIN br USING (library) JOIN mk USING (library, gene) WHERE share >= bar),
    pr AS (SELECT mp.library, dp.cluster, mp.gene, COALESCE(se.observed, 0) AS observed, depth * share AS expected FROM mp JOIN dp ON dp.library = mp.library LEFT JOIN se ON se.library = mp.library AND se.cluster = dp.cluster AND se.gene = mp.gene),
    sl AS (SELECT *, observed = 0 OR 1 - list_sum(list_transform(range(0, CAST(ceil(observed) AS BIGINT)), lambda i: exp(i * ln(0.8 * expected) - 0.8 * expected - lgamma(i + 1)))) >= 0.05 AS silent FROM pr)"""


def contamination_pairs(spark, sf):
    m = metrics(spark, sf)
    kept = m.filter(F.col("n_genes_by_counts") >= 4).select("cell", F.col("cell_type").alias("cluster"))
    raw, droplets = b.counts(spark, sf), b.cells(spark, sf).select("cell", "library")
    return ambient.silent_pairs(raw, droplets, kept, materialise(ambient.ambient_profile(raw, droplets, kept), "profile"), min_tfidf=0.03, soup_quantile=0.6)


@query(
    "c29_silent_pairs",
    with_sql("counts", "cells", "genes", "metrics").rstrip() + PAIRS_SQL + " SELECT library, cluster, gene, observed, round(expected, 6) AS expected, silent FROM sl",
)
def c29_pairs(spark, sf):
    return r(contamination_pairs(spark, sf), "expected")


@query(
    "c29_estimate_rho",
    with_sql("counts", "cells", "genes", "metrics").rstrip()
    + PAIRS_SQL
    + """, s AS (SELECT library, observed + 0.25 AS a, expected + 5 AS b FROM sl WHERE silent), dn AS (SELECT library, i * 0.001 AS rho, round(AVG(exp(a * ln(b) - lgamma(a) + (a - 1) * ln(i * 0.001) - b * i * 0.001)), 9) AS d FROM s, range(1, 801) g(i) GROUP BY 1, 2),
    md AS (SELECT library, rho FROM (SELECT *, row_number() OVER (PARTITION BY library ORDER BY d DESC, rho) AS rn FROM dn) WHERE rn = 1)
    SELECT library, round(rho::DOUBLE, 6) AS rho, round(SUM(observed) / SUM(expected), 6) AS pooled, COUNT(*) AS n_pairs FROM sl JOIN md USING (library) WHERE silent GROUP BY library, rho""",
)
def c29_rho(spark, sf):
    return r(ambient.estimate_rho(contamination_pairs(spark, sf)), "rho", "pooled")
