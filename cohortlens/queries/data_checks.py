"""Contracts and design checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import checks
from ..functions.levels import canonicalise
from ..operators import normalize
from . import bindings as b
from .registry import query
from .bindings import with_sql


@query(
    "b1_count_contract",
    with_sql("counts")
    + """SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (value IS NULL OR isnan(value)) AS n_not_finite,
    COUNT(*) FILTER (value < 0) AS n_negative, COUNT(*) FILTER (value <> floor(value)) AS n_fractional,
    COUNT(*) FILTER (value IS NULL OR value < 0 OR value <> floor(value)) = 0 AS ok FROM counts""",
)
def b1(spark, sf):
    return checks.count_violations(b.counts(spark, sf))


@query(
    "b2_lognorm_contract",
    with_sql("counts")
    + """, t AS (SELECT cell, SUM(value) AS t FROM counts GROUP BY 1),
    v AS (SELECT ln(1 + value * 10000.0 / t) AS x FROM counts JOIN t USING (cell))
    SELECT round(MAX(x), 9) AS max_value, bool_and(x = floor(x)) AS all_integer,
    COUNT(*) FILTER (x IS NULL OR isnan(x)) AS n_not_finite, (NOT bool_and(x = floor(x))) AND MAX(x) <= 12 AS ok FROM v""",
)
def b2(spark, sf):
    layer = normalize.log1p_cp10k(b.counts(spark, sf))
    return checks.lognorm_report(layer, 12.0).withColumn("max_value", F.round("max_value", 9))


@query(
    "b5_canonical_labels",
    """SELECT CAST(p_size AS VARCHAR) AS label, COUNT(*) AS n FROM part GROUP BY 1""",
)
def b5(spark, sf):
    p = b.table(spark, sf, "part").select(F.col("p_size").cast("double").alias("label"))
    return canonicalise(p, "label").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b6_constant_metadata",
    with_sql("cells")
    + """SELECT sample, MIN(donor) AS donor, MIN(condition) AS condition, MIN(cell_type) AS cell_type, COUNT(*) AS n_cells,
    COUNT(DISTINCT donor) = 1 AND COUNT(DISTINCT condition) = 1 AND COUNT(DISTINCT cell_type) = 1 AS constant
    FROM cells GROUP BY 1""",
)
def b6(spark, sf):
    return checks.constant_metadata(b.cells(spark, sf), ["sample"], ["donor", "condition", "cell_type"])


@query(
    "b7_design_summary",
    with_sql("cells")
    + """, d AS (SELECT donor, bool_or(condition = 'F') AS c1, bool_or(condition = 'O') AS c0 FROM cells
      WHERE condition IN ('F', 'O') GROUP BY 1)
    SELECT COUNT(*) FILTER (c1) AS n_case_donors, COUNT(*) FILTER (c0) AS n_control_donors,
    COUNT(*) FILTER (c1 AND c0) AS n_complete_pairs, COUNT(*) AS n_donors FROM d""",
)
def b7(spark, sf):
    return checks.design_summary(b.cells(spark, sf), "donor", "condition", "F", "O")


def samples(spark, sf):
    """Specimens: donor × status × priority, with subject = donor."""
    return b.cells(spark, sf).select(
        F.concat_ws("|", "donor", "condition", "label2").alias("specimen"), "donor", "condition", "label2"
    ).distinct()


SAMPLES_SQL = """samples AS (SELECT DISTINCT concat(donor, '|', condition, '|', label2) AS specimen, donor, condition, label2 FROM cells)"""


@query(
    "b8_design_matrix",
    with_sql("cells", extra=SAMPLES_SQL)
    + """SELECT specimen, 1.0::DOUBLE AS "Intercept", (condition = 'F')::INT::DOUBLE AS "condition_F", (condition = 'P')::INT::DOUBLE AS "condition_P",
    """
    + ", ".join(
        f"""(label2 = '{v}')::INT::DOUBLE AS "label2_{v}" """
        for v in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + ", "
    + ", ".join(
        f"""(condition = '{c}' AND label2 = '{v}')::INT::DOUBLE AS "condition_{c}:label2_{v}" """
        for c in ("F", "P")
        for v in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM samples",
)
def b8(spark, sf):
    return checks.design_matrix(
        samples(spark, sf), "specimen", ["condition", "label2"], [("condition", "label2")], {"condition": "O"}
    )


@query(
    "b8_empty_and_confounded",
    with_sql("cells", extra=SAMPLES_SQL)
    + """, l AS (SELECT * FROM (SELECT DISTINCT condition FROM samples), (SELECT DISTINCT label2 FROM samples))
    SELECT l.condition, l.label2, COUNT(s.specimen) AS n_samples, COUNT(DISTINCT s.donor) AS n_subjects, FALSE AS confounded
    FROM l LEFT JOIN samples s ON l.condition = s.condition AND l.label2 = s.label2 GROUP BY 1, 2""",
)
def b8_cells(spark, sf):
    s = samples(spark, sf)
    grid = checks.factor_cells(s, "condition", "label2", "donor")
    flag = checks.confounded(s, "condition", "label2").select("confounded")
    return checks.attach(grid, flag, [])


@query(
    "b9_factor_support",
    with_sql("cells", extra=SAMPLES_SQL)
    + """, l AS (SELECT 'condition' AS factor, condition AS level, donor FROM samples UNION ALL SELECT 'label2', label2, donor FROM samples),
    w AS (SELECT factor, donor, COUNT(DISTINCT level) > 1 AS varies FROM l GROUP BY 1, 2)
    SELECT factor, level, COUNT(*) AS n_samples, COUNT(DISTINCT l.donor) AS n_subjects,
    COUNT(DISTINCT CASE WHEN varies THEN l.donor END) AS n_subjects_within FROM l JOIN w USING (factor, donor) GROUP BY 1, 2""",
)
def b9(spark, sf):
    return checks.factor_support(samples(spark, sf), ["condition", "label2"], "donor")


@query(
    "b9_random_effects",
    with_sql("cells", extra=SAMPLES_SQL)
    + """, s AS (SELECT donor, COUNT(*) AS n FROM samples GROUP BY 1)
    SELECT COUNT(*) AS n_groups, MIN(n) AS min_specimens, MAX(n) AS max_specimens,
    COUNT(*) FILTER (n > 1) AS n_groups_with_repeats, 'donor' AS "column" FROM s""",
)
def b9_random(spark, sf):
    return checks.random_effect_support(samples(spark, sf), "donor")
