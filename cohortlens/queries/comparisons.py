"""Donor-level comparison queries: condition F against O, donors are nations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import checks
from ..functions.fdr import bh_fdr
from ..operators import compare as j
from ..plans.study import eligible_composition
from . import bindings as b
from .bindings import with_sql
from .data_checks import SAMPLES_SQL, samples
from .quality import EVIDENCE_SQL, metrics, r, verdicts
from .registry import bh_sql, query, t_two_sided_sql

ARMS = dict(case="F", control="O")


def case_cells(spark, sf):
    return b.cells(spark, sf).filter(F.col("condition").isin("F", "O"))


def type_counts(spark, sf):
    return j.celltype_counts(case_cells(spark, sf), ["donor", "condition"], "cell_type")


COUNTS_SQL = """cc0 AS (SELECT donor, condition, cell_type, COUNT(*) AS n FROM cells WHERE condition IN ('F', 'O') GROUP BY 1, 2, 3),
    cc AS (SELECT u.donor, u.condition, t.cell_type, COALESCE(n, 0) AS n FROM (SELECT DISTINCT donor, condition FROM cc0) u
      CROSS JOIN (SELECT DISTINCT cell_type FROM cc0) t LEFT JOIN cc0 ON cc0.donor = u.donor AND cc0.condition = u.condition AND cc0.cell_type = t.cell_type),
    tot AS (SELECT donor, condition, SUM(n) AS total FROM cc GROUP BY 1, 2),
    sh AS (SELECT cc.*, total, n / total AS share, asin(sqrt(n / total)) AS z, ln(n + 0.5) - AVG(ln(n + 0.5)) OVER (PARTITION BY cc.donor, cc.condition) AS clr
      FROM cc JOIN tot USING (donor, condition))"""


def paired_sql(name: str, source: str, item: str, value: str, agg: str = "AVG") -> str:
    """CTEs ``name_w`` (donor arms) and ``name`` (paired statistics per item)."""
    return f"""{name}_w AS (SELECT {item}, donor, {agg}({value}) FILTER (condition = 'F') AS a, {agg}({value}) FILTER (condition = 'O') AS k
      FROM {source} WHERE condition IN ('F', 'O') AND {value} IS NOT NULL GROUP BY {item}, donor),
    {name}_d AS (SELECT *, a - k AS d FROM {name}_w WHERE a IS NOT NULL AND k IS NOT NULL),
    {name} AS (SELECT {item}, COUNT(*) AS n_pairs, AVG(a) AS mean_case, AVG(k) AS mean_control, AVG(d) AS delta, median(d) AS median_delta, stddev_samp(d) AS sd,
      AVG(d) / (stddev_samp(d) / sqrt(COUNT(*))) AS t, COUNT(*) - 1 AS df, COUNT(*) FILTER (d > 0) AS n_pos, sign(AVG(d))::INT AS direction,
      (SUM(d) - MAX(d)) / (COUNT(*) - 1) AS loo_min, (SUM(d) - MIN(d)) / (COUNT(*) - 1) AS loo_max,
      GREATEST(COUNT(*) FILTER (d > 0), 0) AS up, COUNT(*) FILTER (d < 0) AS dn FROM {name}_d GROUP BY {item})"""


@query(
    "j1_pseudobulk",
    with_sql("counts", "cells")
    + "SELECT donor, condition, gene, CAST(SUM(value) AS BIGINT) AS count FROM counts JOIN cells USING (cell) GROUP BY 1, 2, 3",
)
def j1(spark, sf):
    return j.pseudobulk(b.counts(spark, sf), b.cells(spark, sf), ["donor", "condition"])


@query(
    "j1_pseudobulk_units",
    with_sql("cells") + "SELECT sample, MIN(donor) AS donor, MIN(condition) AS condition, COUNT(*) AS n_cells, TRUE AS constant FROM cells GROUP BY 1",
)
def j1_units(spark, sf):
    return j.pseudobulk_units(b.cells(spark, sf), ["sample"], ["donor", "condition"])


@query(
    "j2_pseudobulk_support",
    with_sql("counts", "cells")
    + """, u AS (SELECT DISTINCT sample, donor, condition FROM cells), pop AS (SELECT * FROM cells WHERE cell_type = 'BUILDING' AND label2 = '1-URGENT'),
    el AS (SELECT * FROM pop WHERE price >= 60000), o AS (SELECT sample, COUNT(*) AS no FROM pop GROUP BY 1), e AS (SELECT sample, COUNT(*) AS ne FROM el GROUP BY 1),
    l AS (SELECT sample, CAST(SUM(value) AS BIGINT) AS lib FROM el JOIN counts USING (cell) GROUP BY 1),
    x AS (SELECT u.*, COALESCE(no, 0) AS n_cells_observed, COALESCE(ne, 0) AS n_cells, COALESCE(lib, 0) AS library_size FROM u LEFT JOIN o USING (sample) LEFT JOIN e USING (sample) LEFT JOIN l USING (sample)),
    y AS (SELECT *, n_cells_observed - n_cells AS n_cells_qc_excluded, CASE WHEN n_cells_observed = 0 THEN 'population_absent'
      WHEN n_cells = 0 THEN 'population_present_but_no_de_eligible_cells' WHEN n_cells < 9 AND n_cells_observed > n_cells THEN 'below_min_cells_after_qc'
      WHEN n_cells < 9 THEN 'below_min_cells' WHEN library_size = 0 THEN 'zero_library_size' END AS exclusion_reason FROM x)
    SELECT *, exclusion_reason IS NULL AS included_for_expression FROM y""",
)
def j2(spark, sf):
    cells = b.cells(spark, sf)
    pop = cells.filter((F.col("cell_type") == "BUILDING") & (F.col("label2") == "1-URGENT"))
    eligible = pop.filter(F.col("price") >= 60000)
    universe = cells.select("sample", "donor", "condition").distinct()
    return j.pseudobulk_support(universe, pop, eligible, b.counts(spark, sf), "sample", 9)


@query(
    "j3_resolve_pairing",
    with_sql("cells")
    + """, u AS (SELECT sample, donor, condition, COUNT(*) AS n_cells FROM cells WHERE label2 = '1-URGENT' AND cell_type = 'MACHINERY' AND price > 100000 AND condition IN ('F','O') GROUP BY 1, 2, 3),
    a AS (SELECT donor, bool_or(condition = 'F') AS c1, bool_or(condition = 'O') AS c0 FROM u GROUP BY 1),
    s AS (SELECT COUNT(*) FILTER (c1 AND c0) AS np, COUNT(*) FILTER (NOT (c1 AND c0)) AS ni FROM a)
    SELECT sample, u.donor, condition, TRUE AS paired, np AS n_complete_pairs, ni AS n_incomplete FROM u JOIN a USING (donor), s WHERE c1 AND c0""",
)
def j3(spark, sf):
    cells = case_cells(spark, sf).filter(
        (F.col("label2") == "1-URGENT") & (F.col("cell_type") == "MACHINERY") & (F.col("price") > 100000)
    )
    units = cells.select("sample", "donor", "condition").distinct()
    return j.resolve_pairing(units, "donor", "condition", "F", "O", True).select(
        "sample", "donor", "condition", "paired", "n_complete_pairs", "n_incomplete"
    )


@query(
    "j4_support_gates",
    with_sql("cells", extra=SAMPLES_SQL)
    + """, g AS (SELECT condition, label2, COUNT(*) AS n_samples, COUNT(DISTINCT donor) AS n_subjects FROM samples GROUP BY 1, 2)
    SELECT 'samples_per_cell' AS gate, concat(condition, ' × ', label2) AS unit, n_samples AS n, 26 AS needed FROM g WHERE n_samples < 26
    UNION ALL SELECT 'subjects_per_cell', concat(condition, ' × ', label2), n_subjects, 2 FROM g WHERE n_subjects < 2
    UNION ALL SELECT 'subjects_per_between_level', concat('condition=', condition), COUNT(DISTINCT donor), 26 FROM samples GROUP BY condition HAVING COUNT(DISTINCT donor) < 26""",
)
def j4(spark, sf):
    s = samples(spark, sf)
    grid = checks.factor_cells(s, "condition", "label2", "donor")
    levels = checks.factor_support(s, ["condition"], "donor")
    return j.support_gates(grid, levels, 26, 2, 26, ["condition"])


DE_SQL = """pb0 AS (SELECT donor, condition, gene, CAST(SUM(value) AS BIGINT) AS c FROM {src} JOIN cells USING (cell) WHERE condition IN ('F', 'O') GROUP BY 1, 2, 3),
    libs AS (SELECT donor, condition, SUM(c)::DOUBLE AS lib FROM pb0 GROUP BY 1, 2),
    grid AS (SELECT donor, condition, lib, gene, COALESCE(c, 0) AS c FROM libs CROSS JOIN (SELECT DISTINCT gene FROM pb0) g LEFT JOIN pb0 USING (donor, condition, gene)),
    arms AS (SELECT COUNT(*) FILTER (condition = 'F') AS n1, COUNT(*) FILTER (condition = 'O') AS n0, median(lib) AS med FROM libs),
    keep AS (SELECT gene FROM grid, arms GROUP BY gene, n1, n0, med HAVING COUNT(*) FILTER (c / lib >= 10 / med - 1e-14) >= CASE WHEN LEAST(n1, n0) > 10 THEN 10 + (LEAST(n1, n0) - 10) * 0.7 ELSE LEAST(n1, n0) END - 1e-14 AND SUM(c) >= 15),
    lc AS (SELECT *, log2((c + 0.5) / (lib + 1.0) * 1e6) AS x FROM grid WHERE gene IN (SELECT gene FROM keep))"""


@query(
    "j5_pseudobulk_de_paired",
    with_sql("brandc", "cells", extra=DE_SQL.format(src="brandc") + ",\n" + paired_sql("p", "lc", "gene", "x"))
    + f""", f AS (SELECT gene, delta, t, df, {t_two_sided_sql('t', 'df')} AS p FROM p)
    SELECT gene, round(delta, 6) AS "logFC", round(t, 5) AS t, df::DOUBLE AS df, round(p, 6) AS p, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p')}""",
)
def j5(spark, sf):
    pb = j.pseudobulk(b.brand_counts(spark, sf), case_cells(spark, sf), ["donor", "condition"])
    out = j.pseudobulk_de(pb, "donor", "condition", **ARMS)
    return r(r(out, "logFC", "p", "fdr"), "t", places=5)


@query(
    "j5_pseudobulk_de_welch",
    with_sql("brandc", "cells", extra=DE_SQL.format(src="brandc"))
    + """, w AS (SELECT gene, AVG(x) FILTER (condition = 'F') - AVG(x) FILTER (condition = 'O') AS d, var_samp(x) FILTER (condition = 'F') / COUNT(*) FILTER (condition = 'F') AS a,
      var_samp(x) FILTER (condition = 'O') / COUNT(*) FILTER (condition = 'O') AS k, COUNT(*) FILTER (condition = 'F') AS n1, COUNT(*) FILTER (condition = 'O') AS n0 FROM lc GROUP BY 1)
    SELECT gene, round(d, 6) AS "logFC", round(d / sqrt(a + k), 5) AS t, round((a + k) * (a + k) / (a * a / (n1 - 1) + k * k / (n0 - 1)), 4) AS df FROM w""",
)
def j5_welch(spark, sf):
    pb = j.pseudobulk(b.brand_counts(spark, sf), case_cells(spark, sf), ["donor", "condition"])
    out = j.pseudobulk_de(pb, "donor", "condition", **ARMS, paired=False).select("gene", "logFC", "t", "df")
    return r(r(r(out, "logFC"), "t", places=5), "df", places=4)


@query("j6_celltype_counts", with_sql("cells", extra=COUNTS_SQL) + "SELECT donor, condition, cell_type, n FROM cc")
def j6(spark, sf):
    return type_counts(spark, sf)


@query(
    "j7_composition",
    with_sql("cells")
    + """, k AS (SELECT condition, cell_type, COUNT(*) AS n FROM cells GROUP BY 1, 2 UNION ALL SELECT 'ALL', cell_type, COUNT(*) FROM cells GROUP BY 2)
    SELECT condition, cell_type, n, round(n / SUM(n) OVER (PARTITION BY condition), 9) AS fraction FROM k""",
)
def j7(spark, sf):
    return r(j.composition(b.cells(spark, sf), "cell_type", "condition"), "fraction", places=9)


@query(
    "j7_sample_shares",
    with_sql("cells", extra=COUNTS_SQL)
    + "SELECT donor, condition, cell_type, n, CAST(total AS BIGINT) AS total, round(share, 9) AS share FROM sh",
)
def j7_shares(spark, sf):
    return r(j.sample_shares(type_counts(spark, sf), ["donor", "condition"]), "share", places=9)


@query(
    "j8_donor_median_paired",
    with_sql("cells")
    + """, m AS (SELECT cell_type, donor, median(price) FILTER (condition = 'F') - median(price) FILTER (condition = 'O') AS d FROM cells WHERE condition IN ('F', 'O') GROUP BY 1, 2)
    SELECT cell_type, 'wilcoxon_signed_rank' AS test, COUNT(d) AS n_case, COUNT(d) AS n_control, round(median(d), 4) AS effect FROM m GROUP BY 1""",
)
def j8(spark, sf):
    out = j.donor_median_test(b.cells(spark, sf), "price", "condition", "donor", "F", "O", True, ["cell_type"], incomplete="drop")
    return r(out.drop("p"), "effect", places=4)


def region_arms(spark, sf):
    """Two sets of donors: nations of the first two regions against the others."""
    n = b.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("donor"), "n_regionkey")
    return b.cells(spark, sf).join(n, "donor").withColumn("arm", F.when(F.col("n_regionkey") < 2, "case").otherwise("control"))


@query(
    "j8_donor_median_unpaired",
    with_sql("cells")
    + """, m AS (SELECT cell_type, donor, n_regionkey < 2 AS is_case, median(price) AS v FROM cells JOIN nation ON donor = CAST(n_nationkey AS VARCHAR) GROUP BY 1, 2, 3),
    k AS (SELECT *, rank() OVER (PARTITION BY cell_type ORDER BY v) + (COUNT(*) OVER (PARTITION BY cell_type, v) - 1) / 2.0 AS rk FROM m)
    SELECT cell_type, 'mann_whitney' AS test, COUNT(*) FILTER (is_case) AS n_case, COUNT(*) FILTER (NOT is_case) AS n_control,
    round(median(v) FILTER (is_case) - median(v) FILTER (NOT is_case), 4) AS effect FROM k GROUP BY 1""",
)
def j8_unpaired(spark, sf):
    out = j.donor_median_test(region_arms(spark, sf), "price", "arm", "donor", "case", "control", False, ["cell_type"])
    return r(out.drop("p"), "effect", places=4)


@query("j8_donor_median_p_values")
def j8_p(spark, sf):
    return j.donor_median_test(b.cells(spark, sf), "price", "condition", "donor", "F", "O", True, ["cell_type"], incomplete="drop")


STATE_SQL = """st AS (SELECT donor, condition, u.score, u.value FROM metrics, LATERAL (VALUES ('price', price), ('total_counts', total_counts), ('n_genes_by_counts', n_genes_by_counts::DOUBLE)) u(score, value) WHERE condition IN ('F', 'O')),
    sm AS (SELECT score, donor, condition, median(value) AS m FROM st GROUP BY 1, 2, 3 HAVING COUNT(*) >= 20)"""


@query(
    "j9_differential_state",
    with_sql("counts", "cells", "genes", "metrics", extra=STATE_SQL + ",\n" + paired_sql("p", "sm", "score", "m"))
    + """SELECT score, n_pairs, round(median_delta, 6) AS effect, 'tested' AS status FROM p""",
)
def j9(spark, sf):
    out = j.differential_state(metrics(spark, sf), ["price", "total_counts", "n_genes_by_counts"], "donor", "condition", "F", "O")
    return r(out.select("score", "n_pairs", "effect", "status"), "effect")


@query("j9_differential_state_p_values")
def j9_p(spark, sf):
    return j.differential_state(metrics(spark, sf), ["price", "total_counts", "n_genes_by_counts"], "donor", "condition", "F", "O")


@query(
    "j10_composition_paired",
    with_sql("cells", extra=COUNTS_SQL + ",\n" + paired_sql("p", "sh", "cell_type", "100.0 * share"))
    + "SELECT cell_type, n_pairs, round(delta, 6) AS mean_difference FROM p",
)
def j10(spark, sf):
    shares = j.sample_shares(type_counts(spark, sf), ["donor", "condition"])
    out = j.composition_paired_test(shares, "cell_type", "donor", "condition", "F", "O")
    return r(out.select("cell_type", "n_pairs", "mean_difference"), "mean_difference")


@query(
    "j11_proportion_ttest_paired",
    with_sql("cells", extra=COUNTS_SQL + ",\n" + paired_sql("p", "sh", "cell_type", "z") + ",\n" + paired_sql("s", "sh", "cell_type", "share"))
    + f""", f AS (SELECT p.cell_type, p.n_pairs, p.mean_case, p.mean_control, p.t, p.df, 100 * s.delta AS effect_pp,
      CASE WHEN s.delta > 0 THEN s.up ELSE s.dn END AS same, {t_two_sided_sql('p.t', 'p.df')} AS p FROM p JOIN s USING (cell_type))
    SELECT cell_type, n_pairs, round(mean_case, 6) AS mean_case, round(mean_control, 6) AS mean_control, round(t, 6) AS t, df::DOUBLE AS df, round(effect_pp, 6) AS effect_pp,
    same AS n_donors_with_mean, round(p, 6) AS p, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p')}""",
)
def j11(spark, sf):
    out = j.proportion_ttest(type_counts(spark, sf), "cell_type", "donor", "condition", **ARMS)
    return r(out, "mean_case", "mean_control", "t", "effect_pp", "p", "fdr")


@query(
    "j11_proportion_ttest_welch",
    with_sql("cells", extra=COUNTS_SQL)
    + """, w AS (SELECT cell_type, AVG(z) FILTER (condition = 'F') - AVG(z) FILTER (condition = 'O') AS d, var_samp(z) FILTER (condition = 'F') / COUNT(*) FILTER (condition = 'F') AS a,
      var_samp(z) FILTER (condition = 'O') / COUNT(*) FILTER (condition = 'O') AS k, COUNT(*) FILTER (condition = 'F') AS n1, COUNT(*) FILTER (condition = 'O') AS n0,
      100 * (AVG(share) FILTER (condition = 'F') - AVG(share) FILTER (condition = 'O')) AS pp FROM sh GROUP BY 1)
    SELECT cell_type, n1 AS n_case, n0 AS n_control, round(d, 6) AS effect, round(d / sqrt(a + k), 6) AS t, round((a + k) * (a + k) / (a * a / (n1 - 1) + k * k / (n0 - 1)), 5) AS df, round(pp, 6) AS effect_pp FROM w""",
)
def j11_welch(spark, sf):
    out = j.proportion_ttest(type_counts(spark, sf), "cell_type", "donor", "condition", **ARMS, paired=False)
    out = out.select("cell_type", "n_case", "n_control", "effect", "t", "df", "effect_pp")
    return r(r(out, "effect", "t", "effect_pp"), "df", places=5)


@query("j11_bootstrap_interval")
def j11_boot(spark, sf):
    shares = j.sample_shares(type_counts(spark, sf), ["donor", "condition"])
    wide = j.arms(shares, ["cell_type"], "donor", "condition", "share", "F", "O")
    return j.bootstrap_interval(wide, ["cell_type"], "donor", 500)


@query("j12_propeller")
def j12(spark, sf):
    return j.propeller_test(type_counts(spark, sf), "cell_type", "donor", "condition", **ARMS)


@query(
    "j12_propeller_effects",
    with_sql("cells", extra=COUNTS_SQL + ",\n" + paired_sql("p", "lg", "cell_type", "y").replace("p_w AS", """lg AS (SELECT *, ln(((n + 0.5) / (total + 0.5)) / (1 - LEAST((n + 0.5) / (total + 0.5), 1 - 1e-9))) AS y FROM sh),
    p_w AS""", 1) + ",\n" + paired_sql("s", "sh", "cell_type", "share"))
    + "SELECT cell_type, round(p.delta, 6) AS effect, round(p.sd * p.sd, 6) AS variance, round(s.mean_case / s.mean_control, 6) AS ratio FROM p JOIN s USING (cell_type)",
)
def j12_effects(spark, sf):
    out = j.propeller_test(type_counts(spark, sf), "cell_type", "donor", "condition", **ARMS, transform="logit")
    return r(out.select("cell_type", "effect", "variance", "ratio"), "effect", "variance", "ratio")


@query(
    "j14_select_reference",
    with_sql("cells", extra=COUNTS_SQL)
    + """, c AS (SELECT cell_type, AVG((n > 0)::INT) AS presence, AVG(share) AS ab, var_pop(clr) AS v, stddev_pop(share) / AVG(share) AS cv FROM sh GROUP BY 1),
    e AS (SELECT *, CASE WHEN bool_or(presence >= 0.95 AND ab >= 0.05) OVER () THEN presence >= 0.95 AND ab >= 0.05 ELSE presence >= 0.95 END AS eligible FROM c)
    SELECT cell_type, round(presence, 6) AS presence, round(ab, 6) AS mean_abundance, round(v, 6) AS clr_variance, round(cv, 6) AS abundance_cv, eligible,
    COALESCE(cell_type = (SELECT arg_min(cell_type, v) FROM e WHERE eligible), FALSE) AS selected FROM e""",
)
def j14(spark, sf):
    out = j.select_reference(type_counts(spark, sf), ["donor", "condition"], "cell_type")
    return r(out, "presence", "mean_abundance", "clr_variance", "abundance_cv")


def sign_p_sql(k: str, n: str) -> str:
    return f"LEAST(1.0, list_sum(list_transform(range({k}, {n} + 1), lambda i: exp(lgamma({n} + 1) - lgamma(i + 1) - lgamma({n} - i + 1) - {n} * ln(2.0)))))"


def pattern_sql(src: str) -> str:
    return f"""{src}_x AS (SELECT *, CASE WHEN direction > 0 THEN up WHEN direction < 0 THEN dn ELSE 0 END AS n_agree, CASE WHEN direction > 0 THEN loo_min > 0 WHEN direction < 0 THEN loo_max < 0 ELSE FALSE END AS stable,
      direction <> 0 AND sign(median_delta) = direction AS agree FROM {src}),
    {src}_y AS (SELECT *, {sign_p_sql('n_agree', '(up + dn)')} AS sp FROM {src}_x),
    {src}_z AS (SELECT *, CASE WHEN n_pairs < 6 THEN 'underpowered' WHEN direction = 0 THEN 'heterogeneous' WHEN sp < 0.05 AND stable THEN 'consistent'
      WHEN sp < 0.05 THEN 'single_donor_driven' WHEN NOT agree THEN 'direction_inconsistent' ELSE 'heterogeneous' END AS pattern FROM {src}_y)"""


CONC_SQL = with_sql(
    "cells",
    extra=COUNTS_SQL + ",\n" + paired_sql("p", "sh", "cell_type", "clr") + ",\n" + paired_sql("s", "sh", "cell_type", "100.0 * share") + ",\n" + pattern_sql("p"),
)


@query(
    "j15_paired_concordance",
    CONC_SQL
    + f""", f AS (SELECT p.*, s.delta AS pp, s.median_delta AS mpp FROM p_z p JOIN s USING (cell_type))
    SELECT cell_type, n_pairs, n_agree, direction, round(pp, 6) AS mean_delta_pp, round(mpp, 6) AS median_delta_pp, round(delta, 6) AS mean_delta_clr, round(median_delta, 6) AS median_delta_clr,
    round(loo_min, 6) AS loo_mean_clr_min, round(loo_max, 6) AS loo_mean_clr_max, stable AS loo_sign_stable, agree AS signs_agree, round(sp, 6) AS sign_test_p, pattern, round(fdr, 6) AS sign_test_fdr
    FROM {bh_sql('f', 'sp')}""",
)
def j15(spark, sf):
    out = j.paired_concordance(type_counts(spark, sf), "cell_type", "donor", "condition", "F", "O").drop("wilcoxon_p", "wilcoxon_fdr")
    return r(out, "mean_delta_pp", "median_delta_pp", "mean_delta_clr", "median_delta_clr", "loo_mean_clr_min", "loo_mean_clr_max", "sign_test_p", "sign_test_fdr")


def label_values(spark, sf):
    """Mean price per donor, condition and priority; an item seen in one arm only loses its pair."""
    return case_cells(spark, sf).filter((F.col("condition") == "F") | (F.col("label2") != "5-LOW") | (F.col("donor") > "2")).groupBy(
        "label2", "donor", "condition"
    ).agg(F.avg("price").alias("value"))


@query(
    "j16_paired_value_concordance",
    with_sql(
        "cells",
        extra="""lv AS (SELECT label2, donor, condition, AVG(price) AS value FROM cells WHERE condition IN ('F', 'O') AND (condition = 'F' OR label2 <> '5-LOW' OR donor > '2') GROUP BY 1, 2, 3),
    """ + paired_sql("p", "lv", "label2", "value") + ",\n" + pattern_sql("p"),
    )
    + f""", oa AS (SELECT label2, COUNT(*) FILTER (a IS NULL OR k IS NULL) AS one_arm, COUNT(*) FILTER (k IS NULL) AS co, COUNT(*) FILTER (a IS NULL) AS ko, COUNT(*) FILTER (a IS NOT NULL AND k IS NOT NULL) AS np FROM p_w GROUP BY 1),
    f AS (SELECT p.*, one_arm, LEAST(1.0, 2 * sp) AS sc, LEAST(1.0, 2 * exp(-(np * ln(2.0) + lgamma(co + ko + 1) - lgamma(co + 1) - lgamma(ko + 1)))) AS fl FROM p_z p JOIN oa USING (label2))
    SELECT label2, n_pairs, one_arm AS n_donors_one_arm, n_agree, direction, round(mean_case, 4) AS mean_case, round(mean_control, 4) AS mean_control, round(delta, 4) AS mean_delta, round(median_delta, 4) AS median_delta,
    round(loo_min, 4) AS loo_mean_min, round(loo_max, 4) AS loo_mean_max, stable AS loo_sign_stable, agree AS signs_agree, round(sp, 6) AS sign_test_p, round(sc, 6) AS sign_test_p_conservative, round(fl, 9) AS design_floor_p, pattern,
    round(fdr, 6) AS sign_test_fdr_conservative FROM {bh_sql('f', 'sc')}""",
)
def j16(spark, sf):
    out = j.paired_value_concordance(label_values(spark, sf), "label2", "donor", "condition", "value", "F", "O")
    out = out.drop("wilcoxon_p", "wilcoxon_fdr", "sign_test_fdr")
    out = r(out, "mean_case", "mean_control", "mean_delta", "median_delta", "loo_mean_min", "loo_mean_max", places=4)
    return r(r(out, "sign_test_p", "sign_test_p_conservative", "sign_test_fdr_conservative"), "design_floor_p", places=9)


@query(
    "j17_qualify_calls",
    CONC_SQL
    + f""", f AS (SELECT * FROM {bh_sql('p_z', 'sp')}), e AS (SELECT cell_type, n_pairs, n_agree, pattern, fdr FROM f)
    SELECT cell_type, COALESCE(pattern = 'consistent' AND fdr < 0.05, FALSE) AS concordance_called, n_pairs >= 6 AND n_agree >= n_pairs AS unanimous, pattern, pattern <> 'consistent' AS needs_note FROM e""",
)
def j17(spark, sf):
    counts = type_counts(spark, sf)
    effects = counts.select("cell_type").distinct().withColumn("significant", F.lit(True))
    conc = j.paired_concordance(counts, "cell_type", "donor", "condition", "F", "O")
    return j.qualify_calls(effects, conc, "cell_type", "significant", "sign_test_fdr").drop("significant")


@query(
    "j18_group_resolution",
    with_sql("cells", extra=COUNTS_SQL)
    + """SELECT cell_type, CAST(SUM(n) AS BIGINT) AS total_cells, COUNT(*) AS n_samples, median(n)::DOUBLE AS median_cells_per_sample, MIN(n) AS min_cells_per_sample, COUNT(*) FILTER (n = 0) AS n_samples_zero,
    median(n) FILTER (condition = 'F')::DOUBLE AS median_cells_case, median(n) FILTER (condition = 'O')::DOUBLE AS median_cells_control, median(n) >= 40 AS ratio_rankable FROM cc GROUP BY 1""",
)
def j18(spark, sf):
    return j.group_resolution(type_counts(spark, sf), "cell_type", "condition", "F", "O", 40).drop("resolution_note")


@query(
    "j19_design_floor",
    with_sql("cells")
    + """, d AS (SELECT cell_type, donor, bool_or(condition = 'F') AS a, bool_or(condition = 'O') AS k FROM cells WHERE condition IN ('F', 'O') GROUP BY 1, 2)
    SELECT cell_type, COUNT(*) FILTER (a AND k) AS n_pairs, COUNT(*) FILTER (a AND NOT k) AS n_case_only, COUNT(*) FILTER (k AND NOT a) AS n_control_only,
    round(LEAST(1.0, 2 * exp(-(COUNT(*) FILTER (a AND k) * ln(2.0) + lgamma(COUNT(*) FILTER (a <> k) + 1) - lgamma(COUNT(*) FILTER (a AND NOT k) + 1) - lgamma(COUNT(*) FILTER (k AND NOT a) + 1)))), 12) AS floor_p FROM d GROUP BY 1""",
)
def j19(spark, sf):
    return r(j.randomization_floor(b.cells(spark, sf), "donor", "condition", "F", "O", ["cell_type"]), "floor_p", places=12)


@query(
    "j19_fdr_reachability",
    with_sql("cells", extra=COUNTS_SQL + ",\n" + paired_sql("p", "sh", "cell_type", "z"))
    + f"""SELECT cell_type, round({t_two_sided_sql('t', 'df')}, 6) AS p, round(2 * pow(0.5, 25), 12) AS design_floor_p, 5 AS family_size, FALSE AS p_below_design_floor, 1 AS family_min_concordant, TRUE AS family_floor_reachable FROM p""",
)
def j19_reach(spark, sf):
    table = j.proportion_ttest(type_counts(spark, sf), "cell_type", "donor", "condition", **ARMS).select("cell_type", "p")
    floor = j.randomization_floor(b.cells(spark, sf), "donor", "condition", "F", "O")
    return r(r(j.annotate_reachability(table, floor, "p"), "p"), "design_floor_p", places=12)


def price_arms(spark, sf):
    per = case_cells(spark, sf).groupBy("cell_type", "donor", "condition").agg(F.avg("price").alias("value"))
    return j.arms(per, ["cell_type"], "donor", "condition", "value", "F", "O")


@query(
    "j20_donor_effect",
    with_sql("cells", extra=paired_sql("p", "cells", "cell_type", "price"))
    + f"""SELECT cell_type, 'paired_t' AS test, n_pairs, (SELECT COUNT(a) FROM p_w w WHERE w.cell_type = p.cell_type) AS n_case, (SELECT COUNT(k) FROM p_w w WHERE w.cell_type = p.cell_type) AS n_control, round(delta, 4) AS effect, round(t, 6) AS t, round({t_two_sided_sql('t', 'df')}, 6) AS p, '' AS reason FROM p""",
)
def j20(spark, sf):
    out = j.donor_effect(price_arms(spark, sf), ["cell_type"]).drop("ci_low", "ci_high")
    return r(r(out, "effect", places=4), "t", "p")


@query("j20_donor_effect_intervals")
def j20_ci(spark, sf):
    return j.donor_effect(price_arms(spark, sf), ["cell_type"])


def region_wide(spark, sf):
    """Paired differences over regions: five donors, so the sign flips are enumerated exactly."""
    per = region_arms(spark, sf).filter(F.col("condition").isin("F", "O")).groupBy("cell_type", "n_regionkey", "condition").agg(F.avg("price").alias("value"))
    return j.arms(per.withColumn("donor", F.col("n_regionkey").cast("string")), ["cell_type"], "donor", "condition", "value", "F", "O")


@query(
    "j21_sign_flip_exact",
    with_sql("cells")
    + """, d AS (SELECT cell_type, n_regionkey AS donor, AVG(price) FILTER (condition = 'F') - AVG(price) FILTER (condition = 'O') AS d, row_number() OVER (PARTITION BY cell_type ORDER BY n_regionkey) - 1 AS i
      FROM cells JOIN nation ON donor = CAST(n_nationkey AS VARCHAR) GROUP BY 1, 2),
    s AS (SELECT cell_type, mask, abs(SUM(d * (CASE WHEN (mask >> i) & 1 = 1 THEN -1 ELSE 1 END))) AS v, abs(SUM(d)) AS o, SUM(abs(d)) AS sz, COUNT(*) AS n FROM d, range(0, 32) m(mask) GROUP BY 1, 2)
    SELECT cell_type, n AS n_pairs, round(AVG((v >= o - 1e-12 * GREATEST(1.0, sz))::INT), 6) AS p, 'sign_flip_exact' AS method FROM s GROUP BY 1, 2""",
)
def j21(spark, sf):
    return r(j.sign_flip_test(region_wide(spark, sf), ["cell_type"]), "p")


@query("j21_label_permutation")
def j21_labels(spark, sf):
    per = region_arms(spark, sf).groupBy("cell_type", "donor", "arm").agg(F.avg("price").alias("value"))
    return j.label_permutation_test(j.arms(per, ["cell_type"], "donor", "arm", "value", "case", "control"), ["cell_type"])


@query(
    "j22_module_effects",
    with_sql("counts", "cells", "genes", "metrics",
        extra="""lg AS (SELECT cell_type, donor, condition, u.program, AVG(u.value) AS value FROM metrics, LATERAL (VALUES ('price', price), ('total_counts', total_counts)) u(program, value) WHERE condition IN ('F', 'O') GROUP BY 1, 2, 3, 4),
    """ + paired_sql("p", "lg", "cell_type, program", "value"))
    + f""", f AS (SELECT *, {t_two_sided_sql('t', 'df')} AS p FROM p)
    SELECT cell_type, program, 'paired_t' AS test, n_pairs, round(delta, 4) AS effect, round(t, 6) AS t, round(p, 6) AS p, round(pow(2.0, 1 - n_pairs), 12) AS floor_p, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p')}""",
)
def j22(spark, sf):
    out = j.module_effects(metrics(spark, sf), ["price", "total_counts"], "cell_type", "donor", "condition", "F", "O")
    out = out.select("cell_type", "program", "test", "n_pairs", "effect", "t", "p", "floor_p", "fdr")
    return r(r(r(out, "effect", places=4), "t", "p", "fdr"), "floor_p", places=12)


@query(
    "j23_recorrect",
    with_sql("cells", extra="""lb AS (SELECT cell_type, label2, donor, condition, AVG(price) AS value FROM cells WHERE condition IN ('F', 'O') GROUP BY 1, 2, 3, 4),
    """ + paired_sql("p", "lb", "cell_type, label2", "value"))
    + f""", f AS (SELECT cell_type, label2, {t_two_sided_sql('t', 'df')} AS p FROM p)
    SELECT cell_type, label2, round(p, 6) AS p, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p', 'cell_type')}""",
)
def j23(spark, sf):
    per = case_cells(spark, sf).groupBy("cell_type", "label2", "donor", "condition").agg(F.avg("price").alias("value"))
    table = j.donor_effect(j.arms(per, ["cell_type", "label2"], "donor", "condition", "value", "F", "O"), ["cell_type", "label2"])
    return r(j.recorrect(table.select("cell_type", "label2", "p"), "p", ["cell_type"]), "p", "fdr")


@query(
    "j23_panel_membership",
    """WITH items AS (SELECT DISTINCT concat(l_partkey, '->', l_suppkey) AS item, CAST(l_partkey AS VARCHAR) AS a, CAST(l_suppkey AS VARCHAR) AS c FROM lineitem),
    sets AS (SELECT DISTINCT p_brand AS source, CAST(p_partkey AS VARCHAR) AS target FROM part UNION SELECT DISTINCT concat('Brand#', s_nationkey + 1), CAST(s_suppkey AS VARCHAR) FROM supplier)
    SELECT item, x.source FROM items JOIN sets x ON x.target = a JOIN sets y ON y.target = c AND y.source = x.source""",
)
def j23_panels(spark, sf):
    items = b.table(spark, sf, "lineitem").select(
        F.concat(F.col("l_partkey").cast("string"), F.lit("->"), F.col("l_suppkey").cast("string")).alias("item")
    )
    nations = b.table(spark, sf, "supplier").select(
        F.concat(F.lit("Brand#"), (F.col("s_nationkey") + 1).cast("string")).alias("source"), F.col("s_suppkey").cast("string").alias("target")
    )
    return j.panel_membership(items, b.net(spark, sf).unionByName(nations).distinct(), "item")


def sample_scores(spark, sf):
    return metrics(spark, sf).filter(F.col("condition").isin("F", "O")).groupBy("cell_type", "sample", "condition").agg(
        (F.avg("price") / 1000).alias("x1"), F.avg("total_counts").alias("x2"), F.avg("pct_counts_mito").alias("x3")
    )


@query(
    "j24_permanova",
    with_sql("counts", "cells", "genes", "metrics")
    + """, s AS (SELECT cell_type, sample, condition, AVG(price) / 1000 AS x1, AVG(total_counts) AS x2, AVG(pct_mito) AS x3 FROM metrics WHERE condition IN ('F', 'O') GROUP BY 1, 2, 3),
    d AS (SELECT a.cell_type, a.condition AS ca, b.condition AS cb, (a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.x3 - b.x3) * (a.x3 - b.x3) AS q
      FROM s a JOIN s b ON a.cell_type = b.cell_type AND a.sample < b.sample),
    n AS (SELECT cell_type, COUNT(*) AS n, COUNT(*) FILTER (condition = 'F') AS k FROM s GROUP BY 1),
    w AS (SELECT cell_type, n, k, SUM(q) / n AS tot, SUM(q) FILTER (ca = 'F' AND cb = 'F') / k + SUM(q) FILTER (ca = 'O' AND cb = 'O') / (n - k) AS wit FROM d JOIN n USING (cell_type) GROUP BY 1, 2, 3)
    SELECT cell_type, n, k AS n_case, round((tot - wit) / (wit / (n - 2)), 6) AS "pseudo_F", round((tot - wit) / tot, 6) AS "R2" FROM w""",
)
def j24(spark, sf):
    out = j.permanova(sample_scores(spark, sf), "cell_type", "sample", "condition", "F", ["x1", "x2", "x3"], n_perm=49)
    return r(out.select("cell_type", "n", "n_case", "pseudo_F", "R2"), "pseudo_F", "R2")


@query("j24_permanova_p_values")
def j24_p(spark, sf):
    return j.permanova(sample_scores(spark, sf), "cell_type", "sample", "condition", "F", ["x1", "x2", "x3"])


@query(
    "j25_depth_audit",
    with_sql("counts", "cells", "genes", "metrics",
        extra="""ml AS (SELECT donor, condition, u.metric, u.value, ln(1 + total_counts) AS ld FROM metrics, LATERAL (VALUES ('price', price), ('pct_counts_mito', pct_mito), ('n_genes_by_counts', n_genes_by_counts::DOUBLE)) u(metric, value) WHERE condition IN ('F', 'O')),
    mc AS (SELECT *, value - AVG(value) OVER w AS y, ld - AVG(ld) OVER w AS x FROM ml WINDOW w AS (PARTITION BY metric, donor, condition)),
    sl AS (SELECT metric, SUM(x * y) / SUM(x * x) AS slope, AVG(ld) AS ref FROM mc GROUP BY 1),
    sm AS (SELECT metric, donor, condition, AVG(value) AS raw, AVG(value - slope * (ld - ref)) AS adj, AVG(ld) AS dep FROM mc JOIN sl USING (metric) GROUP BY 1, 2, 3),
    """ + paired_sql("a", "sm", "metric", "raw") + ",\n" + paired_sql("c", "sm", "metric", "adj") + ",\n" + paired_sql("e", "sm", "metric", "dep"))
    + f""", f AS (SELECT a.metric, a.n_pairs, a.delta AS rd, a.t AS rt, {t_two_sided_sql('a.t', 'a.df')} AS rp, c.delta AS ad, c.t AS ate, {t_two_sided_sql('c.t', 'c.df')} AS ap, {t_two_sided_sql('e.t', 'e.df')} AS dp, slope
      FROM a JOIN c USING (metric) JOIN e USING (metric) JOIN sl USING (metric))
    SELECT metric, n_pairs, round(rd, 5) AS raw_delta, round(rp, 6) AS raw_p, round(ad, 5) AS adjusted_delta, round(ap, 6) AS adjusted_p, round(dp, 6) AS depth_p, round(slope, 5) AS slope,
    CASE WHEN n_pairs < 6 THEN 'insufficient_pairs' WHEN dp >= 0.05 THEN 'depth_balanced' WHEN rp >= 0.05 AND ap < 0.05 THEN 'depth_masked' WHEN rp >= 0.05 THEN 'no_raw_effect'
      WHEN sign(ad) <> sign(rd) OR abs(ad) / abs(rd) < 0.25 THEN 'depth_driven' WHEN ap >= 0.05 THEN 'attenuated' ELSE 'robust' END AS verdict, round(fdr, 6) AS raw_fdr FROM {bh_sql('f', 'rp')}""",
)
def j25(spark, sf):
    out = j.depth_audit(metrics(spark, sf), ["price", "pct_counts_mito", "n_genes_by_counts"], "total_counts", "donor", "condition", "F", "O")
    out = out.select("metric", "n_pairs", "raw_delta", "raw_p", "adjusted_delta", "adjusted_p", "depth_p", "slope", "verdict", "raw_fdr")
    return r(r(out, "raw_p", "adjusted_p", "depth_p", "raw_fdr"), "raw_delta", "adjusted_delta", "slope", places=5)


@query(
    "j25_within_sample_rho",
    with_sql("counts", "cells", "genes", "metrics")
    + """, k AS (SELECT donor, condition, rank() OVER (PARTITION BY donor, condition ORDER BY price) + (COUNT(*) OVER (PARTITION BY donor, condition, price) - 1) / 2.0 AS rv,
      rank() OVER (PARTITION BY donor, condition ORDER BY total_counts) + (COUNT(*) OVER (PARTITION BY donor, condition, total_counts) - 1) / 2.0 AS rd FROM metrics),
    c AS (SELECT donor, condition, COUNT(*) AS n, corr(rv, rd) AS rho FROM k GROUP BY 1, 2)
    SELECT round(AVG(rho), 9) AS mean_rho, COUNT(*) AS n_samples FROM c WHERE n >= 5""",
)
def j25_rho(spark, sf):
    return r(j.within_sample_rho(metrics(spark, sf), "price", "total_counts", ["donor", "condition"]), "mean_rho", places=9)


@query(
    "j26_depth_stratified_abundance",
    with_sql("counts", "cells", "genes", "metrics",
        extra="""m0 AS (SELECT donor, condition, cell_type AS label, total_counts AS d FROM metrics WHERE condition IN ('F', 'O')),
    ed AS (SELECT quantile_cont(d, 1/3) AS e1, quantile_cont(d, 2/3) AS e2 FROM m0),
    m1 AS (SELECT m0.*, CAST((d > e1)::INT + (d > e2)::INT AS VARCHAR) AS stratum FROM m0, ed), m2 AS (SELECT * FROM m1 UNION ALL SELECT donor, condition, label, d, 'all' FROM m0),
    tt AS (SELECT stratum, donor, condition, COUNT(*) AS total FROM m2 GROUP BY 1, 2, 3), nn AS (SELECT stratum, donor, condition, label, COUNT(*) AS n FROM m2 GROUP BY 1, 2, 3, 4),
    sh AS (SELECT tt.*, l.label, COALESCE(n, 0) / total AS share FROM tt CROSS JOIN (SELECT DISTINCT label FROM m0) l LEFT JOIN nn USING (stratum, donor, condition, label)),
    """ + paired_sql("p", "sh", "label, stratum", "share"))
    + f""", f AS (SELECT label, stratum, n_pairs, mean_case, mean_control, delta, n_pos, t, {t_two_sided_sql('t', 'df')} AS t_p FROM p), g AS (SELECT * FROM {bh_sql('f', 't_p', 'stratum')}),
    ag AS (SELECT s.label, 'all' AS stratum, COUNT(*) AS ns, COUNT(*) FILTER (sign(s.delta) = sign(a.delta)) AS nsame, COUNT(*) FILTER (s.t_p < 0.05) AS nsig FROM g s JOIN g a ON s.label = a.label AND a.stratum = 'all' WHERE s.stratum <> 'all' AND s.n_pairs >= 6 GROUP BY 1)
    SELECT label, stratum, n_pairs, round(mean_case, 6) AS mean_case, round(mean_control, 6) AS mean_control, round(delta, 6) AS delta, n_pos AS n_donors_positive, round(t_p, 6) AS t_p, round(fdr, 6) AS fdr, ns AS n_strata, nsame AS n_strata_same_sign, nsig AS n_strata_significant,
    CASE WHEN stratum <> 'all' THEN NULL WHEN n_pairs < 6 THEN 'insufficient_pairs' WHEN t_p >= 0.05 THEN 'no_raw_effect' WHEN COALESCE(ns, 0) = 0 THEN 'insufficient_pairs' WHEN nsame = ns AND nsig >= 1 THEN 'robust' WHEN nsame >= ns - 1 THEN 'attenuated' ELSE 'depth_driven' END AS verdict
    FROM g LEFT JOIN ag USING (label, stratum)""",
)
def j26(spark, sf):
    out = j.depth_stratified_abundance(metrics(spark, sf), "cell_type", "total_counts", "donor", "condition", "F", "O").drop("t")
    return r(out, "mean_case", "mean_control", "delta", "t_p", "fdr")


def mediated(spark, sf, n_boot):
    cells = metrics(spark, sf).filter(F.col("condition").isin("F", "O"))
    return j.mediation(cells, ["sample"], F.col("condition") == "F", ["total_counts", "pct_counts_mito"], "price", "donor", n_boot)


@query(
    "j27_mediation",
    with_sql("counts", "cells", "genes", "metrics")
    + """, s AS (SELECT sample, AVG((condition = 'F')::INT) AS t, AVG(price) AS y, AVG(total_counts) AS m1, AVG(pct_mito) AS m2 FROM metrics WHERE condition IN ('F', 'O') GROUP BY 1),
    l AS (SELECT 'total_counts' AS mediator, t, y, m1 AS m FROM s UNION ALL SELECT 'pct_counts_mito', t, y, m2 FROM s),
    c AS (SELECT mediator, COUNT(*) AS n, covar_pop(t, m) AS tm, var_pop(t) AS tt, var_pop(m) AS mm, covar_pop(t, y) AS ty, covar_pop(m, y) AS my FROM l GROUP BY 1),
    k AS (SELECT *, tm / tt AS a, (ty * mm - my * tm) / (tt * mm - tm * tm) AS d, (my * tt - ty * tm) / (tt * mm - tm * tm) AS bb FROM c)
    SELECT mediator, n AS n_samples, round(a, 5) AS path_a, round(bb, 4) AS path_b, round(d, 3) AS direct, round(a * bb, 3) AS acme, round(d + a * bb, 3) AS total, round(a * bb / (d + a * bb), 5) AS proportion_mediated FROM k""",
)
def j27(spark, sf):
    out = mediated(spark, sf, 2).select("mediator", "n_samples", "path_a", "path_b", "direct", "acme", "total", "proportion_mediated")
    return r(r(r(out, "path_a", "proportion_mediated", places=5), "path_b", places=4), "direct", "acme", "total", places=3)


@query("j27_mediation_intervals")
def j27_ci(spark, sf):
    return mediated(spark, sf, 100)


@query(
    "j27_feature_overlap",
    """WITH a AS (SELECT DISTINCT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')), c AS (SELECT DISTINCT p_partkey FROM part WHERE p_type = 'ECONOMY')
    SELECT COUNT(*) AS n_shared, round(COUNT(*) / ((SELECT COUNT(*) FROM a) + (SELECT COUNT(*) FROM c) - COUNT(*)), 6) AS jaccard,
    CASE WHEN COUNT(*) = 0 THEN 'disjoint' WHEN COUNT(*) / LEAST((SELECT COUNT(*) FROM a), (SELECT COUNT(*) FROM c)) >= 0.5 THEN 'nested' ELSE 'overlapping' END AS grade FROM a JOIN c USING (p_partkey)""",
)
def j27_overlap(spark, sf):
    net = b.net(spark, sf)
    types = b.genes(spark, sf).select(F.col("type").alias("source"), F.col("gene").alias("target"))
    out = j.feature_overlap_grade(net.filter(F.col("source").isin("Brand#1", "Brand#2", "Brand#3")), types.filter(F.col("source") == "ECONOMY"))
    return r(out, "jaccard")


QUOTA_SQL = """s AS (SELECT concat(cell_type, '|', condition) AS stratum, COUNT(*) AS available FROM cells GROUP BY 1), k AS (SELECT COUNT(*) AS k, SUM(available - 1) AS t FROM s),
    x AS (SELECT s.*, (500 - k) * (available - 1) / t AS e FROM s, k), y AS (SELECT *, 1 + floor(e) AS q, row_number() OVER (ORDER BY e - floor(e) DESC, stratum) AS rn FROM x),
    z AS (SELECT stratum, available, CAST(q + (rn <= 500 - (SELECT SUM(q) FROM y))::INT AS BIGINT) AS quota FROM y)"""


@query("j28_stratum_quotas", with_sql("cells", extra=QUOTA_SQL) + "SELECT * FROM z")
def j28(spark, sf):
    return j.stratum_quotas(b.cells(spark, sf), ["cell_type", "condition"], 500)


@query("j28_stratified_sample", with_sql("cells", extra=QUOTA_SQL) + "SELECT stratum, quota AS n FROM z")
def j28_draw(spark, sf):
    out = j.stratified_sample(b.cells(spark, sf), ["cell_type", "condition"], 500)
    return out.groupBy(F.concat_ws("|", "cell_type", "condition").alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "c27_qc_donor_comparisons",
    with_sql("counts", "cells", "genes", "metrics",
        extra="""sm AS (SELECT donor, condition, u.score, median(u.value) AS m FROM metrics, LATERAL (VALUES ('total_counts', total_counts), ('pct_counts_mito', pct_mito)) u(score, value) WHERE condition IN ('F', 'O') GROUP BY 1, 2, 3),
    """ + paired_sql("p", "sm", "score", "m"))
    + "SELECT score, 'wilcoxon_signed_rank' AS test, n_pairs AS n_case, n_pairs AS n_control, round(median_delta, 6) AS effect FROM p",
)
def c27(spark, sf):
    long = j.unpivot(metrics(spark, sf), ["donor", "condition"], ["total_counts", "pct_counts_mito"], "score", "value")
    out = j.donor_median_test(long, "value", "condition", "donor", "F", "O", True, ["score"], incomplete="drop")
    return r(out.drop("p"), "effect")


@query(
    "k2_bh_fdr",
    f"""WITH t AS (SELECT l_orderkey AS id, l_linenumber AS line, l_returnflag AS family, CASE WHEN l_discount > 0 THEN l_extendedprice / 200000.0 END AS p FROM lineitem)
    SELECT id, line, family, round(p, 9) AS p, round(fdr, 9) AS fdr FROM {bh_sql('t', 'p', 'family')}""",
)
def k2(spark, sf):
    t = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("family"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice") / 200000.0).alias("p"),
    )
    return r(bh_fdr(t, "p", ["family"]), "p", "fdr", places=9)


@query(
    "flagship_eligible_composition",
    EVIDENCE_SQL.replace("WITH cells AS", "WITH cells AS")
    + ", " + COUNTS_SQL.replace("FROM cells WHERE condition", "FROM ver WHERE qc_state = 'core' AND NOT multiplet AND condition")
    + ",\n" + paired_sql("p", "sh", "cell_type", "z") + ",\n" + paired_sql("pp", "sh", "cell_type", "share")
    + f""", f AS (SELECT p.cell_type, p.n_pairs, p.mean_case, p.mean_control, p.t, p.df, 100 * pp.delta AS effect_pp, CASE WHEN pp.delta > 0 THEN pp.up ELSE pp.dn END AS same, {t_two_sided_sql('p.t', 'p.df')} AS p FROM p JOIN pp USING (cell_type))
    SELECT cell_type, n_pairs, round(mean_case, 6) AS mean_case, round(mean_control, 6) AS mean_control, round(t, 6) AS t, df::DOUBLE AS df, round(effect_pp, 6) AS effect_pp, same AS n_donors_with_mean, round(p, 6) AS p, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p')}""",
)
def flagship(spark, sf):
    """Metrics → severities → verdicts → eligibility → zero-filled counts → paired proportion test → FDR."""
    out = eligible_composition(verdicts(spark, sf), "cell_type", "donor", "condition", **ARMS)
    return r(out, "mean_case", "mean_control", "t", "effect_pp", "p", "fdr")
