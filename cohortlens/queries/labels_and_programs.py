"""Partition, annotation and program-score queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as h
from ..operators import normalize
from ..operators import partitions as g
from ..operators import programs as i
from . import bindings as b
from .bindings import with_sql
from .quality import metrics, r
from .registry import query, t_two_sided_sql


def flags(spark, sf):
    """Cells that have lines, labelled by their largest return flag."""
    return b.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("cell")).agg(F.max("l_returnflag").alias("label"))


def three(spark, sf):
    cells = b.cells(spark, sf)
    return {
        "segment": cells.select("cell", F.col("cell_type").alias("label")),
        "priority": cells.select("cell", F.col("label2").alias("label")),
        "flag": flags(spark, sf),
    }


ALIGNED_SQL = """fl AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell, MAX(l_returnflag) AS flag FROM lineitem GROUP BY 1),
    al AS (SELECT cell, cell_type AS segment, label2 AS priority, flag FROM cells JOIN fl USING (cell))"""


@query("g1_align_partitions", with_sql("cells", extra=ALIGNED_SQL) + "SELECT * FROM al")
def g1(spark, sf):
    return g.align_partitions(three(spark, sf))


@query(
    "g1_partition_coverage",
    with_sql("cells", extra=ALIGNED_SQL)
    + """SELECT 'segment' AS partition, (SELECT COUNT(*) FROM cells) AS n_cells, (SELECT COUNT(*) FROM al) AS n_shared
    UNION ALL SELECT 'priority', (SELECT COUNT(*) FROM cells), (SELECT COUNT(*) FROM al) UNION ALL SELECT 'flag', (SELECT COUNT(*) FROM fl), (SELECT COUNT(*) FROM al)""",
)
def g1_coverage(spark, sf):
    return g.partition_coverage(three(spark, sf))


def agreement_sql(a: str, c: str) -> str:
    return f"""SELECT '{a}' AS partition_a, '{c}' AS partition_b, n AS n_cells, na AS n_a, nb AS n_b,
      round((sab - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)), 9) AS ari, round(mi, 9) AS mi, round(ta / n, 9) AS purity_a_in_b, round(tb / n, 9) AS purity_b_in_a FROM (
      WITH k AS (SELECT {a} AS a, {c} AS c, COUNT(*) AS n FROM al GROUP BY 1, 2), ka AS (SELECT a, SUM(n) AS n, MAX(n) AS t FROM k GROUP BY 1), kc AS (SELECT c, SUM(n) AS n, MAX(n) AS t FROM k GROUP BY 1)
      SELECT (SELECT CAST(SUM(n) AS BIGINT) FROM k) AS n, (SELECT COUNT(*) FROM ka) AS na, (SELECT COUNT(*) FROM kc) AS nb, (SELECT SUM(n * (n - 1) / 2) FROM k) AS sab, (SELECT SUM(n * (n - 1) / 2) FROM ka) AS sa, (SELECT SUM(n * (n - 1) / 2) FROM kc) AS sb,
      (SELECT SUM(t) FROM ka) AS ta, (SELECT SUM(t) FROM kc) AS tb, (SELECT SUM(k.n / tt.n * ln(k.n * tt.n / (ka.n * kc.n))) FROM k JOIN ka ON k.a = ka.a JOIN kc ON k.c = kc.c, (SELECT SUM(n)::DOUBLE AS n FROM k) tt) AS mi)"""


@query(
    "g2_partition_agreement",
    with_sql("cells", extra=ALIGNED_SQL)
    + " UNION ALL ".join(agreement_sql(a, c) for a, c in (("segment", "priority"), ("segment", "flag"), ("priority", "flag"))),
)
def g2(spark, sf):
    out = g.partition_agreement(g.align_partitions(three(spark, sf)), ["segment", "priority", "flag"]).drop("ami")
    return r(out, "ari", "mi", "purity_a_in_b", "purity_b_in_a", places=9)


@query("g2_adjusted_mutual_information")
def g2_ami(spark, sf):
    return g.partition_agreement(g.align_partitions(three(spark, sf)), ["segment", "priority", "flag"])


@query(
    "g3_partition_crosstab",
    with_sql("cells", extra=ALIGNED_SQL)
    + """SELECT segment, flag, COUNT(*) AS n, round(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY segment), 9) AS fraction_of_a, round(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY flag), 9) AS fraction_of_b FROM al GROUP BY 1, 2""",
)
def g3(spark, sf):
    return r(g.partition_crosstab(g.align_partitions(three(spark, sf)), "segment", "flag"), "fraction_of_a", "fraction_of_b", places=9)


@query(
    "g4_cluster_group_support",
    with_sql("cells")
    + """, k AS (SELECT label2, donor, COUNT(*) AS n FROM cells GROUP BY 1, 2)
    SELECT label2, CAST(SUM(n) AS BIGINT) AS n_cells, COUNT(*) AS n_groups, COUNT(*) FILTER (n >= 120) AS n_supporting, round(MAX(n) / SUM(n), 9) AS max_share, COALESCE(string_agg(donor, '; ' ORDER BY donor) FILTER (n >= 120), '') AS supporting FROM k GROUP BY 1""",
)
def g4(spark, sf):
    return r(g.cluster_group_support(b.cells(spark, sf), "label2", "donor", 120), "max_share", places=9)


@query(
    "g5_label_composition",
    with_sql("cells")
    + "SELECT label2, COUNT(*) AS n_cells, "
    + ", ".join(
        f"""COUNT(*) FILTER (condition = '{c}') AS "n_{c}", round(COUNT(*) FILTER (condition = '{c}') / COUNT(*), 9) AS "within_cluster_{c}", round(COUNT(*) FILTER (condition = '{c}') / (SELECT COUNT(*) FROM cells WHERE condition = '{c}'), 9) AS "of_{c}" """
        for c in "FOP"
    )
    + " FROM cells GROUP BY 1",
)
def g5(spark, sf):
    out = g.label_composition(b.cells(spark, sf), "label2", "condition")
    return r(out, *[f"{p}_{c}" for p in ("within_cluster", "of") for c in "FOP"], places=9)


def audited_cells(spark, sf):
    """Clusters are library × priority; confidence from the mitochondrial share."""
    m = metrics(spark, sf)
    return m.select(
        "cell", F.concat_ws("/", "library", "label2").alias("cluster"), "total_counts",
        (1 - F.col("pct_counts_mito") / 100).alias("confidence"), "cell_type", "donor", "library", "condition",
        F.col("price").alias("x"), F.col("n_genes_by_counts").cast("double").alias("y"),
    )


AUDIT_CELLS_SQL = """ac AS (SELECT cell, concat(library, '/', label2) AS cluster, total_counts, 1 - pct_mito / 100 AS confidence, cell_type, donor, library, condition, price AS x, n_genes_by_counts::DOUBLE AS y FROM metrics),
    atl AS (SELECT median(total_counts) AS m, median(x) AS mx, median(y) AS my, COUNT(DISTINCT cell_type) AS nl FROM ac),
    cl AS (SELECT cluster, COUNT(*) AS n_cells, median(total_counts) AS mc, median(confidence) AS mf, median(sqrt((x - mx) * (x - mx) + (y - my) * (y - my))) AS rad FROM ac, atl GROUP BY 1),
    li AS (SELECT cluster, COUNT(*) AS nlin, -SUM(n / t * ln(n / t)) AS h, arg_max(cell_type, n * 1000.0 + length(cell_type) * 0) AS x, MAX(n / t) AS lf FROM (SELECT *, SUM(n) OVER (PARTITION BY cluster) AS t FROM (SELECT cluster, cell_type, COUNT(*) AS n FROM ac GROUP BY 1, 2)) GROUP BY 1),
    lb AS (SELECT cluster, MAX(n) / SUM(n) AS df FROM (SELECT cluster, donor, COUNT(*) AS n FROM ac GROUP BY 1, 2) GROUP BY 1),
    fx AS (SELECT cl.*, nlin, lf, df, mc / atl.m AS ratio, GREATEST(0.0, h / ln(atl.nl)) AS ent, mc / atl.m < 0.95 AS sh, mf < 0.9 AS un, GREATEST(0.0, h / ln(atl.nl)) > 0.996 AS pr, df > 0.06 AS dm FROM cl JOIN li USING (cluster) JOIN lb USING (cluster), atl),
    fv AS (SELECT *, CASE WHEN n_cells < 20 THEN 'insufficient_cells' WHEN sh AND un AND pr THEN 'ambient_debris' WHEN dm AND (sh OR un OR pr) THEN 'library_artifact' WHEN un AND pr THEN 'ambiguous_annotation'
      WHEN sh THEN 'low_complexity' WHEN pr THEN 'promiscuous' WHEN un THEN 'low_confidence' WHEN dm THEN 'single_library' ELSE 'clean' END AS verdict FROM fx)"""


def cluster_audit(spark, sf, coords=("x", "y")):
    return g.cluster_artifact_audit(
        audited_cells(spark, sf), "cluster", "total_counts", "confidence", "cell_type", "donor", "condition", coords,
        collapse_ratio=0.95, confidence_floor=0.9, promiscuity=0.996, dominance=0.06,
    )


@query(
    "g6_cluster_artifact_audit",
    with_sql("counts", "cells", "genes", "metrics", extra=AUDIT_CELLS_SQL)
    + """SELECT cluster, n_cells, round(mc, 6) AS median_complexity, round(mf, 6) AS median_confidence, round(ratio, 6) AS complexity_ratio, round(ent, 6) AS lineage_entropy, nlin AS n_lineages, round(lf, 6) AS modal_lineage_frac,
    round(df, 6) AS dominant_library_frac, sh::INT + un::INT + pr::INT + dm::INT AS n_marks, verdict, round(rad, 4) AS embedding_radius,
    round((rank() OVER (ORDER BY rad) + (COUNT(*) OVER (PARTITION BY rad) - 1) / 2.0) / COUNT(*) OVER (), 6) AS embedding_radius_rank_pct FROM fv""",
)
def g6(spark, sf):
    out = cluster_audit(spark, sf).select(
        "cluster", "n_cells", "median_complexity", "median_confidence", "complexity_ratio", "lineage_entropy", "n_lineages",
        "modal_lineage_frac", "dominant_library_frac", "n_marks", "verdict", "embedding_radius", "embedding_radius_rank_pct",
    )
    out = r(out, "embedding_radius", places=4)
    return r(out, "median_complexity", "median_confidence", "complexity_ratio", "lineage_entropy", "modal_lineage_frac", "dominant_library_frac", "embedding_radius_rank_pct")


@query(
    "g7_verify_debris",
    with_sql("counts", "cells", "genes", "metrics", extra=AUDIT_CELLS_SQL)
    + """, d AS (SELECT DISTINCT cluster FROM ac WHERE cluster LIKE '%/5-LOW')
    SELECT cluster, n_cells, verdict, verdict IN ('ambient_debris', 'library_artifact') AS audited, cluster LIKE '%/5-LOW' AS declared, (cluster LIKE '%/5-LOW') = (verdict IN ('ambient_debris', 'library_artifact')) AS agrees
    FROM fv WHERE cluster LIKE '%/5-LOW' OR verdict IN ('ambient_debris', 'library_artifact')""",
)
def g7(spark, sf):
    declared = b.cells(spark, sf).select(F.concat_ws("/", "library", "label2").alias("cluster")).distinct().filter(F.col("cluster").endswith("/5-LOW"))
    return g.verify_debris(cluster_audit(spark, sf, ()), declared, "cluster")


@query(
    "g8_triage_populations",
    with_sql("cells")
    + """, k AS (SELECT concat(library, label2) AS label, donor, condition FROM cells), d AS (SELECT label, donor, COUNT(*) AS n FROM k GROUP BY 1, 2),
    e AS (SELECT label, SUM(n) AS nc, COUNT(*) AS nd, MAX(n) / SUM(n) AS f FROM d GROUP BY 1), rf AS (SELECT condition AS ref FROM k GROUP BY 1 ORDER BY COUNT(*) DESC, condition DESC LIMIT 1), c AS (SELECT label, AVG((condition = ref)::INT) - (SELECT AVG((condition = ref)::INT) FROM k, rf) AS ce FROM k, rf GROUP BY 1)
    SELECT label, CAST(nc AS BIGINT) AS n_cells, nd AS n_donors, round(f, 9) AS dominant_donor_frac, round(ce, 9) AS condition_enrichment, CASE WHEN nc < 420 OR nd < 3 THEN 'noise' WHEN f >= 0.055 THEN 'single_donor_artifact' ELSE 'candidate' END AS category FROM e JOIN c USING (label)""",
)
def g8(spark, sf):
    cells = b.cells(spark, sf).withColumn("label", F.concat("library", "label2"))
    out = g.triage_populations(cells, "label", "donor", "condition", min_cells=420, donor_veto=0.055)
    return r(out, "dominant_donor_frac", "condition_enrichment", places=9)


@query(
    "g9_cell_cycle_phase",
    """WITH s AS (SELECT l_orderkey, AVG(l_discount) - 0.05 AS s, AVG(l_tax) - 0.04 AS m FROM lineitem GROUP BY 1)
    SELECT CASE WHEN round(s, 9) <= 0 AND round(m, 9) <= 0 THEN 'G1' WHEN round(s, 9) > round(m, 9) THEN 'S' ELSE 'G2M' END AS phase, COUNT(*) AS n FROM s GROUP BY 1""",
)
def g9(spark, sf):
    s = b.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.avg("l_discount") - 0.05, 9).alias("s"), F.round(F.avg("l_tax") - 0.04, 9).alias("m")
    )
    return s.groupBy(g.cell_cycle_phase(F.col("s"), F.col("m")).alias("phase")).agg(F.count(F.lit(1)).alias("n"))


# --- annotation --------------------------------------------------------------------------


def lognorm(spark, sf):
    return normalize.log1p_cp10k(b.dense_counts(spark, sf))


LOG_SQL = """dt AS (SELECT cell, SUM(value) AS t FROM dense GROUP BY 1), ll AS (SELECT cell, gene, ln(1 + value * 10000.0 / t) AS value FROM dense JOIN dt USING (cell))"""


def panels(spark, sf):
    """Brands grouped by last digit: the programs of the dense profile."""
    return b.table(spark, sf, "part").select(
        F.concat(F.lit("set"), F.substring("p_brand", -1, 1)).alias("source"), F.col("p_brand").alias("target")
    ).distinct()


PANEL_SQL = """pan AS (SELECT DISTINCT concat('set', right(p_brand, 1)) AS source, p_brand AS target FROM part)"""
BINS_SQL = """gm AS (SELECT gene, SUM(value) / (SELECT COUNT(*) FROM dcells) AS mean FROM ll GROUP BY 1),
    bn AS (SELECT gene, CAST(floor((rank() OVER (ORDER BY mean)) / GREATEST(1, round((SELECT COUNT(*) FROM gm) / 4.0))) AS INT) AS bin FROM gm),
    ctl AS (SELECT DISTINCT p.source, b2.gene AS target FROM pan p JOIN bn b1 ON b1.gene = p.target JOIN bn b2 ON b2.bin = b1.bin WHERE NOT EXISTS (SELECT 1 FROM pan x WHERE x.source = p.source AND x.target = b2.gene)),
    wts AS (SELECT source, target AS gene, 1.0 / COUNT(*) OVER (PARTITION BY source) AS w FROM pan UNION ALL SELECT source, target, -1.0 / COUNT(*) OVER (PARTITION BY source) FROM ctl)"""


@query(
    "h1_marker_scores",
    with_sql("dense", "dcells", extra=",\n".join([LOG_SQL, PANEL_SQL, BINS_SQL]))
    + """, cm AS (SELECT cell_type, gene, SUM(value) / ANY_VALUE(n) AS m FROM ll JOIN dcells USING (cell) JOIN (SELECT cell_type, COUNT(*) AS n FROM dcells GROUP BY 1) USING (cell_type) GROUP BY 1, 2)
    SELECT source, cell_type, round(SUM(w * m), 6) AS score FROM wts JOIN cm USING (gene) GROUP BY 1, 2""",
)
def h1(spark, sf):
    out = h.marker_scores(lognorm(spark, sf), b.dense_cells(spark, sf), "cell_type", panels(spark, sf), n_bins=5)
    return r(out, "score")


@query(
    "h1_panel_support",
    with_sql("counts", "cells")
    + """, g AS (SELECT DISTINCT gene FROM counts JOIN cells USING (cell) WHERE condition = 'P'), p AS (SELECT concat(p_brand, '/', p_size) AS source, CAST(p_partkey AS VARCHAR) AS target FROM part)
    SELECT source, COUNT(*) AS n_targets, COUNT(gene) AS n_present, COUNT(gene) > 0 AS usable FROM p LEFT JOIN g ON gene = target GROUP BY 1""",
)
def h1_support(spark, sf):
    """Panels of one brand and size against the parts that pending orders hold."""
    part = b.table(spark, sf, "part")
    panels = part.select(F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("source"), F.col("p_partkey").cast("string").alias("target"))
    pending = b.cells(spark, sf).filter("condition = 'P'").select("cell")
    return h.panel_support(panels, b.counts(spark, sf).join(pending, "cell", "left_semi").select("gene"))


@query("h1_marker_vote")
def h1_vote(spark, sf):
    return h.marker_vote(lognorm(spark, sf), b.dense_cells(spark, sf), "cell_type", panels(spark, sf), n_bins=5)


@query(
    "h2_passthrough_label",
    with_sql("cells") + "SELECT CASE label2 WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE label2 END AS label, COUNT(*) AS n FROM cells GROUP BY 1",
)
def h2(spark, sf):
    out = h.passthrough_label(b.cells(spark, sf), "label2", "label", {"1-URGENT": "urgent", "5-LOW": "low"})
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def votes(spark, sf):
    """Four votes per line, one of them often missing."""
    li = b.table(spark, sf, "lineitem")
    return li.select(
        F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("long"), F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cell"),
        F.col("l_returnflag").alias("v1"),
        F.when(F.col("l_tax") > 0.02, F.col("l_linestatus")).otherwise("nan").alias("v2"),
        F.when(F.col("l_discount") > 0.04, "A").otherwise("N").alias("v3"),
        F.when(F.col("l_quantity") > 30, "R").when(F.col("l_quantity") > 5, "none").alias("v4"),
    )


@query(
    "h4_consensus_labels",
    """WITH l AS (SELECT concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT)) AS cell, l_returnflag AS v1, CASE WHEN l_tax > 0.02 THEN CASE l_linestatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' END END AS v2,
      CASE WHEN l_discount > 0.04 THEN 'A' ELSE 'N' END AS v3, CASE WHEN l_quantity > 30 THEN 'R' WHEN l_quantity > 5 THEN 'none' END AS v4 FROM lineitem),
    u AS (SELECT cell, 1 AS pos, v1 AS v FROM l UNION ALL SELECT cell, 2, v2 FROM l UNION ALL SELECT cell, 3, v3 FROM l UNION ALL SELECT cell, 4, v4 FROM l),
    k AS (SELECT cell, v, COUNT(*) AS n, MIN(pos) AS first FROM u WHERE v IS NOT NULL GROUP BY 1, 2),
    w AS (SELECT cell, SUM(n) AS votes, MAX(n) AS top, arg_max(v, n * 10 - first) AS label FROM k GROUP BY 1),
    f AS (SELECT cell, label, CASE WHEN votes >= 2 AND top = votes THEN 'high' WHEN votes >= 2 AND top / votes >= 0.5 AND (SELECT COUNT(*) FROM k WHERE k.cell = w.cell AND k.n = w.top) = 1 THEN 'medium' ELSE 'low' END AS tier FROM w)
    SELECT cell, label AS cell_type, tier AS annotation_confidence, tier = 'low' AS needs_review FROM f""",
)
def h4(spark, sf):
    out = h.consensus_labels(votes(spark, sf), ["v1", "v2", "v3", "v4"], {"F": "A", "O": "N"})
    return out.select("cell", "cell_type", "annotation_confidence", "needs_review")


def reviewed(spark, sf):
    """Clusters are segment × priority × year; a state and a doublet call come from the price."""
    c = b.cells(spark, sf)
    return c.withColumns(
        {
            "cluster": F.concat_ws("/", "cell_type", "label2", "library"),
            "state": F.when(F.col("price") < 50000, "quarantine").when(F.col("price") < 120000, "unresolved_borderline").otherwise("core"),
            "doublet": F.col("price") > 400000,
            "marker": F.col("price") / 500000,
        }
    )


REVIEWED_SQL = """rv AS (SELECT *, concat(cell_type, '/', label2, '/', library) AS cluster, CASE WHEN price < 50000 THEN 'quarantine' WHEN price < 120000 THEN 'unresolved_borderline' ELSE 'core' END AS state, price > 400000 AS doublet, price / 500000 AS marker FROM cells),
    ev AS (SELECT cluster, COUNT(*) AS n_cells, AVG(marker) AS marker_support, AVG((state <> 'core')::INT) AS technical_score FROM rv GROUP BY 1),
    dn AS (SELECT cluster, COUNT(*) AS n_donors, MAX(n) / SUM(n) AS df FROM (SELECT cluster, donor, COUNT(*) AS n FROM rv GROUP BY 1, 2) GROUP BY 1),
    sn AS (SELECT cluster, COUNT(*) AS n_samples FROM (SELECT DISTINCT cluster, sample FROM rv) GROUP BY 1),
    cn AS (SELECT cluster, COUNT(*) AS n_conditions, MAX(n) / SUM(n) AS cf FROM (SELECT cluster, condition, COUNT(*) AS n FROM rv GROUP BY 1, 2) GROUP BY 1)"""


def evidence_table(spark, sf):
    return h.cluster_evidence(reviewed(spark, sf), "cluster", "donor", "condition", "marker", "state")


@query(
    "h5_cluster_evidence",
    with_sql("cells", extra=REVIEWED_SQL)
    + """SELECT cluster, n_cells, round(marker_support, 6) AS marker_support, round(technical_score, 6) AS technical_score, n_donors, round(df, 6) AS dominant_donor_fraction, n_conditions, round(cf, 6) AS dominant_condition_fraction FROM ev JOIN dn USING (cluster) JOIN cn USING (cluster)""",
)
def h5(spark, sf):
    out = evidence_table(spark, sf).drop("donor_counts", "condition_counts")
    return r(out, "marker_support", "technical_score", "dominant_donor_fraction", "dominant_condition_fraction")


@query(
    "h6_adjudicate_clusters",
    with_sql("cells", extra=REVIEWED_SQL)
    + """SELECT cluster, CASE WHEN n_cells < 75 THEN 'unsupported_split' WHEN technical_score >= 0.3 THEN 'technical_population' WHEN df >= 0.11 THEN 'donor_restricted_population' WHEN cf >= 0.43 THEN 'condition_restricted_state' WHEN marker_support >= 0.5 THEN 'rare_replicated_population' ELSE 'ambiguous_population' END AS taxonomy_class,
    round(CASE WHEN n_cells < 75 THEN 0.2 WHEN technical_score >= 0.3 THEN technical_score WHEN df >= 0.11 THEN df WHEN cf >= 0.43 THEN cf WHEN marker_support >= 0.5 THEN GREATEST(0.4, LEAST(1.0, marker_support)) ELSE 0.3 END, 6) AS confidence,
    (n_cells < 75)::INT + (df >= 0.11)::INT + (technical_score >= 0.3)::INT AS n_vetoes FROM ev JOIN dn USING (cluster) JOIN cn USING (cluster)""",
)
def h6(spark, sf):
    out = h.adjudicate_clusters(
        evidence_table(spark, sf), min_cells=75, technical_veto_score=0.3, donor_dominance_veto=0.11, condition_restriction_fraction=0.43,
    )
    return r(out.select("cluster", "taxonomy_class", "confidence", "n_vetoes"), "confidence")


@query(
    "h7_population_summary",
    with_sql("cells", extra=REVIEWED_SQL)
    + """, x AS (SELECT cluster, AVG(doublet::INT) AS dd FROM rv GROUP BY 1)
    SELECT cluster, n_cells, round(technical_score, 6) AS qc_fail_fraction, round(dd, 6) AS doublet_fraction, round(marker_support, 6) AS mean_confidence, n_samples, n_donors, round(df, 6) AS dominant_donor_fraction, round(n_cells / (SELECT COUNT(*) FROM cells), 9) AS fraction_cells,
    CASE WHEN technical_score > 0.3 OR dd > 0.3 THEN 'technical_or_qc_suspect' WHEN n_cells < 75 OR n_samples < 2 THEN 'underpowered_rare_population' WHEN n_donors < 2 OR df > 0.1 THEN 'donor_restricted_candidate' WHEN marker_support < 0.5 THEN 'low_confidence_candidate' ELSE 'annotation_supported_state' END AS evidence_status
    FROM ev JOIN dn USING (cluster) JOIN sn USING (cluster) JOIN x USING (cluster)""",
)
def h7(spark, sf):
    out = h.population_summary(
        reviewed(spark, sf), "cluster", "sample", "donor", "condition", "state", "doublet", confidence="marker", min_cells=75, max_donor=0.1, max_doublet=0.3,
    )
    out = out.select("cluster", "n_cells", "qc_fail_fraction", "doublet_fraction", "mean_confidence", "n_samples", "n_donors", "dominant_donor_fraction", "fraction_cells", "evidence_status")
    return r(r(out, "qc_fail_fraction", "doublet_fraction", "mean_confidence", "dominant_donor_fraction"), "fraction_cells", places=9)


@query(
    "h8_crosstab_long",
    with_sql("cells")
    + """, n AS (SELECT library, label2, COUNT(*) AS n FROM cells WHERE condition <> 'O' OR label2 <> '5-LOW' GROUP BY 1, 2), g AS (SELECT * FROM (SELECT DISTINCT library FROM n), (SELECT DISTINCT label2 FROM n))
    SELECT library, label2, COALESCE(n, 0) AS n, round(COALESCE(n, 0) / SUM(COALESCE(n, 0)) OVER (PARTITION BY library), 9) AS fraction FROM g LEFT JOIN n USING (library, label2)""",
)
def h8(spark, sf):
    cells = b.cells(spark, sf).filter((F.col("condition") != "O") | (F.col("label2") != "5-LOW"))
    return r(h.crosstab_long(cells, "library", "label2"), "fraction", places=9)


def probabilities(spark, sf):
    """Brand shares of each customer stand for label probabilities."""
    return normalize.proportional_fit(b.dense_counts(spark, sf)).select("cell", F.col("gene").alias("label"), F.col("value").alias("prob"))


PROB_SQL = "dt AS (SELECT cell, SUM(value) AS t FROM dense GROUP BY 1), pb AS (SELECT cell, gene AS label, value / t AS prob FROM dense JOIN dt USING (cell))"


@query(
    "h11_top_two",
    with_sql("dense", extra=PROB_SQL)
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY prob DESC, label DESC) AS rn FROM pb)
    SELECT a.cell, a.label AS top_label, round(a.prob, 9) AS top_prob, COALESCE(c.label, a.label) AS second_label, round(COALESCE(c.prob, a.prob), 9) AS second_prob, a.prob < 0.1 AS ambiguous FROM k a LEFT JOIN k c ON a.cell = c.cell AND c.rn = 2 WHERE a.rn = 1""",
)
def h11(spark, sf):
    return r(h.ambiguous(h.top_two(probabilities(spark, sf)), 0.1), "top_prob", "second_prob", places=9)


@query(
    "h11_reassembly",
    with_sql("dense", extra=PROB_SQL)
    + """, s AS (SELECT cell, right(label, 1) AS coarse, SUM(prob) AS p FROM pb GROUP BY 1, 2), k AS (SELECT cell, right(label, 1) AS assigned, row_number() OVER (PARTITION BY cell ORDER BY prob DESC, label DESC) AS rn FROM pb)
    SELECT s.cell, coarse AS candidate_group, round(p, 9) AS candidate_prob, assigned AS assigned_group FROM s JOIN k ON s.cell = k.cell AND rn = 1 WHERE p > 0.2 AND assigned <> coarse""",
)
def h11_reassembly(spark, sf):
    probs = probabilities(spark, sf)
    coarse = probs.select("label").distinct().withColumn("coarse", F.substring("label", -1, 1))
    assigned = h.top_two(probs).select("cell", F.substring("top_label", -1, 1).alias("assigned"))
    return r(h.reassembly_candidates(probs, coarse, assigned, 0.2), "candidate_prob", places=9)


@query(
    "h12_blob_summary",
    with_sql("cells") + "SELECT cell_type, round(COUNT(*) / SUM(COUNT(*)) OVER (), 9) AS fraction FROM cells WHERE price > 300000 GROUP BY 1",
)
def h12(spark, sf):
    cells = b.cells(spark, sf).withColumn("mask", F.col("price") > 300000)
    return r(h.blob_composition(cells, "mask", "cell_type"), "fraction", places=9)


@query(
    "h12_blob_metrics",
    with_sql("counts", "cells", "genes", "metrics")
    + """SELECT 'total_counts' AS metric, round(AVG(total_counts) FILTER (price > 300000), 6) AS blob_mean, round(AVG(total_counts) FILTER (price <= 300000), 6) AS rest_mean FROM metrics
    UNION ALL SELECT 'pct_counts_mito', round(AVG(pct_mito) FILTER (price > 300000), 6), round(AVG(pct_mito) FILTER (price <= 300000), 6) FROM metrics""",
)
def h12_metrics(spark, sf):
    cells = metrics(spark, sf).withColumn("mask", F.col("price") > 300000)
    return r(h.blob_metrics(cells, "mask", ["total_counts", "pct_counts_mito"]), "blob_mean", "rest_mean")


@query(
    "h13_label_entropy",
    with_sql("dense", extra=PROB_SQL) + "SELECT cell, round(-SUM(prob * ln(prob)) / ln(25.0), 6) AS label_entropy FROM pb GROUP BY 1",
)
def h13(spark, sf):
    return r(h.label_entropy(probabilities(spark, sf), 25), "label_entropy")


PROFILE_SQL = """cs AS (SELECT cell_type, COUNT(*) AS n FROM dcells GROUP BY 1), st AS (SELECT cell_type, gene, SUM(value) AS s, COUNT(*) FILTER (value > 0) AS k FROM ll JOIN dcells USING (cell) GROUP BY 1, 2)"""


@query(
    "h14_marker_panel_stats",
    with_sql("dense", "dcells", extra=LOG_SQL + ",\n" + PROFILE_SQL)
    + "SELECT cell_type, gene, round(s / n, 6) AS mean, round(100.0 * k / n, 6) AS pct_detected FROM st JOIN cs USING (cell_type)",
)
def h14(spark, sf):
    panel = b.table(spark, sf, "part").select(F.col("p_brand").alias("gene")).distinct()
    return r(h.marker_panel_stats(lognorm(spark, sf), panel, b.dense_cells(spark, sf), "cell_type"), "mean", "pct_detected")


SPARSE_PROFILE_SQL = """n AS (SELECT donor, COUNT(*) AS n FROM cells GROUP BY 1), pf AS (SELECT donor, gene, SUM(value) / ANY_VALUE(n) AS mean FROM counts JOIN cells USING (cell) JOIN n USING (donor) GROUP BY 1, 2),
    pk AS (SELECT gene, arg_max(donor, mean) AS peak_group, MAX(mean) AS peak FROM pf GROUP BY 1)"""


@query(
    "h15_ambient_gene_mask",
    with_sql("counts", "cells", extra=SPARSE_PROFILE_SQL)
    + """SELECT pk.gene, NOT (peak_group <> '3' AND COALESCE(mean, 0) / peak < 0.25) AS keep FROM pk LEFT JOIN pf ON pf.gene = pk.gene AND pf.donor = '3'""",
)
def h15(spark, sf):
    profile = h.cluster_gene_means(b.counts(spark, sf), b.cells(spark, sf), "donor")
    return h.ambient_gene_mask(profile, "donor", "3").drop("peak_group")


@query(
    "h16_panel_scores_before_after",
    with_sql("counts", "cells", "genes", extra=SPARSE_PROFILE_SQL)
    + """, pg AS (SELECT gene FROM genes WHERE type = 'PROMO'), mk AS (SELECT x.donor, pg.gene, NOT (peak_group <> x.donor AND COALESCE(mean, 0) / peak < 0.25) OR x.donor = '3' AS keep FROM pg JOIN pk USING (gene) CROSS JOIN n x LEFT JOIN pf ON pf.gene = pg.gene AND pf.donor = x.donor),
    sz AS (SELECT donor, (SELECT COUNT(*) FROM pg) - COUNT(*) FILTER (NOT keep) AS left_n FROM mk GROUP BY 1), v AS (SELECT cell, SUM(value) AS bf, SUM(value) FILTER (keep) AS af FROM counts JOIN pg USING (gene) JOIN cells USING (cell) JOIN mk USING (donor, gene) GROUP BY 1)
    SELECT cells.cell, cells.donor, round(COALESCE(bf, 0) / (SELECT COUNT(*) FROM pg), 9) AS before, round(CASE WHEN left_n > 0 THEN COALESCE(af, 0) / left_n ELSE 0 END, 9) AS after FROM cells LEFT JOIN v USING (cell) JOIN sz USING (donor)""",
)
def h16(spark, sf):
    counts, cells = b.counts(spark, sf), b.cells(spark, sf)
    profile = h.cluster_gene_means(counts, cells, "donor")
    panel = b.genes(spark, sf).filter(F.col("type") == "PROMO").select("gene")
    return r(h.panel_scores_before_after(counts, cells, "donor", profile, panel, ["3"]), "before", "after", places=9)


PRED_SQL = """pr AS (SELECT donor, condition AS truth, CASE WHEN price < 100000 THEN 'Unassigned' WHEN price < 250000 THEN 'F' WHEN price < 400000 THEN 'O' ELSE 'P' END AS label FROM cells)"""


def predictions(spark, sf):
    p = F.col("price")
    label = F.when(p < 100000, "Unassigned").when(p < 250000, "F").when(p < 400000, "O").otherwise("P")
    return b.cells(spark, sf).select("donor", F.col("condition").alias("truth"), label.alias("label"))


@query(
    "h17_evaluate_labels",
    with_sql("cells", extra=PRED_SQL)
    + """, t AS (SELECT donor, truth AS class, COUNT(*) AS n_truth, COUNT(*) FILTER (label = truth) AS n_correct FROM pr GROUP BY 1, 2), p AS (SELECT donor, label AS class, COUNT(*) AS n_predicted FROM pr WHERE label <> 'Unassigned' GROUP BY 1, 2)
    SELECT donor, class, COALESCE(n_truth, 0) AS n_truth, COALESCE(n_correct, 0) AS n_correct, COALESCE(n_predicted, 0) AS n_predicted, round(n_correct / n_truth, 9) AS recall, round(COALESCE(n_correct, 0) / n_predicted, 9) AS precision FROM t FULL JOIN p USING (donor, class)""",
)
def h17(spark, sf):
    return r(h.evaluate_labels(predictions(spark, sf), "truth", "label", ["donor"]), "recall", "precision", places=9)


@query(
    "h17_confusion_table",
    with_sql("cells", extra=PRED_SQL) + "SELECT truth, label, COUNT(*) AS n, round(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY truth), 9) AS fraction_of_truth FROM pr GROUP BY 1, 2",
)
def h17_confusion(spark, sf):
    return r(h.confusion_table(predictions(spark, sf), "truth", "label"), "fraction_of_truth", places=9)


# --- programs ----------------------------------------------------------------------------


@query(
    "i1_score_genes",
    with_sql("dense", "dcells", extra=",\n".join([LOG_SQL, PANEL_SQL.replace("FROM part)", "FROM part WHERE right(p_brand, 1) IN ('1', '2', '3', '4', '5', '0'))"), BINS_SQL]))
    + """, sc AS (SELECT cell, source, SUM(w * value) AS s FROM ll JOIN wts USING (gene) GROUP BY 1, 2), gr AS (SELECT cell, source FROM dcells, (SELECT DISTINCT source FROM pan))
    SELECT cell, source, round(COALESCE(s, 0), 6) AS score FROM gr LEFT JOIN sc USING (cell, source)""",
)
def i1(spark, sf):
    sets = panels(spark, sf).filter(F.col("source").isin("set0", "set1", "set2", "set3", "set4", "set5"))
    return r(i.score_genes(lognorm(spark, sf), b.dense_cells(spark, sf), sets, n_bins=5, min_genes=2), "score")


@query(
    "i2_aucell",
    with_sql("counts", "cells", "net")
    + """, k AS (SELECT cell, gene, row_number() OVER (PARTITION BY cell ORDER BY value DESC, gene) AS r FROM counts), gn AS (SELECT COUNT(*) AS n FROM part), up AS (SELECT GREATEST(2, ceil(0.002 * n)) AS u FROM gn),
    sz AS (SELECT source, LEAST(COUNT(*), u - 1) AS k, u FROM net, up GROUP BY source, u), ht AS (SELECT cell, source, SUM(u - r) AS a FROM k JOIN net ON target = gene, up WHERE r < u GROUP BY 1, 2)
    SELECT c.cell, s.source, round(COALESCE(a, 0) / (k * u - k * (k + 1) / 2), 6) AS score FROM cells c CROSS JOIN sz s LEFT JOIN ht USING (cell, source)""",
)
def i2(spark, sf):
    n = b.table(spark, sf, "part").count()
    return r(i.aucell(b.counts(spark, sf), b.cells(spark, sf), b.net(spark, sf), n, 0.002), "score")


@query(
    "i3_ucell",
    with_sql("dense", "dcells", extra=PANEL_SQL)
    + """, k AS (SELECT cell, gene, rank() OVER (PARTITION BY cell ORDER BY value DESC) + (COUNT(*) OVER (PARTITION BY cell, value) - 1) / 2.0 AS r FROM dense WHERE value > 0), nz AS (SELECT cell, COUNT(*) AS z FROM k GROUP BY 1),
    g AS (SELECT d.cell, p.source, p.target, LEAST(COALESCE(k.r, COALESCE(z, 0) + (25 - COALESCE(z, 0) + 1) / 2.0), 21.0) AS r FROM dcells d CROSS JOIN pan p LEFT JOIN k ON k.cell = d.cell AND k.gene = p.target LEFT JOIN nz ON nz.cell = d.cell)
    SELECT cell, source, round(1 - (SUM(r) - COUNT(*) * (COUNT(*) + 1) / 2) / (COUNT(*) * 20 - COUNT(*) * (COUNT(*) + 1) / 2), 6) AS score FROM g GROUP BY 1, 2""",
)
def i3(spark, sf):
    return r(i.ucell(b.dense_counts(spark, sf), b.dense_cells(spark, sf), panels(spark, sf), 25, 20), "score")


ULM_SQL = """gg AS (SELECT d.cell, x.gene, COALESCE(value, 0) AS v FROM dcells d CROSS JOIN (SELECT DISTINCT p_brand AS gene FROM part) x LEFT JOIN ll ON ll.cell = d.cell AND ll.gene = x.gene),
    co AS (SELECT gg.cell, s.source, corr(v, (p.target IS NOT NULL)::INT) AS c FROM gg CROSS JOIN (SELECT DISTINCT source FROM pan) s LEFT JOIN pan p ON p.source = s.source AND p.target = gg.gene GROUP BY 1, 2)"""


@query(
    "i4_activity_ulm",
    with_sql("dense", "dcells", extra=",\n".join([LOG_SQL, PANEL_SQL, ULM_SQL]))
    + "SELECT cell, source, round(c * sqrt(23 / (1 - c * c)), 5) AS score FROM co",
)
def i4(spark, sf):
    return r(i.activity_ulm(lognorm(spark, sf), b.dense_cells(spark, sf), panels(spark, sf), 25), "score", places=5)


@query(
    "i4_activity_by_type",
    with_sql("dense", "dcells", extra=",\n".join([LOG_SQL, PANEL_SQL, ULM_SQL]))
    + "SELECT cell_type, source, round(AVG(c * sqrt(23 / (1 - c * c))), 6) AS mean_score, COUNT(*) AS n_cells FROM co JOIN dcells USING (cell) GROUP BY 1, 2",
)
def i4_types(spark, sf):
    cells = b.dense_cells(spark, sf)
    out = i.mean_by_group(i.activity_ulm(lognorm(spark, sf), cells, panels(spark, sf), 25), cells, ["cell_type"])
    return r(out, "mean_score")


@query(
    "i5_program_means",
    with_sql("dense", "dcells", extra=",\n".join([LOG_SQL, PANEL_SQL, BINS_SQL]))
    + """, s0 AS (SELECT cell, source, SUM(w * value) AS s FROM ll JOIN wts USING (gene) GROUP BY 1, 2),
    sc AS (SELECT d.cell, x.source, COALESCE(s, 0) AS s FROM dcells d CROSS JOIN (SELECT DISTINCT source FROM pan) x LEFT JOIN s0 ON s0.cell = d.cell AND s0.source = x.source)
    SELECT cell_type, source, round(AVG(s), 6) AS mean_score, COUNT(*) AS n_cells FROM sc JOIN dcells USING (cell) GROUP BY 1, 2""",
)
def i5(spark, sf):
    cells = b.dense_cells(spark, sf)
    scores = i.score_genes(lognorm(spark, sf), cells, panels(spark, sf), n_bins=5, min_genes=2)
    return r(i.mean_by_group(scores, cells, ["cell_type"]), "mean_score")


@query(
    "i7_signature_labels",
    with_sql("counts", "cells", "genes", "metrics")
    + """, m AS (SELECT label2, AVG(price) AS a, AVG(total_counts) AS c, AVG(pct_mito) AS d FROM metrics GROUP BY 1), z AS (SELECT label2, u.s, u.z FROM (SELECT label2, (a - AVG(a) OVER ()) / stddev_pop(a) OVER () AS za, (c - AVG(c) OVER ()) / stddev_pop(c) OVER () AS zc, (d - AVG(d) OVER ()) / stddev_pop(d) OVER () AS zd FROM m), LATERAL (VALUES ('price', za), ('total_counts', zc), ('pct_counts_mito', zd)) u(s, z)),
    k AS (SELECT *, row_number() OVER (PARTITION BY label2 ORDER BY z DESC) AS rn FROM z)
    SELECT a.label2, a.s AS top_signature, round(a.z, 5) AS top_z, round(a.z - c.z, 5) AS margin, CASE WHEN a.z - c.z >= 0.5 THEN a.s ELSE 'unassigned' END AS label FROM k a JOIN k c ON a.label2 = c.label2 AND a.rn = 1 AND c.rn = 2""",
)
def i7(spark, sf):
    out = i.signature_labels(metrics(spark, sf), "label2", ["price", "total_counts", "pct_counts_mito"], 0.5)
    return r(out, "top_z", "margin", places=5)


@query(
    "i8_contrast_index",
    with_sql("counts", "cells", "genes", "metrics")
    + """, s AS (SELECT cell, price + total_counts AS u, pct_mito + n_genes_by_counts AS d FROM metrics)
    SELECT cell, round((u - (SELECT AVG(u) FROM s)) / (SELECT stddev_pop(u) FROM s) - (d - (SELECT AVG(d) FROM s)) / (SELECT stddev_pop(d) FROM s), 6) AS contrast_index FROM s""",
)
def i8(spark, sf):
    out = i.contrast_index(metrics(spark, sf), ["price", "total_counts"], ["pct_counts_mito", "n_genes_by_counts"])
    return r(out.select("cell", "contrast_index"), "contrast_index")


PROGRAMS = ["price", "total_counts", "pct_counts_mito"]


@query(
    "i9_program_correlation",
    with_sql("counts", "cells", "genes", "metrics")
    + f""", u AS (SELECT sample, condition, AVG(price) AS a, AVG(total_counts) AS c, AVG(pct_mito) AS d FROM metrics GROUP BY 1, 2), k AS (SELECT condition, rank() OVER (ORDER BY a)::DOUBLE AS a, rank() OVER (ORDER BY c)::DOUBLE AS c, rank() OVER (ORDER BY d)::DOUBLE AS d FROM u),
    q AS (SELECT a, c, d, a - AVG(a) OVER (PARTITION BY condition) AS a2, c - AVG(c) OVER (PARTITION BY condition) AS c2, d - AVG(d) OVER (PARTITION BY condition) AS d2 FROM k),
    p AS (SELECT 'price' AS program_a, 'total_counts' AS program_b, COUNT(*) AS n, corr(a, c) AS r, corr(a2, c2) AS ra FROM q UNION ALL SELECT 'price', 'pct_counts_mito', COUNT(*), corr(a, d), corr(a2, d2) FROM q UNION ALL SELECT 'total_counts', 'pct_counts_mito', COUNT(*), corr(c, d), corr(c2, d2) FROM q)
    SELECT program_a, program_b, n AS n_units, round(r, 6) AS r, round(ra, 6) AS r_adjusted, round({t_two_sided_sql('r * sqrt((n - 2) / (1 - r * r))', '(n - 2)')}, 6) AS p, round({t_two_sided_sql('ra * sqrt((n - 4) / (1 - ra * ra))', '(n - 4)')}, 6) AS p_adjusted FROM p""",
)
def i9(spark, sf):
    out = i.program_correlation(metrics(spark, sf), PROGRAMS, ["sample"], "spearman", ["condition"])
    return r(out.select("program_a", "program_b", "n_units", "r", "r_adjusted", "p", "p_adjusted"), "r", "r_adjusted", "p", "p_adjusted")


def loadings(spark, sf, flag):
    li = b.table(spark, sf, "lineitem").filter(F.col("l_returnflag") == flag)
    p = b.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return li.join(p, "l_partkey").groupBy(F.col("p_type").alias("source"), F.col("p_brand").alias("gene")).agg(
        F.round(F.avg("l_discount") - 0.05, 9).alias("loading")
    ).filter(F.abs("loading") > 0.002)


@query(
    "i10_match_loadings",
    """WITH l AS (SELECT l_returnflag AS f, p_type AS s, p_brand AS g, round(AVG(l_discount) - 0.05, 9) AS x FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3 HAVING abs(round(AVG(l_discount) - 0.05, 9)) > 0.002),
    a AS (SELECT * FROM l WHERE f = 'A'), c AS (SELECT * FROM l WHERE f = 'R'),
    k AS (SELECT pa.s AS pa, pc.s AS pc, u.g FROM (SELECT DISTINCT s FROM a) pa, (SELECT DISTINCT s FROM c) pc, (SELECT DISTINCT g FROM l) u),
    v AS (SELECT pa, pc, a.x AS x, c.x AS y FROM k LEFT JOIN a ON a.s = pa AND a.g = k.g LEFT JOIN c ON c.s = pc AND c.g = k.g WHERE a.x IS NOT NULL OR c.x IS NOT NULL),
    q AS (SELECT pa, pc, abs(corr(COALESCE(x, 0), COALESCE(y, 0))) AS r FROM v GROUP BY 1, 2) SELECT pa AS program, round(MAX(r), 6) AS best_r FROM q GROUP BY 1""",
)
def i10(spark, sf):
    return r(i.match_loadings(loadings(spark, sf, "A"), loadings(spark, sf, "R"), ["gene"]), "best_r")


@query(
    "i10_program_support",
    with_sql("dense", "dcells", extra=",\n".join([LOG_SQL, PANEL_SQL, BINS_SQL]))
    + """, s0 AS (SELECT cell, source, SUM(w * value) AS s FROM ll JOIN wts USING (gene) GROUP BY 1, 2),
    sc AS (SELECT d.cell, x.source, COALESCE(s, 0) AS s FROM dcells d CROSS JOIN (SELECT DISTINCT source FROM pan) x LEFT JOIN s0 ON s0.cell = d.cell AND s0.source = x.source), m AS (SELECT source, AVG(s) AS m FROM sc GROUP BY 1)
    SELECT source, COUNT(DISTINCT donor) AS n_donors, round(COUNT(DISTINCT donor) / 25, 6) AS donor_fraction, COUNT(DISTINCT donor) >= 3 AS supported FROM sc JOIN m USING (source) JOIN dcells USING (cell) WHERE s > m GROUP BY 1""",
)
def i10_support(spark, sf):
    cells = b.dense_cells(spark, sf)
    scores = i.score_genes(lognorm(spark, sf), cells, panels(spark, sf), n_bins=5, min_genes=2)
    return r(i.program_support(scores, cells, "donor"), "donor_fraction")


def _best_sql(flag: str) -> str:
    return f"""(SELECT pa AS program, MAX(r) AS best_r FROM (SELECT pa, pc, abs(corr(COALESCE(x, 0), COALESCE(y, 0))) AS r FROM (
      SELECT pa.s AS pa, pc.s AS pc, a.x AS x, c.x AS y FROM (SELECT DISTINCT s FROM l WHERE f = 'A') pa CROSS JOIN (SELECT DISTINCT s FROM l WHERE f = '{flag}') pc CROSS JOIN (SELECT DISTINCT g FROM l) u
      LEFT JOIN l a ON a.f = 'A' AND a.s = pa.s AND a.g = u.g LEFT JOIN l c ON c.f = '{flag}' AND c.s = pc.s AND c.g = u.g WHERE a.x IS NOT NULL OR c.x IS NOT NULL) GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "i10_program_stability",
    "WITH l AS (SELECT l_returnflag AS f, p_type AS s, p_brand AS g, round(AVG(l_discount) - 0.05, 9) AS x FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3 HAVING abs(round(AVG(l_discount) - 0.05, 9)) > 0.002) SELECT program, round(SUM(best_r) / 2, 6) AS mean_stability, 2 AS n_resamples FROM (SELECT * FROM "
    + _best_sql("N") + " UNION ALL SELECT * FROM " + _best_sql("R") + ") GROUP BY 1",
)
def i10_stability(spark, sf):
    full = loadings(spark, sf, "A")
    out = i.program_stability([i.match_loadings(full, loadings(spark, sf, f), ["gene"]) for f in ("N", "R")])
    return r(out, "mean_stability")


def last_cells(spark, sf, cells):
    """Customers with their number of orders."""
    n = b.table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("cell")).agg(F.count(F.lit(1)).alias("k"))
    return cells.join(n, "cell")
