"""Neighbour, clustering and trajectory queries on the embedding table and the order profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import communities as c
from ..operators import integration as g
from ..operators import neighbors as k
from ..operators import trajectory as t
from ..session import materialise
from . import bindings as b
from .bindings import with_sql
from .labels_and_programs import LOG_SQL, last_cells, lognorm
from .quality import metrics, r
from .registry import query

K = 10
KNN_SQL = with_sql("embedding") + f""", ds AS (SELECT a.cell, c.cell AS neighbor, list_distance(a.vec::DOUBLE[], c.vec::DOUBLE[]) AS distance FROM emb a JOIN emb c ON a.cell <> c.cell),
    kn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(distance, 10), neighbor) AS rank FROM ds) WHERE rank <= {K})"""


def nearest(spark, sf, n=K):
    e = b.embedding(spark, sf)
    return k.knn(e, e, n)


@query("f1_knn", KNN_SQL + " SELECT cell, neighbor, round(distance, 5) AS distance, rank FROM kn")
def f1(spark, sf):
    return r(nearest(spark, sf), "distance", places=5)


GRAPH_SQL = KNN_SQL + """, sg AS (SELECT cell, MAX(distance) AS s FROM kn GROUP BY 1), w0 AS (SELECT kn.cell AS src, neighbor AS dst, exp(-(distance / s) * (distance / s)) AS w, distance FROM kn JOIN sg USING (cell)),
    w1 AS (SELECT * FROM w0 UNION ALL SELECT dst, src, w, distance FROM w0), ed AS (SELECT src, dst, 1 - product(1 - w) AS weight, MIN(distance) AS distance FROM w1 GROUP BY 1, 2)"""


@query("f1_knn_graph", GRAPH_SQL + " SELECT src, dst, round(weight, 6) AS weight, round(distance, 5) AS distance FROM ed")
def f1_graph(spark, sf):
    return r(r(k.knn_graph(nearest(spark, sf)), "weight"), "distance", places=5)


@query("f2_graph_cluster")
def f2(spark, sf):
    return k.graph_cluster(k.knn_graph(nearest(spark, sf)), 1.0)


@query("f2_cluster_certificate", "SELECT unnest(['no_move_gains', 'clusters_connected', 'modularity_not_below']) AS \"check\", true AS passed")
def f2_certificate(spark, sf):
    """What the clusters must hold whatever they are: checked against the graph and the embedding's labels."""
    graph = materialise(k.knn_graph(nearest(spark, sf)), "graph")
    labels = b.embedding(spark, sf).select("cell", F.col("label").alias("cluster"))
    return c.certificate(graph, materialise(k.graph_cluster(graph, 1.0), "clusters"), labels)


@query(
    "f2_modularity",
    GRAPH_SQL
    + """, p AS (SELECT x.label AS a, y.label AS b, weight AS w FROM ed JOIN emb x ON x.cell = src JOIN emb y ON y.cell = dst WHERE src <> dst), t AS (SELECT a, SUM(w) AS tot, SUM(CASE WHEN a = b THEN w ELSE 0 END) AS i FROM p GROUP BY 1)
    SELECT round(SUM(i) / SUM(tot) - 1.5 * SUM(tot * tot) / (SUM(tot) * SUM(tot)), 8) AS modularity, COUNT(*) AS n_clusters FROM t""",
)
def f2_modularity(spark, sf):
    labels = b.embedding(spark, sf).select("cell", F.col("label").alias("cluster"))
    return r(c.modularity(k.knn_graph(nearest(spark, sf)), labels, 1.5), "modularity", places=8)


@query(
    "f2_move_gains",
    GRAPH_SQL
    + """, e2 AS (SELECT src, dst, weight FROM ed WHERE src <> dst), k AS (SELECT src, SUM(weight) AS k FROM e2 GROUP BY 1), s AS (SELECT k.src, k.k, label FROM k JOIN emb ON emb.cell = k.src), m AS (SELECT SUM(k) AS m FROM k), t AS (SELECT label, SUM(k) AS tot FROM s GROUP BY 1),
    o AS (SELECT e2.src, x.label AS c, SUM(weight) AS w FROM e2 JOIN s x ON x.src = dst GROUP BY 1, 2 UNION ALL SELECT src, label, 0 FROM s), q AS (SELECT src, c, SUM(w) AS w FROM o GROUP BY 1, 2),
    g AS (SELECT q.src, c, c = s.label AS own, w / k - (tot - CASE WHEN c = s.label THEN k ELSE 0 END) / m AS g FROM q JOIN s ON s.src = q.src JOIN t ON t.label = c, m)
    SELECT src AS cell, round(GREATEST(MAX(g) - MAX(CASE WHEN own THEN g END), 0), 7) AS rise FROM g GROUP BY 1""",
)
def f2_gains(spark, sf):
    labels = b.embedding(spark, sf).select("cell", F.col("label").alias("cluster"))
    return r(c.move_gains(k.knn_graph(nearest(spark, sf)), labels), "rise", places=7)


VOTES_SQL = KNN_SQL + """, vt AS (SELECT kn.cell, l.label, COUNT(*) AS n FROM kn JOIN emb l ON l.cell = kn.neighbor GROUP BY 1, 2), vr AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, label) AS rn FROM vt)"""


@query("f3_transfer_labels", VOTES_SQL + f" SELECT cell, label, n / {K} AS share FROM vr WHERE rn = 1")
def f3(spark, sf):
    return k.transfer_labels(nearest(spark, sf), b.embedding(spark, sf))


JAC_SQL = with_sql("cells") + """, x AS (SELECT label2 AS a, concat(library, condition) AS c, COUNT(*) AS n FROM cells GROUP BY 1, 2), y AS (SELECT a, n / (SUM(n) OVER (PARTITION BY a) + SUM(n) OVER (PARTITION BY c) - n) AS j FROM x)"""


def two_partitions(spark, sf):
    cells = b.cells(spark, sf)
    return cells.select("cell", F.col("label2").alias("cluster")), cells.select("cell", F.concat("library", "condition").alias("cluster"))


@query("f4_max_jaccard", JAC_SQL + " SELECT a AS cluster, round(MAX(j), 9) AS jaccard FROM y GROUP BY 1")
def f4(spark, sf):
    return r(k.max_jaccard(*two_partitions(spark, sf)), "jaccard", places=9)


@query(
    "f4_stability_summary",
    JAC_SQL + ", z AS (SELECT a, MAX(j) AS m FROM y GROUP BY 1) SELECT 1 AS run, round(median(m), 9) AS median, round(quantile_cont(m, 0.25), 9) AS q25, round(quantile_cont(m, 0.75), 9) AS q75, COUNT(*) AS n FROM z",
)
def f4_summary(spark, sf):
    out = k.stability_summary(k.max_jaccard(*two_partitions(spark, sf)).withColumn("run", F.lit(1)), ["run"])
    return r(out, "median", "q25", "q75", places=9)


@query(
    "f4_bootstrap_allocation",
    with_sql("cells")
    + """, x AS (SELECT library, label2 AS a, cell_type AS c, COUNT(*) AS n FROM cells GROUP BY 1, 2, 3), y AS (SELECT library, a, n / (SUM(n) OVER (PARTITION BY library, a) + SUM(n) OVER (PARTITION BY library, c) - n) AS j FROM x),
    z AS (SELECT CAST(library AS DOUBLE) AS resolution, a, MAX(j) AS m FROM y GROUP BY 1, 2), s AS (SELECT resolution, median(m) AS md, quantile_cont(m, 0.75) - quantile_cont(m, 0.25) AS iqr FROM z GROUP BY 1),
    d AS (SELECT resolution, iqr, COALESCE(GREATEST(abs(md - lag(md) OVER w), abs(md - lead(md) OVER w)), 0) AS st FROM s WINDOW w AS (ORDER BY resolution)),
    p AS (SELECT resolution, (iqr - MIN(iqr) OVER ()) / (MAX(iqr) OVER () - MIN(iqr) OVER ()) + (st - MIN(st) OVER ()) / (MAX(st) OVER () - MIN(st) OVER ()) AS p FROM d)
    SELECT resolution, CAST(round_even(p / SUM(p) OVER () * 40, 0) AS BIGINT) AS extra FROM p""",
)
def f4_allocation(spark, sf):
    """Libraries stand for resolutions, segments for the clusters found at them."""
    cells = b.cells(spark, sf).select("library", F.col("label2").alias("a"), F.col("cell_type").alias("c"))
    n = cells.groupBy("library", "a", "c").agg(F.count(F.lit(1)).alias("n"))
    of = lambda x: n.groupBy("library", x).agg(F.sum("n").alias(f"_{x}"))
    j = n.join(of("a"), ["library", "a"]).join(of("c"), ["library", "c"])
    j = j.groupBy(F.col("library").cast("double").alias("resolution"), "a").agg(F.max(F.col("n") / (F.col("_a") + F.col("_c") - F.col("n"))).alias("jaccard"))
    return k.bootstrap_allocation(j, 40)


@query("f4_resolution_stability")
def f4_resolution(spark, sf):
    return k.resolution_stability(b.embedding(spark, sf), [0.5, 1.0, 1.5], n_boot=4)


@query(
    "f5_extract_focus",
    with_sql("cells") + "SELECT cell, donor, library FROM cells WHERE cell_type = 'BUILDING' AND (donor, library) IN (SELECT (donor, library) FROM cells WHERE cell_type = 'BUILDING' GROUP BY donor, library HAVING COUNT(*) >= 18)",
)
def f5(spark, sf):
    from ..operators.embed import drop_small_groups, extract_focus

    focus = extract_focus(b.cells(spark, sf), "cell_type", ["BUILDING"])
    return drop_small_groups(focus, ["donor", "library"], 18).select("cell", "donor", "library")


def embedded_cells(spark, sf):
    """Cells of the embedding; seven donors by number."""
    return b.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("cell"), F.col("label").cast("string").alias("cluster"), (F.col("vec_id") % 7).cast("string").alias("donor")
    )


@query(
    "f6_donor_gate",
    with_sql("embedding")
    + """, c AS (SELECT cell, label AS cluster, CAST(CAST(cell AS BIGINT) % 7 AS VARCHAR) AS donor, vec FROM emb), ds AS (SELECT a.cell, a.cluster, c2.cluster AS lab, row_number() OVER (PARTITION BY a.cell ORDER BY round(list_distance(a.vec::DOUBLE[], c2.vec::DOUBLE[]), 10), c2.cell) AS rn FROM c a JOIN c c2 ON a.donor <> c2.donor),
    v AS (SELECT cell, cluster, lab, COUNT(*) AS n FROM ds WHERE rn <= 10 GROUP BY 1, 2, 3), w AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, lab) AS rn FROM v), ag AS (SELECT cluster, AVG((lab = cluster)::INT) AS ag FROM w WHERE rn = 1 GROUP BY 1),
    n AS (SELECT cluster, donor, COUNT(*) AS n FROM c GROUP BY 1, 2), s AS (SELECT cluster, CAST(SUM(n) AS BIGINT) AS n_cells, COUNT(*) AS n_groups, COUNT(*) FILTER (n >= 8) AS n_supporting, MAX(n) / SUM(n) AS mf FROM n GROUP BY 1)
    SELECT cluster, n_cells, n_groups, n_supporting, round(mf, 6) AS max_group_frac, round(ag, 6) AS lodo_agreement, CASE WHEN n_supporting < 3 THEN 'fewer_than_3_supporting_groups' WHEN mf > 0.8 THEN 'dominated_by_one_group' WHEN ag < 0.5 THEN 'low_lodo_agreement' ELSE '' END AS reason,
    NOT (n_supporting < 3 OR mf > 0.8 OR ag < 0.5) AS passed FROM s JOIN ag USING (cluster)""",
)
def f6(spark, sf):
    cells = embedded_cells(spark, sf)
    lodo = k.leave_one_donor_out(b.embedding(spark, sf).select("cell", "vec"), cells, "cluster", "donor", 10)
    return r(k.donor_gate(cells, "cluster", "donor", lodo, min_cells=8), "max_group_frac", "lodo_agreement")


@query(
    "f7_qc_consistency",
    with_sql("counts", "cells", "genes", "metrics")
    + """, l AS (SELECT concat(label2, library) AS cluster, u.metric, u.s, u.x FROM metrics, LATERAL (VALUES ('total_counts', -1, total_counts), ('pct_counts_mito', 1, pct_mito), ('price', 0, price)) u(metric, s, x)),
    p AS (SELECT metric, median(x) AS pop FROM l GROUP BY 1), d AS (SELECT metric, GREATEST(1.4826 * median(abs(x - pop)), 1e-9) AS sg FROM l JOIN p USING (metric) GROUP BY 1),
    c AS (SELECT cluster, metric, ANY_VALUE(s) AS s, COUNT(*) AS n, median(x) AS v FROM l GROUP BY 1, 2), q AS (SELECT *, (v - pop) / (1.2533 * sg / sqrt(n)) AS z, (v - pop) / sg AS ef FROM c JOIN p USING (metric) JOIN d USING (metric)),
    rt AS (SELECT concat(label2, library) AS cluster, (price > 300000)::INT AS x FROM metrics), r0 AS (SELECT AVG(x) AS pop FROM rt), rc AS (SELECT cluster, AVG(x) AS v, COUNT(*) AS n FROM rt GROUP BY 1)
    SELECT cluster, metric, n AS n_cells, round(v, 5) AS cluster_value, round(pop, 5) AS population, round(z, 5) AS z, round(ef, 5) AS effect, CASE WHEN s = 0 THEN abs(z) > 1 AND abs(ef) >= 0.05 ELSE z * s > 1 AND ef * s >= 0.05 END AS flagged FROM q
    UNION ALL SELECT cluster, 'pricey', n, round(v, 5), round(pop, 5), round((v - pop) / sqrt(pop * (1 - pop) / n), 5), round(v - pop, 5), (v - pop) / sqrt(pop * (1 - pop) / n) > 1 AND v - pop >= 0.02 FROM rc, r0""",
)
def f7(spark, sf):
    m = metrics(spark, sf).withColumn("cluster", F.concat("label2", "library")).withColumn("pricey", F.col("price") > 300000)
    out = k.qc_consistency(m, "cluster", {"total_counts": "low_is_bad", "pct_counts_mito": "high_is_bad", "price": "both"}, ["pricey"], z_bar=1.0, min_mads=0.05)
    return r(out, "cluster_value", "population", "z", "effect", places=5)


@query(
    "f8_group_connectivity",
    GRAPH_SQL
    + """, ob AS (SELECT x.label AS ga, y.label AS gb, SUM(weight) AS o FROM ed JOIN emb x ON x.cell = src JOIN emb y ON y.cell = dst GROUP BY 1, 2), dg AS (SELECT ga, SUM(o) AS k FROM ob GROUP BY 1)
    SELECT ob.ga AS group_a, gb AS group_b, round(o, 5) AS observed, round(o * (SELECT SUM(o) FROM ob) / (p.k * q.k), 6) AS connectivity FROM ob JOIN dg p ON p.ga = ob.ga JOIN dg q ON q.ga = gb WHERE ob.ga < gb""",
)
def f8(spark, sf):
    out = k.group_connectivity(k.knn_graph(nearest(spark, sf)), b.embedding(spark, sf).select("cell", "label"))
    return r(r(out, "observed", places=5), "connectivity")


@query(
    "f9_cluster_markers",
    with_sql("brandc", "cells")
    + """, g AS (SELECT c.cell, c.label2 AS cl, x.gene, COALESCE(value, 0) AS v FROM cells c CROSS JOIN (SELECT DISTINCT p_brand AS gene FROM part) x LEFT JOIN brandc ON brandc.cell = c.cell AND brandc.gene = x.gene),
    k AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY v) + (COUNT(*) OVER (PARTITION BY gene, v) - 1) / 2.0 AS rk FROM g), tt AS (SELECT gene, SUM(m * m * m - m) AS t FROM (SELECT gene, v, COUNT(*)::DOUBLE AS m FROM g GROUP BY 1, 2) GROUP BY 1),
    s AS (SELECT gene, cl, SUM(rk) AS rs, COUNT(*)::DOUBLE AS n1, AVG(v) AS mean, AVG((v > 0)::INT) AS fr FROM k GROUP BY 1, 2), n AS (SELECT COUNT(*)::DOUBLE AS n FROM cells)
    SELECT gene, cl AS label2, round((rs - n1 * (n + 1) / 2) / sqrt(n1 * (n - n1) / 12 * ((n + 1) - t / (n * (n - 1)))), 5) AS score, round(mean, 6) AS mean, round(fr, 6) AS fraction FROM s JOIN tt USING (gene), n""",
)
def f9(spark, sf):
    out = k.cluster_markers(b.brand_counts(spark, sf), b.cells(spark, sf), "label2")
    return r(r(out, "score", places=5), "mean", "fraction")


def vector_layer(spark, sf):
    """Shifted positive parts of the first embedding dimensions as gene values."""
    return b.embedding(spark, sf).select("cell", F.posexplode(F.slice("vec", 1, 6)).alias("g", "x")).filter("x > 0").select(
        "cell", F.concat(F.lit("d"), F.col("g").cast("string")).alias("gene"), F.col("x").cast("double").alias("value")
    )


SMOOTH_SQL = GRAPH_SQL + """, vl AS (SELECT cell, concat('d', i) AS gene, vec[i + 1]::DOUBLE AS value FROM emb, range(0, 6) g(i) WHERE vec[i + 1] > 0), lp AS (SELECT src, dst, weight FROM ed UNION ALL SELECT DISTINCT src, src, 1.0 FROM ed),
    pw AS (SELECT src, dst, weight / SUM(weight) OVER (PARTITION BY src) AS p FROM lp), s1 AS (SELECT src AS cell, gene, SUM(p * value) AS value FROM pw JOIN vl ON vl.cell = dst GROUP BY 1, 2), s2 AS (SELECT src AS cell, gene, SUM(p * value) AS value FROM pw JOIN s1 ON s1.cell = dst GROUP BY 1, 2)"""


@query("f10_graph_smooth", SMOOTH_SQL + " SELECT cell, gene, round(value, 6) AS value FROM s2")
def f10(spark, sf):
    return r(k.graph_smooth(k.knn_graph(nearest(spark, sf)), vector_layer(spark, sf), 2), "value")


@query(
    "f11_metacell_summary",
    with_sql("cells")
    + """, a AS (SELECT CASE WHEN price > 5000 THEN concat(donor, library, label2) END AS mc, cell_type FROM cells), n AS (SELECT mc, cell_type, COUNT(*) AS n FROM a WHERE mc IS NOT NULL GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY mc ORDER BY n DESC, cell_type) AS rn, SUM(n) OVER (PARTITION BY mc) AS s FROM n)
    SELECT mc, cell_type AS dominant, round(n / s, 9) AS purity, CAST(s AS BIGINT) AS size FROM k WHERE rn = 1""",
)
def f11(spark, sf):
    return r(k.metacell_summary(metacells(spark, sf), "mc", "cell_type"), "purity", places=9)


def metacells(spark, sf):
    return b.cells(spark, sf).withColumn("mc", F.when(F.col("price") > 5000, F.concat("donor", "library", "label2")))


@query(
    "f11_metacell_overview",
    with_sql("cells")
    + """, a AS (SELECT CASE WHEN price > 5000 THEN concat(donor, library, label2) END AS mc, cell_type FROM cells), n AS (SELECT mc, cell_type, COUNT(*) AS n FROM a WHERE mc IS NOT NULL GROUP BY 1, 2), s AS (SELECT mc, SUM(n) AS s, MAX(n) / SUM(n) AS p FROM n GROUP BY 1)
    SELECT COUNT(*) AS n_metacells, median(s)::DOUBLE AS median_size, round(AVG(p), 9) AS mean_purity, round((SELECT AVG((mc IS NULL)::INT) FROM a), 9) AS outlier_share FROM s""",
)
def f11_overview(spark, sf):
    return r(k.metacell_overview(metacells(spark, sf), "mc", "cell_type"), "mean_purity", "outlier_share", places=9)


@query(
    "c22_project_query",
    VOTES_SQL
    + f""", tp AS (SELECT cell, MAX(label) FILTER (rn = 1) AS top_label, MAX(n) FILTER (rn = 1) / {K} AS p1, COALESCE(MAX(n) FILTER (rn = 2), 0) / {K} AS p2, -SUM(n / {K} * ln(n / {K})) AS h FROM vr GROUP BY 1), dm AS (SELECT cell, MIN(distance) AS mn, AVG(distance) AS av FROM kn GROUP BY 1)
    SELECT cell, top_label, p1 AS top_label_probability, p2 AS second_label_probability, round(p1 - p2, 6) AS margin, round(h, 6) AS neighbor_label_entropy, round(mn, 5) AS nearest_reference_distance, round(av, 5) AS mean_neighbor_distance, rank() OVER (ORDER BY round(av, 9)) / COUNT(*) OVER () AS ood_score FROM tp JOIN dm USING (cell)""",
)
def c22(spark, sf):
    e = b.embedding(spark, sf)
    out = k.project_query(e, e, e.select("cell", "label"), K, exclude="cell")
    out = r(r(out, "margin", "neighbor_label_entropy"), "nearest_reference_distance", "mean_neighbor_distance", places=5)
    return out.select("cell", "top_label", "top_label_probability", "second_label_probability", "margin", "neighbor_label_entropy", "nearest_reference_distance", "mean_neighbor_distance", "ood_score")


@query(
    "c23_neighborhood_entropy",
    KNN_SQL
    + f""", al AS (SELECT cell, neighbor FROM kn UNION ALL SELECT cell, cell FROM emb), v AS (SELECT al.cell, l.label, COUNT(*) / {K + 1} AS p FROM al JOIN emb l ON l.cell = al.neighbor GROUP BY 1, 2)
    SELECT cell, round(-SUM(p * ln(p)), 6) AS label_entropy, round(exp(-SUM(p * ln(p))), 6) AS effective_labels FROM v GROUP BY 1""",
)
def c23(spark, sf):
    return r(k.neighborhood_entropy(nearest(spark, sf), b.embedding(spark, sf)), "label_entropy", "effective_labels")


@query(
    "h9_refine_labels",
    GRAPH_SQL
    + """, gp AS (SELECT cell, CASE WHEN i < 2 THEN 'CD4' WHEN i < 4 THEN 'CD8' ELSE 'NK' END AS g, SUM(vec[i + 1]::DOUBLE) / 2 AS v FROM emb, range(0, 6) g(i) WHERE vec[i + 1] > 0 GROUP BY 1, 2), pw AS (SELECT src, dst, weight / SUM(weight) OVER (PARTITION BY src) AS p FROM ed),
    s1 AS (SELECT src AS cell, g, SUM(p * v) AS v FROM pw JOIN gp ON gp.cell = dst GROUP BY 1, 2), s2 AS (SELECT src AS cell, g, SUM(p * v) AS v FROM pw JOIN s1 ON s1.cell = dst GROUP BY 1, 2), e0 AS (SELECT cell, g, SUM(v) / 2 AS e FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2) GROUP BY 1, 2),
    w AS (SELECT emb.cell, COALESCE(MAX(e) FILTER (g = 'CD4'), 0) AS "CD4", COALESCE(MAX(e) FILTER (g = 'CD8'), 0) AS "CD8", COALESCE(MAX(e) FILTER (g = 'NK'), 0) AS "NK" FROM emb LEFT JOIN e0 USING (cell) GROUP BY 1),
    k AS (SELECT *, GREATEST("CD4", "CD8", "NK") AS t, "CD4" + "CD8" + "NK" - GREATEST("CD4", "CD8", "NK") - LEAST("CD4", "CD8", "NK") AS s FROM w)
    SELECT cell, round("CD4", 6) AS "CD4", round("CD8", 6) AS "CD8", round("NK", 6) AS "NK", CASE WHEN t < 0.03 OR t - s < 0.005 THEN 'Unassigned' WHEN "CD4" = t THEN 'CD4' WHEN "CD8" = t THEN 'CD8' ELSE 'NK' END AS call, CASE WHEN t < 0.03 THEN 'weak_evidence' WHEN t - s < 0.005 THEN 'close_call' ELSE '' END AS reason FROM k""",
)
def h9(spark, sf):
    e = b.embedding(spark, sf)
    groups = spark.createDataFrame([("CD4", "d0"), ("CD4", "d1"), ("CD8", "d2"), ("CD8", "d3"), ("NK", "d4"), ("NK", "d5")], "source string, target string")
    out = k.refine_labels(k.knn_graph(nearest(spark, sf)), vector_layer(spark, sf), groups, e, {"CD4": 0.03, "CD8": 0.03, "NK": 0.03}, 0.005)
    return r(out, "CD4", "CD8", "NK")


@query(
    "h10_map_reference",
    VOTES_SQL.replace("rank <= 10", "rank <= 12")
    + """, sv AS (SELECT 5 AS seed, kn.cell, l.label, COUNT(*) AS n FROM kn JOIN emb l ON l.cell = neighbor WHERE rank <= 5 GROUP BY 2, 3 UNION ALL SELECT 12, kn.cell, l.label, COUNT(*) FROM kn JOIN emb l ON l.cell = neighbor GROUP BY 2, 3),
    pp AS (SELECT *, n / SUM(n) OVER (PARTITION BY seed, cell) AS p FROM sv), so AS (SELECT cell, label, SUM(p) / 2 AS prob FROM pp GROUP BY 1, 2), tt AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(prob, 12) DESC, label) AS rn FROM so),
    ea AS (SELECT *, row_number() OVER (PARTITION BY seed, cell ORDER BY n DESC, label) AS rn FROM sv), en AS (SELECT cell, -SUM(prob * ln(prob)) AS h FROM so GROUP BY 1)
    SELECT tt.cell, tt.label, round(tt.prob, 6) AS prob, round(h, 6) AS entropy, (SELECT COUNT(*) FROM ea WHERE ea.cell = tt.cell AND ea.rn = 1 AND ea.label = tt.label) / 2 AS consensus_fraction, CASE WHEN tt.label IN ('0', '1', '2', '3') THEN 'low' WHEN tt.label <> '9' THEN 'high' END AS coarse FROM tt JOIN en USING (cell) WHERE tt.rn = 1""",
)
def h10(spark, sf):
    nb = materialise(nearest(spark, sf, 12))
    labels = b.embedding(spark, sf).select("cell", "label")
    seeds = [k.label_votes(nb.filter(F.col("rank") <= s), labels).withColumn("seed", F.lit(s)) for s in (5, 12)]
    parents = labels.select("label").distinct().withColumn(
        "parent", F.explode(F.when(F.col("label") == "9", F.array(F.lit("low"), F.lit("high"))).otherwise(F.array(F.when(F.col("label") <= "3", "low").otherwise("high"))))
    )
    return r(k.map_reference(seeds[0].unionByName(seeds[1]), parents), "prob", "entropy")


@query("e7_lisi", VOTES_SQL + f" SELECT cell, round(1 / SUM((n / {K}) * (n / {K})), 6) AS lisi FROM vt GROUP BY 1")
def e7(spark, sf):
    return r(k.lisi(nearest(spark, sf), b.embedding(spark, sf)), "lisi")


@query(
    "e7_batch_rejection",
    VOTES_SQL + f""", f AS (SELECT label, COUNT(*) / (SELECT COUNT(*) FROM emb) AS f FROM emb GROUP BY 1) SELECT e.cell, round(SUM(pow(COALESCE(n, 0) - {K} * f, 2) / ({K} * f)), 5) AS chi2, (SELECT COUNT(*) FROM f)::DOUBLE - 1 AS df FROM (SELECT cell FROM emb) e CROSS JOIN f LEFT JOIN vt ON vt.cell = e.cell AND vt.label = f.label GROUP BY 1""",
)
def e7_rejection(spark, sf):
    return r(k.batch_rejection(nearest(spark, sf), b.embedding(spark, sf).select("cell", "label")), "chi2", places=5)


@query(
    "e7_pc_regression",
    with_sql("embedding")
    + """, l AS (SELECT label, i, vec[i]::DOUBLE AS x FROM emb, range(1, 65) g(i)), m AS (SELECT i, AVG(x) AS m FROM l GROUP BY 1), g AS (SELECT label, i, AVG(x) AS gm, COUNT(*) AS n FROM l GROUP BY 1, 2)
    SELECT round((SELECT SUM(n * (gm - m) * (gm - m)) FROM g JOIN m USING (i)) / (SELECT SUM((x - m) * (x - m)) FROM l JOIN m USING (i)), 6) AS pcr""",
)
def e7_pcr(spark, sf):
    e = b.embedding(spark, sf)
    return r(k.pc_regression(e.select("cell", "vec"), e.select("cell", "label")), "pcr")


@query("e7_integration_metrics")
def e7_all(spark, sf):
    e = b.embedding(spark, sf)
    batch = embedded_cells(spark, sf).select("cell", F.col("donor").alias("label"))
    # the same vectors with an offset for each donor: batches stand apart in it
    offset = F.col("donor").cast("double") / 20
    apart = e.join(batch.select("cell", F.col("label").alias("donor")), "cell").withColumn("vec", F.transform(F.col("vec").cast("array<double>"), lambda x: x + offset))
    return k.integration_metrics({"full": e, "apart": apart.select("cell", "vec")}, batch, e.select("cell", "label"))


E7_SQL = """, d AS (SELECT cell, label, CAST(CAST(cell AS BIGINT) % 7 AS VARCHAR) AS batch, vec::DOUBLE[] AS v FROM emb)"""


@query(
    "e7_batch_silhouette",
    with_sql("embedding", extra=E7_SQL.lstrip(", "))
    + """, p AS (SELECT a.cell, a.label, a.batch, c.batch AS other, SUM(pow(list_distance(a.v, c.v), 2)) AS s, COUNT(*) FILTER (a.cell <> c.cell) AS n FROM d a JOIN d c ON a.label = c.label GROUP BY 1, 2, 3, 4),
    q AS (SELECT cell, label, MAX(CASE WHEN batch = other AND n > 0 THEN s / n END) AS a, MIN(CASE WHEN batch <> other THEN s / n END) AS b FROM p GROUP BY 1, 2)
    SELECT label, COUNT(*) AS n, round(AVG(1 - abs(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / GREATEST(a, b) END)), 6) AS score FROM q GROUP BY 1""",
)
def e7_batch_silhouette(spark, sf):
    e = b.embedding(spark, sf)
    batch = embedded_cells(spark, sf).select("cell", F.col("donor").alias("label"))
    return r(g.batch_silhouette(e, e.select("cell", "label"), batch), "score")


@query(
    "e7_graph_connectivity",
    GRAPH_SQL.replace("WITH emb", "WITH RECURSIVE emb", 1)
    + """, ii AS (SELECT src, dst FROM ed JOIN emb x ON x.cell = src JOIN emb y ON y.cell = dst WHERE x.label = y.label AND src <> dst), rr AS (SELECT cell AS a, cell AS b FROM emb UNION SELECT rr.a, ii.dst FROM rr JOIN ii ON rr.b = ii.src),
    cc AS (SELECT a, MIN(b) AS c FROM rr GROUP BY 1), sz AS (SELECT label, c, COUNT(*) AS m FROM cc JOIN emb ON emb.cell = a GROUP BY 1, 2)
    SELECT label, CAST(SUM(m) AS BIGINT) AS n, MAX(m) AS largest, round(MAX(m) / SUM(m), 9) AS connectivity FROM sz GROUP BY 1""",
)
def e7_connectivity(spark, sf):
    return r(g.graph_connectivity(k.knn_graph(nearest(spark, sf)), b.embedding(spark, sf)), "connectivity", places=9)


@query(
    "e7_cluster_agreement",
    with_sql("cells")
    + """, x AS (SELECT donor, concat(library, condition) AS a, label2 AS b, COUNT(*)::DOUBLE AS n FROM cells GROUP BY 1, 2, 3), sa AS (SELECT donor, a, SUM(n) AS n FROM x GROUP BY 1, 2), sb AS (SELECT donor, b, SUM(n) AS n FROM x GROUP BY 1, 2),
    e AS (SELECT donor, SUM(n) AS t, SUM(n * ln(n)) AS e, SUM(n * (n - 1) / 2) AS c FROM x GROUP BY 1), ea AS (SELECT donor, SUM(n * ln(n)) AS e, SUM(n * (n - 1) / 2) AS c FROM sa GROUP BY 1), eb AS (SELECT donor, SUM(n * ln(n)) AS e, SUM(n * (n - 1) / 2) AS c FROM sb GROUP BY 1)
    SELECT donor, round((ln(t) - ea.e / t - eb.e / t + e.e / t) / ((2 * ln(t) - ea.e / t - eb.e / t) / 2), 7) AS nmi,
    round((e.c - ea.c * eb.c / (t * (t - 1) / 2)) / ((ea.c + eb.c) / 2 - ea.c * eb.c / (t * (t - 1) / 2)), 7) AS ari FROM e JOIN ea USING (donor) JOIN eb USING (donor)""",
)
def e7_agreement(spark, sf):
    cells = b.cells(spark, sf)
    found = cells.select("donor", "cell", F.concat("library", "condition").alias("cluster"))
    return r(g.cluster_agreement(found, cells.select("cell", F.col("label2").alias("label")), ("donor",)), "nmi", "ari", places=7)


@query("e7_connected_components")
def e7_components(spark, sf):
    return k.connected_components(k.knn_graph(nearest(spark, sf, 3))).groupBy("c").agg(F.count(F.lit(1)).alias("n"))


def da_cells(spark, sf):
    return embedded_cells(spark, sf).withColumns(
        {"condition": F.when(F.col("cell").cast("long") % 2 == 0, "F").otherwise("O"), "cell_type": F.col("cluster")}
    )


@query("j13_neighbourhood_abundance")
def j13(spark, sf):
    return k.neighbourhood_da(nearest(spark, sf, 20), da_cells(spark, sf), "donor", "condition", "cell_type", "F", "O", 0.2)


@query(
    "j13_neighbourhood_counts",
    KNN_SQL
    + """, a AS (SELECT cell AS nhood, neighbor AS cell FROM kn UNION ALL SELECT cell, cell FROM emb) SELECT nhood, CAST(CAST(cell AS BIGINT) % 7 AS VARCHAR) AS donor, COUNT(*) AS n FROM a GROUP BY 1, 2""",
)
def j13_counts(spark, sf):
    return k.neighbourhood_counts(nearest(spark, sf), embedded_cells(spark, sf), ["donor"], 1.0)


# --- trajectory --------------------------------------------------------------------------


@query("o1_root_by_score", with_sql("cells") + "SELECT cell FROM cells ORDER BY price DESC, cell LIMIT 1")
def o1(spark, sf):
    return t.root_by_score(b.cells(spark, sf), "price")


@query(
    "o1_root_by_group",
    with_sql("embedding")
    + """, l AS (SELECT cell, i, vec[i]::DOUBLE AS x FROM emb, range(1, 65) g(i) WHERE label = '3'), c AS (SELECT i, AVG(x) AS c FROM l GROUP BY 1) SELECT cell FROM (SELECT cell, round(SUM((x - c) * (x - c)), 12) AS d FROM l JOIN c USING (i) GROUP BY 1) ORDER BY d, cell LIMIT 1""",
)
def o1_group(spark, sf):
    e = b.embedding(spark, sf)
    return t.root_by_group(e, e.select("cell", "label"), "3")


@query(
    "o2_embedding_outliers",
    with_sql("embedding")
    + """, l AS (SELECT cell, i, vec[i]::DOUBLE AS x FROM emb, range(1, 11) g(i)), m AS (SELECT i, median(x) AS m FROM l GROUP BY 1), s AS (SELECT i, median(abs(x - m)) AS s FROM l JOIN m USING (i) GROUP BY 1)
    SELECT cell, bool_or(abs(x - m) / (1.4826 * s) > 2.5) AS outlier FROM l JOIN m USING (i) JOIN s USING (i) GROUP BY 1""",
)
def o2(spark, sf):
    return t.embedding_outliers(b.embedding(spark, sf), 2.5)


def pseudotime(spark, sf):
    e = b.embedding(spark, sf)
    graph = materialise(k.knn_graph(nearest(spark, sf)))
    return graph, materialise(t.graph_pseudotime(graph, t.root_by_group(e, e.select("cell", "label"), "3")))


@query(
    "o3_graph_pseudotime",
    GRAPH_SQL.replace("WITH ", "WITH RECURSIVE ", 1)
    + """, l3 AS (SELECT cell, i, vec[i]::DOUBLE AS x FROM emb, range(1, 65) g(i) WHERE label = '3'), c3 AS (SELECT i, AVG(x) AS c FROM l3 GROUP BY 1), rt AS (SELECT cell FROM (SELECT cell, round(SUM((x - c) * (x - c)), 12) AS d FROM l3 JOIN c3 USING (i) GROUP BY 1) ORDER BY d, cell LIMIT 1),
    sp AS (SELECT 0 AS i, cell, 0.0::DOUBLE AS d FROM rt UNION ALL SELECT i + 1, dst, MIN(d + distance) FROM sp JOIN ed ON src = cell WHERE i < 16 GROUP BY i, dst), bs AS (SELECT cell, MIN(d) AS d FROM sp GROUP BY 1)
    SELECT n.cell, round(d / (SELECT MAX(d) FROM bs), 6) AS pseudotime FROM (SELECT DISTINCT src AS cell FROM ed) n LEFT JOIN bs USING (cell)""",
)
def o3(spark, sf):
    return r(pseudotime(spark, sf)[1], "pseudotime")


VEL_SQL = with_sql("layers") + """, w AS (SELECT cell, gene, COALESCE(SUM(value) FILTER (layer = 'spliced'), 0) AS s, COALESCE(SUM(value) FILTER (layer = 'unspliced'), 0) AS u FROM layers GROUP BY 1, 2),
    n AS (SELECT COUNT(DISTINCT cell) AS n FROM layers), g AS (SELECT gene, SUM(CASE WHEN s > 0 AND u > 0 THEN s + u ELSE 0 END) AS sh, SUM(u * s) AS us, SUM(s * s) AS ss, SUM(u * u) AS uu, SUM(u) AS su FROM w GROUP BY 1), gk AS (SELECT *, us / NULLIF(ss, 0) AS gm FROM g WHERE sh >= 20)"""


@query(
    "o4_steady_state_gamma",
    VEL_SQL + "SELECT gene, sh AS shared, round(gm, 9) AS gamma, round(1 - (uu - us * gm) / (uu - su * su / n), 6) AS r2 FROM gk, n",
)
def o4(spark, sf):
    return r(r(t.steady_state_velocity(b.layers(spark, sf))[0], "gamma", places=9), "r2")


@query("o4_velocity", VEL_SQL + "SELECT cell, gene, round(u - gm * s, 6) AS velocity FROM w JOIN gk USING (gene)")
def o4_velocity(spark, sf):
    return r(t.steady_state_velocity(b.layers(spark, sf))[1], "velocity")


def fates(spark, sf):
    graph, pt = pseudotime(spark, sf)
    terminal = b.embedding(spark, sf).filter(F.col("label").isin("7", "8", "9")).select("cell", F.col("label").alias("fate"))
    return t.fate_probabilities(graph, pt, terminal)


@query("o5_fate_probabilities")
def o5(spark, sf):
    return fates(spark, sf)


@query(
    "o6_lineage_drivers",
    with_sql("dense", "dcells", extra=LOG_SQL)
    + f""", g AS (SELECT x.gene, COALESCE(value, 0) AS v, balance FROM dcells d CROSS JOIN (SELECT DISTINCT p_brand AS gene FROM part) x LEFT JOIN ll ON ll.cell = d.cell AND ll.gene = x.gene), c AS (SELECT gene, corr(v, balance) AS r, COUNT(*) AS n FROM g GROUP BY 1)
    SELECT gene, round(r, 6) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t FROM c""",
)
def o6(spark, sf):
    fate = b.dense_cells(spark, sf).select("cell", F.col("balance").alias("prob"))
    return r(r(t.lineage_drivers(lognorm(spark, sf), fate).select("gene", "r", "t"), "r"), "t", places=5)


@query("o6_fate_drivers")
def o6_fates(spark, sf):
    return t.lineage_drivers(vector_layer(spark, sf), fates(spark, sf), by=["fate"])


def timed(spark, sf):
    """Customers ordered by balance, made unique by their number."""
    return b.dense_cells(spark, sf).withColumn("pt", F.col("balance") + F.col("cell").cast("double") * 1e-7)


BINS = """bn AS (SELECT cell, cell_type, donor, LEAST(19, floor((row_number() OVER (ORDER BY balance + CAST(cell AS DOUBLE) * 1e-7) - 1) * 20 / COUNT(*) OVER ()))::INT AS bin FROM dcells)"""


@query(
    "o7_pseudotime_profile",
    with_sql("dense", "dcells", extra=LOG_SQL + ", " + BINS)
    + """, sz AS (SELECT bin, COUNT(*) AS n FROM bn GROUP BY 1), s AS (SELECT gene, bin, SUM(value) AS s FROM ll JOIN bn USING (cell) GROUP BY 1, 2), g AS (SELECT x.gene, sz.bin, COALESCE(s, 0) / n AS m FROM (SELECT DISTINCT gene FROM ll) x CROSS JOIN sz LEFT JOIN s ON s.gene = x.gene AND s.bin = sz.bin)
    SELECT gene, bin, round(SUM(m) OVER (PARTITION BY gene ORDER BY bin ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5.0, 6) AS value FROM g""",
)
def o7(spark, sf):
    return r(t.pseudotime_profile(lognorm(spark, sf), timed(spark, sf), "pt", 20), "value")


@query("o7_score_track", with_sql("dcells", extra="orders_n AS (SELECT CAST(o_custkey AS VARCHAR) AS cell, COUNT(*) AS k FROM orders GROUP BY 1), " + BINS) + "SELECT bin, round(AVG(k), 6) AS value FROM bn JOIN orders_n USING (cell) GROUP BY 1")
def o7_track(spark, sf):
    return r(t.score_track(last_cells(spark, sf, timed(spark, sf)), "pt", "k", 20), "value")


@query(
    "o7_category_track",
    with_sql("dcells", extra=BINS) + "SELECT bin, cell_type AS value FROM (SELECT bin, cell_type, row_number() OVER (PARTITION BY bin ORDER BY COUNT(*) DESC, cell_type) AS rn FROM bn GROUP BY 1, 2) WHERE rn = 1",
)
def o7_category(spark, sf):
    return t.category_track(timed(spark, sf), "pt", "cell_type", 20)


@query(
    "o8_rank_by_pseudotime",
    with_sql("dense", "dcells")
    + """, j AS (SELECT gene AS source, value AS x, balance + CAST(cell AS DOUBLE) * 1e-7 AS t FROM dense JOIN dcells USING (cell)), k AS (SELECT source, rank() OVER (PARTITION BY source ORDER BY x) + (COUNT(*) OVER (PARTITION BY source, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY source ORDER BY t)::DOUBLE AS rt FROM j)
    SELECT source, round(corr(rx, rt), 6) AS rho, COUNT(*) AS n_cells FROM k GROUP BY 1""",
)
def o8(spark, sf):
    act = b.dense_counts(spark, sf).select("cell", F.col("gene").alias("source"), F.col("value").alias("score"))
    return r(t.rank_by_pseudotime(act, timed(spark, sf), "pt"), "rho")


@query("o8_activity_by_bin", with_sql("dense", "dcells", extra=BINS) + "SELECT gene AS source, bin, round(AVG(value), 6) AS mean_score FROM dense JOIN bn USING (cell) GROUP BY 1, 2")
def o8_bins(spark, sf):
    act = b.dense_counts(spark, sf).select("cell", F.col("gene").alias("source"), F.col("value").alias("score"))
    return r(t.activity_by_bin(act, timed(spark, sf), "pt", 20), "mean_score")
