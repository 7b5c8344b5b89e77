"""Source, normalisation, embedding and fitted-model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.levels import bounded_levels
from ..operators import embed, fits, normalize
from ..session import materialise, scratch_path
from ..sources import readers, subset
from . import bindings as b
from .bindings import with_sql
from .labels_and_programs import LOG_SQL, lognorm
from .quality import metrics, r
from .registry import query


# --- sources -----------------------------------------------------------------------------


def written_mtx(spark, sf):
    """The order × part matrix written as coordinate text by many tasks."""
    folder = scratch_path(spark, "mtx")
    p = b.table(spark, sf, "part").select("p_partkey", F.concat_ws("\t", F.concat(F.lit("G"), F.col("p_partkey").cast("string")), "p_name", F.when(F.col("p_type") == "PROMO", "Antibody Capture").otherwise("Gene Expression")).alias("value"))
    p.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").select("value").write.text(f"{folder}/features.tsv")
    o = b.table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("C"), F.col("o_orderkey").cast("string"), F.lit("-1")).alias("value"))
    o.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey").select("value").write.text(f"{folder}/barcodes.tsv")
    c = b.counts(spark, sf).select(F.concat_ws(" ", (F.col("gene").cast("long") + 1).cast("string"), (F.col("cell").cast("long") + 1).cast("string"), F.col("value").cast("long").cast("string")).alias("value"), F.lit(1).alias("k"))
    dims = " ".join(str(n.count()) for n in (p, o, c))
    head = spark.createDataFrame([("%%MatrixMarket matrix coordinate integer general", -1), (dims, 0)], "value string, k int")
    c.unionByName(head).repartitionByRange(4, "k", "value").sortWithinPartitions("k", "value").select("value").write.text(f"{folder}/matrix.mtx")
    return folder


@query(
    "a1_read_mtx_counts",
    "SELECT concat('C', l_orderkey, '-1') AS cell, concat('G', l_partkey) AS gene, SUM(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO' GROUP BY 1, 2",
)
def a1(spark, sf):
    return readers.read_mtx_counts(spark, written_mtx(spark, sf))[0]


def libraries(spark, sf):
    counts, cells, genes = materialise(b.counts(spark, sf)), materialise(b.cells(spark, sf)), b.genes(spark, sf)
    out = {}
    for name in ("F", "O", "P"):
        mine = cells.filter(F.col("condition") == name).select("cell", "donor")
        out[name] = (counts.join(mine, "cell", "left_semi"), genes, mine)
    sheet = spark.createDataFrame([(n, f"batch{i}") for i, n in enumerate(out)], "sample_id string, batch string")
    meta = {n: v[2].select(F.col("cell").alias("barcode"), "donor") for n, v in out.items()}
    return readers.import_libraries(out, sheet, meta)


@query("a2_import_libraries", with_sql("counts", "cells") + "SELECT concat(condition, ':', cell) AS cell, gene, value FROM counts JOIN cells USING (cell)")
def a2(spark, sf):
    return libraries(spark, sf)[0]


@query(
    "a2_library_cells",
    with_sql("cells") + "SELECT concat(condition, ':', cell) AS cell, cell AS barcode, condition AS sample_id, donor, CASE condition WHEN 'F' THEN 'batch0' WHEN 'O' THEN 'batch1' ELSE 'batch2' END AS batch FROM cells",
)
def a2_cells(spark, sf):
    return libraries(spark, sf)[1].select("cell", "barcode", "sample_id", "donor", "batch")


@query("a3_load_manifest", "SELECT n_name AS sample_id, concat('lib/', n_nationkey) AS path, CAST(n_regionkey AS VARCHAR) AS batch, concat('k', n_nationkey) AS note FROM nation")
def a3(spark, sf):
    path = scratch_path(spark, "manifest")
    n = b.table(spark, sf, "nation").select(
        F.col("n_name").alias("Sample ID"), F.concat(F.lit("lib/"), F.col("n_nationkey").cast("string")).alias("Path"),
        F.col("n_regionkey").cast("string").alias("batch"), F.concat(F.lit("k"), F.col("n_nationkey").cast("string")).alias("Note"),
    )
    n.write.csv(path, header=True)
    return readers.load_manifest(spark, path).select("sample_id", "path", "batch", F.col("extra")["note"].alias("note"))


@query("a4_subset_cells", with_sql("cells") + "SELECT cell FROM cells WHERE cell_type IN ('BUILDING', 'MACHINERY') AND condition <> 'P'")
def a4(spark, sf):
    return subset.subset_cells(b.cells(spark, sf), "cell_type", ["BUILDING", "MACHINERY"], ("condition", ["P"]))[0].select("cell")


@query(
    "a4_subset_counters",
    """WITH l AS (SELECT l_returnflag AS a, CASE WHEN l_quantity > 25 THEN l_returnflag ELSE 'N' END AS c, l_linestatus AS s FROM lineitem)
    SELECT COUNT(*) AS n_before, COUNT(*) FILTER (a IN ('A', 'R')) AS n_selected, COUNT(*) FILTER (a IN ('A', 'R') AND a <> c) AS n_discordant, COUNT(*) FILTER (a IN ('A', 'R') AND a = c AND s = 'O') AS n_excluded, COUNT(*) FILTER (a IN ('A', 'R') AND a = c AND s <> 'O') AS n_after FROM l""",
)
def a4_counters(spark, sf):
    li = b.table(spark, sf, "lineitem").withColumn("second", F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("N"))
    return subset.subset_cells(li, "l_returnflag", ["A", "R"], ("l_linestatus", ["O"]), "second")[1]


CAPS = {"BUILDING": 100, "MACHINERY": 50, "AUTOMOBILE": 10_000_000}


@query(
    "a5_sample_report",
    with_sql("cells") + """, c AS (SELECT * FROM (VALUES ('BUILDING', 100), ('MACHINERY', 50), ('AUTOMOBILE', 10000000)) v(cell_type, cap)), n AS (SELECT cell_type, COUNT(*) AS k FROM cells GROUP BY 1)
    SELECT cell_type, cap, k AS available, k >= 10 AS eligible, CASE WHEN k >= 10 THEN LEAST(k, cap) ELSE 0 END AS selected FROM c JOIN n USING (cell_type)""",
)
def a5(spark, sf):
    return subset.sample_per_group(b.cells(spark, sf), "cell_type", CAPS, gate=10)[1]


@query(
    "a5_sample_sizes",
    with_sql("cells") + "SELECT cell_type, LEAST(COUNT(*), CASE cell_type WHEN 'BUILDING' THEN 100 WHEN 'MACHINERY' THEN 50 ELSE 10000000 END) AS n FROM cells WHERE cell_type IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') GROUP BY 1",
)
def a5_draw(spark, sf):
    return subset.sample_per_group(b.cells(spark, sf), "cell_type", CAPS, gate=10)[0].groupBy("cell_type").agg(F.count(F.lit(1)).alias("n"))


@query("a6_attach_layout", with_sql("embedding") + "SELECT cell, label, vec[1]::DOUBLE AS x, vec[2]::DOUBLE AS y FROM emb")
def a6(spark, sf):
    e = b.embedding(spark, sf)
    layout = e.select("cell", F.col("vec")[0].cast("double").alias("x"), F.col("vec")[1].cast("double").alias("y"))
    return subset.attach_layout(e.select("cell", "label"), layout)


@query(
    "a7_reconcile_splice",
    """WITH s AS (SELECT l_orderkey AS o, l_partkey AS g, l_linestatus AS st, MIN(l_linenumber) AS listing, SUM(l_quantity) AS v, c_nationkey AS nk, l_linenumber AS ln FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY l_orderkey, l_partkey, l_linestatus, c_nationkey, l_linenumber),
    f AS (SELECT nk, g, MIN(ln) AS ln FROM s GROUP BY 1, 2)
    SELECT CAST(o AS VARCHAR) AS cell, CAST(g AS VARCHAR) AS gene, CASE st WHEN 'F' THEN 'spliced' ELSE 'unspliced' END AS layer, SUM(v) AS value FROM s JOIN f USING (nk, g, ln) GROUP BY 1, 2, 3""",
)
def a7(spark, sf):
    cells = b.cells(spark, sf).select("cell", F.col("donor").alias("sample"), F.concat("cell", F.lit("-1")).alias("barcode"))
    li = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("cell"), F.col("l_partkey").cast("string").alias("gene"), F.col("l_linenumber").alias("listing"),
        F.when(F.col("l_linestatus") == "F", "spliced").otherwise("unspliced").alias("layer"), F.col("l_quantity").alias("value"),
    )
    splice = li.join(cells.select("cell", "sample"), "cell").select(
        F.concat(F.lit("run"), "sample").alias("stem"), F.concat(F.lit("run"), "sample", F.lit(":"), "cell", F.lit("x")).alias("file_cell"), "gene", "listing", "layer", "value"
    )
    manifest = cells.select(F.concat(F.lit("run"), "sample").alias("stem"), "sample").distinct()
    return subset.reconcile_splice(splice, cells, manifest)


@query(
    "a8_gene_set_files",
    """SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS target FROM part WHERE p_brand <> 'Brand#1' UNION SELECT 'Brand#1', p_name FROM part WHERE p_brand = 'Brand#1'""",
)
def a8(spark, sf):
    path = scratch_path(spark, "gmt")
    net = b.net(spark, sf)
    net.groupBy("source").agg(F.array_join(F.sort_array(F.collect_list("target")), "\t").alias("t")).select(F.concat_ws("\t", "source", F.lit("from the part table"), "t").alias("value")).write.text(path)
    named = b.table(spark, sf, "part").filter(F.col("p_brand") == "Brand#1").select(F.col("p_brand").alias("source"), F.col("p_name").alias("target"))
    return readers.resolve_programs([readers.read_gmt(spark, path), named])


@query("a9_write_result", with_sql("cells") + "SELECT donor, condition, COUNT(*) AS n FROM cells GROUP BY 1, 2")
def a9(spark, sf):
    n = b.cells(spark, sf).groupBy("donor", "condition").agg(F.count(F.lit(1)).alias("n"))
    path = readers.write_result(n, scratch_path(spark, "result"), "csv")
    return spark.read.csv(path, header=True, schema=n.schema)


@query(
    "a10_align_genes",
    "SELECT MIN(CAST(p_partkey AS VARCHAR)) AS ref_gene, p_name AS gene FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_type = 'PROMO') GROUP BY 2",
)
def a10(spark, sf):
    p = b.table(spark, sf, "part")
    ref = p.select(F.col("p_partkey").cast("string").alias("gene"), F.col("p_name").alias("symbol"))
    return subset.align_genes(ref, p.filter("p_type = 'PROMO'").select(F.col("p_name").alias("gene")))


@query("a10_restrict_to_variable", with_sql("counts", "genes") + "SELECT cell, gene, value FROM counts JOIN genes USING (gene) WHERE type = 'PROMO' OR gene IN ('0', '1')")
def a10_restrict(spark, sf):
    genes = b.genes(spark, sf).withColumn("highly_variable", F.col("type") == "PROMO")
    return subset.restrict_to_variable(b.counts(spark, sf), genes, forced=["0", "1"])


# --- normalisation -----------------------------------------------------------------------

TOT = ", tt AS (SELECT cell, SUM(value) AS t FROM counts GROUP BY 1) "


@query("d1_proportional_fit", with_sql("counts") + TOT + "SELECT cell, gene, round(value / t, 9) AS value FROM counts JOIN tt USING (cell)")
def d1(spark, sf):
    return r(normalize.proportional_fit(b.counts(spark, sf)), "value", places=9)


@query("d2_log1p_cp10k", with_sql("counts") + TOT + "SELECT cell, gene, round(ln(1 + value * 10000.0 / t), 6) AS value FROM counts JOIN tt USING (cell)")
def d2(spark, sf):
    return r(normalize.log1p_cp10k(b.counts(spark, sf)), "value")


@query("d3_log1p_pf", with_sql("counts") + TOT + "SELECT cell, gene, round(ln(1 + value / t), 9) AS value FROM counts JOIN tt USING (cell)")
def d3(spark, sf):
    return r(normalize.log1p_pf(b.counts(spark, sf)), "value", places=9)


PF_SQL = with_sql("counts") + TOT + ", k AS (SELECT AVG(t) AS k FROM tt), v AS (SELECT cell, gene, ln(1 + value * k / t) AS value FROM counts JOIN tt USING (cell), k) "


@query("d4_pflog_values", PF_SQL + "SELECT cell, gene, round(value, 6) AS value FROM v")
def d4(spark, sf):
    return r(normalize.pflog(b.counts(spark, sf))[0], "value")


@query("d4_pflog_centers", PF_SQL + "SELECT cell, round(SUM(value) / (SELECT COUNT(DISTINCT gene) FROM counts), 9) AS row_center FROM v GROUP BY 1")
def d4_centers(spark, sf):
    return r(normalize.pflog(b.counts(spark, sf))[1], "row_center", places=9)


@query(
    "d5_hvg_dispersion",
    with_sql("dense", "dcells", extra=LOG_SQL)
    + """, n AS (SELECT COUNT(*)::DOUBLE AS n FROM dcells), s AS (SELECT gene, SUM(exp(value) - 1) AS s, SUM((exp(value) - 1) * (exp(value) - 1)) AS q FROM ll GROUP BY 1), m AS (SELECT gene, s / n AS mu, (q - s * s / n) / (n - 1) AS va FROM s, n),
    d AS (SELECT gene, ln(1 + mu) AS mean, ln(va / mu) AS dispersion FROM m), e AS (SELECT MIN(mean) AS lo, MAX(mean) AS hi FROM d), g AS (SELECT d.*, LEAST(4, GREATEST(0, ceil((mean - lo) / (hi - lo) * 5) - 1))::INT AS mean_bin FROM d, e), h AS (SELECT mean_bin, AVG(dispersion) AS mu, stddev_samp(dispersion) AS sd FROM g GROUP BY 1)
    SELECT gene, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, mean_bin, round(CASE WHEN sd IS NULL THEN dispersion / h.mu ELSE (dispersion - h.mu) / sd END, 5) AS score FROM g JOIN h USING (mean_bin)""",
)
def d5(spark, sf):
    out = normalize.hvg_dispersion(lognorm(spark, sf), b.dense_cells(spark, sf), n_bins=5)
    return r(r(out, "mean", "dispersion"), "score", places=5)


@query(
    "d6_hvg_clipped_variance",
    with_sql("counts", "cells")
    + """, n AS (SELECT COUNT(*)::DOUBLE AS n FROM cells), s AS (SELECT gene, SUM(value) AS s, SUM(value * value) AS q FROM counts GROUP BY 1), m AS (SELECT gene, n, s / n AS mu, (q - s * s / n) / (n - 1) AS va FROM s, n), f AS (SELECT log10(mu) AS x, log10(va) AS y FROM m WHERE va > 0),
    p AS (SELECT COUNT(*)::DOUBLE AS s0, SUM(x) AS s1, SUM(x*x) AS s2, SUM(x*x*x) AS s3, SUM(x*x*x*x) AS s4, SUM(y) AS t0, SUM(x*y) AS t1, SUM(x*x*y) AS t2 FROM f), dd AS (SELECT *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS d FROM p),
    c AS (SELECT (t0*(s2*s4-s3*s3) - s1*(t1*s4-t2*s3) + s2*(t1*s3-t2*s2))/d AS c0, (s0*(t1*s4-t2*s3) - t0*(s1*s4-s2*s3) + s2*(s1*t2-s2*t1))/d AS c1, (s0*(s2*t2-s3*t1) - s1*(s1*t2-s2*t1) + t0*(s1*s3-s2*s2))/d AS c2 FROM dd),
    r AS (SELECT gene, n, mu, va, CASE WHEN va > 0 THEN sqrt(pow(10, c0 + c1*log10(mu) + c2*log10(mu)*log10(mu))) ELSE 1 END AS sd FROM m, c), k AS (SELECT gene, SUM(LEAST(value, sd*sqrt(n)+mu)) AS a, SUM(pow(LEAST(value, sd*sqrt(n)+mu), 2)) AS q FROM counts JOIN r USING (gene) GROUP BY 1)
    SELECT gene, round(mu, 6) AS mean, round(va, 6) AS variance, round((n*mu*mu + q - 2*a*mu) / ((n-1)*sd*sd), 4) AS score FROM r JOIN k USING (gene)""",
)
def d6(spark, sf):
    out = normalize.hvg_clipped_variance(b.counts(spark, sf), b.cells(spark, sf))
    return r(r(out, "mean", "variance"), "score", places=4)


@query(
    "d7_hvg_pearson",
    with_sql("dense", "dcells")
    + """, d AS (SELECT cell, SUM(value) AS d FROM dense GROUP BY 1), g AS (SELECT gene, SUM(value) AS g FROM dense GROUP BY 1), t AS (SELECT SUM(d) AS t FROM d), n AS (SELECT COUNT(*)::DOUBLE AS n FROM dcells),
    x AS (SELECT d.cell, g.gene, COALESCE(value, 0) AS v, g * d / t AS mu, sqrt(n) AS lim FROM d CROSS JOIN g CROSS JOIN t CROSS JOIN n LEFT JOIN dense ON dense.cell = d.cell AND dense.gene = g.gene), r AS (SELECT gene, GREATEST(-lim, LEAST(lim, (v - mu) / sqrt(mu + mu * mu / 100.0))) AS r FROM x)
    SELECT gene, round(SUM(r * r) / (SELECT n FROM n) - pow(SUM(r) / (SELECT n FROM n), 2), 5) AS score FROM r GROUP BY 1""",
)
def d7(spark, sf):
    return r(normalize.hvg_pearson(b.dense_counts(spark, sf), b.dense_cells(spark, sf)), "score", places=5)


@query(
    "d8_hvg_finalize",
    """WITH s AS (SELECT c_mktsegment AS batch, CAST(l_partkey AS VARCHAR) AS gene, SUM(l_quantity) AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY score DESC, gene) AS rk FROM s),
    m AS (SELECT gene, COUNT(*) AS n_batches, median(rk) AS median_rank FROM k WHERE rk <= 300 GROUP BY 1), f AS (SELECT *, row_number() OVER (ORDER BY n_batches DESC, median_rank, gene) AS q FROM m)
    SELECT CAST(p_partkey AS VARCHAR) AS gene, COALESCE(n_batches, 0) AS n_batches, median_rank::DOUBLE AS median_rank, n_batches IS NOT NULL AND p_name NOT LIKE 'red%' AS highly_variable FROM part LEFT JOIN (SELECT * FROM f WHERE q <= 300) f ON f.gene = CAST(p_partkey AS VARCHAR)""",
)
def d8(spark, sf):
    cells = b.cells(spark, sf).select("cell", F.col("cell_type").alias("batch"))
    scores = b.counts(spark, sf).join(cells, "cell").groupBy("batch", "gene").agg(F.sum("value").alias("score"))
    genes = b.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("gene"), "p_name")
    return normalize.hvg_finalize(scores, genes, 300, "batch", ["^red"], "p_name").select("gene", "n_batches", "median_rank", "highly_variable")


# --- embeddings --------------------------------------------------------------------------


def brands(spark, sf):
    return bounded_levels(b.table(spark, sf, "part"), "p_brand")


def fitted(spark, sf, k=5):
    layer = materialise(lognorm(spark, sf))
    return layer, embed.fit_pca(layer, b.dense_cells(spark, sf), brands(spark, sf), k)


@query("e1_pca_loadings")
def e1(spark, sf):
    return fitted(spark, sf)[1][0]


@query("e1_pca_scores")
def e1_scores(spark, sf):
    layer, (loadings, means, _) = fitted(spark, sf)
    return embed.project_pca(layer, b.dense_cells(spark, sf), loadings, means)


@query(
    "e2_project_onto_basis",
    with_sql("dense", "dcells", extra=LOG_SQL)
    + """, l AS (SELECT p_brand AS gene, (CAST(right(p_brand, 1) AS INT) % 3) AS component, AVG(p_size) / 50.0 AS w, AVG(p_retailprice) / 1000 AS mu FROM part GROUP BY 1, 2), o AS (SELECT component, SUM(w * mu) AS o FROM l GROUP BY 1)
    SELECT d.cell, o.component, round(COALESCE(s, 0) - o, 6) AS score FROM dcells d CROSS JOIN o LEFT JOIN (SELECT cell, component, SUM(value * w) AS s FROM ll JOIN l USING (gene) GROUP BY 1, 2) x ON x.cell = d.cell AND x.component = o.component""",
)
def e2(spark, sf):
    g = b.table(spark, sf, "part").groupBy(F.col("p_brand").alias("gene")).agg((F.avg("p_size") / 50.0).alias("value"), (F.avg("p_retailprice") / 1000).alias("mean"))
    loadings = g.select("gene", (F.substring("gene", -1, 1).cast("int") % 3).alias("component"), "value")
    return r(embed.project_pca(lognorm(spark, sf), b.dense_cells(spark, sf), loadings, g.select("gene", "mean")), "score")


@query("e4_batch_correct")
def e4(spark, sf):
    e = b.embedding(spark, sf).select("cell", F.col("label").alias("batch"), F.slice("vec", 1, 8).alias("vec"))
    return embed.batch_correct(e, "batch", k=4, iterations=2).select("cell", "batch", "vec")


@query(
    "e5_check_collapse",
    with_sql("embedding") + ", d AS (SELECT i, stddev_pop(vec[i]::DOUBLE) AS s FROM emb, range(1, 65) g(i) GROUP BY 1) SELECT COUNT(*) AS n_dims, COUNT(*) FILTER (s > 1e-6) AS n_live, COUNT(*) FILTER (s > 1e-6) < 2 AS collapsed, COUNT(*) FILTER (s > 1e-6) < COUNT(*) / 2 AS warning FROM d",
)
def e5(spark, sf):
    return embed.check_collapse(b.embedding(spark, sf))


@query(
    "e6_missing_from_fit",
    with_sql("cells") + """, l AS (SELECT 'donor' AS key, donor AS level, price > 100000 AND donor <> '7' AS f FROM cells UNION ALL SELECT 'library', library, price > 100000 AND donor <> '7' FROM cells UNION ALL SELECT 'sample', sample, price > 100000 AND donor <> '7' FROM cells) SELECT key, level, COUNT(*) AS n_cells FROM l GROUP BY 1, 2 HAVING NOT bool_or(f)""",
)
def e6(spark, sf):
    cells = b.cells(spark, sf).withColumn("fit", (F.col("price") > 100000) & (F.col("donor") != "7"))
    return embed.missing_from_fit(cells, "fit", ["donor", "library", "sample"])


DENSITY_SQL = with_sql("counts", "cells", "genes", "metrics") + """, p AS (SELECT donor, condition, concat(donor, condition) AS sp, price AS x, total_counts AS y FROM metrics WHERE condition IN ('F', 'O')), w AS (SELECT quantile_cont(x, 0.01) AS x0, quantile_cont(x, 0.99) AS x1, quantile_cont(y, 0.01) AS y0, quantile_cont(y, 0.99) AS y1 FROM p),
    k AS (SELECT sp FROM p GROUP BY 1 HAVING COUNT(*) >= 50), h AS (SELECT sp, condition, LEAST(9, floor((x - x0) / ((x1 - x0) / 10)))::INT AS gx, LEAST(9, floor((y - y0) / ((y1 - y0) / 10)))::INT AS gy, COUNT(*) AS n FROM p JOIN k USING (sp), w WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY 1, 2, 3, 4),
    t AS (SELECT sp, SUM(n) AS t FROM h GROUP BY 1), a AS (SELECT COUNT(DISTINCT sp) FILTER (condition = 'F') AS a, COUNT(DISTINCT sp) FILTER (condition = 'O') AS c FROM h)
    SELECT gx, gy, round(COALESCE(SUM(n / t) FILTER (condition = 'F'), 0) / ANY_VALUE(a), 9) AS "case", round(COALESCE(SUM(n / t) FILTER (condition = 'O'), 0) / ANY_VALUE(c), 9) AS control, round(COALESCE(SUM(n / t) FILTER (condition = 'F'), 0) / ANY_VALUE(a) - COALESCE(SUM(n / t) FILTER (condition = 'O'), 0) / ANY_VALUE(c), 9) AS difference FROM h JOIN t USING (sp), a GROUP BY 1, 2"""


def density(spark, sf, smooth):
    xy = metrics(spark, sf).select(F.concat("donor", "condition").alias("sp"), "condition", F.col("price").alias("x"), F.col("total_counts").alias("y"))
    return r(embed.density_difference(xy, "sp", "condition", "F", "O", grid=10, smooth=smooth), "case", "control", "difference", places=9)


@query("e8_density_difference", DENSITY_SQL)
def e8(spark, sf):
    return density(spark, sf, False)


@query("e8_density_difference_smoothed")
def e8_smooth(spark, sf):
    return density(spark, sf, True)


@query("h13_anomaly_scores")
def h13(spark, sf):
    e = b.embedding(spark, sf).select("cell", "label", F.slice("vec", 1, 8).alias("vec"))
    return embed.anomaly_scores(e, "label")


# --- fitted models -----------------------------------------------------------------------


@query("c14_doublet_knn_score")
def c14(spark, sf):
    return fits.doublet_knn_score(b.dense_counts(spark, sf), b.dense_cells(spark, sf), "donor", brands(spark, sf), n_pcs=5, k=10)


@query("c14_doublet_calls")
def c14_calls(spark, sf):
    return fits.call_doublets(b.dense_counts(spark, sf), b.dense_cells(spark, sf), "cell_type", brands(spark, sf), n_pcs=5, k=10)


def mixture(spark, sf):
    m = metrics(spark, sf).filter(F.col("total_counts") > 0)
    return fits.mito_mixture(m, "cell_type", max_iter=30)


@query("c15_mito_mixture_models")
def c15(spark, sf):
    return mixture(spark, sf)[1]


@query("c15_mito_posterior")
def c15_posterior(spark, sf):
    return mixture(spark, sf)[0]


def called(spark, sf):
    """Calls from a slanted line instead of the fitted mixture."""
    return metrics(spark, sf).filter(F.col("total_counts") > 0).select(
        "cell", F.col("cell_type").alias("group"), F.round("pct_counts_mito", 6).alias("mito"), (F.col("pct_counts_mito") + F.col("n_genes_by_counts") > 45).alias("compromised")
    )


@query(
    "c16_mito_ceiling",
    with_sql("counts", "cells", "genes", "metrics")
    + """, c AS (SELECT cell_type AS g, round(pct_mito, 6) AS m, (pct_mito + n_genes_by_counts > 45)::INT AS bad FROM metrics WHERE total_counts > 0), v AS (SELECT DISTINCT g, m FROM c),
    d AS (SELECT v.g, v.m, COUNT(*) FILTER (c.m <= v.m AND bad = 1) + COUNT(*) FILTER (c.m > v.m AND bad = 0) AS d, COUNT(*) FILTER (c.m > v.m) AS rm, COUNT(*) AS n FROM v JOIN c ON c.g = v.g GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d, m DESC) AS rn FROM d)
    SELECT g AS "group", n AS n_cells, m AS ceiling, rm AS n_removed, d AS disagreement, round(d / n, 9) AS disagreement_fraction, d / n > 0.02 AS warning FROM k WHERE rn = 1""",
)
def c16(spark, sf):
    return r(fits.mito_ceiling(called(spark, sf)), "disagreement_fraction", places=9)


@query(
    "c17_sample_features",
    with_sql("counts", "cells", "genes", "metrics")
    + """, u AS (SELECT *, total_counts >= 1 AND n_genes_by_counts >= 1 AND pct_mito BETWEEN 0 AND 100 AS ok, (total_counts * pct_mito / 100 + 1) / (total_counts + 2) AS p FROM metrics), n AS (SELECT sample, COUNT(*) FILTER (ok) AS k FROM u GROUP BY 1)
    SELECT cell, round(CASE WHEN ok THEN log10(total_counts) END, 6) AS log_counts, round(CASE WHEN ok THEN log10(n_genes_by_counts) END, 6) AS log_feats, round(CASE WHEN ok THEN ln(p / (1 - p)) END, 6) AS logit_mito, CASE WHEN NOT ok THEN 'unusable_metrics' WHEN k < 170 THEN 'insufficient_sample_cells' ELSE 'usable' END AS status FROM u JOIN n USING (sample)""",
)
def c17(spark, sf):
    out = fits.sample_features(metrics(spark, sf), "sample", min_cells=170)
    return r(out.select("cell", "log_counts", "log_feats", "logit_mito", "status"), "log_counts", "log_feats", "logit_mito")


@query("c17_sample_outliers")
def c17_fit(spark, sf):
    return fits.sample_outliers(metrics(spark, sf), "sample")


def kept(spark, sf):
    return metrics(spark, sf).filter(F.col("condition").isin("F", "O")).withColumn("keep", F.col("n_genes_by_counts") >= 3)


@query(
    "c18_attrition_rates",
    with_sql("counts", "cells", "genes", "metrics")
    + """, k AS (SELECT *, n_genes_by_counts < 3 AS gone FROM metrics WHERE condition IN ('F', 'O')), l AS (SELECT 'condition' AS factor, condition AS level, gone, cell_type FROM k UNION ALL SELECT 'label2', label2, gone, cell_type FROM k), s AS (SELECT *, 'all' AS scope FROM l UNION ALL SELECT *, cell_type FROM l)
    SELECT factor, scope, level, COUNT(*) AS n_cells, COUNT(*) FILTER (gone) AS n_removed, round(AVG(gone::INT), 9) AS removal_rate FROM s GROUP BY 1, 2, 3""",
)
def c18(spark, sf):
    return r(fits.attrition_rates(kept(spark, sf), "keep", ["condition", "label2"], "cell_type"), "removal_rate", places=9)


@query(
    "c18_attrition_statistics",
    with_sql("counts", "cells", "genes", "metrics")
    + """, k AS (SELECT *, (n_genes_by_counts < 3)::INT AS gone FROM metrics WHERE condition IN ('F', 'O')), l2 AS (SELECT label2, COUNT(*) AS n, SUM(gone) AS k, (SELECT AVG(gone) FROM k) AS p FROM k GROUP BY 1),
    st AS (SELECT donor, SUM(gone) FILTER (condition = 'F')::DOUBLE AS a, COUNT(*) FILTER (condition = 'F' AND gone = 0)::DOUBLE AS b, SUM(gone) FILTER (condition = 'O')::DOUBLE AS c, COUNT(*) FILTER (condition = 'O' AND gone = 0)::DOUBLE AS d FROM k GROUP BY 1),
    cm AS (SELECT SUM(a) AS o, SUM((a+b)*(a+c)/(a+b+c+d)) AS e, SUM((a+b)*(c+d)*(a+c)*(b+d)/(pow(a+b+c+d,2)*(a+b+c+d-1))) AS v, SUM(a*d/(a+b+c+d))/SUM(b*c/(a+b+c+d)) AS o_r, COUNT(*) AS ns, AVG(a/(a+b)) AS r1, AVG(c/(c+d)) AS r2 FROM st)
    SELECT 'condition' AS factor, 'cell' AS unit, 'cochran_mantel_haenszel' AS test, 2 AS n_levels, round((SELECT MAX(x) - MIN(x) FROM (SELECT AVG(gone) AS x FROM k GROUP BY condition)), 9) AS rate_difference, round(pow(GREATEST(abs(o - e) - 0.5, 0), 2) / v, 6) AS statistic, round(o_r, 6) AS odds_ratio, ns AS n_strata FROM cm
    UNION ALL SELECT 'condition', 'block', 'wilcoxon_signed_rank', 2, round(abs(r1 - r2), 9), NULL, NULL, ns FROM cm
    UNION ALL SELECT 'label2', 'cell', 'chi_square', 5, round(MAX(k / n) - MIN(k / n), 9), round(SUM(pow(k - n * p, 2) / (n * p * (1 - p))), 6), NULL, NULL FROM l2""",
)
def c18_tests(spark, sf):
    out = fits.attrition_audit(kept(spark, sf), "keep", ["condition", "label2"], "donor").drop("p", "warning")
    return r(r(out, "statistic", "odds_ratio"), "rate_difference", places=9)


@query("c18_attrition_audit")
def c18_audit(spark, sf):
    return fits.attrition_audit(kept(spark, sf), "keep", ["condition", "label2", "library"], "donor")


@query("c20_provisional_lineages")
def c20(spark, sf):
    counts = b.dense_counts(spark, sf)
    n = counts.groupBy("cell").agg(F.count(F.lit(1)).alias("n_genes_by_counts"))
    return fits.provisional_lineages(counts, n, n_top=20, n_pcs=5, k=10, min_genes=15)


def factorised(spark, sf):
    return fits.consensus_nmf(lognorm(spark, sf), brands(spark, sf), 3, runs=2, max_iter=4, inner=10, n_top=5)


@query("i6_consensus_spectra")
def i6(spark, sf):
    return factorised(spark, sf)[0]


@query("i6_consensus_usages")
def i6_usages(spark, sf):
    return factorised(spark, sf)[1]


@query("h3_label_transfer")
def h3(spark, sf):
    layer, cells, genes = materialise(lognorm(spark, sf)), b.dense_cells(spark, sf), brands(spark, sf)
    model, labels = fits.fit_label_model(layer, cells, "cell_type", genes, max_iter=10)
    return fits.predict_labels(model, labels, layer, cells, genes)


@query(
    "h3_majority_vote",
    with_sql("cells") + """, n AS (SELECT concat(donor, library) AS g, label2, COUNT(*) AS n FROM cells GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, label2) AS rn, SUM(n) OVER (PARTITION BY g) AS t FROM n)
    SELECT cell, label2 AS majority, round(n / t, 9) AS majority_share FROM (SELECT cell, concat(donor, library) AS g FROM cells) c JOIN k USING (g) WHERE rn = 1""",
)
def h3_vote(spark, sf):
    cells = b.cells(spark, sf).withColumn("g", F.concat("donor", "library"))
    return r(fits.majority_vote(cells, "g", "label2").select("cell", "majority", "majority_share"), "majority_share", places=9)
