"""Enrichment, set-overlap, communication and gene-network queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.levels import bounded_levels
from ..operators import communicate as m
from ..operators import compare as j
from ..operators import enrich as e
from ..operators import genenet as n
from ..operators import normalize
from ..operators.communities import certificate
from ..session import materialise
from . import bindings as b
from .bindings import with_sql
from .labels_and_programs import LOG_SQL, lognorm
from .quality import r
from .registry import bh_sql, query


def de_table(spark, sf):
    """A contrast per part: difference of mean prices between line states and a p falling with it."""
    li = b.table(spark, sf, "lineitem")
    open_, closed = F.col("l_linestatus") == "O", F.col("l_linestatus") == "F"
    g = li.groupBy(F.col("l_partkey").cast("string").alias("gene")).agg(
        (F.avg(F.when(closed, F.col("l_extendedprice"))) / 10000 - F.avg(F.when(open_, F.col("l_extendedprice"))) / 10000).alias("logFC")
    )
    return g.withColumn("p", F.exp(-3 * F.abs("logFC"))).withColumn("fdr", F.col("p"))


DE = """de AS (SELECT CAST(l_partkey AS VARCHAR) AS gene, AVG(l_extendedprice) FILTER (l_linestatus = 'F') / 10000 - AVG(l_extendedprice) FILTER (l_linestatus = 'O') / 10000 AS lfc FROM lineitem GROUP BY 1),
    dp AS (SELECT gene, lfc, exp(-3 * abs(lfc)) AS p FROM de), rk AS (SELECT gene, sign(lfc) * -log10(p) AS metric FROM dp WHERE lfc IS NOT NULL)"""


@query("l1_de_ranking", "WITH " + DE + " SELECT gene, round(metric, 9) AS metric FROM rk")
def l1(spark, sf):
    return r(e.de_ranking(de_table(spark, sf)), "metric", places=9)


@query(
    "l2_filter_net",
    with_sql("net", extra=DE)
    + "SELECT source, target FROM net WHERE source IN (SELECT source FROM net JOIN rk ON target = gene GROUP BY 1 HAVING COUNT(DISTINCT target) BETWEEN 70 AND 85)",
)
def l2(spark, sf):
    return e.filter_net(b.net(spark, sf), e.de_ranking(de_table(spark, sf)), 70, 85)


ES_SQL = """ps AS (SELECT gene, metric, row_number() OVER (ORDER BY metric DESC) - 1 AS pos, COUNT(*) OVER () AS n FROM rk),
    ht AS (SELECT source, gene, pos, n, abs(metric) AS w, row_number() OVER (PARTITION BY source ORDER BY pos) AS idx, COUNT(*) OVER (PARTITION BY source) AS k, SUM(abs(metric)) OVER (PARTITION BY source) AS tw,
      SUM(abs(metric)) OVER (PARTITION BY source ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cw FROM ps JOIN net ON target = gene),
    wk AS (SELECT *, cw / tw - (pos - idx + 1) / (n - k) AS af, (cw - w) / tw - (pos - idx + 1) / (n - k) AS bf FROM ht),
    ex AS (SELECT source, MAX(k) AS k, GREATEST(MAX(af), 0) AS hi, LEAST(MIN(bf), 0) AS lo, arg_max(idx, af) AS pk, arg_min(idx, bf) AS tr FROM wk GROUP BY 1),
    es AS (SELECT *, CASE WHEN hi >= -lo THEN hi ELSE lo END AS es FROM ex)"""


@query(
    "l3_gsea_es",
    with_sql("net", extra=DE + ",\n" + ES_SQL)
    + """SELECT source, k AS set_size, round(es, 9) AS es, string_agg(gene, ';' ORDER BY pos) AS leading_edge, COUNT(*) AS n_leading FROM wk JOIN es USING (source) WHERE CASE WHEN es.es = hi THEN idx <= pk ELSE idx >= tr END GROUP BY 1, 2, 3""".replace("SELECT source, k AS", "SELECT source, es.k AS").replace("round(es, 9)", "round(es.es, 9)"),
)
def l3(spark, sf):
    return r(e.gsea_es(e.de_ranking(de_table(spark, sf)), b.net(spark, sf)), "es", places=9)


@query("l4_gsea")
def l4(spark, sf):
    return e.gsea(e.de_ranking(de_table(spark, sf)), b.net(spark, sf), n_perm=100, max_size=100_000)


@query(
    "l4_gsea_scores",
    with_sql("net", extra=DE + ",\n" + ES_SQL) + "SELECT source, k AS set_size, round(es, 9) AS es FROM es",
)
def l4_scores(spark, sf):
    out = e.gsea(e.de_ranking(de_table(spark, sf)), b.net(spark, sf), n_perm=5, min_size=1, max_size=100_000)
    return r(out.select("source", "set_size", "es"), "es", places=9)


@query("l4_gsea_by_type")
def l4_types(spark, sf):
    ranking = e.de_ranking(de_table(spark, sf)).join(b.genes(spark, sf).select("gene", "type"), "gene")
    return e.gsea(ranking, b.net(spark, sf), n_perm=50, by=["type"], min_size=5, max_size=100_000)


def hyper_sql(k: str, N: str, K: str, nn: str) -> str:
    lc = lambda a, c: f"(lgamma({a} + 1) - lgamma({c} + 1) - lgamma({a} - {c} + 1))"
    return f"""CASE WHEN {k} <= 0 THEN 1.0 ELSE LEAST(1.0, COALESCE(list_sum(list_transform(range(CAST(GREATEST({k}, {K} + {nn} - {N}) AS BIGINT), CAST(LEAST({K}, {nn}) + 1 AS BIGINT)),
      lambda i: exp({lc(K, 'i')} + {lc(f'({N} - {K})', f'({nn} - i)')} - {lc(N, nn)}))), 0.0)) END"""


@query(
    "l5_ora",
    with_sql("net", extra=DE)
    + f""", t AS (SELECT gene, CASE WHEN p < 0.05 AND lfc > 0 THEN 'up' WHEN p < 0.05 AND lfc < 0 THEN 'down' END AS dir FROM dp), nn AS (SELECT COUNT(*) AS "N" FROM t), fg AS (SELECT dir, COUNT(*) AS nf FROM t WHERE dir IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 5),
    sz AS (SELECT source, COUNT(*) AS kk FROM net JOIN t ON gene = target GROUP BY 1), ct AS (SELECT source, dir, COUNT(*) AS c FROM net JOIN t ON gene = target WHERE dir IS NOT NULL GROUP BY 1, 2),
    g AS (SELECT sz.source, fg.dir, COALESCE(c, 0) AS k, kk, nf, "N" AS nu FROM sz CROSS JOIN fg CROSS JOIN nn LEFT JOIN ct ON ct.source = sz.source AND ct.dir = fg.dir),
    f AS (SELECT *, {hyper_sql('k', 'nu', 'kk', 'nf')} AS p FROM g)
    SELECT source, dir AS direction, round(log2(((k + 0.5) * (nu - kk - nf + k + 0.5)) / ((nf - k + 0.5) * (kk - k + 0.5))), 6) AS score, round(p, 6) AS p, k AS count, round(k / nf, 9) AS gene_ratio, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p')}""",
)
def l5(spark, sf):
    out = e.ora(de_table(spark, sf), b.net(spark, sf), min_size=1, max_size=100_000)
    return r(r(out, "score", "p", "fdr"), "gene_ratio", places=9)


def unit_pb(spark, sf):
    cells = b.cells(spark, sf).filter(F.col("condition").isin("F", "O"))
    return j.pseudobulk(b.brand_counts(spark, sf), cells, ["sample"])


def last_digit_sets(spark, sf):
    return b.table(spark, sf, "part").select(F.concat(F.lit("set"), F.substring("p_brand", -1, 1)).alias("source"), F.col("p_brand").alias("target")).distinct()


@query("l6_gsva")
def l6(spark, sf):
    return e.gsva(unit_pb(spark, sf), "sample", last_digit_sets(spark, sf), min_size=2)


@query("l6_gsva_contrast")
def l6_contrast(spark, sf):
    scores = e.gsva(unit_pb(spark, sf), "sample", last_digit_sets(spark, sf), min_size=2)
    meta = b.cells(spark, sf).select("sample", "donor", "condition").distinct()
    wide = j.arms(scores.join(meta, "sample"), ["source"], "donor", "condition", "score", "F", "O")
    return j.donor_effect(wide, ["source"])


def supplier_sets(spark, sf):
    """Parts ordered in bulk from each supplier nation."""
    li = b.table(spark, sf, "lineitem").filter(F.col("l_quantity") >= 48)
    s = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return li.join(s, "l_suppkey").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("source"), F.col("l_partkey").cast("string").alias("target")).distinct()


SETS = "st AS (SELECT DISTINCT concat('n', s_nationkey) AS source, CAST(l_partkey AS VARCHAR) AS target FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 48), sz AS (SELECT source, COUNT(*) AS k FROM st GROUP BY 1), un AS (SELECT COUNT(*) AS u FROM part)"


def overlap_sql(pairs: str) -> str:
    return f"""f AS (SELECT *, {hyper_sql('x', 'u', 'size_a', 'size_b')} AS p FROM ({pairs}))
    SELECT set_a, set_b, size_a, size_b, x AS intersection, round(x / (size_a + size_b - x), 9) AS jaccard, round(x / LEAST(size_a, size_b), 9) AS overlap_coefficient, round(size_a * size_b / u, 6) AS expected, round(x / (size_a * size_b / u), 6) AS fold_enrichment, round(p, 6) AS p, round(fdr, 6) AS fdr FROM {bh_sql('f', 'p')}"""


@query(
    "l7_set_overlap",
    "WITH " + SETS + ", " + overlap_sql(
        """SELECT a.source AS set_a, b.source AS set_b, a.k AS size_a, b.k AS size_b, u, (SELECT COUNT(*) FROM st x JOIN st y ON x.target = y.target WHERE x.source = a.source AND y.source = b.source) AS x FROM sz a JOIN sz b ON a.source < b.source, un"""
    ),
)
def l7(spark, sf):
    out = e.set_overlap(supplier_sets(spark, sf), b.table(spark, sf, "part").count())
    return r(r(out, "jaccard", "overlap_coefficient", places=9), "expected", "fold_enrichment", "p", "fdr")


@query(
    "l7_set_overlap_families",
    with_sql("net") + ", " + SETS + ", " + overlap_sql(
        """SELECT a.source AS set_a, b.source AS set_b, a.k AS size_a, b.k AS size_b, u, (SELECT COUNT(*) FROM st x JOIN net y ON x.target = y.target WHERE x.source = a.source AND y.source = b.source) AS x FROM sz a CROSS JOIN (SELECT source, COUNT(*) AS k FROM net GROUP BY 1) b, un"""
    ),
)
def l7_families(spark, sf):
    out = e.set_overlap(supplier_sets(spark, sf), b.table(spark, sf, "part").count(), b.net(spark, sf))
    return r(r(out, "jaccard", "overlap_coefficient", places=9), "expected", "fold_enrichment", "p", "fdr")


@query(
    "l8_exclusive_combinations",
    "WITH " + SETS + ", c AS (SELECT target, string_agg(source, '&' ORDER BY source) AS combination, COUNT(*) AS degree FROM st GROUP BY 1) SELECT combination, degree, COUNT(*) AS size FROM c GROUP BY 1, 2",
)
def l8(spark, sf):
    return e.exclusive_combinations(supplier_sets(spark, sf))


@query(
    "l8_membership_matrix",
    "WITH s AS (SELECT DISTINCT l_returnflag AS f, CAST(l_partkey AS VARCHAR) AS target FROM lineitem WHERE l_quantity >= 48) SELECT target, COUNT(*) FILTER (f = 'A') > 0 AS \"A\", COUNT(*) FILTER (f = 'N') > 0 AS \"N\", COUNT(*) FILTER (f = 'R') > 0 AS \"R\" FROM s GROUP BY 1",
)
def l8_matrix(spark, sf):
    li = b.table(spark, sf, "lineitem").filter(F.col("l_quantity") >= 48)
    return e.membership_matrix(li.select(F.col("l_returnflag").alias("source"), F.col("l_partkey").cast("string").alias("target")))


@query(
    "l9_set_sizes",
    with_sql("genes") + ", " + SETS + """, h AS (SELECT target, COUNT(*) AS h FROM st GROUP BY 1) SELECT source, COUNT(*) AS size, COUNT(*) FILTER (h = 1) AS n_exclusive, COUNT(*) FILTER (target NOT IN (SELECT gene FROM genes WHERE type <> 'PROMO')) AS n_outside_universe FROM st JOIN h USING (target) GROUP BY 1""",
)
def l9(spark, sf):
    return e.set_sizes(supplier_sets(spark, sf), b.genes(spark, sf).filter(F.col("type") != "PROMO"))


@query(
    "l9_cross_membership",
    with_sql("net") + ", " + SETS + """, k AS (SELECT x.source AS a, y.source AS c, COUNT(*) AS n FROM st x JOIN net y USING (target) GROUP BY 1, 2)
    SELECT a AS "left", c AS "right", n AS n_shared, round(n / sz.k, 9) AS fraction_of_left, round(n / z.k, 9) AS fraction_of_right FROM k JOIN sz ON sz.source = a JOIN (SELECT source, COUNT(*) AS k FROM net GROUP BY 1) z ON z.source = c""",
)
def l9_cross(spark, sf):
    return r(e.cross_membership(supplier_sets(spark, sf), b.net(spark, sf)), "fraction_of_left", "fraction_of_right", places=9)


@query(
    "l10_selection_overlap",
    with_sql("genes")
    + """, ra AS (SELECT gene FROM genes WHERE type IN ('PROMO', 'ECONOMY', 'SMALL')), rb AS (SELECT gene FROM genes WHERE type IN ('ECONOMY', 'SMALL', 'LARGE')), sa AS (SELECT gene FROM ra JOIN part ON gene = CAST(p_partkey AS VARCHAR) WHERE p_size <= 25), sb AS (SELECT gene FROM rb JOIN part ON gene = CAST(p_partkey AS VARCHAR) WHERE p_size > 10),
    sh AS (SELECT gene FROM ra JOIN rb USING (gene)), c AS (SELECT (SELECT COUNT(*) FROM sh) AS s, (SELECT COUNT(*) FROM sh JOIN sa USING (gene)) AS a, (SELECT COUNT(*) FROM sh JOIN sb USING (gene)) AS k, (SELECT COUNT(*) FROM sa JOIN sb USING (gene)) AS x)
    SELECT s AS shared_reference, a AS captured_a, k AS captured_b, x AS intersection, round(a * k / s, 6) AS expected, round(x / (a * k / s), 6) AS fold FROM c""",
)
def l10(spark, sf):
    p = b.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("target"), "p_type", "p_size")
    ra, rb = p.filter(F.col("p_type").isin("PROMO", "ECONOMY", "SMALL")), p.filter(F.col("p_type").isin("ECONOMY", "SMALL", "LARGE"))
    return r(e.selection_overlap(ra.filter("p_size <= 25"), rb.filter("p_size > 10"), ra, rb), "expected", "fold")


@query(
    "l11_select_top_bottom",
    "WITH " + DE + """, k AS (SELECT gene, lfc, row_number() OVER (ORDER BY lfc, gene) AS a, row_number() OVER (ORDER BY lfc DESC, gene DESC) AS c FROM dp WHERE lfc IS NOT NULL) SELECT gene, round(lfc, 6) AS "logFC" FROM k WHERE a <= 10 OR c <= 10""",
)
def l11(spark, sf):
    de = de_table(spark, sf).filter(F.col("logFC").isNotNull()).select("gene", "logFC")
    return r(e.select_top_bottom(de, "logFC", "gene", 10), "logFC")


@query(
    "l11_top_genes",
    with_sql("genes", extra=DE)
    + """, k AS (SELECT gene, type, lfc, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction, row_number() OVER (PARTITION BY type, lfc > 0 ORDER BY abs(lfc) DESC, gene) AS rank FROM dp JOIN genes USING (gene) WHERE p < 0.05 AND lfc <> 0) SELECT gene, type, direction, rank FROM k WHERE rank <= 5""",
)
def l11_top(spark, sf):
    de = de_table(spark, sf).join(b.genes(spark, sf).select("gene", "type"), "gene")
    return e.top_genes(de, 5, ["type"]).select("gene", "type", "direction", "rank")


# --- communication -----------------------------------------------------------------------


def resource(spark, sf):
    """Each brand signals to the next number; every fifth ligand is a complex with the brand after."""
    k = F.regexp_extract("p_brand", "(\\d+)", 1).cast("int")
    p = b.table(spark, sf, "part").select("p_brand", k.alias("k")).distinct()
    nxt = F.concat(F.lit("Brand#"), (F.col("k") % 25 + 1).cast("string"))
    after = F.concat(F.lit("Brand#"), ((F.col("k") + 1) % 25 + 1).cast("string"))
    return p.select(F.when(F.col("k") % 5 == 0, F.concat_ws("_", "p_brand", after)).otherwise(F.col("p_brand")).alias("ligand"), nxt.alias("receptor"))


def order_layer(spark, sf):
    return normalize.log1p_cp10k(b.brand_counts(spark, sf))


LR_SQL = with_sql(
    "brandc", "cells",
    extra="""bt AS (SELECT cell, SUM(value) AS t FROM brandc GROUP BY 1), bl AS (SELECT cell, gene, ln(1 + value * 10000.0 / t) AS value FROM brandc JOIN bt USING (cell)),
    sz AS (SELECT donor, cell_type, COUNT(*) AS nc FROM cells GROUP BY 1, 2 HAVING COUNT(*) >= 5), sn AS (SELECT donor, SUM(nc) AS tot FROM sz GROUP BY 1),
    gs AS (SELECT donor, cell_type, gene, SUM(value) / nc AS mean, COUNT(*) FILTER (value > 0) / nc AS fr, nc FROM bl JOIN cells USING (cell) JOIN sz USING (donor, cell_type) GROUP BY 1, 2, 3, nc),
    gt AS (SELECT donor, gene, SUM(mean * nc) AS s FROM gs GROUP BY 1, 2), gf AS (SELECT gs.*, log2(mean + 1e-9) - log2(COALESCE((s - mean * nc) / (tot - nc), 0) + 1e-9) AS fc FROM gs JOIN gt USING (donor, gene) JOIN sn USING (donor)),
    bk AS (SELECT DISTINCT p_brand AS br, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS k FROM part),
    res AS (SELECT br, CASE WHEN k % 5 = 0 THEN concat('Brand#', (k + 1) % 25 + 1) END AS br2, CASE WHEN k % 5 = 0 THEN concat(br, '_Brand#', (k + 1) % 25 + 1) ELSE br END AS ligand, concat('Brand#', k % 25 + 1) AS receptor FROM bk),
    lg AS (SELECT ligand, receptor, a.donor, a.cell_type, LEAST(a.mean, c.mean) AS mean, LEAST(a.fr, c.fr) AS fr, LEAST(a.fc, c.fc) AS fc FROM res JOIN gf a ON a.gene = br LEFT JOIN gf c ON c.gene = br2 AND c.donor = a.donor AND c.cell_type = a.cell_type WHERE br2 IS NULL OR c.gene IS NOT NULL),
    lr AS (SELECT lg.donor, lg.cell_type AS source, r.cell_type AS target, ligand, receptor, lg.mean AS lm, r.mean AS rm, lg.fr AS lf, r.fr AS rf, lg.mean * r.mean AS magnitude, (lg.fc + r.fc) / 2 AS specificity FROM lg JOIN gf r ON r.gene = receptor AND r.donor = lg.donor WHERE lg.fr >= 0.1 AND r.fr >= 0.1)""",
)


def lr_table(spark, sf):
    return m.lr_scores(order_layer(spark, sf), b.cells(spark, sf), resource(spark, sf), "donor", "cell_type")


@query(
    "m1_lr_scores",
    LR_SQL + "SELECT donor, source, target, ligand, receptor, round(lm, 6) AS ligand_mean, round(rm, 6) AS receptor_mean, round(lf, 6) AS ligand_fraction, round(rf, 6) AS receptor_fraction, round(magnitude, 6) AS magnitude, round(specificity, 5) AS specificity FROM lr",
)
def m1(spark, sf):
    out = lr_table(spark, sf)
    return r(r(out, "ligand_mean", "receptor_mean", "ligand_fraction", "receptor_fraction", "magnitude"), "specificity", places=5)


def _rank_sql(c: str) -> str:
    return f"(rank() OVER (PARTITION BY donor ORDER BY {c} DESC) + (COUNT(*) OVER (PARTITION BY donor, {c}) - 1) / 2.0) / COUNT(*) OVER (PARTITION BY donor)"


RANKED_SQL = LR_SQL + f", lk AS (SELECT *, ({_rank_sql('magnitude')} + {_rank_sql('specificity')}) / 2 AS mr FROM lr) "


@query("m1_rank_aggregate", RANKED_SQL + "SELECT donor, source, target, ligand, receptor, round(mr, 6) AS magnitude_rank FROM lk")
def m1_rank(spark, sf):
    out = m.rank_aggregate(lr_table(spark, sf), "donor")
    return r(out.select("donor", "source", "target", "ligand", "receptor", "magnitude_rank"), "magnitude_rank")


@query("m2_lr_to_canonical", RANKED_SQL + "SELECT source, target, ligand, receptor, round(1 - mr, 6) AS weight, donor AS sample FROM lk")
def m2(spark, sf):
    return r(m.lr_to_canonical(m.rank_aggregate(lr_table(spark, sf), "donor"), "donor"), "weight")


def trade(spark, sf):
    """Canonical channels from the trade between nations: sender sells, receiver buys."""
    li = b.table(spark, sf, "lineitem")
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    c = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    p = b.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    name = lambda k: F.concat(F.lit("n"), F.col(k).cast("string"))
    return (
        li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey").join(p, "l_partkey")
        .groupBy(name("s_nationkey").alias("source"), name("c_nationkey").alias("target"), F.col("p_type").alias("ligand"), F.col("l_returnflag").alias("receptor"), F.col("o_orderstatus").alias("sample"))
        .agg(F.avg("l_discount").alias("d"))
        .withColumn("magnitude_rank", F.round(F.col("d") * 10, 6))
        .drop("d")
    )


TRADE = """tr AS (SELECT concat('n', s_nationkey) AS source, concat('n', c_nationkey) AS target, p_type AS ligand, l_returnflag AS receptor, o_orderstatus AS sample, 1 - round(AVG(l_discount) * 10, 6) AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4, 5)"""


def canonical(spark, sf):
    return m.lr_to_canonical(trade(spark, sf))


@query("m2_canonical_channels", "WITH " + TRADE + " SELECT source, target, ligand, receptor, round(weight, 6) AS weight, sample FROM tr")
def m2_trade(spark, sf):
    return r(canonical(spark, sf), "weight")


def target_weights(spark, sf):
    """Ligand × target weights: how strongly each brand's customers buy each part type and size."""
    p = b.table(spark, sf, "part")
    return p.groupBy(F.col("p_brand").alias("ligand"), F.concat_ws("/", "p_type", "p_size").alias("gene")).agg(F.sum("p_retailprice").alias("weight"))


@query(
    "m3_ligand_activity",
    """WITH t AS (SELECT p_brand AS ligand, concat(p_type, '/', p_size) AS gene, SUM(p_retailprice) AS w FROM part GROUP BY 1, 2), bg AS (SELECT DISTINCT gene FROM t), y AS (SELECT gene, (gene LIKE 'PROMO/%')::INT AS y FROM bg),
    g AS (SELECT l.ligand, y.gene, COALESCE(w, 0) AS w, y FROM (SELECT DISTINCT ligand FROM t) l CROSS JOIN y LEFT JOIN t ON t.ligand = l.ligand AND t.gene = y.gene),
    c AS (SELECT ligand, w, SUM(y) AS p, COUNT(*) AS m FROM g GROUP BY 1, 2), d AS (SELECT *, SUM(p) OVER (PARTITION BY ligand ORDER BY w DESC) AS tp, SUM(m) OVER (PARTITION BY ligand ORDER BY w DESC) AS al FROM c),
    a AS (SELECT ligand, SUM(p * tp / al) / (SELECT SUM(y) FROM y) AS aupr FROM d GROUP BY 1) SELECT ligand, round(corr(w, y), 6) AS pearson, round(ANY_VALUE(aupr), 6) AS aupr FROM g JOIN a USING (ligand) GROUP BY 1""",
)
def m3(spark, sf):
    t = target_weights(spark, sf)
    bg = t.select("gene").distinct()
    return r(m.ligand_activity(t, bg.filter(F.col("gene").startswith("PROMO/")), bg), "pearson", "aupr")


EXPRESSED_SQL = """, sz AS (SELECT cell_type AS g, COUNT(*) AS n FROM dcells GROUP BY 1), ex AS (SELECT g AS "group", gene, COUNT(*) / n AS fraction FROM dense JOIN dcells USING (cell) JOIN sz ON g = cell_type WHERE value > 0 GROUP BY g, gene, n HAVING COUNT(*) / n >= 0.8)"""


def expressed(spark, sf):
    return m.expressed_genes(b.dense_counts(spark, sf), b.dense_cells(spark, sf), "cell_type", 0.8)


@query("m3_expressed_genes", with_sql("dense", "dcells").rstrip() + EXPRESSED_SQL + ' SELECT "group", gene, round(fraction, 6) AS fraction FROM ex')
def m3_expressed(spark, sf):
    return r(expressed(spark, sf), "fraction")


@query(
    "m3_potential_ligands",
    with_sql("dense", "dcells").rstrip()
    + EXPRESSED_SQL
    + """, lr AS (SELECT DISTINCT a.p_brand AS ligand, c.p_brand AS receptor FROM part a JOIN part c ON c.p_partkey = a.p_partkey + 1 WHERE a.p_size < 9)
    SELECT DISTINCT ligand FROM lr WHERE ligand IN (SELECT gene FROM ex WHERE "group" IN ('BUILDING', 'MACHINERY')) AND receptor IN (SELECT gene FROM ex WHERE "group" = 'FURNITURE')""",
)
def m3_potential(spark, sf):
    p = b.table(spark, sf, "part")
    follow = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_brand").alias("receptor"))
    pairs = p.filter("p_size < 9").join(follow, "p_partkey").select(F.col("p_brand").alias("ligand"), "receptor").distinct()
    return m.potential_ligands(pairs, expressed(spark, sf), ["BUILDING", "MACHINERY"], "FURNITURE")


@query(
    "m3_top_targets",
    """WITH t AS (SELECT p_brand AS ligand, concat(p_type, '/', p_size) AS gene, SUM(p_retailprice) AS weight FROM part GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY ligand ORDER BY round(weight, 4) DESC, gene) AS rank FROM t WHERE gene LIKE 'PROMO/%') SELECT ligand, gene, round(weight, 4) AS weight, rank FROM k WHERE rank <= 5""",
)
def m3_targets(spark, sf):
    t = target_weights(spark, sf).withColumn("weight", F.round("weight", 4))
    return m.top_targets(t, t.select("gene").distinct().filter(F.col("gene").startswith("PROMO/")), 5)


@query(
    "m3_receiver_genes",
    "WITH " + DE + ", k AS (SELECT gene, row_number() OVER (ORDER BY abs(lfc) DESC, gene) AS rn FROM dp WHERE p < 0.05 AND lfc > 0) SELECT gene FROM k WHERE rn <= 200",
)
def m3_receiver(spark, sf):
    return m.receiver_genes(de_table(spark, sf))


@query(
    "m4_attribute_senders",
    "WITH " + TRADE + """, x AS (SELECT DISTINCT ligand, source AS sender FROM tr WHERE weight > 0.8 AND source <> 'n0')
    SELECT source, target, ligand, receptor, round(weight, 6) AS weight, sample FROM tr WHERE source <> 'n0' UNION ALL SELECT sender, target, tr.ligand, receptor, round(weight, 6), sample FROM tr JOIN x ON x.ligand = tr.ligand WHERE source = 'n0'""",
)
def m4(spark, sf):
    lr = canonical(spark, sf)
    expressing = lr.filter((F.round("weight", 6) > 0.8) & (F.col("source") != "n0")).select("ligand", F.col("source").alias("sender"))
    return r(m.attribute_senders(lr, expressing, "n0"), "weight")


@query(
    "m5_communication_pairing",
    with_sql("cells")
    + """, s AS (SELECT sample, donor, condition, LEAST(COUNT(*) FILTER (cell_type = 'BUILDING'), COUNT(*) FILTER (cell_type = 'MACHINERY'), COUNT(*) FILTER (cell_type = 'FURNITURE')) AS m FROM cells GROUP BY 1, 2, 3),
    d AS (SELECT donor, bool_or(condition = 'F') AND bool_or(condition = 'O') AS ok FROM s WHERE m >= 30 GROUP BY 1)
    SELECT sample, donor, condition, m AS min_cells, m >= 30 AS enough_cells, m >= 30 AND COALESCE(ok, FALSE) AND condition IN ('F', 'O') AS included FROM s LEFT JOIN d USING (donor)""",
)
def m5(spark, sf):
    return m.communication_pairing(b.cells(spark, sf), "sample", "donor", "condition", "cell_type", ["BUILDING", "MACHINERY", "FURNITURE"], "F", "O", 30)


@query(
    "m6_communication_tensor_outer",
    "WITH " + TRADE + ", k AS (SELECT DISTINCT ligand, receptor, source, target FROM tr) SELECT k.*, s.sample, round(COALESCE(weight, 0), 6) AS value FROM k CROSS JOIN (SELECT DISTINCT sample FROM tr) s LEFT JOIN tr USING (ligand, receptor, source, target, sample)",
)
def m6(spark, sf):
    return r(m.communication_tensor(canonical(spark, sf)), "value")


@query(
    "m6_communication_tensor_inner",
    "WITH " + TRADE + ", k AS (SELECT ligand, receptor, source, target FROM tr GROUP BY 1, 2, 3, 4 HAVING COUNT(*) = 3) SELECT ligand, receptor, source, target, sample, round(weight, 6) AS value FROM tr JOIN k USING (ligand, receptor, source, target)",
)
def m6_inner(spark, sf):
    return r(m.communication_tensor(canonical(spark, sf), "inner"), "value")


@query("m7_cci_edges", "WITH " + TRADE + " SELECT source AS src, target AS dst, round(SUM(weight), 6) AS weight FROM tr GROUP BY 1, 2")
def m7(spark, sf):
    return r(m.cci_edges(canonical(spark, sf)), "weight")


@query("m7_gci_edges", "WITH " + TRADE + " SELECT concat(source, '/', ligand, '|L') AS src, concat(target, '/', receptor, '|R') AS dst, round(SUM(weight), 6) AS weight FROM tr GROUP BY 1, 2")
def m7_gci(spark, sf):
    return r(m.gci_edges(canonical(spark, sf)), "weight")


ARMS_SQL = """a AS (SELECT source, target, ligand, receptor, weight AS x FROM tr WHERE sample = 'F'), k AS (SELECT source, target, ligand, receptor, weight AS y FROM tr WHERE sample = 'O'),
    df AS (SELECT source, target, ligand, receptor, COALESCE(x, 0) - COALESCE(y, 0) AS weight FROM a FULL JOIN k USING (source, target, ligand, receptor))"""


@query("m8_differential_network", "WITH " + TRADE + ", " + ARMS_SQL + " SELECT source, target, ligand, receptor, round(weight, 6) AS weight FROM df WHERE abs(weight) > 1e-12")
def m8(spark, sf):
    lr = canonical(spark, sf)
    samples = lr.select("sample").distinct().withColumn("condition", F.col("sample"))
    case, control = m.split_arms(lr, samples, "condition", "F", "O")
    out = m.differential_network(case, control).filter(F.abs("weight") > 1e-12)
    return r(out, "weight")


def pagerank_sql(edges: str, prefix: str = "") -> str:
    """CTEs ending in ``{prefix}pr(node, r)`` for the edge CTE ``edges(src, dst, weight)``."""
    x = prefix
    return f"""{x}nd AS (SELECT src AS node FROM {edges} UNION SELECT dst FROM {edges}), {x}lk AS (SELECT src, dst, weight / SUM(weight) OVER (PARTITION BY src) AS p FROM {edges} UNION ALL SELECT node, node, 0.0 FROM {x}nd),
    {x}it AS (SELECT 0 AS i, node, 1.0 / (SELECT COUNT(*) FROM {x}nd) AS r FROM {x}nd UNION ALL SELECT i + 1, dst, 0.15 / (SELECT COUNT(*) FROM {x}nd) + 0.85 * SUM(p * r) FROM {x}it JOIN {x}lk ON src = node WHERE i < 120 GROUP BY i, dst),
    {x}pr AS (SELECT node, r / SUM(r) OVER () AS r FROM {x}it WHERE i = 120)"""


DEG = "dg AS (SELECT node, SUM(a) AS i, SUM(c) AS o FROM (SELECT dst AS node, weight AS a, 0 AS c FROM {0} UNION ALL SELECT src, 0, weight FROM {0}) GROUP BY 1)"


@query(
    "m9_topology",
    "WITH RECURSIVE " + TRADE + ", ed AS (SELECT source AS src, target AS dst, SUM(weight) AS weight FROM tr GROUP BY 1, 2), " + pagerank_sql("ed") + ", " + DEG.format("ed")
    + """ SELECT node, round(i, 6) AS "Listener", round(o, 6) AS "Influencer", round(r, 6) AS "Pagerank" FROM dg JOIN pr USING (node)""",
)
def m9(spark, sf):
    return r(m.topology(m.cci_edges(canonical(spark, sf))), "Listener", "Influencer", "Pagerank")


@query(
    "m9_topology_difference",
    "WITH RECURSIVE " + TRADE + """, ca AS (SELECT source AS src, target AS dst, SUM(weight) AS weight FROM tr WHERE sample = 'F' GROUP BY 1, 2), co AS (SELECT source AS src, target AS dst, SUM(weight) AS weight FROM tr WHERE sample = 'O' GROUP BY 1, 2),
    df AS (SELECT src, dst, COALESCE(ca.weight, 0) - COALESCE(co.weight, 0) AS weight FROM ca FULL JOIN co USING (src, dst)), """ + pagerank_sql("ca", "a_") + ", " + pagerank_sql("co", "b_") + ", " + DEG.format("df")
    + """ SELECT node, round(COALESCE(i, 0), 6) AS "Listener", round(COALESCE(o, 0), 6) AS "Influencer", round(ln((COALESCE(a_pr.r, 0) + 0.01) / (COALESCE(b_pr.r, 0) + 0.01)), 6) AS "Pagerank" FROM dg FULL JOIN a_pr USING (node) FULL JOIN b_pr USING (node)""",
)
def m9_diff(spark, sf):
    lr = materialise(canonical(spark, sf))
    out = m.topology_difference(m.cci_edges(lr.filter("sample = 'F'")), m.cci_edges(lr.filter("sample = 'O'")))
    return r(out, "Listener", "Influencer", "Pagerank")


@query(
    "m10_sparsify_top_k",
    "WITH " + TRADE + """, ed AS (SELECT source AS src, target AS dst, round(SUM(weight), 6) AS weight FROM tr GROUP BY 1, 2), st AS (SELECT src AS node, * FROM ed UNION ALL SELECT dst, * FROM ed),
    k AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, src, dst) AS rn FROM st) SELECT DISTINCT src, dst, weight FROM k WHERE rn <= 3""",
)
def m10(spark, sf):
    return m.sparsify_top_k(r(m.cci_edges(canonical(spark, sf)), "weight"), 3)


# --- gene networks -----------------------------------------------------------------------

GRID = LOG_SQL + """, gr AS (SELECT d.cell, x.gene, COALESCE(value, 0) AS v FROM dcells d CROSS JOIN (SELECT DISTINCT p_brand AS gene FROM part) x LEFT JOIN ll ON ll.cell = d.cell AND ll.gene = x.gene),
    co AS (SELECT a.gene AS g1, c.gene AS g2, corr(a.v, c.v) AS r FROM gr a JOIN gr c ON a.cell = c.cell GROUP BY 1, 2)"""


def brands(spark, sf):
    return bounded_levels(b.table(spark, sf, "part"), "p_brand")


def correlations(spark, sf):
    return n.gene_correlation(lognorm(spark, sf), b.dense_cells(spark, sf).count(), brands(spark, sf))


@query("n1_gene_correlation", with_sql("dense", "dcells", extra=GRID) + "SELECT g1 AS \"left\", g2 AS gene, round(r, 6) AS r FROM co")
def n1(spark, sf):
    return r(correlations(spark, sf), "r")


@query(
    "n1_topological_overlap",
    with_sql("dense", "dcells", extra=GRID)
    + """, ad AS (SELECT g1, g2, CASE WHEN g1 = g2 THEN 0 ELSE pow(abs(r), 2) END AS a FROM co), kk AS (SELECT g1, SUM(a) AS k FROM ad GROUP BY 1), sh AS (SELECT x.g1, y.g2, SUM(x.a * y.a) AS s FROM ad x JOIN ad y ON x.g2 = y.g1 GROUP BY 1, 2)
    SELECT ad.g1 AS gene1, ad.g2 AS gene2, round(a, 9) AS adjacency, round((s + a) / (LEAST(p.k, q.k) + 1 - a), 9) AS tom FROM ad JOIN sh ON ad.g1 = sh.g1 AND ad.g2 = sh.g2 JOIN kk p ON p.g1 = ad.g1 JOIN kk q ON q.g1 = ad.g2 WHERE ad.g1 < ad.g2""",
)
def n1_tom(spark, sf):
    return r(n.topological_overlap(correlations(spark, sf), brands(spark, sf), 2.0), "adjacency", "tom", places=9)


def brand_modules(spark, sf):
    return last_digit_sets(spark, sf).select(F.col("target").alias("gene"), F.col("source").alias("module"))


KME = GRID + """, md AS (SELECT DISTINCT p_brand AS gene, concat('set', right(p_brand, 1)) AS module FROM part), ms AS (SELECT gene, AVG(v) AS mu, stddev_pop(v) AS sd FROM gr GROUP BY 1),
    eg AS (SELECT cell, module, AVG((v - mu) / sd) AS e FROM gr JOIN ms USING (gene) JOIN md USING (gene) GROUP BY 1, 2)"""


@query(
    "n1_module_membership",
    with_sql("dense", "dcells", extra=KME) + "SELECT gene, module, round(corr(v, e), 6) AS kme FROM gr JOIN md USING (gene) JOIN eg USING (cell, module) GROUP BY 1, 2",
)
def n1_kme(spark, sf):
    return r(n.kme(lognorm(spark, sf), b.dense_cells(spark, sf), brand_modules(spark, sf)), "kme")


@query(
    "n1_module_trait_correlation",
    with_sql("dense", "dcells", extra=KME) + "SELECT module, round(corr(e, balance), 6) AS r FROM eg JOIN dcells USING (cell) GROUP BY 1",
)
def n1_trait(spark, sf):
    return r(n.module_trait_correlation(lognorm(spark, sf), b.dense_cells(spark, sf), brand_modules(spark, sf), "balance"), "r")


@query("n1_coexpression_modules", "SELECT unnest(['no_move_gains', 'clusters_connected', 'modularity_not_below']) AS \"check\", true AS passed")
def n1_modules(spark, sf):
    """What modules of the overlap graph must hold whatever they are, and that they are no worse than the brand sets."""
    tom = materialise(n.topological_overlap(correlations(spark, sf), brands(spark, sf), 2.0), "overlap")
    modules = materialise(n.coexpression_modules(tom, min_size=1).select(F.col("gene").alias("cell"), F.col("module").alias("cluster")), "modules")
    rival = brand_modules(spark, sf).select(F.col("gene").alias("cell"), F.col("module").alias("cluster"))
    return certificate(n.overlap_graph(tom), modules, rival)


# the correlation matrix of a module squared again and again, at trace one, becomes the projection on its first component
FIRST = KME + """, sq AS (SELECT 0 AS step, x.module, c.g1, c.g2, c.r AS v FROM co c JOIN md x ON x.gene = c.g1 JOIN md y ON y.gene = c.g2 AND y.module = x.module
      UNION ALL (SELECT step + 1, module, g1, g2, v / SUM(CASE WHEN g1 = g2 THEN v END) OVER (PARTITION BY module) FROM (
        SELECT a.step, a.module, a.g1, c.g2, SUM(a.v * c.v) AS v FROM sq a JOIN sq c ON a.module = c.module AND a.g2 = c.g1 WHERE a.step < 15 GROUP BY 1, 2, 3, 4))),
    fin AS (SELECT * FROM sq WHERE step = 15), piv AS (SELECT module, max_by(g1, v) AS j FROM fin WHERE g1 = g2 GROUP BY 1),
    raw AS (SELECT f.module, f.g1 AS gene, f.v / sqrt(d.v) AS w FROM fin f JOIN piv USING (module) JOIN fin d ON d.module = f.module AND d.g1 = j AND d.g2 = j WHERE f.g2 = j),
    wt AS (SELECT module, gene, w * CASE WHEN SUM(w) OVER (PARTITION BY module) < 0 THEN -1 ELSE 1 END AS w FROM raw),
    ev AS (SELECT module, SUM(f.v * c.r) AS eigenvalue FROM fin f JOIN co c ON c.g1 = f.g1 AND c.g2 = f.g2 GROUP BY 1),
    pc AS (SELECT cell, module, SUM(w * (v - mu) / sd) AS e FROM gr JOIN ms USING (gene) JOIN wt USING (gene) GROUP BY 1, 2)"""


def first_sql(select):
    return with_sql("dense", "dcells", extra=FIRST).replace("WITH ", "WITH RECURSIVE ", 1) + select


def brand_components(spark, sf):
    return materialise(n.first_components(correlations(spark, sf), brand_modules(spark, sf), 1e-9), "components")


@query("n1_module_components", first_sql("SELECT module, gene, round(w, 4) AS weight, round(eigenvalue, 6) AS eigenvalue, true AS settled FROM wt JOIN ev USING (module)"))
def n1_components(spark, sf):
    found = brand_components(spark, sf).withColumn("settled", F.col("residual") <= 1e-9 * F.col("eigenvalue"))
    return r(r(found.select("module", "gene", "weight", "eigenvalue", "settled"), "weight", places=4), "eigenvalue")


@query("n1_eigengene_kme", first_sql("SELECT gene, module, round(corr(v, e), 4) AS kme FROM gr JOIN md USING (gene) JOIN pc USING (cell, module) GROUP BY 1, 2"))
def n1_eigengene_kme(spark, sf):
    layer, cells = materialise(lognorm(spark, sf), "layer"), b.dense_cells(spark, sf)
    eigen = n.eigengenes(layer, cells, brand_components(spark, sf))
    return r(n.kme(layer, cells, brand_modules(spark, sf), eigen), "kme", places=4)


@query("n1_eigengene_trait", first_sql("SELECT module, round(corr(e, balance), 4) AS r FROM pc JOIN dcells USING (cell) GROUP BY 1"))
def n1_eigengene_trait(spark, sf):
    layer, cells = lognorm(spark, sf), b.dense_cells(spark, sf)
    eigen = n.eigengenes(layer, cells, brand_components(spark, sf))
    return r(n.module_trait_correlation(layer, cells, brand_modules(spark, sf), "balance", eigen), "r", places=4)


def part_modules(spark, sf):
    return b.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("gene"), F.when(F.col("p_brand") == "Brand#25", "grey").otherwise(F.col("p_brand")).alias("module"), (F.col("p_size") / 50.0).alias("kme"))


@query(
    "n2_module_graph",
    """WITH h AS (SELECT CAST(p_partkey AS VARCHAR) AS gene, p_brand AS module, p_size / 50.0 AS kme, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, CAST(p_partkey AS VARCHAR)) AS rn FROM part WHERE p_brand <> 'Brand#25')
    SELECT a.module, a.gene AS gene1, c.gene AS gene2, round(LEAST(a.kme, c.kme)::DOUBLE, 6) AS weight FROM h a JOIN h c ON a.module = c.module AND a.rn < c.rn WHERE a.rn <= 8 AND c.rn <= 8""",
)
def n2(spark, sf):
    return r(n.module_graph(part_modules(spark, sf), 8), "weight")


def chain_edges(spark, sf):
    """Edges between successive parts, weighted by their sizes."""
    p = b.table(spark, sf, "part").select("p_partkey", "p_size")
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_size").alias("s2"))
    return p.join(q, "p_partkey").select(F.col("p_partkey").cast("string").alias("gene1"), (F.col("p_partkey") + 1).cast("string").alias("gene2"), ((F.col("p_size") + F.col("s2")) / 100.0).alias("weight"))


CHAIN = "ch AS (SELECT CAST(a.p_partkey AS VARCHAR) AS gene1, CAST(c.p_partkey AS VARCHAR) AS gene2, (a.p_size + c.p_size) / 100.0 AS weight, a.p_type AS m1, c.p_type AS m2 FROM part a JOIN part c ON c.p_partkey = a.p_partkey + 1)"


@query(
    "n3_cap_edges",
    "WITH " + CHAIN + """, x AS (SELECT *, CASE WHEN m1 = m2 THEN m1 END AS u, row_number() OVER (PARTITION BY CASE WHEN m1 = m2 THEN m1 END ORDER BY weight DESC, gene1, gene2) AS rn FROM ch),
    y AS (SELECT *, rn <= CASE WHEN u IS NULL THEN 50 ELSE 11 END AS sure FROM x), z AS (SELECT *, row_number() OVER (ORDER BY sure DESC, weight DESC, gene1, gene2) AS q FROM y) SELECT gene1, gene2, round(weight::DOUBLE, 6) AS weight FROM z WHERE q <= 200""",
)
def n3(spark, sf):
    modules = b.genes(spark, sf).select("gene", F.col("type").alias("module"))
    return r(n.cap_edges(chain_edges(spark, sf), modules, 200), "weight")


@query(
    "n4_detection_log_dor",
    with_sql("dense", "dcells")
    + """, sz AS (SELECT cell_type, COUNT(*) AS ng FROM dcells GROUP BY 1), tp AS (SELECT gene, cell_type, COUNT(*) AS tp FROM dense JOIN dcells USING (cell) WHERE value > 0 GROUP BY 1, 2), tt AS (SELECT gene, SUM(tp) AS t FROM tp GROUP BY 1),
    g AS (SELECT tt.gene, sz.cell_type, COALESCE(tp, 0) AS tp, t, ng, (SELECT COUNT(*) FROM dcells) AS n FROM tt CROSS JOIN sz LEFT JOIN tp ON tp.gene = tt.gene AND tp.cell_type = sz.cell_type)
    SELECT gene, cell_type AS "group", round(ln(((tp + 0.5) / (t - tp + 0.5)) / ((ng - tp + 0.5) / (n - ng - (t - tp) + 0.5))), 6) AS log_dor FROM g""",
)
def n4(spark, sf):
    return r(n.detection_log_dor(b.dense_counts(spark, sf), b.dense_cells(spark, sf), "cell_type"), "log_dor")


@query(
    "n5_community_relevance",
    with_sql("counts", "cells", "genes").replace("WITH ", "WITH RECURSIVE ", 1) + ", " + CHAIN
    + """, ins AS (SELECT m1 AS c, gene1 AS src, gene2 AS dst, weight FROM ch WHERE m1 = m2), bo AS (SELECT * FROM ins UNION ALL SELECT c, dst, src, weight FROM ins), nd AS (SELECT type AS c, gene AS node FROM genes WHERE gene IN (SELECT gene1 FROM ch UNION SELECT gene2 FROM ch)), nn AS (SELECT c, COUNT(*)::DOUBLE AS n FROM nd GROUP BY 1),
    lk AS (SELECT c, src, dst, weight / SUM(weight) OVER (PARTITION BY c, src) AS p FROM bo UNION ALL SELECT c, node, node, 0.0 FROM nd),
    it AS (SELECT 0 AS i, c, node, 1.0 / n AS r FROM nd JOIN nn USING (c) UNION ALL SELECT i + 1, lk.c, dst, 0.15 / ANY_VALUE(n) + 0.85 * SUM(p * r) FROM it JOIN lk ON lk.c = it.c AND src = node JOIN nn ON nn.c = lk.c WHERE i < 120 GROUP BY i, lk.c, dst), pr AS (SELECT c, node, r / SUM(r) OVER (PARTITION BY c) AS r FROM it WHERE i = 120),
    sz AS (SELECT cell_type, COUNT(*) AS ng FROM cells GROUP BY 1), tp AS (SELECT gene, cell_type, COUNT(*) AS tp FROM counts JOIN cells USING (cell) WHERE value > 0 GROUP BY 1, 2), tt AS (SELECT gene, SUM(tp) AS t FROM tp GROUP BY 1),
    g AS (SELECT tt.gene, sz.cell_type, COALESCE(tp, 0) AS tp, t, ng, (SELECT COUNT(*) FROM cells) AS n FROM tt CROSS JOIN sz LEFT JOIN tp ON tp.gene = tt.gene AND tp.cell_type = sz.cell_type), dr AS (SELECT gene, cell_type, ln(((tp + 0.5) / (t - tp + 0.5)) / ((ng - tp + 0.5) / (n - ng - (t - tp) + 0.5))) AS d FROM g),
    sc AS (SELECT c, cell_type, SUM(r * d) AS s FROM pr JOIN dr ON gene = node GROUP BY 1, 2) SELECT c AS community, cell_type AS "group", round((s - AVG(s) OVER (PARTITION BY c)) / stddev_pop(s) OVER (PARTITION BY c), 4) AS z_score FROM sc""",
)
def n5(spark, sf):
    edges = chain_edges(spark, sf).select(F.col("gene1").alias("src"), F.col("gene2").alias("dst"), "weight")
    communities = b.genes(spark, sf).select("gene", F.col("type").alias("community"))
    dor = n.detection_log_dor(b.counts(spark, sf), b.cells(spark, sf), "cell_type")
    return r(n.community_relevance(edges, communities, dor), "z_score", places=4)


@query(
    "n6_tf_target_links",
    with_sql("dense", "dcells", extra=GRID)
    + """, k AS (SELECT g1 AS tf, g2 AS target, round(r, 9) AS r, row_number() OVER (PARTITION BY g1 ORDER BY abs(r) DESC, g2) AS rank FROM co WHERE g1 <> g2 AND right(g1, 1) = '1') SELECT tf, target, round(abs(r), 6) AS importance, sign(r)::INT AS sign, rank FROM k WHERE rank <= 6""",
)
def n6(spark, sf):
    tfs = [x for x in brands(spark, sf) if x.endswith("1")]
    return r(n.tf_target_links(lognorm(spark, sf), b.dense_cells(spark, sf).count(), tfs, 6), "importance")


@query("n6_regulon_activity")
def n6_activity(spark, sf):
    from ..operators.programs import aucell

    cells = b.dense_cells(spark, sf)
    tfs = [x for x in brands(spark, sf) if x.endswith("1")]
    reg = n.regulons(n.tf_target_links(lognorm(spark, sf), cells.count(), tfs, 10))
    return aucell(lognorm(spark, sf), cells, reg, 25, 0.4)
