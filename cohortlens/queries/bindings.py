"""How the study tables are read from the order, part and embedding tables, in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse profile: cell = order, gene = part, value = summed quantity."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_partkey")
        .agg(F.sum("l_quantity").alias("value"))
        .select(
            F.col("l_orderkey").cast("string").alias("cell"),
            F.col("l_partkey").cast("string").alias("gene"),
            "value",
        )
    )


def dense_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Dense profile: cell = customer, gene = part brand."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (
        li.join(o, "l_orderkey")
        .join(p, "l_partkey")
        .groupBy("o_custkey", "p_brand")
        .agg(F.sum("l_quantity").alias("value"))
        .select(F.col("o_custkey").cast("string").alias("cell"), F.col("p_brand").alias("gene"), "value")
    )


def brand_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Order-level profile over brands: cell = order, gene = part brand."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (
        li.join(p, "l_partkey")
        .groupBy("l_orderkey", "p_brand")
        .agg(F.sum("l_quantity").alias("value"))
        .select(F.col("l_orderkey").cast("string").alias("cell"), F.col("p_brand").alias("gene"), "value")
    )


def dense_cells(spark: SparkSession, sf: str) -> DataFrame:
    """One cell per customer that has orders."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf, "customer").join(o, "c_custkey", "left_semi").select(
        F.col("c_custkey").cast("string").alias("cell"),
        F.col("c_nationkey").cast("string").alias("donor"),
        F.col("c_mktsegment").alias("cell_type"),
        F.col("c_acctbal").alias("balance"),
    )


def cells(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").cast("string").alias("cell"),
        F.concat_ws("_", F.col("c_nationkey").cast("string"), "o_orderstatus").alias("sample"),
        F.col("c_nationkey").cast("string").alias("donor"),
        F.col("o_orderstatus").alias("condition"),
        F.col("c_mktsegment").alias("cell_type"),
        F.col("o_orderpriority").alias("label2"),
        F.year("o_orderdate").cast("string").alias("library"),
        F.col("o_totalprice").alias("price"),
    )


def genes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("gene"),
        F.concat_ws("-", "p_type", "p_name").alias("symbol"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
    )


def net(spark: SparkSession, sf: str) -> DataFrame:
    """Gene sets: source = brand, target = part."""
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("source"), F.col("p_partkey").cast("string").alias("target")
    )


def embedding(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("cell"),
        F.col("embedding").alias("vec"),
        F.col("label").cast("string").alias("label"),
    )


def layers(spark: SparkSession, sf: str) -> DataFrame:
    """Spliced and unspliced layers from the line status."""
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_partkey", "l_linestatus")
        .agg(F.sum("l_quantity").alias("value"))
        .select(
            F.col("l_orderkey").cast("string").alias("cell"),
            F.col("l_partkey").cast("string").alias("gene"),
            F.when(F.col("l_linestatus") == "F", "spliced").otherwise("unspliced").alias("layer"),
            "value",
        )
    )


SQL = {
    "counts": """counts AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell, CAST(l_partkey AS VARCHAR) AS gene,
        SUM(l_quantity) AS value FROM lineitem GROUP BY 1, 2)""",
    "dense": """dense AS (SELECT CAST(o_custkey AS VARCHAR) AS cell, p_brand AS gene, SUM(l_quantity) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    "brandc": """brandc AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell, p_brand AS gene, SUM(l_quantity) AS value
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    "dcells": """dcells AS (SELECT CAST(c_custkey AS VARCHAR) AS cell, CAST(c_nationkey AS VARCHAR) AS donor,
        c_mktsegment AS cell_type, c_acctbal AS balance FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders))""",
    "cells": """cells AS (SELECT CAST(o_orderkey AS VARCHAR) AS cell,
        concat(CAST(c_nationkey AS VARCHAR), '_', o_orderstatus) AS sample,
        CAST(c_nationkey AS VARCHAR) AS donor, o_orderstatus AS condition, c_mktsegment AS cell_type,
        o_orderpriority AS label2, CAST(year(o_orderdate) AS VARCHAR) AS library, o_totalprice AS price
        FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "genes": """genes AS (SELECT CAST(p_partkey AS VARCHAR) AS gene, concat(p_type, '-', p_name) AS symbol,
        p_brand AS brand, p_type AS type FROM part)""",
    "net": "net AS (SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS target FROM part)",
    "layers": """layers AS (SELECT CAST(l_orderkey AS VARCHAR) AS cell, CAST(l_partkey AS VARCHAR) AS gene,
        CASE WHEN l_linestatus = 'F' THEN 'spliced' ELSE 'unspliced' END AS layer,
        SUM(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3)""",
    "embedding": """emb AS (SELECT CAST(vec_id AS VARCHAR) AS cell, embedding AS vec,
        CAST(label AS VARCHAR) AS label FROM embeddings)""",
    # per-cell metrics: zero-depth cells stay with zeros
    "metrics": """metrics AS (SELECT c.cell, c.sample, c.donor, c.condition, c.cell_type, c.label2, c.library, c.price,
        COALESCE(SUM(k.value), 0.0) AS total_counts,
        COUNT(CASE WHEN k.value > 0 THEN 1 END) AS n_genes_by_counts,
        COALESCE(SUM(CASE WHEN g.type = 'ECONOMY' THEN k.value END), 0.0) AS mito,
        COALESCE(SUM(CASE WHEN g.type = 'PROMO' THEN k.value END), 0.0) AS ribo,
        COALESCE(SUM(CASE WHEN regexp_matches(g.symbol, '-(red|blue) ring$') THEN k.value END), 0.0) AS hb,
        CASE WHEN COALESCE(SUM(k.value), 0) = 0 THEN 0.0 ELSE
          100.0 * (COALESCE(SUM(CASE WHEN g.type = 'ECONOMY' THEN k.value END), 0.0) / SUM(k.value)) END AS pct_mito
        FROM cells c LEFT JOIN counts k ON c.cell = k.cell LEFT JOIN genes g ON k.gene = g.gene
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)""",
}


def with_sql(*names: str, extra: str = "") -> str:
    """A WITH clause of the named study tables, optionally followed by more CTEs."""
    parts = [SQL[n] for n in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"
