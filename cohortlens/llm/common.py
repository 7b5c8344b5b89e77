"""Shared pieces: tables, word patterns, ordered prefix sums and connected components."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cohortlens.session import materialise

#: White space between words; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Hand freed memory of this worker process back to the system, so that the next task starts without it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_list(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SPACE), lambda w: w != "")


def ordered_sums(df: DataFrame, order: list[Column], value: Column, index: str, start: str) -> DataFrame:
    """Each row's position in a total order and the sum of ``value`` before it.

    Rows are range-partitioned and written once; only one count and one sum per range are
    added up across ranges, and a window runs inside each range.
    """
    spark = df.sparkSession
    ranged = df.withColumn("_v", value).repartitionByRange(partitions(spark), *order)
    ranged = materialise(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_s"))
    before = W.Window.orderBy("_range").rowsBetween(W.Window.unboundedPreceding, -1)
    # one row per range, a number set by the partition count
    heads = totals.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"),
    )
    inside = W.Window.partitionBy("_range").orderBy(*order)
    sums = inside.rowsBetween(W.Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_i", F.row_number().over(inside) - 1)
        .withColumn("_b", F.coalesce(F.sum("_v").over(sums), F.lit(0)))
        .join(F.broadcast(heads), "_range")
        .withColumn(index, (F.col("_n0") + F.col("_i")).cast("long"))
        .withColumn(start, (F.col("_s0") + F.col("_b")).cast("long"))
        .drop("_v", "_range", "_i", "_b", "_n0", "_s0")
    )


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps; its cleaner acts when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete written intermediates that no later step reads; each is a table as ``materialise`` returned it."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _neighbour_minimum(edges: DataFrame) -> DataFrame:
    """Large step: hang every larger neighbour of a vertex on the least vertex around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _smaller_minimum(edges: DataFrame) -> DataFrame:
    """Small step: hang a vertex and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component``: each linked vertex with the least vertex it reaches.

    Alternates the large and small star steps until the edge set stands still, which takes a
    logarithmic number of rounds. Minima are aggregates joined back, so a vertex with very
    many neighbours is never one task's list. Vertices without links have no row.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    edges = materialise(edges, "edges")
    seen = None
    while True:
        last, edges = edges, materialise(_smaller_minimum(_neighbour_minimum(edges)).filter("u <> v").distinct(), "edges")
        discard(last)
        # order-free digest of the edge set; one row
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).distinct()
