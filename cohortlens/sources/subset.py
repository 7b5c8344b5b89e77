"""Choosing cells and genes, and bringing other tables onto the study's cells."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialise


def subset_cells(
    cells: DataFrame, column: str, values: Sequence[str], exclude: tuple[str, Sequence[str]] | None = None, agree: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cells whose column takes a wanted value, and the counters of each step.

    ``exclude`` removes values of another column; ``agree`` keeps only cells whose second
    label names the same value.
    """
    wanted = F.coalesce(F.col(column).isin(*values), F.lit(False))
    dropped = F.lit(False)
    if exclude:
        col, bad = exclude
        seen = {r[0] for r in cells.filter(F.col(col).isin(*bad)).select(col).distinct().collect()}
        if set(bad) - seen:
            raise ValueError(f"excluded values never occur: {sorted(set(bad) - seen)}")
        dropped = F.coalesce(F.col(col).isin(*bad), F.lit(False))
    same = F.lit(True)
    if agree:
        seen = {r[0] for r in cells.filter(F.col(agree).isin(*values)).select(agree).distinct().collect()}
        if set(values) - seen:
            raise ValueError(f"{agree} never says {sorted(set(values) - seen)}")
        same = F.coalesce(F.col(agree) == F.col(column), F.lit(False))
    stats = cells.agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(wanted).alias("n_selected"),
        F.count_if(wanted & ~same).alias("n_discordant"),
        F.count_if(wanted & same & dropped).alias("n_excluded"),
        F.count_if(wanted & same & ~dropped).alias("n_after"),
    )
    return cells.filter(wanted & same & ~dropped), stats


def restrict_counts(counts: DataFrame, cells: DataFrame) -> DataFrame:
    return counts.join(cells.select("cell"), "cell", "left_semi")


def sample_per_group(
    cells: DataFrame, group: str, caps: Mapping[str, int], seed: int = 0, gate: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Up to ``caps[group]`` cells of each listed group by hashed order, with a report.

    The rank filter keeps at most the largest cap per group on each map task.  Groups
    with fewer than ``gate`` cells give none.
    """
    spark = cells.sparkSession
    plan = spark.createDataFrame([(str(g), int(c)) for g, c in caps.items()], f"{group} string, cap int")
    sizes = cells.groupBy(group).agg(F.count(F.lit(1)).alias("available"))
    report = plan.join(sizes, group, "left").fillna(0, ["available"]).withColumn("eligible", F.col("available") >= gate).withColumn(
        "selected", F.when(F.col("eligible"), F.least("available", F.col("cap").cast("long"))).otherwise(0).cast("long")
    )
    order = W.partitionBy(group).orderBy(F.xxhash64(F.lit(seed), F.col(group), F.col("cell")), "cell")
    ranked = cells.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= max(caps.values(), default=0))
    drawn = ranked.join(report.filter("eligible").select(group, "cap"), group).filter(F.col("_r") <= F.col("cap")).drop("_r", "cap")
    return drawn, report


def missing_genes(genes: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select("gene").distinct().join(genes.select("gene"), "gene", "left_anti")


def attach_layout(cells: DataFrame, layout: DataFrame, check: bool = True) -> DataFrame:
    """Frozen display coordinates by cell; a layout that misses cells is refused."""
    if check and cells.select("cell").join(layout.select("cell"), "cell", "left_anti").limit(1).count():
        raise ValueError("the layout does not describe every cell")
    return cells.join(layout.select("cell", "x", "y"), "cell", "left")


def reconcile_splice(splice: DataFrame, cells: DataFrame, manifest: DataFrame) -> DataFrame:
    """Spliced and unspliced counts of other files on the study's cells.

    File cells look like ``stem:BARCODEx``; they become ``BARCODE-1`` and join the study
    on sample and barcode.  Of a gene listed twice in a file the first listing counts.
    ``splice`` is ``(stem, file_cell, gene, listing, layer, value)``, ``manifest`` maps
    ``stem`` to ``sample``, ``cells`` has ``cell``, ``sample``, ``barcode``.
    """
    barcode = F.concat(F.regexp_extract("file_cell", "([^:]+?)x?$", 1), F.lit("-1"))
    tagged = splice.join(manifest.select("stem", "sample").distinct(), "stem").withColumn("barcode", barcode)
    first = tagged.groupBy("stem", "gene").agg(F.min("listing").alias("listing"))
    kept = tagged.join(first, ["stem", "gene", "listing"])
    return (
        kept.join(cells.select("cell", "sample", "barcode"), ["sample", "barcode"])
        .groupBy("cell", "gene", "layer")
        .agg(F.sum("value").alias("value"))
    )


def align_genes(ref: DataFrame, query: DataFrame, names: str = "symbol", ids: str = "gene") -> DataFrame:
    """``(ref_gene, gene)`` on whichever reference column shares more genes with the query.

    Ties keep the current names; of duplicate names the first reference gene counts.
    """
    q = query.select("gene").distinct()
    by = {}
    for kind, col in (("names", names), ("ids", ids)):
        first = ref.groupBy(F.col(col).alias("gene")).agg(F.min(ids).alias("ref_gene"))
        by[kind] = materialise(first.join(q, "gene"), "aligned")
    use = "ids" if by["ids"].count() > by["names"].count() else "names"
    return by[use].select("ref_gene", "gene")


def restrict_to_variable(counts: DataFrame, genes: DataFrame, flag: str = "highly_variable", forced: Sequence[str] = (), minimum: int = 1) -> DataFrame:
    """Counts of flagged and forced genes; all genes, with a warning, when too few are flagged."""
    chosen = genes.filter(F.coalesce(F.col(flag), F.lit(False)) | F.col("gene").isin(*forced)).select("gene")
    if genes.filter(F.coalesce(F.col(flag), F.lit(False))).limit(minimum).count() < minimum:
        warnings.warn(f"fewer than {minimum} genes are flagged {flag}; all genes are kept", stacklevel=2)
        return counts
    return counts.join(chosen, "gene", "left_semi")
