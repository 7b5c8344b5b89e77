"""Text sources: Matrix-Market triplets, libraries, manifests and gene-set files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.checks import assert_counts
from ..session import materialise


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file or folder with their 1-based number in file order.

    Rows of one input split carry consecutive ids, so a line's number is its place in
    the split plus the lines of earlier splits; only the list of splits is ordered.
    """
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i")
    )
    raw = materialise(raw, "lines")
    splits = raw.groupBy("_f", "_b").agg(F.min("_i").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_f", "_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return raw.join(offsets.select("_f", "_b", "_lo", "_o"), ["_f", "_b"]).select(
        "value", (F.col("_i") - F.col("_lo") + F.col("_o") + 1).alias("line")
    )


def _check_header(lines: DataFrame, first: int | None, body: DataFrame, n_features: int, n_cells: int) -> None:
    stated = lines.filter(F.col("line") == (first or 0)).select("value").collect()
    if not stated:
        raise ValueError("the matrix file has no dimension line")
    dims = tuple(int(x) for x in stated[0].value.split()[:3])
    got = body.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(F.col("row").between(1, n_features) & F.col("col").between(1, n_cells), F.lit(False))).alias("outside")).first()
    if dims != (n_features, n_cells, got.n):
        raise ValueError(f"the matrix states {dims} rows, columns and entries; the files have {(n_features, n_cells, got.n)}")
    if got.outside:
        raise ValueError(f"{got.outside} entries lie outside the name files")


def read_mtx_counts(
    spark: SparkSession, folder: str, matrix: str = "matrix.mtx", features: str = "features.tsv", barcodes: str = "barcodes.tsv"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(counts, genes, barcodes)`` of a gene × cell coordinate file and its name files.

    The first line that is no comment states the numbers of rows, columns and entries; files that
    do not agree with it, and indices outside them, are refused. A third feature column keeps only
    gene expression.
    """
    tab = F.split("value", "\t")
    genes = numbered_lines(spark, f"{folder}/{features}").select(
        F.col("line").alias("row"), tab[0].alias("gene"), F.coalesce(F.get(tab, 1), tab[0]).alias("symbol"), F.get(tab, 2).alias("kind")
    )
    genes = materialise(genes, "features")
    n_features = genes.count()
    genes = materialise(genes.filter(F.col("kind").isNull() | (F.col("kind") == "Gene Expression")).drop("kind"), "genes")
    cells = materialise(numbered_lines(spark, f"{folder}/{barcodes}").select(F.col("line").alias("col"), tab[0].alias("cell")), "barcodes")
    for df, key in ((genes, "gene"), (cells, "cell")):
        twice = df.groupBy(key).count().filter("count > 1").limit(3).collect()
        if twice:
            raise ValueError(f"duplicate {key} names: {[x[0] for x in twice]}")
    if not genes.limit(1).count():
        raise ValueError("no gene expression features")
    lines = numbered_lines(spark, f"{folder}/{matrix}").filter(~F.col("value").startswith("%") & (F.trim("value") != ""))
    lines = materialise(lines, "triplets")
    first = lines.agg(F.min("line")).first()[0]
    parts = F.split(F.trim("value"), "\\s+")
    body = lines.filter(F.col("line") > (first or 0)).select(
        parts[0].cast("long").alias("row"), parts[1].cast("long").alias("col"), parts[2].cast("double").alias("value")
    )
    _check_header(lines, first, body, n_features, cells.count())
    counts = (
        body.filter(F.col("value") != 0)
        .join(genes.select("row", "gene"), "row")
        .join(cells, "col")
        .groupBy("cell", "gene")
        .agg(F.sum("value").alias("value"))
    )
    return counts, genes.select("gene", "symbol"), cells.select("cell")


def import_libraries(
    libraries: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]], sheet: DataFrame, metadata: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One study from several libraries: ``(counts, cells, genes)``.

    ``libraries`` maps sample to its counts, genes and barcodes; ``sheet`` holds the
    library columns by ``sample_id``.  Cells become ``sample:barcode``.
    """
    names = [x.sample_id for x in sheet.select("sample_id").collect()]
    if not names or len(set(names)) != len(names) or any(not str(n or "").strip() for n in names):
        raise ValueError("give one row per unique, nonblank sample_id")
    if set(names) != set(libraries):
        raise ValueError("sample sheet and libraries differ")
    reference = None
    counts_out, cells_out = [], []
    for name in names:
        counts, genes, barcodes = libraries[name]
        assert_counts(counts)
        genes = genes.select("gene", "symbol").distinct()
        if reference is None:
            reference = genes
        elif genes.exceptAll(reference).limit(1).count() or reference.exceptAll(genes).limit(1).count():
            raise ValueError(f"library {name} uses different genes or symbols")
        cells = barcodes.select(F.col("cell").alias("barcode"))
        extra = (metadata or {}).get(name)
        if extra is not None:
            both = [cells.join(extra, "barcode", "left_anti"), extra.join(cells, "barcode", "left_anti")]
            if any(x.limit(1).count() for x in both):
                raise ValueError(f"cell metadata barcodes must match {name} exactly")
            cells = cells.join(extra, "barcode")
        new_id = F.concat_ws(":", F.lit(name), "barcode")
        cells_out.append(cells.withColumn("sample_id", F.lit(name)).withColumn("cell", new_id))
        counts_out.append(counts.select(F.concat_ws(":", F.lit(name), "cell").alias("cell"), "gene", "value"))
    union = lambda parts: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cells = union(cells_out)
    shared = [c for c in sheet.columns if c in cells.columns and c != "sample_id"]
    if shared:
        old = sheet.select("sample_id", *[F.col(c).alias(f"_s_{c}") for c in shared])
        differ = reduce(lambda a, b: a | b, [F.col(c).cast("string") != F.col(f"_s_{c}").cast("string") for c in shared])
        if cells.join(old, "sample_id").filter(differ).limit(1).count():
            raise ValueError(f"cell and library metadata disagree on {shared}")
    cells = cells.join(sheet.drop(*shared), "sample_id")
    return union(counts_out), cells, reference


# Manifest columns with a meaning; all others are kept as extras.
MANIFEST_COLUMNS = [
    "sample_id",
    "path",
    "cellranger_path",
    "loom_path",
    "donor_id",
    "condition",
    "batch",
    "tissue",
    "timepoint",
    "assay",
    "species",
]


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Sample manifest from CSV or TSV: normalised headers, typed columns, extras as a map."""
    raw = spark.read.csv(path, header=True, sep="\t" if path.endswith(".tsv") else ",")
    return validate_manifest(raw)


def validate_manifest(raw: DataFrame) -> DataFrame:
    clean = raw.toDF(*[c.strip().lower().replace(" ", "_").replace("-", "_") for c in raw.columns])
    if "sample_id" not in clean.columns:
        raise ValueError("a manifest needs sample_id")
    text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    known = [text(c).alias(c) if c in clean.columns else F.lit(None).cast("string").alias(c) for c in MANIFEST_COLUMNS]
    extras = [c for c in clean.columns if c not in MANIFEST_COLUMNS]
    pairs = [x for c in extras for x in (F.lit(c), text(c))]
    extra = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    out = clean.select(*known, extra.alias("extra"))
    bad = out.filter(F.col("sample_id").isNull() | (F.col("path").isNull() & F.col("cellranger_path").isNull()))
    if not out.limit(1).count():
        raise ValueError("an empty manifest")
    if bad.limit(1).count():
        raise ValueError("every manifest row needs sample_id and an input location")
    if out.groupBy("sample_id").count().filter("count > 1").limit(1).count():
        raise ValueError("duplicate sample_id in manifest")
    return out


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """Gene sets ``(source, target)``; blank fields go, lines with fewer than three fields are skipped."""
    lines = numbered_lines(spark, path)
    fields = F.filter(F.transform(F.split("value", "\t"), lambda x: F.trim(x)), lambda x: x != "")
    parsed = lines.select("line", fields.alias("f")).filter(F.size("f") >= 3)
    # a repeated name keeps its last line
    last = parsed.groupBy(F.col("f")[0].alias("source")).agg(F.max_by("f", "line").alias("f"))
    return last.select("source", F.explode(F.array_distinct(F.slice("f", 3, 1_000_000_000))).alias("target"))


def resolve_programs(sources: Sequence[DataFrame]) -> DataFrame:
    """Gene sets of several sources; a later source replaces a set of the same name."""
    tagged = reduce(
        lambda a, b: a.unionByName(b), [s.select("source", "target", F.lit(i).alias("_p")) for i, s in enumerate(sources)]
    ).distinct()
    top = tagged.groupBy("source").agg(F.max("_p").alias("_p"))
    return tagged.join(top, ["source", "_p"]).select("source", "target")


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write one result table; CSV carries a header."""
    if fmt == "csv":
        df.write.mode("overwrite").csv(path, header=True)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")
    return path
