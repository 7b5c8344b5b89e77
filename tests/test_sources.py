"""Files in, tables out, and the errors bad input raises."""

from __future__ import annotations

import pytest
from conftest import rows

from cohortlens.sources import readers, subset


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n% note\n3 2 4\n1 1 5\n2 1 1\n2 2 7\n3 2 9\n")
    (tmp_path / "features.tsv").write_text("g1\tA\tGene Expression\ng2\tB\tGene Expression\nab\tC\tAntibody Capture\n")
    (tmp_path / "barcodes.tsv").write_text("AAA-1\nCCC-1\n")
    return tmp_path


def test_mtx(spark, folder):
    counts, genes, cells = readers.read_mtx_counts(spark, str(folder))
    assert rows(counts, "cell", "gene", "value") == [("AAA-1", "g1", 5.0), ("AAA-1", "g2", 1.0), ("CCC-1", "g2", 7.0)]
    assert rows(genes, "gene", "symbol") == [("g1", "A"), ("g2", "B")] and cells.count() == 2


def test_mtx_refuses_duplicate_barcodes(spark, folder):
    (folder / "barcodes.tsv").write_text("AAA-1\nAAA-1\n")
    with pytest.raises(ValueError):
        readers.read_mtx_counts(spark, str(folder))


def test_libraries(spark, folder):
    lib = readers.read_mtx_counts(spark, str(folder))
    sheet = spark.createDataFrame([("s1", "x"), ("s2", "y")], "sample_id string, batch string")
    counts, cells, _ = readers.import_libraries({"s1": lib, "s2": lib}, sheet)
    assert counts.count() == 6 and rows(cells, "cell", "batch")[0] == ("s1:AAA-1", "x")
    other = (lib[0], spark.createDataFrame([("g1", "A"), ("g2", "Z")], "gene string, symbol string"), lib[2])
    with pytest.raises(ValueError):
        readers.import_libraries({"s1": lib, "s2": other}, sheet)
    with pytest.raises(ValueError):
        readers.import_libraries({"s1": lib}, sheet)
    meta = {"s1": spark.createDataFrame([("AAA-1", "d")], "barcode string, donor string")}
    with pytest.raises(ValueError):
        readers.import_libraries({"s1": lib, "s2": lib}, sheet, meta)


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Sample ID,Path,Donor-ID,Extra Note\ns1,a,d1,x\ns2,b,,\n")
    got = {r.sample_id: r for r in readers.load_manifest(spark, str(path)).collect()}
    assert got["s1"].donor_id == "d1" and got["s2"].donor_id is None and got["s1"].extra == {"extra_note": "x"}
    for text in ("sample_id,path\ns1,a\ns1,b\n", "sample_id,path\ns1,\n", "path\na\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            readers.load_manifest(spark, str(path))


def test_gmt(spark, tmp_path):
    path = tmp_path / "sets.gmt"
    path.write_text("S1\tnote\ta\tb\ta\nshort\tnote\nS2\tnote\tc\nS2\tnote\td\te\n")
    net = readers.read_gmt(spark, str(path))
    assert rows(net, "source", "target") == [("S1", "a"), ("S1", "b"), ("S2", "d"), ("S2", "e")]
    over = spark.createDataFrame([("S1", "z")], "source string, target string")
    assert rows(readers.resolve_programs([net, over]), "source", "target")[0] == ("S1", "z")


def test_subset_errors(spark):
    cells = spark.createDataFrame([("c1", "T", "ok"), ("c2", "B", "ok")], "cell string, t string, s string")
    with pytest.raises(ValueError):
        subset.subset_cells(cells, "t", ["T"], ("s", ["never"]))
    with pytest.raises(ValueError):
        subset.subset_cells(cells, "t", ["T"], agree="s")
    with pytest.raises(ValueError):
        subset.attach_layout(cells, spark.createDataFrame([("c1", 0.0, 0.0)], "cell string, x double, y double"))


def test_splice_barcodes(spark):
    splice = spark.createDataFrame(
        [("run", "run:AAAx", "g", 1, "spliced", 2.0), ("run", "run:AAAx", "g", 2, "spliced", 9.0), ("run", "run:ZZZx", "g", 1, "spliced", 1.0)],
        "stem string, file_cell string, gene string, listing int, layer string, value double",
    )
    cells = spark.createDataFrame([("s:AAA-1", "s", "AAA-1")], "cell string, sample string, barcode string")
    got = subset.reconcile_splice(splice, cells, spark.createDataFrame([("run", "s")], "stem string, sample string"))
    assert rows(got, "cell", "gene", "layer", "value") == [("s:AAA-1", "g", "spliced", 2.0)]
