"""Operators on pages and embeddings, the registered queries and the pipeline."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import compare, connect  # noqa: E402

import corpus_pipeline  # noqa: E402
from cohortlens.llm import embedding_dedup, fixity, url_cascade  # noqa: E402
from cohortlens.llm.queries import ORACLES, QUERIES, URL_RULES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://Sub.Example.ORG/en/1x?q#f", "https://example.org/es/a", "http://notexample.org/es/", "ftp://x.com", "http://a.com/fr/é?x", "HTTP://ÉA.com#x/de/", "x://h/p://q"]
    df = spark.createDataFrame([(i, u, "mine", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_cascade.judge_urls(df, URL_RULES, lambda k: k == "h").collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("sub.example.org", "/en/1x", "example.org/en/1", "block")
    assert got[4] == ("example.org", "/es/a", "example.org/es/", "block")
    assert got[5] == ("notexample.org", "/es/", "org/", "allow")
    assert got[6] == ("x.com", "", None, "allow")
    assert got[7][2:] == ("com/fr/", "allow")
    assert got[8] == ("Éa.com", "", None, "allow")
    assert got[9] == ("h", "/p://q", None, "block")
    assert url_cascade.judge_urls(df.limit(0), URL_RULES, lambda k: k == "h").count() == 0


@pytest.mark.parametrize("slice_keys", [10**6, 700])
def test_cascade_is_exact_on_its_universe(spark, slice_keys):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    rows = spark.range(3000).select("id", F.array(F.concat(F.lit("k"), "id"), F.concat(F.lit("k"), F.col("id") + 1 - (F.col("id") == 2999).cast("int"))).alias("ks"))
    got = url_cascade.any_listed(rows, "ks", keys.union(keys), "hit", slice_keys=slice_keys).collect()
    assert len(got) == 3000
    assert all(r.hit == (r.id % 7 == 0 or (r.id < 2999 and r.id % 7 == 6)) for r in got)
    flat = keys.select(F.xxhash64("key").alias("h"), "listed")
    levels = url_cascade.build_cascade(flat)
    assert len(levels) > 1
    pdf = flat.toPandas()
    assert (url_cascade.answers(levels, pdf.h.to_numpy().view(np.uint64)) == pdf.listed.to_numpy()).all()


def unit(rng, n, d=64):
    x = rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_embedding_classes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 60)
    monkeypatch.setattr(embedding_dedup, "CHUNK", 50)
    rng = np.random.default_rng(0)
    base = unit(rng, 400)
    near = np.concatenate([base[i] + rng.normal(size=(40, 64)) * s for i, s in ((0, 0.02), (1, 0.03), (2, 0.028))])
    x = np.concatenate([base, near, base[:5], base[5:8] * 7.5]).astype(np.float32)
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    n = len(rows)
    odd = [None, [], [0.0] * 64, [1.0] * 63 + [float("nan")], [1.0] * 63 + [None], [float("inf")] * 64, [1.0] * 63]
    rows += [(n + i, v, 2) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    got = {r.vec_id: r for r in embedding_dedup.embedding_classes(df).collect()}
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    link = (y @ y.T >= 0.95) & ~np.eye(n, dtype=bool)
    root = np.arange(n)
    while True:
        low = np.array([min(root[i], root[link[i]].min(initial=n)) for i in range(n)])
        if (low == root).all():
            break
        root = low
    assert all(got[i].n_links == link[i].sum() and got[i].component_id == root[i] and got[i].kept == (root[i] == i) for i in range(n))
    assert link.sum() > 1000
    assert all((got[n + i].n_links, got[n + i].component_id, got[n + i].kept) == (0, n + i, True) for i in range(len(odd)))
    assert embedding_dedup.embedding_classes(df.limit(0)).count() == 0


def test_fixity_finds_all_kinds_of_damage(spark):
    pages = [(i, f"http://h/{i}", f"<p>text {i} é</p>" * (i % 30)) for i in range(900)] + [(77, "again", "x"), (None, None, None)]
    a = spark.createDataFrame(pages, "page_id long, url string, html string")
    records = fixity.warc_records(a)
    assert fixity.audit(records, records, range_bytes=2048, fanout=4).count() == 0
    rotten = fixity.damaged(a, F.col("page_id").isin(5, 404, 899))
    found = fixity.audit(records, fixity.warc_records(rotten), range_bytes=2048, fanout=4).collect()
    assert {(r.record_id, r.status) for r in found} == {(5, "corrupt"), (404, "corrupt"), (899, "corrupt")}
    assert all(r.offset == r.other_offset and r.length == r.other_length for r in found)
    less = fixity.warc_records(a.filter("page_id is null or page_id < 890"))
    found = fixity.audit(records, less, range_bytes=2048, fanout=4).collect()
    assert {(r.record_id, r.status) for r in found} == {(i, "missing") for i in range(890, 900)}
    shifted = fixity.warc_records(a.filter("page_id is null or page_id <> 450"))
    found = {r.record_id: r.status for r in fixity.audit(records, shifted, range_bytes=2048, fanout=4).collect()}
    assert found[450] == "missing" and found[899] == "moved" and 10 not in found
    found = {(r.record_id, r.status) for r in fixity.audit(less, records, range_bytes=2048, fanout=4).collect()}
    assert found == {(i, "extra") for i in range(890, 900)}
    empty = records.limit(0)
    assert fixity.audit(empty, empty).count() == 0
    assert {r.status for r in fixity.audit(empty, records).collect()} == {"extra"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    want = connect(SF).execute(ORACLES[name]).df()
    assert compare(QUERIES[name](spark, SF).toPandas(), want) == "ok"


def test_pipeline_against_its_operators(spark, tmp_path):
    """The stages on a small corpus: toxic texts, copies and secrets go, sources are mixed, ids decode."""
    r = random.Random(0)
    words = [f"w{i}" for i in range(500)]
    text = lambda: " ".join(r.choice(words) for _ in range(60))
    rows = []
    for i in range(240):
        t = text()
        if i % 8 == 0:
            t += " grumbo fizzwort snarkel"
        rows.append([i, t, "en", f"s{i % 3}", len(t)])
    rows[11][1] = rows[10][1]
    rows[20][1] += " password=abcdef123456"
    rows[21][1] = None
    docs = spark.createDataFrame([tuple(x) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    step, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        step = spark.createDataFrame(stage(spark, step, str(tmp_path)).collect(), stage(spark, step, str(tmp_path)).schema)
        seen[name] = step
    ids = lambda d: {x.doc_id for x in d.select("doc_id").collect()}
    clean = {i for i in range(240) if i % 8}
    assert ids(seen["toxicity"]) == clean
    assert ids(seen["near_copies"]) == clean - {11}
    assert seen["secrets"].filter("text like '%password%'").count() == 0
    assert all(seen[n].columns == docs.columns for n in list(seen)[:-1])
    total = sum(len((x.text or "").split()) for x in seen["secrets"].collect())
    assert abs(sum(len((x.text or "").split()) for x in seen["mixing"].collect()) - total) < 200
    out = corpus_pipeline.run(spark, str(tmp_path))
    back = corpus_pipeline.vocabulary(spark).decode(out).collect()
    assert back and all(bytes(x.bytes) == (x.text or "").encode() for x in back)
    assert out.count() == seen["mixing"].count()


def test_pipeline_drops_truncated_and_edited_copies(spark):
    """Copies whose five-word likeness lies between 0.80 and 0.85."""
    r = random.Random(3)
    words = [f"w{r.randrange(10**6)}" for _ in range(200)]
    edited = [f"e{i}" if i % 46 == 30 else w for i, w in enumerate(words)]
    other = [f"w{r.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join(words), " ".join(words[:165]), " ".join(edited), " ".join(other)]
    grams = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    assert all(0.8 <= len(grams[0] & g) / len(grams[0] | g) < 0.85 for g in grams[1:3])
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, "")
    assert {x.doc_id for x in kept.collect()} == {0, 3}
