"""Token alignment, exact top-k search and ranked lexical search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import compare, connect  # noqa: E402

from cohortlens.llm import cover_tree_search, lexical_search, token_alignment  # noqa: E402
from cohortlens.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def pair():
    return token_alignment.Pair(*(Path(f).read_bytes() for f in FILES))


ODD = [
    None, "", " ", "a", "\n", "x▁y", "<|endoftext|> hi", "<0x41> <s> <unk>", "  two  spaces\n\nnew \t tab ", "naïve 日本語 🙂🙃 ßü",
    "nul \x00 byte", "don't stop now wide", "a b " * 3000, "xyz" * 500, "é combining", "12345 67,890.5",
]


def split(pair, text):
    """Ids of both sides and their groups by plain loops, or None."""
    if not text:
        return None
    raw = (" " + text).encode()
    ids = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    ends = []
    for own, parts in zip(ids, (pair.a_bytes, pair.b_bytes)):
        data = [parts[i].as_py() for i in own]
        if b"".join(data) != raw:
            return None
        at, out = 0, []
        for x in data:
            at += len(x)
            out.append(at)
        ends.append(out)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        n, m = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((ids[0][i:n], ids[1][j:m]))
        i, j = n, m
    return ids, groups


def described(pair, texts):
    found = [split(pair, t) for t in texts]
    counts = Counter((a[-1], b[-1]) for f in found if f for a, b in f[1])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for f in found:
        if not f:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        (a, b), groups = f
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == most[p[1]] for p in links)
        out.append((len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("at_once, tokenized, links", [(4_000_000, 500_000, 2_000_000), (3000, 40, 50)])
def test_alignment_matches_plain_loops(spark, pair, monkeypatch, at_once, tokenized, links):
    for name, value in (("AT_ONCE", at_once), ("TOKENIZED", tokenized), ("LINKS_AT_ONCE", links)):
        monkeypatch.setattr(token_alignment, name, value)
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).toPandas()
    texts = [*ODD, *docs.text, *docs.text[:3]]
    df = spark.createDataFrame([(i if i != 3 else None, t, 1, "mine") for i, t in enumerate(texts)], "doc_id long, text string, a_ids int, row string")
    aligner = token_alignment.Aligner(spark, *FILES)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = token_alignment.token_alignment(aligner, df.repartition(3)).select(columns).collect()
    want = described(pair, texts)
    assert len(got) == len(texts)
    lists = {r.doc_id: r for r in aligner.align(df).collect()}
    for i in (6, 9, 12, 20):
        ids, groups = split(pair, texts[i])
        r = lists[i]
        assert [r.a_ids, r.b_ids] == list(map(list, ids)) and [r.a_sizes, r.b_sizes] == [[len(g[k]) for g in groups] for k in (0, 1)]
    assert {r[0]: tuple(r)[1:] for r in got} == {i if i != 3 else None: w for i, w in enumerate(want)}
    assert sum(1 for w in want if not w[0]) >= 3


def test_linked_tokens_end_in_each_other(spark, pair):
    aligner = token_alignment.Aligner(spark, *FILES)
    counts = token_alignment.pair_counts(aligner.describe(spark.read.parquet(f"{SF}/documents.parquet"))).collect()
    a, b = pair.a_bytes.to_pylist(), pair.b_bytes.to_pylist()
    assert all(a[r.a].endswith(b[r.b]) or b[r.b].endswith(a[r.a]) for r in counts)
    assert 1000 < len(counts) <= token_alignment.possible_pairs(pair) < 500_000
    assert token_alignment.token_alignment(aligner, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def top(rows, asks, k):
    """Best candidates of each query by sorting all of them."""
    rows = sorted({(i, tuple(math.floor(256 * float(np.float64(x))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i in sorted({i for i, _ in rows if asks(i)}):
        scored = [(-sum(a * b for a, b in zip(q, v)), o) for j, q in rows if j == i for o, v in rows if o != i]
        out += [(i, r + 1, o, -s) for r, (s, o) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("clusters", [1, 12])
def test_top_inner_products_match_brute_force(spark, monkeypatch, clusters):
    for name, value in (("BLOCK_ROWS", 60), ("QUERY_ROWS", 7), ("LEAF", 4), ("SAMPLE_ROWS", 200)):
        monkeypatch.setattr(cover_tree_search, name, value)
    rng = np.random.default_rng(3)
    heart = rng.normal(size=(clusters, 6))
    rows = [(i, [float(np.float32(x)) for x in heart[i % clusters] * rng.uniform(0.2, 3) + rng.normal(size=6) * 0.2]) for i in range(500)]
    rows += [(600 + i, rows[7][1]) for i in range(90)]  # a large group of equal vectors: ties by id
    rows += [(700, None), (701, [None] * 6), (702, [float("nan")] * 6), (750, [float("inf")] + [0.0] * 5), (None, rows[0][1])]
    rows += [(800, []), (801, [0.0] * 6), (850, [1.0, 2.0]), (851, [1.0] * 9), rows[10], rows[10], (3, rows[11][1])]
    df = spark.createDataFrame([(i, v, 0.5, 1) for i, v in rows], "vec_id long, embedding array<float>, score double, node int")
    from pyspark.sql import functions as F

    got = cover_tree_search.top_inner_products(df.repartition(5), F.col("vec_id") % 10 == 0, k=5).collect()
    assert sorted(map(tuple, got)) == top(rows, lambda i: i % 10 == 0, 5)
    few = df.filter("vec_id in (0, 1, 700)")
    assert sorted(map(tuple, cover_tree_search.top_inner_products(few, k=5).collect())) == top(rows[:2], lambda i: True, 5)
    assert cover_tree_search.top_inner_products(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, -2e5]), (1, [1e8, 7e7]), (2, [1e8, 7e7 - 1]), (3, [1e30, 1.0]), (4, [-1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cover_tree_search.top_inner_products(df, df.vec_id == 0).collect()
    whole = [[math.floor(256 * x) for x in v] for _, v in rows]
    clipped = lambda v: [max(min(x, 2**63 - 1), -(2**63)) for x in v]
    score = lambda i: max(min(sum(a * b for a, b in zip(whole[0], clipped(whole[i]))), 2**63 - 1), -(2**63))
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got)] == [(k + 1, i, score(i)) for k, i in enumerate([3, 2, 1, 4])]
    assert 2**53 < score(1) < score(2) < 2**63 - 1 == score(3)


def test_cover_tree_keeps_its_invariants():
    x = np.random.default_rng(0).normal(size=(400, 5)) * np.repeat([1, 10], 200)[:, None]
    nodes = cover_tree_search.cover_tree(x)
    below = cover_tree_search._below(nodes)
    assert sorted(below[0]) == list(range(400))
    for (centre, radius, children, rows), own in zip(nodes, below):
        assert np.linalg.norm(x[own] - x[centre], axis=1).max() <= radius + 1e-9
        assert bool(children) != bool(len(rows))
        inner = [nodes[c][0] for c in children if len(nodes[c][2]) or len(below[c]) > 1]
        if len(children) > 1:
            assert sorted(np.concatenate([below[c] for c in children])) == sorted(own)
        assert len(inner) <= len(children)


def ranked(docs, items, k=10):
    pattern = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: pattern.findall((t or "").translate(low))
    bags = [(d, Counter(words(t))) for d, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(words(t))
    for i, terms in asked.items():
        scored = []
        for d, b in bags:
            if b:
                m = 10 + 90 * sum(b.values()) * n // total
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms if b[t])
                scored.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(x for x in scored if x[0] < 0)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limit, piece, held", [(2_000_000, 1 << 20, 100_000), (120, 40, 20)])
def test_lexical_search_matches_brute_force(spark, monkeypatch, limit, piece, held):
    for name, value in (("SLICE", limit), ("PIECE", piece), ("HELD", held)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(5)
    words = ["Über", "über", "naïve", "cat", "Cat", "dog2", "日本", "é", "x" * 70, "rare", "the", "THE", "a", "🙂"]
    seps = [" ", "  ", "\n", ", ", "-", "_", "\x00", "\x7f", "."]
    docs = [(i, "".join(rng.choice(words[: rng.randint(3, len(words))]) + rng.choice(seps) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "?!"), (203, "rare"), (203, "rare"), (None, "rare"), (204, "y" * 500), (205, "rare" + "z" * 300 + " rare")]
    items = [(1, "The cat, the DOG2!"), (2, "über 日本 unknown"), (3, None), (4, "..."), (5, "rare"), (5, "rare cat"), (None, "cat"), (6, "x" * 70 + " " + "z" * 300)]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(4)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = lexical_search.ranked_search(d, b).collect()
    assert sorted(map(tuple, got), key=str) == ranked(docs, items)
    assert lexical_search.ranked_search(d.limit(0), b).count() == lexical_search.ranked_search(d, b.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op12_exact_top_k", "op13_lexical_search"])
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert compare(got, connect(SF).execute(ORACLES[name]).df()) == "ok"


def test_alignment_query_reads_all_documents(spark, pair):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_token_alignment"](spark, SF).select(columns).collect()}
    assert got == dict(zip(docs.doc_id, described(pair, docs.text)))
