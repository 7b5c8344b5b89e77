"""Communities: planted blocks, certificates, graphs laid side by side and the adaptive bootstrap."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from conftest import rows

from cohortlens.operators import communities as c
from cohortlens.operators import neighbors as k


def undirected(spark, pairs):
    both = [(a, b, w) for a, b, w in pairs] + [(b, a, w) for a, b, w in pairs]
    return spark.createDataFrame(both, "src string, dst string, weight double")


def ring_of_cliques(n_cliques, size):
    """Cliques joined in a ring by single weak edges."""
    name = lambda i, j: f"{i:02d}-{j:02d}"
    inside = [(name(i, a), name(i, b), 1.0) for i in range(n_cliques) for a, b in itertools.combinations(range(size), 2)]
    return inside + [(name(i, 0), name((i + 1) % n_cliques, 1), 0.2) for i in range(n_cliques)]


def quality(pairs, of, resolution=1.0):
    total = sum(w for *_, w in pairs) * 2
    inside = sum(2 * w for a, b, w in pairs if of[a] == of[b])
    tot = {}
    for a, b, w in pairs:
        for x in (a, b):
            tot[of[x]] = tot.get(of[x], 0) + w
    return inside / total - resolution * sum(t * t for t in tot.values()) / total**2


def test_planted_cliques_are_found_whole(spark):
    pairs = ring_of_cliques(8, 6)
    edges = undirected(spark, pairs)
    got = k.graph_cluster(edges).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.cluster, set()).add(r.cell[:2])
    assert len(got) == 48 and len(groups) == 8 and all(len(g) == 1 for g in groups.values())
    assert sorted(groups) == [str(i) for i in range(8)]
    # at a low resolution neighbouring cliques merge
    assert len({r.cluster for r in k.graph_cluster(edges, 0.1).collect()}) < 8


def test_no_move_gains_and_clusters_hold_together(spark):
    rng = np.random.default_rng(2)
    block = rng.integers(0, 4, 120)
    pairs = [(f"n{i:03d}", f"n{j:03d}", float(rng.uniform(0.5, 1))) for i in range(120) for j in range(i) if rng.random() < (0.25 if block[i] == block[j] else 0.02)]
    edges = undirected(spark, pairs)
    found = k.graph_cluster(edges, seed=3)
    of = {r.cell: r.cluster for r in found.collect()}
    planted = {f"n{i:03d}": int(block[i]) for i in range(120)}
    names = spark.createDataFrame([(x, str(v)) for x, v in planted.items()], "cell string, cluster string")
    assert all(r.passed for r in c.certificate(edges, found, names).collect())
    assert quality(pairs, of) >= quality(pairs, planted) - 1e-9
    assert c.modularity(edges, found).first().modularity == pytest.approx(quality(pairs, of))
    # by hand: no node alone does better elsewhere
    for node in list(of)[:20]:
        for other in set(of.values()):
            assert quality(pairs, {**of, node: other}) <= quality(pairs, of) + 1e-9


def test_disconnected_and_empty_graphs(spark):
    edges = undirected(spark, [("a", "b", 1.0), ("c", "d", 2.0), ("c", "c", 5.0)])
    got = k.graph_cluster(edges).collect()
    assert {frozenset(r.cell for r in got if r.cluster == x) for x in ("0", "1")} == {frozenset("ab"), frozenset("cd")}
    assert k.graph_cluster(edges.limit(0)).count() == 0
    split = c.pieces_of(edges, spark.createDataFrame([(x, "all") for x in "abcd"], "cell string, cluster string"))
    assert rows(split, "cluster", "n_pieces") == [("all", 2)]


def test_limits_warn(spark):
    edges = undirected(spark, ring_of_cliques(4, 5))
    with pytest.warns(UserWarning, match="sweeps"):
        c.communities(edges, max_sweeps=0, max_rounds=1).count()


def test_graphs_side_by_side_are_clustered_apart(spark):
    one, two = ring_of_cliques(4, 5), [("x", "y", 1.0), ("y", "z", 1.0), ("p", "q", 9.0)]
    edges = undirected(spark, one).selectExpr("1 part", "*").unionByName(undirected(spark, two).selectExpr("2 part", "*"))
    plan = spark.createDataFrame([(1, 1.0), (1, 0.01), (2, 1.0)], "part int, resolution double")
    got = c.communities_of_parts(edges, plan).collect()
    groups = {}
    for r in got:
        groups.setdefault((r.part, r.resolution, r.cluster), set()).add(r.cell)
    of = lambda p, x: sorted(map(sorted, (g for (a, b, _), g in groups.items() if (a, b) == (p, x))))
    assert [len(g) for g in of(1, 1.0)] == [5] * 4
    assert len(of(1, 0.01)) == 1
    assert of(2, 1.0) == [["p", "q"], ["x", "y", "z"]]


def test_allocation_prefers_uncertain_and_changing_resolutions(spark):
    j = {0.5: [0.9, 0.9, 0.9], 1.0: [0.2, 0.5, 0.9], 2.0: [0.9, 0.9, 0.9], 4.0: [0.9, 0.9, 0.9]}
    df = spark.createDataFrame([(x, str(i), 0, v) for x, vs in j.items() for i, v in enumerate(vs)], "resolution double, cluster string, boot int, jaccard double")
    got = {r.resolution: r.extra for r in k.bootstrap_allocation(df, 40).collect()}
    assert got == {0.5: 10, 1.0: 20, 2.0: 10, 4.0: 0}
    flat = df.filter("resolution <> 1.0")
    assert {r.extra for r in k.bootstrap_allocation(flat, 40).collect()} == {13}


def test_second_round_follows_the_allocation(spark):
    rng = np.random.default_rng(0)
    centres = np.eye(4) * 8
    emb = [(f"c{i:03d}", [float(x) for x in centres[i % 4] + rng.normal(size=4)]) for i in range(80)]
    df = spark.createDataFrame(emb, "cell string, vec array<double>")
    got = k.bootstrap_jaccards(df, [0.2, 3.0], n_boot=3, k=6)
    boots = {x: {r.boot for r in got.filter(f"resolution = {x}").select("boot").distinct().collect()} for x in (0.2, 3.0)}
    extra = {r.resolution: r.extra for r in k.bootstrap_allocation(got.filter("boot = 0"), 4).collect()}
    assert {x: len(b) for x, b in boots.items()} == {x: 1 + e for x, e in extra.items()}
    summary = {(r.resolution, r.cluster): r for r in k.stability_summary(got, ["resolution", "cluster"]).collect()}
    assert all(r.median > 0.9 for (x, _), r in summary.items() if x == 0.2)
