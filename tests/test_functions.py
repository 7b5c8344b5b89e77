"""Ranks, quantiles, positions, FDR and tails against brute force."""

from __future__ import annotations

import itertools
import math
import time
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.functions import fdr, levels, ranks, tails


@pytest.fixture(params=[50_000, 3], ids=["one-piece", "bucketed"])
def group_size(request, monkeypatch):
    """Both paths of the ranking: small groups sorted whole, and every group cut in buckets."""
    monkeypatch.setattr(ranks, "SMALL_GROUP", request.param)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(1)
    # one group holds most rows, another is constant, values are tied
    g = np.where(rng.random(3000) < 0.7, "hot", np.where(rng.random(3000) < 0.5, "b", "c"))
    v = np.round(rng.normal(size=3000), 2)
    v[g == "c"] = 4.0
    return pd.DataFrame({"id": [f"r{i}" for i in range(3000)], "g": g, "v": v})


def test_value_ranks(spark, group_size, sample):
    df = spark.createDataFrame(sample)
    got = ranks.value_ranks(df, ["g"], "v").withColumn("rank", ranks.average_rank()).toPandas()
    want = sample.assign(rank=sample.groupby("g")["v"].rank()).drop_duplicates(["g", "v"])
    both = want.merge(got, on=["g", "v"], suffixes=("", "_got"))
    assert len(both) == len(want) == len(got)
    assert np.allclose(both["rank"], both["rank_got"])


def test_quantiles_and_partitioning(spark, group_size, sample):
    probs = {"a": 0.25, "b": 0.5, "c": 0.99}
    want = sample.groupby("g")["v"].quantile([0.25, 0.5, 0.99]).unstack()
    for n in (1, 7):
        got = ranks.grouped_quantiles(spark.createDataFrame(sample).repartition(n), ["g"], "v", probs).toPandas().set_index("g")
        assert np.allclose(got.loc[want.index, ["a", "b", "c"]], want)


def test_rounding_follows_the_sql(spark):
    import duckdb

    from cohortlens.queries.quality import r

    values = [99994632918.84967, 1.000005, -2.5, -0.0000005, 0.0, 1e300, float("inf"), float("nan"), None]
    got = [x.v for x in r(spark.createDataFrame(list(enumerate(values)), "i int, v double"), "v", places=5).orderBy("i").collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 5)", [v]).fetchone()[0] for v in values]
    assert [repr(None if x is None else x + 0.0) for x in got] == [repr(None if x is None else x + 0.0) for x in want]


def test_split_points_do_not_depend_on_row_order(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SMALL_GROUP", 1_000)
    df = spark.range(60_000).select((F.col("id") % 2).alias("g"), (F.xxhash64("id") % 1_000_003 / 7.0).alias("v")).distinct()
    found = [
        {r.g: r._splits for r in ranks.split_points(d, ["g"], "v").collect()}
        for d in (df.repartition(3, "v"), df.repartition(17).sortWithinPartitions(F.desc("v")))
    ]
    assert found[0] == found[1] and all(len(s) == ranks.SPLITS - 1 and s == sorted(s) for s in found[0].values())


def test_quantiles_ignore_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "v double")
    assert ranks.grouped_quantiles(df, [], "v", {"m": 0.5}).first().m == 2.0


def test_positions_are_a_permutation_in_order(spark, group_size, sample):
    got = ranks.positions(spark.createDataFrame(sample), ["g"], "v", "id").toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("position")
        assert list(part["position"]) == list(range(len(part)))
        assert part["v"].is_monotonic_increasing


def brute_bh(p):
    p = np.asarray(p, float)
    order = np.argsort(p)[::-1]
    out, low = np.empty_like(p), 1.0
    for k, i in enumerate(order):
        low = min(low, p[i] * len(p) / (len(p) - k))
        out[i] = low
    return out


@pytest.mark.parametrize("adjust", [fdr.bh_fdr, fdr.bh_small])
def test_bh(spark, group_size, adjust):
    rng = np.random.default_rng(3)
    p = np.concatenate([rng.random(300) ** 6, [0.0, 0.0, 1.0, 0.5, 0.5]])
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(p)] + [(999, None), (1000, float("nan"))], "i int, p double")
    got = {r.i: r.fdr for r in adjust(df).collect()}
    assert got[999] is None and got[1000] is None
    assert np.allclose([got[i] for i in range(len(p))], brute_bh(p), atol=1e-12)


def test_ln_factorial_and_hypergeometric(spark):
    n = [0, 1, 5, 31, 32, 33, 1000, 10**7]
    df = spark.createDataFrame([(x,) for x in n], "n long").select(fdr.ln_factorial(F.col("n")).alias("v"))
    assert np.allclose([r.v for r in df.collect()], [math.lgamma(x + 1) for x in n], rtol=1e-13)
    cases = [(0, 50, 10, 5), (3, 50, 10, 5), (5, 50, 10, 5), (6, 50, 10, 5), (8, 10, 9, 9)]
    got = spark.createDataFrame(cases, "k long, u long, a long, b long").select(
        fdr.hypergeometric_sf(F.col("k"), F.col("u"), F.col("a"), F.col("b")).alias("p")
    )
    want = [
        sum(math.comb(a, i) * math.comb(u - a, b - i) for i in range(k, min(a, b) + 1) if u - a >= b - i) / math.comb(u, b)
        for k, u, a, b in cases
    ]
    assert np.allclose([r.p for r in got.collect()], want, atol=1e-12)


def test_hypergeometric_tail_of_large_sets():
    """The number of terms follows the spread: sets of millions end at once."""
    exact = lambda k, u, a, b: float(Fraction(sum(math.comb(a, i) * math.comb(u - a, b - i) for i in range(max(k, a + b - u), min(a, b) + 1)), math.comb(u, b)))
    for u, a, b in ((50, 10, 5), (10, 9, 9), (3000, 700, 900), (3000, 2900, 2800), (3000, 1, 5)):
        for k in {0, 1, 2, a * b // u, a * b // u + 1, a * b // u + 60, a * b // u + 300, a + b - u, min(a, b), min(a, b) + 1}:
            assert math.isclose(tails.hypergeometric_tail(k, u, a, b), exact(k, u, a, b) if k > 0 else 1.0, rel_tol=1e-9, abs_tol=1e-300), (k, u, a, b)
    start = time.perf_counter()
    mean = 288_000 * 250_000 // 7_200_000
    got = [tails.hypergeometric_tail(mean + d, 7_200_000, 288_000, 250_000) for d in range(-300, 301, 10)]
    assert time.perf_counter() - start < 2
    assert all(x > y for x, y in zip(got, got[1:])) and abs(got[30] - 0.5) < 0.01


def integral(f, a, b, n=400_001):
    x = np.linspace(a, b, n)
    return float(np.trapezoid(f(x), x))


@pytest.mark.parametrize("t,df", [(2.0, 10), (2.5, 24), (0.3, 3), (4.0, 7.5)])
def test_student_tail_by_integration(t, df):
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    inside = 2 * integral(lambda x: c * (1 + x * x / df) ** (-(df + 1) / 2), 0, t)
    assert tails.student_two_sided([t], [df])[0] == pytest.approx(1 - inside, abs=1e-9)


@pytest.mark.parametrize("x,df", [(3.8, 3), (10.0, 4), (1.0, 5)])
def test_chi_square_tail_by_integration(x, df):
    c = 1 / (2 ** (df / 2) * math.gamma(df / 2))
    inside = integral(lambda v: c * v ** (df / 2 - 1) * np.exp(-v / 2), 0, x)
    assert tails.gammaincc(np.array([df / 2]), np.array([x / 2]))[0] == pytest.approx(1 - inside, abs=1e-6)


def test_student_quantile_inverts_the_tail():
    df = np.array([1.0, 10.0, 24.0])
    assert np.allclose(tails.student_two_sided(tails.student_quantile(0.975, df), df), 0.05, atol=1e-10)


def test_wilcoxon_exact_matches_enumeration():
    d = np.array([0.3, -1.2, 2.5, 3.1, -0.4, 1.9, 2.2])
    r = np.argsort(np.argsort(np.abs(d))) + 1
    seen = min(r[d > 0].sum(), r[d < 0].sum())
    sums = [sum(x for x, s in zip(r, bits) if s) for bits in itertools.product([0, 1], repeat=len(d))]
    want = min(1.0, 2 * np.mean([s <= seen for s in sums]))
    assert tails.wilcoxon_two_sided(d) == pytest.approx(want, abs=1e-12)
    assert tails.wilcoxon_two_sided(np.zeros(4)) == 1.0
    assert 0 < tails.wilcoxon_two_sided(np.array([1.0, 1.0, -1.0, 2.0, 0.0])) <= 1


def test_mann_whitney_exact_matches_enumeration():
    x, y = np.array([1.1, 2.2, 5.0]), np.array([0.3, 3.3, 4.4, 6.0])
    pool = np.concatenate([x, y])
    u = sum((a > b) for a in x for b in y)
    us = []
    for pick in itertools.combinations(range(7), 3):
        rest = [pool[i] for i in range(7) if i not in pick]
        us.append(sum(pool[i] > b for i in pick for b in rest))
    big = max(u, 12 - u)
    assert tails.mann_whitney_two_sided(x, y) == pytest.approx(min(1.0, 2 * np.mean([v >= big for v in us])), abs=1e-12)


def test_levels(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert levels.bounded_levels(df, "v") == ["a", "b"]
    with pytest.raises(ValueError):
        levels.bounded_levels(df, "v", limit=1)
    with pytest.raises(ValueError):
        levels.require_levels(df, "v", ["a", "z"])
    num = spark.createDataFrame([(1.0,), (2.5,), (None,)], "v double")
    assert [r.v for r in levels.canonicalise(num, "v").collect()] == ["1", "2.5", None]
    text = spark.createDataFrame([("nan",), ("x",), ("",)], "v string")
    assert [r.v for r in levels.canonicalise(text, "v").collect()] == [None, "x", None]
