"""Blocks of few dimensions are searched leaf by leaf: the same neighbours, without a distance to every row."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from cohortlens.operators import neighbors as k


def table(rng, n, dims, whole):
    vec = rng.integers(0, 5, (n, dims)).astype(float) if whole else rng.normal(size=(n, dims))
    # names and vectors come twice, and some donors are null
    names = [f"c{i}" for i in rng.integers(0, n, n)]
    return pd.DataFrame({"cell": pd.Series(names, dtype=object), "vec": list(vec), "pivot": 0, "donor": pd.Series([None if i % 13 == 0 else str(i % 4) for i in range(n)], dtype=object)})


def search(k_near, exclude, dims):
    return k._Search(np.zeros((1, dims)), np.array([1.0]), np.zeros((1, 0)), np.ones((1, 1), np.float32), k_near, exclude)


def by_hand(left, right, x, limit, k_near, exclude):
    right = right.sort_values("cell", kind="mergesort")
    y, names = np.stack(right["vec"].to_numpy()), right["cell"].to_numpy()
    out = []
    for i in range(len(left)):
        d = np.sqrt(((y - x[i]) ** 2).sum(axis=1))
        own = left["cell"].iloc[i] if exclude == "cell" else left[exclude].iloc[i] if exclude else None
        other = np.ones(len(y), bool) if own is None else right[exclude].to_numpy() != own
        at = np.flatnonzero(other & (d <= limit[i]))
        out += [(i, names[j], d[j]) for j in at[np.lexsort((at, d[at]))][:k_near]]
    return out


@pytest.mark.parametrize("dims, whole, exclude", [(5, True, "cell"), (5, False, "cell"), (2, True, "donor"), (3, False, None)])
def test_leaves_find_what_all_distances_find(dims, whole, exclude):
    rng = np.random.default_rng(dims)
    right = table(rng, 2_000, dims, whole)
    left = right.sample(150, random_state=1).reset_index(drop=True)
    x = np.stack(left["vec"].to_numpy())
    s = search(6, exclude, dims)
    for limit in (np.full(len(x), np.inf), np.full(len(x), 1.5 if whole else 0.7)):
        row, names, dist = s.nearest(left, right, x, limit, None)
        got = list(zip(row.tolist(), names, dist))
        want = by_hand(left, right, x, limit, 6, exclude)
        assert len(got) == len(want) and all(a[:2] == b[:2] and a[2] == b[2] for a, b in zip(got, want))


def test_large_blocks_of_few_dimensions_go_leaf_by_leaf(monkeypatch):
    met = []
    product = k._Search._by_leaves
    rng = np.random.default_rng(3)
    right = pd.DataFrame({"cell": [f"c{i}" for i in range(20_000)], "vec": list(rng.uniform(size=(20_000, 2))), "pivot": 0})
    x = np.stack(right["vec"].to_numpy())

    def counted(self, *args):
        met.append(1)
        return product(self, *args)

    monkeypatch.setattr(k._Search, "_by_leaves", counted)
    row, _, dist = search(5, "cell", 2).nearest(right, right, x, np.full(len(x), np.inf), None)
    assert len(met) == 1 and np.array_equal(np.bincount(row), np.full(20_000, 5)) and dist.max() < 0.1


def test_leaves_hold_each_row_once():
    x = np.random.default_rng(0).normal(size=(1_000, 3))
    order, starts = k._leaves(x, 64)
    assert sorted(order.tolist()) == list(range(1_000)) and np.diff(starts).max() <= 64 and starts[0] == 0 and starts[-1] == 1_000
