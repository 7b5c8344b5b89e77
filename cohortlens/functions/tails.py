"""Distribution tails as vectorised UDFs; they run on result rows, never on cells."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _lgamma(x):
    return np.vectorize(math.lgamma, otypes=[float])(x)


def _erfc(x):
    return np.vectorize(math.erfc, otypes=[float])(x)


EXACT_WILCOXON_MAX = 50
EXACT_MANN_WHITNEY_MAX = 8


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * c * d
        if np.all(np.abs(c * d - 1.0) < 1e-16):
            break
    return h


def betainc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta."""
    a, b, x = np.broadcast_arrays(*[np.asarray(v, float) for v in (a, b, x)])
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0)
    out[ok & (x <= 0)] = 0.0
    out[ok & (x >= 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        aa, bb, xx = a[mid], b[mid], x[mid]
        front = np.exp(
            _lgamma(aa + bb) - _lgamma(aa) - _lgamma(bb) + aa * np.log(xx) + bb * np.log1p(-xx)
        )
        left = xx < (aa + 1) / (aa + bb + 2)
        res = np.empty_like(xx)
        if left.any():
            res[left] = front[left] * _beta_fraction(aa[left], bb[left], xx[left]) / aa[left]
        if (~left).any():
            r = ~left
            res[r] = 1 - front[r] * _beta_fraction(bb[r], aa[r], 1 - xx[r]) / bb[r]
        out[mid] = res
    return out


def student_two_sided(t, df) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    return betainc(df / 2, 0.5, df / (df + t * t))


def gammaincc(a, x) -> np.ndarray:
    """Regularised upper incomplete gamma."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(x) & (a > 0)
    out[ok & (x <= 0)] = 1.0
    series = ok & (x > 0) & (x < a + 1)
    if series.any():
        aa, xx = a[series], x[series]
        term = 1.0 / aa
        total = term.copy()
        for n in range(1, 2000):
            term = term * xx / (aa + n)
            total += term
            if np.all(term < total * 1e-17):
                break
        out[series] = 1 - total * np.exp(-xx + aa * np.log(xx) - _lgamma(aa))
    frac = ok & (x >= a + 1)
    if frac.any():
        aa, xx = a[frac], x[frac]
        b = xx + 1 - aa
        c = np.full_like(xx, 1e300)
        d = 1 / b
        h = d.copy()
        for i in range(1, 2000):
            an = -i * (i - aa)
            b = b + 2
            d = an * d + b
            d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
            c = b + an / c
            c = np.where(np.abs(c) < 1e-300, 1e-300, c)
            h = h * d * c
            if np.all(np.abs(d * c - 1) < 1e-16):
                break
        out[frac] = np.exp(-xx + aa * np.log(xx) - _lgamma(aa)) * h
    return out


def student_quantile(p: float, df) -> np.ndarray:
    """Upper quantile t with P(T <= t) = p, p >= 1/2, by bisection on the tail."""
    df = np.asarray(df, float)
    lo, hi = np.zeros_like(df), np.full_like(df, 1e8)
    for _ in range(200):
        mid = (lo + hi) / 2
        above = student_two_sided(mid, df) / 2 > 1 - p
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return np.where(np.isfinite(df) & (df > 0), (lo + hi) / 2, np.nan)


def signed_rank_exact(n: int) -> np.ndarray:
    """Counts of sign vectors by rank sum."""
    counts = np.zeros(n * (n + 1) // 2 + 1)
    counts[0] = 1
    for r in range(1, n + 1):
        counts[r:] = counts[r:] + counts[:-r]
    return counts


def wilcoxon_two_sided(diffs: np.ndarray) -> float:
    """Signed-rank p: zeros dropped; exact without ties or zeros up to 50 pairs, normal otherwise."""
    d = np.asarray(diffs, float)
    d = d[np.isfinite(d)]
    if d.size == 0:
        return math.nan
    if np.all(d == 0):
        return 1.0
    zeros = int((d == 0).sum())
    d = d[d != 0]
    n = d.size
    values, inverse, counts = np.unique(np.abs(d), return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    rank = (ends - (counts - 1) / 2)[inverse]
    plus, minus = rank[d > 0].sum(), rank[d < 0].sum()
    if n <= EXACT_WILCOXON_MAX and zeros == 0 and counts.max() == 1:
        dist = signed_rank_exact(n)
        tail = dist[: int(min(plus, minus)) + 1].sum() / 2.0**n
        return float(min(1.0, 2 * tail))
    mean = n * (n + 1) / 4
    var = n * (n + 1) * (2 * n + 1) / 24 - ((counts**3 - counts).sum()) / 48
    if var <= 0:
        return 1.0
    z = (min(plus, minus) - mean) / math.sqrt(var)
    return float(min(1.0, math.erfc(abs(z) / math.sqrt(2))))


def mann_whitney_exact(m: int, n: int) -> np.ndarray:
    """Probabilities of U for samples of m and n without ties."""
    table = [np.array([1.0])] + [np.zeros(0)] * m
    counts = np.zeros((m + 1, m * n + 1))
    counts[0, 0] = 1
    del table
    for j in range(1, m + n + 1):
        for i in range(min(j, m), 0, -1):
            shift = j - i
            if shift <= m * n:
                counts[i, shift:] += counts[i - 1, : m * n + 1 - shift]
    return counts[m] / counts[m].sum()


def mann_whitney_two_sided(x: np.ndarray, y: np.ndarray) -> float:
    """Exact when the smaller sample has at most 8 and no ties, else normal with continuity."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    m, n = x.size, y.size
    if m == 0 or n == 0:
        return math.nan
    both = np.concatenate([x, y])
    _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    u1 = rank[:m].sum() - m * (m + 1) / 2
    u = max(u1, m * n - u1)
    if min(m, n) <= EXACT_MANN_WHITNEY_MAX and counts.max() == 1:
        dist = mann_whitney_exact(m, n)
        return float(min(1.0, 2 * dist[int(u):].sum()))
    total = m + n
    ties = (counts**3 - counts).sum()
    s = math.sqrt(m * n / 12 * ((total + 1) - ties / (total * (total - 1))))
    if s == 0:
        return 1.0
    return float(min(1.0, math.erfc(max(0.0, (u - m * n / 2 - 0.5) / s) / math.sqrt(2))))


def _hypergeometric_run(at: int, step: int, end: int, u: int, a: int, b: int) -> tuple[np.ndarray, int]:
    """Weights of ``at, at + step, ...`` relative to the first, until ``end`` or until they no longer count; for runs that fall."""
    parts, weight, total, width = [np.ones(1)], 1.0, 1.0, 256
    while at != end and weight > 1e-20 * total:
        i = np.arange(at, at + step * min(width, abs(end - at)), step, dtype=float)
        up = lambda x: (a - x) * (b - x) / ((x + 1) * (u - a - b + x + 1))
        w = weight * np.cumprod(up(i) if step > 0 else 1 / up(i - 1))
        parts.append(w)
        at, weight, total, width = at + step * len(w), float(w[-1]), total + float(w.sum()), 2 * width
    return np.concatenate(parts), at


def hypergeometric_tail(k: int, u: int, a: int, b: int) -> float:
    """P(X >= k) for b draws from u holding a marked; terms go from the mode outwards, so their number follows the spread, not the sets."""
    low, high = max(0, a + b - u), min(a, b)
    if k <= 0:
        return 1.0
    if max(k, low) > high:
        return 0.0
    if k <= low:
        return 1.0
    mode = min(max((a + 1) * (b + 1) // (u + 2), low), high)
    above, top = _hypergeometric_run(mode, 1, high, u, a, b)
    below, bottom = _hypergeometric_run(mode, -1, low, u, a, b)
    total = above.sum() + below[1:].sum()
    if k > top:  # so far out that the first term comes from factorials
        ln = lambda n, m: math.lgamma(n + 1) - math.lgamma(m + 1) - math.lgamma(n - m + 1)
        first = ln(a, k) + ln(u - a, b - k) - ln(a, mode) - ln(u - a, b - mode)
        return float(math.exp(first) * _hypergeometric_run(k, 1, high, u, a, b)[0].sum() / total)
    if k > mode:
        return float(above[k - mode :].sum() / total)
    if k <= bottom:
        return 1.0
    return float(min(1.0, 1 - below[mode - k + 1 :].sum() / total))


@pandas_udf(DoubleType())
def hypergeometric_upper(k: pd.Series, u: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    rows = zip(*(x.tolist() for x in (k, u, a, b)))
    return pd.Series([math.nan if any(v != v for v in row) else hypergeometric_tail(*(int(v) for v in row)) for row in rows], dtype=float)


@pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(student_two_sided(t, df))


@pandas_udf(DoubleType())
def t_quantile_975(df: pd.Series) -> pd.Series:
    return pd.Series(student_quantile(0.975, df))


@pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return pd.Series(_erfc(np.abs(z.astype(float)) / math.sqrt(2)))


@pandas_udf(DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(gammaincc(df.astype(float) / 2, x.astype(float) / 2))


@pandas_udf(DoubleType())
def wilcoxon_p(diffs: pd.Series) -> pd.Series:
    return pd.Series([math.nan if d is None else wilcoxon_two_sided(d) for d in diffs])


@pandas_udf(DoubleType())
def mann_whitney_p(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series(
        [math.nan if a is None or b is None else mann_whitney_two_sided(a, b) for a, b in zip(x, y)]
    )


@pandas_udf(DoubleType())
def log_gamma(x: pd.Series) -> pd.Series:
    return pd.Series(_lgamma(x.to_numpy(dtype=float)))
