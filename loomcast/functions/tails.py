"""Tail probabilities as Arrow-batched column functions for small result tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_log_gamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def normal_sf(z):
    return 0.5 * _erfc(np.asarray(z, float) / math.sqrt(2.0))


def normal_cdf(z):
    return 0.5 * _erfc(-np.asarray(z, float) / math.sqrt(2.0))


def normal_quantile(p):
    """Inverse of the normal distribution by bisection on the survival function."""
    p = np.asarray(p, float)
    low, high = np.full(p.shape, -40.0), np.full(p.shape, 40.0)
    for _ in range(70):
        middle = (low + high) / 2
        under = normal_cdf(middle) < p
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


def incomplete_beta(a, b, x):
    """Regularised incomplete beta by its continued fraction (modified Lentz), vectorised."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    d = 1 - (p + q) * z / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    c, total = np.ones_like(z), d.copy()
    for m in range(1, 300):
        for top in (
            m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            total = total * d * c
        if m > 3 and np.all(np.abs(d * c - 1) < 1e-15):
            break
    inside = (z > 0) & (z < 1)
    safe = np.where(inside, z, 0.5)
    front = np.exp(
        _log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(safe) + q * np.log1p(-safe)
    )
    value = np.where(inside, front * total / p, np.where(z <= 0, 0.0, 1.0))
    return np.where(swap, 1 - value, value)


def f_sf(f, df1, df2):
    """P(F > f)."""
    f = np.maximum(np.asarray(f, float), 0.0)
    return incomplete_beta(np.asarray(df2) / 2.0, np.asarray(df1) / 2.0, df2 / (df2 + df1 * f))


def chi2_sf(q, df):
    """P(chi-square > q) by the series below the mean and the continued fraction above it."""
    s, x = np.broadcast_arrays(np.asarray(df, float) / 2, np.maximum(np.asarray(q, float), 0) / 2)
    safe = np.where(x > 0, x, 1.0)
    front = np.exp(s * np.log(safe) - safe - _log_gamma(s))
    term = 1 / s
    series = term.copy()
    for k in range(1, 500):
        term = term * safe / (s + k)
        series = series + term
        if np.all(term < 1e-17 * series):
            break
    b = safe + 1 - s
    c = np.full_like(safe, 1e300)
    d = 1 / np.where(b == 0, 1e-300, b)
    h = d.copy()
    for k in range(1, 500):
        an = -k * (k - s)
        b = b + 2
        d = an * d + b
        d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = b + an / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    upper = np.where(safe < s + 1, 1 - front * series, front * h)
    return np.where(x > 0, upper, 1.0)


# MacKinnon's response surface for the constant-only unit root test.
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_SPLIT, ADF_LOWEST, ADF_HIGHEST = -1.61, -18.83, 2.74


def adf_p(tau):
    """p-value of the augmented Dickey-Fuller statistic with a constant."""
    tau = np.asarray(tau, float)
    small = normal_cdf(np.polyval(ADF_SMALL[::-1], tau))
    large = normal_cdf(np.polyval(ADF_LARGE[::-1], tau))
    p = np.where(tau <= ADF_SPLIT, small, large)
    return np.where(tau < ADF_LOWEST, 0.0, np.where(tau > ADF_HIGHEST, 1.0, p))


def ks_exact(n1: int, n2: int, statistic: float) -> float:
    """P(largest gap >= statistic) for two samples without equal values, by counting lattice paths.

    A path goes right with each value of the first sample and up with each of the second.
    Step by step along the diagonals it holds the share of paths that have left the band
    of smaller gaps; only the band's own places are kept.
    """
    total, least = n1 + n2, round(statistic * n1 * n2)
    if least <= 0:
        return 1.0

    def band(s: int) -> tuple[int, int]:
        # |i * n2 - (s - i) * n1| < least, inside the rectangle
        return max(0, s - n2, (s * n1 - least) // total + 1), min(n1, s, -((-s * n1 - least) // total) - 1)

    low, high = band(0)
    left = np.zeros(high - low + 1)
    for s in range(1, total + 1):
        new_low, new_high = band(s)
        if new_high < new_low:
            return 1.0
        i = np.arange(new_low, new_high + 1)
        wide = np.ones(high - low + 3)  # places beside the band have left it
        wide[1:-1] = left
        from_left, from_below = (np.clip(at - low + 1, 0, len(wide) - 1) for at in (i - 1, i))
        left = (wide[from_left] * i + wide[from_below] * (s - i)) / s
        low, high = new_low, new_high
    return float(left[0]) if low <= n1 <= high else 1.0


def _masked(function, *columns: pd.Series) -> pd.Series:
    known = ~pd.concat(columns, axis=1).isna().any(axis=1)
    out = pd.Series(np.nan, index=columns[0].index, dtype=float)
    if known.any():
        out[known] = function(*(c[known].to_numpy(float) for c in columns))
    return out.astype(object).where(out.notna(), None)


@F.pandas_udf(T.DoubleType())
def f_tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _masked(f_sf, f, df1, df2)


@F.pandas_udf(T.DoubleType())
def chi2_tail(q: pd.Series, df: pd.Series) -> pd.Series:
    return _masked(chi2_sf, q, df)


@F.pandas_udf(T.DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    return _masked(normal_sf, z)


@F.pandas_udf(T.DoubleType())
def normal_score(p: pd.Series) -> pd.Series:
    return _masked(normal_quantile, p)


@F.pandas_udf(T.DoubleType())
def adf_tail(tau: pd.Series) -> pd.Series:
    return _masked(adf_p, tau)


@F.pandas_udf(T.DoubleType())
def ks_tail(n1: pd.Series, n2: pd.Series, statistic: pd.Series) -> pd.Series:
    return _masked(lambda *c: np.array([ks_exact(int(a), int(b), d) for a, b, d in zip(*c)]), n1, n2, statistic)
