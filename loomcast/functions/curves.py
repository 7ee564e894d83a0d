"""Numeric curve helpers used inside tasks: spline, loess decomposition, trend rank counts."""

from __future__ import annotations

import numpy as np


# -- cubic spline -------------------------------------------------------------------------


def spline_moments(x, y, left_end: bool, right_end: bool):
    """Second derivatives of the interpolating cubic spline at the knots.

    A true end uses the not-a-knot condition; a cut end is set to zero, which no
    longer matters some dozens of knots away.
    """
    n = len(x)
    h = np.diff(x).astype(float)
    slope = np.diff(y) / h
    low, high = h[:-1].copy(), h[1:].copy()
    main = 2 * (low + high)
    right = 6 * np.diff(slope)
    if left_end:
        ratio = h[0] / h[1]
        main[0] += h[0] * (1 + ratio)
        high[0] -= h[0] * ratio
    if right_end:
        ratio = h[-1] / h[-2]
        main[-1] += h[-1] * (1 + ratio)
        low[-1] -= h[-1] * ratio
    low, main, high, right = low.tolist(), main.tolist(), high.tolist(), right.tolist()
    for k in range(1, n - 2):
        factor = low[k] / main[k - 1]
        main[k] -= factor * high[k - 1]
        right[k] -= factor * right[k - 1]
    moments = np.zeros(n)
    inner = [0.0] * (n - 2)
    inner[-1] = right[-1] / main[-1]
    for k in range(n - 4, -1, -1):
        inner[k] = (right[k] - high[k] * inner[k + 1]) / main[k]
    moments[1:-1] = inner
    if left_end:
        moments[0] = moments[1] + h[0] / h[1] * (moments[1] - moments[2])
    if right_end:
        moments[-1] = moments[-2] + h[-1] / h[-2] * (moments[-2] - moments[-3])
    return moments


# -- loess decomposition (Cleveland et al. 1990) ------------------------------------------


def _tricube(n: int, span: int, at: np.ndarray):
    """Neighbour positions and tricube weights of each place in ``at`` on 0 … n-1."""
    width = min(span, n)
    start = np.clip(np.floor(at).astype(int) - (width - 1) // 2, 0, n - width)
    places = start[:, None] + np.arange(width)
    reach = np.maximum(at - start, start + width - 1 - at)
    if span > n:
        reach = reach + (span - n) // 2
    distance = np.abs(places - at[:, None])
    share = np.minimum(distance / np.maximum(reach, 1e-300)[:, None], 1)
    w = np.where(distance <= 0.001 * reach[:, None], 1.0, (1 - share**3) ** 3)
    return places, np.where(distance <= 0.999 * reach[:, None], w, 0.0)


def loess(y, span: int, at=None, weights=None):
    """Local linear regression on positions 0 … n-1 with tricube weights, at positions ``at``.

    ``y`` may hold several series of one length as rows; ``weights`` has its shape.
    """
    flat = np.ndim(y) == 1
    rows = np.atleast_2d(y)
    extra = None if weights is None else np.atleast_2d(weights)
    n = rows.shape[1]
    at = np.arange(n, dtype=float) if at is None else np.asarray(at, float)
    out = np.empty((len(rows), len(at)))
    chunk = max(1, 2_000_000 // (min(span, n) * len(rows)))
    for begin in range(0, len(at), chunk):
        x = at[begin : begin + chunk]
        places, kernel = _tricube(n, span, x)
        w = kernel[None] if extra is None else kernel * extra[:, places]
        total = w.sum(axis=2)
        good = total > 0
        w = w / np.where(good, total, 1.0)[:, :, None]
        centre = (w * places).sum(axis=2)
        offset = places - centre[:, :, None]
        spread = (w * offset**2).sum(axis=2)
        tilt = np.where(
            np.sqrt(spread) > 0.001 * (n - 1), (x - centre) / np.where(spread > 0, spread, 1.0), 0.0
        )
        fit = (w * (1 + tilt[:, :, None] * offset) * rows[:, places]).sum(axis=2)
        nearest = rows[:, np.clip(np.rint(x).astype(int), 0, n - 1)]
        out[:, begin : begin + chunk] = np.where(good, fit, nearest)
    return out[0] if flat else out


def _smooth_phases(loose, period: int, span: int, weights):
    """Smooth each phase of the cycle, one period beyond both ends."""
    n = len(loose)
    cycle = np.empty(n + 2 * period)
    longer = n % period
    for phases, length in ((np.arange(longer), n // period + 1), (np.arange(longer, period), n // period)):
        if len(phases) == 0:
            continue
        places = phases[:, None] + period * np.arange(length)
        part = None if weights is None else weights[places]
        smooth = loess(loose[places], span, np.arange(-1, length + 1), part)
        cycle[phases[:, None] + period * np.arange(length + 2)] = smooth
    return cycle


def _running_mean(y, width: int):
    total = np.cumsum(np.concatenate(([0.0], y)))
    return (total[width:] - total[:-width]) / width


def _odd_at_least(value: float) -> int:
    whole = int(np.ceil(value))
    return whole if whole % 2 else whole + 1


def loess_decompose(y, period: int, robust: bool = False, seasonal: int = 7):
    """Season, trend and remainder by repeated loess smoothing."""
    y = np.asarray(y, float)
    n = len(y)
    if period < 2 or n < 2 * period:
        raise ValueError("two full periods are needed")
    trend_span = _odd_at_least(1.5 * period / (1 - 1.5 / seasonal))
    low_span = _odd_at_least(period + 1)
    inner, outer = (2, 15) if robust else (5, 0)
    weights = None
    trend, season = np.zeros(n), np.zeros(n)
    for turn in range(outer + 1):
        for _ in range(inner):
            cycle = _smooth_phases(y - trend, period, seasonal, weights)
            low = _running_mean(_running_mean(_running_mean(cycle, period), period), 3)
            season = cycle[period : period + n] - loess(low, low_span)
            trend = loess(y - season, trend_span, weights=weights)
        if turn < outer:
            gap = np.abs(y - trend - season)
            bound = 6 * np.median(gap)
            share = gap / bound if bound > 0 else np.zeros(n)
            weights = np.where(share <= 0.001, 1.0, (1 - np.minimum(share, 1) ** 2) ** 2)
            weights = np.where(share <= 0.999, weights, 0.0)
    return season, trend, y - season - trend


# -- pair counts for rank trends ----------------------------------------------------------


def _pairs_not_rising(z) -> int:
    """Number of pairs i < j with z[j] <= z[i], by bottom-up merging in whole-array steps."""
    n = len(z)
    rank = np.unique(z, return_inverse=True)[1].astype(np.int64)
    levels = int(rank.max()) + 1
    total = 0
    width = 1
    place = np.arange(n)
    while width < n:
        pair = place // (2 * width)
        order = np.argsort(pair * levels + rank, kind="stable")
        on_left = (place[order] // width) % 2 == 0
        group, ranks = pair[order], rank[order]
        left_so_far = np.cumsum(on_left)
        # left members with a rank strictly below, counted up to the start of each run of ties
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (ranks[1:] != ranks[:-1])))
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        before_run = np.where(run_start > 0, left_so_far[run_start - 1], 0)
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        group_start = np.maximum.accumulate(np.where(new_group, np.arange(n), 0))
        before_group = np.where(group_start > 0, left_so_far[group_start - 1], 0)
        lefts = np.bincount(group, weights=on_left)[group]
        total += int((lefts - (before_run - before_group))[~on_left].sum())
        width *= 2
    return total


def kendall_s(y) -> int:
    """Sum of sign(y[j] - y[i]) over i < j."""
    falling_or_tied = _pairs_not_rising(y)
    n = len(y)
    ties = np.unique(y, return_counts=True)[1].astype(np.int64)
    tied = int((ties * (ties - 1) // 2).sum())
    rising = n * (n - 1) // 2 - falling_or_tied
    return rising - (falling_or_tied - tied)


def median_slope(y, x=None) -> float:
    """Median of (y[j] - y[i]) / (x[j] - x[i]) over i < j, by bisection on counts of pairs.

    ``x`` rises strictly; without it the places 0, 1, … are taken.
    """
    y = np.asarray(y, float)
    n = len(y)
    pairs = n * (n - 1) // 2
    x = np.arange(n) if x is None else np.asarray(x, float)
    step = np.abs(np.diff(y) / np.diff(x)).max()
    if step == 0:
        return 0.0

    def at_rank(rank: int) -> float:
        low, high = -step * (1 + 1e-12), step * (1 + 1e-12)
        for _ in range(80):
            middle = (low + high) / 2
            if middle in (low, high):
                break
            if _pairs_not_rising(y - middle * x) >= rank:
                high = middle
            else:
                low = middle
        return high

    upper = at_rank(pairs // 2 + 1)
    return upper if pairs % 2 else (at_rank(pairs // 2) + upper) / 2
