"""STL / MSTL decomposition for one regular daily series (numpy).

STL (Cleveland et al. 1990), non-robust: an inner loop of cycle-subseries
loess, a low-pass filter (moving averages + loess) and trend loess.  MSTL
(Bandara et al. 2021) runs STL once per period in turn, twice, each time
adding the period's seasonal back before re-estimating it.

Loess here is degree 1 with tricube weights on an integer grid.  For an
interior point the window is symmetric, so the local line's value at the
centre is the weighted mean: interior points are one convolution with a
fixed kernel, and only the (q-1)/2 points at each end are fitted one by
one.  A period that needs more than two cycles of data is skipped.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def _odd(x: float) -> int:
    k = int(np.ceil(x))
    return k if k % 2 else k + 1


def _tricube(r: np.ndarray) -> np.ndarray:
    w = np.clip(1.0 - np.abs(r) ** 3, 0.0, None) ** 3
    w[np.abs(r) >= 0.999] = 0.0
    w[np.abs(r) <= 0.001] = 1.0
    return w


def _fit_many(y: np.ndarray, x0s: np.ndarray, q: int) -> np.ndarray:
    """Local linear fits of y (at 0..n-1) evaluated at every x0 (vectorised).

    Window: the q nearest grid points (all points when q >= n, with the
    bandwidth widened by (q - n) / 2 as in the original STL)."""
    n = len(y)
    x0s = np.asarray(x0s, dtype=float)
    if q >= n:
        L = n
        lo = np.zeros(len(x0s), dtype=int)
        h = np.maximum(x0s, n - 1 - x0s) + (q - n) / 2.0
    else:
        L = q
        lo = np.clip(np.round(x0s).astype(int) - (q - 1) // 2, 0, n - q)
        h = np.maximum(x0s - lo, lo + q - 1 - x0s)
    xs = lo[:, None] + np.arange(L)[None, :]
    ys = y[xs]
    h = np.maximum(h, 1e-9)
    w = _tricube((xs - x0s[:, None]) / h[:, None])
    sw = w.sum(1)
    bad = sw <= 0
    w[bad] = 1.0
    w = w / w.sum(1, keepdims=True)
    xm = (w * xs).sum(1)
    ym = (w * ys).sum(1)
    var = (w * (xs - xm[:, None]) ** 2).sum(1)
    cov = (w * (xs - xm[:, None]) * (ys - ym[:, None])).sum(1)
    b = np.where(var > 1e-12, cov / np.where(var > 1e-12, var, 1.0), 0.0)
    return ym + b * (x0s - xm)


def loess(y: np.ndarray, q: int, extend: int = 0) -> np.ndarray:
    """Smooth y with window q; ``extend`` extra points are extrapolated on
    each side (output length n + 2*extend)."""
    n = len(y)
    q = max(3, q)
    out = np.empty(n + 2 * extend)
    half = (q - 1) // 2
    if q < n:
        offs = np.arange(-half, half + 1, dtype=float)
        k = _tricube(offs / max(half, 1e-9))
        k = k / k.sum()
        inner = np.convolve(y, k[::-1], mode="valid")         # centres half .. n-1-half
        out[extend + half: extend + n - half] = inner
        edge = np.r_[np.arange(-extend, half), np.arange(n - half, n + extend)]
    else:
        edge = np.arange(-extend, n + extend)
    if len(edge):
        out[edge + extend] = _fit_many(y, edge, q)
    return out


@lru_cache(maxsize=256)
def _loess_operator(n: int, q: int, extend: int) -> np.ndarray:
    """The loess smoother of a length-n grid as a matrix ((n + 2*extend) x n):
    every output is a fixed linear combination of the inputs, so it is built
    once per (n, q, extend) and applied to many series by one product."""
    q = max(3, q)
    x0s = np.arange(-extend, n + extend, dtype=float)
    if q >= n:
        L = n
        lo = np.zeros(len(x0s), dtype=int)
        h = np.maximum(x0s, n - 1 - x0s) + (q - n) / 2.0
    else:
        L = q
        lo = np.clip(np.round(x0s).astype(int) - (q - 1) // 2, 0, n - q)
        h = np.maximum(x0s - lo, lo + q - 1 - x0s)
    xs = lo[:, None] + np.arange(L)[None, :]
    w = _tricube((xs - x0s[:, None]) / np.maximum(h, 1e-9)[:, None])
    w[w.sum(1) <= 0] = 1.0
    w = w / w.sum(1, keepdims=True)
    xm = (w * xs).sum(1, keepdims=True)
    var = (w * (xs - xm) ** 2).sum(1, keepdims=True)
    slope = np.where(var > 1e-12, (x0s[:, None] - xm) / np.where(var > 1e-12, var, 1.0), 0.0)
    coef = w + slope * w * (xs - xm)               # value = sum coef_i * y_i
    M = np.zeros((len(x0s), n))
    np.add.at(M, (np.repeat(np.arange(len(x0s)), L), xs.ravel()), coef.ravel())
    return M


def _moving_average(x: np.ndarray, k: int) -> np.ndarray:
    c = np.cumsum(np.r_[0.0, x])
    return (c[k:] - c[:-k]) / k


def stl(y: np.ndarray, period: int, seasonal: int = 7, inner: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(seasonal, trend) of y for one period."""
    n = len(y)
    ns = _odd(seasonal)
    nt = _odd(1.5 * period / (1 - 1.5 / ns))
    nl = _odd(period)
    trend = np.zeros(n)
    season = np.zeros(n)
    for _ in range(inner):
        detr = y - trend
        c = np.zeros(n + 2 * period)
        # cycle-subseries smoothing, one cycle beyond each end; subseries of
        # equal length share one smoother matrix
        for length in {len(range(k, n, period)) for k in range(period)}:
            ks = np.array([k for k in range(period) if len(range(k, n, period)) == length])
            Y = detr[ks[:, None] + period * np.arange(length)[None, :]]
            sm = Y @ _loess_operator(length, ns, 1).T
            c[ks[:, None] + period * np.arange(length + 2)[None, :]] = sm
        low = _moving_average(_moving_average(_moving_average(c, period), period), 3)
        low = loess(low, nl)
        season = c[period: period + n] - low
        trend = loess(y - season, nt)
    return season, trend


def mstl(y: np.ndarray, periods: list[int], iterations: int = 2) -> dict[str, np.ndarray]:
    """trend, one seasonal per usable period, remainder (sum = y exactly)."""
    n = len(y)
    periods = [p for p in sorted(periods) if n >= 2 * p]
    seas = {p: np.zeros(n) for p in periods}
    trend = y.copy()
    if periods:
        deseas = y.copy()
        for _ in range(iterations):
            for i, p in enumerate(periods):
                deseas = deseas + seas[p]
                seas[p], trend = stl(deseas, p, seasonal=7 + 4 * (i + 1))
                deseas = deseas - seas[p]
    else:
        trend = loess(y, _odd(min(n, 15)))
    out = {"trend": trend, **{f"seasonal_{p}": seas[p] for p in periods}}
    out["remainder"] = y - trend - sum(seas.values()) if periods else y - trend
    return out
