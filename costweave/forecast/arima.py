"""ARMA order search by Hannan-Rissanen regression (numpy, one series).

d (0 or 1) is chosen first with the KPSS level-stationarity test (Kwiatkowski
et al. 1992; 5 % critical value 0.463), because AICc is not comparable
across differencing orders.  Each (p, q) with p, q <= 3 is then fitted by
two linear least-squares stages (Hannan & Rissanen 1982): a long AR gives
innovation estimates, then w_t is regressed on an intercept, p lags of w
and q lags of the innovations.  Every candidate of a series is scored on
the same rows so the AICc values are comparable.  Forecasts recurse with
future innovations set to zero and are integrated back when d = 1.
"""

from __future__ import annotations

import numpy as np

MAX_P = 3
MAX_Q = 3
KPSS_CRIT_5PCT = 0.463


def kpss_stat(y: np.ndarray) -> float:
    n = len(y)
    e = y - y.mean()
    s = np.cumsum(e)
    lags = int(np.floor(4 * (n / 100.0) ** 0.25))
    lrv = (e @ e) / n
    for k in range(1, lags + 1):
        w = 1.0 - k / (lags + 1.0)
        lrv += 2.0 * w * (e[k:] @ e[:-k]) / n
    return float((s @ s) / (n * n * lrv)) if lrv > 0 else 0.0


def choose_d(y: np.ndarray) -> int:
    if len(y) < 10 or np.allclose(y, y[0]):
        return 0
    return 1 if kpss_stat(y) > KPSS_CRIT_5PCT else 0


def _lagmat(x: np.ndarray, lags: int, rows: slice) -> np.ndarray:
    idx = np.arange(len(x))[rows]
    return np.column_stack([x[idx - k] for k in range(1, lags + 1)]) if lags else np.empty((len(idx), 0))


def _long_ar_residuals(w: np.ndarray, m: int) -> np.ndarray:
    e = np.zeros(len(w))
    if m == 0 or len(w) <= 2 * m + 1:
        return w - w.mean()
    rows = slice(m, len(w))
    X = np.column_stack([np.ones(len(w) - m), _lagmat(w, m, rows)])
    beta, *_ = np.linalg.lstsq(X, w[rows], rcond=None)
    e[m:] = w[rows] - X @ beta
    return e


def fit_forecast(y: np.ndarray, p: int, q: int, d: int, h: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(AICc, h-step forecast of y, in-sample fitted y)."""
    w = np.diff(y) if d else y.astype(float)
    n = len(w)
    m = min(max(MAX_P, MAX_Q) + 5, max(1, n // 4))
    e = _long_ar_residuals(w, m)
    start = m + max(MAX_P, MAX_Q)                     # same rows for every candidate
    if n - start < p + q + 3:
        return float("inf"), np.full(h, np.nan), np.full(len(y), np.nan)
    rows = slice(start, n)
    X = np.column_stack([np.ones(n - start), _lagmat(w, p, rows), _lagmat(e, q, rows)])
    beta, *_ = np.linalg.lstsq(X, w[rows], rcond=None)
    resid = w[rows] - X @ beta
    n_eff = len(resid)
    sigma2 = max(resid @ resid / n_eff, 1e-12)
    k = p + q + 2                                     # coefficients + intercept + variance
    loglik = -0.5 * n_eff * (np.log(2 * np.pi * sigma2) + 1)
    aicc = -2 * loglik + 2 * k + (2 * k * (k + 1) / (n_eff - k - 1) if n_eff - k - 1 > 0 else np.inf)
    c, phi, theta = beta[0], beta[1:1 + p], beta[1 + p:]
    # fitted values in w space (undefined before the first scored row)
    w_fit = np.full(n, np.nan)
    w_fit[start:] = X @ beta
    ww = list(w)
    ee = list(e)
    ee[start:] = list(resid)
    fc = []
    for _ in range(h):
        val = c + sum(phi[i] * ww[-1 - i] for i in range(p)) + sum(theta[j] * ee[-1 - j] for j in range(q))
        ww.append(val)
        ee.append(0.0)
        fc.append(val)
    fc = np.array(fc)
    if d:
        fc = y[-1] + np.cumsum(fc)
        fitted = np.r_[np.nan, y[:-1] + w_fit]
    else:
        fitted = w_fit
    return float(aicc), fc, fitted


def orders() -> list[tuple[int, int]]:
    return [(p, q) for p in range(MAX_P + 1) for q in range(MAX_Q + 1)]
