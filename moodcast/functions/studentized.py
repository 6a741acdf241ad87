"""Studentised range distribution (numerical integration, numpy).

P(Q <= q; k, nu) = int_0^inf f_nu(s) W_k(q s) ds with
W_k(w) = k int phi(z) [Phi(z) - Phi(z - w)]^(k-1) dz and f_nu the
density of a chi variable over sqrt(nu).  Both integrals use composite
Gauss-Legendre rules.  Used on one row per group pair only.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

_GL_X, _GL_W = np.polynomial.legendre.leggauss(24)

# Phi on a grid; between its points a Taylor series of six terms.
_GRID_STEP, _GRID_END = 1.0 / 64.0, 9.0
_GRID = np.arange(-_GRID_END, _GRID_END + _GRID_STEP / 2, _GRID_STEP)
_GRID_CDF = np.array([0.5 * math.erfc(-x / math.sqrt(2.0)) for x in _GRID])


def _phi_cdf(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, -_GRID_END, _GRID_END)
    at = np.rint((x + _GRID_END) / _GRID_STEP).astype(np.int64)
    g = _GRID[at]
    d = x - g
    # The derivatives of the density are Hermite polynomials times it.
    h2, h3 = g * g - 1.0, g * (g * g - 3.0)
    h4, h5 = g * h3 - 3.0 * h2, g * (g * h3 - 3.0 * h2) - 4.0 * h3
    series = 1.0 - d * (g / 2.0 - d * (h2 / 6.0 - d * (h3 / 24.0 - d * (h4 / 120.0 - d * h5 / 720.0))))
    return _GRID_CDF[at] + np.exp(-0.5 * g * g) / math.sqrt(2.0 * math.pi) * d * series


def _nodes(lo: float, hi: float, panels: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.linspace(lo, hi, panels + 1)
    half = (edges[1:] - edges[:-1]) / 2.0
    mid = (edges[1:] + edges[:-1]) / 2.0
    x = (mid[:, None] + half[:, None] * _GL_X[None, :]).ravel()
    w = (half[:, None] * _GL_W[None, :]).ravel()
    return x, w


_Z, _ZW = _nodes(-8.5, 8.5, 12)
_PHI_Z = np.exp(-0.5 * _Z ** 2) / math.sqrt(2.0 * math.pi)
_CDF_Z = _phi_cdf(_Z)


def _range_cdf(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k standard normals <= w), for each w."""
    w = np.atleast_1d(w)
    inner = _CDF_Z[None, :] - _phi_cdf(_Z[None, :] - w[:, None])
    inner = np.clip(inner, 0.0, 1.0)
    return k * (inner ** (k - 1) * _PHI_Z[None, :] * _ZW[None, :]).sum(axis=1)


def ptukey(q: float, k: int, df: float) -> float:
    """P(Q <= q) of the studentised range with k groups, df error dof."""
    if q is None or not np.isfinite(q) or q <= 0:
        return 0.0
    # The density in t = s - 1, up to a factor: log1p keeps its digits where
    # the curve is narrow, so one formula holds for any df, and the factor
    # follows from the density's own sum.
    sd = 1.0 / math.sqrt(2.0 * df)
    lo, hi = max(1e-9 - 1.0, -14.0 * sd), 14.0 * sd
    if df < 10:
        lo, hi = 1e-9 - 1.0, 14.0 * sd + 4.0
    t, wt = _nodes(lo, hi, 16)
    log_f = (df - 1.0) * np.log1p(t) - df * (t + t * t / 2.0)
    dens = np.exp(log_f - log_f.max()) * wt
    return float(min(1.0, (dens * _range_cdf(q * (1.0 + t), k)).sum() / dens.sum()))


def tukey_sf(q: float, k: int, df: float) -> float:
    return float(max(0.0, 1.0 - ptukey(q, k, df)))


@lru_cache(maxsize=256)
def qtukey(p: float, k: int, df: float) -> float:
    """q with P(Q <= q) = p: a secant between two sides that come closer,
    halved where the secant does not help."""
    lo, hi = 0.0, 1.0
    f_lo, f_hi = -p, ptukey(1.0, k, df) - p
    while f_hi < 0 and hi < 1e300:
        lo, f_lo = hi, f_hi
        hi *= 2.0
        f_hi = ptukey(hi, k, df) - p
    for _ in range(200):
        if hi - lo <= 1e-13 * hi:
            break
        width = hi - lo
        q = lo - f_lo * width / (f_hi - f_lo) if f_hi > f_lo else (lo + hi) / 2.0
        for at in (q, (lo + hi) / 2.0):
            if not lo < at < hi:
                continue
            f = ptukey(at, k, df) - p
            if f < 0:
                lo, f_lo = at, f
            else:
                hi, f_hi = at, f
            if abs(f) < 1e-14:
                return at
            # A step past the root, by the slope there, closes the other side.
            step = 2.0 * abs(f) * (hi - lo) / (f_hi - f_lo) if f_hi > f_lo else 0.0
            near = at + step if f < 0 else at - step
            if lo < near < hi:
                f = ptukey(near, k, df) - p
                if f < 0:
                    lo, f_lo = near, f
                else:
                    hi, f_hi = near, f
            if hi - lo < width / 4.0:
                break
    return (lo + hi) / 2.0
