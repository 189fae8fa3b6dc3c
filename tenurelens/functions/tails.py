"""Tail probabilities of test statistics that are already aggregated (scalars)."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_tail(x: float, df: float) -> float:
    """P(chi-square with df degrees > x), the regularised upper incomplete gamma function."""
    if df <= 0:
        return 1.0
    a, x = df / 2.0, x / 2.0
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    # continued fraction, evaluated from the front
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = d * c
        h *= step
        if abs(step - 1.0) < 1e-16:
            break
    return scale * h


def kolmogorov_tail(x: float) -> float:
    """P(K > x) for the limiting Kolmogorov distribution."""
    if x <= 0:
        return 1.0
    if x < 1.0:
        # the theta-function form converges fast for small x
        t = math.pi * math.pi / (8.0 * x * x)
        s = sum(math.exp(-((2 * k - 1) ** 2) * t) for k in range(1, 20))
        return min(1.0, max(0.0, 1.0 - math.sqrt(2.0 * math.pi) / x * s))
    s = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2.0 * s))


def ks_two_sample_tail(stat: float, n: int, m: int, method: str = "asymptotic") -> float | None:
    """Two-sided p-value of the two-sample KS statistic, by the same method at every size.

    "asymptotic" is the limiting distribution with a small-sample correction of its argument;
    "exact" the chance that a random lattice path from (0, 0) to (n, m) ever leaves the band
    |i/n - j/m| < stat, which takes n * m steps.
    """
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown method {method!r}")
    if not n or not m:
        return None
    if stat <= 0:
        return 1.0
    if method == "asymptotic":
        en = n * m / (n + m)
        root = math.sqrt(en)
        return kolmogorov_tail(stat * root + 1.0 / (6.0 * root) + (stat * root - 1.0) / (4.0 * en))
    n, m = min(n, m), max(n, m)
    h = round(stat * n * m)
    # share[j]: part of the lattice paths to (i, j) that stayed inside the band
    share = np.zeros(m + 1)
    share[: _band(0, n, m, h)[1] + 1] = 1.0
    for i in range(1, n + 1):
        lo, hi = _band(i, n, m, h)
        j = np.arange(lo, hi + 1)
        # paths(i, j) = paths(i-1, j) + paths(i, j-1), as shares of C(i+j, j)
        from_below = share[lo : hi + 1] * (i / (i + j))
        log_paths = np.concatenate([[0.0], np.cumsum(np.log((i + j[1:]) / j[1:]))])
        row = np.zeros(m + 1)
        carry, start = 0.0, 0
        while start < len(j):
            stop = max(start + 1, int(np.searchsorted(log_paths, log_paths[start] + 600.0)))
            weight = np.exp(log_paths[start:stop] - log_paths[start])
            before = carry * math.exp(log_paths[start - 1] - log_paths[start]) if start else 0.0
            row[lo + start : lo + stop] = (
                np.cumsum(from_below[start:stop] * weight) + before
            ) / weight
            carry, start = row[lo + stop - 1], stop
        share = row
    return float(min(1.0, max(0.0, 1.0 - share[m])))


def _band(i: int, n: int, m: int, h: int) -> tuple[int, int]:
    """First and last column j with |i*m - j*n| < h."""
    return max(0, (i * m - h) // n + 1), min(m, -((-(i * m + h)) // n) - 1)
