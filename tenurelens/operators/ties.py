"""Efron's correction for tied events, for any number of ties at a time in the same few steps.

With d events tied at a time, s the sum over the risk set and e the sum over the tied events,
every sum here runs over l = 0..d-1 with f = l/d and phi = s - f e. Three ways, by what is exact:

* d up to FEW: term by term, all times together;
* r = e/s up to one half: phi = s (1 - f r), so sums are power series in r whose coefficients
  are the moments sum f^j; all terms are positive;
* else phi = (e/d)(z - l) with z = s d/e < 2d, so sums are differences of log-gamma, digamma and
  trigamma at z + 1 and z - d + 1, which lose no digits there.
"""

from __future__ import annotations

import math

import numpy as np

FEW = 64
TERMS = 60
#: B_2k / (2k)! of the Euler-Maclaurin sum and the asymptotic series
BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730, 7 / 6)
SHIFT = 12


def _raised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x + SHIFT, and x + 0..SHIFT-1 as rows."""
    return x + SHIFT, x[None, :] + np.arange(SHIFT)[:, None]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x >= 1."""
    y, steps = _raised(np.asarray(x, dtype=float))
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi)
    for k, b in enumerate(BERNOULLI, 1):
        out += b / (2 * k * (2 * k - 1)) * y ** (1 - 2 * k)
    return out - np.log(steps).sum(0)


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of log_gamma, for x >= 1."""
    y, steps = _raised(np.asarray(x, dtype=float))
    out = np.log(y) - 0.5 / y
    for k, b in enumerate(BERNOULLI, 1):
        out -= b / (2 * k) * y ** (-2 * k)
    return out - (1 / steps).sum(0)


def trigamma(x: np.ndarray) -> np.ndarray:
    """The derivative of digamma, for x >= 1."""
    y, steps = _raised(np.asarray(x, dtype=float))
    out = 1 / y + 0.5 / y**2
    for k, b in enumerate(BERNOULLI, 1):
        out += b * y ** (-2 * k - 1)
    return out + (1 / steps**2).sum(0)


def moments(d: np.ndarray, n: int) -> np.ndarray:
    """Row j holds sum over l < d of (l/d)^j, for d > FEW, by the Euler-Maclaurin sum."""
    out = np.empty((n, len(d)))
    out[0] = d
    for j in range(1, n):
        row = d / (j + 1) - 0.5
        falling, power = 1.0, 1.0
        for k, b in enumerate(BERNOULLI, 1):
            order = 2 * k - 1
            # j (j - 1) ... (j - order + 1): zero once the derivative vanishes
            for i in range(max(order - 2, 0), order):
                falling *= max(j - i, 0)
            power = d ** -float(order)
            # at l = 0 only the derivative of order j is not zero
            at_zero = falling * power if order == j else 0.0
            row = row + b / math.factorial(2 * k) * (falling * power - at_zero)
        out[j] = row
    return out


def _few(d: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    out = np.zeros((6, len(d)))
    for step in range(int(d.max(initial=0))):
        on = np.flatnonzero(d > step)
        f = step / d[on]
        phi = s[on] - f * e[on]
        inverse = 1 / phi
        out[0, on] += np.log(phi)
        out[1, on] += inverse
        out[2, on] += f * inverse
        out[3, on] += inverse**2
        out[4, on] += f * inverse**2
        out[5, on] += f**2 * inverse**2
    return out


def _series(d: np.ndarray, s: np.ndarray, r: np.ndarray) -> np.ndarray:
    m = moments(d, TERMS + 2)
    power = r[None, :] ** np.arange(TERMS)[:, None]
    j = np.arange(TERMS)[:, None]
    squares = (j + 1) * power
    return np.stack([
        d * np.log(s) - (power[1:] * m[1:TERMS] / j[1:]).sum(0),
        (power * m[:TERMS]).sum(0) / s,
        (power * m[1 : TERMS + 1]).sum(0) / s,
        (squares * m[:TERMS]).sum(0) / s**2,
        (squares * m[1 : TERMS + 1]).sum(0) / s**2,
        (squares * m[2 : TERMS + 2]).sum(0) / s**2,
    ])


def _gammas(d: np.ndarray, e: np.ndarray, r: np.ndarray) -> np.ndarray:
    z = d / r
    high, low = z + 1, z - d + 1
    h, t = digamma(high) - digamma(low), trigamma(low) - trigamma(high)
    return np.stack([
        d * np.log(e / d) + log_gamma(high) - log_gamma(low),
        d / e * h,
        (z * h - d) / e,
        (d / e) ** 2 * t,
        d / e**2 * (z * t - h),
        (z * z * t - 2 * z * h + d) / e**2,
    ])


def tie_sums(d: np.ndarray, s0: np.ndarray, e0: np.ndarray, efron: bool) -> np.ndarray:
    """Per time: sums over l of ln phi, 1/phi, f/phi, 1/phi^2, f/phi^2, f^2/phi^2.

    Zero where there is no event; f is 0 throughout for Breslow's method.
    """
    out = np.zeros((6, len(d)))
    if not efron:
        has = np.flatnonzero(d > 0)
        n, s = d[has], s0[has]
        out[0, has], out[1, has], out[3, has] = n * np.log(s), n / s, n / s**2
        return out
    few = np.flatnonzero((d > 0) & (d <= FEW))
    out[:, few] = _few(d[few], s0[few], e0[few])
    many = np.flatnonzero(d > FEW)
    n, s = d[many], s0[many]
    # nobody outside the tied events is at risk where r is 1; rounding must not go beyond
    r = np.minimum(e0[many] / s, 1.0)
    wide = r <= 0.5
    out[:, many[wide]] = _series(n[wide], s[wide], r[wide])
    out[:, many[~wide]] = _gammas(n[~wide], (s * r)[~wide], r[~wide])
    return out
