"""Upper tails of the normal, chi-square and F distributions for a few driver scalars."""

from __future__ import annotations

import math

_TINY = 1e-300
_EPS = 1e-15


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) by the regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    a, y = df / 2, x / 2
    front = math.exp(-y + a * math.log(y) - math.lgamma(a))
    if y < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1
            term *= y / n
            total += term
        return max(0.0, 1 - total * front)
    # Lentz continued fraction keeps full relative accuracy far in the tail
    b = y + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or _TINY)
        c = b + an / c or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS:
            return front * h
    raise ArithmeticError("the upper gamma fraction did not converge")


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or _TINY)
    h = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + num * d or _TINY)
            c = 1 + num / c or _TINY
            h *= d * c
        if abs(d * c - 1) < _EPS:
            return h
    raise ArithmeticError("the beta fraction did not converge")


def beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def f_sf(x: float, df1: float, df2: float) -> float:
    if x <= 0:
        return 1.0
    return beta_regularised(df2 / 2, df1 / 2, df2 / (df2 + df1 * x))
