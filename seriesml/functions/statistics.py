"""Distribution functions for statistics that reach the driver as single numbers."""

from __future__ import annotations

import math


def chi_squared_tail(x: float, dof: float) -> float:
    """Probability of a chi-squared value above `x` (Abramowitz & Stegun 6.5.29 and 6.5.31)."""
    a, z = dof / 2, x / 2
    if z <= 0:
        return 1.0
    scale = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= z / n
            total += term
        return 1 - scale * total
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h
