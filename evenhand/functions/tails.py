"""Tail probabilities for the significance tests.

Spark has no error function, so these few lines run in Python, on the one row per test that
is left after aggregation.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

METHODS = ("asymptotic", "exact")


def chi_square_tail(x: float, dof: int) -> float:
    """P(X >= x) for a chi-square variable: the upper incomplete gamma function, by its series
    below the mean and by a continued fraction above, both scaled in logarithms."""
    if x <= 0 or dof < 1:
        return 1.0
    a, half = dof / 2.0, x / 2.0
    scale = a * math.log(half) - half - math.lgamma(a)
    if half < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= half / n
            total += term
        return min(1.0, max(0.0, 1.0 - total * math.exp(scale)))
    # Lentz's method for 1 / (half + 1 - a - 1 (1 - a) / (half + 3 - a - ...))
    tiny = 1e-300
    b = half + 1 - a
    c, d = 1 / tiny, 1 / (b or tiny)
    h = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, max(0.0, math.exp(scale) * h))


def rank_sum_p(n1: int, n2: int, u: float, ties: float, method: str = "asymptotic") -> float:
    """Two-sided p of the U statistic: the normal tail with tie and continuity correction, or
    counted out exactly, which needs values without ties and time as n1 * n2."""
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}, not {method!r}")
    if n1 < 2 or n2 < 2:
        return 1.0
    u = max(u, n1 * n2 - u)
    if method == "exact":
        if ties:
            raise ValueError("the exact distribution is that of values without ties")
        if n1 * n2 > EXACT_VALUES:
            raise ValueError(f"{n1} x {n2} rows: the exact distribution is counted out up to {EXACT_VALUES} "
                             "values of U; take the asymptotic one for more")
        counts = _u_counts(n1, n2)
        tail = sum(counts[int(math.ceil(u)):])
        return min(1.0, 2.0 * tail / sum(counts))
    n = n1 + n2
    spread = n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1)))
    if spread <= 0:
        return 1.0
    z = (u - n1 * n2 / 2.0 - 0.5) / math.sqrt(spread)
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


# Values of U that are counted out, one number each; beyond, the tail is that of the normal distribution.
EXACT_VALUES = 1_000_000


def _u_counts(m: int, n: int) -> list[int]:
    """How many orderings give each value of U: the coefficients of the Gaussian binomial
    [m+n choose m], built factor by factor as (1 - q^(n+i)) / (1 - q^i)."""
    m, n = min(m, n), max(m, n)
    size = m * n + 1
    counts = [1] + [0] * (size - 1)
    for i in range(1, m + 1):
        for k in range(size - 1, n + i - 1, -1):
            counts[k] -= counts[k - n - i]
        for k in range(i, size):
            counts[k] += counts[k - i]
    return counts


@F.pandas_udf(T.DoubleType())
def chi_square_tail_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([
        None if pd.isna(a) else chi_square_tail(float(a), int(b))
        for a, b in zip(x, dof, strict=True)], dtype="float64")


def rank_sum_p_udf(method: str = "asymptotic"):
    @F.pandas_udf(T.DoubleType())
    def p(n1: pd.Series, n2: pd.Series, u: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series([
            rank_sum_p(int(a), int(b), float(c), float(d), method)
            for a, b, c, d in zip(n1, n2, u, ties, strict=True)], dtype="float64")

    return p
