"""Distribution tails for test statistics.

Statistics are computed by Spark aggregations; the tail probabilities of a result
row are column expressions too (``t_two_sided_col``, ``norm_two_sided_col``): an ``aggregate`` over the
constant nodes of a double-exponential quadrature. Only the exact Mann-Whitney
distribution of small samples runs in Python. No scipy; ``t_two_sided`` and
``norm_sf`` are the same tails for plain numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_STEPS = np.linspace(-3.6, 3.6, 241)   # of the double-exponential rule; its weights vanish beyond


def _sine_power(power: float, top: float, rest: float) -> float:
    """Integral of (sin x / sin top) ** power from 0 to ``top``; ``rest`` is pi/2 - top.

    Double-exponential quadrature over the part of the range where the
    integrand is above e**-60; that part shrinks like 1/sqrt(power), so the same
    nodes serve every power. Near pi/2 the sine is taken from the distance to
    it, so that high powers keep their digits.
    """
    def log_sine(x: np.ndarray, to_half_pi: np.ndarray) -> np.ndarray:
        return np.where(to_half_pi < 0.8, 0.5 * np.log1p(-np.sin(np.minimum(to_half_pi, 0.8)) ** 2), np.log(np.sin(x)))

    log_top, low, high = float(log_sine(np.float64(top), np.float64(rest))), 0.0, top
    if power > 0:
        for _ in range(200):
            mid = (low + high) / 2
            if mid in (low, high):
                break
            if power * (log_top - math.log(math.sin(mid))) > 60:
                low = mid
            else:
                high = mid
    arc = np.pi / 2 * np.sinh(_STEPS)
    up, down = np.exp(arc), np.exp(-arc)
    weight = np.pi / 4 * np.cosh(_STEPS) / np.cosh(arc) ** 2
    x = low + (top - low) * up / (up + down)
    to_half_pi = rest + (top - low) * down / (up + down)
    keep = x > 0
    value = np.exp(power * (log_sine(x[keep], to_half_pi[keep]) - log_top))
    return float((value * weight[keep]).sum() * (_STEPS[1] - _STEPS[0]) * (top - low))


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom.

    With t = sqrt(df) cot x the tail is the integral of sin**(df - 1) up to x
    over the integral up to pi/2: the same quadrature for every df, and no
    constant to lose digits in when df is large.
    """
    if t is None or df is None or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    if math.isnan(df) or df <= 0:
        return float("nan")
    if t == 0:
        return 1.0
    top, rest = math.atan2(math.sqrt(df), abs(t)), math.atan2(abs(t), math.sqrt(df))
    scale = math.exp((df - 1) * -0.5 * math.log1p(t * t / df))
    return min(1.0, scale * _sine_power(df - 1, top, rest) / _sine_power(df - 1, math.pi / 2, 0.0))


def norm_sf(z: float) -> float:
    """P(Z >= z) for a standard normal."""
    if z is None or math.isnan(z):
        return float("nan")
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def mwu_exact_sf(u: float, n1: int, n2: int) -> float:
    """P(U >= u) under H0 without ties (Gaussian-binomial coefficients)."""
    m, n = int(min(n1, n2)), int(max(n1, n2))
    size = m * n + 1
    # coefficients of prod_{i=1..m} (1 - q^(n+i)) / (1 - q^i)
    poly = [0] * size
    poly[0] = 1
    for i in range(1, m + 1):
        # multiply by (1 - q^(n+i))
        for k in range(size - 1, n + i - 1, -1):
            poly[k] -= poly[k - n - i]
        # divide by (1 - q^i): running sum with stride i
        for k in range(i, size):
            poly[k] += poly[k - i]
    total = sum(poly)
    k0 = int(math.ceil(u - 1e-9))
    return sum(poly[max(k0, 0):]) / total


FOLDS = 60.0   # an integrand is followed until it has fallen by e**-FOLDS


def _nodes() -> Column:
    """Constant array of (at, weight): places in (0, 1) and weights that sum to 1."""
    arc = np.pi / 2 * np.sinh(_STEPS)
    at = 1 / (1 + np.exp(-2 * arc))
    weight = np.pi / 4 * np.cosh(_STEPS) / np.cosh(arc) ** 2 * (_STEPS[1] - _STEPS[0])
    keep = weight > 1e-18
    # as text: one expression to parse instead of a call per node
    return F.expr("array(" + ", ".join(f"named_struct('at', {float(x)!r}D, 'weight', {float(w)!r}D)"
                                       for x, w in zip(at[keep], weight[keep], strict=True)) + ")")


def _integral(low: Column, high: Column, log_value: Callable[[Column], Column]) -> Column:
    """Integral of exp(log_value(x)) from ``low`` to ``high``."""
    total = F.aggregate(_nodes(), F.lit(0.0), lambda s, n: s + n["weight"] * F.exp(log_value(low + (high - low) * n["at"])))
    return (high - low) * total


def t_two_sided_col(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t with ``df`` (1 or more) degrees of freedom.

    With t = sqrt(df) tan(a) the tail is the integral of cos ** (df - 1) from a to pi / 2 over that
    from 0. Both are taken relative to their first value and end where that has
    fallen by ``FOLDS``, so the nodes serve every df. An infinite t gives 0, a NULL or NaN t NULL.
    """
    def log_cos(x: Column) -> Column:  # from the sine: small angles keep their digits
        return F.greatest(0.5 * F.log1p(-F.least(F.sin(x) * F.sin(x), F.lit(1.0))), F.lit(-1e300))

    def from_angle(a: Column) -> Column:
        end = F.least(F.lit(math.pi / 2), F.sqrt(a * a + F.lit(2 * FOLDS) / F.greatest(df - 1, F.lit(1e-9))))
        first = log_cos(a)
        return _integral(a, end, lambda x: (df - 1) * (log_cos(x) - first))

    angle = F.atan2(F.abs(t), F.sqrt(df))
    p = F.exp((df - 1) * -0.5 * F.log1p(t * t / df)) * from_angle(angle) / from_angle(F.lit(0.0))
    return (F.when(t.isNull() | F.isnan(t), F.lit(None).cast("double"))
            .when(F.abs(t) == float("inf"), F.lit(0.0))
            .when(df.isNull() | F.isnan(df) | (df < 1), F.lit(None).cast("double"))
            .otherwise(F.least(F.lit(1.0), p)))


def norm_two_sided_col(z: Column) -> Column:
    """min(1, 2 P(Z >= z)) of a standard normal; NULL or NaN (no spread) gives 1."""
    tail = _integral(z, F.sqrt(z * z + 2 * FOLDS), lambda x: (z * z - x * x) / 2)
    p = F.exp(-z * z / 2) * tail * (2 / math.sqrt(2 * math.pi))
    return F.when(z.isNull() | F.isnan(z) | (z <= 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), p))


#: Products of sample sizes up to which the exact distribution is computed (one number per value of U).
EXACT_PAIRS = 4_000_000


def mwu_p(u: float, n1: int, n2: int, z: float | None, has_ties: bool, method: str = "auto") -> float | None:
    """Two-sided Mann-Whitney p of max(U1, U2).

    ``auto`` is exact when a sample has at most 8 values, there are no ties and the samples make at most
    ``EXACT_PAIRS`` pairs, and the normal approximation otherwise; ``exact`` and ``asymptotic`` force one.
    Without any spread (all values tied) p is 1.
    """
    if method not in ("auto", "exact", "asymptotic"):
        raise ValueError(f"method {method!r}: auto, exact or asymptotic")
    if n1 == 0 or n2 == 0:
        return None
    if method == "exact" or (method == "auto" and min(n1, n2) <= 8 and not has_ties and n1 * n2 <= EXACT_PAIRS):
        if has_ties:
            raise ValueError("no exact Mann-Whitney distribution with ties; use method='asymptotic'")
        if n1 * n2 > EXACT_PAIRS:
            raise ValueError(f"exact Mann-Whitney p needs {n1} x {n2} values, more than {EXACT_PAIRS}; "
                             "use method='asymptotic'")
        return min(1.0, 2.0 * mwu_exact_sf(u, int(n1), int(n2)))
    return 1.0 if z is None or math.isnan(z) else min(1.0, 2.0 * norm_sf(z))


def mwu_p_col(u: Column, n1: Column, n2: Column, z: Column, has_ties: Column, method: str = "auto") -> Column:
    """``mwu_p`` as a column: the normal tail is an expression, Python is asked only where an exact p may be due."""
    if method not in ("auto", "exact", "asymptotic"):
        raise ValueError(f"method {method!r}: auto, exact or asymptotic")
    normal = F.when((n1 > 0) & (n2 > 0), norm_two_sided_col(z))
    if method == "asymptotic":
        return normal

    @F.pandas_udf(T.DoubleType())
    def exact(u: pd.Series, n1: pd.Series, n2: pd.Series, has_ties: pd.Series) -> pd.Series:
        # rows for the approximation are left to it: they get nothing here
        return pd.Series([None if pd.isna(uu) or pd.isna(a) or pd.isna(b)
                          or method == "auto" and (min(a, b) > 8 or ties or a * b > EXACT_PAIRS)
                          else mwu_p(uu, a, b, None, bool(ties), method)
                          for uu, a, b, ties in zip(u, n1, n2, has_ties)], dtype="float64")

    return F.coalesce(exact(u, n1, n2, has_ties), normal)
