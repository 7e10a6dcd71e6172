"""Poisson(1) weights drawn from a uniform 32-bit hash, without ``rand()``.

``rand()`` depends on how rows land in partitions, so a re-run (or a retried
task) could draw different weights. Here the weight of a (unit, replicate)
pair is a fixed function of its hash: ``u`` uniform in [0, 2**32) maps to the
smallest ``k`` with ``u < floor(2**32 * CDF(k))``, the inverse CDF.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import TWO_32


def poisson_thresholds(lam: float = 1.0, max_k: int = 30) -> list[int]:
    """floor(2**32 * CDF(k)) for k = 0, 1, ... until it reaches 2**32 - 1."""
    out, cdf, pmf = [], 0.0, math.exp(-lam)
    for k in range(max_k):
        cdf += pmf
        t = min(int(math.floor(TWO_32 * cdf)), TWO_32 - 1)
        out.append(t)
        if t >= TWO_32 - 1:
            break
        pmf *= lam / (k + 1)
    return out


def poisson_weight(u: Column, lam: float = 1.0) -> Column:
    """Inverse-CDF Poisson draw from ``u`` (bigint in [0, 2**32)) as a CASE chain."""
    ts = poisson_thresholds(lam)
    expr = None
    for k, t in enumerate(ts):
        expr = F.when(u < F.lit(t), F.lit(k)) if expr is None else expr.when(u < F.lit(t), F.lit(k))
    return expr.otherwise(F.lit(len(ts)))


def poisson_weight_hex(hex8: Column, lam: float = 1.0) -> Column:
    """The same draw from ``u`` written as exactly 8 lowercase hex digits.

    Fixed-width hex strings sort like the numbers they encode, so comparing
    the digest slice with hex thresholds skips the hex-to-number conversion.
    """
    ts = poisson_thresholds(lam)
    expr = None
    for k, t in enumerate(ts):
        lit = F.lit(format(t, "08x"))
        expr = F.when(hex8 < lit, F.lit(k)) if expr is None else expr.when(hex8 < lit, F.lit(k))
    return expr.otherwise(F.lit(len(ts)))


# A sum of independent Poisson draws is Poisson of the summed means, so a mean of
# m is drawn as one Poisson(2**j) per set bit j of m; what is left above the top
# level is drawn in units of Poisson(2**TOP_LEVEL).
TOP_LEVEL = 20


def wide_thresholds(lam: int) -> tuple[int, list[int]]:
    """(k0, ts) with ts[i] = floor(2**32 * CDF(k0 + i)) for Poisson(``lam``), lam >= 1.

    Leading zeros (k below k0) and values that reach 2**32 are left out: a
    uniform ``u`` then draws k0 plus the number of thresholds <= u. The
    probabilities are built outward from the mode as ratios and normalised by
    their sum, so no exponential of a large mean is needed.
    """
    reach = int(8 * math.sqrt(lam)) + 16         # mass beyond is under 2**-40
    low = max(0, lam - reach)
    down, w = [], 1.0
    for k in range(lam, low, -1):                # ratio p(k-1) / p(k)
        w *= k / lam
        down.append(w)
    up, w = [], 1.0
    for k in range(lam + 1, lam + reach + 1):
        w *= lam / k
        up.append(w)
    pmf = down[::-1] + [1.0] + up
    total, cdf, out, k0 = math.fsum(pmf), 0.0, [], low
    for p in pmf:
        cdf += p
        t = int(math.floor(TWO_32 * (cdf / total)))
        if t == 0:
            k0 += 1
        elif t < TWO_32:
            out.append(t)
        else:
            break
    return k0, out


@lru_cache(maxsize=1)
def _levels() -> list[tuple[int, int, list[str], list[int]]]:
    rows = []
    for j in range(TOP_LEVEL + 1):
        k0, ts = wide_thresholds(1 << j)
        steps = [1 << i for i in range(len(ts).bit_length() - 1, -1, -1)]
        rows.append((j, k0, [format(t, "08x") for t in ts], steps))
    return rows


def poisson_levels(spark: SparkSession) -> DataFrame:
    """One row per level j: k0, ts (8-digit hex thresholds of Poisson(2**j)), steps.

    Its size is fixed by TOP_LEVEL (some 50,000 thresholds in all), whatever
    the data, so joining it as a broadcast is bounded.
    """
    return spark.createDataFrame(_levels(), "j int, k0 int, ts array<string>, steps array<int>")


def split_mean(m: str | Column) -> Column:
    """Array of (j, n): ``m`` as n draws of Poisson(2**j) each; n is 1 below the top level."""
    c = (F.col(m) if isinstance(m, str) else m).cast("bigint")
    bits = [F.struct(F.lit(j).alias("j"), F.shiftright(c, j).bitwiseAND(F.lit(1).cast("bigint")).alias("n"))
            for j in range(TOP_LEVEL)]
    top = F.struct(F.lit(TOP_LEVEL).alias("j"), F.shiftright(c, TOP_LEVEL).alias("n"))
    return F.filter(F.array(*bits, top), lambda p: p["n"] > 0)


def level_draw(hex8: str) -> str:
    """SQL of the draw from ``hex8`` (8 hex digits) with a level's columns k0, ts, steps.

    A binary search: ``steps`` are falling powers of two, and the position
    moves on while the threshold before it is not above the digits.
    """
    return (f"(k0 + aggregate(steps, 0, (p, s) -> "
            f"IF(coalesce(get(ts, p + s - 1) <= {hex8}, false), p + s, p)))")
