"""Two-sample tests, bootstrap and histograms as Spark aggregations.

Each test reduces its input to one row with a single aggregation (means and
variances, rank sums, replicate sums); the tail probability of that row is a
column expression (the exact Mann-Whitney p of a small sample is Python). Test outputs carry ``n1``/``n2`` etc. for the
``first`` and ``second`` groups in the order given, like a two-sample call.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dist import mwu_p_col, t_two_sided_col
from ..functions.hashing import uniform_u32
from ..functions.poisson import (level_draw, poisson_levels, poisson_weight, poisson_weight_hex,
                                 split_mean)
from ..session import default_parallelism
from .ranks import compress, compressed_quantiles, profile, value_prefix

ALPHA = 0.05


def verdict(p: str = "p_value", alpha: float = ALPHA):
    """True when the two-sided p-value is below ``alpha``."""
    return (F.col(p) < F.lit(alpha))


# ------------------------------------------------------------------ Welch t

def welch_stats(df: DataFrame, group_col: str, value_col: str, first, second) -> DataFrame:
    """One row: n1, n2, mean1, mean2, var1, var2, t, df (Welch-Satterthwaite).

    NULL values are skipped. One global aggregation with conditional
    moments (partial per task), then column arithmetic.
    """
    g, v = F.col(group_col), F.col(value_col)
    a = df.where(g.isin(first, second) & v.isNotNull()).agg(
        F.count_if(g == first).alias("n1"),
        F.count_if(g == second).alias("n2"),
        F.avg(F.when(g == first, v)).alias("mean1"),
        F.avg(F.when(g == second, v)).alias("mean2"),
        F.var_samp(F.when(g == first, v)).alias("var1"),
        F.var_samp(F.when(g == second, v)).alias("var2"))
    s1 = F.col("var1") / F.col("n1")
    s2 = F.col("var2") / F.col("n2")
    return a.select(
        "n1", "n2", "mean1", "mean2", "var1", "var2",
        # no variance in either arm: infinitely far apart, or (equal means) no answer
        F.when((s1 + s2 == 0) & (F.col("mean1") != F.col("mean2")),
               F.when(F.col("mean1") > F.col("mean2"), F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
        .otherwise(F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(s1 + s2))).alias("t"),
        F.try_divide((s1 + s2) * (s1 + s2),
                     s1 * s1 / (F.col("n1") - 1) + s2 * s2 / (F.col("n2") - 1)).alias("df"))


def welch_ttest(df: DataFrame, group_col: str, value_col: str, first, second,
                alpha: float = ALPHA) -> DataFrame:
    """Welch's unequal-variance t-test, two-sided: the stats row plus p_value, significant."""
    st = welch_stats(df, group_col, value_col, first, second)
    return (st.withColumn("p_value", t_two_sided_col(F.col("t"), F.col("df")))
            .withColumn("significant", verdict("p_value", alpha)))


# ------------------------------------------------------------ Mann-Whitney

def mwu_stats(df: DataFrame, group_col: str, value_col: str, first, second,
              bins: int = 256) -> DataFrame:
    """One row: n1, n2, u1, u2, tie_term, z for the two-sided Mann-Whitney test.

    ``u1`` counts pairs (x from ``first``, y from ``second``) with x > y plus
    half the ties. Values are compressed to distinct values with per-group
    counts, then each value's count of ``second`` values below it comes from
    the distributed prefix sums in ``ranks``. ``z`` uses max(u1, u2), the tie
    correction and a 0.5 continuity correction.
    """
    g, v = F.col(group_col), F.col(value_col)
    d = (df.where(g.isin(first, second) & v.isNotNull())
         .groupBy(value_col)
         .agg(F.count_if(g == first).alias("c1"), F.count_if(g == second).alias("c2")))
    p = value_prefix(d, [], value_col, ["c1", "c2"], bins)
    t = (F.col("c1") + F.col("c2")).cast("double")
    a = p.agg(
        F.sum("c1").cast("double").alias("n1"),
        F.sum("c2").cast("double").alias("n2"),
        F.sum(F.col("c1") * (F.col("c2_below") + F.col("c2") * 0.5)).alias("u1"),
        F.sum(t * t * t - t).alias("tie_term"))
    nn = F.col("n1") + F.col("n2")
    sigma = F.sqrt(F.col("n1") * F.col("n2") / 12.0
                   * ((nn + 1) - F.col("tie_term") / (nn * (nn - 1))))
    u2 = F.col("n1") * F.col("n2") - F.col("u1")
    return a.select(
        F.col("n1").cast("bigint").alias("n1"), F.col("n2").cast("bigint").alias("n2"),
        "u1", u2.alias("u2"), "tie_term",
        F.try_divide(F.greatest(F.col("u1"), u2) - F.col("n1") * F.col("n2") / 2.0 - 0.5,
                     sigma).alias("z"))


def mann_whitney(df: DataFrame, group_col: str, value_col: str, first, second,
                 alpha: float = ALPHA, bins: int = 256, method: str = "auto") -> DataFrame:
    """Two-sided Mann-Whitney U: the stats row plus p_value, significant.

    ``method='auto'``: exact when one sample has at most 8 values, there
    are no ties and at most ``dist.EXACT_PAIRS`` pairs, otherwise the normal approximation;
    'exact' or 'asymptotic' force one. All values tied: p is 1.
    """
    st = mwu_stats(df, group_col, value_col, first, second, bins)
    p = mwu_p_col(F.greatest("u1", "u2"), F.col("n1"), F.col("n2"), F.col("z"),
                  F.col("tie_term") > 0, method)
    return st.withColumn("p_value", p).withColumn("significant", verdict("p_value", alpha))


# ------------------------------------------------------------ Poisson bootstrap

def _grouped_replicates(users: DataFrame, b: int, seed: int, first, second,
                        group_col: str) -> DataFrame:
    """(group, likes, views, b, w): the replicate weights of every (group, likes, views) pattern.

    A pattern of m users needs Poisson(m) weights. It is split into its binary
    levels first, so also one pattern with most users spreads over tasks; each
    piece draws its ``b`` weights inside one row (the thresholds are read in
    place, not copied per replicate).
    """
    par = default_parallelism(users.sparkSession)
    patterns = (users.where(F.col(group_col).isin(first, second))
                .groupBy(group_col, "likes", "views").agg(F.count(F.lit(1)).alias("m")))
    pieces = (patterns.select(group_col, "likes", "views", F.inline(split_mean("m")))
              .select(group_col, "likes", "views", "j",
                      F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("c"))
              .repartition(par))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("null"))
                             for c in (group_col, "likes", "views", "j", "c")])
    keyed = pieces.join(F.broadcast(poisson_levels(users.sparkSession)), "j").withColumn("key", key)
    draw = level_draw("substring(h, 8 * i + 1, 8)")
    weights = F.expr(f"""slice(flatten(transform(sequence(0, {(b - 1) // 4}), k ->
        flatten(transform(array(md5(concat_ws(':', key, k, '{seed}'))), h ->
            transform(array(0, 1, 2, 3), i -> {draw}))))), 1, {b})""")
    return keyed.select(group_col, "likes", "views", F.posexplode(weights).alias("b", "w"))


def _replicate_ctr(rep: DataFrame, g, first, second) -> DataFrame:
    sums = rep.groupBy("b").agg(
        F.sum(F.when(g == first, F.col("w") * F.col("likes"))).alias("l1"),
        F.sum(F.when(g == first, F.col("w") * F.col("views"))).alias("v1"),
        F.sum(F.when(g == second, F.col("w") * F.col("likes"))).alias("l2"),
        F.sum(F.when(g == second, F.col("w") * F.col("views"))).alias("v2"))
    return (sums.select("b",
                        F.try_divide(F.col("l1"), F.col("v1")).alias("ctr1"),
                        F.try_divide(F.col("l2"), F.col("v2")).alias("ctr2"))
            .withColumn("diff", F.col("ctr2") - F.col("ctr1"))
            .orderBy("b"))


def poisson_bootstrap(users: DataFrame, b: int = 5000, seed: int = 0, first=1, second=2,
                      group_col: str = "exp_group", hash_method: str = "md5",
                      method: str = "per_user") -> DataFrame:
    """Poisson(1) bootstrap of the ratio-of-sums CTR per arm.

    Columns: b (replicate 0..b-1), ctr1 (``first``), ctr2 (``second``),
    diff = ctr2 - ctr1. The weight of (user, replicate) is a fixed function
    of a hash, so results do not depend on partitioning or retries: with
    ``hash_method='md5'`` replicate ``b`` takes the 32-bit slice ``b mod 4``
    (hex digits 8j+1 .. 8j+8) of md5('user_id:k:seed') with ``k = b div 4``,
    a rule any SQL engine reproduces; ``'xxhash64'`` hashes (user_id, b, seed). Each user row is expanded to ``b`` replicate rows
    inside its task and immediately summed per replicate (map-side partial
    aggregation), so a shuffle carries at most ``b`` rows per task: the
    ``b x users`` weight matrix never exists.

    The per-user rows are first spread round-robin over the cluster's cores
    (one shuffle of the small per-user frame): the expansion multiplies the
    work by ``b``, and an arm that arrives in a few partitions would
    otherwise run on a few cores. Sums are integer-exact, so the spread does
    not change the result.

    ``method='grouped'`` draws the same distribution with far less work:
    the statistic only depends on each user's (likes, views), and the sum of
    m independent Poisson(1) weights is Poisson(m), so users with the same
    (arm, likes, views) are merged into one pattern of multiplicity m. m is
    written in binary and each set bit j draws one Poisson(2**j) weight per
    replicate, by inverse CDF from the 32-bit slices of
    md5('arm:likes:views:j:c:k:seed') (c counts the units of the top level).
    The work then grows with the number of distinct patterns, not users. It
    stays in column expressions, does not depend on partitioning and any SQL
    engine reproduces it. Its replicates differ from the per-user draws (same
    distribution, different realisation).
    """
    g = F.col(group_col)
    if method == "grouped":
        return _replicate_ctr(_grouped_replicates(users, b, seed, first, second, group_col),
                              g, first, second)
    if method != "per_user":
        raise ValueError(f"unknown method {method!r}")
    spread = (users.where(g.isin(first, second))
              .select(group_col, "user_id", "likes", "views")
              .repartition(default_parallelism(users.sparkSession)))
    if hash_method == "md5":
        # one digest per block of 4 replicates: its four 32-bit slices are the
        # uniforms of replicates 4k .. 4k+3 (a quarter of the hashing work)
        blocks = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit((b - 1) // 4))).alias("k"))
        hashed = blocks.select(
            group_col, "user_id", "likes", "views", "k",
            F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.col("k").cast("string"),
                              F.lit(str(seed)))).alias("h"))
        slices = F.array(*[
            F.struct((F.col("k") * 4 + j).alias("b"), F.substring("h", 8 * j + 1, 8).alias("x"))
            for j in range(4)])
        rep = (hashed.select(group_col, "likes", "views", F.inline(slices))
               .where(F.col("b") < b)
               .withColumn("w", poisson_weight_hex(F.col("x"))))
    else:
        rep = (spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("b"))
               .withColumn("w", poisson_weight(
                   uniform_u32("user_id", "b", F.lit(seed), method=hash_method))))
    return _replicate_ctr(rep, g, first, second)


def bootstrap_ci(reps: DataFrame, level: float = 0.95, col: str = "diff") -> DataFrame:
    """Percentile interval of ``col``: lo, hi, excludes_zero (linear interpolation).

    The input has one row per replicate, so the exact ``percentile``
    aggregate holds at most ``b`` values: bounded by the parameter, not the data.
    """
    tail = (1.0 - level) / 2.0
    q = reps.agg(F.percentile(F.col(col), F.array(F.lit(tail), F.lit(1.0 - tail))).alias("q"),
                 F.avg(col).alias("mean"))
    return q.select(F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"), "mean").select(
        "lo", "hi", ((F.col("lo") > 0) | (F.col("hi") < 0)).alias("excludes_zero"), "mean")


# ------------------------------------------------------------ histogram

def _auto_bins(n: int, lo: float, hi: float, q1: float | None, q3: float | None) -> int:
    """numpy's 'auto' rule: the finer of Sturges and Freedman-Diaconis."""
    span = hi - lo
    if n < 1 or span <= 0:
        return 1
    sturges = span / (math.log2(n) + 1.0)
    iqr = (q3 - q1) if q1 is not None and q3 is not None else 0.0
    fd = 2.0 * iqr * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil(span / width)))


def histogram(df: DataFrame, col: str, by: str | None = None, bins="auto") -> DataFrame:
    """Counts of ``col`` in equal-width bins shared by all groups of ``by``.

    Columns: [by,] bin (1-based), bin_lo, bin_hi, n. Every (group, bin) pair
    is present (zero counts included); the last bin includes its upper edge.
    ``bins`` is a count or 'auto'. ``df`` is read once, into its distinct values and
    their counts; the range (and quartiles for 'auto') is
    one row of these read back to size the bins, and the bins are sums over them.
    """
    # NULL and NaN are left out, as the charting default does
    keys = [by] if by else []
    d = compress(df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col))), keys, col)
    seen = profile(d, keys, col, count=F.col("_c"))
    n, lo, hi = seen.total, seen.lo, seen.hi
    if n == 0:
        lo, hi = 0.0, 1.0
    if bins == "auto":
        if hi > lo and n:
            # quartiles over all groups; the splits of the grouped rows cut these as well
            every = d.groupBy(col).agg(F.sum("_c").alias("_c")) if by else d
            qr = compressed_quantiles(every, [], col, {"q1": 0.25, "q3": 0.75}, known=replace(seen, groups=1)).first()
            nb = _auto_bins(n, lo, hi, qr["q1"], qr["q3"])
        else:
            nb = 1
    else:
        nb = int(bins)
    if hi <= lo:                       # one value: a unit-wide range around it
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / nb
    b = F.least(F.floor((F.col(col) - F.lit(lo)) * F.lit(nb) / F.lit(hi - lo)) + 1,
                F.lit(nb)).cast("int")
    counts = d.groupBy(*keys, b.alias("bin")).agg(F.sum("_c").alias("n"))
    if by:
        grid = d.select(by).distinct()
    else:
        grid = df.sparkSession.range(1).select()
    grid = grid.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(nb))).alias("bin"))
    return (grid.join(counts, [*keys, "bin"], "left")
            .select(*keys, "bin",
                    (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n"))
            .orderBy(*keys, "bin"))
