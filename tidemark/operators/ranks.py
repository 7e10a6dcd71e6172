"""Distributed ordered statistics: prefix counts, exact quantiles, rank sums.

Ranks need a global order. A window ``orderBy`` without ``partitionBy`` (or
partitioned by a two-valued experiment arm) would send every row to one
task, so ordered statistics are computed in two levels instead:

1. Rows are compressed to one row per distinct ``(keys, value)`` with counts
   (a normal, partially aggregated shuffle).
2. Values are cut into equi-depth bins with splits from ``percentile_approx``
   (a few hundred numbers) and ``Bucketizer`` (binary search in the JVM).
   Bin totals (``keys x bins`` rows) get their prefix sums with a window over
   that small table; rows inside one bin get theirs with a window partitioned
   by ``(keys, bin)``. Adding both gives, for every distinct value, the exact
   number of rows below it.

The splits only decide how evenly work is spread; the results are exact
whatever they are. ``d`` is materialized first, so the split job and the
main job read the same rows. Bins that hold more than ``ROWS_PER_BIN`` distinct
values of one key are cut again, as often as needed, so no within-bin window
grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

DEFAULT_BINS = 256
ROWS_PER_BIN = 1_000_000      # target distinct values per within-bin window
CUTS = 256                    # parts an overfull bin is cut into at a time
BIN_STEP = 1024               # bin numbers left free for them
BROADCAST_ROWS = 100_000      # prefix rows that are broadcast without counting them first


@dataclass(frozen=True)
class Profile:
    """What one pass over a compressed frame tells: enough to plan ranks and histograms."""

    rows: int                 # distinct (keys, value) rows
    groups: int               # distinct keys, within a few percent
    splits: list[float]       # equi-depth split points, infinite ends included
    total: int                # sum of the counts
    lo: float | None
    hi: float | None


def compress(df: DataFrame, keys: list[str], value: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """One materialized row per distinct (keys, value): ``_c`` rows, and a sum per entry of ``sums``.

    A NULL value has a row of its own. This is the only time ``df`` is computed: counts, means,
    quantiles, ranges and histograms all follow from these rows.
    """
    return materialize(df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_c"), *[F.sum(c).alias(name) for name, c in (sums or {}).items()]))


def profile(d: DataFrame, keys: list[str], value: str, bins: int = DEFAULT_BINS,
            count: Column | None = None) -> Profile:
    """Sizes, range and equi-depth split points of ``d``; one pass, one row to the driver."""
    v = F.col(value).cast("double")
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)]) if bins > 1 else F.array(F.lit(0.5))
    row = d.agg(F.count(F.lit(1)).alias("rows"),
                (F.approx_count_distinct(F.struct(*keys)) if keys else F.lit(1)).alias("groups"),
                F.percentile_approx(v, probs, 4 * bins).alias("q"),
                F.sum(F.lit(0) if count is None else count).alias("total"),
                F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    qs = row["q"] or [] if bins > 1 else []
    inner = sorted({float(q) for q in qs if q is not None})
    return Profile(int(row["rows"]), int(row["groups"]), [float("-inf")] + inner + [float("inf")],
                   int(row["total"] or 0), row["lo"], row["hi"])


def _cut_overfull(binned: DataFrame, keys: list[str], rows_per_bin: int) -> DataFrame:
    """Cut bins until no (keys, _bin) group has more than ``rows_per_bin`` rows.

    Each round finds the overfull groups and cuts their bins at quantiles of
    these groups' own values: a value is there once per group, so at least two
    different cuts come out and every round makes the groups smaller.
    ``_bin`` keeps the order of the values.
    """
    probs = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    group = F.struct(*keys, "_bin")              # null keys are equal inside a struct
    steps = [1 << i for i in range(CUTS.bit_length() - 1, -1, -1)]
    find = ("aggregate(array(" + ", ".join(map(str, steps)) + "), 0, (p, s) -> "
            "IF(coalesce(get(_cuts, p + s - 1) <= _v, false), p + s, p))")
    while True:
        full = materialize(binned.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
                           .where(F.col("_n") > rows_per_bin).select("_g"))
        if full.isEmpty():
            return binned
        cuts = (binned.withColumn("_g", group).join(broadcast_if_small(full), "_g", "left_semi")
                .groupBy("_bin")
                .agg(F.array_distinct(F.percentile_approx("_v", probs, 4 * CUTS)).alias("_cuts")))
        binned = (binned.join(broadcast_if_small(cuts), "_bin", "left")
                  .withColumn("_bin", F.col("_bin") * BIN_STEP + F.expr(find)).drop("_cuts"))


def value_prefix(d: DataFrame, keys: list[str], value: str, counts: list[str],
                 bins: int = DEFAULT_BINS, materialized: bool = False,
                 rows_per_bin: int | None = None, totals: list[str] | None = None,
                 known: Profile | None = None) -> DataFrame:
    """Add ``<c>_below`` for each count column ``c``, and ``<t>_total`` for each of ``totals``.

    ``d`` holds one row per distinct ``(keys, value)`` (value not NULL) with
    non-negative counts; ``<c>_below`` is the sum of ``c`` over rows with the
    same keys and a strictly smaller value, ``<t>_total`` that over all rows with the same keys.
    ``known`` is the ``profile`` of a ``d`` already materialized.
    """
    if not materialized:
        d = materialize(d)
    known = known or profile(d, keys, value, bins)
    d = d.withColumn("_v", F.col(value).cast("double"))
    if len(known.splits) < 3:           # no or one distinct split point: a single bin
        binned = d.withColumn("_bin", F.lit(0).cast("bigint"))
    else:
        binned = (Bucketizer(splits=known.splits, inputCol="_v", outputCol="_binf",
                             handleInvalid="keep")   # NaN: an extra last bin
                  .transform(d).withColumn("_bin", F.col("_binf").cast("bigint"))
                  .drop("_binf"))
    target = ROWS_PER_BIN if rows_per_bin is None else rows_per_bin
    many = known.rows > bins * target   # bins of equal depth are overfull
    if many:
        binned = _cut_overfull(binned, keys, target)
    binned = binned.drop("_v")
    totals = totals or []
    sums = binned.groupBy(*keys, "_bin").agg(*[F.sum(c).alias(f"_t_{c}") for c in dict.fromkeys([*counts, *totals])])
    wbin = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before_bin = sums.select(
        *keys, "_bin",
        *[F.coalesce(F.sum(f"_t_{c}").over(wbin), F.lit(0)).alias(f"_bb_{c}") for c in counts],
        *[F.sum(f"_t_{c}").over(Window.partitionBy(*keys)).alias(f"{c}_total") for c in totals])
    # At most groups x (bins + NaN bin) rows. The profile counted the groups (twice the estimate is far
    # beyond its error), so the usual few groups need no further job; otherwise, and where
    # bins were cut, the table is counted before it is broadcast. Joining it by shuffle would
    # hash the value table by the keys, and a key (an experiment arm) can
    # hold half of all rows.
    bounded = not many and 2 * known.groups * (bins + 2) <= BROADCAST_ROWS
    before_bin = F.broadcast(before_bin) if bounded else broadcast_if_small(before_bin)
    joined = binned.join(before_bin, [*keys, "_bin"])
    win = (Window.partitionBy(*keys, "_bin").orderBy(value)
           .rowsBetween(Window.unboundedPreceding, -1))
    return joined.select(
        *[c for c in binned.columns if c != "_bin"],
        *[(F.col(f"_bb_{c}") + F.coalesce(F.sum(c).over(win), F.lit(0))).alias(f"{c}_below")
          for c in counts],
        *[f"{c}_total" for c in totals])


def _at_rank(value: str, probs: dict[str, float], method: str) -> dict[str, Column]:
    """Aggregates that pick or interpolate the quantiles from ``_c``, ``_c_below`` and ``_c_total``."""
    n, below, v = F.col("_c_total"), F.col("_c_below"), F.col(value)

    def element(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < below + F.col("_c")), v))

    out = {}
    for name, q in probs.items():
        if method == "element":
            out[name] = element(F.least(F.floor(F.lit(q) * n), n - 1))
        elif method == "linear":
            pos = F.lit(q) * (n - 1)
            lo, hi = element(F.floor(pos)).cast("double"), element(F.ceil(pos)).cast("double")
            out[name] = lo + F.max(pos - F.floor(pos)) * (hi - lo)
        else:
            raise ValueError(f"unknown method {method!r}")
    return out


def compressed_quantiles(d: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                         method: str = "linear", bins: int = DEFAULT_BINS, moments: bool = False,
                         known: Profile | None = None) -> DataFrame:
    """``exact_quantiles`` of a frame made by ``compress``; ``moments`` adds ``mean`` and ``stddev``.

    The mean comes with the prefix sums, so squared distances from it are added
    up in the same aggregation that picks the quantiles.
    """
    v, totals = F.col(value), ["_c"]
    d = d.where(v.isNotNull())
    if moments:
        d, totals = d.withColumn("_cv", F.col("_c") * v.cast("double")), ["_c", "_cv"]
    p = value_prefix(d, keys, value, ["_c"], bins, materialized=True, totals=totals, known=known)
    aggs = _at_rank(value, probs, method)
    if moments:
        mean = F.col("_cv_total") / F.col("_c_total")
        aggs["mean"] = F.max(mean)
        aggs["stddev"] = F.sqrt(F.try_divide(F.sum(F.col("_c") * F.pow(v.cast("double") - mean, 2)), F.max("_c_total") - 1))
    return p.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    method: str = "linear", bins: int = DEFAULT_BINS) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys`` over non-NULL values.

    ``method='linear'`` interpolates between order statistics (numpy's default,
    SQL ``percentile_cont``); ``method='element'`` returns the element at 0-based
    index ``floor(p * n)`` (the "exact" quantile of some SQL engines). ``probs``
    maps output column names to probabilities. Keyed groups without values are
    absent; without keys the single row is NULL when there are no values.
    """
    return compressed_quantiles(compress(df.where(F.col(value).isNotNull()), keys, value),
                                keys, value, probs, method, bins)
