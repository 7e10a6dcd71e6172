"""Customer segmentation over ``orders`` and ``lineitem``.

Only a summary of this analysis exists (sales trends, seasonal sales,
repeat and wholesale buyers, K-means segments, a Mann-Whitney check), so the
exact feature list and output columns here are this library's design:

* ``sales_trend`` - orders, customers and revenue per period with the change
  against the previous period and the same period a year earlier;
* ``seasonal_profile`` - revenue share per calendar month;
* ``customer_features`` - recency, frequency, monetary value, basket size
  and peak-season share per customer;
* ``customer_segments`` - standardized features clustered by K-means whose labels don't
  depend on the partitioning (k fixed or chosen by silhouette);
* ``segment_profile`` - size and feature means per segment;
* ``segment_mwu`` - Mann-Whitney between two segments on one feature.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_between
from ..functions.hashing import TWO_32, md5_u32
from ..session import materialize
from .stats import mann_whitney

PEAK_MONTHS = (11, 12)
MONEY = "decimal(18,2)"     # prices are cents: summed exactly, whatever the order


def money_sum(col: str):
    """Exact sum of a price column (as cents), returned as a double.

    A double sum depends on the order rows arrive in, so the same query could
    differ in the last digits between runs or partitionings; a decimal sum
    does not.
    """
    return F.sum(F.col(col).cast(MONEY))
FEATURES = ("recency_days", "frequency", "monetary", "avg_order_value",
            "avg_quantity", "peak_share")

# truncation unit, forward shift by n units, one period, one year: a period's
# revenue is re-emitted under the next period and under the same period a year on
_GRAINS = {
    "day": ("day", F.date_add, 1, 364),
    "week": ("week", F.date_add, 7, 364),
    "month": ("month", F.add_months, 1, 12),
    "quarter": ("quarter", F.add_months, 3, 12),
    "year": ("year", F.add_months, 12, 12),
}


def sales_trend(orders: DataFrame, grain: str = "month") -> DataFrame:
    """Per period: orders, customers, revenue, avg_order_value, prev_revenue,
    revenue_change, yoy_revenue, yoy_change (changes as fractions; NULL when
    the earlier period has no orders).

    One aggregation per period; each period row is then emitted three times
    (as itself, as the next period's "previous" and as next year's "year
    ago") and regrouped, so the comparison needs no self-join and the orders
    are scanned once.
    """
    unit, shift, step, year = _GRAINS[grain]
    per = (orders.groupBy(F.date_trunc(unit, "o_orderdate").cast("date").alias("period"))
           .agg(F.count(F.lit(1)).alias("orders"),
                F.count_distinct("o_custkey").alias("customers"),
                money_sum("o_totalprice").cast("double").alias("revenue")))
    none = F.lit(None)
    views = F.array(
        F.struct(F.col("period").alias("p"), F.col("orders").alias("o"),
                 F.col("customers").alias("c"), F.col("revenue").alias("r"),
                 none.cast("double").alias("pr"), none.cast("double").alias("yr")),
        F.struct(shift("period", step).alias("p"), none.cast("bigint").alias("o"),
                 none.cast("bigint").alias("c"), none.cast("double").alias("r"),
                 F.col("revenue").alias("pr"), none.cast("double").alias("yr")),
        F.struct(shift("period", year).alias("p"), none.cast("bigint").alias("o"),
                 none.cast("bigint").alias("c"), none.cast("double").alias("r"),
                 none.cast("double").alias("pr"), F.col("revenue").alias("yr")))
    merged = (per.select(F.inline(views))
              .groupBy(F.col("p").alias("period"))
              .agg(F.max("o").alias("orders"), F.max("c").alias("customers"),
                   F.max("r").alias("revenue"), F.max("pr").alias("prev_revenue"),
                   F.max("yr").alias("yoy_revenue"))
              .where(F.col("orders").isNotNull()))
    return (merged
            .select("period", "orders", "customers", "revenue",
                    F.try_divide(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
                    "prev_revenue",
                    F.try_divide(F.col("revenue") - F.col("prev_revenue"),
                                 F.col("prev_revenue")).alias("revenue_change"),
                    "yoy_revenue",
                    F.try_divide(F.col("revenue") - F.col("yoy_revenue"),
                                 F.col("yoy_revenue")).alias("yoy_change"))
            .orderBy("period"))


def seasonal_profile(orders: DataFrame) -> DataFrame:
    """Per calendar month over all years: orders, revenue, revenue_share."""
    per = (orders.groupBy(F.month("o_orderdate").alias("month"))
           .agg(F.count(F.lit(1)).alias("orders"), money_sum("o_totalprice").alias("rev")))
    # ``per`` has at most 12 rows, so a whole-table window over it is cheap
    total = F.sum("rev").over(Window.partitionBy()).cast("double")
    return (per.select("month", "orders", F.col("rev").cast("double").alias("revenue"),
                       F.try_divide(F.col("rev").cast("double"), total).alias("revenue_share"))
            .orderBy("month"))


def customer_features(orders: DataFrame, lineitem: DataFrame, as_of,
                      peak_months=PEAK_MONTHS) -> DataFrame:
    """One row per customer with orders before ``as_of``.

    Columns: custkey, frequency (orders), monetary (total price), avg_order_value,
    recency_days (since the last order), tenure_days (since the first),
    avg_quantity (units per order), avg_lines (lines per order), peak_share
    (share of orders in ``peak_months``), repeat_buyer.

    Line items are summed per order before the join, so the join is
    order-to-order (no fan-out) and the lineitem side shuffles one row per
    order; the per-customer step is a partially aggregated groupBy, which
    stays balanced even if one customer holds a large share of the orders.
    """
    a = as_date(as_of)
    o = (orders.where(time_between(orders, None, a, col="o_orderdate"))
         .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("lines")))
    j = o.join(per_order, o["o_orderkey"] == per_order["l_orderkey"], "left")
    peak = F.month("o_orderdate").isin(*peak_months).cast("int")
    as_of_lit = F.lit(a.isoformat()).cast("date")
    return (j.groupBy(F.col("o_custkey").alias("custkey"))
            .agg(F.count(F.lit(1)).alias("frequency"),
                 money_sum("o_totalprice").cast("double").alias("monetary"),
                 F.max("o_orderdate").alias("_last"),
                 F.min("o_orderdate").alias("_first"),
                 F.avg(F.coalesce("qty", F.lit(0.0))).alias("avg_quantity"),
                 F.avg(F.coalesce("lines", F.lit(0))).alias("avg_lines"),
                 F.avg(peak).alias("peak_share"))
            .select("custkey", "frequency", "monetary",
                    (F.col("monetary") / F.col("frequency")).alias("avg_order_value"),
                    F.datediff(as_of_lit, F.to_date("_last")).alias("recency_days"),
                    F.datediff(as_of_lit, F.to_date("_first")).alias("tenure_days"),
                    "avg_quantity", "avg_lines", "peak_share",
                    (F.col("frequency") > 1).alias("repeat_buyer")))


ROWS_PER_TASK = 200_000
POINT = "decimal(18,6)"     # standardized features: their sums don't depend on the order of rows


def _standardized(features: DataFrame, cols) -> DataFrame:
    """custkey and z0, z1, ...: features less their mean over their deviation, to 6 places.

    Rows with a NULL or NaN feature are left out. The moments are exact decimal sums, read back as one row;
    a feature without spread is 0 throughout.
    """
    data = features.select("custkey", *[F.col(c).cast("double").alias(c) for c in cols])
    for c in cols:
        data = data.where(F.col(c).isNotNull() & ~F.isnan(c))
    exact = [F.col(c).cast(POINT) for c in cols]
    row = data.agg(F.count(F.lit(1)), *[F.sum(x) for x in exact], *[F.sum(x * x) for x in exact]).first()
    n, d = max(1, row[0]), len(cols)
    points = []
    for i, c in enumerate(cols):
        mean = float(row[1 + i] or 0) / n
        deviation = math.sqrt(max(0.0, float(row[1 + d + i] or 0) / n - mean * mean))
        z = F.round((F.col(c) - F.lit(mean)) / F.lit(deviation), 6) if deviation > 0 else F.lit(0.0)
        points.append(z.cast(POINT).alias(f"z{i}"))
    return data.select("custkey", *points)


def _squared(centre: list[float]) -> str:
    """Squared distance of the row's point from ``centre``, as an expression's text (parsed in one go)."""
    steps = [f"(cast(z{i} as double) - ({float(c)!r}D))" for i, c in enumerate(centre)]
    return " + ".join(f"{x} * {x}" for x in steps)


def _seeds(points: DataFrame, k: int, seed: int, d: int) -> list[list[float]]:
    """First centres, each drawn with odds that follow the squared distance from those before.

    The draw of u ** (1 / weight), largest first, takes a row with odds by weight; u is a hash of (custkey, pass,
    seed), so partitions and retries don't change it. One aggregation per centre, ties to the least custkey.
    """
    centres: list[list[float]] = []
    for j in range(k):
        u = (md5_u32("custkey", F.lit(j), F.lit(seed)).cast("double") + 1) / F.lit(float(TWO_32 + 1))
        odds = F.expr(f"least({', '.join(map(_squared, centres))}, double('infinity'))" if centres else "1.0D")
        able = points.withColumn("_odds", odds).where("_odds > 0").withColumn("_draw", F.log(u) / F.col("_odds"))
        row = able.agg(F.min_by(F.array(*[F.col(f"z{i}").cast("double") for i in range(d)]),
                                F.struct((-F.col("_draw")).alias("draw"), "custkey")).alias("z")).first()
        if row["z"] is None:  # fewer different points than centres
            break
        centres.append(list(row["z"]))
    return centres


def _assigned(points: DataFrame, centres: list[list[float]]) -> DataFrame:
    """The points with ``own``, the nearest centre (ties to the first), and its squared distance ``apart``."""
    each = [f"named_struct('apart', {_squared(c)}, 'own', {j})" for j, c in enumerate(centres)]
    none = f"named_struct('apart', double('infinity'), 'own', {len(centres)})"  # twice: least takes two at least
    nearest = F.expr(f"least({', '.join([*each, none, none])})")
    return points.withColumn("_near", nearest).select(*points.columns, "_near.own", "_near.apart")


def _sums(assigned: DataFrame, d: int) -> list:
    """Per centre: own, n, exact sums of the coordinates, sum of squares (k rows, read back)."""
    squares = " + ".join(f"z{i} * z{i}" for i in range(d))
    rows = assigned.groupBy("own").agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum(z{i}) as s{i}") for i in range(d)],
                                       F.expr(f"sum(cast({squares} as decimal(38,12))) as squares")).collect()
    return sorted(rows, key=lambda r: r["own"])


def _silhouette(assigned: DataFrame, sums: list, d: int) -> float:
    """Mean silhouette by squared distances, from the sums of each cluster; 0 for one cluster."""
    if len(sums) < 2:
        return 0.0
    z = [F.col(f"z{i}").cast("double") for i in range(d)]
    norm = sum((x * x for x in z[1:]), z[0] * z[0])
    own = others = F.lit(None).cast("double")
    far = []
    for r in sums:
        dot = sum((z[i] * F.lit(float(r[f"s{i}"])) for i in range(1, d)), z[0] * F.lit(float(r["s0"])))
        total = norm * F.lit(float(r["n"])) + F.lit(float(r["squares"])) - 2 * dot  # to all points of the cluster
        own = F.when(F.col("own") == r["own"], total / F.lit(float(max(1, r["n"] - 1)))).otherwise(own)
        far.append(F.when(F.col("own") != r["own"], total / F.lit(float(r["n"]))).otherwise(F.lit(float("inf"))))
    others = F.least(*far)
    alone = F.col("own").isin(*[r["own"] for r in sums if r["n"] == 1]) if any(r["n"] == 1 for r in sums) else F.lit(False)
    value = F.when(alone | (F.greatest(own, others) <= 0), F.lit(0.0)).otherwise((others - own) / F.greatest(own, others))
    return float(assigned.agg(F.avg(value)).first()[0] or 0.0)


def customer_segments(features: DataFrame, k: int | None = 4, seed: int = 42,
                      cols=FEATURES, k_range=range(2, 9), rounds: int = 20) -> DataFrame:
    """K-means segments: custkey, segment (0 .. k-1, by ascending mean ``monetary`` or first column), silhouette.

    Features are standardized and held to 6 places. Seeds are drawn by hash, sums of clusters are exact decimals and centres
    are rounded to 6 places, so labels are the same on any partitioning. A round is one
    aggregation of k rows; the driver holds k centres. Rounds end when no centre moves. With ``k=None``
    each k in ``k_range`` is fitted and the one with the highest silhouette is kept. Fewer different points
    than k give fewer segments; customers with a NULL feature get none.
    """
    points, d = materialize(_standardized(features, cols)), len(cols)
    # few rows in few partitions: a round over one partition needs no shuffle
    points = points.coalesce(max(1, -(-points.count() // ROWS_PER_TASK)))
    rank = list(cols).index("monetary") if "monetary" in cols else 0
    best = None
    for kk in ([k] if k is not None else list(k_range)):
        centres = _seeds(points, kk, seed, d)
        for _ in range(rounds if centres else 0):
            moved = [list(c) for c in centres]
            for r in _sums(_assigned(points, centres), d):
                moved[r["own"]] = [round(float(r[f"s{i}"]) / r["n"], 6) for i in range(d)]
            if moved == centres:
                break
            centres = moved
        centres.sort(key=lambda c: (c[rank], c))
        assigned = _assigned(points, centres)
        score = _silhouette(assigned, _sums(assigned, d), d)
        if best is None or score > best[0]:
            best = (score, assigned)
    score, assigned = best
    return assigned.select("custkey", F.col("own").cast("int").alias("segment"), F.lit(float(score)).alias("silhouette"))


def segment_profile(features: DataFrame, segments: DataFrame, cols=FEATURES) -> DataFrame:
    """Per segment: customers, share of customers, mean of each feature,
    repeat_share."""
    j = features.join(segments.select("custkey", "segment"), "custkey")
    # sums to 6 places are exact, so the means don't depend on the order of rows
    per = j.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        *[(F.sum(F.col(c).cast(POINT)).cast("double") / F.count(c)).alias(f"avg_{c}") for c in cols],
        F.avg(F.col("repeat_buyer").cast("int")).alias("repeat_share"))
    # one row per segment (k rows): a whole-table window over it is cheap
    return (per.withColumn("share", F.col("customers")
                           / F.sum("customers").over(Window.partitionBy()))
            .orderBy("segment"))


def segment_mwu(features: DataFrame, segments: DataFrame, first: int, second: int,
                value: str = "monetary") -> DataFrame:
    """Mann-Whitney U between two segments on one feature (two-sided)."""
    j = features.join(segments.select("custkey", "segment"), "custkey")
    return mann_whitney(j, "segment", value, first, second)
