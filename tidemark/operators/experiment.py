"""Experiment frames: per-user CTR, arm summaries, smoothing, user buckets.

The experiment table is ``feed_actions`` with an ``exp_group`` (arm) column.
Policy for users without views: their per-user ``ctr`` is NULL (never an
error or infinity). They drop out of every statistic on ``ctr`` (mean,
median, histogram, tests, bucket p90) and are counted in ``n_null``; they
stay in every ratio of sums (global CTR, bucket CTR, bootstrap) and in the
smoothed CTR, whose denominator is never zero.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_between
from ..functions.hashing import hash_bucket
from ..session import broadcast_if_small
from .ranks import compress, compressed_quantiles

DEFAULT_ARMS = (1, 2)
SMOOTHING_ALPHA = 5.0


def user_ctr(feed: DataFrame, start, end, arms=DEFAULT_ARMS) -> DataFrame:
    """Per-user likes, views and ctr for days ``start..end`` (inclusive) in ``arms``.

    Columns: exp_group, user_id, likes, views, ctr. One shuffle by
    (exp_group, user_id) with map-side partial counts.
    """
    end_excl = as_date(end) + dt.timedelta(days=1)
    return (feed.where(time_between(feed, start, end_excl)
                       & F.col("exp_group").isin(*arms))
            .groupBy("exp_group", "user_id")
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == "view").alias("views"))
            .withColumn("ctr", F.try_divide(F.col("likes"), F.col("views"))))


def arm_summary(users: DataFrame, value_col: str = "ctr", group_col: str = "exp_group") -> DataFrame:
    """Per arm: n_users, n_null, mean, median, stddev of ``value_col``.

    The median is exact (average of the middle pair for even counts) and is
    computed with distributed prefix counts, not by gathering an arm's values. ``users`` is
    read once: everything follows from its distinct values and their counts.
    """
    d = compress(users, [group_col], value_col)
    v = F.col(value_col)
    base = d.groupBy(group_col).agg(
        F.sum("_c").alias("n_users"),
        F.sum(F.when(v.isNull(), F.col("_c")).otherwise(0)).alias("n_null"))
    stats = compressed_quantiles(d, [group_col], value_col, {"median": 0.5}, moments=True)
    return (base.join(stats, group_col, "left")
            .select(group_col, "n_users", "n_null", "mean", "median", "stddev")
            .orderBy(group_col))


def global_ctr(users: DataFrame, group_col: str = "exp_group") -> DataFrame:
    """Ratio-of-sums CTR per arm: exp_group, likes, views, global_ctr."""
    return (users.groupBy(group_col)
            .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
            .withColumn("global_ctr", F.try_divide(F.col("likes"), F.col("views")))
            .orderBy(group_col))


def smoothed_ctr(users: DataFrame, alpha: float = SMOOTHING_ALPHA,
                 group_col: str = "exp_group") -> DataFrame:
    """Adds smoothed_ctr = (likes + alpha * global_ctr) / (views + alpha).

    ``global_ctr`` is the arm's ratio of sums. The per-arm table has one row
    per arm; it is broadcast after a size check, so the per-user side is not
    shuffled, and the per-user step is column arithmetic in whole-stage codegen.
    """
    g = broadcast_if_small(global_ctr(users, group_col).select(group_col, "global_ctr"))
    return (users.join(g, group_col)
            .withColumn("smoothed_ctr",
                        (F.col("likes") + F.lit(float(alpha)) * F.col("global_ctr"))
                        / (F.col("views") + F.lit(float(alpha))))
            .drop("global_ctr"))


def bucket_ctr(users: DataFrame, n: int = 50, q: float = 0.9, hash_method: str = "md5",
               group_col: str = "exp_group") -> DataFrame:
    """Users hashed into ``n`` buckets per arm; per bucket the ratio-of-sums CTR
    and the element ``q``-quantile of user CTR (index floor(q * k) of the k
    non-NULL values, 0-based).

    Columns: exp_group, bucket, bucket_ctr, ctr9. Empty buckets are absent;
    buckets whose users have no views get NULL in both metrics.
    """
    # one pass over the users; the sums and the p90 ranks both follow from the distinct values
    d = compress(users.withColumn("bucket", hash_bucket("user_id", n, hash_method)),
                 [group_col, "bucket"], "ctr", {"likes": F.col("likes"), "views": F.col("views")})
    agg = (d.groupBy(group_col, "bucket")
           .agg(F.try_divide(F.sum("likes"), F.sum("views")).alias("bucket_ctr")))
    p90 = compressed_quantiles(d, [group_col, "bucket"], "ctr", {"ctr9": q}, method="element")
    return (agg.join(p90, [group_col, "bucket"], "left")
            .select(group_col, "bucket", "bucket_ctr", "ctr9")
            .orderBy(group_col, "bucket"))
