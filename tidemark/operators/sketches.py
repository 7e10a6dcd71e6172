"""Approximate distinct counts from stored sketches that merge over any range.

One HyperLogLog sketch of users and one of posts per (day, source), about
``2**lg_k`` bytes at most, is kept beside the exact rollups. A range of days,
a choice of sources or trailing windows then union sketches instead of
reading users: the work grows with days times sources. The relative standard
error is about ``1.04 / sqrt(2**lg_k)`` (1.6 % at the default), whatever the
number of days merged; exact counts stay the default everywhere else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_between

LG_K = 12


def daily_sketches(feed: DataFrame, start=None, end=None, lg_k: int = LG_K) -> DataFrame:
    """Per (day, source) of ``[start, end)``: actions, users and posts (sketches).

    Sketches are built map-side, so a hot source shuffles one row per task.
    Null users and posts are not counted.
    """
    return (feed.where(time_between(feed, start, end))
            .groupBy(F.to_date("time").alias("day"), "source")
            .agg(F.count(F.lit(1)).alias("actions"),
                 F.hll_sketch_agg("user_id", lg_k).alias("users"),
                 F.hll_sketch_agg("post_id", lg_k).alias("posts")))


def _estimate(merged: str, name: str):
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(merged)), F.lit(0)).alias(name)


def range_uniques(sketches: DataFrame, start, end, by: tuple[str, ...] = ()) -> DataFrame:
    """[by,] actions, users, posts over all of ``[start, end)``, the last two approximate."""
    day = F.col("day")
    return (sketches.where((day >= F.lit(as_date(start))) & (day < F.lit(as_date(end))))
            .groupBy(*by)
            .agg(F.coalesce(F.sum("actions"), F.lit(0)).alias("actions"),
                 _estimate("users", "users"), _estimate("posts", "posts")))


def trailing_uniques(sketches: DataFrame, start, end, windows: tuple[int, ...] = (1, 7, 28)) -> DataFrame:
    """day, window_days, users: approximate users of the ``window_days`` days that end with
    ``day``, for each day of ``[start, end)``; days whose window is silent are absent.

    Sources are merged first, so a day's one sketch goes to each window it is part of.
    """
    day = F.col("day")
    lo, hi = F.lit(as_date(start)), F.lit(as_date(end))
    daily = (sketches.where((day > F.date_sub(lo, max(windows))) & (day < hi))
             .groupBy("day").agg(F.hll_union_agg("users").alias("users")))
    spread = (daily.withColumn("window_days", F.explode(F.array(*[F.lit(w) for w in windows])))
              .select("window_days", "users",
                      F.explode(F.sequence(F.lit(0), F.col("window_days") - 1)).alias("i"), "day")
              .select("window_days", "users", F.date_add("day", F.col("i")).alias("day"))
              .where((F.col("day") >= lo) & (F.col("day") < hi)))
    return spread.groupBy("day", "window_days").agg(_estimate("users", "users"))
