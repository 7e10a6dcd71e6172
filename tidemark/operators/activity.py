"""Daily activity metrics over the feed and messenger event tables.

Every function takes an explicit ``as_of`` day (the run day, "today") and
reads only the time range it needs; the bound is written on the raw ``time``
column so the scan skips everything else.

Most metrics only need *who was active on which day*. ``user_days`` reduces
events to one row per (user, [source,] day) with an action count; the
``*_from_days`` functions work on that rollup, and the event-level functions
are thin compositions of the two. A daily job can therefore build (or append
one day to) the rollup once and derive every report table from it instead of
scanning the full event history once per table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_between

FEED = "feed"
MESSAGE = "message"


# ------------------------------------------------------------------ rollup

def user_days(events: DataFrame, until=None, by_source: bool | None = None) -> DataFrame:
    """One row per (user_id, [source,] day) with ``actions`` = events that day.

    ``until`` (exclusive day) bounds the scan. ``by_source`` defaults to
    whether the table has a ``source`` column. Map-side partial aggregation
    makes the shuffle carry at most one row per key per task.
    """
    if by_source is None:
        by_source = "source" in events.columns
    src = events if until is None else events.where(time_between(events, None, until))
    keys = ["user_id", "source"] if by_source else ["user_id"]
    return (src.groupBy(*keys, F.to_date("time").alias("day"))
            .agg(F.count(F.lit(1)).alias("actions")))


def distinct_count(col: str, approx_rsd: float | None = None):
    """Exact ``count(DISTINCT col)``, or HyperLogLog++ with relative error
    ``approx_rsd`` (fixed-size sketches per group instead of a distinct set)."""
    if approx_rsd is None:
        return F.count_distinct(col)
    return F.approx_count_distinct(col, rsd=approx_rsd)


def _before(days: DataFrame, as_of) -> DataFrame:
    return days.where(F.col("day") < F.lit(as_date(as_of).isoformat()).cast("date"))


# ------------------------------------------------------------------ one day

def feed_metrics_range(feed: DataFrame, start, end, approx_rsd: float | None = None) -> DataFrame:
    """Feed metrics for each day in ``[start, end)``: day, dau, views, likes, ctr."""
    return (feed.where(time_between(feed, start, end))
            .groupBy(F.to_date("time").alias("day"))
            .agg(distinct_count("user_id", approx_rsd).alias("dau"),
                 F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"))
            .withColumn("ctr", F.try_divide(F.col("likes"), F.col("views"))))


def feed_metrics(feed: DataFrame, as_of, approx_rsd: float | None = None) -> DataFrame:
    """Yesterday's feed metrics: day, dau, views, likes, ctr.

    ``ctr`` is likes / views and NULL when the day has no views.
    """
    day = as_date(as_of) - dt.timedelta(days=1)
    return (feed.where(time_between(feed, day, as_of))
            .groupBy(F.to_date("time").alias("day"))
            .agg(distinct_count("user_id", approx_rsd).alias("dau"),
                 F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"))
            .withColumn("ctr", F.try_divide(F.col("likes"), F.col("views"))))


def msg_metrics(messages: DataFrame, as_of, approx_rsd: float | None = None) -> DataFrame:
    """Yesterday's messenger metrics: day, dau, msgs_sent (non-NULL receivers)."""
    day = as_date(as_of) - dt.timedelta(days=1)
    return (messages.where(time_between(messages, day, as_of))
            .groupBy(F.to_date("time").alias("day"))
            .agg(distinct_count("user_id", approx_rsd).alias("dau"),
                 F.count("receiver_id").alias("msgs_sent")))


# ------------------------------------------------------------------ DAU

def dau_from_days(feed_days: DataFrame, msg_days: DataFrame, as_of) -> DataFrame:
    """``dau_by_source`` over (user, [source,] day) rollups."""
    def active(days, service):
        pairs = _before(days, as_of).select("user_id", "day")
        if "source" in days.columns:      # a (user, source, day) rollup: collapse sources
            pairs = pairs.distinct()
        return pairs.withColumn("source", F.lit(service))

    both = active(feed_days, FEED).unionByName(active(msg_days, MESSAGE))
    return (both.groupBy("day", "source")
            .agg(F.count(F.lit(1)).alias("users"))
            .orderBy("day", "source"))


def dau_by_source(feed: DataFrame, messages: DataFrame, as_of) -> DataFrame:
    """Daily active users per service for every day before ``as_of``.

    Columns: day, source ('feed' or 'message'), users.
    """
    return dau_from_days(user_days(feed, as_of, by_source=False),
                         user_days(messages, as_of, by_source=False), as_of)


def dau_matrix(dau: DataFrame, sources=(FEED, MESSAGE)) -> DataFrame:
    """Day x service matrix of ``dau_by_source``; missing cells are NULL."""
    return (dau.groupBy("day").pivot("source", list(sources))
            .agg(F.sum("users")).orderBy("day"))


# ------------------------------------------------------------------ actions

def actions_from_days(feed_days: DataFrame, msg_days: DataFrame, as_of) -> DataFrame:
    """``actions_per_day`` over rollups: sum actions per (day, user), then per day."""
    def rows(days):
        return _before(days, as_of).select("day", "user_id", "actions")

    per_user = (rows(msg_days).unionByName(rows(feed_days))
                .groupBy("day", "user_id").agg(F.sum("actions").alias("actions_cnt")))
    return (per_user.groupBy("day")
            .agg(F.count(F.lit(1)).alias("unique_users"),
                 F.sum("actions_cnt").alias("total_actions"))
            .withColumn("actions_per_user",
                        F.try_divide(F.col("total_actions"), F.col("unique_users")))
            .orderBy("day"))


def actions_per_day(feed: DataFrame, messages: DataFrame, as_of) -> DataFrame:
    """Per day over both services: unique_users, total_actions, actions_per_user.

    A user active in both services on one day counts once. The two event
    streams are unioned as (day, user) rows and counted per (day, user) in
    one aggregation (partial counts map-side), so the per-day step is a
    count and a sum rather than a distinct count.
    """
    def rows(df):
        return (df.where(time_between(df, None, as_of))
                .select(F.to_date("time").alias("day"), "user_id"))

    per_user = (rows(messages).unionByName(rows(feed))
                .groupBy("day", "user_id").agg(F.count(F.lit(1)).alias("actions_cnt")))
    return (per_user.groupBy("day")
            .agg(F.count(F.lit(1)).alias("unique_users"),
                 F.sum("actions_cnt").alias("total_actions"))
            .withColumn("actions_per_user",
                        F.try_divide(F.col("total_actions"), F.col("unique_users")))
            .orderBy("day"))


# ------------------------------------------------------------------ posts

def post_days(feed: DataFrame, until=None) -> DataFrame:
    """Distinct (day, post_id) rows: the rollup behind ``unique_posts_per_day``."""
    src = feed if until is None else feed.where(time_between(feed, None, until))
    return src.select(F.to_date("time").alias("day"), "post_id").distinct()


def unique_posts_from_days(posts: DataFrame, as_of) -> DataFrame:
    """``unique_posts_per_day`` over a (day, post_id) rollup."""
    return (_before(posts, as_of).groupBy("day")
            .agg(F.count(F.lit(1)).alias("unique_posts"))
            .orderBy("day"))


def unique_posts_per_day(feed: DataFrame, as_of, approx_rsd: float | None = None) -> DataFrame:
    """Distinct posts acted on per day before ``as_of``: day, unique_posts."""
    return (feed.where(time_between(feed, None, as_of))
            .groupBy(F.to_date("time").alias("day"))
            .agg(distinct_count("post_id", approx_rsd).alias("unique_posts"))
            .orderBy("day"))


# ------------------------------------------------------------------ new users

def new_users_from_days(feed_days: DataFrame) -> DataFrame:
    """``new_users_by_source`` over a (user_id, source, day) rollup.

    ``lag`` over (user, source) ordered by day: a window group holds one row
    per active day of one user, so no group grows with the event volume.
    """
    days = feed_days.select("user_id", "source", F.col("day").alias("this_day"))
    w = Window.partitionBy("user_id", "source").orderBy("this_day")
    return (days.withColumn("prev_day", F.lag("this_day").over(w))
            .where(F.col("prev_day").isNull()
                   | (F.col("prev_day") != F.date_sub("this_day", 1)))
            .groupBy("this_day", "source")
            .agg(F.count(F.lit(1)).alias("num_users"))
            .select("this_day",
                    F.date_sub("this_day", 1).alias("previous_day"),
                    "num_users",
                    F.lit("new").alias("status"),
                    "source")
            .orderBy("this_day", "source"))


def new_users_by_source(feed: DataFrame, until=None) -> DataFrame:
    """Users active on a day in a traffic source but not the day before.

    Columns: this_day, previous_day, num_users, status ('new'), source.
    "New" means absent on the previous day, not first ever. There is no date
    bound unless ``until`` (exclusive day) is given.
    """
    return new_users_from_days(user_days(feed, until, by_source=True))


def new_users_map(new_users: DataFrame) -> DataFrame:
    """this_day, users: a map from traffic source to new users.

    The matrix for sources that are not known beforehand: one plan without a
    job that looks for them, and no limit on their number. A day's map holds
    one entry per source; a null source has the key ''.
    """
    pair = F.struct(F.coalesce(F.col("source"), F.lit("")).alias("key"), F.col("num_users").alias("value"))
    per_key = (new_users.select("this_day", F.inline(F.array(pair)))
               .groupBy("this_day", "key").agg(F.sum("value").alias("value")))
    return (per_key.groupBy("this_day")
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("users"))
            .orderBy("this_day"))


def new_users_matrix(new_users: DataFrame, sources=None) -> DataFrame:
    """Day x traffic-source matrix of ``new_users_by_source``.

    Without ``sources`` Spark finds the distinct sources itself (one small
    job, capped by ``spark.sql.pivotMaxValues``); ``new_users_map`` needs
    neither the list nor that job.
    """
    g = new_users.groupBy("this_day")
    g = g.pivot("source", list(sources)) if sources is not None else g.pivot("source")
    return g.agg(F.sum("num_users")).orderBy("this_day")
