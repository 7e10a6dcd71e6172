"""Weekly audience: new, retained and gone users per week.

For week ``w`` (a Monday) a user active in ``w`` is *retained* when also
active in ``w - 1 week`` and *new* otherwise ("new" means absent last week,
not first ever). A user active in ``w - 1 week`` but not in ``w`` is *gone*
in ``w``; gone counts are negative so a stacked chart shows them below zero.
Reported weeks run from ``Monday(as_of) - weeks`` through the current,
partial week; gone is not reported for the week after the current one.

Plan. The scan is cut to ``[Monday(as_of) - (weeks + 1) weeks, as_of]``
(one extra week decides retained/gone for the first reported week) on the raw
``time`` column, so it prunes at the Parquet level. Each user's active weeks
are folded into bitmask words with ``bit_or``: one shuffle by ``user_id``,
map-side partial aggregation, one fixed-width row per user however hot the
user is. Users are then counted per distinct (word, mask): at most
2^(weeks+2) patterns for up to 15 weeks and 2^17 per 16 weeks beyond,
partially aggregated per task; each pattern is expanded to its
(week, status) pairs and summed, so the status step runs on a tiny table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bits import WORD, fold, is_set, n_words, unfold
from ..functions.dates import as_date, monday, time_between

STATUSES = ("gone", "new", "retained")


def _scan_range(as_of, weeks: int):
    if weeks < 1:
        raise ValueError("weeks must be at least 1")
    first = monday(as_of) - dt.timedelta(weeks=weeks + 1)     # bit 0
    end = as_date(as_of) + dt.timedelta(days=1)               # the whole as_of day
    return first, end


def _week_counts(feed: DataFrame, as_of, weeks: int, from_days: bool = False) -> DataFrame:
    first, end = _scan_range(as_of, weeks)
    if from_days:
        lo, hi = (F.lit(d.isoformat()).cast("date") for d in (first, end))
        src = feed.where((F.col("day") >= lo) & (F.col("day") < hi)).select(
            "user_id", F.col("day").alias("d"))
    else:
        src = feed.where(time_between(feed, first, end)).select(
            "user_id", F.to_date("time").alias("d"))
    bit = F.floor(F.datediff(F.trunc("d", "week"),
                             F.lit(first.isoformat()).cast("date")) / 7).cast("int")
    # statuses 1 .. weeks + 1; a word also holds the last week of the word before
    words = n_words(weeks + 1)
    masks = (src.select("user_id", bit.alias("k"))
             .groupBy("user_id").agg(*fold(F.col("k"), words, overlap=1)))
    # users per activity pattern: a bounded number of keys, so the status
    # step below runs on a tiny table whatever the number of users
    patterns = masks.select(unfold(words)).groupBy("word", "mask").agg(F.count(F.lit(1)).alias("users"))
    cur, prev = is_set("mask", F.col("i")), is_set("mask", F.col("i") - 1)
    status = (F.when(cur & prev, F.lit("retained"))
              .when(cur, F.lit("new"))
              .when(prev, F.lit("gone")))
    first_lit = F.lit(first.isoformat()).cast("date")
    return (patterns
            .select("users", "word", "mask",
                    F.explode(F.sequence(F.lit(1), F.lit(min(WORD, weeks + 1)))).alias("i"))
            .select("users", (F.col("word") * WORD + F.col("i")).alias("j"), status.alias("status"))
            .where(F.col("status").isNotNull() & (F.col("j") <= weeks + 1))
            .groupBy("j", "status").agg(F.sum("users").alias("n"))
            .select(F.date_add(first_lit, F.col("j") * 7).alias("this_week"),
                    F.date_add(first_lit, (F.col("j") - 1) * 7).alias("previous_week"),
                    F.when(F.col("status") == "gone", -F.col("n"))
                     .otherwise(F.col("n")).cast("bigint").alias("num_users"),
                    "status"))


def audience_from_days(feed_days: DataFrame, as_of, weeks: int = 8) -> DataFrame:
    """``weekly_audience`` over a (user_id, [source,] day) rollup."""
    return _week_counts(feed_days, as_of, weeks, from_days=True).orderBy("this_week", "status")


def weekly_gone(feed: DataFrame, as_of, weeks: int = 8) -> DataFrame:
    """Churned users per week (negative counts): this_week, previous_week, num_users, status."""
    return (_week_counts(feed, as_of, weeks).where(F.col("status") == "gone")
            .orderBy("this_week"))


def weekly_active_status(feed: DataFrame, as_of, weeks: int = 8) -> DataFrame:
    """New and retained users per week."""
    return (_week_counts(feed, as_of, weeks).where(F.col("status") != "gone")
            .orderBy("this_week", "status"))


def weekly_audience(feed: DataFrame, as_of, weeks: int = 8) -> DataFrame:
    """Gone, new and retained users per week, sorted by week."""
    return _week_counts(feed, as_of, weeks).orderBy("this_week", "status")


def weekly_audience_matrix(audience: DataFrame) -> DataFrame:
    """Week x status matrix (columns gone, new, retained); missing cells NULL."""
    return (audience.groupBy("this_week").pivot("status", list(STATUSES))
            .agg(F.sum("num_users")).orderBy("this_week"))
