"""Cohort retention: users grouped by first active day, tracked day by day.

A user's cohort is the first day with any feed action. Retention reports the
cohorts that started in the ``cohorts`` full days before ``as_of`` and, for
each later day through ``as_of`` itself (the run day's data counts), how many
of them were active and which percent of the cohort that is.

Plan. One aggregation per user gives both the first day (``min``) and a
bitmask words of the days active inside ``[as_of - cohorts, as_of]`` (``bit_or``):
one shuffle by ``user_id`` with map-side partial aggregation and a
fixed-width row per user. Users are counted per (start_day, word, mask) pattern;
each pattern is expanded to its active days and summed per (cohort, day).
The cohort size is the day-0 count (every member is active on its first
day), so no join with a cohort-size table is needed. The first day needs
the whole history, so only the upper time bound reaches the scan; see
``first_seen_update`` for keeping first days incrementally instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bits import WORD, fold, is_set, n_words, unfold
from ..functions.dates import as_date, time_between


def cohort_start(feed: DataFrame, until=None) -> DataFrame:
    """First active day per user: user_id, start_day (``until`` exclusive, optional)."""
    src = feed if until is None else feed.where(time_between(feed, None, until))
    return src.groupBy("user_id").agg(F.min(F.to_date("time")).alias("start_day"))


def cohort_size(feed: DataFrame, until=None) -> DataFrame:
    """Users per first day: start_day, cohort_users."""
    return (cohort_start(feed, until).groupBy("start_day")
            .agg(F.count(F.lit(1)).alias("cohort_users"))
            .orderBy("start_day"))


def first_seen_update(first_seen: DataFrame, feed: DataFrame, day) -> DataFrame:
    """Fold one day of events into a stored (user_id, start_day) table.

    Lets a daily job keep first days without rescanning the whole history:
    only ``day``'s events are read. A user's first day is the least seen, so
    a day that is folded in late (or again) still gives the right table.
    """
    d = as_date(day)
    today = (feed.where(time_between(feed, d, d + dt.timedelta(days=1)))
             .select("user_id", F.lit(d.isoformat()).cast("date").alias("start_day")))
    return (first_seen.select("user_id", "start_day").unionByName(today)
            .groupBy("user_id").agg(F.min("start_day").alias("start_day")))


def _cohort_counts(feed: DataFrame, as_of, cohorts: int, from_days: bool = False,
                   first_seen: DataFrame | None = None) -> tuple[DataFrame, dt.date]:
    if cohorts < 1:
        raise ValueError("cohorts must be at least 1")
    a = as_date(as_of)
    lo = a - dt.timedelta(days=cohorts)
    lo_lit = F.lit(lo.isoformat()).cast("date")
    end = a + dt.timedelta(days=1)
    # with stored first days only the cohort window of activity is needed
    start = lo if first_seen is not None else None
    if from_days:
        src = feed.where(F.col("day") < F.lit(end.isoformat()).cast("date"))
    else:
        src = feed.where(time_between(feed, start, end)).select(
            "user_id", F.to_date("time").alias("day"))
    words = n_words(cohorts + 1)
    masks = fold(F.datediff("day", lo_lit), words)       # days before the window are in no word
    in_window = (F.col("start_day") >= lo_lit) & (F.col("start_day") < F.lit(a.isoformat()).cast("date"))
    if first_seen is None:
        users = (src.select("user_id", "day")
                 .groupBy("user_id")
                 .agg(F.min("day").alias("start_day"), *masks)
                 .where(in_window))
    else:
        # stored first days: only the cohort window of activity is read, and it is
        # one row of masks per user before the join, so a hot user is one row there
        cohort = first_seen.select("user_id", "start_day").where(in_window)
        recent = src.where(F.col("day") >= lo_lit).groupBy("user_id").agg(*masks)
        users = cohort.join(recent, "user_id")

    # users per (start_day, activity pattern): at most cohorts * 2^16 keys per word of 16 days
    patterns = (users.select("start_day", unfold(words))
                .groupBy("start_day", "word", "mask").agg(F.count(F.lit(1)).alias("users")))
    active = (patterns
              .select("start_day", "word", "mask", "users",
                      F.explode(F.sequence(F.lit(0), F.lit(min(WORD, cohorts + 1) - 1))).alias("bit"))
              .where(is_set("mask", F.col("bit")))
              .groupBy("start_day", (F.col("word") * WORD + F.col("bit")).alias("i"))
              .agg(F.sum("users").alias("active_users")))
    return active, lo


def retention(feed: DataFrame, as_of, cohorts: int = 7, from_days: bool = False,
              first_seen: DataFrame | None = None) -> DataFrame:
    """Long-form retention.

    Columns: start_day, date, active_users, cohort_users, retention_pct
    (active / cohort * 100), cohort_day (days since start_day). With
    ``from_days=True`` the input is a (user_id, [source,] day) rollup. A
    stored ``first_seen`` table (user_id, start_day), kept with
    ``first_seen_update``, replaces the full-history ``min``: only the last
    ``cohorts + 1`` days of activity are read.
    """
    active, lo = _cohort_counts(feed, as_of, cohorts, from_days, first_seen)
    lo_lit = F.lit(lo.isoformat()).cast("date")
    # every cohort member is active on its first day, so the cohort size is the
    # day-0 count; the window runs over at most cohorts * (cohorts + 1) rows
    size = F.max(F.when(F.date_add(lo_lit, F.col("i")) == F.col("start_day"),
                        F.col("active_users"))).over(Window.partitionBy("start_day"))
    return (active
            .select("start_day", F.date_add(lo_lit, F.col("i")).alias("date"),
                    "active_users", size.alias("cohort_users"))
            .select("start_day", "date", "active_users", "cohort_users",
                    (F.col("active_users") * 100.0 / F.col("cohort_users")).alias("retention_pct"),
                    F.datediff("date", "start_day").alias("cohort_day"))
            .orderBy("start_day", "date"))


def retention_matrix(long_form: DataFrame, cohorts: int = 7) -> DataFrame:
    """start_day x cohort_day matrix of retention_pct (columns day_0 .. day_<cohorts>)."""
    wide = (long_form.groupBy("start_day")
            .pivot("cohort_day", list(range(cohorts + 1)))
            .agg(F.first("retention_pct")))
    return wide.select("start_day", *[F.col(f"`{i}`").alias(f"day_{i}")
                                      for i in range(cohorts + 1)]).orderBy("start_day")
