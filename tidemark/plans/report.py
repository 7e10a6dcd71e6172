"""The daily app report: every table for one run day, its caption, its sink.

``daily_report`` builds the (user, source, day) rollups of both event tables
once, materializes them, and derives the DAU, actions, new-user, audience and
retention tables from them; the two one-day metric tables and the posts table
read the events directly with pushed-down time bounds. Nothing is collected:
the caller writes the tables (``write_report``) or reads the one-row caption.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, time_between
from ..operators import activity, audience, retention, sketches
from ..session import materialize, reuse
from .publish import publish_report

# Fixed caption text of the report message (values that must match the
# original report's wording and layout).
CAPTION_TITLE = "Отчет по приложению:"
CAPTION_FEED = "Метрики по новостной ленте за "
CAPTION_MSG = "Метрики по мессенджеру за "
CAPTION_DATE_FORMAT = "dd-MM-yyyy"


def thousands(col: str | Column) -> Column:
    """Integer with thousands separated by spaces: 1234567 -> '1 234 567'."""
    return F.regexp_replace(F.format_number(F.col(col) if isinstance(col, str) else col, 0),
                            ",", " ")


def percent2(col: str | Column) -> Column:
    """Ratio as a percent with two decimals: 0.12345 -> '12.35%' (NULL -> 'nan%')."""
    c = F.col(col) if isinstance(col, str) else col
    txt = F.regexp_replace(F.format_number(c * 100.0, 2), ",", "")
    return F.concat(F.coalesce(txt, F.lit("nan")), F.lit("%"))


def report_message(feed_m: DataFrame, msg_m: DataFrame) -> DataFrame:
    """One row: day and the caption text built from the two one-day metric rows.

    Both inputs hold at most one row (one day). A service without events that
    day counts 0; there is no row only if both are silent.
    """
    f = feed_m.select(F.col("day"), F.col("dau").alias("f_dau"), "views", "likes", "ctr")
    m = msg_m.select(F.col("day"), F.col("dau").alias("m_dau"), "msgs_sent")
    j = f.join(m, "day", "full").fillna(0, ["f_dau", "m_dau", "views", "likes", "msgs_sent"])
    when = F.date_format("day", CAPTION_DATE_FORMAT)
    text = F.concat(
        F.lit(CAPTION_TITLE + "\n"),
        F.lit(CAPTION_FEED), when, F.lit(":\n"),
        F.lit("DAU: "), thousands("f_dau"), F.lit("\n"),
        F.lit("Views: "), thousands("views"), F.lit("\n"),
        F.lit("Likes: "), thousands("likes"), F.lit("\n"),
        F.lit("CTR: "), percent2("ctr"), F.lit("\n\n"),
        F.lit(CAPTION_MSG), when, F.lit(":\n"),
        F.lit("DAU: "), thousands("m_dau"), F.lit("\n"),
        F.lit("Msgs sent: "), thousands("msgs_sent"))
    return j.select("day", text.alias("message"))


ROLLUPS = ("feed_days", "msg_days", "post_days")
SKETCHES = "feed_sketches"


def append_rollups(feed: DataFrame, messages: DataFrame, start, end, store: str) -> None:
    """Write the rollups of days ``[start, end)`` into ``store`` (one folder per rollup).

    Each day reads only its own events (pushed-down time bounds) and replaces
    its own partition folder, also when nothing is left of it, so a daily job
    appends yesterday and a re-run or late data rewrites the same days. The
    first-seen state of the feed's users is brought along.
    """
    day, e = as_date(start), as_date(end)
    while day < e:
        until = day + dt.timedelta(days=1)
        f = feed.where(time_between(feed, day, until))
        m = messages.where(time_between(messages, day, until))
        parts = {"feed_days": activity.user_days(f, by_source=True),
                 "msg_days": activity.user_days(m, by_source=False),
                 "post_days": activity.post_days(f),
                 SKETCHES: sketches.daily_sketches(f)}
        for name, df in parts.items():
            df.drop("day").write.mode("overwrite").parquet(f"{store.rstrip('/')}/{name}/day={day.isoformat()}")
        _fold_first_seen(feed.sparkSession, store, day)
        day = until


def _stored(spark, store: str, name: str) -> DataFrame | None:
    """A folder of the store, or None before its first day."""
    try:
        return spark.read.parquet(f"{store.rstrip('/')}/{name}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _fold_first_seen(spark, store: str, day: dt.date) -> None:
    """Bring the (user_id, start_day) state up to date with the stored rollup of ``day``.

    The state is partitioned by day: ``first_seen/day=D`` holds users active on
    D that no earlier day holds, so a new day reads the state's user ids and
    its own rollup, never the event history. A day may come late or again: its
    folder is replaced, users it adds are right because readers take the least
    day per user, and users it no longer holds move to their next stored day
    before the replacement (so a run killed in between loses none).
    """
    base = f"{store.rstrip('/')}/first_seen"
    d = F.lit(day.isoformat()).cast("date")
    days = _stored(spark, store, "feed_days")
    active = days.where(F.col("day") == d).select("user_id").distinct()
    state = _stored(spark, store, "first_seen")
    if state is None:
        fresh = active
    else:
        gone = (state.where(F.col("day") == d).select("user_id").distinct()
                .join(active, "user_id", "left_anti"))
        moved = (days.where(F.col("day") > d).select("user_id", "day").join(gone, "user_id", "left_semi")
                 .groupBy("user_id").agg(F.min("day").alias("day")))
        moved.write.mode("append").partitionBy("day").parquet(base)
        fresh = active.join(state.where(F.col("day") < d).select("user_id"), "user_id", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{base}/day={day.isoformat()}")


def read_sketches(spark, store: str) -> DataFrame:
    """The stored (day, source) sketches, for ``sketches.range_uniques`` and ``trailing_uniques``."""
    return spark.read.parquet(f"{store.rstrip('/')}/{SKETCHES}")


def read_rollups(spark, store: str) -> dict[str, DataFrame]:
    """The stored rollups, filters on ``day`` prune day partitions, and ``first_seen``.

    ``first_seen`` has user_id and start_day, possibly several rows a user
    (late days); its least start_day counts. It is absent from a store
    written before it was kept.
    """
    out = {name: spark.read.parquet(f"{store.rstrip('/')}/{name}") for name in ROLLUPS}
    state = _stored(spark, store, "first_seen")
    if state is not None:
        out["first_seen"] = state.select("user_id", F.col("day").alias("start_day"))
    return out


def daily_report(feed: DataFrame, messages: DataFrame, as_of, weeks: int = 8,
                 cohorts: int = 7, feed_days: DataFrame | None = None,
                 msg_days: DataFrame | None = None,
                 post_days: DataFrame | None = None,
                 first_seen: DataFrame | None = None,
                 sources: list[str] | None = None) -> dict[str, DataFrame]:
    """All report tables for run day ``as_of``.

    ``feed_days`` / ``msg_days`` / ``post_days`` may come from a rollup store
    (``append_rollups`` / ``read_rollups``); then only the day before
    ``as_of`` is read from the events. Otherwise the user rollups are built
    from the events up to the end of ``as_of`` and materialized once. A
    stored ``first_seen`` state lets retention read only its cohort window of
    the rollup; days after ``as_of`` are left out and a user's least day counts.
    With ``sources`` the new-user matrix has these columns and needs no job
    that looks for them. The four tables that also feed a matrix are persisted; call
    ``unpersist()`` on the returned frames once they are written.
    """
    a = as_date(as_of)
    end = a + dt.timedelta(days=1)
    if feed_days is None:
        feed_days = materialize(activity.user_days(feed, end, by_source=True))
    else:
        feed_days = feed_days.where(F.col("day") < F.lit(end.isoformat()).cast("date"))
    if msg_days is None:
        msg_days = materialize(activity.user_days(messages, end, by_source=False))
    else:
        msg_days = msg_days.where(F.col("day") < F.lit(end.isoformat()).cast("date"))
    if first_seen is not None:
        first_seen = (first_seen.where(F.col("start_day") < F.lit(end.isoformat()).cast("date"))
                      .groupBy("user_id").agg(F.min("start_day").alias("start_day")))
    posts = (activity.unique_posts_per_day(feed, a) if post_days is None
             else activity.unique_posts_from_days(post_days, a))
    feed_m = activity.feed_metrics(feed, a)
    msg_m = activity.msg_metrics(messages, a)
    # each of these feeds a second table (its matrix): compute once, read twice
    dau = reuse(activity.dau_from_days(feed_days, msg_days, a))
    new_users = reuse(activity.new_users_from_days(feed_days))
    aud = reuse(audience.audience_from_days(feed_days, a, weeks))
    ret = reuse(retention.retention(feed_days, a, cohorts, from_days=True,
                                    first_seen=first_seen))
    return {
        "feed_metrics": feed_m,
        "msg_metrics": msg_m,
        "message": report_message(feed_m, msg_m),
        "dau": dau,
        "dau_matrix": activity.dau_matrix(dau),
        "actions": activity.actions_from_days(feed_days, msg_days, a),
        "posts": posts,
        "new_users": new_users,
        "new_users_matrix": activity.new_users_matrix(new_users, sources),
        "audience": aud,
        "audience_matrix": audience.weekly_audience_matrix(aud),
        "retention": ret,
        "retention_matrix": retention.retention_matrix(ret, cohorts),
    }


def write_report(tables: dict[str, DataFrame], path: str, as_of, fmt: str = "parquet") -> None:
    """Write each table under ``<path>/<name>/as_of=<day>``.

    The run day's partition folder is replaced as a whole, also by a table
    without rows, so a re-run or back-fill of one day is idempotent and
    readers of one day get partition pruning.
    """
    day = as_date(as_of).isoformat()
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{name}/as_of={day}")


def backfill(feed: DataFrame, messages: DataFrame, start, end, path: str,
             store: str | None = None, publish: bool = False) -> list[str]:
    """Report tables for every run day in ``[start, end)``, written under ``path``.

    Each day is an independent, idempotent run (its own ``as_of`` partition),
    so a failed day can be re-run alone. With a rollup ``store`` the days
    read the stored rollups instead of the event history. With ``publish`` a
    day's tables become visible together (``publish.read_report``).
    """
    s, e = as_date(start), as_date(end)
    rollups = read_rollups(feed.sparkSession, store) if store else {}
    done = []
    day = s
    while day < e:
        tables = daily_report(feed, messages, day, **rollups)
        (publish_report if publish else write_report)(tables, path, day)
        for df in tables.values():      # release the day's cached shared tables
            df.unpersist()
        done.append(day.isoformat())
        day += dt.timedelta(days=1)
    return done
