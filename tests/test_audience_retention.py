"""Weekly audience and retention on hand-made frames, plus properties on test data."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import audience, retention

D = dt.date


def _rows(df):
    return sorted((r["this_week"], r["status"], r["num_users"]) for r in df.collect())


def test_week_gaps_and_year_end(make_feed):
    # weeks (Mondays): 2023-12-25, 2024-01-01 (across the year end), gap, 2024-01-15
    feed = make_feed([(1, "2023-12-27 10:00:00", "view"),
                      (1, "2024-01-02 10:00:00", "view"),
                      (1, "2024-01-16 10:00:00", "view"),
                      (2, "2023-12-28 10:00:00", "view")])
    got = _rows(audience.weekly_audience(feed, D(2024, 1, 17), weeks=8))
    assert (D(2023, 12, 25), "new", 2) in got
    assert (D(2024, 1, 1), "retained", 1) in got          # across the year end
    assert (D(2024, 1, 1), "gone", -1) in got             # user 2 left
    assert (D(2024, 1, 8), "gone", -1) in got             # one-week gap
    assert (D(2024, 1, 15), "new", 1) in got              # back after the gap: new
    # gone is never reported for the week after the current one
    assert all(w <= D(2024, 1, 15) for w, _, _ in got)


def test_weeks_before_window_only_decide_status(make_feed):
    feed = make_feed([(1, "2023-01-02 10:00:00", "view"),     # far outside
                      (1, "2024-01-01 10:00:00", "view")])
    got = _rows(audience.weekly_audience(feed, D(2024, 1, 3), weeks=2))
    assert got == [(D(2024, 1, 1), "new", 1)]


def test_audience_identities_on_test_data(spark):
    import __spark_entry__ as E
    from conftest import SF01
    feed, _ = E._events(spark, SF01)
    aud = {(r["this_week"], r["status"]): r["num_users"]
           for r in audience.weekly_audience(feed, E.AS_OF).collect()}
    active = {r["w"]: r["n"] for r in feed.groupBy(F.trunc(F.to_date("time"), "week").alias("w"))
              .agg(F.count_distinct("user_id").alias("n")).collect()}
    for (w, st), n in aud.items():
        if st == "new":
            assert n + aud.get((w, "retained"), 0) == active[w]
        if st == "gone":
            prev = w - dt.timedelta(weeks=1)
            assert -n == active.get(prev, 0) - aud.get((w, "retained"), 0)


def test_retention_day_zero_is_full(spark):
    import __spark_entry__ as E
    from conftest import SF01
    feed, _ = E._events(spark, SF01)
    ret = retention.retention(feed, E.RETENTION_AS_OF)
    day0 = ret.where("cohort_day = 0").collect()
    assert day0 and all(r["retention_pct"] == 100.0 for r in day0)
    assert all(r["active_users"] <= r["cohort_users"] for r in ret.collect())


def test_retention_on_rollup_equals_events(spark):
    import __spark_entry__ as E
    from conftest import SF01
    from tidemark.operators.activity import user_days
    feed, _ = E._events(spark, SF01)
    a = retention.retention(feed, E.RETENTION_AS_OF).collect()
    b = retention.retention(user_days(feed), E.RETENTION_AS_OF, from_days=True).collect()
    assert a == b


def test_first_seen_update(make_feed, spark):
    feed = make_feed([(1, "2024-03-01 10:00:00", "view"), (2, "2024-03-02 10:00:00", "view"),
                      (1, "2024-03-02 11:00:00", "view")])
    first = retention.cohort_start(feed, until=D(2024, 3, 2))
    upd = retention.first_seen_update(first, feed, D(2024, 3, 2))
    assert sorted(tuple(r) for r in upd.collect()) == sorted(
        tuple(r) for r in retention.cohort_start(feed).collect())


def test_retention_with_stored_first_days(spark):
    import __spark_entry__ as E
    from conftest import SF01
    from tidemark.operators.activity import user_days
    feed, _ = E._events(spark, SF01)
    first = retention.cohort_start(feed)
    a = retention.retention(feed, E.RETENTION_AS_OF).collect()
    b = retention.retention(feed, E.RETENTION_AS_OF, first_seen=first).collect()
    c = retention.retention(user_days(feed), E.RETENTION_AS_OF, from_days=True,
                            first_seen=first).collect()
    assert a == b == c


def test_two_week_gap(make_feed):
    # active in weeks of 2024-01-01 and 2024-01-22 only: gone once, then new again
    feed = make_feed([(1, "2024-01-02 10:00:00", "view"), (1, "2024-01-23 10:00:00", "view")])
    got = _rows(audience.weekly_audience(feed, D(2024, 1, 24), weeks=8))
    assert got == [(D(2024, 1, 1), "new", 1), (D(2024, 1, 8), "gone", -1),
                   (D(2024, 1, 22), "new", 1)]
