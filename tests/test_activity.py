"""Daily metrics on hand-made frames."""

import datetime as dt

from tidemark.operators import activity

D = dt.date


def test_feed_metrics_zero_views_gives_null_ctr(make_feed):
    feed = make_feed([(1, "2024-03-09 10:00:00", "like"),
                      (2, "2024-03-09 11:00:00", "like"),
                      (1, "2024-03-10 10:00:00", "view")])       # run day itself: excluded
    r = activity.feed_metrics(feed, D(2024, 3, 10)).collect()
    assert len(r) == 1
    assert (r[0]["day"], r[0]["dau"], r[0]["views"], r[0]["likes"]) == (D(2024, 3, 9), 2, 0, 2)
    assert r[0]["ctr"] is None


def test_msg_metrics_counts_non_null_receivers(make_msgs):
    msgs = make_msgs([(1, "2024-03-09 10:00:00", 5), (1, "2024-03-09 12:00:00", None),
                      (2, "2024-03-09 13:00:00", 7)])
    r = activity.msg_metrics(msgs, D(2024, 3, 10)).collect()[0]
    assert (r["dau"], r["msgs_sent"]) == (2, 2)


def test_dau_user_in_both_services_and_duplicates(make_feed, make_msgs):
    feed = make_feed([(1, "2024-03-08 10:00:00", "view"), (1, "2024-03-08 10:00:00", "view"),
                      (2, "2024-03-08 11:00:00", "like")])
    msgs = make_msgs([(1, "2024-03-08 09:00:00", 3)])
    dau = {(r["day"], r["source"]): r["users"]
           for r in activity.dau_by_source(feed, msgs, D(2024, 3, 10)).collect()}
    assert dau == {(D(2024, 3, 8), "feed"): 2, (D(2024, 3, 8), "message"): 1}
    act = activity.actions_per_day(feed, msgs, D(2024, 3, 10)).collect()
    assert len(act) == 1
    # user 1 counted once across services; 4 actions in total
    assert (act[0]["unique_users"], act[0]["total_actions"]) == (2, 4)
    assert act[0]["actions_per_user"] == 2.0


def test_day_without_events_is_absent(make_feed):
    feed = make_feed([(1, "2024-03-01 10:00:00", "view"), (1, "2024-03-03 10:00:00", "view")])
    days = [r["day"] for r in activity.unique_posts_per_day(feed, D(2024, 3, 10)).collect()]
    assert days == [D(2024, 3, 1), D(2024, 3, 3)]


def test_new_users_means_absent_yesterday(make_feed):
    feed = make_feed([(1, "2024-03-01 10:00:00", "view", "ads"),
                      (1, "2024-03-02 10:00:00", "view", "ads"),
                      (1, "2024-03-04 10:00:00", "view", "ads"),       # gap: new again
                      (1, "2024-03-02 10:00:00", "view", "organic")])  # other source: new
    got = sorted((r["this_day"], r["source"], r["num_users"])
                 for r in activity.new_users_by_source(feed).collect())
    assert got == [(D(2024, 3, 1), "ads", 1), (D(2024, 3, 2), "organic", 1),
                   (D(2024, 3, 4), "ads", 1)]


def test_pivot_keys_are_unique(spark):
    import __spark_entry__ as E
    from conftest import SF01
    dau = activity.dau_by_source(*E._events(spark, SF01), E.AS_OF)
    assert dau.count() == dau.select("day", "source").distinct().count()


def test_approx_distinct_close_to_exact(spark):
    import __spark_entry__ as E
    from conftest import SF01
    feed, _ = E._events(spark, SF01)
    exact = {r["day"]: r["unique_posts"]
             for r in activity.unique_posts_per_day(feed, E.AS_OF).collect()}
    approx = {r["day"]: r["unique_posts"]
              for r in activity.unique_posts_per_day(feed, E.AS_OF, approx_rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(2, 0.1 * exact[d]) for d in exact)
