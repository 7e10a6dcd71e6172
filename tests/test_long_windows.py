"""Look-backs longer than one word of bits, against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest

from tidemark.operators import audience, retention

AS_OF = dt.date(2024, 6, 5)


def _events(seed, users, days, per_user):
    rng = random.Random(seed)
    return sorted({(u, AS_OF - dt.timedelta(days=rng.randrange(-2, days)))
                   for u in range(users) for _ in range(rng.randrange(1, per_user))})


def _feed(make_feed, pairs):
    return make_feed([(u, f"{d} 12:00:00", "view") for u, d in pairs])


def _audience(pairs, weeks):
    def week(d):
        return d - dt.timedelta(days=d.weekday())
    one = dt.timedelta(weeks=1)
    first = week(AS_OF) - weeks * one
    active = {(u, week(d)) for u, d in pairs if d <= AS_OF}
    out = Counter()
    for u, w in active:
        if w >= first:
            out[w, "retained" if (u, w - one) in active else "new"] += 1
        if first <= w + one <= week(AS_OF) and (u, w + one) not in active:
            out[w + one, "gone"] -= 1
    return dict(out)


@pytest.mark.parametrize("weeks", [14, 15, 16, 104])
def test_audience_of_many_weeks(make_feed, weeks):
    pairs = _events(weeks, 40, 7 * (weeks + 4), 30)
    got = {(r["this_week"], r["status"]): r["num_users"]
           for r in audience.weekly_audience(_feed(make_feed, pairs), AS_OF, weeks).collect()}
    assert got == _audience(pairs, weeks)


@pytest.mark.parametrize("cohorts", [15, 16, 90])
def test_retention_of_many_days(make_feed, cohorts):
    pairs = _events(cohorts, 60, cohorts + 10, 25)
    feed = _feed(make_feed, pairs)
    first = {}
    for u, d in pairs:
        first[u] = min(first.get(u, d), d)
    lo = AS_OF - dt.timedelta(days=cohorts)
    want = Counter((first[u], d) for u, d in pairs if lo <= first[u] < AS_OF and d <= AS_OF)
    for stored in (None, retention.cohort_start(feed)):
        rows = retention.retention(feed, AS_OF, cohorts, first_seen=stored).collect()
        assert {(r["start_day"], r["date"]): r["active_users"] for r in rows} == dict(want)
        assert all(r["cohort_users"] == want[r["start_day"], r["start_day"]] for r in rows)


def test_windows_of_no_length_are_refused(make_feed):
    feed = make_feed([])
    with pytest.raises(ValueError):
        audience.weekly_audience(feed, AS_OF, 0)
    with pytest.raises(ValueError):
        retention.retention(feed, AS_OF, 0)
