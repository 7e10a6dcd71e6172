"""First-seen state of the rollup store, and publishing of all report tables together."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import report
from tidemark.plans.publish import manifest, publish_report, published, read_report


def _first(spark, store):
    rows = (report.read_rollups(spark, store)["first_seen"]
            .groupBy("user_id").agg(F.min("start_day").alias("d")).collect())
    return {r["user_id"]: r["d"].day for r in rows}


def _brute(rows):
    out = {}
    for user, t, *_ in rows:
        out[user] = min(out.get(user, 99), int(t[8:10]))
    return out


def test_first_seen_follows_late_and_removed_events(spark, make_feed, make_msgs, tmp_path):
    store = str(tmp_path)
    none = make_msgs([])
    rows = [(1, "2024-01-02 10:00:00", "view"), (2, "2024-01-02 10:00:00", "view"),
            (1, "2024-01-03 10:00:00", "like"), (3, "2024-01-04 10:00:00", "view"),
            (2, "2024-01-04 11:00:00", "view")]
    report.append_rollups(make_feed(rows), none, "2024-01-01", "2024-01-05", store)
    assert _first(spark, store) == _brute(rows)

    # a late day before all others, then the same day again
    late = rows + [(3, "2024-01-01 08:00:00", "view"), (4, "2024-01-01 08:00:00", "view")]
    for _ in range(2):
        report.append_rollups(make_feed(late), none, "2024-01-01", "2024-01-02", store)
        assert _first(spark, store) == _brute(late)

    # a corrected day 2 without user 2: the first day moves to day 4
    fixed = [r for r in late if r[:2] != (2, "2024-01-02 10:00:00")]
    report.append_rollups(make_feed(fixed), none, "2024-01-02", "2024-01-03", store)
    got = _first(spark, store)
    assert got == _brute(fixed) and got[2] == 4


def test_state_partition_holds_new_users_only(spark, make_feed, make_msgs, tmp_path):
    rows = [(u, f"2024-01-0{d} 10:00:00", "view") for d in (1, 2, 3) for u in range(d * 10)]
    report.append_rollups(make_feed(rows), make_msgs([]), "2024-01-01", "2024-01-04", str(tmp_path))
    per_day = {str(r["day"]): r["count"] for r in
               spark.read.parquet(f"{tmp_path}/first_seen").groupBy("day").count().collect()}
    assert per_day == {"2024-01-01": 10, "2024-01-02": 10, "2024-01-03": 10}


@pytest.mark.parametrize("as_of", ["2024-01-08", "2024-01-05"])
def test_retention_from_stored_first_days(spark, tmp_path, as_of):
    import __spark_entry__ as E
    from conftest import SF001
    feed, msg = E._events(spark, SF001)
    report.append_rollups(feed, msg, "2024-01-01", "2024-01-10", str(tmp_path))
    stored = report.read_rollups(spark, str(tmp_path))
    assert "first_seen" in stored
    # the state runs past as_of: later first days and days must not count
    a = report.daily_report(feed, msg, as_of, **stored)
    b = report.daily_report(feed, msg, as_of)
    for name in ("retention", "retention_matrix", "new_users", "dau"):
        rows = [tuple(r) for r in b[name].collect()]
        assert [tuple(r) for r in a[name].collect()] == rows and rows, name


def _tables(spark, n):
    return {"a": spark.createDataFrame([(n,)], "x int"), "b": spark.createDataFrame([(n * 10,)], "y int")}


def _read(spark, path, **days):
    return {n: sorted(tuple(r) for r in read_report(spark, path, n, **days).collect()) for n in "ab"}


def test_a_run_killed_between_two_tables_shows_the_old_day(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(LookupError):
        read_report(spark, path, "a")
    day = dt.date(2024, 1, 2)
    publish_report(_tables(spark, 1), path, day)
    before = _read(spark, path)
    assert before == {"a": [(1, day)], "b": [(10, day)]}
    broken = _tables(spark, 2)
    broken["b"] = broken["b"].withColumn("y", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        publish_report(broken, path, day)
    assert _read(spark, path) == before and manifest(spark, path).count() == 1
    publish_report(_tables(spark, 3), path, day)
    assert _read(spark, path) == {"a": [(3, day)], "b": [(30, day)]}


def test_published_days_are_read_by_range_and_emptied_by_a_rerun(spark, tmp_path):
    path = str(tmp_path)
    for n in (1, 2, 3):
        publish_report(_tables(spark, n), path, dt.date(2024, 1, n))
    assert _read(spark, path, start="2024-01-02", end="2024-01-03")["a"] == [(2, dt.date(2024, 1, 2))]
    publish_report({n: df.limit(0) for n, df in _tables(spark, 9).items()}, path, "2024-01-02")
    assert [r[0] for r in _read(spark, path)["a"]] == [1, 3]
    assert sorted((r["as_of"].day, r["seq"]) for r in published(spark, path).collect()) == [(1, 1), (2, 2), (3, 1)]
    with pytest.raises(LookupError):
        read_report(spark, path, "a", start="2025-01-01")


def test_backfill_publishes_each_day(spark, tmp_path):
    import __spark_entry__ as E
    from conftest import SF001
    feed, msg = E._events(spark, SF001)
    report.backfill(feed, msg, "2024-01-08", "2024-01-09", str(tmp_path), publish=True)
    got = read_report(spark, str(tmp_path), "retention").drop("as_of")
    want = report.retention.retention(feed, "2024-01-08")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
