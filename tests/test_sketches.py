"""Stored sketches: merged ranges stay within the error, in any split; source maps."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import activity, sketches
from tidemark.plans import report


@pytest.fixture(scope="module")
def big(spark):
    """60,000 actions of some 20,000 users over 20 days, one source with most rows."""
    i = F.col("id")
    return (spark.range(60_000).select(
        (F.xxhash64(i) % 20_000).alias("user_id"),
        F.expr("timestamp'2024-01-01 06:00:00' + make_dt_interval(cast(pmod(xxhash64(id, 1), 20) as int))").alias("time"),
        F.lit("view").alias("action"), F.pmod(F.xxhash64(i, F.lit(2)), F.lit(3000)).alias("post_id"),
        F.when(i % 10 < 9, "ads").otherwise("organic").alias("source")))


def test_a_range_is_within_the_error(big):
    s = sketches.daily_sketches(big)
    for lo, hi in (("2024-01-01", "2024-01-21"), ("2024-01-03", "2024-01-10")):
        got = sketches.range_uniques(s, lo, hi).first()
        want = (big.where((F.col("time") >= lo) & (F.col("time") < hi))
                .agg(F.count("*"), F.count_distinct("user_id"), F.count_distinct("post_id")).first())
        assert got["actions"] == want[0]
        assert got["users"] == pytest.approx(want[1], rel=0.05)
        assert got["posts"] == pytest.approx(want[2], rel=0.05)
    by = {r["source"]: r["users"] for r in
          sketches.range_uniques(s, "2024-01-01", "2024-01-21", ("source",)).collect()}
    assert set(by) == {"ads", "organic"} and by["ads"] > by["organic"]
    none = sketches.range_uniques(s, "2025-01-01", "2025-02-01").first()
    assert (none["actions"], none["users"], none["posts"]) == (0, 0, 0)


def test_trailing_windows(big):
    got = {(str(r["day"]), r["window_days"]): r["users"] for r in
           sketches.trailing_uniques(sketches.daily_sketches(big), "2024-01-08", "2024-01-10", (1, 7)).collect()}
    assert set(got) == {(d, w) for d in ("2024-01-08", "2024-01-09") for w in (1, 7)}
    want = big.where("time >= '2024-01-03' and time < '2024-01-10'").select("user_id").distinct().count()
    assert got["2024-01-09", 7] == pytest.approx(want, rel=0.05)


def test_sketches_of_the_store_equal_those_of_the_events(spark, tmp_path):
    import __spark_entry__ as E
    from conftest import SF001
    feed, msg = E._events(spark, SF001)
    report.append_rollups(feed, msg, "2024-01-05", "2024-01-07", str(tmp_path))
    stored = report.read_sketches(spark, str(tmp_path))
    args = ("2024-01-05", "2024-01-07", ("source",))
    direct = sketches.range_uniques(sketches.daily_sketches(feed, *args[:2]), *args)
    assert sorted(map(tuple, sketches.range_uniques(stored, *args).collect())) == \
        sorted(map(tuple, direct.collect())) != []


def test_source_map_with_null_source(spark):
    rows = spark.createDataFrame([("2024-01-01", "b", 2), ("2024-01-01", None, 1), ("2024-01-01", "a", 5),
                                  ("2024-01-02", "a", 7)], "this_day string, source string, num_users long")
    got = {r["this_day"]: r["users"] for r in activity.new_users_map(rows).collect()}
    assert got == {"2024-01-01": {"": 1, "a": 5, "b": 2}, "2024-01-02": {"a": 7}}
    assert activity.new_users_map(rows.limit(0)).collect() == []
