"""Report caption, partitioned sink, segmentation invariants."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import segments
from tidemark.plans import report


def test_caption_number_formats(spark):
    df = spark.createDataFrame([(1234567, 0.123456, 0.125, None)],
                               "n long, r double, half double, missing double")
    r = df.select(report.thousands("n").alias("a"), report.percent2("r").alias("b"),
                  report.percent2(F.col("r") * 100).alias("c"),
                  report.percent2("missing").alias("d")).collect()[0]
    assert r["a"] == "1 234 567"
    assert r["b"] == f"{0.123456:.2%}"
    assert r["c"] == f"{0.123456 * 100:.2%}"           # no grouping in percents
    assert r["d"] == "nan%"


def test_write_report_overwrites_one_day(spark):
    out = tempfile.mkdtemp(prefix="tidemark-report-")
    t1 = {"t": spark.createDataFrame([(1,)], "x int")}
    report.write_report(t1, out, dt.date(2024, 1, 1))
    report.write_report(t1, out, dt.date(2024, 1, 2))
    report.write_report({"t": spark.createDataFrame([(5,), (6,)], "x int")}, out,
                        dt.date(2024, 1, 1))
    back = spark.read.parquet(os.path.join(out, "t"))
    got = sorted((str(r["as_of"]), r["x"]) for r in back.collect())
    assert got == [("2024-01-01", 5), ("2024-01-01", 6), ("2024-01-02", 1)]


def test_daily_report_tables_match_event_level_queries(spark):
    import __spark_entry__ as E
    from conftest import SF01
    from tidemark.operators import activity, audience
    feed, msg = E._events(spark, SF01)
    t = report.daily_report(feed, msg, E.AS_OF)
    assert t["dau"].collect() == activity.dau_by_source(feed, msg, E.AS_OF).collect()
    assert t["actions"].collect() == activity.actions_per_day(feed, msg, E.AS_OF).collect()
    assert t["new_users"].collect() == activity.new_users_by_source(feed).collect()
    assert t["audience"].collect() == audience.weekly_audience(feed, E.AS_OF).collect()


@pytest.fixture(scope="module")
def seg(spark):
    import __spark_entry__ as E
    from conftest import SF001
    return E._segments(spark, SF001)


def test_segments_cover_every_customer(seg):
    feats, s = seg
    assert s.count() == feats.count()
    assert s.select("custkey").distinct().count() == feats.count()
    assert {r["segment"] for r in s.collect()} <= set(range(4))


def test_segment_profile_shares(seg):
    feats, s = seg
    prof = segments.segment_profile(feats, s).collect()
    assert sum(r["share"] for r in prof) == pytest.approx(1.0)
    assert sum(r["customers"] for r in prof) == feats.count()


def test_daily_report_from_rollup_store_equals_events(spark):
    import __spark_entry__ as E
    from conftest import SF001
    feed, msg = E._events(spark, SF001)
    store = tempfile.mkdtemp(prefix="tidemark-store-")
    report.append_rollups(feed, msg, "2024-01-01", "2024-01-16", store)
    report.append_rollups(feed, msg, "2024-01-16", "2024-02-01", store)
    report.append_rollups(feed, msg, "2024-01-20", "2024-01-21", store)   # re-run one day
    r = report.read_rollups(spark, store)
    from_store = report.daily_report(feed, msg, E.AS_OF, **r)
    from_events = report.daily_report(feed, msg, E.AS_OF)
    for name in ("dau", "actions", "posts", "new_users", "audience", "retention", "message"):
        a = sorted(tuple(x) for x in from_store[name].collect())
        b = sorted(tuple(x) for x in from_events[name].collect())
        assert a == b, name


def test_command_line_daily_report(spark):
    import __spark_entry__ as E
    from conftest import SF001
    from tidemark.__main__ import main
    feed, msg = E._events(spark, SF001)
    base = tempfile.mkdtemp(prefix="tidemark-cli-")
    feed.write.parquet(os.path.join(base, "feed"))
    msg.write.parquet(os.path.join(base, "msgs"))
    args = ["--feed", os.path.join(base, "feed"), "--messages", os.path.join(base, "msgs")]
    assert main(["append-rollups", *args, "--start", "2024-01-01", "--end", "2024-02-01",
                 "--store", os.path.join(base, "store")]) == 0
    assert main(["daily-report", *args, "--as-of", "2024-01-31", "--out",
                 os.path.join(base, "out"), "--store", os.path.join(base, "store")]) == 0
    msg_out = spark.read.parquet(os.path.join(base, "out", "message")).collect()
    assert len(msg_out) == 1 and str(msg_out[0]["as_of"]) == "2024-01-31"
    dau = spark.read.parquet(os.path.join(base, "out", "dau")).drop("as_of")
    assert sorted(tuple(r) for r in dau.collect()) == sorted(
        tuple(r) for r in report.activity.dau_by_source(feed, msg, E.AS_OF).collect())


def test_backfill_writes_one_partition_per_day(spark):
    import __spark_entry__ as E
    from conftest import SF001
    feed, msg = E._events(spark, SF001)
    out = tempfile.mkdtemp(prefix="tidemark-backfill-")
    days = report.backfill(feed, msg, "2024-01-29", "2024-01-31", out)
    assert days == ["2024-01-29", "2024-01-30"]
    fm = spark.read.parquet(os.path.join(out, "feed_metrics")).collect()
    assert sorted(str(r["as_of"]) for r in fm) == days
    assert all(r["day"] == r["as_of"] - dt.timedelta(days=1) for r in fm)


def test_command_line_experiment_report(spark):
    import __spark_entry__ as E
    from conftest import SF001
    from tidemark.__main__ import main
    feed, _ = E._events(spark, SF001)
    base = tempfile.mkdtemp(prefix="tidemark-cli-exp-")
    feed.write.parquet(os.path.join(base, "feed"))
    assert main(["experiment-report", "--feed", os.path.join(base, "feed"), "--start",
                 "2024-01-02", "--end", "2024-01-08", "--replicates", "200",
                 "--out", os.path.join(base, "out")]) == 0
    out = spark.read.parquet(os.path.join(base, "out"))
    assert {r["method"] for r in out.collect()} >= {"ttest_ctr", "mannwhitney_ctr",
                                                    "poisson_bootstrap"}


@pytest.mark.parametrize("grain,step,year", [("day", "1 day", "364 days"),
                                             ("week", "7 days", "364 days"),
                                             ("month", "1 month", "12 months"),
                                             ("quarter", "3 months", "12 months"),
                                             ("year", "12 months", "12 months")])
def test_sales_trend_previous_periods_every_grain(spark, grain, step, year):
    from conftest import SF001
    from tidemark.sources import read_table
    orders = read_table(spark, SF001, "orders")
    got = {r["period"]: (r["revenue"], r["prev_revenue"], r["yoy_revenue"])
           for r in segments.sales_trend(orders, grain).collect()}
    orders.createOrReplaceTempView("o_trend")
    per = spark.sql(f"""SELECT CAST(date_trunc('{grain}', o_orderdate) AS DATE) AS p,
                               SUM(o_totalprice) AS r FROM o_trend GROUP BY 1""")
    per.createOrReplaceTempView("per_trend")
    want = spark.sql(f"""
        SELECT a.p, a.r, b.r AS pr, c.r AS yr FROM per_trend a
        LEFT JOIN per_trend b ON b.p = a.p - INTERVAL {step}
        LEFT JOIN per_trend c ON c.p = a.p - INTERVAL {year}""").collect()
    assert len(want) == len(got)
    for w in want:
        r, pr, yr = got[w["p"]]
        assert r == pytest.approx(w["r"])
        assert (pr is None and w["pr"] is None) or pr == pytest.approx(w["pr"])
        assert (yr is None and w["yr"] is None) or yr == pytest.approx(w["yr"])


def test_segments_choose_k_by_silhouette(seg):
    feats, _ = seg
    auto = segments.customer_segments(feats, k=None, k_range=range(2, 4))
    rows = auto.collect()
    assert len(rows) == feats.count()
    ks = {r["segment"] for r in rows}
    assert 2 <= len(ks) <= 3
    assert len({r["silhouette"] for r in rows}) == 1


def test_smoothed_value_ctr_reproduces_plain_ttest(spark):
    import __spark_entry__ as E
    from conftest import SF01
    from tidemark.plans.experiment_report import experiment_report
    feed, _ = E._events(spark, SF01)
    rep = {r["method"]: r for r in experiment_report(
        feed, E.EXP_START, E.EXP_END, b=50, smoothed_value="ctr").collect()}
    assert rep["ttest_smoothed_ctr"]["statistic"] == rep["ttest_ctr"]["statistic"]
    assert rep["ttest_smoothed_ctr"]["p_value"] == rep["ttest_ctr"]["p_value"]


def test_backfill_from_store_matches_events(spark):
    import __spark_entry__ as E
    from conftest import SF001
    feed, msg = E._events(spark, SF001)
    base = tempfile.mkdtemp(prefix="tidemark-bf-store-")
    store = os.path.join(base, "store")
    report.append_rollups(feed, msg, "2024-01-01", "2024-02-01", store)
    a, b = os.path.join(base, "a"), os.path.join(base, "b")
    report.backfill(feed, msg, "2024-01-30", "2024-02-01", a, store=store)
    report.backfill(feed, msg, "2024-01-30", "2024-02-01", b)
    def rows(path):
        # a table with no rows on any written day has no data files to read
        if not any(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs):
            return []
        return sorted(tuple(r) for r in spark.read.parquet(path).collect())

    for name in ("dau", "audience", "retention", "posts", "message", "new_users"):
        assert rows(os.path.join(a, name)) == rows(os.path.join(b, name)), name


def test_caption_stays_when_one_service_is_silent(make_feed, make_msgs):
    from tidemark.operators import activity
    from tidemark.plans.report import report_message
    feed = make_feed([(1, "2024-01-30 10:00:00", "view")])
    msgs = make_msgs([])
    rows = report_message(activity.feed_metrics(feed, "2024-01-31"), activity.msg_metrics(msgs, "2024-01-31")).collect()
    assert len(rows) == 1 and "Msgs sent: 0" in rows[0]["message"]


def test_rerun_without_rows_clears_the_day(spark, tmp_path):
    from tidemark.plans.report import write_report
    df = spark.createDataFrame([(1,)], "x int")
    for day in ("2024-01-01", "2024-01-02"):
        write_report({"t": df}, str(tmp_path), day)
    write_report({"t": df.limit(0)}, str(tmp_path), "2024-01-02")
    assert [str(r["as_of"]) for r in spark.read.parquet(f"{tmp_path}/t").collect()] == ["2024-01-01"]


def test_late_day_lowers_first_seen(spark, make_feed):
    from tidemark.operators.retention import first_seen_update
    seen = spark.sql("SELECT 1L AS user_id, DATE'2024-01-03' AS start_day")
    feed = make_feed([(1, "2024-01-01 09:00:00", "view"), (2, "2024-01-01 09:00:00", "view")])
    got = {r["user_id"]: str(r["start_day"]) for r in first_seen_update(seen, feed, "2024-01-01").collect()}
    assert got == {1: "2024-01-01", 2: "2024-01-01"}
