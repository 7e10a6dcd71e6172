"""Empty and degenerate inputs give NULLs or empty results, never errors."""

from tidemark.operators import experiment, stats
from tidemark.operators.ranks import exact_quantiles


def _users(spark, rows):
    return spark.createDataFrame(
        rows, "exp_group int, user_id long, likes long, views long, ctr double")


def test_one_arm_empty(spark):
    users = _users(spark, [(1, 1, 1, 2, 0.5), (1, 2, 0, 1, 0.0)])
    w = stats.welch_ttest(users, "exp_group", "ctr", 2, 1).collect()[0]
    assert w["n1"] == 0 and w["t"] is None and w["p_value"] is None
    m = stats.mann_whitney(users, "exp_group", "ctr", 2, 1).collect()[0]
    assert m["p_value"] is None
    b = stats.poisson_bootstrap(users, 10).collect()
    assert len(b) == 10 and all(r["ctr2"] is None for r in b)


def test_all_null_values(spark):
    users = _users(spark, [(1, 1, 0, 0, None), (2, 2, 3, 0, None)])
    s = {r["exp_group"]: r for r in experiment.arm_summary(users).collect()}
    assert s[1]["median"] is None and s[1]["n_null"] == 1
    assert [r["q"] for r in exact_quantiles(users, [], "ctr", {"q": 0.5}).collect()] == [None]
    bk = experiment.bucket_ctr(users, 5).collect()
    assert all(r["bucket_ctr"] is None and r["ctr9"] is None for r in bk)


def test_single_value_and_empty_histogram(spark):
    one = _users(spark, [(1, 1, 1, 2, 0.5), (1, 2, 1, 2, 0.5)])
    h = stats.histogram(one, "ctr", bins="auto").collect()
    assert len(h) == 1 and h[0]["n"] == 2 and h[0]["bin_lo"] < 0.5 < h[0]["bin_hi"]
    none = _users(spark, [(1, 1, 0, 0, None)])
    e = stats.histogram(none, "ctr", bins=3).collect()
    assert [r["n"] for r in e] == [0, 0, 0]


def test_nan_values(spark):
    df = spark.createDataFrame([(1, float(x)) for x in range(1, 10)] + [(1, float("nan"))]
                               + [(2, float(x)) for x in (2, 4, 6, 8)], "g int, v double")
    # NaN sorts last (Spark's order): the median of 1..9 and NaN is 5.5
    med = {r["g"]: r["m"] for r in exact_quantiles(df, ["g"], "v", {"m": 0.5}, bins=3).collect()}
    assert med == {1: 5.5, 2: 5.0}
    assert stats.mwu_stats(df, "g", "v", 1, 2, bins=3).collect()[0]["u1"] == 22.0
    # histograms leave NaN out
    h = stats.histogram(df, "v", bins=4).collect()
    assert sum(r["n"] for r in h) == 13 and h[-1]["bin_hi"] == 9.0
