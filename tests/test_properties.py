"""Property tests: distributed ranks and quantiles against numpy on random data."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import stats
from tidemark.operators.ranks import exact_quantiles

values = st.lists(st.integers(min_value=0, max_value=12), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=values, b=values, bins=st.integers(min_value=1, max_value=9))
def test_mwu_u_matches_pairs(spark, a, b, bins):
    rows = [(1, x / 4.0) for x in a] + [(2, x / 4.0) for x in b]
    df = spark.createDataFrame(rows, "g int, v double")
    r = stats.mwu_stats(df, "g", "v", 1, 2, bins=bins).collect()[0]
    xa, xb = np.array(a)[:, None], np.array(b)[None, :]
    u = float((xa > xb).sum() + 0.5 * (xa == xb).sum())
    assert r["u1"] == u and r["u1"] + r["u2"] == len(a) * len(b)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=st.lists(st.floats(min_value=-50, max_value=50, allow_nan=False), min_size=1,
                   max_size=80),
       q=st.floats(min_value=0.0, max_value=1.0), bins=st.integers(min_value=1, max_value=9))
def test_quantiles_match_numpy(spark, xs, q, bins):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    r = exact_quantiles(df, [], "v", {"lin": q}, "linear", bins=bins).collect()[0]
    assert np.isclose(r["lin"], np.percentile(xs, q * 100), rtol=1e-9, atol=1e-9)
    e = exact_quantiles(df, [], "v", {"el": q}, "element", bins=bins).collect()[0]
    s = sorted(xs)
    assert e["el"] == s[min(int(np.floor(q * len(s))), len(s) - 1)]
    # and through a grouped call, group by group
    g = spark.createDataFrame([(i % 2, x) for i, x in enumerate(xs)], "k int, v double")
    for row in exact_quantiles(g, ["k"], "v", {"lin": q}, "linear", bins=bins).collect():
        part = [x for i, x in enumerate(xs) if i % 2 == row["k"]]
        assert np.isclose(row["lin"], np.percentile(part, q * 100), rtol=1e-9, atol=1e-9)
