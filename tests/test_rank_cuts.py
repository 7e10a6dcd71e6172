"""Bins cut again where they hold too many values: same prefix counts as plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranks


def _brute(rows):
    out = {}
    for k, v, c in rows:
        out[k, v] = sum(c2 for k2, v2, c2 in rows if k2 == k and v2 < v)
    return out


@pytest.mark.parametrize("rows_per_bin", [1, 7, 1000])
@pytest.mark.parametrize("bins", [1, 4])
def test_prefix_counts_on_both_sides_of_the_limit(spark, rows_per_bin, bins):
    rng = random.Random(rows_per_bin * 10 + bins)
    rows = [(k, v, rng.randrange(1, 5)) for k, n in (("a", 300), ("b", 20), ("c", 1))
            for v in rng.sample(range(400), n)]
    d = spark.createDataFrame([(k, v / 7, c) for k, v, c in rows], "k string, v double, c long")
    got = {(r["k"], round(r["v"] * 7)): r["c_below"] for r in
           ranks.value_prefix(d, ["k"], "v", ["c"], bins=bins, rows_per_bin=rows_per_bin).collect()}
    assert got == _brute(rows)


def test_groups_shrink_below_the_limit_beside_a_value_of_many_keys(spark):
    # one value in 2,000 keys, and one key with 600 values around it
    rows = [(f"k{i}", 0.5) for i in range(2000)] + [("hot", i / 1000) for i in range(600)]
    binned = (spark.createDataFrame(rows, "k string, _v double")
              .withColumn("_bin", F.lit(0).cast("bigint")))
    out = ranks._cut_overfull(binned, ["k"], 3)
    assert out.groupBy("k", "_bin").count().agg(F.max("count")).first()[0] <= 3
    hot = [r["_bin"] for r in out.where("k = 'hot'").orderBy("_v").collect()]
    assert len(hot) == 600 and hot == sorted(hot)


def test_quantiles_over_cut_bins(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(ranks, "ROWS_PER_BIN", 5)
    xs = np.random.default_rng(1).normal(size=3000)
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = ranks.exact_quantiles(df, [], "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}, bins=16).first()
    assert [got["q1"], got["m"], got["q9"]] == pytest.approx(list(np.quantile(xs, [0.25, 0.5, 0.9])))


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_one_compressed_frame_gives_moments_and_quantiles(spark, monkeypatch, broadcast_rows):
    """Both ways to broadcast the prefixes; a group of one value, one of nulls only, means far apart."""
    import numpy as np
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", broadcast_rows)
    rng = np.random.default_rng(7)
    values = {"near": rng.integers(0, 9, 500) / 8, "far": 1e9 + rng.integers(0, 4, 300), "one": np.array([2.5])}
    rows = [(g, float(x)) for g, xs in values.items() for x in xs] + [("near", None), ("none", None)]
    d = ranks.compress(spark.createDataFrame(rows, "g string, v double"), ["g"], "v")
    assert d.where("g = 'near'").count() == 10 and d.where("v is null").agg(F.sum("_c")).first()[0] == 2
    got = {r["g"]: r for r in
           ranks.compressed_quantiles(d, ["g"], "v", {"m": 0.5}, bins=4, moments=True).collect()}
    assert set(got) == set(values)
    for g, xs in values.items():
        assert got[g]["m"] == pytest.approx(np.median(xs)) and got[g]["mean"] == pytest.approx(xs.mean())
        assert got[g]["stddev"] == (None if len(xs) == 1 else pytest.approx(xs.std(ddof=1), rel=1e-6))
