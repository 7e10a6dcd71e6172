"""Session helpers: checkpoint folder, size-checked broadcast."""

from tidemark.session import broadcast_if_small, checkpoint_dir, default_parallelism


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_dir_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert default_parallelism(spark) >= 1


def test_broadcast_only_under_the_limit(spark):
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hinted = big.join(broadcast_if_small(small, max_rows=100), "k")
        plain = big.join(broadcast_if_small(small, max_rows=5), "k")
        assert "BroadcastHashJoin" in _plan(hinted)
        assert "BroadcastHashJoin" not in _plan(plain)
        assert hinted.count() == plain.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
