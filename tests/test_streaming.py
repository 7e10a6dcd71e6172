"""The streaming refresh equals the batch metrics and replays idempotently."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators.activity import feed_metrics_range
from tidemark.sources import load_event_tables
from tidemark.streaming.daily import start_feed_metrics_stream


def test_stream_refresh_matches_batch(spark):
    feed, _ = load_event_tables(spark, SF001)
    base = tempfile.mkdtemp(prefix="tidemark-stream-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    early = feed.where(F.col("time") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    late = feed.where(F.col("time") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    early.coalesce(1).write.parquet(os.path.join(src, "part1"))
    q = start_feed_metrics_stream(spark, src + "/*", sink, ckpt)
    q.awaitTermination()
    late.coalesce(1).write.parquet(os.path.join(src, "part2"))
    q = start_feed_metrics_stream(spark, src + "/*", sink, ckpt)
    q.awaitTermination()
    got = spark.read.parquet(sink).select("day", "dau", "views", "likes", "ctr")
    want = feed_metrics_range(feed, "2024-01-01", "2024-02-01")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_stream_one_file_per_batch(spark):
    feed, _ = load_event_tables(spark, SF001)
    base = tempfile.mkdtemp(prefix="tidemark-stream-mf-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    # three files whose days overlap, read one per micro-batch
    feed.repartition(3, "user_id").write.parquet(os.path.join(src, "all"))
    q = start_feed_metrics_stream(spark, src + "/*", sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(sink).select("day", "dau", "views", "likes", "ctr")
    want = feed_metrics_range(feed, "2024-01-01", "2024-02-01")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
