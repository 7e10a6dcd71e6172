"""Adapter from the generic ``events`` test table to the two event tables.

The test tables carry no feed data, so the feed and messenger event tables are
derived from ``events`` by fixed rules. The rules only give the right shape
and types; likes are independent of views, so test CTRs can exceed 1.

Fixed values of the mapping:
    feed rows:      event_type in ('view', 'click'); click -> 'like', view -> 'view'
    post_id:        props key "k"
    source:         'ads' when user_id % 3 = 0, else 'organic'
    exp_group:      user_id % 4
    message rows:   event_type in ('signup', 'purchase')
    receiver_id:    props key "k"
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

FEED_EVENT_TYPES = ("view", "click")
MESSAGE_EVENT_TYPES = ("signup", "purchase")


def feed_from_events(events: DataFrame) -> DataFrame:
    """``feed_actions`` columns from ``events``; all expressions stay JVM-side."""
    return (events
            .where(F.col("event_type").isin(*FEED_EVENT_TYPES))
            .select(
                F.col("user_id"),
                F.col("ts").alias("time"),
                F.when(F.col("event_type") == "click", F.lit("like"))
                 .otherwise(F.lit("view")).alias("action"),
                F.get_json_object("props", "$.k").cast("bigint").alias("post_id"),
                F.when(F.col("user_id") % 3 == 0, F.lit("ads"))
                 .otherwise(F.lit("organic")).alias("source"),
                (F.col("user_id") % 4).cast("int").alias("exp_group"),
            ))


def messages_from_events(events: DataFrame) -> DataFrame:
    """``message_actions`` columns from ``events``."""
    return (events
            .where(F.col("event_type").isin(*MESSAGE_EVENT_TYPES))
            .select(
                F.col("user_id"),
                F.col("ts").alias("time"),
                F.get_json_object("props", "$.k").cast("bigint").alias("receiver_id"),
            ))


def load_event_tables(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(feed_actions, message_actions) over ``<base>/events.parquet``."""
    events = read_table(spark, base, "events")
    return feed_from_events(events), messages_from_events(events)
