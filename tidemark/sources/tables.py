"""Declared schemas and readers for the event tables.

``feed_actions`` holds one row per user action on a post, ``message_actions``
one row per sent message. Both are read with a fixed schema (no inference) and
only the columns an operator selects reach the scan: Catalyst prunes the rest
and pushes the time-range filters into Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("time", T.TimestampNTZType(), False),
    T.StructField("action", T.StringType(), False),      # 'view' or 'like'
    T.StructField("post_id", T.LongType(), True),
    T.StructField("source", T.StringType(), True),       # traffic source
    T.StructField("exp_group", T.IntegerType(), True),   # experiment arm
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("time", T.TimestampNTZType(), False),
    T.StructField("receiver_id", T.LongType(), True),
])


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table under ``base`` (``<base>/<name>.parquet``)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_feed_actions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``feed_actions`` stored as files (Parquet by default), schema declared."""
    return spark.read.format(fmt).schema(FEED_SCHEMA).load(path)


def read_message_actions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(MESSAGE_SCHEMA).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str,
              lower_bound, upper_bound, num_partitions: int,
              properties: dict | None = None) -> DataFrame:
    """A table in a live SQL database, read in ``num_partitions`` parallel ranges.

    ``partition_column`` should be numeric or a timestamp (for event tables
    ``time``); each task then reads one slice, so the read scales with the
    executors instead of funnelling through one connection.
    """
    reader = (spark.read.format("jdbc")
              .option("url", url)
              .option("dbtable", table)
              .option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound))
              .option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions))
              .option("fetchsize", "10000"))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
