import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[*]", app="tidemark-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def feed_schema():
    from tidemark.sources import FEED_SCHEMA
    return FEED_SCHEMA


def ts(text):
    import datetime as dt
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def make_feed(spark, feed_schema):
    """Feed rows from tuples (user_id, time, action[, source[, exp_group[, post_id]]])."""
    def build(rows):
        full = []
        for r in rows:
            user, t, action = r[0], ts(r[1]), r[2]
            source = r[3] if len(r) > 3 else "organic"
            group = r[4] if len(r) > 4 else 1
            post = r[5] if len(r) > 5 else 1
            full.append((user, t, action, post, source, group))
        return spark.createDataFrame(full, feed_schema)
    return build


@pytest.fixture
def make_msgs(spark):
    from tidemark.sources import MESSAGE_SCHEMA

    def build(rows):
        return spark.createDataFrame([(u, ts(t), r) for u, t, r in rows], MESSAGE_SCHEMA)
    return build
