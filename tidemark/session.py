"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster (hundreds of TB of events). Shuffle partitions
# start high and AQE coalesces them to ~256 MB each, so the same jobs fit
# small and large days; skewed join partitions are split at runtime; scans
# read 256 MB splits; runtime bloom filters prune the large side of joins
# (e.g. line items of orders outside the date range).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_cluster_conf(spark: SparkSession, overwrite: bool = False) -> None:
    """Set ``CLUSTER_CONF`` on a running session, keeping values the
    deployment already chose unless ``overwrite``."""
    for k, v in CLUSTER_CONF.items():
        try:
            if overwrite or spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static confs cannot change at runtime
            pass


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session tuned for these jobs; on a cluster pass ``master=None``.

    AQE stays on so shuffle partition counts coalesce to the data actually
    produced and skewed join partitions are split at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    confs = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # reliable checkpoints of released frames are removed from the shared folder
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for k, v in confs.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def default_parallelism(spark: SparkSession) -> int:
    """Cores available to the session (a fixed guess where the context is
    not reachable, as in Spark Connect)."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.default.parallelism", "200") or 200)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context). Only a local-mode session without one gets a private folder,
    which is the test and laptop case; a cluster session never does.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns checkpointing
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if sc.master.startswith("local"):
        local = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(local)
        return local
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage for frames read many times.

    Uses a reliable checkpoint into the shared checkpoint folder so a lost
    executor does not force the upstream scan again. Without a shared folder
    (cluster with no ``spark.checkpoint.dir``) the frame is persisted to
    memory and disk instead; lineage then stays and lost blocks are recomputed.
    """
    spark = df.sparkSession
    if checkpoint_dir(spark):
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after checking its size.

    The frame is materialized (so the check does not compute it twice) and
    counted; under ``max_rows`` it gets a broadcast hint, otherwise it is
    returned as is and the join shuffles both sides (AQE may still pick a
    broadcast from measured sizes).
    """
    from pyspark.sql import functions as F

    small = materialize(df)
    return F.broadcast(small) if small.count() <= max_rows else small


def reuse(df: DataFrame) -> DataFrame:
    """Keep a small derived frame that several outputs read (lazy: it is
    computed by the first action and read back by the next ones; lost blocks
    are recomputed from lineage)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
