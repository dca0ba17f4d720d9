"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins and partition counts
# from runtime sizes, splits skewed shuffle partitions, and the runtime bloom
# filter prunes the big side of a selective join before it is shuffled.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # merge streaming session windows map-side before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.ui.explainMode": "formatted",
    # delete checkpoint files (the batch job's shared pre-aggregates) once
    # their data is no longer referenced, so periodic refreshes do not pile
    # them up in the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Keyed streaming state that outgrows the executor heap (dedup keys within
# the watermark, many open sessions) belongs in RocksDB; for small state the
# default provider starts faster.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "salestide",
                  shuffle_partitions: int | None = None, large_state: bool = False,
                  **conf) -> SparkSession:
    """A session with ``DEFAULTS``; ``master`` only for local runs (a
    cluster's submit sets it).  ``shuffle_partitions`` should be about total
    input bytes / 128 MB at scale (AQE coalesces the small ones);
    ``large_state`` moves streaming state to RocksDB."""
    b = SparkSession.builder.appName(app)
    if large_state:
        conf = {**LARGE_STATE, **conf}
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when a ``local[...]`` session names none (a test) is a fresh local
    folder created and registered with ``setCheckpointDir``; on a cluster the
    setting must point at shared storage: without it this raises.  (Under
    Spark Connect there is no SparkContext: the setting alone is used.)
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = current
    if not root:
        if sc is None or not sc.master.startswith("local"):
            # executors on other machines would each write to their own disk
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="salestide-ckpt-")
    if sc is not None and current is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    base = checkpoint_root(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "salestide", f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library wrote, on whatever file system it is;
    whether there was one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
