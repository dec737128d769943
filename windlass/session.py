"""Session helpers.

Everything in the library takes a ``SparkSession`` from the caller. These
helpers only build one for tests / the bench, and find the shared folder the
cluster names in ``spark.checkpoint.dir`` (snapshots and lineage cuts go there,
never to a machine-local temporary folder).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a 1000-executor deployment would also want; local runs override
# only the shuffle width.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Snapshot versions are written into their own partition directories;
    # dynamic overwrite makes a re-run of a version idempotent.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Structured Streaming state: RocksDB with changelog checkpointing, the
    # Spark counterpart of a segmented RocksDB store with a changelog topic.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "windlass", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set one only where it is unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared filesystem (HDFS,
    object store): without it this raises, as executors could not see a folder
    of the driver's machine. Only a ``local`` master (tests, a laptop) gets a
    fresh local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="windlass-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder (its URI kept whole)."""
    return os.path.join(ensure_checkpoint_dir(spark), "windlass", *parts, uuid.uuid4().hex)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
