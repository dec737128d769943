"""Offset tables: changelog checkpoints, source positions, lag.

OFFSETS = (app, task, store, topic, partition, offset): one row per store
changelog partition. These tables have one row per topic partition and
store - metadata, bounded by the partition count, never by the data - so
joins between them broadcast freely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


def task_id(partition_col: str = "partition", subtopology: int = 0):
    """Task name of a partition: ``<subtopology>_<partition>``."""
    return F.concat(F.lit(f"{subtopology}_"), F.col(partition_col).cast("string"))


def offsets_checkpoint(changelog: DataFrame) -> DataFrame:
    """Latest changelog offset per (topic partition, store): the content of
    a checkpoint taken now. A partial aggregate: a few rows per task."""
    return (changelog.groupBy("topic", "partition", "store")
                     .agg(F.max("offset").alias("offset")))


def source_positions(records: DataFrame) -> DataFrame:
    """Per source partition, the position the state includes (last offset
    consumed) and how many records that covers."""
    return (records.groupBy("topic", "partition")
                   .agg(F.max("offset").alias("position"), F.count(F.lit(1)).alias("records")))


def lag_report(end: DataFrame, current: DataFrame, *,
               acceptable_lag: int = C.ACCEPTABLE_RECOVERY_LAG) -> DataFrame:
    """Per store partition: end offset minus the offset the local state has
    reached (0 if none), and whether that is within the acceptable lag.

    ``current`` holds the last applied offset; the next one to read is
    ``offset + 1``.
    """
    cur = current.select("app", "task", "store", "topic", "partition",
                         (F.col("offset") + 1).alias("current_offset"))
    out = end.join(cur, ["app", "task", "store", "topic", "partition"], "left")
    lag = F.col("end_offset") - F.coalesce(F.col("current_offset"), F.lit(0))
    return out.select("app", "task", "store", "topic", "partition", "end_offset",
                      F.coalesce(F.col("current_offset"), F.lit(0)).alias("current_offset"),
                      lag.alias("lag"), (lag <= F.lit(acceptable_lag)).alias("caught_up"))
