"""Snapshots of a running Structured Streaming aggregation (foreachBatch).

In update mode a micro-batch carries exactly the windows it changed, with
their new absolute values: that is the store's changelog for the batch.
The sink writes it to ``changelog/batch_id=<id>`` (overwrite: a replayed
batch rewrites the same directory), and every ``every_n`` batches folds
"latest version + changelog after it" into a new version named by the
batch id (``restore_with_tail``), optionally dropping windows past
retention. Each batch costs its own size, never the size of the state. A version
costs the segments that its changelog touches: those are read, folded and written,
the others are taken over by reference (``SnapshotStore.publish_changes``).

Windows are assigned to ``partitions`` snapshot tasks by key hash, the same
way the state store spreads them over shuffle partitions. Any value columns go
along. If the stream carries source addresses (see ``windowed_stream``), a
version also records how far into the source it reaches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import MICROS, epoch_micros, instant_to_ntz, micros_to_ntz, segment_id
from ..operators.restore import restore_with_tail
from ..sources.snapshots import SnapshotStore
from .batches import last_batch, read_batches, write_batch

KEYS = ["topic", "partition", "key", "window_start", "window_end"]
SOURCE = ["source_topic", "source_partition", "source_offset"]


def key_partition(key: str, partitions: int):
    return F.pmod(F.hash(F.col(key)), F.lit(partitions)).cast("int")


@dataclass
class SnapshotSink:
    spark: SparkSession
    path: str
    store: SnapshotStore
    every_n: int = C.DEFAULT_SNAPSHOT_FREQUENCY
    partitions: int = C.FIXTURE_PARTITIONS
    retention_seconds: int | None = None

    @property
    def changelog_path(self) -> str:
        return f"{self.path}/changelog"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        values = [c for c in batch.columns if c not in KEYS]
        ntz = [instant_to_ntz(c).alias(c) if t == "timestamp" else F.col(c) for c, t in batch.dtypes if c in values]
        rows = batch.select(F.lit(self.store.changelog_topic).alias("topic"),
                            key_partition("key", self.partitions).alias("partition"), "key",
                            instant_to_ntz("window_start").alias("window_start"),
                            instant_to_ntz("window_end").alias("window_end"), *ntz,
                            F.lit(batch_id).cast("bigint").alias("offset"))
        write_batch(rows, self.changelog_path, batch_id)
        if self.every_n and batch_id % self.every_n == 0:
            self.snapshot(batch_id)

    def changelog(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """Changelog batches in (after, upto]: only those directories are listed, so a
        compaction costs the new batches, not the history."""
        upto = last_batch(self.spark, self.changelog_path) if upto is None else upto
        return read_batches(self.spark, self.changelog_path, after, upto)

    def _base(self, upto: int) -> tuple[DataFrame, int | None, int]:
        """Pointers of the last version at or before ``upto``, the batch after which its
        changelog begins (None while a task has no version yet) and the tasks that have one."""
        pointer = self.store.at(upto)
        low = pointer.agg(F.min("version"), F.count(F.lit(1))).first()
        return pointer, int(low[0]) if low[1] == self.partitions else None, int(low[1])

    def _floor(self, newest):
        """Windows that start at or before this (micros) are past retention."""
        return epoch_micros(F.lit(newest).cast("timestamp_ntz")) - F.lit(self.retention_seconds * MICROS)

    def state(self, upto: int | None = None) -> DataFrame:
        """Latest version (at or before ``upto``) + changelog after it."""
        upto = last_batch(self.spark, self.changelog_path) if upto is None else upto
        pointer, after, tasks = self._base(upto)
        snap, positions = self.store.open(pointer)
        # a task without a version yet needs the whole changelog
        changelog = self.changelog(-1 if after is None else after, upto).drop("batch_id")
        if not tasks:
            snap = changelog.drop("offset").limit(0)
        st = restore_with_tail(snap, positions, changelog)
        if self.retention_seconds is not None and "value_ts" in st.columns:
            # stream time is the newest record of snapshot and tail (one scalar)
            newest = st.agg(F.max("value_ts")).first()[0]
            if newest is not None:
                st = st.where(epoch_micros("window_start") > self._floor(newest))
        return st

    def sources(self, upto: int) -> DataFrame | None:
        """Per source partition the last offset that updates up to a batch include."""
        if not set(SOURCE) <= set(self.changelog(upto - 1, upto).columns):  # the last batch tells
            return None
        pointer = self.store.at(upto)
        low = pointer.agg(F.min("version")).first()[0]
        after = -1 if low is None else int(low)
        new = (self.changelog(after, upto).groupBy(F.col("source_topic").alias("topic"),
                                                   F.col("source_partition").alias("partition"))
               .agg(F.max("source_offset").alias("position")))
        return (new.unionByName(self.store.sources(pointer).drop("stream_time")).groupBy("topic", "partition")
                .agg(F.max("position").alias("position")))

    def snapshot(self, batch_id: int) -> DataFrame:
        """Fold everything up to ``batch_id`` into version ``batch_id``."""
        positions = self.spark.range(self.partitions).select(
            F.lit(self.store.changelog_topic).alias("topic"), F.col("id").cast("int").alias("partition"),
            F.lit(batch_id).cast("bigint").alias("version"))
        pointer, after, _ = self._base(batch_id - 1)
        if after is None:
            return self.store.publish(self.state(upto=batch_id), positions, self.sources(batch_id))
        tail = self.changelog(after, batch_id).drop("batch_id")
        cut = segment_id("window_start", self.store.segment_seconds)
        touched = tail.select("topic", "partition", cut.alias("segment_id")).distinct()
        newest = None
        if self.retention_seconds is not None and "value_ts" in tail.columns:
            newest = self._newest(pointer, tail)
        least = None
        if newest is not None:
            # the segment that retention cuts through is written again without what is past it
            edge = segment_id(micros_to_ntz(self._floor(newest)), self.store.segment_seconds)
            least = int(self.spark.range(1).select(edge).first()[0])
            touched = touched.where(F.col("segment_id") > least).unionByName(
                positions.select("topic", "partition", F.lit(least).cast("bigint").alias("segment_id")))
        snap, held = self.store.open(pointer, segments=touched)
        if not set(tail.columns) - {"offset"} <= set(snap.columns):  # no version holds a touched segment
            snap = tail.drop("offset").limit(0)
        tail = tail.withColumn("__segment", cut)
        if least is not None:
            tail = tail.where(F.col("__segment") >= least)
        rows = restore_with_tail(snap, held, tail.drop("__segment"))
        if newest is not None:
            rows = rows.where(epoch_micros("window_start") > self._floor(newest))
        floor = None if least is None else positions.select("topic", "partition", F.lit(least).cast("bigint").alias("least_segment"))
        return self.store.publish_changes(rows, touched, positions, pointer, self.sources(batch_id), least=floor)

    def _newest(self, pointer: DataFrame, tail: DataFrame):
        """The newest record time of version and tail: of the version, its last segments hold it,
        as a record lies in the window it counts in."""
        parts = self.store.segments(pointer)
        last = parts.groupBy("topic", "partition").agg(F.max("segment_id").alias("segment_id"))
        snap, _ = self.store.open(pointer, segments=last)
        times = [d.agg(F.max("value_ts")).first()[0] for d in (snap, tail) if "value_ts" in d.columns]
        return max((t for t in times if t is not None), default=None)
