"""Exact zero-grace windowing in a stream: foreachBatch with a carried
per-partition stream time, a per-batch delta log and periodic snapshots.

Per micro-batch ``id`` (all work runs as Spark jobs on the batch):

1. carry = stream time and source position per topic partition after the
   previous batch, read from ``carry/`` (one row per partition);
2. stream time of each record = max(carry, running max of ts in the batch
   by offset) - the block-parallel scan, so a batch's partition is split;
3. records with ``window_end + grace > stream_time`` are kept and summed
   per (topic, partition, key, window) into ``deltas/batch_id=<id>``;
4. the new carry is written to ``carry/batch_id=<id>``.

With ``emit_updates`` the batch's per-record updates are written first, to
``updates/batch_id=<id>``: for every record kept, the new value of its window -
the running sum of the batch's records (the same block-parallel scan) on top of
what the window held before. They are the store's changelog, which
``restore_with_tail`` replays, and the deltas are then read from them.

With ``emit_updates`` or ``emit_final`` the sink also keeps ``open/batch_id=<id>``,
the windows that records can still change: those that end after their own
partition's stream time, so a few per key, however long the query runs. With
``emit_final`` a window that has ended goes to ``final/batch_id=<id>`` instead
("emit on window close"), by the time of its partition, not by Spark's global
watermark. As no record is kept for a window that has ended, each is emitted once.

All writes overwrite their batch directory, so a batch replayed after a
failure (same id, same input) rewrites the same files: exactly once. The
carry is looked up by batch id, never "the latest", so a replay sees the
carry its first run saw; only batch 0 may start without one. Each
partition's records must arrive in offset order across batches (true for a
topic; the file fixture keeps it).

State = sum of all deltas per window; every ``every_n`` batches the sink folds
the deltas since the last version into a new snapshot version (named by the
batch id), which also records stream time and position per source partition.
A sink with ``resume`` set starts from such a version of another query: its
state, stream times and positions take the place of empty ones, and records up
to the positions are skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import MICROS, epoch_micros, instant_to_ntz, micros_to_ntz, segment_id
from ..operators import scan
from ..operators.windows import _keyed
from ..sources.snapshots import SnapshotStore
from .batches import last_batch, read_batches, write_batch

CARRY = "topic string, partition int, carry timestamp_ntz, position bigint"
CARRY_SCHEMA = CARRY + ", batch_id bigint"
DELTA_SCHEMA = ("topic string, partition int, key string, window_start timestamp_ntz, window_end timestamp_ntz, "
                "agg bigint, n bigint, batch_id bigint")
STATE_SCHEMA = ("topic string, partition int, key string, window_start timestamp_ntz, window_end timestamp_ntz, "
                "agg bigint, n bigint")
UPDATE_SCHEMA = ("topic string, partition int, offset bigint, ts timestamp_ntz, key string, window_start timestamp_ntz, "
                 "window_end timestamp_ntz, value bigint, agg bigint, n bigint, batch_id bigint")
WINDOW = ["topic", "partition", "key", "window_start", "window_end"]
WHERE = ["topic", "partition"]


@dataclass
class StrictWindowSink:
    spark: SparkSession
    path: str
    size_seconds: int = C.STORE_WINDOW_SECONDS
    grace_seconds: int = C.STORE_GRACE_SECONDS
    every_n: int = C.DEFAULT_SNAPSHOT_FREQUENCY
    store: SnapshotStore | None = None
    resume: SnapshotStore | None = None
    emit_updates: bool = False
    emit_final: bool = False
    retention_seconds: int | None = None  # windows past it leave the state and the versions

    @property
    def carry_path(self) -> str:
        return f"{self.path}/carry"

    @property
    def delta_path(self) -> str:
        return f"{self.path}/deltas"

    @property
    def update_path(self) -> str:
        return f"{self.path}/updates"

    @property
    def open_path(self) -> str:
        return f"{self.path}/open"

    @property
    def final_path(self) -> str:
        return f"{self.path}/final"

    def _ended(self):
        """Whether a window takes no more records at its partition's time ``carry``."""
        return (epoch_micros("window_end") + F.lit(self.grace_seconds * MICROS)) <= epoch_micros("carry")

    def open_after(self, batch_id: int) -> DataFrame:
        """Windows that a batch left open, from its own directory."""
        if batch_id >= 0:
            return read_batches(self.spark, self.open_path, batch_id - 1, batch_id, STATE_SCHEMA + ", batch_id bigint").drop("batch_id")
        if self.resume is None:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        held = self.resume.read().select(*WINDOW, "agg", "n").join(self.carry_after(-1), WHERE, "left")
        return held.where(F.col("carry").isNull() | ~self._ended()).select(*WINDOW, "agg", "n")

    def carry_after(self, batch_id: int) -> DataFrame:
        """Stream time and position per topic partition as a batch left them: its own
        directory only, so the cost does not grow with the batches run."""
        if batch_id < 0:
            if self.resume is None:
                return self.spark.createDataFrame([], CARRY)
            return self.resume.sources().select(*WHERE, F.col("stream_time").alias("carry"), "position")
        return read_batches(self.spark, self.carry_path, batch_id - 1, batch_id, CARRY_SCHEMA).drop("batch_id")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if dict(batch.dtypes)["ts"] == "timestamp":
            batch = batch.withColumn("ts", instant_to_ntz("ts"))
        batch = _keyed(batch)
        carry = self.carry_after(batch_id - 1)
        if self.resume is not None:
            batch = batch.join(carry.select(*WHERE, "position"), WHERE, "left").where(
                F.col("position").isNull() | (F.col("offset") > F.col("position"))).drop("position")
        timed = scan.running(batch, WHERE, "offset", [("__run", "max", F.col("ts"))])
        timed = (timed.join(carry, WHERE, "left")
                 .withColumn("stream_time", F.greatest("carry", "__run")))
        w = F.window("ts", f"{self.size_seconds} seconds")
        kept = (timed.withColumn("__w", w)
                .where((epoch_micros("__w.end") + F.lit(self.grace_seconds * MICROS))
                       > epoch_micros("stream_time"))
                .select(*WHERE, "offset", "ts", "key", F.col("__w.start").alias("window_start"),
                        F.col("__w.end").alias("window_end"), "value"))
        if self.emit_updates:
            kept = self._write_updates(kept, batch_id)
        deltas = kept.groupBy(*WINDOW).agg(F.sum("value").cast("bigint").alias("agg"), F.count(F.lit(1)).alias("n"))
        write_batch(deltas, self.delta_path, batch_id)
        seen = batch.groupBy(*WHERE).agg(F.max("ts").alias("__t"), F.max("offset").alias("__o"))
        after = carry.join(seen, WHERE, "full_outer").select(
            *WHERE, F.greatest("carry", "__t").alias("carry"), F.greatest("position", "__o").alias("position"))
        write_batch(after, self.carry_path, batch_id)
        if self.emit_updates or self.emit_final:
            self._close_windows(batch_id)
        if self.store is not None and self.every_n and batch_id % self.every_n == 0:
            self.snapshot(batch_id)

    def _write_updates(self, kept: DataFrame, batch_id: int) -> DataFrame:
        """The value of its window after each record kept, written and read back."""
        run = scan.running(kept, WINDOW, "offset", [("__agg", "sum", F.col("value")), ("__n", "count", F.lit(1))])
        held = self.open_after(batch_id - 1).withColumnsRenamed({"agg": "__held", "n": "__held_n"})
        zero = F.lit(0).cast("bigint")
        updates = run.join(held, WINDOW, "left").select(
            *WHERE, "offset", "ts", "key", "window_start", "window_end", F.col("value").cast("bigint").alias("value"),
            (F.coalesce("__held", zero) + F.col("__agg")).cast("bigint").alias("agg"),
            (F.coalesce("__held_n", zero) + F.col("__n")).cast("bigint").alias("n"))
        write_batch(updates, self.update_path, batch_id)
        return read_batches(self.spark, self.update_path, batch_id - 1, batch_id, UPDATE_SCHEMA)

    def _close_windows(self, batch_id: int) -> None:
        """Add the batch's deltas to the open windows and part those that have ended."""
        deltas = read_batches(self.spark, self.delta_path, batch_id - 1, batch_id, DELTA_SCHEMA).select(*WINDOW, "agg", "n")
        held = self._summed([self.open_after(batch_id - 1), deltas]).join(self.carry_after(batch_id).drop("position"), WHERE, "left")
        still = F.col("carry").isNull() | ~self._ended()
        if self.emit_final:
            write_batch(held.where(~still).select(*WINDOW, "agg", "n"), self.final_path, batch_id)
        write_batch(held.where(still).select(*WINDOW, "agg", "n"), self.open_path, batch_id)

    def updates(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """Per record kept in the batches (after, upto], the new value of its window."""
        upto = last_batch(self.spark, self.update_path) if upto is None else upto
        return read_batches(self.spark, self.update_path, after, upto, UPDATE_SCHEMA).drop("value")

    def final(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """Windows that ended in the batches (after, upto], each once, with their final value."""
        upto = last_batch(self.spark, self.final_path) if upto is None else upto
        return read_batches(self.spark, self.final_path, after, upto, DELTA_SCHEMA)

    def state(self, upto: int | None = None) -> DataFrame:
        """:meth:`_whole_state` without the windows past retention: those that start at or
        before their partition's stream time less it."""
        upto = last_batch(self.spark, self.delta_path) if upto is None else upto
        whole = self._whole_state(upto)
        return self._live(whole, self.carry_after(upto))

    def _live(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        if self.retention_seconds is None:
            return rows
        gone = epoch_micros("window_start") <= epoch_micros("carry") - F.lit(self.retention_seconds * MICROS)
        return (rows.join(carry.select(*WHERE, "carry"), WHERE, "left")
                .where(F.col("carry").isNull() | ~gone).select(*WINDOW, "agg", "n"))

    def _whole_state(self, upto: int) -> DataFrame:
        """Windowed state (topic, partition, key, window, agg, n): per topic partition the
        last version at or before ``upto`` plus the deltas of the batches after it."""
        parts, after = [], -1
        if self.resume is not None:
            parts.append(self.resume.read().select(*WINDOW, "agg", "n"))
        if self.store is not None:
            pointer = self.store.at(upto)
            base, positions = self.store.open(pointer)
            # versions of one store may differ between tasks: each task's deltas start after its own
            low = positions.agg(F.min("version"), F.count(F.lit(1))).first()
            if low[1]:
                seen = self.carry_after(upto).select(*WHERE)
                missing = seen.join(positions, WHERE, "left_anti").limit(1).count()
                after = -1 if missing else int(low[0])
                if self.resume is not None:  # its rows are inside the versions of the tasks that have one
                    parts = [parts[0].join(positions, WHERE, "left_anti")]
                parts.append(base.select(*WINDOW, "agg", "n"))
                deltas = read_batches(self.spark, self.delta_path, after, upto, DELTA_SCHEMA).join(
                    positions.select(*WHERE, F.col("version").alias("__v")), WHERE, "left").where(
                    F.col("__v").isNull() | (F.col("batch_id") > F.col("__v")))
                return self._summed([*parts, deltas.select(*WINDOW, "agg", "n")])
        deltas = read_batches(self.spark, self.delta_path, after, upto, DELTA_SCHEMA)
        return self._summed([*parts, deltas.select(*WINDOW, "agg", "n")])

    @staticmethod
    def _summed(parts: list[DataFrame]) -> DataFrame:
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return rows.groupBy(*WINDOW).agg(F.sum("agg").cast("bigint").alias("agg"), F.sum("n").cast("bigint").alias("n"))

    def snapshot(self, batch_id: int) -> DataFrame:
        """Fold everything up to ``batch_id`` into version ``batch_id``: the segments that the
        deltas since the last version touch, and the one that retention cuts through; the
        others are taken over by reference."""
        carry = self.carry_after(batch_id)
        positions = carry.select(*WHERE, F.lit(batch_id).cast("bigint").alias("version"))
        sources = carry.select(*WHERE, "position", F.col("carry").alias("stream_time"))
        pointer = self.store.at(batch_id - 1)
        versions = pointer.select(*WHERE, F.col("version").alias("__v"))
        low = versions.agg(F.min("__v")).first()[0]
        if low is None or carry.join(versions, WHERE, "left_anti").limit(1).count():  # a partition without a version
            return self.store.publish(self.state(upto=batch_id), positions, sources)
        deltas = (read_batches(self.spark, self.delta_path, int(low), batch_id, DELTA_SCHEMA).join(versions, WHERE)
                  .where(F.col("batch_id") > F.col("__v")).select(*WINDOW, "agg", "n"))
        width = self.store.segment_seconds
        touched, least = deltas.select(*WHERE, segment_id("window_start", width).alias("segment_id")), None
        if self.retention_seconds is not None:
            edge = segment_id(micros_to_ntz(epoch_micros("carry") - F.lit(self.retention_seconds * MICROS)), width)
            least = carry.select(*WHERE, edge.alias("least_segment"))
            touched = touched.unionByName(least.withColumnRenamed("least_segment", "segment_id"))
        touched = touched.distinct()
        base, _ = self.store.open(pointer, segments=touched)
        held = [base.select(*WINDOW, "agg", "n")] if "n" in base.columns else []  # no version may hold a touched segment
        rows = self._live(self._summed([*held, deltas]), carry)
        return self.store.publish_changes(rows, touched, positions, pointer, sources, least=least)
