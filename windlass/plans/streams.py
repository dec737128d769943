"""Registered streaming queries.

Each one cuts RECORD (derived from ``events``) into micro-batches of files in a
fresh folder under the shared checkpoint dir, runs a Structured Streaming
query over them to completion (``availableNow``), and returns what the
query produced, read back as a batch DataFrame.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import MICROS, epoch_micros, instant_to_ntz, micros_to_ntz
from ..session import scratch_dir, table_path
from ..sources.records import read_records, stream_records_from_files
from ..sources.snapshots import SnapshotStore
from ..sources.state_reader import read_operator_state, read_state_variable, windowed_state_rows
from ..streaming import listener
from ..streaming.batches import last_batch, read_batches, write_batch
from ..streaming.bootstrap import bootstrap_stream, rows_stream
from ..streaming.enrich import EnrichSink, ReplicatedTable
from ..streaming.files import write_record_batches
from ..streaming.sessions import session_stream
from ..streaming.snapshot_sink import SnapshotSink
from ..streaming.strict import StrictWindowSink
from ..streaming.windowed import for_each_update, windowed_stream
from .oracle import BATCHES
from .scenario import SCENARIO

APP = C.SAMPLE_APPLICATION_ID


def _parallelism(spark: SparkSession) -> int:
    """State partitions for the registered streams: the cluster's cores."""
    return max(1, spark.sparkContext.defaultParallelism)


ROWS_PER_SLOT = 250_000


def _slots(spark: SparkSession, sf: str, windows: bool = False) -> int:
    """Slots for the keys of a registered stream: some for each state partition, so that they
    spread evenly, and one per ``ROWS_PER_SLOT`` records; fewer if many short ``windows``
    divide the records already."""
    rows = spark.read.parquet(table_path(sf, "events")).count()
    if windows:
        return max(8, math.ceil(rows / (4 * ROWS_PER_SLOT)))
    return max(16 * _parallelism(spark), math.ceil(rows / ROWS_PER_SLOT))


def _input(spark: SparkSession, sf: str, tag: str, **source) -> tuple[str, DataFrame, DataFrame]:
    """(folder, RECORD, the stream over its micro-batches)."""
    root = scratch_dir(spark, "streams", tag)
    recs = read_records(spark, sf)
    files = write_record_batches(recs, f"{root}/in", BATCHES)
    return root, recs, stream_records_from_files(spark, f"{root}/in", max_files_per_trigger=files, **source)


def _deliver_to(path: str):
    """foreachBatch function that keeps each batch's rows in a directory of its own."""
    return lambda df, batch_id: write_batch(df, path, batch_id)


def _delivered(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, -1, last_batch(spark, path))


def strict_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Exact zero-grace store over 1 h windows, as a stream with a carried
    per-partition stream time; snapshots every 2 batches. Final state."""
    root, _, src = _input(spark, sf, "strict", event_time_type="timestamp_ntz")
    sink = StrictWindowSink(spark, f"{root}/strict", every_n=2, store=SnapshotStore(spark, f"{root}/snap", APP))
    for_each_update(src, sink, f"{root}/ckpt", output_mode="append", available_now=True,
                    state_partitions=_parallelism(spark)).awaitTermination()
    return sink.state().select("key", "window_start", "window_end", "agg")


def _strict(spark: SparkSession, sf: str, tag: str, **options) -> StrictWindowSink:
    """A strict store over 1 h windows that has seen all batches."""
    root, _, src = _input(spark, sf, tag, event_time_type="timestamp_ntz")
    sink = StrictWindowSink(spark, f"{root}/strict", every_n=2, store=SnapshotStore(spark, f"{root}/snap", APP), **options)
    for_each_update(src, sink, f"{root}/ckpt", output_mode="append", available_now=True,
                    state_partitions=_parallelism(spark)).awaitTermination()
    return sink


def final_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Emit on window close by each partition's own stream time, as a stream: what
    the batches emitted."""
    return _strict(spark, sf, "final", emit_final=True).final().select("key", "window_start", "window_end", "n", "agg")


def update_changelog_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every kept record's new window value, as the stream emitted them batch by batch."""
    return _strict(spark, sf, "updates", emit_updates=True).updates().select(
        "topic", "partition", "offset", "ts", "key", "window_start", "window_end", "agg")


def live_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The strict store with a retention of 1 day: the windows it still holds at the end."""
    sink = _strict(spark, sf, "live", retention_seconds=C.STORE_RETENTION_SECONDS)
    return sink.state().select("partition", "key", "window_start", "window_end", "n", "agg")


def tumbling_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarked (0 s) 1,000,000 s windows in update mode; the sink keeps
    the changelog and a snapshot every 2 batches. Final state (Spark's
    watermark rule: one global watermark, previous batch's value)."""
    root, _, src = _input(spark, sf, "tumbling")
    sink = SnapshotSink(spark, f"{root}/sink", SnapshotStore(spark, f"{root}/snap", APP), every_n=2)
    for_each_update(windowed_stream(src, addresses=True), sink, f"{root}/ckpt", available_now=True,
                    state_partitions=_parallelism(spark)).awaitTermination()
    return sink.state().select("key", "window_start", "window_end", "agg")


def for_each_update_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every (windowed key, value) update the stream emitted, by batch."""
    root, _, src = _input(spark, sf, "foreach")
    out = f"{root}/updates"
    for_each_update(windowed_stream(src, C.STORE_WINDOW_SECONDS), _deliver_to(out), f"{root}/ckpt",
                    available_now=True, state_partitions=_parallelism(spark)).awaitTermination()
    return _delivered(spark, out).select("batch_id", "key", instant_to_ntz("window_start").alias("window_start"),
                                         instant_to_ntz("window_end").alias("window_end"), "agg", "n")


def operator_state(spark: SparkSession, sf: str) -> DataFrame:
    """The running aggregation's own state store, read offline from its
    checkpoint after the last batch: the windows still open."""
    root, _, src = _input(spark, sf, "state")
    ckpt = f"{root}/ckpt"
    for_each_update(windowed_stream(src, C.STORE_WINDOW_SECONDS),
                    lambda df, i: df.write.format("noop").mode("overwrite").save(), ckpt,
                    available_now=True, state_partitions=_parallelism(spark)).awaitTermination()
    rows = windowed_state_rows(read_operator_state(spark, ckpt), ("agg", "n", "value_ts"))
    return rows.select("key", "window_start", "window_end", "agg", "n")


def bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """A new query started from a snapshot of the 1,000,000 s sums taken at
    the first scenario cut, fed the whole input again: records at or below
    the snapshot position are cut per partition, so the final state equals
    an uninterrupted run."""
    root, recs, src = _input(spark, sf, "bootstrap")
    where = ["topic", "partition"]
    cut = F.lit(SCENARIO.snapshot_cuts[0]).cast("timestamp_ntz")
    pos = recs.where(F.col("ts") < cut).groupBy(*where).agg(F.max("offset").alias("version"))
    w = F.window("ts", f"{C.SAMPLE_WINDOW_SECONDS} seconds")
    upto = (recs.join(pos, where).where((F.col("offset") <= F.col("version")) & F.col("key").isNotNull())
            .groupBy(*where, "key", w.alias("w")).agg(F.sum(F.coalesce("value", F.lit(0))).cast("bigint").alias("agg"))
            .select(*where, "key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "agg"))
    store = SnapshotStore(spark, f"{root}/snap", APP, store="sum-store")
    store.publish(upto, pos, pos.withColumnRenamed("version", "position"))
    snapshot, out = store.read(), f"{root}/updates"
    for_each_update(bootstrap_stream(src, snapshot, store.sources(), slots=_slots(spark, sf)), _deliver_to(out), f"{root}/ckpt",
                    available_now=True, state_partitions=_parallelism(spark), rocksdb=True).awaitTermination()
    emitted = _delivered(spark, out).select("key", instant_to_ntz("window_start").alias("window_start"), "agg", "batch_id")
    first = snapshot.groupBy("key", "window_start").agg(F.sum("agg").cast("bigint").alias("agg")).withColumn(
        "batch_id", F.lit(-1).cast("bigint"))
    final = first.unionByName(emitted).groupBy("key", "window_start").agg(F.max_by("agg", "batch_id").alias("agg"))
    size = C.SAMPLE_WINDOW_SECONDS * MICROS
    return final.select("key", "window_start",
                        micros_to_ntz(epoch_micros("window_start") + F.lit(size)).alias("window_end"), "agg")


def expiring_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Running sums of 1 h windows whose state expires after 1 day, by event-time timers:
    what the state store holds after the last batch, read variable by variable."""
    root, _, src = _input(spark, sf, "expiring")
    out = f"{root}/updates"
    sums = bootstrap_stream(src, size_seconds=C.STORE_WINDOW_SECONDS, retention_seconds=C.STORE_RETENTION_SECONDS,
                            slots=_slots(spark, sf, windows=True))
    for_each_update(sums, _deliver_to(out), f"{root}/ckpt", available_now=True, state_partitions=_parallelism(spark),
                    rocksdb=True).awaitTermination()
    held = read_state_variable(spark, f"{root}/ckpt", "agg")
    return held.select("key", instant_to_ntz("window_start").alias("window_start"), "agg")


def window_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates retained in a stream: the list state of every window after the last batch."""
    root, _, src = _input(spark, sf, "rows")
    for_each_update(rows_stream(src, slots=_slots(spark, sf)), _deliver_to(f"{root}/rows"), f"{root}/ckpt",
                    output_mode="append", available_now=True, state_partitions=_parallelism(spark), rocksdb=True).awaitTermination()
    start = instant_to_ntz("window_start")
    return read_state_variable(spark, f"{root}/ckpt", "rows").select(
        "key", start.alias("window_start"), micros_to_ntz(epoch_micros(start) + F.lit(C.SAMPLE_WINDOW_SECONDS * MICROS)).alias("window_end"),
        "partition", "offset", "value", "seq")


def session_changes(spark: SparkSession, sf: str, gap_seconds: int) -> DataFrame:
    """Sessions kept by a stream, the replaced ones retracted; snapshots every 2 batches.
    The final sessions."""
    root, _, src = _input(spark, sf, "sessions")
    sink = SnapshotSink(spark, f"{root}/sink", SnapshotStore(spark, f"{root}/snap", APP, store="sessions"), every_n=2)
    for_each_update(session_stream(src, gap_seconds, slots=_slots(spark, sf)), sink, f"{root}/ckpt", available_now=True,
                    state_partitions=_parallelism(spark), rocksdb=True).awaitTermination()
    return sink.state().select("key", F.col("window_start").alias("session_start"), F.col("window_end").alias("session_end"),
                               "n", "agg")


def enrich_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Each record of the stream with its customer and the customer's nation, from
    replicated tables that are copied anew every 2 batches."""
    root, _, src = _input(spark, sf, "enrich", event_time_type="timestamp_ntz")
    customers = ReplicatedTable(spark, f"{root}/customers", lambda: spark.read.parquet(table_path(sf, "customer")).select(
        F.col("c_custkey").cast("string").alias("key"), "c_name", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")),
        ["key"], order="c_name", refresh_every=2)
    nations = ReplicatedTable(spark, f"{root}/nations", lambda: spark.read.parquet(table_path(sf, "nation")).select(
        "n_nationkey", "n_name"), ["n_nationkey"], order="n_name", refresh_every=2)
    sink = EnrichSink(f"{root}/out", [customers, nations])
    for_each_update(src, sink, f"{root}/ckpt", output_mode="append", available_now=True,
                    state_partitions=_parallelism(spark)).awaitTermination()
    return _delivered(spark, sink.path).select("topic", "partition", "offset", "ts", "key", "value", "c_name", "c_mktsegment", "n_name")


def query_events(spark: SparkSession, sf: str) -> DataFrame:
    """Lifecycle events of a streaming query (started, progress per batch,
    terminated) with input rows per batch."""
    root, _, src = _input(spark, sf, "events")
    events = listener.attach(spark, f"{root}/events")
    try:
        q = for_each_update(windowed_stream(src, C.STORE_WINDOW_SECONDS),
                            lambda df, i: df.write.format("noop").mode("overwrite").save(), f"{root}/ckpt",
                            available_now=True, state_partitions=_parallelism(spark))
        q.awaitTermination()
        events.wait_terminated(str(q.runId))
        rows = events.frame(str(q.id))
    finally:
        spark.streams.removeListener(events)
    return rows.where(F.col("event") != "idle").select("event", "batch_id", "input_rows")
