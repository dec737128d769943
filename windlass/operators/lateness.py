"""Exact late-record rules, emission modes and retention, in batch.

Stream time of a topic partition is the largest timestamp seen so far in
that partition, this record included. With grace ``g`` a record counts
iff ``window_end + g > stream_time``. A window is final ("emit on window
close") once ``window_end + g <= stream_time`` of its partition, and it is
retained while ``window_start > stream_time - retention``.

Spark's streaming watermark is looser (one global watermark, applied with
the previous batch's value); :mod:`windlass.streaming` has both forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import MICROS, epoch_micros, segment_id
from . import scan
from .windows import _keyed


def with_stream_time(records: DataFrame, *, span: int | None = None) -> DataFrame:
    """Add ``stream_time``: running max of ts per (topic, partition) by
    offset. Block-parallel: a topic partition is far too big for one task.
    A source that already carries it (see ``records_from_events``) is kept."""
    if "stream_time" in records.columns:
        return records
    return scan.running(records, ["topic", "partition"], "offset",
                        [("stream_time", "max", F.col("ts"))], span=span)


def with_window(records: DataFrame, size_seconds: int) -> DataFrame:
    w = F.window("ts", f"{size_seconds} seconds")
    return (records.withColumn("__w", w)
                   .withColumn("window_start", F.col("__w.start"))
                   .withColumn("window_end", F.col("__w.end"))
                   .drop("__w"))


def strict_kept(records: DataFrame, size_seconds: int = C.STORE_WINDOW_SECONDS,
                grace_seconds: int = C.STORE_GRACE_SECONDS, *, span: int | None = None) -> DataFrame:
    """Records that count under the zero-grace rule, with their window."""
    d = with_window(with_stream_time(_keyed(records), span=span), size_seconds)
    keep = (epoch_micros("window_end") + F.lit(grace_seconds * MICROS)) > epoch_micros("stream_time")
    return d.where(keep)


def strict_late_drop(records: DataFrame, size_seconds: int = C.STORE_WINDOW_SECONDS,
                     grace_seconds: int = C.STORE_GRACE_SECONDS, *,
                     span: int | None = None) -> DataFrame:
    """Windowed sum of the records that are not late: the final content of
    a zero-grace windowed store."""
    return (strict_kept(records, size_seconds, grace_seconds, span=span)
            .groupBy("key", "window_start", "window_end")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("agg")))


def update_stream(records: DataFrame, size_seconds: int = C.STORE_WINDOW_SECONDS,
                  grace_seconds: int = C.STORE_GRACE_SECONDS, *,
                  span: int | None = None) -> DataFrame:
    """With caching off, every kept record emits the new aggregate of its
    window: running sum per (key, window) in offset order.

    This is also the store's changelog: one absolute value per update, so
    replaying any overlapping suffix is harmless.
    """
    kept = strict_kept(records, size_seconds, grace_seconds, span=span)
    out = scan.running(kept, ["key", "window_start"], "offset", [("agg", "sum", F.col("value"))], span=span)
    return out.select("topic", "partition", "offset", "ts", "key", "window_start", "window_end",
                      F.col("agg").cast("bigint").alias("agg"))


def changelog(records: DataFrame, *, app_id: str = C.SAMPLE_APPLICATION_ID, store: str = C.STORE_NAME,
              size_seconds: int = C.STORE_WINDOW_SECONDS, grace_seconds: int = C.STORE_GRACE_SECONDS,
              span: int | None = None) -> DataFrame:
    """CHANGELOG: the update stream addressed by changelog topic.

    Changelog partition = source partition (the store is keyed like its
    input). Each update carries the source offset that produced it, which
    is monotone and unique in the partition; so a snapshot's version, its
    changelog position and its source position are one number, and a
    replay cut ``offset > version`` is exact for both the changelog tail
    and the input.
    """
    up = update_stream(records, size_seconds, grace_seconds, span=span)
    return up.select(F.lit(C.changelog_topic(app_id, store)).alias("topic"), F.lit(store).alias("store"),
                     "partition", "offset", "ts", "key", "window_start", "window_end", "agg")


def changelog_offsets(records: DataFrame, *, app_id: str = C.SAMPLE_APPLICATION_ID,
                      store: str = C.STORE_NAME, size_seconds: int = C.STORE_WINDOW_SECONDS,
                      grace_seconds: int = C.STORE_GRACE_SECONDS, span: int | None = None) -> DataFrame:
    """The changelog's positions without its values: one row per kept
    record (topic, store, partition, offset, ts). Offset tables need only
    this, which skips the per-window running sums of :func:`changelog`."""
    kept = strict_kept(records, size_seconds, grace_seconds, span=span)
    return kept.select(F.lit(C.changelog_topic(app_id, store)).alias("topic"), F.lit(store).alias("store"),
                       "partition", "offset", "ts")


def partition_stream_time(records: DataFrame) -> DataFrame:
    """Final stream time per topic partition (a partial aggregate). Records without a
    key take no part in the late rule, so they don't move it either."""
    return _keyed(records).groupBy("topic", "partition").agg(F.max("ts").alias("stream_time"))


def _with_partition_time(state: DataFrame, records: DataFrame) -> DataFrame:
    return state.join(partition_stream_time(records), ["topic", "partition"])


def final_windows(records: DataFrame, size_seconds: int = C.STORE_WINDOW_SECONDS,
                  grace_seconds: int = C.STORE_GRACE_SECONDS, *, span: int | None = None) -> DataFrame:
    """Emit-on-close: windows whose end plus grace has passed their
    partition's stream time, with their final value."""
    kept = strict_kept(records, size_seconds, grace_seconds, span=span)
    state = (kept.groupBy("topic", "partition", "key", "window_start", "window_end")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("agg")))
    st = _with_partition_time(state, records)
    closed = (epoch_micros("window_end") + F.lit(grace_seconds * MICROS)) <= epoch_micros("stream_time")
    return st.where(closed).select("key", "window_start", "window_end", "n", "agg")


def live_windows(records: DataFrame, size_seconds: int = C.STORE_WINDOW_SECONDS,
                 grace_seconds: int = C.STORE_GRACE_SECONDS,
                 retention_seconds: int = C.STORE_RETENTION_SECONDS, *,
                 span: int | None = None) -> DataFrame:
    """Windows still held by a store with the given retention at the end
    of the input: ``window_start > stream_time - retention``."""
    kept = strict_kept(records, size_seconds, grace_seconds, span=span)
    state = (kept.groupBy("topic", "partition", "key", "window_start", "window_end")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("agg")))
    st = _with_partition_time(state, records)
    live = epoch_micros("window_start") > (epoch_micros("stream_time") - F.lit(retention_seconds * MICROS))
    return st.where(live).select("partition", "key", "window_start", "window_end", "n", "agg")


def segment_rollup(records: DataFrame, size_seconds: int = C.STORE_WINDOW_SECONDS,
                   grace_seconds: int = C.STORE_GRACE_SECONDS,
                   segment_seconds: int = C.segment_interval_seconds(C.STORE_RETENTION_SECONDS), *,
                   span: int | None = None) -> DataFrame:
    """State sliced by segment (``floor(window_start / interval)``): rows,
    value and window range per segment, the unit a store expires."""
    state = strict_late_drop(records, size_seconds, grace_seconds, span=span)
    return (state.withColumn("segment_id", segment_id("window_start", segment_seconds))
                 .groupBy("segment_id")
                 .agg(F.count(F.lit(1)).alias("windows"), F.sum("n").cast("bigint").alias("records"),
                      F.sum("agg").cast("bigint").alias("agg"),
                      F.min("window_start").alias("min_window_start"),
                      F.max("window_start").alias("max_window_start")))
