"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator.

Every query reads the fixture tables (or data Spark derives from them) in
full; nothing is capped or sampled. Window sizes and parameters:

* sample aggregate: 1,000,000 s tumbling windows (the reference's sample);
* store pipeline: 1 hour tumbling windows, grace 0, retention 1 day,
  segments of 12 hours (max(retention / 2, 60 s));
* hopping 2 h / 1 h, sliding 6 h, session gap 6 h, CUSUM drift 50.00.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import lateness, offsets, restore, status, windows
from ..sources.records import events, read_records, task_events
from ..sources.snapshots import tail_filter
from . import scenario

HOP_SIZE, HOP_SLIDE = 7_200, 3_600
SLIDE_RANGE = 6 * 3_600
SESSION_GAP = 6 * 3_600
CUSUM_DRIFT = 5_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _changelog(spark, sf):
    return lateness.changelog(read_records(spark, sf, stream_time=True))


def _changelog_offsets(spark, sf):
    return lateness.changelog_offsets(read_records(spark, sf, stream_time=True))


@register("read_records")
def q_read_records(spark, sf):
    return read_records(spark, sf)


@register("tumbling_sum")
def q_tumbling_sum(spark, sf):
    return windows.tumbling_sum(read_records(spark, sf, offsets=False))


@register("tumbling_count")
def q_tumbling_count(spark, sf):
    return windows.tumbling_count(read_records(spark, sf, offsets=False))


@register("tumbling_stats")
def q_tumbling_stats(spark, sf):
    return windows.tumbling_stats(read_records(spark, sf, offsets=False))


@register("tumbling_timestamped")
def q_tumbling_timestamped(spark, sf):
    return windows.tumbling_timestamped(read_records(spark, sf, offsets=False))


@register("keyed_sum")
def q_keyed_sum(spark, sf):
    return windows.keyed_sum(read_records(spark, sf, offsets=False))


@register("hopping_sum")
def q_hopping_sum(spark, sf):
    return windows.hopping_sum(read_records(spark, sf, offsets=False), HOP_SIZE, HOP_SLIDE)


@register("sliding_sum")
def q_sliding_sum(spark, sf):
    return windows.sliding_sum(read_records(spark, sf), SLIDE_RANGE)


@register("sliding_windows")
def q_sliding_windows(spark, sf):
    return windows.sliding_windows(read_records(spark, sf, offsets=False), SLIDE_RANGE)


@register("longest_rise")
def q_longest_rise(spark, sf):
    return windows.longest_rise(read_records(spark, sf))


@register("session_sum")
def q_session_sum(spark, sf):
    return windows.session_sum(read_records(spark, sf, offsets=False), SESSION_GAP)


@register("window_rows")
def q_window_rows(spark, sf):
    return windows.window_rows(read_records(spark, sf))


@register("window_last")
def q_window_last(spark, sf):
    return windows.window_last(read_records(spark, sf))


@register("ordered_fold")
def q_ordered_fold(spark, sf):
    return windows.cusum(read_records(spark, sf), CUSUM_DRIFT)


@register("strict_late_drop")
def q_strict_late_drop(spark, sf):
    return lateness.strict_late_drop(read_records(spark, sf, stream_time=True))


@register("update_stream")
def q_update_stream(spark, sf):
    return lateness.update_stream(read_records(spark, sf, stream_time=True))


@register("final_windows")
def q_final_windows(spark, sf):
    return lateness.final_windows(read_records(spark, sf, stream_time=True))


@register("live_windows")
def q_live_windows(spark, sf):
    return lateness.live_windows(read_records(spark, sf, stream_time=True))


@register("segment_rollup")
def q_segment_rollup(spark, sf):
    return lateness.segment_rollup(read_records(spark, sf, stream_time=True))


@register("changelog_compact")
def q_changelog_compact(spark, sf):
    return restore.changelog_compact(_changelog(spark, sf)).select(
        "partition", "key", "window_start", "window_end", "agg", "offset")


@register("source_positions")
def q_source_positions(spark, sf):
    return offsets.source_positions(read_records(spark, sf))


@register("offsets_checkpoint")
def q_offsets_checkpoint(spark, sf):
    return offsets.offsets_checkpoint(_changelog_offsets(spark, sf))


# -- snapshots ---------------------------------------------------------------
# Each snapshot query publishes into its own fresh folder under the shared
# checkpoint dir, reads back what it wrote and returns that.

_POINTER_COLS = ["app", "task", "store", "version", "row_count"]
_STATE_COLS = ["task", "store", "version", "partition", "key", "window_start", "window_end", "agg",
               "segment_id"]


@register("snapshot_state")
def q_snapshot_state(spark, sf):
    store, _ = scenario.publish_snapshots(spark, sf)
    return store.versions().select(*_POINTER_COLS)


@register("latest_snapshot")
def q_latest_snapshot(spark, sf):
    store, _ = scenario.publish_snapshots(spark, sf)
    return store.latest().select(*_POINTER_COLS)


@register("read_snapshot")
def q_read_snapshot(spark, sf):
    store, _ = scenario.publish_snapshots(spark, sf)
    return store.read().select(*_STATE_COLS)


@register("snapshot_manifest")
def q_snapshot_manifest(spark, sf):
    store, _ = scenario.publish_snapshots(spark, sf)
    # sizes and times vary from run to run: that every file has them is what is reported
    return (store.manifest().groupBy("task", "version", "segment_id")
            .agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("agg").cast("bigint").alias("agg"),
                 F.min("min_window_start").alias("min_window_start"),
                 F.max("max_window_start").alias("max_window_start"),
                 F.min((F.col("length") > 0) & F.col("modificationTime").isNotNull()).alias("files_listed")))


@register("snapshot_aggregates")
def q_snapshot_aggregates(spark, sf):
    """A version of several aggregates with the newest record time, read back."""
    from ..session import scratch_dir
    from ..sources.snapshots import SnapshotStore
    recs = lateness.strict_kept(read_records(spark, sf, stream_time=True))
    state = (recs.groupBy("topic", "partition", "key", "window_start", "window_end")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("total"),
                  F.max("ts").alias("value_ts")))
    positions = recs.groupBy("topic", "partition").agg(F.max("offset").alias("version"))
    store = SnapshotStore(spark, scratch_dir(spark, "aggregates"), C.SAMPLE_APPLICATION_ID)
    store.publish(state, positions)
    return store.read().select("partition", "key", "window_start", "window_end", "n", "total", "value_ts", "version")


@register("restore_with_tail")
def q_restore_with_tail(spark, sf):
    store, cl = scenario.publish_snapshots(spark, sf)
    snap, positions = store.open()
    return restore.restore_with_tail(snap, positions, cl, cut=tail_filter(positions)).select(
        "key", "window_start", "window_end", "agg")


# -- restore decisions and reports ---------------------------------------------



@register("restore_decision")
def q_restore_decision(spark, sf):
    local, remote, _ = scenario.offset_tables(_changelog_offsets(spark, sf))
    return restore.restore_decision(local, remote)


@register("merge_offsets")
def q_merge_offsets(spark, sf):
    local, remote, _ = scenario.offset_tables(_changelog_offsets(spark, sf))
    return restore.merge_offsets(local, remote)


@register("lag_report")
def q_lag_report(spark, sf):
    local, _, end = scenario.offset_tables(_changelog_offsets(spark, sf))
    return offsets.lag_report(end, local)


@register("task_status")
def q_task_status(spark, sf):
    return status.task_status(task_events(events(spark, sf)))


@register("snapshot_eligible")
def q_snapshot_eligible(spark, sf):
    recs = read_records(spark, sf, stream_time=True)
    st = status.task_status(task_events(events(spark, sf)))
    return status.snapshot_eligible(st, offsets.offsets_checkpoint(lateness.changelog_offsets(recs)),
                                    offsets.source_positions(recs))


@register("snapshot_sampled")
def q_snapshot_sampled(spark, sf):
    return status.snapshot_sampled(_changelog(spark, sf))


# -- streaming forms (Structured Streaming over micro-batch files) ----------------

@register("strict_stream")
def q_strict_stream(spark, sf):
    from .streams import strict_stream
    return strict_stream(spark, sf)


@register("final_stream")
def q_final_stream(spark, sf):
    from .streams import final_stream
    return final_stream(spark, sf)


@register("update_changelog_stream")
def q_update_changelog_stream(spark, sf):
    from .streams import update_changelog_stream
    return update_changelog_stream(spark, sf)


@register("live_stream")
def q_live_stream(spark, sf):
    from .streams import live_stream
    return live_stream(spark, sf)


@register("expiring_stream")
def q_expiring_stream(spark, sf):
    from .streams import expiring_stream
    return expiring_stream(spark, sf)


@register("window_rows_stream")
def q_window_rows_stream(spark, sf):
    from .streams import window_rows_stream
    return window_rows_stream(spark, sf)


@register("session_stream")
def q_session_stream(spark, sf):
    from .streams import session_changes
    return session_changes(spark, sf, SESSION_GAP)


@register("enrich_orders")
def q_enrich_orders(spark, sf):
    from .streams import enrich_orders
    return enrich_orders(spark, sf)


@register("bootstrap_stream")
def q_bootstrap_stream(spark, sf):
    from .streams import bootstrap
    return bootstrap(spark, sf)


@register("tumbling_stream")
def q_tumbling_stream(spark, sf):
    from .streams import tumbling_stream
    return tumbling_stream(spark, sf)


@register("for_each_update")
def q_for_each_update(spark, sf):
    from .streams import for_each_update_rows
    return for_each_update_rows(spark, sf)


@register("read_operator_state")
def q_read_operator_state(spark, sf):
    from .streams import operator_state
    return operator_state(spark, sf)


@register("query_events")
def q_query_events(spark, sf):
    from .streams import query_events
    return query_events(spark, sf)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return QUERIES["tumbling_sum"](spark, sf)



