"""User-facing entry points: opt a windowed aggregation into snapshots.

* :func:`snapshotted_aggregation` - start a streaming windowed aggregate
  whose state is snapshotted every ``opts.every_n`` batches (the implicit
  "materialize with snapshots" of the original library);
* :func:`with_snapshot` - publish any state DataFrame as a version;
* :func:`restore_state` - latest version + changelog tail;
* :func:`restore` - the whole start of a store: decide whether to fetch, fetch,
  merge checkpoints, replay the tail;
* :func:`enable_listeners` - collect query lifecycle / progress events.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .config import SnapshotOptions
from .functions.columns import layout_path_str
from .operators import restore as R
from .sources.snapshots import SnapshotStore, tail_filter
from .streaming import listener
from .streaming.snapshot_sink import SnapshotSink
from .streaming.windowed import for_each_update, windowed_stream

STORE_KEYS = ["app", "task", "store"]


def snapshotted_aggregation(records: DataFrame, opts: SnapshotOptions, checkpoint: str, *,
                            size_seconds: int, grace_seconds: int = 0, partitions: int = 4,
                            aggs: dict[str, Column] | None = None, available_now: bool = False,
                            processing_time: str | None = None, on_update=None) -> tuple[StreamingQuery, SnapshotSink]:
    """Windowed aggregates per key (default: sum and count) over a streaming RECORD,
    update mode, with the state changelog kept and compacted into snapshot versions."""
    spark = records.sparkSession
    store = SnapshotStore.from_options(spark, opts)
    sink = SnapshotSink(spark, layout_path_str(opts.path, opts.app_id, opts.store, "sink"), store, every_n=opts.every_n,
                        partitions=partitions, retention_seconds=opts.retention_seconds)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        if on_update is not None:  # what the sink wrote: the batch is computed once
            on_update(sink.changelog(batch_id - 1, batch_id), batch_id)

    agg = windowed_stream(records, size_seconds, grace_seconds=grace_seconds, aggs=aggs,
                          addresses={"topic", "partition", "offset"} <= set(records.columns))
    q = for_each_update(agg, deliver, checkpoint, available_now=available_now, processing_time=processing_time)
    return q, sink


def with_snapshot(state: DataFrame, positions: DataFrame, opts: SnapshotOptions,
                  sources: DataFrame | None = None) -> DataFrame:
    """Publish ``state`` (topic, partition, key, window_start, window_end, values...) as
    the versions that ``positions`` (topic, partition, version) names."""
    return SnapshotStore.from_options(state.sparkSession, opts).publish(state, positions, sources)


def restore_state(spark: SparkSession, opts: SnapshotOptions, changelog: DataFrame) -> DataFrame:
    """State = latest published version + every changelog update after it."""
    snap, positions = SnapshotStore.from_options(spark, opts).open()
    if not set(R._values(changelog)) <= set(snap.columns):  # nothing published yet
        snap = changelog.limit(0)
    return R.restore_with_tail(snap, positions, changelog, cut=tail_filter(positions))


class Restored(NamedTuple):
    decision: DataFrame  # per store: should_fetch and why
    offsets: DataFrame  # the task checkpoints after the merge
    state: DataFrame


def restore(spark: SparkSession, opts: SnapshotOptions, changelog: DataFrame, local: DataFrame, *,
            local_state: DataFrame | None = None, status: DataFrame | None = None) -> Restored:
    """Start a store: decide per task whether its remote snapshot is worth fetching
    (``opts.threshold``), take the state of fetched tasks from the latest version and
    that of the others from ``local_state`` (topic, partition, key, window, values),
    and replay the changelog after whichever position each task then stands at.

    ``local`` is the OFFSETS table of the local checkpoints. Tasks that neither fetch
    nor have a local state replay their whole changelog.
    """
    store = SnapshotStore.from_options(spark, opts)
    latest = store.latest()
    remote = store.offsets(latest)
    decision = R.restore_decision(local, remote, threshold=opts.threshold, status=status)
    fetched = decision.where("should_fetch").select(*STORE_KEYS)
    pointer = latest.join(fetched, STORE_KEYS, "left_semi")
    snap, positions = store.open(pointer)
    values = R._values(changelog)
    keys = ["topic", "partition", "key", "window_start", "window_end"]
    base = snap.select(*keys, *values) if set(values) <= set(snap.columns) else changelog.select(*keys, *values).limit(0)
    if local_state is not None:
        stay = local.join(fetched, STORE_KEYS, "left_anti").select("topic", "partition", local["offset"].alias("version"))
        base = base.unionByName(local_state.select(*keys, *values).join(stay, ["topic", "partition"], "left_semi"))
        positions = positions.unionByName(stay)
    state = R.restore_with_tail(base, positions, changelog, cut=tail_filter(positions))
    merged = R.merge_offsets(local, remote.join(fetched, STORE_KEYS, "left_semi"))
    kept = (local.join(fetched.select("app", "task").distinct(), ["app", "task"], "left_anti")
                 .selectExpr("app", "task", "topic", "partition", "offset", "'local' AS source"))
    return Restored(decision, merged.unionByName(kept), state)


def enable_listeners(spark: SparkSession, path: str | None = None) -> listener.QueryEvents:
    return listener.attach(spark, path)
