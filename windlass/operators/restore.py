"""Restore: decide whether to fetch a snapshot, merge checkpoints, rebuild
state from a snapshot plus the changelog tail.

Decision and merge work on OFFSETS tables (metadata: one row per store
partition). The replay works on data: the tail is cut per partition by a
broadcast position table (one row per partition) and folded with
``max_by(agg, offset)``, a partial aggregate, so a hot window costs one
partial row per input split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C

_STORE_KEYS = ["app", "task", "store"]


def restore_decision(local: DataFrame, remote: DataFrame, *, threshold: int = C.RESTORE_OFFSET_THRESHOLD,
                     status: DataFrame | None = None) -> DataFrame:
    """Should a starting store fetch its remote snapshot?

    ``local`` and ``remote`` are OFFSETS (app, task, store, topic, partition,
    offset). The local checkpoint is a task-level file shared by the task's
    stores; the remote one is per store. Rules, in order:

    1. no remote checkpoint for the store -> no;
    2. no local checkpoint for the task -> yes;
    3. remote checkpoint with other than exactly one entry -> no;
    4. the remote entry's topic partition missing locally -> yes;
    5. else yes iff ``local + threshold < remote`` (strict).

    With ``status`` (partition, store, restoring), a store already being
    restored is never fetched.
    """
    stores = (local.select(*_STORE_KEYS).unionByName(remote.select(*_STORE_KEYS)).distinct())
    r = (remote.groupBy(*_STORE_KEYS)
               .agg(F.count(F.lit(1)).alias("remote_entries"),
                    F.min("topic").alias("r_topic"), F.min("partition").alias("r_partition"),
                    F.max("offset").alias("r_offset")))
    tasks = local.groupBy("app", "task").agg(F.lit(True).alias("local_exists"))
    loc = local.select("app", "task", F.col("topic").alias("r_topic"),
                       F.col("partition").alias("r_partition"), F.col("offset").alias("local_offset"))
    # one remote entry: its topic partition is the one to compare
    d = (stores.join(r, _STORE_KEYS, "left")
               .join(tasks, ["app", "task"], "left")
               .join(loc, ["app", "task", "r_topic", "r_partition"], "left"))
    n = F.coalesce(F.col("remote_entries"), F.lit(0))
    single = n == 1
    remote_offset = F.when(single, F.col("r_offset"))
    local_offset = F.when(single, F.col("local_offset"))
    has_local = F.coalesce(F.col("local_exists"), F.lit(False))
    reason = (F.when(n == 0, F.lit("no remote checkpoint"))
               .when(~has_local, F.lit("no local checkpoint"))
               .when(~single, F.lit("remote checkpoint names several partitions"))
               .when(F.col("local_offset").isNull(), F.lit("partition missing locally"))
               .when(F.col("local_offset") + F.lit(threshold) < F.col("r_offset"),
                     F.lit("local behind remote by more than threshold"))
               .otherwise(F.lit("local within threshold")))
    fetch = (F.when(n == 0, F.lit(False))
              .when(~has_local, F.lit(True))
              .when(~single, F.lit(False))
              .when(F.col("local_offset").isNull(), F.lit(True))
              .otherwise(F.col("local_offset") + F.lit(threshold) < F.col("r_offset")))
    out = d.select(*_STORE_KEYS, F.when(single, F.col("r_topic")).alias("topic"),
                   F.when(single, F.col("r_partition")).alias("partition"),
                   local_offset.alias("local_offset"), remote_offset.alias("remote_offset"),
                   fetch.alias("should_fetch"), reason.alias("reason"))
    if status is not None:
        # a store's own partition is the number its task name ends in
        own = F.regexp_extract("task", r"_(\d+)$", 1).cast("int")
        st = status.select(F.col("partition").alias("__p"), "store", "restoring")
        out = (out.withColumn("__p", own).join(st, ["__p", "store"], "left")
                  .withColumn("reason", F.when(F.col("restoring"), F.lit("store already restoring"))
                              .otherwise(F.col("reason")))
                  .withColumn("should_fetch", F.col("should_fetch") & ~F.coalesce(F.col("restoring"), F.lit(False)))
                  .select(*out.columns))
    return out


def merge_offsets(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Merged task checkpoint: key-wise union of local and remote entries,
    remote winning. Only tasks that have a remote checkpoint are merged
    (merging with no remote is an error, see :func:`merge_errors`)."""
    keys = ["app", "task", "topic", "partition"]
    rtasks = remote.select("app", "task").distinct()
    loc = local.join(rtasks, ["app", "task"], "left_semi").select(*keys, F.col("offset").alias("l_off"))
    rem = remote.select(*keys, F.col("offset").alias("r_off"))
    m = loc.join(rem, keys, "full_outer")
    return m.select(*keys, F.coalesce(F.col("r_off"), F.col("l_off")).alias("offset"),
                    F.when(F.col("r_off").isNotNull(), F.lit("remote")).otherwise(F.lit("local")).alias("source"))


def merge_map(local_map, remote_map):
    """The same merge on map<string,bigint> cells (remote wins).
    ``map_concat`` would fail on duplicate keys; ``map_zip_with`` does not."""
    return F.map_zip_with(local_map, remote_map, lambda k, a, b: F.coalesce(b, a))


def merge_errors(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Tasks whose merge must fail: a local checkpoint but no remote."""
    return local.select("app", "task").distinct().join(remote.select("app", "task"), ["app", "task"], "left_anti")


def _values(df: DataFrame) -> list[str]:
    """Value columns of a changelog or state table."""
    known = {"topic", "partition", "store", "offset", "ts", "key", "window_start", "window_end", "batch_id", "version",
             "segment_id", "task", "attempt"}
    return [c for c in df.columns if c not in known]


# types a hash aggregate can update in place
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _last_write(rows: DataFrame, values: list[str]) -> DataFrame:
    """Per window the values of the highest offset; a window whose values are all null was deleted.

    Values of fixed width are kept one by one, so the aggregate is a hash aggregate with
    map-side combine; a struct, as other types need it, would have to be sorted twice.
    """
    gone = F.lit(True)
    for v in values:
        gone = gone & F.col(v).isNull()
    fixed = [v for v in values if isinstance(rows.schema[v].dataType, _FIXED_WIDTH)]
    other = [v for v in values if v not in fixed]
    last = [F.max_by(v, "offset").alias(v) for v in fixed]
    if other:
        last.append(F.max_by(F.struct(*other), "offset").alias("__last"))
    return (rows.groupBy("topic", "partition", "key", "window_start", "window_end")
            .agg(*last, F.max("offset").alias("offset"))
            .select("topic", "partition", "key", "window_start", "window_end", *fixed, *(["__last.*"] if other else []), "offset")
            .select("topic", "partition", "key", "window_start", "window_end", *values, "offset")
            .where(~gone))


def changelog_compact(changelog: DataFrame) -> DataFrame:
    """Last record per topic partition, key and window of a changelog;
    tombstones (null values) dropped after compaction."""
    return _last_write(changelog, _values(changelog))


def state_as_of(changelog: DataFrame, positions: DataFrame) -> DataFrame:
    """Store state as of a changelog position per topic partition: last write per
    window among updates with ``offset <= version``. ``positions``: (topic,
    partition, version)."""
    cut = changelog.join(positions.select("topic", "partition", "version"), ["topic", "partition"])
    return changelog_compact(cut.where(F.col("offset") <= F.col("version")).drop("version"))


def restore_with_tail(snapshot: DataFrame, positions: DataFrame, changelog: DataFrame, *,
                      cut: Column | None = None) -> DataFrame:
    """State = snapshot rows, then every changelog update after the
    snapshot's position, last write per window.

    ``snapshot``: (topic, partition, key, window_start, window_end, values...,
    optional version); ``positions``: (topic, partition, version). A partition
    without a snapshot replays its whole changelog. Updates are absolute values,
    so an overlapping tail changes nothing. ``cut`` (see
    ``sources.snapshots.tail_filter``) says the same as the positions in a form
    the changelog scan can push down, partition by partition.
    """
    where = ["topic", "partition"]
    pos = positions.select(*where, F.col("version").cast("bigint").alias("__v"))
    values = _values(changelog)
    keys = [*where, "key", "window_start", "window_end"]
    if "version" in snapshot.columns:
        # snapshot rows carry their version: no join needed on this side
        snap = snapshot.select(*keys, *values, F.col("version").cast("bigint").alias("offset"))
    else:
        snap = (snapshot.join(pos, where, "left")
                .select(*keys, *values, F.coalesce(F.col("__v"), F.lit(-1)).cast("bigint").alias("offset")))
    if cut is not None:
        changelog = changelog.where(cut)
    tail = (changelog.join(pos, where, "left")
            .where(F.col("__v").isNull() | (F.col("offset") > F.col("__v")))
            .select(*keys, *values, "offset"))
    return _last_write(snap.unionByName(tail), values).drop("offset")
