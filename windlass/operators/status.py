"""Task/store status and snapshot guards.

The restore/standby listener keeps two flags per (partition, store). Here
its event log is folded with ``max_by(flag, seq)`` restricted to the events
that set that flag - a partial aggregate, so a store with a huge event log
is still pre-aggregated on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import sampled

RESTORING_EVENTS = ("restore_start", "restore_end", "restore_suspended", "standby_start", "standby_suspended")
STANDBY_EVENTS = ("standby_start", "standby_suspended")


def _last(flag, applies):
    """Value of ``flag`` at the last event (by seq) for which it applies."""
    return F.max_by(flag, F.when(applies, F.col("seq")))


def task_status(events: DataFrame) -> DataFrame:
    """TASK_EVENT (seq, topic, partition, store, event, total) -> current
    ``restoring`` and ``standby`` per (partition, store).

    restore start -> restoring; restore end -> not restoring; suspended ->
    restoring iff nothing was restored (total <= 0); standby start ->
    standby and restoring; standby suspended -> not standby, restoring by
    the same suspended rule; batch events change nothing. No event: false.
    """
    ev = F.col("event")
    restoring_val = (ev.isin("restore_start", "standby_start")
                     | (ev.isin("restore_suspended", "standby_suspended") & (F.col("total") <= 0)))
    return (events.groupBy("partition", "store")
            .agg(F.coalesce(_last(restoring_val, ev.isin(*RESTORING_EVENTS)), F.lit(False)).alias("restoring"),
                 F.coalesce(_last(ev == "standby_start", ev.isin(*STANDBY_EVENTS)), F.lit(False)).alias("standby"),
                 F.count(F.lit(1)).alias("events")))


def snapshot_eligible(status: DataFrame, offsets: DataFrame, positions: DataFrame,
                      flushing: DataFrame | None = None) -> DataFrame:
    """May a store partition snapshot now? Not restoring, not already
    snapshotting, not a standby, its changelog offset known and its source
    topic known. Missing status counts as false.

    ``status`` (partition, store, restoring, standby); ``offsets`` (topic,
    partition, store, offset); ``positions`` (topic, partition, ...) of the
    source; ``flushing`` optional (partition, store, flushing). All are
    metadata (one row per store partition).
    """
    st = status.select("partition", "store", "restoring", "standby")
    off = offsets.select("partition", "store", "offset")
    d = st.join(off, ["partition", "store"], "full_outer")
    src = positions.select("partition", F.col("topic").alias("source_topic")).distinct()
    d = d.join(src, "partition", "left")
    if flushing is not None:
        d = d.join(flushing.select("partition", "store", "flushing"), ["partition", "store"], "left")
    else:
        d = d.withColumn("flushing", F.lit(None).cast("boolean"))
    restoring = F.coalesce(F.col("restoring"), F.lit(False))
    standby = F.coalesce(F.col("standby"), F.lit(False))
    flushing_c = F.coalesce(F.col("flushing"), F.lit(False))
    eligible = (~restoring & ~flushing_c & ~standby & F.col("offset").isNotNull()
                & F.col("source_topic").isNotNull())
    return d.select("partition", "store", restoring.alias("restoring"), standby.alias("standby"),
                    "offset", "source_topic", eligible.alias("eligible"))


def snapshot_sampled(changelog: DataFrame, every_n: int = C.DEFAULT_SNAPSHOT_FREQUENCY) -> DataFrame:
    """Flushes that take a snapshot: a deterministic 1-in-``every_n`` draw
    per flush (a flush follows each update with caching off). In
    foreachBatch the same rule is ``batch_id % every_n == 0``."""
    fid = F.concat(F.col("partition").cast("string"), F.lit(":"), F.col("offset").cast("string"))
    return (changelog.where(sampled(fid, every_n))
            .select("topic", "partition", "offset", "key", "window_start", "agg"))
