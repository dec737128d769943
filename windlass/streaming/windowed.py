"""Watermarked windowed aggregation and per-update delivery (Structured
Streaming).

Spark's rule is looser than the per-partition one of
:mod:`windlass.operators.lateness`: one watermark per query, and a batch
filters late rows with the *previous* batch's watermark, so a record one
batch late still counts. :class:`windlass.streaming.strict.StrictWindowSink`
gives the exact rule.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def default_aggregates() -> dict[str, Column]:
    return {"agg": F.sum("value").cast("bigint"), "n": F.count(F.lit(1))}


def windowed_stream(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *,
                    grace_seconds: int = C.SAMPLE_GRACE_SECONDS, slide_seconds: int | None = None,
                    aggs: dict[str, Column] | None = None, addresses: bool = False) -> DataFrame:
    """``withWatermark(grace)`` + per key and window the aggregates ``aggs`` (default:
    sum and count of value) and ``value_ts``, the newest record time.

    ``addresses`` adds, per window, the source topic, partition and last offset it
    includes (a key's records come from one partition), so a snapshot of the updates
    knows where in the source to go on. State lives in the configured state store;
    partial aggregation happens before the state shuffle.
    """
    size = f"{size_seconds} seconds"
    w = F.window("ts", size) if slide_seconds is None else F.window("ts", size, f"{slide_seconds} seconds")
    out = dict(aggs or default_aggregates())
    out["value_ts"] = F.max("ts")
    if addresses:
        out |= {"source_topic": F.max("topic"), "source_partition": F.max("partition"), "source_offset": F.max("offset")}
    return (records.withWatermark("ts", f"{grace_seconds} seconds")
            .groupBy("key", w.alias("w")).agg(*[c.alias(n) for n, c in out.items()])
            .select("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *out))


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Settings for what starts inside; the session's own come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def for_each_update(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, *,
                    output_mode: str = "update", available_now: bool = False,
                    processing_time: str | None = None, query_name: str | None = None,
                    state_partitions: int | None = None, rocksdb: bool = False) -> StreamingQuery:
    """Hand every emitted batch of (windowed key, value) rows to ``fn``.

    ``update`` emits each changed window once per batch (emit on update);
    ``append`` emits each window once, after the watermark passes its end
    (emit on window close). ``fn`` gets a DataFrame and the batch id, runs
    on the driver, must accept an empty batch and must consume the whole
    batch (a stateful query checks that every state partition committed).

    ``state_partitions`` fixes the number of state store partitions (recorded in
    the checkpoint at the first start); ``rocksdb`` picks the provider with column
    families that ``transformWithState`` needs. Both hold for this query only.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    settings = {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if rocksdb:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    with session_settings(df.sparkSession, settings):
        return w.start()
