"""Read the state a streaming aggregation holds, from its checkpoint.

Spark's ``statestore`` data source reads the operator's state store
(RocksDB or HDFS-backed) at a committed batch, on executors, partition by
partition; ``state-metadata`` lists the operators. This is how a snapshot
is taken offline, without touching the running query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MICROS, instant_to_ntz


def state_metadata(spark: SparkSession, checkpoint: str) -> DataFrame:
    return spark.read.format("state-metadata").load(checkpoint)


def read_operator_state(spark: SparkSession, checkpoint: str, *, batch_id: int | None = None,
                        operator_id: int = 0, store_name: str | None = None,
                        change_feed_from: int | None = None) -> DataFrame:
    """Raw rows of one stateful operator: (key struct, value struct,
    partition_id), or its change feed between batches."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    if store_name:
        r = r.option("storeName", store_name)
    if change_feed_from is not None:
        r = r.option("readChangeFeed", "true").option("changeStartBatchId", change_feed_from)
        if batch_id is not None:
            r = r.option("changeEndBatchId", batch_id)
    return r.load(checkpoint)


def windowed_state_rows(state: DataFrame, values: tuple[str, ...] = (), key_field: str = "key") -> DataFrame:
    """STATE_ROW view of a windowed aggregation's state: key, window bounds and the
    aggregates. ``values`` names the aggregates in the order the query declared them
    (one buffer field each, as sum, count, min and max of numbers and times have);
    without it the buffer stays one struct column."""
    key_type = state.schema["key"].dataType
    win = next(f.name for f in key_type.fields
               if isinstance(f.dataType, T.StructType) and {"start", "end"} <= set(f.dataType.names))
    buffer = state.schema["value"].dataType
    if values and len(buffer) != len(values):
        raise ValueError(f"the state has {len(buffer)} buffer fields {buffer.names}, not {len(values)}")
    # buffer fields are named by function, so names repeat: rename them by place
    named = T.StructType([T.StructField(v, f.dataType) for v, f in zip(values, buffer.fields)])  # noqa: B905
    held = F.col("value").cast(named)
    cols = [held.getField(v).alias(v) for v in values] or [F.col("value").alias("agg_buffer")]
    return state.select(
        F.col(f"key.{key_field}").alias("key"),
        instant_to_ntz(F.col(f"key.{win}.start")).alias("window_start"),
        instant_to_ntz(F.col(f"key.{win}.end")).alias("window_end"),
        *cols)


def read_state_variable(spark: SparkSession, checkpoint: str, name: str, *, batch_id: int | None = None,
                        operator_id: int = 0) -> DataFrame:
    """Rows of one state variable of a ``transformWithState`` query: the grouping key's
    fields, then the variable's - a value state has one row per key, a list state one
    per element, a map state one per entry. State kept in slots (``streaming.bootstrap``),
    whose entries hold columns as arrays, gives one row per packed row instead, without
    the slot and a map's key."""
    r = spark.read.format("statestore").option("operatorId", operator_id).option("stateVarName", name)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    rows = r.load(checkpoint)
    parts = [c for c in ("key", "value", "list_element", "user_map_key", "user_map_value") if c in rows.columns]
    fields = {p: rows.schema[p].dataType.fields for p in parts}
    if "slot" not in rows.schema["key"].dataType.names or not all(isinstance(f.dataType, T.ArrayType) for f in fields[parts[-1]]):
        return rows.select(*[F.col(f"{p}.{f.name}").alias(f.name) for p in parts for f in fields[p]])
    named = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType.elementType) for f in fields[parts[-1]]]))
    packed = F.arrays_zip(*[F.col(f"{parts[-1]}.{f.name}") for f in fields[parts[-1]]]).cast(named)
    return rows.select(*[F.col(f"key.{f.name}") for f in fields["key"] if f.name != "slot"], F.explode(packed).alias("row")).select(
        *[f.name for f in fields["key"] if f.name != "slot"], "row.*")


def publish_state(rows: DataFrame, store, version: int, partitions: int = 4, sources: DataFrame | None = None) -> DataFrame:
    """Publish (key, window_start, window_end, values...), dealt to ``partitions`` snapshot
    tasks by key, as ``version``; returns the pointers."""
    for c, kind in rows.dtypes:
        if kind == "timestamp":
            rows = rows.withColumn(c, instant_to_ntz(c))
    part = F.pmod(F.hash("key"), F.lit(partitions)).cast("int")
    positions = rows.sparkSession.range(partitions).select(
        F.lit(store.changelog_topic).alias("topic"), F.col("id").cast("int").alias("partition"), F.lit(version).alias("version"))
    return store.publish(rows.withColumn("topic", F.lit(store.changelog_topic)).withColumn("partition", part), positions, sources)


def snapshot_state_variable(spark: SparkSession, checkpoint: str, name: str, store, version: int, size_seconds: int, *,
                            partitions: int = 4, batch_id: int | None = None, sources: DataFrame | None = None) -> DataFrame:
    """Publish a value or list variable keyed by (key, window_start), read from the query's
    checkpoint, as a version that :func:`~windlass.streaming.bootstrap.bootstrap_stream` starts from."""
    rows = read_state_variable(spark, checkpoint, name, batch_id=batch_id)
    end = F.timestamp_micros(F.unix_micros("window_start") + F.lit(size_seconds * MICROS))
    return publish_state(rows.withColumn("window_end", end), store, version, partitions, sources)


def snapshot_operator_state(spark: SparkSession, checkpoint: str, store, version: int, values: tuple[str, ...], *,
                            partitions: int = 4, batch_id: int | None = None) -> DataFrame:
    """Publish a stopped or running query's own state, read from its checkpoint, as
    ``version`` of a :class:`~windlass.sources.snapshots.SnapshotStore`; returns the pointers."""
    rows = windowed_state_rows(read_operator_state(spark, checkpoint, batch_id=batch_id), values)
    return publish_state(rows, store, version, partitions)
