"""Keyed record source: RECORD = (topic, partition, offset, ts, key, value).

* batch, from the ``events`` table (the test fixture cut of FIXTURES.md);
* stream, from parquet files (one per micro-batch) or from Kafka.

The Kafka connector jar is not on this image's classpath; the Kafka path is
kept as an option and tested with files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.columns import cents, decode_long, ntz_to_instant
from ..operators import scan
from ..session import table_path

RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.LongType()),
])

RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "events"))


def records_from_events(ev: DataFrame, *, partitions: int = C.FIXTURE_PARTITIONS,
                        topic: str = C.SAMPLE_TOPIC, late_every: int = C.FIXTURE_LATE_EVERY,
                        late_shift_hours: int = C.FIXTURE_LATE_SHIFT_HOURS,
                        span: int | None = None, stream_time: bool = False,
                        offsets: bool = True) -> DataFrame:
    """Cut the keyed topic out of ``events`` (FIXTURES.md, RECORD).

    partition = user_id % partitions; offset = position of the event in its
    partition by event_id (a block-parallel row number: a topic partition
    can hold a large share of the data); every ``late_every``-th event is
    moved ``late_shift_hours`` back in time to make late records; key is
    the user id as a string; value is exact cents.

    ``stream_time=True`` also adds the partition's stream time (running max
    of ts over non-null-key records, by offset) from the same scan: offsets
    and stream time follow the same order, so one block-parallel pass
    yields both. ``offsets=False`` skips the fixture's offset derivation
    for consumers that never read it (on a real topic offsets are a
    physical column and cost nothing; here they cost a scan).
    """
    shifted = F.when(F.col("event_id") % late_every == 0,
                     F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(late_shift_hours))
                     ).otherwise(F.col("ts"))
    base = ev.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id"),
        shifted.alias("ts"),
        F.col("user_id").cast("string").alias("key"),
        cents("value").alias("value"),
    )
    if not offsets and not stream_time:
        return base.select(*[c for c in RECORD_COLUMNS if c != "offset"])
    aggs = [("offset", "count", F.lit(1))]
    if stream_time:
        aggs.append(("stream_time", "max", F.when(F.col("key").isNotNull(), F.col("ts"))))
    out = scan.running(base, ["topic", "partition"], "event_id", aggs, span=span)
    out = out.withColumn("offset", (F.col("offset") - 1).cast("bigint"))
    return out.select(*RECORD_COLUMNS, *(["stream_time"] if stream_time else []))


def read_records(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Batch RECORD over the fixture ``events`` table."""
    return records_from_events(events(spark, sf_dir), **kw)


def stream_records_from_files(spark: SparkSession, path: str, *, max_files_per_trigger: int = 1,
                              event_time_type: str = "timestamp") -> DataFrame:
    """Streaming RECORD from parquet files, ``max_files_per_trigger`` per micro-batch.

    ``ts`` is cast to ``timestamp``: a streaming watermark rejects
    ``timestamp_ntz``. Null keys are skipped, null values fold as 0.
    """
    df = (spark.readStream.schema(RECORD_SCHEMA)
          .option("maxFilesPerTrigger", max_files_per_trigger)
          .parquet(path))
    ts = ntz_to_instant("ts") if event_time_type == "timestamp" else F.col("ts").cast(event_time_type)
    return (df.where(F.col("key").isNotNull())
              .withColumn("value", F.coalesce(F.col("value"), F.lit(0)))
              .withColumn("ts", ts))


def stream_records_from_kafka(spark: SparkSession, bootstrap: str, topic: str = C.SAMPLE_TOPIC, *,
                              starting_offsets: str = "latest",
                              max_offsets_per_trigger: int | None = C.MAX_POLL_RECORDS,
                              options: dict | None = None) -> DataFrame:
    """Streaming RECORD from a Kafka topic with String keys and Long values.

    Needs the spark-sql-kafka connector on the classpath. The long value is
    8-byte big-endian; decoded JVM-side.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("kafka.max.partition.fetch.bytes", str(C.MAX_PARTITION_FETCH_BYTES)))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return decode_kafka_rows(reader.load())


def decode_kafka_rows(raw: DataFrame) -> DataFrame:
    """Kafka source rows (key/value binary, topic, partition, offset,
    timestamp) -> RECORD: String key, Long value (8-byte big-endian),
    decoded JVM-side. Null keys are skipped, null values fold as 0."""
    return (raw.select(
        F.col("topic"), F.col("partition").cast("int"), F.col("offset").cast("bigint"),
        F.col("timestamp").alias("ts"), F.col("key").cast("string").alias("key"),
        F.coalesce(decode_long("value"), F.lit(0)).alias("value"))
        .where(F.col("key").isNotNull()))


def task_events(ev: DataFrame, *, app_id: str = C.SAMPLE_APPLICATION_ID,
                partitions: int = C.FIXTURE_PARTITIONS) -> DataFrame:
    """TASK_EVENT fixture: the restore/standby listener log cut out of events.

    seq = event_id, partition = user_id % partitions, store by user_id % 8
    (two stores per partition), event by event_id % 7, total = event_id % 3.
    """
    names = F.array(*[F.lit(n) for n in C.TASK_EVENTS])
    store = F.when(F.pmod(F.col("user_id"), F.lit(2 * partitions)) < partitions,
                   F.lit("agg-store")).otherwise(F.lit("count-store"))
    return ev.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit(app_id + "-"), store, F.lit("-changelog")).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        store.alias("store"),
        F.element_at(names, (F.pmod(F.col("event_id"), F.lit(len(C.TASK_EVENTS))) + 1).cast("int")).alias("event"),
        F.pmod(F.col("event_id"), F.lit(3)).alias("total"),
    )
