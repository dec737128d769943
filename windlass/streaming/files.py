"""File-backed micro-batches: RECORD cut into parquet files, several per batch.

Stands in for a Kafka topic where the connector is absent: every batch has
exactly ``files`` files, so the file source with ``maxFilesPerTrigger=files``
turns it into one micro-batch, in the order the batches were written; every
topic partition's records arrive in offset order across batches. Each file is
written, and later read, by a task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.records import RECORD_COLUMNS


def write_record_batches(records: DataFrame, path: str, batches: int, files: int | None = None) -> int:
    """Write ``records`` as ``batches`` batches cut by offset range (the same
    fraction of every partition per batch) and return the files per batch
    (``files``, by default the session's parallelism, at most as many as a batch has offsets).

    The cut is staged once, partitioned by batch, then each batch is copied to
    ``path`` by a job of its own; jobs run in order, so file times follow batch
    order. File ``k`` of a batch takes the k-th slice of its offsets, so no file
    is empty. A real topic has no such step.
    """
    spark = records.sparkSession
    stage = path.rstrip("/") + "_staged"
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("__end"))
    cut = F.col("offset") * batches
    (records.join(ends, ["topic", "partition"])
            .withColumn("__b", F.floor(cut / F.col("__end")).cast("int"))
            .withColumn("__rest", cut % F.col("__end"))
            .select(*RECORD_COLUMNS, "__rest", "__end", "__b")
            .write.partitionBy("__b").parquet(stage))
    staged = spark.read.parquet(stage)
    longest = staged.agg(F.max("__end")).first()[0] or 0
    files = max(1, min(files or spark.sparkContext.defaultParallelism, longest // batches))
    slot = F.floor(F.col("__rest") * files / F.col("__end")).cast("int")
    for b in range(batches):
        (staged.where(F.col("__b") == b).withColumn("__f", slot).repartitionById(files, F.col("__f"))
               .select(*RECORD_COLUMNS).write.mode("append").parquet(path))
    return files
