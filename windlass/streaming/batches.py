"""Tables a sink writes one directory of per micro-batch, and reads back whole or not at all."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.snapshots import missing_path


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Overwrite the batch's directory: a batch replayed after a failure (same id, same
    input) rewrites it. A batch without rows still writes its directory."""
    rows.write.mode("overwrite").parquet(batch_path(path, batch_id))


def read_batches(spark: SparkSession, path: str, after: int, upto: int, schema=None) -> DataFrame:
    """Rows of the batches in (after, upto], with their batch_id. Every batch writes its
    directory, so one that is absent was lost: that is an error, never "no rows".
    Without ``schema`` it is read from the files of the last batch."""
    try:
        if schema is None:
            schema = spark.read.parquet(batch_path(path, upto)).schema.add("batch_id", "long")
        if upto <= after:
            return spark.createDataFrame([], schema)
        return (spark.read.schema(schema).option("basePath", path)
                .parquet(*[batch_path(path, b) for b in range(after + 1, upto + 1)]))
    except AnalysisException as e:
        if not missing_path(e):
            raise
        raise FileNotFoundError(f"a batch directory of {path} in ({after}, {upto}] is missing: {e}") from e


def last_batch(spark: SparkSession, path: str) -> int:
    """The highest batch id with a committed directory; -1 if there is none."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    ids = sorted((int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")), reverse=True)
    for batch_id in ids:  # only the newest can lack its mark, so this asks once or twice
        if fs.exists(jvm.org.apache.hadoop.fs.Path(batch_path(path, batch_id), "_SUCCESS")):
            return batch_id
    return -1
