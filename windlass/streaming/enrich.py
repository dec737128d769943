"""Enrich a stream from replicated tables.

A replicated table is small enough, usually, for every task to hold, and changes while
the stream runs. :class:`ReplicatedTable` keeps copies of it: the copy a batch uses is
the one taken at the last batch whose id is a multiple of ``refresh_every``, in a
directory named by that id. It is written once and only read afterwards, so a batch
replayed after a failure, or in a new process, sees the table its first run saw.

The rows of a copy are counted: up to ``broadcast_rows`` of them it is broadcast,
beyond that the join is dealt by key and left to Spark. Rows of the stream are never
dropped: without a match the table's columns are null, and of several rows of a key
in the table the one that ``order`` says is last counts, as in a keyed table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import batch_path, write_batch

BROADCAST_ROWS = 100_000


@dataclass
class ReplicatedTable:
    spark: SparkSession
    path: str  # of the copies, in the shared folder
    load: Callable[[], DataFrame]  # the table as it is now
    keys: list[str]
    order: str | None = None  # of rows that share a key, the highest counts; else the first as Spark meets them
    refresh_every: int = 1  # batches
    broadcast_rows: int = BROADCAST_ROWS
    _rows: dict[int, int] = field(default_factory=dict, repr=False)

    def version(self, batch_id: int) -> int:
        return batch_id - batch_id % self.refresh_every

    def _written(self, version: int) -> bool:
        jvm = self.spark.sparkContext._jvm
        mark = jvm.org.apache.hadoop.fs.Path(batch_path(self.path, version), "_SUCCESS")
        return mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)

    def _keyed(self, table: DataFrame) -> DataFrame:
        """One row per key; rows without a key match nothing and go."""
        rest = [c for c in table.columns if c not in self.keys]
        for k in self.keys:
            table = table.where(F.col(k).isNotNull())
        if self.order is None:
            return table.groupBy(*self.keys).agg(F.first(F.struct(*rest)).alias("__r")).select(*self.keys, "__r.*")
        return (table.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), self.order).alias("__r")).select(*self.keys, "__r.*"))

    def at(self, batch_id: int) -> DataFrame:
        """The copy that a batch uses; taken now if this is the first batch to use it."""
        version = self.version(batch_id)
        if not self._written(version):
            write_batch(self._keyed(self.load()), self.path, version)
        return self.spark.read.parquet(batch_path(self.path, version))

    def join(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """``rows`` with the table's columns, as the batch sees the table."""
        table = self.at(batch_id)
        version = self.version(batch_id)
        if version not in self._rows:
            self._rows = {version: table.count()}  # one count per copy
        if self._rows[version] <= self.broadcast_rows:
            table = F.broadcast(table)
        return rows.join(table, self.keys, "left")


@dataclass
class EnrichSink:
    """foreachBatch function: each batch joined with the tables, in order, into a directory of its own."""

    path: str
    tables: list[ReplicatedTable]
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.prepare(batch)
        for table in self.tables:
            rows = table.join(rows, batch_id)
        write_batch(rows, self.path, batch_id)
