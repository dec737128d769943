"""The restore scenario the registered snapshot/restore queries replay.

All of it is derived from the fixture ``events`` through RECORD and the
store's CHANGELOG, so its work grows with the data:

* a flush follows every update (cache off, commit interval 0); a flush
  snapshots when the deterministic 1-in-20 sample picks it;
* snapshots are published at two event-time cuts; the version of a
  partition is its last sampled flush before the cut;
* the "local" instance stopped at an earlier cut and lost the state
  directory of some partitions (no local checkpoint there).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import sampled
from ..operators import lateness, scan
from ..operators.offsets import task_id
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sources.records import read_records
from ..sources.snapshots import SnapshotStore


@dataclass(frozen=True)
class Scenario:
    snapshot_cuts: tuple[str, ...] = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
    local_cut: str = "2024-01-05 00:00:00"
    lost_partitions: tuple[int, ...] = (2,)
    every_n: int = C.DEFAULT_SNAPSHOT_FREQUENCY


SCENARIO = Scenario()
CHANGELOG_BLOCK = 1 << 16  # offsets of one partition that are written together


def flush_id(partition: str = "partition", offset: str = "offset"):
    return F.concat(F.col(partition).cast("string"), F.lit(":"), F.col(offset).cast("string"))


def before(cut: str):
    return F.col("ts") < F.lit(cut).cast("timestamp_ntz")


def snapshot_flushes(changelog: DataFrame, every_n: int = C.DEFAULT_SNAPSHOT_FREQUENCY) -> DataFrame:
    """Flushes the sampler picks for a snapshot."""
    return changelog.where(sampled(flush_id(), every_n))


def snapshot_positions(changelog: DataFrame, cut: str, every_n: int = C.DEFAULT_SNAPSHOT_FREQUENCY) -> DataFrame:
    """(partition, version): last sampled flush before ``cut`` per partition."""
    return (snapshot_flushes(changelog, every_n).where(before(cut))
            .groupBy("topic", "partition").agg(F.max("offset").alias("version")))


def materialized_changelog(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Derive the store's changelog once and keep it as a table in the
    shared folder (it is the changelog topic; later steps read it instead
    of recomputing the lineage)."""
    path = f"{root}/changelog"
    # dealt by blocks of offsets and sorted: every file and row group covers tight
    # offset ranges, so a tail read skips the old ones, and a hot partition is
    # spread over many writers; no range sampling, so the lineage runs once
    block = scan.block_of("offset", CHANGELOG_BLOCK)
    (lateness.changelog(read_records(spark, sf, stream_time=True))
        .repartition("partition", block).sortWithinPartitions("partition", "offset")
        .write.partitionBy("partition").parquet(path))
    return spark.read.parquet(path)


def publish_snapshots(spark: SparkSession, sf: str, sc: Scenario = SCENARIO) -> tuple[SnapshotStore, DataFrame]:
    """Publish one version per cut into a fresh store; returns (store,
    changelog)."""
    from ..operators.restore import state_as_of
    root = scratch_dir(spark, "scenario")
    cl = materialized_changelog(spark, sf, root)
    store = SnapshotStore(spark, f"{root}/snapshots", C.SAMPLE_APPLICATION_ID)
    for cut in sc.snapshot_cuts:
        pos = snapshot_positions(cl, cut, sc.every_n)
        store.publish(state_as_of(cl, pos), pos)
    return store, cl


def checkpoint_table(changelog: DataFrame, sc: Scenario = SCENARIO) -> DataFrame:
    """One pass over the changelog: per store partition, the offset the
    stopped local instance checkpointed (none for lost partitions), the
    newest snapshot version (remote) and the log end. Local, remote and
    end OFFSETS are all cut from this one small aggregate, so the
    changelog is derived once and its exchange shared."""
    lost = [int(p) for p in sc.lost_partitions]
    local_cond = before(sc.local_cut) & ~F.col("partition").isin(lost)
    remote_cond = sampled(flush_id(), sc.every_n) & before(sc.snapshot_cuts[-1])
    return (changelog.groupBy("topic", "partition", "store")
            .agg(F.max(F.when(local_cond, F.col("offset"))).alias("local_offset"),
                 F.max(F.when(remote_cond, F.col("offset"))).alias("remote_offset"),
                 (F.max("offset") + 1).alias("end_offset"))
            .select(F.lit(C.SAMPLE_APPLICATION_ID).alias("app"), task_id().alias("task"), "store", "topic",
                    "partition", "local_offset", "remote_offset", "end_offset"))


_KEYS = ["app", "task", "store", "topic", "partition"]


def offset_tables(changelog: DataFrame, sc: Scenario = SCENARIO) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(local, remote, end) OFFSETS from one pass over the changelog.

    The shared table has one row per store partition; it is materialized
    once with a reliable ``checkpoint()`` (shared checkpoint folder), so
    the decision, merge and lag joins - which read it several times - do
    not re-run the scan over the records for each read."""
    ensure_checkpoint_dir(changelog.sparkSession)
    t = checkpoint_table(changelog, sc).checkpoint(eager=True)
    local = t.where(F.col("local_offset").isNotNull()).select(*_KEYS, F.col("local_offset").alias("offset"))
    remote = t.where(F.col("remote_offset").isNotNull()).select(*_KEYS, F.col("remote_offset").alias("offset"))
    end = t.select(*_KEYS, "end_offset")
    return local, remote, end
