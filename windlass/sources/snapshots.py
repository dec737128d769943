"""Versioned snapshots of windowed state: a sink and a source.

Layout (one function builds it for writer and reader)::

    <path>/<app>/<store>/state/attempt=<id>/task=<t>/part-*.parquet
    <path>/<app>/<store>/sources/attempt=<id>/part-*.parquet
    <path>/<app>/<store>/versions/attempt=<id>/part-*.parquet   manifest rows

A version is a manifest: per task and segment (time slice of the store) the attempt
that wrote the rows and how many there are. ``publish`` writes all of a state;
``publish_changes`` writes the segments that changed and refers to the others where
they lie, so its cost follows what changed, not the state. A version is named by the changelog offset the state stands at, per (topic,
partition). One publish writes one attempt directory: state first, then
how far into the source it reaches, then the manifest rows. Every attempt has a directory of its own, so
nothing that was published is ever overwritten, and a publish that is replayed
after a failure only adds an attempt: per version the newest one counts,
and a half-written attempt has no manifest. A version with no rows gets no pointer
(the empty-snapshot guard; a pointer is the sum of a version's manifest rows). Old
versions are kept.

Readers list the attempts that the wanted manifests name - no more than there were
publishes, or live segments - and join data and manifest as tables. Row counts per
segment must equal the manifest's or the read fails: missing or partial data is
never read as an empty state.

State rows carry any number of value columns (``agg`` in the sample; counts,
sums, ``value_ts``, ... as the aggregation has them). Segments (time slices of
the store) are a sorted column inside an attempt, so a filter on them skips row
groups by their statistics.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.columns import layout_path, layout_path_str, segment_id
from ..operators.offsets import task_id

MANY_POSITIONS = 1_000
ADDRESS = ["topic", "partition"]
KEYS = [*ADDRESS, "key", "window_start", "window_end"]
_META = ["segment_id", "task", "store", "version"]
KEY_SCHEMA = ("topic string, partition int, key string, window_start timestamp_ntz, window_end timestamp_ntz")
DEFAULT_VALUES = "agg bigint"
META_SCHEMA = "segment_id bigint, task string, store string, version bigint"
POINTER = ["app", "task", "store", "topic", "partition", "version"]
VERSION_SCHEMA = ("app string, task string, store string, topic string, partition int, version bigint, path string, "
                  "row_count bigint, offsets map<string,bigint>, published_at timestamp, attempt string")
MANIFEST_SCHEMA = ("app string, task string, store string, topic string, partition int, version bigint, segment_id bigint, "
                   "data_attempt string, data_version bigint, row_count bigint, published_at timestamp, attempt string")
PART = ["task", "topic", "partition", "segment_id"]
DATA_KEYS = [*PART, "data_attempt", "data_version"]
SOURCE_SCHEMA = "topic string, partition int, position bigint, stream_time timestamp_ntz, attempt string"


def value_columns(state: DataFrame) -> list[str]:
    """The columns of a state table that are neither its keys nor its address."""
    return [c for c in state.columns if c not in (*KEYS, *_META, "offset", "attempt")]


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], schema)


def missing_path(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


@dataclass
class SnapshotStore:
    spark: SparkSession
    path: str
    app_id: str
    store: str = C.STORE_NAME
    segment_seconds: int = C.segment_interval_seconds(C.STORE_RETENTION_SECONDS)
    max_records_per_file: int = 5_000_000
    values: str = DEFAULT_VALUES  # schema of the value columns while nothing is published

    @classmethod
    def from_options(cls, spark: SparkSession, opts: C.SnapshotOptions, **kw) -> SnapshotStore:
        return cls(spark, opts.path, opts.app_id, opts.store, opts.segment_seconds, opts.max_records_per_file, **kw)

    def table_path(self, name: str) -> str:
        return layout_path_str(self.path, self.app_id, self.store, name)

    def attempt_path(self, name: str, attempt: str) -> str:
        return layout_path_str(self.table_path(name), f"attempt={attempt}")

    @property
    def changelog_topic(self) -> str:
        return C.changelog_topic(self.app_id, self.store)

    def _addressed(self, df: DataFrame) -> DataFrame:
        return df if "topic" in df.columns else df.withColumn("topic", F.lit(self.changelog_topic))

    # -- sink --------------------------------------------------------------
    def publish(self, state: DataFrame, positions: DataFrame, sources: DataFrame | None = None) -> DataFrame:
        """Write ``state`` (topic, partition, key, window_start, window_end, values...)
        as the versions ``positions`` (topic, partition, version) names, and return
        their pointer rows. Without a topic column both are taken to be of the
        store's changelog topic.

        ``sources`` (topic, partition, position, optional stream_time): how far
        into the source topics the state reaches, to start a stream from it.
        """
        attempt = uuid.uuid4().hex
        schema = self._write_state(state, positions, attempt)
        self._write_sources(sources, attempt)
        # data committed; count what is really there. Manifest last: from here on the attempt can be read
        self._counted(attempt, schema).write.parquet(self.attempt_path("versions", attempt))
        return self._pointers().where(F.col("attempt") == attempt)

    def publish_changes(self, changed: DataFrame, segments: DataFrame, positions: DataFrame, base: DataFrame,
                        sources: DataFrame | None = None, *, least: DataFrame | None = None) -> DataFrame:
        """Publish versions that differ from ``base`` (pointers) in some segments only, and
        return their pointer rows.

        ``segments`` (topic, partition, segment_id): the segments that may differ;
        ``changed``: all state rows these now hold. Other segments are taken over by
        reference - their rows are counted, from the key columns alone, as a version must
        not rest on data that is gone - except those below ``least`` (topic, partition, least_segment), which
        have expired.
        """
        attempt = uuid.uuid4().hex
        schema = self._write_state(changed, positions, attempt)
        self._write_sources(sources, attempt)
        positions = self._positions(positions)
        segments = self._addressed(segments).select(*ADDRESS, "segment_id").distinct()
        kept = self._parts(base)
        if least is not None:
            kept = (kept.join(self._addressed(least).select(*ADDRESS, "least_segment"), ADDRESS, "left")
                    .where(F.col("least_segment").isNull() | (F.col("segment_id") >= F.col("least_segment"))).drop("least_segment"))
        kept = kept.join(segments, [*ADDRESS, "segment_id"], "left_anti")
        if attempts := self._named(kept, "data_attempt"):
            self._complete(kept, self._data(attempts))  # a version must not rest on data that is gone
        kept = (kept.drop("version").join(positions, ADDRESS)
                .withColumn("published_at", F.current_timestamp()))
        manifest = self._counted(attempt, schema)
        (manifest.unionByName(kept.select(*manifest.columns)).coalesce(1)
         .write.parquet(self.attempt_path("versions", attempt)))
        return self._pointers().where(F.col("attempt") == attempt)

    def _positions(self, positions: DataFrame) -> DataFrame:
        return self._addressed(positions).select(*ADDRESS, F.col("version").cast("bigint").alias("version"))

    def _write_state(self, state: DataFrame, positions: DataFrame, attempt: str) -> T.StructType:
        state = self._addressed(state)
        values = value_columns(state)
        rows = (state.join(self._positions(positions), ADDRESS)
                .select(*KEYS, *values, segment_id("window_start", self.segment_seconds).alias("segment_id"),
                        task_id().alias("task"), F.lit(self.store).alias("store"), "version"))
        # rebalance: AQE sizes the write tasks (splits a big task, merges small
        # ones); rows are clustered by segment inside each file
        (rows.hint("rebalance", "task").sortWithinPartitions("task", "topic", "segment_id", "key", "window_start")
             .write.option("maxRecordsPerFile", self.max_records_per_file).partitionBy("task")
             .parquet(self.attempt_path("state", attempt)))
        return rows.schema

    def _write_sources(self, sources: DataFrame | None, attempt: str) -> None:
        if sources is not None:
            time = F.col("stream_time") if "stream_time" in sources.columns else F.lit(None)
            (sources.select(*ADDRESS, F.col("position").cast("bigint").alias("position"),
                            time.cast("timestamp_ntz").alias("stream_time"))
                    .write.parquet(self.attempt_path("sources", attempt)))

    def _counted(self, attempt: str, schema: T.StructType) -> DataFrame:
        """Manifest rows of what an attempt wrote."""
        return (self._attempts([attempt], schema).groupBy("task", "store", *ADDRESS, "version", "segment_id")
                .agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit(self.app_id).alias("app"), "task", "store", *ADDRESS, "version", "segment_id",
                        F.lit(attempt).alias("data_attempt"), F.col("version").alias("data_version"), "row_count",
                        F.current_timestamp().alias("published_at")))

    # -- source ------------------------------------------------------------
    def _manifests(self) -> DataFrame:
        return read_or_empty(self.spark, self.table_path("versions"), MANIFEST_SCHEMA)

    def _pointers(self) -> DataFrame:
        """One row per version and attempt: its manifest rows added up."""
        path = layout_path(F.lit(self.table_path("state")), F.concat(F.lit("attempt="), "attempt"),
                           F.concat(F.lit("task="), "task"))
        return (self._manifests().groupBy(*POINTER, "attempt")
                .agg(F.sum("row_count").cast("bigint").alias("row_count"), F.max("published_at").alias("published_at"))
                .select(*POINTER, path.alias("path"), "row_count",
                        F.create_map(F.concat("topic", F.lit("-"), F.col("partition").cast("string")),
                                     F.col("version")).alias("offsets"), "published_at", "attempt"))

    def _parts(self, pointer: DataFrame | None) -> DataFrame:
        """Manifest rows of the pointed versions (default: the latest, found by one aggregate
        of the manifests)."""
        if pointer is None:
            by = ["app", "task", "store", "topic", "partition"]
            rows = self._manifests()
            best = rows.groupBy(*by).agg(F.max(F.struct("published_at", "version", "attempt")).alias("b")).select(
                *by, F.col("b.version").alias("version"), F.col("b.attempt").alias("attempt"))
            return rows.join(best, [*by, "version", "attempt"])
        keys = ["attempt", "task", "topic", "partition", "version"]
        return self._manifests().join(pointer.select(*keys), keys, "left_semi")

    def versions(self) -> DataFrame:
        """One pointer row per published version (of replayed publishes the newest)."""
        rest = [c.split()[0] for c in VERSION_SCHEMA.split(", ") if c.split()[0] not in POINTER]
        newest = F.max_by(F.struct(*rest), F.struct("published_at", "attempt"))
        return self._pointers().groupBy(*POINTER).agg(newest.alias("p")).select(*POINTER, "p.*")

    def latest(self) -> DataFrame:
        """Newest published version per (app, task, store, topic)."""
        by = ["app", "task", "store", "topic", "partition"]
        rest = [c.split()[0] for c in VERSION_SCHEMA.split(", ") if c.split()[0] not in by]
        best = F.max_by(F.struct(*rest), F.struct("published_at", "version"))
        return self.versions().groupBy(*by).agg(best.alias("p")).select(*by, "p.*")

    def at(self, version: int) -> DataFrame:
        """Per task the highest version at or below ``version``."""
        by = ["app", "task", "store", "topic", "partition"]
        rest = [c.split()[0] for c in VERSION_SCHEMA.split(", ") if c.split()[0] not in by]
        best = F.max_by(F.struct(*rest), "version")
        return (self.versions().where(F.col("version") <= version).groupBy(*by).agg(best.alias("p"))
                    .select(*by, "p.*"))

    def read(self, pointer: DataFrame | None = None, *, verify: bool = True) -> DataFrame:
        """State rows of the versions named by ``pointer`` (default: the latest)."""
        return self.open(pointer, verify=verify)[0]

    def open(self, pointer: DataFrame | None = None, *, verify: bool = True,
             segments: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """(state rows, positions) of the pointed versions; positions (topic,
        partition, version). With ``verify``, rows per segment must equal the manifest's.
        ``segments`` (topic, partition, segment_id) limits the rows, and what is read, to those."""
        wanted = self._parts(pointer).select(*PART, "version", "attempt", "data_attempt", "data_version", "row_count")
        few = wanted.limit(MANY_POSITIONS + 1).toArrow()
        positions = wanted.select(*ADDRESS, "version").distinct()
        if few.num_rows <= MANY_POSITIONS:  # a handful of rows: look them up once, not per join
            wanted = self.spark.createDataFrame(few, wanted.schema)
            held = few.group_by([*ADDRESS, "version"]).aggregate([]).select([*ADDRESS, "version"])
            positions = self.spark.createDataFrame(held, positions.schema)
        if segments is not None:
            wanted = wanted.join(self._addressed(segments), [*ADDRESS, "segment_id"], "left_semi")
            few = wanted.limit(MANY_POSITIONS + 1).toArrow()
        attempts = (sorted(set(few["data_attempt"].to_pylist())) if few.num_rows <= MANY_POSITIONS
                    else self._named(wanted, "data_attempt"))
        if not attempts:
            empty = ", ".join([KEY_SCHEMA, self.values, META_SCHEMA, "attempt string"])
            return self.spark.createDataFrame([], empty), positions
        data = self._data(attempts)
        if verify:
            self._complete(wanted, data)
        rows = data.join(wanted.select(*DATA_KEYS, "version", "attempt"), DATA_KEYS).drop("data_attempt", "data_version")
        return rows.select(*KEYS, *value_columns(rows), *[c for c in rows.columns if c in (*_META, "attempt")]), positions

    def segments(self, pointer: DataFrame | None = None) -> DataFrame:
        """(topic, partition, segment_id, row_count, data_attempt): what the pointed versions
        consist of, and the publish that wrote each part."""
        return self._parts(self.latest() if pointer is None else pointer).select(
            *ADDRESS, "segment_id", "row_count", "data_attempt")

    def sources(self, pointer: DataFrame | None = None) -> DataFrame:
        """(topic, partition, position, stream_time): how far into the source topics the
        pointed versions reach; where several attempts are named, the furthest."""
        pointer = self.latest() if pointer is None else pointer
        attempts = self._named(pointer)
        rows = read_or_empty(self.spark, self.table_path("sources"), SOURCE_SCHEMA).where(
            F.col("attempt").isin(attempts))
        return rows.groupBy(*ADDRESS).agg(F.max("position").alias("position"), F.max("stream_time").alias("stream_time"))

    def offsets(self, pointer: DataFrame | None = None) -> DataFrame:
        """OFFSETS of the pointed versions: the remote checkpoint of each task."""
        pointer = self.latest() if pointer is None else pointer
        return pointer.select("app", "task", "store", "topic", "partition", F.col("version").alias("offset"))

    def files(self, pointer: DataFrame | None = None) -> DataFrame:
        """Manifest: every data file of the pointed attempts with its size and
        time; file contents are not read."""
        attempts = self._named(self._parts(self.latest() if pointer is None else pointer), "data_attempt")
        if not attempts:
            return self.spark.createDataFrame(
                [], "path string, length long, modificationTime timestamp, attempt string, task string")
        return (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                .option("basePath", self.table_path("state"))
                .load([self.attempt_path("state", a) for a in attempts])
                .select("path", "length", "modificationTime", "attempt", "task"))

    def manifest(self, pointer: DataFrame | None = None) -> DataFrame:
        """The files joined to the rows they hold: one row per file, task, version and
        segment, with size, row count and window range."""
        pointer = self.latest() if pointer is None else pointer
        self.read(pointer)  # complete, or it raises
        parts = self._parts(pointer)
        attempts = self._named(parts, "data_attempt")
        if not attempts:
            data = (self.read(pointer).withColumn("__file", F.lit("")).withColumn("data_version", F.col("version"))
                    .withColumnRenamed("attempt", "data_attempt").drop("version"))
        else:
            data = (self._attempts(attempts).withColumn("__file", _file_key(F.col("_metadata.file_path")))
                    .withColumnsRenamed({"attempt": "data_attempt", "version": "data_version"}))
        held = (data.join(parts.select(*DATA_KEYS, "version"), DATA_KEYS).groupBy("__file", "task", "version", "segment_id")
                    .agg(F.count(F.lit(1)).alias("rows"), F.min("window_start").alias("min_window_start"),
                         F.max("window_start").alias("max_window_start"),
                         *[F.sum(c).cast("bigint").alias(c) for c in ("agg",) if c in data.columns]))
        files = self.files(pointer).withColumn("__file", _file_key(F.col("path")))
        return held.join(files.select("__file", "path", "length", "modificationTime"), "__file").drop("__file")

    def _data(self, attempts: list[str]) -> DataFrame:
        return self._attempts(attempts).withColumnsRenamed({"attempt": "data_attempt", "version": "data_version"})

    @staticmethod
    def _complete(parts: DataFrame, data: DataFrame) -> None:
        """Raise unless ``data`` has as many rows of each part as its manifest says."""
        have = data.groupBy(*DATA_KEYS).agg(F.count(F.lit(1)).alias("found"))
        bad = (parts.join(have, DATA_KEYS, "left").where(~F.col("row_count").eqNullSafe(F.col("found")))
                    .select(*DATA_KEYS, "row_count", "found").limit(5).collect())
        if bad:
            raise FileNotFoundError(f"snapshot data missing or partial, for example {bad}")

    # -- helpers -------------------------------------------------------------
    @staticmethod
    def _named(rows: DataFrame, column: str = "attempt") -> list[str]:
        """The attempts that rows name: one per publish at most, however many tasks it had."""
        return sorted(r[column] for r in rows.select(column).distinct().collect())

    def _attempts(self, attempts: list[str], schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.option("basePath", self.table_path("state")).parquet(
                *[self.attempt_path("state", a) for a in attempts])
        except AnalysisException as e:
            if schema is not None and "UNABLE_TO_INFER" not in str(e) and not missing_path(e):
                raise
            raise FileNotFoundError(f"snapshot data missing for an attempt of {attempts}") from e


def _file_key(path):
    """A data file by its attempt, task and name, however its URI is written."""
    return F.regexp_extract(path, r"(attempt=.*)$", 1)


def tail_filter(positions: DataFrame):
    """Condition that a changelog row lies past its partition's position, for the
    scan to push down; None beyond ``MANY_POSITIONS`` partitions, where the join
    with the positions alone does the cut."""
    rows = positions.select(*ADDRESS, "version").limit(MANY_POSITIONS + 1).collect()
    if not rows or len(rows) > MANY_POSITIONS:
        return None
    past = known = F.lit(False)
    for r in rows:
        here = (F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"])
        past, known = past | (here & (F.col("offset") > r["version"])), known | here
    return past | ~known
