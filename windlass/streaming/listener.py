"""Query lifecycle events and live lag, from StreamingQueryListener.

Events go to a table of JSON lines, appended ``flush_every`` at a time, so the
driver holds a bounded number of them however long a query lives.
:meth:`QueryEvents.frame` and :meth:`QueryEvents.lag_frame` read the table back
for one query.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import scratch_dir
from ..sources.snapshots import read_or_empty

EVENT_SCHEMA = ("event string, query_id string, run_id string, name string, batch_id long, "
                "input_rows long, timestamp string, sources string")
LAG_SCHEMA = ("query_id string, batch_id long, source string, topic string, partition int, end_offset long, "
              "latest_offset long, lag long, input_rows long")


class QueryEvents(StreamingQueryListener):
    """Collect started / progress / idle / terminated events of all queries of a session."""

    def __init__(self, spark: SparkSession, path: str | None = None, flush_every: int = 200) -> None:
        self.spark, self.flush_every = spark, flush_every
        self.path = path or scratch_dir(spark, "query-events")
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()
        self._writing = threading.Lock()

    def _add(self, *row) -> None:
        """Keep an event; a full set is in the table before the run's end is announced."""
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self.flush_every
        try:
            if full:
                self._flush()
        finally:
            if row[0] == "terminated":
                with self._changed:
                    self._ended.add(row[2])
                    self._changed.notify_all()

    def _flush(self) -> None:
        """Write the events held. One writer at a time, and they are let go only once
        written: a failed write loses none, the next one takes them along."""
        with self._writing:
            with self._changed:
                rows = list(self._rows)
            if rows:
                self._write(rows)
                with self._changed:
                    del self._rows[:len(rows)]

    def _write(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self._add("started", str(event.id), str(event.runId), event.name, None, None, event.timestamp, None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add("progress", str(p.id), str(p.runId), p.name, p.batchId, p.numInputRows, p.timestamp,
                  json.dumps(json.loads(p.json).get("sources", [])))

    def onQueryIdle(self, event) -> None:
        self._add("idle", str(event.id), str(event.runId), None, None, None, event.timestamp, None)

    def onQueryTerminated(self, event) -> None:
        self._add("terminated", str(event.id), str(event.runId), None, None, None, None, None)

    def wait_terminated(self, run_id: str, timeout: float = 600.0) -> None:
        """Wait for the last event of a run (events arrive after the query has ended);
        raises if it doesn't come, as the table would then be incomplete."""
        with self._changed:
            if not self._changed.wait_for(lambda: run_id in self._ended, timeout):
                raise TimeoutError(f"no terminated event of run {run_id} after {timeout:g} s")

    def frame(self, query_id: str | None = None) -> DataFrame:
        """Events so far, of one query or of all."""
        self._flush()
        events = read_or_empty(self.spark, self.path, EVENT_SCHEMA)
        return events if query_id is None else events.where(F.col("query_id") == query_id)

    def lag_frame(self, query_id: str | None = None) -> DataFrame:
        """Per progress report, source, topic and partition: how far the query is behind."""
        sources = "array<struct<description string, endOffset string, latestOffset string, numInputRows bigint>>".replace(
            " string", ": string").replace(" bigint", ": bigint")
        src = (self.frame(query_id).where("event = 'progress'")
               .select("query_id", "batch_id", F.explode(F.from_json("sources", sources)).alias("s")))
        offsets = "map<string,map<string,bigint>>"
        end = (src.select("query_id", "batch_id", F.col("s.description").alias("source"),
                          F.col("s.numInputRows").alias("input_rows"), F.col("s.latestOffset").alias("latest"),
                          F.explode_outer(F.from_json("s.endOffset", offsets)).alias("topic", "parts"))
               .select("*", F.explode_outer("parts").alias("p", "end_offset")))
        latest = F.from_json("latest", offsets)[F.col("topic")][F.col("p")]
        return end.select("query_id", "batch_id", "source", "topic", F.col("p").cast("int").alias("partition"), "end_offset",
                          latest.alias("latest_offset"), (latest - F.col("end_offset")).alias("lag"), "input_rows")


def attach(spark: SparkSession, path: str | None = None) -> QueryEvents:
    """Install a collector on the session."""
    listener = QueryEvents(spark, path)
    spark.streams.addListener(listener)
    return listener
