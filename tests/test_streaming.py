"""Streaming forms, end to end with a file source (several files per batch)."""

import json
import os
import shutil
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from windlass import config as C
from windlass.functions.columns import instant_to_ntz
from windlass.operators import lateness, windows
from windlass.sources.records import read_records, stream_records_from_files
from windlass.sources.snapshots import SnapshotStore
from windlass.sources.state_reader import (read_operator_state, snapshot_operator_state, state_metadata,
                                           windowed_state_rows)
from windlass.streaming import listener
from windlass.streaming.batches import last_batch, write_batch
from windlass.streaming.bootstrap import bootstrap_stream, fold_stream
from windlass.streaming.files import write_record_batches
from windlass.streaming.snapshot_sink import SnapshotSink
from windlass.streaming.strict import StrictWindowSink
from windlass.streaming.windowed import ROCKSDB_PROVIDER, for_each_update, windowed_stream

BATCHES = 4
APP = "app"
RECORD = "topic string, partition int, offset long, ts timestamp_ntz, key string, value long"


@pytest.fixture(scope="module")
def batches(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="windlass-stream-")
    recs = read_records(spark, SF001)
    files = write_record_batches(recs, f"{root}/in", BATCHES, 3)
    return root, recs, files


def source(spark, batches, **kw):
    root, _, files = batches
    return stream_records_from_files(spark, f"{root}/in", max_files_per_trigger=files, **kw)


def _as_map(df, cols=("key", "window_start"), val="agg"):
    return {tuple(r[c] for c in cols): r[val] for r in df.collect()}


def test_every_batch_is_written_by_several_tasks(spark, batches):
    root, recs, files = batches
    assert files == 3
    names = [f for f in os.listdir(f"{root}/in") if f.endswith(".parquet")]
    assert len(names) == BATCHES * files
    assert all(spark.read.parquet(f"{root}/in/{n}").count() > 0 for n in names)
    assert spark.read.parquet(f"{root}/in").exceptAll(recs).count() == 0
    seen = []
    for_each_update(source(spark, batches), lambda df, i: seen.append((i, df.rdd.getNumPartitions(), df.count())),
                    f"{root}/count_ckpt", output_mode="append", available_now=True).awaitTermination()
    assert [i for i, _, _ in seen] == list(range(BATCHES)) and sum(n for _, _, n in seen) == recs.count()


def test_tiny_input_has_fewer_files(spark, tmp_root):
    recs = spark.createDataFrame([("t", 0, i, None, "k", 1) for i in range(8)], RECORD)
    assert write_record_batches(recs, f"{tmp_root}/in", 4, 100) == 2
    assert len([f for f in os.listdir(f"{tmp_root}/in") if f.endswith(".parquet")]) == 8


def test_strict_stream_equals_batch_rule(spark, batches):
    root, recs, _ = batches
    store = SnapshotStore(spark, f"{root}/strict_snap", APP)
    sink = StrictWindowSink(spark, f"{root}/strict", every_n=2, store=store)
    src = source(spark, batches, event_time_type="timestamp_ntz")
    for_each_update(src, sink, f"{root}/strict_ckpt", output_mode="append", available_now=True).awaitTermination()
    expect = _as_map(lateness.strict_late_drop(read_records(spark, SF001, stream_time=True)))
    assert _as_map(sink.state()) == expect
    # a snapshot was published on even batches and restores to the same state
    assert {r["version"] for r in store.versions().collect()} == {0, 2}
    # replaying a batch (same id, same input) changes nothing, nor does publishing its version again
    names = sorted(f for f in os.listdir(f"{root}/in") if f.endswith(".parquet"))
    per = sorted(names, key=lambda n: os.path.getmtime(f"{root}/in/{n}"))[2 * 3:3 * 3]
    sink(spark.read.parquet(*[f"{root}/in/{n}" for n in per]).where("key is not null"), 2)
    assert _as_map(sink.state()) == expect
    assert store.versions().count() == len({(r["task"], r["version"]) for r in store.versions().collect()})


def test_strict_sink_fails_closed(spark, batches, tmp_root):
    root, recs, _ = batches
    sink = StrictWindowSink(spark, f"{tmp_root}/s")
    part = [recs.where((F.col("offset") % 3) == 0).where("key is not null"), recs.limit(0), recs.limit(0)]
    for i, rows in enumerate(part):
        sink(rows, i)
    whole = _as_map(sink.state())
    assert whole  # batches without rows are no loss
    shutil.move(f"{sink.delta_path}/batch_id=1", f"{tmp_root}/kept")
    with pytest.raises(FileNotFoundError):
        sink.state()
    shutil.move(f"{tmp_root}/kept", f"{sink.delta_path}/batch_id=1")
    assert _as_map(sink.state()) == whole
    # a batch whose predecessor left no carry must not start from an empty one
    with pytest.raises(FileNotFoundError):
        sink(recs.limit(0), 9)
    assert last_batch(spark, sink.delta_path) == 2


def test_short_base_version_stops_a_compaction(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = StrictWindowSink(spark, f"{tmp_root}/s", every_n=0, store=store)
    rows = read_records(spark, SF001).where("key is not null")
    sink(rows.where("offset < 100"), 0)
    sink.snapshot(0)
    sink(rows.where("offset >= 100"), 1)
    good = _as_map(sink.state())
    assert good == _as_map(lateness.strict_late_drop(lateness.with_stream_time(rows)))
    attempt = store.latest().first()["attempt"]
    path = store.attempt_path("state", attempt)
    data = spark.read.parquet(path)
    fewer = spark.createDataFrame(data.collect()[1:], data.schema)
    fewer.write.mode("overwrite").partitionBy("task").parquet(path)
    with pytest.raises(FileNotFoundError):
        sink.state()
    with pytest.raises(FileNotFoundError):
        sink.snapshot(1)


def hand(spark, rows):
    import datetime as dt
    return spark.createDataFrame([(t, p, o, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), k, v)
                                  for t, p, o, s, k, v in rows], RECORD)


def test_topics_that_share_a_partition_number(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = StrictWindowSink(spark, f"{tmp_root}/s", every_n=1, store=store)
    sink(hand(spark, [("t1", 0, 0, 5, "a", 5), ("t2", 0, 0, 6, "b", 7)]), 0)
    got = lambda: sorted((r["topic"], r["key"], r["agg"]) for r in sink.state().collect())
    assert got() == [("t1", "a", 5), ("t2", "b", 7)]
    sink(hand(spark, [("t1", 0, 1, 7, "a", 1)]), 1)
    assert got() == [("t1", "a", 6), ("t2", "b", 7)]


def test_versions_that_differ_between_tasks_add_no_delta_twice(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = StrictWindowSink(spark, f"{tmp_root}/s", every_n=0, store=store)
    sink(hand(spark, [("t", 0, 0, 5, "a", 5), ("t", 1, 0, 6, "b", 7)]), 0)
    sink.snapshot(0)
    sink(hand(spark, [("t", 0, 1, 8, "a", 1), ("t", 1, 1, 9, "b", 2)]), 1)
    # only partition 1 gets a version of batch 1
    pos = spark.createDataFrame([("t", 1, 1)], "topic string, partition int, version long")
    store.publish(sink.state(1).where("partition = 1"), pos)
    sink(hand(spark, [("t", 0, 2, 10, "a", 1), ("t", 1, 2, 11, "b", 4)]), 2)
    assert sorted((r["key"], r["agg"]) for r in sink.state().collect()) == [("a", 7), ("b", 13)]


def test_strict_sink_resumes_from_a_version_of_another_query(spark, batches, tmp_root):
    """Stop after two batches, start a new query with a new checkpoint from the published
    version, fed the whole input again: equal to the run that was never stopped."""
    root, recs, _ = batches
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    first = StrictWindowSink(spark, f"{tmp_root}/first", every_n=1, store=store)
    first(recs.where("key is not null and offset < 100"), 0)
    again = StrictWindowSink(spark, f"{tmp_root}/second", every_n=2, store=SnapshotStore(spark, f"{tmp_root}/snap2", APP),
                             resume=store)
    src = source(spark, batches, event_time_type="timestamp_ntz")
    for_each_update(src, again, f"{tmp_root}/ckpt", output_mode="append", available_now=True).awaitTermination()
    expect = _as_map(lateness.strict_late_drop(read_records(spark, SF001, stream_time=True)))
    assert _as_map(again.state()) == expect
    assert _as_map(StrictWindowSink(spark, f"{tmp_root}/second", resume=store).state()) == expect


def test_strict_stream_restarts_from_its_checkpoint(spark, tmp_root):
    recs = read_records(spark, SF001)
    files = write_record_batches(recs, f"{tmp_root}/all", 4, 2)
    names = sorted((f for f in os.listdir(f"{tmp_root}/all") if f.endswith(".parquet")),
                   key=lambda n: os.path.getmtime(f"{tmp_root}/all/{n}"))
    os.makedirs(f"{tmp_root}/in")
    sink = StrictWindowSink(spark, f"{tmp_root}/s", every_n=2, store=SnapshotStore(spark, f"{tmp_root}/snap", APP))
    for part in (names[:files * 2], names[files * 2:]):  # the query ends and is started again
        for n in part:
            shutil.copy2(f"{tmp_root}/all/{n}", f"{tmp_root}/in/{n}")
        src = stream_records_from_files(spark, f"{tmp_root}/in", max_files_per_trigger=files, event_time_type="timestamp_ntz")
        for_each_update(src, sink, f"{tmp_root}/ckpt", output_mode="append", available_now=True).awaitTermination()
    assert last_batch(spark, sink.delta_path) == 3
    assert _as_map(sink.state()) == _as_map(lateness.strict_late_drop(read_records(spark, SF001, stream_time=True)))


def test_update_stream_snapshots_restore(spark, batches):
    root, recs, _ = batches
    store = SnapshotStore(spark, f"{root}/upd_snap", APP)
    sink = SnapshotSink(spark, f"{root}/upd", store, every_n=2)
    updates = []

    def both(df, batch_id):
        updates.extend(tuple(r) for r in df.select("key", instant_to_ntz("window_start"), "agg").collect())
        sink(df, batch_id)

    q = for_each_update(windowed_stream(source(spark, batches), 3600, addresses=True), both, f"{root}/upd_ckpt", available_now=True)
    q.awaitTermination()
    last = {}
    for k, w, a in updates:
        last[(k, w)] = a
    assert _as_map(sink.state()) == last
    assert store.versions().count() > 0
    # a lost changelog batch is an error
    shutil.move(f"{sink.changelog_path}/batch_id=3", f"{root}/kept3")
    with pytest.raises(FileNotFoundError):
        sink.state(upto=3)
    shutil.move(f"{root}/kept3", f"{sink.changelog_path}/batch_id=3")
    assert _as_map(sink.state()) == last
    # offline: the operator's own state store agrees with the update rows, and can be published
    ckpt = f"{root}/upd_ckpt"
    assert state_metadata(spark, ckpt).count() >= 1
    values = ("agg", "n", "value_ts", "source_topic", "source_partition", "source_offset")
    raw = read_operator_state(spark, ckpt)
    held = _as_map(windowed_state_rows(raw, values))
    assert held and all(last[k] == a for k, a in held.items())
    offline = SnapshotStore(spark, f"{root}/offline", APP)
    snapshot_operator_state(spark, ckpt, offline, 4, values)
    assert _as_map(offline.read()) == held and offline.read().first()["version"] == 4
    with pytest.raises(ValueError):
        windowed_state_rows(raw, ("agg",))


def test_retention_follows_the_stream_time_of_snapshot_and_tail(spark, tmp_root):
    day = 86_400
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = SnapshotSink(spark, f"{tmp_root}/s", store, every_n=0, retention_seconds=day)

    def batch(rows):
        import datetime as dt
        t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
        return spark.createDataFrame([(k, t(s), t(s + 3600), a, t(s + 60)) for k, s, a in rows],
                                     "key string, window_start timestamp, window_end timestamp, agg long, value_ts timestamp")

    sink(batch([("a", 20 * day, 1)]), 0)
    sink.snapshot(0)
    sink(batch([("b", 2 * day, 1)]), 1)  # far behind the newest record
    assert [r["key"] for r in sink.state().collect()] == ["a"]
    sink(batch([]), 2)
    sink.snapshot(2)
    assert [r["key"] for r in store.read().collect()] == ["a"]


def test_append_mode_emits_each_window_once(spark, batches):
    root = batches[0]
    seen = []

    def collect(df, batch_id):
        seen.extend((r["key"], r["window_start"], r["agg"]) for r in df.collect())

    for_each_update(windowed_stream(source(spark, batches), 3600), collect, f"{root}/app_ckpt", output_mode="append",
                    available_now=True).awaitTermination()
    keys = [(k, w) for k, w, _ in seen]
    assert len(keys) == len(set(keys)) and len(keys) > 0


def test_append_rows_equal_last_update_of_closed_windows(spark, batches):
    root = batches[0]
    upd, app = [], []
    for mode, sink_rows, tag in (("update", upd, "u"), ("append", app, "a")):
        def collect(df, batch_id, rows=sink_rows):
            rows.extend((r["key"], r["window_start"], r["agg"], batch_id) for r in df.collect())
        for_each_update(windowed_stream(source(spark, batches), 3600), collect, f"{root}/cmp_{tag}", output_mode=mode,
                        available_now=True).awaitTermination()
    last = {}
    for k, w, a, _ in sorted(upd, key=lambda x: x[3]):
        last[(k, w)] = a
    assert app and all(last[(k, w)] == a for k, w, a, _ in app)


def _final(spark, out, snapshot=None):
    emitted = spark.read.option("basePath", out).parquet(out)
    last = emitted.groupBy("key", instant_to_ntz("window_start").alias("window_start")).agg(F.max_by("agg", "batch_id").alias("agg"))
    final = _as_map(last)
    for r in (snapshot.collect() if snapshot is not None else []):
        final.setdefault((r["key"], r["window_start"]), r["agg"])
    return final


def test_bootstrap_from_a_version_the_sink_wrote(spark, batches, tmp_root):
    """A stream stops; a new query starts from the version its sink published."""
    root, recs, _ = batches
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = SnapshotSink(spark, f"{tmp_root}/sink", store, every_n=1)
    size = 10_000_000  # one window: no record is late, so both runs fold everything
    files = write_record_batches(recs.where("offset < 120"), f"{tmp_root}/first", 2, 2)
    first = stream_records_from_files(spark, f"{tmp_root}/first", max_files_per_trigger=files)
    for_each_update(windowed_stream(first, size, addresses=True), sink, f"{tmp_root}/ckpt1", available_now=True).awaitTermination()
    snapshot, out = store.read(), f"{tmp_root}/out"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    q = for_each_update(bootstrap_stream(source(spark, batches), snapshot, store.sources(), size),
                        lambda df, i: write_batch(df, out, i), f"{tmp_root}/ckpt2", available_now=True, rocksdb=True)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    assert ROCKSDB_PROVIDER
    assert _final(spark, out, snapshot) == _as_map(windows.tumbling_sum(recs, size))


def test_user_fold_in_a_stream_equals_batch(spark, batches, tmp_root):
    root, recs, _ = batches
    out = f"{tmp_root}/out"
    for_each_update(fold_stream(source(spark, batches), 0, lambda agg, v: max(0, agg + v - 5_000)), lambda df, i: write_batch(df, out, i), f"{tmp_root}/ckpt",
                    available_now=True, rocksdb=True).awaitTermination()
    assert _final(spark, out) == _as_map(windows.cusum(recs, 5_000))


def test_listener_records_events(spark, batches, tmp_root):
    events = listener.attach(spark, f"{tmp_root}/events")
    events.flush_every = 2  # several files: the driver never holds more
    try:
        q = for_each_update(windowed_stream(source(spark, batches), 3600),
                            lambda df, i: df.write.format("noop").mode("overwrite").save(), f"{tmp_root}/ckpt",
                            available_now=True, query_name="lst")
        other = for_each_update(windowed_stream(source(spark, batches), 3600),
                                lambda df, i: df.write.format("noop").mode("overwrite").save(), f"{tmp_root}/ckpt_b",
                                available_now=True)
        for x in (q, other):
            x.awaitTermination()
            events.wait_terminated(str(x.runId))
        rows = events.frame(str(q.id)).collect()
        assert [r["batch_id"] for r in sorted((r for r in rows if r["event"] == "progress"), key=lambda r: r["batch_id"])][:4] == [0, 1, 2, 3]
        assert {"started", "terminated"} <= {r["event"] for r in rows} and {r["query_id"] for r in rows} == {str(q.id)}
        assert events.frame().select("query_id").distinct().count() == 2
        assert events.lag_frame(str(q.id)).where("lag is not null").count() == 0  # a file source has no offsets per partition
        with pytest.raises(TimeoutError):
            events.wait_terminated("no such run", timeout=0.1)
    finally:
        spark.streams.removeListener(events)


@pytest.mark.parametrize("flush_every", [1, 2, 3, 4])
def test_events_are_written_before_a_run_counts_as_ended(spark, tmp_root, flush_every):
    """A slow write, in the listener's own thread, delays the announcement, not the rows."""
    events = listener.QueryEvents(spark, f"{tmp_root}/events", flush_every)
    plain = events._write

    def slow(rows):
        time.sleep(0.5)
        plain(rows)

    events._write = slow

    def run():
        for k in range(3):
            events._add("progress", "q", "run", None, k, 1, "now", None)
        events._add("terminated", "q", "run", None, None, None, None, None)

    caller = threading.Thread(target=run)
    caller.start()
    events.wait_terminated("run", timeout=60)
    assert sorted(r["event"] for r in events.frame("q").collect()) == ["progress"] * 3 + ["terminated"]
    caller.join()
    assert events.frame().count() == 4 and events._rows == []


def test_a_failed_write_loses_no_event(spark, tmp_root):
    events = listener.QueryEvents(spark, f"{tmp_root}/events", flush_every=2)
    plain, calls = events._write, []

    def fails_once(rows):
        calls.append(len(rows))
        if len(calls) == 1:
            raise OSError("no space")
        plain(rows)

    events._write = fails_once
    events._add("started", "q", "run", None, None, None, "now", None)
    with pytest.raises(OSError):
        events._add("terminated", "q", "run", None, None, None, None, None)
    events.wait_terminated("run", timeout=1)
    assert sorted(r["event"] for r in events.frame("q").collect()) == ["started", "terminated"] and calls == [2, 2]


def test_lag_per_source_partition(spark, tmp_root):
    events = listener.QueryEvents(spark, f"{tmp_root}/events")
    sources = json.dumps([{"description": "KafkaV2[order]", "startOffset": {"order": {"0": 1, "1": 1}}, "numInputRows": 12,
                           "endOffset": {"order": {"0": 7, "1": 9}}, "latestOffset": {"order": {"0": 10, "1": 9}}}])
    events._add("progress", "q", "r", None, 3, 12, "now", sources)
    got = sorted((r["topic"], r["partition"], r["end_offset"], r["latest_offset"], r["lag"], r["batch_id"])
                 for r in events.lag_frame("q").collect())
    assert got == [("order", 0, 7, 10, 3, 3), ("order", 1, 9, 9, 0, 3)]


def test_kafka_long_codec(spark):
    from windlass.functions.columns import decode_long, encode_long
    df = spark.createDataFrame([(0,), (1,), (-1,), (2 ** 62,), (-(2 ** 63),)], "v long")
    back = df.select(decode_long(encode_long("v")).alias("v")).collect()
    assert [r["v"] for r in back] == [0, 1, -1, 2 ** 62, -(2 ** 63)]


def test_kafka_row_decoding(spark):
    """The Kafka source's projection, on rows shaped like the Kafka source
    schema (the connector jar is not on this image)."""
    from windlass.functions.columns import encode_long, ntz_to_instant
    from windlass.sources.records import decode_kafka_rows
    recs = read_records(spark, SF001)
    raw = recs.select(F.col("key").cast("binary").alias("key"), encode_long("value").alias("value"),
                      "topic", "partition", "offset", ntz_to_instant("ts").alias("timestamp"))
    nulls = spark.createDataFrame([(None, None, "order", 0, 10 ** 9)],
                                  "key binary, value binary, topic string, partition int, offset long") \
        .withColumn("timestamp", F.current_timestamp())
    got = decode_kafka_rows(raw.unionByName(nulls))
    assert got.count() == recs.count()
    a = got.select("partition", "offset", "key", "value")
    assert a.exceptAll(recs.select("partition", "offset", "key", "value")).count() == 0
    assert C.SAMPLE_TOPIC == "order"
