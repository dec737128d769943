"""Streaming stores: emission by partition time, per-record updates, expiry, sessions, kept duplicates."""

import datetime as dt
import os
import shutil

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from windlass import config as C
from windlass.functions.columns import instant_to_ntz
from windlass.operators import lateness, restore, windows
from windlass.sources.records import read_records, stream_records_from_files
from windlass.sources.snapshots import SnapshotStore
from windlass.sources.state_reader import read_state_variable, snapshot_state_variable
from windlass.streaming.batches import last_batch, write_batch
from windlass.streaming.bootstrap import bootstrap_stream, fold_stream, rows_stream
from windlass.streaming.enrich import EnrichSink, ReplicatedTable
from windlass.streaming.files import write_record_batches
from windlass.streaming.sessions import merge_sessions, session_stream
from windlass.streaming.snapshot_sink import SnapshotSink
from windlass.streaming.strict import StrictWindowSink
from windlass.streaming.windowed import for_each_update

APP = "app"
BATCHES = 4
RECORD = "topic string, partition int, offset long, ts timestamp_ntz, key string, value long"
T0 = dt.datetime(2024, 1, 1)


def hand(spark, rows):
    """(topic, partition, offset, seconds, key, value)"""
    return spark.createDataFrame([(t, p, o, T0 + dt.timedelta(seconds=s), k, v) for t, p, o, s, k, v in rows], RECORD)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def batches(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="windlass-stores-")
    recs = read_records(spark, SF001)
    return f"{root}/in", recs, write_record_batches(recs, f"{root}/in", BATCHES, 2)


def source(spark, batches, **kw):
    return stream_records_from_files(spark, batches[0], max_files_per_trigger=batches[2], **kw)


def batch_files(path, files, batch):
    names = sorted((f for f in os.listdir(path) if f.endswith(".parquet")), key=lambda n: os.path.getmtime(f"{path}/{n}"))
    return [f"{path}/{n}" for n in names[files * batch:files * (batch + 1)]]


def write(path):
    return lambda df, i: write_batch(df, path, i)


# -- the strict store -------------------------------------------------------------

def test_strict_store_emits_updates_and_each_final_window_once(spark, batches, tmp_root):
    path, recs, files = batches
    timed = read_records(spark, SF001, stream_time=True)
    sink = StrictWindowSink(spark, f"{tmp_root}/s", emit_updates=True, emit_final=True, every_n=2,
                            store=SnapshotStore(spark, f"{tmp_root}/snap", APP))
    src = source(spark, batches, event_time_type="timestamp_ntz")
    for_each_update(src, sink, f"{tmp_root}/ckpt", output_mode="append", available_now=True).awaitTermination()
    update = ("topic", "partition", "offset", "ts", "key", "window_start", "window_end", "agg")
    final = ("key", "window_start", "window_end", "n", "agg")
    want_updates, want_final = rows(lateness.update_stream(timed), *update), rows(lateness.final_windows(timed), *final)

    def check():
        assert rows(sink.updates(), *update) == want_updates
        assert rows(sink.final(), *final) == want_final and len(want_final) > 100
        assert rows(sink.state(), "key", "window_start", "agg") == rows(lateness.strict_late_drop(timed), "key", "window_start", "agg")

    check()
    # the open windows are few, and with the final ones they are the whole state
    still = sink.open_after(3)
    assert 0 < still.count() < len(want_final)
    assert rows(still.unionByName(sink.final().select(still.columns)), *final) == rows(sink.state(), *final)
    # a batch replayed with the same input, the last one or an earlier one and all after it
    for start in (3, 1):
        for b in range(start, BATCHES):
            sink(spark.read.parquet(*batch_files(path, files, b)).where("key is not null"), b)
        check()
    # the updates are a changelog: the state after batch 1 and the updates past its positions
    positions = sink.carry_after(1).select("topic", "partition", F.col("position").alias("version"))
    again = restore.restore_with_tail(sink.state(1).drop("n"), positions, sink.updates().drop("n", "batch_id"))
    assert rows(again, "key", "window_start", "agg") == rows(sink.state(), "key", "window_start", "agg")


def test_final_windows_close_by_their_own_partitions_time(spark, tmp_root):
    sink = StrictWindowSink(spark, f"{tmp_root}/s", emit_final=True)
    sink(hand(spark, [("t", 0, 0, 10, "a", 1), ("t", 1, 0, 20, "b", 2)]), 0)
    sink(hand(spark, [("t", 0, 1, 4_000, "a", 5), ("t", 0, 2, 30, "a", 100)]), 1)  # the second is late in its batch
    got = lambda: rows(sink.final(), "batch_id", "key", "agg", "n")
    assert got() == [(1, "a", 1, 1)]  # partition 1 has not moved: b stays open
    sink(hand(spark, [("t", 1, 1, 40, "b", 3), ("t", 1, 2, 9_000, "c", 4), ("t", 1, 3, 20_000, "c", 6)]), 2)
    assert got() == [(1, "a", 1, 1), (2, "b", 5, 2), (2, "c", 4, 1)]  # c's first window opened and closed within the batch
    sink(hand(spark, []), 3)
    assert got() == [(1, "a", 1, 1), (2, "b", 5, 2), (2, "c", 4, 1)]
    # a batch whose predecessor left no open windows must not start from none
    shutil.move(f"{sink.open_path}/batch_id=3", f"{tmp_root}/kept")
    with pytest.raises(FileNotFoundError):
        sink(hand(spark, []), 4)


def test_strict_store_drops_what_is_past_retention(spark, batches, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = StrictWindowSink(spark, f"{tmp_root}/s", every_n=1, store=store, retention_seconds=C.STORE_RETENTION_SECONDS)
    src = source(spark, batches, event_time_type="timestamp_ntz")
    for_each_update(src, sink, f"{tmp_root}/ckpt", output_mode="append", available_now=True).awaitTermination()
    timed = read_records(spark, SF001, stream_time=True)
    want = rows(lateness.live_windows(timed), "partition", "key", "window_start", "n", "agg")
    assert rows(sink.state(), "partition", "key", "window_start", "n", "agg") == want
    assert rows(store.read(), "partition", "key", "window_start", "n", "agg") == want
    assert 0 < len(want) < lateness.strict_late_drop(timed).count()


def test_resumed_strict_store_emits_the_windows_that_were_open(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    first = StrictWindowSink(spark, f"{tmp_root}/a", every_n=1, store=store)
    first(hand(spark, [("t", 0, 0, 10, "a", 1), ("t", 0, 1, 4_000, "a", 5)]), 0)
    second = StrictWindowSink(spark, f"{tmp_root}/b", resume=store, emit_final=True, emit_updates=True)
    second(hand(spark, [("t", 0, 1, 4_000, "a", 5), ("t", 0, 2, 4_100, "a", 7), ("t", 0, 3, 8_000, "a", 9)]), 0)
    assert rows(second.final(), "key", "agg") == [("a", 12)]
    assert rows(second.updates(), "offset", "agg") == [(2, 12), (3, 9)]


# -- state that expires --------------------------------------------------------------

DAY = 86_400


def run_batches(spark, build, parts, root, mode="update"):
    """Run a stream over hand-made batches, one file each; returns its output folder."""
    os.makedirs(f"{root}/in")
    for b, part in enumerate(parts):
        hand(spark, part).coalesce(1).write.parquet(f"{root}/stage{b}")
        name = next(f for f in os.listdir(f"{root}/stage{b}") if f.endswith(".parquet"))
        shutil.copyfile(f"{root}/stage{b}/{name}", f"{root}/in/{b}.parquet")
        os.utime(f"{root}/in/{b}.parquet", (1_700_000_000 + b, 1_700_000_000 + b))
    src = stream_records_from_files(spark, f"{root}/in", max_files_per_trigger=1)
    for_each_update(build(src), write(f"{root}/out"), f"{root}/ckpt", output_mode=mode, available_now=True, rocksdb=True,
                    state_partitions=2).awaitTermination()
    return spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out")


PARTS = [[("t", 0, 0, 10, "a", 1), ("t", 0, 1, 20, "b", 2)],
         [("t", 0, 2, DAY - 1, "c", 3)],
         [("t", 0, 3, DAY + 3_600, "c", 4), ("t", 0, 4, 50, "a", 10)],  # a's window is still held in this batch
         [("t", 0, 5, 60, "a", 100)]]  # and past its retention in this one: skipped


@pytest.mark.parametrize("build", [
    lambda s: bootstrap_stream(s, size_seconds=3_600, retention_seconds=DAY),
    lambda s: fold_stream(s, 0, lambda agg, v: agg + v, 3_600, retention_seconds=DAY)])
def test_expired_windows_leave_the_state_store(spark, tmp_root, build):
    out = run_batches(spark, build, PARTS, tmp_root)
    held = lambda batch: rows(read_state_variable(spark, f"{tmp_root}/ckpt", "agg", batch_id=batch), "key", "agg")
    assert held(1) == [("a", 1), ("b", 2), ("c", 3)]
    assert held(None) == [("c", 3), ("c", 4)]
    assert rows(out, "batch_id", "key", "agg") == [(0, "a", 1), (0, "b", 2), (1, "c", 3), (2, "a", 11), (2, "c", 4)]


def test_state_from_a_snapshot_expires_too(spark, tmp_root):
    start = spark.createDataFrame([("a", T0, 5), ("c", T0 + dt.timedelta(days=1), 7)], "key string, window_start timestamp_ntz, agg long")
    run_batches(spark, lambda s: bootstrap_stream(s, start, size_seconds=3_600, retention_seconds=DAY), PARTS, tmp_root)
    assert rows(read_state_variable(spark, f"{tmp_root}/ckpt", "agg", batch_id=0), "key", "agg") == [("a", 6), ("b", 2), ("c", 7)]
    assert rows(read_state_variable(spark, f"{tmp_root}/ckpt", "agg"), "key", "agg") == [("c", 3), ("c", 4), ("c", 7)]


def entries(spark, root, name):
    """Entries of the state store that hold a variable."""
    return spark.read.format("statestore").option("stateVarName", name).load(f"{root}/ckpt").count()


@pytest.mark.parametrize("build", [
    lambda s, slots: bootstrap_stream(s, size_seconds=3_600, retention_seconds=DAY, slots=slots),
    lambda s, slots: fold_stream(s, 0, lambda agg, v: agg + v, 3_600, retention_seconds=DAY, slots=slots)])
def test_keys_of_a_window_share_entries_of_the_store(spark, tmp_root, build):
    parts = [[("t", 0, 40 * b + i, 7_200 * b + i % 2 * 3_600, f"k{i}", i + b) for i in range(40)] for b in range(2)]
    parts[1] += [("t", 0, 100 + i, 5, f"k{i}", 1_000) for i in range(0, 40, 4)]
    out = run_batches(spark, lambda s: build(s, 3), parts, tmp_root)
    again = {f"k{i}" for i in range(0, 40, 4)}
    want = [(f"k{i}", i + 1_000 * (f"k{i}" in again)) for i in range(40)] + [(f"k{i}", i + 1) for i in range(40)]
    assert rows(read_state_variable(spark, f"{tmp_root}/ckpt", "agg"), "key", "agg") == sorted(want, key=repr)
    assert out.where("batch_id = 1").count() == 50
    assert 4 <= entries(spark, tmp_root, "agg") <= 4 * 3


def test_custom_state_is_published_and_started_from(spark, batches, tmp_root):
    """The value state of one query, read offline, is the snapshot another one goes on from."""
    path, recs, files = batches
    size = C.SAMPLE_WINDOW_SECONDS
    os.makedirs(f"{tmp_root}/in")
    for b in range(2):
        for f in batch_files(path, files, b):
            shutil.copy2(f, f"{tmp_root}/in/")
    src = stream_records_from_files(spark, f"{tmp_root}/in", max_files_per_trigger=files)
    for_each_update(bootstrap_stream(src, size_seconds=size), write(f"{tmp_root}/o1"), f"{tmp_root}/c1", available_now=True,
                    rocksdb=True).awaitTermination()
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    seen = spark.read.parquet(f"{tmp_root}/in").groupBy("topic", "partition").agg(F.max("offset").alias("position"))
    snapshot_state_variable(spark, f"{tmp_root}/c1", "agg", store, 7, size, sources=seen)
    assert {r["version"] for r in store.read().collect()} == {7}
    again = bootstrap_stream(source(spark, batches), store.read(), store.sources(), size)
    for_each_update(again, write(f"{tmp_root}/o2"), f"{tmp_root}/c2", available_now=True, rocksdb=True).awaitTermination()
    held = read_state_variable(spark, f"{tmp_root}/c2", "agg").withColumn("window_start", instant_to_ntz("window_start"))
    assert rows(held, "key", "window_start", "agg") == rows(windows.tumbling_sum(recs, size), "key", "window_start", "agg")


# -- sessions ----------------------------------------------------------------------------

def test_merge_sessions():
    assert merge_sessions([(10, 12, 1, 5), (0, 3, 2, 1), (5, 6, 1, 1)], 3) == {0: (6, 3, 2), 10: (12, 1, 5)}
    assert merge_sessions([(10, 12, 1, 5), (0, 3, 2, 1), (4, 7, 1, 1)], 3) == {0: (12, 4, 7)}
    assert merge_sessions([(0, 9, 1, 1), (2, 3, 1, 1), (10, 10, 1, 1)], 1) == {0: (10, 3, 3)}
    assert merge_sessions([], 1) == {}


def sessions_of(out):
    """Final sessions of a changelog of sessions."""
    last = {}
    for r in sorted(out.collect(), key=lambda r: r["batch_id"]):
        last[r["key"], r["window_start"], r["window_end"]] = (r["n"], r["agg"])
    return sorted((*k, *v) for k, v in last.items() if v[0] is not None)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_a_late_record_joins_two_sessions_and_retracts_them(spark, tmp_root):
    parts = [[("t", 0, 0, 0, "a", 1), ("t", 0, 1, 5, "a", 2), ("t", 0, 2, 100, "a", 4), ("t", 0, 3, 3, "b", 1)],
             [("t", 0, 4, 300, "a", 8)],
             [("t", 0, 5, 52, "a", 16)]]  # 47 s and 48 s from its neighbours
    out = run_batches(spark, lambda s: session_stream(s, 50), parts, tmp_root).withColumn(
        "window_start", instant_to_ntz("window_start")).withColumn("window_end", instant_to_ntz("window_end"))
    assert sessions_of(out) == [("a", at(0), at(100), 4, 23), ("a", at(300), at(300), 1, 8), ("b", at(3), at(3), 1, 1)]
    last = rows(out.where("batch_id = 2"), "window_start", "window_end", "n", "agg", "source_offset")
    assert last == sorted([(at(0), at(5), None, None, None), (at(100), at(100), None, None, None), (at(0), at(100), 4, 23, 5)], key=repr)
    assert rows(read_state_variable(spark, f"{tmp_root}/ckpt", "sessions").where("key = 'a'"), "n", "agg") == [(1, 8), (4, 23)]


def test_closed_sessions_leave_the_state(spark, tmp_root):
    parts = [[("t", 0, 0, 0, "a", 1)], [("t", 0, 1, 200, "b", 2)], [("t", 0, 2, 40, "a", 4), ("t", 0, 3, 160, "b", 8)],
             [("t", 0, 4, 10_000, "c", 1)]]
    out = run_batches(spark, lambda s: session_stream(s, 50, grace_seconds=20), parts, tmp_root)
    assert [(r[0], r[3], r[4]) for r in sessions_of(out)] == [("a", 1, 1), ("b", 2, 10), ("c", 1, 1)]  # a's second record is late
    assert rows(read_state_variable(spark, f"{tmp_root}/ckpt", "sessions"), "key") == [("c",)]


def test_sessions_of_many_keys_share_entries(spark, tmp_root):
    day = 86_400
    parts = [[("t", 0, i, i // 30 * 3 * day, f"k{i % 30}", 1) for i in range(60)],
             [("t", 0, 60 + i, 3 * day + 40, f"k{i}", 5) for i in range(30)],
             [("t", 0, 100, 40, "k0", 7), ("t", 0, 101, day, "k1", 9)]]  # late ones: of an old session, and between two
    out = run_batches(spark, lambda s: session_stream(s, 50, slots=3), parts, tmp_root)
    want = [(f"k{i}", at(0), at(40 if i == 0 else 0), 2 if i == 0 else 1, 8 if i == 0 else 1) for i in range(30)]
    want += [(f"k{i}", at(3 * day), at(3 * day + 40), 2, 6) for i in range(30)] + [("k1", at(day), at(day), 1, 9)]
    shown = out.withColumn("window_start", instant_to_ntz("window_start")).withColumn("window_end", instant_to_ntz("window_end"))
    assert sessions_of(shown) == sorted(want)
    held = read_state_variable(spark, f"{tmp_root}/ckpt", "sessions")
    assert rows(held, "key", "n", "agg") == sorted(((k, n, agg) for k, _, _, n, agg in want), key=repr)
    assert entries(spark, tmp_root, "sessions") <= 3 * 3


def test_closed_sessions_of_a_slot_leave_one_by_one(spark, tmp_root):
    day = 86_400
    parts = [[("t", 0, 0, 0, "a", 1), ("t", 0, 1, 300, "b", 2), ("t", 0, 2, day, "c", 4)], [("t", 0, 3, day + 1, "c", 8)],
             [("t", 0, 4, 2 * day, "d", 1)], [("t", 0, 5, 2 * day + 1, "d", 1)]]
    run_batches(spark, lambda s: session_stream(s, 50, grace_seconds=20, slots=1), parts, tmp_root)
    held = lambda batch: rows(read_state_variable(spark, f"{tmp_root}/ckpt", "sessions", batch_id=batch), "key", "n", "agg")
    assert held(0) == [("a", 1, 1), ("b", 1, 2), ("c", 1, 4)] and held(1) == [("c", 2, 12)]
    assert held(None) == [("d", 2, 2)]


def test_sessions_equal_batch_with_snapshots_and_a_new_query(spark, batches, tmp_root):
    path, recs, files = batches
    gap = 6 * 3_600
    want = rows(windows.session_sum(recs, gap), "key", "session_start", "session_end", "n", "agg")
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP, store="sessions")
    sink = SnapshotSink(spark, f"{tmp_root}/sink", store, every_n=1)
    os.makedirs(f"{tmp_root}/in")
    for b in range(2):
        for f in batch_files(path, files, b):
            shutil.copy2(f, f"{tmp_root}/in/")
    src = stream_records_from_files(spark, f"{tmp_root}/in", max_files_per_trigger=files)
    for_each_update(session_stream(src, gap), sink, f"{tmp_root}/c1", available_now=True, rocksdb=True).awaitTermination()
    part = rows(sink.state(), "key", "window_start", "window_end", "n", "agg")
    seen = spark.read.parquet(f"{tmp_root}/in")
    assert part == rows(windows.session_sum(seen, gap), "key", "session_start", "session_end", "n", "agg") != want
    # a new query with no checkpoint goes on from the published version, fed the whole input
    again = SnapshotSink(spark, f"{tmp_root}/sink2", SnapshotStore(spark, f"{tmp_root}/snap2", APP, store="sessions"), every_n=0)
    changes = session_stream(source(spark, batches), gap, snapshot=store.read().select("key", "window_start", "window_end", "n", "agg"),
                             positions=store.sources())
    for_each_update(changes, again, f"{tmp_root}/c2", available_now=True, rocksdb=True).awaitTermination()
    held = read_state_variable(spark, f"{tmp_root}/c2", "sessions")
    start, end = (instant_to_ntz(F.timestamp_micros(c)).alias(c) for c in ("start", "end"))
    assert rows(held.select("key", start, end, "n", "agg"), "key", "start", "end", "n", "agg") == want


# -- duplicates kept -----------------------------------------------------------------------

def test_kept_duplicates_equal_batch_across_a_restart(spark, batches, tmp_root):
    path, recs, files = batches
    os.makedirs(f"{tmp_root}/in")
    for part in ((0, 1), (2, 3)):  # the query ends and is started again from its checkpoint
        for b in part:
            for f in batch_files(path, files, b):
                shutil.copy2(f, f"{tmp_root}/in/")
        src = stream_records_from_files(spark, f"{tmp_root}/in", max_files_per_trigger=files)
        for_each_update(rows_stream(src), write(f"{tmp_root}/out"), f"{tmp_root}/ckpt", output_mode="append", available_now=True,
                        rocksdb=True).awaitTermination()
    assert last_batch(spark, f"{tmp_root}/out") == 3
    cols = ("key", "window_start", "partition", "offset", "value", "seq")
    want = rows(windows.window_rows(recs), *cols)
    emitted = spark.read.parquet(f"{tmp_root}/out").withColumn("window_start", instant_to_ntz("window_start"))
    held = read_state_variable(spark, f"{tmp_root}/ckpt", "rows").withColumn("window_start", instant_to_ntz("window_start"))
    assert rows(emitted, *cols) == want and rows(held, *cols) == want


def test_kept_duplicates_of_many_keys_share_entries(spark, tmp_root):
    parts = [[("t", 0, 60 * b + i, i, f"k{i % 30}", i + b) for i in range(60)] for b in range(2)]
    out = run_batches(spark, lambda s: rows_stream(s, 3_600, slots=3), parts, tmp_root, "append")
    cols = ("key", "offset", "value", "seq")
    want = sorted(((f"k{i % 30}", 60 * b + i, i + b, 2 * b + i // 30 + 1) for b in range(2) for i in range(60)), key=repr)
    assert rows(out, *cols) == want and rows(read_state_variable(spark, f"{tmp_root}/ckpt", "rows"), *cols) == want
    assert entries(spark, tmp_root, "n") <= 3 and entries(spark, tmp_root, "rows") <= 3 * 2


# -- replicated tables --------------------------------------------------------------------------

def test_enrichment_refreshes_by_batch_and_replays_what_it_saw(spark, tmp_root):
    loads = []

    def load():
        loads.append(1)
        n = len(loads)
        return spark.createDataFrame([("a", f"a{n}", 1), ("a", f"A{n}", 2), ("b", f"b{n}", 1), (None, "none", 1)],
                                     "key string, name string, rank int")

    def sink(limit=100):
        return EnrichSink(f"{tmp_root}/out", [ReplicatedTable(spark, f"{tmp_root}/t", load, ["key"], order="rank", refresh_every=2,
                                                              broadcast_rows=limit)])

    first = sink()
    for b in range(4):
        first(hand(spark, [("t", 0, b, b, "a", b), ("t", 0, 10 + b, b, "x", b)]), b)
    out = lambda: rows(spark.read.option("basePath", f"{tmp_root}/out").parquet(f"{tmp_root}/out"), "batch_id", "key", "name")
    want = [(b, k, f"A{1 + b // 2}" if k == "a" else None) for b in range(4) for k in "ax"]
    assert out() == sorted(want, key=repr) and len(loads) == 2
    # replayed by a new process, and by key where the copy is too large to broadcast
    again = sink(limit=0)
    again(hand(spark, [("t", 0, 1, 1, "a", 1), ("t", 0, 11, 1, "x", 1)]), 1)
    assert out() == sorted(want, key=repr) and len(loads) == 2


def test_the_join_is_broadcast_by_its_counted_size(spark, tmp_root):
    def plan(limit):
        t = ReplicatedTable(spark, f"{tmp_root}/t{limit}", lambda: spark.range(50).selectExpr("cast(id as string) key", "id"), ["key"],
                            broadcast_rows=limit)
        return t.join(spark.range(10).selectExpr("cast(id as string) key"), 0)._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(50) and "broadcast" not in plan(49)
