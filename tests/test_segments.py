"""Versions that share segments: what is written, read and listed follows what changed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from windlass.functions.columns import segment_id
from windlass.operators import restore
from windlass.sources.snapshots import SnapshotStore
from windlass.streaming.snapshot_sink import SnapshotSink

APP = "app"
STATE = "topic string, partition int, key string, window_start timestamp_ntz, window_end timestamp_ntz, agg long"
T0 = dt.datetime(2024, 1, 1)
HOUR = 3_600


def state(spark, rows):
    """(partition, key, hour, agg)"""
    return spark.createDataFrame([("t", p, k, T0 + dt.timedelta(hours=h), T0 + dt.timedelta(hours=h + 1), a) for p, k, h, a in rows], STATE)


def positions(spark, version, partitions=(0,)):
    return spark.createDataFrame([("t", p, version) for p in partitions], "topic string, partition int, version long")


def segments(spark, df):
    return df.select("topic", "partition", segment_id("window_start", 12 * HOUR).alias("segment_id"))


def held(df):
    return sorted((r["partition"], r["key"], r["window_start"], r["agg"]) for r in df.collect())


def data_bytes(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_changed_segments_are_written_and_others_referenced(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/s", APP)
    one = [(p, f"{(i + 600 * s) * 7919 % 100_003}", 12 * s + 1, i * 31 % 977) for p in (0, 1) for s in range(10) for i in range(600)]
    store.publish(state(spark, one), positions(spark, 1, (0, 1)))
    first = store.latest()
    whole = data_bytes(store.attempt_path("state", first.first()["attempt"]))
    new = [(p, k, h, a + 1000) if h == 109 else (p, k, h, a) for p, k, h, a in one]
    changed = state(spark, [r for r in new if r[2] == 109])
    pointers = store.publish_changes(changed, segments(spark, changed), positions(spark, 2, (0, 1)), first)
    attempt = pointers.first()["attempt"]
    assert data_bytes(store.attempt_path("state", attempt)) < 0.35 * whole
    assert held(store.read()) == held(state(spark, new)) and held(store.read(store.at(1))) == held(state(spark, one))
    assert {r["version"] for r in store.read().collect()} == {2}
    assert sorted((r["partition"], r["row_count"]) for r in pointers.collect()) == [(0, 6000), (1, 6000)]
    by = {(r["partition"], r["segment_id"]): r["data_attempt"] for r in store.segments().collect()}
    assert sum(a == attempt for a in by.values()) == 2 and len(by) == 20
    # a third version on top of the second, which also drops the oldest segments
    again = state(spark, [(0, "k0", 109, 7)])  # all that partition 0 holds of the last segment
    low = min(s for _, s in by) + 4
    least = spark.createDataFrame([("t", p, low) for p in (0, 1)], "topic string, partition int, least_segment long")
    store.publish_changes(again, segments(spark, again), positions(spark, 3, (0, 1)), store.latest(), least=least)
    want = [r for r in new if r[2] > 48 and not (r[0] == 0 and r[2] == 109)] + [(0, "k0", 109, 7)]
    assert held(store.read()) == held(state(spark, want))
    # the manifest lists every file of a version once, with all its rows
    listed = store.manifest()
    assert listed.agg(F.sum("rows")).first()[0] == len(want) and listed.where("length <= 0").count() == 0


def test_a_lost_segment_of_an_older_attempt_is_an_error(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/s", APP)
    store.publish(state(spark, [(0, "a", 1, 1), (0, "b", 30, 2)]), positions(spark, 1))
    old = store.latest().first()["attempt"]
    changed = state(spark, [(0, "a", 1, 5)])
    store.publish_changes(changed, segments(spark, changed), positions(spark, 2), store.latest())
    assert held(store.read()) == held(state(spark, [(0, "a", 1, 5), (0, "b", 30, 2)]))
    path = store.attempt_path("state", old)
    data = spark.read.parquet(path)
    spark.createDataFrame(data.where("key = 'a'").collect(), data.schema).write.mode("overwrite").partitionBy("task").parquet(path)
    with pytest.raises(FileNotFoundError):
        store.read()


def test_a_segment_that_became_empty_goes(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/s", APP)
    one = state(spark, [(0, "a", 1, 1), (0, "b", 30, 2)])
    store.publish(one, positions(spark, 1))
    store.publish_changes(one.where("key = 'none'"), segments(spark, one.where("key = 'a'")), positions(spark, 2), store.latest())
    assert held(store.read()) == held(one.where("key = 'b'"))
    store.publish_changes(one.where("key = 'none'"), segments(spark, one), positions(spark, 3), store.latest())
    assert store.latest().first()["version"] == 2  # a version without rows gets no pointer


def update(spark, rows):
    """A batch of the update stream: (key, hour, agg)."""
    t = lambda h: T0 + dt.timedelta(hours=h)
    return spark.createDataFrame([(k, t(h), t(h + 1), a, t(h + 0.5)) for k, h, a in rows],
                                 "key string, window_start timestamp, window_end timestamp, agg long, value_ts timestamp")


@pytest.mark.parametrize("retention,batches", [(None, 31), (3 * 86_400, 51)])
def test_versions_of_a_sink_cost_what_changed(spark, tmp_root, retention, batches, monkeypatch):
    """Many batches that move on in time: bytes written follow the segments they touch, a
    version opens the batches since the last one only, and each equals a full fold."""
    import windlass.streaming.snapshot_sink as module
    opened = []
    plain = module.read_batches
    monkeypatch.setattr(module, "read_batches", lambda s, path, after, upto, schema=None: (
        opened.append(upto - after), plain(s, path, after, upto, schema))[1])
    store = SnapshotStore(spark, f"{tmp_root}/snap", APP)
    sink = SnapshotSink(spark, f"{tmp_root}/s", store, every_n=10, partitions=2, retention_seconds=retention)
    everything = {}
    first, written = [(f"{(i + 50 * h) * 7919 % 100_003}", h, i * 31 % 977) for i in range(1_000) for h in range(0, 240, 24)], []
    for b in range(batches):
        rows = first if b == 0 else [(f"k{i}", 240 + b, b * i) for i in range(3)] + ([(first[-1][0], 216, b)] if b == 25 else [])
        everything.update({(k, h): a for k, h, a in rows})
        opened.clear()
        sink(update(spark, rows), b)
        if b % 10 == 0:
            attempt = store.latest().first()["attempt"]
            written.append(data_bytes(store.attempt_path("state", attempt)))
            assert all(n <= 10 for n in opened if b), opened
            newest = max(h for _, h in everything) + 0.5
            live = {k: a for k, a in everything.items() if retention is None or k[1] > newest - retention / HOUR}
            got = {(r["key"], int((r["window_start"] - T0).total_seconds() // HOUR)): r["agg"] for r in store.read().collect()}
            assert got == live, b
            again = {(r["key"], int((r["window_start"] - T0).total_seconds() // HOUR)): r["agg"] for r in sink.state(b).collect()}
            assert again == live
    assert all(w < 0.5 * written[0] for w in written[1:])


def test_no_sort_aggregate_in_compaction(spark):
    """Values of fixed width are folded by hash aggregates, nothing is sorted."""
    rows = spark.range(100).selectExpr("'t' topic", "0 partition", "id offset", "cast(id % 7 as string) key",
                                       "timestamp_ntz'2024-01-01 00:00:00' window_start", "timestamp_ntz'2024-01-01 01:00:00' window_end",
                                       "IF(id % 3 = 0, null, id) agg", "id * 2.5 total", "timestamp_ntz'2024-01-01 00:00:00' value_ts")
    snap = rows.limit(3).drop("offset")
    pos = positions(spark, 1)
    for df in (restore.changelog_compact(rows), restore.restore_with_tail(snap, pos, rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    # a null at the highest offset stays null
    got = {r["key"]: (r["agg"], r["offset"]) for r in restore.changelog_compact(rows).collect()}
    assert got["1"] == (None, 99) and got["0"] == (98, 98)


def test_compaction_of_values_of_any_type(spark):
    rows = spark.createDataFrame([(0, "a", "x", [1], 5), (1, "a", None, [2], 6), (2, "b", None, None, None), (1, "b", "y", [3], 1)],
                                 "offset long, key string, name string, list array<int>, agg long").selectExpr(
        "'t' topic", "0 partition", "*", "timestamp_ntz'2024-01-01 00:00:00' window_start", "timestamp_ntz'2024-01-01 01:00:00' window_end")
    got = [tuple(r) for r in restore.changelog_compact(rows).select("key", "name", "list", "agg", "offset").collect()]
    assert got == [("a", None, [2], 6, 1)]  # b's last write is a tombstone
