"""Restore decisions, checkpoint merges, snapshot publish protocol and the
key invariant: snapshot + changelog tail == full aggregate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from windlass import config as C
from windlass.operators import lateness, restore
from windlass.plans import scenario
from windlass.sources.records import read_records
from windlass.sources.snapshots import SnapshotStore, tail_filter

OFF = "app string, task string, store string, topic string, partition int, offset bigint"
A, S, T = "app", "s1", "app-s1-changelog"


def decide(spark, local, remote, **kw):
    l_df = spark.createDataFrame(local, OFF)
    r_df = spark.createDataFrame(remote, OFF)
    return {(r["task"], r["store"]): (r["should_fetch"], r["reason"])
            for r in restore.restore_decision(l_df, r_df, **kw).collect()}


def test_decision_table(spark):
    local = [
        (A, "0_0", S, T, 0, 100),          # remote missing -> no
        (A, "0_2", S, T, 9, 5),             # partition missing locally (other partition) -> yes
        (A, "0_3", S, T, 3, 100),           # boundary: 100 + 10000 == 10100 -> no
        (A, "0_4", S, T, 4, 20000),         # 20000 + 10000 < 30001 -> yes
        (A, "0_5", S, T, 5, 100),           # two remote entries -> no
    ]
    remote = [
        (A, "0_1", S, T, 1, 7),             # no local checkpoint -> yes
        (A, "0_2", S, T, 2, 7),
        (A, "0_3", S, T, 3, 10100),
        (A, "0_4", S, T, 4, 30001),
        (A, "0_5", S, T, 5, 50000), (A, "0_5", S, T, 6, 50000),
    ]
    d = decide(spark, local, remote)
    assert d[("0_0", S)] == (False, "no remote checkpoint")
    assert d[("0_1", S)] == (True, "no local checkpoint")
    assert d[("0_2", S)] == (True, "partition missing locally")
    assert d[("0_3", S)][0] is False
    assert d[("0_4", S)][0] is True
    assert d[("0_5", S)] == (False, "remote checkpoint names several partitions")
    # threshold is an option; +10001 crosses it
    d2 = decide(spark, [(A, "0_3", S, T, 3, 100)], [(A, "0_3", S, T, 3, 10101)])
    assert d2[("0_3", S)][0] is True


def test_decision_skips_restoring_store(spark):
    status = spark.createDataFrame([(3, S, True)], "partition int, store string, restoring boolean")
    l_df = spark.createDataFrame([], OFF)
    r_df = spark.createDataFrame([(A, "0_3", S, T, 3, 7)], OFF)
    r = restore.restore_decision(l_df, r_df, status=status).collect()[0]
    assert (r["should_fetch"], r["reason"]) == (False, "store already restoring")


def test_merge_is_remote_biased_and_idempotent(spark):
    local = spark.createDataFrame([(A, "0_1", S, T, 1, 5), (A, "0_1", "s2", "app-s2-changelog", 1, 9),
                                   (A, "0_9", S, T, 9, 1)], OFF)
    remote = spark.createDataFrame([(A, "0_1", S, T, 1, 50)], OFF)
    m = {(r["topic"], r["partition"]): (r["offset"], r["source"])
         for r in restore.merge_offsets(local, remote).collect()}
    assert m == {(T, 1): (50, "remote"), ("app-s2-changelog", 1): (9, "local")}
    merged = restore.merge_offsets(local, remote).select("app", "task", F.lit(S).alias("store"), "topic",
                                                         "partition", "offset")
    again = {(r["topic"], r["offset"]) for r in restore.merge_offsets(merged, remote).collect()}
    assert again == {(T, 50), ("app-s2-changelog", 9)}
    assert [r["task"] for r in restore.merge_errors(local, remote).collect()] == ["0_9"]


def test_merge_map_cells(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 20, "c": 30})], "l map<string,bigint>, r map<string,bigint>")
    got = df.select(restore.merge_map(F.col("l"), F.col("r")).alias("m")).collect()[0]["m"]
    assert got == {"a": 1, "b": 20, "c": 30}


@pytest.fixture(scope="module")
def store_pipeline(spark):
    recs = read_records(spark, SF001, stream_time=True)
    cl = lateness.changelog(recs).cache()
    full = {(r["key"], r["window_start"]): r["agg"] for r in lateness.strict_late_drop(recs).collect()}
    return cl, full


@pytest.mark.parametrize("frac", [0.0, 0.3, 0.7, 1.0])
def test_restore_with_tail_equals_full(spark, store_pipeline, frac):
    cl, full = store_pipeline
    ends = cl.groupBy("topic", "partition").agg(F.max("offset").alias("m"))
    pos = ends.select("topic", "partition", F.floor(F.col("m") * frac).cast("bigint").alias("version"))
    snap = restore.state_as_of(cl, pos)
    got = {(r["key"], r["window_start"]): r["agg"]
           for r in restore.restore_with_tail(snap, pos, cl).collect()}
    assert got == full
    # the same with the cut pushed into the changelog scan
    pushed = restore.restore_with_tail(snap, pos, cl, cut=tail_filter(pos))
    assert {(r["key"], r["window_start"]): r["agg"] for r in pushed.collect()} == full
    # an overlapping tail (replay from earlier than the snapshot) changes nothing
    earlier = pos.select("topic", "partition", (F.col("version") - 25).alias("version"))
    tail_from_earlier = cl.join(earlier.withColumnRenamed("version", "v"), ["topic", "partition"]).where("offset > v")
    over = restore.restore_with_tail(snap, pos, cl.unionByName(tail_from_earlier.drop("v")))
    assert {(r["key"], r["window_start"]): r["agg"] for r in over.collect()} == full


def test_publish_read_latest(spark, store_pipeline, tmp_root):
    cl, full = store_pipeline
    store = SnapshotStore(spark, tmp_root, C.SAMPLE_APPLICATION_ID)
    for cut in scenario.SCENARIO.snapshot_cuts:
        pos = scenario.snapshot_positions(cl, cut)
        store.publish(restore.state_as_of(cl, pos), pos)
    latest = {r["task"]: r["version"] for r in store.latest().collect()}
    newest = {f"0_{r['partition']}": r["version"] for r in
              scenario.snapshot_positions(cl, scenario.SCENARIO.snapshot_cuts[-1]).collect()}
    assert latest == newest
    data = store.read()
    assert {r["version"] for r in data.select("version").distinct().collect()} == set(newest.values())
    # only the attempts that the latest pointers name are read
    attempts = {r["attempt"] for r in store.latest().collect()}
    files = [f for f in data.inputFiles() if "/state/" in f]
    assert files and all(f.split("attempt=")[1].split("/")[0] in attempts for f in files)
    files = store.files().collect()
    assert files and all(f["length"] > 0 for f in files)
    manifest = store.manifest()
    assert manifest.agg(F.sum("rows")).first()[0] == data.count()
    assert {r["path"] for r in manifest.select("path").collect()} == {f["path"] for f in files}
    # offsets map names the changelog partition
    offs = store.latest().select("task", "offsets").collect()
    for r in offs:
        assert list(r["offsets"].values()) == [latest[r["task"]]]


def test_empty_state_publishes_no_pointer(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root, C.SAMPLE_APPLICATION_ID)
    empty = spark.createDataFrame([], "partition int, key string, window_start timestamp_ntz, "
                                      "window_end timestamp_ntz, agg bigint")
    pos = spark.createDataFrame([(0, 5)], "partition int, version bigint")
    assert store.publish(empty, pos).count() == 0
    assert store.latest().count() == 0
    assert store.read().count() == 0


def test_failed_write_keeps_pointer(spark, store_pipeline, tmp_root):
    cl, _ = store_pipeline
    store = SnapshotStore(spark, tmp_root, C.SAMPLE_APPLICATION_ID)
    pos = scenario.snapshot_positions(cl, scenario.SCENARIO.snapshot_cuts[0])
    store.publish(restore.state_as_of(cl, pos), pos)
    before = sorted(tuple(r) for r in store.latest().select("task", "version").collect())
    bad = restore.state_as_of(cl, pos).withColumn("agg", F.assert_true(F.lit(False)).cast("bigint"))
    later = pos.select("topic", "partition", (F.col("version") + 1000).alias("version"))
    with pytest.raises(Exception):
        store.publish(bad, later)
    assert sorted(tuple(r) for r in store.latest().select("task", "version").collect()) == before


STATE = "topic string, partition int, key string, window_start timestamp_ntz, window_end timestamp_ntz, agg bigint"
W0, W1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1)


def small_state(spark, rows):
    return spark.createDataFrame([(t, p, k, W0, W1, a) for t, p, k, a in rows], STATE)


def at(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, version long")


def test_lost_or_short_data_is_an_error(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root, "app")
    store.publish(small_state(spark, [("t", 0, "a", 1), ("t", 0, "b", 2), ("t", 1, "c", 3)]), at(spark, [("t", 0, 5), ("t", 1, 5)]))
    assert store.read().count() == 3
    attempt = store.latest().first()["attempt"]
    # one row of the attempt is lost
    short = small_state(spark, [("t", 0, "a", 1), ("t", 1, "c", 3)])
    path = store.attempt_path("state", attempt)
    kept = store.read().where("key <> 'b'").drop("attempt")
    spark.createDataFrame(kept.collect(), kept.schema).write.mode("overwrite").partitionBy("task").parquet(path)
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.read(verify=False).count() == short.count()
    # a pointer whose attempt was never written
    ghost = SnapshotStore(spark, tmp_root, "ghost")
    ghost.publish(small_state(spark, [("t", 0, "a", 1)]), at(spark, [("t", 0, 5)]))
    store.latest().withColumn("attempt", F.lit("none")).write.mode("append").parquet(ghost.table_path("versions") + "/attempt=none")
    with pytest.raises(FileNotFoundError):
        ghost.read(ghost._pointers().where("attempt = 'none'"))


def test_replayed_publish_adds_no_version_and_spoils_none(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root, "app")
    state, pos = small_state(spark, [("t", 0, "a", 1)]), at(spark, [("t", 0, 5)])
    store.publish(state, pos)
    first = {f["path"] for f in store.files().collect()}
    store.publish(state, pos)
    assert store.versions().count() == 1 and store.latest().count() == 1
    assert [r["agg"] for r in store.read().collect()] == [1]
    # the first attempt's files are still there, whole
    assert all(spark.read.parquet(p).count() == 1 for p in first)


def test_topics_that_share_a_partition_number(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root, "app")
    store.publish(small_state(spark, [("t1", 0, "a", 5), ("t2", 0, "b", 7)]), at(spark, [("t1", 0, 3), ("t2", 0, 9)]))
    assert sorted((r["topic"], r["key"], r["agg"], r["version"]) for r in store.read().collect()) == [
        ("t1", "a", 5, 3), ("t2", "b", 7, 9)]
    assert sorted(map(tuple, store.open()[1].collect())) == [("t1", 0, 3), ("t2", 0, 9)]


def test_any_value_columns(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root, "app")
    rows = small_state(spark, [("t", 0, "a", 5)]).withColumnRenamed("agg", "total").withColumn(
        "n", F.lit(2).cast("bigint")).withColumn("value_ts", F.col("window_start"))
    store.publish(rows, at(spark, [("t", 0, 3)]))
    r = store.read().first()
    assert (r["total"], r["n"], r["value_ts"]) == (5, 2, W0)


def test_one_stalled_partition_does_not_widen_the_cut_of_others(spark):
    pos = at(spark, [("t", 0, 1), ("t", 1, 1000)])
    cl = spark.createDataFrame([("t", p, o) for p in (0, 1, 2) for o in (0, 2, 999, 1001)], "topic string, partition int, offset long")
    got = sorted((r["partition"], r["offset"]) for r in cl.where(tail_filter(pos)).collect())
    assert got == [(0, 2), (0, 999), (0, 1001), (1, 1001), (2, 0), (2, 2), (2, 999), (2, 1001)]


def test_restoring_store_with_several_remote_entries_and_no_local(spark):
    status = spark.createDataFrame([(3, S, True)], "partition int, store string, restoring boolean")
    l_df = spark.createDataFrame([], OFF)
    r_df = spark.createDataFrame([(A, "0_3", S, T, 3, 7), (A, "0_3", S, T, 4, 7)], OFF)
    r = restore.restore_decision(l_df, r_df, status=status).collect()[0]
    assert (r["should_fetch"], r["reason"]) == (False, "store already restoring")


def test_records_without_a_key_close_no_window(spark):
    rows = [("t", 0, 0, W0, "a", 1), ("t", 0, 1, dt.datetime(2024, 2, 1), None, 5)]
    recs = spark.createDataFrame(rows, "topic string, partition int, offset long, ts timestamp_ntz, key string, value long")
    assert lateness.final_windows(recs).count() == 0
    assert [r["key"] for r in lateness.live_windows(recs).collect()] == ["a"]


def test_composed_restore(spark, store_pipeline, tmp_root):
    """Decide, fetch, merge, replay: with a threshold that lets one task fetch and one not."""
    from windlass import api
    cl, full = store_pipeline
    opts = C.SnapshotOptions(path=tmp_root, app_id=C.SAMPLE_APPLICATION_ID, threshold=20)
    pos = scenario.snapshot_positions(cl, scenario.SCENARIO.snapshot_cuts[-1])
    api.with_snapshot(restore.state_as_of(cl, pos), pos, opts)
    versions = {r["partition"]: r["version"] for r in pos.collect()}
    behind = {p: v - (5 if p % 2 else 50) for p, v in versions.items()}
    local_pos = at(spark, [(r["topic"], r["partition"], behind[r["partition"]]) for r in pos.collect()])
    local = spark.createDataFrame([(opts.app_id, f"0_{p}", opts.store, C.changelog_topic(opts.app_id, opts.store), p, o)
                                   for p, o in behind.items()], OFF)
    got = api.restore(spark, opts, cl, local, local_state=restore.state_as_of(cl, local_pos))
    assert {r["task"]: r["should_fetch"] for r in got.decision.collect()} == {f"0_{p}": p % 2 == 0 for p in versions}
    assert {r["partition"]: r["offset"] for r in got.offsets.collect()} == {p: versions[p] if p % 2 == 0 else behind[p] for p in versions}
    assert {(r["key"], r["window_start"]): r["agg"] for r in got.state.collect()} == full
    # tasks without local state replay everything
    again = api.restore(spark, opts, cl, local)
    assert {(r["key"], r["window_start"]): r["agg"] for r in again.state.collect()} == full


def test_threshold_constant():
    assert C.RESTORE_OFFSET_THRESHOLD == 10_000 and C.DEFAULT_SNAPSHOT_FREQUENCY == 20
