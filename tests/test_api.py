"""User API: opt a stream into snapshots, restore, helpers."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from windlass import api
from windlass import config as C
from windlass.functions.columns import layout_path, layout_path_str
from windlass.sources.records import read_records, stream_records_from_files
from windlass.streaming.files import write_record_batches


def test_snapshotted_aggregation_and_restore(spark):
    root = tempfile.mkdtemp(prefix="windlass-api-")
    files = write_record_batches(read_records(spark, SF001), f"{root}/in", 3)
    opts = C.SnapshotOptions(path=f"{root}/snap", app_id="app", store="hourly", every_n=1)
    seen = []
    q, sink = api.snapshotted_aggregation(
        stream_records_from_files(spark, f"{root}/in", max_files_per_trigger=files), opts, f"{root}/ckpt", size_seconds=3600,
        available_now=True, on_update=lambda df, i: seen.append(df.count()))
    q.awaitTermination()
    assert len(seen) >= 3
    state = {(r["key"], r["window_start"]): r["agg"] for r in sink.state().collect()}
    restored = {(r["key"], r["window_start"]): r["agg"]
                for r in api.restore_state(spark, opts, sink.changelog().drop("batch_id")).collect()}
    assert restored == state and state


def test_layout_path_column_and_string(spark):
    parts = [" s3a://bucket/prefix/ ", "", "app", "0_1/", "store "]
    expect = "s3a://bucket/prefix/app/0_1/store"
    assert layout_path_str(*parts) == expect
    got = spark.range(1).select(layout_path(*parts).alias("p")).collect()[0]["p"]
    assert got == expect


def test_segment_interval_rule():
    assert C.segment_interval_seconds(86_400) == 43_200
    assert C.segment_interval_seconds(30) == 60


def test_sampling_rate(spark):
    from windlass.functions.columns import sampled
    n = spark.range(200_000).where(sampled(F.col("id"), 20)).count()
    assert 9_000 < n < 11_000


def test_several_aggregates_in_a_snapshotted_stream(spark):
    root = tempfile.mkdtemp(prefix="windlass-api-")
    recs = read_records(spark, SF001)
    files = write_record_batches(recs, f"{root}/in", 3)
    opts = C.SnapshotOptions(path=f"{root}/snap", app_id="app", every_n=1)
    aggs = {"n": F.count(F.lit(1)), "low": F.min("value"), "high": F.max("value")}
    q, sink = api.snapshotted_aggregation(
        stream_records_from_files(spark, f"{root}/in", max_files_per_trigger=files), opts, f"{root}/ckpt",
        size_seconds=10_000_000, aggs=aggs, available_now=True)
    q.awaitTermination()
    rows = sink.store.read().collect()
    w = F.window("ts", "10000000 seconds")
    want = {(r["key"], r["w"]["start"]): (r["n"], r["low"], r["high"], r["value_ts"]) for r in
            recs.groupBy("key", w.alias("w")).agg(*[c.alias(n) for n, c in aggs.items()], F.max("ts").alias("value_ts")).collect()}
    assert {(r["key"], r["window_start"]): (r["n"], r["low"], r["high"], r["value_ts"]) for r in rows} == want
    # the version knows how far into the source it reaches
    ends = {(r["topic"], r["partition"]): r["m"] for r in recs.groupBy("topic", "partition").agg(F.max("offset").alias("m")).collect()}
    assert {(r["topic"], r["partition"]): r["position"] for r in sink.store.sources().collect()} == ends


def test_checkpoint_dir_is_required_off_a_local_master(spark, monkeypatch):
    import pytest

    from windlass import session

    class Remote:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Remote())


def test_scratch_dir_keeps_the_uri(spark):
    from windlass import session

    class Shared:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: "file:///shared/x")})()
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: "file:///shared/x")})()

    assert session.scratch_dir(Shared(), "a").startswith("file:///shared/x/windlass/a/")
