"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the median run is reported).

snapshot_state (publish one version of the store) and restore_with_tail
(newest snapshot + changelog tail) against restore_full_recompute (the same
state rebuilt from the raw input) and restore_full_changelog (compacting the
whole changelog). replay_tail_xK and replay_full_xK are the same comparison for
a store as it is run: 5-day windows, K times as many updates per window, a
snapshot at 98 % of the log. Each query is forced with a ``noop`` write, so the
whole plan runs and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from windlass.config import SAMPLE_APPLICATION_ID as APP  # noqa: E402
from windlass.operators import lateness, restore, scan, windows  # noqa: E402
from windlass.operators.restore import state_as_of  # noqa: E402
from windlass.plans import scenario  # noqa: E402
from windlass.session import build_session, scratch_dir  # noqa: E402
from windlass.sources.records import read_records  # noqa: E402
from windlass.sources.snapshots import SnapshotStore, tail_filter  # noqa: E402

HEADLINE = ["tumbling_sum", "strict_late_drop", "update_stream", "snapshot_state", "restore_with_tail"]


def run(df):
    df.write.format("noop").mode("overwrite").save()


REPLAY = (1, 10, 40)  # updates per window, times those of the events


def replay_case(spark, sf: str, root: str, k: int):
    """(tail replay, full replay) of a store with 5-day windows and k-fold updates."""
    path = f"{root}/replay{k}"
    one = lateness.changelog(read_records(spark, sf, stream_time=True), size_seconds=5 * 86_400)
    many = one.withColumn("__c", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
        "offset", F.col("offset") * k + F.col("__c")).drop("__c")
    (many.repartition("partition", scan.block_of("offset", scenario.CHANGELOG_BLOCK))
         .sortWithinPartitions("partition", "offset").write.partitionBy("partition").parquet(path))
    log = spark.read.parquet(path)
    ends = log.groupBy("topic", "partition").agg(F.max("offset").alias("m"))
    pos = ends.select("topic", "partition", F.floor(F.col("m") * 0.98).cast("bigint").alias("version"))
    store = SnapshotStore(spark, f"{root}/replay-store{k}", APP)
    store.publish(state_as_of(log, pos), pos)

    def tail():
        snap, positions = store.open()
        run(restore.restore_with_tail(snap, positions, log, cut=tail_filter(positions)))

    return tail, lambda: run(restore.changelog_compact(log))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", cpus, app_name="windlass-bench")
    spark.sparkContext.setLogLevel("ERROR")

    root = scratch_dir(spark, "bench")
    # the changelog topic, kept as a table (setup, not timed)
    cl = scenario.materialized_changelog(spark, sf, root)
    early, late = scenario.SCENARIO.snapshot_cuts
    # published history: a version at each scenario cut; restores use the newest
    base = SnapshotStore(spark, f"{root}/base", APP)
    for cut in (early, late):
        pos_cut = scenario.snapshot_positions(cl, cut)
        base.publish(state_as_of(cl, pos_cut), pos_cut)
    pos_late = scenario.snapshot_positions(cl, late)
    counter = iter(range(1_000_000))

    def snapshot_state():
        store = SnapshotStore(spark, f"{root}/snap{next(counter)}", APP)
        store.publish(state_as_of(cl, pos_late), pos_late)

    def restore_with_tail():
        snap, positions = base.open()
        run(restore.restore_with_tail(snap, positions, cl, cut=tail_filter(positions)))

    plans = {
        "tumbling_sum": lambda: run(windows.tumbling_sum(read_records(spark, sf, offsets=False))),
        "strict_late_drop": lambda: run(lateness.strict_late_drop(read_records(spark, sf, stream_time=True))),
        "update_stream": lambda: run(lateness.update_stream(read_records(spark, sf, stream_time=True))),
        "snapshot_state": snapshot_state,
        "restore_with_tail": restore_with_tail,
        "restore_full_recompute": lambda: run(lateness.strict_late_drop(read_records(spark, sf, stream_time=True))),
        "restore_full_changelog": lambda: run(restore.changelog_compact(cl)),
        "session_sum": lambda: run(windows.session_sum(read_records(spark, sf, offsets=False), 6 * 3600)),
        "sliding_sum": lambda: run(windows.sliding_sum(read_records(spark, sf), 6 * 3600)),
        "ordered_fold": lambda: run(windows.cusum(read_records(spark, sf), 5000)),
    }
    for k in REPLAY:
        plans[f"replay_tail_x{k}"], plans[f"replay_full_x{k}"] = replay_case(spark, sf, root, k)
    times = {}
    for name, fn in plans.items():
        fn()  # warm-up run per query (class loading, code generation)
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    total = round(sum(times[q] for q in HEADLINE), 3)
    sf_name = os.path.basename(os.path.normpath(sf)).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": sf_name, "cpus": cpus, "runs": runs,
                      "tail_vs_full": round(times["restore_with_tail"] / times["restore_full_recompute"], 3),
                      "replay_tail_vs_full": {f"x{k}": round(times[f"replay_tail_x{k}"] / times[f"replay_full_x{k}"], 3)
                                              for k in REPLAY}}))
    spark.stop()


if __name__ == "__main__":
    main()
