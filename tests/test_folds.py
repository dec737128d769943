"""User folds in parts, distinct sliding windows, sessions from stretches."""

import datetime as dt

import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windlass.operators import windows
from windlass.operators.windows import Fold
from windlass.sources.records import read_records

T0 = dt.datetime(2024, 1, 1)
RECORD = "topic string, partition int, offset long, ts timestamp_ntz, key string, value long"


def records(spark, rows):
    """(key, milliseconds, value), offsets in order"""
    return spark.createDataFrame([("t", 0, i, T0 + dt.timedelta(milliseconds=ms), k, v) for i, (k, ms, v) in enumerate(rows)], RECORD)


def text_fold(separator="|"):
    """Keeps every value in order: any wrong merge order shows."""
    return Fold(lambda: (0, ""), lambda s, v: (s[0] + 1, s[1] + f"{v}{separator}"), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                "n int, text string")


@pytest.mark.parametrize("span,fan_in", [(None, 1_024), (7, 2), (3, 3), (1, 2), (1_000, 4)])
def test_parts_are_merged_in_order_whatever_the_blocks(spark, span, fan_in):
    rows = [(i, ("hot" if i % 3 else f"k{i % 5}"), i * 37 % 101) for i in range(300)]
    df = spark.createDataFrame(rows, "offset long, key string, value long").repartition(5)
    got = {r["key"]: (r["n"], r["text"]) for r in
           windows.parallel_fold(df, ["key"], "offset", ["value"], text_fold(), span=span, fan_in=fan_in).collect()}
    want = {}
    for _, k, v in rows:
        n, t = want.get(k, (0, ""))
        want[k] = (n + 1, t + f"{v}|")
    assert got == want


def test_a_hot_group_is_dealt_over_blocks_and_fan_in(spark, monkeypatch):
    """No task of a level folds more of one group than a block, or fan_in states."""
    seen = []
    plain = windows._grouped_fold

    def watched(by, values, out, start, step):
        seen.append(tuple(by))
        return plain(by, values, out, start, step)

    monkeypatch.setattr(windows, "_grouped_fold", watched)
    df = spark.range(1_000).select(F.col("id").alias("offset"), F.lit("hot").alias("key"), F.col("id").alias("value"))
    got = windows.parallel_fold(df, ["key"], "offset", ["value"], text_fold(","), span=10, fan_in=10).collect()
    assert got[0]["n"] == 1_000 and got[0]["text"] == "".join(f"{i}," for i in range(1_000))
    assert seen[0] == ("key", "__blk") and set(seen[1:]) == {("key", "__up")}


def test_null_and_nan_groups_stay_whole(spark):
    """A null number is one group, NaN another, each folded once, also over several batches."""
    rows = [(i, None if i % 3 == 0 else float("nan") if i % 3 == 1 else 1.5, None if i % 2 else 7, 1) for i in range(60)]
    df = spark.createDataFrame(rows, "offset long, a double, b long, value long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = windows.ordered_fold(df, ["a", "b"], "offset", "value", 0, lambda s, v: s + v, "a double, b long, agg long").collect()
        par = windows.parallel_fold(df, ["a", "b"], "offset", ["value"], text_fold(), span=16, fan_in=2).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == 6 and all(r["agg"] == 10 for r in out)
    assert len(par) == 6 and all(r["n"] == 10 for r in par)


def test_empty_input_folds_to_nothing(spark):
    df = spark.createDataFrame([], "offset long, key string, value long")
    assert windows.parallel_fold(df, ["key"], "offset", ["value"], text_fold()).collect() == []


def test_longest_rise_over_many_blocks(spark):
    recs = read_records(spark, SF001)
    cols = ("key", "window_start", "n", "longest")
    whole = sorted(tuple(r[c] for c in cols) for r in windows.longest_rise(recs).collect())
    for span, fan_in in ((5, 2), (1, 3)):
        assert sorted(tuple(r[c] for c in cols) for r in windows.longest_rise(recs, span=span, fan_in=fan_in).collect()) == whole


def brute_windows(rows, difference):
    """Every distinct non-empty set of a key's records within some [e - difference, e], named by the
    first millisecond at which it is the current one."""
    out = {}
    for key in {k for k, _, _ in rows}:
        mine = [(ms, v) for k, ms, v in rows if k == key]
        last = None
        for e in range(min(m for m, _ in mine), max(m for m, _ in mine) + difference + 2):
            held = tuple(sorted((i for i, (m, _) in enumerate(mine) if e - difference <= m <= e)))
            if held and held != last:
                out[key, e] = (len(held), sum(mine[i][1] for i in held))
            last = held
    return out


@pytest.mark.parametrize("block_seconds", [1, 3_600])
def test_every_distinct_sliding_window_once(spark, block_seconds):
    rows = [("a", 0, 1), ("a", 400, 2), ("a", 1_000, 4), ("a", 1_000, 8), ("a", 2_001, 16), ("a", 2_002, 32), ("b", 5, 1), ("b", 9_000, 2),
            ("b", 9_999, None)]
    got = windows.sliding_windows(records(spark, rows + [(None, 3, 9)]), 1, block_seconds=block_seconds)
    have = {(r["key"], (r["window_end"] - T0) // dt.timedelta(milliseconds=1)): (r["n"], r["agg"]) for r in got.collect()}
    assert have == brute_windows([(k, ms, v or 0) for k, ms, v in rows], 1_000)
    assert got.where(F.col("window_end") - F.col("window_start") != F.expr("INTERVAL 1 SECOND")).count() == 0


def brute_sessions(rows, gap):
    out = []
    for k, ms, v in sorted(rows):
        if out and out[-1][0] == k and ms - out[-1][2] <= gap:
            out[-1] = (k, out[-1][1], ms, out[-1][3] + 1, out[-1][4] + v)
        else:
            out.append((k, ms, ms, 1, v))
    return out


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30_000), st.integers(-5, 5)), min_size=1, max_size=60),
       gap=st.sampled_from([1, 2, 5]), block=st.sampled_from([None, 1, 7]))
def test_sessions_from_stretches_equal_brute_force(spark, rows, gap, block):
    got = windows.session_sum(records(spark, rows), gap, block_seconds=block)
    ms = dt.timedelta(milliseconds=1)
    have = sorted((r["key"], (r["session_start"] - T0) // ms, (r["session_end"] - T0) // ms, r["n"], r["agg"]) for r in got.collect())
    assert have == brute_sessions(rows, gap * 1_000)
