"""Block-parallel scans equal their single-window definitions (brute force
in pandas) for any block span, including hot groups spanning many blocks."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windlass.operators import scan, windows

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(-50, 50), st.integers(0, 40)), min_size=1, max_size=60)


def _frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["g", "v", "t"])
    pdf["o"] = np.arange(len(pdf))  # unique order key
    return spark.createDataFrame(pdf), pdf


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, span=st.integers(1, 7))
def test_running_matches_window(spark, rows, span):
    df, pdf = _frame(spark, rows)
    out = scan.running(df, ["g"], "o", [("s", "sum", F.col("v")), ("m", "max", F.col("v")),
                                       ("n", "min", F.col("v")), ("c", "count", F.lit(1))], span=span)
    got = out.toPandas().sort_values("o").reset_index(drop=True)
    exp = pdf.sort_values("o").copy()
    grp = exp.groupby("g")["v"]
    exp["s"], exp["m"], exp["n"] = grp.cumsum(), grp.cummax(), grp.cummin()
    exp["c"] = exp.groupby("g").cumcount() + 1
    exp = exp.reset_index(drop=True)
    for c in ["s", "m", "n", "c"]:
        assert got[c].tolist() == exp[c].tolist(), c


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, span=st.integers(1, 7))
def test_exclusive_running(spark, rows, span):
    df, pdf = _frame(spark, rows)
    ex = scan.running(df, ["g"], "o", [("s", "sum", F.col("v"))], span=span, inclusive=False)
    got = ex.toPandas().sort_values("o")
    exp = pdf.sort_values("o").copy()
    exp["s"] = exp.groupby("g")["v"].cumsum() - exp["v"]
    first = exp.groupby("g").cumcount() == 0
    assert [None if f else int(x) for f, x in zip(first, exp["s"])] == \
        [None if pd.isna(x) else int(x) for x in got["s"]]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, gap=st.integers(0, 6), width=st.integers(1, 9))
def test_session_starts(spark, rows, gap, width):
    df, pdf = _frame(spark, rows)
    out = scan.session_starts(df, ["g"], "t", gap, block=F.floor(F.col("t") / width).cast("bigint"),
                              name="s").toPandas()
    exp = {}
    for g, part in pdf.groupby("g"):
        start, prev = None, None
        for t in sorted(part["t"]):
            if prev is None or t - prev > gap:
                start = t
            exp.setdefault(g, {})[t] = start
            prev = t
    for r in out.itertuples():
        assert r.s == exp[r.g][r.t]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, span=st.integers(1, 5), drift=st.integers(-10, 30))
def test_max_plus_fold_is_cusum(spark, rows, span, drift):
    df, pdf = _frame(spark, rows)
    got = windows.max_plus_fold(df, ["g"], "o", F.lit(0), F.col("v") - F.lit(drift), 0, span=span).toPandas()
    run = windows.max_plus_fold(df, ["g"], "o", F.lit(0), F.col("v") - F.lit(drift), 0, span=span,
                                running=True).toPandas().sort_values("o")
    exp_final, exp_run = {}, []
    state = {}
    for r in pdf.sort_values("o").itertuples():
        state[r.g] = max(0, state.get(r.g, 0) + r.v - drift)
        exp_run.append(state[r.g])
    exp_final = state
    assert dict(zip(got["g"], got["agg"])) == exp_final
    assert run["agg"].tolist() == exp_run


def test_ordered_fold_generic(spark):
    pdf = pd.DataFrame({"g": [1, 1, 2, 1, 2], "o": [0, 1, 2, 3, 4], "v": [3, -5, 2, 4, 1]})
    df = spark.createDataFrame(pdf).repartition(3)
    # non-commutative: agg = 2 * agg + v
    out = windows.ordered_fold(df, ["g"], "o", "v", 0, lambda a, v: 2 * a + v, "g long, agg long")
    assert dict((r["g"], r["agg"]) for r in out.collect()) == {1: 2 * (2 * 3 - 5) + 4, 2: 2 * 2 + 1}


@pytest.mark.parametrize("span", [1, 2, 1000])
def test_row_number_offsets(spark, span):
    df = spark.range(0, 50).select((F.col("id") % 3).alias("p"), F.col("id").alias("e"))
    out = scan.row_number(df, ["p"], "e", "off", span=span, start=0).toPandas()
    for p, part in out.groupby("p"):
        assert sorted(part["off"]) == list(range(len(part)))
        assert part.sort_values("e")["off"].tolist() == list(range(len(part)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20), st.integers(0, 30)), min_size=1,
                     max_size=50), rng=st.integers(0, 8), block=st.integers(1, 9))
def test_sliding_sum_probes_match_range_frame(spark, rows, rng, block):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    pdf = pd.DataFrame([{"topic": "t", "partition": 0, "offset": i, "key": str(k), "value": v,
                         "ts": base + dt.timedelta(seconds=s)} for i, (k, v, s) in enumerate(rows)])
    df = spark.createDataFrame(pdf, "topic string, partition int, offset long, key string, value long, "
                                    "ts timestamp_ntz")
    got = {r["offset"]: r["agg"] for r in windows.sliding_sum(df, rng, block_seconds=block).collect()}
    for r in pdf.itertuples():
        same = pdf[(pdf.key == r.key) & (pdf.ts >= r.ts - dt.timedelta(seconds=rng)) & (pdf.ts <= r.ts)]
        assert got[r.offset] == same.value.sum()


def test_null_groups_keep_their_prefix(spark):
    rows = [(None if i % 2 else 7, i) for i in range(14)]
    df = spark.createDataFrame(rows, "g int, o long")
    got = scan.row_number(df, ["g"], "o", "n", span=3, start=0).collect()
    for g in (None, 7):
        assert [r["n"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["o"])] == list(range(7))


def test_records_of_equal_times_are_one_row_of_a_block(spark):
    """Sessions and sliding sums first add up a key's records of one time, so a hot key
    with coarse times never makes a block larger than its distinct times."""
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [("t", 0, i, "k", 1, base + dt.timedelta(days=i % 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value long, ts timestamp_ntz")
    sessions = windows.session_sum(df, 3600).collect()
    assert sorted((r["session_start"], r["n"], r["agg"]) for r in sessions) == [
        (base + dt.timedelta(days=d), 1000, 1000) for d in range(3)]
    sums = windows.sliding_sum(df, 86_400)
    assert {(r["ts"], r["agg"]) for r in sums.collect()} == {
        (base, 1000), (base + dt.timedelta(days=1), 2000), (base + dt.timedelta(days=2), 2000)}
    assert sums.count() == 3000
