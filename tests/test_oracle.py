"""Every registered query against its DuckDB oracle (the driver's gate)."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from windlass.plans.oracle import oracle_sql
from windlass.plans.queries import QUERIES

NAMES = sorted(oracle_sql())
# the snapshot queries write files; run them once with the default span
SNAPSHOT = {"snapshot_state", "latest_snapshot", "read_snapshot", "snapshot_manifest", "restore_with_tail",
            "bootstrap_stream", "snapshot_aggregates", "tumbling_stream", "for_each_update", "read_operator_state",
            "query_events", "expiring_stream", "window_rows_stream", "session_stream", "enrich_orders", "live_stream"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    return con


def _check(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    res = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    _check(spark, duck, name)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in SNAPSHOT])
def test_query_matches_oracle_many_blocks(spark, duck, small_span, name):
    _check(spark, duck, name)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "window_start", "window_end", "agg"]
    assert df.count() > 0
