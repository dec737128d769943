import numpy as np
import pytest
from helpers import rows_of

from windlass.llm import metric_join as mj
from windlass.llm.queries import ORACLE_SQL


CLASH = "g string, pivot string, ring string, node string, n string, v string, home string, links string, low string, dim string"
NAMES = [c.split()[0] for c in CLASH.split(", ")]


def table(spark, rows, kind="float"):
    extra = (None,) * len(NAMES)
    return spark.createDataFrame([(i, v, label, *extra) for i, v, label in rows],
                                 f"vec_id long, embedding array<{kind}>, label int, {CLASH}")


def brute(rows, least=0.93):
    """All pairs, position by position."""
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, _ in rows]
    linked = [[False] * n for _ in range(n)]
    for a in range(n):
        for b in range(n):
            (_, x, la), (_, y, lb) = rows[a], rows[b]
            if a != b and ok[a] and ok[b] and la is not None and la == lb and len(x) == len(y):
                x, y = (np.array(v, np.float64) / max(abs(c) for c in v) for v in (x, y))
                linked[a][b] = float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))) >= least
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            k = todo.pop()
            new = {b for b in range(n) if linked[k][b]} - seen
            seen |= new
            todo += new
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[a][0], sum(linked[a]), low, rows[a][0] == low))
    return sorted(out, key=repr)


def clustered(seed, n, dim, labels=3):
    """Uniform directions, near copies of a few of them (a tight one of a third of all), exact copies."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    for k in range(n):
        if k % 3 == 1:
            x[k] = x[0] + r.normal(size=dim) * r.choice([0.05, 0.1, 0.25])
        elif k % 7 == 2:
            x[k] = x[k // 2] + r.normal(size=dim) * 0.2
        elif k % 11 == 5:
            x[k] = x[k // 2] * 2
    label = np.where(np.arange(n) % 3 == 1, 0, r.integers(0, labels, n))
    return [(int(k), [float(np.float32(c)) for c in x[k]], int(label[k])) for k in r.permutation(n)]


@pytest.mark.parametrize("seed,dim,settings", [
    (1, 3, dict(cell_rows=10, tile=12)), (2, 8, dict(cell_rows=15, tile=1_000)), (3, 16, dict(cell_rows=1_000, tile=9)),
    (4, 8, dict(cell_rows=20, tile=17, max_labels=1, max_pivots=3)), (5, 2, {}), (6, 24, dict(cell_rows=25, tile=5))])
def test_links_and_components_equal_all_pairs(spark, seed, dim, settings):
    rows = clustered(seed, 240, dim)
    assert rows_of(mj.near_dedup(table(spark, rows), **settings)) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
            (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1),
            (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.001], 1), (None, [0.0, 1.0], 3), (12, [-0.0, 5.0], 4), (13, [0.0, 5.0], 4),
            (14, [1e300, 1e300], 5), (15, [1e-300, 1e-300], 5)]
    assert rows_of(mj.near_dedup(table(spark, rows, "double"))) == brute(rows)
    assert rows_of(mj.near_dedup(table(spark, [], "double"))) == []


def test_a_hot_core_is_counted_without_comparing(spark, monkeypatch):
    """A third of all rows within r / 2 of a pivot: linked by the triangle inequality alone."""
    rows = clustered(9, 300, 16)
    tight = [(1_000 + k, [float(np.float32(c)) for c in np.eye(16)[0] + np.random.default_rng(k).normal(size=16) * 0.01], 0)
             for k in range(200)]
    got = {r["vec_id"]: r for r in mj.near_dedup(table(spark, rows + tight), cell_rows=20, tile=16).collect()}
    assert all(got[i]["n_links"] >= 199 and got[i]["component_id"] == got[1_000]["component_id"] for i, _, _ in tight)
    assert rows_of(mj.near_dedup(table(spark, rows + tight), cell_rows=20, tile=16)) == brute(rows + tight)


def test_every_linked_pair_meets_in_both_homes():
    """Completeness of the replication: of a pair within r each one reaches the other's home."""
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 5))
    x[300:] = x[:300] + r.normal(size=(300, 5)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    radius = np.sqrt(2 - 2 * 0.93)
    pivots = mj.choose_pivots(x[::9], 12, radius)
    d, home, ring = mj._homes(x, pivots, radius)
    low, high = np.full((12, 2), np.inf), np.full((12, 2), -np.inf)
    for k in range(len(x)):
        own = d[k, home[k]]
        low[home[k], ring[k]] = min(low[home[k], ring[k]], own)
        high[home[k], ring[k]] = max(high[home[k], ring[k]], own)
    at, p, k, _, own = mj.reach(x, pivots, low, high, radius)
    cells = [set() for _ in x]
    for a, b, c in zip(at, p, k):
        cells[a].add((b, c))
    assert own.sum() == len(x)
    a, b = np.nonzero(x @ x.T >= 0.93)
    assert len(a) > 600
    assert all((home[j], ring[j]) in cells[i] for i, j in zip(a, b))
    # and the bounds do keep most vectors out of most cells here
    assert len(at) < 0.6 * len(x) * 24


def test_sql_is_registered():
    assert "op11_embedding_near_dedup" in ORACLE_SQL
