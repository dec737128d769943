"""Embedding near-dedup by an exact metric range join.

Unit vectors of cosine c lie sqrt(2 - 2c) apart, so "cosine >= t" is "distance <=
r". Within a label, pivots cut the vectors into cells that join independently:

* a vector's home is the cell of its nearest pivot, in its core (within r / 2 of
  the pivot) or its outer ring;
* it is replicated to every other cell that could hold one of its links: the
  triangle inequality bounds how much farther that cell's pivot may be (2 r), how
  near its bisecting plane must be (r), and how the distance to the pivot must lie
  to those of the cell's home vectors (r to either side). All of a vector's links
  meet it in its home cell, which alone counts them;
* within a cell, vectors are sorted by their distance to the pivot; only those within
  r of one another there are compared;
* two vectors of a core are linked for certain, again by the triangle inequality, so a
  core of any number of near copies is counted and linked without comparing them.

Equal vectors are one vector with a count. Cells beyond ``TILE`` rows are cut into
chunks, and pairs of chunks join in tasks of their own, so no task holds more than
two chunks, however large a cell is. Pairs are never emitted: a task gives a count per
vector and a spanning forest of what it linked.

Where vectors have no structure at all (independent, uniform directions), a pivot
separates little and an exact join compares most pairs of a label, within tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windlass.llm.common import join_small, write_table
from windlass.llm.components import components

LEAST_COSINE = 0.93
CELL_ROWS = 2_000  # distinct vectors per pivot
MAX_PIVOTS = 32  # of one label
MAX_LABELS = 64  # labels with pivots, the largest; others are one cell each
PIVOT_SAMPLE = 256  # vectors of a label that its pivots are chosen from
TILE = 8_000
SLACK = 1e-6  # on every bound, far beyond rounding
BLOCK = 512

GROUP = ["label", "dim"]
CELL = [*GROUP, "pivot", "ring"]
CORE, OUTER = 0, 1
COUNT, LINK = 0, 1


def unit(column) -> np.ndarray:
    """Arrow lists of equal length as unit rows; scaled first, so that no norm overflows."""
    if not len(column):
        return np.zeros((0, 0))
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def choose_pivots(sample: np.ndarray, k: int, radius: float) -> np.ndarray:
    """Up to ``k`` rows: first those with the most uncovered rows within radius / 2 (so that
    dense places are cores), then the ones farthest from all chosen."""
    apart = distances(sample, sample)
    near = apart <= radius / 2
    open_, chosen = np.ones(len(sample), bool), []
    while len(chosen) < min(k, len(sample)):
        covers = (near & open_).sum(1)
        best = int(covers.argmax())
        if covers[best] < 2:
            break
        chosen.append(best)
        open_ &= ~near[best]
    if not chosen:
        chosen.append(0)
    while len(chosen) < min(k, len(sample)):
        chosen.append(int(apart[:, chosen].min(1).argmax()))
    return sample[chosen]


def _homes(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distances to all pivots, nearest pivot, ring) of each row."""
    d = distances(x, pivots)
    home = d.argmin(1)
    core = d[np.arange(len(x)), home] <= radius / 2 - SLACK
    return d, home, np.where(core, CORE, OUTER)


def _by_group(rb: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, rows, unit vectors) of a batch with columns g and v."""
    g = rb.column("g").fill_null(-1).to_numpy(zero_copy_only=False)
    for one in np.unique(g):
        rows = np.flatnonzero(g == one)
        if one >= 0:  # one length of vector per group
            yield int(one), rows, unit(rb.column("v").take(pa.array(rows)))


def _ranges(pivots: dict[int, np.ndarray], radius: float):
    """mapInArrow body: how far the home vectors of each cell lie from its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for rb in batches:
            for g, _, x in _by_group(rb):
                d, home, ring = _homes(x, pivots[g], radius)
                own = d[np.arange(len(x)), home]
                for cell in np.unique(home * 2 + ring):
                    here = own[home * 2 + ring == cell]
                    old = found.setdefault((g, int(cell) // 2, int(cell) % 2), [np.inf, -np.inf])
                    old[:] = [min(old[0], here.min()), max(old[1], here.max())]
        if found:
            g, p, r = (pa.array(c, pa.int32()) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([g, p, r, *(pa.array(c, pa.float64()) for c in zip(*found.values()))],
                                             names=["g", "pivot", "ring", "low", "high"])

    return run


def reach(x: np.ndarray, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, radius: float):
    """(row, pivot, ring, distance, home) of every cell that each row belongs to: its home and
    the cells that may hold a link. ``low`` and ``high`` (pivots x 2): where their homes lie."""
    d, home, ring = _homes(x, pivots, radius)
    rows = np.arange(len(x))
    own = d[rows, home][:, None]
    between = distances(pivots, pivots)[home]
    # triangle inequality: a link y of cell q has d(y, q) <= d(y, p), so d(x, q) <= d(x, p) + 2 r
    may = d <= own + 2 * radius + SLACK
    # and x is within r of the plane between p and q
    may &= d ** 2 - own ** 2 <= 2 * between * radius + SLACK
    may[rows, home] = True
    inside = may[:, :, None] & (d[:, :, None] >= low - radius - SLACK) & (d[:, :, None] <= high + radius + SLACK)
    inside[rows, home, ring] = True
    at, p, k = np.nonzero(inside)
    return at, p, k, d[at, p], (home[at] == p) & (ring[at] == k)


def _dealt(pivots: dict[int, np.ndarray], bounds: dict[int, tuple], radius: float, names: list[str]):
    """mapInArrow body: each vector once for every cell that it belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rb, at, p, k, d, home):
            part = rb.take(pa.array(at))
            return pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(d), pa.array(home)],
                names=[*names, "pivot", "ring", "d", "home"])

        for rb in batches:
            g = rb.column("g").fill_null(-1).to_numpy(zero_copy_only=False)
            alone = np.flatnonzero(g < 0)
            if len(alone):  # a label without pivots is one cell
                n = len(alone)
                yield out(rb, alone, np.full(n, -1), np.full(n, OUTER), np.zeros(n), np.ones(n, bool))
            for one, rows, x in _by_group(rb):
                for a in range(0, len(rows), 2_000):
                    at, p, k, d, home = reach(x[a:a + 2_000], pivots[one], *bounds[one], radius)
                    yield out(rb, rows[a:a + 2_000][at], p, k, d, home)

    return run


class Forest:
    """Classes of nodes, joined block by block."""

    def __init__(self, nodes: int) -> None:
        self.label = np.arange(nodes)

    def join(self, a: np.ndarray, b: np.ndarray, links: np.ndarray) -> None:
        """Join the nodes a[i] and b[j] wherever ``links[i, j]``."""
        rows, cols = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
        if not len(rows):
            return
        links, a, b = links[np.ix_(rows, cols)], a[rows], b[cols]
        while True:
            la, lb = self.label[a], self.label[b]
            least = np.where(links, lb[None, :], len(self.label)).min(1)
            new = np.minimum(la, least)
            if (new == la).all():
                back = np.where(links, la[:, None], len(self.label)).min(0)
                if (lb <= back).all():
                    return
                old, to = lb, np.minimum(lb, back)
            else:
                old, to = la, new
            self._rename(old, to)

    def _rename(self, old: np.ndarray, to: np.ndarray) -> None:
        moved = old != to
        up: dict[int, int] = {}

        def top(x):
            while x in up:
                x = up[x]
            return x

        for x, y in np.unique(np.stack([old[moved], to[moved]], 1), axis=0).tolist():
            p, q = top(x), top(y)
            if p != q:
                up[max(p, q)] = min(p, q)
        names = np.arange(len(self.label))
        for x in up:
            names[x] = top(x)
        self.label = names[self.label]


def compare(x: np.ndarray, d: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, forest: Forest, counts: np.ndarray,
            least: float, radius: float, both: bool) -> None:
    """Links between the nodes ``a`` and ``b`` (the same array: among them), counted for a and,
    with ``both``, for b."""
    same = a is b
    a = a[np.argsort(d[a], kind="stable")]
    b = a if same else b[np.argsort(d[b], kind="stable")]
    db = d[b]
    for s in range(0, len(a), BLOCK):
        rows = a[s:s + BLOCK]
        # sorted by distance to the pivot: only rows within r of the block can be linked
        low = np.searchsorted(db, d[rows[0]] - radius - SLACK, "left")
        high = np.searchsorted(db, d[rows[-1]] + radius + SLACK, "right")
        for t in range(low, high, 16 * BLOCK):
            cols = b[t:min(t + 16 * BLOCK, high)]
            links = x[rows] @ x[cols].T >= least
            if same:
                links &= rows[:, None] != cols[None, :]
            if links.any():
                counts[rows] += links @ n[cols]
                if both and not same:
                    counts[cols] += n[rows] @ links
                forest.join(rows, cols, links)


def _tile(least: float, radius: float):
    """applyInArrow body: the links of a tile, as counts and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        x = unit(table["v"].combine_chunks())
        d, n, node = (table[c].to_numpy() for c in ("d", "n", "node"))
        home, chunk = table["home"].to_numpy(), table["chunk"].to_numpy()
        core = table["ring"][0].as_py() == CORE
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        forest, counts = Forest(len(node)), np.zeros(len(node), np.int64)
        args = (forest, counts, least, radius)
        if i == j:
            homes = np.flatnonzero(home)
            if not core:
                compare(x, d, n, homes, homes, *args, True)
            compare(x, d, n, homes, np.flatnonzero(~home), *args, False)
        else:
            left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            compare(x, d, n, left, right, *args, bool(len(right) and home[right[0]]))
        some, tied = np.flatnonzero(counts), np.flatnonzero(forest.label != np.arange(len(node)))
        return pa.table({"kind": pa.array(np.r_[np.full(len(some), COUNT), np.full(len(tied), LINK)], pa.int32()),
                         "a": pa.array(np.r_[node[some], node[tied]], pa.int64()),
                         "b": pa.array(np.r_[counts[some], node[forest.label[tied]]], pa.int64())})

    return run


def _pivots(nodes: DataFrame, radius: float, cell_rows: int, max_labels: int, max_pivots: int):
    """Table (label, dim, g) of the groups with pivots, and g -> pivots. At most
    ``max_labels`` groups of about ``PIVOT_SAMPLE`` sampled vectors pass through the driver."""
    sizes = (nodes.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > cell_rows)
             .orderBy(F.desc("rows"), *GROUP).limit(max_labels).collect())
    groups = nodes.sparkSession.createDataFrame(
        [(r["label"], r["dim"], g, min(1.0, PIVOT_SAMPLE / r["rows"])) for g, r in enumerate(sizes)],
        f"label {nodes.schema['label'].dataType.simpleString()}, dim int, g int, share double")
    some = nodes.join(F.broadcast(groups), GROUP).filter(
        F.pmod(F.xxhash64("node"), F.lit(1 << 31)) < F.col("share") * F.lit(float(1 << 31))).select("g", "v").toArrow()
    g = some["g"].to_numpy()
    out = {}
    for k, r in enumerate(sizes):
        sample = unit(some["v"].combine_chunks().take(pa.array(np.flatnonzero(g == k))))
        if len(sample):
            out[k] = choose_pivots(sample, min(max_pivots, math.ceil(r["rows"] / cell_rows)), radius)
    return groups.filter(F.col("g").isin(list(out))).drop("share"), out


def plain(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, v, label); components stay float where they are."""
    floats = vectors.schema[vec_col].dataType.simpleString() == "array<float>"
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vec_col}`").cast("array<float>" if floats else "array<double>").alias("v"),
                          F.col(f"`{label_col}`").alias("label"))


def valid(rows: DataFrame) -> DataFrame:
    """Rows that may have links: a label, and finite components that are not all zero."""
    return rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull()
                       & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists("v", lambda x: x != 0))


def near_dedup(vectors: DataFrame, least: float = LEAST_COSINE, id_col: str = "vec_id", vec_col: str = "embedding",
               label_col: str = "label", *, cell_rows: int = CELL_ROWS, max_labels: int = MAX_LABELS,
               max_pivots: int = MAX_PIVOTS, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links (others linked directly), component_id (smallest id
    reachable by links, itself included), kept (vec_id is component_id).

    Rows link if their labels are equal and not null and their cosine, in double
    precision, is at least ``least``. A vector that is null, empty, zero or holds null or
    non-finite components links with nothing, nor do vectors of different length.
    Repeated rows are rows of their own and linked like any equal vectors; a null id is
    larger than every id (component_id is null if all of a component's are, and kept is
    then true). Other columns are not read, whatever their names. An empty table gives
    an empty result.
    """
    radius = math.sqrt(2 - 2 * least)
    rows = plain(vectors, id_col, vec_col, label_col)
    nodes = write_table(valid(rows).groupBy("label", F.size("v").alias("dim"), "v")
                        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"))
                        .withColumn("node", F.monotonically_increasing_id()), "metric-nodes")
    groups, pivots = _pivots(nodes, radius, cell_rows, max_labels, max_pivots)
    known = nodes.join(F.broadcast(groups), GROUP, "left")  # at most max_labels rows
    bounds = {g: (np.full((len(p), 2), np.inf), np.full((len(p), 2), -np.inf)) for g, p in pivots.items()}
    found = (known.filter("g IS NOT NULL").select("g", "v").mapInArrow(
        _ranges(pivots, radius), "g int, pivot int, ring int, low double, high double")
        .groupBy("g", "pivot", "ring").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    for r in found:  # at most two rows per pivot
        low, high = bounds[r["g"]]
        low[r["pivot"], r["ring"]], high[r["pivot"], r["ring"]] = r["low"], r["high"]
    names = [*GROUP, "node", "n", "v"]
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    dealt = write_table(known.select(*names, "g").mapInArrow(
        _dealt(pivots, bounds, radius, names),
        ", ".join(f"{c} {kinds[c]}" for c in names) + ", pivot int, ring int, d double, home boolean"), "metric-cells")

    # tiles: homes in chunks 0 .. hs - 1, replicas in the chunks after them
    def chunks(rows):
        return F.ceil(rows / F.lit(tile))

    sizes = (dealt.groupBy(*CELL).agg(F.count(F.when(F.col("home"), 1)).alias("homes"),
                                      F.count(F.when(~F.col("home"), 1)).alias("others"))
             .filter(F.col("homes") + F.col("others") > tile)
             .select(*CELL, chunks(F.col("homes")).alias("hs"), chunks(F.col("others")).alias("os")))
    cut = join_small(dealt, sizes, CELL, "node")
    part = F.when(F.col("home"), F.pmod(F.xxhash64("node"), F.col("hs"))).otherwise(
        F.col("hs") + F.pmod(F.xxhash64("node"), F.col("os")))
    tiles = F.expr("""CASE WHEN hs IS NULL THEN array(named_struct('i', 0L, 'j', 0L))
        WHEN NOT home THEN transform(IF(hs > 0, sequence(0, hs - 1), array()), o -> named_struct('i', o, 'j', chunk))
        ELSE transform(filter(sequence(0, hs + os - 1), o -> NOT (ring = 0 AND o < hs)),
                       o -> named_struct('i', least(chunk, o), 'j', greatest(chunk, o))) END""")
    placed = (cut.withColumn("chunk", F.when(F.col("hs").isNull(), F.lit(0).cast("long")).otherwise(part))
              .withColumn("at", F.explode(tiles)).select(*CELL, "node", "n", "v", "d", "home", "chunk", "at.i", "at.j"))
    joined = write_table(placed.groupBy(*CELL, "i", "j").applyInArrow(_tile(least, radius), "kind int, a long, b long"),
                         "metric-links")

    # a core is linked whole: every vector to its first, and counted by its size
    core = dealt.filter((F.col("ring") == CORE) & F.col("home"))
    cores = core.groupBy(*CELL).agg(F.sum("n").alias("all"), F.min("node").alias("first"))  # at most one row per pivot
    sure = core.select(*CELL, "node", "n").join(F.broadcast(cores), CELL)
    counts = joined.filter(F.col("kind") == COUNT).select(F.col("a").alias("node"), F.col("b").alias("links")).unionByName(
        sure.select("node", (F.col("all") - F.col("n")).alias("links")))
    links = joined.filter(F.col("kind") == LINK).select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        sure.select(F.col("node").alias("src"), F.col("first").alias("dst")))
    near = nodes.join(counts.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").select(
        "node", "label", "v", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")).filter("n_links > 0")
    roots = components(links).withColumnsRenamed({"src": "node", "dst": "root"})
    rooted = write_table(near.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "metric-near")
    tops = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    linked = join_small(rooted, tops, ["root"], "node").select("label", "v", "n_links", "component_id", F.lit(True).alias("has"))
    # only vectors with a link are looked up
    out = rows.join(linked, ["label", "v"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("has"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN n USING (vec_id)
"""
