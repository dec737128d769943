"""Approximate nearest neighbours with an inverted multi-index.

A vector is cut in halves; each half has its own codebook of ``k`` centroids,
and a vector's cell is the pair of its nearest centroids, so 2k centroids
make k * k cells. A query walks the cells in order of the summed distance of
its halves to the two centroids, by a heap over centroid pairs, until the
cells seen hold enough entries; those entries are reranked by exact distance.

* Codebooks are fitted on a bounded sample (``SAMPLE`` vectors, by hash of the
  id); every vector is indexed.
* How many entries are enough is calibrated, not set: for ``CALIBRATION``
  queries the true neighbours are found by brute force over all rows, and the
  visit length is the one that reaches ``RECALL`` of them. Clustered vectors
  need few entries; vectors without structure need a large part of the table.
* Equal vectors are indexed once with their ``top + 1`` smallest ids, which is
  all that any answer can use, and equal query vectors are searched once. A
  vector that a third of all rows share is then a few rows.
* Entries are dealt by first centroid and cut into blocks of ``BLOCK`` rows;
  each block meets the queries that visit it in chunks of ``CHUNK``. Codebooks,
  cell counts (k * k numbers) and the calibration queries are all that goes
  through the driver, each of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windlass.llm.common import width, write_table

SAMPLE = 20_000  # vectors that the codebooks are fitted on
CALIBRATION = 128  # queries that set the visit length
RECALL = 0.95
MAX_CENTROIDS = 256  # per half
BLOCK = 20_000
CHUNK = 20_000
VISITS = 2_000  # (query, first centroid, block) rows that a task holds before it sends them on


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of vectors with an id and finite components, not all zero, of the table's usual length."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def matrix(column) -> np.ndarray:
    """Arrow lists of equal length as rows of a float64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from evenly drawn rows; empty clusters keep their place."""
    k = min(k, len(x))
    c = x[np.random.default_rng(11).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = square_distances(x, c).argmin(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.bincount(own, minlength=k)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """Cells (pairs of centroids) by growing summed distance until they hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    heap, seen, out, held = [(da[0] + db[0], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        n = counts[a[i], b[j]]
        if n:
            held += n
            out.append((a[i], b[j]))
        if i + 1 < len(a) and (i + 1, j) not in seen:
            seen.add((i + 1, j))
            heapq.heappush(heap, (da[i + 1] + db[j], i + 1, j))
        if j + 1 < len(b) and (i, j + 1) not in seen:
            seen.add((i, j + 1))
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
    return out


def nearest(v: np.ndarray, ids: np.ndarray, q: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the ``top`` rows nearest to ``q``; ties to the smaller id."""
    rough = square_distances(v, q[None, :])[:, 0]
    if len(rough) > top:
        edge = np.partition(rough, top - 1)[top - 1]
        rows = np.flatnonzero(rough <= edge + 1e-9 * (1 + abs(edge) + float(q @ q)))
    else:
        rows = np.arange(len(rough))
    exact = np.sqrt(((v[rows] - q) ** 2).sum(1))
    order = np.lexsort((ids[rows], exact))[:top]
    return rows[order], exact[order]


class Codebooks:
    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.books = [k_means(sample[:, :self.half], k), k_means(sample[:, self.half:], k)]

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [square_distances(x[:, :self.half], self.books[0]), square_distances(x[:, self.half:], self.books[1])]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return np.stack([a.argmin(1), b.argmin(1)])


def _visit_length(index: DataFrame, queries: DataFrame, books: Codebooks, counts: np.ndarray, top: int) -> float:
    """Entries a query must see to meet ``RECALL`` of its true neighbours, by brute force for some queries."""
    some = queries.orderBy(F.xxhash64("qrep"), "qrep").limit(CALIBRATION).toArrow()
    if not some.num_rows:
        return math.inf
    qids, qv = some["qrep"].to_numpy(), matrix(some["v"].combine_chunks())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for b in batches:
            if not b.num_rows:
                continue
            ids, c1, c2, v = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), matrix(b.column(3))
            for k in range(len(qids)):
                other = ids != qids[k]
                rows, d = nearest(v[other], ids[other], qv[k], top)
                rows = np.flatnonzero(other)[rows]
                best[k] = sorted(best.get(k, []) + list(zip(d.tolist(), ids[rows].tolist(), c1[rows].tolist(),  # noqa: B905
                                                            c2[rows].tolist())))[:top]
        flat = [(k, *x) for k, found in best.items() for x in found]
        if flat:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(flat, columns=["k", "d", "id", "c1", "c2"]), preserve_index=False)

    found = index.mapInArrow(local, "k long, d double, id long, c1 long, c2 long")
    true = found.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("d", "id"))).filter(
        F.col("r") <= top).select("k", "c1", "c2").collect()
    da, db = books.distances(qv)
    needed = []
    order_of: dict[int, tuple] = {}
    for k, c1, c2 in true:
        if k not in order_of:
            summed = (da[k][:, None] + db[k][None, :]).ravel()
            order = np.argsort(summed, kind="stable")
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            order_of[k] = place, np.cumsum(counts.ravel()[order])
        place, seen = order_of[k]
        needed.append(seen[place[c1 * counts.shape[1] + c2]])
    return float(np.quantile(needed, RECALL, method="higher")) if needed else math.inf


def search(vectors: DataFrame, every: int = 100, top: int = 10, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by
    ``every``, its ``top`` nearest found among the rows of other ids, by Euclidean
    distance in double precision, nearest first and ties to the smaller id.

    Rows with a null id take no part, nor do vectors that are null, empty, all
    zero, hold null or non-finite components, or differ in length from most of
    the table's. A query with fewer candidates than ``top`` gets all of them.
    Rows that repeat an id and vector count once; a query never finds a row of
    its own id. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = write_table(valid_vectors(vectors, id_col, vec_col), "ann-vectors")
    same = Window.partitionBy("v").orderBy("vec_id")
    entries = write_table(rows.withColumn("r", F.dense_rank().over(same)).filter(F.col("r") <= top + 1)
                          .select("vec_id", "v").distinct(), "ann-entries")
    asked = rows.filter(F.col("vec_id") % every == 0).distinct()
    queries = write_table(asked.groupBy("v").agg(F.min("vec_id").alias("qrep")).select("qrep", "v"), "ann-queries")
    schema = "query_id long, rank int, vec_id long, score double"
    n, n_queries = entries.count(), queries.count()
    if not n or not n_queries:
        return spark.createDataFrame([], schema)

    k = min(MAX_CENTROIDS, max(4, 2 ** round(math.log2(math.sqrt(n / 16)))))
    # about twice as many by a bound on the hash, before the smallest hashes meet in one task
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
    drawn = entries.filter(place < F.lit(min(1 << 40, (2 * SAMPLE << 40) // n)))
    sample = drawn.orderBy(place, "vec_id").limit(SAMPLE).select("v").toArrow()
    books = Codebooks(matrix(sample["v"].combine_chunks()), k)
    shape = len(books.books[0]), len(books.books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                c = books.cells(matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(c[0]), pa.array(c[1]), b.column(1)],
                                                 names=["vec_id", "c1", "c2", "v"])

    index = write_table(entries.mapInArrow(assign, "vec_id long, c1 long, c2 long, v array<double>"), "ann-index")
    counts = np.zeros(shape, dtype=np.int64)
    for r in index.groupBy("c1", "c2").count().collect():  # at most k * k rows
        counts[r["c1"], r["c2"]] = r["count"]
    enough = max(_visit_length(index, queries, books, counts, top), 2.0 * top)
    blocks = np.maximum(1, -(-counts.sum(1) // BLOCK))
    chunks = max(1, -(-n_queries // CHUNK))

    def probes_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["c1", "blk", "chunk", "qrep", "v", "seconds"]),
                                          preserve_index=False)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = matrix(b.column(1))
            da, db = books.distances(v)
            out = []
            for i, qrep in enumerate(b.column(0).to_pylist()):
                seconds: dict[int, list[int]] = {}
                for c1, c2 in walk(da[i], db[i], counts, enough):
                    seconds.setdefault(c1, []).append(c2)
                for c1, c2s in seconds.items():
                    for blk in range(blocks[c1]):
                        out.append((c1, blk, qrep % chunks, qrep, v[i], c2s))
                        if len(out) == VISITS:  # no more than these are held at once
                            yield probes_batch(out)
                            out = []
            if out:
                yield probes_batch(out)

    def meet(key, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asking):
            ids, c2, v = own["vec_id"].to_numpy(), own["c2"].to_numpy(), np.stack(own["v"].to_numpy())
            for qrep, q, seconds in zip(asking["qrep"], asking["v"], asking["seconds"], strict=True):
                mask = np.zeros(shape[1], dtype=bool)
                mask[seconds] = True
                rows_in = np.flatnonzero(mask[c2])
                at, d = nearest(v[rows_in], ids[rows_in], np.asarray(q), top + 1)
                found.extend(zip([qrep] * len(at), ids[rows_in[at]].tolist(), d.tolist()))  # noqa: B905
        return pd.DataFrame(found, columns=["qrep", "vec_id", "score"])

    blk = F.array(*[F.lit(int(x)) for x in blocks])[F.col("c1").cast("int")]
    dealt = index.select("c1", F.pmod(F.xxhash64("vec_id"), blk.cast("long")).alias("blk"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), "vec_id", "c2", "v")
    probes = queries.repartition(width(spark, n_queries, 2000)).mapInArrow(
        visits, "c1 long, blk long, chunk long, qrep long, v array<double>, seconds array<long>")
    met = dealt.groupBy("c1", "blk", "chunk").cogroup(probes.groupBy("c1", "blk", "chunk")).applyInPandas(
        meet, "qrep long, vec_id long, score double")
    order = ["score", "vec_id"]
    best = met.withColumn("r", F.row_number().over(Window.partitionBy("qrep").orderBy(*order))).filter(
        F.col("r") <= top + 1).drop("r")
    named = asked.select(F.col("vec_id").alias("query_id"), "v").join(queries, "v").select("query_id", "qrep")
    answer = named.join(best, "qrep").filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return answer.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
