"""Windowed aggregations over RECORD (key, ts, value, partition, offset).

Tumbling and hopping windows are ``groupBy(key, F.window(...))`` - partial
aggregation before the shuffle, so a hot key costs one partial row per
input partition, not its rows. Running and ordered forms (row positions,
sliding frames, sessions, ordered folds) go through the block-parallel
scans of :mod:`windlass.operators.scan`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import config as C
from ..functions.columns import MICROS, epoch_micros, micros_to_ntz
from ..session import scratch_dir
from . import scan


def _keyed(records: DataFrame, key: str = "key") -> DataFrame:
    """Null keys are skipped; null values fold as 0."""
    return (records.where(F.col(key).isNotNull())
                   .withColumn("value", F.coalesce(F.col("value"), F.lit(0))))


def windowed_agg(records: DataFrame, aggs: dict[str, Column], *, size_seconds: int = C.SAMPLE_WINDOW_SECONDS,
                 slide_seconds: int | None = None, key: str = "key", ts: str = "ts") -> DataFrame:
    """One ``groupBy`` for all aggregates of a window (name -> aggregate):
    one shuffle, not one per materialization."""
    size = f"{size_seconds} seconds"
    w = F.window(ts, size) if slide_seconds is None else F.window(ts, size, f"{slide_seconds} seconds")
    return (_keyed(records, key)
            .groupBy(F.col(key).alias("key"), w.alias("w"))
            .agg(*[c.alias(n) for n, c in aggs.items()])
            .select("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *aggs.keys()))


def tumbling_sum(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS) -> DataFrame:
    """The sample's fold ``agg = v + agg`` from 0 per key and tumbling window."""
    return windowed_agg(records, {"agg": F.sum("value").cast("bigint")}, size_seconds=size_seconds)


def tumbling_count(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS) -> DataFrame:
    return windowed_agg(records, {"n": F.count(F.lit(1))}, size_seconds=size_seconds)


def tumbling_stats(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS) -> DataFrame:
    """count, sum, min, max in one aggregation (one shuffle)."""
    return windowed_agg(records, {
        "n": F.count(F.lit(1)),
        "total": F.sum("value").cast("bigint"),
        "min_value": F.min("value"),
        "max_value": F.max("value"),
    }, size_seconds=size_seconds)


def tumbling_timestamped(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS) -> DataFrame:
    """Aggregate kept with the newest record timestamp of its window."""
    return windowed_agg(records, {
        "agg": F.sum("value").cast("bigint"),
        "value_ts": F.max("ts"),
    }, size_seconds=size_seconds)


def hopping_sum(records: DataFrame, size_seconds: int, slide_seconds: int) -> DataFrame:
    return windowed_agg(records, {
        "n": F.count(F.lit(1)),
        "agg": F.sum("value").cast("bigint"),
    }, size_seconds=size_seconds, slide_seconds=slide_seconds)


def keyed_sum(records: DataFrame) -> DataFrame:
    """Unwindowed key/value aggregate."""
    return (_keyed(records).groupBy("key")
            .agg(F.sum("value").cast("bigint").alias("agg"), F.count(F.lit(1)).alias("n")))


def _active(records: DataFrame, range_micros: int, unit_micros: int, block_seconds: int) -> DataFrame:
    """(key, t, kind, __n, __agg): what lies in the last ``range_micros`` before each moment
    at which that changes for a key: kind 1 where a record enters (its time), 0 where only
    ones leave (one unit after the range is over).

    A sweep over entry and exit events: a record adds its value at its time and takes it
    off again once the range has passed. Events of a key and moment are added up before
    the scan (with map-side combine, so equal or coarse times of a hot key are one row).
    """
    enter = F.struct(F.col("__t").alias("t"), F.lit(1).alias("kind"), F.col("value").cast("bigint").alias("v"), F.lit(1).alias("n"))
    leave = F.struct((F.col("__t") + F.lit(range_micros + unit_micros)).alias("t"), F.lit(0).alias("kind"),
                     (-F.col("value")).cast("bigint").alias("v"), F.lit(-1).alias("n"))
    events = (records.select("key", F.explode(F.array(enter, leave)).alias("__e")).select("key", "__e.*")
              .groupBy("key", "t").agg(F.max("kind").alias("kind"), F.sum("v").alias("v"), F.sum("n").alias("n")))
    return scan.running(events, ["key"], "t", [("__agg", "sum", F.col("v")), ("__n", "sum", F.col("n"))],
                        block=F.floor(F.col("t") / F.lit(block_seconds * MICROS)).cast("bigint"), share=True)


def sliding_sum(records: DataFrame, range_seconds: int, *, block_seconds: int = 3_600) -> DataFrame:
    """Trailing window ending at each record: sum of the key's values with
    ``ts`` in ``[ts - range, ts]`` (ties included), one row per record.

    The frame of a record is what is active at its time in a sweep over entry and exit
    events (a block-parallel scan over a key's distinct moments, blocks of
    ``block_seconds``); it goes back to the records by key and time.
    """
    d = _keyed(records).withColumn("__t", epoch_micros("ts"))
    frames = (_active(d, range_seconds * MICROS, 1, block_seconds).where("kind = 1")
              .select("key", F.col("t").alias("__t"), F.col("__agg").cast("bigint").alias("agg")))
    return d.join(frames, ["key", "__t"]).select("topic", "partition", "offset", "ts", "key", "value", "agg")


def sliding_windows(records: DataFrame, difference_seconds: int, *, block_seconds: int = 3_600) -> DataFrame:
    """Every distinct sliding window that holds a record, once: (key, window_start, window_end,
    n, agg), both ends included, ``difference`` apart, times in ms.

    Windows that end at a record and windows that begin just after one (1 ms), that is
    where a record has left: together, every set of a key's records that some window of
    that length holds. They are the moments of the entry and exit sweep at which anything
    is active; a window is named by that moment, its end.
    """
    d = _keyed(records).withColumn("__t", F.floor(epoch_micros("ts") / 1000) * 1000)
    run = _active(d, difference_seconds * MICROS, 1000, block_seconds).where("__n > 0")
    return run.select("key", micros_to_ntz(F.col("t") - F.lit(difference_seconds * MICROS)).alias("window_start"),
                      micros_to_ntz("t").alias("window_end"), F.col("__n").cast("bigint").alias("n"),
                      F.col("__agg").cast("bigint").alias("agg"))


def session_sum(records: DataFrame, gap_seconds: int, *, block_seconds: int | None = None) -> DataFrame:
    """Session windows: a key's records closer than or exactly ``gap`` apart
    share a session. Session end is the last record's time.

    Records of a key within one stretch of ``gap`` (times cut at its multiples) are
    never more than it apart, so each stretch is one row from the start, with map-side
    combine. Session starts come from a block-parallel scan of these rows (blocks of
    ``block_seconds``, by default of 100,000 stretches; see
    :func:`windlass.operators.scan.session_starts`), then a plain ``groupBy(key, start)``.
    """
    gap = gap_seconds * MICROS
    block_rows = 100_000 if block_seconds is None else max(1, block_seconds * MICROS // max(gap, 1))
    stretch = F.floor(epoch_micros("ts") / F.lit(max(gap, 1))).cast("bigint")
    d = (_keyed(records).groupBy("key", stretch.alias("__s"))
         .agg(F.count(F.lit(1)).alias("__n"), F.sum("value").alias("__v"), F.min("ts").alias("__lo"), F.max("ts").alias("__hi"))
         .withColumn("__t", epoch_micros("__lo")).withColumn("__e", epoch_micros("__hi")))
    starts = scan.session_starts(d, ["key"], "__t", gap, block=F.floor(F.col("__s") / block_rows).cast("bigint"), end="__e",
                                 name="__start")
    return (starts.groupBy("key", "__start")
            .agg(F.min("__lo").alias("session_start"), F.max("__hi").alias("session_end"),
                 F.sum("__n").cast("bigint").alias("n"), F.sum("__v").cast("bigint").alias("agg"))
            .drop("__start"))


def window_rows(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *,
                span: int | None = None) -> DataFrame:
    """Duplicates retained: every record of a window with its sequence
    number (1-based, by offset)."""
    d = _keyed(records).withColumn("w", F.window("ts", f"{size_seconds} seconds"))
    d = d.select("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "partition", "offset", "value")
    return scan.row_number(d, ["key", "window_start"], "offset", "seq", span=span)


def window_last(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS) -> DataFrame:
    """Duplicates not retained: last write (highest offset) per window."""
    d = _keyed(records).withColumn("w", F.window("ts", f"{size_seconds} seconds"))
    return (d.groupBy("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
            .agg(F.max_by("value", "offset").alias("value"), F.max("offset").alias("offset")))


def max_plus_fold(df: DataFrame, by: list[str], order: str, a: Column, b: Column, init: int,
                  name: str = "agg", *, span: int | None = None, running: bool = False) -> DataFrame:
    """Ordered fold whose step is ``s -> max(a_i, s + b_i)``, exactly and in
    parallel.

    Such steps compose associatively ((max, +) algebra): after rows 1..i,
    ``s_i = P_i + max(init, max_{j<=i}(a_j - P_j))`` with ``P`` the running
    sum of ``b``. So the fold is two block-parallel running aggregates
    (``running=True``, one value per row) or a running sum and a plain
    group aggregate (final value per group). Covers sums (a = -inf), CUSUM
    ``max(0, s + v - c)``, running max with floor, clamped accumulators.
    """
    d = df.withColumn("__a", a).withColumn("__b", b)
    p = scan.running(d, by, order, [("__p", "sum", F.col("__b"))], span=span)
    p = p.withColumn("__m", F.col("__a") - F.col("__p"))
    if running:
        m = scan.running(p, by, order, [("__mm", "max", F.col("__m"))], span=span)
        return (m.withColumn(name, (F.col("__p") + F.greatest(F.lit(init), F.col("__mm"))).cast("bigint"))
                 .drop("__a", "__b", "__p", "__m", "__mm"))
    return (p.groupBy(*by)
            .agg((F.max_by("__p", order) + F.greatest(F.lit(init), F.max("__m"))).cast("bigint").alias(name)))


def cusum(records: DataFrame, drift: int, size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *,
          span: int | None = None) -> DataFrame:
    """One-sided CUSUM ``agg = max(0, agg + v - drift)`` from 0, applied in
    offset order per key and tumbling window: an order-dependent user fold
    (the reference's ``aggregate(init)(f)`` with a non-commutative ``f``)."""
    d = _keyed(records).withColumn("w", F.window("ts", f"{size_seconds} seconds"))
    d = d.select("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 "offset", "value")
    return max_plus_fold(d, ["key", "window_start", "window_end"], "offset", F.lit(0),
                         F.col("value") - F.lit(drift), 0, span=span)


def _grouped_fold(by: list[str], values: list[str], out_schema: T.StructType, start: Callable, step: Callable):
    """mapInArrow body over rows sorted by ``by``: per group ``step`` from ``start()`` over
    the tuples of ``values``, one accumulator carried from batch to batch. A group's keys
    are compared as Arrow gives them: null is null and NaN is NaN."""
    schema = to_arrow_schema(out_schema)

    def same(x):
        return tuple("nan" if isinstance(v, float) and v != v else v for v in x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = key = acc = None
        for rb in batches:
            done = []
            keys = zip(*[rb.column(c).to_pylist() for c in by]) if by else [()] * rb.num_rows
            rows = zip(*[rb.column(c).to_pylist() for c in values])
            for k, row in zip(keys, rows):
                if group is None or same(k) != key:
                    if group is not None:
                        done.append((*group, *acc))
                    group, key, acc = k, same(k), start()
                acc = step(acc, row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*done), schema)], schema=schema)
        if group is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in zip((*group, *acc), schema)], schema=schema)

    return run


@dataclass(frozen=True)
class Fold:
    """A user's fold in parts that can run apart: ``step(state, *values)`` from ``init()``,
    and ``merge(earlier, later)``, associative but not necessarily commutative, of the
    states of two adjacent stretches. States are tuples, with the fields of ``schema``."""

    init: Callable[[], tuple]
    step: Callable[..., tuple]
    merge: Callable[[tuple, tuple], tuple]
    schema: str


def parallel_fold(df: DataFrame, by: list[str], order: str, values: list[str], fold: Fold, *, span: int | None = None,
                  fan_in: int = 1_024) -> DataFrame:
    """Any fold with a merge, in ``order`` per group: (by..., the state's fields).

    Rows are dealt by (group, block of ``order``) and folded block by block, each a task's
    stream of sorted Arrow batches; then up to ``fan_in`` adjacent blocks are merged at a
    time, level by level, in block order. However large a group is, no task holds more
    of it than a block or ``fan_in`` states. Each level is written to the shared folder.
    """
    spark = df.sparkSession
    keys = df.select(*by).schema.fields
    out = T.StructType([*keys, T.StructField("__blk", T.LongType()), *T.StructType.fromDDL(fold.schema).fields])
    state = [f.name for f in T.StructType.fromDDL(fold.schema).fields]

    def written(rows: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "fold")
        rows.write.parquet(path)
        return spark.read.schema(out).parquet(path)

    dealt = df.select(*by, scan.block_of(order, span).alias("__blk"), order, *values)
    step = _grouped_fold([*by, "__blk"], values, out, fold.init, lambda s, row: fold.step(s, *row))
    now = written(dealt.repartition(*by, "__blk").sortWithinPartitions(*by, "__blk", order).mapInArrow(step, out))
    merge = _grouped_fold([*by, "__up"], state, out, lambda: None, lambda s, row: row if s is None else fold.merge(s, row))
    low, high = now.agg(F.min("__blk"), F.max("__blk")).first()
    while low != high:
        up = now.withColumn("__up", F.floor(F.col("__blk") / F.lit(fan_in)).cast("bigint"))
        now = written(up.repartition(*by, "__up").sortWithinPartitions(*by, "__up", "__blk").mapInArrow(merge, out))
        low, high = low // fan_in, high // fan_in
    return now.drop("__blk")


def longest_rise(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *, span: int | None = None,
                 fan_in: int = 1_024) -> DataFrame:
    """Per key and tumbling window, the longest run of records, in offset order, whose
    values rise from each to the next: a fold whose merge is not commutative."""

    def step(s, v):
        n, first, last, prefix, suffix, best = s
        if n == 0:
            return 1, v, v, 1, 1, 1
        suffix = suffix + 1 if v > last else 1
        return n + 1, first, v, prefix + (prefix == n and v > last), suffix, max(best, suffix)

    def merge(a, b):
        if a[0] == 0 or b[0] == 0:
            return b if a[0] == 0 else a
        joined = a[4] + b[3] if b[1] > a[2] else 0
        prefix = a[3] + b[3] if joined and a[3] == a[0] else a[3]
        suffix = a[4] + b[4] if joined and b[4] == b[0] else b[4]
        return a[0] + b[0], a[1], b[2], prefix, suffix, max(a[5], b[5], joined)

    fold = Fold(lambda: (0, 0, 0, 0, 0, 0), step, merge,
                "n long, first long, last long, prefix long, suffix long, longest long")
    d = _keyed(records).withColumn("w", F.window("ts", f"{size_seconds} seconds"))
    d = d.select("key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "offset", "value")
    return parallel_fold(d, ["key", "window_start", "window_end"], "offset", ["value"], fold, span=span, fan_in=fan_in).select(
        "key", "window_start", "window_end", "n", "longest")


def ordered_fold(df: DataFrame, by: list[str], order: str, value: str, init, step, schema: str,
                 name: str = "agg") -> DataFrame:
    """Any user fold ``step(agg, value) -> agg`` in ``order`` per group.

    For a step with no merge the fold is inherently sequential within a group. Rows are
    hash-partitioned by group and sorted, then folded by streaming Arrow batches with a
    carried accumulator: memory stays one batch, but one group is one task. Prefer
    built-in aggregates when the fold commutes, :func:`max_plus_fold` when it has that
    shape and :func:`parallel_fold` when it has a merge.
    """
    out = T.StructType.fromDDL(schema)
    out = T.StructType([out[c] for c in [*by, name]])
    run = _grouped_fold(by, [value], out, lambda: (init,), lambda s, row: (step(s[0], row[0]),))
    return (df.select(*by, order, value)
              .repartition(*by)
              .sortWithinPartitions(*by, order)
              .mapInArrow(run, out))
