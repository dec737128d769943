"""Skew-proof running computations (parallel prefix scans).

Several operators need a value that depends on *all earlier rows of a
group in some order*: stream time per topic partition (running max of ts
by offset), the per-record update stream (running sum per key and window),
offsets of a fixture topic (running count), the position of a record in
its window (row number), session starts, ordered folds.

A plain ``Window.partitionBy(group).orderBy(order)`` puts a whole group in
one task. A topic has few partitions and one key may hold a third of all
rows, so at scale that is one task reading terabytes. Instead every running
computation here is a two-level scan:

1. rows get a *block* id that is monotone in the order (``order // span``),
   so one (group, block) holds at most ``span`` rows;
2. the within-block running value is a window over (group, block) - one
   hash exchange of the data, bounded partitions;
3. per (group, block) totals are a second branch over the same exchange (the
   window's input is read twice, and adaptive execution usually reuses the
   exchange); an exclusive prefix over blocks is a window over the block table;
4. the prefix is joined back for the blocks that have an earlier one. A group
   within one block has none, so what is joined is small unless groups really
   span blocks.

Each level reads its input for two branches: nested scans multiply that, and
a long chain is better cut by a written table. Where all columns of the rows are
used afterwards, ``share`` makes the two branches' exchanges equal, so that Spark
runs one and reads its output twice.

All of it is declared with DataFrame operators; Catalyst keeps the
expressions in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_BLOCK_SPAN
from ..functions.columns import col

_BLK = "__blk"

def _whole(rows: DataFrame) -> Column:
    """A block aggregate that reads every column. Without it the totals' branch is pruned to
    fewer columns than the rows' branch, so that its exchange differs from that one."""
    return F.max(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).alias("__whole")


_ROW_AGG = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "count": lambda c: F.count(c),
}
_PREFIX_AGG = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, prefix: Column, inner: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(prefix.isNull(), inner).when(inner.isNull(), prefix).otherwise(prefix + inner)
    if kind == "max":
        return F.greatest(prefix, inner)
    if kind == "min":
        return F.least(prefix, inner)
    raise ValueError(kind)


SPAN_CONF = "windlass.scan.blockSpan"


def block_span(span: int | None = None) -> int:
    """Rows of one group per block: explicit, else the session setting
    ``windlass.scan.blockSpan``, else the library default."""
    if span:
        return int(span)
    spark = SparkSession.getActiveSession()
    if spark is not None:
        v = spark.conf.get(SPAN_CONF, None)
        if v:
            return int(v)
    return DEFAULT_BLOCK_SPAN


def block_of(order: str | Column, span: int | None = None) -> Column:
    return F.floor(col(order) / F.lit(block_span(span))).cast("bigint")


def _join_back(rows: DataFrame, blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join block-level columns back on (by, block).

    ``blocks`` holds only blocks that have an earlier one in their group, which
    for most groups is none, so it is small and usually broadcast by size. Left
    join: no row is ever dropped; null groups match null groups.
    """
    keys = [*by, _BLK]
    named = blocks.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
                          *[c for c in blocks.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__r{i}"))
    return rows.join(named, same, "left").drop(*[f"__r{i}" for i in range(len(keys))])


def running(df: DataFrame, by: Sequence[str], order: Sequence[str] | str,
            aggs: Sequence[tuple[str, str, Column]], *, span: int | None = None,
            block: Column | None = None, inclusive: bool = True, share: bool = False) -> DataFrame:
    """Add running aggregates over ``order`` within groups ``by``.

    ``aggs`` is a list of (output name, kind, value column), kind one of
    ``sum``, ``count``, ``max``, ``min``. ``inclusive`` False gives the value
    over strictly earlier rows. ``block`` overrides the block id (it must
    be monotone in ``order``); by default it is ``order[0] // span``. ``share``: see above.
    Rows with equal order keys are taken in an arbitrary but fixed order
    (ROWS frame), as a window function would.
    """
    order = [order] if isinstance(order, str) else list(order)
    by = list(by)
    blk = block if block is not None else block_of(order[0], span)
    d = df.withColumn(_BLK, blk)
    frame_end = Window.currentRow if inclusive else -1
    wi = Window.partitionBy(*by, _BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    rows = d
    for name, kind, value in aggs:
        rows = rows.withColumn(f"__in_{name}", _ROW_AGG[kind](value).over(wi))
    # block totals from the same exchange as the within-block window
    totals = rows.groupBy(*by, _BLK).agg(
        *[_ROW_AGG[kind](value).alias(f"__bt_{name}") for name, kind, value in aggs], *([_whole(d)] if share else []))
    if share:
        totals = totals.where("__whole IS NOT NULL").drop("__whole")
    wb = Window.partitionBy(*by).orderBy(_BLK)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(
        *by, _BLK, F.row_number().over(wb).alias("__nth"),
        *[_PREFIX_AGG[kind](F.col(f"__bt_{name}")).over(before).alias(f"__bp_{name}")
          for name, kind, _ in aggs]).where("__nth > 1").drop("__nth")
    out = _join_back(rows, prefix, by)
    for name, kind, _ in aggs:
        inner = F.col(f"__in_{name}")
        if kind == "count":
            inner = F.coalesce(inner, F.lit(0))
        combined = _combine(kind, F.col(f"__bp_{name}"), inner)
        if kind == "count":
            combined = F.coalesce(combined, F.lit(0)).cast("bigint")
        out = out.withColumn(name, combined).drop(f"__in_{name}", f"__bp_{name}")
    return out.drop(_BLK)


def row_number(df: DataFrame, by: Sequence[str], order: Sequence[str] | str, name: str, *,
               span: int | None = None, block: Column | None = None,
               start: int = 1) -> DataFrame:
    """``row_number() over (partition by by order by order)`` without
    putting a whole group in one task. ``start`` 0 gives offsets."""
    out = running(df, by, order, [(name, "count", F.lit(1))], span=span, block=block)
    return out.withColumn(name, (F.col(name) - F.lit(1 - start)).cast("bigint"))


def session_starts(df: DataFrame, by: Sequence[str], t: str, gap: int, *, block: Column,
                   end: str | None = None, name: str = "session_start") -> DataFrame:
    """Start time of each row's session, block-parallel.

    A row opens a session when it has no predecessor in its group or the
    predecessor is more than ``gap`` earlier (``t`` numeric, e.g. epoch
    micros). With ``end`` a row stands for the stretch from ``t`` to ``end`` (stretches of
    a group don't overlap), and the gap is from its predecessor's end. A row's session start is the latest opening time at or before
    it. Within a block: lag, opening flags and the running latest opening.
    On the block table (one row per group and block): the previous block's
    last time decides whether the block's first row opens a session, and an
    exclusive running max carries the latest opening into the block.
    One exchange of the rows; everything else moves block rows only.
    """
    by = list(by)
    d = df.withColumn(_BLK, block)
    wi = Window.partitionBy(*by, _BLK).orderBy(t)
    end = end or t
    lag_t = F.lag(end).over(wi)
    rows = (d.withColumn("__rn", F.row_number().over(wi))
              .withColumn("__open", F.when((F.col(t) - lag_t) > F.lit(gap), F.col(t))))
    rows = rows.withColumn("__run", F.max("__open").over(
        wi.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    blocks = rows.groupBy(*by, _BLK).agg(F.min(t).alias("__first"), F.max(end).alias("__last"),
                                          F.max("__open").alias("__bopen"),
                                         _whole(d)).where("__whole IS NOT NULL").drop("__whole")
    wb = Window.partitionBy(*by).orderBy(_BLK)
    prev_last = F.lag("__last").over(wb)
    blocks = blocks.withColumn(
        "__fopen", prev_last.isNull() | ((F.col("__first") - prev_last) > F.lit(gap)))
    blocks = blocks.withColumn(
        "__bstart", F.greatest(F.col("__bopen"), F.when(F.col("__fopen"), F.col("__first"))))
    blocks = blocks.select(
        *by, _BLK, F.row_number().over(wb).alias("__nth"), "__first", "__fopen",
        F.max("__bstart").over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry")).where(
        "__nth > 1").drop("__nth")
    # a group's first block always opens a session with its first row
    rows = rows.withColumn("__low", F.min(t).over(wi))
    out = _join_back(rows, blocks, by)
    opened = F.when(F.coalesce("__fopen", F.lit(True)), F.coalesce("__first", "__low"))
    out = out.withColumn(name, F.greatest(F.col("__carry"), opened, F.col("__run")))
    return out.drop("__rn", "__open", "__run", "__low", "__first", "__fopen", "__carry", _BLK)
