"""Start a new streaming query from a snapshot instead of empty state.

The snapshot becomes the initial state of a ``transformWithStateInPandas``
processor; input records at or below the snapshot's source position are cut
*per source partition* before the processor, because input replay is not
idempotent: a record folded into the snapshot must not be folded again.

State is kept in slots: keys are dealt to ``slots`` by hash, and a window's keys of
one slot are one entry of the store (their columns as arrays), read, written and
expired at once. A call of the processor, a look-up and a timer then serve many keys;
one per key and window costs milliseconds each. A batch rewrites the entries it
touches, so there should be enough slots that one holds some 100,000 rows at most.
``read_state_variable`` gives the rows one by one.

:func:`bootstrap_stream` continues a sum: records are summed per window within
each Arrow batch before they are shuffled, so a hot key costs a few rows per
task. :func:`fold_stream` continues any user fold in offset order; the
records that a batch has for one window and slot then meet in one task.
Start the queries with ``for_each_update(..., rocksdb=True)``.
"""

from __future__ import annotations

import sys as _sys
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import config as C
from ..functions.columns import ntz_to_instant

# Executors unpickle the processor; ship this module's code by value so they
# need no installed copy of the package (same effect as --py-files).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

OUTPUT_SCHEMA = "key string, window_start timestamp, agg long, last_offset long"

SLOTS = 64


def in_slots(rows: DataFrame, slots: int) -> DataFrame:
    """Rows with the slot of their key."""
    return rows.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(slots)).cast("int"))


def unpacked(held) -> list[tuple]:
    """The rows of an entry that keeps its columns as arrays; none if there is no entry."""
    return [] if held is None else list(zip(*held))  # noqa: B905


def packed(rows) -> tuple:
    """The entry of some rows."""
    return tuple(map(list, zip(*rows)))  # noqa: B905


def _sum_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            sums = pdf.groupby(["key", "window_start", "slot", "expires"], as_index=False).agg(value=("value", "sum"), offset=("offset", "max"))
            yield sums[["key", "window_start", "offset", "value", "expires", "slot"]]


class RunningSum(StatefulProcessor):
    """agg = v + agg per (key, window), starting from the initial state; the processor's
    groups are (window, slot).

    With ``expire`` a window leaves the state by an event-time timer once the watermark
    reaches its ``expires`` (ms), and records that come for it later are skipped, as a
    store skips what lies past its retention.
    """

    def __init__(self, expire: bool = False) -> None:
        self.expire = expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.agg = handle.getValueState("agg", "key array<string>, agg array<long>")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        held = dict(unpacked(self.agg.get()))  # a large group comes in several frames
        for k, v in zip(initialState["key"].tolist(), initialState["agg"].tolist()):  # noqa: B905
            held[k] = held.get(k, 0) + v
        self.agg.update(packed(held.items()))
        if self.expire:
            self.handle.registerTimer(int(initialState["expires"].iloc[0]))

    def open_rows(self, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """The rows of a window that is not past its retention; its timer is set."""
        known = False
        for pdf in rows:
            if self.expire and not known:
                expires = int(pdf["expires"].iloc[0])
                if expires <= timerValues.getCurrentWatermarkInMs():
                    return
                self.handle.registerTimer(expires)
                known = True
            yield pdf

    def folded(self, agg: dict, rows: Iterator[pd.DataFrame]) -> dict:
        """``agg`` (key -> value) with the rows folded in; last offset by key."""
        last: dict = {}
        for pdf in rows:
            for k, v, o in zip(*[pdf[c].tolist() for c in ("key", "value", "offset")]):  # noqa: B905
                agg[k] = agg.get(k, 0) + v
                last[k] = max(last.get(k, o), o)
        return last

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = self.open_rows(rows, timerValues)
        first = next(rows, None)
        if first is None:
            return
        agg = dict(unpacked(self.agg.get()))
        last = self.folded(agg, chain([first], rows))
        self.agg.update(packed(agg.items()))
        yield pd.DataFrame({"key": list(last), "window_start": key[0], "agg": [agg[k] for k in last], "last_offset": list(last.values())})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.agg.clear()
        return iter([])

    def close(self) -> None:
        pass


class RunningFold(RunningSum):
    """agg = step(agg, value) in offset order per (key, window), from ``start``."""

    def __init__(self, start: int, step: Callable[[int, int], int], expire: bool = False) -> None:
        super().__init__(expire)
        self.start, self.step = start, step

    def folded(self, agg: dict, rows: Iterator[pd.DataFrame]) -> dict:
        pdf = pd.concat(list(rows)).sort_values("offset")
        last: dict = {}
        for k, v, o in zip(*[pdf[c].tolist() for c in ("key", "value", "offset")]):  # noqa: B905
            agg[k] = self.step(agg.get(k, self.start), v)
            last[k] = o
        for k in last:
            agg[k] = int(agg[k])
        return last


def _expires(window_start, retention_seconds: int | None):
    """When a window leaves the state, in ms since the epoch."""
    return (F.unix_millis(window_start) + F.lit((retention_seconds or 0) * 1000)).cast("long").alias("expires")


def _past(records: DataFrame, positions: DataFrame | None) -> DataFrame:
    """Records past their source partition's position."""
    if positions is None:
        return records
    pos = positions.select("topic", "partition", F.col("position").alias("__pos"))
    return (records.join(pos, ["topic", "partition"], "left")
            .where(F.col("__pos").isNull() | (F.col("offset") > F.col("__pos"))))


def _fresh(records: DataFrame, positions: DataFrame | None, size_seconds: int, retention_seconds: int | None,
           delay_seconds: int, slots: int) -> DataFrame:
    """Records past their source partition's position, with their window and slot."""
    if retention_seconds is not None:
        records = records.withWatermark("ts", f"{delay_seconds} seconds")
    return in_slots(_past(records, positions).withColumn("window_start", F.window("ts", f"{size_seconds} seconds").start)
                    .select("key", "window_start", "offset", "value", _expires(F.col("window_start"), retention_seconds)), slots)


def _initial(snapshot: DataFrame, retention_seconds: int | None, slots: int):
    start = ntz_to_instant("window_start")
    return (in_slots(snapshot.select("key", start.alias("window_start"), F.coalesce(F.col("agg").cast("bigint"), F.lit(0)).alias("agg"),
                                     _expires(start, retention_seconds)), slots).groupBy("window_start", "slot"))


def _with_state(rows: DataFrame, processor: RunningSum, snapshot: DataFrame | None, retention_seconds: int | None,
                slots: int) -> DataFrame:
    init = {} if snapshot is None else {"initialState": _initial(snapshot, retention_seconds, slots)}
    mode = "None" if retention_seconds is None else "EventTime"
    return rows.groupBy("window_start", "slot").transformWithStateInPandas(processor, OUTPUT_SCHEMA, "Update", mode, **init)


def bootstrap_stream(records: DataFrame, snapshot: DataFrame | None = None, positions: DataFrame | None = None,
                     size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *, retention_seconds: int | None = None,
                     delay_seconds: int = 0, slots: int = SLOTS) -> DataFrame:
    """Streaming DataFrame of per-window sums that continues from ``snapshot``
    (key, window_start, agg; several rows of a window add up), if one is given.

    ``records``: streaming RECORD (ts as timestamp); ``positions`` (topic,
    partition, position): the source offset each partition's state includes, as
    ``SnapshotStore.sources`` returns it. With ``retention_seconds`` a window leaves
    the state once the watermark (newest time less ``delay_seconds``) reaches its
    start plus that; records for it are then skipped. ``slots`` must stay the same
    for one checkpoint.
    """
    fresh = _fresh(records, positions, size_seconds, retention_seconds, delay_seconds, slots)
    summed = fresh.mapInPandas(_sum_batches, fresh.schema)
    return _with_state(summed, RunningSum(retention_seconds is not None), snapshot, retention_seconds, slots)


def fold_stream(records: DataFrame, start: int, step: Callable[[int, int], int],
                size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *, snapshot: DataFrame | None = None,
                positions: DataFrame | None = None, retention_seconds: int | None = None, delay_seconds: int = 0,
                slots: int = SLOTS) -> DataFrame:
    """Any fold ``step(agg, value)`` from ``start`` per key and window, in offset order,
    optionally continued from a snapshot; retention and slots as in :func:`bootstrap_stream`."""
    fresh = _fresh(records, positions, size_seconds, retention_seconds, delay_seconds, slots)
    return _with_state(fresh, RunningFold(start, step, retention_seconds is not None), snapshot, retention_seconds, slots)


ROWS_PER_ELEMENT = 10_000
ROWS_SCHEMA = "key string, window_start timestamp, partition int, offset long, value long, seq long"


class WindowRows(StatefulProcessor):
    """Every record of a window with its sequence number, by offset: the store that keeps
    duplicates. Its groups are (window, slot). ``rows`` is a list of packed rows, ``n`` how
    many each key has, so that a batch appends without reading what is there."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState(
            "rows", "key array<string>, seq array<long>, partition array<int>, offset array<long>, value array<long>")
        self.n = handle.getValueState("n", "key array<string>, n array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("offset", kind="stable")  # one window's and slot's records of one batch
        n = dict(unpacked(self.n.get()))
        seq = []
        for k in new["key"].tolist():
            n[k] = n.get(k, 0) + 1
            seq.append(n[k])
        new["seq"] = seq
        columns = ["key", "seq", "partition", "offset", "value"]
        for lo in range(0, len(new), ROWS_PER_ELEMENT):
            part = new.iloc[lo:lo + ROWS_PER_ELEMENT]
            self.rows.appendValue((part["key"].tolist(), *[part[c].astype(int).tolist() for c in columns[1:]]))
        self.n.update(packed(n.items()))
        yield new.assign(window_start=key[0])[["key", "window_start", "partition", "offset", "value", "seq"]]

    def close(self) -> None:
        pass


def rows_stream(records: DataFrame, size_seconds: int = C.SAMPLE_WINDOW_SECONDS, *, slots: int = SLOTS) -> DataFrame:
    """Duplicates retained, as a stream: each record once, with its sequence number (from 1,
    by offset) in its key's window. A key's records come from one topic partition, in offset
    order from batch to batch. The records that one batch brings for a window and slot meet
    in one task; the source's rate limit bounds them. ``slots`` must stay the same for one
    checkpoint."""
    windowed = records.withColumn("window_start", F.window("ts", f"{size_seconds} seconds").start)
    return (in_slots(windowed.select("key", "window_start", "partition", "offset", "value"), slots).groupBy("window_start", "slot")
            .transformWithStateInPandas(WindowRows(), ROWS_SCHEMA, "Append", "None"))
