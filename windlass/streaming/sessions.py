"""Session windows in a running query.

The state is the sessions that can still change, in slots of keys (``bootstrap``): a
map from the day of a session's end to that day's sessions, columns as arrays. A
batch's records are first made into sessions of their own within each Arrow
batch, so a hot key costs a few rows per task; the slot's task then merges them with
the ones it holds that end no more than the gap before the batch's first. A late record may join two sessions into one: the ones that are
replaced are retracted - emitted again with null values, which is a tombstone to the
changelog - and the new one is emitted. So the result is a changelog by (key, start,
end) that ``SnapshotSink`` folds into versions, and that a new query resumes from.

With ``grace_seconds`` a session is closed, and leaves the state by an event-time
timer, once the watermark reaches its end + gap + grace; records as late as that are
skipped. Without it sessions stay open for ever, as in batch; a batch still reads only
the days from its oldest record on, and writes those it changes.
"""

from __future__ import annotations

import sys as _sys
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import MICROS, epoch_micros
from .bootstrap import SLOTS, _past, in_slots, packed, unpacked

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

_PART = "key string, start long, end long, n long, agg long, source_topic string, source_partition int, source_offset long"
_OUT = ("key string, start long, end long, n long, agg long, source_topic string, source_partition int, "
        "source_offset long")


def merge_sessions(sessions: list[tuple], gap: int) -> dict[int, tuple]:
    """start -> (end, n, agg) of intervals (start, end, n, agg), joined where no more than
    ``gap`` lies between them."""
    out: dict[int, tuple] = {}
    last = None
    for start, end, n, agg in sorted(sessions):
        if last is not None and start - out[last][0] <= gap:
            e, m, a = out[last]
            out[last] = (max(e, end), m + n, a + agg)
        else:
            last = start
            out[start] = (end, n, agg)
    return out


def _own_sessions(gap: int):
    """mapInPandas body: the sessions of each Arrow batch by itself."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf.sort_values(["key", "t"], kind="stable")
            new = (pdf["key"] != pdf["key"].shift()) | (pdf["t"] - pdf["t"].shift() > gap)
            yield (pdf.groupby(["key", new.cumsum()], sort=False)
                   .agg(start=("t", "min"), end=("t", "max"), n=("t", "size"), agg=("value", "sum"), source_topic=("topic", "first"),
                        source_partition=("partition", "first"), source_offset=("offset", "max"))
                   .reset_index(level=1, drop=True).reset_index())

    return run


SEGMENT = 86_400 * MICROS  # sessions are held by the day of their end


class Sessions(StatefulProcessor):
    """Its groups are the slots of the keys."""

    def __init__(self, gap: int, grace: int | None) -> None:
        self.gap, self.grace = gap, grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getMapState("sessions", "segment long", "key array<string>, start array<long>, end array<long>, "
                                           "n array<long>, agg array<long>")

    def _closes(self, end: int) -> int:
        """The watermark (ms) at which a session that ends at ``end`` (micros) is closed."""
        return -(-(end + self.gap + self.grace) // 1000)

    def _segments(self) -> list[int]:
        return sorted(k[0] for k in self.sessions.keys()) if self.sessions.exists() else []

    def _load(self, segment: int) -> dict[tuple, tuple]:
        """(key, start) -> (end, n, agg)"""
        return {r[:2]: r[2:] for r in unpacked(self.sessions.getValue((segment,)))}

    def _store(self, segment: int, held: dict[tuple, tuple]) -> None:
        if held:
            self.sessions.updateValue((segment,), packed((*k, *v) for k, v in held.items()))
        elif self.sessions.containsKey((segment,)):
            self.sessions.removeKey((segment,))

    def _close_later(self, ends: list[int]) -> None:
        """A timer for the first of some sessions; when it comes, it sets the next one."""
        if self.grace is not None and ends:
            self.handle.registerTimer(self._closes(min(ends)))

    def _merge(self, new: dict[str, list[tuple]]) -> Iterator[tuple]:
        """Put new sessions to the held ones; (key, start, old, now) of each that was held and
        is replaced (now None) or that is new or changed (old its former end, if it had one)."""
        low = (min(s[0] for sessions in new.values() for s in sessions) - self.gap) // SEGMENT
        segments = defaultdict(dict, {g: self._load(g) for g in self._segments() if g >= low})
        before = defaultdict(dict)
        for sessions in segments.values():
            for (k, start), session in sessions.items():
                if k in new:
                    before[k][start] = session
        touched, ends = set(), []
        for k, sessions in new.items():
            held = before[k]
            after = merge_sessions([(s, *v) for s, v in held.items()] + sessions, self.gap)
            for start, old in held.items():
                if after.get(start) != old:
                    del segments[old[0] // SEGMENT][k, start]
                    touched.add(old[0] // SEGMENT)
                    if start not in after or after[start][0] != old[0]:  # joined into another, or ends elsewhere now
                        yield k, start, old[0], None
            for start, session in after.items():
                if held.get(start) != session:
                    segments[session[0] // SEGMENT][k, start] = session
                    touched.add(session[0] // SEGMENT)
                    ends.append(session[0])
                    yield k, start, session[0], session
        for g in touched:
            self._store(g, segments[g])
        self._close_later(ends)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        new = defaultdict(list)  # a large slot comes in several frames
        for k, *session in zip(*[initialState[c].tolist() for c in ("key", "start", "end", "n", "agg")]):  # noqa: B905
            new[k].append(tuple(session))
        for _ in self._merge(new):
            pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new, where = defaultdict(list), {}
        for pdf in rows:
            for k, start, end, n, agg, *at in zip(*[pdf[c].tolist() for c in (  # noqa: B905
                    "key", "start", "end", "n", "agg", "source_topic", "source_partition", "source_offset")]):
                new[k].append((start, end, n, agg))
                if k not in where or at[2] > where[k][2]:
                    where[k] = at
        if self.grace is not None:
            mark = timerValues.getCurrentWatermarkInMs()
            on_time = {k: [s for s in sessions if self._closes(s[1]) > mark] for k, sessions in new.items()}
            new = {k: sessions for k, sessions in on_time.items() if sessions}
        if not new:
            return
        out = [(k, start, end, None, None, None, None, None) if now is None else (k, start, end, *now[1:], *where[k])
               for k, start, end, now in self._merge(new)]
        if out:
            columns = zip(*out)  # noqa: B905
            yield pd.DataFrame({c.split()[0]: pd.array(v, "Int64") if c.split()[1] in ("long", "int") else list(v)
                                for c, v in zip(_OUT.split(", "), columns)})  # noqa: B905

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        for g in self._segments():
            held = self._load(g)
            left = {k: s for k, s in held.items() if self._closes(s[0]) > mark}
            if len(left) < len(held):
                self._store(g, left)
            if left:
                self._close_later([s[0] for s in left.values()])
                break  # later segments end later
        return iter([])

    def close(self) -> None:
        pass


def session_stream(records: DataFrame, gap_seconds: int, *, grace_seconds: int | None = None,
                   snapshot: DataFrame | None = None, positions: DataFrame | None = None, slots: int = SLOTS) -> DataFrame:
    """Changelog of session windows: (key, window_start, window_end, agg, n, source_topic,
    source_partition, source_offset), one row per session that a batch changed and one
    with null values per session that it replaced.

    ``records``: streaming RECORD (ts as timestamp). Records no more than the gap apart
    share a session, whose end is its last record's time. ``snapshot`` (key,
    window_start, window_end, agg, n) and ``positions`` continue from a version of
    another query. ``slots`` must stay the same for one checkpoint.
    """
    gap = gap_seconds * MICROS
    if grace_seconds is not None:
        records = records.withWatermark("ts", "0 seconds")
    rows = _past(records, positions).select("key", F.unix_micros("ts").alias("t"), "value", "topic", "partition", "offset")
    parts = in_slots(rows.mapInPandas(_own_sessions(gap), _PART), slots)
    init = {}
    if snapshot is not None:
        held = snapshot.select("key", epoch_micros("window_start").alias("start"), epoch_micros("window_end").alias("end"), "n", "agg")
        init["initialState"] = in_slots(held, slots).groupBy("slot")
    grace = None if grace_seconds is None else grace_seconds * MICROS
    out = parts.groupBy("slot").transformWithStateInPandas(Sessions(gap, grace), _OUT, "Update",
                                                          "None" if grace is None else "EventTime", **init)
    return out.select("key", F.timestamp_micros("start").alias("window_start"), F.timestamp_micros("end").alias("window_end"),
                      "agg", "n", "source_topic", "source_partition", "source_offset")
