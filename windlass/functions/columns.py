"""Column expressions used across the library (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(value: str | Column) -> Column:
    """Fold a two-decimal double as exact bigint cents."""
    return F.round(col(value) * 100).cast("bigint")


def decode_long(binary: str | Column) -> Column:
    """8-byte big-endian two's complement -> bigint (Kafka LongSerializer)."""
    return F.conv(F.hex(col(binary)), 16, -10).cast("bigint")


def encode_long(value: str | Column) -> Column:
    """bigint -> 8-byte big-endian two's complement."""
    return F.unhex(F.lpad(F.hex(col(value)), 16, "0"))


def _epoch_ntz() -> Column:
    # parsed as a wall clock: independent of the session time zone
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` wall clock.

    Computed as a difference of wall clocks, so the result does not depend
    on the session time zone (a cast to ``timestamp`` would).
    """
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), col(ts))


def micros_to_ntz(micros: str | Column) -> Column:
    """``timestamp_ntz`` wall clock ``micros`` after the epoch."""
    return F.timestamp_add("MICROSECOND", col(micros), _epoch_ntz())


def ntz_to_instant(ts: str | Column) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` reading the wall clock as UTC,
    whatever the session time zone (streaming watermarks need ``timestamp``)."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts: str | Column) -> Column:
    """``timestamp`` -> its UTC wall clock as ``timestamp_ntz``."""
    return micros_to_ntz(F.unix_micros(col(ts)))


def segment_id(window_start: str | Column, segment_seconds: int) -> Column:
    """Time slice of the store a window belongs to."""
    return F.floor(epoch_micros(window_start) / F.lit(segment_seconds * MICROS)).cast("bigint")


def sampled(ident: str | Column, every_n: int) -> Column:
    """Deterministic 1-in-``every_n`` sample of an identifier.

    Same rate as drawing ``nextInt(n) == 0`` per flush, but reproducible
    across retries and engines: first 32 bits of md5(id) modulo n.
    """
    h = F.conv(F.substring(F.md5(col(ident).cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(every_n)) == 0


def layout_path(*parts: str | Column) -> Column:
    """Join path parts with '/': blank parts dropped, each part trimmed and
    one trailing '/' removed. One layout for both writer and reader."""
    arr = F.array(*[col(p) if isinstance(p, Column) else F.lit(p) for p in parts])
    kept = F.filter(arr, lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    cleaned = F.transform(kept, lambda x: F.regexp_replace(F.trim(x), "/$", ""))
    return F.array_join(cleaned, "/")


def layout_path_str(*parts: object) -> str:
    """Python twin of :func:`layout_path` for driver-side paths."""
    out = []
    for p in parts:
        s = "" if p is None else str(p).strip()
        if not s:
            continue
        out.append(s[:-1] if s.endswith("/") else s)
    return "/".join(out)
