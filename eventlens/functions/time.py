"""Time helpers: durations, epoch conversion, buckets.

All of these are plain Column expressions so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_US = {
    "microsecond": 1, "us": 1,
    "millisecond": 1_000, "ms": 1_000,
    "second": 1_000_000, "s": 1_000_000, "sec": 1_000_000,
    "minute": 60_000_000, "min": 60_000_000, "m": 60_000_000,
    "hour": 3_600_000_000, "h": 3_600_000_000,
    "day": 86_400_000_000, "d": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(d) -> int:
    """'5 seconds' / '1 hour' / '2 min 30 s' / timedelta / int (µs) -> microseconds."""
    if isinstance(d, timedelta):
        return int(d / timedelta(microseconds=1))
    if isinstance(d, int):
        return d
    s = str(d).strip().lower()
    total, pos = 0, 0
    for m in re.finditer(r"(-?\d+(?:\.\d+)?)\s*([a-z]+)", s):
        unit = m.group(2)
        unit = unit[:-1] if unit.endswith("s") and unit[:-1] in _UNIT_US else unit
        if unit not in _UNIT_US:
            raise ValueError(f"unknown duration unit in {d!r}")
        total += int(round(float(m.group(1)) * _UNIT_US[unit]))
        pos = m.end()
    if pos == 0 or s[pos:].strip():
        raise ValueError(f"cannot parse duration {d!r}")
    return total


def _interval(us: int) -> Column:
    return F.expr(f"INTERVAL '{int(us)}' MICROSECOND")


def add_duration(ts, d) -> Column:
    """ts + duration; works for TIMESTAMP and TIMESTAMP_NTZ alike."""
    return F.col(ts) + _interval(duration_us(d)) if isinstance(ts, str) else ts + _interval(duration_us(d))


def sub_duration(ts, d) -> Column:
    return F.col(ts) - _interval(duration_us(d)) if isinstance(ts, str) else ts - _interval(duration_us(d))


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch (session zone for TIMESTAMP_NTZ; keep it UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def to_micros(c, dtype: str) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> epoch µs (a long), for cheap arithmetic."""
    c = F.col(c) if isinstance(c, str) else c
    if dtype == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr(_NTZ_EPOCH), c)
    return F.unix_micros(c)


def from_micros(c, dtype: str) -> Column:
    """Inverse of :func:`to_micros`, back to the same timestamp type."""
    c = F.col(c) if isinstance(c, str) else c
    if dtype == "timestamp_ntz":
        return F.timestamp_add("MICROSECOND", c, F.expr(_NTZ_EPOCH))
    return F.timestamp_micros(c)


def floor_to(us: Column, step_us: int) -> Column:
    """Exact integer floor of epoch µs to a multiple of ``step_us``."""
    return us - F.pmod(us, F.lit(int(step_us)))


def bucket_of(ts, width) -> Column:
    """Integer time bucket of ``width``; used to split a hot key by time."""
    return F.floor(epoch_micros(ts) / F.lit(duration_us(width))).cast("long")


def from_epoch_s(c) -> Column:
    """Epoch seconds (long) -> TIMESTAMP (SURVEY §2.9 'seconds -> instant')."""
    return F.timestamp_seconds(F.col(c) if isinstance(c, str) else c)


def from_epoch_ms(c) -> Column:
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


def parse_text_time(c, pattern: str = "dd/MM/yyyy:HH:mm:ss") -> Column:
    """Date text with a pattern -> TIMESTAMP (web-log layout by default)."""
    return F.to_timestamp(F.col(c) if isinstance(c, str) else c, pattern)


def to_event_timestamp(c) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP, needed before ``withWatermark``."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def event_time(df, ts: str = "ts"):
    """Return ``df`` with ``ts`` as TIMESTAMP (streams need it; batch accepts either)."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def utc_day(ts) -> Column:
    """Start of the (UTC, session-zone) day: the daily-reset boundary of D1."""
    return F.date_trunc("day", F.col(ts) if isinstance(ts, str) else ts)
