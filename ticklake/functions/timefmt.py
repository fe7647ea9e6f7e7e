"""Time column expressions (native, codegen-friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.schemas import EVENT_TIME_PATTERN, OFFSET_SUFFIX


def as_column(value) -> Column:
    """A timestamp parameter as a Column: Column, datetime, or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        # as text: a naive datetime handed to the JVM would be shifted by the
        # Python process's local time zone
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_event_time(text: Column, *, strict_fraction: bool = True) -> Column:
    """Event-time text -> TIMESTAMP_NTZ, NULL when it does not parse.

    A trailing ``+hh:mm``/``-hh:mm`` offset is *stripped*, not applied (the wall
    clock is kept). The pattern wants six fraction digits; with
    ``strict_fraction`` a text with another number of digits is NULL, as the
    stream engine's fixed-width pattern would give.
    """
    local = F.regexp_replace(text, OFFSET_SUFFIX, "")
    parsed = F.try_to_timestamp(local, F.lit(EVENT_TIME_PATTERN)).cast("timestamp_ntz")
    if strict_fraction:
        parsed = F.when(local.rlike(r"\.[0-9]{6}$"), parsed)
    return parsed


def to_millis(ts: Column) -> Column:
    """Truncate to milliseconds: sinks keep TIMESTAMP(3)."""
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def epoch_ms_to_iso(ms: Column, *, python_compat: bool = False) -> Column:
    """Epoch milliseconds -> ISO-8601 UTC text with a ``+00:00`` suffix.

    Default: always six fraction digits. ``python_compat`` drops the fraction
    when it is zero, as ``datetime.isoformat()`` does.
    """
    ts = F.timestamp_millis(ms).cast("timestamp_ntz")
    full = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    if not python_compat:
        return full
    bare = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return F.when(F.pmod(ms, F.lit(1000)) == 0, bare).otherwise(full)


def iso_utc(ts: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> ISO text with six digits and +00:00."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a UTC wall-clock timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(later: Column, earlier: Column) -> Column:
    """(later - earlier) in minutes as DOUBLE, unrounded."""
    return (micros(later) - micros(earlier)) / F.lit(60_000_000.0)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def minus_seconds(ts: Column, seconds: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(seconds)} SECONDS")


def time_bucket(ts: Column, seconds: int) -> Column:
    """Integer bucket number of width ``seconds`` (for skew-splitting windows)."""
    return F.floor(micros(ts) / F.lit(int(seconds) * 1_000_000))
