"""Durations, epoch arithmetic and time formatting.

Event time may be ``timestamp`` or ``timestamp_ntz``; the session zone is expected to be UTC, so that
both count the same microseconds since the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def duration_micros(duration: str) -> int:
    """``"10 seconds"`` -> 10000000."""
    amount, unit = duration.split()
    return int(amount) * MICROS[unit.lower().rstrip("s")]


def interval(duration: str) -> Column:
    """``"10 seconds"`` as an interval column."""
    return F.expr(f"INTERVAL {duration}")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp"))


def millis(ts: Column) -> Column:
    """Milliseconds since the epoch."""
    return F.unix_millis(ts.cast("timestamp"))


def window_start(ts: Column, size: str) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts``, as ``timestamp_ntz``."""
    width = duration_micros(size)
    value = micros(ts)
    return F.timestamp_micros(value - F.pmod(value, F.lit(width))).cast("timestamp_ntz")


def seconds_timestamp(epoch_millis: Column) -> Column:
    """Epoch milliseconds to a timestamp at whole seconds; the milliseconds are cut off."""
    return F.timestamp_seconds(F.floor(epoch_millis / F.lit(1000))).cast("timestamp_ntz")


def millis_timestamp(epoch_millis: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(epoch_millis).cast("timestamp_ntz")


def format_time(ts: Column, pattern: str = TEXT_FORMAT) -> Column:
    """Text form of an instant in the session zone."""
    return F.date_format(ts, pattern)


def parse_millis(text: Column, zone: str = "+08:00", pattern: str = TEXT_FORMAT) -> Column:
    """Epoch milliseconds of a text written in ``zone``."""
    return F.unix_millis(F.to_utc_timestamp(F.to_timestamp(text, pattern), zone))
