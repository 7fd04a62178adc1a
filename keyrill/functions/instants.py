"""Time arithmetic in whole microseconds, so that results never depend on rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def floor_to(us: Column, width_us: int) -> Column:
    """Start of the cell `[start, start + width)`."""
    return us - F.pmod(us, F.lit(width_us).cast("bigint"))


def ceil_to(us: Column, width_us: int) -> Column:
    """The first multiple of the width at or after the instant."""
    return floor_to(us + F.lit(width_us - 1), width_us)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def payload_time(time_ms: Column, record_time: Column) -> Column:
    """Event time from an epoch-milliseconds payload field, falling back to the record's own time."""
    return F.coalesce(F.timestamp_millis(time_ms), record_time)
