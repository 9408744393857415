"""UTC time helpers on timestamp columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorloom.functions.numeric import ColumnLike, as_column


def micros(ts: ColumnLike) -> Column:
    return F.unix_micros(as_column(ts).cast("timestamp"))


def floor_minutes(ts: ColumnLike, step_minutes: int) -> Column:
    """Start of the ``step_minutes`` bucket; buckets restart at every UTC midnight."""
    if not isinstance(step_minutes, int) or step_minutes <= 0:
        raise ValueError("step_minutes must be a positive integer")
    us = micros(ts)
    day_us = F.lit(86_400_000_000)
    in_day = F.pmod(us, day_us)
    return F.timestamp_micros(us - F.pmod(in_day, F.lit(step_minutes * 60_000_000)))


def utc_window(end: ColumnLike, window_hours: float) -> tuple[Column, Column]:
    """``(end - window_hours, end)``."""
    if not math.isfinite(window_hours) or window_hours <= 0:
        raise ValueError("window_hours must be a finite positive number")
    end_us = micros(end)
    return F.timestamp_micros(end_us - F.lit(round(window_hours * 3_600_000_000))), F.timestamp_micros(end_us)


def format_utc(ts: ColumnLike) -> Column:
    return F.date_format(as_column(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def format_utc_compact(ts: ColumnLike) -> Column:
    return F.date_format(as_column(ts).cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'")


def parse_utc(text: ColumnLike, allow_naive: bool = False) -> Column:
    """ISO text to timestamp; NULL when malformed, and when it has no offset unless ``allow_naive``."""
    t = F.trim(as_column(text))
    parsed = F.try_to_timestamp(F.when(t != "", t))
    if allow_naive:
        return parsed
    return F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), parsed)


def hours_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Hours from ``earlier`` to ``later`` as double, through exact microseconds."""
    return (micros(later) - micros(earlier)).cast("double") / F.lit(1e6) / F.lit(3600.0)
