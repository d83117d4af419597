"""Calendar keys and clock rounding as native column expressions.

All take and give Spark columns, accept ``TIMESTAMP`` and ``TIMESTAMP_NTZ``, return null for
null, and read the clock in UTC (see ``session.require_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE


def month_key(ts: Column) -> Column:
    """``"YYYY-MM"`` of a timestamp; the partition value of stored feature tables."""
    return F.date_format(ts, "yyyy-MM")


def weekend_flag(ts: Column, zone: str = "America/New_York") -> Column:
    """1 when the UTC instant falls on a Saturday or Sunday in ``zone``, else 0."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))
    return (F.weekday(local) >= 5).cast("int")


def round_to_minutes(ts: Column, minutes: int, direction: str = "up") -> Column:
    """Move a timestamp up (or down) to a grid of ``minutes`` that restarts every hour.

    Exact grid points stay. For widths that divide 60 this is the epoch grid; other widths
    count from the full hour and may step past the next one.
    """
    step = F.lit(minutes * MICROS_PER_MINUTE)
    into_hour = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(MICROS_PER_HOUR))
    if direction == "up":
        shift = F.pmod(-into_hour, step)
    elif direction == "down":
        shift = -F.pmod(into_hour, step)
    else:
        raise ValueError(f"direction must be 'up' or 'down', got {direction!r}")
    seconds = (shift / F.lit(1_000_000)).cast("decimal(18,6)")
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC."""
    return F.unix_timestamp(ts)


def from_epoch_seconds(seconds: Column) -> Column:
    """The timestamp of a count of epoch seconds."""
    return F.timestamp_seconds(seconds)
