"""Event time out of an epoch number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest epoch numbers a TIMESTAMP (microseconds in a long) can hold.
_LIMITS = {"ms": (1 << 63) // 1000 - 1, "s": (1 << 63) // 1_000_000 - 1}


def event_timestamp(column: str | Column, unit: str = "ms") -> Column:
    """TIMESTAMP of an epoch number; null, not an overflow error, where it is out of range."""
    if unit not in _LIMITS:
        raise ValueError(f"unit must be 'ms' or 's', not {unit!r}")
    number = F.col(column) if isinstance(column, str) else column
    convert = F.timestamp_millis if unit == "ms" else F.timestamp_seconds
    return F.when(number.between(-_LIMITS[unit], _LIMITS[unit]), convert(number))


def event_date(column: str | Column, unit: str = "ms") -> Column:
    return F.to_date(event_timestamp(column, unit))


def event_hour(column: str | Column, unit: str = "ms") -> Column:
    return F.hour(event_timestamp(column, unit))
