"""Turning the caller's idea of "now" into a Column."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def moment(as_of: Column | datetime | str | None) -> Column:
    """``as_of`` as a TIMESTAMP column; the query's own start time when it is None.

    Text without an offset is UTC, whatever the session time zone.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        return F.lit(as_of)
    if as_of[-1:] == "Z" or "+" in as_of:
        return F.lit(as_of).cast("timestamp")
    return F.lit(as_of + "Z").cast("timestamp")


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def before(when: Column, *, minutes: float = 0, seconds: float = 0) -> Column:
    """``when`` moved back; exact to the microsecond and free of calendar rules."""
    return F.timestamp_micros(F.unix_micros(when) - F.lit(int((minutes * 60 + seconds) * 1_000_000)))
