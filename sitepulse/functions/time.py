"""Ages, look-backs and clock labels. The evaluation time is always a parameter."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitepulse.functions.labels import cut

# Hour edges and names of the six daily slots.
SLOT_EDGES = [-1, 3, 7, 11, 15, 19, 23]
SLOT_NAMES = ["12AM~4AM", "4AM~8AM", "8AM~12PM", "12PM~4PM", "4PM~8PM", "8PM~12AM"]


def as_of(value: str | date | datetime | Column) -> Column:
    """Evaluation time as a zone-free literal, so comparisons reach the scan as plain filters."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _whole_units(start: str | Column, end: str | Column, micros: int) -> Column:
    gap = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return F.floor(gap / F.lit(micros)).cast("long")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole minutes, floored toward minus infinity (-90 s is -2)."""
    return _whole_units(start, end, 60_000_000)


def hours_between(start: str | Column, end: str | Column) -> Column:
    return _whole_units(start, end, 3_600_000_000)


def minutes_between_exact(start: str | Column, end: str | Column, digits: int = 2) -> Column:
    """Minutes with decimals, taken from whole seconds."""
    return F.round(_whole_units(start, end, 1_000_000) / F.lit(60.0), digits)


def days_before(asof: str | datetime | Column, days: int, *, whole_days: bool = False) -> Column:
    """``asof`` minus ``days``; ``whole_days`` starts from midnight."""
    base = as_of(asof)
    if whole_days:
        base = F.date_trunc("day", base).cast("timestamp_ntz")
    return base - F.make_dt_interval(F.lit(days))


def clamp(value: str | Column, low: Column, high: Column) -> Column:
    """Keep a time inside [low, high]; a missing (still open) time becomes ``high``."""
    return F.greatest(low, F.least(F.coalesce(_col(value), high), high))


def slot_label(value: str | Column) -> Column:
    """Name of the four-hour slot a time falls into."""
    return cut(F.hour(_col(value)), SLOT_EDGES, SLOT_NAMES)


def combine_date_time(day: str | Column, clock: str | Column) -> Column:
    joined = F.concat_ws(" ", _col(day).cast("string"), _col(clock).cast("string"))
    return F.try_to_timestamp(joined).cast("timestamp_ntz")


def parse_time(value: str | Column, pattern: str | None = None) -> Column:
    """Text to time; text that does not parse becomes NULL."""
    if pattern is None:
        return F.try_to_timestamp(_col(value)).cast("timestamp_ntz")
    return F.try_to_timestamp(_col(value), F.lit(pattern)).cast("timestamp_ntz")
