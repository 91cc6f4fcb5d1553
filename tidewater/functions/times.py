"""Epoch milliseconds <-> text. Dates follow the session time zone.

Milliseconds outside ``LEAST_MS`` to ``MOST_MS`` have no date: the result is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewater.contract import (
    DATE_FORMAT,
    DAY_MS,
    LEAST_MS,
    MOST_MS,
    SECOND_FORMAT,
    TEXT_ZONE_OFFSET,
)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def in_range(ts: Column | str) -> Column:
    """The milliseconds if they are a time that can be dated, otherwise NULL."""
    ts = _column(ts)
    return F.when(ts.between(LEAST_MS, MOST_MS), ts)


def _moment(ts: Column | str, earlier_ms: int = 0) -> Column:
    return F.timestamp_millis(in_range(ts) - F.lit(earlier_ms))


def to_day(ts: Column | str) -> Column:
    """Calendar day of an epoch-millisecond column, as a date."""
    return F.to_date(_moment(ts))


def to_previous_day(ts: Column | str) -> Column:
    """Calendar day of the moment 24 hours earlier."""
    return F.to_date(_moment(ts, DAY_MS))


def to_date_text(ts: Column | str) -> Column:
    """Calendar day as ``yyyy-MM-dd``."""
    return F.date_format(_moment(ts), DATE_FORMAT)


def to_second_text(ts: Column | str) -> Column:
    """Moment as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_moment(ts), SECOND_FORMAT)


def to_epoch_ms(text: Column | str, full: bool = False, zone: str = TEXT_ZONE_OFFSET) -> Column:
    """Epoch milliseconds of a day (or, with ``full``, a day and time) in a fixed zone.

    The zone is part of the parsed text, so the session zone has no effect.
    """
    time_part = "" if full else " 00:00:00"
    return F.unix_millis(
        F.to_timestamp(F.concat(_column(text), F.lit(time_part + zone)), SECOND_FORMAT + "XXX")
    )
