"""Time expressions. Times travel as strings; arithmetic uses parsed timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TIME_FORMAT

# The two halves of an hour label.
HOUR_LABEL_FORMATS = ("yyyy-MM-dd HH时", "-HH时")


def parse_time(value) -> Column:
    """Timestamp of a ``yyyy-MM-dd HH:mm:ss`` string; null when malformed."""
    return F.try_to_timestamp(_col(value), F.lit(TIME_FORMAT))


def format_time(value) -> Column:
    return F.date_format(_col(value), TIME_FORMAT)


def day_of(value) -> Column:
    """Date part of a time string."""
    return F.substring(_col(value), 1, 10)


def hour_of(value) -> Column:
    """Date and hour part of a time string."""
    return F.substring(_col(value), 1, 13)


def seconds_between(start, end) -> Column:
    return F.unix_seconds(_col(end)) - F.unix_seconds(_col(start))


def whole_minutes(start, end) -> Column:
    """Complete minutes from start to end, truncated toward zero."""
    return _div(seconds_between(start, end), F.lit(60))


def whole_hours(start, end) -> Column:
    """Complete hours from start to end, truncated toward zero."""
    return _div(seconds_between(start, end), F.lit(3600))


def millis_between(start, end) -> Column:
    return F.unix_millis(_col(end)) - F.unix_millis(_col(start))


def truncated_mean(total, count) -> Column:
    """Integer mean, truncated toward zero; null when there is nothing to average."""
    return F.when(_col(count) != 0, _div(_col(total), _col(count))).cast("bigint")


def hour_label(value) -> Column:
    """Label of the clock hour a time falls into: date, hour and next hour."""
    ts = _col(value)
    start, end = HOUR_LABEL_FORMATS
    return F.concat(F.date_format(ts, start),
                    F.date_format(ts + F.expr("interval 1 hour"), end))


def _div(a: Column, b: Column) -> Column:
    # integral division: stays in bigint, truncates toward zero
    return F.call_function("div", a, b)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
