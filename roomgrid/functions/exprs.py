"""Time, interval and rounding expressions. All stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR_FUTURE = "9999-12-31 23:59:59"


def ntz(value) -> Column:
    """A zone-free timestamp literal from a datetime or text; columns pass unchanged."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def open_end(column) -> Column:
    """The end of an interval; a missing end lies in the far future."""
    return F.coalesce(_col(column), ntz(FAR_FUTURE))


def overlaps(start_a, end_a, start_b, end_b) -> Column:
    """Half-open intervals: touching ends do not overlap."""
    return (_col(start_a) < _col(end_b)) & (_col(end_a) > _col(start_b))


def epoch_second(column: str) -> Column:
    """Seconds since 1970 of a zone-free timestamp column, whatever the session zone."""
    return F.expr(f"cast(cast({column} - timestamp_ntz'1970-01-01 00:00:00' as interval second) as bigint)")


def _boundaries(start, end, unit: str) -> Column:
    if isinstance(start, str) and isinstance(end, str):
        hours = f"datediff(cast({end} as date), cast({start} as date)) * 24L + hour({end}) - hour({start})"
        return F.expr(hours if unit == "hour" else f"({hours}) * 60 + minute({end}) - minute({start})")
    a, b = _col(start), _col(end)
    hours = F.datediff(b.cast("date"), a.cast("date")).cast("long") * 24 + (F.hour(b) - F.hour(a))
    return hours if unit == "hour" else hours * 60 + (F.minute(b) - F.minute(a))


def hour_diff(start, end) -> Column:
    """Hour boundaries crossed, not full hours."""
    return _boundaries(start, end, "hour")


def minute_diff(start, end) -> Column:
    """Minute boundaries crossed, not full minutes."""
    return _boundaries(start, end, "minute")


def shift_minutes(column, minutes) -> Column:
    """column + minutes; minutes may be a column, its name or a number."""
    m = F.lit(minutes) if isinstance(minutes, int) else _col(minutes)
    return _col(column) + F.make_dt_interval(mins=m.cast("int"))


def hundredths(numerator, denominator) -> Column:
    """numerator / denominator in whole hundredths, half up, in exact integers (BIGINT)."""
    n, d = _col(numerator).cast("long"), _col(denominator).cast("long")
    return F.call_function("div", n * 200 + d, d * 2)


def as_decimal(count_of_hundredths, precision: int) -> Column:
    return (_col(count_of_hundredths).cast("decimal(36,0)") / F.lit(100).cast("decimal(3,0)")).cast(f"decimal({precision},2)")


def percent(part, whole) -> Column:
    """100 * part / whole as decimal(5,2), exact half up; NULL if whole is zero."""
    return as_decimal(hundredths(_col(part) * 100, F.nullif(_col(whole), F.lit(0))), 5)
