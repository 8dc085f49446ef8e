"""Dates, packed times and day windows. Every window takes an explicit as-of date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date the sources store for "none".
NO_DATE = "0001-01-01"


def _day(as_of: date, back: int) -> Column:
    # The literal is worked out here, so the filter reaches the scan as a constant.
    return F.lit(as_of - timedelta(days=back))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_date() -> Column:
    # As text, since the driver cannot pass a four-digit year 1 to the JVM.
    return F.lit(NO_DATE).cast("date")


def _date(d: Column | str | date) -> Column:
    return F.lit(d) if isinstance(d, date) else _col(d)


# --- day windows -----------------------------------------------------------


def on_day(col: Column | str, as_of: date, back: int = 0) -> Column:
    """The whole day `back` days before `as_of`, for dates and timestamps alike.

    Half open, so the last minute of the day is in, and the range is pushed to
    the scan (a cast of the column to a date would not be).
    """
    c = _col(col)
    return (c >= _day(as_of, back)) & (c < _day(as_of, back - 1))


def between_days(col: Column | str, as_of: date, first_back: int, last_back: int = 0) -> Column:
    """BETWEEN two dates. A timestamp equals the upper bound only at midnight."""
    return _col(col).between(_day(as_of, first_back), _day(as_of, last_back))


def since(col: Column | str, as_of: date, back: int = 0) -> Column:
    return _col(col) >= _day(as_of, back)


def same_day(col: Column | str, as_of: date, back: int = 0) -> Column:
    """Equality for a column that holds dates."""
    return _col(col) == _day(as_of, back)


# --- month arithmetic ------------------------------------------------------


def month_start(d: Column | str | date, back: int = 0) -> Column:
    """First day of the month `back` months before `d`."""
    return F.trunc(F.add_months(_date(d), -back), "MM")


def month_end(d: Column | str | date, days_back: int = 0) -> Column:
    """Last day of the month that holds `d` less `days_back` days."""
    return F.last_day(F.date_sub(_date(d), days_back))


# --- packed dates and times ------------------------------------------------


def yymmdd(d: Column | str | date) -> Column:
    """A date as the six-digit number the order tables hold (leading zeros lost)."""
    return F.date_format(_date(d), "yyMMdd").cast("int")


def from_yymmdd(col: Column | str) -> Column:
    """The six-digit number, or text, as a date; NULL when it is none. Longer numbers are none."""
    text = _col(col).cast("string")
    return F.when(F.length(text) <= 6, F.try_to_timestamp(F.lpad(text, 6, "0"), F.lit("yyMMdd")).cast("date"))


def hhmm_pad(col: Column | str) -> Column:
    """HHMM without leading zeros as four characters ('5' is five past midnight)."""
    text = _col(col).cast("string")
    return F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)


def hhmm_to_time(col: Column | str) -> Column:
    """An HHMM number as 'HH:mm:00'; NULL when it is no time of day."""
    n = _col(col).cast("int")
    hour, minute = F.floor(n / 100), n % 100
    text = F.lpad(n.cast("string"), 4, "0")
    return F.when(
        (n >= 0) & (hour < 24) & (minute < 60),
        F.concat(F.substring(text, 1, 2), F.lit(":"), F.substring(text, 3, 2), F.lit(":00")),
    )


def time_of(col: Column | str) -> Column:
    return F.date_format(_col(col), "HH:mm:ss")


def time_after(col: Column | str, hhmmss: str) -> Column:
    return time_of(col) > F.lit(hhmmss)


# --- rendering -------------------------------------------------------------


def iso_z(col: Column | str) -> Column:
    """ISO text with a Z. The value stays local time, as in the source feeds."""
    return F.date_format(_col(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_of(day: Column | str, hhmm: Column | str) -> Column:
    """A date and an HHMM number as ISO text; NULL when either is missing or bad."""
    return F.concat(_col(day).cast("string"), F.lit("T"), hhmm_to_time(hhmm))


def iso_z_of(day: Column | str, hhmm: Column | str) -> Column:
    return F.concat(iso_of(day, hhmm), F.lit("Z"))


def us_date(col: Column | str) -> Column:
    return F.date_format(_col(col), "MM/dd/yyyy")


# --- spans -----------------------------------------------------------------


def los_days(admitted: Column | str, discharged: Column | str, raw: bool = False) -> Column:
    """Length of stay in days; NULL while the patient is in (raw: the plain difference)."""
    days = F.datediff(_col(discharged), _col(admitted))
    return days if raw else F.when(_col(discharged) != no_date(), days)


def duration_parts(start: Column | str, stop: Column | str) -> tuple[Column, Column]:
    """A span as hours and minutes of two digits at least; NULL when an end is missing or the stop comes before the start."""
    seconds = F.timestamp_diff("SECOND", _col(start), _col(stop))
    seconds = F.when(seconds >= 0, seconds)
    return _two_digits(F.floor(seconds / 3600)), _two_digits(F.floor(seconds % 3600 / 60))


def _two_digits(n: Column) -> Column:
    text = n.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
