"""Calendar functions.

Weeks start on Monday and are numbered by ISO rules unless ``first_day="sunday"`` is given; the
Sunday variant numbers weeks by ``ceil(day of year / 7)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnOrName, as_col, as_lit

__all__ = [
    "date_part",
    "day_name",
    "month_name",
    "day_of_month",
    "day_of_year",
    "day_of_week",
    "week_start",
    "week_end",
    "week_of_year",
    "iso_week_start",
    "iso_week_end",
    "iso_week_of_year",
    "now_in",
    "today",
    "yesterday",
    "tomorrow",
    "n_days_ago",
    "n_days_away",
    "n_weeks_ago",
    "n_weeks_away",
    "n_months_ago",
    "n_months_away",
    "last_week",
    "next_week",
    "last_month",
    "next_month",
    "last_month_name",
    "next_month_name",
    "last_month_number",
    "next_month_number",
    "periods_since",
    "period_diff",
    "add_periods",
    "round_timestamp",
    "to_unixtimestamp",
    "from_unixtimestamp",
    "convert_timezone",
]

_UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def _unit(period: str) -> str:
    if period not in _UNITS:
        raise ValueError(f"period must be one of {_UNITS}, got {period!r}")
    return period


def date_part(part: str, value: ColumnOrName) -> Column:
    return F.date_part(F.lit(part), as_col(value))


def day_name(value: ColumnOrName, short: bool = True) -> Column:
    return F.date_format(as_col(value), "E" if short else "EEEE")


def month_name(value: ColumnOrName, short: bool = True) -> Column:
    return F.date_format(as_col(value), "MMM" if short else "MMMM")


def day_of_month(value: ColumnOrName) -> Column:
    return F.dayofmonth(as_col(value))


def day_of_year(value: ColumnOrName) -> Column:
    return F.dayofyear(as_col(value))


def day_of_week(value: ColumnOrName, isoweek: bool = True) -> Column:
    """Monday=1 … Sunday=7, or Sunday=1 … Saturday=7 with ``isoweek=False``."""
    return F.weekday(as_col(value)) + 1 if isoweek else F.dayofweek(as_col(value))


def iso_week_start(value: ColumnOrName) -> Column:
    return F.date_trunc("week", as_col(value)).cast("date")


def iso_week_end(value: ColumnOrName) -> Column:
    return F.date_add(iso_week_start(value), 6)


def iso_week_of_year(value: ColumnOrName) -> Column:
    return F.weekofyear(as_col(value))


def week_start(value: ColumnOrName, first_day: str = "monday") -> Column:
    if first_day == "monday":
        return iso_week_start(value)
    day = as_col(value).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_end(value: ColumnOrName, first_day: str = "monday") -> Column:
    return F.date_add(week_start(value, first_day), 6)


def week_of_year(value: ColumnOrName, first_day: str = "monday") -> Column:
    if first_day == "monday":
        return iso_week_of_year(value)
    return F.ceil(F.dayofyear(as_col(value)) / 7).cast("int")


def now_in(as_of, tz: str = "UTC") -> Column:
    """The moment ``as_of`` (UTC) as wall-clock time in ``tz``."""
    return F.from_utc_timestamp(as_lit(as_of).cast("timestamp"), tz)


def today(as_of, tz: str = "UTC") -> Column:
    return now_in(as_of, tz).cast("date")


def n_days_ago(n: int, day: ColumnOrName) -> Column:
    return F.date_sub(as_col(day).cast("date"), n)


def n_days_away(n: int, day: ColumnOrName) -> Column:
    return n_days_ago(-n, day)


def yesterday(day: ColumnOrName) -> Column:
    return n_days_ago(1, day)


def tomorrow(day: ColumnOrName) -> Column:
    return n_days_away(1, day)


def n_weeks_away(n: int, day: ColumnOrName) -> Column:
    """Monday of the week ``n`` weeks from ``day``."""
    return F.trunc(F.date_add(as_col(day).cast("date"), 7 * n), "week")


def n_weeks_ago(n: int, day: ColumnOrName) -> Column:
    return n_weeks_away(-n, day)


def n_months_away(n: int, day: ColumnOrName) -> Column:
    """First day of the month ``n`` months from ``day``."""
    return F.trunc(F.add_months(as_col(day).cast("date"), n), "month")


def n_months_ago(n: int, day: ColumnOrName) -> Column:
    return n_months_away(-n, day)


def last_week(day: ColumnOrName) -> Column:
    return n_weeks_ago(1, day)


def next_week(day: ColumnOrName) -> Column:
    return n_weeks_away(1, day)


def last_month(day: ColumnOrName) -> Column:
    return n_months_ago(1, day)


def next_month(day: ColumnOrName) -> Column:
    return n_months_away(1, day)


def last_month_name(day: ColumnOrName, short: bool = True) -> Column:
    return month_name(last_month(day), short)


def next_month_name(day: ColumnOrName, short: bool = True) -> Column:
    return month_name(next_month(day), short)


def last_month_number(day: ColumnOrName) -> Column:
    return F.month(last_month(day))


def next_month_number(day: ColumnOrName) -> Column:
    return F.month(next_month(day))


def period_diff(start: ColumnOrName, end: ColumnOrName, period: str) -> Column:
    """Number of period boundaries between two moments (both are truncated first)."""
    unit = _unit(period)
    low = F.date_trunc(unit, as_col(start))
    high = F.date_trunc(unit, as_col(end))
    return F.timestamp_diff(unit.upper(), low, high)


def periods_since(value: ColumnOrName, as_of, period: str = "day") -> Column:
    return period_diff(value, as_lit(as_of).cast("timestamp"), period)


def add_periods(value: ColumnOrName, n, period: str) -> Column:
    return F.timestamp_add(_unit(period).upper(), as_lit(n), as_col(value))


def round_timestamp(value: ColumnOrName) -> Column:
    """Midnight nearest to the moment."""
    return F.date_trunc("day", add_periods(value, 12, "hour"))


def to_unixtimestamp(value: ColumnOrName) -> Column:
    return F.unix_timestamp(as_col(value).cast("timestamp"))


def from_unixtimestamp(value: ColumnOrName, format: str = "seconds") -> Column:
    readers = {
        "seconds": F.timestamp_seconds,
        "milliseconds": F.timestamp_millis,
        "microseconds": F.timestamp_micros,
    }
    if format not in readers:
        raise ValueError(f"format must be one of {sorted(readers)}, got {format!r}")
    return readers[format](as_col(value))


def convert_timezone(value: ColumnOrName, target: str, source: str = "UTC") -> Column:
    return F.from_utc_timestamp(F.to_utc_timestamp(as_col(value), source), target)
