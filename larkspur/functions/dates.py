"""Calendar expressions. Nothing reads the clock: "today" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import column

_UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")
_EPOCH_UNITS = {
    "seconds": F.timestamp_seconds,
    "milliseconds": F.timestamp_millis,
    "microseconds": F.timestamp_micros,
}


def _unit(name: str) -> str:
    if name not in _UNITS:
        raise ValueError(f"unknown date part {name!r}")
    return name


def as_date(value) -> Column:
    return F.to_date(column(value))


def shift(value, unit: str, n) -> Column:
    """Move a timestamp by ``n`` units; n may be a column."""
    return F.timestamp_add(_unit(unit).upper(), F.lit(n) if isinstance(n, int) else n, column(value))


def periods_since(value, as_of, unit: str = "day") -> Column:
    """Whole calendar boundaries crossed between a date and ``as_of``."""
    if unit == "day":
        return F.date_diff(column(as_of), column(value))
    return F.timestamp_diff(
        _unit(unit).upper(), F.date_trunc(unit, column(value)), F.date_trunc(unit, column(as_of))
    ).cast("int")


def day_name(value, short: bool = True) -> Column:
    return F.date_format(column(value), "E" if short else "EEEE")


def month_name(value, short: bool = True) -> Column:
    return F.date_format(column(value), "MMM" if short else "MMMM")


def day_of_week(value, iso: bool = True) -> Column:
    """Monday 1 to Sunday 7, or Sunday 1 to Saturday 7."""
    return F.weekday(column(value)) + 1 if iso else F.dayofweek(column(value))


def week_start(value) -> Column:
    """Sunday on or before the date."""
    day = as_date(value)
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_end(value) -> Column:
    return F.date_add(week_start(value), 6)


def iso_week_start(value) -> Column:
    return F.to_date(F.date_trunc("week", column(value)))


def iso_week_end(value) -> Column:
    return F.date_add(iso_week_start(value), 6)


def week_of_year(value) -> Column:
    """Weeks counted from 1 January."""
    return F.ceil(F.dayofyear(column(value)) / 7).cast("int")


def period_start(value, unit: str) -> Column:
    return F.to_date(F.date_trunc(_unit(unit), column(value)))


def period_end(value, unit: str) -> Column:
    """Last day of the month, quarter or year."""
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.date_sub(F.add_months(period_start(value, unit), months), 1)


def days_away(value, n: int) -> Column:
    return F.date_add(column(value), n)


def weeks_away(as_of, n: int) -> Column:
    """Monday of the week ``n`` weeks from ``as_of``."""
    return iso_week_start(F.date_add(column(as_of), 7 * n))


def months_away(as_of, n: int) -> Column:
    """First day of the month ``n`` months from ``as_of``."""
    return period_start(F.add_months(column(as_of), n), "month")


def convert_timezone(value, target: str, source: str = "UTC") -> Column:
    return F.from_utc_timestamp(F.to_utc_timestamp(column(value), source), target)


def now_in(zone: str, as_of=None) -> Column:
    """Wall clock of a zone; pass ``as_of`` for a repeatable result."""
    return convert_timezone(F.current_timestamp() if as_of is None else as_of, zone)


def today_in(zone: str, as_of=None) -> Column:
    return F.to_date(now_in(zone, as_of))


def round_to_day(value) -> Column:
    return F.date_trunc("day", shift(value, "hour", 12))


def from_epoch(value, unit: str = "seconds") -> Column:
    if unit == "nanoseconds":
        return F.timestamp_micros(F.floor(column(value).cast("decimal(20,0)") / 1000).cast("long"))
    if unit not in _EPOCH_UNITS:
        raise ValueError(f"unknown epoch unit {unit!r}")
    return _EPOCH_UNITS[unit](column(value))


def to_epoch(value) -> Column:
    return F.unix_timestamp(column(value))
