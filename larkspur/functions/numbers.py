"""Arithmetic with explicit null, zero and rounding rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from larkspur.functions.text import column

# Fixed values of the distance formula.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def exact(value, scale: int = 10) -> Column:
    """Decimal form of an amount, so that sums do not depend on row order.

    Ten decimals and 28 digits before them: no amount is rounded to cents before it is summed.
    """
    return column(value).cast(f"decimal(38,{scale})")


def exact_sum(value, scale: int = 10) -> Column:
    return F.sum(exact(value, scale)).cast("double")


def exact_avg(value, scale: int = 10) -> Column:
    """Mean from the exact sum; null for an empty group."""
    return F.try_divide(exact_sum(value, scale), F.count(column(value)).cast("double"))


def safe_divide(numerator, denominator) -> Column:
    return F.try_divide(column(numerator).cast("double"), column(denominator).cast("double"))


def half_up(value, digits: int) -> Column:
    """Round half away from zero on ten decimals.

    A quotient that should be 0.675 may be stored as 0.6749999999999999; rounding
    the double itself would go down.
    """
    return F.round(column(value).cast("decimal(38,10)"), digits).cast("double")


def percent(numerator, denominator, digits: int = 2) -> Column:
    return half_up(safe_divide(numerator, denominator) * 100, digits)


def _or_zero(names) -> list:
    if not names:
        raise ValueError("at least one column is needed")
    return [F.coalesce(column(n), F.lit(0)) for n in names]


def safe_add(*names) -> Column:
    return reduce(lambda a, b: a + b, _or_zero(names))


def safe_subtract(*names) -> Column:
    return reduce(lambda a, b: a - b, _or_zero(names))


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance in miles (``mi``) or kilometres (``km``)."""
    if unit not in ("mi", "km"):
        raise ValueError("unit is 'mi' or 'km'")
    a, b = column(lat1), column(lat2)
    half_lat = F.sin((F.radians(b) - F.radians(a)) / 2)
    half_lon = F.sin((F.radians(column(lon2)) - F.radians(column(lon1))) / 2)
    chord = F.pow(half_lat, 2) + F.cos(F.radians(a)) * F.cos(F.radians(b)) * F.pow(half_lon, 2)
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles
