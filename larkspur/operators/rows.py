"""Row-level operators: filters, cleaning, labels and column selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import column


def _date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def date_range(value, first, last) -> Column:
    """Days ``first`` to ``last`` inclusive, as a half-open range.

    The column itself stays bare, so partition pruning and Parquet statistics apply.
    """
    col = column(value)
    return (col >= F.lit(_date(first))) & (col < F.lit(_date(last) + dt.timedelta(days=1)))


def in_year(value, year: int) -> Column:
    """Same rows as ``year(column) = year`` in a form that can be pushed to the scan."""
    return date_range(value, dt.date(year, 1, 1), dt.date(year, 12, 31))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become null in every string column."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def star(df: DataFrame, drop=(), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but some (names compared without case), optionally renamed."""
    unwanted = {name.lower() for name in drop}
    kept = [c for c in df.columns if c.lower() not in unwanted]
    if not kept:
        raise ValueError("no columns left")
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in kept])


def map_values(value, mapping: dict, default=None) -> Column:
    """Value-to-value mapping as one conditional expression."""
    expression = None
    for key, result in mapping.items():
        test = column(value) == F.lit(key)
        expression = F.when(test, F.lit(result)) if expression is None else expression.when(test, F.lit(result))
    return expression.otherwise(F.lit(default))


def label_ranges(value, ranges, default=None) -> Column:
    """Label of the first inclusive range that holds the value; None leaves a side open."""
    expression = None
    for low, high, label in ranges:
        test = F.lit(True)
        if low is not None:
            test = column(value) >= F.lit(low)
        if high is not None:
            test = test & (column(value) <= F.lit(high))
        expression = F.when(test, F.lit(label)) if expression is None else expression.when(test, F.lit(label))
    return expression.otherwise(F.lit(default))


def flag(test: Column, yes="YES", no="NO") -> Column:
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def value_counts(df: DataFrame, name: str, where: str | None = None) -> DataFrame:
    source = df.filter(where) if where else df
    return source.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def column_values(df: DataFrame, name: str, where: str | None = None) -> DataFrame:
    """The distinct values of a column with their counts, as a frame of any size."""
    return value_counts(df, name, where)


def value_list(df: DataFrame, name: str, limit: int, by_count: bool = True, default=None, where: str | None = None) -> list:
    """Distinct values as a list of at most ``limit``, most frequent first, for building a later query.

    The list comes to the driver; asking for the values of a column with more of them is an error, not a silent cut.
    """
    counts = value_counts(df, name, where)
    order = [F.desc("n"), F.asc(name)] if by_count else [F.asc(name)]
    found = [r[0] for r in counts.orderBy(*order).limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{name} has more than {limit} values")
    return found or list(default or [])


def top_column_values(df: DataFrame, name: str, n: int, where: str | None = None) -> DataFrame:
    """The n most frequent values, as a frame."""
    return value_counts(df, name, where).orderBy(F.desc("n"), F.asc(name)).limit(n)


def single_value(df: DataFrame, default=None) -> Column:
    """The value of a one-row, one-column frame, as a scalar subquery."""
    scalar = df.scalar()
    return scalar if default is None else F.coalesce(scalar, F.lit(default))
