"""Stacking, differences, series and spines."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import dates


def tables_like(spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None) -> list[str]:
    """Names of catalog tables that match a shell pattern."""
    names = [t.name for t in spark.catalog.listTables(database)]
    return sorted(
        n for n in names
        if fnmatch.fnmatch(n.lower(), pattern.lower()) and not (exclude and fnmatch.fnmatch(n.lower(), exclude.lower()))
    )


def frames_like(spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None) -> dict[str, DataFrame]:
    """The matching tables by name, ready for ``union_relations``."""
    prefix = f"{database}." if database else ""
    return {name: spark.table(f"{prefix}{name}") for name in tables_like(spark, pattern, exclude, database)}


def union_relations(
    frames: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include=(),
    exclude=(),
    source_column: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """Stack frames of different columns; a column missing from one of them is null there."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = {k.lower(): v for k, v in (column_override or {}).items()}
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}

    def prepared(name: str, df: DataFrame) -> DataFrame:
        kept = [
            c for c in df.columns
            if (not wanted or c.lower() in wanted) and c.lower() not in unwanted
        ]
        cols = [F.col(c).cast(override[c.lower()]).alias(c) if c.lower() in override else F.col(c) for c in kept]
        if source_column:
            cols.insert(0, F.lit(name).alias(source_column))
        return df.select(*cols)

    stacked = None
    for name, df in frames.items():
        part = prepared(name, df)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.filter(where) if where else stacked


def symmetric_difference(a: DataFrame, b: DataFrame, names=None) -> DataFrame:
    """Distinct rows on one side only, tagged with the side.

    Both sides are counted in one grouping, so each table is shuffled once
    instead of twice.
    """
    names = list(names or a.columns)
    sides = a.select(*names, F.lit(True).alias("_a")).union(b.select(*names, F.lit(False).alias("_a")))
    return (
        sides.groupBy(*names)
        .agg(F.bool_or("_a").alias("_in_a"), F.bool_or(~F.col("_a")).alias("_in_b"))
        .filter(F.col("_in_a") != F.col("_in_b"))
        .select(F.when(F.col("_in_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff"), *names)
    )


def newer_than(df: DataFrame, target: DataFrame, name: str, floor) -> DataFrame:
    """Rows newer than the newest row of the target; all rows after ``floor`` if it is empty."""
    newest = target.agg(F.coalesce(F.max(name), F.lit(floor).cast(target.schema[name].dataType))).scalar()
    return df.filter(F.col(name) > newest)


def series(spark: SparkSession, n: int, alias: str = "generated_number") -> DataFrame:
    """Integers 1 to n."""
    if n <= 0:
        raise ValueError("the upper bound has to be positive")
    return spark.range(1, n + 1).select(F.col("id").alias(alias))


def date_spine(spark: SparkSession, start: Column, end: Column, unit: str = "day") -> DataFrame:
    """All periods from ``start``; the one that holds ``end`` is left out.

    ``start`` and ``end`` are literals or scalar subqueries over a table; they are looked up once, and the periods are spread
    over tasks.
    """
    bounds = spark.range(1).select(start.cast("timestamp").alias("_start"), end.cast("timestamp").alias("_end"))
    first, periods = bounds.select(F.col("_start").cast("string"), dates.periods_since("_start", "_end", unit)).first()
    return spark.range(max(0, periods or 0)).select(dates.shift(F.lit(first).cast("timestamp"), unit, F.col("id").cast("int")).alias(f"date_{unit}"))


def base_dates(
    spark: SparkSession, start: Column | None = None, end: Column | None = None,
    last: int | None = None, as_of: Column | None = None, unit: str = "day",
) -> DataFrame:
    """A spine between two bounds, or over the last n periods up to and including ``as_of``."""
    if start is not None and end is not None:
        return date_spine(spark, start, end, unit)
    if last is None or as_of is None:
        raise ValueError("give start and end, or last and as_of")
    return date_spine(spark, dates.shift(as_of.cast("timestamp"), unit, -last), F.date_add(as_of, 1), unit)


def replicate(df: DataFrame, n: int = 1) -> DataFrame:
    """Every row n times."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy")
