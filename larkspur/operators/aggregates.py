"""Aggregations with a reshaping or a comparison."""

from __future__ import annotations

import operator
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.joins import full_on

_COMPARE = {
    "=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
_AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}


def slug(text: str) -> str:
    """A column name from a value: lower case, words joined by underscores."""
    words = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", str(text).lower()))
    return f"_{words}" if words[:1].isdigit() else words


def pivot(
    df: DataFrame, keys, name: str, values, agg: str = "sum", compare: str = "=",
    prefix: str = "", suffix: str = "", then=1, otherwise=0, distinct: bool = False, slugs: bool = False,
) -> DataFrame:
    """One column per value, all computed in a single grouping.

    A value that does not occur gives ``otherwise`` for its rows, hence 0 for a
    sum, where the built-in pivot gives null. ``then`` may be a column.
    """
    test = _COMPARE[compare]

    def cell(value):
        picked = F.when(test(F.col(name), F.lit(value)), then if hasattr(then, "alias") else F.lit(then))
        if otherwise is not None:
            picked = picked.otherwise(F.lit(otherwise))
        if distinct:
            if agg == "sum":
                return F.sum_distinct(picked)
            if agg == "count":
                return F.count_distinct(picked)
        return _AGGREGATES[agg](picked)

    label = slug if slugs else str
    return df.groupBy(*keys).agg(*[cell(v).alias(f"{prefix}{label(v)}{suffix}") for v in values])


def unpivot(df: DataFrame, keep=(), drop=(), cast_to: str = "string", name="field_name", value="value") -> DataFrame:
    """Columns to rows. Booleans become text first; names are compared without case."""
    kept = {c.lower() for c in keep}
    skipped = kept | {c.lower() for c in drop}
    ids = [c for c in df.columns if c.lower() in kept]
    melted = [f for f in df.schema if f.name.lower() not in skipped]
    if not melted:
        raise ValueError("no columns to unpivot")
    casts = [
        (F.col(f.name).cast("string") if isinstance(f.dataType, T.BooleanType) else F.col(f.name))
        .cast(cast_to).alias(f.name)
        for f in melted
    ]
    return df.select(*ids, *casts).unpivot(ids, [f.name for f in melted], name, value)


def top_value(df: DataFrame, keys, value: str, alias: str, weight=None) -> DataFrame:
    """Most frequent value per key; ties go to the smallest value.

    ``weight`` is an aggregate that replaces the row count, for rows that are
    counts already.

    Counts are combined before the shuffle and each key keeps one candidate per
    task, so a hot key or a hot value stays cheap.
    """
    size = F.count(F.lit(1)) if weight is None else weight
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(size.alias("_n"))
    window = Window.partitionBy(*keys).orderBy(F.desc("_n"), F.asc(value))
    return (
        counts.withColumn("_i", F.row_number().over(window))
        .filter(F.col("_i") == 1)
        .select(*keys, F.col(value).alias(alias))
    )


def compare_counts(a: DataFrame, b: DataFrame, keys=()) -> DataFrame:
    """Row counts of two tables per key, with their difference; a key on one side counts 0 on the other."""
    keys = list(keys)
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_a"))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_b"))
    if keys:
        both = full_on(left, right, keys).fillna(0, ["count_a", "count_b"])
    else:
        both = left.withColumn("count_b", right.scalar())
    return both.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))
