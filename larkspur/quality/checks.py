"""Table checks. Each returns the failing rows; an empty frame is a pass.

A test that is null for a row (because an input is null) does not fail the row,
unless the docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import dates
from larkspur.functions.text import column
from larkspur.operators import ordered
from larkspur.operators.aggregates import compare_counts
from larkspur.operators.sets import symmetric_difference


def condition(test) -> Column:
    return F.expr(test) if isinstance(test, str) else test


def only(df: DataFrame, where) -> DataFrame:
    return df if where is None else df.filter(condition(where))


def within(value, low=None, high=None, strictly: bool = False) -> Column:
    """Test that a value lies between two bounds, either of which may be open."""
    if low is None and high is None:
        raise ValueError("give a lower bound, an upper bound or both")
    col = column(value)
    tests = []
    if low is not None:
        tests.append(col > low if strictly else col >= low)
    if high is not None:
        tests.append(col < high if strictly else col <= high)
    return reduce(lambda a, b: a & b, tests)


def not_null(df: DataFrame, name: str, where=None) -> DataFrame:
    return only(df, where).filter(F.col(name).isNull())


def unique(df: DataFrame, name: str, where=None) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return duplicated(only(df, where).filter(F.col(name).isNotNull()), [name])


def duplicated(df: DataFrame, names) -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def unique_combination(df: DataFrame, names, where=None) -> DataFrame:
    return duplicated(only(df, where), names)


def accepted_values(df: DataFrame, name: str, values) -> DataFrame:
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(~F.col(name).isin(*values))


def not_accepted_values(df: DataFrame, name: str, values) -> DataFrame:
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col(name).isin(*values))


def accepted_range(df: DataFrame, name: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    return df.filter(~within(name, low, high, strictly=not inclusive))


def expression_is_true(df: DataFrame, test, where=None) -> DataFrame:
    return only(df, where).filter(~condition(test))


def at_least_one(df: DataFrame, name: str, keys=()) -> DataFrame:
    """Groups (or the table) without a single non-null value."""
    return df.groupBy(*keys).agg(F.count(name).alias("n_values")).filter(F.col("n_values") == 0)


def not_constant(df: DataFrame, name: str, keys=()) -> DataFrame:
    """Groups with exactly one distinct value; found from min and max, so nothing is kept per value."""
    return (
        df.groupBy(*keys).agg(F.min(name).alias("low"), F.max(name).alias("high"))
        .filter(F.col("low") == F.col("high"))
        .select(*keys, F.col("low").alias("value"))
    )


def not_empty_string(df: DataFrame, name: str, trim: bool = True) -> DataFrame:
    return df.filter((F.trim(name) if trim else F.col(name)) == "")


def not_null_proportion(df: DataFrame, name: str, at_least: float, at_most: float = 1.0, keys=()) -> DataFrame:
    share = F.count(name) / F.count(F.lit(1))
    return df.groupBy(*keys).agg(share.alias("not_null_proportion")).filter(
        ~within("not_null_proportion", at_least, at_most)
    )


def recency(df: DataFrame, name: str, unit: str, interval: int, as_of: Column, keys=(), by_day: bool = False) -> DataFrame:
    """Groups whose newest value is older than ``interval`` units before ``as_of``."""
    kind = "date" if by_day else "timestamp"
    limit = dates.shift(as_of.cast("timestamp"), unit, -interval).cast(kind)
    newest = df.groupBy(*keys).agg(F.max(name).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", limit).filter(F.col("most_recent") < F.col("threshold"))


def relationships_where(
    df: DataFrame, name: str, to: DataFrame, field: str, from_condition=None, to_condition=None
) -> DataFrame:
    """Keys without a match on the other side; null keys pass."""
    left = only(df, from_condition).filter(F.col(name).isNotNull())
    right = only(to, to_condition).select(F.col(field).alias("_to"))
    return left.join(right, F.col(name) == F.col("_to"), "left_anti")


def sequential_values(df: DataFrame, name: str, interval: int = 1, unit: str | None = None, keys=()) -> DataFrame:
    """Rows whose value is not the previous one plus the interval."""
    pairs = ordered.neighbour(df.select(*keys, name), keys, [name], name, 1, "previous")
    if unit:
        follows = F.col(name).cast("timestamp") == dates.shift(F.col("previous").cast("timestamp"), unit, interval)
    else:
        follows = F.col(name) == F.col("previous") + interval
    return pairs.filter(~follows)


_GAPS = {
    "allowed": lambda upper, following: upper <= following,
    "not_allowed": lambda upper, following: upper == following,
    "required": lambda upper, following: upper < following,
}


def exclusive_ranges(
    df: DataFrame, lower: str, upper: str, keys=(), gaps: str = "allowed", zero_length: bool = False
) -> DataFrame:
    """Ranges that overlap the next one of their key, are reversed, or break the rule on gaps.

    A null bound fails.
    """
    if gaps not in _GAPS:
        raise ValueError(f"gaps is one of {sorted(_GAPS)}")
    keys = list(keys)
    rows = df.select(*keys, lower, upper, F.struct(F.col(lower).alias("bound")).alias("_here"))
    paired = ordered.neighbour(rows, keys, [lower, upper], "_here", -1, "_next").drop("_here")
    bounds = F.col(lower) <= F.col(upper) if zero_length else F.col(lower) < F.col(upper)
    follows = F.coalesce(_GAPS[gaps](F.col(upper), F.col("_next.bound")), F.col("_next").isNull())
    return paired.filter(~(F.coalesce(bounds, F.lit(False)) & follows)).select(
        *keys, lower, upper, F.col("_next.bound").alias(f"next_{lower}")
    )


def equal_rowcount(a: DataFrame, b: DataFrame, keys=()) -> DataFrame:
    """Groups with different row counts. A group on one side only counts 0 on the other and fails."""
    return compare_counts(a, b, keys).filter(F.col("diff_count") > 0)


def fewer_rows_than(a: DataFrame, b: DataFrame, keys=()) -> DataFrame:
    """Groups where the first table does not have fewer rows, with by how many (1 when equal)."""
    counts = compare_counts(a, b, keys)
    excess = F.col("count_a") - F.col("count_b")
    return counts.withColumn("row_count_delta", F.greatest(excess, F.lit(1))).filter(excess >= 0).drop("diff_count")


def cardinality_equality(a: DataFrame, name: str, b: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs between two tables, one line per side."""
    left = a.groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    right = b.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return symmetric_difference(left, right)


def equality(a: DataFrame, b: DataFrame, names=None, exclude=(), precision: int | None = None) -> DataFrame:
    """Distinct rows on one side only; fractional columns can be rounded first."""
    if names and exclude:
        raise ValueError("give names or exclude, not both")
    skipped = {c.lower() for c in exclude}
    if names is None:
        names = [c for c in a.columns if c.lower() not in skipped]
        others = {c.lower() for c in b.columns} - skipped
        if {c.lower() for c in names} != others:
            raise ValueError("the tables have different columns; choose names or exclude some")
    fractional = (T.DoubleType, T.FloatType, T.DecimalType)

    def prepared(df):
        return df.select(*[
            F.round(F.col(n).cast("decimal(38,9)"), precision).alias(n)
            if precision is not None and isinstance(df.schema[n].dataType, fractional) else F.col(n)
            for n in names
        ])

    return symmetric_difference(prepared(a), prepared(b), names)


def imbalance(failures: DataFrame) -> DataFrame:
    """Failure count of an equality check: its rows plus the difference between the sides."""
    sign = F.when(F.col("which_diff") == "a_minus_b", 1).otherwise(-1)
    extra = F.coalesce(F.abs(F.sum(sign)), F.lit(0))
    return failures.agg((F.count(F.lit(1)) + extra).alias("failures"))


def no_negative(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name) < 0)


def funnel_sanity(df: DataFrame, steps, last: str, total: str) -> DataFrame:
    """Rows with a negative step count or more conversions than events."""
    broken = reduce(lambda a, b: a | b, [F.col(s) < 0 for s in steps])
    return df.filter(broken | (F.col(last) > F.col(total)))


def reconcile_totals(a: DataFrame, a_name: str, b: DataFrame, b_name: str, tolerance: float = 1.0) -> DataFrame:
    """One row when two totals differ by more than the tolerance."""
    total = lambda name: F.round(F.sum(F.col(name).cast("decimal(28,6)")), 2).cast("double")
    both = a.agg(total(a_name).alias("total_a")).withColumn("total_b", b.agg(total(b_name)).scalar())
    return both.withColumn("difference", F.abs(F.col("total_a") - F.col("total_b"))).filter(
        F.col("difference") > tolerance
    )


