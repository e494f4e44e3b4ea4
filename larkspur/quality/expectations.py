"""Expectations on values, aggregates, text and table shape.

As in ``checks``, each returns what fails and an empty frame is a pass.
Checks of the schema alone return one row per problem.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import dates, text
from larkspur.operators import ordered
from larkspur.operators.joins import full_on
from larkspur.operators.sets import date_spine
from larkspur.quality.checks import condition, duplicated, only, within
from larkspur.session import cut

# Names of result columns that readers of the checks go by, here and below: value_field, value_count, metric_period,
# agg_metric_value, prior_agg_metric_value, metric_test_value, metric_test_rolling_average, metric_test_rolling_stddev, metric_test_delta, metric_test_sigma.

# --- expressions ------------------------------------------------------------


def expression_true(df: DataFrame, test, keys=(), where=None, aggregate: bool = False) -> DataFrame:
    """Rows, groups or the whole table for which a test is false.

    With ``keys`` or ``aggregate`` the test is an aggregate expression.
    """
    source = only(df, where)
    if keys or aggregate:
        judged = source.groupBy(*keys).agg(condition(test).alias("expression"))
    else:
        judged = source.withColumn("expression", condition(test))
    return judged.filter(~F.col("expression"))


def expression_between(df, expression, low=None, high=None, keys=(), where=None, strictly=False, aggregate=False):
    """Rows, groups or the whole table whose expression is out of bounds, with its value."""
    source = only(df, where)
    value = condition(expression).alias("expression")
    judged = source.groupBy(*keys).agg(value) if keys or aggregate else source.withColumn("expression", condition(expression))
    return judged.filter(~within("expression", low, high, strictly))


def equal_expression(
    a: DataFrame, expression, b: DataFrame | None = None, other_expression=None, keys=(), other_keys=None,
    where=None, other_where=None, tolerance: float = 0.0, tolerance_percent: float | None = None,
) -> DataFrame:
    """Groups (or totals) whose aggregate differs from another table's."""
    b = a if b is None else b
    other_expression = expression if other_expression is None else other_expression
    other_keys = list(other_keys or keys)
    other_where = where if other_where is None else other_where
    names = [f"col_{i + 1}" for i in range(len(keys))]
    left = only(a, where).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        condition(expression).alias("expression")
    )
    right = only(b, other_where).groupBy(*[F.col(k).alias(n) for k, n in zip(other_keys, names)]).agg(
        condition(other_expression).alias("compare_expression")
    )
    both = full_on(left, right, names) if names else left.withColumn("compare_expression", right.scalar())
    gap = F.abs(F.coalesce("expression", F.lit(0)) - F.coalesce("compare_expression", F.lit(0)))
    judged = both.withColumn("expression_difference", gap).withColumn(
        "expression_difference_percent", F.try_divide(gap.cast("double"), F.col("expression").cast("double"))
    )
    if tolerance_percent:
        return judged.filter(F.col("expression_difference_percent") > tolerance_percent)
    return judged.filter(F.col("expression_difference") > tolerance)


# --- one aggregate per column -------------------------------------------------


def _measure(aggregate):
    def check(df, name, low=None, high=None, keys=(), where=None, strictly=False):
        return expression_between(df, aggregate(name), low, high, keys, where, strictly, aggregate=True)

    return check


max_between = _measure(F.max)
min_between = _measure(F.min)
mean_between = _measure(F.avg)
sum_between = _measure(F.sum)
stdev_between = _measure(F.stddev_samp)
unique_count_between = _measure(F.count_distinct)
unique_proportion_between = _measure(lambda name: F.try_divide(F.count_distinct(name), F.count(name)))


def quantile_between(df, name, quantile, low=None, high=None, keys=(), where=None, strictly=False):
    """Exact quantile in bounds, without collecting a group's values in one place."""
    measured = ordered.percentile(only(df, where), keys, name, quantile, "expression")
    return measured.filter(~within("expression", low, high, strictly))


def median_between(df, name, low=None, high=None, keys=(), where=None, strictly=False):
    return quantile_between(df, name, 0.5, low, high, keys, where, strictly)


def distinct_count(df, name, at_least=None, at_most=None, equal=None, keys=(), where=None) -> DataFrame:
    """Groups whose number of distinct values is not > at_least, < at_most, or = equal."""
    count = F.col("expression")
    tests = []
    if at_least is not None:
        tests.append(count > at_least)
    if at_most is not None:
        tests.append(count < at_most)
    if equal is not None:
        tests.append(count == equal)
    counted = only(df, where).groupBy(*keys).agg(F.count_distinct(name).alias("expression"))
    return counted.filter(~reduce(lambda a, b: a & b, tests))


def distinct_count_equals_other(df, name, other, other_name, where=None, other_where=None) -> DataFrame:
    return equal_expression(
        only(df, where), F.count_distinct(name), only(other, other_where), F.count_distinct(other_name)
    )


# --- sets of values -----------------------------------------------------------


def _value_set(df: DataFrame, name: str, values) -> DataFrame:
    """A literal list as a frame of the column's type; its size is that of the argument."""
    kind = df.schema[name].dataType.simpleString()
    return df.sparkSession.createDataFrame([(None if v is None else str(v),) for v in dict.fromkeys(values)], "_v string").select(
        F.col("_v").cast(kind).alias("value_field")
    )


def _found(df, name, where) -> DataFrame:
    return only(df, where).select(F.col(name).alias("value_field")).distinct()


def distinct_in_set(df, name, values, where=None) -> DataFrame:
    """Distinct values that are not in the set; null is not in it."""
    return _found(df, name, where).join(F.broadcast(_value_set(df, name, values)), "value_field", "left_anti")


def distinct_contain_set(df, name, values, where=None) -> DataFrame:
    """Members of the set that do not occur."""
    return _value_set(df, name, values).join(_found(df, name, where), "value_field", "left_anti")


def distinct_equal_set(df, name, values, where=None) -> DataFrame:
    """Values on one side only."""
    found = _found(df, name, where).withColumn("in_table", F.lit(True))
    wanted = _value_set(df, name, values).withColumn("in_set", F.lit(True))
    return found.join(wanted, "value_field", "full").filter(F.col("in_table").isNull() | F.col("in_set").isNull()).select(
        "value_field", F.col("in_table").isNotNull().alias("in_table")
    )


def values_in_set(df, name, values, where=None) -> DataFrame:
    """Rows whose value is not in the set; a null fails."""
    return only(df, where).filter(~F.coalesce(F.col(name).isin(*values), F.lit(False)))


def values_not_in_set(df, name, values, where=None) -> DataFrame:
    return only(df, where).filter(F.col(name).isin(*values))


def most_common_in_set(df, name, values, top_n: int = 1, where=None) -> DataFrame:
    """The value at rank ``top_n`` by frequency, if it is not in the set.

    Ties are broken by the value. Only this one rank is tested.
    """
    counts = only(df, where).groupBy(F.col(name).alias("value_field")).agg(F.count(F.lit(1)).alias("value_count"))
    first = counts.orderBy(F.desc("value_count"), "value_field").limit(top_n)
    place = F.row_number().over(Window.orderBy(F.desc("value_count"), "value_field"))
    return (
        first.withColumn("_place", place).filter(F.col("_place") == top_n)
        .filter(~F.col("value_field").isin(*values)).select("value_field", "value_count")
    )


# --- single columns -----------------------------------------------------------


def values_between(df, name, low=None, high=None, where=None, strictly=False) -> DataFrame:
    return only(df, where).filter(~within(name, low, high, strictly))


def values_null(df, name, null: bool = True, where=None) -> DataFrame:
    """Rows that break "all values are null" (or, with ``null=False``, "none is")."""
    return only(df, where).filter(F.col(name).isNotNull() if null else F.col(name).isNull())


def values_monotonic(
    df, name, up: bool = True, sort_by: str | None = None, strictly: bool = True, keys=(), where=None, step=None, tie=()
) -> DataFrame:
    """Rows that break a rising (or falling) order, with the value before them."""
    sort_by = sort_by or name
    rows = only(df, where).select(*dict.fromkeys([*keys, sort_by, name, *tie]))
    pairs = ordered.neighbour(rows, list(keys), [sort_by, *tie], name, 1, "value_before")
    here, before = F.col(name), F.col("value_before")
    holds = (here > before if strictly else here >= before) if up else (here < before if strictly else here <= before)
    if step is not None:
        holds = holds & (F.abs(here - before) == F.abs(F.lit(step)))
    return pairs.filter(before.isNotNull() & ~holds)


def type_in_list(df, name, kinds) -> DataFrame:
    """One row when the column's type is not one of the given names."""
    actual = next((f.dataType.simpleString() for f in df.schema if f.name.lower() == name.lower()), None)
    wanted = {k.lower() for k in kinds}
    return _problems(df, [] if actual in wanted else [(name, f"type is {actual}")])


def consistent_casing(df, name, display: bool = False) -> DataFrame:
    """A row when some values differ by case only, or with ``display`` those values."""
    values = df.groupBy(F.col(name).alias("value"), F.lower(name).alias("folded")).agg(F.count(F.lit(1)).alias("n_records"))
    spellings = values.groupBy("folded").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n_records").alias("n_records"))
    if display:
        return spellings.filter(F.col("spellings") > 1)
    return spellings.agg(
        F.sum("spellings").alias("set_size"), F.count(F.lit(1)).alias("set_size_lower")
    ).filter(F.col("set_size") != F.col("set_size_lower"))


# --- several columns ----------------------------------------------------------


def pair_greater(df, a, b, or_equal: bool = False, where=None) -> DataFrame:
    test = F.col(a) >= F.col(b) if or_equal else F.col(a) > F.col(b)
    return only(df, where).filter(~test)


def pair_equal(df, a, b, where=None) -> DataFrame:
    return only(df, where).filter(~(F.col(a) == F.col(b)))


def pair_in_set(df, a, b, pairs, where=None) -> DataFrame:
    """Rows whose pair is not one of the given pairs; pairs with a null fail."""
    allowed = reduce(lambda x, y: x | y, [(F.col(a) == F.lit(x)) & (F.col(b) == F.lit(y)) for x, y in pairs])
    return only(df, where).filter(~F.coalesce(allowed, F.lit(False)))


def _kept(names, ignore_row_if: str) -> Column:
    missing = [F.col(n).isNull() for n in names]
    if ignore_row_if == "all_values_are_missing":
        return ~reduce(lambda a, b: a & b, missing)
    if ignore_row_if == "any_value_is_missing":
        return ~reduce(lambda a, b: a | b, missing)
    raise ValueError("ignore_row_if is 'all_values_are_missing' or 'any_value_is_missing'")


def compound_unique(df, names, ignore_row_if: str = "all_values_are_missing", where=None) -> DataFrame:
    return duplicated(only(df, where).filter(_kept(names, ignore_row_if)), names)


def unique_in_record(df, names, ignore_row_if: str = "all_values_are_missing", where=None) -> DataFrame:
    """Rows with fewer distinct values than columns; a null is not a value."""
    different = F.size(F.array_distinct(F.array_compact(F.array(*[F.col(n).cast("string") for n in names]))))
    return only(df, where).filter(_kept(names, ignore_row_if)).filter(different < len(names))


def multicolumn_sum(df, names, total, keys=(), where=None) -> DataFrame:
    """Groups (or the table) where the column sums do not add up to a number or to the sum of ``total``."""
    total = F.sum(total) if isinstance(total, str) else F.lit(total)
    added = reduce(lambda a, b: a + b, [F.sum(n) for n in names])
    return expression_true(df, added == total, keys, where, aggregate=True)


# --- text ---------------------------------------------------------------------


def length_between(df, name, low=None, high=None, where=None, strictly=False) -> DataFrame:
    return only(df, where).filter(~within(F.length(name), low, high, strictly))


def _matching(df, tests, any_of: bool, negate: bool, where) -> DataFrame:
    joined = reduce((lambda a, b: a | b) if any_of else (lambda a, b: a & b), tests)
    return only(df, where).filter(joined if negate else ~joined)


def match_like(df, name, pattern, negate=False, where=None) -> DataFrame:
    return _matching(df, [F.col(name).like(pattern)], True, negate, where)


def match_like_list(df, name, patterns, match_on="any", negate=False, where=None) -> DataFrame:
    """Rows that match none (or not all) of the patterns; ``negate`` asks for rows that should not match."""
    tests = [F.col(name).like(p) for p in patterns]
    if negate:
        # each pattern must be absent: any/all applies to the absences
        return _matching(df, [~x for x in tests], match_on == "any", False, where)
    return _matching(df, tests, match_on == "any", False, where)


def match_regex(df, name, pattern, negate=False, flags="", where=None) -> DataFrame:
    return _matching(df, [text.regex_position(name, pattern, flags=flags) > 0], True, negate, where)


def match_regex_list(df, name, patterns, match_on="any", negate=False, flags="", where=None) -> DataFrame:
    tests = [text.regex_position(name, p, flags=flags) > 0 for p in patterns]
    if negate:
        tests = [~x for x in tests]
    return _matching(df, tests, match_on == "any", False, where)


# --- distribution over time ---------------------------------------------------


def _metric(name: str, logs: bool) -> Column:
    if logs:
        return F.coalesce(F.ln(F.nullif(F.col(name), F.lit(0))), F.lit(0.0))
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def moving_stdevs(
    df, name, at: str, as_of: Column, keys=(), period="day", lookback=1, trend=7, test=14,
    sigma: float = 3, sigma_upper=None, sigma_lower=None, diffs=True, logs=True,
) -> DataFrame:
    """Periods whose total strays from the moving mean of the periods before.

    Rows are summed per period first; the windows run over that series, which is stored.
    Periods without a deviation yet pass.
    """
    series = cut(df.groupBy(*keys, F.date_trunc(period, at).alias("metric_period")).agg(F.sum(name).alias("agg_metric_value")))
    measured = ordered.measure(series, keys)
    value = _metric("agg_metric_value", logs)
    if diffs:
        series = ordered.neighbour(series, keys, ["metric_period"], "agg_metric_value", lookback, "prior_agg_metric_value", measured=measured)
        value = value - _metric("prior_agg_metric_value", logs)
    moving = {"metric_test_rolling_average": F.avg("metric_test_value"), "metric_test_rolling_stddev": F.stddev_samp("metric_test_value")}
    judged = (
        ordered.rolling(series.withColumn("metric_test_value", value), keys, ["metric_period"], trend, moving, measured=measured)
        .withColumn("metric_test_delta", F.col("metric_test_value") - F.col("metric_test_rolling_average"))
        .withColumn("metric_test_sigma", F.try_divide("metric_test_delta", "metric_test_rolling_stddev"))
    )
    today = F.date_trunc(period, as_of.cast("timestamp"))
    recent = (F.col("metric_period") >= dates.shift(today, period, -test)) & (F.col("metric_period") < today)
    low, high = -sigma if sigma_lower is None else sigma_lower, sigma if sigma_upper is None else sigma_upper
    return judged.filter(recent & ~within("metric_test_sigma", low, high))


def within_stdevs(df, name, keys, sigma: float = 3) -> DataFrame:
    """Groups whose total is more than n deviations from the mean of all totals."""
    sums = df.groupBy(*keys).agg(F.sum(name).alias(name))
    judged = ordered.with_totals(sums, [], {f"{name}_average": F.avg(name), f"{name}_stddev": F.stddev_samp(name)})
    score = F.try_divide(F.col(name) - F.col(f"{name}_average"), F.col(f"{name}_stddev"))
    return judged.withColumn(f"{name}_sigma", score).filter(F.abs(F.col(f"{name}_sigma")) > sigma)


def data_every(
    df, at: str, unit="day", interval: int | None = None, where=None, exclude=None, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Periods between the first and the last date (left out) that hold no rows."""
    source = only(df, where)
    first = source.agg(F.to_date(F.min(at))).scalar() if start is None else start
    last = source.agg(F.to_date(F.max(at))).scalar() if end is None else end
    name = f"date_{unit}"
    spine = date_spine(df.sparkSession, first, last, unit).withColumn("_first", first.cast("timestamp"))
    found = source.select(F.date_trunc(unit, at).alias(name))
    if interval:
        steps = dates.periods_since("_first", name, unit)
        spine = spine.filter(steps % interval == 0)
        found = found.withColumn("_first", first.cast("timestamp")).withColumn(
            name, dates.shift(name, unit, -(dates.periods_since("_first", name, unit) % interval))
        )
    counts = found.groupBy(name).agg(F.count(F.lit(1)).alias("row_cnt"))
    empty = spine.drop("_first").join(counts, name, "left").filter(F.col("row_cnt").isNull())
    result = empty.select(name, F.lit(True).alias("is_missing"), F.lit(0).cast("long").alias("row_cnt"))
    return result if exclude is None else result.filter(condition(exclude))


def recent_data(df, at: str, unit: str, interval: int, as_of: Column, keys=(), where=None) -> DataFrame:
    """Groups (or the table) whose newest row, not counting future ones, is too old.

    A table without rows fails.
    """
    now = as_of.cast("timestamp")
    past = only(df, where).filter(F.col(at).cast("timestamp") <= now)
    newest = past.groupBy(*keys).agg(F.max(F.col(at).cast("timestamp")).alias("latest"))
    judged = F.coalesce("latest", F.lit("1970-01-01").cast("timestamp")) < dates.shift(now, unit, -interval)
    return newest.filter(judged)


# --- shape of a table ---------------------------------------------------------


def _problems(df: DataFrame, rows) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, "column_name string, problem string")


def column_exists(df, name, index: int | None = None) -> DataFrame:
    """One row when the column is missing or not at the given position (from 0)."""
    names = [c.lower() for c in df.columns]
    if name.lower() not in names:
        return _problems(df, [(name, "missing")])
    at = names.index(name.lower())
    return _problems(df, [] if index is None or at == index else [(name, f"at position {at}")])


def column_count(df, low=None, high=None, equal=None, other: DataFrame | None = None) -> DataFrame:
    n = len(df.columns)
    equal = len(other.columns) if other is not None else equal
    bad = (equal is not None and n != equal) or (low is not None and n < low) or (high is not None and n > high)
    return _problems(df, [("*", f"{n} columns")] if bad else [])


def columns_contain(df, names, negate: bool = False) -> DataFrame:
    present = {c.lower() for c in df.columns}
    bad = [n for n in names if (n.lower() in present) == negate]
    return _problems(df, [(n, "unwanted" if negate else "missing") for n in bad])


def columns_match(df, names, ordered_list: bool = False) -> DataFrame:
    """Columns equal to a set, or to a list in order."""
    actual, wanted = [c.lower() for c in df.columns], [n.lower() for n in names]
    if ordered_list:
        longest = max(len(actual), len(wanted))
        pairs = zip(actual + [None] * (longest - len(actual)), wanted + [None] * (longest - len(wanted)))
        return _problems(df, [(a or w, f"expected {w}") for a, w in pairs if a != w])
    missing = [(w, "missing") for w in wanted if w not in actual]
    return _problems(df, missing + [(a, "unwanted") for a in actual if a not in wanted])


def row_count_between(df, low=None, high=None, keys=(), where=None, strictly=False) -> DataFrame:
    return expression_between(df, F.count(F.lit(1)), low, high, keys, where, strictly, aggregate=True)


def row_count_equals_other(df, other, factor: float = 1, keys=(), where=None, other_where=None) -> DataFrame:
    rows = F.count(F.lit(1))
    return equal_expression(df, rows, other, rows * factor, keys, None, where, other_where)


def aggregation_equals_other(df, expression, other, keys=(), where=None, tolerance=0.0, tolerance_percent=None):
    return equal_expression(df, expression, other, keys=keys, where=where, tolerance=tolerance, tolerance_percent=tolerance_percent)
