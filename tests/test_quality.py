"""Checks on small tables: what passes, what fails, and how nulls count."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.quality import checks, suite
from larkspur.quality import expectations as ex


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_nulls_pass_ranges_and_fail_sets(spark):
    df = frame(spark, [(1,), (9,), (None,)], "x int")
    assert values(checks.accepted_range(df, "x", 0, 5)) == [(9,)]
    assert values(checks.expression_is_true(df, "x < 5")) == [(9,)]
    assert values(ex.values_in_set(df, "x", [1])) == [(9,), (None,)]
    assert values(ex.values_not_in_set(df, "x", [9])) == [(9,)]
    assert checks.unique(frame(spark, [(None,), (None,), (1,)], "x int"), "x").count() == 0


def test_ranges(spark):
    touching = frame(spark, [(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert checks.exclusive_ranges(touching, "lo", "hi", gaps="not_allowed").count() == 0
    assert checks.exclusive_ranges(touching, "lo", "hi", gaps="required").count() == 2
    gaps = frame(
        spark, [(1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"), (2, "2019-05-06", "2019-07-02")],
        "id int, lo string, hi string",
    )
    assert checks.exclusive_ranges(gaps, "lo", "hi", ["id"], gaps="required").count() == 0
    zero = frame(
        spark, [(3, "2020-05-06", "2020-05-07"), (3, "2020-05-08", "2020-05-10"), (3, "2020-05-08", "2020-05-08")],
        "id int, lo string, hi string",
    )
    assert checks.exclusive_ranges(zero, "lo", "hi", ["id"], zero_length=True).count() == 0
    assert checks.exclusive_ranges(zero, "lo", "hi", ["id"]).count() == 1
    assert checks.exclusive_ranges(frame(spark, [(0, None), (2, 3)], "lo int, hi int"), "lo", "hi").count() == 1
    with pytest.raises(ValueError):
        checks.exclusive_ranges(touching, "lo", "hi", gaps="some")


def test_sequences(spark):
    even = frame(spark, [(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "a int, n int")
    assert checks.sequential_values(even, "n", 2).count() == 0
    assert checks.sequential_values(even, "n", 1, keys=["a"]).count() == 3
    hours = frame(spark, [(dt.datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "at timestamp")
    assert values(checks.sequential_values(hours, "at", 1, "hour")) == [(dt.datetime(2021, 1, 1, 4), dt.datetime(2021, 1, 1, 2))]
    assert ex.values_monotonic(even, "n").count() == 0
    assert ex.values_monotonic(even, "n", step=2).count() == 0
    assert ex.values_monotonic(even, "n", up=False).count() == 4
    flat = frame(spark, [(1, 5), (2, 5)], "i int, n int")
    assert ex.values_monotonic(flat, "n", sort_by="i").count() == 1
    assert ex.values_monotonic(flat, "n", sort_by="i", strictly=False).count() == 0


def test_equality(spark):
    a = frame(spark, [(1, 1, 3), (1, 2, 1), (2, 3, 3)], "a int, b int, c int")
    b = frame(spark, [(1, 1, 2), (1, 2, 2), (2, 3, 2)], "a int, b int, c int")
    assert checks.equality(a, b, names=["a", "b"]).count() == 0
    assert checks.equality(a, b, exclude=["C"]).count() == 0
    failing = checks.equality(a, b)
    assert failing.count() == 6
    assert checks.imbalance(failing).first()[0] == 6
    assert checks.imbalance(checks.equality(a, b.limit(1))).first()[0] == 6
    twice = a.unionByName(a)
    assert checks.equality(a, twice).count() == 0  # duplicates do not count
    near = frame(spark, [(1, 1.234)], "i int, x double"), frame(spark, [(1, 1.2341)], "i int, x double")
    assert checks.equality(*near).count() == 2 and checks.equality(*near, precision=3).count() == 0
    with pytest.raises(ValueError):
        checks.equality(a, b.drop("c"))


def test_counts(spark):
    one, two = frame(spark, [(1,), (1,), (2,)], "k int"), frame(spark, [(1,), (3,)], "k int")
    assert values(checks.equal_rowcount(one, two, ["k"])) == [(1, 2, 1, 1), (2, 1, 0, 1), (3, 0, 1, 1)]
    assert values(checks.equal_rowcount(one, two)) == [(3, 2, 1)]
    assert values(checks.fewer_rows_than(two, one)) == []
    assert values(checks.fewer_rows_than(one, two)) == [(3, 2, 1)]
    assert values(checks.fewer_rows_than(one, one)) == [(3, 3, 1)]
    assert checks.cardinality_equality(one, "k", two, "k").count() == 4
    half = frame(spark, [(1,), (None,), (3,), (None,)], "x int")
    assert checks.not_null_proportion(half, "x", 0.5).count() == 0
    assert checks.not_null_proportion(half, "x", 0.6).count() == 1
    assert checks.at_least_one(half, "x").count() == 0
    assert checks.not_constant(frame(spark, [(1, 1), (1, 1), (2, 1), (2, 2)], "k int, x int"), "x", ["k"]).count() == 1


def test_aggregate_expectations(spark):
    df = frame(spark, [(1, 1.0), (1, 2.0), (2, 3.0), (2, None)], "k int, x double")
    assert ex.max_between(df, "x", 0, 3).count() == 0
    assert values(ex.sum_between(df, "x", None, 2, ["k"])) == [(1, 3.0), (2, 3.0)]
    assert ex.unique_proportion_between(df, "x", 1).count() == 0
    assert ex.median_between(df, "x", 2, 2).count() == 0
    assert ex.quantile_between(df, "x", 0.25, 1.5, 1.5).count() == 0
    assert ex.mean_between(df, "x", 2, strictly=True).count() == 1
    assert ex.distinct_count(df, "x", equal=3).count() == 0
    assert ex.most_common_in_set(df, "k", [1]).count() == 0
    assert ex.most_common_in_set(df, "k", [1], top_n=2).count() == 1
    assert ex.most_common_in_set(df, "k", [1], top_n=9).count() == 0
    with pytest.raises(ValueError):
        ex.max_between(df, "x")


def test_equal_expression(spark):
    a = frame(spark, [(1, 10.0), (2, 20.0)], "k int, x double")
    b = frame(spark, [(1, 10.5), (3, 1.0)], "k int, x double")
    assert ex.equal_expression(a, F.sum("x"), b, keys=["k"], tolerance=0.6).count() == 2
    assert ex.equal_expression(a, F.sum("x"), b, tolerance_percent=0.7).count() == 0
    assert ex.row_count_equals_other(a, b).count() == 0
    assert ex.row_count_equals_other(a, b, factor=2).count() == 1


def test_text_and_sets(spark):
    df = frame(spark, [("ab",), ("AB",), ("c1",), (None,)], "s string")
    assert values(ex.match_regex(df, "s", "^[a-z]+$")) == [("AB",), ("c1",)]
    assert values(ex.match_regex(df, "s", "^[a-z]+$", flags="i")) == [("c1",)]
    assert values(ex.match_regex(df, "s", "[0-9]", negate=True)) == [("c1",)]
    assert values(ex.match_like_list(df, "s", ["a%", "A%"])) == [("c1",)]
    assert values(ex.match_like_list(df, "s", ["a%", "A%"], match_on="all", negate=True)) == [("AB",), ("ab",)]
    assert ex.match_like_list(df, "s", ["a%", "A%"], match_on="any", negate=True).count() == 0
    assert ex.consistent_casing(df, "s").count() == 1
    assert values(ex.consistent_casing(df, "s", display=True)) == [("ab", 2, 2)]
    assert values(ex.distinct_equal_set(df.dropna(), "s", ["ab", "AB", "zz"])) == [("c1", True), ("zz", False)]
    assert ex.distinct_contain_set(df, "s", ["ab"]).count() == 0
    assert values(ex.length_between(df, "s", 3)) == [("AB",), ("ab",), ("c1",)]


def test_multicolumn(spark):
    df = frame(spark, [(1, 1), (1, 2), (None, None), (None, 1), (None, 1)], "a int, b int")
    assert values(ex.unique_in_record(df, ["a", "b"])) == [(1, 1), (None, 1), (None, 1)]
    assert values(ex.unique_in_record(df, ["a", "b"], "any_value_is_missing")) == [(1, 1)]
    assert values(ex.compound_unique(df, ["a", "b"])) == [(None, 1, 2)]
    assert ex.compound_unique(df, ["a", "b"], "any_value_is_missing").count() == 0
    assert ex.multicolumn_sum(df, ["a", "b"], 7).count() == 0
    assert ex.multicolumn_sum(df, ["a", "b"], "b").count() == 1
    assert ex.pair_greater(df, "b", "a").count() == 1 and ex.pair_greater(df, "b", "a", or_equal=True).count() == 0
    assert ex.pair_in_set(df.dropna(), "a", "b", [(1, 1)]).count() == 1
    with pytest.raises(ValueError):
        ex.compound_unique(df, ["a"], "never")


def test_time(spark):
    days = [dt.date(2020, 1, n) for n in (1, 2, 4, 5, 9)]
    df = frame(spark, [(x, 10.0) for x in days], "day date, v double")
    missing = ex.data_every(df, "day")
    assert sorted(r[0].day for r in missing.collect()) == [3, 6, 7, 8]
    assert sorted(r[0].day for r in ex.data_every(df, "day", interval=2).collect()) == [7]
    as_of = F.lit(dt.date(2020, 1, 11))
    assert ex.recent_data(df, "day", "day", 2, as_of).count() == 0
    assert ex.recent_data(df, "day", "day", 1, as_of).count() == 1
    assert ex.recent_data(df.filter("v < 0"), "day", "day", 1, as_of).count() == 1
    assert checks.recency(df, "day", "day", 1, as_of, by_day=True).count() == 1
    steady = frame(spark, [(dt.date(2020, 1, 1) + dt.timedelta(i), 10.0 + (i % 2) + (500 if i == 28 else 0)) for i in range(31)], "day date, v double")
    odd = ex.moving_stdevs(steady, "v", "day", F.lit(dt.date(2020, 2, 1)), diffs=False, logs=False)
    assert [r.metric_period.day for r in odd.collect()] == [29]


def test_shape(spark):
    df = frame(spark, [(1, "x")], "Id int, name string")
    assert ex.column_exists(df, "id", 0).count() == 0 and ex.column_exists(df, "nope").count() == 1
    assert ex.column_count(df, equal=2).count() == 0 and ex.column_count(df, low=3).count() == 1
    assert ex.columns_contain(df, ["ID"]).count() == 0 and ex.columns_contain(df, ["id"], negate=True).count() == 1
    assert ex.columns_match(df, ["name", "id"]).count() == 0
    assert ex.columns_match(df, ["name", "id"], ordered_list=True).count() == 2
    assert ex.type_in_list(df, "id", ["int"]).count() == 0 and ex.type_in_list(df, "id", ["string"]).count() == 1


def test_suite_file(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text('{"expectation_suite_name": "ids",\n "expectations": [{"type": "%s", "kwargs": {"column": "id"}}]}' % suite.NOT_NULL)
    loaded = suite.load_suite(spark, str(path))
    log = str(tmp_path / "log")
    suite.log_results([suite.validate(spark.range(3), loaded, "t")], log, "r1", "2024-01-01")
    row = spark.read.parquet(log).first()
    assert (row.suite_name, row.success, row.success_percent, row.failure_details, row.run_id) == ("ids", True, 100.0, None, "r1")


def test_suite_and_gate(spark):
    df = frame(spark, [(1, 5, "a1"), (1, None, "b"), (None, 50, None)], "id int, n int, code string")
    checks_list = [
        {"type": suite.NOT_NULL, "kwargs": {"column": "id"}},
        {"type": suite.UNIQUE, "kwargs": {"column": "id"}},
        {"type": suite.BETWEEN, "kwargs": {"column": "n", "min_value": 1, "max_value": 10}},
        {"type": suite.IN_SET, "kwargs": {"column": "n", "value_set": [5, 50]}},
        {"type": suite.MATCHES, "kwargs": {"column": "code", "regex": "[a-z][0-9]"}},
        {"type": suite.NOT_NULL, "kwargs": {"column": "gone"}},
        {"type": "expect_new", "kwargs": {}},
    ]
    named = {"expectation_suite_name": "s", "expectations": checks_list}
    found = {r["position"]: (r["failed_rows"], r["passed"]) for r in suite.run_suite(df, named).collect()}
    assert found == {0: (1, False), 1: (1, False), 2: (1, False), 3: (0, True), 4: (1, False), 5: (None, False), 6: (None, True)}
    one = suite.validate(df, named, "t").withColumn("run_id", F.lit("r"))
    row = one.first()
    assert (row.success, row.evaluated_expectations, row.successful_expectations, row.success_percent) == (False, 7, 2, 28.6)
    assert "Column not found: gone" in row.failure_details
    with pytest.raises(suite.QualityGateError):
        suite.gate(one, "r")
    suite.gate(one, "another run")
