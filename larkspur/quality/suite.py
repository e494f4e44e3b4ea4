"""Suites of checks read from a list of dicts, their log and the gate.

All row checks of a suite are conditional counts in a single pass over the
table; each uniqueness check adds one grouped count.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The check names suites are written with.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
MATCHES = "expect_column_values_to_match_regex"


class QualityGateError(RuntimeError):
    """Raised when a suite failed and the next stage must not run."""


def load_suite(spark: SparkSession, path: str) -> dict:
    """A suite from a JSON file on any file system Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _bad_rows(kind: str, name: str, args: dict) -> Column | None:
    """Condition of a failing row; nulls only fail the null check."""
    col = F.col(name)
    if kind == NOT_NULL:
        return col.isNull()
    if kind == BETWEEN:
        sides = []
        if args.get("min_value") is not None:
            sides.append(col < args["min_value"])
        if args.get("max_value") is not None:
            sides.append(col > args["max_value"])
        return reduce(lambda a, b: a | b, sides) if sides else F.lit(False)
    if kind == IN_SET:
        return ~col.isin(*args["value_set"])
    if kind == MATCHES:
        return ~col.cast("string").rlike(f"^(?:{args['regex']})")
    return None


def _repeats(df: DataFrame, name: str) -> Column:
    """Rows beyond the first of each value, nulls counted as one value."""
    sizes = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar()


def run_suite(df: DataFrame, suite: dict) -> DataFrame:
    """One row per check: position, type, column, failing rows, passed, detail."""
    present = set(df.columns)
    counts, plan = [], []
    for i, item in enumerate(suite["expectations"]):
        kind, args = item["type"], item.get("kwargs", {})
        name = args.get("column")
        known = kind in (NOT_NULL, UNIQUE, BETWEEN, IN_SET, MATCHES)
        note = None
        if not known:
            note = f"Unknown check: {kind}"
        elif name not in present:
            note = f"Column not found: {name}"
        elif kind != UNIQUE:
            bad = _bad_rows(kind, name, args)
            counts.append(F.count_if(bad).alias(f"_c{i}"))
        plan.append((i, kind, name, known, note))
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    for i, kind, name, _, note in plan:
        if kind == UNIQUE and note is None:
            one = one.withColumn(f"_c{i}", _repeats(df, name))

    def row(i, kind, name, known, note):
        failed = F.lit(None).cast("long") if note else F.col(f"_c{i}").cast("long")
        passed = F.lit(not known) if note else failed == 0
        detail = F.lit(note) if note else F.when(failed > 0, F.concat(failed.cast("string"), F.lit(f" rows of '{name}' fail")))
        return F.struct(
            F.lit(i).alias("position"), F.lit(kind).alias("type"), F.lit(name).alias("column"),
            failed.alias("failed_rows"), passed.alias("passed"), detail.cast("string").alias("detail"),
        )

    return one.select(F.inline(F.array(*[row(*p) for p in plan])))


def summarise(results: DataFrame, suite_name: str, table_name: str) -> DataFrame:
    """One row per suite with counts, percent and the failures as JSON."""
    failures = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct("position", "type", "column", "detail"))))
    good, total = F.count_if("passed"), F.count(F.lit(1))
    one = results.agg(
        F.bool_and("passed").alias("success"), total.alias("evaluated_expectations"),
        good.alias("successful_expectations"), (total - good).alias("unsuccessful_expectations"),
        F.round(good / total * 100, 1).alias("success_percent"), failures.alias("_failures"),
    )
    return one.select(
        F.lit(suite_name).alias("suite_name"), F.lit(table_name).alias("table_name"), "success",
        "evaluated_expectations", "successful_expectations", "unsuccessful_expectations", "success_percent",
        F.when(F.size("_failures") > 0, F.to_json("_failures")).alias("failure_details"),
    )


def validate(df: DataFrame, suite: dict, table_name: str) -> DataFrame:
    return summarise(run_suite(df, suite), suite["expectation_suite_name"], table_name)


def log_results(summaries, path: str, run_id: str, run_at) -> DataFrame:
    """Append one row per suite to the log; returns what was appended."""
    stacked = reduce(DataFrame.unionByName, summaries)
    stamped = stacked.withColumn("run_id", F.lit(run_id)).withColumn("run_timestamp", F.lit(run_at).cast("timestamp"))
    stamped.write.mode("append").parquet(path)
    return stamped


def gate(log: DataFrame, run_id: str) -> None:
    """Raise unless every suite of the run passed; call it before the next stage."""
    failed = [r["suite_name"] for r in log.filter((F.col("run_id") == run_id) & ~F.col("success")).collect()]
    if failed:
        raise QualityGateError(f"failed suites: {', '.join(sorted(failed))}")
