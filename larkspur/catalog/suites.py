"""Check suites, their log and the gate."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from larkspur.catalog.registry import query
from larkspur.quality import suite
from larkspur.session import shared_dir

ORDER_SUITE = {
    "expectation_suite_name": "orders",
    "expectations": [
        {"type": suite.NOT_NULL, "kwargs": {"column": "o_orderkey"}},
        {"type": suite.UNIQUE, "kwargs": {"column": "o_custkey"}},
        {"type": suite.BETWEEN, "kwargs": {"column": "o_totalprice", "min_value": 5000, "max_value": 450000.0}},
        {"type": suite.IN_SET, "kwargs": {"column": "o_orderstatus", "value_set": ["F", "O"]}},
        {"type": suite.MATCHES, "kwargs": {"column": "o_orderpriority", "regex": "[1-4]-"}},
        {"type": suite.NOT_NULL, "kwargs": {"column": "o_comment"}},
        {"type": "expect_something_new", "kwargs": {"column": "o_orderkey"}},
    ],
}

PART_SUITE = {
    "expectation_suite_name": "parts",
    "expectations": [
        {"type": suite.NOT_NULL, "kwargs": {"column": "p_partkey"}},
        {"type": suite.UNIQUE, "kwargs": {"column": "p_partkey"}},
        {"type": suite.BETWEEN, "kwargs": {"column": "p_size", "min_value": 1, "max_value": 50}},
    ],
}

RESULTS = f"""
SELECT *, failed_rows = 0 AS passed FROM (
SELECT 0 AS position, '{suite.NOT_NULL}' AS type, 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS failed_rows FROM orders
UNION ALL SELECT 1, '{suite.UNIQUE}', 'o_custkey', count(*) - count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 2, '{suite.BETWEEN}', 'o_totalprice', count(*) FILTER (o_totalprice < 5000 OR o_totalprice > 450000) FROM orders
UNION ALL SELECT 3, '{suite.IN_SET}', 'o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 4, '{suite.MATCHES}', 'o_orderpriority', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-4]-')) FROM orders)
UNION ALL SELECT 5, '{suite.NOT_NULL}', 'o_comment', NULL, false
UNION ALL SELECT 6, 'expect_something_new', 'o_orderkey', NULL, true
"""

SUMMARY = "success, evaluated_expectations, successful_expectations, unsuccessful_expectations"


@query(f"SELECT * FROM ({RESULTS})")
def gx_suite(t):
    return suite.run_suite(t.orders, ORDER_SUITE).drop("detail")


def logged(t, run_id):
    path = f"{shared_dir(t.spark)}/suite_log/{uuid.uuid4()}"
    checked = [suite.validate(t.orders, ORDER_SUITE, "orders"), suite.validate(t.part, PART_SUITE, "part")]
    suite.log_results(checked, path, run_id, "2024-01-31 00:00:00")
    return t.spark.read.parquet(path)


@query(f"""
SELECT 'orders' AS suite_name, bool_and(passed) AS success, count(*) AS evaluated_expectations, count(*) FILTER (passed) AS successful_expectations,
  count(*) FILTER (NOT passed) AS unsuccessful_expectations, round(count(*) FILTER (passed) / count(*) * 100, 1) AS success_percent FROM ({RESULTS})
UNION ALL SELECT 'parts', count(*) FILTER (p_size NOT BETWEEN 1 AND 50) = 0 AND count(*) = count(DISTINCT p_partkey), 3,
  2 + CASE WHEN count(*) FILTER (p_size NOT BETWEEN 1 AND 50) = 0 THEN 1 ELSE 0 END,
  CASE WHEN count(*) FILTER (p_size NOT BETWEEN 1 AND 50) = 0 THEN 0 ELSE 1 END,
  CASE WHEN count(*) FILTER (p_size NOT BETWEEN 1 AND 50) = 0 THEN 100.0 ELSE 66.7 END FROM part
""")
def gx_results_log(t):
    return logged(t, "nightly").select("suite_name", *SUMMARY.split(", "), "success_percent")


@query("SELECT p_type, count(*) AS n FROM part GROUP BY 1")
def quality_gate(t):
    """The next stage runs because the suite it depends on passed; a failing suite raises."""
    log = suite.validate(t.part, PART_SUITE, "part").withColumn("run_id", F.lit("gate"))
    suite.gate(log, "gate")
    return t.part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
