"""Layout and reuse."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from larkspur.catalog.registry import query
from larkspur.functions.numbers import exact_sum
from larkspur.operators import layout
from larkspur.session import cut, shared_dir
from larkspur.sources import writers


def scratch(t, name):
    return f"{shared_dir(t.spark)}/{name}/{uuid.uuid4()}"


STATUS_TOTALS = "SELECT o_orderstatus, count(*) AS n, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS total FROM orders GROUP BY 1"


def status_totals(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))


@query(STATUS_TOTALS)
def repartition_even(t):
    return status_totals(layout.spread(t.orders.select("o_orderstatus", "o_totalprice"), 16))


@query(STATUS_TOTALS)
def coalesce_files(t):
    return status_totals(layout.fewer(t.orders.select("o_orderstatus", "o_totalprice"), 2))


@query("""
SELECT 'status' AS report, o_orderstatus AS key, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 2
UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 2
""")
def cache_reuse(t):
    """Three reports from one joined result, which is then freed."""
    joined = t.orders.join(t.customer.filter(F.col("c_acctbal") > 0), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderstatus", "o_orderpriority", "c_mktsegment"
    )
    with layout.reused(joined) as kept:
        parts = [
            kept.groupBy(F.lit(name).alias("report"), F.col(c).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            for name, c in (("status", "o_orderstatus"), ("priority", "o_orderpriority"), ("segment", "c_mktsegment"))
        ]
        return cut(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'")
def partition_prune(t):
    folder = scratch(t, "prune")
    writers.write_partitioned(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), folder, "o_orderstatus")
    return t.spark.read.parquet(folder).filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey")


@query("""
SELECT lang, count(*) AS n_rows, round(count(*) / (SELECT count(*) FROM documents) * 100, 1) AS share_pct,
  round(count(*) / (SELECT count(*) FROM documents) * 100, 1) > 30 AS is_skewed FROM documents GROUP BY 1
""")
def skew_report(t):
    return layout.skew_report(t.documents, "lang")
