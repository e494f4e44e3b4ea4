"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, rounded
from larkspur.functions.numbers import exact_avg, exact_sum
from larkspur.operators import aggregates, ordered

TOTAL = "CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE)"


@query(f"SELECT o_custkey, {TOTAL} AS total_spent FROM orders GROUP BY o_custkey")
def agg_group_sum(t):
    return t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total_spent"))


@query(f"SELECT o_custkey, count(o_orderkey) AS total_orders, {TOTAL} AS total_spent FROM orders GROUP BY o_custkey")
def agg_count_sum(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("total_orders"), exact_sum("o_totalprice").alias("total_spent")
    )


@query(f"SELECT o_custkey, {TOTAL} AS total_spent FROM orders GROUP BY o_custkey HAVING total_spent > 3000000")
def agg_having(t):
    return agg_group_sum(t).filter(F.col("total_spent") > 3000000)


@query(f"SELECT o_custkey, {TOTAL} AS total_spent FROM orders WHERE o_totalprice >= 200000 GROUP BY o_custkey HAVING total_spent > 2500000")
def agg_where_having(t):
    return (
        t.orders.filter(F.col("o_totalprice") >= 200000)
        .groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total_spent"))
        .filter(F.col("total_spent") > 2500000)
    )


@query(f"SELECT o_orderpriority, {TOTAL} AS total_spent FROM orders GROUP BY ROLLUP (o_orderpriority)")
def agg_rollup(t):
    return t.orders.rollup("o_orderpriority").agg(exact_sum("o_totalprice").alias("total_spent"))


@query(f"SELECT {TOTAL} / count(o_totalprice) AS avg_price FROM orders")
def agg_global(t):
    return t.orders.agg(exact_avg("o_totalprice").alias("avg_price"))


@query(f"""
SELECT o_orderpriority, {TOTAL} / count(o_totalprice) AS avg_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
FROM orders GROUP BY 1
""")
def agg_avg_min_max(t):
    return t.orders.groupBy("o_orderpriority").agg(
        exact_avg("o_totalprice").alias("avg_price"), F.min("o_totalprice").alias("min_price"),
        F.max("o_totalprice").alias("max_price"),
    )


@query("SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS visitors, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def agg_count_distinct(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_distinct("user_id").alias("visitors"), F.count_distinct("event_type").alias("kinds")
    )


@query("SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1")
def agg_count_if(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )


@query("SELECT o_custkey, CAST(CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(38,10)) ELSE 0 END) AS DECIMAL(18,2)) AS DOUBLE) AS open_total FROM orders GROUP BY 1")
def agg_sum_if(t):
    return t.orders.groupBy("o_custkey").agg(
        exact_sum(F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).otherwise(0.0)).alias("open_total")
    )


@query("SELECT CAST(ts AS DATE) AS day, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers FROM events GROUP BY 1")
def agg_distinct_if(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_distinct(F.when(F.col("event_type") == "purchase", F.col("user_id"))).alias("buyers")
    )


@query("""
SELECT user_id, event_type AS favourite FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1
""")
def agg_top_value(t):
    return aggregates.top_value(t.events, ["user_id"], "event_type", "favourite")


@query("SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, count(*) AS total_orders FROM orders GROUP BY 1")
def agg_group_by_expr(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("total_orders"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_group_by_ordinal(t):
    lines = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return lines.groupBy(*lines.columns[:2]).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT p_brand, {rounded('stddev_samp(p_retailprice)', 4)} AS price_sd FROM part GROUP BY 1")
def agg_stddev(t):
    return t.part.groupBy("p_brand").agg(F.round(F.stddev_samp("p_retailprice"), 4).alias("price_sd"))


@query(f"SELECT o_orderpriority, {rounded('quantile_cont(o_totalprice, 0.9)', 4)} AS p90 FROM orders GROUP BY 1")
def agg_percentile(t):
    result = ordered.percentile(t.orders, ["o_orderpriority"], "o_totalprice", 0.9, "p90")
    return result.withColumn("p90", F.round("p90", 4))


@query(f"SELECT p_type, {rounded('median(p_retailprice)', 4)} AS median_price FROM part GROUP BY 1")
def agg_median(t):
    result = ordered.percentile(t.part, ["p_type"], "p_retailprice", 0.5, "median_price")
    return result.withColumn("median_price", F.round("median_price", 4))


@query("SELECT user_id, event_id, value, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) = 1")
def agg_first_per_group(t):
    best = F.max_by(F.struct("event_id", "value", "event_type"), F.struct("value", "event_id"))
    return t.events.groupBy("user_id").agg(best.alias("best")).select("user_id", "best.*")


@query(r"SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents) GROUP BY 1")
def agg_array_row_counts(t):
    words = t.documents.select(F.explode(F.split("text", r"\s+")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT user_id, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS n_view,
  sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS n_purchase,
  sum(CASE WHEN event_type = 'refund' THEN 1 ELSE 0 END)::BIGINT AS n_refund FROM events GROUP BY 1
""")
def agg_pivot(t):
    return aggregates.pivot(t.events, ["user_id"], "event_type", ["view", "purchase", "refund"], prefix="n_")


@query("""
SELECT s_suppkey, 's_name' AS prop, s_name AS val FROM supplier
UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT s_suppkey, 'is_overdrawn', CASE WHEN s_acctbal < 0 THEN 'true' ELSE 'false' END FROM supplier
""")
def agg_unpivot(t):
    wide = t.supplier.withColumn("is_overdrawn", F.col("s_acctbal") < 0)
    return aggregates.unpivot(wide, keep=["S_SUPPKEY"], drop=["s_acctbal"], name="prop", value="val")


@query("""
WITH a AS (SELECT o_custkey AS custkey, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT user_id AS custkey, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(a.custkey, b.custkey) AS custkey, coalesce(a.n, 0) AS count_a, coalesce(b.n, 0) AS count_b,
  abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS diff_count FROM a FULL JOIN b ON a.custkey = b.custkey
""")
def agg_symmetric_counts(t):
    return aggregates.compare_counts(
        t.orders.select(F.col("o_custkey").alias("custkey")), t.events.select(F.col("user_id").alias("custkey")), ["custkey"]
    )
