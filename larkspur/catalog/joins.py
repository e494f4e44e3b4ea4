"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query
from larkspur.functions.numbers import exact_sum
from larkspur.operators import joins

def on_customer():
    return F.col("c_custkey") == F.col("o_custkey")


def documents(t):
    return t.documents.select("doc_id", "lang", "source")


def on_document():
    return F.col("doc_id") == F.col("label_id")


def labels(t):
    return t.labels.select(F.col("doc_id").alias("label_id"), "quality", "toxic")


def names(t):
    return t.customer.select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey")
def join_inner(t):
    return names(t).join(t.orders, on_customer()).select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def join_left(t):
    return documents(t).join(labels(t), on_document(), "left").drop("label_id")


@query("SELECT quality, toxic, d.doc_id, lang, source FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id")
def join_right(t):
    return labels(t).join(documents(t), on_document(), "right").drop("label_id")


@query("SELECT doc_id, lang, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_semi(t):
    return documents(t).join(labels(t), on_document(), "left_semi")


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_anti(t):
    return documents(t).join(labels(t), on_document(), "left_anti")


@query("""
WITH a AS (SELECT o_custkey AS custkey, count(*) AS n_orders FROM orders GROUP BY 1),
b AS (SELECT user_id AS custkey, count(*) AS n_events FROM events GROUP BY 1)
SELECT coalesce(a.custkey, b.custkey) AS custkey, n_orders, n_events FROM a FULL JOIN b ON a.custkey = b.custkey
""")
def join_full(t):
    def counts(df, key, alias):
        return df.groupBy(F.col(key).alias("custkey")).agg(F.count(F.lit(1)).alias(alias))

    return joins.full_on(counts(t.orders, "o_custkey", "n_orders"), counts(t.events, "user_id", "n_events"), ["custkey"])


@query("""
SELECT (SELECT CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) FROM orders) AS order_total,
  (SELECT CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) FROM lineitem) AS line_total
""")
def join_cross_scalar(t):
    orders = t.orders.agg(exact_sum("o_totalprice").alias("order_total"))
    lines = t.lineitem.agg(exact_sum("l_extendedprice"))
    return orders.withColumn("line_total", lines.scalar())


@query("""
WITH quarters AS (SELECT date_trunc('quarter', l_shipdate) AS q, CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day
  FROM lineitem GROUP BY 1)
SELECT first_day, last_day, count(*) AS n_orders FROM orders JOIN quarters
ON CAST(o_orderdate AS DATE) BETWEEN first_day AND last_day GROUP BY 1, 2
""")
def join_range(t):
    ranges = t.lineitem.groupBy(F.date_trunc("quarter", "l_shipdate")).agg(
        F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day")
    ).select("first_day", "last_day")
    points = t.orders.select(F.to_date("o_orderdate").alias("day"))
    matched = joins.range_join(points, ranges, "day", "first_day", "last_day")
    return matched.groupBy("first_day", "last_day").agg(F.count(F.lit(1)).alias("n_orders"))


@query("SELECT DISTINCT * FROM (SELECT doc_id, lang, source FROM documents) NATURAL JOIN labels")
def join_natural(t):
    return joins.natural(t.documents.select("doc_id", "lang", "source"), t.labels).distinct()


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def join_broadcast(t):
    """No hint: the planner broadcasts a side whose size in bytes it knows to be small."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t.customer.join(
        places, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select("c_custkey", "n_name", "r_name")


@query("""
SELECT o_orderstatus, l_returnflag, count(*) AS n, CAST(CAST(sum(CAST(l_quantity AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
""")
def join_shuffle(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus").hint("merge")
    joined = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderstatus", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("l_quantity").alias("quantity")
    )


@query("SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) ON c_custkey = user_id WHERE user_id IS NULL")
def join_null_anti(t):
    return t.customer.select("c_custkey").join(t.events, F.col("c_custkey") == F.col("user_id"), "left_anti")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal < 0)")
def join_in_subquery(t):
    overdrawn = t.customer.filter(F.col("c_acctbal") < 0).select("c_custkey")
    return t.orders.select("o_orderkey", "o_custkey").join(overdrawn, on_customer(), "left_semi")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)")
def join_not_in_subquery(t):
    poorer = t.customer.filter(F.col("c_acctbal") < 5000)
    return joins.not_in(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", poorer, "c_custkey")


def segment_versions(t):
    """Customers whose segment changed in mid-1998 have two versions."""
    moved = F.col("c_acctbal") > 5000
    change = F.lit("1998-06-01").cast("timestamp_ntz")
    first = t.customer.select(
        F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("segment"),
        F.lit("1990-01-01").cast("timestamp_ntz").alias("valid_from"), F.when(moved, change).alias("valid_to"),
    )
    second = t.customer.filter(moved).select(
        F.col("c_custkey").alias("customer"), F.lit("PREMIUM").alias("segment"),
        change.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    return first.unionByName(second)


@query("""
WITH v AS (SELECT c_custkey, c_mktsegment AS segment, TIMESTAMP '1990-01-01' AS valid_from,
  CASE WHEN c_acctbal > 5000 THEN TIMESTAMP '1998-06-01' END AS valid_to FROM customer
  UNION ALL SELECT c_custkey, 'PREMIUM', TIMESTAMP '1998-06-01', NULL FROM customer WHERE c_acctbal > 5000)
SELECT o_orderkey, segment FROM orders LEFT JOIN v ON o_custkey = c_custkey AND o_orderdate >= valid_from
AND (valid_to IS NULL OR o_orderdate < valid_to)
""")
def join_scd2_as_of(t):
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer"), "o_orderdate")
    return joins.as_of_version(facts, segment_versions(t), "customer", "o_orderdate").select("o_orderkey", "segment")


@query("""
SELECT coalesce(p_type, l_returnflag) AS category, s_nationkey AS nation, count(*) AS n,
  CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS revenue
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
""")
def join_star(t):
    parts = t.part.filter(F.col("p_size") > 10).select("p_partkey", "p_type")
    suppliers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"))
    lines = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    joined = joins.star_join(
        lines, [(parts, "l_partkey", "p_partkey"), (suppliers, "l_suppkey", "s_suppkey")],
        {"category": ["p_type", "l_returnflag"]},
    )
    return joined.groupBy("category", "nation").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("l_extendedprice").alias("revenue")
    )
