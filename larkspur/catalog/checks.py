"""Table checks, with arguments that leave failing rows to compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query
from larkspur.functions.numbers import exact_sum
from larkspur.quality import checks

LABELLED = "(SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def labelled(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


def event_ranges(t):
    """Time between the first and the last event of each user on a day."""
    spans = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return spans.drop("day")


RANGES = "(SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY user_id, CAST(ts AS DATE))"


@query(f"SELECT * FROM {LABELLED} WHERE quality IS NULL")
def dq_not_null(t):
    return checks.not_null(labelled(t), "quality")


@query("SELECT url, count(*) AS n_records FROM (SELECT split_part(url, '/', 3) AS url FROM pages) GROUP BY 1 HAVING count(*) > 1")
def dq_unique(t):
    return checks.unique(t.pages.select(F.split_part("url", F.lit("/"), F.lit(3)).alias("url")), "url")


@query("SELECT event_type, count(*) AS n_records FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1")
def dq_accepted_values(t):
    return checks.accepted_values(t.events, "event_type", ["view", "click"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice >= 2000 AND o_totalprice <= 499000)")
def dq_accepted_range(t):
    return checks.accepted_range(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 2000, 499000)


@query(f"SELECT lang, CAST(0 AS BIGINT) AS part, count(quality) AS n_values FROM {LABELLED} GROUP BY 1, 2 HAVING count(quality) = 0 UNION ALL SELECT CAST(doc_id AS VARCHAR), 1, 0 FROM {LABELLED} WHERE quality IS NULL")
def dq_at_least_one(t):
    rows = labelled(t)
    by_lang = checks.at_least_one(rows, "quality", ["lang"]).select("lang", F.lit(0).cast("long").alias("part"), "n_values")
    by_doc = checks.at_least_one(rows, "quality", ["doc_id"]).select(
        F.col("doc_id").cast("string").alias("lang"), F.lit(1).cast("long").alias("part"), "n_values"
    )
    return by_lang.unionByName(by_doc)


@query("""
WITH a AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS value, count(*) AS num_rows FROM supplier GROUP BY 1)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def dq_cardinality_equality(t):
    return checks.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


COUNTS = """
WITH a AS (SELECT o_custkey AS custkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT user_id AS custkey, count(*) AS n FROM events GROUP BY 1),
c AS (SELECT coalesce(a.custkey, b.custkey) AS custkey, coalesce(a.n, 0) AS count_a, coalesce(b.n, 0) AS count_b FROM a FULL JOIN b ON a.custkey = b.custkey)
"""


def order_and_event_keys(t):
    return t.orders.select(F.col("o_custkey").alias("custkey")), t.events.select(F.col("user_id").alias("custkey"))


@query(COUNTS + "SELECT *, abs(count_a - count_b) AS diff_count FROM c WHERE count_a <> count_b")
def dq_equal_rowcount(t):
    return checks.equal_rowcount(*order_and_event_keys(t), ["custkey"])


@query("""
WITH a AS (SELECT s_suppkey, round(CAST(s_acctbal AS DECIMAL(38,9)), 0) AS bal FROM supplier), b AS (SELECT s_suppkey, round(CAST(CASE WHEN s_acctbal > 5000 THEN s_acctbal + 1 ELSE s_acctbal END AS DECIMAL(38,9)), 0) AS bal FROM supplier)
SELECT which_diff, s_suppkey, CAST(bal AS DOUBLE) AS bal FROM (SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
""")
def dq_equality(t):
    a = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("bal"))
    b = a.withColumn("bal", F.when(F.col("bal") > 5000, F.col("bal") + 1).otherwise(F.col("bal")))
    return checks.equality(a, b, precision=0).withColumn("bal", F.col("bal").cast("double"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem WHERE NOT (l_discount + l_tax < 0.175)")
def dq_expression_is_true(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return checks.expression_is_true(rows, "l_discount + l_tax < 0.175D")


@query(COUNTS + "SELECT *, greatest(count_a - count_b, 1) AS row_count_delta FROM c WHERE count_a >= count_b")
def dq_fewer_rows_than(t):
    return checks.fewer_rows_than(*order_and_event_keys(t), ["custkey"])


@query(f"""
WITH w AS (SELECT *, lead(lo) OVER (PARTITION BY user_id ORDER BY lo, hi) AS next_lo FROM {RANGES})
SELECT * FROM w WHERE NOT (lo < hi AND coalesce(hi <= next_lo, true))
""")
def dq_exclusive_ranges(t):
    return checks.exclusive_ranges(event_ranges(t), "lo", "hi", ["user_id"])


@query("SELECT event_type, count(*) AS n_records FROM events WHERE event_type IN ('error', 'none') GROUP BY 1")
def dq_not_accepted_values(t):
    return checks.not_accepted_values(t.events, "event_type", ["error", "none"])


@query("SELECT l_orderkey, min(l_returnflag) AS value FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def dq_not_constant(t):
    return checks.not_constant(t.lineitem, "l_returnflag", ["l_orderkey"])


@query(r"SELECT page_id, ext FROM (SELECT page_id, regexp_extract(url, '\.(html)$', 1) AS ext FROM pages) WHERE trim(ext) = ''")
def dq_not_empty_string(t):
    return checks.not_empty_string(t.pages.select("page_id", F.regexp_extract("url", r"\.(html)$", 1).alias("ext")), "ext")


@query("""
SELECT source, count(quality) / count(*) AS not_null_proportion FROM (SELECT source, quality FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1
HAVING NOT (count(quality) / count(*) >= 0.4 AND count(quality) / count(*) <= 0.5)
""")
def dq_not_null_proportion(t):
    rows = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")
    return checks.not_null_proportion(rows, "quality", 0.4, 0.5, ["source"])


@query("""
SELECT o_custkey, max(o_orderdate) AS most_recent, TIMESTAMP '2001-07-02' AS threshold FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '2001-07-02'
""")
def dq_recency(t):
    return checks.recency(t.orders, "o_orderdate", "day", 30, F.lit("2001-08-01").cast("timestamp"), ["o_custkey"])


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 300000 AND o_custkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
""")
def dq_relationships_where(t):
    rows = t.orders.filter(F.col("o_totalprice") > 300000).select("o_orderkey", "o_custkey")
    return checks.relationships_where(rows, "o_custkey", t.customer, "c_custkey", to_condition="c_acctbal > 0")


@query("""
SELECT * FROM (SELECT event_type, event_id, lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS previous FROM events) WHERE NOT (event_id = previous + 1)
""")
def dq_sequential_values(t):
    return checks.sequential_values(t.events, "event_id", 1, keys=["event_type"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combination(t):
    return checks.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def dq_no_negative(t):
    return checks.no_negative(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal")


@query("""
WITH f AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1)
SELECT * FROM f WHERE views < 0 OR purchases < 0 OR purchases > views
""")
def dq_funnel_sanity(t):
    funnel = t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    return checks.funnel_sanity(funnel, ["views", "purchases"], "purchases", "views")


@query("""
SELECT *, abs(total_a - total_b) AS difference FROM (SELECT
(SELECT CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) FROM orders) AS total_a,
(SELECT CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) FROM lineitem) AS total_b) WHERE abs(total_a - total_b) > 1.0
""")
def dq_reconcile_totals(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(exact_sum("o_totalprice").alias("revenue"))
    return checks.reconcile_totals(daily, "revenue", t.lineitem, "l_extendedprice")
