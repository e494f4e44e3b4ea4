"""Projections, filters, cleaning, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query
from larkspur.functions.numbers import exact
from larkspur.operators import ordered, rows, sets


def labelled_documents(t):
    """Documents with their labels; unlabelled documents have null labels."""
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")


LABELLED = "SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_columns(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def filter_compare(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").filter(F.col("o_totalprice") > 200000)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
""")
def filter_date_range(t):
    return t.orders.filter(rows.date_range("o_orderdate", "1996-01-01", "1996-12-31")).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE extract(year FROM o_orderdate) = 1997")
def filter_year_of_date(t):
    return t.orders.filter(rows.in_year("o_orderdate", 1997)).select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"SELECT * FROM ({LABELLED}) WHERE quality IS NOT NULL")
def filter_not_null(t):
    return labelled_documents(t).filter(F.col("quality").isNotNull())


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('purchase', 'signup')")
def filter_in_list(t):
    return t.events.select("event_id", "user_id", "event_type").filter(
        F.col("event_type").isin("purchase", "signup")
    )


@query(f"SELECT doc_id, lang, source, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM ({LABELLED})")
def fill_nulls(t):
    return labelled_documents(t).fillna({"quality": -1, "toxic": -1})


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def drop_duplicates(t):
    return t.orders.select("o_custkey", "o_orderstatus").dropDuplicates(["o_custkey", "o_orderstatus"])


@query("""
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def deduplicate(t):
    events = t.events.select("user_id", "event_id", "ts", "event_type")
    return ordered.first_per_group(events, ["user_id"], ["-ts", "-event_id"])


@query(f"""
SELECT count(*) FILTER (doc_id IS NULL) AS doc_id, count(*) FILTER (lang IS NULL) AS lang,
  count(*) FILTER (source IS NULL) AS source, count(*) FILTER (quality IS NULL) AS quality,
  count(*) FILTER (toxic IS NULL) AS toxic FROM ({LABELLED})
""")
def null_counts(t):
    return rows.null_counts(labelled_documents(t))


@query("""
SELECT CAST(split_part(c_name, '#', 2) AS BIGINT) AS customer_number,
  TRY_CAST(c_mktsegment AS INTEGER) AS segment_number, CAST(c_custkey AS VARCHAR) AS customer_text,
  CAST(c_acctbal AS DOUBLE) AS balance, CAST(CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END AS BOOLEAN) AS overdrawn
FROM customer
""")
def cast_columns(t):
    return t.customer.select(
        F.split_part("c_name", F.lit("#"), F.lit(2)).cast("long").alias("customer_number"),
        F.col("c_mktsegment").try_cast("int").alias("segment_number"),
        F.col("c_custkey").cast("string").alias("customer_text"),
        F.col("c_acctbal").cast("double").alias("balance"),
        F.when(F.col("c_acctbal") < 0, "true").otherwise("false").cast("boolean").alias("overdrawn"),
    )


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
  WHEN 'purchase' THEN 4 ELSE 0 END AS step FROM events
""")
def case_map(t):
    steps = {"view": 1, "click": 2, "signup": 3, "purchase": 4}
    return t.events.select("event_id", rows.map_values("event_type", steps, 0).alias("step"))


@query("""
SELECT p_partkey, CASE WHEN p_size <= 5 THEN 'tiny' WHEN p_size BETWEEN 6 AND 20 THEN 'small'
  WHEN p_size BETWEEN 21 AND 40 THEN 'medium' ELSE 'large' END AS size_class FROM part
""")
def case_bucket(t):
    classes = [(None, 5, "tiny"), (6, 20, "small"), (21, 40, "medium")]
    return t.part.select("p_partkey", rows.label_ranges("p_size", classes, "large").alias("size_class"))


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'YES' ELSE 'NO' END AS is_high_value,
  o_totalprice >= 400000 AS is_top FROM orders
""")
def flag_column(t):
    total = F.col("o_totalprice")
    return t.orders.select("o_orderkey", rows.flag(total > 250000).alias("is_high_value"), (total >= 400000).alias("is_top"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
  * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DOUBLE) AS net_amount FROM lineitem
""")
def derived_amount(t):
    net = F.round(exact("l_extendedprice") * (1 - exact("l_discount")), 2).cast("double")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", net.alias("net_amount"))


@query("""
SELECT c_custkey, coalesce(n, 0) AS n_events FROM customer LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ON c_custkey = user_id
""")
def coalesce_default(t):
    seen = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    joined = t.customer.join(seen, F.col("c_custkey") == F.col("user_id"), "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_events"))


@query("SELECT s_suppkey AS src_s_suppkey_v1, s_nationkey AS src_s_nationkey_v1, s_acctbal AS src_s_acctbal_v1 FROM supplier")
def star(t):
    return rows.star(t.supplier, drop=["S_NAME"], prefix="src_", suffix="_v1")


@query("SELECT * EXCLUDE (p_name) FROM part")
def select_except(t):
    return t.part.drop("p_name")


@query(r"""
SELECT page_id, nullif(regexp_extract(url, 'ref=(\w+)', 1), '') AS referrer,
  nullif(regexp_extract(url, '\.(html)$', 1), '') AS extension FROM pages
""")
def nullcheck_table(t):
    return rows.blank_to_null(
        t.pages.select(
            "page_id",
            F.regexp_extract("url", r"ref=(\w+)", 1).alias("referrer"),
            F.regexp_extract("url", r"\.(html)$", 1).alias("extension"),
        )
    )


@query("""
SELECT event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY event_type
""")
def column_values(t):
    return rows.column_values(t.events, "event_type", where="value > 10")


@query("""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE),
  (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS days_before_last FROM orders
""")
def single_value(t):
    newest = rows.single_value(t.orders.agg(F.to_date(F.max("o_orderdate"))))
    days = F.date_diff(F.col("newest"), F.to_date("o_orderdate")).cast("long")
    return t.orders.select("o_orderkey", "o_orderdate").withColumn("newest", newest).select(
        "o_orderkey", days.alias("days_before_last")
    )


# --- set operations and composition -----------------------------------------


@query("SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier")
def set_union_all(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return customers.unionByName(suppliers)


@query("""
SELECT 'customer' AS source_relation, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL AS suppkey FROM customer
UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL, CAST(s_suppkey AS VARCHAR) FROM supplier
""")
def set_union_relations(t):
    frames = {
        "customer": t.customer.selectExpr("c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment", "c_nationkey AS nation"),
        "supplier": t.supplier.selectExpr("s_suppkey AS suppkey", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation"),
    }
    return sets.union_relations(frames, column_override={"suppkey": "string"}, exclude=["NATION"])


@query("SELECT c_custkey AS custkey FROM customer EXCEPT SELECT user_id FROM events")
def set_except(t):
    return t.customer.select(F.col("c_custkey").alias("custkey")).subtract(t.events.select(F.col("user_id").alias("custkey")))


@query("""
WITH a AS (SELECT c_custkey AS custkey FROM customer), b AS (SELECT user_id AS custkey FROM events)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def set_symmetric_diff(t):
    a, b = t.customer.select(F.col("c_custkey").alias("custkey")), t.events.select(F.col("user_id").alias("custkey"))
    return sets.symmetric_difference(a, b)


@query("""
WITH totals AS (SELECT o_custkey, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS total FROM orders GROUP BY o_custkey)
SELECT * FROM totals WHERE total > 3000000
""")
def cte_filter(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum(exact("o_totalprice")).cast("double").alias("total"))
    return totals.filter(F.col("total") > 3000000)


@query("""
WITH w AS (SELECT o_orderkey, o_custkey, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) OVER (PARTITION BY o_custkey) AS DECIMAL(18,2)) AS DOUBLE) AS customer_total FROM orders)
SELECT * FROM w
""")
def cte_window(t):
    total = {"customer_total": F.sum(exact("o_totalprice")).cast("double")}
    return ordered.with_totals(t.orders, ["o_custkey"], total).select("o_orderkey", "o_custkey", "customer_total")


@query("""
WITH target AS (SELECT * FROM orders WHERE o_orderdate < '2000-01-01')
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (SELECT coalesce(max(o_orderdate), TIMESTAMP '1990-01-01') FROM target)
""")
def incremental_filter(t):
    loaded = t.orders.filter(F.col("o_orderdate") < "2000-01-01")
    return sets.newer_than(t.orders.select("o_orderkey", "o_orderdate"), loaded, "o_orderdate", "1990-01-01 00:00:00")


@query("SELECT CAST(range AS BIGINT) AS generated_number FROM range(1, (SELECT count(*) + 1 FROM orders))")
def generate_series(t):
    return sets.series(t.spark, t.orders.count())


SPINE = """
SELECT CAST(d AS DATE) AS day, coalesce(n, 0) AS n_orders FROM
(SELECT unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM
  (SELECT date_trunc('day', min(o_orderdate)) AS lo, date_trunc('day', max(o_orderdate)) AS hi FROM orders))
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n FROM orders GROUP BY 1) ON od = CAST(d AS DATE)
"""


@query(SPINE)
def date_spine(t):
    first = t.orders.agg(F.to_date(F.min("o_orderdate"))).scalar()
    last = t.orders.agg(F.to_date(F.max("o_orderdate"))).scalar()
    spine = sets.date_spine(t.spark, first, last).select(F.to_date("date_day").alias("day"))
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("""
SELECT CAST(d AS DATE) AS month, coalesce(n, 0) AS n_events FROM
(SELECT (SELECT last_day(max(ts)) FROM events) - INTERVAL 6 MONTH + to_months(CAST(i AS INTEGER)) AS d FROM range(7) r(i))
LEFT JOIN (SELECT date_trunc('month', ts) AS m, count(*) AS n FROM events GROUP BY 1) ON m = date_trunc('month', d)
""")
def base_dates(t):
    as_of = t.events.agg(F.last_day(F.max("ts"))).scalar()
    spine = sets.base_dates(t.spark, last=6, as_of=as_of, unit="month")
    counts = t.events.groupBy(F.date_trunc("month", "ts").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    return (
        spine.join(counts, F.date_trunc("month", "date_month") == F.col("m"), "left")
        .select(F.to_date("date_month").alias("month"), F.coalesce("n", F.lit(0)).alias("n_events"))
    )


@query("SELECT s_suppkey, s_name FROM supplier, range(3)")
def replicate_rows(t):
    return sets.replicate(t.supplier.select("s_suppkey", "s_name"), 3)
