"""Expectations, with arguments that leave failing rows to compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, rounded
from larkspur.functions.numbers import exact_sum
from larkspur.quality import expectations as ex

AMOUNT = "CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE)"


def prices(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query("SELECT o_custkey, count(*) < 15 AS expression FROM orders GROUP BY 1 HAVING NOT (count(*) < 15)")
def ex_expression_true(t):
    return ex.expression_true(t.orders, F.count(F.lit(1)) < 15, ["o_custkey"])


@query(f"SELECT o_custkey, {AMOUNT} AS expression FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1 HAVING NOT ({AMOUNT} > 500000 AND {AMOUNT} < 2500000)")
def ex_expression_between(t):
    return ex.expression_between(
        t.orders, exact_sum("o_totalprice"), 500000, 2500000, ["o_custkey"], "o_orderstatus <> 'F'", strictly=True
    )


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT coalesce(a.k, b.k) AS col_1, a.n AS expression, b.n AS compare_expression, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS expression_difference,
  abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / nullif(a.n * 1.0, 0) AS expression_difference_percent
FROM a FULL JOIN b ON a.k = b.k WHERE abs(coalesce(a.n, 0) - coalesce(b.n, 0)) > 50
""")
def ex_equal_expression(t):
    return ex.equal_expression(
        t.customer, F.count(F.lit(1)), t.supplier, keys=["c_nationkey"], other_keys=["s_nationkey"], tolerance=50
    )


@query("SELECT l_orderkey, count(DISTINCT l_partkey) AS expression FROM lineitem GROUP BY 1 HAVING NOT (count(DISTINCT l_partkey) > 2)")
def ex_distinct_count_gt(t):
    return ex.distinct_count(t.lineitem, "l_partkey", at_least=2, keys=["l_orderkey"])


@query("SELECT l_orderkey, count(DISTINCT l_partkey) AS expression FROM lineitem GROUP BY 1 HAVING NOT (count(DISTINCT l_partkey) < 6)")
def ex_distinct_count_lt(t):
    return ex.distinct_count(t.lineitem, "l_partkey", at_most=6, keys=["l_orderkey"])


@query("SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS expression FROM events GROUP BY 1 HAVING NOT (count(DISTINCT CAST(ts AS DATE)) = 27)")
def ex_distinct_count_eq(t):
    return ex.distinct_count(t.events.withColumn("day", F.to_date("ts")), "day", equal=27, keys=["user_id"])


@query("""
SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference, abs(a - b) / (a * 1.0) AS expression_difference_percent
FROM (SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS a, (SELECT count(DISTINCT user_id) FROM events) AS b) WHERE abs(a - b) > 0
""")
def ex_distinct_count_eq_other(t):
    return ex.distinct_count_equals_other(t.orders, "o_custkey", t.events, "user_id")


@query("SELECT DISTINCT event_type AS value_field FROM events WHERE event_type NOT IN ('view', 'click')")
def ex_distinct_in_set(t):
    return ex.distinct_in_set(t.events, "event_type", ["view", "click"])


@query("SELECT v AS value_field FROM (VALUES ('view'), ('refund')) s(v) WHERE v NOT IN (SELECT event_type FROM events)")
def ex_distinct_contain_set(t):
    return ex.distinct_contain_set(t.events, "event_type", ["view", "refund"])


@query("""
SELECT coalesce(e, v) AS value_field, e IS NOT NULL AS in_table FROM (SELECT DISTINCT event_type AS e FROM events)
FULL JOIN (VALUES ('view'), ('refund')) s(v) ON e = v WHERE e IS NULL OR v IS NULL
""")
def ex_distinct_equal_set(t):
    return ex.distinct_equal_set(t.events, "event_type", ["view", "refund"])


@query("SELECT o_custkey, max(o_totalprice) AS expression FROM orders GROUP BY 1 HAVING NOT (max(o_totalprice) >= 400000 AND max(o_totalprice) <= 490000)")
def ex_max_between(t):
    return ex.max_between(t.orders, "o_totalprice", 400000, 490000, ["o_custkey"])


@query("SELECT o_custkey, min(o_totalprice) AS expression FROM orders GROUP BY 1 HAVING NOT (min(o_totalprice) > 5000)")
def ex_min_between(t):
    return ex.min_between(t.orders, "o_totalprice", 5000, keys=["o_custkey"], strictly=True)


@query(f"SELECT o_custkey, {rounded('avg(o_totalprice)', 6)} AS expression FROM orders GROUP BY 1 HAVING NOT (avg(o_totalprice) >= 150000.5 AND avg(o_totalprice) <= 350000.5)")
def ex_mean_between(t):
    failing = ex.mean_between(t.orders, "o_totalprice", 150000.5, 350000.5, ["o_custkey"])
    return failing.withColumn("expression", F.round("expression", 6))


@query("SELECT p_type, median(p_retailprice) AS expression FROM part GROUP BY 1 HAVING NOT (median(p_retailprice) <= 905)")
def ex_median_between(t):
    return ex.median_between(t.part, "p_retailprice", None, 905, ["p_type"])


@query(f"SELECT o_orderpriority, {rounded('quantile_cont(o_totalprice, 0.95)', 4)} AS expression FROM orders GROUP BY 1 HAVING NOT (quantile_cont(o_totalprice, 0.95) >= 490000)")
def ex_quantile_between(t):
    failing = ex.quantile_between(t.orders, "o_totalprice", 0.95, 490000, keys=["o_orderpriority"])
    return failing.withColumn("expression", F.round("expression", 4))


@query(f"SELECT o_custkey, {rounded('stddev_samp(o_totalprice)', 2)} AS expression FROM orders GROUP BY 1 HAVING NOT (stddev_samp(o_totalprice) >= 100000)")
def ex_stdev_between(t):
    failing = ex.stdev_between(t.orders, "o_totalprice", 100000, keys=["o_custkey"])
    return failing.withColumn("expression", F.round("expression", 2))


@query("SELECT l_orderkey, sum(l_quantity) AS expression FROM lineitem GROUP BY 1 HAVING NOT (sum(l_quantity) >= 20 AND sum(l_quantity) <= 200)")
def ex_sum_between(t):
    return ex.sum_between(t.lineitem, "l_quantity", 20, 200, ["l_orderkey"])


@query("""
SELECT event_type AS value_field, n AS value_count FROM (SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1)
WHERE r = 2 AND event_type NOT IN ('view', 'purchase')
""")
def ex_most_common_in_set(t):
    return ex.most_common_in_set(t.events, "event_type", ["view", "purchase"], top_n=2)


@query("""
SELECT l_orderkey, count(DISTINCT l_partkey) / count(l_partkey) AS expression FROM lineitem GROUP BY 1
HAVING NOT (count(DISTINCT l_partkey) / count(l_partkey) >= 1.0)
""")
def ex_unique_proportion(t):
    return ex.unique_proportion_between(t.lineitem, "l_partkey", 1.0, keys=["l_orderkey"])


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS expression FROM orders GROUP BY 1 HAVING NOT (count(DISTINCT o_orderpriority) >= 3 AND count(DISTINCT o_orderpriority) <= 4)")
def ex_unique_count_between(t):
    return ex.unique_count_between(t.orders, "o_orderpriority", 3, 4, ["o_custkey"])


@query("SELECT event_id, value FROM events WHERE event_type = 'purchase' AND NOT (value > 1 AND value < 100)")
def ex_values_between(t):
    rows = t.events.select("event_id", "value", "event_type")
    return ex.values_between(rows, "value", 1, 100, "event_type = 'purchase'", strictly=True).drop("event_type")


MONOTONIC = """
SELECT * FROM (SELECT user_id, ts, value, event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_before FROM events)
WHERE value_before IS NOT NULL AND NOT ({test})
"""


@query(MONOTONIC.format(test="value <= value_before"))
def ex_values_decreasing(t):
    return ex.values_monotonic(t.events, "value", up=False, sort_by="ts", strictly=False, keys=["user_id"], tie=["event_id"])


@query(MONOTONIC.format(test="value > value_before"))
def ex_values_increasing(t):
    return ex.values_monotonic(t.events, "value", up=True, sort_by="ts", keys=["user_id"], tie=["event_id"])


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT coalesce(quality IN (1), false)")
def ex_values_in_set(t):
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return ex.values_in_set(rows, "quality", [1])


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD')")
def ex_values_not_in_set(t):
    return ex.values_not_in_set(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", ["MACHINERY", "HOUSEHOLD"])


@query("""
SELECT column_name, 'type is ' || CASE data_type WHEN 'VARCHAR' THEN 'string' END AS problem FROM (DESCRIBE SELECT c_mktsegment FROM customer) d(column_name, data_type, n, k, df, e)
WHERE (SELECT count(*) FROM customer) > 0
""")
def ex_type_in_list(t):
    return ex.type_in_list(t.customer, "c_mktsegment", ["int", "bigint"])


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def ex_values_null(t):
    rows = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return ex.values_null(rows, "quality")


@query("SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def ex_values_unique(t):
    return ex.compound_unique(t.lineitem, ["l_orderkey"])


@query(r"SELECT lower(w) AS folded, count(DISTINCT w) AS spellings, CAST(count(*) AS BIGINT) AS n_records FROM (SELECT unnest(string_split_regex(text, '\s+')) AS w FROM conversations) GROUP BY 1 HAVING count(DISTINCT w) > 1")
def ex_consistent_casing(t):
    words = t.conversations.select(F.explode(F.split("text", r"\s+")).alias("word"))
    return ex.consistent_casing(words, "word", display=True)


MOVING = f"""
WITH g AS (SELECT date_trunc('month', o_orderdate) AS metric_period, o_orderpriority, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS v FROM orders GROUP BY 1, 2),
d AS (SELECT *, coalesce(ln(nullif(v, 0)), 0) - coalesce(ln(nullif(lag(v) OVER (PARTITION BY o_orderpriority ORDER BY metric_period), 0)), 0) AS x FROM g),
m AS (SELECT *, avg(x) OVER w AS a, stddev_samp(x) OVER w AS s FROM d WINDOW w AS (PARTITION BY o_orderpriority ORDER BY metric_period ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
SELECT o_orderpriority, CAST(metric_period AS DATE) AS metric_period, {rounded('(x - a) / nullif(s, 0)', 6)} AS sigma FROM m
WHERE metric_period >= TIMESTAMP '1998-08-01' AND metric_period < TIMESTAMP '2001-08-01' AND NOT ((x - a) / nullif(s, 0) >= -1.5 AND (x - a) / nullif(s, 0) <= 2)
"""


@query(MOVING)
def ex_moving_stdevs(t):
    rows = t.orders.select("o_orderdate", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    failing = ex.moving_stdevs(
        rows, "amount", "o_orderdate", F.to_date(F.lit("2001-08-01")), ["o_orderpriority"], period="month",
        trend=6, test=36, sigma=2, sigma_lower=-1.5,
    )
    return failing.select(
        "o_orderpriority", F.to_date("metric_period").alias("metric_period"), F.round("metric_test_sigma", 6).alias("sigma")
    )


@query(f"""
WITH g AS (SELECT o_custkey, {AMOUNT} AS o_totalprice FROM orders GROUP BY 1), s AS (SELECT avg(o_totalprice) AS a, stddev_samp(o_totalprice) AS d FROM g)
SELECT o_custkey, o_totalprice, {rounded('a', 4, 8)} AS o_totalprice_average, {rounded('d', 4)} AS o_totalprice_stddev, {rounded('(o_totalprice - a) / d', 6)} AS o_totalprice_sigma
FROM g, s WHERE abs((o_totalprice - a) / d) > 1.5
""")
def ex_stdevs(t):
    sums = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("o_totalprice"))
    failing = ex.within_stdevs(sums, "o_totalprice", ["o_custkey"], 1.5)
    digits = {"o_totalprice_average": 4, "o_totalprice_stddev": 4, "o_totalprice_sigma": 6}
    return failing.select("o_custkey", "o_totalprice", *[F.round(n, k).alias(n) for n, k in digits.items()])


@query("""
WITH b AS (SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events WHERE event_type = 'error'),
s AS (SELECT unnest(generate_series(lo, hi - INTERVAL 2 HOUR, INTERVAL 2 HOUR)) AS d FROM b),
f AS (SELECT DISTINCT date_trunc('hour', ts) - to_hours(CAST(extract(hour FROM ts) AS INTEGER) % 2) AS d FROM events WHERE event_type = 'error')
SELECT d AS period, true AS is_missing, CAST(0 AS BIGINT) AS row_cnt, 'hours' AS unit FROM s WHERE d NOT IN (SELECT d FROM f)
UNION ALL SELECT d, true, 0, 'days' FROM (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)
WHERE d NOT IN (SELECT date_trunc('day', o_orderdate) FROM orders)
""")
def ex_data_every_datepart(t):
    hours = ex.data_every(t.events.select("ts", "event_type"), "ts", "hour", interval=2, where="event_type = 'error'")
    days = ex.data_every(t.orders.select("o_orderdate"), "o_orderdate")
    return hours.withColumnRenamed("date_hour", "period").withColumn("unit", F.lit("hours")).unionByName(
        days.withColumnRenamed("date_day", "period").withColumn("unit", F.lit("days"))
    )


@query("SELECT event_id, user_id, value FROM events WHERE NOT (value > user_id)")
def ex_pair_greater(t):
    return ex.pair_greater(t.events.select("event_id", "user_id", "value"), "value", "user_id")


@query("SELECT c_custkey, c_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT (c_nationkey = n_regionkey)")
def ex_pair_equal(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return ex.pair_equal(rows, "c_nationkey", "n_regionkey").select("c_custkey", "c_nationkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM lineitem WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))")
def ex_pair_in_set(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    return ex.pair_in_set(rows, "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")])


@query("SELECT quality, toxic, count(*) AS n_records FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT (quality IS NULL AND toxic IS NULL) GROUP BY 1, 2 HAVING count(*) > 1")
def ex_compound_unique(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return ex.compound_unique(rows, ["quality", "toxic"])


@query("SELECT o_custkey, count(*) + sum(1) = 20 AS expression FROM orders GROUP BY 1 HAVING NOT (count(*) + sum(1) = 20)")
def ex_multicolumn_sum(t):
    rows = t.orders.select("o_custkey", F.lit(1).alias("one"), F.lit(1).alias("other"))
    return ex.multicolumn_sum(rows, ["one", "other"], 20, ["o_custkey"])


@query("""
SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT (quality IS NULL AND toxic IS NULL) AND quality = toxic
""")
def ex_unique_in_record(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return ex.unique_in_record(rows, ["quality", "toxic"])


@query("SELECT doc_id, n_chars FROM documents WHERE NOT (length(text) >= 100 AND length(text) <= 5000)")
def ex_length_between(t):
    return ex.length_between(t.documents, "text", 100, 5000).select("doc_id", "n_chars")


@query("SELECT p_partkey, p_name FROM part WHERE NOT (p_name LIKE '%ring%')")
def ex_match_like(t):
    return ex.match_like(t.part.select("p_partkey", "p_name"), "p_name", "%ring%")


@query("SELECT p_partkey, p_name, 'any' AS how FROM part WHERE NOT (p_name LIKE '%ring%' OR p_name LIKE 'small%') UNION ALL SELECT p_partkey, p_name, 'not all' FROM part WHERE NOT (p_name NOT LIKE '%ring%' AND p_name NOT LIKE 'small%')")
def ex_match_like_list(t):
    rows, patterns = t.part.select("p_partkey", "p_name"), ["%ring%", "small%"]
    any_of = ex.match_like_list(rows, "p_name", patterns).withColumn("how", F.lit("any"))
    none = ex.match_like_list(rows, "p_name", patterns, match_on="all", negate=True).withColumn("how", F.lit("not all"))
    return any_of.unionByName(none)


@query("SELECT page_id, url, 'found' AS how FROM pages WHERE NOT regexp_matches(url, '/en/[0-9]+') UNION ALL SELECT page_id, url, 'absent' FROM pages WHERE regexp_matches(url, '(?i)UTM_SOURCE')")
def ex_match_regex(t):
    rows = t.pages.select("page_id", "url")
    found = ex.match_regex(rows, "url", "/en/[0-9]+").withColumn("how", F.lit("found"))
    absent = ex.match_regex(rows, "url", "UTM_SOURCE", negate=True, flags="i").withColumn("how", F.lit("absent"))
    return found.unionByName(absent)


@query("SELECT page_id, url FROM pages WHERE NOT (regexp_matches(url, '^https:') AND regexp_matches(url, 'example\\.(com|org)'))")
def ex_match_regex_list(t):
    return ex.match_regex_list(t.pages.select("page_id", "url"), "url", ["^https:", r"example\.(com|org)"], match_on="all")


@query("SELECT 'O_CUSTKEY' AS column_name, 'at position 1' AS problem FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM orders)")
def ex_column_exists(t):
    return ex.column_exists(t.orders, "O_CUSTKEY", index=0)


@query("SELECT o_custkey, max(o_orderdate) AS latest FROM orders WHERE o_orderdate <= TIMESTAMP '2001-08-01' GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '2001-08-01' - INTERVAL 1 MONTH")
def ex_grouped_recent(t):
    return ex.recent_data(t.orders, "o_orderdate", "month", 1, F.to_date(F.lit("2001-08-01")), ["o_custkey"])


@query("SELECT max(ts) AS latest FROM events WHERE ts <= TIMESTAMP '2024-02-10' HAVING max(ts) < TIMESTAMP '2024-02-10' - INTERVAL 5 DAY")
def ex_recent(t):
    return ex.recent_data(t.events, "ts", "day", 5, F.to_date(F.lit("2024-02-10")))


@query("""
WITH a AS (SELECT c_nationkey AS k, max(c_acctbal) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, max(s_acctbal) AS n FROM supplier GROUP BY 1)
SELECT coalesce(a.k, b.k) AS col_1, a.n AS expression, b.n AS compare_expression, abs(coalesce(a.n, 0) - coalesce(b.n, 0)) AS expression_difference,
  abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / nullif(a.n, 0) AS expression_difference_percent
FROM a FULL JOIN b ON a.k = b.k WHERE expression_difference > 100
""")
def ex_aggregation_eq_other(t):
    """The highest balances of a nation's customers and of its suppliers."""
    balances = lambda df, p: df.select(F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance"))
    return ex.aggregation_equals_other(balances(t.customer, "c"), F.max("balance"), balances(t.supplier, "s"), ["nation"], tolerance=100)


@query("SELECT '*' AS column_name, '6 columns' AS problem FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM orders)")
def ex_column_count(t):
    return ex.column_count(t.orders, other=t.customer)


@query("SELECT 'o_comment' AS column_name, 'missing' AS problem FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM orders)")
def ex_columns_contain(t):
    return ex.columns_contain(t.orders, ["o_orderkey", "o_comment"])


@query("SELECT unnest(['r_name', 'r_comment']) AS column_name, unnest(['unwanted', 'missing']) AS problem FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM region)")
def ex_columns_match(t):
    return ex.columns_match(t.region, ["r_regionkey", "r_comment"])


@query("SELECT l_suppkey, count(*) AS expression FROM lineitem GROUP BY 1 HAVING NOT (count(*) >= 580 AND count(*) <= 620)")
def ex_row_count(t):
    return ex.row_count_between(t.lineitem, 580, 620, ["l_suppkey"])


@query("""
SELECT a AS expression, 5 * b AS compare_expression, CAST(abs(a - 5 * b) AS BIGINT) AS expression_difference, abs(a - 5 * b) / (a * 1.0) AS expression_difference_percent
FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM orders) AS b) WHERE abs(a - 5 * b) > 0
""")
def ex_row_count_other(t):
    return ex.row_count_equals_other(t.lineitem, t.orders, factor=5)
