"""Retail tables: staging, history, marts, forecast, lineage.

The raw tables are derived from the test tables by plain expressions that mean
the same in Spark and in the checking SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, rounded
from larkspur.plans import forecast, history, lineage, marts, staging
from larkspur.session import cut, shared_dir
from larkspur.sources.tables import Stored

AS_OF = "2001-08-31"
LTV_SEGMENTS = (("High", 600_000), ("Medium", 300_000))

RAW_ORDERS = {
    "order_id": "l_orderkey", "user_id": "o_custkey", "product_id": "l_partkey", "product_title": "concat(' ', p_name, ' ')",
    "product_category": "concat(p_type, '_goods ')", "product_price": "p_retailprice", "quantity": "l_quantity",
    "total_amount": "l_extendedprice",
    "status": "CASE o_orderstatus WHEN 'F' THEN ' Cancelled ' WHEN 'O' THEN 'Shipped' ELSE 'pending' END",
    "payment_method": "CASE o_orderpriority WHEN '1-URGENT' THEN 'UPI' WHEN '2-HIGH' THEN 'credit_card' WHEN '3-MEDIUM' THEN 'Cod ' "
    "WHEN '4-NOT SPECIFIED' THEN 'wallet' ELSE 'debit_card' END",
    "order_date": "o_orderdate", "shipping_address": "concat('  ', o_orderpriority, ' street ')", "_ingested_at": "l_shipdate",
    "_source": "'lineitem'", "_batch_id": "l_returnflag", "_ingested_date": "CAST(l_shipdate AS DATE)",
}
ORDER_TIE = ["product_id", "total_amount", "quantity"]

RAW_PRODUCTS = {
    "product_id": "p_partkey", "product_name": "concat(p_name, ' ')", "category": "concat(' ', p_type, '_goods')", "price": "p_retailprice",
    "cost_price": "p_retailprice * 0.5", "stock_quantity": "(p_size - 1) * 6", "supplier": "p_brand", "rating": "p_size / 10.0D",
    "review_count": "p_size", "is_available": "p_size < 50", "_ingested_at": "CAST('2001-01-01' AS TIMESTAMP)", "_source": "'part'",
    "_batch_id": "'b1'", "_ingested_date": "CAST('2001-01-01' AS DATE)",
}

RAW_CLICKS = {
    "event_id": "concat(' ', event_id)", "session_id": "concat(user_id, '-', CAST(ts AS DATE))", "user_id": "user_id",
    "event_type": "CASE event_type WHEN 'view' THEN ' Page_View ' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart' "
    "WHEN 'error' THEN 'CHECKOUT_started' ELSE event_type END",
    "page_url": "concat('/p/', props)", "product_id": "user_id", "event_timestamp": "ts",
    "device_type": "CASE WHEN value < 5 THEN 'Mobile' WHEN value < 30 THEN 'desktop ' ELSE 'tablet' END", "browser": "'b '",
    "referrer": "' r'", "_ingested_at": "ts", "_source": "'events'", "_batch_id": "'b1'", "_ingested_date": "CAST(ts AS DATE)",
}


def customer_batch(mail: str, city: str, at: str) -> dict:
    return {
        "customer_id": "c_custkey", "first_name": "concat(' ', lower(c_mktsegment))", "last_name": "lower(split_part(c_name, '#', 1))",
        "email": f"concat(' {mail}', c_custkey, '@', c_mktsegment, '.Example.com')", "phone": "concat(c_nationkey, '-555 ')",
        "address": "concat(c_nationkey, ' Road')", "city": f"'{city}'", "state": "lower(c_mktsegment)", "country": "'FRANCE'",
        "age": "c_nationkey * 3", "gender": "' F '", "registration_date": "CAST('1995-01-01' AS DATE)", "is_active": "c_acctbal >= 0",
        "_ingested_at": f"CAST('{at}' AS TIMESTAMP)", "_source": "'customer'", "_batch_id": f"'{mail}'",
        "_ingested_date": f"CAST('{at}' AS DATE)",
    }


FIRST_BATCH = customer_batch("c", "old town", "2001-01-01")
SECOND_BATCH = customer_batch("moved", "new-PORT", "2001-06-01")


def columns_sql(mapping: dict) -> str:
    return ", ".join(f"{e.replace('10.0D', '10.0')} AS {n}" for n, e in mapping.items())


def mapped(df, mapping: dict):
    return df.selectExpr(*[f"{e} AS {n}" for n, e in mapping.items()])


def raw_orders(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return mapped(lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")), RAW_ORDERS)


MART_COLUMNS = [
    "order_id", "customer_id", "product_id", "product_category", "unit_price", "quantity", "total_amount", "order_status",
    "payment_method", "order_date",
]


def staged_orders(t):
    """The staged columns the marts use, stored because each mart reads them several times."""
    return cut(staging.orders(raw_orders(t), ORDER_TIE).select(*MART_COLUMNS))


def staged_products(t):
    return staging.products(mapped(t.part, RAW_PRODUCTS))


def staged_clicks(t):
    return staging.clickstream(mapped(t.events, RAW_CLICKS))


def staged_customers(t):
    moved = mapped(t.customer.filter(F.col("c_acctbal") > 5000), SECOND_BATCH)
    return staging.customers(mapped(t.customer, FIRST_BATCH).unionByName(moved))


AUDIT_SQL = "CAST(_ingested_at AS TIMESTAMP) AS ingested_at, _source AS record_source, _batch_id AS batch_id, _ingested_date AS ingested_date"

STG_ORDERS = f"""
SELECT md5(CAST(order_id AS VARCHAR)) AS order_sk, order_id, user_id AS customer_id, product_id, trim(product_title) AS product_title,
  lower(trim(product_category)) AS product_category, product_price AS unit_price, CAST(quantity AS BIGINT) AS quantity, total_amount,
  lower(trim(status)) AS order_status, lower(trim(payment_method)) AS payment_method, order_date AS order_timestamp,
  CAST(order_date AS DATE) AS order_date, trim(shipping_address) AS shipping_address, {AUDIT_SQL}
FROM (SELECT {columns_sql(RAW_ORDERS)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) r
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingested_at DESC, product_id, total_amount, quantity) = 1
"""

STG_PRODUCTS = f"""
SELECT md5(CAST(product_id AS VARCHAR)) AS product_sk, product_id, trim(product_name) AS product_name, lower(trim(category)) AS category,
  array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(replace(trim(category), '_', ' '), ' ')], ' ') AS category_display,
  price, cost_price, {rounded('price - cost_price', 2)} AS margin, {rounded('(price - cost_price) / nullif(price, 0) * 100', 2)} AS margin_pct,
  CAST(stock_quantity AS BIGINT) AS stock_quantity, CASE WHEN stock_quantity = 0 THEN 'out_of_stock' WHEN stock_quantity <= 20 THEN 'low_stock'
  WHEN stock_quantity <= 200 THEN 'in_stock' ELSE 'overstocked' END AS stock_status, is_available, trim(supplier) AS supplier,
  CAST(rating AS DOUBLE) AS rating, CAST(review_count AS BIGINT) AS review_count, {AUDIT_SQL}
FROM (SELECT {columns_sql(RAW_PRODUCTS)} FROM part) r
"""

STG_CLICKS = f"""
SELECT md5(event_id) AS event_sk, trim(event_id) AS event_id, trim(session_id) AS session_id, user_id, lower(trim(event_type)) AS event_type,
  CASE lower(trim(event_type)) WHEN 'page_view' THEN 1 WHEN 'product_view' THEN 2 WHEN 'add_to_cart' THEN 3 WHEN 'checkout_started' THEN 4
  WHEN 'purchase' THEN 5 ELSE 0 END AS funnel_step_number, lower(trim(event_type)) = 'purchase' AS is_conversion, trim(page_url) AS page_url,
  product_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date, lower(trim(device_type)) AS device_type, trim(browser) AS browser,
  trim(referrer) AS referrer, {AUDIT_SQL} FROM (SELECT {columns_sql(RAW_CLICKS)} FROM events) r
"""

STG_CUSTOMERS = f"""
SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_sk, customer_id, upper(trim(first_name)[1]) || trim(first_name)[2:] AS first_name,
  upper(last_name[1]) || last_name[2:] AS last_name, upper(trim(first_name)[1]) || trim(first_name)[2:] || ' ' || upper(last_name[1]) || last_name[2:] AS full_name,
  lower(trim(email)) AS email, lower(split_part(trim(email), '@', 2)) AS email_domain, trim(phone) AS phone, trim(address) AS address,
  CASE city WHEN 'old town' THEN 'Old Town' ELSE 'New-Port' END AS city, upper(state[1]) || state[2:] AS state, 'France' AS country,
  CAST(age AS BIGINT) AS age, CASE WHEN age BETWEEN 18 AND 25 THEN '18-25' WHEN age BETWEEN 26 AND 35 THEN '26-35' WHEN age BETWEEN 36 AND 45 THEN '36-45'
  WHEN age BETWEEN 46 AND 55 THEN '46-55' WHEN age > 55 THEN '56+' ELSE 'unknown' END AS age_bucket, trim(gender) AS gender, registration_date, is_active, {AUDIT_SQL}
FROM (SELECT {columns_sql(FIRST_BATCH)} FROM customer UNION ALL SELECT {columns_sql(SECOND_BATCH)} FROM customer WHERE c_acctbal > 5000) r
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at DESC) = 1
"""


@query(STG_ORDERS)
def stg_orders(t):
    return staging.orders(raw_orders(t), ORDER_TIE)


@query(STG_CUSTOMERS)
def stg_customers(t):
    return staged_customers(t)


@query(STG_PRODUCTS)
def stg_products(t):
    return staged_products(t)


@query(STG_CLICKS)
def stg_clickstream(t):
    return staged_clicks(t)


# --- history ------------------------------------------------------------------

TRACKED = ["email", "phone", "city", "state", "is_active"]
SNAPSHOT_COLUMNS = [
    "customer_id", "full_name", "first_name", "last_name", "email", "phone", "city", "state", "country", "age", "gender",
    "registration_date", "is_active", "ingested_at", "batch_id",
]
T1, T2 = "2001-01-02 00:00:00", "2001-06-02 00:00:00"


def customer_history(t):
    """Two looks: on the first some customers are not there yet, before the second some move and some leave."""
    first = t.customer.filter(~F.col("c_acctbal").between(0, 500))
    second = t.customer.filter(F.col("c_acctbal") >= -800)
    moved = second.filter(F.col("c_acctbal") > 5000)
    day1 = staging.customers(mapped(first, FIRST_BATCH)).select(*SNAPSHOT_COLUMNS)
    both = mapped(second, FIRST_BATCH).unionByName(mapped(moved, SECOND_BATCH))
    day2 = staging.customers(both).select(*SNAPSHOT_COLUMNS)
    stored = Stored(t.spark, f"{shared_dir(t.spark)}/history/{uuid.uuid4()}")
    history.look(stored, day1, "customer_id", TRACKED, T1)
    return history.look(stored, day2, "customer_id", TRACKED, T2)


PROFILE = [
    "customer_id", "full_name", "first_name", "last_name", "email", "city", "state", "country", "age", "age_bucket", "gender", "registration_date", "is_active",
]


def current_customers(t):
    """Profiles of the versions that are valid now."""
    return history.current(customer_history(t)).select(*PROFILE)


HISTORY = f"""
WITH c AS (SELECT c_custkey AS customer_id, c_acctbal AS b, 'c' || c_custkey || '@' || lower(c_mktsegment) || '.example.com' AS mail,
  'moved' || c_custkey || '@' || lower(c_mktsegment) || '.example.com' AS moved_mail, CAST(c_nationkey * 3 AS BIGINT) AS age FROM customer),
h AS (SELECT customer_id, mail AS email, 'Old Town' AS city, age, TIMESTAMP '{T1}' AS valid_from, CASE WHEN b > 5000 OR b < -800 THEN TIMESTAMP '{T2}' END AS valid_to
  FROM c WHERE NOT (b BETWEEN 0 AND 500)
UNION ALL SELECT customer_id, moved_mail, 'New-Port', age, TIMESTAMP '{T2}', NULL FROM c WHERE b > 5000
UNION ALL SELECT customer_id, mail, 'Old Town', age, TIMESTAMP '{T2}', NULL FROM c WHERE b BETWEEN 0 AND 500)
"""
SCD_ID = "md5(customer_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S'))"


@query(HISTORY + f"SELECT customer_id, email, city, valid_from, valid_to, {SCD_ID} AS scd_id FROM h")
def scd2_snapshot(t):
    return customer_history(t).select("customer_id", "email", "city", "valid_from", "valid_to", "scd_id")


@query(HISTORY + f"""
SELECT customer_id, city, md5(customer_id || '-' || {SCD_ID}) AS customer_version_sk, valid_from AS _valid_from, valid_to AS _valid_to,
  valid_to IS NULL AS _is_current, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS _version_num,
  CASE WHEN age BETWEEN 18 AND 25 THEN '18-25' WHEN age BETWEEN 26 AND 35 THEN '26-35' WHEN age BETWEEN 36 AND 45 THEN '36-45'
  WHEN age BETWEEN 46 AND 55 THEN '46-55' WHEN age > 55 THEN '56+' ELSE 'unknown' END AS age_bucket FROM h
""")
def scd2_dimension(t):
    return history.dimension(customer_history(t)).select(
        "customer_id", "city", "customer_version_sk", "_valid_from", "_valid_to", "_is_current", "_version_num", "age_bucket"
    )


@query(HISTORY + """
, v AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from) AS n FROM h)
SELECT customer_id, email, n AS _version_num, valid_to IS NULL AS _is_current, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from,
  strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to FROM v WHERE customer_id IN (SELECT customer_id FROM v WHERE n > 1) ORDER BY customer_id, n
""")
def scd2_verify(t):
    dim = history.dimension(customer_history(t))
    return history.multi_version(dim).select("customer_id", "email", "_version_num", "_is_current", "valid_from", "valid_to")


# --- marts ----------------------------------------------------------------------

SUM = "CAST(CAST(sum(CASE WHEN order_status <> 'cancelled' THEN CAST(total_amount AS DECIMAL(38,10)) ELSE 0 END) AS DECIMAL(18,2)) AS DOUBLE)"
SOLD = "count(*) FILTER (order_status <> 'cancelled')"

STAGED = f"WITH so AS ({STG_ORDERS}), sp AS ({STG_PRODUCTS}), sc AS ({STG_CUSTOMERS}), cl AS ({STG_CLICKS})"

DAILY = f"""
lines AS (SELECT so.*, coalesce(sp.category, so.product_category) AS cat FROM so LEFT JOIN sp ON so.product_id = sp.product_id),
best AS (SELECT order_date AS d, cat AS top_category FROM (SELECT order_date, cat, sum(CAST(total_amount AS DECIMAL(38,10))) AS r FROM lines
  WHERE order_status <> 'cancelled' GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY order_date ORDER BY r DESC, cat) = 1),
daily AS (SELECT x.*, top_category FROM (SELECT order_date, {SUM} AS total_revenue, count(DISTINCT order_id) AS order_count,
  coalesce({rounded(f'{SUM} / nullif({SOLD}, 0)', 2)}, 0) AS avg_order_value, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(CASE WHEN order_status <> 'cancelled' THEN quantity ELSE 0 END) AS BIGINT) AS units_sold, count(*) FILTER (order_status = 'cancelled') AS cancelled_orders,
  {rounded("count(*) FILTER (order_status = 'cancelled') / count(DISTINCT order_id) * 100", 2)} AS cancellation_rate,
  count(*) FILTER (payment_method = 'upi') AS upi_orders, count(*) FILTER (payment_method = 'credit_card') AS credit_card_orders,
  count(*) FILTER (payment_method = 'cod') AS cod_orders FROM lines GROUP BY 1) x LEFT JOIN best ON d = order_date)
"""

LTV = f"""
co AS (SELECT customer_id, {SUM} AS total_spend, count(DISTINCT order_id) AS order_count, {rounded(f'{SUM} / count(*)', 2)} AS avg_order_value,
  CAST(sum(quantity) AS BIGINT) AS total_units_purchased, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
  CAST(DATE '{AS_OF}' - max(order_date) AS INTEGER) AS days_since_last_order, CAST(max(order_date) - min(order_date) AS INTEGER) AS customer_tenure_days,
  {rounded('count(DISTINCT order_id) / greatest(max(order_date) - min(order_date), 1) * 30', 2)} AS orders_per_month
  FROM so WHERE order_status <> 'cancelled' GROUP BY 1),
pay AS (SELECT customer_id, payment_method AS preferred_payment_method FROM (SELECT customer_id, payment_method, count(*) AS n FROM so WHERE order_status <> 'cancelled' GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, payment_method) = 1),
fav AS (SELECT customer_id, product_category AS favorite_category FROM (SELECT customer_id, product_category, count(*) AS n FROM so WHERE order_status <> 'cancelled' GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, product_category) = 1),
base AS (SELECT {", ".join("now." + c for c in PROFILE)}, coalesce(total_spend, 0) AS total_spend, coalesce(order_count, 0) AS order_count,
  coalesce(avg_order_value, 0) AS avg_order_value, coalesce(total_units_purchased, 0) AS total_units_purchased, first_order_date, last_order_date,
  coalesce(days_since_last_order, 9999) AS days_since_last_order, coalesce(customer_tenure_days, 0) AS customer_tenure_days,
  coalesce(orders_per_month, 0) AS orders_per_month, preferred_payment_method, favorite_category
  FROM (SELECT sc.* FROM sc JOIN customer ON c_custkey = customer_id WHERE c_acctbal >= -800) now LEFT JOIN co USING (customer_id) LEFT JOIN pay USING (customer_id) LEFT JOIN fav USING (customer_id)),
ltv AS (SELECT *, CASE WHEN total_spend = 0 THEN 'New' WHEN total_spend >= 600000 THEN 'High' WHEN total_spend >= 300000 THEN 'Medium' ELSE 'Low' END AS ltv_segment,
  CASE WHEN order_count = 0 THEN 'no_orders' WHEN days_since_last_order <= 30 THEN 'active' WHEN days_since_last_order <= 60 THEN 'at_risk'
  WHEN days_since_last_order <= 90 THEN 'slipping' ELSE 'churned' END AS churn_risk,
  CAST(ntile(5) OVER (ORDER BY days_since_last_order DESC, customer_id) AS INTEGER) AS recency_score,
  CAST(ntile(5) OVER (ORDER BY order_count, customer_id) AS INTEGER) AS frequency_score,
  CAST(ntile(5) OVER (ORDER BY total_spend, customer_id) AS INTEGER) AS monetary_score FROM base)
"""
# Built from the definitions of the columns at finer grains: product and order, product and day, product and buyer. Ranks count the better rows.
PERFORMANCE = f"""
bought AS (SELECT product_id, count(*) AS orders_placed, count(*) FILTER (kept_lines > 0) AS orders_kept
  FROM (SELECT product_id, order_id, count(*) FILTER (order_status <> 'cancelled') AS kept_lines FROM so GROUP BY ALL) GROUP BY ALL),
dealt AS (SELECT product_id, min(order_date) AS opened, max(order_date) AS closed, count(*) AS days, sum(dropped) AS dropped, sum(kept) AS kept, sum(units) AS units,
  sum(amount) AS amount, sum(asked) AS asked FROM (
    SELECT product_id, order_date, count(*) FILTER (order_status = 'cancelled') AS dropped, count(*) FILTER (order_status <> 'cancelled') AS kept,
      sum(quantity) FILTER (order_status <> 'cancelled') AS units, sum(CAST(total_amount AS DECIMAL(38,10))) FILTER (order_status <> 'cancelled') AS amount,
      sum(CAST(unit_price AS DECIMAL(38,10))) FILTER (order_status <> 'cancelled') AS asked FROM so GROUP BY ALL) GROUP BY ALL),
buyers AS (SELECT product_id, count(*) AS people FROM (SELECT DISTINCT product_id, customer_id FROM so WHERE customer_id IS NOT NULL) GROUP BY ALL),
goods AS (SELECT sp.*, coalesce(units, 0) AS units, CAST(CAST(coalesce(amount, 0) AS DECIMAL(18,2)) AS DOUBLE) AS amount, asked, kept, dropped, orders_placed, orders_kept, opened, closed, days, people
  FROM sp LEFT JOIN dealt USING (product_id) LEFT JOIN bought USING (product_id) LEFT JOIN buyers USING (product_id)),
shelves AS (SELECT category, CAST(CAST(sum(CAST(amount AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS shelf FROM goods GROUP BY ALL),
perf AS (SELECT g.product_id, product_sk, product_name, g.category, category_display, price AS list_price, cost_price, margin, margin_pct, stock_quantity, stock_status,
  is_available, supplier, rating, review_count, CAST(units AS BIGINT) AS units_sold, coalesce(orders_kept, 0) AS order_count, coalesce(people, 0) AS unique_buyers, amount AS revenue,
  coalesce({rounded('CAST(CAST(asked AS DECIMAL(18,2)) AS DOUBLE) / nullif(kept, 0)', 2)}, price) AS avg_selling_price, CAST(coalesce(dropped, 0) AS BIGINT) AS cancelled_count,
  coalesce({rounded('dropped / orders_placed * 100', 2)}, 0) AS return_rate, opened AS first_sale_date, closed AS last_sale_date, coalesce(days, 0) AS active_sale_days,
  CAST(CAST(CAST(amount AS DECIMAL(28,10)) - CAST(units AS BIGINT) * CAST(cost_price AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS DOUBLE) AS gross_profit, {rounded('amount / greatest(units, 1)', 2)} AS revenue_per_unit,
  {rounded('stock_quantity / nullif(units / greatest(coalesce(days, 0), 1), 0)', 1)} AS estimated_days_of_stock,
  1 + (SELECT count(*) FROM goods o WHERE o.category = g.category AND o.amount > g.amount) AS rank_in_category,
  1 + (SELECT count(*) FROM goods o WHERE o.category = g.category AND o.units > g.units) AS units_rank_in_category,
  1 + (SELECT count(*) FROM goods o WHERE o.amount > g.amount) AS overall_revenue_rank, {rounded('amount / nullif(shelf, 0) * 100', 2)} AS pct_of_category_revenue
  FROM goods g LEFT JOIN shelves ON shelves.category = g.category)
"""

FUNNEL_ORDERS = "SELECT event_id AS order_id, CAST(ts AS DATE) AS order_date, value AS total_amount, CASE WHEN value < 1 THEN 'cancelled' ELSE 'done' END AS order_status FROM events WHERE event_type = 'purchase'"


def pct(a, b):
    return rounded(f"{a} / nullif({b}, 0) * 100", 2)


# Sessions first, then days; orders of a day by lookup.
FUNNEL = f"""
visits AS (SELECT event_date, session_id, count(*) AS steps, map_from_entries(list((event_type, n))) AS by_type, sum(mobile) AS mobile, sum(desktop) AS desktop, sum(tablet) AS tablet, sum(n) AS hits
  FROM (SELECT event_date, session_id, event_type, count(*) AS n, count_if(device_type = 'mobile') AS mobile, count_if(device_type = 'desktop') AS desktop, count_if(device_type = 'tablet') AS tablet
    FROM cl GROUP BY ALL) GROUP BY ALL),
people AS (SELECT event_date, count(*) AS n FROM (SELECT DISTINCT event_date, user_id FROM cl WHERE user_id IS NOT NULL) GROUP BY ALL),
days AS (SELECT event_date, CAST(sum(hits) AS BIGINT) AS total_events, count(session_id) AS total_sessions, {", ".join(f"CAST(sum(coalesce(by_type['{kind}'], 0)) AS BIGINT) AS {name}"
    for kind, name in (("page_view", "page_views"), ("product_view", "product_views"), ("add_to_cart", "add_to_cart"), ("checkout_started", "checkout_started"), ("purchase", "purchases")))},
  count_if(by_type['purchase'] > 0 AND session_id IS NOT NULL) AS sessions_with_purchase, count_if(by_type['add_to_cart'] > 0 AND session_id IS NOT NULL) AS sessions_with_cart,
  CAST(sum(mobile) AS BIGINT) AS mobile_events, CAST(sum(desktop) AS BIGINT) AS desktop_events, CAST(sum(tablet) AS BIGINT) AS tablet_events FROM visits GROUP BY ALL),
ordered AS (SELECT d.*, coalesce(people.n, 0) AS unique_visitors, (SELECT count(DISTINCT order_id) FROM ({FUNNEL_ORDERS}) o WHERE o.order_date = d.event_date AND o.order_status = 'done') AS confirmed_orders,
  coalesce((SELECT CAST(CAST(sum(CAST(total_amount AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) FROM ({FUNNEL_ORDERS}) o WHERE o.order_date = d.event_date AND o.order_status = 'done'), 0) AS order_revenue
  FROM days d LEFT JOIN people ON people.event_date = d.event_date),
funnel AS (SELECT *, {pct('product_views', 'page_views')} AS view_to_product_rate,
  {pct('add_to_cart', 'product_views')} AS product_to_cart_rate, {pct('checkout_started', 'add_to_cart')} AS cart_to_checkout_rate, {pct('purchases', 'checkout_started')} AS checkout_to_purchase_rate,
  {pct('purchases', 'page_views')} AS view_to_order_rate, {pct('sessions_with_purchase', 'total_sessions')} AS session_conversion_rate, {rounded('total_events / total_sessions', 1)} AS avg_events_per_session,
  {pct('(add_to_cart - checkout_started)', 'greatest(add_to_cart, 1)')} AS cart_abandonment_rate FROM ordered)
"""


def sales(t, orders=None):
    return marts.sales_daily(orders or staged_orders(t), staged_products(t))


def ltv(t):
    return marts.customer_ltv(current_customers(t), staged_orders(t), AS_OF, LTV_SEGMENTS)


def performance(t, orders=None):
    return marts.product_performance(staged_products(t), orders or staged_orders(t))


def daily_funnel(t):
    buys = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"), F.to_date("ts").alias("order_date"), F.col("value").alias("total_amount"),
        F.when(F.col("value") < 1, "cancelled").otherwise("done").alias("order_status"),
    )
    return marts.funnel(staged_clicks(t), buys)


@query(f"{STAGED}, {DAILY} SELECT * FROM daily")
def mart_sales_daily(t):
    return sales(t)


@query(f"{STAGED}, {LTV} SELECT *, recency_score + frequency_score + monetary_score AS rfm_total_score FROM ltv")
def mart_customer_ltv(t):
    return ltv(t)


@query(f"{STAGED}, {PERFORMANCE} SELECT * FROM perf")
def mart_product_performance(t):
    return performance(t)


@query(f"{STAGED}, {FUNNEL} SELECT * FROM funnel")
def mart_funnel(t):
    return daily_funnel(t)


PREDICTIONS = "SELECT product_id, CAST(sum(quantity) / 2 AS DOUBLE) AS predicted_units FROM so GROUP BY 1"


@query(f"""
{STAGED}, pred AS ({PREDICTIONS})
SELECT sp.product_id, product_sk, product_name, category, category_display, price AS list_price, cost_price, margin_pct, stock_quantity, stock_status, rating, review_count, supplier,
  predicted_units, TIMESTAMP '2001-08-31' AS forecast_generated_at, DATE '2001-09-07' AS forecast_for_week_starting,
  CAST(round(CAST(predicted_units AS DECIMAL(18,4)) * CAST(price AS DECIMAL(18,2)), 2) AS DOUBLE) AS projected_revenue,
  CASE WHEN stock_quantity >= predicted_units THEN 'sufficient' WHEN stock_quantity >= predicted_units * 0.5 THEN 'at_risk' ELSE 'insufficient' END AS stock_adequacy,
  greatest(predicted_units - stock_quantity, 0) AS recommended_reorder_qty FROM sp JOIN pred ON pred.product_id = sp.product_id
""")
def mart_demand_forecast(t):
    predictions = staged_orders(t).groupBy("product_id").agg((F.sum("quantity") / 2).alias("predicted_units")).withColumns(
        {"forecast_generated_at": F.lit(AS_OF).cast("timestamp"), "forecast_for_week_starting": F.date_add(F.lit(AS_OF).cast("date"), 7)}
    )
    return marts.demand_forecast(predictions, staged_products(t))


@query(f"""
{STAGED}, {DAILY} SELECT CAST(CAST(sum(CAST(total_revenue AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS total_revenue, CAST(sum(order_count) AS BIGINT) AS total_orders,
{rounded('CAST(CAST(sum(CAST(avg_order_value AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) / count(*)', 2)} AS avg_order_value, CAST(sum(units_sold) AS BIGINT) AS total_units_sold, count(DISTINCT order_date) AS active_days FROM daily
""")
def kpi_revenue(t):
    return marts.revenue_kpis(sales(t))


@query(f"""
{STAGED}, {LTV} SELECT ltv_segment, count(*) AS customer_count, {rounded('CAST(CAST(sum(CAST(total_spend AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) / count(*)', 2)} AS avg_spend,
CAST(CAST(sum(CAST(total_spend AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS total_spend FROM ltv GROUP BY 1
""")
def kpi_segments(t):
    return marts.segment_kpis(ltv(t))


@query(f"""
{STAGED}, {FUNNEL}, s AS (SELECT CAST(sum(page_views) AS BIGINT) AS page_views, CAST(sum(add_to_cart) AS BIGINT) AS add_to_cart, CAST(sum(checkout_started) AS BIGINT) AS checkout_started,
  CAST(sum(confirmed_orders) AS BIGINT) AS orders FROM funnel)
SELECT *, {pct('add_to_cart', 'page_views')} AS views_to_cart_rate, {pct('checkout_started', 'add_to_cart')} AS cart_to_checkout_rate, {pct('orders', 'checkout_started')} AS checkout_to_order_rate,
  {pct('orders', 'page_views')} AS overall_conversion_rate FROM s
""")
def kpi_funnel(t):
    return marts.funnel_kpis(daily_funnel(t))


# --- demand features ------------------------------------------------------------

# Days of a product first, then its weeks; the target is looked up in the next week that has sales.
FEATURES = f"""
sold_days AS (SELECT product_id, order_date, coalesce(sum(quantity) FILTER (order_status <> 'cancelled'), 0) AS units, count_if(order_status <> 'cancelled') AS kept,
  coalesce(sum(CAST(total_amount AS DECIMAL(38,10))) FILTER (order_status <> 'cancelled'), 0) AS amount, sum(CAST(unit_price AS DECIMAL(38,10))) FILTER (order_status <> 'cancelled') AS asked
  FROM so GROUP BY ALL),
sold_weeks AS (SELECT product_id, order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS monday, CAST(sum(units) AS BIGINT) AS units, CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS DOUBLE) AS amount,
  {rounded('CAST(CAST(sum(asked) AS DECIMAL(18,2)) AS DOUBLE) / nullif(sum(kept), 0)', 2)} AS price_asked FROM sold_days GROUP BY ALL),
week_orders AS (SELECT product_id, order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS monday, count(DISTINCT order_id) AS orders_kept FROM so WHERE order_status <> 'cancelled' GROUP BY ALL),
week_buyers AS (SELECT product_id, order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS monday, count(DISTINCT customer_id) AS people FROM so GROUP BY ALL),
market AS (SELECT order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS monday, CAST(CAST(sum(CAST(total_revenue AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS turnover, count(*) AS days, CAST(sum(order_count) AS BIGINT) AS orders
  FROM daily GROUP BY ALL),
known AS (SELECT w.*, (SELECT min_by(n.units, n.monday) FROM sold_weeks n WHERE n.product_id = w.product_id AND n.monday > w.monday) AS target FROM sold_weeks w),
features AS (SELECT k.product_id, perf.product_name, k.monday AS week_start, perf.category, perf.list_price, perf.cost_price, perf.margin_pct, perf.stock_quantity, perf.rating, perf.review_count,
  perf.units_sold AS lifetime_units_sold, perf.revenue AS lifetime_revenue, perf.rank_in_category, perf.overall_revenue_rank, perf.return_rate, perf.active_sale_days,
  k.units AS current_week_units_sold, coalesce(week_orders.orders_kept, 0) AS current_week_orders, k.amount AS current_week_revenue, week_buyers.people AS current_week_buyers,
  k.price_asked AS avg_selling_price, coalesce(turnover, 0) AS platform_weekly_revenue, coalesce(market.orders, 0) AS platform_weekly_orders,
  coalesce({rounded('turnover / days', 2)}, 0) AS platform_avg_daily_revenue, {rounded('k.amount / nullif(turnover, 0) * 100', 4)} AS pct_of_platform_revenue, k.target AS next_week_units_sold
  FROM known k JOIN perf ON perf.product_id = k.product_id LEFT JOIN market ON market.monday = k.monday LEFT JOIN week_orders ON week_orders.product_id = k.product_id AND week_orders.monday = k.monday
  LEFT JOIN week_buyers ON week_buyers.product_id = k.product_id AND week_buyers.monday = k.monday WHERE k.target IS NOT NULL)
"""
WITH_FEATURES = f"{STAGED}, {DAILY}, {PERFORMANCE}, {FEATURES}"


def features(t):
    """The features, stored: their readers ask for several things."""
    orders = staged_orders(t)
    return cut(forecast.training_features(orders, performance(t, orders), sales(t, orders)))


@query(f"{WITH_FEATURES} SELECT * FROM features")
def ml_training_features(t):
    return features(t)


@query(f"""
{WITH_FEATURES} SELECT count(*) AS total_rows, count(DISTINCT product_id) AS unique_products, count(DISTINCT week_start) AS unique_weeks, count(DISTINCT category) AS unique_categories,
{rounded('CAST(sum(next_week_units_sold) AS DOUBLE) / count(*)', 2)} AS avg_target, min(next_week_units_sold) AS min_target, max(next_week_units_sold) AS max_target,
{rounded('stddev_samp(next_week_units_sold)', 2)} AS stddev_target, count(*) FILTER (next_week_units_sold IS NULL) AS null_targets FROM features
""")
def ml_training_stats(t):
    return forecast.training_stats(features(t))


@query(f"{WITH_FEATURES} SELECT * EXCLUDE (next_week_units_sold) FROM features WHERE week_start = (SELECT max(week_start) FROM features)")
def ml_prediction_input(t):
    return forecast.prediction_input(features(t))


NUMERIC = ["list_price", "lifetime_units_sold", "current_week_units_sold", "current_week_orders", "platform_weekly_orders"]
ROUNDS, BINS = 6, 16


def stump_sql() -> str:
    """The learner's rounds, each from the sums over its bins."""
    hexes = " + ".join(f"{16 ** (3 - i)} * (instr('0123456789abcdef', substr(md5(product_id || '|' || week_start), {i + 1}, 1)) - 1)" for i in range(4))
    bins = ", ".join(f"CASE WHEN x{i} IS NULL OR h{i} <= l{i} THEN 0 ELSE CAST(least(greatest(floor((x{i} - l{i}) * {BINS} / (h{i} - l{i})), 0), {BINS - 1}) AS INTEGER) END" for i in range(len(NUMERIC)))
    parts = [
        f"""rows0 AS MATERIALIZED (SELECT product_id, week_start, next_week_units_sold AS actual, CAST(round(next_week_units_sold * 1000) AS BIGINT) AS y, ({hexes}) % 10 AS part,
          {", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(NUMERIC))} FROM features)""",
        f"ends AS MATERIALIZED (SELECT {', '.join(f'min(x{i}) AS l{i}, max(x{i}) AS h{i}' for i in range(len(NUMERIC)))}, CAST(floor(CAST(sum(y) AS DOUBLE) / count(*)) AS BIGINT) AS start FROM rows0 WHERE part < 8)",
        f"r0 AS MATERIALIZED (SELECT product_id, week_start, actual, part, y, [{bins}] AS b, start AS p FROM rows0, ends)",
    ]
    for k in range(ROUNDS):
        parts += [
            f"s{k} AS (SELECT f, b[f + 1] AS k, count(*) AS n, CAST(sum(y - p) AS BIGINT) AS g FROM (SELECT unnest(range({len(NUMERIC)})) AS f, b, y, p FROM r{k} WHERE part < 8) GROUP BY 1, 2)",
            f"c{k} AS (SELECT f, k, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(n) OVER (PARTITION BY f) AS nt, sum(g) OVER (PARTITION BY f) AS gt FROM s{k} WINDOW w AS (PARTITION BY f ORDER BY k))",
            f"""best{k} AS MATERIALIZED (SELECT f, k, CAST(floor(CAST(gl AS DOUBLE) * 3 / (CAST(nl AS DOUBLE) * 10)) AS BIGINT) AS lv, CAST(floor(CAST(gt - gl AS DOUBLE) * 3 / (CAST(nt - nl AS DOUBLE) * 10)) AS BIGINT) AS rv
              FROM c{k} WHERE nt > nl ORDER BY CAST(gl AS DOUBLE) * CAST(gl AS DOUBLE) / CAST(nl AS DOUBLE) + CAST(gt - gl AS DOUBLE) * CAST(gt - gl AS DOUBLE) / CAST(nt - nl AS DOUBLE) DESC, f, k LIMIT 1)""",
            f"r{k + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (p), p + CASE WHEN best{k}.f IS NULL THEN 0 WHEN b[best{k}.f + 1] <= best{k}.k THEN lv ELSE rv END AS p FROM r{k} r LEFT JOIN best{k} ON true)",
        ]
    return ", ".join(parts)


@query(f"{WITH_FEATURES}, {stump_sql()} SELECT product_id, week_start, actual, p / 1000 AS prediction FROM r{ROUNDS} WHERE part = 9")
def ml_train_regressor(t):
    """Predictions on the held-out tenth."""
    rows = features(t).select("product_id", "week_start", "category", forecast.TARGET, *NUMERIC)
    train, _, test = forecast.split(rows, ["product_id", "week_start"])
    model = forecast.train_stumps(train, NUMERIC, rounds=ROUNDS, bins=BINS)
    return model.transform(test).select("product_id", "week_start", F.col(forecast.TARGET).alias("actual"), "prediction")


@query(f"""
{WITH_FEATURES}, p AS (SELECT CAST(next_week_units_sold AS DOUBLE) AS a, CAST(current_week_units_sold AS DOUBLE) AS p FROM features)
SELECT {rounded('sqrt(avg((p - a) * (p - a)))', 6)} AS rmse, {rounded('avg(abs(p - a))', 6)} AS mae, {rounded('1 - avg((p - a) * (p - a)) / var_pop(a)', 6)} AS r_squared,
{rounded('avg(abs((p - a) / nullif(a, 0))) * 100', 6)} AS mape, {rounded('sqrt(avg(pow(ln(1 + p) - ln(1 + a), 2)))', 6)} AS rmse_log FROM p
""")
def ml_regression_metrics(t):
    """Errors of the naive forecast: next week sells what this week sold."""
    metrics = forecast.regression_metrics(features(t), forecast.TARGET, "current_week_units_sold")
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


@query(f"""
{WITH_FEATURES}, latest AS (SELECT * FROM features WHERE week_start = (SELECT max(week_start) FROM features))
SELECT product_id, product_name, category, list_price, stock_quantity, current_week_units_sold, CAST(round(current_week_units_sold * 1.1) AS DOUBLE) AS predicted_units,
  TIMESTAMP '{AS_OF}' AS forecast_generated_at, DATE '{AS_OF}' + 7 AS forecast_for_week_starting FROM latest
""")
def ml_forecast_table(t):
    value = (F.col("current_week_units_sold").cast("decimal(18,2)") * F.lit("1.1").cast("decimal(3,1)")).cast("double")
    predicted = forecast.prediction_input(features(t)).withColumn(f"predicted_{forecast.TARGET}", F.struct(value.alias("value")))
    return forecast.forecast_table(predicted, AS_OF)


@query(f"""
{STAGED}, {PERFORMANCE} SELECT category, CAST(sum(units_sold) AS BIGINT) AS current, CAST(sum(units_sold + order_count) AS BIGINT) AS predicted,
CAST(sum(CAST(rating / 10 AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS avg_confidence, count(product_id) AS products,
{rounded('CAST(sum(units_sold + order_count) - sum(units_sold) AS DOUBLE) / sum(units_sold) * 100', 1)} AS growth_pct FROM perf GROUP BY 1
""")
def ml_forecast_by_category(t):
    return forecast.forecast_by_category(
        performance(t).select(
            "product_id", "category", F.col("units_sold").alias("current_units_sold"),
            (F.col("units_sold") + F.col("order_count")).alias("predicted_next_week_units_sold"),
            (F.col("rating") / 10).alias("prediction_confidence"),
        )
    )


# --- lineage ----------------------------------------------------------------------


def logged_hops(t):
    """Run two hops and log what went in and out of each."""
    spark = t.spark
    folder = f"{shared_dir(spark)}/lineage/{uuid.uuid4()}"
    at = dt.datetime(2024, 1, 31)
    hops = [
        (lineage.Hop("clean_orders", "raw_orders", "orders", "filter"), t.orders, lambda df: df.filter(F.col("o_totalprice") > 200000)),
        (lineage.Hop("customer_totals", "orders", "customers", "aggregate"), t.orders, lambda df: df.groupBy("o_custkey").count()),
    ]
    for i, (hop, source, work) in enumerate(hops):
        hop.leaving(work(hop.entering(source))).write.mode("overwrite").parquet(f"{folder}/out{i}")
        hop.record(spark, "nightly", at).write.mode("append").parquet(f"{folder}/log")
    return spark.read.parquet(f"{folder}/log")


HOPS = """
SELECT 'clean_orders' AS task_name, 'raw_orders' AS source_table, 'orders' AS target_table, (SELECT count(*) FROM orders) AS rows_in, (SELECT count(*) FROM orders WHERE o_totalprice > 200000) AS rows_out
UNION ALL SELECT 'customer_totals', 'orders', 'customers', (SELECT count(*) FROM orders), (SELECT count(DISTINCT o_custkey) FROM orders)
"""


@query(HOPS)
def lineage_log(t):
    return logged_hops(t).select("task_name", "source_table", "target_table", "rows_in", "rows_out")


@query(f"SELECT source_table, target_table, CAST(sum(rows_out) AS BIGINT) AS total_rows, count(*) AS hops, CAST(1 AS BIGINT) AS runs FROM ({HOPS}) GROUP BY 1, 2")
def lineage_flows(t):
    return lineage.flows(logged_hops(t))
