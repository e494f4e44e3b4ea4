"""Order and facility pipelines, their reports, routing and user functions."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, rounded
from larkspur.functions.numbers import exact
from larkspur.operators import routing
from larkspur.plans import facilities, orders
from larkspur.session import shared_dir

AS_OF = "2001-12-31"

RAW = {
    "order_id": "l_orderkey", "customer_id": "CAST(o_custkey AS STRING)", "city": "concat('city_', c_nationkey)",
    "product_category": "c_mktsegment", "quantity": "CAST(nullif(l_quantity, 50) AS INTEGER)", "unit_price": "nullif(l_extendedprice, 0) / 10",
    "order_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'open' END",
}


def raw_orders(t):
    """One line per order: the one with the largest price."""
    best = F.max_by(F.struct("l_quantity", "l_extendedprice"), F.struct("l_extendedprice", "l_quantity"))
    lines = t.lineitem.groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", "b.*")
    joined = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in RAW.items()])


ETL = f"""
WITH b AS (SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC) = 1),
r AS (SELECT {', '.join(f'{e} AS {n}' for n, e in RAW.items())} FROM b JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
c AS (SELECT CAST(order_id AS BIGINT) AS order_id, customer_id, upper(city) AS city, product_category, coalesce(quantity, 0) AS quantity, coalesce(unit_price, 0) AS unit_price,
  CAST(order_date AS DATE) AS order_date, coalesce(status, 'unknown') AS status FROM r),
v AS (SELECT *, CAST(round(quantity * CAST(unit_price AS DECIMAL(18,6)), 2) AS DOUBLE) AS total_value FROM c),
e AS (SELECT *, CAST(month(order_date) AS INTEGER) AS order_month, CAST(year(order_date) AS INTEGER) AS order_year, CASE WHEN total_value > 100000 THEN 'YES' ELSE 'NO' END AS is_high_value,
  CASE WHEN total_value >= 300000 THEN 'Gold' WHEN total_value >= 100000 THEN 'Silver' ELSE 'Bronze' END AS value_tier, CAST(DATE '{AS_OF}' - order_date AS INTEGER) AS days_since_order FROM v)
"""
REVENUE = "CAST(CAST(sum(CAST(total_value AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE)"
MEAN = rounded(f"{REVENUE} / count(*)", 2)


def enriched(t):
    return orders.enrich(orders.clean(raw_orders(t)), AS_OF, high_value=100_000, tiers=(("Gold", 300_000), ("Silver", 100_000)))


def joined(t):
    members = t.customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.when(F.col("c_acctbal") > 5000, "Premium").otherwise("Standard").alias("membership_tier"),
    )
    return orders.with_customers(enriched(t), members)


JOINED = ETL + """
, m AS (SELECT CAST(c_custkey AS STRING) AS customer_id, c_name, CASE WHEN c_acctbal > 5000 THEN 'Premium' ELSE 'Standard' END AS membership_tier FROM customer WHERE c_acctbal >= 0),
j AS (SELECT e.*, coalesce(c_name, 'Unknown') AS customer_name, membership_tier FROM e LEFT JOIN m USING (customer_id))
"""


@query(ETL + "SELECT * FROM e")
def pipe_order_etl(t):
    return enriched(t)


@query(ETL + f"SELECT city, product_category, count(order_id) AS order_count, {REVENUE} AS total_revenue, {MEAN} AS avg_order_value FROM e WHERE status = 'completed' GROUP BY 1, 2")
def report_city_category(t):
    return orders.by_city_category(enriched(t))


@query(ETL + f"SELECT order_year, order_month, count(order_id) AS order_count, {REVENUE} AS total_revenue, {MEAN} AS avg_order_value FROM e WHERE status = 'completed' GROUP BY 1, 2")
def report_monthly(t):
    return orders.by_month(enriched(t))


@query(ETL + f"SELECT value_tier, count(order_id) AS order_count, {REVENUE} AS total_revenue FROM e WHERE status = 'completed' GROUP BY 1")
def report_value_tier(t):
    return orders.by_tier(enriched(t))


@query(JOINED + f"SELECT city, membership_tier, count(order_id) AS order_count, {REVENUE} AS total_revenue, {MEAN} AS avg_order_value, max(total_value) AS max_order_value FROM j WHERE status = 'completed' GROUP BY 1, 2")
def report_city_tier(t):
    return orders.by_city_tier(joined(t))


@query(JOINED + f"SELECT is_high_value, count(order_id) AS order_count, {REVENUE} AS total_revenue, {MEAN} AS avg_value FROM j WHERE status = 'completed' GROUP BY 1")
def report_high_value(t):
    return orders.by_high_value(joined(t))


@query(JOINED + f"SELECT customer_id, customer_name, membership_tier, count(order_id) AS total_orders, {REVENUE} AS total_spent FROM j WHERE status = 'completed' GROUP BY 1, 2, 3")
def report_top_customers(t):
    return orders.by_customer(joined(t))


# --- anomalies ------------------------------------------------------------------

SUSPECT = {
    "order_id": "concat(l_orderkey, '-', l_linenumber)", "customer_id": "CASE WHEN l_tax = 0.07 THEN ' ' ELSE concat('C', l_suppkey) END",
    "product_id": "concat('P', l_partkey)", "quantity": "concat(CAST(l_quantity AS INTEGER) * 3, '')",
    "order_amount": "CASE WHEN l_discount = 0.1 THEN '0.00' WHEN l_tax = 0.08 THEN concat('-', CAST(l_quantity AS INTEGER), '.50') ELSE concat(CAST(l_quantity AS INTEGER), '.25') END",
    "order_timestamp": "concat(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 10:00:00')",
}
NOW = "2001-09-01 00:00:00"


def suspect_orders(t):
    return t.lineitem.selectExpr(*[f"{e} AS {n}" for n, e in SUSPECT.items()])


FINDINGS = f"""
WITH o AS (SELECT {', '.join(f'{e} AS {n}' for n, e in SUSPECT.items())} FROM lineitem), f AS (
SELECT order_id, 'NEGATIVE_AMOUNT' AS anomaly_type, 'Order ID ' || order_id || ' has a negative order amount of ' || order_amount || ' INR with quantity ' || quantity || '. Customer ID ' || customer_id || '.' AS description
  FROM o WHERE CAST(order_amount AS DOUBLE) < 0
UNION ALL SELECT order_id, 'ZERO_AMOUNT_HIGH_QTY', 'Order ID ' || order_id || ' has a quantity of ' || quantity || ' and an order amount of 0.00 INR. Product ID ' || product_id || '.'
  FROM o WHERE CAST(order_amount AS DOUBLE) = 0 AND CAST(quantity AS INTEGER) > 100
UNION ALL SELECT order_id, 'FUTURE_TIMESTAMP', 'Order ID ' || order_id || ' has an order timestamp of ' || order_timestamp || ', which is in the future. Customer ID ' || customer_id || '.'
  FROM o WHERE CAST(order_timestamp AS TIMESTAMP) > TIMESTAMP '{NOW}'
UNION ALL SELECT order_id, 'MISSING_CUSTOMER_ID', 'Order ID ' || order_id || ' has a missing or empty customer ID. Order amount: ' || order_amount || ' INR, Product ID: ' || product_id || '.'
  FROM o WHERE trim(customer_id) = ''
UNION ALL SELECT order_id, 'DUPLICATE_ORDER_ID', 'Order ID ' || order_id || ' appears ' || count(*) || ' times in the dataset. This suggests a pipeline retry or double-ingestion issue.'
  FROM o GROUP BY order_id HAVING count(*) > 1)
"""


@query(FINDINGS + "SELECT * FROM f")
def pipe_order_anomalies(t):
    return orders.anomalies(suspect_orders(t), NOW)


@query(FINDINGS + """
SELECT run_id, anomaly_type, CAST(count(*) AS BIGINT) AS findings FROM f, (VALUES ('run_1'), ('run_2')) r(run_id) GROUP BY 1, 2
UNION ALL SELECT 'all runs', anomaly_type, 2 * count(*) FROM f GROUP BY 2
""")
def pipe_anomaly_report(t):
    """Two runs appended to one report table, counted by run and by type."""
    path = f"{shared_dir(t.spark)}/anomaly_report/{uuid.uuid4()}"
    found = orders.anomalies(suspect_orders(t), NOW)
    for run_id in ("run_1", "run_2"):
        orders.stamp_run(found, run_id, NOW).write.mode("append").partitionBy("run_id").parquet(path)
    report = t.spark.read.parquet(path)
    total = orders.findings_by_type(report).select(F.lit("all runs").alias("run_id"), "anomaly_type", "findings")
    return orders.findings_by_run(report).unionByName(total)


PRICED = """
WITH p AS (SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE o_custkey END AS customer_id, CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'pending' END AS status, o_orderkey AS order_id,
  c_nationkey AS items, o_totalprice AS unit_price FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def items(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), F.when(F.col("c_acctbal") >= 0, F.col("o_custkey")).alias("customer_id"),
        F.col("c_nationkey").alias("items"), F.col("o_totalprice").alias("unit_price"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("pending").alias("status"),
    )


@query(PRICED + """
SELECT count(customer_id) AS processed, count(*) FILTER (customer_id IS NOT NULL AND status = 'completed') AS completed,
  count(*) FILTER (customer_id IS NOT NULL AND items * CAST(unit_price AS DECIMAL(18,2)) >= 1000000) AS high_value,
  CAST(sum(CASE WHEN customer_id IS NOT NULL AND status = 'completed' THEN items * CAST(unit_price AS DECIMAL(18,2)) END) AS DOUBLE) AS completed_revenue,
  count(*) FILTER (customer_id IS NULL) AS errors FROM p
""")
def pipe_order_summary(t):
    return orders.summary(orders.priced(items(t), high_value=1_000_000.0))


@query(PRICED + """
SELECT order_id, items, CAST(items * CAST(unit_price AS DECIMAL(18,2)) AS DOUBLE) AS total_value, upper(status) AS status, customer_id IS NULL AS failed FROM p
""")
def map_rows(t):
    total = (F.col("items") * exact("unit_price")).cast("double")
    good, bad = routing.map_rows(items(t), {"total_value": total, "status": F.upper("status")}, required=["order_id", "customer_id"])
    failed = bad.select("order_id", "items", total.alias("total_value"), F.upper("status").alias("status"), F.lit(True).alias("failed"))
    return good.select("order_id", "items", "total_value", "status", F.lit(False).alias("failed")).unionByName(failed)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(o_orderdate AS DATE) AS DATE) AS trip_date, CAST(date_diff('second', o_orderdate, l_shipdate) // 60 AS BIGINT) AS trip_duration_minutes,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate
""")
def pipe_trip_curated(t):
    trips = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("o_orderdate").alias("pickup_at"), F.col("l_shipdate").alias("dropoff_at"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amount"),
    )
    return orders.curated_trips(trips).drop("pickup_at", "dropoff_at")


# --- facilities -------------------------------------------------------------------

LEVEL = "CASE WHEN {0} < 2000 THEN 'Above the national average' WHEN {0} < 5000 THEN 'Same as the national average' WHEN {0} < 8000 THEN 'Below the national average' ELSE 'Not Available' END"
FACILITY = {
    "facility_id": "CASE WHEN c_acctbal > 9900 THEN '' ELSE concat(' F', c_custkey, ' ') END", "facility_name": "c_name", "city": "concat(n_name, ' ')",
    "state": "CASE WHEN n_regionkey = 0 THEN n_name ELSE substr(r_name, 1, 2) END", "zip_code": "'00000'", "county": "n_name",
    "hospital_type": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE c_mktsegment END", "ownership": "r_name",
    "emergency_services": "CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END",
    "overall_rating": "CASE WHEN n_regionkey = 4 THEN 'Not Available' ELSE concat(n_regionkey + 2, '') END",
    "readmission_comparison": LEVEL.format("c_acctbal"), "patient_experience_comparison": LEVEL.format("(c_acctbal + 1000)"),
    "mortality_comparison": LEVEL.format("(c_acctbal * 2)"),
}
SALT = "pepper_"
FROM_FACILITIES = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def facility_records(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return facilities.tidy(places.selectExpr(*[f"{e} AS {n}" for n, e in FACILITY.items()]))


def score_sql(name):
    return f"CASE {name} WHEN 'Above the national average' THEN 2 WHEN 'Below the national average' THEN 0 ELSE 1 END"


FACILITIES = f"""
WITH r AS (SELECT {', '.join(f'trim({e}) AS {n}' for n, e in FACILITY.items())} FROM {FROM_FACILITIES}),
x AS (SELECT *, concat_ws(', ', CASE WHEN facility_id = '' THEN 'missing_facility_id' END, CASE WHEN NOT regexp_full_match(state, '[A-Za-z][A-Za-z]') THEN 'invalid_state:' || state END,
  CASE WHEN hospital_type = '' THEN 'missing_hospital_type' END) AS errors FROM r)
"""


@query(FACILITIES + "SELECT facility_id, facility_name, nullif(errors, '') AS validation_errors, CASE WHEN errors = '' THEN 'valid' ELSE 'invalid' END AS route FROM x")
def route_split(t):
    valid, invalid = routing.split(facilities.validate(facility_records(t)))
    kept = valid.select("facility_id", "facility_name", F.lit(None).cast("string").alias("validation_errors"), F.lit("valid").alias("route"))
    return kept.unionByName(invalid.select("facility_id", "facility_name", "validation_errors", F.lit("invalid").alias("route")))


@query(FACILITIES + f"""
SELECT facility_name, CASE WHEN errors <> '' THEN 'dead_letter' WHEN readmission_comparison = 'Above the national average' AND mortality_comparison = 'Above the national average' THEN 'alerts' ELSE 'curated' END AS route,
  CASE WHEN errors = '' THEN upper(substr(sha256('{SALT}' || facility_id), 1, 12)) END AS facility_id_masked,
  CASE WHEN errors = '' THEN CASE overall_rating WHEN '5' THEN 'A' WHEN '4' THEN 'B' WHEN '3' THEN 'C' WHEN '2' THEN 'D' WHEN '1' THEN 'F' ELSE 'UNKNOWN' END END AS quality_tier,
  CASE WHEN errors = '' THEN {rounded(f"(6 - ({score_sql('readmission_comparison')} + {score_sql('mortality_comparison')} + {score_sql('patient_experience_comparison')})) / 6 * 100", 2)} END AS risk_score FROM x
""")
def pipe_hospital_batch(t):
    """The three outputs written as JSON lines and read back."""
    folder = f"{shared_dir(t.spark)}/facilities/{uuid.uuid4()}"
    columns = "facility_name string, facility_id_masked string, quality_tier string, risk_score double"
    outputs = facilities.run(facility_records(t), folder, SALT, "2024-01-31 00:00:00")
    parts = [t.spark.read.schema(columns).json(path).withColumn("route", F.lit(name)) for name, path in outputs.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(value) AS low, max(value) AS high FROM events GROUP BY 1")
def group_apply(t):
    """The hook with a small user function; a type too large for one task is worked on in chunks."""

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["value"]
        return pd.DataFrame({"event_type": rows["event_type"].iloc[:1], "n": len(rows), "low": values.min(), "high": values.max()})

    def combine(parts: pd.DataFrame) -> pd.DataFrame:
        low, high = parts["low"].min(), parts["high"].max()
        return pd.DataFrame({"event_type": parts["event_type"].iloc[:1], "n": parts["n"].sum(), "low": low, "high": high})

    rows = t.events.select("event_id", "event_type", "value")
    return routing.group_apply(rows, ["event_type"], summarise, "event_type string, n long, low double, high double", combine)
