"""Order tables: cleaning, reports, anomaly findings, summaries, trips."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.numbers import exact, exact_avg, exact_sum, half_up
from larkspur.operators.rows import flag

# Columns of the order files.
ORDER_SCHEMA = (
    "order_id int, customer_id string, city string, product_category string, quantity int, unit_price double, "
    "order_date string, status string"
)

# Defaults, thresholds and labels of the order tables.
DEFAULTS = {"quantity": 0, "unit_price": 0.0, "status": "unknown"}
HIGH_VALUE = 10_000
TIERS = (("Gold", 50_000), ("Silver", 10_000))
LOWEST_TIER = "Bronze"
COMPLETED = "completed"


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=ORDER_SCHEMA, header=True)


def clean(orders: DataFrame) -> DataFrame:
    """Rows with an id, one per id, defaults for missing values, upper-case city, typed date."""
    tidy = {"city": F.upper("city"), "order_date": F.try_to_date("order_date", "yyyy-MM-dd")}
    return orders.dropna(subset=["order_id"]).dropDuplicates(["order_id"]).fillna(DEFAULTS).withColumns(tidy)


def enrich(orders: DataFrame, as_of: str, high_value=HIGH_VALUE, tiers=TIERS) -> DataFrame:
    """Order value, its calendar parts, a flag, a tier and the age in days."""
    valued = orders.withColumn("total_value", F.round(F.col("quantity") * exact("unit_price", 6), 2).cast("double"))
    value = F.col("total_value")
    (top, least), *lower = tiers
    tier = reduce(lambda c, t: c.when(value >= t[1], t[0]), lower, F.when(value >= least, top)).otherwise(LOWEST_TIER)
    return valued.withColumns(
        {
            "order_month": F.month("order_date"),
            "order_year": F.year("order_date"),
            "is_high_value": flag(value > high_value),
            "value_tier": tier,
            "days_since_order": F.date_diff(F.lit(as_of).cast("date"), "order_date"),
        }
    )


def completed_totals(orders: DataFrame, keys, count="order_count", total="total_revenue", mean=None, largest=None) -> DataFrame:
    """Completed orders per key: how many, their value, and optionally its mean and maximum."""
    measures = [F.count("order_id").alias(count), exact_sum("total_value").alias(total)]
    if mean:
        measures.append(half_up(exact_avg("total_value"), 2).alias(mean))
    if largest:
        measures.append(half_up(F.max("total_value"), 2).alias(largest))
    return orders.filter(F.col("status") == COMPLETED).groupBy(*keys).agg(*measures)


def by_city_category(orders):
    return completed_totals(orders, ["city", "product_category"], mean="avg_order_value").orderBy(F.desc("total_revenue"))


def by_month(orders):
    months = ["order_year", "order_month"]
    return completed_totals(orders, months, mean="avg_order_value").orderBy(*months)


def by_tier(orders):
    return completed_totals(orders, ["value_tier"]).orderBy(F.desc("total_revenue"))


def with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the name and tier of their customer; an unknown customer gets a default name."""
    return orders.join(customers, "customer_id", "left").fillna({"customer_name": "Unknown"})


def by_city_tier(joined):
    keys = ["city", "membership_tier"]
    return completed_totals(joined, keys, mean="avg_order_value", largest="max_order_value").orderBy(F.desc("total_revenue"))


def by_high_value(joined):
    return completed_totals(joined, ["is_high_value"], mean="avg_value")


def by_customer(joined):
    keys = ["customer_id", "customer_name", "membership_tier"]
    return completed_totals(joined, keys, count="total_orders", total="total_spent").orderBy(F.desc("total_spent"))


# --- anomalies ----------------------------------------------------------------

# Finding types, their texts and the quantity limit.
TEXTS = {
    "NEGATIVE_AMOUNT": "Order ID %s has a negative order amount of %.2f INR with quantity %s. Customer ID %s.",
    "ZERO_AMOUNT_HIGH_QTY": "Order ID %s has a quantity of %d and an order amount of 0.00 INR. Product ID %s.",
    "FUTURE_TIMESTAMP": "Order ID %s has an order timestamp of %s, which is in the future. Customer ID %s.",
    "MISSING_CUSTOMER_ID": "Order ID %s has a missing or empty customer ID. Order amount: %s INR, Product ID: %s.",
    "DUPLICATE_ORDER_ID": "Order ID %s appears %d times in the dataset. This suggests a pipeline retry or double-ingestion issue.",
}
QUANTITY_LIMIT = 100


def _finding(kind: str, test: Column, *args) -> Column:
    return F.when(
        test, F.struct(F.lit(kind).alias("anomaly_type"), F.format_string(TEXTS[kind], *args).alias("description"))
    )


def anomalies(orders: DataFrame, as_of: str) -> DataFrame:
    """One row per finding: order id, type, text.

    The row rules are one pass of expressions; repeated ids come from a count
    per id, of which only the repeated ones leave the aggregation. All order
    columns are text, as read from a file; text that is no number or time never
    matches a rule.
    """
    rows = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    amount, quantity = F.col("order_amount").try_cast("double"), F.col("quantity").try_cast("int")
    at = F.try_to_timestamp("order_timestamp", F.lit("yyyy-MM-dd HH:mm:ss"))
    customer = F.coalesce("customer_id", F.lit(""))
    rules = F.array(
        _finding("NEGATIVE_AMOUNT", amount < 0, "order_id", amount, "quantity", customer),
        _finding("ZERO_AMOUNT_HIGH_QTY", (amount == 0) & (quantity > QUANTITY_LIMIT), "order_id", quantity, "product_id"),
        _finding("FUTURE_TIMESTAMP", at > F.lit(as_of).cast("timestamp"), "order_id", "order_timestamp", customer),
        _finding("MISSING_CUSTOMER_ID", F.trim(customer) == "", "order_id", "order_amount", "product_id"),
    )
    by_row = rows.select("order_id", F.inline(F.array_compact(rules)))
    copies = rows.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    repeated = _finding("DUPLICATE_ORDER_ID", F.lit(True), "order_id", "n")
    return by_row.unionByName(copies.select("order_id", F.inline(F.array(repeated))))


def stamp_run(findings: DataFrame, run_id: str, detected_at) -> DataFrame:
    """Findings of one run, ready to be appended to the report table."""
    return findings.select(
        F.lit(run_id).alias("run_id"), "order_id", "anomaly_type", "description",
        F.lit(detected_at).cast("timestamp").alias("detected_at"),
    )


def findings_by_type(report: DataFrame) -> DataFrame:
    return report.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("findings")).orderBy(F.desc("findings"))


def findings_by_run(report: DataFrame) -> DataFrame:
    return report.groupBy("run_id", "anomaly_type").agg(F.count(F.lit(1)).alias("findings"))


def report_kpis(report: DataFrame) -> DataFrame:
    """Findings, runs, types, the most common type and the newest run of the report table."""
    common = findings_by_type(report).orderBy(F.desc("findings"), "anomaly_type").limit(1).select("anomaly_type")
    return report.agg(
        F.count(F.lit(1)).alias("findings"), F.count_distinct("run_id").alias("runs"),
        F.count_distinct("anomaly_type").alias("types"), F.max("detected_at").alias("latest"),
    ).withColumn("most_common", common.scalar())


# --- summary ------------------------------------------------------------------

HIGH_VALUE_ORDER = 1000.0


def priced(orders: DataFrame, high_value: float = HIGH_VALUE_ORDER, processed_at: dt.datetime | None = None) -> DataFrame:
    """Order totals with a flag and an upper-case status; rows that lack a field are marked."""
    needed = ("order_id", "customer_id", "items", "unit_price", "status")
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed]))
    total = F.col("items") * exact("unit_price", 6)
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return orders.select(
        "order_id", "customer_id", "items", "unit_price", F.round(total, 2).cast("double").alias("total_value"),
        (total >= high_value).alias("is_high_value"), F.upper("status").alias("status"), stamp.alias("processed_at"),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))).alias("error"),
    )


def summary(priced_orders: DataFrame) -> DataFrame:
    """Processed, completed, high-value and bad rows with the completed revenue."""
    good = F.col("error").isNull()
    done = good & (F.col("status") == "COMPLETED")
    return priced_orders.agg(
        F.count_if(good).alias("processed"), F.count_if(done).alias("completed"),
        F.count_if(good & F.col("is_high_value")).alias("high_value"),
        F.coalesce(exact_sum(F.when(done, F.col("total_value"))), F.lit(0.0)).alias("completed_revenue"),
        F.count_if(~good).alias("errors"),
    )


# --- trips ----------------------------------------------------------------------


def curated_trips(trips: DataFrame, start="pickup_at", end="dropoff_at") -> DataFrame:
    """Trips with both times in order, their date and length in minutes; negative amounts (refunds) stay."""
    typed = trips.withColumns({start: F.col(start).cast("timestamp"), end: F.col(end).cast("timestamp")})
    minutes = F.timestamp_diff("MINUTE", F.col(start), F.col(end))
    return typed.filter(F.col(end) >= F.col(start)).withColumns(
        {"trip_date": F.to_date(start), "trip_duration_minutes": minutes}
    )


