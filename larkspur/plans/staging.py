"""Raw to clean: the newest record per key, typed, trimmed, with derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text
from larkspur.functions.numbers import half_up, percent
from larkspur.operators.ordered import first_per_group
from larkspur.operators.rows import label_ranges, map_values

# Labels and steps the staged tables are read by.
AGE_BUCKETS = [(18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"), (56, None, "56+")]
STOCK_LEVELS = [(0, 0, "out_of_stock"), (None, 20, "low_stock"), (None, 200, "in_stock")]
FUNNEL_STEPS = {"page_view": 1, "product_view": 2, "add_to_cart": 3, "checkout_started": 4, "purchase": 5}


def newest(raw: DataFrame, key: str, tie=()) -> DataFrame:
    """The most recently ingested record per key; ``tie`` makes the choice repeatable."""
    return first_per_group(raw, [key], ["-_ingested_at", *tie])


def _audit():
    return [
        F.col("_ingested_at").cast("timestamp").alias("ingested_at"), F.col("_source").alias("record_source"),
        F.col("_batch_id").alias("batch_id"), F.col("_ingested_date").alias("ingested_date"),
    ]


def age_bucket(age="age"):
    return label_ranges(F.col(age).cast("long"), AGE_BUCKETS, "unknown")


def orders(raw: DataFrame, tie=()) -> DataFrame:
    at = F.col("order_date").cast("timestamp")
    return newest(raw, "order_id", tie).select(
        text.surrogate_key("order_id").alias("order_sk"),
        F.col("order_id").cast("long").alias("order_id"),
        F.col("user_id").cast("long").alias("customer_id"),
        F.col("product_id").cast("long").alias("product_id"),
        F.trim("product_title").alias("product_title"),
        text.lower_trim("product_category").alias("product_category"),
        F.col("product_price").cast("double").alias("unit_price"),
        F.col("quantity").cast("long").alias("quantity"),
        F.col("total_amount").cast("double").alias("total_amount"),
        text.lower_trim("status").alias("order_status"),
        text.lower_trim("payment_method").alias("payment_method"),
        at.alias("order_timestamp"),
        F.to_date(at).alias("order_date"),
        F.trim("shipping_address").alias("shipping_address"),
        *_audit(),
    )


def customers(raw: DataFrame, tie=()) -> DataFrame:
    first, last = text.title_trim("first_name"), text.title_trim("last_name")
    return newest(raw, "customer_id", tie).select(
        text.surrogate_key("customer_id").alias("customer_sk"),
        F.col("customer_id").cast("long").alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        text.lower_trim("email").alias("email"),
        F.lower(text.after(F.trim("email"), "@")).alias("email_domain"),
        F.trim("phone").alias("phone"),
        F.trim("address").alias("address"),
        *[text.title_trim(c).alias(c) for c in ("city", "state", "country")],
        F.col("age").cast("long").alias("age"),
        age_bucket().alias("age_bucket"),
        F.trim("gender").alias("gender"),
        F.col("registration_date").cast("date").alias("registration_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
        *_audit(),
    )


def products(raw: DataFrame, tie=()) -> DataFrame:
    typed = newest(raw, "product_id", tie).withColumns(
        {"price": F.col("price").cast("double"), "cost_price": F.col("cost_price").cast("double")}
    )
    margin = F.col("price") - F.col("cost_price")
    return typed.select(
        text.surrogate_key("product_id").alias("product_sk"),
        F.col("product_id").cast("long").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        text.lower_trim("category").alias("category"),
        text.display_name("category").alias("category_display"),
        "price",
        "cost_price",
        half_up(margin, 2).alias("margin"),
        percent(margin, "price").alias("margin_pct"),
        F.col("stock_quantity").cast("long").alias("stock_quantity"),
        label_ranges("stock_quantity", STOCK_LEVELS, "overstocked").alias("stock_status"),
        F.col("is_available").cast("boolean").alias("is_available"),
        F.trim("supplier").alias("supplier"),
        F.col("rating").cast("double").alias("rating"),
        F.col("review_count").cast("long").alias("review_count"),
        *_audit(),
    )


def clickstream(raw: DataFrame, tie=()) -> DataFrame:
    kind = text.lower_trim("event_type")
    at = F.col("event_timestamp").cast("timestamp")
    return newest(raw, "event_id", tie).select(
        text.surrogate_key("event_id").alias("event_sk"),
        F.trim("event_id").alias("event_id"),
        F.trim("session_id").alias("session_id"),
        F.col("user_id").cast("long").alias("user_id"),
        kind.alias("event_type"),
        map_values(kind, FUNNEL_STEPS, 0).alias("funnel_step_number"),
        (kind == "purchase").alias("is_conversion"),
        F.trim("page_url").alias("page_url"),
        F.col("product_id").cast("long").alias("product_id"),
        at.alias("event_timestamp"),
        F.to_date(at).alias("event_date"),
        text.lower_trim("device_type").alias("device_type"),
        F.trim("browser").alias("browser"),
        F.trim("referrer").alias("referrer"),
        *_audit(),
    )
