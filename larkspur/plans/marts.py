"""Gold tables over the staged ones.

Staged orders have one row per order id, so orders are counted as rows; that
spares the marts a distinct count and the expansion of every row it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.numbers import exact, exact_avg, exact_sum, half_up, percent, safe_divide
from larkspur.operators import ordered
from larkspur.operators.aggregates import top_value
from larkspur.operators.rows import label_ranges
from larkspur.session import cut

# Statuses, payment methods, steps, devices and labels the marts count by.
CANCELLED = "cancelled"
PAYMENT_METHODS = ("upi", "credit_card", "cod")
STEPS = ("page_view", "product_view", "add_to_cart", "checkout_started", "purchase")
DEVICES = ("mobile", "desktop", "tablet")
LTV_SEGMENTS = (("High", 50_000), ("Medium", 10_000))
CHURN_DAYS = [(None, 30, "active"), (None, 60, "at_risk"), (None, 90, "slipping")]
NEVER_ORDERED_DAYS = 9999


def _sold():
    return F.col("order_status") != CANCELLED


def sales_daily(orders: DataFrame, products: DataFrame, payment_methods=PAYMENT_METHODS) -> DataFrame:
    """One row per day: revenue, orders, customers, cancellations, payment mix, best category.

    The category is that of the catalogue, or else the one on the order. Ties for
    the best category go to the first name.
    """
    revenue = exact_sum(F.when(_sold(), F.col("total_amount")).otherwise(0.0))
    daily = orders.groupBy("order_date").agg(
        revenue.alias("total_revenue"),
        F.count("order_id").alias("order_count"),
        F.coalesce(half_up(safe_divide(revenue, F.count_if(_sold())), 2), F.lit(0.0)).alias("avg_order_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum(F.when(_sold(), F.col("quantity")).otherwise(0)).alias("units_sold"),
        F.count_if(~_sold()).alias("cancelled_orders"),
        percent(F.count_if(~_sold()), F.count("order_id")).alias("cancellation_rate"),
        *[F.count_if(F.col("payment_method") == m).alias(f"{m}_orders") for m in payment_methods],
    )
    # summed per product before the catalogue is joined: the join sees days x products, not orders
    per_product = orders.filter(_sold()).groupBy("order_date", "product_id", "product_category").agg(
        F.sum(exact("total_amount")).alias("_r")
    )
    by_category = (
        per_product.join(products.select("product_id", "category"), "product_id", "left")
        .groupBy("order_date", F.coalesce("category", "product_category").alias("category"))
        .agg(F.sum("_r").alias("_r"))
    )
    best = ordered.first_per_group(by_category, ["order_date"], ["-_r", "category"])
    return daily.join(best.select("order_date", F.col("category").alias("top_category")), "order_date", "left")


def customer_ltv(customers: DataFrame, orders: DataFrame, as_of: str, segments=LTV_SEGMENTS, churn=None) -> DataFrame:
    """One row per current customer: spend, recency, frequency, favourites, segment and RFM scores.

    The quintiles are over all customers; equal values are split by customer id.
    """
    sold = orders.filter(_sold())
    last, first = F.max("order_date"), F.min("order_date")
    n_orders = F.count("order_id")
    per_customer = sold.groupBy("customer_id").agg(
        exact_sum("total_amount").alias("total_spend"),
        n_orders.alias("order_count"),
        half_up(exact_avg("total_amount"), 2).alias("avg_order_value"),
        F.sum("quantity").alias("total_units_purchased"),
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        F.date_diff(F.lit(as_of).cast("date"), last).alias("days_since_last_order"),
        F.date_diff(last, first).alias("customer_tenure_days"),
        half_up(safe_divide(n_orders, F.greatest(F.date_diff(last, first), F.lit(1))) * 30, 2).alias("orders_per_month"),
    )
    # one pass over the orders for both favourites
    tastes = sold.groupBy("customer_id", "payment_method", "product_category").agg(F.count(F.lit(1)).alias("_n"))
    favourites = top_value(tastes, ["customer_id"], "payment_method", "preferred_payment_method", F.sum("_n")).join(
        top_value(tastes, ["customer_id"], "product_category", "favorite_category", F.sum("_n")), "customer_id", "full"
    )
    defaults = {
        "total_spend": 0.0, "order_count": 0, "avg_order_value": 0.0, "total_units_purchased": 0,
        "days_since_last_order": NEVER_ORDERED_DAYS, "customer_tenure_days": 0, "orders_per_month": 0.0,
    }
    segment = F.when(F.col("total_spend") == 0, "New")
    for label, least in segments:
        segment = segment.when(F.col("total_spend") >= least, label)
    risk = F.when(F.col("order_count") == 0, "no_orders").otherwise(
        label_ranges("days_since_last_order", churn or CHURN_DAYS, "churned")
    )
    enriched = (
        customers.join(per_customer, "customer_id", "left")
        .join(favourites, "customer_id", "left")
        .fillna(defaults)
        .withColumn("ltv_segment", segment.otherwise("Low"))
        .withColumn("churn_risk", risk)
    )
    # three whole-table rankings read it: write it once
    scored = cut(enriched)
    measured = ordered.measure(scored, [])
    scored = ordered.ntile(scored, 5, ["-days_since_last_order", "customer_id"], "recency_score", measured=measured)
    scored = ordered.ntile(scored, 5, ["order_count", "customer_id"], "frequency_score", measured=measured)
    scored = ordered.ntile(scored, 5, ["total_spend", "customer_id"], "monetary_score", measured=measured)
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumn("rfm_total_score", total)


def product_performance(products: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per product: units, revenue, return rate, profit, days of stock, ranks and share."""
    # a row per buyer first, and a row per day beside it: counting those counts distinct ones without a copy of each order per count
    sold = _sold()
    by_buyer = orders.groupBy("product_id", "customer_id").agg(
        F.sum(F.when(sold, F.col("quantity")).otherwise(0)).alias("units_sold"), F.count_if(sold).alias("order_count"),
        F.sum(exact(F.when(sold, F.col("total_amount")).otherwise(0.0))).alias("_revenue"),
        F.sum(exact(F.when(sold, F.col("unit_price")))).alias("_asked"), F.count(F.when(sold, F.col("unit_price"))).alias("_priced"),
        F.count_if(~sold).alias("cancelled_count"), F.count("order_id").alias("_orders"),
        F.min("order_date").alias("first_sale_date"), F.max("order_date").alias("last_sale_date"),
    )
    sales = by_buyer.groupBy("product_id").agg(
        F.sum("units_sold").alias("units_sold"), F.sum("order_count").alias("order_count"), F.count("customer_id").alias("unique_buyers"),
        F.sum("_revenue").cast("double").alias("revenue"),
        half_up(safe_divide(F.sum("_asked").cast("double"), F.sum("_priced")), 2).alias("avg_selling_price"),
        F.sum("cancelled_count").alias("cancelled_count"), percent(F.sum("cancelled_count"), F.sum("_orders")).alias("return_rate"),
        F.min("first_sale_date").alias("first_sale_date"), F.max("last_sale_date").alias("last_sale_date"),
    )
    days = orders.select("product_id", "order_date").distinct().groupBy("product_id").agg(F.count("order_date").alias("active_sale_days"))
    zeros = {
        "units_sold": 0, "order_count": 0, "unique_buyers": 0, "revenue": 0.0, "cancelled_count": 0, "return_rate": 0.0,
        "active_sale_days": 0,
    }
    catalogue = products.select(
        "product_id", "product_sk", "product_name", "category", "category_display", F.col("price").alias("list_price"),
        "cost_price", "margin", "margin_pct", "stock_quantity", "stock_status", "is_available", "supplier", "rating",
        "review_count",
    )
    per_day = safe_divide("units_sold", F.greatest("active_sale_days", F.lit(1)))
    cost = F.col("units_sold") * exact("cost_price")
    enriched = (
        catalogue.join(sales, "product_id", "left").join(days, "product_id", "left").fillna(zeros)
        .withColumns(
            {
                "avg_selling_price": F.coalesce("avg_selling_price", "list_price"),
                "gross_profit": (exact("revenue") - cost).cast("decimal(28,2)").cast("double"),
                "revenue_per_unit": half_up(safe_divide("revenue", F.greatest("units_sold", F.lit(1))), 2),
                "estimated_days_of_stock": half_up(safe_divide("stock_quantity", per_day), 1),
            }
        )
    )
    stored = cut(enriched)
    measured = ordered.measure(stored, ["category"])
    ranked = ordered.rank(stored, ["category"], ["-revenue"], "rank_in_category", measured=measured, stored=stored)
    ranked = ordered.rank(ranked, ["category"], ["-units_sold"], "units_rank_in_category", measured=measured, stored=stored)
    ranked = ordered.rank(ranked, [], ["-revenue"], "overall_revenue_rank", measured=(measured[1], measured[1]), stored=stored)
    totals = stored.groupBy("category").agg(exact_sum("revenue").alias("_total"))
    ranked = ordered.attach(ranked, totals, ["category"])
    return ranked.withColumn("pct_of_category_revenue", percent("revenue", "_total")).drop("_total")


def funnel(clicks: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per day: step counts, step-to-step rates, sessions, devices, abandonment."""
    # a row per session first, and a row per visitor beside it, so that distinct ones are counted as rows
    kind, device = F.col("event_type"), F.col("device_type")
    sessions = clicks.groupBy("event_date", "session_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(kind == s).alias(s) for s in STEPS],
        *[F.count_if(device == d).alias(d) for d in DEVICES],
    )
    reached = lambda step: F.count_if((F.col(step) > 0) & F.col("session_id").isNotNull())
    names = {"page_view": "page_views", "product_view": "product_views", "purchase": "purchases"}
    by_day = sessions.groupBy("event_date").agg(
        F.sum("n").alias("total_events"),
        F.count("session_id").alias("total_sessions"),
        *[F.sum(s).alias(names.get(s, s)) for s in STEPS],
        reached("purchase").alias("sessions_with_purchase"),
        reached("add_to_cart").alias("sessions_with_cart"),
        *[F.sum(d).alias(f"{d}_events") for d in DEVICES],
    )
    visitors = clicks.select("event_date", "user_id").distinct().groupBy("event_date").agg(F.count("user_id").alias("unique_visitors"))
    daily = by_day.join(visitors, "event_date")
    confirmed = orders.filter(_sold()).groupBy(F.col("order_date").alias("event_date")).agg(
        F.count("order_id").alias("confirmed_orders"), exact_sum("total_amount").alias("order_revenue")
    )
    rates = {
        "view_to_product_rate": ("product_views", "page_views"),
        "product_to_cart_rate": ("add_to_cart", "product_views"),
        "cart_to_checkout_rate": ("checkout_started", "add_to_cart"),
        "checkout_to_purchase_rate": ("purchases", "checkout_started"),
        "view_to_order_rate": ("purchases", "page_views"),
        "session_conversion_rate": ("sessions_with_purchase", "total_sessions"),
    }
    left_behind = F.col("add_to_cart") - F.col("checkout_started")
    return (
        daily.join(confirmed, "event_date", "left")
        .fillna({"confirmed_orders": 0, "order_revenue": 0.0})
        .withColumns({name: percent(*pair) for name, pair in rates.items()})
        .withColumn("avg_events_per_session", half_up(safe_divide("total_events", "total_sessions"), 1))
        .withColumn("cart_abandonment_rate", percent(left_behind, F.greatest("add_to_cart", F.lit(1))))
    )


def demand_forecast(predictions: DataFrame, products: DataFrame) -> DataFrame:
    """Forecast with the catalogue: projected revenue, whether stock suffices, what to reorder."""
    units, stock = F.col("predicted_units"), F.col("stock_quantity")
    adequacy = F.when(stock >= units, "sufficient").when(stock >= units * 0.5, "at_risk").otherwise("insufficient")
    return products.join(predictions, "product_id").select(
        "product_id", "product_sk", "product_name", "category", "category_display", F.col("price").alias("list_price"),
        "cost_price", "margin_pct", "stock_quantity", "stock_status", "rating", "review_count", "supplier",
        "predicted_units", "forecast_generated_at", "forecast_for_week_starting",
        F.round(units.cast("decimal(18,4)") * exact("price"), 2).cast("double").alias("projected_revenue"),
        adequacy.alias("stock_adequacy"),
        F.greatest(units - stock, F.lit(0)).alias("recommended_reorder_qty"),
    )


# --- dashboard figures --------------------------------------------------------


def revenue_kpis(daily: DataFrame) -> DataFrame:
    return daily.agg(
        exact_sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("total_orders"),
        half_up(exact_avg("avg_order_value"), 2).alias("avg_order_value"), F.sum("units_sold").alias("total_units_sold"),
        F.count_distinct("order_date").alias("active_days"),
    )


def segment_kpis(ltv: DataFrame) -> DataFrame:
    return ltv.groupBy("ltv_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), half_up(exact_avg("total_spend"), 2).alias("avg_spend"),
        exact_sum("total_spend").alias("total_spend"),
    ).orderBy(F.desc("total_spend"))


def funnel_kpis(daily: DataFrame) -> DataFrame:
    steps = daily.agg(
        F.sum("page_views").alias("page_views"), F.sum("add_to_cart").alias("add_to_cart"),
        F.sum("checkout_started").alias("checkout_started"), F.sum("confirmed_orders").alias("orders"),
    )
    return steps.withColumns(
        {
            "views_to_cart_rate": percent("add_to_cart", "page_views"),
            "cart_to_checkout_rate": percent("checkout_started", "add_to_cart"),
            "checkout_to_order_rate": percent("orders", "checkout_started"),
            "overall_conversion_rate": percent("orders", "page_views"),
        }
    )
