"""Window functions, sorting, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query, rounded
from larkspur.functions.numbers import exact, exact_sum, safe_divide
from larkspur.operators import ordered
from larkspur.session import cut

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]
AMOUNT = "CAST(o_totalprice AS DECIMAL(38,10))"


def orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), "o_orderpriority")


@query(f"SELECT o_orderkey, o_custkey, o_totalprice, CAST(CAST(sum({AMOUNT}) OVER (PARTITION BY o_custkey) AS DECIMAL(18,2)) AS DOUBLE) AS total_spent FROM orders")
def win_sum_partition(t):
    return ordered.with_totals(
        t.orders.select(*ORDER_COLUMNS), ["o_custkey"], {"total_spent": exact_sum("o_totalprice")}
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders")
def win_row_number(t):
    return ordered.row_number(t.orders.select(*ORDER_COLUMNS), ["o_custkey"], ["-o_totalprice", "o_orderkey"], "rn")


@query("SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rank_val FROM orders")
def win_rank(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return ordered.rank(rows, ["o_custkey"], ["o_orderpriority"], "rank_val").drop("o_orderpriority")


@query("SELECT p_partkey, p_type, dense_rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS size_rank FROM part")
def win_dense_rank(t):
    return ordered.dense_rank(t.part.select("p_partkey", "p_type", "p_size"), ["p_type"], ["-p_size"], "size_rank").drop("p_size")


@query("SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS bucket FROM customer")
def win_ntile(t):
    return ordered.ntile(t.customer.select("c_custkey", "c_acctbal"), 5, ["c_acctbal", "c_custkey"], "bucket").drop("c_acctbal")


@query("SELECT o_orderkey, o_custkey, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price FROM orders")
def win_lead(t):
    return ordered.neighbour(
        orders(t), ["o_custkey"], ["day", "o_orderkey"], "o_totalprice", -1, "next_price"
    ).select("o_orderkey", "o_custkey", "next_price")


@query("SELECT o_orderkey, o_custkey, lag(o_totalprice, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS earlier_price FROM orders")
def win_lag(t):
    return ordered.neighbour(
        orders(t), ["o_custkey"], ["day", "o_orderkey"], "o_totalprice", 2, "earlier_price"
    ).select("o_orderkey", "o_custkey", "earlier_price")


@query(f"""
WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, CAST(CAST(sum({AMOUNT}) AS DECIMAL(18,2)) AS DOUBLE) AS total FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, day, {rounded("avg(total) OVER w", 4)} AS moving_avg, {rounded("stddev_samp(total) OVER w", 4)} AS moving_sd
FROM d WINDOW w AS (PARTITION BY o_orderpriority ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
""")
def win_rolling_avg_std(t):
    daily = orders(t).groupBy("o_orderpriority", "day").agg(exact_sum("o_totalprice").alias("total"))
    moving = ordered.rolling(daily, ["o_orderpriority"], ["day"], 7, {"moving_avg": F.avg("total"), "moving_sd": F.stddev_samp("total")})
    return moving.select("o_orderpriority", "day", *[F.round(c, 4).alias(c) for c in ("moving_avg", "moving_sd")])


@query(f"SELECT o_orderkey, o_custkey, CAST(CAST(sum({AMOUNT}) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS DECIMAL(18,2)) AS DOUBLE) AS running_total FROM orders")
def win_running_sum(t):
    rows = orders(t).withColumn("amount", exact("o_totalprice"))
    summed = ordered.running_sum(rows, ["o_custkey"], ["day"], "amount", "running_total")
    return summed.select("o_orderkey", "o_custkey", F.col("running_total").cast("double").alias("running_total"))


@query(f"""
SELECT o_orderkey, {rounded(f"CAST(CAST(sum({AMOUNT}) OVER () AS DECIMAL(18,2)) AS DOUBLE) / count(*) OVER ()", 4)} AS mean_price,
  {rounded("stddev_samp(o_totalprice) OVER ()", 4)} AS sd_price FROM orders
""")
def win_global_stats(t):
    mean = F.round(exact_sum("o_totalprice") / F.count(F.lit(1)), 4)
    spread = F.round(F.stddev_samp("o_totalprice"), 4)
    return ordered.with_totals(t.orders.select("o_orderkey", "o_totalprice"), [], {"mean_price": mean, "sd_price": spread}).drop("o_totalprice")


@query(f"""
SELECT p_type, p_partkey, {rounded("p_retailprice / CAST(CAST(sum(CAST(p_retailprice AS DECIMAL(38,10))) OVER (PARTITION BY p_type) AS DECIMAL(18,2)) AS DOUBLE)", 8, 15)} AS share FROM part
""")
def win_share_of_total(t):
    rows = ordered.with_totals(t.part.select("p_type", "p_partkey", "p_retailprice"), ["p_type"], {"total": exact_sum("p_retailprice")})
    return rows.select("p_type", "p_partkey", F.round(safe_divide("p_retailprice", "total"), 8).alias("share"))


@query(f"""
SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, CAST(CAST(sum({AMOUNT}) AS DECIMAL(18,2)) AS DOUBLE) AS revenue,
  row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY sum({AMOUNT}) DESC, o_orderpriority) AS rank_in_day FROM orders GROUP BY 1, 2
""")
def win_rank_of_aggregate(t):
    sums = orders(t).groupBy("day", "o_orderpriority").agg(exact_sum("o_totalprice").alias("revenue"))
    return ordered.row_number(sums, ["day"], ["-revenue", "o_orderpriority"], "rank_in_day")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) = 1")
def win_qualify(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return ordered.first_per_group(rows, ["l_orderkey"], ["-l_extendedprice", "l_linenumber", "l_partkey"])


@query("SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_last FROM orders")
def win_is_last(t):
    last = {"last": F.max(F.struct("day", "o_orderkey"))}
    rows = ordered.with_totals(orders(t), ["o_custkey"], last)
    return rows.select("o_orderkey", "o_custkey", (F.struct("day", "o_orderkey") == F.col("last")).alias("is_last"))


@query("SELECT event_id, user_id, ts AS valid_from, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version_number FROM events")
def win_version_number(t):
    versions = t.events.select("event_id", "user_id", F.col("ts").alias("valid_from"))
    return ordered.row_number(versions, ["user_id"], ["valid_from", "event_id"], "version_number")


# --- sorting and top-k ------------------------------------------------------


def placed(rows):
    """Rows with the position they come out at: partition by partition, row by row."""
    stored = cut(rows.withColumn("_out", F.monotonically_increasing_id()))
    return ordered.row_number(stored, [], ["_out"], "position").drop("_out")


@query("SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY n DESC, o_custkey) AS position FROM orders GROUP BY 1")
def sort_order_by(t):
    return placed(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders ORDER BY o_orderkey LIMIT 10")
def sort_limit(t):
    return placed(t.orders.select(*ORDER_COLUMNS).orderBy("o_orderkey").limit(10))


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders WHERE o_totalprice > 10000 QUALIFY position <= 20
""")
def topk_global(t):
    large = t.orders.filter(F.col("o_totalprice") > 10000).select(*ORDER_COLUMNS)
    return placed(large.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20))


@query("""
SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, o_totalprice,
  rank() OVER (PARTITION BY extract(year FROM o_orderdate) ORDER BY o_totalprice DESC) AS rank_in_year FROM orders QUALIFY rank_in_year <= 3
""")
def topk_per_group(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    return ordered.top_per_group(rows, ["year"], ["-o_totalprice"], 3, "rank_in_year").withColumn(
        "rank_in_year", F.col("rank_in_year").cast("long")
    )


@query(f"WITH s AS (SELECT o_custkey, CAST(CAST(sum({AMOUNT}) AS DECIMAL(18,2)) AS DOUBLE) AS total FROM orders GROUP BY 1) SELECT * FROM s WHERE total = (SELECT max(total) FROM s)")
def topk_rank_one(t):
    totals = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total"))
    return totals.filter(F.col("total") == totals.agg(F.max("total")).scalar())


@query("SELECT event_type, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(t):
    newest = F.max_by(F.struct("event_id", "ts", "value"), F.struct("ts", "event_id"))
    return t.events.groupBy("event_type").agg(newest.alias("e")).select("event_type", "e.*")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE date_trunc('week', o_orderdate) = (SELECT max(date_trunc('week', o_orderdate)) FROM orders)")
def latest_slice(t):
    # the newest week as a range on the bare column, so the scan can skip files
    newest = t.orders.agg(F.date_trunc("week", F.max("o_orderdate")).cast("timestamp_ntz")).scalar()
    return t.orders.filter(F.col("o_orderdate") >= newest).select("o_orderkey", "o_totalprice")
