"""Date functions and calendar tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.registry import query
from larkspur.functions import dates as d
from larkspur.operators import calendar, sets

AS_OF = "2001-12-31"
DAY = "CAST(o_orderdate AS DATE)"


def days(t):
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


def as_of():
    return F.to_date(F.lit(AS_OF))


@query(f"SELECT o_orderkey, {DAY} AS day FROM orders")
def date_from_string(t):
    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("written"))
    return written.select("o_orderkey", F.to_date("written", "yyyy-MM-dd").alias("day"))


@query("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def date_of_timestamp(t):
    return t.events.select("event_id", F.to_date("ts").alias("event_date"))


@query("""
SELECT event_id, CAST(extract(hour FROM ts) AS INTEGER) AS hour, CAST(extract(minute FROM ts) AS INTEGER) AS minute,
  CAST(extract(quarter FROM ts) AS INTEGER) AS quarter, CAST(extract(month FROM ts) AS INTEGER) AS month FROM events
""")
def date_part(t):
    parts = ("hour", "minute", "quarter", "month")
    return t.events.select("event_id", *[F.date_part(F.lit(p), "ts").cast("int").alias(p) for p in parts])


@query(f"""
SELECT o_orderkey, CAST(date_diff('day', {DAY}, DATE '{AS_OF}') AS INTEGER) AS days_since,
  CAST(date_diff('month', {DAY}, DATE '{AS_OF}') AS INTEGER) AS months_since, CAST(date_diff('year', {DAY}, DATE '{AS_OF}') AS INTEGER) AS years_since FROM orders
""")
def date_diff_days(t):
    return days(t).select(
        "o_orderkey", d.periods_since("day", as_of()).alias("days_since"),
        d.periods_since("day", as_of(), "month").alias("months_since"), d.periods_since("day", as_of(), "year").alias("years_since"),
    )


@query(f"SELECT o_orderkey, CAST(date_trunc('week', {DAY}) AS DATE) AS week FROM orders")
def date_trunc_week(t):
    return days(t).select("o_orderkey", d.iso_week_start("day").alias("week"))


@query(f"SELECT o_orderkey, strftime({DAY}, '%a') AS short_name, dayname({DAY}) AS long_name FROM orders")
def date_day_name(t):
    return days(t).select("o_orderkey", d.day_name("day").alias("short_name"), d.day_name("day", short=False).alias("long_name"))


@query(f"SELECT o_orderkey, strftime({DAY}, '%b') AS short_name, monthname({DAY}) AS long_name FROM orders")
def date_month_name(t):
    return days(t).select("o_orderkey", d.month_name("day").alias("short_name"), d.month_name("day", short=False).alias("long_name"))


@query(f"SELECT o_orderkey, CAST(day({DAY}) AS INTEGER) AS n FROM orders")
def date_day_of_month(t):
    return days(t).select("o_orderkey", F.dayofmonth("day").alias("n"))


@query(f"SELECT o_orderkey, CAST(isodow({DAY}) AS INTEGER) AS iso, CAST(dayofweek({DAY}) + 1 AS INTEGER) AS from_sunday FROM orders")
def date_day_of_week(t):
    return days(t).select("o_orderkey", d.day_of_week("day").alias("iso"), d.day_of_week("day", iso=False).alias("from_sunday"))


@query(f"SELECT o_orderkey, CAST(dayofyear({DAY}) AS INTEGER) AS n FROM orders")
def date_day_of_year(t):
    return days(t).select("o_orderkey", F.dayofyear("day").alias("n"))


@query(f"SELECT o_orderkey, CAST({DAY} - CAST(dayofweek({DAY}) AS INTEGER) AS DATE) AS first_day, CAST({DAY} - CAST(dayofweek({DAY}) AS INTEGER) + 6 AS DATE) AS last_day FROM orders")
def date_week_start_end(t):
    return days(t).select("o_orderkey", d.week_start("day").alias("first_day"), d.week_end("day").alias("last_day"))


@query(f"SELECT o_orderkey, CAST(date_trunc('week', {DAY}) AS DATE) AS first_day, CAST(date_trunc('week', {DAY}) AS DATE) + 6 AS last_day FROM orders")
def date_iso_week_start_end(t):
    return days(t).select("o_orderkey", d.iso_week_start("day").alias("first_day"), d.iso_week_end("day").alias("last_day"))


@query(f"SELECT o_orderkey, CAST(ceil(dayofyear({DAY}) / 7.0) AS INTEGER) AS week FROM orders")
def date_week_of_year(t):
    return days(t).select("o_orderkey", d.week_of_year("day").alias("week"))


@query(f"SELECT o_orderkey, CAST(weekofyear({DAY}) AS INTEGER) AS week FROM orders")
def date_iso_week_of_year(t):
    return days(t).select("o_orderkey", F.weekofyear("day").alias("week"))


@query(f"SELECT o_orderkey, {DAY} - 10 AS earlier, {DAY} + 10 AS later, {DAY} - 1 AS yesterday, {DAY} + 1 AS tomorrow FROM orders")
def date_n_days(t):
    shifts = {"earlier": -10, "later": 10, "yesterday": -1, "tomorrow": 1}
    return days(t).select("o_orderkey", *[d.days_away("day", n).alias(a) for a, n in shifts.items()])


@query(f"""
SELECT o_orderkey, CAST(date_trunc('week', {DAY} - 21) AS DATE) AS three_ago, CAST(date_trunc('week', {DAY} + 21) AS DATE) AS three_away,
  CAST(date_trunc('week', {DAY} - 7) AS DATE) AS last_week, CAST(date_trunc('week', {DAY} + 7) AS DATE) AS next_week FROM orders
""")
def date_n_weeks(t):
    shifts = {"three_ago": -3, "three_away": 3, "last_week": -1, "next_week": 1}
    return days(t).select("o_orderkey", *[d.weeks_away("day", n).alias(a) for a, n in shifts.items()])


@query(f"""
SELECT o_orderkey, CAST(date_trunc('month', {DAY} - INTERVAL 5 MONTH) AS DATE) AS five_ago, CAST(date_trunc('month', {DAY} + INTERVAL 5 MONTH) AS DATE) AS five_away,
  CAST(month({DAY} - INTERVAL 1 MONTH) AS INTEGER) AS last_number, monthname({DAY} - INTERVAL 1 MONTH) AS last_name,
  CAST(month({DAY} + INTERVAL 1 MONTH) AS INTEGER) AS next_number, strftime({DAY} + INTERVAL 1 MONTH, '%b') AS next_name FROM orders
""")
def date_n_months(t):
    last, following = d.months_away("day", -1), d.months_away("day", 1)
    return days(t).select(
        "o_orderkey", d.months_away("day", -5).alias("five_ago"), d.months_away("day", 5).alias("five_away"),
        F.month(last).alias("last_number"), d.month_name(last, short=False).alias("last_name"),
        F.month(following).alias("next_number"), d.month_name(following).alias("next_name"),
    )


# Tokyo has no daylight saving, so the plain shift is an independent check
@query("SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS tokyo_date, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS tokyo_time FROM events")
def date_now_today(t):
    return t.events.select(
        "event_id", d.today_in("Asia/Tokyo", "ts").alias("tokyo_date"),
        F.date_format(d.now_in("Asia/Tokyo", "ts"), "yyyy-MM-dd HH:mm:ss").alias("tokyo_time"),
    )


@query("SELECT event_id, strftime(ts - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS utc_time FROM events")
def date_convert_timezone(t):
    moved = d.convert_timezone("ts", "UTC", "Asia/Tokyo")
    return t.events.select("event_id", F.date_format(moved, "yyyy-MM-dd HH:mm:ss").alias("utc_time"))


@query("SELECT event_id, CAST(date_trunc('day', ts + INTERVAL 12 HOUR) AS DATE) AS nearest_day FROM events")
def date_round_timestamp(t):
    return t.events.select("event_id", F.to_date(d.round_to_day("ts")).alias("nearest_day"))


@query("""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_s, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_ms,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS from_us, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS from_ns FROM events
""")
def date_unix_to_ts(t):
    micros = t.events.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    seconds, millis = F.floor(F.col("us") / 1000000), F.floor(F.col("us") / 1000)
    whole, fine = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return micros.select(
        "event_id", F.date_format(d.from_epoch(seconds), whole).alias("from_s"),
        F.date_format(d.from_epoch(millis, "milliseconds"), whole).alias("from_ms"),
        F.date_format(d.from_epoch("us", "microseconds"), fine).alias("from_us"),
        F.date_format(d.from_epoch(F.col("us") * 1000, "nanoseconds"), fine).alias("from_ns"),
    )


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def date_ts_to_unix(t):
    return t.events.select("event_id", d.to_epoch("ts").alias("seconds"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS written FROM events")
def date_format_text(t):
    return t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("written"))


# --- calendar tables over the span of the orders -----------------------------

SPAN = "(SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders)"

DIMENSION = f"""
SELECT date_day, date_day - 1 AS prior_date_day, date_day + 1 AS next_date_day, py AS prior_year_date_day, pyoy AS prior_year_over_year_date_day,
  CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week, CAST(isodow(date_day) AS INTEGER) AS day_of_week_iso,
  dayname(date_day) AS day_of_week_name, strftime(date_day, '%a') AS day_of_week_name_short,
  CAST(day(date_day) AS INTEGER) AS day_of_month, CAST(dayofyear(date_day) AS INTEGER) AS day_of_year,
  date_day - CAST(dayofweek(date_day) AS INTEGER) AS week_start_date, date_day - CAST(dayofweek(date_day) AS INTEGER) + 6 AS week_end_date,
  pyoy - CAST(dayofweek(pyoy) AS INTEGER) AS prior_year_week_start_date, pyoy - CAST(dayofweek(pyoy) AS INTEGER) + 6 AS prior_year_week_end_date,
  CAST(ceil(dayofyear(date_day) / 7.0) AS INTEGER) AS week_of_year,
  CAST(date_trunc('week', date_day) AS DATE) AS iso_week_start_date, CAST(date_trunc('week', date_day) AS DATE) + 6 AS iso_week_end_date,
  CAST(date_trunc('week', pyoy) AS DATE) AS prior_year_iso_week_start_date, CAST(date_trunc('week', pyoy) AS DATE) + 6 AS prior_year_iso_week_end_date,
  CAST(weekofyear(date_day) AS INTEGER) AS iso_week_of_year, CAST(ceil(dayofyear(pyoy) / 7.0) AS INTEGER) AS prior_year_week_of_year,
  CAST(weekofyear(pyoy) AS INTEGER) AS prior_year_iso_week_of_year,
  CAST(month(date_day) AS INTEGER) AS month_of_year, monthname(date_day) AS month_name, strftime(date_day, '%b') AS month_name_short,
  CAST(date_trunc('month', date_day) AS DATE) AS month_start_date, last_day(date_day) AS month_end_date,
  CAST(date_trunc('month', py) AS DATE) AS prior_year_month_start_date, last_day(py) AS prior_year_month_end_date,
  CAST(quarter(date_day) AS INTEGER) AS quarter_of_year, CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  CAST(year(date_day) AS INTEGER) AS year_number, CAST(date_trunc('year', date_day) AS DATE) AS year_start_date,
  CAST(date_trunc('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date
FROM (SELECT date_day, CAST(date_day - INTERVAL 1 YEAR AS DATE) AS py, date_day - 364 AS pyoy FROM
  (SELECT CAST(unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY)) AS DATE) AS date_day FROM {SPAN}))
"""

# A year ends on the Saturday closest to 31 January: the one on or after it, or the one before.
FISCAL = f"""
WITH dim AS (SELECT CAST(unnest(generate_series(lo, hi - 1, INTERVAL 1 DAY)) AS DATE) AS date_day FROM {SPAN}),
jan AS (SELECT DISTINCT year(date_day) AS y, make_date(year(date_day), 1, 31) AS e FROM dim WHERE month(date_day) = 1),
ends AS (SELECT y, CASE WHEN dayofweek(e) >= 3 THEN e + 6 - CAST(dayofweek(e) AS INTEGER) ELSE e - 1 - CAST(dayofweek(e) AS INTEGER) END AS fe FROM jan),
fiscal AS (SELECT date_day, CAST(b.y - 1 AS INTEGER) AS fiscal_year_number, a.fe + 1 AS fiscal_year_start_date, b.fe AS fiscal_year_end_date,
  date_day - CAST(dayofweek(date_day) AS INTEGER) AS week_start_date, date_day - CAST(dayofweek(date_day) AS INTEGER) + 6 AS week_end_date,
  CAST((date_day - a.fe - 1) // 7 + 1 AS INTEGER) AS fiscal_week_of_year
  FROM ends a JOIN ends b ON b.y = a.y + 1 JOIN dim ON date_day > a.fe AND date_day <= b.fe)
"""


def order_days(t):
    first = t.orders.agg(F.to_date(F.min("o_orderdate"))).scalar()
    last = t.orders.agg(F.to_date(F.max("o_orderdate"))).scalar()
    return sets.date_spine(t.spark, first, last)


@query(DIMENSION)
def date_dimension(t):
    return calendar.date_dimension(order_days(t))


@query(FISCAL + "SELECT * FROM fiscal")
def date_fiscal_year(t):
    return calendar.fiscal_year_dates(date_dimension(t), year_end_month=1)


@query(FISCAL + """, q AS (SELECT *, least((fiscal_week_of_year - 1) // 13, 3) AS qn FROM fiscal),
p AS (SELECT *, fiscal_week_of_year - qn * 13 AS w, CASE WHEN fiscal_week_of_year - qn * 13 < 5 THEN 1 WHEN fiscal_week_of_year - qn * 13 < 10 THEN 2 ELSE 3 END AS pq FROM q)
SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year, CAST(w - [0, 4, 9][pq] AS INTEGER) AS fiscal_week_of_period,
  CAST(qn * 3 + pq AS INTEGER) AS fiscal_period_number, CAST(qn + 1 AS INTEGER) AS fiscal_quarter_number, CAST(pq AS INTEGER) AS fiscal_period_of_quarter FROM p
""")
def date_fiscal_periods(t):
    return calendar.fiscal_periods(date_dimension(t), year_end_month=1)
