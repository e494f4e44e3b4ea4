"""Streams over the events table, run to the end of what is there and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.catalog.layout import scratch
from larkspur.catalog.registry import query, rounded
from larkspur.session import cut
from larkspur.streaming import events, sinks

SALT = "pepper_"
FIELDS = "hospital_id string, severity string, patient_id string, at string"
SEVERITY = "CASE event_type WHEN 'view' THEN 'LOW' WHEN 'click' THEN 'MEDIUM' WHEN 'purchase' THEN 'HIGH' WHEN 'error' THEN 'CRITICAL' END"


def event_files(t):
    """A pattern, so that the table may be a file or a folder of files."""
    return f"{t.folder}/event[s].parquet"


def event_stream(t):
    return events.read_files(t.spark, event_files(t), t.events.schema).withColumn("ts", F.col("ts").cast("timestamp"))


def messages(t):
    """Admission messages as JSON text: no severity for signups, no hospital for tiny values, broken text for large ones."""
    body = F.to_json(
        F.struct(
            F.when(F.col("value") >= 0.5, F.concat(F.lit("H"), F.col("user_id"))).alias("hospital_id"),
            F.expr(SEVERITY).alias("severity"), F.concat(F.lit("P"), "event_id").alias("patient_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
        )
    )
    return event_stream(t).select("event_id", F.when(F.col("value") > 150, F.lit("{broken")).otherwise(body).alias("raw"))


def admissions(t):
    parsed = events.valid(events.parse(messages(t), FIELDS))
    return events.enrich(parsed, SALT, "v1").withColumn("at", F.col("at").cast("timestamp"))


RAW = f"""
WITH m AS (SELECT *, {SEVERITY} AS severity, CASE WHEN value >= 0.5 THEN 'H' || user_id END AS hospital_id, date_trunc('second', ts) AS at_time FROM events),
p AS (SELECT *, CASE WHEN value > 150 THEN 'parse_error' WHEN hospital_id IS NULL THEN 'missing_hospital_id' WHEN severity IS NULL THEN 'missing_severity' END AS error FROM m),
v AS (SELECT event_id, hospital_id, severity, at_time, CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 ELSE 4 END AS score FROM p WHERE error IS NULL)
"""
STATS = f"""
SELECT hospital_id, window_start, window_start + INTERVAL {{length}} MINUTE AS window_end, count(*) AS total_admissions, count(*) FILTER (severity = 'CRITICAL') AS critical_count,
  count(*) FILTER (severity = 'HIGH') AS high_count, {rounded('avg(score)', 2)} AS avg_severity_score, count(*) > {{surge}} AS is_surge,
  CASE WHEN count(*) > {{surge}} THEN count(*) || ' admissions in window' ELSE '' END AS surge_reason FROM w GROUP BY 1, 2
"""


def run_updates(t, stream, keys, name):
    folder = scratch(t, name)
    sinks.finish(sinks.updates_to(stream, f"{folder}/rows", keys, f"{folder}/state"))
    return sinks.latest(t.spark, f"{folder}/rows", keys)


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_read_events(t):
    folder = scratch(t, "read_events")
    rows = event_stream(t).select("event_id", "user_id", "event_type", "value")
    sinks.finish(sinks.append_to(rows, f"{folder}/rows", f"{folder}/state"))
    return t.spark.read.parquet(f"{folder}/rows")


@query(RAW + "SELECT event_id, CASE WHEN error = 'parse_error' THEN NULL ELSE hospital_id END AS hospital_id, CASE WHEN error = 'parse_error' THEN NULL ELSE severity END AS severity, error FROM p")
def stream_parse_validate(t):
    folder = scratch(t, "parse")
    rows = events.parse(messages(t), FIELDS).select("event_id", "hospital_id", "severity", "error")
    sinks.finish(sinks.append_to(rows, f"{folder}/rows", f"{folder}/state"))
    return t.spark.read.parquet(f"{folder}/rows")


@query(RAW + f"SELECT event_id, severity, CAST(score AS INTEGER) AS severity_score, upper(substr(sha256('{SALT}P' || event_id), 1, 10)) AS patient_id_masked, severity = 'CRITICAL' AS is_critical, 'v1' AS pipeline_version FROM v")
def stream_enrich(t):
    folder = scratch(t, "enrich")
    rows = admissions(t).select("event_id", "severity", "severity_score", "patient_id_masked", "is_critical", "pipeline_version")
    sinks.finish(sinks.append_to(rows, f"{folder}/rows", f"{folder}/state"))
    return t.spark.read.parquet(f"{folder}/rows")


@query(RAW + ", w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, at_time) AS window_start FROM v)" + STATS.format(length=5, surge=1))
def stream_tumbling_stats(t):
    stats = events.window_stats(admissions(t), "hospital_id", "at", late="2 minutes", surge_above=1)
    return run_updates(t, stats, ["hospital_id", "window_start"], "tumbling")


@query(RAW + ", w AS (SELECT *, time_bucket(INTERVAL 1 MINUTE, at_time) - to_minutes(CAST(i AS BIGINT)) AS window_start FROM v, range(3) r(i))" + STATS.format(length=3, surge=1))
def stream_sliding_stats(t):
    stats = events.window_stats(admissions(t), "hospital_id", "at", "3 minutes", "1 minute", late="2 minutes", surge_above=1)
    return run_updates(t, stats, ["hospital_id", "window_start"], "sliding")


#: Thirds of the month stand for three days; the second reaches 119 seconds past the end of the first, the third 121 past that of the second.
THIRD = "least((extract(DAY FROM ts) - 1) div 10, 2)"
REACH = {1: 119, 2: 121}


@query(f"""
WITH e AS (SELECT event_type, {THIRD.replace("div", "//")} AS third FROM events)
SELECT event_type, TIMESTAMP '2024-01-01' + to_days(CAST(third AS INTEGER)) AS window_start, count(*) AS n FROM e WHERE NOT (event_type = 'error' AND third = 1) GROUP BY 1, 2
""")
def stream_late_update(t):
    """Errors of a day arrive after the next day has begun: 119 seconds past its end they correct their window, 121 seconds past it they don't."""
    folder = scratch(t, "late")
    rows = t.events.select("event_id", "event_type", F.expr(THIRD).cast("int").alias("third"), (F.col("event_type") == "error").alias("late"))
    # the last event in time of each day but the first stands exactly at its reach
    last = rows.filter("NOT late").groupBy("third").agg(F.max("event_id").alias("last_id"))
    reach = F.coalesce(*[F.when(F.col("third") == k, v) for k, v in REACH.items()], F.lit(86_399))
    second = F.when(F.col("event_id") == F.col("last_id"), reach).otherwise(F.col("event_id") % reach)
    timed = cut(rows.join(last, "third", "left").withColumn("at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("third") * 86_400 + second)).drop("last_id"))
    for batch in ("third = 0 AND NOT late", "third = 1 AND NOT late", "third = 0 AND late", "third = 2", "third = 1 AND late"):
        timed.filter(batch).write.parquet(f"{folder}/in", mode="append")
        counts = events.read_files(t.spark, f"{folder}/in", timed.schema).withWatermark("at", "2 minutes").groupBy(F.window("at", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
        flat = counts.select("event_type", F.col("window.start").alias("window_start"), "n")
        sinks.finish(sinks.updates_to(flat, f"{folder}/rows", ["event_type", "window_start"], f"{folder}/state"))
    return sinks.latest(t.spark, f"{folder}/rows", ["event_type", "window_start"])


@query(RAW + "SELECT error, count(*) AS n FROM p WHERE error IS NOT NULL GROUP BY 1 UNION ALL SELECT 'valid', count(*) FROM v")
def stream_dead_letter(t):
    folder = scratch(t, "dead_letter")
    parsed = events.parse(messages(t), FIELDS)
    routes = {f"{folder}/valid": events.valid, f"{folder}/dead": events.dead_letters}
    sinks.finish(sinks.route_to(parsed, routes, f"{folder}/state"))
    dead = sinks.stored_rows(t.spark, f"{folder}/dead").groupBy("error").agg(F.count(F.lit(1)).alias("n"))
    good = sinks.stored_rows(t.spark, f"{folder}/valid").agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("error"), "n")
    return dead.unionByName(good)


@query(f"""
SELECT event_type AS coin, {rounded('value * 1.005 - 1', 2)} AS price_usd, {rounded('user_id * 1.5', 2)} AS volume_24h, {rounded('value / 7', 4)} AS change_24h_pct, 'quotes' AS source, 'v2' AS pipeline_version
FROM events WHERE event_type <> 'error' AND value * 1.005 - 1 > 0
""")
def stream_price_validate(t):
    folder = scratch(t, "prices")
    quotes = event_stream(t).select(
        F.col("event_type").alias("coin"), (F.col("value") * F.lit(1.005) - 1).alias("usd"),
        F.when(F.col("event_type") != "error", F.col("value") / 7).alias("usd_24h_change"),
        (F.col("user_id") * F.lit(1.5)).alias("usd_24h_vol"), F.col("ts").alias("ingested_at"),
    )
    rows = events.valid_prices(quotes, "quotes", "v2").drop("ingested_at")
    sinks.finish(sinks.append_to(rows, f"{folder}/rows", f"{folder}/state"))
    return t.spark.read.parquet(f"{folder}/rows")


@query("SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_dedupe_keyed(t):
    """Three batches, a third of the month each; what is known of a user who stays away for ten days is forgotten."""
    folder, order = scratch(t, "dedupe"), ["-ts", "-event_id"]
    rows = t.events.select("user_id", "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.expr(THIRD).alias("third"))
    for third in range(3):
        rows.filter(F.col("third") == third).drop("third").write.parquet(f"{folder}/in", mode="append")
        stream = events.read_files(t.spark, f"{folder}/in", rows.drop("third").schema)
        newest = events.newest_per_key(stream, "user_id", "ts", "event_id", "1 hour", "10 days")
        sinks.finish(sinks.updates_to(newest, f"{folder}/rows", ["user_id"], f"{folder}/state", newest=order))
    return sinks.latest(t.spark, f"{folder}/rows", ["user_id"], order)
