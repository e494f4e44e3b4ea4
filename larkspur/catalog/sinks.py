"""Sources and sinks: each query writes part of the tables, reads it back and returns what it found."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from larkspur.catalog.layout import scratch
from larkspur.catalog.registry import query
from larkspur.catalog.streams import event_files
from larkspur.functions.nested import json_scalar
from larkspur.functions.numbers import exact
from larkspur.session import cut
from larkspur.sources import readers, writers
from larkspur.sources.tables import Stored
from larkspur.streaming import events, sinks

PARTS = "p_partkey long, p_name string, p_retailprice double"


def parts(t):
    return t.part.select("p_partkey", "p_name", "p_retailprice")


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def read_csv_schema(t):
    folder = scratch(t, "csv")
    writers.write_csv(parts(t), folder, files=4)
    return readers.csv(t.spark, folder, PARTS)


@query("SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_retailprice FROM part")
def read_csv_infer(t):
    folder = scratch(t, "csv")
    writers.write_csv(parts(t), folder, files=4)
    return readers.csv_inferred(t.spark, folder)


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand AS brand FROM part WHERE p_size > 10")
def read_delimited_lines(t):
    """Files of two shapes in one folder. Short lines (of small parts) do not parse and are left out; the others are trimmed."""
    folder = scratch(t, "lines")
    fields = {"key": F.concat(F.lit("  "), F.col("p_partkey").cast("string")), "name": F.concat("p_name", F.lit("  ")), "brand": F.col("p_brand"), "size": F.col("p_size").cast("string")}
    for test, names in (("p_partkey % 2 = 0", ["key", "name", "brand"]), ("p_partkey % 2 = 1", ["size", "brand", "key", "name"])):
        line = F.when(F.col("p_size") > 10, F.concat_ws(",", *[fields[n] for n in names])).otherwise(F.col("p_partkey").cast("string"))
        lines = t.part.filter(test).select(line.alias(",".join(names)))
        lines.write.option("header", True).option("quote", "").option("sep", "\t").mode("append").csv(folder)
    return readers.delimited(t.spark, folder, ["key", "name", "brand"])


@query("SELECT event_id, user_id, event_type, value FROM events")
def read_ndjson(t):
    folder = scratch(t, "ndjson")
    writers.write_json(t.events.select("event_id", "user_id", "event_type", "value"), folder)
    return readers.ndjson(t.spark, folder, "event_id long, user_id long, event_type string, value double")


@query("SELECT * FROM supplier")
def read_table(t):
    t.supplier.createOrReplaceTempView("supplier_view")
    return readers.table(t.spark, "supplier_view")


@query("SELECT o_orderkey, 'predictions_' || o_orderstatus AS table_name FROM orders")
def read_wildcard(t):
    folder = scratch(t, "wildcard")
    for status in ("F", "O", "P"):
        t.orders.filter(F.col("o_orderstatus") == status).select("o_orderkey").write.parquet(f"{folder}/predictions_{status}")
    t.part.write.parquet(f"{folder}/other")
    return readers.wildcard(t.spark, folder, "predictions_")


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def write_csv(t):
    folder = scratch(t, "csv")
    writers.write_csv(parts(t), folder, files=1)
    return readers.csv(t.spark, folder, PARTS)


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def write_partitioned(t):
    folder = scratch(t, "partitioned")
    writers.write_partitioned(t.orders.select("o_orderkey", "o_orderpriority"), folder, "o_orderpriority")
    return t.spark.read.parquet(folder)


@query("SELECT event_id, event_type, event_type = 'error' AS is_error FROM events")
def write_jsonl(t):
    """One folder per route."""
    folder, rows = scratch(t, "jsonl"), t.events.select("event_id", "event_type")
    routes = {"errors": F.col("event_type") == "error", "rest": F.col("event_type") != "error"}
    for name, test in routes.items():
        writers.write_json(rows.filter(test), f"{folder}/{name}")
    found = [readers.ndjson(t.spark, f"{folder}/{n}", "event_id long, event_type string").withColumn("is_error", F.lit(n == "errors")) for n in routes]
    return found[0].unionByName(found[1])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def write_overwrite(t):
    folder, rows = scratch(t, "overwrite"), t.orders.select("o_orderkey", "o_totalprice")
    writers.overwrite(rows, folder)
    writers.overwrite(t.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice"), folder)
    return t.spark.read.parquet(folder)


@query("SELECT c_custkey, c_mktsegment, 'b1' AS _batch_id, DATE '2024-01-01' AS _ingested_date FROM customer UNION ALL SELECT c_custkey, c_mktsegment, 'b2', DATE '2024-01-02' FROM customer WHERE c_acctbal > 5000")
def write_append(t):
    folder, rows = scratch(t, "append"), t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    writers.append(writers.with_audit(rows, "crm", "b1", "2024-01-01 08:00:00"), folder, "_ingested_date", "c_mktsegment")
    moved = rows.filter(F.col("c_acctbal") > 5000)
    writers.append(writers.with_audit(moved, "crm", "b2", "2024-01-02 08:00:00"), folder, "_ingested_date", "c_mktsegment")
    return t.spark.read.parquet(folder).select("c_custkey", "c_mktsegment", "_batch_id", "_ingested_date")


def scratch_table(name):
    return f"{name}_{uuid.uuid4().hex[:12]}"


def read_and_drop(t, name):
    """The rows of a scratch table as a frame that outlives it."""
    rows = cut(t.spark.table(name))
    t.spark.sql(f"DROP TABLE {name}")
    return rows


@query("SELECT event_id, event_type, value FROM events")
def write_stream_append(t):
    """Into a table that exists; the stream never creates one."""
    name, folder = scratch_table("streamed"), scratch(t, "stream_append")
    writers.ensure_table(t.spark, name, "event_id BIGINT, event_type STRING, value DOUBLE", path=f"{folder}/rows")
    stream = events.read_files(t.spark, event_files(t), t.events.schema).select("event_id", "event_type", "value")
    sinks.finish(sinks.insert_to(stream, name, f"{folder}/state"))
    t.spark.catalog.refreshTable(name)
    return read_and_drop(t, name)


@query("SELECT o_orderkey AS order_id, o_totalprice AS amount FROM orders")
def ensure_table(t):
    name = scratch_table("ensured")
    rows = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"))
    schema, path = "order_id BIGINT, amount DOUBLE", scratch(t, name)
    writers.ensure_table(t.spark, name, schema, path=path)
    writers.insert_into(rows, name)
    writers.ensure_table(t.spark, name, schema, path=path)  # does not empty it
    return read_and_drop(t, name)


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def ctas_replace(t):
    name = scratch_table("replaced")
    path = scratch(t, name)
    writers.replace_table(t.orders.select("o_orderkey"), name, path)
    writers.replace_table(t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), name, path)
    return read_and_drop(t, name)


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date, json_extract_string(props, '$.k') AS k FROM events")
def insert_select(t):
    name = scratch_table("curated")
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, k STRING, event_date DATE"
    writers.ensure_table(t.spark, name, schema, "event_date", scratch(t, name))
    curated = t.events.select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("event_date"), json_scalar("props", "$.k").alias("k")
    )
    writers.insert_into(curated, name)
    return read_and_drop(t, name)


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events")
def partition_cluster_layout(t):
    folder = scratch(t, "clustered")
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("event_date"))
    writers.write_clustered(rows, folder, "event_date", "user_id", "event_type")
    return t.spark.read.parquet(folder)


@query("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 10")
def partition_retention(t):
    folder = scratch(t, "retention")
    writers.write_partitioned(t.events.select("event_id", F.to_date("ts").alias("event_date")), folder, "event_date")
    writers.expire_partitions(t.spark, folder, "event_date", F.to_date(F.lit("2024-01-30")), 10)
    return t.spark.read.parquet(folder)


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, count(*) AS n, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,10))) AS DECIMAL(18,2)) AS DOUBLE) AS total,
  min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM orders GROUP BY 1, 2
""")
def materialized_agg(t):
    """Stored before the last year was complete and with the pending orders at half their price; kept up by what was inserted, deleted and corrected since."""
    keys, sums, lows, highs = ["year", "o_orderpriority"], {"total": "amount"}, {"lowest": "o_totalprice"}, {"highest": "o_totalprice"}
    now = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderpriority", "o_totalprice", "o_orderdate", "o_orderstatus")
    late, pending = F.col("o_orderdate") >= "2001-03-01", F.col("o_orderstatus") == "P"
    halved = now.withColumn("o_totalprice", F.when(pending, F.col("o_totalprice") / 2).otherwise(F.col("o_totalprice")))
    amount = lambda df: df.withColumn("amount", exact("o_totalprice"))
    whole = [F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"), F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")]
    stored = Stored(t.spark, scratch(t, "stored"))
    stored.replace(amount(halved.filter(~late)).groupBy(*keys).agg(*whole))

    signed = lambda df, sign: amount(df).withColumn("_sign", F.lit(sign))
    steps = [
        (signed(halved.filter(late), 1), amount(halved)),
        (signed(halved.filter(pending), -1), amount(now.filter(~pending))),
        (signed(now.filter(pending), 1), amount(now)),
    ]
    for changes, source in steps:
        stored.change(lambda rows, c=changes, s=source: writers.apply_changes(rows, c, s, keys, sums, lows, highs))
    return stored.read().withColumn("total", F.col("total").cast("double"))


@query("SELECT s_suppkey, TIMESTAMP '2024-01-31 06:00:00' AS _ingested_at, 'feed' AS _source, 'b7' AS _batch_id, DATE '2024-01-31' AS _ingested_date FROM supplier")
def audit_columns(t):
    return writers.with_audit(t.supplier.select("s_suppkey"), "feed", "b7", "2024-01-31 06:00:00")


@query("SELECT count(*) AS n FROM lineitem")
def verify_readback(t):
    folder = scratch(t, "readback")
    rows = t.lineitem.select("l_orderkey", "l_linenumber")
    writers.overwrite(rows, folder)
    return writers.read_back(t.spark, folder, rows.count()).agg(F.count(F.lit(1)).alias("n"))
