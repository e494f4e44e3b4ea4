"""Reading files and tables with declared schemas."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import cut

#: Stands for the end of a line.
END = "\u0001"


def csv(spark: SparkSession, path, schema) -> DataFrame:
    """CSV with a header and a declared schema: one pass, no inference."""
    return spark.read.csv(path, schema=schema, header=True)


def csv_inferred(spark: SparkSession, path) -> DataFrame:
    """CSV whose types are inferred by an extra pass; for exploration."""
    return spark.read.csv(path, header=True, inferSchema=True)


def _fields(line: Column, count: int, separator: str) -> Column:
    """The first ``count`` fields of a line, as an array."""
    schema = ", ".join(f"f{i} string" for i in range(count))
    parsed = F.from_csv(line, schema, {"sep": separator, "mode": "PERMISSIVE"})
    return F.array(*[parsed[f"f{i}"] for i in range(count)])


def _slugs(fields: Column) -> Column:
    """Header names as column names, as ``slug`` makes them."""
    words = lambda f: F.regexp_replace(F.regexp_replace(F.lower(F.trim(f)), "[ -]+", "_"), "[^a-z0-9_]+", "")
    return F.transform(fields, lambda f: F.regexp_replace(words(f), "^([0-9])", "_$1"))


def delimited(spark: SparkSession, path, fields, separator: str = ",") -> DataFrame:
    """Text fields by header name, trimmed; lines with fewer fields than their header are left out.

    Each file has its own header, which its lines find by the name of their file, so files with more columns, or in another
    order, may lie in one folder. A header is the first line of a file, by its place: the same text further down is a record. A
    line is a record, so quoted line breaks are not supported. The headers take a pass of their own over the lines.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")
    )
    # lines are numbered in the order of the file; the same files are always dealt out alike
    headers = cut(lines.filter("_block = 0").groupBy("_file").agg(F.min_by("value", "_at").alias("_header"), F.min("_at").alias("_first")))
    most = headers.agg(F.coalesce(F.max(F.size(F.split("_header", re.escape(separator)))), F.lit(1))).first()[0]
    named = headers.withColumn("_names", F.filter(_fields(F.col("_header"), most, separator), lambda f: f.isNotNull()))
    named = named.select("_file", "_first", F.size("_names").alias("_size"), _slugs(F.col("_names")).alias("_names"))
    places = {f: F.array_position("_names", f) for f in fields}
    lacking = named.filter(reduce(lambda a, b: a | b, [p == 0 for p in places.values()])).first()
    if lacking:
        raise ValueError(f"no column {', '.join(f for f in fields if f not in lacking['_names'])} in {lacking['_file']}")
    known = named.select("_file", "_first", "_size", *[p.cast("int").alias(f"_p_{f}") for f, p in places.items()])

    # every line gets one more field, which tells how many there were; in an open quotation it is part of another
    records = lines.withColumn("_all", _fields(F.concat("value", F.lit(separator + END)), most + 1, separator)).join(known, "_file")
    ended = F.array_position("_all", END)
    whole = (ended > F.col("_size")) | ((ended == 0) & ~F.contains(F.concat_ws("", "_all"), F.lit(END)))
    kept = records.filter(whole & (F.col("_at") != F.col("_first")))
    return kept.select(*[F.coalesce(F.trim(F.element_at("_all", F.col(f"_p_{f}"))), F.lit("")).alias(f) for f in fields])


def ndjson(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.json(path, schema=schema)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def wildcard(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """All Parquet tables of a folder whose name starts with ``prefix``, with the name of the table."""
    found = spark.read.parquet(f"{folder}/{prefix}*")
    return found.withColumn("table_name", F.regexp_extract(F.input_file_name(), rf"/({prefix}[^/]*)/[^/]*$", 1))
