"""The query registry and the table access queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.session import tune

QUERIES: dict = {}
SQL: dict[str, str] = {}


class Tables:
    """Parquet tables of one folder, by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows."""

    def add(fn):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return fn

    return add


def rounded(expression: str, digits: int, scale: int = 10) -> str:
    """SQL text that rounds a double half away from zero on its decimal form, as Spark does.

    ``scale`` is the number of decimals kept before rounding; large values leave
    room for fewer in a double.
    """
    return f"CAST(round(CAST({expression} AS DECIMAL(38,{scale})), {digits}) AS DOUBLE)"
